"""The time series behind a dashboard."""

from chatterscope.operators.ranking import attach_top_post, rolling_mean
from chatterscope.operators.serving import as_series, order_series, slice_daily
from chatterscope.sources.tables import read_daily, read_posts_table


def brand_series(spark, base, brand, year=None, rolling=True):
    """Daily values of a brand with rolling means and the best post of each day, by date."""
    daily = slice_daily(read_daily(spark, base), brand, year)
    posts = slice_daily(read_posts_table(spark, base), brand, year)
    if rolling:
        daily = rolling_mean(daily)
    return order_series(as_series(attach_top_post(daily, posts)))
