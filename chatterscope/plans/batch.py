"""The batch job: clean, tag, dedupe, score, and write three tables."""

from pyspark.sql import functions as F

from chatterscope.functions.vocabulary import compound_by_vocabulary
from chatterscope.operators.aggregates import daily_aggregate
from chatterscope.operators.clean import clean_posts, filter_year
from chatterscope.operators.ranking import dedupe_posts, monthly_top
from chatterscope.operators.scoring import lexicon_dict, score_posts, with_labels
from chatterscope.operators.serving import select_tops
from chatterscope.operators.tagging import explode_brands, has_brand, tag_posts
from chatterscope.schema import SCORED_SCHEMA
from chatterscope.session import pin_utc
from chatterscope.sinks.tables import dealt, write_daily, write_posts, write_tops
from chatterscope.sources.posts import read_posts
from chatterscope.sources.tables import read_posts_table

# What only posts with a brand need to carry through the dedupe shuffle.
_HEAVY = ("text", "url", "author", "event_tags")
_DAY = ("year", "month", "day")


def tagged_posts(posts, cfg, year=None, tables=None):
    """Unique posts with at least one brand, with `brands` and `event_tags`.

    Tagging looks at one row at a time, so it is done before the dedupe: posts without a brand still
    compete there, because they may be the newest version of their id, but leave their text behind.
    """
    tagged = tag_posts(clean_posts(filter_year(posts, year)), cfg, tables)
    tagged = tagged.withColumn("text_hash", F.xxhash64("text"))
    mentioned = F.size("brands") > 0
    light = tagged.withColumns({c: F.when(mentioned, F.col(c)) for c in _HEAVY})
    return has_brand(dedupe_posts(light)).drop("text_hash")


def scored_posts(posts, cfg, lexicon, year=None, rules=None, scorer=None, tables=None):
    """One row per post and brand, with sentiment. Each post is scored once."""
    return explode_brands(_unique_scored(posts, cfg, lexicon, year, rules, scorer, tables))


def _unique_scored(posts, cfg, lexicon, year, rules, scorer, tables):
    return score_posts(tagged_posts(posts, cfg, year, tables), lexicon, rules, scorer)


def daily_from_posts(posts, cfg, lexicon, year=None, rules=None, tables=None):
    """Daily aggregates straight from posts, when the other tables are not needed.

    Texts are tagged and scored where they are read, and never shuffled.
    """
    small = lexicon_dict(lexicon)
    if small is None:
        return daily_aggregate(scored_posts(posts, cfg, lexicon, year, rules, tables=tables))
    tagged = tag_posts(clean_posts(filter_year(posts, year)), cfg, tables)
    # Texts without a brand are not read by the scorer.
    score_text = compound_by_vocabulary(F.when(F.size("brands") > 0, F.col("text")), small, rules)
    narrow = tagged.select(
        "id",
        "created_utc",
        "fetched_at",
        "score",
        "permalink",
        "event_date",
        "brands",
        "event_tags",
        F.xxhash64("text").alias("text_hash"),
        score_text.alias("compound"),
    )
    return daily_aggregate(explode_brands(with_labels(dedupe_posts(narrow))))


def run_batch(spark, source, base, cfg, lexicon, year=None, rules=None, scorer=None, tables=None):
    """Write the three tables. The aggregates are built from the written posts, not from the input,
    so the input is read, tagged and scored once, and lost executors cost no more than their tasks.
    Brands and events come from `cfg`, or from keyword `tables`.

    Posts are dealt to the writers by day, before there is a row for each brand, so a text is moved once whatever its
    brands; top posts are written by the tasks that read them from the folders of a day.
    """
    pin_utc(spark)
    posts = source if not isinstance(source, str) else read_posts(spark, source)
    scored = dealt(_unique_scored(posts, cfg, lexicon, year, rules, scorer, tables), _DAY)
    write_posts(explode_brands(scored).select(*SCORED_SCHEMA.names), base, grouped=True)
    written = read_posts_table(spark, base)
    write_daily(daily_aggregate(written), base)
    write_tops(select_tops(monthly_top(written)), base, grouped=True)
    return base
