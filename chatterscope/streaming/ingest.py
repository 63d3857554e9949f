"""Live ingest: two raw feeds to one folder of NDJSON posts."""

from chatterscope.config import clean_keywords
from chatterscope.operators.ingest import normalize_comments, normalize_submissions, union_feeds
from chatterscope.operators.tagging import extract_brand
from chatterscope.schema import POST_SCHEMA
from chatterscope.sinks.files import start_ndjson_sink
from chatterscope.streaming.dedupe import dedupe_bounded, dedupe_stream


def mentions_feed(submissions, comments, keywords, now=None):
    """Posts of both feeds that name a keyword, with the leftmost one as brand."""
    posts = union_feeds(normalize_submissions(submissions, now), normalize_comments(comments, now))
    return extract_brand(posts, clean_keywords(keywords))


def start_ingest(submissions, comments, keywords, path, checkpoint, delay="1 hour", now=None, spread=False, bound=None, **sink):
    """Run the feed through the dedupe into the NDJSON sink. `spread` is for hot ids, and `bound` limits the ids that are
    remembered by their number instead of their time, see `streaming.dedupe`.
    """
    feed = mentions_feed(submissions, comments, keywords, now)
    unique = dedupe_stream(feed, delay, spread=spread) if bound is None else dedupe_bounded(feed, bound)
    return start_ndjson_sink(unique.select(*POST_SCHEMA.names), path, checkpoint, **sink)
