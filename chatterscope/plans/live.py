"""One tick of the live view as a batch."""

from typing import NamedTuple

from pyspark.sql import DataFrame, functions as F

from chatterscope.functions.text import contains_any
from chatterscope.operators.live import (
    add_seen,
    filter_relevancy,
    keep_last,
    live_point,
    since,
    unseen,
    waterline,
    with_live_key,
)
from chatterscope.operators.scoring import with_provider
from chatterscope.operators.seen import SeenKeys


class Tick(NamedTuple):
    posts: DataFrame
    point: DataFrame
    seen: DataFrame | SeenKeys
    waterline: DataFrame
    scored: DataFrame


def scored_matches(new, epoch, keywords, lexicon, provider="lexicon", rules=None):
    """Rows since `epoch` that mention a keyword, scored."""
    fresh = since(new, epoch)
    return with_provider(fresh.where(contains_any("text", keywords)), provider, lexicon, rules)


def relevant(scored, provider="lexicon", threshold=0.5):
    return filter_relevancy(scored, threshold) if provider == "gemini" else scored


def gather(new, epoch, keywords, lexicon, provider="lexicon", threshold=0.5, rules=None):
    """Scored matches without those of low relevancy."""
    scored = scored_matches(new, epoch, keywords, lexicon, provider, rules)
    return relevant(scored, provider, threshold)


def live_tick(
    new, seen, epoch, now, keywords, lexicon, provider="lexicon", threshold=0.5, rules=None
):
    """A tick over the rows in `new`: `seen` holds the live_keys of earlier ticks.

    As a frame, `seen` grows by a union with each tick, which is for a few ticks; as SeenKeys it is stored, and plans do not grow. All
    parts use the scored rows, which are persisted; unpersist `scored` when the tick is done.
    """
    scored = scored_matches(new, epoch, keywords, lexicon, provider, rules).persist()
    raw = relevant(scored, provider, threshold)
    last = keep_last(with_live_key(raw))
    if isinstance(seen, SeenKeys):
        at = last.sparkSession.range(1).select(F.lit(now).cast("timestamp").cast("double")).first()[0]
        posts = seen.unseen(last, at)
        after = seen.added(posts, at)
    else:
        posts = unseen(last, seen)
        after = add_seen(seen, posts)
    return Tick(posts, live_point(posts, now, provider), after, waterline(raw), scored)
