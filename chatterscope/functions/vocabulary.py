"""Sentiment by vocabulary: the distinct words of a batch of texts are looked up once, texts carry codes.

The rules are those of `functions.sentiment`, on arrays of codes instead of strings. The lexicon is copied to the executors, so this also
works on streams, with any lexicon that fits there.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession, functions as F

from chatterscope.functions.sentiment import PUNCTUATION, Rules, normalized, punctuation_emphasis
from chatterscope.functions.text import _col

# Characters of text that are split into words at once, so that memory stays bounded.
PIECE = 1 << 22


def bare(word):
    """A lowercase word without the punctuation at its edges, unless less than three characters would be left."""
    core = word.strip(PUNCTUATION)
    return core if len(core) > 2 else word


def split_words(texts):
    """(offsets, words) of an Arrow array of texts, words as a dictionary array."""
    lists = pc.utf8_split_whitespace(texts.fill_null(""))
    offsets = np.asarray(lists.offsets, np.int64)
    flat = lists.values.slice(offsets[0], offsets[-1] - offsets[0])
    offsets = offsets - offsets[0]
    filled = np.asarray(pc.not_equal(flat, ""))
    offsets = np.concatenate([[0], np.cumsum(filled)])[offsets]
    return offsets, flat.filter(pa.array(filled)).dictionary_encode()


class Vocabulary:
    """What the rules know of words."""

    def __init__(self, lexicon, rules):
        self.lexicon, self.rules = lexicon, rules
        self.negators = frozenset(rules.negators)

    def traits(self, words):
        """Arrays over distinct words: valence and degree (NaN for none), negator, contrast, capitals."""
        lowered = [w.lower() for w in words]
        core = [bare(w) for w in lowered]
        valence = np.array([self.lexicon.get(w, math.nan) for w in core], float)
        degree = np.array([self.rules.degrees.get(w, math.nan) for w in core], float)
        negator = np.array([w in self.negators or "n't" in w for w in core], bool)
        contrast = np.array([w == self.rules.contrast for w in core], bool)
        capital = np.array([w != low and w == w.upper() for w, low in zip(words, lowered)], bool)
        return valence, degree, negator, contrast, capital

    def totals(self, texts):
        """The sum of the weighted valences of each text of an Arrow array."""
        offsets, coded = split_words(texts)
        codes = np.asarray(coded.indices)
        out = np.zeros(len(texts))
        if not len(codes):
            return out
        valence, degree, negator, contrast, capital = self.traits(coded.dictionary.to_pylist())
        # Only words with a valence count; the others are looked at where they stand before one.
        hit = np.nonzero(~np.isnan(valence[codes]))[0]
        if not len(hit):
            return out
        row = np.searchsorted(offsets, hit, "right") - 1
        # Capitals count in texts that also have other words.
        shouted = np.concatenate([[0], np.cumsum(capital[codes])])
        mixed = shouted[offsets[1:]] - shouted[offsets[:-1]] < np.diff(offsets)
        rules, here = self.rules, codes[hit]
        value = valence[here].copy()

        def loud(code, value):
            """What capitals add, in the direction of a value."""
            return np.where(capital[code] & mixed[row], np.where(value > 0, rules.capitals, -rules.capitals), 0.0)

        value += loud(here, value)
        for back, weight in enumerate(rules.distance, start=1):
            place = hit - back
            inside = place >= offsets[row]
            before = codes[np.maximum(place, 0)]
            acts = inside & np.isnan(valence[before])
            amount = np.where(value < 0, -degree[before], degree[before]) + loud(before, value)
            moved = value + np.where(np.isnan(degree[before]), 0.0, amount * weight)
            moved = moved * np.where(negator[before], rules.negation, 1.0)
            value = np.where(acts, moved, value)
        value[~np.isnan(degree[here])] = 0.0
        turns = np.nonzero(contrast[codes])[0]
        if len(turns):
            # The first contrast word of each text.
            first = np.searchsorted(turns, offsets[:-1])
            cut = np.where(first < len(turns), turns[np.minimum(first, len(turns) - 1)], np.iinfo(np.int64).max)
            cut = np.where(cut < offsets[1:], cut, -1)[row]
            value *= np.where((cut < 0) | (cut == hit), 1.0, np.where(hit < cut, rules.before_contrast, rules.after_contrast))
        return np.bincount(row, value, minlength=len(texts))


def pieces(texts):
    """Parts of an Arrow array of about PIECE characters."""
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(texts), 0), np.int64))
    begin = 0
    while begin < len(texts):
        held = ends[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(ends, held + PIECE, "right")))
        yield texts.slice(begin, end - begin)
        begin = end


def word_hits(keys, texts, rules, maybe):
    """A row for each word that `maybe` holds (a function of different words as an Arrow array), with its three predecessors."""
    offsets, coded = split_words(texts)
    codes, raw = np.asarray(coded.indices), coded.dictionary.to_pylist()
    words = pa.array([bare(w.lower()) for w in raw], pa.string())
    capital = np.array([w != w.lower() and w == w.upper() for w in raw], bool)
    hit = np.nonzero(maybe(words)[codes])[0]
    row = np.searchsorted(offsets, hit, "right") - 1
    shouted = np.concatenate([[0], np.cumsum(capital[codes])])
    mixed = shouted[offsets[1:]] - shouted[offsets[:-1]] < np.diff(offsets)
    # The first contrast word of each text, from 1; 0 without one.
    turns = np.nonzero(np.asarray(pc.equal(words, rules.contrast))[codes])[0]
    first = np.append(turns, len(codes))[np.searchsorted(turns, offsets[:-1])]
    cut = np.where(first < offsets[1:], first - offsets[:-1] + 1, 0)
    columns = {
        "key": keys.take(pa.array(row)),
        "place": pa.array(hit - offsets[row] + 1, pa.int32()),
        "cut": pa.array(cut[row], pa.int32()),
    }
    for back in range(4):
        inside = hit - back >= offsets[row]
        before = codes[np.maximum(hit - back, 0)]
        loud = capital[before] & mixed[row] & inside
        found = [words.take(pa.array(before, mask=~inside)), pa.array(loud)]
        columns[f"w{back}"] = pa.StructArray.from_arrays(found, ["word", "capital"])
    return pa.RecordBatch.from_pydict(columns)


def distinct_words(df, text="text"):
    """word: the words of a frame of texts as the rules see them, each once; made distinct per batch before they are shuffled."""

    def run(batches):
        for batch in batches:
            for piece in pieces(batch.column(0)):
                found = pc.utf8_split_whitespace(piece.fill_null("")).flatten().unique().to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array(list({bare(w.lower()) for w in found if w}), pa.string())], ["word"])

    return df.select(text).mapInArrow(run, "word string").distinct()


def compound_by_vocabulary(text, lexicon, rules=None):
    """Sentiment in [-1, 1] of a text column, as `functions.sentiment.compound` gives it. `lexicon` is a dict of any size."""
    rules = rules or Rules()
    shared = SparkSession.active().sparkContext.broadcast(Vocabulary(lexicon, rules))

    @F.arrow_udf("double")
    def total(texts: pa.Array) -> pa.Array:
        vocabulary = shared.value
        return pa.array(np.concatenate([np.zeros(0), *[vocabulary.totals(piece) for piece in pieces(texts)]]))

    text = F.coalesce(_col(text), F.lit(""))
    return normalized(total(text), punctuation_emphasis(text, rules), rules)
