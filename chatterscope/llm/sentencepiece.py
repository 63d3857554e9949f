"""Unigram pieces: best segmentation by log scores over a double-array trie, byte fallback, exact decoding.

Spaces become the marker U+2581, a marker is put before the text, and every marker begins a new word, so that the
best segmentation of a text is that of its words in a row (no piece of the vocabulary has a marker after another
character; pieces that do are left out). Characters that no piece covers become byte pieces. A literal U+2581 of
the text also goes through its bytes, so that decoding gives back the very text.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from chatterscope.llm.batches import pieces, with_result

MARK = "▁"
UNKNOWN_PENALTY = 10.0


class Vocabulary:
    """Pieces, scores and the double array: a child of state s by character c is base[s] + code(c), if check says so."""

    def __init__(self, pieces, scores, byte_ids):
        self.pieces, self.scores, self.byte_ids = pieces, np.asarray(scores, np.float64), byte_ids
        special = set(byte_ids) | {i for i, p in enumerate(pieces) if p in ("<unk>", "<s>", "</s>", "<pad>")}
        self.usable = usable = {p: i for i, p in enumerate(pieces) if p and i not in special and MARK not in p[1:]}
        self.raw = [b"" if i in special else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.is_byte = np.zeros(len(pieces), bool)
        for b, i in enumerate(byte_ids):
            self.raw[i], self.is_byte[i] = bytes([b]), True
        self.unknown = float(min((self.scores[i] for i in usable.values()), default=0.0)) - UNKNOWN_PENALTY
        # Frequent characters get small codes, which keeps the children of a state close together.
        times = {}
        for c in "".join(usable):
            times[c] = times.get(c, 0) + 1
        letters = sorted(times, key=lambda c: (-times[c], c))
        self.codes = np.zeros(0x110000, np.int32)
        for k, c in enumerate(letters):
            self.codes[ord(c)] = k + 1
        self._build(usable, {c: k + 1 for k, c in enumerate(letters)}, len(letters) + 2)

    def _build(self, usable, code, width):
        children = [{}]
        value = [-1]
        for piece, number in usable.items():
            node = 0
            for c in piece:
                nxt = children[node].get(code[c])
                if nxt is None:
                    nxt = len(children)
                    children[node][code[c]] = nxt
                    children.append({})
                    value.append(-1)
                node = nxt
            value[node] = number
        size = len(children) * 2 + 4 * width
        base, check, leaf = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        taken = bytearray(size)
        taken[0] = 1
        place, free, top = {0: 0}, 1, 1
        order, at = [0], 0
        while at < len(order):  # level by level: a node is placed before its children
            node = order[at]
            at += 1
            state = place[node]
            leaf[state] = value[node]
            kids = sorted(children[node])
            if not kids:
                continue
            while taken[free]:
                free += 1
            # First fit over a bounded number of places, else behind all that is taken: room is cheaper than search.
            start, tries = max(1, free - kids[0]), 0
            while any(taken[start + k] for k in kids):
                start, tries = (start + 1, tries + 1) if tries < 64 else (max(1, top - kids[0]), tries)
            if top + 3 * width + 64 >= len(taken):
                more = len(taken)
                taken += bytearray(more)
                base = np.concatenate([base, np.zeros(more, np.int32)])
                check = np.concatenate([check, np.full(more, -1, np.int32)])
                leaf = np.concatenate([leaf, np.full(more, -1, np.int32)])
            base[state] = start
            top = max(top, start + kids[-1] + 1)
            for k in kids:
                taken[start + k], check[start + k] = 1, state
                place[children[node][k]] = start + k
                order.append(children[node][k])
        end = top + 2 * width
        pad = lambda a, fill: np.concatenate([a[:end], np.full(max(0, end - len(a)), fill, np.int32)])
        self.base, self.check, self.leaf = pad(base, 0), pad(check, -1), pad(leaf, -1)


def load_vocabulary(path) -> Vocabulary:
    """Pieces and scores of a model file; its scores are taken as log scores as they are."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    byte_ids = [model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    return Vocabulary(pieces, [model.get_score(i) for i in range(n)], byte_ids)


def encode_words(words, vocab):
    """A list of ids per word: Viterbi over all words at once, place by place.

    Words are handled in groups of like length, so that the tables have no more than a constant share of padding.
    """
    out = [None] * len(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(sizes, kind="stable")
    begin = 0
    while begin < len(order):
        longest = sizes[order[begin]]
        if longest > 64:  # alone, character by character
            out[order[begin]] = encode_long(words[order[begin]], vocab)
            begin += 1
            continue
        end = begin + int(np.searchsorted(sizes[order[begin : begin + 20_000]], longest * 1.25, "right"))
        group = order[begin:end]
        for i, ids in zip(group, _encode_group([words[i] for i in group], vocab)):
            out[i] = ids
        begin = end
    return out


def _encode_group(words, vocab):
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    n, width = len(words), int(sizes.max())
    chars = np.zeros((width, n), np.int64)
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    row = np.repeat(np.arange(n), sizes)
    chars[np.arange(len(flat)) - np.repeat(np.cumsum(sizes) - sizes, sizes), row] = flat
    codes = vocab.codes[chars]
    codes[1:][chars[1:] == ord(MARK)] = 0  # a marker of the text itself
    best = np.full((width + 1, n), -np.inf)
    best[0] = 0
    came = np.zeros((width + 1, n), np.int16)
    piece = np.full((width + 1, n), -1, np.int32)
    for i in range(width):
        live = np.nonzero(sizes > i)[0]
        worse = best[i, live] + vocab.unknown
        better = worse > best[i + 1, live]
        at = live[better]
        best[i + 1, at], came[i + 1, at], piece[i + 1, at] = worse[better], i, -1
        state = np.zeros(len(live), np.int64)
        for j in range(i, width):
            code = codes[j, live]
            nxt = vocab.base[state] + code
            ok = (code > 0) & (vocab.check[nxt] == state) & (vocab.base[state] > 0)
            live, state = live[ok], nxt[ok]
            if not len(live):
                break
            number = vocab.leaf[state]
            whole = number >= 0
            at, number = live[whole], number[whole]
            score = best[i, at] + vocab.scores[number]
            better = score > best[j + 1, at]
            at = at[better]
            best[j + 1, at], came[j + 1, at], piece[j + 1, at] = score[better], i, number[better]
    out = []
    came, piece = came.T.tolist(), piece.T.tolist()
    for w, word in enumerate(words):
        ids, at = [], len(word)
        while at:
            if piece[w][at] >= 0:
                ids.append(piece[w][at])
            else:
                ids += reversed(byte_pieces(word[at - 1], vocab))
            at = came[w][at]
        out.append(ids[::-1])
    return out


def byte_pieces(char, vocab):
    return [vocab.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]


def encode_long(word, vocab):
    """One word of any length in one pass; the same rules."""
    base, check, leaf, codes = vocab.base, vocab.check, vocab.leaf, vocab.codes
    n = len(word)
    best, came, piece = [0.0] + [-np.inf] * n, [0] * (n + 1), [-1] * (n + 1)
    for i in range(n):
        if best[i] + vocab.unknown > best[i + 1]:
            best[i + 1], came[i + 1], piece[i + 1] = best[i] + vocab.unknown, i, -1
        state = 0
        for j in range(i, n):
            code = 0 if j and word[j] == MARK else int(codes[ord(word[j])])
            nxt = int(base[state]) + code
            if not code or not base[state] or check[nxt] != state:
                break
            state = nxt
            number = int(leaf[state])
            if number >= 0 and best[i] + vocab.scores[number] > best[j + 1]:
                best[j + 1], came[j + 1], piece[j + 1] = best[i] + vocab.scores[number], i, number
    ids, at = [], n
    while at:
        ids += [piece[at]] if piece[at] >= 0 else reversed(byte_pieces(word[at - 1], vocab))
        at = came[at]
    return ids[::-1]


def cut(text):
    """Words of a text, each with the marker in front; an empty text has none."""
    return [MARK + word for word in text.split(" ")] if text else []


def encode(texts, vocab):
    """An int32 array of ids per text; each distinct word of these texts is segmented once."""
    number, per_text = {}, []
    for text in texts:
        mine = cut(text)
        per_text.append(np.fromiter((number.setdefault(w, len(number)) for w in mine), np.int64, len(mine)))
    ids = encode_words(list(number), vocab)
    sizes = np.fromiter(map(len, ids), np.int64, len(ids))
    starts = np.cumsum(sizes) - sizes
    flat = np.fromiter((i for w in ids for i in w), np.int32, int(sizes.sum()))
    out = []
    for mine in per_text:
        n = sizes[mine]
        shift = np.repeat(starts[mine] - (np.cumsum(n) - n), n)
        out.append(flat[np.arange(len(shift)) + shift])
    return out


def decode(ids, vocab):
    """The text of one array of ids: pieces in a row, markers as spaces, without the first one."""
    return b"".join(map(vocab.raw.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")[1:]


def encoded(docs: DataFrame, vocab: Vocabulary, name="ids") -> DataFrame:
    """docs with an array<int> column of ids: null for a null text, empty for an empty one.

    All columns and rows stay; a column called `name` is replaced.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocab)  # bounded by the vocabulary file

    @F.pandas_udf("array<int>")
    def run(texts: pd.Series) -> pd.Series:
        out = []
        for begin, end in pieces(texts):
            out += encode(["" if t is None else t for t in texts.iloc[begin:end]], shared.value)
        return pd.Series(out, dtype=object)

    return docs.withColumn(name, F.when(F.col("text").isNotNull(), run("text")))


def decoded(frame: DataFrame, vocab: Vocabulary, ids="ids", name="text") -> DataFrame:
    """frame with the texts of its ids; null for null. The exact inverse of `encoded`."""
    shared = frame.sparkSession.sparkContext.broadcast(vocab)

    @F.pandas_udf("string")
    def run(rows: pd.Series) -> pd.Series:
        return pd.Series([None if r is None else decode(np.asarray(r), shared.value) for r in rows], dtype=object)

    return frame.withColumn(name, run(ids))


SCHEMA = "n_ids long, n_byte_ids long, ids_sha256 string, round_trip boolean"


def digests(docs: DataFrame, vocab: Vocabulary, name="pieces") -> DataFrame:
    """docs with a struct column: number of ids and of byte ids, SHA-256 of the ids as little-endian 32-bit numbers,
    and whether decoding them gives back the text. A null text counts as an empty one."""
    shared = docs.sparkSession.sparkContext.broadcast(vocab)

    def run(texts):
        v = shared.value
        return [
            (len(ids), int(v.is_byte[ids].sum()), hashlib.sha256(ids.tobytes()).hexdigest(), decode(ids, v) == text)
            for text, ids in zip(texts, encode(texts, v))
        ]

    return with_result(docs, run, SCHEMA, name)
