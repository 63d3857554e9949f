"""Many terms, looked up in many texts at once.

Terms are found by hashes of their bytes. The hash of any stretch of a text is the difference of two running sums, so that a
stretch costs the same whatever its length and whatever the number of terms: places whose first bytes begin no term are
passed over, and the others are asked for the whole of a term, once for each length of the terms that begin so. Works on UTF-8
bytes, where a term occurs in a text exactly if its bytes do.
"""

import numpy as np
import pyarrow as pa

# Bytes by which the beginning of a term is known; a shorter term by the largest of these sizes that it has.
GRAMS = (1, 2, 3, 4, 8)
# Bytes of text that are looked at at once, so that memory stays bounded whatever a batch holds.
PIECE = 1 << 18
PAIRS = 1 << 20  # places and terms that are compared at once
_MIX = np.uint64(0x9E3779B97F4A7C15)  # odd numbers
_BASE, _UNBASE = 0xD1342543DE82EF95, pow(0xD1342543DE82EF95, -1, 1 << 64)


def _mixed(numbers):
    for shift in (31, 29):
        numbers = (numbers ^ (numbers >> np.uint64(shift))) * _MIX
    return numbers


_VALUES = _mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS = [np.ones(1, np.uint64)] * 2


def _powers(n):
    """The first n powers of the base and of its inverse; all numbers are taken modulo 2 ** 64."""
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            steps = np.full(max(n, 1 << 16), base, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.cumprod(steps)
    return _POWERS[0][:n], _POWERS[1][:n]


class _Sums:
    """Hashes of the stretches of some bytes."""

    def __init__(self, data):
        power, self.inverse = _powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_VALUES[data] * power[:-1], out=self.sums[1:])

    def of(self, start, size):
        """Of those that begin at `start` and have `size` bytes."""
        return (self.sums[start + size] - self.sums[start]) * self.inverse[start]

    def every(self, size):
        """Of all stretches of `size` bytes."""
        n = max(0, len(self.sums) - size)
        return (self.sums[size:] - self.sums[:n]) * self.inverse[:n]


def _slots(hashes, bits):
    return _mixed(hashes) >> np.uint64(64 - bits)


def _gram_sizes(lengths):
    return np.array(GRAMS)[np.searchsorted(GRAMS, lengths, "right") - 1]


def _term_hashes(data, lengths, sizes):
    """The hashes of terms that follow each other in data, and those of their first `sizes` bytes."""
    ends, wholes, grams, i = np.cumsum(lengths), [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    while i < len(lengths):
        begin = ends[i] - lengths[i]
        j = max(i + 1, int(np.searchsorted(ends, begin + PIECE, "right")))
        sums, starts = _Sums(data[begin : ends[j - 1]]), ends[i:j] - lengths[i:j] - begin
        wholes.append(sums.of(starts, lengths[i:j]))
        grams.append(sums.of(starts, sizes[i:j]))
        i = j
    return np.concatenate(wholes), np.concatenate(grams)


def _spread(heads, counts):
    """0 .. counts[i] - 1 after heads[i], for all i in a row."""
    return np.arange(counts.sum()) + np.repeat(heads - np.cumsum(counts) + counts, counts)


def _parts(counts):
    """Bounds of stretches of `counts` that sum up to about PAIRS."""
    cuts = np.searchsorted(np.cumsum(counts), np.arange(PAIRS, counts.sum() + PAIRS, PAIRS), "left") + 1
    begin = 0
    for end in np.unique(np.minimum(cuts, len(counts))).tolist():
        yield begin, end
        begin = end


def text_bytes(column):
    """(offsets, bytes) of an Arrow column of strings; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def stretch_texts(data, begin, end):
    """The stretches begin .. end of some bytes as an Arrow array of strings."""
    size = end - begin
    ends = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    held = pa.py_buffer(data[_spread(begin, size)])
    return pa.LargeStringArray.from_buffers(len(size), pa.py_buffer(ends), held).cast(pa.string())


class _Keyed:
    """Different terms of at least `size` bytes, keyed by the hash of their first `size` bytes."""

    def __init__(self, size, ids, starts, lengths, wholes, grams):
        self.size = size
        self.bits = max(16, (16 * len(ids)).bit_length())
        by_hash = np.argsort(wholes, kind="stable")
        self.hash = wholes[by_hash]
        self.ids, self.starts, self.lengths = ids[by_hash], starts[by_hash], lengths[by_hash]
        # The lengths of the terms of each gram.
        order = np.lexsort((lengths, grams))
        grams, sizes = grams[order], lengths[order]
        new = np.ones(len(grams), bool)
        new[1:] = (grams[1:] != grams[:-1]) | (sizes[1:] != sizes[:-1])
        grams, self.sizes = grams[new], sizes[new]
        self.gram, heads = np.unique(grams, return_index=True)
        self.heads = np.append(heads, len(grams))
        self.begins, self.whole = np.zeros(1 << self.bits, bool), np.zeros(1 << self.bits, bool)
        self.begins[_slots(self.gram, self.bits)] = True
        self.whole[_slots(self.hash, self.bits)] = True

    def candidates(self, sums):
        """(start, place of the term in this table) of what may be occurrences, in parts of about PAIRS."""
        grams, end = sums.every(self.size), len(sums.sums) - 1
        places = np.nonzero(self.begins[_slots(grams, self.bits)])[0]
        known = np.minimum(np.searchsorted(self.gram, grams[places]), len(self.gram) - 1)
        same = self.gram[known] == grams[places]
        places, known = places[same], known[same]
        counts = self.heads[known + 1] - self.heads[known]
        for a, b in _parts(counts):
            start = np.repeat(places[a:b], counts[a:b])
            size = self.sizes[_spread(self.heads[known[a:b]], counts[a:b])]
            fits = start + size <= end
            start, size = start[fits], size[fits]
            found = sums.of(start, size)
            maybe = self.whole[_slots(found, self.bits)]
            start, found = start[maybe], found[maybe]
            first = np.searchsorted(self.hash, found, "left")
            many = np.searchsorted(self.hash, found, "right") - first
            yield np.repeat(start, many), _spread(first, many)


class TermIndex:
    """Finds terms in texts. Terms are strings; empty ones never occur."""

    def __init__(self, terms):
        places = {}
        which = np.array([places.setdefault(t, len(places)) for t in terms], np.int64)
        # The terms of each different one.
        self.terms = np.argsort(which, kind="stable")
        self.counts = np.bincount(which, minlength=len(places))
        self.heads = np.cumsum(self.counts) - self.counts
        encoded = [t.encode("utf-8") for t in places]
        lengths = np.array([len(t) for t in encoded], np.int64)
        starts = np.cumsum(lengths) - lengths
        self.data = np.frombuffer(b"".join(encoded), np.uint8)
        sizes = np.where(lengths > 0, _gram_sizes(np.maximum(lengths, 1)), 0)
        wholes, grams = _term_hashes(self.data, lengths, sizes)
        self.keyed = []
        for size in GRAMS:
            ids = np.nonzero(sizes == size)[0]
            if len(ids):
                self.keyed.append(_Keyed(size, ids, starts[ids], lengths[ids], wholes[ids], grams[ids]))

    def find(self, offsets, data):
        """Sorted pairs (text, term) without repeats, as two arrays; offsets and data as of `text_bytes`."""
        texts, terms = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for i, j in text_parts(offsets):
            text, term = self._find(np.asarray(offsets[i : j + 1]), data)
            texts.append(text + i)
            terms.append(term)
        return np.concatenate(texts), np.concatenate(terms)

    def _find(self, bounds, data):
        overlap = max((int(k.lengths.max()) for k in self.keyed), default=0)
        found = [np.zeros(0, np.int64)]
        for piece, a in _text_pieces(bounds, data, overlap):
            sums = _Sums(piece)
            for keyed in self.keyed:
                for start, term in keyed.candidates(sums):
                    found.append(self._occurring(keyed, start, term, piece, a, bounds))
        pairs = np.unique(np.concatenate(found))
        row, different = pairs >> 32, pairs & 0xFFFFFFFF
        counts = self.counts[different]
        pairs = np.sort((np.repeat(row, counts) << 32) | self.terms[_spread(self.heads[different], counts)])
        return pairs >> 32, pairs & 0xFFFFFFFF

    def _occurring(self, keyed, start, term, piece, begin, bounds):
        """Those of the candidates in a piece (that begins at `begin`) that occur, as text << 32 | term."""
        size = keyed.lengths[term]
        row = np.searchsorted(bounds, start + begin, "right") - 1
        fits = start + begin + size <= bounds[row + 1]
        start, term, row = start[fits], term[fits], row[fits]
        pairs, found = (row << 32) | keyed.ids[term], [np.zeros(0, np.int64)]
        # Compared byte by byte, all at once; most differ in the first ones.
        alive, k = np.arange(len(start)), 0
        while len(alive):
            done = keyed.lengths[term[alive]] == k
            found.append(pairs[alive[done]])
            alive = alive[~done]
            same = piece[start[alive] + k] == self.data[keyed.starts[term[alive]] + k]
            alive, k = alive[same], k + 1
        return np.unique(np.concatenate(found))


def text_parts(offsets):
    """Bounds of stretches of texts that have about PIECE bytes."""
    i = 0
    while i < len(offsets) - 1:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + PIECE, "right")) - 1)
        j = min(j, len(offsets) - 1)
        yield i, j
        i = j


def _text_pieces(bounds, data, overlap):
    """(bytes, where they begin); a longer text is cut into pieces that overlap by the longest term."""
    begin, end = int(bounds[0]), int(bounds[-1])
    for a in range(begin, max(end, begin + 1), PIECE):
        yield data[a : min(a + PIECE + overlap, end)], a


def filter_slots(terms, bits):
    """The bits that terms (an Arrow array without empty ones) and their beginnings set in a filter of 2 ** bits bits."""
    offsets, data = text_bytes(terms)
    data, lengths = data[offsets[0] : offsets[-1]], np.diff(offsets)
    wholes, grams = _term_hashes(data, lengths, _gram_sizes(lengths))
    return np.unique(_slots(np.concatenate([wholes, ~grams]), bits)).astype(np.int64)


class TermFilter:
    """Finds the stretches of texts that may be terms, by a filter of fixed size for any number of terms.

    A term is always found; a stretch that is no term seldom. `words` is the filter in words of 64 bits, `lengths` are the
    lengths of the terms in bytes.
    """

    def __init__(self, words, lengths):
        self.words, self.lengths = np.asarray(words, np.uint64), np.unique(lengths)
        self.bits = (64 * len(self.words)).bit_length() - 1

    def _holds(self, hashes):
        slot = _slots(hashes, self.bits)
        return ((self.words[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)

    def maybe(self, words):
        """Of each word of an Arrow array without empty ones, whether it may be a term."""
        offsets, data = text_bytes(words)
        lengths = np.diff(offsets)
        return self._holds(_term_hashes(data[offsets[0] : offsets[-1]], lengths, _gram_sizes(lengths))[0])

    def find(self, offsets, data):
        """(text, begin, end in data) of the stretches, as three arrays; offsets and data as of `text_bytes`."""
        found = [np.zeros((3, 0), np.int64)]
        for i, j in text_parts(offsets):
            bounds = np.asarray(offsets[i : j + 1])
            for piece, a in _text_pieces(bounds, data, int(self.lengths.max(initial=0))):
                sums, gram_sizes = _Sums(piece), _gram_sizes(self.lengths)
                # Characters begin at bytes that do not continue one.
                begins = np.append((piece & 0xC0) != 0x80, True)
                for gram in np.unique(gram_sizes):
                    places = np.nonzero(self._holds(~sums.every(int(gram))))[0]
                    places = places[begins[places] & (places < PIECE)]
                    row = np.searchsorted(bounds, places + a, "right") - 1
                    left = bounds[row + 1] - a - places
                    for size in self.lengths[gram_sizes == gram].tolist():
                        fits = np.nonzero((size <= left) & begins[np.minimum(places + size, len(piece))])[0]
                        fits = fits[self._holds(sums.of(places[fits], size))]
                        begin = places[fits] + a
                        found.append(np.stack([row[fits] + i, begin, begin + size]))
        return np.concatenate(found, axis=1)
