"""Hashes of words and word windows of many texts at once, on the UTF-8 bytes of an Arrow column."""

import numpy as np
import pyarrow as pa

CHUNK = 1 << 20

# 64-bit mixing constants; any odd numbers would do.
ROOT = np.uint64(0x9E3779B97F4A7C15)
STEP = np.uint64(0x2545F4914F6CDD1D | 3)
TABLE = (np.arange(1, 257, dtype=np.uint64) * ROOT) ^ (np.arange(1, 257, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(21))
BACK = np.uint64(pow(int(STEP), -1, 1 << 64))


def mixed(h):
    """Finalizer: every bit of the result depends on every bit of h."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


TABLE = mixed(TABLE)
# A-Z hash like a-z.
LOWERED = TABLE.copy()
LOWERED[65:91] = TABLE[97:123]


def byte_mask(*ranges):
    mask = np.zeros(256, bool)
    for a, b in ranges:
        mask[a : b + 1] = True
    return mask


def text_bytes(column):
    """(offsets, bytes) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    n = len(column)
    if not n:
        return np.zeros(1, np.int64), np.zeros(0, np.uint8)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = column.buffers()[2]
    return offsets, np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)


def sliced(batches, limit=6 << 20, column="text"):
    """The batches, cut (without copying) into pieces of about `limit` bytes of text, so that memory stays bounded."""
    for batch in batches:
        offsets, _ = text_bytes(batch.column(column))
        at = 0
        while at < batch.num_rows:
            end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
            end = min(end, batch.num_rows)
            yield batch.slice(at, end - at)
            at = end


def gathered(batches, limit, column="text"):
    """Pieces of about `limit` bytes of text, put together from small batches and cut from large ones."""
    held, size = [], 0
    for batch in sliced(batches, limit, column):
        held.append(batch)
        size += batch.nbytes
        if size >= limit:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def _powers(n):
    up, down = np.full(n, STEP), np.full(n, BACK)
    up[0] = down[0] = 1
    return np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)


UP, DOWN = _powers(CHUNK + 1)


def chunk_words(raw, breaks, separators, table=LOWERED):
    """(hashes, starts) of the words of some bytes. `breaks`: places where a word ends in any case."""
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    word = ~separators[raw]
    first = word.copy()
    first[1:] &= ~word[:-1]
    first[breaks[(breaks > 0) & (breaks < len(raw))]] |= word[breaks[(breaks > 0) & (breaks < len(raw))]]
    starts = np.nonzero(first)[0]
    up, down = (UP, DOWN) if len(raw) < len(UP) else _powers(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(np.where(word, table[raw], np.uint64(0)) * up[: len(raw)], out=total[1:])
    ends = np.append(starts[1:], len(raw))  # separators add nothing to the sum
    return mixed((total[ends] - total[starts]) * down[starts]), starts


def word_hashes(offsets, data, separators, table=LOWERED):
    """Yields (index of text, hashes of its words in order), piece by piece of about CHUNK bytes.

    A longer text is cut at separators, so that memory stays bounded by the text's own hashes.
    """
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, "right")) - 1)
        j = min(j, n)
        begin, end = int(offsets[i]), int(offsets[j])
        if end - begin <= CHUNK:
            hashes, starts = chunk_words(data[begin:end], np.asarray(offsets[i:j]) - begin, separators, table)
            cuts = np.searchsorted(starts, np.asarray(offsets[i : j + 1]) - begin)
            for k in range(i, j):
                yield k, hashes[cuts[k - i] : cuts[k - i + 1]]
        else:
            parts, at = [], begin
            while at < end:
                stop = min(at + CHUNK, end)
                if stop < end:
                    gaps = np.nonzero(separators[data[at:stop]])[0]
                    while not len(gaps) and stop < end:  # one word of more than a chunk
                        more = min(stop + CHUNK, end)
                        gaps = np.nonzero(separators[data[stop:more]])[0] + (stop - at)
                        stop = more
                    stop = at + int(gaps[-1]) + 1 if len(gaps) and stop < end else stop
                parts.append(chunk_words(data[at:stop], np.zeros(0, np.int64), separators, table)[0])
                at = stop
            yield i, np.concatenate(parts)
        i = j


def windows(hashes, size):
    """Hash of each run of `size` words; fewer words, but not none, are one run."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    h = np.full(n - width + 1, np.uint64(width * int(ROOT) % 2**64))
    for k in range(width):
        h = mixed(h + hashes[k : n - width + 1 + k])
    return h
