"""Constant-time dictionary lookups inside a Spark expression."""

import json
import zlib

from pyspark.sql import functions as F

# Above this many entries a dictionary belongs in a joined table, not in the plan.
MAX_LITERAL_ENTRIES = 50_000

# Above this many rows or bytes a table of terms is not copied to every executor.
MAX_BROADCAST_ROWS = 1_000_000
MAX_BROADCAST_BYTES = 64 << 20


def is_small(terms):
    """Whether a table of terms may be copied to every executor, by its measured rows and bytes.

    Both are summed per task, so measuring a large table is a scan and gathers nothing.
    """
    texts = [F.coalesce(F.octet_length(c), F.lit(0)) for c, kind in terms.dtypes if kind == "string"]
    row_bytes = sum(texts, F.lit(16 * len(terms.columns)))
    rows, size = terms.agg(F.count(F.lit(1)), F.sum(row_bytes)).first()
    return rows <= MAX_BROADCAST_ROWS and (size or 0) <= MAX_BROADCAST_BYTES


def join_method(terms):
    """Join hint for a table of terms, by its measured size: copy it, or else shuffle both sides.

    Without a hint the planner may take the exploded texts for the small side.
    """
    return "broadcast" if is_small(terms) else "merge"


def literal_lookup(mapping, value_type="double"):
    """Return a function Column -> Column that looks a string up in `mapping` (null if missing).

    Spark scans a map literal key by key, so the entries are spread over an array of small maps
    and the array is indexed by the checksum of the key. The array is parsed once, when the
    optimizer folds the constant; it needs no shuffle and works on streams.
    """
    if len(mapping) > MAX_LITERAL_ENTRIES:
        raise ValueError(f"{len(mapping)} entries are too many for a literal; join a table instead")
    if not mapping:
        return lambda key: F.lit(None).cast(value_type)
    # A power of two; most slots stay empty, which ends the lookup of most words early.
    slots = 1 if len(mapping) <= 2 else 2 << len(mapping).bit_length()
    table = [None] * slots
    for key, value in mapping.items():
        place = zlib.crc32(key.encode("utf-8")) % slots
        table[place] = {**(table[place] or {}), key: value}
    literal = F.from_json(F.lit(json.dumps(table)), f"array<map<string,{value_type}>>")

    def lookup(key):
        if slots == 1:
            return F.get(literal, F.lit(0))[key]
        place = F.crc32(key.cast("binary")).bitwiseAND(F.lit(slots - 1))
        return F.get(literal, place.cast("int"))[key]

    return lookup


def bind(value, body):
    """Evaluate `value` once per row and hand it to `body` as a variable."""
    return F.get(F.transform(F.array(value), body), F.lit(0))
