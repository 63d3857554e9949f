"""The keys that were seen, as tables of geometric sizes."""

from typing import NamedTuple

from pyspark.sql import functions as F

from chatterscope.functions.lookup import is_small
from chatterscope.session import scratch_path

LEVEL = "path string, rows long, bits long, newest double"


class Level(NamedTuple):
    """A table of keys at `path`, its rows, the bits of its filter (a power of two), the time of its newest key."""

    path: str
    rows: int
    bits: int
    newest: float


# Bits of a filter for each key; with one bit set by a key, one in so many keys passes by chance.
_BITS = 32


class SeenKeys:
    """Keys with the time at which they were seen last, in the shared folder; a value that is never changed.

    New keys become a level. While a level is less than twice as large as the next one, both are merged, so there are as many
    levels as the logarithm of the number of keys, and each key is written as often. All levels are read as one table:
    plans do not get deeper with time. A level has a filter, a bitmap of hashes, that tells for most new
    keys that they are not in it; levels that no key may be in are not read. Keys that were last seen more than `expiry` seconds ago
    are forgotten when their level is merged, and with a whole level.

    `levels` is all there is to remember, see `LEVEL`; `stale` lists folders that this value does not need any more.
    """

    def __init__(self, spark, key="live_key", expiry=None, levels=()):
        self.spark, self.key, self.expiry = spark, key, expiry
        self.levels, self.stale = [Level(*level) for level in levels], []

    def _with(self, levels, stale):
        other = SeenKeys(self.spark, self.key, self.expiry, levels)
        other.stale = stale
        return other

    def _read(self, levels, part):
        return self.spark.read.schema(self._schema(part)).parquet(*[f"{level.path}/{part}" for level in levels])

    def _schema(self, part):
        return f"{self.key} string, at double" if part == "keys" else "name string, bucket long, bitmap binary"

    def keys(self):
        """key, at: all keys, those that may be forgotten included."""
        if not self.levels:
            return self.spark.createDataFrame([], self._schema("keys"))
        return self._read(self.levels, "keys").groupBy(self.key).agg(F.max("at").alias("at"))

    def _may_have(self, keys):
        """The keys that may be in a level, each with the place of that level."""
        levels = F.array(*[
            F.struct(F.lit(i).alias("place"), F.lit(level.path).alias("name"), F.lit(level.bits - 1).alias("mask"))
            for i, level in enumerate(self.levels)
        ])
        asked = keys.select(self.key, F.explode(levels).alias("level")).select(self.key, "level.*")
        bit = F.xxhash64(self.key).bitwiseAND(F.col("mask"))
        asked = asked.withColumns({"bucket": F.bitmap_bucket_number(bit), "at_bit": F.bitmap_bit_position(bit)})
        byte = F.conv(F.hex(F.substring("bitmap", (F.col("at_bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        is_set = byte.bitwiseAND(F.pow(F.lit(2), F.col("at_bit") % 8).cast("int")) != 0
        found = asked.join(self._read(self.levels, "filter"), ["name", "bucket"]).where(is_set)
        return found.select(self.key, "place")

    def unseen(self, df, now=None):
        """The rows of df whose key was not seen; a null key never was."""
        alive = [x for x in self.levels if now is None or self.expiry is None or x.newest >= now - self.expiry]
        if not alive:
            return df
        mine = self._with(alive, [])
        keys = df.select(self.key).where(F.col(self.key).isNotNull()).distinct()
        few = is_small(keys)
        maybe = mine._may_have(keys)
        if few:
            # The new keys are small by measure, so the filters and levels are scanned, not shuffled.
            places = sorted(r[0] for r in maybe.select("place").distinct().collect())
            if not places:
                return df
            old = mine._read([alive[i] for i in places], "keys")
            maybe = F.broadcast(maybe.select(self.key).distinct())
        else:
            old, maybe = mine._read(alive, "keys"), maybe.select(self.key).distinct()
        if now is not None and self.expiry is not None:
            old = old.where(F.col("at") >= now - self.expiry)
        hits = old.join(maybe, self.key, "left_semi").select(self.key)
        # Some of the keys, each once: no larger than what was measured.
        return df.join(F.broadcast(hits.distinct()) if few else hits, self.key, "left_anti")

    def _write(self, keys):
        """A level of key, at; None without keys."""
        path = scratch_path(self.spark, "seen")
        keys.write.parquet(f"{path}/keys")
        stored = self.spark.read.schema(self._schema("keys")).parquet(f"{path}/keys")
        rows, newest = stored.agg(F.count(F.lit(1)), F.max("at")).first()
        if not rows:
            return None
        bits = 1 << max(15, (rows * _BITS).bit_length())
        hashed = stored.select(F.xxhash64(self.key).bitwiseAND(F.lit(bits - 1)).alias("bit"))
        hashed.groupBy(F.bitmap_bucket_number("bit").alias("bucket")).agg(
            F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bitmap")
        ).select(F.lit(path).alias("name"), "bucket", "bitmap").write.parquet(f"{path}/filter")
        return Level(path, rows, bits, newest)

    def added(self, df, now):
        """SeenKeys with the keys of df, which were seen at `now` (epoch seconds)."""
        fresh = df.select(F.col(self.key).cast("string").alias(self.key)).where(F.col(self.key).isNotNull()).distinct()
        levels, stale = list(self.levels), []
        if self.expiry is not None:
            stale = [x.path for x in levels if x.newest < now - self.expiry]
            levels = [x for x in levels if x.newest >= now - self.expiry]
        new = self._write(fresh.withColumn("at", F.lit(float(now))))
        if new is None:
            return self._with(levels, stale)
        merged, rows = [], new.rows
        while levels and levels[-1].rows < 2 * rows:
            merged.append(levels.pop())
            rows += merged[-1].rows
        if merged:
            both = self._with([*merged, new], []).keys()
            if self.expiry is not None:
                both = both.where(F.col("at") >= now - self.expiry)
            stale += [x.path for x in [*merged, new]]
            new = self._write(both)
        return self._with(levels if new is None else [*levels, new], stale)

    def clear(self, paths):
        """Empties folders of levels that no value needs any more."""
        for path in paths:
            for part in ("keys", "filter"):
                self.spark.createDataFrame([], self._schema(part)).write.mode("overwrite").parquet(f"{path}/{part}")
