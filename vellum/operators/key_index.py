"""Stored key index: which keys of a load does the history hold (Q2–Q4)?

An accepted load adds one segment: its distinct keys with their row counts, dealt
by hash into key files and sorted, and a Bloom filter over them, as rows of 256
bits. A lookup of new keys goes

1. past every segment whose key range the new keys don't meet (from the log),
2. through the filters of the others: each key meets one filter row a segment,
3. into those key files alone that hold a key which a filter lets through.

So unseen keys read no history but filters (about 2 bytes a key), and answers are
exact: a filter only ever says "no" or "perhaps". All of it is joins and
aggregates; the driver sees one row a segment and the names of key files.
"""

from __future__ import annotations

import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.sources.tables import materialized

#: keys in a key file, keys for one filter row of 256 bits
PER_FILE, PER_ROW = 1_000_000, 16
_WORDS = range(4)


@dataclass(frozen=True)
class Segment:
    """One load's keys: its folder, files, filter rows, and key range (None: not known)."""
    name: str
    keys: int
    files: int
    rows: int
    low: object
    high: object
    nulls: bool


def key_counts(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column (NULL is one) with their rows: _key, _n."""
    return df.groupBy(F.col(column).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))


def _place(modulus: Column, salt: int) -> Column:
    return F.pmod(F.xxhash64("_key", F.lit(salt)), modulus)


def _mask(word: int) -> Column:
    """The two bits that a key sets in one of the words of its filter row."""
    bit = [f"shiftleft(1L, cast(shiftright(xxhash64(_key, 3), {12 * word + 6 * i}) & 63 AS int))" for i in (0, 1)]
    return F.expr(f"{bit[0]} | {bit[1]}")


def _plain(value):
    """A key as the log can hold it in order, else None."""
    return value if isinstance(value, (int, str)) and not isinstance(value, bool) else None


class KeyIndex:
    """The keys of one column of one entity, in segments under ``base``.

    The caller keeps the list of segments (a commit names them); files of a
    segment that no commit names are never read. Keys are of one type; a key
    that fills a load is one row in its segment.
    """

    def __init__(self, spark: SparkSession, base: str, segments: list[Segment] = ()):
        self.spark, self.base, self.segments = spark, base.rstrip("/"), list(segments)

    # -------------------------------------------------------------- writing
    def add(self, counts: DataFrame) -> Segment | None:
        """A new segment with these keys (_key, _n; each key once), None if there are none."""
        counts = materialized(counts.select("_key", "_n"), name="segment-keys")
        s = counts.agg(F.count(F.lit(1)).alias("keys"), F.min("_key").alias("low"), F.max("_key").alias("high"),
                       F.count_if(F.col("_key").isNull()).alias("nulls")).first()
        if not s["keys"]:
            return None
        n_files, n_rows = -(-s["keys"] // PER_FILE), -(-s["keys"] // PER_ROW)
        name = uuid.uuid4().hex[:12]
        (counts.withColumn("file", _place(F.lit(n_files), 1)).repartition(n_files, "file").sortWithinPartitions("file", "_key")
         .write.partitionBy("file").parquet(f"{self.base}/{name}/keys"))
        words = [F.bit_or(_mask(w)).alias(f"w{w}") for w in _WORDS]
        counts.groupBy(_place(F.lit(n_rows), 2).alias("row")).agg(*words).write.parquet(f"{self.base}/{name}/filter")
        return Segment(name, s["keys"], n_files, n_rows, _plain(s["low"]), _plain(s["high"]), bool(s["nulls"]))

    # -------------------------------------------------------------- reading
    def meeting(self, counts: DataFrame) -> list[Segment]:
        """The segments whose key range the keys meet."""
        s = counts.agg(F.min("_key").alias("low"), F.max("_key").alias("high"),
                       F.count_if(F.col("_key").isNull()).alias("nulls")).first()

        def meets(seg: Segment) -> bool:
            if seg.nulls and s["nulls"]:
                return True
            if s["low"] is None:
                return False
            if seg.low is None or _plain(s["low"]) is None:
                return seg.keys > seg.nulls  # no order in the log
            return seg.low <= s["high"] and s["low"] <= seg.high

        return [seg for seg in self.segments if meets(seg)]

    def _perhaps(self, counts: DataFrame, segments: list[Segment]) -> DataFrame:
        """Keys that a segment's filter lets through, with the key file to look in."""
        places = F.explode(F.array(*[F.struct(F.lit(s.name).alias("name"), F.lit(s.files).cast("long").alias("files"),
                                              F.lit(s.rows).cast("long").alias("rows")) for s in segments]))
        asked = (counts.select("_key", places.alias("s"))
                 .select("_key", F.col("s.name").alias("name"), _place(F.col("s.files"), 1).alias("file"),
                         _place(F.col("s.rows"), 2).alias("row"), *[_mask(w).alias(f"m{w}") for w in _WORDS]))
        filters = reduce(DataFrame.unionByName, [self.spark.read.parquet(f"{self.base}/{s.name}/filter")
                                                 .withColumn("name", F.lit(s.name)) for s in segments])
        hit = F.lit(True)
        for w in _WORDS:
            hit = hit & (F.col(f"w{w}").bitwiseAND(F.col(f"m{w}")) == F.col(f"m{w}"))
        return asked.join(filters, ["name", "row"]).where(hit).select("_key", "name", "file")

    def held(self, counts: DataFrame) -> tuple[DataFrame, list[str]]:
        """The keys of ``counts`` that the history holds with their rows there
        (_key, _held), and the key files read for the answer."""
        segments = self.meeting(counts)
        none = counts.select("_key", F.lit(0).cast("long").alias("_held")).where(F.lit(False))
        if not segments:
            return none, []
        perhaps = materialized(self._perhaps(counts, segments), name="perhaps-held")
        read = sorted(f"{r['name']}/keys/file={r['file']}" for r in perhaps.select("name", "file").distinct().collect())
        if not read:
            return none, []
        rows = self.spark.read.parquet(*[f"{self.base}/{name}" for name in read])
        asked = perhaps.select(F.col("_key").alias("_asked")).distinct()
        return (rows.join(asked, rows["_key"].eqNullSafe(asked["_asked"]), "left_semi")
                .groupBy("_key").agg(F.sum("_n").alias("_held"))), read

    def compacted(self) -> Segment | None:
        """All segments as one: a lookup then meets one filter row a key."""
        if not self.segments:
            return None
        rows = [self.spark.read.parquet(f"{self.base}/{s.name}/keys").select("_key", "_n") for s in self.segments]
        return self.add(reduce(DataFrame.unionByName, rows).groupBy("_key").agg(F.sum("_n").alias("_n")))


def as_json(segments: list[Segment]) -> list[dict]:
    return [asdict(s) for s in segments]


def from_json(rows: list[dict]) -> list[Segment]:
    return [Segment(**r) for r in rows]
