"""Near-duplicate groups by fast similarity sketches, banding and exact checks.

1. One pass over the texts gives each document the size of its shingle set,
   a 128-bit key of the set, a sketch (``fast_similarity``) and its bands.
   The result is written; texts aren't shuffled for it.
2. Equal sets become one class (aggregated map-side, so thousands of copies
   are one row per task before the exchange). From here on only class
   representatives take part.
3. Representatives that share a band are candidates. A bucket is never
   expanded into its pairs: its members are first checked against one leader,
   the member with the fullest buckets, which in a group of edited copies is
   the text that the others were made from. What is known of each bucket is
   written before it meets the members again, so that either side of the join
   has an exchange of its own and a very full bucket's partition can be split.
4. Links are confirmed on the full shingle sets and joined into components.
5. Only members of one bucket that lie in different components are compared
   again, all such pairs, in blocks, so no link is lost to the choice of
   leaders. Pairs within a component can't change the result and are left out.
   So are pairs that can't be links because of the shingles that one of them
   alone holds among all members still in question: in a large group of
   edited copies that leaves few pairs of the far edits.

With the default 20 bands of 4 coordinates a pair of similarity 0.85 shares a
band but for a chance of 4e-7, and one of 0.9 but for 2e-9. A pair is checked
exactly unless fewer than 70 % of the 160 coordinates of the sketches agree (a
chance of 1e-6 at 0.85).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm import fast_similarity as fs
from vellum.llm.components import components
from vellum.llm.text import python_workers_import, written


@dataclass(frozen=True)
class Settings:
    """``percent``: least similarity of a link; ``shingle``: words; ``t``:
    coordinates of a sketch, the first of which make ``n_bands`` bands of
    ``rows``; ``min_agree``: share of agreeing coordinates
    that a pair needs to be checked; ``block``: members of one block when all
    pairs of a bucket are compared."""

    percent: int = 85
    shingle: int = 5
    n_bands: int = 20
    rows: int = 4
    t: int = 160
    min_agree: float = 0.7
    block: int = 512


#: texts, and bytes of texts, whose sketches are made at a time
TEXTS_AT_ONCE, BYTES_AT_ONCE = 500, 1 << 20


def _stretches(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """(from, to) of runs of texts within both bounds; a longer text alone."""
    at, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > at and (held + n > BYTES_AT_ONCE or i - at == TEXTS_AT_ONCE):
            yield at, i
            at, held = i, 0
        held += n
    if at < len(lengths):
        yield at, len(lengths)


def signatures(docs: DataFrame, id_col: str, text_col: str, s: Settings) -> DataFrame:
    """(id, n_shingles, k1, k2, sketch, bands) of each row; no sketch where
    the set is empty."""
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            for at, to in _stretches(pc.binary_length(texts.cast(pa.large_binary())).fill_null(0).to_numpy()):
                sets = [fs.shingle_hashes((x.as_py() or "").encode("utf-8", "surrogatepass"), s.shingle) for x in texts[at:to]]
                full = [i for i, x in enumerate(sets) if len(x)]
                rows = fs.sketches([sets[i] for i in full], s.t)
                bands = fs.bands(rows, s.n_bands, s.rows).view(np.int64)
                short = (rows ^ (rows >> np.uint64(16))).astype(np.uint16).view(np.int16)
                k1 = [int(np.bitwise_xor.reduce(fs.mix(x ^ fs.seed(101)))) if len(x) else 0 for x in sets]
                k2 = [int(np.add.reduce(fs.mix(x ^ fs.seed(202)))) if len(x) else 0 for x in sets]
                at_row = {i: k for k, i in enumerate(full)}
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(sets)),
                    pa.array([len(x) for x in sets], pa.int64()),
                    pa.array(np.array(k1, np.uint64).view(np.int64)),
                    pa.array(np.array(k2, np.uint64).view(np.int64)),
                    pa.array([short[at_row[i]] if i in at_row else None for i in range(len(sets))], pa.list_(pa.int16())),
                    pa.array([bands[at_row[i]] if i in at_row else None for i in range(len(sets))], pa.list_(pa.int64())),
                ], names=["id", "n_shingles", "k1", "k2", "sketch", "bands"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(
        sign, "id long, n_shingles long, k1 long, k2 long, sketch array<smallint>, bands array<long>")


def agreeing(a: Column, b: Column) -> Column:
    """The number of coordinates in which two sketches agree."""
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda e: e))


def promising(s: Settings, n_a: str, n_b: str, most: Column, a: str, b: str) -> Column:
    """Pairs that may be links: an intersection of ``most`` shingles would do,
    and enough coordinates agree."""
    size = F.col(n_a) + F.col(n_b)
    return (100 * most >= s.percent * (size - most)) & (agreeing(F.col(a), F.col(b)) >= int(s.min_agree * s.t))


def confirmed(pairs: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple = (None, None)  # the join leaves the rows of one b side by side
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            good = []
            for i in range(len(a)):
                raw = batch.column(3)[i].as_py()
                if last[0] != raw:
                    last = (raw, fs.shingle_hashes(raw, s.shingle))
                x, y = fs.shingle_hashes(batch.column(2)[i].as_py(), s.shingle), last[1]
                both = fs.common(x, y)
                if both and 100 * both >= s.percent * (len(x) + len(y) - both):
                    good.append(i)
            yield pa.RecordBatch.from_arrays([pa.array([a[i] for i in good], pa.int64()),
                                              pa.array([b[i] for i in good], pa.int64())], names=["a", "b"])

    of_a = texts.select(F.col("id").alias("a"), F.col("raw").alias("raw_a"))
    of_b = texts.select(F.col("id").alias("b"), F.col("raw").alias("raw_b"))
    joined = pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "raw_a", "raw_b")
    return joined.mapInArrow(check, "a long, b long")


def _with_sketches(pairs: DataFrame, reps: DataFrame, s: Settings) -> DataFrame:
    """The promising ones of the pairs (a, b)."""
    side = lambda x: reps.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                 F.col("sketch").alias(f"sketch_{x}"))
    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .where(promising(s, "n_a", "n_b", F.least("n_a", "n_b"), "sketch_a", "sketch_b")).select("a", "b"))


def _star(members: DataFrame) -> DataFrame:
    """(a, b): each member of a bucket with the bucket's leader, the member
    with the fullest buckets."""
    leaders = (members.groupBy("h").agg(F.max(F.struct("fullness", F.col("id").alias("b"))).alias("top"))
               .select("h", F.col("top.b").alias("b")))
    return members.join(written(leaders, "leaders"), "h").where("id <> b").select(F.col("id").alias("a"), "b").distinct()


def _held_alone(texts: DataFrame, s: Settings) -> DataFrame:
    """(id, n_alone): the number of shingles that no other text holds."""
    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, raw in zip(batch.column(0).to_pylist(), batch.column(1)):
                values = fs.shingle_hashes(raw.as_py() or b"", s.shingle).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), i)), pa.array(values)], names=["id", "shingle"])

    return (texts.mapInArrow(explode, "id long, shingle long").groupBy("shingle")
            .agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("id")).where("n = 1")
            .groupBy("id").agg(F.count(F.lit(1)).alias("n_alone")))


def _left_over(members: DataFrame, reps: DataFrame, texts: DataFrame, s: Settings) -> DataFrame:
    """(a, b): all promising pairs of members of one bucket that lie in
    different components, compared block by block."""
    asked = texts.join(members.select("id").distinct(), "id", "left_semi")
    shared = F.col("n_shingles") - F.coalesce("n_alone", F.lit(0))
    known = (reps.select("id", "n_shingles", "sketch", "bands").join(_held_alone(asked, s), "id", "left")
             .select("id", "n_shingles", "sketch", "bands", shared.alias("most")))
    # a text can't be linked with any if too few of its shingles are held elsewhere
    able = members.join(known.where(100 * F.col("most") >= s.percent * F.col("n_shingles")), "id")
    able = written(_mixed(able), "in-question")
    sizes = able.groupBy("h").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("n_blocks"))
    full = (able.join(written(sizes, "sizes"), "h")
            .withColumn("own", F.pmod(F.xxhash64("id"), F.col("n_blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("n_blocks") - 1))))
    side = lambda x, i, j: full.select(
        "h", F.col("own").alias(i), F.col("other").alias(j), F.col("id").alias(x), F.col("comp").alias(f"comp_{x}"),
        F.col("n_shingles").alias(f"n_{x}"), F.col("most").alias(f"most_{x}"), F.col("sketch").alias(f"sketch_{x}"), F.col("bands").alias(f"bands_{x}"))
    left, right = side("a", "i", "j"), side("b", "j", "i")
    on = [left[c] == right[c] for c in ("h", "i", "j")]
    most = F.least("most_a", "most_b")
    first = left["h"] == F.array_min(F.array_intersect("bands_a", "bands_b"))  # a pair in one of its buckets only
    return left.join(right, [*on, left["a"] < right["b"], left["comp_a"] != right["comp_b"],
                             promising(s, "n_a", "n_b", most, "sketch_a", "sketch_b"), first]).select("a", "b")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               settings: Settings = Settings()) -> DataFrame:
    """One row per input row: id, n_shingles, component_id (the least id of
    its group, itself included), kept (the id is the component's).

    Edge cases: a NULL or wordless text has no shingle and is its own group;
    a text of fewer words than a shingle is one shingle; rows that repeat an
    id are one document (if their texts differ, that id links the texts); a
    row without an id is kept unless a document with an id has its set; an
    empty table gives an empty result.
    """
    python_workers_import(docs.sparkSession)
    s = settings
    sig = written(signatures(docs, id_col, text_col, s), "signatures")
    reps = written(sig.where("n_shingles > 0 AND id IS NOT NULL").groupBy("k1", "k2", "n_shingles")
                   .agg(F.min("id").alias("id"), F.any_value("sketch").alias("sketch"), F.any_value("bands").alias("bands")),
                   "classes")
    buckets = reps.select("id", F.explode("bands").alias("h"))
    shared = buckets.groupBy("h").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    members = written(buckets.join(written(shared, "sizes"), "h"), "buckets")
    fullness = written(members.groupBy("id").agg(F.sum("size").alias("fullness")), "fullness")
    texts = written(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("binary").alias("raw"))
                    .join(fullness.select("id"), "id", "left_semi"), "candidates")
    stars = _star(members.join(fullness, "id"))
    links = written(confirmed(_with_sketches(stars, reps, s), texts, s), "links")
    groups = components(links)
    now = (members.select("h", "id").join(groups, members["id"] == groups["node"], "left")
           .select("h", "id", F.coalesce("root", "id").alias("comp")))
    apart = written(_mixed(now), "apart")
    if not apart.isEmpty():
        more = confirmed(_left_over(apart, reps, texts, s), texts, s)
        # links between components: of their roots, added to the stars there are
        groups = components(groups.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    classes = (reps.select("k1", "k2", "n_shingles", F.col("id").alias("rep"))
               .join(groups.select(F.col("node").alias("rep"), "root"), "rep", "left")
               .select("k1", "k2", F.col("n_shingles").alias("n"), F.coalesce("root", "rep").alias("component")))
    same = [sig["k1"] == classes["k1"], sig["k2"] == classes["k2"], sig["n_shingles"] == classes["n"]]
    component = F.coalesce(F.col("component"), F.col("id"))
    return (sig.join(classes, same, "left")
            .select("id", "n_shingles", component.alias("component_id"),
                    F.coalesce(F.col("id") == component, component.isNull()).alias("kept")))


def _mixed(members: DataFrame) -> DataFrame:
    """The members of buckets that hold more than one component."""
    mixed = members.groupBy("h").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    return members.join(written(mixed.select("h"), "mixed"), "h", "left_semi")
