"""Embedding near-duplicates by lattice hashing.

Equal vectors of a label are one class (found by a 128-bit hash), so copies
never meet each other. Every class is normalised, projected to eight Gaussian
directions in each of several tables, and decoded to the nearest point of the
E8 lattice there. It is stored in the cell of that point and probes the
neighbouring cells it is closest to. Two vectors are candidates where at least
one of them is at home; each candidate's cosine is computed from the whole
vectors in double precision.

No pair leaves a task. The rows of a cell meet in one task (a crowded cell is
cut into blocks, and pairs of blocks are dealt out), which adds up each
vector's links and joins linked vectors to one another by the least of them.
A pair that meets in several cells counts in the first only; both vectors
carry their cells, so every task decides that alike.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.components import components
from vellum.llm.text import python_workers_import, row_struct, written

#: pairs whose cosines are computed at a time
PAIRS_AT_ONCE = 50_000


@dataclass(frozen=True)
class Settings:
    """cosine of a link; lattice tables; neighbouring cells probed in each;
    side of a lattice cell relative to the projected unit vectors; rows of a
    cell compared in one block; seed of the projections.

    A pair with the threshold's cosine meets in one table with a probability
    of about 0.93, so five tables miss about two in a million of them.
    """

    cosine: float = 0.98
    tables: int = 5
    probes: int = 3
    scale: float = 1.4
    block: int = 2048
    seed: int = 8


# --------------------------------------------------------------- lattice ---
def _roots() -> np.ndarray:
    """The 240 shortest vectors of E8, which lead to the neighbouring points."""
    out = []
    for i, j in itertools.combinations(range(8), 2):
        for a, b in itertools.product((1.0, -1.0), repeat=2):
            v = np.zeros(8)
            v[i], v[j] = a, b
            out.append(v)
    out += [np.array(h) for h in itertools.product((0.5, -0.5), repeat=8) if sum(x < 0 for x in h) % 2 == 0]
    return np.array(out)


def _nearest_d8(x: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    near = np.rint(x)
    off = x - near
    odd = np.flatnonzero(near.sum(1) % 2)
    worst = np.abs(off[odd]).argmax(1)
    near[odd, worst] += np.where(off[odd, worst] >= 0, 1.0, -1.0)
    return near


def nearest_e8(x: np.ndarray) -> np.ndarray:
    """The nearest points of E8: integers with an even sum, or those plus 1/2."""
    whole, half = _nearest_d8(x), _nearest_d8(x - 0.5) + 0.5
    closer = ((x - half) ** 2).sum(1) < ((x - whole) ** 2).sum(1)
    return np.where(closer[:, None], half, whole)


def cells_of(unit: np.ndarray, group: np.ndarray, s: Settings) -> np.ndarray:
    """64-bit cell keys (rows × tables × (1 + probes)) of unit vectors: the
    home cell first. ``group`` is a hash of what vectors must share."""
    rng = np.random.default_rng([s.seed, unit.shape[1]])
    roots = _roots()
    mix = np.random.default_rng(s.seed).integers(1, 1 << 63, 9, dtype=np.uint64) | np.uint64(1)
    keys = np.empty((len(unit), s.tables, 1 + s.probes), np.uint64)
    for t in range(s.tables):
        x = unit @ (rng.normal(size=(unit.shape[1], 8)) / s.scale)
        home = nearest_e8(x)
        side = (x - home) @ roots.T
        close = np.argsort(-side, axis=1, kind="stable")[:, :s.probes]
        points = np.concatenate([home[:, None], home[:, None] + roots[close]], axis=1)
        doubled = np.rint(2 * points).astype(np.int64).astype(np.uint64)
        h = (doubled * mix[:8]).sum(2, dtype=np.uint64) + group[:, None] + np.uint64(t) * mix[8]
        h ^= h >> np.uint64(31)
        h *= mix[8]
        keys[:, t] = h ^ (h >> np.uint64(29))
    return keys.view(np.int64)


# ------------------------------------------------------------ candidates ---
_ROWS = "cell long, home boolean, node long, n long, d int, vector binary, cells binary"


def _vectors(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix of floats or doubles) of the rows of each vector length."""
    column = batch.column(batch.schema.get_field_index("vector"))
    lengths = column.value_lengths().to_numpy()
    flat, starts = column.flatten().to_numpy(), np.concatenate([[0], np.cumsum(lengths)])
    for d in np.unique(lengths):
        rows = np.flatnonzero(lengths == d)
        yield rows, flat[starts[rows][:, None] + np.arange(d)]


def _keyed(s: Settings):
    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, 512) for b in batches for at in range(0, len(b), 512)):
            node, n = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("node", "n"))
            group = batch.column(batch.schema.get_field_index("label_hash")).to_numpy().view(np.uint64)
            for rows, v in _vectors(batch):
                if v.dtype == np.float64:  # a power of two keeps the cosine, and no square overflows
                    v = np.ldexp(v, -np.frexp(np.abs(v).max(1, keepdims=True))[1])
                unit = v.astype(np.float64)
                unit /= np.sqrt((unit * unit).sum(1, keepdims=True))
                cells = cells_of(unit, group[rows] + np.uint64(v.shape[1]), s)
                each = s.tables * (1 + s.probes)
                again = np.repeat(rows, each)
                yield pa.RecordBatch.from_pydict({
                    "cell": cells.reshape(-1),
                    "home": np.tile(np.arange(1 + s.probes) == 0, len(rows) * s.tables),
                    "node": node[again], "n": n[again], "d": np.full(len(again), v.shape[1], np.int32),
                    "vector": pa.array([x for r in v for x in [r.tobytes()] * each], pa.binary()),
                    "cells": pa.array([x for r in cells for x in [r.tobytes()] * each], pa.binary())})

    return key


def _first_meeting(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The cell in which each pair counts: of the first table where they meet,
    the home of ``a`` if ``b`` is there, else the home of ``b``."""
    at_a = (b == a[:, :, :1]).any(2)
    at_b = (a == b[:, :, :1]).any(2)
    rows, table = np.arange(len(a)), (at_a | at_b).argmax(1)
    return np.where(at_a[rows, table], a[rows, table, 0], b[rows, table, 0])


def _linked(rows: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, s: Settings) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The links among candidate pairs, and which of them count here."""
    v, norm = rows["vector"], rows["norm"]
    linked = np.einsum("ij,ij->i", v[i], v[j]) / (norm[i] * norm[j]) >= s.cosine
    i, j = i[linked], j[linked]
    first = np.where(rows["node"][i] < rows["node"][j], i, j)
    second = i + j - first
    counts = _first_meeting(rows["cells"][first], rows["cells"][second]) == rows["cell"][i]
    return i, j, counts


def _joined(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least row number of the component of each of ``n`` rows."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        np.minimum.at(new, root[i], low)
        np.minimum.at(new, root[j], low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def _pairs(start: np.ndarray, end: np.ndarray, side: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The pairs of row numbers within each group, some at a time. Groups are
    runs of rows; in a group of two blocks, whose rows follow one another,
    only rows of different blocks pair."""
    size = end - start
    row = np.arange(size.sum())
    a, b = np.repeat(start, size), np.repeat(end, size)
    ahead = np.concatenate([[0], np.cumsum(side == 0)])
    middle = a + ahead[b] - ahead[a]  # where the second block begins
    begin = np.where(side < 0, row + 1, middle)
    n = np.where(side == 1, 0, b - begin)
    upto = np.cumsum(n)
    at = 0
    while at < len(row):
        to = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + PAIRS_AT_ONCE, "right")))
        some = n[at:to]
        i = np.repeat(row[at:to], some)
        within = np.arange(len(i)) - np.repeat(np.cumsum(some) - some, some)
        yield i, np.repeat(begin[at:to], some) + within
        at = to


_FOUND = "node long, root long, links long"


def _compare(s: Settings):
    """Rows sorted by group → per group and linked vector: its links that
    count here and the least node it is joined with here."""
    def groups(table: pa.Table) -> pa.RecordBatch | None:
        get = lambda c: table.column(c).combine_chunks()
        rows = {c: get(c).to_numpy(zero_copy_only=False) for c in ("cell", "home", "node", "n", "side", "first", "second", "d")}
        change = np.flatnonzero((np.diff(rows["cell"]) != 0) | (np.diff(rows["first"]) != 0) | (np.diff(rows["second"]) != 0)
                                | (np.diff(rows["d"]) != 0)) + 1
        start, end = np.concatenate([[0], change]), np.concatenate([change, [len(rows["cell"])]])
        more = end - start > 1
        found: list[tuple[np.ndarray, ...]] = []
        for d in np.unique(rows["d"]):
            these = more & (rows["d"][start] == d)
            if not these.any():
                continue
            keep = np.concatenate([np.arange(a, b) for a, b in zip(start[these], end[these])])
            part = {c: v[keep] for c, v in rows.items()}
            taken = pa.array(keep)
            vectors = b"".join(get("vector").take(taken).to_pylist())
            part["vector"] = np.frombuffer(vectors, f"<f{len(vectors) // (len(keep) * d)}").reshape(len(keep), d).astype(np.float64)
            part["norm"] = np.sqrt(np.einsum("ij,ij->i", part["vector"], part["vector"]))
            part["cells"] = np.frombuffer(b"".join(get("cells").take(taken).to_pylist()), np.int64).reshape(
                len(keep), s.tables, 1 + s.probes)
            size = (end - start)[these]
            last = np.cumsum(size)
            links, ends_i, ends_j = np.zeros(len(keep), np.int64), [], []
            for i, j in _pairs(last - size, last, part["side"]):
                meet = (part["home"][i] | part["home"][j]) & (part["node"][i] != part["node"][j])
                i, j, counts = _linked(part, i[meet], j[meet], s)
                ends_i.append(i)
                ends_j.append(j)
                np.add.at(links, i[counts], part["n"][j[counts]])
                np.add.at(links, j[counts], part["n"][i[counts]])
            i, j = (np.concatenate(e) if e else np.empty(0, np.int64) for e in (ends_i, ends_j))
            root = _joined(len(keep), i, j)
            seen = np.unique(np.concatenate([i, j]))
            found.append((part["node"][seen], part["node"][root[seen]], links[seen]))
        if not found:
            return None
        node, root, links = (np.concatenate(x) for x in zip(*found))
        return pa.RecordBatch.from_pydict({"node": node, "root": root, "links": links})

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in (b.slice(at, 2048) for b in batches for at in range(0, len(b), 2048)):
            # the last group of a batch may go on in the next one
            held.append(batch)
            key = [batch.column(batch.schema.get_field_index(c)) for c in ("cell", "first", "second", "d")]
            last = [k[len(batch) - 1].as_py() for k in key]
            same = np.ones(len(batch), bool)
            for k, value in zip(key, last):
                same &= k.to_numpy(zero_copy_only=False) == value
            begins = int(np.flatnonzero(same)[0])
            if begins == 0:
                continue
            done = pa.Table.from_batches([*held[:-1], batch.slice(0, begins)])
            held = [batch.slice(begins)]
            if (out := groups(done)) is not None:
                yield out
        if held and (out := groups(pa.Table.from_batches(held))) is not None:
            yield out

    return compare


def usable(vector: Column) -> Column:
    """Whether a vector can be compared: not NULL, not zero, every component there and finite."""
    def fine(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    return F.coalesce(F.forall(vector, fine) & F.exists(vector, lambda x: x != 0), F.lit(False))


def near_vectors(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 settings: Settings = Settings()) -> DataFrame:
    """One row per input row: ``row`` (the input row), n_links (other rows
    linked directly), component_id (the least id reachable) and kept.

    Edge cases: a NULL label, and a vector that is NULL, zero or has a NULL or
    non-finite component, link with nothing (component_id is the own id);
    vectors of different lengths don't link; rows that repeat an id count as
    rows of their own; rows without an id link like others, but a component
    of them alone has a NULL component_id and keeps none; an empty table gives
    an empty result.
    """
    s = settings
    spark = rows.sparkSession
    python_workers_import(spark)
    v = F.col(vector_col)
    if rows.schema[vector_col].dataType.elementType.typeName() != "float":
        v = F.transform(v, lambda x: x.cast("double"))
    fits = usable(v) & F.col(label_col).isNotNull()
    key = [F.when(fits, F.xxhash64(F.col(label_col), v)), F.when(fits, F.xxhash64(F.lit(7), F.col(label_col), v))]
    keyed = rows.select(row_struct(rows).alias("row"), F.col(id_col).alias("id"), key[0].alias("k1"), key[1].alias("k2"),
                        F.xxhash64(F.lit(11), F.col(label_col)).alias("label_hash"), v.alias("vector"))
    classes = written(keyed.where("k1 IS NOT NULL").groupBy("k1", "k2", "label_hash")
                      .agg(F.any_value("vector").alias("vector"), F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
                      .withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    cells = written(classes.select("node", "n", "label_hash", "vector").mapInArrow(_keyed(s), _ROWS), "lattice-cells")
    # a crowded cell is cut into blocks; each pair of blocks is a group
    crowded = written(cells.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / s.block).cast("int").alias("blocks"))
                      .where("blocks > 1"), "crowded-cells")
    blocks = F.coalesce(F.col("blocks"), F.lit(1))
    own = F.pmod(F.xxhash64("node"), blocks).cast("int")
    dealt = (cells.join(crowded, "cell", "left").withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
             .select("cell", "home", "node", "n", "vector", "cells", "d",
                     F.least("own", "other").alias("first"), F.greatest("own", "other").alias("second"),
                     # which of two blocks a row is of; -1: the group is one block
                     F.when(F.col("own") == F.col("other"), -1).when(F.col("own") < F.col("other"), 0).otherwise(1).alias("side")))
    group = ["cell", "first", "second"]
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = dealt.repartition(n, *group).sortWithinPartitions(*group, "d", "side")
    found = written(met.mapInArrow(_compare(s), _FOUND), "vector-links")
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).where("a <> b"))
    per = (classes.select("k1", "k2", "n", "least", "node").join(links, "node", "left").join(joined, "node", "left")
           .withColumn("root", F.coalesce("root", "node")))
    least = per.groupBy("root").agg(F.min("least").alias("component"))
    result = written(per.join(least, "root").select("k1", "k2", "component", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("found")),
                     "vector-classes-linked")
    out = keyed.select("row", "id", "k1", "k2").join(result, ["k1", "k2"], "left")
    component = F.when(F.col("k1").isNull(), F.col("id")).otherwise(F.col("component"))
    return out.select("row", F.coalesce("found", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                      F.coalesce(F.col("id") == component, F.lit(False)).alias("kept"))
