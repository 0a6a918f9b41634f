"""Hard negatives from an STR-packed R-tree.

Packing: the rows are sorted by label and first coordinate over range
partitions; each run of rows of one label becomes a page, tiled sort-tile-
recursively (the widest coordinate is sorted and cut into strips, each strip
by its own widest one) into leaves. A page and each of its leaves keep their
minimum bounding box and least id. Pages are rows of a written table, so the
index is built and read by all executors.

Search: the anchors, a stated set, meet all pages in blocks. For an anchor, a
box gives an interval of each coordinate's share of the inner product, hence
bounds on the scores in it. A queue takes the page with the highest bound
first; pages and leaves whose interval misses the score window, or whose bound
is strictly below the k-th score found (or equals it with larger ids only),
are pruned. Each block returns its first k rows a window; the first k of all
blocks are exact. The first search finds the positives among the rows of the
anchor's label, the second the negatives among the others, in windows that
the positives' scores span.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.text import python_workers_import, written

_PAGES = ("label long, d int, page long, n int, width int, ids binary, vectors binary, starts binary, "
          "low binary, high binary, least binary")
#: a score window that holds every score
_ALL = (-(1 << 63), (1 << 63) - 1)


@dataclass(frozen=True)
class Settings:
    """rows of a page and of a leaf; pages and anchors that meet in one task;
    positives of an anchor, negatives of a pair, and the window of a
    negative's score in percent of the positive's."""

    page: int = 2048
    leaf: int = 32
    pages_at_once: int = 32
    anchors_at_once: int = 2048
    positives: int = 5
    negatives: int = 10
    low_percent: int = 30
    high_percent: int = 90


# --------------------------------------------------------------- packing ---
def tiles(v: np.ndarray, size: int) -> list[np.ndarray]:
    """Sort-tile-recursive: row numbers of each leaf."""
    done, todo = [], [np.arange(len(v))]
    while todo:
        rows = todo.pop()
        if len(rows) <= size:
            done.append(rows)
            continue
        widest = int(np.argmax(v[rows].max(0) - v[rows].min(0)))
        rows = rows[np.argsort(v[rows, widest], kind="stable")]
        # strips of whole leaves, about as many as leaves go on each side
        leaves = -(-len(rows) // size)
        strips = max(2, round(leaves ** 0.5))
        todo += np.split(rows, np.arange(1, strips) * (-(-leaves // strips) * size))
    return [rows for rows in done if len(rows)]


def _pack(s: Settings):
    def page(label: int, number: int, ids: np.ndarray, v: np.ndarray) -> dict:
        leaves = tiles(v, s.leaf)
        order = np.concatenate(leaves)
        starts = np.cumsum([0] + [len(x) for x in leaves[:-1]])
        ids, v = ids[order], v[order]
        small = np.abs(v).max(initial=0) < 1 << 31 and v.min(initial=0) > -(1 << 31)
        box = lambda f: f.reduceat(v, starts, axis=0).astype("<i8").tobytes()
        return {"label": label, "d": v.shape[1], "page": number, "n": len(ids), "width": 4 if small else 8,
                "ids": ids.astype("<i8").tobytes(), "vectors": v.astype("<i4" if small else "<i8").tobytes(),
                "starts": starts.astype("<i8").tobytes(), "low": box(np.minimum), "high": box(np.maximum),
                "least": np.minimum.reduceat(ids, starts).astype("<i8").tobytes()}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        number, held, key = TaskContext.get().partitionId() << 32, [], None

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal number, held
            if held:
                ids, v = np.concatenate([x for x, _ in held]), np.concatenate([x for _, x in held])
                yield pa.RecordBatch.from_pylist([page(key[0], number, ids, v)], schema=kinds)
                number, held = number + 1, []

        kinds = _arrow(_PAGES)
        for batch in batches:
            label, d, ids = (batch.column(i).to_numpy() for i in range(3))
            flat = batch.column(3).flatten().to_numpy()
            at, starts = 0, np.concatenate([[0], np.cumsum(d, dtype=np.int64)])
            while at < len(batch):
                if key != (label[at], d[at]):
                    yield from done()
                    key = (label[at], d[at])
                room = s.page - sum(len(x) for x, _ in held)
                other = np.flatnonzero((label[at:at + room] != key[0]) | (d[at:at + room] != key[1]))
                to = at + (int(other[0]) if len(other) else min(room, len(batch) - at))
                held.append((ids[at:to], flat[starts[at]:starts[to]].reshape(to - at, key[1])))
                at = to
                if to - at + sum(len(x) for x, _ in held) >= s.page:
                    yield from done()
        yield from done()

    return pack


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    return pa.schema([(c.split()[0], kinds[c.split()[1]]) for c in ddl.split(", ")])


def pack_pages(rows: DataFrame, s: Settings) -> DataFrame:
    """The written tree over ``rows`` (label, d, id, vector of longs)."""
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["label", "d", "x", "id"]  # the id parts rows of one vector
    dealt = (rows.withColumn("x", F.get("vector", F.lit(0))).repartitionByRange(n, *order).sortWithinPartitions(*order)
             .select("label", "d", "id", "vector"))
    return written(dealt.mapInArrow(_pack(s), _PAGES), "rtree-pages")


# ---------------------------------------------------------------- search ---
class Pages:
    """The pages of one task, as arrays that score exactly: doubles where
    every sum stays below 2**53, Python integers elsewhere."""

    def __init__(self, table: pa.Table, limit: int):
        self.pages = []
        for p in table.to_pylist():
            v = np.frombuffer(p["vectors"], f"<i{p['width']}").reshape(p["n"], p["d"])
            get = lambda c: np.frombuffer(p[c], "<i8")
            low, high = get("low").reshape(-1, p["d"]), get("high").reshape(-1, p["d"])
            most = int(max(np.abs(low.astype(object)).max(initial=0), np.abs(high.astype(object)).max(initial=0)))
            kind = np.float64 if most * limit * max(1, p["d"]) < 1 << 53 else object
            self.pages.append({"label": p["label"], "d": p["d"], "ids": get("ids"), "v": v.astype(kind), "kind": kind,
                               "leaf": np.repeat(np.arange(len(low)), np.diff(np.append(get("starts"), p["n"]))),
                               "low": low.astype(kind), "high": high.astype(kind), "least": get("least")})

    @staticmethod
    def bounds(page: dict, anchor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The least and greatest inner products that the leaves' boxes allow."""
        up, down = np.maximum(anchor, 0), np.minimum(anchor, 0)
        return page["low"] @ up + page["high"] @ down, page["high"] @ up + page["low"] @ down

    def first(self, anchor: np.ndarray, own_id: int, fits, windows: list[tuple[int, int]], k: int) -> list[list[tuple[int, int]]]:
        """Per window, the first k (-score, id) of the pages that ``fits``."""
        found: list[list[tuple[int, int]]] = [[] for _ in windows]
        queue = []
        for number, page in enumerate(self.pages):
            if page["d"] == len(anchor) and fits(page["label"]):
                a = anchor.astype(page["kind"])
                low, high = self.bounds(page, a)
                heapq.heappush(queue, (-int(high.max()), number, a, low, high))
        while queue:
            _, number, a, low, high = heapq.heappop(queue)
            page = self.pages[number]
            wanted = []
            for (least, most), best in zip(windows, found):
                top = np.minimum(high, most)
                want = (high >= least) & (low <= most)
                if len(best) == k:
                    kth, last_id = -best[-1][0], best[-1][1]
                    want &= (top > kth) | ((top == kth) & (page["least"] < last_id))
                wanted.append(want)
            some = np.logical_or.reduce(wanted)[page["leaf"]]
            if not some.any():
                continue
            score, ids = page["v"][some] @ a, page["ids"][some]
            for w, (least, most) in enumerate(windows):
                if not wanted[w].any():
                    continue
                fit = (score >= least) & (score <= most) & (ids != own_id)
                if len(found[w]) == k:
                    fit &= score >= -found[w][-1][0]
                score_w, ids_w = score[fit], ids[fit]
                order = np.lexsort((ids_w, -score_w))[:k]
                more = [(-int(score_w[i]), int(ids_w[i])) for i in order]
                found[w] = sorted(found[w] + more)[:k]
        return found


_FOUND = "anchor_id long, positive_id long, positive_score long, id long, score long"


def _searcher(same_label: bool, k: int):
    kinds = _arrow(_FOUND)

    def search(pages: pa.Table, anchors: pa.Table) -> pa.Table:
        columns: list[list] = [[] for _ in kinds]
        if len(pages) and len(anchors):
            rows = anchors.select(["label", "id", "vector", "wanted"]).to_pylist()
            limit = max((abs(x) for r in rows for x in r["vector"]), default=0)
            block = Pages(pages, max(1, limit))
            for r in rows:
                windows = list(dict.fromkeys((w["low"], w["high"]) for w in r["wanted"]))
                found = dict(zip(windows, block.first(np.array(r["vector"], np.int64), r["id"],
                                                      (lambda label: (label == r["label"]) == same_label), windows, k)))
                for w in r["wanted"]:
                    for minus, i in found[w["low"], w["high"]]:
                        for c, x in zip(columns, (r["id"], w["id"], w["score"], i, -minus)):
                            c.append(x)
        return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds.types)], schema=kinds)

    return search


def _dealt(df: DataFrame, keys: list[str], uid: str, at_once: int, name: str) -> DataFrame:
    """Number parts of about ``at_once`` rows within each key."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    parts = F.ceil(F.col("_n") / at_once).cast("int")
    return df.join(n, keys).withColumn(name, F.pmod(F.xxhash64(uid), parts).cast("int")).drop("_n")


def _search(pages: DataFrame, anchors: DataFrame, same_label: bool, k: int, s: Settings) -> DataFrame:
    """The first k rows of every wanted window of every anchor: anchor_id,
    positive_id, positive_score (the window's), id, score, n (from 1)."""
    keys = ["label", "d"] if same_label else ["d"]
    blocks = _dealt(pages, keys, "page", s.pages_at_once, "block")
    chunks = _dealt(anchors, keys, "id", s.anchors_at_once, "chunk")
    # each block of pages meets each chunk of anchors of its label (or of any)
    left = blocks.join(chunks.select(*keys, "chunk").distinct(), keys)
    right = chunks.join(blocks.select(*keys, "block").distinct(), keys)
    group = [*keys, "block", "chunk"]
    # both sides hold columns of both inputs: new names tell them apart
    left, right = left.toDF(*left.columns), right.toDF(*right.columns)
    found = left.groupBy(*group).cogroup(right.groupBy(*group)).applyInArrow(_searcher(same_label, k), _FOUND)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.col("score").desc(), "id")
    return found.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k)


def hard_negatives(rows: DataFrame, is_anchor: Column, id_col: str = "vec_id", vector_col: str = "vector",
                   label_col: str = "label", settings: Settings = Settings()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score. The vectors hold integers (longs); ``is_anchor`` marks the
    query rows. A score is the inner product; ties go to the smaller id.

    Edge cases: a row takes no part if its id, label or vector is NULL or a
    component is NULL; of rows that repeat an id, the one with the least label
    (then the least vector) takes part; vectors of different lengths have no
    score; an anchor without another row of its label, or a positive without a
    negative in its window, gives no row; a score beyond 64 bits is an error;
    an empty table gives an empty result.
    """
    s = settings
    python_workers_import(rows.sparkSession)
    whole = F.coalesce(F.forall(vector_col, lambda x: x.isNotNull()), F.lit(False))
    clean = (rows.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & whole)
             .select(F.col(id_col).cast("long").alias("id"), is_anchor.alias("anchor"),
                     F.struct(F.col(label_col).cast("long").alias("label"), F.col(vector_col).cast("array<long>").alias("vector")).alias("v"))
             .groupBy("id").agg(F.min("v").alias("v"), F.any_value("anchor").alias("anchor"))
             .select("id", "anchor", "v.label", "v.vector", F.size("v.vector").alias("d")).where("d > 0"))
    clean = written(clean, "rtree-rows")
    pages = pack_pages(clean, s)
    anchors = clean.where("anchor").select("id", "label", "d", "vector")
    none, least, most = F.lit(-1).cast("long"), F.lit(_ALL[0]), F.lit(_ALL[1])
    anywhere = F.array(F.struct(none.alias("id"), none.alias("score"), least.alias("low"), most.alias("high")))
    positives = _search(pages, anchors.withColumn("wanted", anywhere), True, s.positives, s)
    # in whole numbers: low_percent * positive <= 100 * score <= high_percent * positive
    share = lambda percent: F.col("score").cast("decimal(20,0)") * percent / F.lit(100).cast("decimal(3,0)")
    window = F.struct("id", "score", F.ceil(share(s.low_percent)).cast("long").alias("low"),
                      F.floor(share(s.high_percent)).cast("long").alias("high"))
    wanted = written(positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(window)).alias("wanted")), "rtree-windows")
    asked = anchors.join(wanted, F.col("id") == F.col("anchor_id")).drop("anchor_id")
    negatives = _search(pages, asked, False, s.negatives, s)
    return negatives.select("anchor_id", "positive_id", F.col("n").cast("int").alias("rank"), F.col("id").alias("negative_id"),
                            "positive_score", F.col("score").alias("negative_score"))
