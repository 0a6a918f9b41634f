import math

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm import queries
from vellum.llm.hard_negatives import Settings, hard_negatives, tiles

from .conftest import SF

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("vector", T.ArrayType(T.LongType())),
                       T.StructField("label", T.IntegerType()), T.StructField("page", T.StringType()), T.StructField("d", T.StringType())])


def brute(rows, anchor, s=Settings()):
    """The contract on [(id, vector, label)], row by row."""
    by_id = {}
    for i, v, label in rows:
        if i is not None and v and label is not None and None not in v and (i not in by_id or (label, v) < by_id[i][::-1]):
            by_id[i] = (v, label)
    out = []

    def first(a, fits, k):
        va, la = by_id[a]
        scored = [(-sum(x * y for x, y in zip(va, v)), i) for i, (v, label) in by_id.items()
                  if i != a and len(v) == len(va) and fits(label == la)]
        return sorted(scored)[:k] if k else sorted(scored)

    for a in filter(anchor, by_id):
        others = first(a, lambda same: not same, None)
        for minus, p in first(a, lambda same: same, s.positives):
            found = [(m, i) for m, i in others if s.low_percent * -minus <= 100 * -m <= s.high_percent * -minus]
            out += [(a, p, n, i, -minus, -m) for n, (m, i) in enumerate(found[:s.negatives], 1)]
    return sorted(out)


def got(df):
    return sorted((r.anchor_id, r.positive_id, r["rank"], r.negative_id, r.positive_score, r.negative_score) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def random_rows(rng, n, d=6, spread=40, labels=3):
    return [(i, [int(x) for x in rng.integers(-spread, spread, d)], int(rng.integers(0, labels))) for i in range(n)]


def test_query_equals_brute_force(spark):
    table = [(r.vec_id, [math.floor(256 * x) for x in r.embedding], (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
             for r in queries.table(spark, SF, "embeddings").collect()]
    want = brute(table, lambda i: i % 100 == 0)
    assert got(queries.op11_hard_negatives(spark, SF)) == want and len(want) > 100


@pytest.mark.parametrize("s", [Settings(), Settings(page=16, leaf=4, pages_at_once=2, anchors_at_once=5)])
def test_blocks_and_ties(spark, s):
    """Small integers give many equal scores; small pages many blocks."""
    rng = np.random.default_rng(5)
    rows = random_rows(rng, 300, 3, 3) + [(i, [2, 1, 0], int(i % 2)) for i in range(300, 420)]
    assert got(hard_negatives(frame(spark, rows), F.col("vec_id") % 9 == 0, settings=s)) == brute(rows, lambda i: i % 9 == 0, s)


def test_leaves_hold_every_row_once():
    rng = np.random.default_rng(2)
    for n in (1, 31, 32, 33, 700):
        leaves = tiles(rng.integers(-9, 9, (n, 5)), 32)
        assert sorted(np.concatenate(leaves).tolist()) == list(range(n)) and max(map(len, leaves)) <= 32


def test_edge_cases(spark):
    big = 1 << 29
    rows = [(0, [3, 4], 1), (1, [3, 3], 1), (2, [1, 2], 2), (3, [2, 1], 2), (3, [1, 1], 1), (4, None, 1), (5, [1, None], 1), (6, [1, 1], None),
            (None, [1, 1], 2), (7, [], 1), (8, [1, 2, 3], 2), (9, [1, 2, 3], 2), (10, [big, -big], 3), (11, [big, -big + 1], 3),
            (12, [big // 2, -big // 2], 4), (20, [0, 0], 1), (2, [1, 2], 2)]
    assert got(hard_negatives(frame(spark, rows), F.lit(True))) == brute(rows, lambda i: True)
    assert hard_negatives(frame(spark, rows).limit(0), F.lit(True)).collect() == []
    assert got(hard_negatives(frame(spark, rows[:1]), F.lit(True))) == []
