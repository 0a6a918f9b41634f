import itertools
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm import queries
from vellum.llm.lattice_dedup import Settings, cells_of, near_vectors, nearest_e8

from .conftest import SF

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType()), T.StructField("node", T.StringType()),
                       T.StructField("n_links", T.StringType())])


def brute(rows, cosine=0.98):
    """[(id, n_links, component, kept)] of [(id, vector, label)], in their order."""
    def fine(v):
        return v is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)

    vectors = [np.array(v, float) if fine(v) and label is not None else None for _, v, label in rows]
    root = list(range(len(rows)))
    links = [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = vectors[i], vectors[j]
        if a is not None and b is not None and rows[i][2] == rows[j][2] and len(a) == len(b):
            if a @ b / (np.sqrt(a @ a) * np.sqrt(b @ b)) >= cosine or (a == b).all():
                links[i], links[j] = links[i] + 1, links[j] + 1
                root[find(i)] = find(j)
    out = []
    for i, (id_, _, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None)
        out.append((id_, links[i], least, id_ is not None and id_ == least))
    return sorted(out, key=repr)


def got(df):
    return sorted(((r.row.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)


def near(rng, v, angle):
    """A vector at the given angle from a unit vector."""
    side = rng.normal(size=len(v))
    side -= (side @ v) * v
    return np.cos(angle) * v + np.sin(angle) * side / np.linalg.norm(side)


def unit(rng, d):
    v = rng.normal(size=d)
    return v / np.linalg.norm(v)


def groups(rng, d=32):
    """Vectors alone, groups of near copies around the threshold, chains and copies."""
    rows = []
    for g in range(40):
        base = unit(rng, d)
        rows += [near(rng, base, a) for a in rng.uniform(0, 0.22, 1 + g % 7)]
        walk = base
        for _ in range(g % 4):
            walk = near(rng, walk, 0.15)
            rows.append(walk)
    rows += rows[:25] + rows[5:15]
    label = [int(x) for x in rng.integers(0, 2, len(rows))]
    return [(i, [float(np.float32(x)) for x in v], k) for i, (v, k) in enumerate(zip(rows, label))]


def test_nearest_points():
    """Against every point of E8 around."""
    rng = np.random.default_rng(3)
    whole = np.array([p for p in itertools.product((-1, 0, 1), repeat=8) if sum(p) % 2 == 0], float)
    half = np.array([p for p in itertools.product((-0.5, 0.5), repeat=8) if sum(p) % 2 == 0], float)
    more = np.array([p for p in itertools.product((-1.5, -0.5, 0.5, 1.5), repeat=8) if sum(p) % 2 == 0 and sum(abs(x) > 1 for x in p) == 1], float)
    points = np.concatenate([whole, half, more])
    x = rng.uniform(-0.6, 0.6, (200, 8))
    found = nearest_e8(x)
    least = ((x[:, None] - points) ** 2).sum(2).min(1)
    assert np.allclose(((x - found) ** 2).sum(1), least)


def test_recall_at_the_threshold():
    """Pairs just at the threshold meet in one of the tables (at least 0.999)."""
    rng, s = np.random.default_rng(1), Settings()
    a = np.array([unit(rng, 64) for _ in range(4000)])
    b = np.array([near(rng, v, np.arccos(s.cosine)) for v in a])
    zero = np.zeros(len(a), np.uint64)
    x, y = cells_of(a, zero, s), cells_of(b, zero, s)
    met = ((y == x[:, :, :1]).any(2) | (x == y[:, :, :1]).any(2)).any(1)
    assert met.mean() >= 0.999
    far = np.roll(b, 1, axis=0)
    z = cells_of(far, zero, s)
    assert ((z == x[:, :, :1]).any(2) | (x == z[:, :, :1]).any(2)).any(1).mean() < 0.1


@pytest.mark.parametrize("block", [2048, 4])
def test_equals_brute_force(spark, block):
    rows = groups(np.random.default_rng(11))
    assert got(near_vectors(frame(spark, rows), settings=replace(Settings(), block=block))) == brute(rows)


def test_query_equals_brute_force(spark):
    """The whole small table with planted copies and near copies."""
    rows = [(r.vec_id, r.embedding, r.label) for r in queries.table(spark, SF, "embeddings").collect()]
    want = brute(rows)
    assert sorted((tuple(r) for r in queries.op12_embedding_dedup(spark, SF).collect()), key=repr) == want
    rng = np.random.default_rng(4)
    more = []
    for k in range(60):
        _, v, label = rows[k % 20]
        v = np.array(v) / np.linalg.norm(v)
        w = near(rng, v, 0.02 * (k % 12))
        more.append((1000 + k, [float(np.float32(x)) for x in w], label))
    every = rows + more
    assert got(near_vectors(frame(spark, every))) == brute(every)


def test_edge_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, [2.0, 4.0], 1), (4, [1.0, 2.0], 2), (5, None, 1),
            (6, [0.0, 0.0], 1), (7, [1.0, None], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [], 1), (11, [1.0, 2.0], None),
            (12, [1.0, 2.0, 0.0], 1), (None, [1.0, 2.0], 1), (None, [5.0, -7.0], 3), (13, [-1.0, -2.0], 1), (14, [1e30, 2e30], 1),
            (15, [1e-30, 2e-30], 1), (5, None, 1)]
    assert got(near_vectors(frame(spark, rows))) == brute(rows)
    assert near_vectors(frame(spark, rows[:1]).limit(0)).collect() == []
    huge = spark.createDataFrame([(1, [1e300, 2e300], "a"), (2, [2e300, 4e300], "a"), (3, [1e-300, 2e-300], "a")], "vec_id long, embedding array<double>, label string")
    assert got(near_vectors(huge)) == [(1, 2, 1, True), (2, 2, 1, False), (3, 2, 1, False)]


def test_rows_made_for_large_groups(spark):
    """What leaves the tasks grows with the vectors, not with the pairs."""
    rng = np.random.default_rng(2)
    base = unit(rng, 16)
    rows = [(i, [float(np.float32(x)) for x in near(rng, base, 0.05 * rng.random())], 1) for i in range(400)]
    out = near_vectors(frame(spark, rows), settings=replace(Settings(), block=64))
    assert got(out) == [(i, 399, 0, i == 0) for i in sorted(range(400), key=lambda i: repr((i, 399, 0, i == 0)))]
