import hashlib
from collections import defaultdict
from fractions import Fraction

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vellum.llm import queries
from vellum.llm.mixing import Mix, leaf_budgets, mix_sources, word_count

from .conftest import SF


def fill(total, children):
    """{name: budget}: children (name, weight, holds), poured until full."""
    got = {n: Fraction(0) for n, _, _ in children}
    left, live = Fraction(min(total, sum(h for _, w, h in children if w))), [c for c in children if c[1]]
    while left and live:
        unit = left / sum(w for _, w, _ in live)
        short = [c for c in live if c[2] <= unit * c[1]]
        for n, w, h in short or live:
            got[n] = Fraction(h) if short else unit * w
            left -= got[n]
        live = [c for c in live if c not in short] if short else []
    return {n: int(x) for n, x in got.items()}


def brute_budgets(leaves, mix):
    """{path: budget}, top down."""
    def holds(path):
        return sum(t * mix.max_epochs for p, t in leaves.items() if p[:len(path)] == path and all(
            w.get(v, o) for w, o, v in zip(mix.weights, mix.other, p)))

    total = mix.total_tokens if mix.total_tokens is not None else sum(leaves.values()) * mix.percent // 100
    level = {(): min(total, holds(()))}
    for depth, (known, other) in enumerate(zip(mix.weights, mix.other)):
        below = {}
        for path, budget in level.items():
            kids = sorted({p[:depth + 1] for p in leaves if p[:depth] == path})
            below.update(fill(budget, [(k, known.get(k[-1], other), holds(k)) for k in kids]))
        level = below
    return level


def test_query_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.execute(queries.ORACLE["op4_mixing"])
    cols = [c[0] for c in rel.description]
    rows = queries.op4_mixing(spark, SF).collect()
    assert sorted(tuple(r[c] for c in cols) for r in rows) == sorted(rel.fetchall())


LEVELS = st.tuples(st.sampled_from("ab"), st.sampled_from("cde"), st.sampled_from("fg"))
MIXES = st.builds(lambda w, t, e: Mix(weights=w, other=(1, 2, 3), total_tokens=t, max_epochs=e),
                  st.tuples(*[st.dictionaries(st.sampled_from(v), st.integers(0, 5)) for v in ("ab", "cde", "fg")]),
                  st.integers(0, 4000), st.integers(1, 3))


@settings(max_examples=12, deadline=None)
@given(st.dictionaries(LEVELS, st.integers(0, 900), min_size=1), MIXES)
def test_budgets_follow_the_water_line(spark, leaves, mix):
    rows = spark.createDataFrame([(*p, t, 1) for p, t in leaves.items()], "domain string, lang string, source string, tokens long, docs long")
    got = {(r.domain, r.lang, r.source): r.budget for r in leaf_budgets(rows, mix).collect()}
    assert got == brute_budgets(leaves, mix)


def test_prefixes_of_seeded_epochs(spark):
    """A hot leaf over many buckets, repeated ids, documents without tokens,
    NULL levels and clashing column names."""
    schema = T.StructType([T.StructField(n, t) for n, t in (
        ("doc_id", T.LongType()), ("text", T.StringType()), ("n_tokens", T.StringType()), ("budget", T.StringType()), ("s", T.StringType()))])
    docs = [(i, "w " * (i % 7), "x", "y", "hot" if i % 3 else None) for i in range(600)] + [(5, "w w", "x", "y", "hot"), (None, None, "x", "y", "cold")]
    mix = Mix(weights=({}, {}, {"hot": 3}), other=(1, 1, 1), percent=140, max_epochs=3, seed=5, bucket_docs=16)
    frame = spark.createDataFrame(docs, schema)
    rows = mix_sources(frame, [F.lit("d"), F.lit("l"), F.col("s")], word_count(F.col("text")), mix).select(
        "doc.doc_id", F.col("doc.n_tokens").alias("own"), "source", "n_tokens", "copies").collect()
    assert len(rows) == len(docs) and {r.own for r in rows} == {"x"}
    leaves = defaultdict(int)
    for r in rows:
        leaves["d", "l", r.source] += r.n_tokens
    budgets = brute_budgets(leaves, mix)
    for path, budget in budgets.items():
        own = [r for r in rows if r.source == path[2]]
        epochs, rest = divmod(budget, leaves[path]) if leaves[path] else (0, 0)
        order = sorted(own, key=lambda r: (hashlib.md5("|".join(
            ["5", str(epochs), *([str(r.doc_id)] if r.doc_id is not None else [])]).encode()).hexdigest(), r.doc_id or 0, r.n_tokens))
        upto, total = 0, 0
        for r in order:
            upto += r.n_tokens
            total += r.copies
            assert r.copies == epochs + (0 < rest and upto <= rest)
        assert sum(r.n_tokens * r.copies for r in own) <= budget


def test_empty_table(spark):
    frame = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert mix_sources(frame, [F.lit("d"), F.col("lang"), F.col("source")], word_count(F.col("text")), queries.TARGET).collect() == []
