"""The corpus pipeline held against brute force, stage by stage."""

import hashlib

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from vellum.llm.byte_bpe import load_ranks

from .conftest import SF
from .test_line_dedup import brute as brute_lines
from .test_near_dedup import brute as brute_near


def test_stages_and_run(spark, texts):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = stage(spark, docs, SF).persist()
        seen.append({r.doc_id: r for r in docs.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert docs.columns == columns and set(seen[-1]) <= {r.doc_id for r in before.select("doc_id").collect()}
    quality, lines, near, mixed, coded = seen
    assert 0 < len(quality) < len(texts) and all(r.text == texts[i] for i, r in quality.items())
    want = brute_lines({i: r.text for i, r in quality.items()})
    assert {i: r.text for i, r in lines.items()} == {i: t for i, (_, _, t) in want.items()}
    assert all(r.n_chars == len(r.text) for r in lines.values())
    groups = brute_near([(i, r.text) for i, r in lines.items()])
    assert set(near) == {i for i, (_, c) in groups.items() if i == c}
    assert 0 < len(mixed) < len(near)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(P.path("byte_bpe_50k.tiktoken")), special_tokens={})
    for i, r in coded.items():
        ids = library.encode_ordinary(mixed[i].text)
        assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(mixed[i].text.encode()).hexdigest()
    assert coded.keys() == mixed.keys()
    rows = corpus_pipeline.run(spark, SF).collect()
    assert sorted(rows) == sorted(coded.values())


def test_empty_table(spark, tmp_path):
    spark.read.parquet(f"{SF}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_rows_with_nulls(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    nulls = spark.createDataFrame([(None, None, None, None, None), (10_000_000, None, "en", "src0", 0)], docs.schema)
    docs.unionByName(nulls).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert got and None not in got and 10_000_000 not in got


def test_near_copies_with_repeated_and_missing_ids(spark):
    """Copies are found whatever their ids: one row of each group stays."""
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    near = lambda k: words(k) + " and more"
    rows = [(1, words(1)), (1, words(1)), (2, words(2)), (2, words(3)), (3, near(2)), (None, words(4)), (None, near(4)),
            (None, words(4)), (None, near(1)), (9, words(5)), (8, near(5)), (None, words(6)), (7, None), (6, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF)
    assert kept.columns == docs.columns
    got = [(r.doc_id, r.text) for r in kept.collect()]
    group = lambda t: t.split("x")[0] if t else t
    assert sorted(group(t) for _, t in got if t) == [f"w{k}" for k in range(1, 7)]
    assert {i for i, t in got if not t} == {7, 6} and (8, near(5)) in got and (9, words(5)) not in got
