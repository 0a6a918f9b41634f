import hashlib
import math
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vellum.llm import queries, resampling
from vellum.llm.resampling import Settings, drawn, feature_hashes, resample

from .conftest import SF

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def features(text):
    words = WORDS.findall((text or "").translate(LOWER))
    return words, [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def buckets(text, n):
    return [zlib.crc32(f.encode("utf-8", "surrogatepass")) % n for f in features(text)[1]]


def brute(docs, target, s=Settings()):
    """[(id, n_features, weight, score, rank)] from [(id, text)] and texts."""
    corpus = Counter(b for _, t in docs for b in buckets(t, s.buckets))
    wanted = Counter(b for t in target for b in buckets(t, s.buckets))
    all_s, all_t, k = sum(corpus.values()), sum(wanted.values()), s.buckets

    def gain(b):
        return math.floor(1000 * math.log((wanted[b] + 1) * (all_s + k) / ((corpus[b] + 1) * (all_t + k))))

    rows = []
    for i, t in docs:
        h = int(hashlib.sha256(f"{s.seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(map(gain, buckets(t, k)))
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, len(features(t)[1]), weight, weight + noise, None, len(features(t)[0])])
    fit = sorted((r for r in rows if r[5] >= s.min_words), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1], r[2]))
    for n, r in enumerate(fit[:s.percent * len(fit) // 100], 1):
        r[4] = n
    return sorted((tuple(r[:5]) for r in rows), key=repr)


def got(rows):
    return sorted(((r.doc.doc_id, r.n_features, r.weight, r.score, r.rank) for r in rows), key=repr)


def test_query_equals_brute_force(spark, texts):
    target = [r.text for r in queries.table(spark, SF, "benchmark", "text").collect()]
    rows = queries.op13_resampling(spark, SF).collect()
    assert sorted((tuple(r) for r in rows), key=repr) == brute(list(texts.items()), target)
    assert sum(r.rank is not None for r in rows) > 3


@pytest.mark.parametrize("at_once", [1, 7, 1 << 20])
def test_hashes_of_runs(monkeypatch, at_once):
    """Whatever the stretches a text is split in, every run is hashed once."""
    monkeypatch.setattr(resampling, "AT_ONCE", at_once)
    for text in ("", "one", "A b", "é日本 Ünder_x 12-3\x00q\x7f   Z end", "w " * 50 + "last", "no-separator" * 9, "a b c d e f"):
        words, runs = features(text)
        n, hashes = feature_hashes(text)
        assert n == len(words)
        assert sorted(int(x) for h in hashes for x in h) == sorted(zlib.crc32(f.encode()) for f in runs)


def test_edge_cases(spark, make_docs):
    long = " ".join(f"w{i % 91}" for i in range(30_000))
    same = "some words that stand in a row and make up a text of more than twenty words for the draw to take or to leave"
    docs = [(1, None), (2, ""), (3, long), (4, same), (5, same), (5, same), (5, long), (None, same), (None, None), (6, "too short")]
    target = ["a row of words", None, ""]
    s = Settings(percent=50, seed=7, buckets=97)
    frame, wanted = make_docs(docs), spark.createDataFrame([(t,) for t in target], "text string")
    assert got(resample(frame, wanted, settings=s).collect()) == brute(docs, target, s)
    taken = drawn(frame, wanted, s)
    assert sorted(r.rank for r in taken.collect()) == [1, 2, 3] and taken.select("doc.*").columns == frame.columns
    assert got(resample(frame, wanted.limit(0), settings=s).collect()) == brute(docs, [], s)
    assert resample(frame.limit(0), wanted).collect() == []


def test_the_draw_favours_the_target(spark):
    words = F.concat_ws(" ", *[F.concat(F.when(F.col("id") % 4 == 0, F.lit("near")).otherwise(F.lit("far")),
                                        F.pmod(F.xxhash64("id", F.lit(k)), F.lit(50)).cast("string")) for k in range(25)])
    docs = spark.range(400).select(F.col("id").alias("doc_id"), words.alias("text"))
    target = spark.range(1).select(F.concat_ws(" ", *[F.lit(f"near{k}") for k in range(50)]).alias("text"))
    rows = resample(docs, target).where("rank IS NOT NULL").collect()
    assert len(rows) == 20 and all(r.doc.doc_id % 4 == 0 for r in rows)
