"""Importance resampling towards a target distribution.

A text's features are its runs of one to three consecutive words, hashed to a
fixed number of buckets. One 256-byte table lower-cases A-Z and blanks every
separator of the UTF-8 bytes, ``bytes.split`` yields the words, and a chain of
``zlib.crc32`` calls, each seeded with the hash of the run one word shorter,
gives the hash of every run without building it.

The first pass counts the buckets of the corpus and of the target: every task
keeps one counter of all its texts, the counters are summed by bucket. The
gains of the buckets (their number is a parameter, so the table is bounded)
travel with the tasks of the second pass, which adds up each document's gains.
The draw is the Gumbel top-k trick: seeded noise on the weights, and the
documents with the highest scores, numbered over range partitions.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.text import python_workers_import, row_struct, written
from vellum.operators.numbering import number_rows

#: lower-cased letters, digits and all bytes of other characters stay; the rest separates words
TABLE = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: bytes of a text that are split at a time
AT_ONCE = 1 << 20


@dataclass(frozen=True)
class Settings:
    """buckets of the hashed features, the smallest number of words of a
    document that can be drawn, the share to draw in percent, and the seed."""

    buckets: int = 10_000
    min_words: int = 20
    percent: int = 5
    seed: int = 42


def _stretches(raw: bytes) -> Iterator[list[bytes]]:
    """The words of a translated text, some at a time, cut between words."""
    start = 0
    while start < len(raw):
        end = len(raw)
        if start + AT_ONCE < end:
            end = raw.find(b" ", start + AT_ONCE)
            end = len(raw) if end < 0 else end
        if words := raw[start:end].split():
            yield words
        start = end


def feature_hashes(text: str) -> tuple[int, list[np.ndarray]]:
    """The number of words, and the crc32 of every run of 1 to 3 words (the
    UTF-8 bytes joined by one space), in arrays."""
    n, out = 0, []
    one: list[int] = []  # hash of the last word, and of the last two: seeds of the next stretch
    two: list[int] = []
    for words in _stretches(text.encode("utf-8", "surrogatepass").translate(TABLE)):
        n += len(words)
        spaced = [b" " + w for w in words]
        ones = list(map(crc32, words))
        seeds = one + ones[:-1]
        twos = list(map(crc32, spaced[len(words) - len(seeds):], seeds))
        seeds = two + twos[:-1]
        threes = list(map(crc32, spaced[len(words) - len(seeds):], seeds))
        out += [np.array(h, np.uint32) for h in (ones, twos, threes)]
        one, two = ones[-1:], twos[-1:] or two
    return n, out


def bucket_counts(texts: DataFrame, buckets: int, text_col: str = "text") -> DataFrame:
    """bucket, n: how often the features of all texts fall into each bucket
    (buckets without any are left out). A task sends one row a bucket."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = np.zeros(buckets, np.int64)
        for batch in batches:
            for text in batch.column(0):
                for hashes in feature_hashes(text.as_py() or "")[1]:
                    counter += np.bincount(hashes % buckets, minlength=buckets)
        seen = np.flatnonzero(counter)
        yield pa.RecordBatch.from_pydict({"bucket": seen.astype(np.int64), "n": counter[seen]})

    python_workers_import(texts.sparkSession)
    return (texts.select(F.col(text_col).alias("text")).mapInArrow(count, "bucket long, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n")))


def gains(corpus: DataFrame, target: DataFrame, s: Settings, corpus_text: str = "text", target_text: str = "text") -> DataFrame:
    """bucket, s, t, gain of every bucket: 1000 times the log ratio of its
    smoothed share in the target and in the corpus, rounded down."""
    both = (bucket_counts(corpus, s.buckets, corpus_text).select("bucket", F.col("n").alias("s"), F.lit(0).cast("long").alias("t"))
            .unionByName(bucket_counts(target, s.buckets, target_text).select("bucket", F.lit(0).cast("long").alias("s"), F.col("n").alias("t")))
            .unionByName(corpus.sparkSession.range(s.buckets).select(
                F.col("id").alias("bucket"), F.lit(0).cast("long").alias("s"), F.lit(0).cast("long").alias("t"))))
    per = written(both.groupBy("bucket").agg(F.sum("s").alias("s"), F.sum("t").alias("t")), "buckets")
    total = per.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))  # one row

    def smooth(n: str, more: int):
        return (F.col(n) + more).cast("double")

    ratio = smooth("t", 1) * smooth("all_s", s.buckets) / (smooth("s", 1) * smooth("all_t", s.buckets))
    return (per.join(F.broadcast(total), F.lit(True))
            .select("bucket", "s", "t", F.floor(1000 * F.log(ratio)).cast("long").alias("gain")))


def weigh(docs: DataFrame, gain_of: np.ndarray, text_col: str = "text") -> DataFrame:
    """``doc`` (the input row) and ``features`` (struct: n_words, n_features,
    weight: the sum of the gains of all features)."""
    python_workers_import(docs.sparkSession)
    buckets = len(gain_of)

    @F.pandas_udf("n_words long, n_features long, weight long")
    def add_up(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            rows = []
            for text in texts:
                n, hashes = feature_hashes(text or "")
                rows.append((n, sum(map(len, hashes)), sum(int(gain_of[h % buckets].sum()) for h in hashes)))
            yield pd.DataFrame(rows, columns=["n_words", "n_features", "weight"])

    return docs.select(row_struct(docs).alias("doc"), add_up(F.col(text_col)).alias("features"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             target_text: str = "text", settings: Settings = Settings(), carry: list[str] | None = None) -> DataFrame:
    """One row per input row: ``doc`` (its columns named in ``carry``; the id
    by default), n_words, n_features, weight, score and rank. The drawn rows
    have the ranks 1, 2, 3, ...; the rank of the others is NULL.

    Edge cases: a NULL or empty text has no features and weight 0; rows that
    repeat an id are documents of their own and share their noise; rows
    without an id have the noise of the empty id and come last among equal
    scores; ties go to the smaller id. Empty documents give an empty result;
    an empty target leaves every bucket with its smoothed share.
    """
    s = settings
    # bounded by the number of buckets
    table = np.zeros(s.buckets, np.int64)
    for r in gains(docs, target, s, text_col, target_text).select("bucket", "gain").collect():
        table[r.bucket] = r.gain
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{s.seed}:"), F.coalesce(F.col(f"doc.`{id_col}`").cast("string"), F.lit("")))
                                  .cast("binary"), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    kept = F.struct(*[F.col(f"doc.`{c}`") for c in dict.fromkeys([*(carry or []), id_col])])
    scored = written(weigh(docs, table, text_col).select(kept.alias("doc"), "features.*")
                     .withColumn("score", F.col("weight") + noise), "scored")
    fit = F.col("n_words") >= s.min_words
    n_drawn = scored.where(fit).count() * s.percent // 100
    order = [F.col("score").desc(), F.col(f"doc.`{id_col}`").asc_nulls_last(), F.col("n_features"), F.col("weight")]
    ranked = number_rows(scored.where(fit), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= n_drawn, F.col("rank")))
    return ranked.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def drawn(docs: DataFrame, target: DataFrame, settings: Settings = Settings(), **names) -> DataFrame:
    """The rows of ``docs`` that are drawn, whole, with their rank."""
    rows = resample(docs, target, settings=settings, carry=docs.columns, **names).where("rank IS NOT NULL")
    return rows.select("doc", "rank")
