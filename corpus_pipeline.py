"""Corpus preparation in five stages over the ``documents`` table.

quality rules → line de-duplication → near-duplicate removal → mixing to
target weights → byte-level BPE. Each stage reads what its predecessor wrote
(Parquet) and all but the last return the columns of ``documents``; a stage's
decisions take effect in its output. SQL can't express the quality, sketch and
BPE stages, so there is no oracle; the tests hold the run against a
brute-force version.
"""

from __future__ import annotations

from dataclasses import replace

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.byte_bpe import encode_decode
from vellum.llm.line_dedup import dedup_lines
from vellum.llm.mixing import mix_sources, word_count
from vellum.llm.near_dedup import near_dedup
from vellum.llm.quality_rules import quality_rules
from vellum.llm.queries import TARGET, domain_of
from vellum.llm.text import written
from vellum.operators.numbering import number_rows

#: the mix of the run: one epoch, since a second one would bring back copies
MIX = replace(TARGET, max_epochs=1)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality_rules(docs).where("quality.kept").select("doc.*")


def drop_shared_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many documents share."""
    rest = [F.col(f"doc.`{c}`") for c in docs.columns]
    out = dedup_lines(docs).select(*rest, F.col("kept_text").alias("_kept"))
    return (out.withColumn("text", F.col("_kept")).withColumn("n_chars", F.char_length("_kept").cast("long"))
            .select(*docs.columns))


def with_row_keys(docs: DataFrame) -> DataFrame:
    """``docs`` with a key of its own for each row, ``_row``: its doc_id, or
    for rows that repeat an id or have none a number above all ids. Of such
    rows those with equal id and text are one document: one of them stays."""
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    unsure = written(ids.where("doc_id IS NULL OR n > 1").select("doc_id"), "unsure-ids")
    if unsure.isEmpty():
        return docs.withColumn("_row", F.col("doc_id"))
    sure = docs.where("doc_id IS NOT NULL").join(unsure, "doc_id", "left_anti")
    others = docs.where("doc_id IS NULL").unionByName(docs.join(unsure, "doc_id", "left_semi"))
    top = docs.agg(F.max("doc_id")).first()[0] or 0
    numbered = number_rows(others.dropDuplicates(["doc_id", "text"]), [F.col("doc_id"), F.xxhash64("text")], "_row")
    return (sure.withColumn("_row", F.col("doc_id"))
            .unionByName(numbered.withColumn("_row", F.col("_row") + F.lit(top))).select(*docs.columns, "_row"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: the one of the least id, or
    of rows that repeat an id or have none, any one if no other is in the group."""
    keyed = with_row_keys(docs)
    copies = near_dedup(keyed, id_col="_row").where(~F.col("kept")).select(F.col("id").alias("_row"))
    return keyed.join(copies, "_row", "left_anti").select(*docs.columns)


def mix_to_target(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the seeded token prefixes, by target weights."""
    mixed = mix_sources(docs, [domain_of(), F.col("lang"), F.col("source")], word_count(F.col("text")), MIX)
    return mixed.where("copies > 0").select("doc.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of the encoded and decoded texts."""
    coded = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc.doc_id", "doc.lang", "doc.source", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


STAGES = [
    ("quality_rules", keep_quality),
    ("line_dedup", drop_shared_lines),
    ("near_dedup", drop_near_copies),
    ("mixing", mix_to_target),
    ("byte_bpe", encode),
]

ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
