"""The registered queries of the text operators and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.llm.byte_bpe import encode_decode
from vellum.llm.edit_counts import edited_counts, sample_edits
from vellum.llm.hard_negatives import hard_negatives
from vellum.llm.html_extract import extract_pages, fit_weights
from vellum.llm.imatch import fingerprint_edits
from vellum.llm.lattice_dedup import near_vectors
from vellum.llm.line_dedup import dedup_lines
from vellum.llm.mixing import Mix, mix_sources, word_count
from vellum.llm.near_dedup import near_dedup
from vellum.llm.quality_rules import quality_rules
from vellum.llm.resampling import resample
from vellum.llm.secret_scan import scan_secrets
from vellum.llm.token_files import digest_row, new_folder, read_token_files, write_token_files


def table(spark: SparkSession, sf_dir: str, name: str, *cols: str) -> DataFrame:
    """A whole table (the given columns of it)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*cols) if cols else df


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    folder = new_folder(spark)
    write_token_files(docs, folder, public_tokenizers.path("word_bpe_49k.json"), end_id=1, vocab_size=49408,
                      special_tokens=True)
    return read_token_files(spark, folder, "doc_id long, start long, n_tokens long, ids_crc32 long", digest_row)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality_rules(docs).select(
        "doc.doc_id", *[f"quality.{c}" for c in (
            "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
            "whole_ratio", "n_chunks", "n_bad_chunks")])


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return near_dedup(docs).withColumnRenamed("id", "doc_id")


#: domains of the sources (a parameter of the mix)
DOMAINS = {"web": ("src0", "src1", "src2", "src3", "src4", "src5", "src6", "src7"),
           "forum": ("src8", "src9", "src10", "src11", "src12"),
           "books": ("src13", "src14", "src15", "src16")}
OTHER_DOMAIN = "misc"
#: target weights of the levels domain, language and source
TARGET = Mix(weights=({"web": 5, "forum": 3, "books": 4}, {"en": 6, "de": 3, "fr": 2, "es": 2}, {"src0": 4}),
             other=(2, 1, 1), percent=90, max_epochs=2, seed=17)


def domain_of(source: str = "source"):
    out = F.lit(OTHER_DOMAIN)
    for domain, sources in DOMAINS.items():
        out = F.when(F.col(source).isin(*sources), F.lit(domain)).otherwise(out)
    return out


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    docs = docs.select("doc_id", "lang", "source", word_count(F.col("text")).alias("n_words"))
    mixed = mix_sources(docs, [domain_of(), F.col("lang"), F.col("source")], F.col("n_words"), TARGET)
    return mixed.select("doc.doc_id", "domain", "lang", "source", "n_tokens", "copies")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "lang", "text")
    found = scan_secrets(docs, path=F.concat_ws("/", "source", "lang"))
    return found.select("doc_id", "n", "start", F.char_length("candidate").cast("long").alias("length"),
                        F.sha2(F.col("candidate").cast("binary"), 256).alias("candidate_sha256"), "probability", "kept")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return dedup_lines(docs).select("doc.doc_id", "n_lines", "n_dropped",
                                    F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op7_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    counted = edited_counts(docs, sample_edits(), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return counted.select("doc.doc_id", "count.n_tokens", "count.edited_tokens", "count.n_pretokens", "count.n_encoded")


def op8_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    coded = encode_decode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    return coded.select("doc.doc_id", "bpe.n_tokens", "bpe.ids_sha256", "bpe.decoded_sha256")


def op9_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return fingerprint_edits(docs).withColumnRenamed("id", "doc_id")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    found = extract_pages(pages, fit_weights(pages))
    return found.select("page.page_id", "page.url", "text", F.char_length("text").cast("long").alias("n_chars"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    fine = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")))
    rows = rows.where(fine).select("vec_id", label.alias("label"), vector.alias("vector"))
    return hard_negatives(rows, F.col("vec_id") % 100 == 0)


def op12_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    return near_vectors(rows).select("row.vec_id", "n_links", "component_id", "kept")


def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    drawn = resample(docs, table(spark, sf_dir, "benchmark", "text"))
    return drawn.select("doc.doc_id", "n_features", "weight", "score", "rank")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_files, op2_quality_rules, op3_near_dedup, op4_mixing, op5_secret_scan, op6_line_dedup, op7_edit_counts, op8_byte_bpe, op9_imatch,
                             op10_html_extraction, op11_hard_negatives, op12_embedding_dedup, op13_resampling)}

_STRIP = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"



def _case(col: str, known: dict[str, int], other: int) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{v}' THEN {w}" for v, w in known.items()) + f" ELSE {other} END"


def mixing_sql(mix: Mix, docs: str = "documents") -> str:
    """DuckDB SQL: doc_id, domain, lang, source, n_tokens, copies. Each level
    is filled by testing, for every child, which siblings would be full at
    the water level that the child's own fill implies."""
    domain = "CASE " + " ".join(
        f"WHEN source IN ({', '.join(map(repr, s))}) THEN '{d}'" for d, s in DOMAINS.items()) + f" ELSE '{OTHER_DOMAIN}' END"
    sql = f"""
tok AS (SELECT doc_id, {domain} AS domain, coalesce(lang, '(none)') AS lang, coalesce(source, '(none)') AS source,
        len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::HUGEINT AS n FROM {docs}),
leaf AS (SELECT domain, lang, source, sum(n) AS tokens FROM tok GROUP BY ALL),
b0 AS (SELECT least(sum(tokens) * {mix.percent} // 100, sum(tokens) * {mix.max_epochs}) AS budget FROM leaf)"""
    path: list[str] = []
    for depth, (level, known, other) in enumerate(zip(mix.levels, mix.weights, mix.other), 1):
        up = ", ".join(path)
        on = " AND ".join(f"x.{c} = y.{c}" for c in path) or "true"
        keys = ", ".join([*path, level])
        sql += f""",
n{depth} AS (SELECT {keys}, {_case(level, known, other)}::HUGEINT AS w, sum(tokens) * {mix.max_epochs} AS cap
     FROM leaf GROUP BY {keys}),
f{depth} AS (SELECT x.*, (SELECT budget FROM b{depth - 1} y WHERE {on}) AS total,
     (SELECT sum(least(y.cap * x.w, x.cap * y.w)) FROM n{depth} y WHERE {on}) AS filled FROM n{depth} x),
g{depth} AS (SELECT *, filled <= total * w AS is_full FROM f{depth}),
r{depth} AS (SELECT {up + ', ' if up else ''}any_value(total) - coalesce(sum(cap) FILTER (WHERE is_full), 0) AS rest,
     sum(w) FILTER (WHERE NOT is_full) AS w_rest FROM g{depth} {'GROUP BY ' + up if up else ''}),
b{depth} AS (SELECT x.*, CASE WHEN is_full THEN cap ELSE w * y.rest // y.w_rest END AS budget
     FROM g{depth} x JOIN r{depth} y ON {on})"""
        path.append(level)
    last = len(path)
    return "WITH " + sql.strip() + f""",
plan AS (SELECT domain, lang, source, CASE WHEN tokens > 0 THEN budget // tokens ELSE 0 END AS epochs,
     CASE WHEN tokens > 0 THEN budget % tokens ELSE 0 END AS rest FROM leaf JOIN b{last} USING (domain, lang, source)),
run AS (SELECT doc_id, domain, lang, source, n, epochs, rest,
     sum(n) OVER (PARTITION BY domain, lang, source
                  ORDER BY md5(concat_ws('|', '{mix.seed}', epochs, doc_id)), doc_id ROWS UNBOUNDED PRECEDING) AS upto
     FROM tok JOIN plan USING (domain, lang, source))
SELECT doc_id, domain, lang, source, n::BIGINT AS n_tokens,
     (epochs + CASE WHEN rest > 0 AND upto <= rest THEN 1 ELSE 0 END)::BIGINT AS copies FROM run"""


#: DuckDB SQL of the queries that SQL can express on whole tables
ORACLE: dict[str, str] = {
    "op4_mixing": mixing_sql(TARGET),
    "op6_line_dedup": f"""
WITH parts AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
line AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM parts),
keyed AS (SELECT *, {_LOWERED.format(f"trim(line, {_STRIP})")} AS k FROM line),
shared AS (SELECT k, max(doc_id) AS last_id FROM keyed WHERE length(k) >= 20
           GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
marked AS (SELECT keyed.*, coalesce(keyed.doc_id < shared.last_id, false) AS lost
           FROM keyed LEFT JOIN shared USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
}
