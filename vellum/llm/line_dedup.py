"""Line de-duplication over a whole corpus, with built-in expressions only.

Every line is exploded with its position, normalised to a key and hashed to
128 bits. One distributed aggregation counts the distinct documents of each
key (map-side partial aggregation first, so a line that sits in a third of
all documents is one row per map task before the exchange). Only the keys
over the threshold join the lines again; a hot key's lines are split by the
adaptive skew join. What reaches the documents is a list of dropped
positions, and each text is put together again by position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.text import WHITE_SPACE, ascii_lower, hash128, row_struct, whole_text, written


def line_key(line: Column) -> Column:
    """A line without white space at its ends and with A-Z lower-cased."""
    return F.btrim(ascii_lower(line), F.lit(WHITE_SPACE))


def shared_line_positions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                          min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """(id, text_hash, positions): the lines each document loses, by the hash
    of its text, as rows that repeat an id may hold different texts.

    A line is lost when its key has at least ``min_chars`` code points, is
    found in at least ``min_docs`` distinct ids, and the document's id isn't
    the largest one that holds the key.
    """
    keyed = ascii_lower(whole_text(text_col))
    lines = (docs.where(F.col(id_col).isNotNull())
             .select(F.col(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("text_hash"),
                     F.posexplode(F.split(keyed, "\n", -1)).alias("pos", "line"))
             .select("id", "text_hash", "pos", F.btrim("line", F.lit(WHITE_SPACE)).alias("key"))
             .where(F.char_length("key") >= min_chars))
    h1, h2 = hash128(F.col("key"))
    lines = lines.select("id", "text_hash", "pos", h1.alias("h1"), h2.alias("h2"))
    shared = (lines.groupBy("h1", "h2")
              .agg(F.countDistinct("id").alias("n_docs"), F.max("id").alias("last_id"))
              .where(F.col("n_docs") >= min_docs)
              .select("h1", "h2", "last_id"))
    # written, so that the join below has an exchange of its own on either side
    # and a very common line's partition can be split (an aggregate in the same
    # stage would keep it whole)
    shared = written(shared, "shared-lines")
    return (lines.join(shared, ["h1", "h2"])
            .where(F.col("id") < F.col("last_id"))
            .groupBy("id", "text_hash").agg(F.collect_list("pos").alias("positions")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """One row per input row: ``doc`` (the input row as a struct),
    ``kept_text``, ``n_lines`` (before dropping), ``n_dropped``.

    Edge cases: a NULL or empty text is one empty line; rows that repeat an
    id are one document when documents are counted, each keeps its own row
    and loses the lines of its own text only; a row without an id counts for no key and keeps all
    its lines; an empty table gives an empty result.
    """
    lost = shared_line_positions(docs, id_col, text_col, min_chars, min_docs)
    rows = docs.select(row_struct(docs).alias("doc"), F.col(id_col).alias("row_id"),
                       whole_text(text_col).alias("whole"))
    same = [rows["row_id"] == lost["id"], F.xxhash64(rows["whole"]) == lost["text_hash"]]
    joined = rows.join(lost, same, "left")
    parts = joined.select("doc", "whole", "positions", F.split("whole", "\n", -1).alias("lines"))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("positions"))
    out = parts.select("doc", "whole", "lines", F.when(F.col("positions").isNotNull(), kept).alias("kept"))
    return out.select(
        "doc",
        F.when(F.col("kept").isNull(), F.col("whole"))
        .otherwise(F.array_join(F.transform("kept", lambda i: F.get(F.col("lines"), i)), "\n")).alias("kept_text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"))
