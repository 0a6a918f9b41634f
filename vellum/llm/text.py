"""Small helpers shared by the text operators."""

from __future__ import annotations

import os
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vellum.sources.tables import materialized

#: the white space that separates words and is stripped from lines
WHITE_SPACE = "\t\n\x0b\x0c\r "
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def whole_text(col: str | Column = "text") -> Column:
    """The text, with NULL read as the empty text."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def ascii_lower(col: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    return F.translate(col, UPPER, LOWER)


def hash128(col: Column) -> tuple[Column, Column]:
    """Two independent 64-bit hashes of a value (a 128-bit key).

    The constant comes first, so it seeds the hash of the value: the second
    hash is no function of the first.
    """
    return F.xxhash64(col), F.xxhash64(F.lit(7), col)


def row_struct(docs: DataFrame) -> Column:
    """The whole input row as one struct, so that no column of the input can
    clash with a column that an operator adds."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns])


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back."""
    return materialized(df, name=f"llm-{name}")


def python_workers_import(spark: SparkSession) -> None:
    """Let the Python workers import the package from where the driver has
    it (a checkout on a path that all nodes see; an installed package needs
    nothing)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = [*sys.path, os.environ.get("PYTHONPATH", "")]
    env = spark.sparkContext.environment
    if root in paths and root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH")]))
