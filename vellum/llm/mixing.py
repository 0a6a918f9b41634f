"""Mixing sources to target weights: budgets down a tree, prefixes by hash.

The tree (domain, language, source) gets a total of tokens at its root. A
node hands its budget to its children in proportion to their weights; a child
can't take more than its subtree holds (tokens times ``max_epochs``), and what
it can't take goes to its siblings by weight. Since a node's own budget never
exceeds what its subtree holds, a shortage reaches the siblings of an ancestor
only when everything under that ancestor is used up.

Sorted by (what it holds / weight), the children that take all they hold come
first, so a whole level is one pair of running sums over the table of nodes:
no iteration.

A leaf of budget b and size s takes b div s whole epochs, and from the next
one the longest prefix of documents that fits the rest. An epoch's order is
the md5 of (seed, epoch, id). The prefix is found without bringing a leaf
together: the hash range of a leaf is cut into buckets of a few thousand
documents, running sums over bucket totals say where each bucket begins, and
only documents of one bucket are sorted in one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.text import row_struct, written

_WIDE = "decimal(19,0)"  # products of two have 38 digits


@dataclass(frozen=True)
class Mix:
    """``weights``: a whole number for each value of each level (others get
    ``other``; 0 takes nothing). The total is ``total_tokens``, or else
    ``percent`` of the tokens there are. ``bucket_docs``: documents that are
    sorted together, about."""

    weights: Sequence[dict[str, int]]
    other: Sequence[int]
    total_tokens: int | None = None
    percent: int = 100
    max_epochs: int = 2
    seed: int = 0
    bucket_docs: int = 4096
    levels: Sequence[str] = field(default=("domain", "lang", "source"))


def word_count(text: Column) -> Column:
    """The number of words (runs without ASCII white space) of a text."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit("\t\n\x0b\x0c\r "))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.size(F.split(trimmed, r"[\x20\x09-\x0D]+"))).cast("long")


def _weight(level: str, known: dict[str, int], other: int) -> Column:
    out = F.lit(other)
    for value, weight in known.items():
        out = F.when(F.col(level) == value, F.lit(weight)).otherwise(out)
    return out.cast("long")


def _share(nodes: DataFrame, parents: list[str], own: str) -> DataFrame:
    """``budget`` of each child: columns parents…, own, weight, holds, total
    (the parent's budget)."""
    order = Window.partitionBy(*parents).orderBy(F.col("holds") / F.col("weight"), own)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    onwards = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("holds").over(before), F.lit(0))
    full = F.col("holds").cast(_WIDE) * F.col("w_left").cast(_WIDE) <= F.col("weight").cast(_WIDE) * F.col("left").cast(_WIDE)
    nodes = (nodes.withColumn("left", left).withColumn("w_left", F.sum("weight").over(onwards))
             .withColumn("full", full))
    within = Window.partitionBy(*parents)
    rest = F.col("total") - F.coalesce(F.sum(F.when(F.col("full"), F.col("holds"))).over(within), F.lit(0))
    w_rest = F.sum(F.when(~F.col("full"), F.col("weight"))).over(within)
    nodes = nodes.withColumn("rest", rest).withColumn("w_rest", w_rest)
    exact = F.expr("cast(weight as decimal(19,0)) * cast(rest as decimal(19,0)) div w_rest")
    return nodes.withColumn("budget", F.when(F.col("full"), F.col("holds")).otherwise(exact).cast("long"))


def leaf_budgets(leaves: DataFrame, mix: Mix) -> DataFrame:
    """``leaves``: levels…, tokens, docs. Adds ``budget`` (tokens)."""
    levels = list(mix.levels)
    root = Window.partitionBy()
    tree = leaves.withColumn("_holds", F.col("tokens") * mix.max_epochs)
    for level, known, other in zip(levels, mix.weights, mix.other):
        tree = tree.withColumn(f"_w_{level}", _weight(level, known, other))
    nothing = F.greatest(*[F.when(F.col(f"_w_{lv}") == 0, 1).otherwise(0) for lv in levels]) == 1
    tree = tree.withColumn("_holds", F.when(nothing, F.lit(0)).otherwise(F.col("_holds")).cast("long"))
    budgets = None
    for depth, level in enumerate(levels):
        path = levels[:depth + 1]
        nodes = tree.groupBy(*path).agg(F.sum("_holds").alias("holds"), F.max(f"_w_{level}").alias("weight"),
                                        F.sum("tokens").alias("tokens"))
        nodes = nodes.withColumn("weight", F.greatest("weight", F.lit(1)))
        if budgets is None:
            wanted = F.lit(mix.total_tokens) if mix.total_tokens is not None else F.expr(
                f"cast(cast(sum(tokens) over () as decimal(19,0)) * {mix.percent} div 100 as bigint)")
            nodes = nodes.withColumn("total", F.least(wanted.cast("long"), F.sum("holds").over(root)))
        else:
            nodes = nodes.join(budgets.select(*path[:-1], F.col("budget").alias("total")), path[:-1])
        budgets = _share(nodes, path[:-1], level)
    return leaves.join(budgets.select(*levels, "budget"), levels)


def mix_sources(docs: DataFrame, levels: Sequence[Column], tokens: Column, mix: Mix, id_col: str = "doc_id") -> DataFrame:
    """One row per input row: ``doc`` (the input row as a struct), the levels,
    ``n_tokens``, ``copies`` (epochs that hold the document; 0: left out).

    Edge cases: a NULL level value is read as the value "(none)"; a document
    without tokens fits whatever is left; rows that repeat an id are each a
    document (equal order; fewer tokens first, then by a hash of the row, so
    a repeated task decides alike); a leaf without tokens gets nothing; an
    empty table gives an empty result.
    """
    names = list(mix.levels)
    hashed = [F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()]  # maps have no hash
    rows = docs.select(row_struct(docs).alias("doc"), F.col(id_col).alias("_id"), tokens.cast("long").alias("n_tokens"),
                       F.xxhash64(*hashed).alias("_tie"),
                       *[F.coalesce(c.cast("string"), F.lit("(none)")).alias(n) for n, c in zip(names, levels)])
    leaves = rows.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
    plan = leaf_budgets(leaves, mix).select(
        *names, F.expr("case when tokens > 0 then budget div tokens else 0 end").alias("epochs"),
        F.expr("case when tokens > 0 then budget % tokens else 0 end").alias("rest"),
        F.ceil(F.col("docs") / mix.bucket_docs).cast("long").alias("n_buckets"))
    # written (one row a leaf), so that the rows of a hot leaf can be split in this join
    rows = rows.join(written(plan, "budgets"), names)
    rows = rows.withColumn("_order", F.md5(F.concat_ws("|", F.lit(str(mix.seed)), F.col("epochs"), F.col("_id")).cast("binary")))
    at = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") * F.col("n_buckets")
    rows = rows.withColumn("_bucket", F.shiftright(at, 32))
    # one column as the key: a partitioning by leaf must not be taken for one by bucket
    rows = rows.withColumn("_key", F.concat_ws("\x01", *names, F.col("_bucket")))
    sums = rows.groupBy("_key", *names, "_bucket").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.partitionBy(*names).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("_key", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_key").orderBy("_order", "_id", "n_tokens", "_tie").rowsBetween(Window.unboundedPreceding, 0)
    ends = rows.withColumn("_end", F.sum("n_tokens").over(inside)).join(starts, "_key")
    taken = (F.col("rest") > 0) & (F.col("_start") + F.col("_end") <= F.col("rest"))
    return ends.select("doc", *names, "n_tokens", (F.col("epochs") + F.when(taken, 1).otherwise(0)).cast("long").alias("copies"))
