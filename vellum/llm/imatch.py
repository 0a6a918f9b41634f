"""I-Match fingerprints with randomised lexicons, in built-in expressions.

Document frequencies are counted over the whole corpus (distinct terms per
document, hashed to 64 bits, one aggregation). The lexicon keeps the terms
whose inverse document frequency lies in a band. The lower bound on the
document frequency is a share of all documents, so the lexicon's size is
bounded whatever the corpus holds: the frequencies add up to (documents x
distinct terms of a document), hence there are at most (mean distinct terms /
least share) terms above it. That bound is proven, and is why the lexicon may
be broadcast; every document's terms meet it where they are, unshuffled.

A fingerprint has one slot for each of several random subsets of the lexicon:
a slot holds the hash of the document's sorted distinct terms in that subset.
Subsets come in several densities, since a dense one changes with any edit of
a long text and a sparse one holds nothing of a short text. The likeness of
two fingerprints is the share of equal slots among those that either fills. A
text without a term in any subset is fingerprinted by its bytes instead.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vellum.llm.text import whole_text, written
from vellum.operators.numbering import number_rows


@dataclass(frozen=True)
class Settings:
    """``least_share``, ``most_share``: the band, as shares of all documents
    that hold the term (idf from -log(most) to -log(least)); ``least_docs``:
    documents at least; ``densities``: subsets of one term in so many;
    ``per_density``: subsets of each density."""

    least_share: float = 0.002
    most_share: float = 0.25
    least_docs: int = 2
    densities: tuple[int, ...] = (24, 96, 384)
    per_density: int = 16

    @property
    def slots(self) -> int:
        return len(self.densities) * self.per_density


def terms(text: Column) -> Column:
    """The distinct terms of a text, as 64-bit hashes: runs of letters and
    digits, lower-cased."""
    words = F.array_distinct(F.split(F.lower(text), r"[^\p{L}\p{N}]+"))
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def term_counts(docs: DataFrame, text_col: str, least_docs: int) -> tuple[DataFrame, int]:
    """(term, df) of the terms in at least ``least_docs`` documents, and the
    number of documents."""
    # a null term stands for "any document": it counts them in the same pass
    any_document = F.array(F.lit(None).cast("long"))
    counted = docs.select(F.explode(F.concat(any_document, terms(whole_text(text_col)))).alias("term"))
    counts = written(counted.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
                     .where((F.col("df") >= least_docs) | F.col("term").isNull()), "term-counts")
    n_docs = counts.where("term IS NULL").agg(F.max("df")).first()[0] or 0
    return counts.where("term IS NOT NULL"), n_docs


def lexicon(docs: DataFrame, text_col: str, s: Settings) -> DataFrame:
    """(term, slots): the terms inside the band and the random subsets that
    hold each of them."""
    counts, n_docs = term_counts(docs, text_col, s.least_docs)
    inside = counts.where(F.col("df").between(s.least_share * n_docs, s.most_share * n_docs))
    member = F.filter(F.transform(F.sequence(F.lit(0), F.lit(s.slots - 1)), lambda k: F.when(
        F.pmod(F.xxhash64(F.lit(31), k, F.col("term")), F.get(F.array(*[F.lit(d) for d in s.densities]),
                                                             (k / s.per_density).cast("int"))) == 0, k)),
        lambda k: k.isNotNull())
    return written(inside.select("term", member.alias("slots")).where(F.size("slots") > 0), "lexicon")


#: the term that every document holds, with the subset that holds it alone
ANY_DOCUMENT, NO_SUBSET = 0, -1
#: a filled slot as one long: its number above so many bits of its hash
BITS = 56
LOW = (1 << BITS) - 1


def slot_values(rows: DataFrame, key: list[str], texts: dict[str, str], carried: list[str], words: DataFrame) -> DataFrame:
    """key…, carried…, and for each name in ``texts`` (name: text column) an
    array ``name`` of the filled slots in order: one long each, the slot above
    56 bits of the hash of its terms.

    ``rows`` has unique keys. If it is partitioned by the key, nothing is
    shuffled: the terms are exploded, meet the broadcast lexicon and are
    grouped again in the same task.
    """
    none = F.lit(None)
    kinds = dict(rows.dtypes)
    own = F.struct(F.lit(-1).alias("side"), F.lit(ANY_DOCUMENT).cast("long").alias("term"), *[F.col(c) for c in carried])

    def side(number: int, col: str) -> Column:
        return F.transform(terms(F.col(col)), lambda t: F.struct(
            F.lit(number).alias("side"), t.alias("term"), *[none.cast(kinds[c]).alias(c) for c in carried]))

    sides = [side(i, col) for i, col in enumerate(texts.values())]
    one = rows.select(*key, F.explode(F.concat(F.array(own), *sides)).alias("e")).select(*key, "e.*")
    always = words.sparkSession.range(1).select(F.lit(ANY_DOCUMENT).cast("long").alias("term"),
                                                F.array(F.lit(NO_SUBSET)).alias("slots"))
    held = (one.join(F.broadcast(words.unionByName(always)), "term")
            .select(*key, "side", "term", *carried, F.explode("slots").alias("slot"))
            .where((F.col("side") < 0) == (F.col("slot") == NO_SUBSET)))
    slots = held.groupBy(*key, "side", "slot").agg(F.xxhash64(F.sort_array(F.collect_list("term"))).alias("value"),
                                                   *[F.any_value(c).alias(c) for c in carried])
    filled = F.shiftleft(F.col("slot").cast("long"), BITS).bitwiseOR(F.col("value").bitwiseAND(F.lit(LOW)))
    return slots.groupBy(*key).agg(
        *[F.max(c).alias(c) for c in carried],
        *[F.sort_array(F.collect_list(F.when(F.col("side") == i, filled))).alias(name) for i, name in enumerate(texts)])


def fingerprint_text(slots: Column, digest: Column) -> Column:
    """The fingerprint as text: slot:hash of each filled slot, or the digest
    of a text that fills none."""
    filled = F.array_join(F.transform(slots, lambda x: F.concat(
        F.shiftright(x, BITS).cast("string"), F.lit(":"), F.lower(F.hex(x.bitwiseAND(F.lit(LOW)))))), ".")
    return F.when(F.size(slots) == 0, F.concat(F.lit("text:"), digest)).otherwise(filled)


def likeness(a: Column, b: Column, a_text: Column, b_text: Column) -> Column:
    """0 to 1: equal slots among those that either fingerprint fills; without
    any, whether the fingerprints as text are equal."""
    slot = lambda x: F.transform(x, lambda e: F.shiftright(e, BITS))
    either = F.size(F.array_union(slot(a), slot(b)))
    return (F.when(either == 0, (a_text == b_text).cast("double"))
            .otherwise(F.size(F.array_intersect(a, b)).cast("double") / either))


NO_ID = -(1 << 63)
#: ranges of rows for each shuffle partition; more of them even out what one partition gets
RANGES = 4


def dealt(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The distinct (id, text) rows in ranges of ascending (id, h), h a hash
    of the text: part, guest, id, h, text.

    The first row of each range also stands in the range before as its guest
    (that of the first range in the last one), so every other row has its next
    one in its own range. Ranges hold equally many rows whatever the ids are;
    their first rows are found on ids and hashes alone, and those few (one a
    range) are all that the driver sees.
    """
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("id"), whole_text(text_col).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    counted = rows.groupBy("id", "h").agg(F.count(F.lit(1)).alias("copies"))
    numbered = written(number_rows(counted, [F.col("id"), F.col("h")], "rn"), "numbered")
    n, most = numbered.agg(F.count(F.lit(1)), F.max("copies")).first()
    if (most or 1) > 1:  # repeated rows fold in the tasks that read them, before they are dealt
        rows = rows.dropDuplicates(["id", "h"])
    size = max(1, -(-n // (RANGES * int(spark.conf.get("spark.sql.shuffle.partitions")))))
    firsts = numbered.where((F.col("rn") - 1) % size == 0).orderBy("rn").select("id", "h").collect() or [(NO_ID, 0)]
    begins = F.array(*[F.struct(F.lit(i).cast("long").alias("id"), F.lit(h).cast("long").alias("h")) for i, h in firsts])
    own = F.struct("id", "h")
    part = F.size(F.filter(begins, lambda b: b <= own))
    rows = rows.select("id", "h", "text", part.alias("part"))
    before = F.when(F.col("part") == 1, F.lit(len(firsts))).otherwise(F.col("part") - 1)
    place = lambda at, guest: F.array(F.struct(at.alias("part"), F.lit(guest).alias("guest")))
    places = F.when(F.get(begins, F.col("part") - 1) == own, F.concat(place(F.col("part"), False), place(before, True))
                    ).otherwise(place(F.col("part"), False))
    return rows.select(F.explode(places).alias("at"), "id", "h", "text").select("at.part", "at.guest", "id", "h", "text")


def fingerprint_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      settings: Settings = Settings()) -> DataFrame:
    """One row per distinct (id, text): id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has the last floor(n_chars / 4) code points replaced by
    the first as many of the next row by id (after the last row: the first).
    Whole texts are shuffled once, into ranges of rows; edits, slots and the
    comparison with the next row follow in the same tasks.

    Edge cases: a NULL text counts as empty; rows that repeat an id and a text
    are one row, rows that share an id only are documents in the order of a
    hash of their texts; a row without an id comes first and keeps its NULL
    id; the only document is its own next one; an empty table gives an empty
    result.
    """
    words = lexicon(docs, text_col, settings)
    in_order = Window.partitionBy("part").orderBy("guest", "id", "h")
    piece = F.expr("cast(n_chars div 4 as int)")
    edited = F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - piece),
                      F.substring("next_text", F.lit(1), piece))
    rows = (dealt(docs, id_col, text_col).withColumn("next_text", F.lead("text").over(in_order))
            .withColumn("n_chars", F.char_length("text").cast("long")).withColumn("edited", F.coalesce(edited, F.lit(""))))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    key = ["part", "guest", "id", "h"]
    rows = rows.select(*key, "text", "edited", "n_chars", sha("text").alias("sha"), sha("edited").alias("edited_sha256"))
    done = slot_values(rows, key, {"own": "text", "other": "edited"}, ["n_chars", "sha", "edited_sha256"], words)
    done = (done.withColumn("next_own", F.lead("own").over(in_order)).withColumn("next_sha", F.lead("sha").over(in_order))
            .where(~F.col("guest")))
    own = fingerprint_text(F.col("own"), F.col("sha"))
    other = fingerprint_text(F.col("other"), F.col("edited_sha256"))
    coming = fingerprint_text(F.col("next_own"), F.col("next_sha"))
    return done.select(
        F.nullif("id", F.lit(NO_ID)).alias("id"), "n_chars", "edited_sha256", own.alias("fingerprint"),
        other.alias("edited_fingerprint"), likeness(F.col("own"), F.col("other"), own, other).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own"), own, coming).alias("near_next"))
