"""Secret scan: wide candidates, then a random forest against false positives.

Candidates are whatever is assigned to a credential's name, known formats of
keys, and maximal runs of key-like characters with a digit in them, cut from
whole texts with one regular expression (its matches, and the text between
them, which gives the neighbouring words). A random forest on the
candidate's length and alphabet, the transitions between its character
classes, the share of it that dictionary words cover, its path and the words
beside it tells secrets from checksums, identifiers, numbers and placeholders.

The dictionary is the corpus's own: the words in at least a given share of
all documents (a set bounded by mean distinct words / share, whatever the
corpus holds). The forest is trained on labelled findings: constructed ones of
both kinds, and a bounded sample of the corpus's candidates that known formats
or their assignment decide. Everything is DataFrame and SQL expressions; the
forest is Spark's.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.imatch import term_counts
from vellum.llm.text import whole_text, written
from vellum.session import work_dir

_KEY = r"A-Za-z0-9+/_\-"
#: a maximal run of at least 12 key characters, one of them a digit
CANDIDATE = rf"(?<![{_KEY}])(?=[A-Za-z+/_\-]*[0-9])[{_KEY}]{{12,}}={{0,2}}(?![{_KEY}])"
#: code points of the neighbouring words on either side
BESIDE = 60

# Words that speak for and against a secret (fixed values).
CREDENTIAL = r"(?i)(pass(word|wd|phrase)?|pwd|secret|token|api[_\- ]?key|access[_\- ]?key|auth|bearer|credential|private[_\- ]?key|client[_\- ]?secret)"
HARMLESS = r"(?i)\b(sha-?\d*|md5|commit|checksum|digest|etag|uuid|guid|revision|build|order|card|phone|tel|isbn|serial|id|no|version)\b"
PLACEHOLDER = r"(?i)(example|sample|dummy|placeholder|changeme|your|xxxx|test)"
TEST_PATH = r"(?i)(test|example|sample|mock|fixture|docs?/)"
#: known formats of access keys and tokens
KNOWN_FORMATS = r"^((AKIA|ASIA)[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|xox[baprs]-[A-Za-z0-9\-]{10,}|AIza[0-9A-Za-z_\-]{35})$"

# What is assigned to a credential's name. Java's look-behind takes bounded patterns; the two short ones before the long
# one leave few places to try it at.
_ASSIGNED = (r"(?<=[=:> \t\"'`])(?<=[=:>][ \t]{0,20}[\"'`]?(?i:bearer |basic )?)(?<=(?i:" + CREDENTIAL.removeprefix("(?i)")
             + r"(?:orization)?s?[0-9]{0,3}(?:[_\-][a-z0-9]{1,12})?(?:[_\-][a-z0-9]{1,12})?)[\"'\]]{0,2}[ \t]{0,20}(?::=|=>|==|[=:])[ \t]{0,20}"
             r"[\"'`]?(?i:bearer |basic )?)(?!(?i:bearer|basic) )")
#: characters that end a value if only such ones follow, or if the name of a next value does
_STOPS, _NEXT = r"'&;,<>.:)\]}", r"(?![&;,]\s{0,2}[A-Za-z_][A-Za-z0-9_ .\-]{0,30}[=:])(?!</)"
_PART = rf"[^\s\"`{_STOPS}]"
_VALUE = (r"(?:(?<=\")(?=[^\"\r\n]*[^\"\s])[^\"\r\n]{1,4000}(?=\")|(?<=')(?=[^'\r\n]*[^'\s])[^'\r\n]{1,4000}(?=')"
          rf"|(?:[{_STOPS[1:]}]{{1,8}}(?={_PART}))?{_PART}++(?:{_NEXT}[{_STOPS}]{{1,8}}{_PART}++){{0,100}})")
#: every candidate: values of a credential's name of any length and alphabet, known formats, and the runs (for Java's engine)
FOUND = rf"{_ASSIGNED}{_VALUE}|(?<![{_KEY}])(?:{KNOWN_FORMATS[1:-1]})(?![{_KEY}])|{CANDIDATE}"


@dataclass(frozen=True)
class Settings:
    """``max_labelled``: findings of the corpus used for training, those with
    the least hashes; ``constructed``: constructed findings of each template;
    ``word_share``: least share of documents that hold a dictionary word;
    ``threshold``: probability from which a candidate is kept."""

    max_labelled: int = 2000
    constructed: int = 40
    word_share: float = 0.001
    threshold: float = 0.5
    trees: int = 24
    depth: int = 7
    seed: int = 11


def candidates(docs: DataFrame, id_col: str, text_col: str, path: Column) -> DataFrame:
    """doc_id, path, n (1, 2, … in the text), candidate, before, after, gap
    (code points between the candidate before and this one)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(path.cast("string"), F.lit("")).alias("path"),
                       whole_text(text_col).alias("text")).where(F.col("text").rlike(FOUND))
    cut = rows.select("doc_id", "path", F.xxhash64("text").alias("h"),
                      F.regexp_extract_all("text", F.lit(FOUND), F.lit(0)).alias("found"),
                      F.split("text", FOUND, -1).alias("between"))
    beside = F.transform(F.col("between"), lambda t: F.struct(
        F.right(t, F.lit(BESIDE)).alias("end"), F.left(t, F.lit(BESIDE)).alias("start"), F.char_length(t).alias("n")))
    cut = cut.select("doc_id", "path", "h", "found", beside.alias("beside"))
    one = cut.select("doc_id", "path", "h", F.posexplode("found").alias("i", "candidate"), "beside")
    return one.select("doc_id", "path", "h", (F.col("i") + 1).alias("n"), "candidate",
                      F.get("beside", F.col("i"))["end"].alias("before"),
                      F.get("beside", F.col("i") + 1)["start"].alias("after"),
                      F.get("beside", F.col("i"))["n"].alias("gap"))


def _classes(candidate: Column) -> Column:
    """The candidate with each character replaced by its class: l, u, d, o."""
    out = F.regexp_replace(candidate, r"[^A-Za-z0-9]", "#")
    out = F.regexp_replace(out, r"[0-9]", "%")
    out = F.regexp_replace(out, r"[A-Z]", "u")
    out = F.regexp_replace(out, r"[a-z]", "l")
    return F.translate(out, "%#", "do")


_TRANSITIONS = [a + b for a in "ludo" for b in "ludo"]


def with_features(found: DataFrame) -> tuple[DataFrame, list[str]]:
    """The frame (candidate, before, after, path, covered) with the forest's
    features, and their names."""
    n = F.char_length("candidate")
    cls = F.col("_cls")
    chars = F.split(F.col("candidate"), "")
    share = lambda pattern: (n - F.char_length(F.regexp_replace("candidate", pattern, ""))) / n
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(F.char_length(cls) - 1, F.lit(1))), lambda i: F.substr(cls, i, F.lit(2)))
    flag = lambda c: c.cast("double")
    near = F.right(F.col("before"), F.lit(24))
    cols = {
        "f_length": n.cast("double"),
        "f_digits": share("[0-9]"), "f_upper": share("[A-Z]"), "f_vowels": share("[aeiouAEIOU]"),
        "f_hex": flag(F.col("candidate").rlike("^[0-9a-f]+$")), "f_number": flag(F.col("candidate").rlike("^[0-9]+$")),
        "f_uuid": flag(F.col("candidate").rlike(r"^[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}$")),
        "f_distinct": F.size(F.array_distinct(chars)) / n,
        "f_covered": F.col("covered").cast("double"),
        "f_known": flag(F.col("candidate").rlike(KNOWN_FORMATS)),
        "f_credential": flag(near.rlike(CREDENTIAL)), "f_harmless": flag(near.rlike(HARMLESS)),
        "f_placeholder": flag(F.concat_ws(" ", F.col("before"), F.col("candidate"), F.col("after")).rlike(PLACEHOLDER)),
        "f_assigned": flag(F.col("before").rlike(r"[=:]\s*[\"']?$")), "f_quoted": flag(F.col("before").rlike(r"[\"']$")),
        "f_in_url": flag(F.col("before").rlike(r"(https?:|www\.)\S*$|[/@?&]$")),
        "f_test_path": flag(F.col("path").rlike(TEST_PATH)),
        "f_path_depth": F.size(F.split(F.col("path"), "/")).cast("double"),
    }
    out = found.withColumn("_cls", _classes(F.col("candidate"))).withColumn("_pairs", pairs)
    for name, col in cols.items():
        out = out.withColumn(name, col)
    for pair in _TRANSITIONS:
        out = out.withColumn(f"f_{pair}", F.size(F.filter("_pairs", _is(pair))) / F.size("_pairs"))
    return out.drop("_cls", "_pairs"), [*cols, *[f"f_{p}" for p in _TRANSITIONS]]


def _is(pair: str):
    return lambda p: p == pair


def with_coverage(found: DataFrame, dictionary: DataFrame, key: list[str]) -> DataFrame:
    """Adds ``covered``: the share of the candidate inside dictionary words
    (its runs of at least three letters, lower-cased)."""
    runs = found.select(*key, F.char_length("candidate").alias("n"), F.explode(
        F.regexp_extract_all("candidate", F.lit("[A-Z]?[a-z]{2,}|[A-Z]{3,}"), F.lit(0))).alias("run"))
    hit = runs.withColumn("term", F.xxhash64(F.lower("run"))).join(dictionary, "term")
    share = hit.groupBy(*key).agg((F.sum(F.char_length("run")) / F.max("n")).alias("covered"))
    return found.join(share, key, "left").withColumn("covered", F.coalesce("covered", F.lit(0.0)))


def constructed_findings(spark: SparkSession, n: int) -> DataFrame:
    """Labelled findings of both kinds, ``n`` of each template: candidate,
    before, after, path, label."""
    i = F.col("id").cast("string")
    hexa = lambda k, size: F.substring(F.concat(F.md5(F.concat(F.lit(k), i).cast("binary")), F.md5(F.concat(i, F.lit(k)).cast("binary"))), 1, size)
    upper = lambda k, size: F.substring(F.upper(F.regexp_replace(F.base64(F.unhex(hexa(k, 64))), "[^A-Za-z0-9]", "Q")), 1, size)
    mixed = lambda k, size: F.concat(F.substring(F.regexp_replace(F.base64(F.unhex(hexa(k, 64))), "[^A-Za-z0-9]", "x"), 1, size - 1), F.lit("7"))
    digits = lambda k, size: F.substring(F.translate(hexa(k, 64), "abcdef", "314159"), 1, size)
    letters = lambda k, size: F.translate(hexa(k, size), "0123456789", "ghijklmnop")
    signs = lambda k, size: F.translate(mixed(k, size), "aGmSy4", "#!$@%&")
    word = lambda k: F.substr(F.translate(hexa(k, 16), "0123456789", "aeioulnrst"), F.lit(1), (F.col("id") % 7 + 3).cast("int"))
    h = hexa("u", 32)
    uuid = F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4), F.substring(h, 17, 4), F.substring(h, 21, 12))
    both = [  # (candidate, before, after, label)
        (hexa("a", 18), "set it as password=", " and go", 1), (hexa("b", 40), 'then token = "', '" is used', 1),
        (F.concat(F.lit("AKIA"), upper("c", 16)), "with the key ", " of the", 1), (mixed("d", 32), "api_key: ", "\n", 1),
        (mixed("e", 40), "Authorization: Bearer ", "\n", 1), (F.concat(F.lit("ghp_"), mixed("f", 36)), "clone with ", " now", 1),
        (mixed("g", 24), "client_secret='", "'", 1),
        (hexa("h", 40), "fixed in commit ", " of the", 0), (hexa("i", 64), "sha256 checksum ", " of the file", 0),
        (hexa("j", 32), "see http://host.example/img/", ".png", 0), (uuid, "with the uuid ", " in it", 0),
        (digits("k", 16), "paid by card ", " on", 0), (digits("l", 16), "the and of ", " that is", 0),
        (F.concat(F.lit("section-"), digits("m", 2), F.lit("-of-the-report")), "read ", " first", 0),
        (F.concat(F.lit("your-password-here"), digits("n", 1)), "password=", " for example", 0),
        (F.concat(F.lit("order_number_"), digits("o", 6)), "the ", " was", 0),
        (hexa("p", 10), "api_key=", " in", 1), (signs("q", 13), "password=", "\n", 1), (signs("r", 16), "token: ", " for", 1),
        (F.concat(*[F.initcap(letters(k, 6)) for k in "stvw"]), "secret = ", "\n", 1),
        (F.translate(mixed("x", 24), "0123456789", "ghijKLMNOP"), "client_secret: ", " is", 1),
        (F.translate(upper("y", 16), "0123456789", "QRSTUVWXYZ"), "password='", "'", 1),
        (F.concat(F.lit("AKIA"), F.translate(upper("z", 16), "0123456789", "QRSTUVWXYZ")), "with the key ", " of the", 1),
        (word("aa"), "password: ", " of the", 0), (word("ab"), "token = ", " and", 0), (F.initcap(word("ac")), "Secret: ", " was", 0),
        (F.concat_ws(" ", word("ad"), word("ae"), word("af"), word("ag")), 'the secret: "', '" said', 0),
    ]
    rows = F.explode(F.array(*[F.struct(c.alias("candidate"), F.lit(b).alias("before"), F.lit(a).alias("after"),
                                        F.lit("").alias("path"), F.lit(float(label)).alias("label")) for c, b, a, label in both]))
    return spark.range(n).select(rows.alias("r")).select("r.*")


def labelled_findings(found: DataFrame, s: Settings) -> DataFrame:
    """The constructed findings and a bounded sample of the corpus's own that
    are decided by a known format, an assignment of a run (with a digit, and of
    some length) to a credential's name, or by being a bare number."""
    near = F.right(F.col("before"), F.lit(24))
    secret = F.col("candidate").rlike(KNOWN_FORMATS) | (near.rlike(CREDENTIAL + r"\W{0,4}[=:]\s*[\"']?$") & ~F.col("candidate").rlike(PLACEHOLDER)
                                                        & F.col("candidate").rlike(f"^(?:{CANDIDATE})$"))
    number = F.col("candidate").rlike("^[0-9]+$")
    cols = ["candidate", "before", "after", "path"]
    own = (found.select(*cols, F.when(secret, 1.0).when(number, 0.0).alias("label")).where("label IS NOT NULL")
           .orderBy(F.xxhash64("candidate", "before"), *cols).limit(s.max_labelled))
    return constructed_findings(found.sparkSession, s.constructed).unionByName(own)


def train(labelled: DataFrame, dictionary: DataFrame, s: Settings) -> tuple[RandomForestClassificationModel, VectorAssembler]:
    """The forest, from findings: candidate, before, after, path, label (1: a
    secret)."""
    rows = written(labelled.withColumn("k", F.monotonically_increasing_id()), "labelled")
    featured, names = with_features(with_coverage(rows, dictionary, ["k"]))
    vectors = VectorAssembler(inputCols=names, outputCol="features")
    forest = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=s.trees, maxDepth=s.depth, seed=s.seed,
                                    featureSubsetStrategy="onethird")
    # the fitted model carries a summary with the session and the training rows, which must not
    # travel in tasks: the model as saved has none
    path = work_dir(labelled.sparkSession, f"llm-forest-{uuid.uuid4().hex[:12]}")
    forest.fit(vectors.transform(featured).select("features", "label")).write().save(path)
    return RandomForestClassificationModel.load(path), vectors


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: Column | None = None,
                 settings: Settings = Settings(), labelled: DataFrame | None = None) -> DataFrame:
    """One row per candidate: doc_id, n (its number in the text), start (code
    points before it), candidate, before, after, probability, kept.

    ``labelled`` replaces the training findings (candidate, before, after,
    path, label). Edge cases: a NULL or empty text has no candidate; rows that
    repeat an id and a text give their candidates once; rows without an id
    give theirs with a NULL id; an empty table gives an empty result.
    """
    s = settings
    path = F.lit("") if path is None else path
    counts, n_docs = term_counts(docs, text_col, 2)
    dictionary = written(counts.where(F.col("df") >= s.word_share * n_docs).select("term"), "dictionary")
    found = written(candidates(docs, id_col, text_col, path).dropDuplicates(["doc_id", "h", "n"]), "candidates")
    model, vectors = train(labelled if labelled is not None else labelled_findings(found, s), dictionary, s)
    key = ["doc_id", "h", "n"]
    # null ids can't be joined on: a hash of the key stands for the row
    keyed = found.withColumn("k", F.struct(F.xxhash64(*key), F.xxhash64(F.lit(7), *key)))
    featured, _ = with_features(with_coverage(keyed, dictionary, ["k"]))
    scored = model.transform(vectors.transform(featured))
    upto = Window.partitionBy("doc_id", "h").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    length = F.char_length("candidate")
    out = scored.select("doc_id", "n", (F.sum(F.col("gap") + length).over(upto) - length).cast("long").alias("start"),
                        "candidate", "before", "after", F.get(vector_to_array("probability"), F.lit(1)).alias("probability"))
    return out.withColumn("kept", F.col("probability") >= s.threshold)
