"""Token ids as flat binary files with 64-bit document offsets.

Documents are dealt into ranges of ascending id; every range is one part with
three files in the shared folder:

* ``<part>.ids``: the token ids of its documents one after the other,
  little-endian unsigned 16-bit integers if the largest id fits, else 32-bit;
* ``<part>.offsets``: n + 1 little-endian 64-bit integers, where each document
  begins, in ids from the start of the part;
* ``<part>.docs``: n little-endian 64-bit document ids.

A manifest (Parquet) names the files of each part with its counts and its
base: the ids of all parts before it, a prefix sum over the parts (one row a
part). A document's global start is the base plus its offset. A task writes
under a name of its own attempt and the manifest only names the attempts that
Spark committed, so retries, lost executors and speculation leave the set of
files consistent. Readers map the files into memory where the folder is
mounted, and read ranges through a file system client elsewhere.
"""

from __future__ import annotations

import functools
import itertools
import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vellum.llm.text import python_workers_import
from vellum.session import work_dir

#: words that a worker keeps the ids of (a full table goes back to the first
#: ones, which are the common ones), the bytes of the longest word kept, and new
#: words encoded at a time
MAX_KEPT, FIRST_KEPT, MAX_LENGTH, AT_ONCE = 800_000, 400_000, 64, 500
#: ASCII marks between a letter and white space; they are one piece with or without a space before them
_MARK = re.compile(rb"(?<=[a-z])([!-&(-/:-@\[-`{-~]+)(?=[\x20\x09-\x0D])")
#: a run of Latin letters is one piece before and after lower-casing (U+0130 isn't)
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u017f]+").fullmatch


class WordIds:
    """The ids of whole texts by a tokenizer that drops white space and never
    joins across it, and lower-cases. With ``special_tokens`` their strings in
    a text have their own ids, as by the library's plain call; else they are
    ordinary text. The tokenizers library encodes every distinct word; the
    results are kept in a bounded table, since words repeat."""

    def __init__(self, path: str, dtype: str, special_tokens: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share out the cores
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # a word of the table is no special token
        self.library = Tokenizer.from_file(path)
        # of a lower-case run of Latin letters only its bytes' merges are left to do
        self.letters = Tokenizer(self.library.model)
        self.letters.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        # a text with the string of a special token goes to the library whole
        special = [re.escape(t.content) for t in self.library.get_added_tokens_decoder().values()] if special_tokens else []
        self.special = re.compile("|".join(special) or "(?!)").search
        self.dtype = np.dtype(dtype)
        self.kept: dict[bytes, bytes] = {}

    def _encode(self, words: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """(word, ids) of each distinct word, in some order."""
        plain, other = [], []
        for w in words:
            text = w.decode("utf-8", "surrogatepass")
            (plain if _PLAIN(text) else other).append((w, text))
        for at in range(0, len(plain), AT_ONCE):
            some = plain[at:at + AT_ONCE]
            coded = self.letters.encode(" ".join([t for _, t in some]).lower(), add_special_tokens=False)
            ids = np.array(coded.ids, self.dtype).tobytes()
            ends = np.searchsorted(np.array(coded.word_ids), np.arange(len(some)), "right") * self.dtype.itemsize
            start = 0
            for (w, _), end in zip(some, ends.tolist()):
                yield w, ids[start:end]
                start = end
        for at in range(0, len(other), AT_ONCE):
            some = other[at:at + AT_ONCE]
            for (w, _), c in zip(some, self.tokenizer.encode_batch_fast([t for _, t in some], add_special_tokens=False)):
                yield w, np.array(c.ids, self.dtype).tobytes()

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        # bytes split at ASCII white space; A-Z go first, as the tokenizer lower-cases anyway
        split = [_MARK.sub(rb" \1", t.encode("utf-8", "surrogatepass").lower()).split() for t in texts]
        found = [list(map(self.kept.get, words)) for words in split]
        new = {w for words, ids in zip(split, found) if None in ids for w, i in zip(words, ids) if i is None}
        if len(self.kept) + len(new) > MAX_KEPT:
            self.kept = dict(itertools.islice(self.kept.items(), FIRST_KEPT))
        fresh = dict(self._encode(list(new)))
        self.kept.update((w, ids) for w, ids in fresh.items() if len(w) <= MAX_LENGTH)
        for text, words, ids in zip(texts, split, found):
            if self.special(text):
                yield np.array(self.library.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()
                continue
            yield b"".join([fresh[w] if i is None else i for w, i in zip(words, ids)] if None in ids else ids)


@functools.lru_cache(1)
def _coder(path: str, dtype: str, special_tokens: bool) -> WordIds:
    """One for all tasks of a worker, so that they share its table of words."""
    return WordIds(path, dtype, special_tokens)


def _folder(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pafs.LocalFileSystem(), uri)


def _put(fs: pafs.FileSystem, path: str):
    return fs.open_output_stream(path, buffer_size=1 << 20)


_PARTS = "part int, name string, n_docs long, n_ids long"


def write_token_files(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int, vocab_size: int,
                      id_col: str = "doc_id", text_col: str = "text", parts: int | None = None,
                      special_tokens: bool = False) -> DataFrame:
    """Encode ``docs`` into ``folder`` (a URI on storage that all executors
    see) and return the manifest: part, name, n_docs, n_ids, base.

    Edge cases: a NULL text is the empty text (its only id is ``end_id``);
    rows without an id come first, with the document id -2**63; rows that
    repeat an id are documents of their own, in the order of their texts; an
    empty table writes a manifest without parts.
    """
    spark = docs.sparkSession
    python_workers_import(spark)
    dtype = "<u2" if max(vocab_size, end_id + 1) <= 1 << 16 else "<u4"
    no_id = -(1 << 63)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part, name = context.partitionId(), f"{context.partitionId():06d}-{context.taskAttemptId()}"
        fs, base = _folder(folder)
        coder, end = None, np.array([end_id], dtype).tobytes()
        offsets, ids = [0], []
        out = None
        for batch in batches:
            if out is None and len(batch):
                coder, out = _coder(tokenizer_path, dtype, special_tokens), _put(fs, f"{base}/{name}.ids")
            for at in range(0, len(batch), 128):
                some = batch.slice(at, 128)
                ids += [no_id if i is None else i for i in some.column(0).to_pylist()]
                for coded in coder.encode([t or "" for t in some.column(1).to_pylist()]):
                    out.write(coded + end)
                    offsets.append(offsets[-1] + len(coded) // len(end) + 1)
        if out is None:
            return
        out.close()
        for kind, values in (("offsets", offsets), ("docs", ids)):
            with _put(fs, f"{base}/{name}.{kind}") as file:
                file.write(np.array(values, "<i8").tobytes())
        yield pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "name": [name],
                                          "n_docs": [len(ids)], "n_ids": [offsets[-1]]})

    fs, base = _folder(folder)
    fs.create_dir(base, recursive=True)
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.col(id_col).cast("long")
    dealt = (docs.select(key.alias("id"), F.col(text_col).alias("text"))
             .repartitionByRange(n, "id").sortWithinPartitions("id", "text"))
    dealt.mapInArrow(write, _PARTS).write.mode("overwrite").parquet(f"{folder}/parts")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    (spark.read.schema(_PARTS).parquet(f"{folder}/parts")
     .select("*", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("base"))
     .write.mode("overwrite").parquet(f"{folder}/manifest"))
    with _put(fs, f"{base}/format.json") as file:
        file.write(json.dumps({"ids": dtype, "offsets": "<i8", "docs": "<i8", "end_id": end_id}).encode())
    return spark.read.parquet(f"{folder}/manifest")


def _map(fs: pafs.FileSystem, path: str, dtype: str) -> np.ndarray:
    if isinstance(fs, pafs.LocalFileSystem):
        return np.memmap(path, dtype, "r")
    with fs.open_input_file(path) as file:  # a store without memory mapping
        return np.frombuffer(file.read(), dtype)


def read_token_files(spark: SparkSession, folder: str, columns: str, row) -> DataFrame:
    """One row per document: ``row(doc_id, start, ids)`` with ``ids`` a view of
    the mapped file. ``columns`` is the schema of the rows."""
    fs, base = _folder(folder)
    with fs.open_input_file(f"{base}/format.json") as file:
        dtype = json.loads(file.read())["ids"]
    names = [c.split()[0] for c in columns.split(", ")]
    kinds = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}[c.split()[1]])
                       for n, c in zip(names, columns.split(", "))])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _folder(folder)
        for batch in batches:
            for part in batch.to_pylist():
                path = f"{base}/{part['name']}"
                ids, docs = _map(fs, f"{path}.ids", dtype), _map(fs, f"{path}.docs", "<i8")
                offsets = _map(fs, f"{path}.offsets", "<i8")
                for at in range(0, len(docs), 4096):
                    rows = [row(int(docs[i]), part["base"] + int(offsets[i]), ids[offsets[i]:offsets[i + 1]])
                            for i in range(at, min(at + 4096, len(docs)))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds.types)], schema=kinds)

    manifest = spark.read.parquet(f"{folder}/manifest")
    return manifest.repartition(max(1, manifest.count())).mapInArrow(read, columns)


def digest_row(doc_id: int, start: int, ids: np.ndarray) -> tuple[int, int, int, int]:
    """doc_id, start, number of ids, crc32 of the ids as 32-bit integers."""
    return doc_id, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())


def new_folder(spark: SparkSession) -> str:
    """A new folder for token files in the shared checkpoint folder."""
    return work_dir(spark, f"llm-tokens-{uuid.uuid4().hex[:12]}")
