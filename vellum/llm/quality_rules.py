"""Quality rules: compression bands over whole documents and fixed chunks.

Natural text compresses within a narrow band that depends on its length: a
short text has little to repeat, a long one more. A document is rejected when
its zstandard ratio (bytes before / bytes after) leaves the band of its
length class, either way: above it is repetitive (or built from a few
templates), below it is close to incompressible (encoded or random bytes).
Fixed chunks, the last of which covers the final bytes, are held against one
band of their own, which finds a large repetitive or encoded part in a document
whose total looks normal, wherever it stands.

Base rules (word counts, symbols, duplicate lines, repeated windows) come
with the verdict. Everything looks at the whole text of one row, so the job
is a map over the scan: no shuffle, no state, and a lost task is run again.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.text import python_workers_import, row_struct

WORD_BREAKS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Bands:
    """Limits of the ratio. ``whole``: (bytes from, least, most), ascending;
    a class holds until the next one begins. ``chunk``: least and most of a
    chunk; a document is rejected when the chunks that leave them cover more
    than ``max_bad_chunks`` of its bytes, more than both ``max_bad_bytes``
    bytes and ``max_bad_long`` of it, or more than ``max_bad_run`` bytes in a
    row. The defaults were set on the labelled rows: clean
    documents lie inside with a margin of about a twelfth, and none of their
    chunks is outside."""

    level: int = 3
    whole: tuple[tuple[int, float, float], ...] = (
        (0, 0.0, 1.75), (200, 1.05, 2.00), (400, 1.15, 2.15), (800, 1.30, 2.25), (1600, 1.45, 2.35),
        (3200, 1.60, 2.45), (6400, 1.70, 2.55), (12800, 1.80, 2.62), (25600, 1.85, 2.75))
    chunk_bytes: int = 4096
    chunk: tuple[float, float] = (1.50, 2.60)
    max_bad_chunks: float = 0.25
    max_bad_bytes: int = 8192
    max_bad_long: float = 0.05
    max_bad_run: int = 16384

    def limits(self, n_bytes: int) -> tuple[float, float]:
        return next((least, most) for start, least, most in reversed(self.whole) if n_bytes >= start)

    def most_bad(self, n_bytes: int) -> float:
        return min(self.max_bad_chunks * n_bytes, max(self.max_bad_bytes, self.max_bad_long * n_bytes))


def repeat_words(words: list[bytes], window: int = 8) -> int:
    """Words inside a window of ``window`` words (a power of two) that the
    text holds at least twice, the first one included. Exact: windows get
    numbers by doubling (pairs, pairs of pairs, …), no hashes."""
    n = len(words)
    if n <= window:
        return 0
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    size, kinds = 1, len(number)
    while size < window:
        pairs = ids[:-size] * kinds + ids[size:]
        values, ids = np.unique(pairs, return_inverse=True)
        size, kinds = 2 * size, len(values)
    again = np.bincount(ids)[ids] > 1
    edges = np.zeros(n + 1, np.int64)
    edges[:len(again)] += again
    edges[window:] -= again
    return int((np.cumsum(edges[:n]) > 0).sum())


def compression(raw: bytes, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple[float, int, int, int, int]:
    """(whole ratio, chunks, chunks outside their band, bytes that those
    cover, the most of these in a row). The last chunk covers the final bytes,
    so it may overlap the one before it; a text below a chunk has none."""
    if not raw:
        return 0.0, 0, 0, 0, 0
    ratio = len(raw) / len(packer.compress(raw))
    size, (least, most) = bands.chunk_bytes, bands.chunk
    starts = [k * size for k in range(len(raw) // size)]
    if starts and len(raw) % size:
        starts.append(len(raw) - size)
    bad = covered = longest = run = end = 0
    for start in starts:
        if least <= size / len(packer.compress(raw[start:start + size])) <= most:
            continue
        new = start + size - max(start, end)
        run = run + new if start <= end and bad else new
        bad, covered, longest, end = bad + 1, covered + new, max(longest, run), start + size
    return ratio, len(starts), bad, covered, longest


def text_stats(text: str | None, bands: Bands, packer: zstandard.ZstdCompressor) -> tuple:
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at the ASCII white space only
    lines = [x for x in text.split("\n") if x.strip(WORD_BREAKS)]
    n_repeat = repeat_words(words)
    failed = len(words) < 20 or 100 * n_repeat > 30 * len(words)
    ratio, chunks, bad, bad_bytes, bad_run = compression(raw, bands, packer)
    least, most = bands.limits(len(raw))
    in_band = bool(raw) and least <= ratio <= most and bad_bytes <= bands.most_bad(len(raw)) and bad_run <= bands.max_bad_run
    return (len(words), len(text) - sum(map(text.count, WORD_BREAKS)) if words else 0, sum(map(text.count, SYMBOLS)),
            len(lines) - len(set(lines)), n_repeat, failed, ratio, chunks, bad, in_band, in_band and not failed)


_FIELDS = (("n_words", "long"), ("word_chars", "long"), ("n_symbols", "long"), ("n_dup_lines", "long"),
           ("n_repeat_words", "long"), ("base_failed", "boolean"), ("whole_ratio", "double"), ("n_chunks", "long"),
           ("n_bad_chunks", "long"), ("in_band", "boolean"), ("kept", "boolean"))


def quality_rules(docs: DataFrame, text_col: str = "text", bands: Bands = Bands()) -> DataFrame:
    """One row per input row: ``doc`` (the input row as a struct) and
    ``quality`` (struct: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, whole_ratio, n_chunks, n_bad_chunks, in_band,
    kept).

    Edge cases: a NULL text counts as empty and is not kept; a text of white
    space has no word and fails the base rules; repeated rows get equal
    verdicts; an empty table gives an empty result.
    """
    python_workers_import(docs.sparkSession)
    names = [n for n, _ in _FIELDS]

    @F.pandas_udf(", ".join(f"{n} {t}" for n, t in _FIELDS))
    def stats(texts: pd.Series) -> pd.DataFrame:
        packer = zstandard.ZstdCompressor(level=bands.level)
        return pd.DataFrame([text_stats(t, bands, packer) for t in texts], columns=names)

    return docs.select(row_struct(docs).alias("doc"), stats(F.col(text_col)).alias("quality"))
