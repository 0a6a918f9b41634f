"""Byte-level BPE in linear time, with a longest-match automaton.

The vocabulary is a list of byte strings with ranks (a token's id). Bytes are
mapped to Latin-1 characters, so pyahocorasick can hold them; the automaton
gives the longest token that starts at each byte of a piece. The encoder
takes longest tokens from the left and steps back to the next shorter prefix
wherever a token can't follow the one before it. Whether token b may follow
token a is a property of the pair alone (the merges of a+b must leave the
boundary standing); the answer is memoised per pair. Each byte position is
given up at most once, so the work is linear in the piece, and the result is
the one that merging pairs by rank would give.

Texts are cut into pieces by the tokenizer's pattern first; the ids of pieces
and of space-separated parts are kept in bounded tables per Python worker,
since they repeat. A table makes what it lacks (``__missing__``), so a text
of known and new parts is looked up in one pass.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import itertools
import re
from collections.abc import Callable, Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vellum.llm.text import python_workers_import, row_struct

#: entries of each table that a worker keeps, and code points of the longest
#: string kept
MAX_KEPT = 400_000
MAX_SPANS_KEPT = 800_000  # small entries: equal spans are one object
MAX_LENGTH = 64


class NotAlone(Exception):
    """The word doesn't stand for a part of its own, or is too long to be kept."""


class Kept(dict):
    """A bounded table of what ``make`` gives for a key. Half of the entries
    are set aside when the other half is full, and those that are asked for
    again come back; the rest go at the next time."""

    def __init__(self, make: Callable, most: int = MAX_KEPT):
        self.make, self.half, self.aside = make, most // 2, {}

    def __missing__(self, key):
        made = self.aside.get(key)
        if made is None:
            made = self.make(key)
            if len(key) > MAX_LENGTH:
                return made
        if len(self) >= self.half:
            self.aside = dict(self)
            self.clear()
        self[key] = made
        return made


def load_ranks(path: str) -> dict[bytes, int]:
    """token bytes → rank, from a file of ``base64 rank`` lines."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class ByteBpe:
    """Encoder and decoder for one vocabulary."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.bytes_of = {i: b for b, i in ranks.items()}
        self.pattern = compiled_pattern(pattern)
        self.ascii_pattern, self.bmp_pattern = compiled_pattern(pattern, 0x7F), compiled_pattern(pattern, 0xFFFF)
        self.trie = ahocorasick.Automaton()
        for token, i in ranks.items():
            self.trie.add_word(token.decode("latin-1"), i)
        self.trie.make_automaton()
        self.longest = max(map(len, ranks))
        self.length_of = {i: len(b) for b, i in ranks.items()}
        # bounded tables of this worker
        self.pieces = Kept(self._encode)
        self.parts_kept = Kept(functools.partial(self._of_word, self._ids))
        self.spans_kept = Kept(functools.partial(self._of_word, self._word_spans), MAX_SPANS_KEPT)
        self.pairs = Kept(lambda pair: self._stands(*pair, 1 << 62))
        self.shared_spans: dict[tuple[int, int], tuple[int, int]] = {}  # one object for all equal spans of kept words
        # one entry per token at most
        self.parts = functools.lru_cache(None)(self._parts)
        self.shorter = functools.lru_cache(None)(self._shorter)

    # -- facts about tokens -------------------------------------------------
    def _parts(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes ``token``; None for one byte."""
        raw = self.bytes_of[token]
        if len(raw) == 1:
            return None
        # a token's own last merge joins two tokens of lower rank that are
        # themselves what their bytes encode to, with a boundary that no
        # earlier merge crosses
        for cut in range(1, len(raw)):
            left, right = self.ranks.get(raw[:cut]), self.ranks.get(raw[cut:])
            if left is not None and right is not None and max(left, right) < token and self._stands(left, right, token):
                return left, right
        return None

    def _shorter(self, token: int) -> int | None:
        """The longest token that is a proper prefix of ``token``."""
        raw = self.bytes_of[token]
        return next((self.ranks[raw[:n]] for n in range(len(raw) - 1, 0, -1) if raw[:n] in self.ranks), None)

    def _stands(self, left: int, right: int, below: int) -> bool:
        """No merge of rank under ``below`` crosses the boundary between the
        derivations of two tokens.

        The merges at the boundary are replayed backwards: the side that was
        made last (the higher rank) is taken apart, and at each step the
        tokens that touch there must not form a token that would have been
        merged before either side grew.
        """
        limit = below
        while True:
            joined = self.ranks.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < limit:
                return False
            parts_l, parts_r = self.parts(left), self.parts(right)
            if parts_l is None and parts_r is None:
                return True
            # the leftmost pair is merged first among equal ranks, so a tie
            # takes the right side apart
            if parts_l is not None and (parts_r is None or left > right):
                limit, left = min(limit, left), parts_l[1]
            else:
                limit, right = min(limit, right + 1), parts_r[0]

    # -- encoding -----------------------------------------------------------
    def encode_piece(self, raw: bytes) -> tuple[int, ...]:
        """The ids of one piece of text."""
        whole = self.ranks.get(raw)
        if whole is not None:
            return (whole,)
        piece = raw.decode("latin-1")
        # every byte is a token, so the longest matches tile the piece
        out = [token for _, token in self.trie.iter_long(piece)]
        stand = list(map(self.pairs.__getitem__, itertools.pairwise(out)))  # whether each may follow the one before
        if all(stand):
            return tuple(out)
        # up to the first that may not, they are what stepping back comes to as well
        first = stand.index(False) + 1
        return self._step_back(piece, out[:first], out[first])

    def _longest(self, piece: str, at: int) -> int:
        """The longest token that starts at byte ``at``."""
        return next(self.trie.iter_long(piece[at:at + self.longest]))[1]  # no token is longer than the look-ahead

    def _step_back(self, piece: str, out: list[int], token: int) -> tuple[int, ...]:
        """The ids of a piece that begins with ``out``, all longest matches
        that may stand, where ``token`` is the longest match behind them."""
        length_of, pairs, longest = self.length_of, self.pairs, self._longest
        closed: set[int] = set()  # no encoding goes on from these places
        at = sum(map(length_of.__getitem__, out))
        while at < len(piece):
            end = at + length_of[token]
            if end not in closed and (not out or pairs[out[-1], token]):
                out.append(token)
                at, token = end, longest(piece, end) if end < len(piece) else -1
                continue
            less = self.shorter(token)
            if less is not None:
                token = less
                continue
            if not out:
                raise ValueError("the vocabulary lacks single bytes")
            closed.add(at)
            token = out.pop()
            at -= length_of[token]
        return tuple(out)

    def _encode(self, piece: str) -> tuple[int, ...]:
        return self.encode_piece(piece.encode("utf-8", "surrogatepass"))

    def count(self, piece: str) -> int:
        """The number of tokens of one piece."""
        return len(self.pieces[piece])

    def pattern_for(self, text: str) -> re.Pattern:
        """The pattern with classes no larger than the text's characters need:
        a class ends in a list of its ranges over U+FFFF, which every
        character that is not in it would be compared with."""
        if text.isascii():
            return self.ascii_pattern
        return self.pattern if OVER_BMP.search(text) else self.bmp_pattern

    def _ids(self, text: str) -> tuple[int, ...]:
        return tuple(itertools.chain.from_iterable(map(self.pieces.__getitem__, self.pattern_for(text).findall(text))))

    def _spans(self, text: str) -> tuple[tuple[int, int], ...]:
        pieces = self.pieces
        return tuple([(len(p), len(pieces[p])) for p in self.pattern_for(text).findall(text)])

    def _word_spans(self, part: str) -> tuple[tuple[int, int], ...]:
        spans = self._spans(part)
        return tuple(map(self.shared_spans.setdefault, spans, spans))

    def encode(self, text: str) -> list[int]:
        """The ids of a whole text."""
        return self._by_parts(text, self.parts_kept, self._ids)

    def spans(self, text: str) -> list[tuple[int, int]]:
        """(code points, tokens) of each piece of a whole text."""
        return self._by_parts(text, self.spans_kept, self._spans)

    def _by_parts(self, text: str, kept: Kept, make) -> list:
        """What ``make`` gives for the pieces of a text, part by part.

        A single space between two characters that aren't white space always
        begins a piece, whatever stands around it, so the pieces of the part
        from one such space to the next depend on that part alone. These
        parts repeat, and what they give is kept.
        """
        first, *rest = text.split(" ")
        try:
            if rest and first and not first[-1].isspace():
                return [*make(first), *itertools.chain.from_iterable(map(kept.__getitem__, rest))]
        except NotAlone:
            pass
        out: list = []
        part = first
        for word in rest:
            if part and word and not part[-1].isspace() and not word[0].isspace():
                out += self._part(part, kept, make)
                part = " " + word
            else:
                part += " " + word
        out += self._part(part, kept, make)
        return out

    def _part(self, part: str, kept: Kept, make) -> tuple:
        try:
            return kept[part[1:]] if part[:1] == " " else make(part)
        except NotAlone:
            return make(part)

    def _of_word(self, make, word: str) -> tuple:
        """What ``make`` gives for a space and a word, if the word can be kept."""
        if not word or len(word) >= MAX_LENGTH or word[0].isspace() or word[-1].isspace() or " " in word:
            raise NotAlone(word)
        return make(" " + word)

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


# The Unicode White_Space property (fixed values).
UNICODE_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


#: a character outside the basic multilingual plane
OVER_BMP = re.compile("[\U00010000-\U0010ffff]")


@functools.lru_cache(None)
def category_runs(category: str) -> list[tuple[int, int]]:
    """The runs of code points of a Unicode category."""
    import sys

    import regex
    every = "".join(map(chr, (c for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)))
    runs = []
    for m in regex.finditer(rf"\p{{{category}}}+", every):
        # a run of the string may jump the surrogates: cut it there
        first, last = ord(m.group()[0]), ord(m.group()[-1])
        runs += [(first, last)] if not (first < 0xD800 <= last) else [(first, 0xD7FF), (0xE000, last)]
    return runs


def category_class(category: str, last: int = 0x10FFFF) -> str:
    """A Unicode category up to the code point ``last``, as the inside of a
    character class of ``re`` (its first run if none begins by then: a class
    can't be empty)."""
    runs = [(a, min(b, last)) for a, b in category_runs(category) if a <= last] or category_runs(category)[:1]
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in runs)


@functools.lru_cache(None)
def compiled_pattern(pattern: str, last: int = 0x10FFFF) -> re.Pattern:
    r"""A tokenizer's pattern for the ``re`` module, which scans a few times
    faster than ``regex``: \\p{..} and \\s become explicit classes. It holds
    for texts without characters over ``last``."""
    inside = False
    out = []
    for part in re.findall(r"\\p\{\w+\}|\\.|\[\^?|\]|.", pattern):
        if part.startswith("["):
            inside = True
        elif part == "]":
            inside = False
        known = {r"\s": UNICODE_SPACE, r"\S": None}
        if part.startswith(r"\p"):
            body = category_class(part[3:-1], last)
            part = body if inside else f"[{body}]"
        elif part == r"\s":
            part = known[part] if inside else f"[{UNICODE_SPACE}]"
        elif part == r"\S" and not inside:
            part = f"[^{UNICODE_SPACE}]"
        out.append(part)
    return re.compile("".join(out))


@functools.lru_cache(4)
def coder(path: str, pattern: str) -> ByteBpe:
    """The worker's coder: built once per Python process."""
    return ByteBpe(load_ranks(path), pattern)


def encode_decode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text",
                  with_ids: bool = False) -> DataFrame:
    """One row per input row: ``doc`` (the input row as a struct) and ``bpe``
    (struct: n_tokens, ids_sha256 of the decimal ids joined by one space,
    decoded_sha256 of the bytes that the ids decode to; with ``with_ids`` also
    ids and decoded).

    Edge cases: a NULL text counts as empty and has no id; repeated rows give
    equal results; an empty table gives an empty result. A map over the scan:
    no shuffle.
    """
    python_workers_import(docs.sparkSession)
    fields = "n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>, decoded binary" * with_ids

    @F.pandas_udf(fields)
    def digest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = coder(ranks_path, pattern)
        decimal = [str(i) for i in range(max(bpe.bytes_of) + 1)]
        for texts in batches:
            rows = []
            for text in texts:
                ids = bpe.encode(text or "")
                decoded = bpe.decode(ids)
                row = (len(ids), hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest(),
                       hashlib.sha256(decoded).hexdigest())
                rows.append((*row, ids, decoded) if with_ids else row)
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    return docs.select(row_struct(docs).alias("doc"), digest(F.col(text_col)).alias("bpe"))
