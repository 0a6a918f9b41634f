"""Token counts that follow edits: a segment tree of pre-tokens per document.

A document's text is cut into pre-tokens by the tokenizer's pattern; each has
a length (code points) and a token count. Runs of pre-tokens are the leaves of
a segment tree whose nodes hold the sums of lengths and of tokens below them.

An edit (position, number of code points deleted, text inserted) finds its
leaf by the sums on the way down, cuts again from a pre-token that can't have
seen the edit, and stops at the first cut that falls on an old one behind the
edit: from there on the pattern reads the same characters, so everything after
it stands. Only the pre-tokens between are encoded, and only the nodes above
the leaves they lie in are summed again. A leaf that grows far over its size
leads to a new tree over the same pre-tokens (no text is encoded for it).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vellum.llm.byte_bpe import ByteBpe, coder
from vellum.llm.text import python_workers_import, row_struct, whole_text

#: pre-tokens of a new leaf; a leaf of four times as many leads to a new tree
LEAF = 32
#: a match is decided by its own characters and at most so many after it
LOOK_AHEAD = 2

Span = tuple[int, int]  # length, tokens


class SegmentTree:
    """Leaves of pre-tokens under binary nodes of (length, tokens)."""

    def __init__(self, spans: Sequence[Span]):
        self.touched = 0
        self._build([list(spans[i:i + LEAF]) for i in range(0, len(spans), LEAF)] or [[]])

    def _build(self, leaves: list[list[Span]]) -> None:
        self.leaves = leaves
        self.size = 1 << max(0, (len(leaves) - 1).bit_length())
        self.nodes: list[Span] = [(0, 0)] * (2 * self.size)
        for i in range(len(leaves)):
            self.nodes[self.size + i] = self._sum(i)
        for i in range(self.size - 1, 0, -1):
            self.nodes[i] = self._under(i)

    def _sum(self, leaf: int) -> Span:
        length = tokens = 0
        for x, t in self.leaves[leaf]:
            length += x
            tokens += t
        return length, tokens

    def _under(self, i: int) -> Span:
        (a, s), (b, t) = self.nodes[2 * i], self.nodes[2 * i + 1]
        return a + b, s + t

    @property
    def length(self) -> int:
        return self.nodes[1][0]

    @property
    def tokens(self) -> int:
        return self.nodes[1][1]

    def find(self, at: int) -> tuple[int, int, int]:
        """(leaf, index in it, start) of the pre-token that holds code point
        ``at``; behind the end: one past the last."""
        if at >= self.length:
            last = len(self.leaves) - 1
            return last, len(self.leaves[last]), self.length
        i, start = 1, 0
        while i < self.size:
            i *= 2
            if at >= start + self.nodes[i][0]:
                start += self.nodes[i][0]
                i += 1
        leaf = i - self.size
        for k, (n, _) in enumerate(self.leaves[leaf]):
            if at < start + n:
                return leaf, k, start
            start += n
        raise AssertionError("the sums hold")

    def back(self, leaf: int, k: int, start: int) -> tuple[int, int, int] | None:
        """The pre-token before the given place."""
        while k == 0:
            leaf -= 1
            if leaf < 0:
                return None
            k = len(self.leaves[leaf])
        return leaf, k - 1, start - self.leaves[leaf][k - 1][0]

    def replace(self, first: tuple[int, int], end: tuple[int, int], spans: list[Span]) -> None:
        """Put ``spans`` where the pre-tokens from ``first`` up to ``end``
        (leaf, index) are."""
        (a, i), (b, j) = first, end
        if a == b:
            self.leaves[a][i:j] = spans
        else:
            self.leaves[a][i:] = spans
            for leaf in range(a + 1, b):
                self.leaves[leaf] = []
            self.leaves[b][:j] = []
        if len(self.leaves[a]) > 4 * LEAF:
            flat = [s for leaf in self.leaves for s in leaf]
            self._build([flat[k:k + LEAF] for k in range(0, len(flat), LEAF)])
            return
        changed = set(range(self.size + a, self.size + b + 1))
        for i in changed:
            self.nodes[i] = self._sum(i - self.size)
        while changed and max(changed) > 1:
            changed = {i // 2 for i in changed if i > 1}
            for i in changed:
                self.nodes[i] = self._under(i)
            self.touched += len(changed)

    def spans(self) -> list[Span]:
        return [s for leaf in self.leaves for s in leaf]


def pack_tree(tree: SegmentTree) -> bytes:
    """A tree as bytes: its pre-tokens' lengths and counts, deflated. Node
    sums follow from them, and are checked against the total."""
    spans = tree.spans()
    flat = [v for s in spans for v in s]
    return zlib.compress(struct.pack(f"<qq{len(flat)}I", tree.length, tree.tokens, *flat), 1)


def unpack_tree(raw: bytes) -> SegmentTree:
    data = zlib.decompress(raw)
    length, tokens = struct.unpack_from("<qq", data)
    flat = struct.unpack_from(f"<{(len(data) - 16) // 4}I", data, 16)
    tree = SegmentTree(list(zip(flat[::2], flat[1::2])))
    if (tree.length, tree.tokens) != (length, tokens):
        raise ValueError("the tree's sums don't match its total")
    return tree


class EditedText:
    """A text with its tree; ``encoded`` counts the pre-tokens encoded."""

    def __init__(self, text: str, bpe: ByteBpe, tree: SegmentTree | None = None):
        self.text, self.bpe, self.encoded = text, bpe, 0
        if tree is None:
            spans = bpe.spans(text)
            self.encoded = len(spans)
            tree = SegmentTree(spans)
        self.tree = tree

    def edit(self, at: int, n_deleted: int, inserted: str) -> None:
        """Replace ``n_deleted`` code points from ``at`` by ``inserted``. A
        place or a number beyond the text is cut to the text."""
        at = max(0, min(at, len(self.text)))
        n_deleted = max(0, min(n_deleted, len(self.text) - at))
        if not n_deleted and not inserted:
            return
        tree = self.tree
        # the first pre-token that may have looked at the edit
        place = tree.find(at)
        while (before := tree.back(*place)) is not None and place[2] + LOOK_AHEAD > at:
            place = before
        self.text = self.text[:at] + inserted + self.text[at + n_deleted:]
        shift = len(inserted) - n_deleted
        leaf, k, start = place
        old_leaf, old_k, old_end = leaf, k, start  # old pre-tokens before this place are replaced
        spans: list[Span] = []
        here, pieces = start, self.bpe.pieces
        for m in self.bpe.pattern_for(self.text).finditer(self.text, start):
            if here >= at + len(inserted):
                # move on to the old cut at or behind this one
                while old_end + shift < here and (old_leaf, old_k) != (len(tree.leaves), 0):
                    if old_k == len(tree.leaves[old_leaf]):
                        old_leaf, old_k = old_leaf + 1, 0
                        if old_leaf == len(tree.leaves):
                            break
                        continue
                    old_end += tree.leaves[old_leaf][old_k][0]
                    old_k += 1
                if old_end + shift == here and old_end >= at + n_deleted:
                    break
            piece = m.group()
            spans.append((len(piece), len(pieces[piece])))
            here += len(piece)
        else:
            old_leaf, old_k = len(tree.leaves) - 1, len(tree.leaves[-1])
        if old_leaf == len(tree.leaves):
            old_leaf, old_k = old_leaf - 1, len(tree.leaves[-1])
        self.encoded += len(spans)
        tree.replace((leaf, k), (old_leaf, old_k), spans)


def count_trees(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``doc`` (the input row as a struct), ``n_tokens`` and ``tree`` (binary):
    the trees to keep beside the texts. A NULL text is the empty text."""
    python_workers_import(docs.sparkSession)

    @F.pandas_udf("n_tokens long, tree binary")
    def build(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = coder(ranks_path, pattern)
        for texts in batches:
            trees = [EditedText(t or "", bpe).tree for t in texts]
            yield pd.DataFrame({"n_tokens": [t.tokens for t in trees], "tree": [pack_tree(t) for t in trees]})

    built = docs.select(row_struct(docs).alias("doc"), build(F.col(text_col)).alias("b"))
    return built.select("doc", "b.n_tokens", "b.tree")


def edited_counts(docs: DataFrame, edits: Column, ranks_path: str, pattern: str, text_col: str = "text",
                  tree_col: str | None = None, with_text: bool = False) -> DataFrame:
    """One row per input row: ``doc`` (the input row as a struct) and ``count``
    (struct: n_tokens before, edited_tokens after all edits, n_pretokens of
    the edited text, n_encoded pre-tokens that the edits made anew, and with
    ``with_text`` the edited text and its tree).

    ``edits`` is an array of (at, n_deleted, inserted), applied in order;
    places count in the text as the edits before left it. With ``tree_col``
    the kept trees are used, and only edited regions are encoded at all.

    Edge cases: a NULL text or tree is the empty text's; NULL edits are none;
    an edit beyond the text is cut to it; repeated rows give equal results; an
    empty table gives an empty result.
    """
    python_workers_import(docs.sparkSession)
    fields = "n_tokens long, edited_tokens long, n_pretokens long, n_encoded long" + ", edited string, tree binary" * with_text
    tree = F.col(tree_col) if tree_col else F.lit(None).cast("binary")

    @F.pandas_udf(fields)
    def follow(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        bpe = coder(ranks_path, pattern)
        for texts, trees, changes in batches:
            rows = []
            for text, raw, edits_of in zip(texts, trees, changes):
                doc = EditedText(text or "", bpe, unpack_tree(raw) if raw is not None else None)
                before, doc.encoded = doc.tree.tokens, 0
                for e in () if edits_of is None else edits_of:
                    doc.edit(e["at"], e["n_deleted"], e["inserted"] or "")
                row = (before, doc.tree.tokens, len(doc.tree.spans()), doc.encoded)
                rows.append((*row, doc.text, pack_tree(doc.tree)) if with_text else row)
            yield pd.DataFrame(rows, columns=[f.split()[0] for f in fields.split(", ")])

    return docs.select(row_struct(docs).alias("doc"), follow(whole_text(text_col), tree, edits).alias("count"))


def sample_edits(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """Three edits of a text by its own content, at hashed places: a passage
    of up to 200 code points is inserted a second time, a stretch of up to 100
    is deleted, and a word is put in at the end of the text."""
    text = whole_text(text_col)
    n = F.char_length(text)
    place = lambda k: F.pmod(F.xxhash64(F.lit(k), F.col(id_col)), n + 1).cast("int")
    edit = lambda at, gone, new: F.struct(at.cast("int").alias("at"), F.lit(gone).cast("int").alias("n_deleted"),
                                          new.alias("inserted"))
    return F.array(edit(place(1), 0, F.substring(text, place(2) + 1, F.lit(200))),
                   edit(place(3), 100, F.lit("")),
                   edit(n + 200, 0, F.lit(" addendum.")))
