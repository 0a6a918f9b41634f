import random

import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from vellum.llm import queries
from vellum.llm.byte_bpe import coder, load_ranks
from vellum.llm.edit_counts import EditedText, SegmentTree, count_trees, edited_counts, pack_tree, sample_edits, unpack_tree

from .conftest import SF

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.mark.parametrize("seed", range(6))
def test_random_edits(seed):
    rng, bpe = random.Random(seed), coder(PATH, P.PATTERN)
    some = lambda n: "".join(rng.choices("ab \n\t'sdtrel 12,.!　é", k=rng.randint(0, n)))
    for k in range(200):
        doc = EditedText(some(400), bpe)
        for _ in range(6):
            at, gone, new = rng.randint(0, len(doc.text) + 2), rng.choice([0, 1, 3, 20, 300]), some(rng.choice([0, 2, 20, 900]))
            want = doc.text[:at] + new + doc.text[at:][gone:]
            doc.edit(at, gone, new)
            spans = [(m.end() - m.start(), bpe.count(m.group())) for m in bpe.pattern.finditer(want)]
            assert doc.text == want and doc.tree.spans() == spans
            assert (doc.tree.length, doc.tree.tokens) == (len(want), sum(t for _, t in spans))
            if k % 4 == 0:
                doc.tree = unpack_tree(pack_tree(doc.tree))


def test_only_the_edited_region_is_encoded():
    bpe = coder(PATH, P.PATTERN)
    doc = EditedText("some words in a row, " * 20_000, bpe)
    doc.encoded = doc.tree.touched = 0
    doc.edit(200_003, 4, "more")
    assert doc.encoded <= 6 and doc.tree.touched <= 2 * 20


def test_sums_of_an_empty_tree():
    assert (SegmentTree([]).length, unpack_tree(pack_tree(SegmentTree([]))).tokens) == (0, 0)


def apply(text, edits):
    for e in edits:
        at = min(e["at"], len(text))
        text = text[:at] + e["inserted"] + text[at + e["n_deleted"]:]
    return text


def test_query_equals_encoding_the_edited_texts(spark, texts):
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})
    edits = {r.doc_id: r.e for r in queries.table(spark, SF, "documents").select("doc_id", sample_edits().alias("e")).collect()}
    for r in queries.op7_edit_counts(spark, SF).collect():
        text = texts[r.doc_id]
        assert r.n_tokens == len(library.encode_ordinary(text))
        assert r.edited_tokens == len(library.encode_ordinary(apply(text, edits[r.doc_id])))
        assert r.n_encoded <= 3 * 260


def test_kept_trees_and_edge_cases(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "a few words"), (3, "a few words"), (4, "x" * 100_000)])
    kept = count_trees(docs, PATH, P.PATTERN).select("doc.doc_id", "doc.text", "tree", F.col("doc.kept").alias("n_tokens"))
    edit = F.array(F.struct(F.lit(5).alias("at"), F.lit(1).alias("n_deleted"), F.lit("new ").alias("inserted")))
    for tree_col in (None, "tree"):
        rows = edited_counts(kept, edit, PATH, P.PATTERN, tree_col=tree_col, with_text=True).select("doc.doc_id", "doc.n_tokens", "count.*").collect()
        got = {r[0]: r for r in rows}
        assert got[1].edited == got[2].edited == "new " and got[3].edited == "a fewnew words" and got[1][1] == "x"
        assert all(unpack_tree(bytes(r.tree)).tokens == r.edited_tokens for r in rows)
    none = edited_counts(docs, F.lit(None).cast("array<struct<at:int,n_deleted:int,inserted:string>>"), PATH, P.PATTERN)
    rows = none.select("count.*").collect()
    assert len(rows) == 5 and all(r.n_tokens == r.edited_tokens and r.n_encoded == 0 for r in rows)
    assert edited_counts(make_docs([]), edit, PATH, P.PATTERN).collect() == []
