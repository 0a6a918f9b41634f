import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from vellum.llm import queries
from vellum.llm.token_files import WordIds, new_folder, read_token_files, write_token_files

from .conftest import SF

PATH = P.path("word_bpe_49k.json")


def library(texts):
    t = Tokenizer.from_file(PATH)
    t.encode_special_tokens = True
    return [e.ids for e in t.encode_batch(list(texts), add_special_tokens=False)]


def test_query_equals_the_library(spark, texts):
    want, start = {}, 0
    for i, ids in zip(texts, library(texts.values())):
        ids = np.array([*ids, 1], "<u4")
        want[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    rows = queries.op1_token_files(spark, SF).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in rows} == want


def test_words_are_encoded_as_in_whole_texts():
    rng = random.Random(5)
    alphabet = "ab \n\t 　'sdtÉé́ΣσİŉẞǄ漢🙂1234.,!<|endoftext|>\x1c\x85"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 50))) for _ in range(4000)] + ["x" * 5000, "a ́b", "<|startoftext|> a"]
    got = [np.frombuffer(b, "<u2").tolist() for b in WordIds(PATH, "<u2").encode(texts)]
    assert got == library(texts)


def test_marks_after_words_and_every_latin_letter():
    """Runs of ASCII marks, with and without apostrophes, and all letters of the short path."""
    rng = random.Random(6)
    marks = "".join(chr(c) for c in range(0x21, 0x7f) if not chr(c).isalnum())
    texts = [" ".join("".join(rng.choices("abstIR", k=rng.randint(0, 3))) + "".join(rng.choices(marks, k=rng.randint(0, 4)))
                      for _ in range(8)) + rng.choice(["", " ", "\n", "\u0338", "\u0338 "]) for _ in range(6000)]
    texts += [f"x{chr(c)}y {chr(c)} {chr(c)}{chr(c)}z" for c in range(0xc0, 0x250)]
    got = [np.frombuffer(b, "<u2").tolist() for b in WordIds(PATH, "<u2").encode(texts)]
    assert got == library(texts)


def read(spark, folder):
    rows = read_token_files(spark, folder, "doc_id long, start long, n long, raw binary",
                            lambda i, s, ids: (i, s, len(ids), ids.astype("<u4").tobytes())).collect()
    return sorted((r.start, r.doc_id, np.frombuffer(bytes(r.raw), "<u4").tolist()) for r in rows)


def test_round_trip_and_edge_cases(spark, make_docs):
    docs = [(7, "one two"), (7, "a b"), (3, None), (5, ""), (None, "none"), (9, "long " * 30_000)]
    for vocab in (49408, 100_000):  # 16 and 32 bits
        folder = new_folder(spark)
        manifest = write_token_files(make_docs(docs), folder, PATH, end_id=1, vocab_size=vocab, parts=4)
        got = read(spark, folder)
        order = [(-(1 << 63), "none"), (3, ""), (5, ""), (7, "a b"), (7, "one two"), (9, "long " * 30_000)]
        ids = [[*x, 1] for x in library(t for _, t in order)]
        starts = np.cumsum([0, *map(len, ids)])[:-1].tolist()
        assert got == [(s, i, x) for s, (i, _), x in zip(starts, order, ids)]
        assert sum(r.n_ids for r in manifest.collect()) == sum(map(len, ids))


def test_empty_table(spark, make_docs):
    folder = new_folder(spark)
    assert write_token_files(make_docs([]), folder, PATH, end_id=1, vocab_size=49408).collect() == []
    assert read(spark, folder) == []


def test_special_tokens_as_by_the_plain_call(spark, make_docs):
    """Strings of special tokens in texts, against the library as it is."""
    plain = Tokenizer.from_file(PATH)
    texts = ["a <|endoftext|> b", "x<|startoftext|><|endoftext|>y", "<|ENDOFTEXT|> <|endoftext |>", "no mark", "", "A<|endoftext|>"]
    coder = WordIds(PATH, "<u2", special_tokens=True)
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [320, 49407, 321]
    assert [np.frombuffer(b, "<u2").tolist() for b in coder.encode(texts)] == want
    folder = new_folder(spark)
    write_token_files(make_docs(list(enumerate(texts))), folder, PATH, end_id=1, vocab_size=49408, parts=2, special_tokens=True)
    assert [ids for _, _, ids in read(spark, folder)] == [[*x, 1] for x in want]
