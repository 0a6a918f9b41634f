import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from vellum.llm import queries
from vellum.llm.byte_bpe import ByteBpe, Kept, coder, compiled_pattern, encode_decode, load_ranks

from .conftest import SF

PATH = P.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=load_ranks(PATH), special_tokens={})


def test_query_equals_the_library(spark, texts, library):
    want = {}
    for i, t in texts.items():
        ids = library.encode_ordinary(t)
        want[i] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
    rows = queries.op8_byte_bpe(spark, SF).collect()
    assert {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows} == want


@pytest.mark.parametrize("seed", range(8))
def test_random_texts(library, seed):
    rng, bpe = random.Random(seed), coder(PATH, P.PATTERN)
    alphabet = "ab \n\t 　'sdtrel1٣²é漢字🙂_-.\x1c\x85​,<|endoftext|>"
    for _ in range(600):
        text = "".join(rng.choices(alphabet, k=rng.randint(0, 60)))
        ids = bpe.encode(text)
        assert ids == library.encode_ordinary(text) and bpe.decode(ids) == text.encode()


@pytest.mark.parametrize("text", ["a" * 20_000, "ab" * 9_000, " " * 9_000, " \n" * 5_000, "'" * 999, "=-" * 4_000, "é" * 5_000])
def test_long_pieces(library, text):
    assert coder(PATH, P.PATTERN).encode(text) == library.encode_ordinary(text)


def test_pieces_without_the_table(library):
    """Every step back is the library's merge, piece by piece."""
    rng, bpe = random.Random(1), coder(PATH, P.PATTERN)
    for _ in range(3000):
        piece = "".join(rng.choices("etaoinshrdlu", k=rng.randint(1, 25)))
        assert list(bpe.encode_piece(piece.encode())) == library.encode_ordinary(piece)


def test_edge_cases(make_docs):
    rows = encode_decode(make_docs([(1, None), (2, ""), (2, ""), (3, "hi  there")]), PATH, P.PATTERN, with_ids=True)
    got = {r.doc_id: r for r in rows.select("doc.doc_id", "doc.tokens", "bpe.*").collect()}
    assert got[1].n_tokens == 0 and got[1].ids == [] and got[1].ids_sha256 == hashlib.sha256(b"").hexdigest()
    assert bytes(got[3].decoded) == b"hi  there" and got[3].tokens == -1
    assert encode_decode(make_docs([]), PATH, P.PATTERN).collect() == []


def test_time_is_linear_in_a_piece(library):
    """One run of letters, whose longest matches don't fit together; each size starts with empty tables."""
    import time
    letters = "".join(random.Random(5).choices("abcdefghijklmnopqrstuvwxyz", k=400_000))
    took = {}
    for n in (200_000, 400_000):
        bpe = ByteBpe(load_ranks(PATH), P.PATTERN)
        start = time.process_time()
        ids = bpe.encode_piece(letters[:n].encode())
        took[n] = time.process_time() - start
        assert bpe.decode(list(ids)) == letters[:n].encode()
    assert took[400_000] <= 2.5 * took[200_000]
    assert bpe.encode(letters[:50_000]) == library.encode_ordinary(letters[:50_000])


def test_a_new_word_costs_its_own_work_only(monkeypatch):
    """The known words around it are looked up as in a text without it."""
    bpe, slow = ByteBpe(load_ranks(PATH), P.PATTERN), []
    part = ByteBpe._part
    monkeypatch.setattr(ByteBpe, "_part", lambda self, *a: slow.append(a) or part(self, *a))
    known = "the quick, brown fox é 3.5 don't " * 50 + "end"
    bpe.spans(known), bpe.encode(known)
    text = known.replace("end", "qzorblatt, of\nthe end")
    assert bpe.spans(text) == [(m.end() - m.start(), bpe.count(m.group())) for m in bpe.pattern.finditer(text)]
    assert bpe.decode(bpe.encode(text)) == text.encode() and not slow
    assert bpe.spans("a  b " + text)[-1] == (4, 1) and slow  # two spaces: part by part


def test_a_full_table_keeps_what_is_asked_for():
    made = []
    table = Kept(lambda key: made.append(key) or key.upper(), 20)
    for i in range(500):
        assert table["often"] == "OFTEN" and table[f"once {i}"] == f"ONCE {i}" and len(table) + len(table.aside) <= 20
    assert made.count("often") == 1 and table["x" * 65] == "X" * 65 and "x" * 65 not in table


@pytest.mark.parametrize("pattern", [P.PATTERN, r"""\p{M}+|[\p{Mn}]|\p{L}+|[^\s\p{Lo}\p{M}]+|\s+"""])
def test_smaller_classes_cut_alike(pattern):
    """Characters in, over and at the ends of ASCII and the BMP."""
    rng, bpe = random.Random(2), ByteBpe(load_ranks(PATH), pattern)
    for last, alphabet in ((0x7F, "ab1 \n'sZ_,~\x7f\x1c"), (0xFFFF, "ab1 \n'é\u0301\u2028漢٣\uffff\ufb00!"),
                           (0x10FFFF, "ab1 \n'é漢𝟙𐐀🙂\U00010000\U0010ffff!")):
        for _ in range(300):
            text = "".join(rng.choices(alphabet, k=rng.randint(0, 40))) + alphabet[-2]
            assert bpe.pattern_for(text) is compiled_pattern(pattern, last) or last > 0x7F
            assert bpe.pattern_for(text).findall(text) == bpe.pattern.findall(text)
