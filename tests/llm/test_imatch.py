import hashlib
import math
import random
from collections import Counter

import regex
import xxhash

from vellum.llm import queries
from vellum.llm.imatch import Settings, fingerprint_edits

from .conftest import SF


def brute(docs):
    """[(id, n_chars, edited sha256)] of rows sorted by id."""
    out = []
    for k, (i, t) in enumerate(docs):
        after, n = docs[(k + 1) % len(docs)][1], len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[:len(t) - n] + after[:n]).encode()).hexdigest()))
    return out


def test_query_edits_and_separation(spark, texts):
    rows = queries.op9_imatch(spark, SF).collect()
    assert sorted((r.doc_id, r.n_chars, r.edited_sha256) for r in rows) == brute(list(texts.items()))
    by_text = {}
    for r in rows:
        assert by_text.setdefault(texts[r.doc_id], r.fingerprint) == r.fingerprint
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    closer = sum(r.near_edited > r.near_next for r in rows)
    assert closer > 0.9 * len(rows)


def words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choices("abcdefgh", k=2)) for _ in range(n))


def test_edge_cases(make_docs):
    long = words(3, 50_000)
    docs = [(4, words(1, 80)), (2, words(2, 90)), (2, words(2, 90)), (9, words(1, 80)), (7, None), (6, ""), (8, long), (None, "déjà vu é")]
    rows = {r.id: r for r in fingerprint_edits(make_docs(docs), settings=Settings(least_share=0.0, most_share=1.0)).collect()}
    assert rows.keys() == {None, 2, 4, 6, 7, 8, 9}
    assert rows[4].fingerprint == rows[9].fingerprint and rows[6].fingerprint == rows[7].fingerprint and rows[6].near_next == 1.0
    order = [(None, "déjà vu é"), (2, words(2, 90)), (4, words(1, 80)), (6, ""), (7, ""), (8, long), (9, words(1, 80))]
    assert [(i, rows[i].n_chars, rows[i].edited_sha256) for i, _ in order] == brute(order)
    assert rows[9].near_edited > rows[9].near_next


def test_one_document_and_none(make_docs):
    row = fingerprint_edits(make_docs([(1, "one two three four")])).first()
    assert row.near_next == 1.0 and row.n_chars == 18
    assert fingerprint_edits(make_docs([])).collect() == []


def xx(seed, *values):
    """The chained 64-bit hash of longs, ints and strings, as a signed number."""
    for v in values:
        raw = v.encode() if isinstance(v, str) else v[0].to_bytes(v[1], "little", signed=True)
        seed = xxhash.xxh64_intdigest(raw, seed)
    return seed - (1 << 64) if seed >> 63 else seed


def brute_fingerprints(docs, s):
    """id → (fingerprint, edited fingerprint, near_edited, near_next) of rows
    in order, with the lexicon made from all their texts."""
    seed = 42
    terms = lambda t: {w for w in regex.split(r"[^\p{L}\p{N}]+", t.lower()) if w}
    hashed = lambda t: {xx(seed, w) for w in terms(t)}
    df = Counter(h for _, t in docs for h in hashed(t))
    unsigned = lambda x: x % (1 << 64)
    members = {}
    for h, n in df.items():
        if n >= s.least_docs and s.least_share * len(docs) <= n <= s.most_share * len(docs):
            members[h] = [k for k in range(s.slots)
                          if xx(unsigned(xx(seed, (31, 4))), (k, 4), (h, 8)) % s.densities[k // s.per_density] == 0]

    def slots(t):
        held = {}
        for h in sorted(hashed(t)):
            for k in members.get(h, ()):
                held.setdefault(k, []).append((h, 8))
        return {k: unsigned(xx(seed, *v)) % (1 << 56) for k, v in held.items()}

    def text(x, t):
        return ".".join(f"{k}:{x[k]:x}" for k in sorted(x)) or "text:" + hashlib.sha256(t.encode()).hexdigest()

    def near(a, b, ta, tb):
        either = a.keys() | b.keys()
        return sum(a.get(k) == b.get(k) for k in either) / len(either) if either else float(ta == tb)

    own, out = [slots(t) for _, t in docs], {}
    for k, (i, t) in enumerate(docs):
        j, n = (k + 1) % len(docs), len(t) // 4
        edit = t[:len(t) - n] + docs[j][1][:n]
        other, print_ = slots(edit), text(own[k], t)
        out[i] = (print_, text(other, edit), near(own[k], other, print_, text(other, edit)),
                  near(own[k], own[j], print_, text(own[j], docs[j][1])))
    return out


def test_fingerprints_by_brute_force(spark, texts):
    rows = queries.op9_imatch(spark, SF).collect()
    want = brute_fingerprints(list(texts.items()), Settings())
    assert len(rows) == len(want)
    for r in rows:
        fingerprint, edited, near_edited, near_next = want[r.doc_id]
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint, edited)
        assert math.isclose(r.near_edited, near_edited) and math.isclose(r.near_next, near_next)


def test_many_texts_of_one_id(make_docs):
    """Rows that share an id, or have none, spread over the ranges."""
    docs = [(None, words(k, 12)) for k in range(60)] + [(5, words(100 + k, 12)) for k in range(60)] + [(6, words(7, 12))] * 40
    rows = fingerprint_edits(make_docs(docs)).collect()
    key = lambda i, t: (-(1 << 63) if i is None else i, xx(42, t))
    assert sorted((key(r.id, "")[0], r.edited_sha256) for r in rows) == sorted(
        (key(i, "")[0], e) for i, _, e in brute(sorted(set(docs), key=lambda d: key(*d))))


def test_whole_texts_are_shuffled_once(spark):
    plan = queries.op9_imatch(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_plan_has_no_python(spark):
    plan = queries.op9_imatch(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
