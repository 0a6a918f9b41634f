import random
from collections import defaultdict

import numpy as np
import pytest

from vellum.llm import fast_similarity as fs
from vellum.llm import queries
from vellum.llm.components import components
from vellum.llm.near_dedup import Settings, near_dedup

from .conftest import SF


def shingles(text):
    words = fs._LOWER[np.frombuffer((text or "").encode(), np.uint8)].tobytes().split()
    return frozenset(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(docs):
    """{id: (set size, component)} by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i in sorted(sets):
        common = defaultdict(int)
        for s in sets[i]:
            for j in holders[s]:
                common[j] += 1
            holders[s].append(i)
        for j, n in common.items():
            if 100 * n >= 85 * (len(sets[i]) + len(sets[j]) - n):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return {i: (len(sets[i]), find(i)) for i in sets}


def got(df):
    return {r.id: (r.n_shingles, r.component_id) for r in df.collect()}


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=rng.randint(2, 7))) for _ in range(n)]


def edited(rng, base, changes):
    out = list(base)
    for at in rng.sample(range(len(out)), changes):
        out[at] = "".join(rng.choices("mnopqrst", k=5))
    return out


def test_query_equals_brute_force(spark, texts):
    rows = queries.op3_near_dedup(spark, SF).collect()
    want = brute(texts.items())
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in rows)


@pytest.mark.parametrize("settings", [Settings(), Settings(block=4)])
def test_groups_of_edited_copies(make_docs, settings):
    """Groups where not every pair is linked, chains, and copies of copies."""
    rng = random.Random(4)
    docs, i = [], 0
    for _ in range(6):
        base = words(rng, rng.choice([60, 120, 300]))
        for _ in range(25):
            docs.append((i := i + 1, " ".join(edited(rng, base, rng.randint(0, max(1, len(base) // 60)))).title()))
    chain = words(rng, 200)
    for _ in range(12):  # each close to the one before it only
        chain = edited(rng, chain, 2)
        docs.append((i := i + 1, " ".join(chain)))
    for n in range(0, 9):  # tiny texts
        for _ in range(2):
            docs.append((i := i + 1, "\n".join(words(random.Random(n), n))))
    rng.shuffle(docs)
    assert got(near_dedup(make_docs(docs), settings=settings)) == brute(docs)


def test_edge_cases(make_docs):
    text = " ".join(words(random.Random(1), 30))
    long = " ".join(words(random.Random(2), 100_000))
    rows = near_dedup(make_docs([(5, text), (5, text), (3, text.upper()), (7, None), (8, ""), (9, " \n"), (None, text),
                                 (None, "alone here"), (10, long), (11, long + " end")])).collect()
    found = sorted(((r.id or 0, r.n_shingles, r.component_id or 0, r.kept) for r in rows))
    assert found == [(0, 1, 0, True), (0, 26, 3, False), (3, 26, 3, True), (5, 26, 3, False), (5, 26, 3, False), (7, 0, 7, True),
                     (8, 0, 8, True), (9, 0, 9, True), (10, 99996, 10, True), (11, 99997, 10, False)]
    assert near_dedup(make_docs([])).collect() == []


def test_components_of_long_paths_and_hubs(spark):
    edges = [(i, i + 1) for i in range(100, 160)] + [(5, i) for i in range(200, 400)] + [(400, 160), (1, 1), (2, 3), (3, 2)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 100 for i in [*range(101, 161), 400]}, **{i: 5 for i in range(200, 400)}, 3: 2}


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(200):
        u = rng.integers(0, 1 << 63, 260, dtype=np.uint64)
        a, b = np.unique(u[:230]), np.unique(u[25:])
        both = fs.common(a, b)
        s = fs.sketches([a, b], 80)
        assert not (s == fs.UNSEEN).any()
        errors.append((s[0] == s[1]).mean() - both / (len(a) + len(b) - both))
    assert abs(np.mean(errors)) < 0.01 and np.std(errors) < 0.06
    assert not (fs.sketches([np.array([7], np.uint64)], 80) == fs.UNSEEN).any()


def test_band_recall_at_the_threshold():
    rng, s, missed = np.random.default_rng(5), Settings(), 0
    for _ in range(400):
        u = rng.integers(0, 1 << 63, 200, dtype=np.uint64)  # 170 of 200 in common: 0.85
        rows = fs.bands(fs.sketches([np.unique(u[:185]), np.unique(np.concatenate((u[:170], u[185:])))], s.t), s.n_bands, s.rows)
        missed += not (rows[0] == rows[1]).any()
    assert missed == 0


def test_sketches_of_many_long_texts_take_bounded_memory(spark, make_docs):
    """500 texts of 20,000 words in one batch: the arrays at work are those of
    about a million bytes of text."""
    import tracemalloc

    import pyarrow as pa

    from vellum.llm import near_dedup as nd
    rng = random.Random(9)
    words = [f"w{k}" for k in range(5000)]
    texts = [" ".join(rng.choices(words, k=20_000)) for _ in range(20)]
    parts = list(nd._stretches(np.array([len(texts[i % 20]) for i in range(500)])))
    assert [a for a, _ in parts] == [0, *[b for _, b in parts[:-1]]] and parts[-1][1] == 500
    sign = {}
    class Frame:  # takes the function that the tasks run
        def select(self, *_):
            return self
        def mapInArrow(self, f, _):
            sign["f"] = f
    nd.signatures(Frame(), "doc_id", "text", nd.Settings())
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(500)), "text": [texts[i % 20] for i in range(500)]})
    tracemalloc.start()
    rows = sum(len(b) for b in sign["f"](iter([batch])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 500 and peak < 100e6
