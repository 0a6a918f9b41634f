import hashlib
from collections import defaultdict

from vellum.llm import queries
from vellum.llm.line_dedup import dedup_lines

from .conftest import SF

LINE = "A line that is long enough to count"
WS = "\t\n\x0b\x0c\r "
LOWER = str.maketrans({c: c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"})


def brute(docs):
    """{doc_id: (lines, dropped, text)} of unique ids."""
    holders = defaultdict(set)
    for i, t in docs.items():
        for line in t.split("\n"):
            holders[line.strip(WS).translate(LOWER)].add(i)
    out = {}
    for i, t in docs.items():
        lines = t.split("\n")
        kept = [x for x in lines if not (len(k := x.strip(WS).translate(LOWER)) >= 20 and len(holders[k]) >= 3
                                         and i != max(holders[k]))]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out


def test_query_equals_brute_force(spark, texts):
    rows = queries.op6_line_dedup(spark, SF).collect()
    want = {i: (n, d, hashlib.sha256(t.encode()).hexdigest()) for i, (n, d, t) in brute(texts).items()}
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_sha256) for r in rows} == want


def test_keys_positions_and_edge_cases(make_docs):
    long = "\n".join(f"line number {i} of a very long text, all different" for i in range(20000))
    docs = {1: f"head\n {LINE.upper()}\t\nmid\n{LINE}\n", 2: LINE, 3: f"x\n{LINE}\n{LINE}", 4: "", 5: None, 6: f"{long}\n{LINE}",
            7: "short line\nshort line", 8: "short line", 9: "short line"}
    rows = dedup_lines(make_docs(docs.items())).select("doc.doc_id", "doc.kept", "kept_text", "n_lines", "n_dropped").collect()
    want = brute({i: t or "" for i, t in docs.items()})
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.kept_text) for r in rows} == want
    assert want[1][1] == 2 and want[6][1] == 0 and {r.kept for r in rows} == {"x"}


def test_repeated_rows_and_missing_ids(make_docs):
    rows = dedup_lines(make_docs([(1, LINE), (1, LINE), (2, LINE), (None, LINE)])).select("doc.doc_id", "n_dropped").collect()
    assert sorted((r.doc_id or 0, r.n_dropped) for r in rows) == [(0, 0), (1, 0), (1, 0), (2, 0)]  # two documents only
    rows = dedup_lines(make_docs([(1, LINE), (1, LINE), (2, LINE), (3, LINE)])).select("doc.doc_id", "n_dropped").collect()
    assert sorted((r.doc_id, r.n_dropped) for r in rows) == [(1, 1), (1, 1), (2, 1), (3, 0)]


def test_one_id_with_two_texts(make_docs):
    """A line that one of them loses leaves the other's line alone."""
    own = "Another line, which nobody else has"
    rows = dedup_lines(make_docs([(1, f"{LINE}\nend"), (1, f"{own}\n{LINE}"), (1, own), (2, LINE), (3, LINE)])).select("doc.doc_id", "kept_text").collect()
    assert sorted((r.doc_id, r.kept_text) for r in rows) == [(1, own), (1, own), (1, "end"), (2, ""), (3, LINE)]


def test_empty_table(make_docs):
    assert dedup_lines(make_docs([])).collect() == []


def test_plan_has_no_python(spark):
    plan = queries.op6_line_dedup(spark, SF)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan
