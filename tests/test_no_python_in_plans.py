"""The data products stay JVM-side: no Python UDFs, pandas/Arrow UDFs or RDD code
(the text operators, where present, have rules of their own)."""
import pathlib
import re

FORBIDDEN = re.compile(r"\b(udf|pandas_udf|mapInPandas|applyInPandas|mapPartitions|localCheckpoint)\b|\.rdd\b")


def test_package_has_no_python_row_code():
    root = pathlib.Path(__file__).resolve().parent.parent / "vellum"
    hits = [f"{p.name}:{i}" for p in root.rglob("*.py") if p.parent.name != "llm"
            for i, line in enumerate(p.read_text().splitlines(), 1)
            if FORBIDDEN.search(line) and not line.lstrip().startswith("#")]
    assert hits == []


def test_registered_plans_have_no_python_evaluation(spark):
    import contextlib
    import io

    from vellum.plans import catalog
    for name in ("fact_order", "reconcile_keys", "rules_gold", "quarantine", "quality_documents"):
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            catalog.QUERIES[name](spark, "/root/testdata/sf0.001").explain()
        plan = buf.getvalue()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name
