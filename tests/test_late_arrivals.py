import random
import uuid

import pytest

from vellum import contracts
from vellum.plans import revenue
from vellum.session import work_dir
from vellum.sources import files
from vellum.streaming.late_arrivals import STORE_KEYS, ArrivingFact
from tests.test_pipeline import _orders_csv


def _tables(spark, n):
    """Bronze rows of n orders, as lists per table."""
    out = {}
    for e, text in _orders_csv(n).items():
        path = f"{work_dir(spark, f'arriving-{uuid.uuid4().hex[:8]}')}/{e}.csv"
        spark.createDataFrame([(x,) for x in text.split("\n")], "value string").coalesce(1).write.text(path)
        out[e] = [tuple(r) for r in files.read_csv(spark, path, contracts.REVENUE[e]).collect()]
    return out


def _land(spark, landing, entity, rows):
    if rows:
        files.append_parquet(spark.createDataFrame(rows, contracts.REVENUE[entity]).coalesce(1), f"{landing}/{entity}")


def _full(spark, tables):
    silver = {e: revenue.SILVER[e](spark.createDataFrame(rows, contracts.REVENUE[e])) for e, rows in tables.items()}
    return sorted(map(tuple, revenue.fact_order(revenue.Silver.from_silver(silver)).collect()))


def _new(spark):
    return (ArrivingFact(spark, work_dir(spark, f"fact-{uuid.uuid4().hex[:8]}")), work_dir(spark, f"landing-{uuid.uuid4().hex[:8]}"))


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_of_arrivals_ends_in_the_full_refresh(spark, seed):
    """Rows of all seven tables in random arrivals; some tables come first or last as a whole."""
    rng, tables = random.Random(seed), _tables(spark, 24)
    arriving, landing = _new(spark)
    assert arriving.rebuild() is None and arriving.read() is None
    whole = {e: rng.randrange(3) for e in rng.sample(sorted(STORE_KEYS), 3)}
    parts = {e: [whole.get(e, rng.randrange(3)) for _ in rows] for e, rows in tables.items()}
    for arrival in range(3):
        for e in rng.sample(sorted(tables), len(tables)):
            _land(spark, landing, e, [r for r, p in zip(tables[e], parts[e]) if p == arrival])
        arriving.take_in(landing)
        arriving.rebuild()
        here = {e: [r for r, p in zip(rows, parts[e]) if p <= arrival] for e, rows in tables.items()}
        assert sorted(map(tuple, arriving.read().collect())) == _full(spark, here)
    assert arriving.rebuild() is None      # nothing new


def test_a_late_refund_touches_its_order_only(spark):
    tables = _tables(spark, 40)
    arriving, landing = _new(spark)
    late = [r for r in tables["refunds"] if r[1] == 36]
    for e, rows in tables.items():
        _land(spark, landing, e, [r for r in rows if r not in late])
    arriving.take_in(landing)
    first = arriving.rebuild()
    _land(spark, landing, "orders", [(41, 1, *tables["orders"][0][2:])])      # an order above all others
    arriving.take_in(landing)
    second = arriving.rebuild()
    _land(spark, landing, "refunds", late)
    arriving.take_in(landing)
    third = arriving.rebuild()
    held = [{r.file: r.rows for r in arriving.fact.manifest(v).collect()} for v in (first, second, third)]
    assert set(held[0]) < set(held[1])                    # only a file was added
    assert len(set(held[1]) - set(held[2])) == 1          # only the file of order 36 was written again
    refunded = {r.order_id: r.refunded_amount for r in arriving.read().collect()}
    assert refunded[36] == 5 and len(refunded) == 41
    assert {r.order_id: r.refunded_amount for r in arriving.fact.read(second).collect()}[36] == 0


def test_a_batch_is_stored_once_and_a_dead_rebuild_is_repeated(spark, monkeypatch):
    tables = _tables(spark, 6)
    arriving, landing = _new(spark)
    for e, rows in tables.items():
        _land(spark, landing, e, rows)
    arriving.take_in(landing)
    batch = spark.createDataFrame(tables["refunds"], contracts.REVENUE["refunds"])
    arriving._keep("refunds")(batch, 0)                   # the stream replays a batch
    assert arriving.stores["refunds"].read().count() == len(tables["refunds"])
    with monkeypatch.context() as m:
        m.setattr(type(arriving.fact), "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            arriving.rebuild()
    assert arriving.read() is None
    arriving.rebuild()
    arriving.compact(1 << 30)
    assert sorted(map(tuple, arriving.read().collect())) == _full(spark, tables) and arriving.rebuild() is None
