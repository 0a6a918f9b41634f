"""Incident numbers last from run to run."""

from vellum.plans import migration

COLS = "entity string, record_key string, issue_type string, severity string, description string, owner string, status string"


def found(spark, *keys):
    return spark.createDataFrame([("accounts", k, "missing_in_target", "high", "d", "o", "open") for k in keys], COLS)


def state(queue):
    return {r.record_key: (r.exception_id, r.status, r.first_seen, r.closed_in) for r in queue.collect()}


def test_numbers_last_and_closed_ones_are_marked(spark):
    one = migration.opened(migration.numbered_queue(found(spark, "b", "d", None)), "r1").persist()
    assert state(one) == {"b": (1, "open", "r1", None), "d": (2, "open", "r1", None), None: (3, "open", "r1", None)}
    two = migration.carried_queue(one, found(spark, "a", "d", None), "r2").persist()
    assert state(two) == {"b": (1, "closed", "r1", "r2"), "d": (2, "open", "r1", None), None: (3, "open", "r1", None),
                          "a": (4, "open", "r2", None)}
    assert two.columns == one.columns
    # closed in r2 stays closed in r2; one that comes back keeps its number
    three = migration.carried_queue(two, found(spark, "b", "c"), "r3").persist()
    assert state(three) == {"b": (1, "open", "r1", None), "d": (2, "closed", "r1", "r3"), None: (3, "closed", "r1", "r3"),
                            "a": (4, "closed", "r2", "r3"), "c": (5, "open", "r3", None)}
    again = migration.carried_queue(three, found(spark, "b", "c"), "r3")
    assert state(again) == state(three)


def test_nothing_before_and_nothing_now(spark):
    none = migration.opened(migration.numbered_queue(found(spark)), "r1").persist()
    assert state(migration.carried_queue(none, found(spark, "x"), "r2")) == {"x": (1, "open", "r2", None)}
    assert state(migration.carried_queue(none, found(spark), "r2")) == {}
