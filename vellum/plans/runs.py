"""Runs that publish at the end and go on where they stopped.

Every run writes its layers into a folder of its own. Readers follow one
pointer, which moves after the gate and the model tests have passed; until
then they read the previous run, silver and gold alike. A run that is held by
the gate, or dies anywhere, leaves the pointer where it is.

A journal has one row per finished step of a run (a written table, a gate, a
published pointer). A run that starts with the same inputs and parameters as an
unfinished one takes that one over: finished steps are read, not run again.
Steps are recorded after their data is written, so a step that died half way
is run again and overwrites what it left.

Layout under ``out_dir``: ``runs/<run>/<layer>/<table>``, ``journal/<run>/*``
and ``published/<n>-<run>``, one line of JSON each.
"""

from __future__ import annotations

import datetime as dt
import json
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vellum.sources import files
from vellum.sources.tables import write_table

_JOURNAL = "run string, step string, detail string, at timestamp"
_POINTER = "number long, run string, detail string, at timestamp"


def _read(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("recursiveFileLookup", "true").json(path)


def _now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc)


def _put(spark: SparkSession, path: str, **row) -> None:
    files.put_text(spark, path, json.dumps({**row, "at": _now().isoformat()}) + "\n")


# ------------------------------------------------------------- readers ---
def published(spark: SparkSession, out_dir: str) -> dict | None:
    """The run that readers see: number, run and its detail; None before the first."""
    rows = _read(spark, f"{out_dir}/published", _POINTER).orderBy(F.col("number").desc()).limit(1).collect()
    return None if not rows else {"number": rows[0].number, "run": rows[0].run, **json.loads(rows[0].detail)}


def read_published(spark: SparkSession, out_dir: str, layer: str, table: str) -> DataFrame:
    """A table of the published run."""
    pointer = published(spark, out_dir)
    if pointer is None:
        raise FileNotFoundError(f"nothing is published in {out_dir}")
    return spark.read.parquet(f"{out_dir}/runs/{pointer['run']}/{layer}/{table}")


def journal(spark: SparkSession, out_dir: str) -> DataFrame:
    """Every finished step of every run: run, step, detail (JSON), at."""
    return _read(spark, f"{out_dir}/journal", _JOURNAL)


# ----------------------------------------------------------------- run ---
class Run:
    """One run, new or taken over. ``inputs`` is a digest of what it reads,
    ``params`` what else decides its results."""

    def __init__(self, spark: SparkSession, out_dir: str, inputs: str, params: dict):
        self.spark, self.out_dir = spark, out_dir
        self.started = time.time()
        same = json.dumps({"inputs": inputs, **params}, sort_keys=True, default=str)
        self.parent = published(spark, out_dir)
        rows = journal(spark, out_dir).orderBy("at").collect()  # a few rows a run
        last = rows[-1].run if rows else None
        steps = {r.step: json.loads(r.detail) for r in rows if r.run == last}
        seen = None if self.parent is None else self.parent["run"]
        if last is not None and not {"finished", "held"} & set(steps) and steps["start"]["same"] == same \
                and seen in (steps["start"]["parent"], last):
            self.id, self.done, self.resumed = last, steps, True
            if seen == last:  # the pointer had moved already
                self.parent = next((p for p in self._pointers() if p["run"] == steps["start"]["parent"]), None)
        else:
            self.id, self.done, self.resumed = f"{_now():%Y%m%dT%H%M%S%f}-{uuid.uuid4().hex[:6]}", {}, False
            self.record("start", {"same": same, "parent": seen})
        self.folder = f"{out_dir}/runs/{self.id}"

    def _pointers(self) -> list[dict]:
        return [{"number": r.number, "run": r.run, **json.loads(r.detail)}
                for r in _read(self.spark, f"{self.out_dir}/published", _POINTER).collect()]

    def record(self, step: str, detail: dict | None = None) -> dict:
        """Journal a finished step."""
        detail = detail or {}
        _put(self.spark, f"{self.out_dir}/journal/{self.id}/{uuid.uuid4().hex}.json", run=self.id, step=step,
             detail=json.dumps(detail, default=str))
        self.done[step] = detail
        return detail

    def once(self, step: str, work: Callable[[], dict | None]) -> dict:
        """The detail of a step, run only if the journal lacks it."""
        return self.done[step] if step in self.done else self.record(step, work())

    def table(self, step: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A table of the run (``layer/name``), written once with its row count observed."""
        path = f"{self.folder}/{step}"
        if step not in self.done:
            seen = Observation(f"rows_{uuid.uuid4().hex}")
            write_table(build().observe(seen, F.count(F.lit(1)).alias("rows")), path)
            self.record(step, {"rows": int(seen.get["rows"])})
        return self.spark.read.parquet(path)

    def layer(self, layer: str, frames: dict, parallel: int = 8) -> dict:
        """Several tables of a layer, written as concurrent jobs: name → written table."""
        def label(name) -> str:
            return name if isinstance(name, str) else "_".join(name)

        def one(item):
            name, frame = item
            return name, self.table(f"{layer}/{label(name)}", frame if callable(frame) else lambda: frame)

        with ThreadPoolExecutor(max_workers=max(1, min(parallel, len(frames)))) as pool:
            return dict(pool.map(one, frames.items()))

    def counts(self, layer: str) -> dict[str, int]:
        """Rows per table of a layer, as observed while it was written."""
        return {step.split("/", 1)[1]: d["rows"] for step, d in self.done.items() if step.startswith(f"{layer}/")}

    def held(self, reason: dict) -> None:
        """The run ends at the gate or at the model tests; the pointer stays."""
        self.record("held", reason)

    def publish(self, **detail) -> None:
        """Move the pointer to this run: the one step that readers notice."""
        def move() -> None:
            number = (published(self.spark, self.out_dir) or {"number": 0})["number"] + 1
            _put(self.spark, f"{self.out_dir}/published/{number:08d}-{self.id}.json", number=number, run=self.id,
                 detail=json.dumps(detail))

        current = published(self.spark, self.out_dir)
        if current is None or current["run"] != self.id:
            move()
        self.once("published", lambda: detail)

    def finish(self) -> None:
        self.once("finished", lambda: {"seconds": round(time.time() - self.started, 3)})
