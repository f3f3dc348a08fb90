"""S4 where devices choose keys freely: a dictionary of payload keys that grows with the batches,
and the columns it chooses.

Each batch's keys go into a heavy-hitter sketch (``approx_top_k_accumulate``, a partial
aggregate in the tasks); the batch's sketch is combined with that of all batches before it
and kept as one small state a batch.  A key is a column once it is in ``min_share`` of the
rows seen so far, by the sketch's estimate, and stays one; all other keys go, as one JSON
object, into the rest column.  The state is bounded by ``tracked`` keys, the table by
``max_columns`` columns, and no value is lost to either: see :func:`from_rest`.

A batch that is run again starts from the state before it, so it chooses alike.
"""

from __future__ import annotations

import base64
import json
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.operators import refine as R
from shoal.streaming.ledger import file_system, read_text, write_text

SKETCH = "sketch struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
KEPT_STATES = 5


@dataclass
class KeyRegistry:
    spark: SparkSession
    path: str
    rest_column: str = "rest"
    min_share: float = 0.01
    max_columns: int = 500
    tracked: int = 10_000

    def _states(self) -> list[str]:
        fs, p = file_system(self.spark, self.path)
        if not fs.exists(p):
            return []
        return sorted(n[:-5] for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.endswith(".json"))

    def _load(self, tag: str | None) -> dict:
        if tag is None:
            return {"rows": 0, "columns": [], "sketch": None}
        return json.loads(read_text(self.spark, f"{self.path}/{tag}.json"))

    def columns(self) -> list[str]:
        """The columns chosen so far."""
        states = self._states()
        return self._load(states[-1] if states else None)["columns"]

    def choose(self, prepared: DataFrame, tag: str) -> list[str]:
        """Take in a batch; the columns its rows are written with, by lower-case name."""
        states = self._states()
        base = self._load(max((s for s in states if s < tag), default=None))
        payload = R.payload_map()
        keys = prepared.select(F.explode(F.array_distinct(F.transform(F.map_keys(payload), F.lower))).alias("key"))
        sketches = keys.select(F.expr(f"approx_top_k_accumulate(key, {self.tracked}) AS sketch"))
        if base["sketch"] is not None:
            old = (bytearray(base64.b64decode(base["sketch"][0])), *base["sketch"][1:])
            sketches = sketches.unionByName(self.spark.createDataFrame([(old,)], SKETCH))
        # two small rows at most; a task without any can't write its half of this aggregate
        whole = sketches.coalesce(1).agg(F.expr(f"approx_top_k_combine(sketch, {self.tracked})").alias("sketch"))
        r = whole.select("sketch", F.expr(f"approx_top_k_estimate(sketch, {self.max_columns})").alias("top")).first()
        rows = base["rows"] + prepared.where(payload.isNotNull()).count()
        heavy = [x["item"] for x in r["top"] or [] if x["count"] >= self.min_share * rows]
        columns = (base["columns"] + sorted(k for k in heavy if k not in base["columns"]))[:self.max_columns]
        sketch = r["sketch"] and [base64.b64encode(r["sketch"][0]).decode(), *r["sketch"][1:]]
        write_text(self.spark, f"{self.path}/{tag}.json", json.dumps({"rows": rows, "columns": columns, "sketch": sketch}))
        fs, _ = file_system(self.spark, self.path)
        for s in [s for s in states if s < tag][:-KEPT_STATES]:  # those before the last few are needed by no batch
            fs.delete(file_system(self.spark, f"{self.path}/{s}.json")[1], False)
        return columns


def from_rest(table: DataFrame, names: list[str], rest_column: str) -> DataFrame:
    """``table`` with the columns ``names`` whole: a value that an earlier batch left in the rest
    column, when its key was no column yet, is taken from there."""
    have = {c.lower(): c for c in table.columns}
    rest = F.try_parse_json(F.col(f"`{have[rest_column.lower()]}`")).try_cast("map<string,variant>")
    lower = F.transform_keys(rest, lambda k, _: F.lower(k))
    out = {}
    for n in names:
        held = lower[n.lower()].cast("string")
        own = have.get(n.lower())
        out[own or n.lower()] = F.coalesce(F.col(f"`{own}`"), held) if own else held
    return table.withColumns(out)
