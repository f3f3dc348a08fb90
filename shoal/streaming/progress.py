"""What the two queries of a stream have done, kept in ledgers, and the lag between
them.

Stage 1's figures come with its progress events (rows in, kept, and why rows drop), stage 2's
from its writer.  Each batch is one ledger entry under its number, so a batch that is run
again after a crash counts once, and a job that starts anew goes on from the totals of all
runs before it.
"""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Iterable

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from shoal.streaming.ledger import Ledger, Rows

log = logging.getLogger(__name__)
KEPT = "kept"


def summed(parts: Iterable[Rows]) -> Rows:
    """Counts by name over several entries."""
    out: dict[str, int] = {}
    for rows in parts:
        for r in rows:
            out[r["count"]] = out.get(r["count"], 0) + r["n"]
    return [{"count": c, "n": out[c]} for c in sorted(out)]


class Counts:
    """A query's counts by batch: totals, and each of the batches that no roll holds."""

    def __init__(self, ledger: Ledger | None):
        self.ledger = ledger
        self.base: dict[str, int] = {}
        self.batches: dict[int, dict[str, int]] = {}
        if ledger is not None:
            rolled, entries = ledger.entries()
            self.base = {r["count"]: r["n"] for r in rolled}
            self.batches = {int(k): {r["count"]: r["n"] for r in rows} for k, rows in entries}

    def put(self, batch: int, counts: dict[str, int]) -> None:
        if self.batches.get(batch) == counts:
            return
        self.batches[batch] = counts
        if self.ledger is not None:
            self.ledger.put(f"{batch:012d}", [{"count": c, "n": n} for c, n in counts.items()])
        while len(self.batches) > 1000:  # only the newest are ever waited for or run again
            for c, n in self.batches.pop(min(self.batches)).items():
                self.base[c] = self.base.get(c, 0) + n

    def total(self, count: str | None = None):
        out = dict(self.base)
        for counts in self.batches.values():
            for c, n in counts.items():
                out[c] = out.get(c, 0) + n
        return out if count is None else out.get(count, 0)

    def after(self, count: str, n: int) -> int:
        """How many batches with some of ``count`` reach beyond the first ``n`` in sum."""
        have, beyond = self.base.get(count, 0), 0
        for b in sorted(self.batches):
            own = self.batches[b].get(count, 0)
            have += own
            beyond += own > 0 and have > n
        return beyond


def records_behind(progress: dict) -> int | None:
    """Records of a Kafka source not read yet: its metric where it has one, else the latest
    offsets less those read, by partition; None if the source tells neither."""
    behind = None
    for s in progress.get("sources") or []:
        metric = (s.get("metrics") or {}).get("maxOffsetsBehindLatest")
        latest, end = (x if isinstance(x, dict) else None for x in (s.get("latestOffset"), s.get("endOffset")))
        if latest is not None and end is not None and all(isinstance(v, dict) for v in latest.values()):
            n = sum(max(0, int(o) - int((end.get(topic) or {}).get(part, 0))) for topic, parts in latest.items() for part, o in parts.items())
        elif metric is not None:
            n = int(metric)
        else:
            continue
        behind = (behind or 0) + n
    return behind


class ProgressRecorder(StreamingQueryListener):
    """The counts of both queries.  ``stage1`` names the first query and ``metric`` its observed
    counts; the writer of the second tells :meth:`loaded`.  The lag is counted in stage-1
    batches: those with a kept row that stage 2 hasn't loaded.  Callbacks run on the
    listener's thread, the job loop reads."""

    def __init__(self, metric: str | None = None, stage1: str | None = None, first: Ledger | None = None, second: Ledger | None = None):
        self.metric, self.stage1 = metric, stage1
        self.first, self.second = Counts(first), Counts(second)
        self.behind: int | None = None
        self._lock = threading.Lock()

    def onQueryStarted(self, event):  # noqa: N802
        log.info("query %s started", event.id)

    def onQueryProgress(self, event):  # noqa: N802
        self.add(json.loads(event.progress.json))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        log.info("query %s terminated", event.id)

    def add(self, progress: dict) -> None:
        if progress.get("name") != self.stage1:
            return
        observed = progress.get("observedMetrics") or {}
        seen, new = observed.get(self.metric), observed.get(f"{self.metric}_new")
        with self._lock:
            behind = records_behind(progress)
            self.behind = self.behind if behind is None else behind
            if seen and progress.get("numInputRows"):  # an idle trigger repeats the last batch's number
                counts = {k: int(v) for k, v in seen.items() if isinstance(v, (int, float))}
                if new:  # what is kept is what wasn't seen before
                    late = sum(int(o.get("numRowsDroppedByWatermark") or 0) for o in progress.get("stateOperators") or [])
                    counts |= {KEPT: int(new["new"]), "seen": counts[KEPT] - int(new["new"]) - late, "late": late}
                self.first.put(int(progress["batchId"]), counts)

    def add_all(self, query) -> None:
        """The progress a finished query still remembers: the last events may be on their way
        yet.  Those seen before change nothing."""
        for p in query.recentProgress:
            self.add(json.loads(p.json))

    def loaded(self, batch: int, rows: int) -> None:
        with self._lock:
            self.second.put(batch, {"rows": rows})

    @property
    def lag(self) -> int:
        with self._lock:
            return self.first.after(KEPT, self.second.total("rows"))

    def observed(self) -> dict[str, int]:
        """Totals of stage 1's counts (rows in, kept, dropped by reason) over all runs."""
        with self._lock:
            return self.first.total()

    def batches(self) -> int:
        """Stage-1 batches with rows this recorder knows one by one."""
        with self._lock:
            return len(self.first.batches)


def recorder(spark: SparkSession, path: str, metric: str, stage1: str) -> ProgressRecorder:
    """A recorder on the ledgers under ``path``."""
    return ProgressRecorder(metric, stage1, Ledger(spark, f"{path}/stage1", summed), Ledger(spark, f"{path}/stage2", summed))
