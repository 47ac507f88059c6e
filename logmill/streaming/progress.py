"""Counters of running streams, fed by Spark's progress events."""

from __future__ import annotations

import json
from collections import defaultdict

from pyspark.sql.streaming import StreamingQueryListener

Offsets = dict[tuple[str, int], int]


def parsed_offsets(text: str | dict | None) -> Offsets:
    """Offsets of a source per topic partition; other sources' offsets give none."""
    held = json.loads(text) if isinstance(text, str) and text.startswith("{") else text
    if not isinstance(held, dict):
        return {}
    per_topic = {t: at for t, at in held.items() if isinstance(at, dict)}
    return {(t, int(p)): int(n) for t, at in per_topic.items() for p, n in at.items() if str(p).isdigit()}


def source_lag(end: str | dict | None, latest: str | dict | None) -> Offsets:
    """Messages per topic partition that the source holds beyond ``end``; 0 at least."""
    done = parsed_offsets(end)
    return {at: max(0, n - done.get(at, 0)) for at, n in parsed_offsets(latest).items()}


class ProgressCounters(StreamingQueryListener):
    """Totals per query: polled rows, understood and written documents, failures, offsets, source lag.

    ``offsets`` holds the next offset per topic partition: of sources that tell it, and
    of :func:`logmill.operators.metrics.observe_offsets`.  ``rows`` holds the polled rows
    of the latter.  Written documents are those handed to :meth:`wrote`.
    """

    def __init__(self) -> None:
        self.totals: dict[str, dict[str, int]] = defaultdict(lambda: defaultdict(int))
        self.last: dict[str, dict] = {}
        self.offsets: dict[str, Offsets] = defaultdict(dict)
        self.rows: dict[str, Offsets] = defaultdict(lambda: defaultdict(int))
        self.lag: dict[str, Offsets] = {}

    def wrote(self, query_id: str, documents: int, failures: int = 0) -> None:
        """Count what a micro-batch wrote: documents, and rows that became dead letters."""
        totals = self.totals[query_id]
        totals["written"] += documents
        totals["dead_letters"] += failures

    def skipped_or_merged(self, query_id: str) -> int:
        """Polled rows that became neither a document nor a dead letter."""
        totals = self.totals[query_id]
        return max(0, totals["polled"] - totals["written"] - totals["dead_letters"])

    def onQueryStarted(self, event) -> None:  # noqa: N802
        self.totals[str(event.id)]["starts"] += 1

    def onQueryProgress(self, event) -> None:  # noqa: N802
        progress = event.progress
        query = str(progress.id)
        totals = self.totals[query]
        totals["batches"] += 1
        totals["polled"] += progress.numInputRows
        observed = progress.observedMetrics.get("progress")
        if observed is not None:
            totals["documents"] += observed["documents"] or 0
            totals["failures"] += observed["failures"] or 0
        lag: Offsets = {}
        for source in progress.sources:
            self._reach(query, parsed_offsets(source.endOffset))
            lag.update(source_lag(source.endOffset, source.latestOffset))
        self.lag[query] = lag
        seen = progress.observedMetrics.get("offsets")
        for name, value in (seen.asDict() if seen is not None else {}).items():
            kind, at = name.split(" ", 1)
            topic, partition = at.rsplit(" ", 1)
            if kind == "rows":
                self.rows[query][topic, int(partition)] += value or 0
            elif value is not None:
                self._reach(query, {(topic, int(partition)): value + 1})
        self.last[query] = {
            "batch_id": progress.batchId,
            "end_offsets": [s.endOffset for s in progress.sources],
            "latest_offsets": [s.latestOffset for s in progress.sources],
        }

    def _reach(self, query: str, offsets: Offsets) -> None:
        held = self.offsets[query]
        for at, n in offsets.items():
            held[at] = max(n, held.get(at, n))

    def onQueryIdle(self, event) -> None:  # noqa: N802
        pass

    def onQueryTerminated(self, event) -> None:  # noqa: N802
        self.totals[str(event.id)]["stops"] += 1
