"""What a stream did, from its own progress reports."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.streaming import StreamingQuery


@dataclass(frozen=True)
class Run:
    """Totals over all batches. ``rows_dropped`` counts what stateful operators refused because it
    lay behind the watermark: rows before ``dropDuplicates``, but groups of a batch before an
    aggregation, which Spark folds first."""
    batches: int
    rows_in: int
    rows_dropped: int


def finish(query: StreamingQuery, poll_seconds: int = 1) -> Run:
    """Wait for the end and sum up. Spark keeps the last hundred reports, so they are read while the
    query runs."""
    seen: dict[int, tuple[int, int]] = {}

    def look() -> None:
        for p in query.recentProgress:
            dropped = sum(s["numRowsDroppedByWatermark"] for s in p["stateOperators"])
            before = seen.get(p["batchId"], (0, 0))
            seen[p["batchId"]] = max(before[0], p["numInputRows"]), max(before[1], dropped)
    while not query.awaitTermination(poll_seconds):
        look()
    look()
    return Run(len(seen), sum(n for n, _ in seen.values()), sum(d for _, d in seen.values()))
