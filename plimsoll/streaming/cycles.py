"""Monitoring cycles over a stream of labelled decisions.

Each function takes a batch or a streaming DataFrame; the watermark has no effect on a batch,
so the batch result is the reference for what the stream must have emitted once all windows
are closed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..dimensions import annotate
from ..functions import measures as M
from ..operators import metrics


def as_event_time(df: DataFrame, column: str = "ts") -> DataFrame:
    """Zone-less timestamps cannot carry a watermark; read them in the session zone."""
    return df.withColumn(column, F.col(column).cast("timestamp"))


def cycle_counts(decisions: DataFrame, width: str = "7 days", slide: str | None = None,
                 lateness: str = "1 day") -> DataFrame:
    """Confusion counts per window and category from ``ts, category, y, pred``.

    State is four counters per open window and category, however many rows arrive.
    """
    window = F.window("ts", width, slide) if slide else F.window("ts", width)
    y, p = F.col("y") == 1, F.col("pred") == 1
    counted = decisions.withWatermark("ts", lateness).groupBy(window.alias("w"), "category").agg(
        F.count_if(y & p).alias("tp"), F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"), F.count_if(~y & ~p).alias("tn"))
    return counted.select(F.col("w.start").alias("cycle_start"), F.col("w.end").alias("cycle_end"),
                          "category", "tp", "fp", "fn", "tn")


def cycle_cards(counts: DataFrame) -> DataFrame:
    return counts.select("cycle_start", "category", metrics.precision().alias("precision"),
                         metrics.recall().alias("recall"), metrics.f1().alias("f1"))


def unique_rows(stream: DataFrame, key: str = "id", lateness: str = "1 day", time: str = "ts") -> DataFrame:
    """Drops re-sent keys that arrive within the lateness bound, which also bounds the state."""
    return stream.withWatermark(time, lateness).dropDuplicatesWithinWatermark([key])


def drift_alerts(counts: DataFrame, baseline: DataFrame, dimension: DataFrame, metric: str = "recall") -> DataFrame:
    """Every (cycle, category) that fell more than half its tolerance below the baseline card."""
    cards = annotate(cycle_cards(counts), dimension, ["severity_tier", "tolerance"])
    base = baseline.select("category", F.col(metric).alias("baseline"))
    rows = cards.join(base, "category").withColumn("drop", F.col("baseline") - F.col(metric))
    status = M.ladder(F.col("drop"), F.col("tolerance"), F.col("tolerance") / 2,
                      M.DRIFT_RED, M.DRIFT_AMBER, M.DRIFT_GREEN)
    return rows.select("cycle_start", "category", "severity_tier", "baseline", F.col(metric).alias("current"),
                       "drop", "tolerance", status.alias("kri_status")).where(~F.col("kri_status").startswith("GREEN"))


#: What an alert sink writes.
ALERTS = ("cycle_start timestamp, category string, severity_tier string, baseline double, current double, drop double, "
          "tolerance double, kri_status string")


def alert_sink(baseline: DataFrame, dimension: DataFrame, path: str,
               metric: str = "recall") -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` writer. A batch that is run again overwrites its own folder, so alerts
    are neither lost nor doubled after a failure."""

    def write(batch: DataFrame, batch_id: int) -> None:
        alerts = drift_alerts(batch, baseline, dimension, metric)
        alerts.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write
