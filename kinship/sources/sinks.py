"""JSON report sink."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_report(report: DataFrame, path: str) -> None:
    """Write a long ``(metric, value)`` report as one JSON object per file.

    Dotted metric names become nested objects one level deep
    (``"sweep.k10"`` -> ``{"sweep": {"k10": ...}}``). A report has a handful of
    rows, so folding it into one row is cheap; the write itself is a normal
    Spark job into ``path`` (one part file).
    """
    section = F.when(F.col("metric").contains("."), F.substring_index("metric", ".", 1)).otherwise(F.lit("report"))
    name = F.when(F.col("metric").contains("."), F.substring_index("metric", ".", -1)).otherwise(F.col("metric"))
    nested = (
        report.select(section.alias("section"), name.alias("name"), F.col("value"))
        .groupBy("section")
        .agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("name", "value")))).alias("entries"))
        .agg(F.map_from_entries(F.collect_list(F.struct("section", "entries"))).alias("answers"))
    )
    nested.select("answers").coalesce(1).write.mode("overwrite").json(path)
