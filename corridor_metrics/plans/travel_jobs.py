"""Travel-time table and monthly speed indices."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import month_start
from corridor_metrics.operators.filters import safety_speeds
from corridor_metrics.operators.travel import corridor_limits, relative_speed_index, serious_injury_pct, travel_times
from corridor_metrics.sources.sinks import write_by_date

SUB = ["Corridor", "Subcorridor"]


def write_travel_times(readings: DataFrame, segments: DataFrame, root: str) -> None:
    times = travel_times(readings, segments)
    write_by_date(times.withColumn("Date", F.to_date("Minute")), root, "travel_times_1min")


def speed_indices(times: DataFrame, limits: DataFrame, reference: DataFrame) -> dict[str, DataFrame]:
    """Relative speed and bike/ped safety index by corridor and subcorridor, for every month at once."""
    by_month = times.withColumn("month", month_start("Minute"))
    safety = safety_speeds(by_month).withColumn("month", month_start("Minute"))
    return {
        "rsi_sub": relative_speed_index(by_month, limits, SUB, by=["month"]),
        "rsi_cor": relative_speed_index(by_month, corridor_limits(limits), ["Corridor"], by=["month"]),
        "bpsi_sub": serious_injury_pct(safety, reference, ["month", *SUB]),
        "bpsi_cor": serious_injury_pct(safety, reference, ["month", "Corridor"]),
    }


def write_speed_indices(indices: dict[str, DataFrame], root: str) -> None:
    """One partition per month and level."""
    for name, df in indices.items():
        index, level = name.split("_")
        table = {"rsi": "relative_speed_index", "bpsi": "bike_ped_safety_index"}[index]
        writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy("month").parquet(f"{root}/{table}/{level}")

