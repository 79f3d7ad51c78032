"""Watchdog alerts for vehicle and ped detection."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import alert_name, lane_text
from corridor_metrics.operators.scale import as_of_join, checked_join

WATCH_DAYS = 90
PLACE = ["Zone_Group", "Zone", "Corridor"]


def watched(df: DataFrame, today: dt.date, days: int = WATCH_DAYS) -> DataFrame:
    """Rows of the last ``days`` full days."""
    return df.where(F.col("Date").between(F.lit(today - dt.timedelta(days=days)), F.lit(today - dt.timedelta(days=1))))


def dated_config(df: DataFrame, config: DataFrame) -> DataFrame:
    """Each row with the detector configuration of its own date."""
    return checked_join(df, config, ["SignalID", "Detector", "Date"], "left")


def config_as_of(df: DataFrame, config: DataFrame) -> DataFrame:
    """Each row with the configuration of its detector that was in force on its date: the last one not after it."""
    return as_of_join(df, config, ["SignalID", "Detector"], "Date", [c for c in config.columns if c not in ("SignalID", "Detector", "Date")])


def vehicle_alerts(bad: DataFrame, config: DataFrame, corridors: DataFrame, today: dt.date) -> DataFrame:
    settings = config.select("SignalID", "CallPhase", "Detector", "ApproachDesc", "LaneNumber", "Date")
    recent = watched(bad.select("SignalID", "Detector", "Date"), today)
    place = corridors.select(*PLACE, "SignalID", "Name").where(F.col("Corridor").isNotNull())
    return checked_join(dated_config(recent, watched(settings, today)), place, ["SignalID"]).select(
        *PLACE, "SignalID", "CallPhase", "Detector", "Date",
        F.lit("Bad Vehicle Detection").alias("Alert"),
        alert_name("Name", "Corridor").alias("Name"),
        lane_text("ApproachDesc", "LaneNumber").alias("ApproachDesc"),
    )


def ped_alerts(bad: DataFrame, corridors: DataFrame, today: dt.date) -> DataFrame:
    """Signals without a corridor stay in."""
    place = corridors.select(*PLACE, "SignalID", "Name")
    recent = watched(bad.select("SignalID", "Detector", "Date"), today)
    return checked_join(recent, place, ["SignalID"], "left").select(
        *PLACE, "SignalID", "Detector", "Date", F.lit("Bad Ped Detection").alias("Alert"), "Name"
    )
