"""Camera logs to daily camera uptime."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corridor_metrics.functions.columns import http_date_to_local, utc_text_to_local
from corridor_metrics.operators.filters import before_today
from corridor_metrics.operators.uptime import camera_size_spread
from corridor_metrics.sources.sinks import write_by_month


def camera_log(raw: DataFrame) -> DataFrame:
    """Image log of the cameras: HTTP dates to local time."""
    return raw.select(
        F.col("ID").alias("CameraID"),
        http_date_to_local("Last-Modified").alias("Timestamp"),
        F.col("Content-Length").alias("Size"),
        F.col("date").alias("Date"),
    ).distinct()


def encoder_log(raw: DataFrame) -> DataFrame:
    """Image log of the encoders: UTC text to local time."""
    return raw.select(
        "CameraID", utc_text_to_local("Datetime").alias("Timestamp"), "Size", F.col("date").alias("Date")
    ).distinct()


def camera_uptime(raw: DataFrame, today: dt.date, encoders: bool = False) -> DataFrame:
    """Daily size spread per camera, for all full days of the log."""
    days = before_today(raw, today)
    return camera_size_spread(encoder_log(days) if encoders else camera_log(days))


def write_camera_uptime(raw: DataFrame, root: str, today: dt.date, encoders: bool = False) -> str:
    table = "cctv_uptime_encoders" if encoders else "cctv_uptime"
    write_by_month(camera_uptime(raw, today, encoders), root, table)
    return table
