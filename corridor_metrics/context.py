"""Run settings, session defaults and the shared scratch folder."""

from __future__ import annotations

import datetime as dt
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from corridor_metrics.functions.dates import add_months

# Quality thresholds per counting interval.
COUNT_THRESHOLDS = {
    "1 hour": {"max_volume": 1200, "max_abs_delta": 200, "max_flat": 5},
    "15 min": {"max_volume": 300, "max_abs_delta": 50, "max_flat": 20},
}


@dataclass(frozen=True)
class RunContext:
    """Dates and settings that a report run needs.

    ``today`` is explicit so that a run can be repeated for a past day.
    """

    start_date: dt.date
    end_date: dt.date
    today: dt.date
    root: str = ""
    calcs_start_date: dt.date | None = None
    wk_calcs_start_date: dt.date | None = None
    am_peak_hours: tuple[int, ...] = ()
    pm_peak_hours: tuple[int, ...] = ()
    thresholds: dict = field(default_factory=lambda: COUNT_THRESHOLDS)

    @property
    def calcs_start(self) -> dt.date:
        return self.calcs_start_date or self.start_date

    @property
    def wk_calcs_start(self) -> dt.date:
        return self.wk_calcs_start_date or self.calcs_start

    @property
    def history_start(self) -> dt.date:
        """First day to read, so that every saved period and the one before it are complete."""
        monday = self.wk_calcs_start - dt.timedelta(days=self.wk_calcs_start.weekday() + 7)
        return min(monday, add_months(self.calcs_start, -1))

    @property
    def peak_hours(self) -> list[int]:
        return sorted({*self.am_peak_hours, *self.pm_peak_hours})

    @property
    def ped_history_start(self) -> dt.date:
        """Ped activity looks back six months before the last report month."""
        month = self.end_date.year * 12 + self.end_date.month - 1 - 6
        return min(self.calcs_start, dt.date(month // 12, month % 12 + 1, 1))


def build_session(app: str = "corridor_metrics", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the jobs are planned for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        "spark.sql.parquet.filterPushdown": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, taken from ``spark.checkpoint.dir``.

    Only a local session may fall back on a temporary folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if shared:
        return shared
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    shared = tempfile.mkdtemp(prefix="corridor-metrics-")
    spark.sparkContext.setCheckpointDir(shared)
    return spark.sparkContext.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, not yet used path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives lost executors and fixes row placement."""
    shared_dir(df.sparkSession)
    if not df.sparkSession.sparkContext.getCheckpointDir():
        df.sparkSession.sparkContext.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint(eager=True)
