"""Windowed change extraction and the high-water mark that drives it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import spec
from tidemark.functions import moment
from tidemark.operators.upsert import upsert


class UnknownPipeline(LookupError):
    """The control table has no row for the requested pipeline."""


def changes(df: DataFrame, start: datetime, end: datetime, changed_at: str = "updated_at") -> DataFrame:
    """Rows changed in the half-open window (start, end].

    The bounds are literals of the column's own type, so the filter is pushed
    into a Parquet scan or to a JDBC source.
    """
    column_type = df.schema[changed_at].dataType.simpleString()
    lower, upper = moment(start, column_type), moment(end, column_type)
    return df.filter((F.col(changed_at) > lower) & (F.col(changed_at) <= upper))


def window_start(watermark: datetime, overlap_minutes: int = spec.OVERLAP_MINUTES) -> datetime:
    """Where the next window opens: some minutes before the watermark, to catch late commits."""
    return watermark - timedelta(minutes=overlap_minutes)


def with_window_start(control: DataFrame, overlap_minutes: int = spec.OVERLAP_MINUTES) -> DataFrame:
    """The control table with each pipeline's next window start."""
    overlap = F.make_dt_interval(mins=F.lit(overlap_minutes))
    return control.withColumn("window_start", F.col("last_watermark") - overlap)


def read_watermark(control: DataFrame, pipeline: str) -> datetime:
    row = control.filter(F.col("pipeline_name") == pipeline).select("last_watermark").first()
    if row is None:
        raise UnknownPipeline(f"no watermark for pipeline {pipeline!r}")
    return row["last_watermark"]


def advance_watermark(control: DataFrame, moved: DataFrame) -> DataFrame:
    """The control table after the pipelines in ``moved`` finished.

    ``moved`` has ``pipeline_name``, ``last_watermark`` and ``last_run_at``.
    """
    done = spec.CONTROL.conform(moved.withColumn("status", F.lit("success")))
    return upsert(control, done, spec.CONTROL.key, nullable_key=False)
