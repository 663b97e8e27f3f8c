"""Snapshot numbers of the dictionary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def latest_snapshot(snapshot_master: DataFrame, db_nm: str) -> DataFrame:
    """``chasu``: the highest registered number of the database, 0 if there is none."""
    return snapshot_master.filter(F.col("db_nm") == db_nm).agg(
        F.coalesce(F.max("chasu"), F.lit(0)).alias("chasu")
    )


def next_snapshot(snapshot_master: DataFrame, db_nm: str) -> DataFrame:
    """``chasu``: the number after the latest one."""
    return latest_snapshot(snapshot_master, db_nm).select((F.col("chasu") + 1).alias("chasu"))


def require_snapshot(snapshot_master: DataFrame, db_nm: str) -> int:
    """The latest number as a value; registering without any snapshot is an error."""
    chasu = latest_snapshot(snapshot_master, db_nm).first()["chasu"]
    if chasu == 0:
        raise ValueError(f"no dictionary snapshot is registered for {db_nm!r}")
    return int(chasu)


def snapshot_row(spark: SparkSession, db_nm: str, chasu: int, run_ts: dt.datetime) -> DataFrame:
    return spark.createDataFrame(
        [(chasu, db_nm, run_ts)], "chasu int, db_nm string, cr_dt timestamp_ntz"
    )
