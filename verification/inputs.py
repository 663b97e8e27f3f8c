"""What the registered queries share: profile inputs, a run time, scratch stores."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import replace

from pyspark.sql import DataFrame

from tabscope.operators.remote import RemoteInput, RemoteTable
from tabscope.plans.spec import ProfileInput, spec_from_schema
from tabscope.session import shared_dir
from tabscope.sources.store import ResultStore
from verification.tables import Frames

DECIMALS = 2
RUN_TS = dt.datetime(2026, 1, 2, 3, 4, 5)


def profile_input(
    frame: DataFrame, tab_nm: str, modes: Mapping[str, str] | None = None
) -> ProfileInput:
    """A table with its default plan, or with value modes for the named columns only."""
    if modes is not None:
        modes = {c: modes.get(c) for c in frame.columns}
    return ProfileInput(
        spec_from_schema(frame, tab_nm, decimals=DECIMALS, modes=modes), frame
    )


def inputs(frames: Frames, *names: str) -> list[ProfileInput]:
    return [profile_input(frames[n], n) for n in names]


def remote_input(
    frames: Frames, tab_nm: str, modes: Mapping[str, str] | None = None
) -> RemoteInput:
    """A table that Spark SQL groups by itself, as a relational source would."""
    local = profile_input(frames[tab_nm], tab_nm, modes)
    view = f"{tab_nm}_{uuid.uuid4().hex}"
    local.frame.createOrReplaceTempView(view)
    types = {f.name: f.dataType.simpleString() for f in local.frame.schema.fields}
    columns = tuple(replace(c, vendor_type=types[c.col_nm]) for c in local.spec.columns)
    source = RemoteTable("spark", (view,), frames.spark.sql, lambda: local.frame)
    return RemoteInput(replace(local.spec, columns=columns), source)


def scratch_store(frames: Frames) -> ResultStore:
    """A store of its own below the shared folder."""
    return ResultStore(frames.spark, f"{shared_dir(frames.spark)}/store-{uuid.uuid4().hex}")
