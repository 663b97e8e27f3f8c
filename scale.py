"""Stage times of the profile levels over many generated rows: ``scale.py [rows] [folder]``.

Writes a table of many files once: a unique text, a text of which one value holds a third
of the rows, a long text with a constant start, a double that is NULL for a third,
integers and timestamps. Then runs each level to the noop sink and reads Spark's event
log: per stage of 0.3 s and more the tasks, the median and the slowest task, and bytes
shuffled and spilled. One JSON line per level.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections import defaultdict
from pathlib import Path
from statistics import median

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tabscope.operators.column_stats import column_stats  # noqa: E402
from tabscope.operators.pattern_dist import patterns_direct, patterns_from_values  # noqa: E402
from tabscope.operators.value_dist import sample_values, value_histogram  # noqa: E402
from tabscope.plans.spec import ProfileInput, spec_from_schema  # noqa: E402

MODES = {"unique_text": "Y", "hot_text": "Y", "number": "B", "at": "A"}


def session(folder: str) -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    os.makedirs(f"{folder}/events", exist_ok=True)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("scale")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", "32")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{folder}/checkpoint")
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.dir", f"file://{folder}/events")
        .getOrCreate()
    )


def generated(spark: SparkSession, rows: int) -> DataFrame:
    return spark.range(0, rows, 1, 64).selectExpr(
        "concat('user-', id, '@example.org') AS unique_text",
        "if(id % 3 = 0, 'the hot value', concat('v', id % 1000)) AS hot_text",
        "concat(repeat('same start ', 30), id % 977, repeat(' tail', id % 50)) AS long_text",
        "if(id % 3 = 1, NULL, id * 0.37) AS number",
        "id % 5000 AS small",
        "id AS big",
        "timestamp_ntz '2020-01-01 00:00:00' + make_interval(0, 0, 0, id % 900) AS at",
    )


def stages(folder: str, since: float) -> list[dict]:
    """What the event log says of the stages that began after ``since``."""
    tasks: dict[int, list[dict]] = defaultdict(list)
    for log in Path(folder, "events").iterdir():
        for line in log.open(errors="replace"):
            if '"SparkListenerTaskEnd"' in line:
                event = json.loads(line)
                if event["Task Info"]["Launch Time"] >= since * 1000:
                    tasks[event["Stage ID"]].append(event.get("Task Metrics") or {})
    out = []
    for stage, metrics in sorted(tasks.items()):
        times = [m.get("Executor Run Time", 0) / 1000 for m in metrics]
        if max(times) >= 0.3:
            written = sum(m.get("Shuffle Write Metrics", {}).get("Shuffle Bytes Written", 0) for m in metrics)
            out.append({
                "stage": stage, "tasks": len(times), "median_s": round(median(times), 2),
                "slowest_s": round(max(times), 2), "shuffle_mb": round(written / 1e6, 1),
                "spill_mb": round(sum(m.get("Disk Bytes Spilled", 0) for m in metrics) / 1e6, 1),
            })
    return out


def main() -> None:
    rows = int(sys.argv[1]) if len(sys.argv) > 1 else 10_000_000
    folder = sys.argv[2] if len(sys.argv) > 2 else tempfile.mkdtemp(prefix="scale-")
    spark = session(folder)
    spark.sparkContext.setLogLevel("ERROR")
    table = f"{folder}/rows-{rows}"
    if not os.path.exists(f"{table}/_SUCCESS"):
        generated(spark, rows).write.mode("overwrite").parquet(table)
    frame = spark.read.parquet(table)
    source = [ProfileInput(spec_from_schema(frame, "rows", decimals=2, modes=MODES), frame)]
    levels = {
        "column_stats": lambda: column_stats(source),
        "column_stats_4000": lambda: column_stats(source, extreme_chars=4000),
        "value_histogram": lambda: value_histogram(source),
        "sample_values": lambda: sample_values(value_histogram(source)),
        "patterns_from_values": lambda: patterns_from_values(value_histogram(source)),
        "patterns_direct": lambda: patterns_direct(source),
    }
    for name, build in levels.items():
        began = time.time()
        build().write.format("noop").mode("overwrite").save()
        took = time.time() - began
        time.sleep(1)  # the log is written behind the run
        print(json.dumps({"level": name, "rows": rows, "seconds": round(took, 1), "stages": stages(folder, began)}), flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
