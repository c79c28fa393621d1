"""Twelve million rows, even and skewed: executor CPU seconds and rows shuffled per step.

``python benchmarks/large_trial.py FOLDER`` writes twenty copies of sf0.1 with shifted keys to the
(new) folder once, in 16 files; in the skewed copy a third of the rows has one key and one date.
Figures come from Spark's event log, which goes to the same folder.
"""

from __future__ import annotations

import json
import sys
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pedalstrata.operators import numbering
from pedalstrata.operators.rollup import DAY_MEASURES, rollup
from pedalstrata.plans.lineitem_feed import hour_raw
from pedalstrata.plans.silver import silver

COPIES = 20


def feed(spark: SparkSession, hot: bool) -> DataFrame:
    copies = spark.range(COPIES).withColumnRenamed("id", "copy")  # a fixed number of copies of each row
    hours = hour_raw(spark, "/root/testdata/sf0.1").crossJoin(F.broadcast(copies))
    key = (F.col("instant").cast("bigint") + F.col("copy") * 100_000_000).cast("string")
    hours = hours.withColumn("instant", key).drop("copy")
    if hot:
        third = F.pmod(F.xxhash64("instant", "hr", "cnt"), F.lit(3)) == 0
        hours = hours.withColumn("instant", F.when(third, "1").otherwise(F.col("instant")))
        hours = hours.withColumn("dteday", F.when(third, "1995-01-01").otherwise(F.col("dteday")))
    return hours.repartition(16)


STEPS = {
    "silver, aggregate form": lambda df: silver(df, "hour"),
    "silver, window form": lambda df: silver(df, "hour", method="window"),
    "roll-up, unique order": lambda df: rollup(df, "dteday", DAY_MEASURES, unique=True),
    "roll-up, order may repeat": lambda df: rollup(df, "dteday", DAY_MEASURES),
    "distributed numbering": lambda df: numbering.sequence_id_distributed(df, ["dteday", "instant"], "position"),
}


def main() -> None:
    folder = Path(sys.argv[1])
    (folder / "events").mkdir(parents=True)
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "64")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.eventLog.enabled", "true")
        .config("spark.eventLog.compress", "false")
        .config("spark.eventLog.rolling.enabled", "false")
        .config("spark.eventLog.dir", f"file://{folder}/events")
        .getOrCreate()
    )
    for kind in ("even", "hot"):
        feed(spark, kind == "hot").write.parquet(f"{folder}/{kind}")
        hours = spark.read.parquet(f"{folder}/{kind}")
        for name, step in STEPS.items():
            spark.sparkContext.setJobDescription(f"{name}|{kind}")
            step(hours).write.format("noop").mode("overwrite").save()
        spark.sparkContext.setJobDescription("")
    spark.stop()
    stages: dict[int, str] = {}
    totals: dict[str, list[float]] = {}
    for line in next((folder / "events").iterdir()).open():
        event = json.loads(line)
        if event["Event"] == "SparkListenerJobStart":
            told = event.get("Properties", {}).get("spark.job.description") or ""
            stages |= dict.fromkeys(event["Stage IDs"], told)
        elif event["Event"] == "SparkListenerTaskEnd" and "|" in stages.get(event["Stage ID"], ""):
            m = event["Task Metrics"]
            t = totals.setdefault(stages[event["Stage ID"]], [0.0, 0, 0])
            t[0] += m["Executor CPU Time"] / 1e9
            t[1] += m["Shuffle Write Metrics"]["Shuffle Records Written"]
            t[2] = max(t[2], m["Shuffle Read Metrics"]["Total Records Read"])
    for name, (cpu, rows, largest) in totals.items():
        print(json.dumps({"step": name, "cpu_s": round(cpu), "rows_shuffled": rows, "largest_task": largest}))


if __name__ == "__main__":
    main()
