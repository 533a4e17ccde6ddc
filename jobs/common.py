"""What the jobs share: configuration files, sessions, row counts of writes."""

from __future__ import annotations

import argparse
import json
import logging

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def read_config(spark: SparkSession, path: str | None, defaults: dict) -> dict:
    """Settings of a small JSON file in any store, over the defaults; an unknown name is an error."""
    found = {}
    if path:
        (row,) = spark.read.option("wholetext", True).text(path).collect()
        found = json.loads(row["value"])
    unknown = set(found) - set(defaults)
    if unknown:
        raise ValueError(f"unknown settings in {path}: {sorted(unknown)}")
    return defaults | found


def table_path(folder: str, name: str) -> str:
    return f"{folder.rstrip('/')}/{name}.parquet"


def write_counted(df: DataFrame, path: str, partition: str, log: logging.Logger) -> int:
    """Replaces the partitions that df has rows of; logs and returns the number of rows."""
    seen = Observation()
    out = df.observe(seen, F.count(F.lit(1)).alias("n_rows"))
    out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
    log.info("wrote %d rows to %s", seen.get["n_rows"], path)
    return seen.get["n_rows"]


def arguments(description: str, *names: str) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=description)
    for n in names:
        p.add_argument(f"--{n}", required=True)
    p.add_argument("--config", help="JSON file of settings")
    return p.parse_args()


def session(name: str) -> SparkSession:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s %(message)s")
    return SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").getOrCreate()
