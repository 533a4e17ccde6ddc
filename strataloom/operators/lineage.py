"""Lineage cuts in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one in local sessions only."""
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found and not re.match(r"local($|\[)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    return found or tempfile.gettempdir()


def cut(df: DataFrame) -> DataFrame:
    """df as it is now, kept in the shared folder: a lost executor costs no recomputation, and what a
    plan draws by sampling (range bounds, sketches) is drawn once."""
    context = df.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def staged(df: DataFrame) -> DataFrame:
    """df as Parquet in the shared folder: what is read several times is computed once, and takes less room than in a
    checkpoint, which holds rows as they are in memory."""
    path = f"{shared_folder(df.sparkSession)}/strataloom-staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
