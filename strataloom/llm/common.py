"""Shared helpers: table access, lineage cuts in the cluster's shared folder, text primitives."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The six ASCII white-space characters of every word and line contract here.
WS = " \t\n\x0b\x0c\r"
#: Byte table that lower-cases A-Z only.
LOWER_ASCII = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir of the session.

    Only where the session has none and runs in one process (unit tests) a temporary folder is set; a
    cluster without the setting is an error.
    """
    found = spark.sparkContext.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.match(r"local($|\[)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        found = tempfile.mkdtemp(prefix="strataloom-checkpoint-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def cut(df: DataFrame) -> DataFrame:
    """Materialise a narrow table reliably (checkpoint in the shared folder) and cut its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Like cut(), but as Parquet, for wider tables that are read more than once by column."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/strataloom-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """name, prolonged until df has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame) -> DataFrame:
    """df with its columns renamed c0, c1, ...: names of any kind pass through Arrow so."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))])


def discard(spark: SparkSession, path: str) -> None:
    """Removes a folder that nothing reads any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def lower_ascii(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def words_of(text: str | None) -> list[bytes]:
    """ASCII-lower-cased maximal runs of characters other than space and \\x09-\\x0D, as UTF-8.

    bytes.split() separates at exactly those six ASCII characters, never at Unicode spaces.
    """
    return text.encode("utf-8", "surrogatepass").translate(LOWER_ASCII).split() if text else []
