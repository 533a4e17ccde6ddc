"""Inventory of delivered documents, by content: a streaming job that reads each delivered file once.

Deliveries arrive as Parquet files of documents under one path. Whether something has been delivered
is a question of content, not of names: the inventory says of each document what its content is (hash,
bytes, words), how many documents hold the same content, which of them is the first (smallest id), and
hence what a delivery brings that no other has.

Step 1, incremental: a file stream (availableNow, with a checkpoint) takes the files that are new since the
last run and keeps a narrow row for each document under ``<output>/manifest/batch=N``; texts are read in this
step only. A batch that is repeated after a failure replaces its own folder.
Step 2, incremental: of the deliveries that hold a content of a new batch, the inventory is computed anew from
the narrow rows and their partitions of ``<output>/inventory`` are replaced; the others stay as they are.
``<output>/mark`` holds the last batch that the inventory knows; it is written last, so that a run which was
stopped before is mended by the next one. A run without new files changes nothing.
Step 3, where the settings name a table of wanted objects (object_id, content_md5, kind, critical):
``<output>/presence`` says which are there and where, by ``strataloom.sources.manifest``.

Defined results: a null text is an empty one; a document without delivery (null or empty) belongs to
``unstated``; repeated rows are repeated holders. Null ids hold contents but are never the first holder
unless no other is known.

    python -m jobs.delivery_inventory --input IN/documents.parquet --output OUT --checkpoint OUT/_checkpoint
"""

from __future__ import annotations

import logging

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobs.common import arguments, read_config, session, write_counted
from strataloom.operators.contract import gated
from strataloom.sources import manifest as M

log = logging.getLogger("delivery_inventory")
#: Columns of the delivered tables, and files a micro-batch.
SETTINGS = {"id": "doc_id", "text": "text", "delivery": "source", "lang": "lang", "files_per_batch": 1000, "wanted": None}
WORD = r"[^\x20\x09-\x0D]+"
MANIFEST = "doc_id bigint, delivery string, lang string, content_md5 string, size_bytes bigint, n_words bigint"
INVENTORY = MANIFEST + ", n_holders bigint, first_doc_id bigint, is_copy boolean"


def manifest_rows(docs: DataFrame, names: dict) -> DataFrame:
    """What is kept of each document."""
    text = F.coalesce(F.col(names["text"]), F.lit(""))
    return docs.select(
        F.col(names["id"]).cast("bigint").alias("doc_id"), F.coalesce(F.nullif(F.col(names["delivery"]), F.lit("")), F.lit("unstated")).alias("delivery"), F.col(names["lang"]).alias("lang"),
        F.md5(text).alias("content_md5"), F.octet_length(text).cast("bigint").alias("size_bytes"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("n_words"),
    )


def take_new(spark: SparkSession, source: str, manifest: str, checkpoint: str, names: dict) -> int:
    """Adds the documents of files that no earlier run has read, by batch; their number."""
    schema = spark.read.parquet(source).schema
    # a pattern that only the path itself meets: a table may be one file or a folder of files
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", names["files_per_batch"]).parquet(f"{source[:-1]}[{source[-1]}]")

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{manifest}/batch={batch_id}")

    q = manifest_rows(stream, names).writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    n = sum(p["numInputRows"] for p in q.recentProgress)
    log.info("read %d new documents of %s in %d batches", n, source, len(q.recentProgress))
    return n


def inventory(rows: DataFrame, of: DataFrame | None = None) -> DataFrame:
    """rows of the manifest with n_holders, first_doc_id, is_copy of their content; with ``of``, only the
    deliveries that it lists, though their contents are counted in all.

    Contents are counted with partial aggregation; only those with several holders are joined back.
    """
    held = rows.groupBy("content_md5").agg(F.count(F.lit(1)).alias("n_holders"), F.min("doc_id").alias("first_doc_id")).where("n_holders > 1")
    out = (rows if of is None else rows.join(of, "delivery", "left_semi")).join(held, "content_md5", "left")
    out = out.withColumns({"n_holders": F.coalesce("n_holders", F.lit(1).cast("bigint")), "first_doc_id": F.when(F.col("n_holders").isNull(), F.col("doc_id")).otherwise(F.col("first_doc_id"))})
    return out.withColumn("is_copy", ~F.col("doc_id").eqNullSafe(F.col("first_doc_id")))


def last_mark(spark: SparkSession, path: str) -> int:
    """The last batch of the inventory, -1 before the first run."""
    try:
        return spark.read.schema("batch bigint").parquet(path).agg(F.coalesce(F.max("batch"), F.lit(-1))).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return -1


def update(spark: SparkSession, manifest: str, target: str, mark: str) -> int:
    """Renews the partitions of deliveries that hold what new batches brought; the rows written."""
    rows, known = spark.read.schema(MANIFEST + ", batch bigint").parquet(manifest), last_mark(spark, mark)
    new = rows.where(F.col("batch") > known)
    last = new.agg(F.max("batch")).first()[0]
    n = 0
    if last is None:
        log.info("nothing new after batch %d", known)
    else:
        touched = rows.join(new.select("content_md5").distinct(), "content_md5", "left_semi").select("delivery").distinct()
        n = write_counted(gated(inventory(rows.drop("batch"), touched)), target, "delivery", log)
        spark.createDataFrame([(last,)], "batch bigint").coalesce(1).write.mode("append").parquet(mark)
    return n


def presence(spark: SparkSession, rows: DataFrame, wanted: str) -> DataFrame:
    """Wanted objects with the documents that hold their content. Only wanted contents are listed."""
    objects = spark.read.parquet(wanted)
    holders = rows.join(objects.select("content_md5").distinct(), "content_md5", "left_semi")
    index = holders.groupBy("content_md5").agg(F.array_sort(F.collect_set(F.concat_ws("/", "delivery", F.col("doc_id").cast("string")))).alias("paths"))
    return M.missing_objects(objects, index)


def run(spark: SparkSession, source: str, output: str, checkpoint: str, config: str | None = None) -> DataFrame:
    """All steps; the inventory as it stands."""
    names = read_config(spark, config, SETTINGS)
    manifest, target = f"{output}/manifest", f"{output}/inventory"
    take_new(spark, source, manifest, checkpoint, names)
    update(spark, manifest, target, f"{output}/mark")
    if names["wanted"]:
        write_counted(presence(spark, spark.read.schema(MANIFEST).parquet(manifest), names["wanted"]), f"{output}/presence", "kind", log)
    return spark.read.schema(INVENTORY).parquet(target)


def main() -> None:
    a = arguments("Inventory of delivered documents", "input", "output", "checkpoint")
    spark = session("delivery_inventory")
    try:
        out = run(spark, a.input, a.output, a.checkpoint, a.config)
        for r in out.groupBy("delivery").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_copy").alias("copies")).orderBy("delivery").toLocalIterator():
            log.info("delivery %s: %d documents, %d of them copies", r["delivery"], r["n"], r["copies"])
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
