"""File manifest and content index of a source tree.

Files are listed by the driver through Hadoop's file system and read in tasks, each file as one row:
a task holds one file, so that files of 2 GB and more are beyond these two functions.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataloom.operators.lookups import bounded

#: Only so many leading bytes are hashed; longer files carry a labelled prefix hash.
HASH_PREFIX_BYTES = 64 << 20
FORMATS = {"csv": "csv", "tsv": "tsv", "txt": "txt", "xlsx": "xlsx", "parquet": "parquet", "json": "json", "pdf": "pdf", "md": "md"}


def file_format(name: str) -> str:
    base = re.sub(r"\.gz$", "", name.lower())
    ext = base.rpartition(".")[2]
    return FORMATS.get(ext, ext) + (".gz" if name.lower().endswith(".gz") else "")


def list_files(spark: SparkSession, root: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """relative_path, path, file_size_bytes, modified_on; folders named in skip are left out."""
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    fs = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    top = fs.getFileStatus(base).getPath().toString().rstrip("/") + "/"
    it, rows = fs.listFiles(base, True), []
    while it.hasNext():
        s = it.next()
        path = s.getPath().toString()
        rel = path.removeprefix(top)
        if not set(rel.split("/")[:-1]) & set(skip):
            rows.append((rel, path, s.getLen(), s.getModificationTime() / 1000.0))
    return spark.createDataFrame(rows, "relative_path string, path string, file_size_bytes bigint, mtime double")


def file_manifest(spark: SparkSession, root: str, skip: tuple[str, ...] = ()) -> DataFrame:
    """One row for each file: format, size, hash (of a prefix where long), columns and rows of tables."""
    files = list_files(spark, root, skip)
    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    head = F.substring(F.col("content"), F.lit(1), F.lit(HASH_PREFIX_BYTES))
    hashes = content.select("path", F.sha2(head, 256).alias("sha256"), F.md5("content").alias("md5"))
    out = files.join(hashes, _same(files["path"], hashes["path"]), "left").drop(hashes["path"])
    out = out.withColumn("sha256", F.when(F.col("file_size_bytes") > HASH_PREFIX_BYTES, F.concat(F.lit("prefix64MB:"), F.col("sha256"))).otherwise(F.col("sha256")))
    name = F.lower(F.element_at(F.split("relative_path", "/"), -1))
    plain = F.regexp_replace(name, r"\.gz$", "")
    fmt = F.concat(F.substring_index(plain, ".", -1), F.when(name.endswith(".gz"), ".gz").otherwise(""))
    synapse = F.nullif(F.regexp_extract("relative_path", r"(?:^|/)(syn\d+)(?:/|$)", 1), F.lit(""))
    lines = _line_counts(spark, root)
    out = out.withColumn("file_name", F.element_at(F.split("relative_path", "/"), -1)).withColumn("file_format", fmt).withColumn("synapse_id", synapse)
    out = out.join(lines, _same(out["path"], lines["line_path"]), "left").drop("line_path", "path")
    return out.withColumn("modified_on", F.timestamp_seconds("mtime")).drop("mtime")


def _same(a, b):
    strip = lambda c: F.regexp_replace(c, "^file:/+", "/")
    return strip(a) == strip(b)


def _line_counts(spark: SparkSession, root: str) -> DataFrame:
    """Rows, columns and delimiter of delimited files (by suffix), from their lines."""
    text = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.{csv,tsv,txt,csv.gz,tsv.gz,txt.gz}").text(root)
    t = text.select("value", F.col("_metadata.file_path").alias("line_path"), F.col("_metadata.file_block_start").alias("s"), F.monotonically_increasing_id().alias("i"))
    first = F.min_by("value", F.struct("s", "i"))
    g = t.groupBy("line_path").agg(F.count(F.lit(1)).alias("n"), first.alias("head"))
    sep = F.when(F.size(F.split("head", "\t")) > F.size(F.split("head", ",")), F.lit("\t")).otherwise(F.lit(","))
    return g.select("line_path", (F.col("n") - 1).alias("n_rows"), F.when(sep == "\t", F.size(F.split("head", "\t"))).otherwise(F.size(F.split("head", ","))).alias("n_cols"), sep.alias("delimiter"))


def _candidates(content: DataFrame, sizes: DataFrame) -> DataFrame:
    """The files whose content has one of the sizes: plain files by their length, gzip files by the size in their trailer
    (of the decompressed content, modulo 2^32). The others are neither decompressed nor hashed.

    The trailer is that of a file's last member, and the trailing bytes cannot tell how many there are: a gzip
    file of several members that is to be found by size has to be listed without sizes.
    """
    packed = F.hex(F.substring("content", 1, 2)) == "1F8B"
    last = F.hex(F.substring(F.col("content"), F.lit(-4), F.lit(4)))
    trailer = F.conv(F.concat(*[F.substring(last, k, 2) for k in (7, 5, 3, 1)]), 16, 10).cast("bigint")
    wanted = sizes.select(F.col("size_bytes").cast("bigint").alias("_size")).where("_size is not null").distinct()
    whole = wanted.select(F.lit(False).alias("_packed"), "_size")
    modulo = wanted.select(F.lit(True).alias("_packed"), (F.col("_size") % (1 << 32)).alias("_size")).distinct()
    sized = content.withColumns({"_packed": packed, "_size": F.when(packed, trailer).otherwise(F.col("length"))})
    return sized.join(bounded(whole.unionByName(modulo)), ["_packed", "_size"], "left_semi").drop("_packed", "_size")


def content_index(spark: SparkSession, root: str, skip: tuple[str, ...] = (), sizes: DataFrame | None = None) -> DataFrame:
    """md5 of each file's decompressed content with its paths: presence is decided by content.

    sizes: sizes (size_bytes) of the contents that are looked for; files of other sizes are left out unhashed.
    """
    from collections.abc import Iterator

    import pyarrow as pa

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib
        import zlib

        for b in batches:
            out = []
            for c in b.column("content").to_pylist():
                h = hashlib.md5()
                if c[:2] == b"\x1f\x8b":
                    d = zlib.decompressobj(31)
                    at = 0
                    while at < len(c):
                        h.update(d.decompress(c[at : at + (1 << 20)]))
                        at += 1 << 20
                        if d.eof and d.unused_data:
                            c, at = d.unused_data + c[at:], 0
                            d = zlib.decompressobj(31)
                    h.update(d.flush())
                else:
                    h.update(c)
                out.append(h.hexdigest())
            yield pa.RecordBatch.from_arrays([b.column("path"), pa.array(out, pa.string())], ["path", "content_md5"])

    content = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "length", "content")
    if sizes is not None:
        content = _candidates(content, sizes)
    hashed = content.select("path", "content").mapInArrow(rows, "path string, content_md5 string")
    files = list_files(spark, root, skip).select("relative_path", "path")
    j = hashed.join(files, _same(hashed["path"], files["path"])).select("content_md5", "relative_path")
    return j.groupBy("content_md5").agg(F.array_sort(F.collect_list("relative_path")).alias("paths"))


def missing_objects(wanted: DataFrame, index: DataFrame) -> DataFrame:
    """wanted (object_id, content_md5, kind, critical) with presence by content and where it is held."""
    out = wanted.join(index, "content_md5", "left")
    out = out.withColumn("present", F.col("paths").isNotNull()).withColumn("held_as", F.array_join("paths", "; ")).drop("paths")
    return out.orderBy(F.desc("critical"), "kind", "object_id")


def stated_int(c):
    """The number a tracking sheet states: digits, possibly with ``?``, ``~`` or separators; else null."""
    return F.regexp_replace(F.regexp_replace(c, r"[?~,\s]", ""), r"\.0+$", "").try_cast("int")


def derived_inventory(probes: DataFrame) -> DataFrame:
    """Per stratum what the build measured, in declared order of columns."""
    return probes.orderBy("layer_key", "stratum_key")


def measured_rows(inventory: DataFrame, tracking: DataFrame) -> DataFrame:
    """tracking_row, field, derived_value from the inventory for the rows of a tracking sheet.

    A sheet's row names a stratum, or (column prefix) the beginning of the keys of several: their
    numbers are summed, sites listed. Prefixes meet keys by an equi-join on the key's own beginnings.
    """
    wanted = tracking.select("tracking_row", F.coalesce("prefix", "tracking_row").alias("_p") if "prefix" in tracking.columns else F.col("tracking_row").alias("_p"), (F.col("prefix").isNotNull() if "prefix" in tracking.columns else F.lit(False)).alias("_many")).distinct()
    starts = inventory.withColumn("_p", F.explode(F.transform(F.sequence(F.lit(1), F.length("stratum_key")), lambda n: F.substring(F.col("stratum_key"), F.lit(1), n))))
    met = wanted.join(starts, "_p").where(F.col("_many") | (F.col("_p") == F.col("stratum_key")))
    numbers = ("n_features", "n_samples", "n_resolved")
    g = met.groupBy("tracking_row").agg(*[F.sum(c).alias(c) for c in numbers], F.array_join(F.array_sort(F.collect_set("site")), "; ").alias("site"))
    return g.select("tracking_row", F.inline(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("derived_value")) for c in (*numbers, "site")])))


def tracking_diff(tracking: DataFrame, derived: DataFrame) -> DataFrame:
    """A tracking sheet's numbers and sites against derived ones: agrees is true, false or null.

    tracking: tracking_row, field, tracking_value; derived: tracking_row, field, derived_value.
    """
    j = tracking.join(derived, ["tracking_row", "field"], "left")
    number = stated_int(F.col("tracking_value")) == F.col("derived_value").try_cast("int")
    site = F.lower("derived_value").contains(F.lower(F.trim("tracking_value")))
    agrees = F.when(F.col("derived_value").isNull() | F.col("tracking_value").isNull(), F.lit(None).cast("boolean")).when(F.col("field") == "site", site).otherwise(number)
    note = F.when(agrees.isNull(), "not computable from the build").when(~agrees, "derived value differs")
    return j.select("tracking_row", "field", "tracking_value", "derived_value", agrees.alias("agrees"), note.alias("note"))
