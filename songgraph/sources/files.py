"""File sources and sinks (SRC1, SRC2, SRC4-SRC8, SNK1).

Parquet is the canonical format; Avro is read and written through
``format("avro")`` where the spark-avro package is on the classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from songgraph.functions.scalar import first_of
from songgraph.schema import SONG, conform
from songgraph.session import materialize

TARGET_FILE_BYTES = 256 * 1024 * 1024


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | str | None = None, columns: list[str] | None = None,
               options: dict[str, str] | None = None) -> DataFrame:
    """SRC1/SRC2/SRC4: a table by path. With ``columns`` only those are read
    (Parquet prunes the rest at the scan); with ``schema`` the file schema is
    not inferred."""
    reader = spark.read.format(fmt).options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    try:
        df = reader.load(path)
    except Exception as e:  # noqa: BLE001 - say which package is missing
        if fmt == "avro" and "avro" in str(e).lower():
            raise RuntimeError("reading Avro needs the spark-avro package on the "
                               "classpath (spark.jars.packages)") from e
        raise
    return df.select(*columns) if columns else df


def read_songs(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """The song table with the fixed record schema; absent fields are null. A scalar
    field stored as an array (one value per row of a record table) gives its first
    element, a value of the wrong type null (SC11)."""
    df = read_table(spark, path, fmt)
    stored = [f.name for f in SONG.fields if f.name in df.columns
              and isinstance(df.schema[f.name].dataType, T.ArrayType) and not isinstance(f.dataType, T.ArrayType)]
    kinds = {f.name: f.dataType.simpleString() for f in SONG.fields}
    return conform(df.withColumns({c: first_of(df, c, kinds[c]) for c in stored}) if stored else df, SONG)


def scan_dir(spark: SparkSession, root: str, suffix: str, fmt: str = "parquet",
             schema: T.StructType | None = None, skip_corrupt: bool = True) -> DataFrame:
    """SRC5 + SRC6: every file under ``root`` (recursively) whose name ends in
    ``suffix``; an unreadable file is skipped instead of failing the job."""
    reader = (spark.read.format(fmt)
              .option("recursiveFileLookup", "true")
              .option("pathGlobFilter", f"*{suffix}")
              .option("ignoreCorruptFiles", "true" if skip_corrupt else "false"))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(root)


def listing(spark: SparkSession, root: str, suffix: str) -> DataFrame:
    """``(path, length)`` of every file under ``root`` whose name ends in ``suffix``,
    from the file listing alone: no content is read, and Spark lists in parallel."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", f"*{suffix}").load(root).select("path", "length"))


def _plain(path) -> F.Column:
    """A path in one spelling: the scheme with a single slash, no URL escapes."""
    return F.regexp_replace(path, "^([A-Za-z][A-Za-z0-9+.-]*):/+", "$1:/")


def audit(spark: SparkSession, root: str, suffix: str, fmt: str = "parquet",
          schema: T.StructType | None = None) -> DataFrame:
    """SRC6: one row per file of the scan, ``(path, length, n_rows, checksum, reason)``.

    Every column of every file is read (skipping what is corrupt) and counted by file;
    files of the listing that delivered nothing have 0 rows and the reason ``no
    readable rows`` (files without a byte are in no Spark listing). ``checksum`` is the exclusive or of the rows'
    hashes, so a re-read of the same files can be compared. Counts combine partially,
    one row per file and task is shuffled."""
    rows = scan_dir(spark, root, suffix, fmt, schema)
    names = [F.col(f"`{c}`") for c in rows.columns]
    escaped = F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))
    read = (rows.select(F.try_url_decode(escaped).alias("path"), F.xxhash64(*names).alias("h"))
            .groupBy(_plain(F.col("path")).alias("_path"))
            .agg(F.count(F.lit(1)).alias("n_rows"), F.bit_xor("h").alias("checksum")))
    files = listing(spark, root, suffix)
    reason = F.when(F.col("n_rows").isNull(), "no readable rows")
    return (files.join(read, _plain(F.col("path")) == F.col("_path"), "left")
            .select("path", "length", F.coalesce("n_rows", F.lit(0)).alias("n_rows"), "checksum", reason.alias("reason")))


def rejects(audited: DataFrame) -> DataFrame:
    """SRC6: ``(path, length, reason)`` of the files that could not be read."""
    return audited.where(F.col("reason").isNotNull()).select("path", "length", "reason")


def read_with_rejects(spark: SparkSession, path: str, schema: T.StructType,
                      fmt: str = "json") -> tuple[DataFrame, DataFrame]:
    """SRC6 for text formats: rows that do not parse go to a rejects frame
    (with the raw record) instead of stopping the job. The parsed rows are written
    once (Spark does not filter a file scan on the corrupt column alone)."""
    bad = "_corrupt_record"
    full = T.StructType(list(schema.fields) + [T.StructField(bad, T.StringType())])
    parsed = materialize(spark.read.format(fmt).schema(full)
                         .option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", bad)
                         .load(path), "parsed")
    good = parsed.where(F.col(bad).isNull()).drop(bad)
    return good, parsed.where(F.col(bad).isNotNull()).select(F.col(bad).alias("raw_record"))


def packing_session(spark: SparkSession, target_bytes: int) -> SparkSession:
    """A session like ``spark`` whose file scans put small files together up to
    ``target_bytes`` a task (and cut larger ones there)."""
    own = spark.newSession()
    for k, v in spark.conf.getAll.items():
        if own.conf.isModifiable(k):
            own.conf.set(k, v)
    own.conf.set("spark.sql.files.maxPartitionBytes", str(int(target_bytes)))
    own.conf.set("spark.sql.files.openCostInBytes", "1")
    own.conf.set("spark.sql.files.minPartitionNum", "1")
    return own


def compact(spark: SparkSession, root: str, out: str, suffix: str = ".parquet", fmt: str = "parquet",
            schema: T.StructType | None = None, out_fmt: str | None = None, codec: str = "snappy",
            target_file_bytes: int = TARGET_FILE_BYTES, single_file: bool = False) -> DataFrame:
    """SRC7 + SNK1: rewrite the many small files under ``root`` as few large ones,
    replacing ``out``; corrupt files are skipped (``audit`` names them).

    No row is shuffled and no file list reaches Python: the scan itself packs files
    by size into read tasks of about ``target_file_bytes``, and each task writes its
    rows as one file. ``single_file`` is the original one-file output, which funnels
    the whole write through one task. Returns the listing of the files written."""
    packed = packing_session(spark, target_file_bytes)
    df = scan_dir(packed, root, suffix, fmt, schema)
    if single_file:
        df = df.coalesce(1)
    df.write.mode("overwrite").format(out_fmt or fmt).option("compression", codec).save(out)
    return listing(spark, out, "")
