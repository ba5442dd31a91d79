"""Directory sources: poll, pattern filter, accept-once listings, recursive
scan, remote-sync intake and first-object pick.

A directory poll is a file source: batch ``spark.read`` or
``spark.readStream`` over any Hadoop URI.  File metadata comes from the
hidden ``_metadata`` column; the file-source checkpoint gives accept-once
across restarts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowframe.session import stage_table
from flowframe.streaming.runner import batch_dir, last_batch_before, read_batches


def _reader(spark: SparkSession, fmt: str, glob: str | None, recursive: bool, streaming: bool,
            max_files_per_trigger: int | None, schema: T.StructType | str | None, options: dict | None):
    r = spark.readStream if streaming else spark.read
    r = r.format(fmt)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if recursive:
        r = r.option("recursiveFileLookup", "true")
    if streaming and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(int(max_files_per_trigger)))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    if schema is not None:
        r = r.schema(schema)
    return r


def file_poll_source(spark: SparkSession, path: str, fmt: str = "text", *, glob: str | None = None,
                     recursive: bool = False, streaming: bool = False, max_files_per_trigger: int | None = None,
                     schema: T.StructType | str | None = None, options: dict | None = None) -> DataFrame:
    """Rows of the files under ``path`` with ``file_path``, ``file_name``,
    ``file_size`` and ``file_modification_time``.  Hidden files (``.``/``_``
    prefixes) are skipped by the file source itself."""
    df = _reader(spark, fmt, glob, recursive, streaming, max_files_per_trigger, schema, options).load(path)
    return df.select("*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
                     F.col("_metadata.file_size").alias("file_size"),
                     F.col("_metadata.file_modification_time").alias("file_modification_time"))


def file_listing(spark: SparkSession, path: str, *, glob: str | None = None, recursive: bool = False) -> DataFrame:
    """One row per file (no content read: ``binaryFile`` reads content only
    when the column is selected)."""
    df = _reader(spark, "binaryFile", glob, recursive, False, None, None, None).load(path)
    return df.select(F.col("path").alias("file_path"), F.regexp_extract("path", r"([^/]*)$", 1).alias("file_name"),
                     F.col("length").alias("file_size"), F.col("modificationTime").alias("file_modification_time"))


def file_messages(df: DataFrame, file_cols: list[str]) -> DataFrame:
    """One message per file (the directory poll's payload is the file)."""
    return df.groupBy(*file_cols).agg(F.count(F.lit(1)).alias("n_records"))


def accept_once(listings: DataFrame, path: str = "file_path", seen_at: str = "listing_ts", ignore_hidden: bool = True) -> DataFrame:
    """Accept-once filter over repeated directory listings: each path is
    handed over once, at its first listing.  A per-path ``min`` (partial
    aggregate), not a window."""
    src = listings
    if ignore_hidden:
        src = src.filter(~F.regexp_extract(F.col(path), r"([^/]*)$", 1).rlike(r"^[._]"))
    return src.groupBy(path).agg(F.min(seen_at).alias(seen_at))


def accept_all(listings: DataFrame, path: str = "file_path", ignore_hidden: bool = True) -> DataFrame:
    """Accept-all: the same path is handed over at every listing."""
    if ignore_hidden:
        return listings.filter(~F.regexp_extract(F.col(path), r"([^/]*)$", 1).rlike(r"^[._]"))
    return listings


def intake_changed(spark: SparkSession, path: str, ledger: str, accept: str = "changed", *, glob: str | None = None) -> DataFrame:
    """One poll of a directory against the ledger of what earlier polls handed over: (file_path, file_modification_time).

    ``accept`` is ``once`` (a path is handed over once for good), ``changed``
    (again whenever its modification time or size has changed), ``create``
    (when it was not there at the poll before, so also when it has come back)
    or ``all``.  The ledger holds the handed-over rows of each poll; a poll
    joins the new listing with it and appends, so a restart goes on where the
    last poll ended."""
    listing = file_listing(spark, path, glob=glob, recursive=True).filter(
        ~F.col("file_name").rlike(r"^[._]")).select("file_path", "file_modification_time", "file_size")
    listing = stage_table(listing, "listing")  # both the answer and the ledger are of one listing
    last = last_batch_before(spark, ledger, "listed", 1 << 62)
    poll = 0 if last is None else last + 1
    handed = read_batches(spark, ledger, "handed", listing.schema)
    new = {
        "all": lambda: listing,
        "once": lambda: listing.join(handed, "file_path", "left_anti"),
        "changed": lambda: listing.join(handed, ["file_path", "file_modification_time", "file_size"], "left_anti"),
        "create": lambda: listing.join(read_batches(spark, ledger, "listed", listing.schema).filter(
            F.col("batch_id") == poll - 1), "file_path", "left_anti"),
    }[accept]()
    new.write.mode("overwrite").parquet(batch_dir(ledger, "handed", poll))
    there = listing if accept == "create" else listing.limit(0)
    there.write.mode("overwrite").parquet(batch_dir(ledger, "listed", poll))
    return spark.read.schema(listing.schema).parquet(batch_dir(ledger, "handed", poll)).drop("file_size")


def touch(spark: SparkSession, path: str, seconds: int = 60) -> None:
    """Give a file a later modification time, as writing it anew would."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.setTimes(p, fs.getFileStatus(p).getModificationTime() + seconds * 1000, -1)


def first_object(listing: DataFrame, key: str = "file_path") -> DataFrame:
    """First key in listing order (one per poll): a top-1, planned as
    TakeOrderedAndProject."""
    return listing.orderBy(F.col(key)).limit(1)


def sync_source_intake(spark: SparkSession, remote: str, fmt: str, schema: T.StructType | str,
                       max_files_per_trigger: int, clean_source: str | None = None,
                       archive_dir: str | None = None) -> DataFrame:
    """Remote-store sync intake: a stream over any Hadoop URI taking at most
    N new files per trigger, keeping the remote modification time; with
    ``clean_source`` = ``delete`` / ``archive`` the source files are removed
    or moved once committed (archive lags one batch)."""
    opts = {}
    if clean_source:
        opts["cleanSource"] = clean_source
        if archive_dir:
            opts["sourceArchiveDir"] = archive_dir
    return file_poll_source(spark, remote, fmt, streaming=True, max_files_per_trigger=max_files_per_trigger,
                            schema=schema, options=opts)
