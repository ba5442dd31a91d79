"""File and table sinks: per-group files, composed documents, gated publish,
null sink, log taps, post-process disposition and stage moves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from flowframe.session import drop_path


def per_file_sink(df: DataFrame, out_dir: str, file_col: str, seq_col: str, line_col: str,
                  num_partitions: int | None = None) -> None:
    """One output directory per input file, lines in sequence order.

    Rows are range-partitioned on ``(file, seq)`` and sorted inside each
    partition, so the part files of one file, read in name order, give its
    lines in order, and a very large file is written by many tasks instead
    of one.  Dynamic partition overwrite replaces only the files written."""
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    out = df.select(file_col, seq_col, line_col).repartitionByRange(n, file_col, seq_col).sortWithinPartitions(file_col, seq_col)
    (out.select(file_col, F.col(line_col).alias("value")).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy(file_col).text(out_dir))


def compose_document(to: Column, subject: Column, body: Column) -> Column:
    """``To: …\\r\\nSubject: …\\r\\n\\r\\nbody``."""
    return F.concat(F.lit("To: "), to, F.lit("\r\n"), F.lit("Subject: "), subject, F.lit("\r\n\r\n"), body)


def write_documents(df: DataFrame, out_dir: str, name_col: str, document_col: str) -> DataFrame:
    """Write composed documents with their file names and return what was written.

    One row per document in few files: a file of its own for every small
    message would cost a store more than the message."""
    df.select(F.col(name_col).alias("file_name"), F.col(document_col).alias("document")).write.mode("overwrite").parquet(out_dir)
    return df.sparkSession.read.parquet(out_dir)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def gated_publish(spark: SparkSession, target: str, parts: dict[str, DataFrame], marker: str = "sent",
                  fmt: str = "parquet") -> bool:
    """Publish once: if ``target/marker`` exists do nothing; else replace each
    part and write the marker last.  Returns True when it published."""
    marker_path = f"{target.rstrip('/')}/{marker}"
    if path_exists(spark, marker_path):
        return False
    for name, df in parts.items():
        df.write.mode("overwrite").format(fmt).save(f"{target.rstrip('/')}/{name}")
    fs, p = _fs(spark, marker_path)
    fs.create(p, True).close()
    return True


def null_sink(df: DataFrame) -> int:
    """Run the plan and drop the rows; returns the row count (observed
    while writing, no second pass)."""
    obs = Observation("null_sink")
    df.observe(obs, F.count(F.lit(1)).alias("rows")).write.format("noop").mode("overwrite").save()
    return int(obs.get["rows"])


def log_tap(df: DataFrame, level: str, formatter: Column | None = None, payload: str = "payload") -> DataFrame:
    """Side record of each message (the flow itself is unchanged)."""
    line = formatter if formatter is not None else F.col(payload).cast("string")
    return df.select("*", F.lit(level).alias("log_level"), F.concat(F.lit(level), F.lit(" "), line).alias("log_line"))


def disposition(df: DataFrame, path: str, ok: Column, error_dir: str, success_dir: str | None = None) -> DataFrame:
    """Post-process disposition per input file: success -> delete (or move to
    ``success_dir``), failure -> move to ``error_dir``."""
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    okc = F.coalesce(ok, F.lit(False))
    succ_target = F.lit(None).cast("string") if success_dir is None else F.concat(F.lit(success_dir.rstrip("/") + "/"), name)
    return df.withColumn("outcome", F.when(okc, F.lit("delete" if success_dir is None else "move_success")).otherwise(F.lit("move_error"))) \
             .withColumn("target_path", F.when(okc, succ_target).otherwise(F.concat(F.lit(error_dir.rstrip("/") + "/"), name)))


def apply_disposition(rows: DataFrame, decided: DataFrame, path: str, input_dir: str, error_dir: str,
                      parts: Sequence[str], success_dir: str | None = None) -> bool:
    """Carry out ``disposition`` for all files of ``input_dir``; returns whether there was anything to do.

    ``rows`` are the files' rows with their ``path``.  Rows of failed files
    are written below ``error_dir``, those of handled ones below
    ``success_dir`` (or nowhere), both partitioned by ``parts``; then the
    input folder is dropped as a whole.  A repeat after a failure writes the
    same rows over; once the input is gone it does nothing."""
    spark = rows.sparkSession
    if not path_exists(spark, input_dir):
        return False
    judged = rows.join(decided.select(path, "outcome").distinct(), path).drop(path)
    for outcome, target in (("move_error", error_dir), ("move_success", success_dir)):
        if target is not None:
            judged.filter(F.col("outcome") == outcome).drop("outcome").repartition(*parts).write.mode("overwrite").partitionBy(
                *parts).parquet(target)
    drop_path(spark, input_dir)
    return True


def stage_progress(df: DataFrame, path: str, stages: Sequence[str]) -> DataFrame:
    """Stage moves (e.g. upload -> uploading -> sent): one row per stage per
    item with the item's path in that stage's directory."""
    name = F.regexp_extract(F.col(path), r"([^/]*)$", 1)
    arr = F.array(*[F.lit(s) for s in stages])
    return df.select("*", F.posexplode(arr).alias("stage_no", "stage")).withColumn(
        "stage_path", F.concat(F.col("stage"), F.lit("/"), name))
