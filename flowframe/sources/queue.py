"""A message source of one's own (§2.14) by the Python Data Source API: a queue of envelopes in a shared folder.

A producer appends a numbered folder of Parquet files; a folder counts once
its ``_SUCCESS`` marker is there and so are all before it, so half an append
is never read.  A stream's offset is the number of folders taken, which the
checkpoint remembers; each file of the folders since then is one partition,
read in Arrow batches, so a task holds one batch at a time and only file names
pass through the driver, those of the new folders.  The same source reads as a
batch.  Parsing is left to ``records.envelope_unwrap``, on the JVM.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from flowframe.streaming.runner import child_names

FORMAT = "envelopes"
BATCH_ROWS = 8192


def append_envelopes(df: DataFrame, folder: str) -> int:
    """Append the rows' ``value`` as the next numbered folder of the queue; its number.

    One producer appends at a time; an append that failed is written again
    under its own number.
    """
    done = len(child_names(df.sparkSession, folder, "append=*/_SUCCESS"))
    df.select("value").write.mode("overwrite").parquet(f"{folder}/append={done:09d}")
    return done


def read_envelopes(spark: SparkSession, folder: str, streaming: bool = False) -> DataFrame:
    """The queue as a frame or a stream of (append, value)."""
    spark.dataSource.register(EnvelopeQueue)
    return (spark.readStream if streaming else spark.read).format(FORMAT).load(folder)


class EnvelopeQueue(DataSource):
    """``spark.read`` / ``spark.readStream`` ``.format("envelopes").load(folder)``: (append long, value string)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "append long, value string"

    def reader(self, schema) -> DataSourceReader:
        return EnvelopeReader(self.options["path"])

    def streamReader(self, schema) -> DataSourceStreamReader:
        return EnvelopeStreamReader(self.options["path"])


@dataclass
class EnvelopeFile(InputPartition):
    append: int
    path: str


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(folder)


def _complete(folder: str) -> int:
    """Number of complete appends without a gap from the first on."""
    fs, root = _open(folder)
    listed = fs.get_file_info(pafs.FileSelector(root, allow_not_found=True))
    numbers = sorted(int(f.base_name.split("=")[1]) for f in listed if f.base_name.startswith("append="))
    # newest first: only the last append can lack its marker, as each number is given after the one before is complete
    whole = next((k for k, n in enumerate(numbers) if k != n), len(numbers))
    while whole and fs.get_file_info(f"{root}/append={whole - 1:09d}/_SUCCESS").type == pafs.FileType.NotFound:
        whole -= 1
    return whole


def _files(folder: str, first: int, last: int) -> list[EnvelopeFile]:
    """The files of the appends first..last-1."""
    fs, root = _open(folder)
    return [EnvelopeFile(n, f.path) for n in range(first, last)
            for f in fs.get_file_info(pafs.FileSelector(f"{root}/append={n:09d}")) if f.base_name.endswith(".parquet")]


def _read(folder: str, part: EnvelopeFile) -> Iterator[pa.RecordBatch]:
    fs, _ = _open(folder)
    with fs.open_input_file(part.path) as source:
        for batch in pq.ParquetFile(source).iter_batches(BATCH_ROWS, columns=["value"]):
            yield pa.RecordBatch.from_arrays([pa.array([part.append] * batch.num_rows, pa.int64()), batch.column(0)],
                                             names=["append", "value"])


class EnvelopeReader(DataSourceReader):
    """All complete appends."""

    def __init__(self, folder: str):
        self.folder = folder

    def partitions(self) -> list[EnvelopeFile]:
        # a reader without partitions is read once with None
        return _files(self.folder, 0, _complete(self.folder)) or [EnvelopeFile(-1, "")]

    def read(self, partition: EnvelopeFile) -> Iterator[pa.RecordBatch]:
        return iter(()) if partition.append < 0 else _read(self.folder, partition)


class EnvelopeStreamReader(DataSourceStreamReader):
    """The appends since the offset; a restart goes on where the checkpoint stands."""

    def __init__(self, folder: str):
        self.folder = folder

    def initialOffset(self) -> dict:
        return {"appends": 0}

    def latestOffset(self) -> dict:
        return {"appends": _complete(self.folder)}

    def partitions(self, start: dict, end: dict) -> list[EnvelopeFile]:
        return _files(self.folder, start["appends"], end["appends"])

    def read(self, partition: EnvelopeFile) -> Iterator[pa.RecordBatch]:
        return _read(self.folder, partition)

    def commit(self, end: dict) -> None:
        """Nothing to give back: the queue keeps its envelopes for other readers."""
