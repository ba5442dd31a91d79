"""What the corpus operators share: words, tables staged in the shared folder, Arrow helpers."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowframe.session import drop_path, stage_table

#: A word is a maximal run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def words(text: bytes) -> list[bytes]:
    """The words of a UTF-8 text.  ``bytes.split`` splits on exactly 0x20 and 0x09-0x0D."""
    return text.split()


def word_array(text: Column) -> Column:
    """The words of a text as a JVM-side array (null: empty)."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE), "")


def fold_case(text: bytes) -> bytes:
    """Lower-case A-Z only; ``bytes.lower`` leaves every other byte alone."""
    return text.lower()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write a frame once into the shared folder and read it back: what is read later depends on no executor."""
    return stage_table(df, label)


def drop_staged(df: DataFrame) -> None:
    """Delete a staged table that nothing reads any more."""
    drop_path(df.sparkSession, df.staged_path)


def column(batch: pa.RecordBatch | pa.Table, name: str) -> pa.Array:
    c = batch.column(name)
    return c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c


def longs(batch: pa.RecordBatch | pa.Table, name: str) -> list[int | None]:
    return column(batch, name).to_pylist()


def texts(batch: pa.RecordBatch | pa.Table, name: str) -> Iterator[bytes]:
    """The texts of a batch one by one as UTF-8 (null: empty), without decoding them."""
    return utf8_items(column(batch, name))


def utf8_items(col: pa.Array) -> Iterator[bytes]:
    for x in col.cast(pa.large_binary() if pa.types.is_large_string(col.type) else pa.binary()):
        yield x.as_py() or b""


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], dict[str, list]], schema: str) -> DataFrame:
    """``mapInArrow`` with a function from a batch to columns in the order of ``schema``."""
    names = arrow_schema(df.sparkSession, schema)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_pydict(fn(b), schema=names)
        give_back()

    return df.mapInArrow(run, schema)


def give_back() -> None:
    """Hand freed memory back to the system: a Python worker outlives its task and waits beside those of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass  # another C library; it has its own ways


def arrow_schema(spark: SparkSession, ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser on unsigned 64-bit integers (multiply and xor-shift)."""
    x = x.astype(np.uint64, copy=True)
    with np.errstate(over="ignore"):
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xFF51AFD7ED558CCD)
        x ^= x >> np.uint64(33)
        x *= np.uint64(0xC4CEB9FE1A85EC53)
        x ^= x >> np.uint64(33)
    return x


def pack(values: np.ndarray) -> bytes:
    """Unsigned 32-bit integers as byte planes: planes of small numbers are all zero and compress to nothing."""
    return np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def unpack(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(blob, np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def pack_sorted(values: np.ndarray) -> bytes:
    """Increasing unsigned 32-bit integers as the byte planes of their differences."""
    return pack(np.diff(values, prepend=values.dtype.type(0)))


def unpack_sorted(blob: bytes) -> np.ndarray:
    return np.cumsum(unpack(blob), dtype=np.int64)


def runs(keys: np.ndarray) -> Iterator[tuple[int, slice]]:
    """The runs of equal values of an array of numbers from 0 on: (value, slice)."""
    bounds = np.flatnonzero(np.diff(keys, prepend=-1))
    for a, b in zip(bounds, [*bounds[1:], len(keys)]):
        yield int(keys[a]), slice(int(a), int(b))


def rows_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.Table.from_arrays(
        [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)
