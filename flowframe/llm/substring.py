"""Removal of word passages that an earlier document already holds, behind a count-min prefilter.

A window is ``window`` consecutive words.  The corpus is dealt once into
buckets of documents by a hash of the id; the three passes over the texts
group by that bucket, so Spark deals the texts once and reuses the exchange.

1. Sketch.  Each bucket counts, per row of the sketch, the cells its windows
   fall into, and sends the touched cells of each sketch segment as one packed
   row.  The segments merge independently; each
   answers every bucket with those of its cells whose merged count is two or
   more.  Counts only ever overestimate: a window found in two documents is
   counted twice in every row, so none is lost.
2. Exact.  Each bucket sends, for windows that all rows report as repeated,
   an 80-bit key and the smallest document id it has for it (one entry per
   window and bucket however many copies there are).  Grouped by key, the
   entry with the smallest id is told apart from the others by one bit.
3. Removal.  Each bucket finds its windows again and removes the words
   covered by windows that start in a smaller document, inside the bucket or
   by the bit.

The segment of a window comes from the sketch hash: two windows are taken as
equal when they agree in the 80 bits of the key and in their segment.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import (
    arrow_schema, column, give_back, mix64, pack_sorted, rows_table, runs, texts, unpack_sorted, words,
)
from flowframe.session import shuffle_partitions

#: Text bytes dealt into one bucket, on average.
BUCKET_BYTES = 4 << 20
#: Bytes or words hashed at a time.
STRETCH = 1 << 18
#: Windows that meet in one segment of a sketch row, on average, and cells per window.
SEGMENT_WINDOWS, CELLS_PER_WINDOW = 1 << 21, 4
ROWS = 2
CELLS = SEGMENT_WINDOWS * CELLS_PER_WINDOW
_BASES = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)
_REPLY = "bucket long, kind int, segment long, body binary"


@lru_cache(8)
def _powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base ** i and base ** -i modulo 2 ** 64 for i below n."""
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        factors = np.full(n, b, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def window_hashes(word_hashes: np.ndarray, window: int, base: int) -> np.ndarray:
    """A polynomial hash of each run of ``window`` word hashes."""
    n = max(0, len(word_hashes) - window + 1)
    out = np.empty(n, np.uint64)
    up, down = _powers(base, STRETCH + window)
    with np.errstate(over="ignore"):
        for a in range(0, n, STRETCH):
            part = word_hashes[a:a + STRETCH + window - 1]
            sums = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part * up[:len(part)], out=sums[1:])
            out[a:a + STRETCH] = (sums[window:] - sums[:-window]) * down[:len(part) - window + 1]
    return out


_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_LETTERS = 0xA24BAED4963EE407


def word_hashes(texts_of: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of some texts, in order, and the number of words of each text.

    A hash is a polynomial in the bytes of the word, taken from running sums
    over the joined texts, one stretch at a time.
    """
    data = np.frombuffer(b" ".join(texts_of), np.uint8)
    space = np.concatenate(([True], _SPACE[data], [True]))
    edges = np.flatnonzero(space[1:] != space[:-1])
    starts, ends = edges[::2], edges[1::2]
    first_byte = np.cumsum([0, *(len(t) + 1 for t in texts_of)])
    sizes = np.diff(np.searchsorted(starts, first_byte))
    out = np.empty(len(starts), np.uint64)
    stretch = np.searchsorted(starts, np.arange(0, len(data) + STRETCH, STRETCH))
    for a, b in zip(stretch, stretch[1:]):
        if a == b:
            continue
        low, high = starts[a], ends[b - 1]
        up, down = _powers(_LETTERS, 1 << int(high - low).bit_length())
        with np.errstate(over="ignore"):
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum((data[low:high].astype(np.uint64) + np.uint64(1)) * up[:high - low], out=sums[1:])
            out[a:b] = (sums[ends[a:b] - low] - sums[starts[a:b] - low]) * down[starts[a:b] - low]
    return mix64(out), sizes


class _Bucket:
    """The windows of the documents of a bucket that have an id."""

    def __init__(self, docs: pa.Table, window: int, segments: int):
        row_ids = docs.column("__id").to_pylist()
        hashes, self.sizes = word_hashes(list(texts(docs, "__text")))
        self.starts = np.cumsum(self.sizes) - self.sizes
        doc_of = np.repeat(np.arange(len(row_ids)), self.sizes)
        n = max(0, len(hashes) - window + 1)
        inside = np.arange(n) <= (self.starts + self.sizes - window)[doc_of[:n]]
        has_id = np.array([i is not None for i in row_ids], bool)
        self.at = np.flatnonzero(inside & has_id[doc_of[:n]])
        self.id = np.array([i or 0 for i in row_ids], np.int64)[doc_of[self.at]]
        self.key = window_hashes(hashes, window, _BASES[0])[self.at]
        other = window_hashes(hashes, window, _BASES[1])[self.at]
        self.extra = (mix64(other) >> np.uint64(48)).astype(np.uint16)
        # the sketch rows: independent places of the window among all cells
        with np.errstate(over="ignore"):
            self.cells = [(mix64(other + np.uint64(0x632BE59BD9B4E019 * (r + 1) % (1 << 64)))
                           % np.uint64(segments * CELLS)).astype(np.int64) for r in range(ROWS)]

    def sketch(self) -> Iterator[tuple[int, bytes, bytes]]:
        """(segment of a row, cells touched once, cells touched more often)."""
        for r in range(ROWS):
            cell, n = np.unique(self.cells[r], return_counts=True)
            for segment, part in runs(cell // CELLS):
                inside, many = (cell[part] % CELLS).astype(np.uint32), n[part] > 1
                yield segment * ROWS + r, pack_sorted(inside[~many]), pack_sorted(inside[many])

    def repeated(self, replies: list[tuple[int, bytes]]) -> np.ndarray:
        """Which windows every sketch row reports as repeated, or a few that share the last bits of such a cell."""
        found = np.ones(len(self.at), bool)
        for r in range(ROWS):
            parts = [unpack_sorted(body) + segment // ROWS * CELLS for segment, body in replies if segment % ROWS == r]
            cells = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            size = 1 << max(16, (16 * len(cells)).bit_length())
            marked = np.zeros(size, bool)
            marked[cells & (size - 1)] = True
            found &= marked[self.cells[r] & (size - 1)]
        return found

    def entries(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of the chosen windows: the smallest id per distinct key, and each window's place among those.

        Returns the entries' windows and segments, then each chosen window's entry and the windows themselves.
        """
        at = np.flatnonzero(which)
        segment = self.cells[0][at] // CELLS
        order = np.lexsort((self.id[at], self.extra[at], self.key[at], segment))
        at, segment = at[order], segment[order]
        key, extra = self.key[at], self.extra[at]
        new = np.ones(len(at), bool)
        new[1:] = (segment[1:] != segment[:-1]) | (key[1:] != key[:-1]) | (extra[1:] != extra[:-1])
        return at[new], segment[new], np.cumsum(new) - 1, at


def _sketch_merge(group: pa.Table, out: pa.Schema) -> pa.Table:
    counts = np.zeros(CELLS, np.uint8)
    once, more = column(group, "once"), column(group, "more")
    for i in range(group.num_rows):
        cells = unpack_sorted(once[i].as_py())
        counts[cells] = np.minimum(counts[cells] + 1, 2)
        counts[unpack_sorted(more[i].as_py())] = 2
    segment, rows = group.column("segment")[0].as_py(), []
    for i, bucket in enumerate(group.column("bucket").to_pylist()):
        cells = np.concatenate([unpack_sorted(once[i].as_py()), unpack_sorted(more[i].as_py())])
        hit = np.sort(cells[counts[cells] > 1]).astype(np.uint32)
        if len(hit):
            rows.append((bucket, 0, segment, pack_sorted(hit)))
    return rows_table(rows, out)


def _exact_merge(group: pa.Table, out: pa.Schema) -> pa.Table:
    key, extra, ids = ([np.frombuffer(x.as_py(), t) for x in column(group, c)]
                       for c, t in (("key", "<u8"), ("extra", "<u2"), ("ids", "<i8")))
    sizes = [len(k) for k in key]
    key, extra, ids = np.concatenate(key), np.concatenate(extra), np.concatenate(ids)
    order = np.lexsort((ids, extra, key))
    k, e = key[order], extra[order]
    new = np.ones(len(order), bool)
    new[1:] = (k[1:] != k[:-1]) | (e[1:] != e[:-1])
    least = ids[order][np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    later = np.zeros(len(order), bool)
    later[order] = ids[order] > least
    segment, stops = group.column("segment")[0].as_py(), np.cumsum(sizes)
    rows = [(bucket, 1, segment, np.packbits(later[stop - n:stop]).tobytes())
            for bucket, n, stop in zip(group.column("bucket").to_pylist(), sizes, stops)]
    return rows_table(rows, out)


def _replies(table: pa.Table, kind: int) -> list[tuple[int, bytes]]:
    return [(s, b) for k, s, b in zip(table.column("kind").to_pylist(), table.column("segment").to_pylist(),
                                      table.column("body").to_pylist()) if k == kind]


def dedup_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 13,
                   keep_layout: bool = False) -> DataFrame:
    """Every row of ``docs`` with (n_words, n_removed, kept_text) in place of its text.

    Removed is each word covered by a window whose words also start in a
    document with a smaller id, judged on the input.  ``kept_text`` is the
    kept words joined by one space; with ``keep_layout`` a text that loses no
    word stays as it was.  Null and empty texts have no words.  Rows with a
    null id neither lose words nor make others lose any; rows that repeat an
    id are one document, whose copies do not remove each other's words.
    Existing columns with the three added names are replaced.
    """
    added = ("n_words", "n_removed", "kept_text")
    rest = [c for c in docs.columns if c not in (*added, id_col, text_col)]
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = max(-(-size // BUCKET_BYTES), 2 * shuffle_partitions(spark))
    # a word and the space after it are two bytes at least
    segments = max(1, -(-size // (2 * 3 * SEGMENT_WINDOWS)))
    source = docs.select(
        F.col(id_col).cast("long").alias("__id"), F.col(text_col).alias("__text"),
        F.struct(F.lit(1).alias("__one"), *[F.col(c) for c in rest]).alias("__rest"),
        F.pmod(F.xxhash64(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col))), F.lit(buckets)).alias("bucket"))
    by_bucket = source.groupBy("bucket")
    sketch_schema = arrow_schema(spark, "segment long, bucket long, once binary, more binary")
    entry_schema = arrow_schema(spark, "segment long, bucket long, key binary, extra binary, ids binary")
    reply_schema = arrow_schema(spark, _REPLY)

    def to_sketch(group: pa.Table) -> pa.Table:
        own = _Bucket(group, window, segments)
        bucket = group.column("bucket")[0].as_py()
        out = rows_table([(s, bucket, a, b) for s, a, b in own.sketch()], sketch_schema)
        give_back()
        return out

    def to_entries(group: pa.Table, reply: pa.Table) -> pa.Table:
        if not group.num_rows or not reply.num_rows:
            return rows_table([], entry_schema)
        own = _Bucket(group, window, segments)
        at, segment, _, _ = own.entries(own.repeated(_replies(reply, 0)))
        bucket = group.column("bucket")[0].as_py()
        return rows_table([(s, bucket, own.key[at[g]].tobytes(), own.extra[at[g]].tobytes(), own.id[at[g]].tobytes())
                       for s, g in runs(segment)], entry_schema)

    kept = "__id long, __rest {rest}, n_words long, n_removed long, kept_text string".format(
        rest=source.schema["__rest"].dataType.simpleString())
    kept_schema = arrow_schema(spark, kept)

    def to_kept(group: pa.Table, reply: pa.Table) -> pa.Table:
        if not group.num_rows:
            return kept_schema.empty_table()
        own = _Bucket(group, window, segments)
        at, segment, entry, chosen = own.entries(own.repeated(_replies(reply, 0)))
        later = np.zeros(len(at), bool)
        bits = dict(_replies(reply, 1))
        for s, g in runs(segment):
            n = g.stop - g.start
            later[g] = np.unpackbits(np.frombuffer(bits[s], np.uint8), count=n).astype(bool)
        gone = chosen[later[entry] | (own.id[chosen] > own.id[at][entry])]
        cover = np.zeros(int(own.sizes.sum()) + window + 1, np.int32)
        cover[own.at[gone]] += 1
        cover[own.at[gone] + window] -= 1
        removed = np.cumsum(cover) > 0
        n_removed, kept_text = [], []
        for text, start, size in zip(texts(group, "__text"), own.starts.tolist(), own.sizes.tolist()):
            flags = removed[start:start + size]
            n = int(flags.sum())
            n_removed.append(n)
            if n:
                text = b" ".join([w for w, out in zip(words(text), flags.tolist()) if not out])
            elif not keep_layout:
                text = b" ".join(words(text))
            kept_text.append(text.decode("utf-8", "replace"))
        return pa.Table.from_arrays(
            [column(group, "__id"), column(group, "__rest"), pa.array(own.sizes), pa.array(n_removed, pa.int64()),
             pa.array(kept_text, pa.string())], names=kept_schema.names).cast(kept_schema)

    sketched = by_bucket.applyInArrow(to_sketch, "segment long, bucket long, once binary, more binary")
    heavy = sketched.groupBy("segment").applyInArrow(lambda t: _sketch_merge(t, reply_schema), _REPLY)
    entries = by_bucket.cogroup(heavy.groupBy("bucket")).applyInArrow(
        to_entries, "segment long, bucket long, key binary, extra binary, ids binary")
    exact = entries.groupBy("segment").applyInArrow(lambda t: _exact_merge(t, reply_schema), _REPLY)
    result = by_bucket.cogroup(heavy.unionByName(exact).groupBy("bucket")).applyInArrow(to_kept, kept)
    return result.select(F.col("__id").alias(id_col), *[F.col(f"__rest.`{c}`").alias(c) for c in rest], *added)


def passage_digest(docs: DataFrame) -> DataFrame:
    """Per document (doc_id, n_words, n_removed, kept_sha256) of the 13-word passage dedup."""
    out = dedup_passages(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"))
