"""Token ids packed into fixed-length rows, best fit decreasing, ready for training.

Documents are encoded, and pieces longer than a row are cut into full rows
and a rest, so nothing is lost.  Each task gathers pieces up to a bounded
number of tokens and packs them: pieces by falling length, each into the row
whose free space fits it best.  Rows are counted by their free space in a
segment tree over the possible amounts, so the best fit is one descent
however many rows are open.

A packed row holds its ids, filled with the padding id to its full length,
the cumulative lengths of its segments and the position of every token within
its segment, each little-endian, and where its segments come from.
"""

from __future__ import annotations

import base64
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.bpe import read_vocabulary
from flowframe.llm.common import arrow_schema, give_back, longs, rows_table, texts

LENGTH = 2048
#: Tokens a task holds before it packs them.
GATHER = 1 << 21
_PACKED = ("ids binary, n_tokens int, cumulative array<int>, positions binary, "
           "doc_ids array<bigint>, offsets array<bigint>")


@lru_cache(2)
def rank_encoding(data: bytes, pattern: str):
    """The encoder of a published rank file (one base64 token and its rank a line), without special tokens."""
    import tiktoken

    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines())}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


class Capacities:
    """A multiset of free spaces 0..top: the smallest one that is at least a given size, in log(top) steps."""

    def __init__(self, top: int):
        self.width = 1 << top.bit_length()
        self.count = [0] * (2 * self.width)

    def add(self, space: int, n: int) -> None:
        i = space + self.width
        while i:
            self.count[i] += n
            i >>= 1

    def best(self, size: int) -> int:
        """The smallest space of at least ``size``, or -1."""
        i = size + self.width
        if self.count[i]:
            return size
        while i > 1 and (i & 1 or not self.count[i + 1]):  # up until a right sibling has something
            i >>= 1
        if i <= 1:
            return -1
        i += 1
        while i < self.width:
            i = 2 * i if self.count[2 * i] else 2 * i + 1
        return i - self.width


def best_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """The pieces of each row: by falling size, each into the fullest row it fits; ties by the order given."""
    spaces, rows_with = Capacities(length), {}
    rows: list[list[int]] = []
    for piece in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        size = sizes[piece]
        space = spaces.best(size) if size else -1
        if space < 0:
            row, space = len(rows), length
            rows.append([])
        else:
            row = rows_with[space].pop()
            spaces.add(space, -1)
        rows[row].append(piece)
        rows_with.setdefault(space - size, []).append(row)
        spaces.add(space - size, 1)
    return rows


def pack_rows(pieces: list[tuple[int | None, int, np.ndarray]], length: int, padding: int) -> list[tuple]:
    """Packed rows of pieces (document id, offset in the document, ids)."""
    out = []
    for row in best_fit_decreasing([len(p[2]) for p in pieces], length):
        parts = [pieces[i] for i in row]
        sizes = [len(p[2]) for p in parts]
        ids = np.full(length, padding, "<u4")
        positions = np.zeros(length, "<u4")
        used = sum(sizes)
        ids[:used] = np.concatenate([p[2] for p in parts])
        positions[:used] = np.concatenate([np.arange(n) for n in sizes])
        out.append((ids.tobytes(), used, [0, *np.cumsum(sizes).tolist()], positions.tobytes(),
                    [p[0] for p in parts], [p[1] for p in parts]))
    return out


def cut(doc_id: int | None, ids: np.ndarray, length: int) -> list[tuple[int | None, int, np.ndarray]]:
    """A document as pieces of at most ``length`` tokens; none if it has no tokens."""
    return [(doc_id, a, ids[a:a + length]) for a in range(0, len(ids), length)]


def pack_documents(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text",
                   length: int = LENGTH, padding: int = 50256) -> DataFrame:
    """Packed rows of the whole corpus; see the module for their columns.

    ``path`` is a rank file, ``pattern`` the one that splits text before its
    merges, ``padding`` an id that the file leaves free.

    ``cumulative`` starts with 0 and ends with ``n_tokens``; segment k of a
    row is document ``doc_ids[k]`` from token ``offsets[k]`` on.  Null and
    empty texts have no tokens and no segment.  Rows with null or repeated
    ids are packed like any other.  Which documents share a row depends on
    how the input is split; every token appears exactly once in any case.
    """
    vocabulary = read_vocabulary(docs.sparkSession, path)
    schema = arrow_schema(docs.sparkSession, _PACKED)

    def run(batches):
        encode = rank_encoding(vocabulary.value, pattern).encode_ordinary
        pieces, held = [], 0
        for batch in batches:
            for i, t in zip(longs(batch, "id"), texts(batch, "text")):
                ids = np.array(encode(t.decode("utf-8", "replace")), "<u4")
                pieces += cut(i, ids, length)
                held += len(ids)
                if held >= GATHER:
                    yield from _batches(pieces, length, padding, schema)
                    pieces, held = [], 0
        yield from _batches(pieces, length, padding, schema)
        give_back()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(run, _PACKED)


def _batches(pieces: list, length: int, padding: int, schema: pa.Schema):
    rows = pack_rows(pieces, length, padding)
    for a in range(0, len(rows), 256):
        yield from rows_table(rows[a:a + 256], schema).to_batches()


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed rows as Parquet, with two fixed-width binary matrices beside the lengths."""
    packed.write.mode("overwrite").parquet(path)


def unpack_documents(packed: DataFrame) -> DataFrame:
    """The token ids of each document back from packed rows: (doc_id, token_ids binary).

    Segments are put in order of their offset; a document is as large as its
    own tokens.  Documents without tokens are not in packed rows.
    """
    segment = F.explode(F.sequence(F.lit(1), F.size("doc_ids")))
    rows = packed.select("ids", "cumulative", "doc_ids", "offsets", segment.alias("k"))
    parts = rows.select(
        F.get("doc_ids", F.col("k") - 1).alias("doc_id"), F.get("offsets", F.col("k") - 1).alias("offset"),
        F.substring(F.col("ids"), F.get("cumulative", F.col("k") - 1) * 4 + 1,
                    (F.get("cumulative", F.col("k")) - F.get("cumulative", F.col("k") - 1)) * 4).alias("part"))
    listed = parts.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("offset", F.hex("part").alias("part")))).alias("p"))
    return listed.select("doc_id", F.unhex(F.array_join(F.col("p.part"), "")).alias("token_ids"))
