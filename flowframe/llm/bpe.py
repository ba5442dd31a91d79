"""Byte-pair encoding and decoding with a published vocabulary file.

A text is split at its special tokens, normalised (NFC, lower case), cut into
pieces by the vocabulary's pattern and written in the printable alphabet of
its bytes; the last symbol of a piece carries the end-of-word mark.  A piece
is merged over a doubly linked list of symbols with a priority queue of
(merge rank, position); an entry whose two symbols have changed since it was
queued is stale and skipped.  Decoding concatenates vocabulary strings with
the separator the file's (absent) decoder prescribes, one space.

Merging never crosses white space and neither does the normalisation, so
results are remembered per white-space-delimited word.
"""

from __future__ import annotations

import json
import re
import struct
import unicodedata
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import arrow_schema, give_back, utf8_items

# Unicode white space and the contractions of the vocabulary's pattern.
UNICODE_SPACE = r"\x09-\x0D\x20\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000"
#: Words and pieces remembered in each half of a memory, none longer than this.
REMEMBERED, LONGEST = 120_000, 48
#: Rows handed back at once.
ROWS = 500


CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
# Fixed values of the Unicode standard beyond version 15.1, the tables of Python 3.13: letters and numbers
# that 16.0 added (first, last), and lower-case mappings of 16.0 and 17.0 (first, last, first target).
LETTERS_16 = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
              (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
              (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
              (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
              (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
LOWER_17 = ((0x1C89, 0x1C89, 0x1C8A), (0xA7CB, 0xA7CB, 0x264), (0xA7CC, 0xA7CC, 0xA7CD), (0xA7CE, 0xA7CE, 0xA7CF),
            (0xA7D2, 0xA7D2, 0xA7D3), (0xA7D4, 0xA7D4, 0xA7D5), (0xA7DA, 0xA7DA, 0xA7DB), (0xA7DC, 0xA7DC, 0x19B),
            (0x10D50, 0x10D65, 0x10D70), (0x16EA0, 0x16EB8, 0x16EBB))
#: A final capital sigma has no special form here, and newer lower-case mappings count.
LOWER = {0x3A3: 0x3C3} | {c: to + c - a for a, b, to in LOWER_17 for c in range(a, b + 1)}


@lru_cache
def code_points(kind: str) -> str:
    """All code points of a general category (L, N, ...) as the ranges of a character class.

    The vocabulary's pattern is read with the tables of Unicode 16.0.
    """
    added = {"L": LETTERS_16, "N": NUMBERS_16}.get(kind, ())
    inside = np.array([unicodedata.category(chr(c))[0] == kind for c in range(0x110000)])
    for a, b in added:
        inside[a:b + 1] = True
    edges = np.flatnonzero(np.diff(inside.astype(np.int8), prepend=0, append=0)).tolist()
    return "".join(f"\\U{a:08x}-\\U{b - 1:08x}" for a, b in zip(edges[::2], edges[1::2]))


def piece_pattern() -> re.Pattern:
    """Contractions, runs of letters, single numbers, and runs of anything else but white space."""
    letters, numbers = code_points("L"), code_points("N")
    return re.compile(f"{CONTRACTIONS}|[{letters}]+|[{numbers}]|[^{UNICODE_SPACE}{letters}{numbers}]+")


def byte_alphabet() -> list[str]:
    """A printable character per byte: itself where printable, else the next code point from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in printable else next(spare)) for b in range(256)]


class Memory(dict):
    """Results of a function of short texts.  Looked up here are the young ones; when they are many they become old.

    An old result that is needed again is young again; the old ones before them go.
    """

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, key):
        found = self.old.get(key)
        if found is None:
            found = self.compute(key)
        if len(key) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.old = dict(self)
                self.clear()
            self[key] = found
        return found


class Codec:
    """A vocabulary file of the ``tokenizers`` JSON format: BPE model with an end-of-word suffix."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special: dict[str, int] = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.end = model.get("end_of_word_suffix") or ""
        # a pair of ids as one number -> rank of its merge; the id a rank makes
        self.base = len(self.vocab)
        self.ranks: dict[int, int] = {}
        self.made: list[int] = []
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            self.ranks[self.vocab[left] * self.base + self.vocab[right]] = rank
            self.made.append(self.vocab[left + right])
        # the symbol of each byte within a piece and at its end (None: the vocabulary drops it)
        self.inner = [self.vocab.get(c) for c in byte_alphabet()]
        self.last = [self.vocab.get(c + self.end) for c in byte_alphabet()]
        self.find = piece_pattern().findall
        self.split = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.words, self.pieces = Memory(self._word), Memory(self._piece)

    def merge(self, piece: bytes) -> list[int]:
        """The ids of one piece."""
        inner = self.inner
        ids = [inner[b] for b in piece]
        ids[-1] = self.last[piece[-1]]
        if None in ids:
            ids = [s for s in ids if s is not None]
        n, base, rank_of, made, queue = len(ids), self.base, self.ranks.get, self.made, []
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        for i in range(n - 1):
            rank = rank_of(ids[i] * base + ids[i + 1])
            if rank is not None:
                queue.append(rank << 32 | i)  # in order of rank, then position
        heapify(queue)
        while queue:
            entry = heappop(queue)
            i = entry & 0xFFFFFFFF
            j = after[i]
            if j >= n or ids[i] < 0 or rank_of(ids[i] * base + ids[j]) != entry >> 32:
                continue  # stale: one of the two symbols has been merged since
            new = ids[i] = made[entry >> 32]
            ids[j], k, h = -1, after[j], before[i]
            after[i] = k
            if k < n:
                before[k] = i
                rank = rank_of(new * base + ids[k])
                if rank is not None:
                    heappush(queue, rank << 32 | i)
            if h >= 0:
                rank = rank_of(ids[h] * base + new)
                if rank is not None:
                    heappush(queue, rank << 32 | h)
        return [s for s in ids if s >= 0]

    def _piece(self, piece: str) -> bytes:
        ids = self.merge(piece.encode())
        return struct.pack(f"<{len(ids)}I", *ids)

    def _plain(self, text: str) -> bytes:
        text = text.lower() if text.isascii() else unicodedata.normalize("NFC", text).translate(LOWER).lower()
        return b"".join(map(self.pieces.__getitem__, self.find(text)))

    def _word(self, word: bytes) -> bytes:
        text = word.decode("utf-8", "replace")
        if self.split is None or "<" not in text:
            return self._plain(text)
        return b"".join([self.special[part].to_bytes(4, "little") if part in self.special else self._plain(part)
                         for part in self.split.split(text)])

    def forget(self) -> None:
        """Empty the memories; the worker waits beside those of other stages."""
        for memory in (self.words, self.pieces):
            memory.clear()
            memory.old = {}

    def encode(self, text: bytes) -> bytes:
        """The ids of a UTF-8 text, little-endian 32-bit, without added special tokens."""
        return b"".join(map(self.words.__getitem__, text.split()))


@lru_cache(2)
def vocabulary_strings(data: bytes) -> dict[int, str]:
    """The string of each id, special tokens included."""
    spec = json.loads(data)
    return {i: s for s, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}


def decode(ids: bytes, strings: dict[int, str]) -> str:
    """The strings of little-endian 32-bit ids, joined by one space."""
    return " ".join(map(strings.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(2)
def codec(data: bytes) -> Codec:
    return Codec(data)


def read_vocabulary(spark, path: str):
    """The vocabulary file (about 50,000 entries, fixed) for every executor; only the driver reads the path."""
    with open(path, "rb") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_texts(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "token_ids",
                 count_col: str = "n_tokens", decoded_col: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the token ids (binary, little-endian unsigned 32-bit) and their number added.

    With ``decoded_col`` the ids are decoded again in the same pass; without
    ``keep_text`` the text does not come back.  Null and empty texts have no
    tokens.  All rows and columns stay, repeated rows too;
    existing columns with the added names are replaced.
    """
    added = {ids_col: "binary", count_col: "bigint"} | ({decoded_col: "string"} if decoded_col else {})

    def run_parts(data: bytes):
        own, strings = codec(data), vocabulary_strings(data) if decoded_col else None

        def coded(column: pa.Array) -> list[pa.Array]:
            ids = [own.encode(t) for t in utf8_items(column)]
            out = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
            return out + ([pa.array([decode(i, strings) for i in ids], pa.string())] if decoded_col else [])

        return coded, own.forget

    return _with_columns(docs, path, text_col, added, run_parts, keep_text)


def _with_columns(df: DataFrame, path: str, col: str, added: dict[str, str], start, keep: bool = True) -> DataFrame:
    """``df`` with columns that ``start(vocabulary file)`` computes from one column, a few rows at a time.

    The other columns travel as one struct, so their names cannot clash; the
    column itself is in it too if it stays, and sent only once.
    """
    vocabulary = read_vocabulary(df.sparkSession, path)
    rest = [c for c in df.columns if c not in added and (keep or c != col)]
    sent = F.struct(F.lit(1).alias("one"), *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(rest)])
    packed = df.select(sent.alias("row"), *([] if col in rest else [F.col(f"`{col}`").alias("alone")]))
    place = rest.index(col) + 1 if col in rest else None
    schema = f"row {packed.schema['row'].dataType.simpleString()}, " + ", ".join(f"a{i} {t}" for i, t in enumerate(added.values()))
    out = arrow_schema(df.sparkSession, schema)

    def run(batches):
        compute, end = start(vocabulary.value)
        for batch in batches:
            for i in range(0, batch.num_rows, ROWS):
                part = batch.slice(i, ROWS)
                row = part.column("row")
                column = part.column("alone") if place is None else row.field(place)
                yield pa.RecordBatch.from_arrays([row, *compute(column)], schema=out)
        end()
        give_back()

    return packed.mapInArrow(run, schema).select(
        *[F.col(f"row.c{i}").alias(c) for i, c in enumerate(rest)], *[F.col(f"a{i}").alias(c) for i, c in enumerate(added)])


def decode_ids(coded: DataFrame, path: str, ids_col: str = "token_ids", text_col: str = "decoded") -> DataFrame:
    """``coded`` with the text of its token ids added (null ids: empty); other columns stay."""
    def run_parts(data: bytes):
        strings = vocabulary_strings(data)
        return (lambda ids: [pa.array([decode(x.as_py() or b"", strings) for x in ids], pa.string())]), give_back

    return _with_columns(coded, path, ids_col, {text_col: "string"}, run_parts)


def round_trip_digest(docs: DataFrame, path: str) -> DataFrame:
    """Per document (doc_id, n_tokens, ids_sha256, decoded_sha256) of encoding and decoding its text."""
    both = encode_texts(docs.select("doc_id", "text"), path, decoded_col="decoded", keep_text=False)
    return both.select("doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
                       F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))
