"""Periodic runs of words, by tiles of every scale.

A run is a stretch of consecutive words with smallest period q and at least
``max(6, 4 * q)`` words that no neighbouring word extends.  Periods are
solved by octave: octave k holds the periods from P = 2^k to 2 P - 1.  A
document is laid out in overlapping tiles of an octave, one around every
P-th word, ``LEFT * P`` words to its left and ``RIGHT * P`` to its right.  A
run of a period of the octave has a centre with a whole period on its left
and two on its right, so there the 2 P words from the centre on occur again
q words earlier.  Windows of 2 P words are compared by 64-bit fingerprints,
doubled from octave to octave; where two agree, the tile is solved exactly on
its words: the Z-function of the words right of the centre and that of the
words left of it, read backwards, give how far period q reaches to both
sides.  A period whose stretch already has a shorter one is passed over by
the Z-function of the 2 P words around the centre.

Tiles know only themselves.  Their fragments (document, period, from, to) are
shuffled by document and period and stitched: fragments that share a period's
length of words belong to one run.  A document's tiles are laid out in the
task that reads it: over all octaves they hold its words a hundred times, and
only fragments travel.  A document that has fragments is carried along for
its collapsed text; every other one is finished where it is read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import arrow_schema, give_back, longs, map_batches, mix64, stage, texts

#: A run has at least so many words and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
#: Reach of a tile to both sides of its centre, in lowest periods of its octave.
LEFT, RIGHT = 4, 6
#: Words laid out together, in tiles of all octaves.
LAID_OUT = 200_000

FOUND = ("row long, doc_id long, n_words long, fragments array<struct<period:long,lo:long,hi:long>>, "
         "body binary, whole_sha256 string")
RESULT = ("doc_id long, n_words long, n_runs long, start long, length long, period long, exponent_milli long, "
          "runs_sha256 string, collapsed_sha256 string, runs array<struct<start:long,length:long,period:long>>")


def make_periodic(words: list[bytes], doc_id: int | None) -> list[bytes]:
    """The planted tail of the contract: one document in ten repeats a stretch of itself to its end."""
    h, n = zlib.crc32(b"" if doc_id is None else str(doc_id).encode()), len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + (i - a) % p] for i in range(a, n)]


def z_function(s: list[int]) -> list[int]:
    """For every position the length of the longest common prefix of the rest with the whole."""
    n = len(s)
    z = [n] + [0] * (n - 1)
    left = right = 0
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        while i + k < n and s[k] == s[i + k]:
            k += 1
        z[i] = k
        if i + k > right:
            left, right = i, i + k
    return z


def reaches(pattern: list[int], tile: list[int]) -> list[int]:
    """For every position of the tile how many words of the pattern follow from it on."""
    return z_function([*pattern, -1, *tile])[len(pattern) + 1:]


def shortest_period(s: list[int]) -> int:
    z = z_function(s)
    return next((i for i in range(1, len(s)) if z[i] == len(s) - i), len(s))


def solve_tile(x: np.ndarray, c: int, periods: list[int], low: int) -> Iterator[tuple[int, int, int]]:
    """(period, from, to) of the stretches with one of the periods around centre c, as far as the tile sees.

    A stretch that ends inside the tile on both sides and is too short for a run is left out.
    """
    inner = x[max(0, c - low):c + low].tolist()
    short = shortest_period(inner)
    if short < low:  # periods whose whole surroundings repeat with the shorter one are not smallest
        a, b = max(0, c - 2 * low), min(len(x), c + 2 * low)
        broken = np.flatnonzero(x[a:b - short] != x[a + short:b]) + a
        before, after = broken[broken < c - low], broken[broken >= c - low]
        begin = int(before[-1]) + 1 if len(before) else a
        end = int(after[0]) + short if len(after) else b
        periods = [q for q in periods if q % short or c - q < begin or c + q > end]
    if not periods:
        return
    a, b = max(0, c - LEFT * low), min(len(x), c + RIGHT * low)
    ahead = reaches(x[c:b].tolist(), x[max(a, c - 2 * low):b].tolist())
    behind = reaches(x[a:c][::-1].tolist(), x[a:c][::-1].tolist())
    for q in periods:
        right, left = ahead[c - q - max(a, c - 2 * low)], behind[q] if q < len(behind) else 0
        lo, hi = c - q - left, c + right
        open_ends = lo == a or hi == b
        if open_ends or hi - lo >= max(LEAST_WORDS, LEAST_PERIODS * q):
            yield q, lo, hi


def fragments(x: np.ndarray, longest: int) -> Iterator[tuple[int, int, int]]:
    """(period, from, to) found by the tiles of all octaves that a document of ``longest`` words has periods of.

    ``x`` holds the word numbers of documents end to end, each closed by a number that occurs once.
    """
    prints, low = mix64(x.astype(np.uint64)), 1
    while LEAST_PERIODS * low <= longest:
        with np.errstate(over="ignore"):  # the window of low words becomes one of 2 * low
            prints = mix64(prints[:-low] * np.uint64(0x9E3779B97F4A7C15) + prints[low:])
        tiles = (len(prints) - 1) // low - 1  # centres 2 * low, 3 * low, ...
        if tiles < 1:
            return
        earlier = prints[1:1 + tiles * low].reshape(tiles, low)
        j, t = np.nonzero(earlier == prints[2 * low:2 * low + tiles * low:low][:, None])
        if len(j):
            cuts = np.flatnonzero(np.diff(j, prepend=-1))
            for a, b in zip(cuts, [*cuts[1:], len(j)]):
                yield from solve_tile(x, (int(j[a]) + 2) * low, (2 * low - 1 - t[a:b]).tolist(), low)
        low *= 2


def solve_documents(docs: list[tuple[int | None, list[bytes]]]) -> list[list[tuple[int, int, int]]]:
    """The fragments of each document, counted from its first word."""
    numbers: dict[bytes, int] = {}
    flat: list[int] = []
    starts = []
    for k, (_, words) in enumerate(docs):
        starts.append(len(flat))
        flat += [numbers.setdefault(w, 2 * len(numbers)) for w in words]
        flat.append(2 * k + 1)
    found: list[list[tuple[int, int, int]]] = [[] for _ in docs]
    at = np.array(starts)
    for q, lo, hi in fragments(np.array(flat, np.int64), max((len(w) for _, w in docs), default=0)):
        k = int(np.searchsorted(at, lo, side="right")) - 1
        found[k].append((q, lo - starts[k], hi - starts[k]))
    return found


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def find_fragments(docs: DataFrame, plant: bool) -> DataFrame:
    """``docs`` (id, text) -> FOUND: one numbered row per document, with its words only where it has fragments."""
    schema = arrow_schema(docs.sparkSession, FOUND)

    def run(batches):
        row = TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, list[bytes]]] = []

        def solved() -> pa.RecordBatch:
            nonlocal row, held
            rows = []
            for (doc, words), frags in zip(held, solve_documents(held)):
                body = b" ".join(words)
                rows.append({"row": row, "doc_id": doc, "n_words": len(words),
                             "fragments": [dict(zip(("period", "lo", "hi"), f)) for f in frags],
                             "body": body if frags else None, "whole_sha256": None if frags else sha(body)})
                row += 1
            held = []
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        size = 0
        for batch in batches:
            for doc, text in zip(longs(batch, "id"), texts(batch, "text")):
                words = make_periodic(text.split(), doc) if plant else text.split()
                if held and size + len(words) > LAID_OUT:
                    yield solved()
                    size = 0
                held.append((doc, words))
                size += len(words) + 1
        if held:
            yield solved()
        give_back()

    return docs.mapInArrow(run, FOUND)


def stitch(found: DataFrame) -> DataFrame:
    """Fragments (row, period, lo, hi) -> runs (row, start, length, period).

    Two runs of one period share fewer words than the period; fragments of one run share more.
    """
    by_period = Window.partitionBy("row", "period").orderBy("lo", "hi")
    reached = F.max("hi").over(by_period.rowsBetween(Window.unboundedPreceding, -1))
    new = F.coalesce((F.col("reached") - F.col("lo") < F.col("period")).cast("long"), F.lit(1))
    islands = found.withColumn("reached", reached).withColumn("new", new).withColumn("island", F.sum("new").over(by_period))
    whole = islands.groupBy("row", "period", "island").agg(F.min("lo").alias("start"), F.max("hi").alias("to"))
    return whole.select("row", "start", (F.col("to") - F.col("start")).alias("length"), "period").where(
        (F.col("length") >= LEAST_WORDS) & (F.col("length") >= LEAST_PERIODS * F.col("period")))


def collapse(body: bytes, n: int, runs: list[dict]) -> bytes:
    """The words that no run contains after its first period."""
    words = body.split()
    keep = bytearray(b"\x01") * n
    for r in runs:
        keep[r["start"] + r["period"]:r["start"] + r["length"]] = bytes(r["length"] - r["period"])
    return b" ".join(w for w, k in zip(words, keep) if k)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False) -> DataFrame:
    """Per row of ``docs``: RESULT, with all of its runs by start, then period.

    A word is a maximal run of anything but the six ASCII white-space
    characters; null and empty texts have none and no run.  ``start``,
    ``length``, ``period`` and ``exponent_milli`` are of the longest run
    (ties: smallest start, then period), null without one; ``runs_sha256``
    hashes all runs, ``collapsed_sha256`` the kept words joined by spaces.
    With ``plant`` the words are first made periodic by the contract's rule,
    a null id counting as the empty text.  Equal rows and equal ids each give
    a row of their own; other columns are not read.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    found = stage(find_fragments(rows, plant), "run-fragments")
    runs = stitch(found.where("body is not null").select("row", F.explode("fragments").alias("f")).select("row", "f.*"))
    listed = runs.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "length", "period"))).alias("runs"))

    def finish(batch: pa.RecordBatch) -> dict[str, list]:
        out: dict[str, list] = {"doc_id": longs(batch, "doc_id"), "n_words": longs(batch, "n_words")}
        out |= {c: [] for c in ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")}
        out["runs"] = [sorted(r or [], key=lambda x: (x["start"], x["period"])) for r in batch.column("runs").to_pylist()]
        for n, found_runs, body, whole in zip(out["n_words"], out["runs"], batch.column("body"), batch.column("whole_sha256")):
            best = min(found_runs, key=lambda x: (-x["length"], x["start"], x["period"]), default=None)
            out["n_runs"].append(len(found_runs))
            for c in ("start", "length", "period"):
                out[c].append(best and best[c])
            out["exponent_milli"].append(best and 1000 * best["length"] // best["period"])
            out["runs_sha256"].append(sha("".join(f"{r['start']},{r['length']},{r['period']}\n" for r in found_runs).encode()))
            out["collapsed_sha256"].append(whole.as_py() or sha(collapse(body.as_py(), n, found_runs)))
        return out

    with_runs = found.where("body is not null").join(listed, "row", "left")
    none = found.where("body is null").withColumn("runs", F.lit(None).cast(listed.schema["runs"].dataType))
    shape = ["doc_id", "n_words", "runs", "body", "whole_sha256"]
    return map_batches(with_runs.select(*shape).unionByName(none.select(*shape)), finish, RESULT)


def run_report(docs: DataFrame) -> DataFrame:
    """The contract's rows over planted texts."""
    return periodic_runs(docs, plant=True).drop("runs")
