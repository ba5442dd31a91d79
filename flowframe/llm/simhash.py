"""SimHash near-duplicates found by covering locality-sensitive hashing.

Covering LSH (Pagh, 2016): give each of the 64 bit positions one non-zero
vector of ``radius + 1`` bits.  For every non-zero vector v, the mask of v
holds the positions whose vector has an odd inner product with v.  Any
``radius`` positions leave some v orthogonal to all of them, so two
fingerprints that differ in at most ``radius`` bits agree under at least one
of the ``2 ** (radius + 1) - 1`` masks: no pair within the radius is missed.

Work is done on distinct fingerprints.  A masked fingerprint is a bucket.
Buckets of one need nothing, buckets of two are compared in place, buckets up
to ``BUCKET`` fingerprints are linked by one small matrix.  Larger buckets
are covered again over their free bits only; with every level about half of
the free bits are fixed, so after three levels 7 or 8 bits are free and no
bucket can hold more than 2 ** 8 distinct fingerprints.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import arrow_schema, fold_case, longs, map_batches, stage, texts, words
from flowframe.llm.components import connected_components

BITS = 64
#: Largest bucket compared by one matrix; more distinct fingerprints are covered again.
BUCKET = 256
#: Times the free bits are covered again at most.
LEVELS = 3
XXH64_SEED = 42


def fingerprint(text: bytes, width: int = 3) -> int:
    """SimHash of the word shingles of a text: a bit is 1 when set in over half of the hashes."""
    import xxhash

    ws = words(fold_case(text))
    if not ws:
        return 0
    joined = b" ".join(ws)
    if len(ws) <= width:
        return xxhash.xxh64_intdigest(joined, XXH64_SEED)
    ends = np.cumsum(np.fromiter(map(len, ws), np.int64, len(ws)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[: len(ws) - width + 1].tolist()
    stops = (ends[width - 1:] - 1).tolist()
    h = xxhash.xxh64_intdigest
    hashes = np.array([h(joined[a:b], XXH64_SEED) for a, b in zip(starts, stops)], "<u8")
    ones = np.zeros(BITS, np.int64)
    for i in range(0, len(hashes), 65536):
        part = hashes[i:i + 65536].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0])


def covering_masks(radius: int, free: int = (1 << BITS) - 1) -> list[int]:
    """The masks of the covering over the free bit positions."""
    positions = [i for i in range(BITS) if free >> i & 1]
    vectors = (1 << (radius + 1)) - 1
    given = {p: 1 + k % vectors for k, p in enumerate(positions)}
    return [sum(1 << p for p, m in given.items() if bin(m & v).count("1") % 2) for v in range(1, vectors + 1)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _linked(prints: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Members of one bucket and the root of the component they have within it."""
    near = np.bitwise_count(prints[:, None] ^ prints[None, :]) <= radius
    label = np.arange(len(prints))
    while True:
        lower = np.where(near, label[None, :], len(prints)).min(axis=1)
        if (lower == label).all():
            break
        label = lower
    moved = label != np.arange(len(prints))
    return prints[moved], prints[label[moved]]


def cover(radius: int, levels: int) -> list[list[tuple[int, int, int]]]:
    """Per level the rows (parent path, path, fixed positions); a path names the masks chosen so far."""
    everything, out, parents = (1 << BITS) - 1, [], [(0, 0)]
    for _ in range(levels):
        rows = []
        for parent, fixed in parents:
            for t, mask in enumerate(covering_masks(radius, everything & ~fixed)):
                rows.append((parent, (parent << (radius + 1)) + t + 1, fixed | mask))
        out.append(rows)
        parents = [(path, fixed) for _, path, fixed in rows]
    return out


def fingerprint_links(prints: DataFrame, radius: int = 3) -> DataFrame:
    """``prints`` (print long, distinct) -> links (a, b) that join all pairs within ``radius`` bits.

    The links connect exactly the fingerprints that a chain of pairs within
    the radius connects; not every pair is listed.
    """
    spark, found = prints.sparkSession, []
    rows = prints.select("print", F.lit(0).cast("long").alias("parent"))
    levels = cover(radius, LEVELS)
    for level, paths in enumerate(levels):
        # a fixed table of the rule, at most (2 ** (radius + 1) - 1) ** LEVELS rows
        masks = spark.createDataFrame([(a, b, _signed(c)) for a, b, c in paths], "parent long, path long, fixed long")
        buckets = rows.join(F.broadcast(masks), "parent").select(
            "print", "path", F.col("print").bitwiseAND(F.col("fixed")).alias("key"))
        counted = stage(
            buckets.groupBy("path", "key").agg(
                F.count("*").alias("n"), F.min("print").alias("a"), F.max("print").alias("b")).where("n > 1"),
            "buckets")
        found.append(counted.where("n = 2").where(
            F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).select("a", "b"))
        last = level == len(levels) - 1
        small = counted.where("n > 2") if last else counted.where(F.col("n").between(3, BUCKET))
        found.append(_matrix_links(buckets.join(small.select("path", "key"), ["path", "key"]), radius))
        hot = counted.where(F.col("n") > BUCKET)
        if last or not hot.limit(1).count():
            break
        rows = stage(buckets.join(hot.select("path", "key"), ["path", "key"]).select(
            "print", F.col("path").alias("parent")), "hot-buckets")
    links = found[0]
    for more in found[1:]:
        links = links.union(more)
    return links


def _matrix_links(members: DataFrame, radius: int) -> DataFrame:
    schema = "a long, b long"
    out = arrow_schema(members.sparkSession, schema)

    def link(batches):
        for batch in batches:
            lists = batch.column("prints")
            a, b = [], []
            for x in lists:
                m, root = _linked(x.values.to_numpy(zero_copy_only=False).view(np.uint64), radius)
                a.append(m)
                b.append(root)
            if a:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(v).view(np.int64)) for v in (a, b)], schema=out)

    grouped = members.groupBy("path", "key").agg(F.collect_list("print").alias("prints"))
    return grouped.select("prints").mapInArrow(link, schema)


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       width: int = 3, radius: int = 3) -> DataFrame:
    """One row per document: (id, fingerprint as 16 hex digits, component_id).

    Linked are fingerprints of at most ``radius`` differing bits;
    ``component_id`` is the smallest id reachable, the document's own
    included.  Null and empty texts have fingerprint zero and are linked like
    any other.  Rows with a null id get a fingerprint, link nothing and have
    a null component.  Repeated rows stay repeated.  Columns other than the
    two named ones are not read, so their names cannot clash.
    """
    def signatures(batch):
        return {"id": longs(batch, "id"),
                "print": [_signed(fingerprint(t, width)) for t in texts(batch, "text")]}

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    signed = stage(map_batches(source, signatures, "id long, print long"), "prints")
    owners = stage(signed.where("id is not null").groupBy("print").agg(F.min("id").alias("owner")), "owners")
    a = owners.select(F.col("print").alias("a"), F.col("owner").alias("src"))
    b = owners.select(F.col("print").alias("b"), F.col("owner").alias("dst"))
    links = fingerprint_links(owners.select("print"), radius).distinct().join(a, "a").join(b, "b")
    # an id on rows with several texts owns several fingerprints: its rows are one document
    several = signed.where("id is not null").groupBy("id").agg(
        F.min("print").alias("x"), F.max("print").alias("y")).where("x <> y").select("id")
    same = signed.join(several, "id").join(owners, "print").where("id <> owner").select(
        F.col("id").alias("src"), F.col("owner").alias("dst"))
    comps = connected_components(links.select("src", "dst").union(same))
    best = owners.join(comps.withColumnRenamed("node", "owner"), "owner", "left").select(
        "print", F.coalesce("component", "owner").alias("component_id"))
    return signed.join(best, "print", "left").select(
        F.col("id").alias(id_col), F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"),
        F.when(F.col("id").isNotNull(), F.col("component_id")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, radius: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each component its smallest id stays, on one row.

    Every column of ``docs`` is kept.  Rows with a null id stay as they are.
    Of rows that repeat the smallest id, the one with the least text stays.
    """
    comps = simhash_components(docs, id_col, text_col, width, radius)
    kept = comps.where(F.col(id_col) == F.col("component_id")).select(F.col(id_col).alias("__kept")).distinct()
    first = Window.partitionBy("__kept").orderBy(text_col)
    named = docs.join(kept, docs[id_col] == kept["__kept"]).withColumn("__row", F.row_number().over(first))
    return named.where("__row = 1").drop("__kept", "__row").unionByName(docs.where(F.col(id_col).isNull()))
