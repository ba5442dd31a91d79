import os

import duckdb
import pytest
from conftest_llm import WORD
from flowframe.llm import mixing


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Hand the total out by weight; what a full source cannot take goes to the others, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    target, open_, rest = {}, set(order), share * sum(sizes.values())
    while open_:
        level = rest / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > most * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        target |= {s: most * sizes[s] for s in full}
        rest -= sum(target[s] for s in full)
        open_ -= full
    return target


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 5, "c": 70, None: 30}, {"a": 1}, {"a": 0, "b": 10}, {None: 7, "": 9, "￿": 100, "\U0001F600": 3, "Z": 50, "z": 1}])
def test_targets(spark, sizes):
    df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, source_size long")
    got = {r["source"]: r["target"] for r in mixing.source_targets(df).collect()}
    assert got == pytest.approx(brute_targets(sizes))


def test_mix_matches_its_sql_and_its_targets(spark, sf_dir, documents):
    rows = sorted(tuple(r) for r in mixing.mix_report(documents).collect())
    con = duckdb.connect()
    con.execute(f"create view documents as select * from read_parquet('{os.path.join(sf_dir, 'documents.parquet')}')")
    want = sorted(con.execute(mixing.MIX_SQL).fetchall())
    assert len(rows) == len(want)
    for a, b in zip(rows, want):
        assert a == pytest.approx(b)
    sources = {r["doc_id"]: r["source"] for r in documents.collect()}
    taken, target, largest = {}, {}, {}
    for doc_id, size, _, aim, words in rows:
        s = sources[doc_id]
        taken[s], target[s], largest[s] = taken.get(s, 0) + words, aim, max(largest.get(s, 0), size)
        assert words in (0, size, 2 * size)
    for s in taken:
        assert abs(taken[s] - target[s]) <= 2 * largest[s]
    again = sorted(tuple(r) for r in mixing.mix_report(documents.repartition(5)).collect())
    assert again == rows


def test_odd_rows(odd_documents, odd_rows, no_documents):
    plan = mixing.mix_plan(odd_documents).collect()
    assert len(plan) == len(odd_rows)
    sizes = {}
    for r in odd_rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(WORD.findall(r[1] or ""))
    assert {r["source"]: r["source_size"] for r in plan} == sizes
    assert {r["source"]: r["target"] for r in plan} == pytest.approx(brute_targets(sizes))
    mixed = mixing.mix(odd_documents)
    assert mixed.columns == odd_documents.columns
    assert mixed.count() == sum(r["copies"] for r in plan)
    assert mixing.mix(no_documents).collect() == [] == mixing.mix_report(no_documents).collect()


def test_one_size_and_source_for_all(spark):
    """A hot (source, size) group is numbered in chunks; the copies still follow the rate exactly."""
    docs = spark.range(5000).selectExpr("id as doc_id", "'w w w' as text", "if(id < 4000, 's', 't') as source")
    got = {r["source"]: (r["n"], r["target"]) for r in mixing.mix_plan(docs).groupBy("source", "target").agg(
        {"copies": "sum"}).selectExpr("source", "target", "`sum(copies)` as n").collect()}
    for n, target in got.values():
        assert abs(3 * n - target) <= 3


def test_rows_without_an_id_spread(spark):
    """5,000 null ids, and as many rows of one id: neither lies in one chunk, and both are sampled evenly."""
    docs = spark.range(10_000).selectExpr("if(id < 5000, null, 7) as doc_id", "concat('w w w', id) as text", "'s' as source").union(
        spark.range(2000).selectExpr("id as doc_id", "'w w w w' as text", "'t' as source"))
    h = mixing.row_hash(docs["doc_id"], docs["text"])
    assert docs.where("source = 's'").select((h % 64).alias("c")).groupBy("c").count().agg({"count": "max"}).first()[0] < 300
    got = {(r["source"], r["id"] is None): r["n"] for r in mixing.mix_plan(docs).groupBy("source", "id").agg(
        {"copies": "sum"}).selectExpr("source", "id", "`sum(copies)` as n").where("source = 's'").collect()}
    target = mixing.mix_plan(docs).where("source = 's'").first()["target"]
    assert all(abs(3 * n - target / 2) < 0.02 * target for n in got.values()) and len(got) == 2
    assert abs(3 * sum(got.values()) - target) <= 6


def test_of_sixteen_offsets_the_closest_is_used(spark):
    """Few documents and one long: what is taken is as close to the target as any of the drawn offsets comes."""
    import hashlib
    import math

    docs = spark.createDataFrame([(s * 100 + i, " ".join(["w"] * n), f"s{s}") for s in range(6)
                                  for i, n in enumerate([1, 2, 3, 5, 8, 90 + s])], "doc_id long, text string, source string")
    rows = mixing.mix_plan(docs).collect()
    for source in {r["source"] for r in rows}:
        own = sorted((r for r in rows if r["source"] == source), key=lambda r: r["size"])  # each size is a class, in order
        rate = own[0]["target"] / own[0]["source_size"]
        offs = []
        for j in range(16):
            u = int(hashlib.md5(f"mix:{j}:{source}".encode()).hexdigest()[:8], 16) / 2.0 ** 32
            offs.append(abs(sum((math.floor(k * rate + u) - math.floor((k - 1) * rate + u)) * r["size"]
                                for k, r in enumerate(own, 1)) - own[0]["target"]))
        assert abs(sum(r["copies"] * r["size"] for r in own) - own[0]["target"]) == min(offs)
