import numpy as np
import pytest
from flowframe.llm import hnsw
from flowframe.llm.common import stage
from pyspark.sql import functions as F


def clusters(n_clusters, most, d=24, spread=0.06, seed=0):
    draw = np.random.default_rng(seed)
    rows = []
    for _ in range(n_clusters):
        centre = draw.normal(size=d)
        for _ in range(draw.integers(1, most + 1)):
            rows.append(centre + spread * draw.normal(size=d))
    return np.array(rows)


def brute(rows, least=0.98):
    """Links per row and components of (id, vector or None, label)."""
    n, linked = len(rows), {}
    units = [None if v is None or lab is None or i is None or not np.all(np.isfinite(v)) or not np.any(v)
             else np.array(v, float) / np.linalg.norm(v) for i, v, lab in rows]
    near = [[b for b in range(n) if b != a and units[a] is not None and units[b] is not None and len(units[a]) == len(units[b])
             and rows[a][2] == rows[b][2] and units[a] @ units[b] >= least] for a in range(n)]
    label = [r[0] for r in rows]
    changed = True
    while changed:
        changed = False
        for a in range(n):
            low = min([label[a], *(label[b] for b in near[a])]) if near[a] else label[a]
            if low != label[a]:
                label[a], changed = low, True
    del linked
    return [len(x) for x in near], label


def passing_beam(graph, least=0.98):
    return min((beam for beam, found, probes in graph.audit(hnsw.PROBES, least) if found >= hnsw.RECALL * probes), default=2 * hnsw.WIDEST)


@pytest.mark.parametrize("shape", [(400, 3), (6, 300), (3000, 2)])
def test_graph_finds_the_pairs(shape):
    x = clusters(*shape)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = hnsw.Graph(x)
    beam = passing_beam(graph)
    assert beam <= hnsw.WIDEST
    copy = hnsw.Graph.from_bytes(x, **graph.as_bytes())
    q, p = copy.within(x, 0.98, beam)
    want = set(zip(*np.nonzero(x @ x.T >= 0.98)))
    found = set(zip(q.tolist(), p.tolist()))
    assert len(found) == len(q) and len(want & found) >= 0.99 * len(want)
    assert min(x[a] @ x[b] for a, b in found) >= 0.98 - 2e-4


def test_a_graph_that_finds_nothing_passes_no_beam(monkeypatch):
    graph = hnsw.Graph(rare_links())
    monkeypatch.setattr(hnsw.Graph, "nearest", lambda self, q, beam: (
        np.full((len(q), beam), -1, np.int32), np.full((len(q), beam), -np.inf, np.float32)))
    assert all(found == 0 < probes for _, found, probes in graph.audit(500, 0.98)) and passing_beam(graph) > hnsw.WIDEST
    q, p = graph.within(rare_links(), 0.98, 2 * hnsw.WIDEST)  # the shard is read whole
    x = rare_links()
    assert set(zip(q.tolist(), p.tolist())) == set(zip(*(k.tolist() for k in np.nonzero(x @ x.T >= 0.98 - 1e-4))))


def answered(df, least=0.98):
    """(graphs, answers, points) of the stages inside ``near_duplicates``."""
    points = df.select(F.col("label"), F.col("embedding").cast("array<double>").alias("vector"), F.col("vec_id").cast("long").alias("id"),
                       F.lit(1).cast("long").alias("copies"), F.size("embedding").alias("length"))
    dealt = hnsw.deal(points)
    graphs = stage(hnsw.shard_graphs(dealt, least), "test-graphs")
    return graphs, stage(hnsw.query_shards(graphs, dealt, least), "test-answers"), dealt


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_labels_of_the_tables_are_answered_from_their_graphs(spark, sf):
    df = spark.read.parquet(f"/root/testdata/{sf}/embeddings.parquet")
    graphs, answers, dealt = answered(df)
    beams = {r["label"]: r["beam"] for r in hnsw.audited_beams(graphs).collect()}
    sizes = {(r["label"], r["shard"]): r["count"] for r in dealt.groupBy("label", "shard").count().collect()}
    asked = {(label, shard): sum(n for (other, _), n in sizes.items() if other == label) for label, shard in sizes}
    assert max(sizes.values()) > hnsw.BEAM and all(beams[label] <= hnsw.WIDEST for label, _ in sizes)
    from_graphs = sum(n for (label, shard), n in asked.items() if sizes[label, shard] > beams[label])
    assert answers.agg(F.sum("searched")).first()[0] == from_graphs > 0.9 * df.count()


def test_planted_links_in_many_shards_are_found_by_the_graphs(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 400)
    monkeypatch.setattr(hnsw, "BLOCK", 1500)
    common, rare = clusters(1200, 3, seed=9), rare_links(2000, 40)
    rows = [(i, v.tolist(), 0 if i < len(common) else 1) for i, v in enumerate([*common, *rare])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    graphs, answers, _ = answered(df)
    assert graphs.groupBy("label").count().agg(F.min("count")).first()[0] >= 5
    shards = {r["label"]: r["count"] for r in graphs.groupBy("label").count().collect()}
    assert answers.agg(F.sum("searched")).first()[0] == len(common) * shards[0] + len(rare) * shards[1]
    found = {r["src"]: r["links"] for r in answers.where("dst is null and src is not null").groupBy("src").agg(F.sum("links").alias("links")).collect()}
    for part, least in ((range(len(common)), 0.99), (range(len(common), len(rows)), 0.99)):
        units = np.array([rows[i][1] for i in part])
        units /= np.linalg.norm(units, axis=1, keepdims=True)
        want = int((units @ units.T >= 0.98).sum()) - len(units)
        assert want >= 60 and least * want <= sum(found.get(i, 0) for i in part) <= want


def test_rows_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(hnsw, "SHARD", 150)  # several shards and blocks a label
    monkeypatch.setattr(hnsw, "BLOCK", 100)
    x = clusters(160, 6, seed=4)
    x = np.concatenate([x, x[:40]])
    rows = [(i * 3, v.tolist(), int(i % 2) if i < 500 else 0) for i, v in enumerate(x)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = {r["vec_id"]: r for r in hnsw.near_duplicates(df).collect()}
    links, component = brute(rows)
    found = [out[r[0]]["n_links"] for r in rows]
    assert all(f <= w for f, w in zip(found, links)) and sum(found) >= 0.99 * sum(links) > 0
    if found == links:
        assert [out[r[0]]["component_id"] for r in rows] == component
    assert all(r["kept"] == (r["component_id"] == r["vec_id"]) for r in out.values())


def rare_links(n=1500, pairs=150, seed=6):
    """Vectors of which few have a partner, at an angle just inside the threshold."""
    x = np.random.default_rng(seed).normal(size=(n, 24))
    x[n - pairs:] = x[:pairs] + 0.12 * np.random.default_rng(seed + 1).normal(size=(pairs, 24))
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def test_table_recall(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    out = {r["vec_id"]: r["n_links"] for r in hnsw.near_duplicates(df).collect()}
    assert len(out) == len(rows) and sum(out.values()) >= 0.9 * sum(brute(rows)[0])


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [1.0, 0.0], 2), (5, None, 1), (6, [0.0, 0.0], 1),
            (7, [nan, 1.0], 1), (8, [inf, 1.0], 1), (9, [], 1), (10, [1.0, 0.0], None), (11, [1.0, 0.0, 0.0], 1),
            (None, [1.0, 0.0], 1), (12, [1e200, 0.0], 1), (13, [1e-200, 1e-203], 1), (14, [-0.0, 5.0], 1), (15, [0.0, 5.0], 1),
            (None, None, None), (16, [None, 1.0], 1)]
    wide = [(i, v, lab, 1, "x", 2, 3) for i, v, lab in rows]
    df = spark.createDataFrame(wide, "vec_id long, embedding array<double>, label int, id long, vector string, copies int, point int")
    out = sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in hnsw.near_duplicates(df).collect()),
                 key=lambda r: (r[0] is None, r[0] or 0))
    first = [(i, 4, 1, i == 1) for i in (1, 2, 3)]
    alone = [(i, 0, i, True) for i in (4, 5, 6, 7, 8, 9, 10, 11)]
    rest = [(12, 4, 1, False), (13, 4, 1, False), (14, 1, 14, True), (15, 1, 14, False), (16, 0, 16, True)]
    assert out == [*first, *alone, *rest, (None, 0, None, False), (None, 0, None, False)]
    assert hnsw.near_duplicates(df.where("false")).collect() == []


def test_repeated_rows(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0], 0), (1, [1.0, 2.0], 0), (2, [2.0, 1.0], 0)], "vec_id long, embedding array<float>, label int")
    out = sorted(tuple(r) for r in hnsw.near_duplicates(df).collect())
    assert out == [(1, 1, 1, True), (1, 1, 1, True), (2, 0, 2, True)]
