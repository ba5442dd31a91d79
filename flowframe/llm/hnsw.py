"""Embedding near-duplicates from hierarchical navigable small-world graphs, one per shard.

Equal vectors of a label are one point.  The points of a label are dealt into
shards of about ``SHARD`` points by a hash; a task builds the graph of a
shard, and every point of the label queries every shard of the label.  A query
walks down the layers greedily and searches the lowest one with a beam.

The beam of a label is the smallest that passes its recall audit.  The audit
needs no brute force: a probe is a point of the shard turned away by just less
than the threshold's angle, in a random direction, so the point itself is an
answer that the search has to find.  The task that builds a graph probes it,
at most ``PROBES`` times a label in all its shards together, at beams that
double until none is missed; the counts are pooled by label.  Where no beam up
to ``WIDEST`` passes, and where a shard has no more points than the beam, the
shard is read whole.  A query whose beam is filled with links may have more of
them: it is asked again with twice the beam, and beyond ``WIDEST`` links in one
shard its links there are read off by a matrix product, exactly.

Links are verified by their cosine in double precision.  A graph meets the
queries of its label as a stream behind it, ``BLOCK`` of them to a task; a
batch of queries reports the number of links of each and a spanning forest of
what it linked, never the pairs of a group; the forests are united into
components.

Graphs are built and searched in lock step: the queries of a block advance
together, each expanding its best unexpanded candidate, so a step is a few
matrix operations for all of them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import arrow_schema, column, give_back, stage
from flowframe.llm.components import connected_components

#: Points of a shard, queries that a task puts to a graph, and those it advances together.
SHARD, BLOCK, TOGETHER = 8192, 65536, 2048
#: Links kept per point above the lowest layer (twice as many there), and the beam while building.
DEGREE, BUILD_BEAM = 12, 48
#: The first and the widest beam; beyond it the shard is read whole.
BEAM, WIDEST = 32, 256
#: Probes of a label in all its shards (at least ``LEAST_PROBES`` a shard), and the share of them that a beam has to find.
PROBES, LEAST_PROBES, RECALL = 1024, 16, 0.995
#: Points inserted together, as a share of those already in the graph.
BATCH = 0.25


class Graph:
    """A layered neighbour graph over unit vectors.  ``links[l]`` holds each point's neighbours, -1 where none."""

    def __init__(self, points: np.ndarray, seed: int = 11):
        self.points = points.astype(np.float32)
        n = len(points)
        draw = np.random.default_rng(seed).random(n)
        level = np.minimum((-np.log(draw) / np.log(DEGREE)).astype(int), 12)
        order = np.argsort(-level, kind="stable")  # the highest layers first: the entry point never changes
        self.points, self.order, level = self.points[order], order, level[order]
        self.level = level
        self.links = [np.full((int((level >= l).sum()), 2 * DEGREE if l == 0 else DEGREE), -1, np.int32)
                      for l in range(int(level.max(initial=0)) + 1)]
        done = min(n, 1)
        while done < n:
            size = max(1, min(n - done, int(done * BATCH)))
            self._insert(np.arange(done, done + size))
            done += size
        self.links[0] = self._both_ways(self.links[0])

    def _both_ways(self, links: np.ndarray) -> np.ndarray:
        """The links with as many back: in a crowd most links go to few points, and a point without any is never found.

        A point that is linked back by many gets the backward links of those that are linked least.
        """
        source, k = np.nonzero(links >= 0)
        target = links[source, k]
        linked = np.bincount(target, minlength=len(links))
        known = set(zip(source.tolist(), target.tolist()))
        back = np.array([(t, s) not in known for s, t in zip(source.tolist(), target.tolist())], bool)
        source, target = source[back], target[back]
        order = np.lexsort((linked[source], target))
        source, target = source[order], target[order]
        _, first, place = np.unique(target, return_index=True, return_inverse=True)
        rank = np.arange(len(target)) - first[place]
        more = np.full((len(links), 2 * DEGREE), -1, np.int32)
        fits = rank < more.shape[1]
        more[target[fits], rank[fits]] = source[fits]
        return np.concatenate([links, more], axis=1)

    def _insert(self, new: np.ndarray) -> None:
        queries = self.points[new]
        at = np.zeros((len(new), 1), np.int32)
        for l in range(len(self.links) - 1, -1, -1):
            inside = self.level[new] >= l
            known = min(int(new[0]), len(self.links[l]))
            if known == 0:
                continue
            if not inside.any():
                at, _ = self.search(queries, at, l, 1)
                continue
            found, sims = self.search(queries, at, l, BUILD_BEAM)
            at = found[:, :1]
            chosen = self._diverse(queries[inside], found[inside], sims[inside], self.links[l].shape[1] // 2)
            members = new[inside]
            self.links[l][members, :chosen.shape[1]] = chosen
            self._link_back(l, members, chosen)

    def _diverse(self, queries: np.ndarray, found: np.ndarray, sims: np.ndarray, most: int) -> np.ndarray:
        """Of the found points the near ones that are not nearer to a point chosen before."""
        n, width = found.shape
        near = self.points[np.maximum(found, 0)]
        chosen = np.full((n, most), -1, np.int32)
        count = np.zeros(n, int)
        between = np.einsum("nad,nbd->nab", near, near)
        taken = np.zeros((n, width), bool)
        rows = np.arange(n)
        for k in range(width):
            blocked = (taken & (between[:, k] > sims[:, k, None])).any(axis=1)
            use = (found[:, k] >= 0) & ~blocked & (count < most)
            chosen[rows[use], count[use]] = found[use, k]
            taken[use, k] = True
            count[use] += 1
        for k in range(width):  # fill up with the nearest that were passed over
            use = (found[:, k] >= 0) & ~taken[:, k] & (count < most)
            chosen[rows[use], count[use]] = found[use, k]
            count[use] += 1
        return chosen

    def _link_back(self, l: int, members: np.ndarray, chosen: np.ndarray) -> None:
        """Offer the new points to those they chose; each keeps a diverse choice of old and new."""
        links, most = self.links[l], self.links[l].shape[1]
        row, k = np.nonzero(chosen >= 0)
        target, source = chosen[row, k], members[row].astype(np.int32)
        sims = np.einsum("nd,nd->n", self.points[target], self.points[source])
        order = np.lexsort((-sims, target))
        target, source = target[order], source[order]
        uniq, first, place = np.unique(target, return_index=True, return_inverse=True)
        rank = np.arange(len(target)) - first[place]
        offered = np.full((len(uniq), most), -1, np.int32)
        offered[place[rank < most], rank[rank < most]] = source[rank < most]
        for a in range(0, len(uniq), 1024):
            t = uniq[a:a + 1024]
            both = np.concatenate([links[t], offered[a:a + 1024]], axis=1)
            sims = np.einsum("nd,nkd->nk", self.points[t], self.points[np.maximum(both, 0)])
            sims[both < 0] = -np.inf
            best = np.argsort(-sims, axis=1, kind="stable")
            links[t] = self._diverse(self.points[t], np.take_along_axis(both, best, 1), np.take_along_axis(sims, best, 1), most)

    def search(self, queries: np.ndarray, at: np.ndarray, l: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Beam search of all queries on one layer from the given points: (points, similarities), nearest first."""
        links, n = self.links[l], len(queries)
        seen = np.zeros((n, len(links)), bool)
        width = max(beam, at.shape[1])
        ids = np.full((n, width), -1, np.int32)
        sims = np.full((n, width), -np.inf, np.float32)
        ids[:, :at.shape[1]] = at
        rows = np.arange(n)
        start = np.einsum("nd,nkd->nk", queries, self.points[np.maximum(at, 0)])
        sims[:, :at.shape[1]] = np.where(at >= 0, start, -np.inf)
        np.put_along_axis(seen, np.maximum(at, 0), True, 1)
        done = np.zeros((n, width), bool)
        live = rows
        while len(live):
            open_ = np.where(done[live] | (ids[live] < 0), -np.inf, sims[live])
            best = open_.argmax(axis=1)
            more = open_[np.arange(len(live)), best] > -np.inf
            live, best = live[more], best[more]
            if not len(live):
                break
            done[live, best] = True
            near = links[ids[live, best]]
            fresh = (near >= 0) & ~np.take_along_axis(seen[live], np.maximum(near, 0), 1)
            i, k = np.nonzero(fresh)
            seen[live[i], near[i, k]] = True
            value = np.full(near.shape, -np.inf, np.float32)
            value[i, k] = np.einsum("nd,nd->n", queries[live[i]], self.points[near[i, k]])
            all_ids = np.concatenate([ids[live], np.where(fresh, near, -1)], axis=1)
            all_sims = np.concatenate([sims[live], value], axis=1)
            all_done = np.concatenate([done[live], np.zeros(near.shape, bool)], axis=1)
            pick = np.argsort(-all_sims, axis=1, kind="stable")[:, :width]
            ids[live] = np.take_along_axis(all_ids, pick, 1)
            sims[live] = np.take_along_axis(all_sims, pick, 1)
            done[live] = np.take_along_axis(all_done, pick, 1)
        order = np.argsort(-sims, axis=1, kind="stable")
        return np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)

    def nearest(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        at = np.zeros((len(queries), 1), np.int32)
        for l in range(len(self.links) - 1, 0, -1):
            at, _ = self.search(queries, at, l, 1)
        return self.search(queries, at[:, :1], 0, beam)

    def whole(self, queries: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """All pairs (query, point) at or above ``least``, by matrix products."""
        pairs = [np.nonzero(queries[a:a + 512] @ self.points.T >= np.float32(least - 1e-4)) for a in range(0, len(queries), 512)]
        return (np.concatenate([i + 512 * n for n, (i, _) in enumerate(pairs)] or [np.zeros(0, int)]),
                np.concatenate([self.order[k] for _, k in pairs] or [np.zeros(0, int)]))

    def audit(self, probes: int, least: float) -> list[tuple[int, int, int]]:
        """Per first beam up to ``WIDEST``: (beam, probes whose point is found from it on, probes).

        A probe whose beam is filled with links is asked again with the next one, like any query.
        """
        draw = np.random.default_rng(len(self.points))
        n, inside = min(probes, len(self.points)), least + (1 - least) / 50
        chosen = draw.choice(len(self.points), n, replace=False)
        points = self.points[chosen].astype(np.float64)
        away = draw.standard_normal(points.shape)
        away -= (away * points).sum(1, keepdims=True) * points
        lengths = np.sqrt((away * away).sum(1, keepdims=True))
        # in one dimension nothing turns away from a point
        queries = np.where(lengths > 1e-9, inside * points + np.sqrt(1 - inside * inside) * away / np.maximum(lengths, 1e-9), points)
        queries = queries.astype(np.float32)
        beams = [BEAM << k for k in range(16) if BEAM << k <= WIDEST]
        open_, steps = np.arange(n), []
        for beam in beams:  # a wider beam is put to what a narrower one has not found or has sent on
            ids, sims = self.nearest(queries[open_], min(beam, len(self.points)))
            sent_on = (sims[:, -1] >= np.float32(least - 1e-4)) & (ids[:, -1] >= 0)
            found = (ids == chosen[open_][:, None]).any(axis=1)
            steps.append((beam, open_, sent_on, found))
            open_ = open_[sent_on | ~found]
        answered = np.ones(n, bool)  # what is sent on beyond the widest beam is read off whole
        out = []
        for beam, asked, sent_on, found in reversed(steps):
            answered[asked] = np.where(sent_on, answered[asked], found)
            out.append((beam, int(answered.sum()), n))
        return out

    def within(self, queries: np.ndarray, least: float, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query, point) found at or above ``least`` from the given first beam on; points in the order given to the graph."""
        queries = queries.astype(np.float32)
        loose = np.float32(least - 1e-4)  # single precision finds, double precision decides
        rest, pairs = np.arange(len(queries)), []
        while len(rest):
            if beam > WIDEST or beam >= len(self.points):
                i, k = self.whole(queries[rest], least)
                pairs.append((rest[i], k))
                break
            ids, sims = self.nearest(queries[rest], beam)
            hit = (sims >= loose) & (ids >= 0)
            full = hit[:, -1]  # a beam whose farthest member is still a link may have more beyond it
            i, k = np.nonzero(hit & ~full[:, None])
            pairs.append((rest[i], self.order[ids[i, k]]))
            rest = rest[full]
            beam *= 2
        if not pairs:
            return np.zeros(0, int), np.zeros(0, int)
        return np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])

    def as_bytes(self) -> dict[str, bytes | list[bytes]]:
        return {"places": self.order.astype("<i4").tobytes(), "layers": [x.astype("<i4").tobytes() for x in self.links]}

    @classmethod
    def from_bytes(cls, points: np.ndarray, places: bytes, layers: list[bytes]) -> Graph:
        """The graph of ``points``, in the order they were given, from what ``as_bytes`` wrote."""
        graph = cls.__new__(cls)
        graph.order = np.frombuffer(places, "<i4")
        graph.points = points.astype(np.float32)[graph.order]
        graph.links = [np.frombuffer(x, "<i4").reshape(-1, 4 * DEGREE if l == 0 else DEGREE) for l, x in enumerate(layers)]
        return graph


def _vectors(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids and unit vectors in double precision of points of one length."""
    flat = column(table, "vector")
    x = flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # lengths of very large or small vectors stay finite
    return column(table, "id").to_numpy(), x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _units(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    ids, x = _vectors(table)
    return ids, column(table, "copies").to_numpy(), x


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest member of each node's component, from links a-b among nodes below n."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        following = label.copy()
        np.minimum.at(following, a, low)
        np.minimum.at(following, b, low)
        following = following[following]
        if (following == label).all():
            return label
        label = following


GRAPH = ("ids binary, copies binary, vectors binary, places binary, layers array<binary>, "
         "audit array<struct<beam:int,found:long,probes:long>>")


def deal(points: DataFrame) -> DataFrame:
    """``points`` (label, length, id, ...) with the shard and the block of queries that each falls into."""
    sizes = points.groupBy("label", "length").agg(F.count("*").alias("n"))
    return points.join(sizes, ["label", "length"]).select(
        "*", F.ceil(F.col("n") / SHARD).alias("shards"), F.ceil(F.col("n") / BLOCK).alias("blocks")).withColumns({
            "shard": F.pmod(F.xxhash64("id"), F.col("shards")), "block": F.pmod(F.xxhash64("id", F.lit(1)), F.col("blocks"))})


def shard_graphs(points: DataFrame, least: float) -> DataFrame:
    """``points`` (label, length, shard, shards, id, copies, vector) -> one audited graph per (label, length, shard)."""
    label_type = points.schema["label"].dataType.simpleString()
    schema = f"label {label_type}, length int, shard long, {GRAPH}"
    out = arrow_schema(points.sparkSession, schema)

    def build(group: pa.Table) -> pa.Table:
        ids, copies, x = _units(group)
        graph = Graph(x)
        probes = max(LEAST_PROBES, PROBES // group.column("shards")[0].as_py())
        row = {c: group.column(c)[0].as_py() for c in ("label", "length", "shard")} | graph.as_bytes() | {
            "ids": ids.astype("<i8").tobytes(), "copies": copies.astype("<i8").tobytes(), "vectors": x.astype("<f8").tobytes(),
            "audit": [dict(zip(("beam", "found", "probes"), a)) for a in graph.audit(probes, least)]}
        give_back()
        return pa.Table.from_pylist([row], schema=out)

    return points.groupBy("label", "length", "shard").applyInArrow(build, schema)


def audited_beams(graphs: DataFrame) -> DataFrame:
    """(label, length, beam): the smallest beam that finds its share of the probes of all shards; none, no row."""
    audits = graphs.select("label", "length", F.explode("audit").alias("a")).groupBy("label", "length", "a.beam").agg(
        F.sum("a.found").alias("found"), F.sum("a.probes").alias("probes"))
    return audits.where(F.col("found") >= RECALL * F.col("probes")).groupBy("label", "length").agg(F.min("beam").alias("beam"))


def query_shards(graphs: DataFrame, points: DataFrame, least: float) -> DataFrame:
    """Every point against every graph of its label and length: (src, dst, links, searched).

    A row with ``dst`` null says how many rows ``src`` is linked with in a
    shard; the others are the edges of a spanning forest.  A row without
    ``src`` counts the queries that a graph was searched for.
    """
    schema = "src long, dst long, links long, searched long"
    out = arrow_schema(points.sparkSession, schema)
    counted = points.groupBy("label", "length").agg(F.max("blocks").alias("blocks"))
    beams = stage(audited_beams(graphs), "beams")
    heads = graphs.join(counted, ["label", "length"]).join(beams, ["label", "length"], "left").select(
        "label", "length", "shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"),
        F.lit(0).alias("part"), F.lit(None).cast("long").alias("id"), F.lit(None).cast("array<double>").alias("vector"),
        F.coalesce("beam", F.lit(2 * WIDEST)).alias("beam"), "ids", "copies", "vectors", "places", "layers")
    asked = points.select("label", "length", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)).alias("shard"), "block",
                          F.lit(1).alias("part"), "id", "vector")
    meeting = heads.unionByName(asked, allowMissingColumns=True)
    lined = meeting.repartition("label", "length", "shard", "block").sortWithinPartitions("label", "length", "shard", "block", "part")

    def ask(batches):
        graph, held, count = None, [], 0

        def answer() -> pa.RecordBatch:
            ids, copies, x, index, beam = graph
            own = np.concatenate([h[0] for h in held])
            queries = np.concatenate([h[1] for h in held])
            q, p = index.within(queries, least, beam)
            cosine = np.concatenate([np.einsum("nd,nd->n", queries[q[a:a + 65536]], x[p[a:a + 65536]])
                                     for a in range(0, max(1, len(q)), 65536)])
            real = (cosine >= least) & (own[q] != ids[p])
            q, p = q[real], p[real]
            nodes, place = np.unique(np.concatenate([own[q], ids[p]]), return_inverse=True)
            root = _roots(place[:len(q)], place[len(q):], len(nodes))
            moved = np.flatnonzero(root != np.arange(len(nodes)))
            links = np.bincount(q, copies[p], len(own)).astype(np.int64)
            some = np.flatnonzero(links)
            searched = len(own) if beam <= WIDEST and beam < len(ids) else 0
            src = pa.array([*own[some], *nodes[moved], None], pa.int64())
            dst = pa.array([*[None] * len(some), *nodes[root[moved]], None], pa.int64())
            return pa.RecordBatch.from_arrays([src, dst, pa.array([*links[some], *[0] * len(moved), 0], pa.int64()),
                                               pa.array([*[0] * (len(some) + len(moved)), searched], pa.int64())], schema=out)

        for b in batches:
            parts = b.column("part").to_pylist()
            at = 0
            while at < len(parts):
                if parts[at] == 0:
                    if count:
                        yield answer()
                    held, count = [], 0
                    one = {c: b.column(c)[at].as_py() for c in ("ids", "copies", "vectors", "places", "layers", "beam", "length")}
                    x = np.frombuffer(one["vectors"], "<f8").reshape(-1, one["length"])
                    graph = (np.frombuffer(one["ids"], "<i8"), np.frombuffer(one["copies"], "<i8"), x,
                             Graph.from_bytes(x, one["places"], one["layers"]), one["beam"])
                    at += 1
                    continue
                end = at
                while end < len(parts) and parts[end] == 1 and count + end - at < TOGETHER:
                    end += 1
                held.append(_vectors(b.slice(at, end - at)))
                count += end - at
                at = end
                if count >= TOGETHER:
                    yield answer()
                    held, count = [], 0
        if count:
            yield answer()
        give_back()

    return lined.mapInArrow(ask, schema)


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    least: float = 0.98) -> DataFrame:
    """Per row of ``vectors``: (id, n_links, component_id, kept).

    Two vectors are linked when their labels are equal and not null and the
    cosine is at least ``least``.  Vectors that are null, empty or zero, hold
    null or non-finite components, or have no label link with nothing; so do
    vectors of different length.  ``n_links`` counts the other rows linked
    directly; ``component_id`` is the smallest id reachable, the row's own
    included; ``kept`` marks the rows whose id that is.  Rows with a null id
    link nothing and have a null component.  Rows that repeat an id and its
    vector count as copies of each other.  Only the named columns are read.
    """
    v = F.col(vector_col).cast("array<double>")
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"),
        F.when(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & F.coalesce(sound, F.lit(False)), v).alias("vector"))
    points = stage(rows.where("vector is not null").groupBy("label", "vector").agg(
        F.min("id").alias("id"), F.count("*").alias("copies")).withColumn("length", F.size("vector")), "points")
    dealt = deal(points)
    graphs = stage(shard_graphs(dealt, least), "graphs")
    answers = stage(query_shards(graphs, dealt, least), "answers")
    direct = answers.where("dst is null and src is not null").groupBy(F.col("src").alias("point")).agg(F.sum("links").alias("links"))
    comps = connected_components(answers.where("dst is not null").select("src", "dst"))
    found = points.select("label", "vector", F.col("id").alias("point"), "copies").join(
        direct, "point", "left").join(comps.withColumnRenamed("node", "point"), "point", "left")
    return rows.join(found, ["label", "vector"], "left").select(
        F.col("id").alias(id_col),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("long").alias("n_links"),
        F.coalesce("component", "point", "id").alias("component_id"),
        F.coalesce(F.coalesce("component", "point", "id") == F.col("id"), F.lit(False)).alias("kept"))
