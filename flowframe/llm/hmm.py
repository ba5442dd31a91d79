"""A hidden Markov language model trained over the whole corpus, beside a smoothed unigram base score.

Tokens of a text are its lower-cased words and one end token.  The tokens are
laid out once: documents are gathered into blocks of about ``BLOCK_TOKENS``
tokens, each a row with its own vocabulary, and every later step reads those
rows.  A block sends the counts of its words, known by 64-bit hashes, to
segments of the hash range; each segment adds them up and answers every block
with the counts of that block's words.  Neither the driver nor any task ever
holds the vocabulary of the corpus.

Model.  Every token has a class: the most frequent words have one each, every
other word shares one of ``SHAPES`` classes picked by its ending and length
(known or not), so there are ``FREQUENT + SHAPES`` classes whatever the
corpus.  A document is a path of hidden states; a state emits a class, a class
emits its word by smoothed relative frequency.  Each class keeps a share for
unseen words, so probabilities over all known words and one unseen word per
class sum to one.  Baum-Welch runs over all training documents: each
partition adds up its expected counts, Spark sums them, and the next tables
(bounded by states x classes) go out with the next job.  The score is the
scaled forward recursion, an exact likelihood.

Documents of a block advance together, one token at a time, as rows of a
matrix.  A document longer than ``PIECE`` tokens is cut into pieces that
advance beside the others: what a piece does to a distribution over the
states is a matrix, found for all pieces at once; these are chained from the
front and from the back of the document, and with what enters each piece its
own recursion is the same as if the document had been walked in one go.  So
the steps of a block are bounded by ``PIECE``; the memory of a step grows with
the tokens of a document, of which a block holds at least one whole.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import (
    arrow_schema, column, fold_case, give_back, longs, pack, rows_table, runs, stage, texts, unpack, words,
)
from flowframe.session import shuffle_partitions

BLOCK_TOKENS = 1 << 20
#: Words that meet in one segment, on average.
SEGMENT_WORDS = 1 << 18
STATES = 6
FREQUENT, SHAPES = 16384, 4096
#: Rounds end when one raises the log10 likelihood of a token by less than this.
SETTLED = 0.01
#: Tokens that are walked one after another.
PIECE = 1024
SMOOTH = 0.1
#: The end of a text, a word that no text can hold.
END = b" "
_BLOCKS = ("block long, ids array<bigint>, training array<boolean>, sizes array<bigint>, tokens binary, "
           "hashes binary, shapes binary, seen binary")
_COUNTED = "segment long, block long, hashes binary, shapes binary, counts binary"


def shape_class(word: bytes) -> int:
    """One of ``SHAPES`` classes by the last two bytes and the length of a word."""
    tail = (b"\x00" + word)[-2:]
    return (tail[0] * 31 + tail[1] * 7 + min(len(word), 20) * 257) % SHAPES


def token_blocks(docs: DataFrame, id_col: str, text_col: str, training) -> DataFrame:
    """The documents as staged rows of about ``BLOCK_TOKENS`` tokens (a longer document is a row of its own).

    A row: (block, ids, training, sizes; tokens = places in the block's
    vocabulary; per place the word's hash, its shape class and how often it
    occurs in training documents of the block).
    """
    schema = arrow_schema(docs.sparkSession, _BLOCKS)

    def run(batches):
        gathered = _Gathered()
        for batch in batches:
            for i, t, text in zip(longs(batch, "id"), longs(batch, "training"), texts(batch, "text")):
                gathered.add(i, bool(t), text)
                if gathered.total >= BLOCK_TOKENS:
                    yield gathered.row(schema)
                    gathered = _Gathered()
        if gathered.ids:
            yield gathered.row(schema)
        give_back()

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), training.alias("training"))
    rows = source.mapInArrow(run, _BLOCKS)
    return stage(rows.withColumn("block", F.monotonically_increasing_id()), "token-blocks")


class _Gathered:
    """A block while it grows."""

    def __init__(self):
        self.ids, self.training, self.sizes, self.tokens = [], [], [], []
        self.places: defaultdict[bytes, int] = defaultdict()
        self.places.default_factory = self.places.__len__  # a new word gets the next place
        self.total = 0

    def add(self, doc_id: int | None, training: bool, text: bytes) -> None:
        row = list(map(self.places.__getitem__, words(fold_case(text))))
        row.append(self.places[END])
        self.ids.append(doc_id)
        self.training.append(training)
        self.sizes.append(len(row))
        self.tokens.append(np.array(row, np.uint32))
        self.total += len(row)

    def row(self, schema: pa.Schema) -> pa.RecordBatch:
        flat = np.concatenate(self.tokens)
        seen = np.bincount(flat[np.repeat(self.training, self.sizes)], minlength=len(self.places))
        hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in self.places], "<u8")
        shapes = np.array([shape_class(w) for w in self.places], np.uint32)
        cells = (0, self.ids, self.training, self.sizes, pack(flat), hashes.tobytes(), pack(shapes), pack(seen))
        return pa.RecordBatch.from_arrays([pa.array([x], f.type) for x, f in zip(cells, schema)], schema=schema)


class Chain:
    """The parameters: start, move (states x states) and emit (states x classes)."""

    def __init__(self, start: np.ndarray, move: np.ndarray, emit: np.ndarray):
        self.start, self.move, self.emit = start, move, emit

    @classmethod
    def initial(cls, class_counts: np.ndarray, seed: int = 7) -> Chain:
        """Every state near the corpus's class distribution, moved apart by fixed pseudo-random factors."""
        draw = np.random.default_rng(seed)
        emit = (class_counts + SMOOTH) * draw.uniform(0.3, 1.7, (STATES, len(class_counts)))
        move = np.full((STATES, STATES), 0.3 / STATES) + 0.7 * np.eye(STATES)
        return cls(np.full(STATES, 1 / STATES), move, emit / emit.sum(axis=1, keepdims=True))

    @classmethod
    def from_counts(cls, start: np.ndarray, move: np.ndarray, emit: np.ndarray) -> Chain:
        """Relative frequencies of expected counts, smoothed so that nothing becomes impossible."""
        start, move, emit = start + SMOOTH, move + SMOOTH, emit + SMOOTH
        return cls(start / start.sum(), move / move.sum(axis=1, keepdims=True), emit / emit.sum(axis=1, keepdims=True))


class _Pieces:
    """The pieces of documents of given sizes, laid end to end."""

    def __init__(self, sizes: np.ndarray):
        self.first_token = np.cumsum(sizes) - sizes
        self.count = -(-sizes // PIECE)
        self.doc = np.repeat(np.arange(len(sizes)), self.count)
        self.base = np.cumsum(self.count) - self.count  # the first piece of each document
        self.number = np.arange(len(self.doc)) - self.base[self.doc]
        self.start = self.first_token[self.doc] + self.number * PIECE
        self.length = np.minimum(PIECE, sizes[self.doc] - self.number * PIECE)


def _steps(length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pieces by falling length, and how many are still running at each step."""
    order = np.argsort(-length, kind="stable")
    return order, np.searchsorted(-length[order], -np.arange(int(length.max(initial=0))), side="left")


def _transfers(chain: Chain, emit: np.ndarray, classes: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Of each piece, up to a factor: from the state at its first token, the state at its last one and all its tokens."""
    order, running = _steps(length)
    start, m = start[order], np.broadcast_to(np.eye(STATES), (len(order), STATES, STATES)).copy()
    for t, n in enumerate(running):
        ahead = m[:n] if t == 0 else m[:n] @ chain.move
        ahead = ahead * emit[classes[start[:n] + t]][:, None, :]
        m[:n] = ahead / ahead.sum(axis=(1, 2), keepdims=True)
    out = np.empty_like(m)
    out[order] = m
    return out


def _entering(chain: Chain, emit: np.ndarray, classes: np.ndarray, p: _Pieces, backward: bool) -> tuple[np.ndarray, np.ndarray]:
    """What is known of the state at each piece's first token from the tokens before it, and, if asked for, of the
    state at its last token from those after it (up to a factor)."""
    ahead = np.broadcast_to(chain.start, (len(p.doc), STATES)).copy()
    beyond = np.ones((len(p.doc), STATES))
    last = p.number == p.count[p.doc] - 1
    cut = np.flatnonzero(p.count[p.doc] > 1) if backward else np.flatnonzero(~last)
    if len(cut):
        place = np.full(len(p.doc), -1)
        place[cut] = np.arange(len(cut))
        through = _transfers(chain, emit, classes, p.start[cut], p.length[cut])
        most = int(p.count.max())
        for k in range(most - 1):
            at = p.base[p.count > k + 1] + k
            v = np.einsum("ns,nst->nt", ahead[at], through[place[at]])
            ahead[at + 1] = (v / v.sum(axis=1, keepdims=True)) @ chain.move
        for k in range(most - 1, 0, -1) if backward else ():
            at = p.base[p.count > k] + k
            v = np.einsum("nst,nt->ns", through[place[at]], beyond[at]) @ chain.move.T
            beyond[at - 1] = v / v.sum(axis=1, keepdims=True)
    return ahead, beyond


class _Walk:
    """All pieces side by side: ``at`` lists the tokens step by step, those of step t from ``begin[t]`` on."""

    def __init__(self, p: _Pieces):
        self.order, self.running = _steps(p.length)
        start = p.start[self.order]
        self.begin = np.concatenate([[0], np.cumsum(self.running)])
        step = np.repeat(np.arange(len(self.running)), self.running)
        row = np.arange(self.begin[-1]) - self.begin[step]
        self.at = start[row] + step
        self.last = self.begin[p.length[self.order] - 1] + np.arange(len(start))  # where each piece's last token is listed


def forward(chain: Chain, classes: np.ndarray, sizes: np.ndarray, keep: bool = False):
    """log10 likelihood of the class sequence of each document; with ``keep`` also what the backward pass needs."""
    p, emit = _Pieces(sizes), np.ascontiguousarray(chain.emit.T)
    entering, beyond = _entering(chain, emit, classes, p, keep)
    w = _Walk(p)
    own = classes[w.at]
    odds = np.empty((STATES, len(own)))  # a row for each state, a column for each token
    for k in range(STATES):
        np.take(chain.emit[k], own, out=odds[k])
    alphas = np.empty_like(odds) if keep else odds
    totals = np.ones(len(own))
    ahead, turn = np.ascontiguousarray(entering[w.order].T), np.ascontiguousarray(chain.move.T)
    for t, n in enumerate(w.running):
        a, b = w.begin[t], w.begin[t] + n
        alpha = alphas[:, a:b]
        np.multiply(odds[:, a:b], ahead[:, :n], out=alpha)
        total = totals[a:b]
        np.sum(alpha, axis=0, out=total)
        alpha /= total
        ahead = turn @ alpha
    scales = np.empty_like(totals)
    scales[w.at] = totals
    logs = np.add.reduceat(np.log10(scales), p.first_token) if len(sizes) else np.zeros(0)
    return (logs, alphas, odds, totals, own, w, p, beyond) if keep else logs


def expected_counts(chain: Chain, classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Expected starts, moves and emissions of whole documents, and their log10 likelihood."""
    logs, alphas, odds, totals, own, w, p, beyond = forward(chain, classes, sizes, keep=True)
    odds /= totals
    # at a piece's last token the state's odds by all tokens have to add up to one
    ending = np.ascontiguousarray(beyond[w.order].T)
    ending /= (alphas[:, w.last] * ending).sum(axis=0)
    move = np.zeros((STATES, STATES))
    chosen = np.zeros((STATES, 0))
    for t in range(len(w.running) - 1, -1, -1):
        n, a = w.running[t], w.begin[t]
        beta = ending[:, :n]
        if chosen.shape[1]:  # the pieces that go on: what they hold next decides
            beta = np.concatenate([chain.move @ chosen, ending[:, chosen.shape[1]:n]], axis=1)
            move += alphas[:, a:a + chosen.shape[1]] @ chosen.T
        chosen = odds[:, a:a + n]
        chosen *= beta  # each token's part of a move into its state
        alphas[:, a:a + n] *= beta
    # and the moves from one piece into the next
    later = np.flatnonzero(p.number[w.order] > 0)
    if len(later):
        listed = np.empty(len(p.doc), np.int64)
        listed[w.order] = w.last
        before = listed[w.order[later] - 1]
        ends = np.empty(len(p.doc), np.int64)
        ends[w.order] = np.arange(len(p.doc))
        move += (alphas[:, before] / ending[:, ends[w.order[later] - 1]]) @ odds[:, later].T
    emitted = np.stack([np.bincount(own, alphas[k], chain.emit.shape[1]) for k in range(STATES)])
    return alphas[:, np.flatnonzero(p.number[w.order] == 0)].sum(axis=1), move * chain.move, emitted, logs


def _segment_order(hashes: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """The order by (segment, hash) in which a block sends its words, and their segments in that order."""
    segment = (hashes % np.uint64(segments)).astype(np.int64)
    order = np.lexsort((hashes, segment))
    return order, segment[order]


def _sent_words(blocks: DataFrame, segments: int) -> DataFrame:
    schema = arrow_schema(blocks.sparkSession, _COUNTED)

    def send(batches):
        for b in batches:
            for i in range(b.num_rows):
                hashes = np.frombuffer(b.column("hashes")[i].as_py(), "<u8")
                shapes, seen = unpack(b.column("shapes")[i].as_py()), unpack(b.column("seen")[i].as_py())
                order, segment = _segment_order(hashes, segments)
                block = b.column("block")[i].as_py()
                yield from rows_table(
                    [(s, block, hashes[order[g]].tobytes(), pack(shapes[order[g]]), pack(seen[order[g]]))
                     for s, g in runs(segment)], schema).to_batches()
        give_back()

    return blocks.select("block", "hashes", "shapes", "seen").mapInArrow(send, _COUNTED)


def _added_up(group: pa.Table, out: pa.Schema) -> pa.Table:
    """Of one segment: each block's words with their counts in the corpus, and (block null) all known words."""
    hashes = [np.frombuffer(x.as_py(), "<u8") for x in column(group, "hashes")]
    sizes = [len(h) for h in hashes]
    shapes = np.concatenate([unpack(x.as_py()) for x in column(group, "shapes")])
    seen = np.concatenate([unpack(x.as_py()) for x in column(group, "counts")])
    known, first, place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
    counts = np.bincount(place, seen).astype(np.int64)
    segment, stops = group.column("segment")[0].as_py(), np.cumsum(sizes)
    rows = [(segment, block, None, None, counts[place[stop - n:stop]].tobytes())
            for block, n, stop in zip(group.column("block").to_pylist(), sizes, stops)]
    has = counts > 0
    rows.append((segment, None, known[has].tobytes(), pack(shapes[first][has]), counts[has].tobytes()))
    return rows_table(rows, out)


def _known_words(batch: pa.RecordBatch):
    for i in range(batch.num_rows):
        yield (np.frombuffer(batch.column("hashes")[i].as_py(), "<u8"), unpack(batch.column("shapes")[i].as_py()),
               np.frombuffer(batch.column("counts")[i].as_py(), "<i8"))


def _frequent(known: DataFrame) -> dict[int, int]:
    """hash -> class of the ``FREQUENT`` most frequent words; ties by the hash.  A top-k of fixed length."""
    def most(batches):
        for b in batches:
            for hashes, _, counts in _known_words(b):
                top = np.lexsort((hashes, -counts))[:FREQUENT]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[top].view(np.int64)), pa.array(counts[top])], names=["hash", "c"])

    top = known.mapInArrow(most, "hash long, c long").orderBy(F.col("c").desc(), "hash").limit(FREQUENT)
    return {r["hash"] % (1 << 64): i for i, r in enumerate(top.collect())}


def _classes(hashes: np.ndarray, shapes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """The class of each word: its own if it is frequent, else that of its shape."""
    keys, values = frequent
    out = FREQUENT + shapes.astype(np.int64)
    if len(keys):
        at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
        out = np.where(keys[at] == hashes, values[at], out)
    return out


def _class_sums(known: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Training tokens and distinct words of each class."""
    n = FREQUENT + SHAPES

    def add(batches):
        sums = np.zeros((2, n), np.int64)
        for b in batches:
            for hashes, shapes, counts in _known_words(b):
                cls = _classes(hashes, shapes, frequent)
                sums[0] += np.bincount(cls, counts, n).astype(np.int64)
                sums[1] += np.bincount(cls, minlength=n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), *map(pa.array, sums)], names=["class", "tokens", "words"])

    tokens_of, words_of = np.zeros(n), np.zeros(n)
    for r in known.mapInArrow(add, "class long, tokens long, words long").groupBy("class").agg(
            F.sum("tokens").alias("tokens"), F.sum("words").alias("words")).collect():  # one row per class
        tokens_of[r["class"]], words_of[r["class"]] = r["tokens"], r["words"]
    return tokens_of, words_of


def score_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 10) -> DataFrame:
    """Per row of ``docs``: (id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Both scores are log10 probabilities of the whole text, its end included.
    Learned from the rows whose crc32 of the id's text modulo ``folds`` is
    not 0; rows with a null id are scored, count as not held out and are not
    learned from.  Null and empty texts are one end token.  Without training
    tokens every word is unseen.  Repeated rows each get a row and count each
    time.  Only the two named columns are read.
    """
    spark = docs.sparkSession
    fold = F.crc32(F.col(id_col).cast("string")) % folds
    blocks = token_blocks(docs, id_col, text_col, F.coalesce(fold != 0, F.lit(False)))
    entries = blocks.agg(F.sum(F.octet_length("hashes") / 8)).first()[0] or 0
    segments = max(int(-(-entries // SEGMENT_WORDS)), shuffle_partitions(spark))
    counted_schema = arrow_schema(spark, _COUNTED)
    counted = stage(_sent_words(blocks, segments).groupBy("segment").applyInArrow(
        lambda group: _added_up(group, counted_schema), _COUNTED), "word-counts")
    known = counted.where("block is null").select("hashes", "shapes", "counts")
    by_hash = sorted(_frequent(known).items())
    frequent = np.array([h for h, _ in by_hash], np.uint64), np.array([c for _, c in by_hash], np.int64)
    tokens_of, words_of = _class_sums(known, frequent)
    total, distinct = int(tokens_of.sum()), int(words_of.sum())
    log_all = np.log10(total + SMOOTH * (distinct + 1))
    log_class = np.log10(tokens_of + SMOOTH * (words_of + 1))
    coded_schema = ("ids array<bigint>, training array<boolean>, sizes array<bigint>, known array<bigint>, "
                    "base array<double>, inside array<double>, classes binary")
    coded_arrow = arrow_schema(spark, coded_schema)

    def code(block: pa.Table, answer: pa.Table) -> pa.Table:
        cell = {c: block.column(c)[0].as_py() for c in block.column_names}
        hashes = np.frombuffer(cell["hashes"], "<u8")
        order, _ = _segment_order(hashes, segments)
        answers = sorted(zip(answer.column("segment").to_pylist(), answer.column("counts").to_pylist()))
        c = np.zeros(len(hashes), np.int64)
        c[order] = np.concatenate([np.frombuffer(x, "<i8") for _, x in answers])
        cls = _classes(hashes, unpack(cell["shapes"]), frequent)
        tokens, sizes = unpack(cell["tokens"]), np.array(cell["sizes"], np.int64)
        first = np.cumsum(sizes) - sizes
        logs = np.log10(c + SMOOTH)
        per = [np.add.reduceat(v[tokens], first).tolist() for v in
               ((c > 0).astype(np.int64), logs - log_all, logs - log_class[cls])]
        return rows_table([(cell["ids"], cell["training"], cell["sizes"], *per, cls[tokens].astype("<u2").tobytes())],
                          coded_arrow)

    coded = stage(blocks.drop("seen").groupBy("block").cogroup(
        counted.where("block is not null").select("block", "segment", "counts").groupBy("block")
    ).applyInArrow(code, coded_schema), "coded")
    chain = train(coded, Chain.initial(tokens_of))
    out_schema = "id long, n_tokens long, n_known long, base_score double, score double"
    out_arrow = arrow_schema(spark, out_schema)

    def score(batches):
        for b in batches:
            for i in range(b.num_rows):
                sizes = np.array(b.column("sizes")[i].as_py(), np.int64)
                classes = np.frombuffer(b.column("classes")[i].as_py(), "<u2").astype(np.int64)
                inside = np.array(b.column("inside")[i].as_py(), float)
                yield pa.RecordBatch.from_arrays([
                    pa.array(b.column("ids")[i].as_py(), pa.int64()), pa.array(sizes),
                    pa.array(b.column("known")[i].as_py(), pa.int64()), pa.array(b.column("base")[i].as_py(), pa.float64()),
                    pa.array(inside + forward(chain, classes, sizes))], schema=out_arrow)
        give_back()

    scored = coded.mapInArrow(score, out_schema)
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(F.crc32(F.col("id").cast("string")) % folds == 0, F.lit(False)).alias("held_out"),
        "n_tokens", "n_known", F.lit(total).cast("long").alias("train_tokens"), "base_score", "score")


def train(coded: DataFrame, chain: Chain, settled: float = SETTLED) -> Chain:
    """Baum-Welch over all training documents of the coded blocks, until the likelihood settles."""
    schema, before = "cell int, expected double", -np.inf
    while True:
        def count(batches, chain=chain) -> Iterator[pa.RecordBatch]:
            sums = [np.zeros(STATES), np.zeros((STATES, STATES)), np.zeros(chain.emit.shape), np.zeros(2)]
            for b in batches:
                for i in range(b.num_rows):
                    sizes = np.array(b.column("sizes")[i].as_py(), np.int64)
                    chosen = np.array(b.column("training")[i].as_py(), bool)
                    classes = np.frombuffer(b.column("classes")[i].as_py(), "<u2").astype(np.int64)
                    if chosen.any():
                        *own, logs = expected_counts(chain, classes[np.repeat(chosen, sizes)], sizes[chosen])
                        for total, x in zip(sums, [*own, np.array([logs.sum(), sizes[chosen].sum()])]):
                            total += x
            flat = np.concatenate([x.ravel() for x in sums])
            cells = np.flatnonzero(flat)
            yield pa.RecordBatch.from_arrays([pa.array(cells, pa.int32()), pa.array(flat[cells])], names=["cell", "expected"])
            give_back()

        summed = coded.select("training", "sizes", "classes").mapInArrow(count, schema).groupBy("cell").agg(
            F.sum("expected").alias("expected"))
        flat = np.zeros(STATES + STATES ** 2 + chain.emit.size + 2)
        for r in summed.collect():  # as many rows as the model has numbers
            flat[r["cell"]] = r["expected"]
        a, b = STATES, STATES + STATES ** 2
        chain = Chain.from_counts(flat[:a], flat[a:b].reshape(STATES, STATES), flat[b:-2].reshape(chain.emit.shape))
        now = flat[-2] / max(flat[-1], 1)
        if now - before < settled:
            return chain
        before = now
