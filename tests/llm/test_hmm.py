import collections
import itertools
import math
import zlib

import numpy as np
from conftest_llm import WORD, fold
from flowframe.llm import hmm


def test_documents(documents):
    out = {r["doc_id"]: r for r in hmm.score_documents(documents).collect()}
    tokens = {r["doc_id"]: WORD.findall(fold(r["text"])) + [" "] for r in documents.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    c = collections.Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    n, v = sum(c.values()), len(c)
    assert len(out) == len(tokens)
    for i, ts in tokens.items():
        r = out[i]
        base = sum(math.log10((c[t] + 0.1) / (n + 0.1 * (v + 1))) for t in ts)
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ts), sum(c[t] > 0 for t in ts), n)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base) and r["score"] < 0
    for side in (True, False):
        assert sum(r["score"] for r in out.values() if r["held_out"] == side) > sum(
            r["base_score"] for r in out.values() if r["held_out"] == side)


def small_chain(seed=0, classes=7):
    draw = np.random.default_rng(seed)
    rows = lambda *shape: (lambda x: x / x.sum(axis=-1, keepdims=True))(draw.uniform(0.1, 1, shape))
    return hmm.Chain(rows(hmm.STATES), rows(hmm.STATES, hmm.STATES), rows(hmm.STATES, classes))


def test_forward_sums_over_all_paths():
    chain = small_chain()
    docs = [[0, 3, 3, 6], [2], [5, 1, 0], [4, 4]]
    got = hmm.forward(chain, np.array(sum(docs, [])), np.array([len(d) for d in docs]))
    for d, log10 in zip(docs, got):
        total = 0.0
        for path in itertools.product(range(hmm.STATES), repeat=len(d)):
            p = chain.start[path[0]] * chain.emit[path[0], d[0]]
            for a, b, c in zip(path, path[1:], d[1:]):
                p *= chain.move[a, b] * chain.emit[b, c]
            total += p
        assert abs(math.log10(total) - log10) < 1e-9


def test_expected_counts_are_those_of_all_paths():
    chain, d = small_chain(1), [2, 5, 0, 2]
    start, move, emit, _ = hmm.expected_counts(chain, np.array(d + [1]), np.array([4, 1]))
    want = [np.zeros_like(x) for x in (start, move, emit)]
    for one in (d, [1]):
        weights = []
        for path in itertools.product(range(hmm.STATES), repeat=len(one)):
            p = chain.start[path[0]] * chain.emit[path[0], one[0]]
            for a, b, c in zip(path, path[1:], one[1:]):
                p *= chain.move[a, b] * chain.emit[b, c]
            weights.append((path, p))
        total = sum(p for _, p in weights)
        for path, p in weights:
            want[0][path[0]] += p / total
            for a, b in zip(path, path[1:]):
                want[1][a, b] += p / total
            for s, c in zip(path, one):
                want[2][s, c] += p / total
    assert all(np.allclose(a, b) for a, b in zip((start, move, emit), want))


def walked(chain, classes):
    """One document, token by token: its log10 likelihood, and expected starts, moves and emissions."""
    a, scales = [], []
    for t, c in enumerate(classes):
        v = (chain.start if t == 0 else a[-1] @ chain.move) * chain.emit[:, c]
        scales.append(v.sum())
        a.append(v / v.sum())
    beta, move, emit = np.ones(hmm.STATES), np.zeros_like(chain.move), np.zeros_like(chain.emit)
    for t in range(len(classes) - 1, -1, -1):
        emit[:, classes[t]] += a[t] * beta
        if t:
            ahead = chain.emit[:, classes[t]] * beta / scales[t]
            move += np.outer(a[t - 1], ahead) * chain.move
            beta = chain.move @ ahead
    return sum(math.log10(x) for x in scales), a[0] * beta, move, emit


def test_pieces_change_nothing(monkeypatch):
    draw, chain = np.random.default_rng(4), small_chain(3, 9)
    docs = [draw.integers(0, 9, n) for n in (1, 4, 5, 6, 23, 5, 200, 1, 10)]
    want = [walked(chain, d) for d in docs]
    for piece in (1, 5, 7, 1000):
        monkeypatch.setattr(hmm, "PIECE", piece)
        flat, sizes = np.concatenate(docs), np.array([len(d) for d in docs])
        assert np.allclose(hmm.forward(chain, flat, sizes), [w[0] for w in want])
        *got, logs = hmm.expected_counts(chain, flat, sizes)
        assert np.allclose(logs, [w[0] for w in want])
        for x, parts in zip(got, zip(*[w[1:] for w in want])):
            assert np.allclose(x, sum(parts))


def plain_scores(tokens, held):
    """The whole model in one process: classes, Baum-Welch until it settles, scores of all documents."""
    c = collections.Counter(t for i, ts in tokens.items() if not held[i] for t in ts)
    code = lambda t: (t if t == " " else t).encode()
    by_count = sorted(c, key=lambda t: (-c[t], np.uint64(hmm.xxhash.xxh3_64_intdigest(code(t))).astype(np.int64)))
    own = {t: k for k, t in enumerate(by_count[:hmm.FREQUENT])}
    cls = lambda t: own.get(t, hmm.FREQUENT + hmm.shape_class(code(t)))
    n = hmm.FREQUENT + hmm.SHAPES
    tokens_of, words_of = np.zeros(n), np.zeros(n)
    for t, k in c.items():
        tokens_of[cls(t)] += k
        words_of[cls(t)] += 1
    chain, before = hmm.Chain.initial(tokens_of), -math.inf
    coded = {i: np.array([cls(t) for t in ts]) for i, ts in tokens.items()}
    while True:
        sums, log, length = None, 0.0, 0
        for i, x in coded.items():
            if not held[i]:
                own_log, *parts = walked(chain, x)
                log, length = log + own_log, length + len(x)
                sums = parts if sums is None else [a + b for a, b in zip(sums, parts)]
        chain = hmm.Chain.from_counts(*sums)
        if log / length - before < hmm.SETTLED:
            break
        before = log / length
    inside = lambda t: math.log10((c[t] + 0.1) / (tokens_of[cls(t)] + 0.1 * (words_of[cls(t)] + 1)))
    return {i: walked(chain, coded[i])[0] + sum(map(inside, ts)) for i, ts in tokens.items()}


def test_scores_are_those_of_a_plain_model(documents):
    some = documents.where("doc_id < 60")
    tokens = {r["doc_id"]: WORD.findall(fold(r["text"])) + [" "] for r in some.collect()}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    want = plain_scores(tokens, held)
    got = {r["doc_id"]: r["score"] for r in hmm.score_documents(some).collect()}
    assert got.keys() == want.keys() and all(abs(got[i] - want[i]) < 1e-6 * abs(want[i]) for i in want)


def test_rounds_raise_the_likelihood():
    draw = np.random.default_rng(3)
    classes = np.concatenate([(draw.integers(0, 3, 40) + 4 * (k % 2)) for k in range(30)])
    sizes, chain, logs = np.full(30, 40), small_chain(2, 8), []
    for _ in range(6):
        start, move, emit, own = hmm.expected_counts(chain, classes, sizes)
        logs.append(own.sum())
        chain = hmm.Chain(start / start.sum(), move / move.sum(1, keepdims=True), emit / emit.sum(1, keepdims=True))
    assert all(b >= a - 1e-9 for a, b in zip(logs, logs[1:])) and logs[-1] > logs[0] + 1


def test_odd_rows(odd_documents, odd_rows, no_documents):
    out = hmm.score_documents(odd_documents).collect()
    assert len(out) == len(odd_rows)
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    assert sorted(((r["doc_id"], r["n_tokens"]) for r in out), key=key) == sorted(
        ((r[0], len(WORD.findall(r[1] or "")) + 1) for r in odd_rows), key=key)
    assert all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in out)
    assert hmm.score_documents(no_documents).collect() == []
