import random

import numpy as np
import pytest
from flowframe.llm import packing

P = pytest.importorskip("public_tokenizers")
RANKS = P.path("byte_bpe_50k.tiktoken"), P.PATTERN


def encode(text):
    return packing.rank_encoding(open(RANKS[0], "rb").read(), RANKS[1]).encode_ordinary(text or "")


def brute_best_fit(sizes, length):
    rows, free = [], []
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        fits = [(free[r], -r) for r in range(len(rows)) if free[r] >= sizes[i]]
        if fits and sizes[i]:
            space = min(fits)[0]
            r = max(r for r in range(len(rows)) if free[r] == space)
        else:
            r = len(rows)
            rows.append([])
            free.append(length)
        rows[r].append(i)
        free[r] -= sizes[i]
    return free


def test_best_fit_uses_as_many_rows_as_a_plain_scan():
    draw = random.Random(2)
    for length in (1, 7, 64, 100):
        for n in (0, 1, 50, 400):
            sizes = [draw.randint(1, length) for _ in range(n)]
            rows = packing.best_fit_decreasing(sizes, length)
            assert sorted(i for r in rows for i in r) == list(range(n))
            free = sorted(length - sum(sizes[i] for i in r) for r in rows)
            assert all(f >= 0 for f in free) and free == sorted(brute_best_fit(sizes, length))


def test_capacities_find_the_smallest_that_fits():
    draw, tree, held = random.Random(4), packing.Capacities(50), []
    for _ in range(2000):
        if held and draw.random() < 0.5:
            x = held.pop(draw.randrange(len(held)))
            tree.add(x, -1)
        else:
            held.append(draw.randint(0, 50))
            tree.add(held[-1], 1)
        size = draw.randint(1, 50)
        assert tree.best(size) == min((x for x in held if x >= size), default=-1)


def unpacked(rows, length):
    got = {}
    for r in rows:
        ids, positions = np.frombuffer(bytes(r["ids"]), "<u4"), np.frombuffer(bytes(r["positions"]), "<u4")
        cuts = r["cumulative"]
        assert len(ids) == len(positions) == length and cuts[0] == 0 and cuts[-1] == r["n_tokens"] <= length
        assert (ids[cuts[-1]:] == 50256).all()
        for k, (doc, offset) in enumerate(zip(r["doc_ids"], r["offsets"])):
            part = ids[cuts[k]:cuts[k + 1]].tolist()
            assert positions[cuts[k]:cuts[k + 1]].tolist() == list(range(len(part)))
            got.setdefault(doc, []).append((offset, part))
    return {d: sorted(p) for d, p in got.items()}


def test_no_token_is_lost(documents):
    packed = packing.pack_documents(documents, *RANKS, length=256)
    got = unpacked(packed.collect(), 256)
    want = {r["doc_id"]: encode(r["text"]) for r in documents.collect()}
    assert {d: [x for _, p in parts for x in p] for d, parts in got.items()} == {d: x for d, x in want.items() if x}
    back = {r["doc_id"]: np.frombuffer(bytes(r["token_ids"]), "<u4").tolist() for r in packing.unpack_documents(packed).collect()}
    assert back == {d: x for d, x in want.items() if x}


def test_odd_rows(odd_documents, no_documents):
    got = unpacked(packing.pack_documents(odd_documents, *RANKS).collect(), packing.LENGTH)
    assert set(got) == {1, 2, 3, 6, 7, 8, 9, 10, 11, 12, 13, None}
    assert sum(o == 0 for o, _ in got[1]) == 3
    assert packing.pack_documents(no_documents, *RANKS).collect() == []
