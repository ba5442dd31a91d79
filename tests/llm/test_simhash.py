import random
from itertools import combinations

import numpy as np
import xxhash
from conftest_llm import WORD, fold
from flowframe.llm import simhash


def brute_print(text):
    w = WORD.findall(fold(text))
    if not w:
        return 0
    shingles = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints, radius=3):
    ids = sorted(prints)
    p = np.array([prints[i] for i in ids], np.uint64)
    near = np.bitwise_count(p[:, None] ^ p[None]) <= radius
    label = np.arange(len(ids))
    while True:
        low = np.where(near, label[None], len(ids)).min(1)
        if (low == label).all():
            return {i: ids[k] for i, k in zip(ids, label)}
        label = low


def test_documents_match_brute_force(documents):
    rows = {r["doc_id"]: r for r in simhash.simhash_components(documents).collect()}
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    prints = {i: brute_print(t) for i, t in texts.items()}
    assert {i: r["fingerprint"] for i, r in rows.items()} == {i: format(p, "016x") for i, p in prints.items()}
    assert {i: r["component_id"] for i, r in rows.items()} == brute_components(prints)


def test_every_pair_within_the_radius_shares_a_mask():
    masks = simhash.covering_masks(3)
    assert len(masks) == 15 and all(32 <= bin(m).count("1") <= 36 for m in masks)
    draw = random.Random(1)
    for flips in [*combinations(range(0, 64, 3), 3), *([draw.sample(range(64), 3) for _ in range(3000)])]:
        changed = sum(1 << f for f in flips)
        assert any(m & changed == 0 for m in masks)


def test_crowded_buckets_are_covered_again(spark, monkeypatch):
    draw = random.Random(5)
    base = draw.getrandbits(64)
    crowd = {base ^ sum(1 << b for b in draw.sample(range(20), draw.randrange(9))) for _ in range(700)}
    crowd |= {draw.getrandbits(64) for _ in range(300)}
    prints = sorted(crowd)
    monkeypatch.setattr(simhash, "BUCKET", 8)
    links = simhash.fingerprint_links(spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long"))
    parent = {p: p for p in prints}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for r in links.collect():
        a, b = (r[c] % (1 << 64) for c in "ab")
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    assert {p: find(p) for p in prints} == brute_components({p: p for p in prints})


def test_odd_rows(odd_documents, odd_rows, no_documents):
    rows = simhash.simhash_components(odd_documents).collect()
    assert len(rows) == len(odd_rows)
    blank = {r["doc_id"]: r for r in rows if r["fingerprint"] == "0" * 16}
    assert set(blank) == {4, 5, 6, None}
    assert {r["component_id"] for i, r in blank.items() if i} == {4} and blank[None]["component_id"] is None
    assert {r["component_id"] for r in rows if r["doc_id"] in (1, 2)} == {1}
    assert simhash.simhash_components(no_documents).collect() == []
    kept = simhash.keep_one(odd_documents)
    assert kept.columns == odd_documents.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(i for i in ids if i) == sorted({r["component_id"] for r in rows if r["component_id"]}) and ids.count(None) == 2
    assert simhash.keep_one(no_documents).collect() == []
