import hashlib

from conftest_llm import WORD
from flowframe.llm import substring


def brute(rows, window=13):
    """(n_words, kept words) per row; a null id takes no part."""
    words = [(i, WORD.findall(t or "")) for i, t in rows]
    first = {}
    for i, w in sorted((x for x in words if x[0] is not None), key=lambda x: x[0]):
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), i)
    out = []
    for i, w in words:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1 if i is not None else 0):
            if first[tuple(w[k:k + window])] < i:
                gone[k:k + window] = [True] * window
        out.append((i, len(w), [x for x, g in zip(w, gone) if not g]))
    return out


def test_documents_match_brute_force(documents):
    rows = [(r["doc_id"], r["text"]) for r in documents.select("doc_id", "text").collect()]
    want = {i: (n, n - len(k), hashlib.sha256(" ".join(k).encode()).hexdigest()) for i, n, k in brute(rows)}
    got = {r["doc_id"]: tuple(r)[1:] for r in substring.passage_digest(documents).collect()}
    assert got == want and sum(x[1] for x in got.values()) > 0


def test_hashes_are_those_of_the_words():
    texts = [b"a b  a\tb", b"", b"  ", b"b a" * 3, b"long" * 700_000 + b" a end", "é a".encode()]
    hashes, sizes = substring.word_hashes(texts)
    flat = [w for t in texts for w in t.split()]
    assert sizes.tolist() == [len(t.split()) for t in texts] and len(hashes) == len(flat)
    known = {}
    assert all(known.setdefault(w, h) == h for w, h in zip(flat, hashes.tolist()))
    assert len(set(known.values())) == len(known)


def test_odd_rows(odd_documents, odd_rows, no_documents):
    out = substring.dedup_passages(odd_documents)
    assert set(out.columns) == set(odd_documents.columns) - {"text"} | {"n_removed", "kept_text"}
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:])
    want = sorted(((i, n, n - len(k), " ".join(k)) for i, n, k in brute([(r[0], r[1]) for r in odd_rows])), key=key)
    got = sorted((tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_text").collect()), key=key)
    assert got == want
    assert substring.dedup_passages(no_documents).collect() == []
    laid_out = {r["doc_id"]: r["kept_text"] for r in substring.dedup_passages(odd_documents, keep_layout=True).collect()}
    assert laid_out[6] == " \t\n\x0b\x0c\r " and laid_out[2] == ""
