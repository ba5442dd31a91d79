import hashlib
import random
import zlib

from conftest_llm import WORD
from flowframe.llm import periodic_runs as pr


def plain_words(text, doc_id):
    w = WORD.findall(text or "")
    h = zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    n, g = len(w), h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def plain_runs(w):
    """Every period in turn: maximal stretches of equal words q apart, unless a shorter period has the stretch."""
    n, out, seen = len(w), [], {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            start, length = i, j - i + q
            if length >= max(6, 4 * q) and not any(q % p == 0 for p in seen.get((start, length), [])):
                out.append((start, length, q))
                seen.setdefault((start, length), []).append(q)
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text):
    w = plain_words(text, doc_id)
    runs = plain_runs(w)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=None)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(w), len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def local_runs(words):
    """Stitch the fragments of one document without Spark."""
    out, spans = [], {}
    for q, lo, hi in pr.solve_documents([(0, words)])[0]:
        spans.setdefault(q, []).append((lo, hi))
    for q, parts in spans.items():
        merged = []
        for lo, hi in sorted(parts):
            if merged and merged[-1][1] - lo >= q:
                merged[-1][1] = max(merged[-1][1], hi)
            else:
                merged.append([lo, hi])
        out += [(lo, hi - lo, q) for lo, hi in merged if hi - lo >= max(6, 4 * q)]
    return sorted(out, key=lambda r: (r[0], r[2]))


def test_documents_match_brute_force(documents):
    got = rows_of(pr.run_report(documents))
    want = sorted((plain_row(r["doc_id"], r["text"]) for r in documents.collect()), key=str)
    assert got == want
    assert sum(r[2] for r in got) > 10


def test_random_periodic_words_match_brute_force():
    draw = random.Random(3)
    for case in range(400):
        words = []
        while len(words) < draw.randrange(1, 300):
            unit = [str(draw.randrange(draw.choice([1, 2, 3, 30]))).encode() for _ in range(draw.randrange(1, 24))]
            body = unit * draw.randrange(1, 9)
            words += body[:draw.randrange(1, len(body) + 1)]
        assert local_runs(words) == plain_runs(words), case


def test_long_periods_and_nested_runs():
    unit = [b"a", b"b"] * 5 + [str(i).encode() for i in range(700)] + [b"z"] * 40
    words = [b"head"] * 3 + unit * 5 + unit[:100] + [b"tail"]
    assert local_runs(words) == plain_runs(words)
    assert max(r[2] for r in plain_runs(words)) == 750


def test_one_word_repeated_has_one_run():
    assert local_runs([b"x"] * 20_000) == [(0, 20_000, 1)]


def test_z_function():
    assert pr.z_function([1, 1, 2, 1, 1, 2, 1]) == [7, 1, 0, 4, 1, 0, 1]
    assert pr.shortest_period([1, 2, 1, 2, 1]) == 2


def test_documents_laid_out_together_stay_apart():
    docs = [(i, [b"x"] * 5) for i in range(10)]
    assert all(0 <= lo < hi <= 5 for found in pr.solve_documents(docs) for _, lo, hi in found)


def test_odd_rows(odd_documents, odd_rows):
    got = rows_of(pr.run_report(odd_documents))
    assert got == sorted((plain_row(r[0], r[1]) for r in odd_rows), key=str)


def test_empty_table(no_documents):
    assert pr.run_report(no_documents).collect() == []


def test_runs_are_returned(spark):
    df = spark.createDataFrame([(1, "p q " * 5 + "p r")], "doc_id long, text string")
    row = pr.periodic_runs(df).collect()[0]
    assert [tuple(r) for r in row["runs"]] == [(0, 11, 2)]
    assert row["exponent_milli"] == 5500
