import collections
import random

import numpy as np
import pytest
from conftest_llm import WORD
from flowframe.llm import quality_rules
from pyspark.sql import functions as F


def brute(text):
    w = WORD.findall(text or "")
    n = len(w)
    seen = collections.Counter(zip(w, w[1:], w[2:]))
    twice = {i + k for i in range(n - 2) if seen[w[i], w[i + 1], w[i + 2]] > 1 for k in range(3)}
    lines, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return n, sum(map(len, w)), symbols, dup, len(twice), n < 50 or 100 * len(twice) > 50 * n


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]


def test_documents(spark, sf_dir, documents):
    out = quality_rules.judge(documents).collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS) for r in out} == {i: brute(t) for i, t in texts.items()}
    assert not any(r["kept"] and r["base_failed"] for r in out)
    good = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    judged = [r for r in out if r["doc_id"] in good and not r["base_failed"]]
    assert all(r["kept"] for r in judged if good[r["doc_id"]])
    assert not any(r["kept"] for r in judged if not good[r["doc_id"]])


def statistics_of(text):
    """The transformed statistics of a text, from the plain counts."""
    n, chars, symbols, dup, twice, _ = brute(text)
    lines = sum(bool(WORD.search(line)) for line in text.split("\n"))
    upper = sum("A" <= c <= "Z" for c in text)
    root = lambda part, whole: (part / max(whole, 1)) ** 0.5
    return [np.log1p(n), np.log1p(chars / max(n, 1)), root(symbols, chars), root(dup, lines), root(twice, n), root(upper, chars)]


def ranked(values, share):
    return np.sort(values, axis=0)[int(np.ceil(share * len(values))) - 1]


def squared(z, mu, scatter):
    d = z - mu
    return np.einsum("ij,ij->i", d @ np.linalg.inv(scatter), d)


def plain_mcd(x):
    """The estimate of one group with sorted quantiles: (rows, location, scatter)."""
    floors, p, chi = np.array(list(quality_rules.STATISTICS.values())), quality_rules.P, quality_rules.chi_square
    middle = ranked(x, 0.5)
    unit = np.sqrt((1.4826 * ranked(np.abs(x - middle), 0.5)) ** 2 + floors ** 2)
    z, ridge = (x - middle) / unit, np.diag((floors / unit) ** 2)

    def estimate(rows):
        return rows.mean(axis=0), np.cov(rows.T, bias=True).reshape(p, p) + ridge

    def concentrated(mu, scatter):
        d = squared(z, mu, scatter)
        return estimate(z[d <= ranked(d, quality_rules.COVERAGE)])

    log_det = lambda e: np.linalg.slogdet(e[1])[1]
    ends = []
    for start in (np.tanh(z), z / np.sqrt((z * z).sum(axis=1, keepdims=True) + 1e-12) * p ** 0.5):
        now = concentrated(np.zeros(p), start.T @ start / len(z) + ridge)
        while log_det(after := concentrated(*now)) < log_det(now) - quality_rules.SETTLED:
            now = after
        ends.append(after)
    d = squared(z, *min(ends, key=log_det))
    mu, scatter = estimate(z[d <= ranked(d, 0.5) / chi(0.5) * chi(quality_rules.REWEIGHT)])
    grown = max(1.0, ranked(squared(z, mu, scatter), 0.5) / chi(0.5))
    return len(x), middle + unit * mu, scatter * np.outer(unit, unit) * grown


def plain_distances(rows):
    """Squared distances of (language, source, statistics) rows, each under its own group's shrunk estimate."""
    x = np.array([r[2] for r in rows])
    levels = [[(r[0], r[1]) for r in rows], [r[0] for r in rows], [None] * len(rows)]
    fits = [{k: plain_mcd(x[[q == k for q in keys]]) for k in set(keys)} for keys in levels]
    out = []
    for i in range(len(rows)):
        _, mu, scatter = fits[2][None]
        for level in (1, 0):
            n, own_mu, own = fits[level][levels[level][i]]
            beyond = max(n - quality_rules.P, 0)
            w, v = beyond / (beyond + quality_rules.SHRINK), min(1.0, beyond / quality_rules.P)
            gap = own_mu - mu
            mu, scatter = mu + v * gap, w * own + (1 - w) * scatter + v * (1 - v) * np.outer(gap, gap)
        out.append(squared(x[i:i + 1], mu, scatter)[0])
    return out


def test_distances_are_those_of_a_plain_mcd(spark, documents):
    """Every document's distance and verdict against numpy; histograms place a rank within 1/64 of its value."""
    texts = {r["doc_id"]: (r["lang"], r["source"], r["text"]) for r in documents.collect()}
    out = [r for r in quality_rules.judge(documents).collect() if not r["base_failed"]]
    want = plain_distances([(*texts[r["doc_id"]][:2], statistics_of(texts[r["doc_id"]][2])) for r in out])
    got = np.array([r["distance"] for r in out])
    assert len(out) > 100 and np.allclose(got, want, rtol=0.05, atol=0.01)
    assert np.median(np.abs(got / want - 1)) < 0.01
    assert [r["kept"] for r in out] == [w <= quality_rules.chi_square(quality_rules.CUT) for w in want]


def test_quantiles_by_histogram(spark):
    """Exact where a bin holds one value or two rows, within the bin elsewhere; per group, with a hot one."""
    draw = random.Random(2)
    rows = [("hot", draw.lognormvariate(0, 2)) for _ in range(3000)] + [("one", 5.0)] + [("two", 1.0), ("two", 1.001)] + [("same", 0.0)] * 9
    df = spark.createDataFrame(rows, "key string, x double")
    for share in (0.01, 0.5, 1.0):
        got = {r["key"]: (r["n"], r["at"]) for r in quality_rules._quantiles(
            df, ["key"], "x", F.floor(F.log2(F.greatest("x", F.lit(1e-6))) * 64), share).collect()}
        for key in ("hot", "one", "two", "same"):
            values = np.array([v for k, v in rows if k == key])
            assert got[key][0] == len(values)
            assert got[key][1] == pytest.approx(ranked(values, share), rel=2 ** (1 / 64) - 1 if key == "hot" else 1e-12)


def test_odd_rows(odd_documents, odd_rows, no_documents):
    out = quality_rules.judge(odd_documents).collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r["doc_id"], *(r[c] for c in COUNTS)) for r in out), key=key) == sorted(
        ((r[0], *brute(r[1])) for r in odd_rows), key=key)
    assert not any(r["kept"] for r in out if r["base_failed"])
    assert quality_rules.judge(no_documents).collect() == []


def test_repeats_and_lines_of_hard_texts(spark):
    draw = random.Random(8)
    rows = [(i, "".join(draw.choice(["a ", "b ", "c\n", "\n", "\t", "d#|"]) for _ in range(draw.randrange(300)))) for i in range(60)]
    got = quality_rules.measured(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["doc_id"]: tuple(r[c] for c in COUNTS[:5]) for r in got} == {i: brute(t)[:5] for i, t in rows}


def test_estimate_withstands_a_quarter_of_outliers(spark):
    """Location and scatter of the clean rows come back although 20 % of the rows lie far away."""
    draw = np.random.default_rng(0)
    p = quality_rules.P
    clean = draw.multivariate_normal(np.arange(p) * 2.0, np.diag(np.linspace(0.5, 2, p) ** 2), 2000)
    far = draw.normal(40, 0.1, (500, p))
    rows = [("g", *map(float, x)) for x in np.concatenate([clean, far])]
    df = spark.createDataFrame(rows, "key string, " + ", ".join(f"{n} double" for n in quality_rules.NAMES))
    g = quality_rules.fit_groups(df).first()
    location = np.array(g["mid_at"]) + np.array(g["unit"]) * np.array(g["mu"])
    assert g["rows"] == 2500 and np.abs(location - clean.mean(axis=0)).max() < 0.15
    z = [(F.lit(float(v)) - F.col("mid_at")[i]) / F.col("unit")[i] for i, v in enumerate(far[0])]
    d = quality_rules.fit_groups(df).select((quality_rules._distance(z) / F.col("grown")).alias("d")).first()["d"]
    assert d > 10 * quality_rules.chi_square(quality_rules.CUT)


def test_chi_square():
    assert quality_rules.chi_square(0.975, 6) == pytest.approx(14.449, abs=0.05)


def sourced(lang, first, n_small, odd_words):
    """Texts of one language: 400 long ones from one source, ``n_small`` short ones from another, and there a last odd one."""
    draw = random.Random(5)
    text = lambda n: " ".join(f"{draw.choice('abcdefgh') * draw.randint(2, 8)}{draw.randrange(10 ** 6)}" for _ in range(n))
    odd = text(odd_words)
    short = [(first + i, text(draw.randint(90, 110)), lang, "short") for i in range(n_small)]
    return [*short, *((first + 1000 + i, text(draw.randint(450, 550)), lang, "long") for i in range(400)), (first - 1, odd, lang, "short")]


def test_small_source_is_judged_by_its_own(spark):
    """A text odd for its source of 60 rows but usual in its language is rejected, and no size switches the verdict."""
    rows = [*sourced("de", 1, 60, 1000), *sourced("en", 10_000, 146, 150), *sourced("fr", 20_000, 152, 150)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    out = {r["doc_id"]: r for r in quality_rules.judge(df).collect()}
    assert not out[0]["kept"] and all(r["kept"] for i, r in out.items() if i != 0)
    assert out[9_999]["distance"] == pytest.approx(out[19_999]["distance"], rel=0.2)


def test_estimate_withstands_a_third_of_copies(spark):
    """A third of the rows are copies of one odd row: location and scatter stay those of the rest, and the copies lie beyond the cut."""
    draw = np.random.default_rng(1)
    p = quality_rules.P
    clean = draw.multivariate_normal(np.arange(p) * 2.0, np.diag(np.linspace(0.5, 2, p) ** 2), 1000)
    odd = np.full(p, 40.0)
    rows = [("g", *map(float, x)) for x in np.concatenate([clean, np.tile(odd, (500, 1))])]
    df = spark.createDataFrame(rows, "key string, " + ", ".join(f"{n} double" for n in quality_rules.NAMES))
    z = [(F.lit(float(v)) - F.col("mid_at")[i]) / F.col("unit")[i] for i, v in enumerate(odd)]
    g = quality_rules.fit_groups(df).withColumn("d", quality_rules._distance(z) / F.col("grown")).first()
    location = np.array(g["mid_at"]) + np.array(g["unit"]) * np.array(g["mu"])
    assert np.abs(location - clean.mean(axis=0)).max() < 0.3
    assert g["d"] > quality_rules.chi_square(quality_rules.CUT)
