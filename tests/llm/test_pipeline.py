"""The pipeline against a plain version of each stage on the rows that its predecessor kept."""

import os
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest_llm import WORD

P = pytest.importorskip("public_tokenizers")

import corpus_pipeline as cp  # noqa: E402
from flowframe.llm import mixing, quality_model  # noqa: E402
from test_simhash import brute_components, brute_print  # noqa: E402
from test_substring import brute as brute_passages  # noqa: E402

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir):
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), []
    for name, step in cp.STAGES[:-1]:
        docs = cp.stage(step(spark, docs, sf_dir), "test")
        assert docs.columns == COLUMNS, name
        out.append(docs.toPandas())
    return [pd.read_parquet(f"{sf_dir}/documents.parquet"), *out]


def rows(df):
    return Counter(df[COLUMNS].itertuples(index=False, name=None))


def test_classifier_keeps_what_a_plain_discriminant_accepts(steps, sf_dir):
    docs, kept = steps[0], steps[1]
    labels = pd.read_parquet(os.path.join(sf_dir, "labels.parquet")).set_index("doc_id").quality
    x = np.array([quality_model.text_statistics(t.encode()) for t in docs.text])
    import zlib

    train = np.array([i in labels.index and zlib.crc32(str(i).encode()) % 5 != 0 for i in docs.doc_id])
    y = np.array([labels.get(i, -1) for i in docs.doc_id])
    logs, n = [], train.sum()
    parts = {c: x[train & (y == c)] for c in (0, 1)}
    d, cov = x.shape[1], {c: np.cov(p.T, bias=True) for c, p in parts.items()}
    pooled = sum(cov[c] * len(parts[c]) for c in parts) / n
    pooled = 0.95 * pooled + 0.05 * np.diag(np.diag(pooled)) + quality_model.FLOOR * np.eye(d)
    for c, p in parts.items():
        lean = (quality_model.TO_POOLED * len(p) + d) / (len(p) + d)
        s = (1 - lean) * (cov[c] + quality_model.FLOOR * np.eye(d)) + lean * pooled
        z = x - p.mean(0)
        logs.append(np.log(len(p) / n) - 0.5 * (np.linalg.slogdet(s)[1] + np.einsum("ni,ij,nj->n", z, np.linalg.inv(s), z)))
    accepted = 1 / (1 + np.exp(np.clip(logs[0] - logs[1], -30, 30))) >= 0.3
    assert rows(kept) == rows(docs[accepted])
    good = docs[[labels.get(i) == 1 for i in docs.doc_id]]
    assert set(good.doc_id) <= set(kept.doc_id)


def test_one_document_of_each_component_stays(steps):
    docs, kept = steps[1], steps[2]
    component = brute_components({i: brute_print(t) for i, t in zip(docs.doc_id, docs.text)})
    assert rows(kept) == rows(docs[[component[i] == i for i in docs.doc_id]])
    assert len(kept) < len(docs)


def test_repeated_passages_go(steps):
    docs, kept = steps[2], steps[3].set_index("doc_id")
    want = {i: (n, k) for i, n, k in brute_passages(list(zip(docs.doc_id, docs.text)))}
    assert len(kept) == len(docs)
    for i, original in zip(docs.doc_id, docs.text):
        n, words = want[i]
        text = original if len(words) == n else " ".join(words)
        assert kept.text[i] == text and kept.n_chars[i] == len(text)


def test_mix_takes_what_the_plan_says(steps):
    docs, mixed = steps[3], steps[4]
    con = duckdb.connect()
    con.register("documents", docs)
    plan = con.execute(mixing.MIX_SQL.replace("as taken", "as taken, s.copies")).df()
    times = plan.set_index("doc_id").copies
    assert Counter(mixed.doc_id) == Counter({i: int(n) for i, n in times.items() if n})
    assert set(rows(mixed)) <= set(rows(docs))


def test_run_encodes_the_mix(spark, sf_dir, steps):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    out = cp.run(spark, sf_dir).toPandas()
    assert rows(out) == rows(steps[4])
    for r in out.itertuples():
        ids = t.encode(r.text, add_special_tokens=False).ids
        assert np.frombuffer(r.token_ids, "<u4").tolist() == ids and r.n_tokens == len(ids)
        assert r.decoded == t.decode(ids, skip_special_tokens=False)


def test_odd_rows_pass_through_all_stages(spark, tmp_path, odd_rows):
    table = spark.createDataFrame([(*r, len(r[1] or "")) for r in odd_rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, 1, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    for name, rows_of in (("some", table), ("none", table.where("false"))):
        rows_of.write.parquet(f"{tmp_path}/{name}/documents.parquet")
        labels.write.parquet(f"{tmp_path}/{name}/labels.parquet")
        out = cp.run(spark, f"{tmp_path}/{name}").collect()
        assert bool(out) == (name == "some")
        assert all(WORD.findall(r["text"] or "") or r["n_tokens"] == 0 for r in out)
