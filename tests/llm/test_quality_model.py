import zlib

import numpy as np
from flowframe.llm import quality_model


def test_held_out_accuracy_and_inputs(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = {r["doc_id"]: r for r in quality_model.score_documents(documents, labels).collect()}
    assert len(out) == documents.count()
    for i, r in out.items():
        assert r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    held = [(r["quality"], out[r["doc_id"]]["predicted"]) for r in labels.collect() if out[r["doc_id"]]["held_out"]]
    assert np.mean([a == b for a, b in held]) >= 0.95
    # neither the other columns nor held-out labels change a score
    other = documents.selectExpr("doc_id", "text", "'x' as lang", "cast(null as string) as source")
    flipped = labels.selectExpr("doc_id", "if(crc32(cast(doc_id as string)) % 5 = 0, 1 - quality, quality) as quality")
    again = {r["doc_id"]: r["score"] for r in quality_model.score_documents(other, flipped).collect()}
    assert all(abs(again[i] - r["score"]) < 1e-9 for i, r in out.items())


def test_model_matches_plain_densities():
    """The score is the Bayes rule on the two regularised normal densities."""
    draw = np.random.default_rng(1)
    d = len(quality_model.FEATURES)
    rows = {0: draw.normal(0, 1, (300, d)), 1: draw.normal(0.5, 0.7, (900, d))}
    model = quality_model.Discriminant({y: (float(len(x)), x.sum(0), x.T @ x) for y, x in rows.items()})
    x = draw.normal(0, 1, (50, d))
    dens = []
    for y in (0, 1):
        inverse = model.inverse[y].T @ model.inverse[y]
        diff = x - rows[y].mean(0)
        dens.append(np.log(len(rows[y]) / 1200) + 0.5 * np.linalg.slogdet(inverse)[1] - 0.5 * np.einsum("ni,ij,nj->n", diff, inverse, diff))
    odds = np.clip(dens[1] - dens[0], -quality_model.CERTAIN, quality_model.CERTAIN)
    assert np.allclose(model.score(x), 1 / (1 + np.exp(-odds)))


def test_odd_rows(spark, odd_documents, odd_rows, no_documents):
    labels = spark.createDataFrame([(1, 1), (2, 1), (5, 0), (9, 0), (13, None), (None, 1), (7, 3)], "doc_id long, quality int")
    out = quality_model.score_documents(odd_documents, labels).collect()
    assert len(out) == len(odd_rows) and all(0 <= r["score"] <= 1 for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (4, 5)}) == 1
    kept = quality_model.keep_accepted(odd_documents, labels)
    assert kept.columns == odd_documents.columns
    assert kept.count() == sum(r["predicted"] for r in out)
    none = labels.where("false")
    assert {r["score"] for r in quality_model.score_documents(odd_documents, none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1) for i in range(20)], "doc_id long, quality int")
    assert all(r["predicted"] for r in quality_model.score_documents(odd_documents, ones).collect())
    assert quality_model.score_documents(no_documents, labels).collect() == []
    assert quality_model.keep_accepted(no_documents, labels).collect() == []
