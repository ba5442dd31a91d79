"""A quality classifier: regularised quadratic discriminant on statistics of whole texts.

Each text becomes a short vector of transformed statistics.  Per class the
mean and covariance come from sums over all labelled training rows (computed
as Spark aggregates); a class covariance is shrunk towards the pooled one and
that towards its diagonal.  A score is the logistic of the difference of the
two log densities plus the log prior; the Mahalanobis distances use Cholesky
factors that are inverted once.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowframe.llm.common import give_back, longs, map_batches, stage, texts, words

FEATURES = ("log_words", "word_length", "upper", "symbols", "calls", "stops", "digits", "other_ascii",
            "repeated_lines", "word_variety", "repeated_triples", "longest_word")
#: Share of the pooled covariance in a class covariance, and of the diagonal in the pooled one.
TO_POOLED, TO_DIAGONAL = 0.1, 0.05
#: Added to every variance, so that a constant statistic has a defined density.
FLOOR = 1e-3
#: Log odds beyond this count as this.
CERTAIN = 30.0

_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"
_SYMBOLS = b"#*$%&|<>"
_CALLS = b"!?"
_STOPS = b".,;:"
_OTHER = b"\"'()+-/=@[\\]^_`{}~"


def text_statistics(text: bytes) -> list[float]:
    """The transformed statistics of one text, in the order of ``FEATURES``; an empty text has its own fixed vector."""
    ws = words(text)
    n, size = len(ws), max(1, len(text))

    def share(chars: bytes) -> float:
        return math.sqrt((len(text) - len(text.translate(None, chars))) / size)

    lines = [x for x in text.split(b"\n") if x.strip()]
    triples = len(set(zip(ws, ws[1:], ws[2:])))
    return [
        math.log1p(n),
        math.log1p(sum(map(len, ws)) / max(1, n)),
        share(_UPPER), share(_SYMBOLS), share(_CALLS), share(_STOPS), share(_DIGITS), share(_OTHER),
        math.sqrt(1 - len(set(lines)) / len(lines)) if lines else 0.0,
        (math.log1p(len(set(ws))) - math.log1p(n)),
        math.sqrt(1 - triples / (n - 2)) if n > 2 else 0.0,
        math.log1p(max(map(len, ws), default=0)),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, f array<double>) per row of ``docs``; null texts count as empty."""
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    return map_batches(
        source, lambda b: {"id": longs(b, "id"), "f": [text_statistics(t) for t in texts(b, "text")]},
        f"id {kind}, f array<double>")


class Discriminant:
    """The two class densities; ``odds`` gives the log odds of label 1 for rows of statistics."""

    def __init__(self, moments: dict[int, tuple[float, np.ndarray, np.ndarray]]):
        d = len(FEATURES)
        self.known = sorted(moments)
        if not moments:
            return
        n = {y: moments[y][0] for y in moments}
        mean = {y: s / c for y, (c, s, _) in moments.items()}
        spread = {y: q / c - np.outer(mean[y], mean[y]) for y, (c, _, q) in moments.items()}
        pooled = sum(spread[y] * n[y] for y in moments) / sum(n.values())
        pooled = (1 - TO_DIAGONAL) * pooled + TO_DIAGONAL * np.diag(np.diag(pooled)) + FLOOR * np.eye(d)
        self.mean, self.inverse, self.log_det, self.prior = {}, {}, {}, {}
        for y in moments:
            # few rows lean on the pooled covariance as if it were this many rows of their own
            lean = (TO_POOLED * n[y] + d) / (n[y] + d)
            factor = np.linalg.cholesky((1 - lean) * (spread[y] + FLOOR * np.eye(d)) + lean * pooled)
            self.mean[y], self.inverse[y] = mean[y], np.linalg.inv(factor)
            self.log_det[y] = 2 * np.log(np.diag(factor)).sum()
            self.prior[y] = math.log(n[y] / sum(n.values()))

    def _log_density(self, y: int, x: np.ndarray) -> np.ndarray:
        z = (x - self.mean[y]) @ self.inverse[y].T
        return self.prior[y] - 0.5 * (self.log_det[y] + (z * z).sum(axis=1))

    def odds(self, x: np.ndarray) -> np.ndarray:
        if self.known == [0, 1]:
            return np.clip(self._log_density(1, x) - self._log_density(0, x), -CERTAIN, CERTAIN)
        return np.full(len(x), {(1,): CERTAIN, (0,): -CERTAIN}.get(tuple(self.known), 0.0))

    def score(self, x: np.ndarray) -> np.ndarray:
        """The probability of label 1."""
        return 1 / (1 + np.exp(-self.odds(x)))


def fit(stats: DataFrame, labels: DataFrame) -> Discriminant:
    """Fit on the rows of ``stats`` (id, f) that ``labels`` (id, y) gives a 0 or 1.

    The sums of a class are one row of (number, sums, sums of products); the
    driver receives two such rows whatever the corpus.
    """
    d = len(FEATURES)
    one = labels.where("y in (0, 1) and id is not null").groupBy("id").agg(F.max("y").alias("y"))
    f = [F.col("f")[i] for i in range(d)]
    sums = stats.join(one, "id").groupBy("y").agg(
        F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(f)],
        *[F.sum(f[i] * f[j]).alias(f"q{i}_{j}") for i in range(d) for j in range(i, d)])
    moments = {}
    for r in sums.collect():
        q = np.array([[r[f"q{min(i, j)}_{max(i, j)}"] for j in range(d)] for i in range(d)])
        moments[int(r["y"])] = float(r["n"]), np.array([r[f"s{i}"] for i in range(d)]), q
    return Discriminant(moments)


def fold(id_col: str = "doc_id", folds: int = 5):
    """crc32 of the id's text modulo ``folds`` (null id: null)."""
    return F.crc32(F.col(id_col).cast("string")) % folds


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "quality", folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """Per row of ``docs``: (id, held_out, score, predicted).

    Learned from labelled rows whose fold is not 0; fold 0 is held out.
    Empty and null texts get the score of the empty text's statistics; rows
    with a null id are scored and never learned from; repeated rows each get
    a row.  Without training labels every score is 0.5, with labels of one
    class the score is that class's.  Only the named columns are read.
    """
    stats = stage(statistics(docs, id_col, text_col), "statistics")
    model = fit(stats, training_labels(labels, id_col, label_col, folds))

    def scores(batch):
        x = np.array(batch.column("f").to_pylist(), float).reshape(-1, len(FEATURES))
        return {"id": longs(batch, "id"), "score": model.score(x).tolist()}

    scored = map_batches(stats, scores, f"id {stats.schema['id'].dataType.simpleString()}, score double")
    return scored.select(
        F.col("id").alias(id_col), F.coalesce(fold("id", folds) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"))


def training_labels(labels: DataFrame, id_col: str, label_col: str, folds: int) -> DataFrame:
    return labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y")).where(fold("id", folds) != 0)


def keep_accepted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", folds: int = 5, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` whose score reaches ``threshold``, all columns unchanged.

    Each row is judged by its own text in a second pass over the texts, not
    by a join on the id: rows that share an id or have none are judged one
    by one and no text is shuffled.  Otherwise as ``score_documents``.
    """
    model = fit(statistics(docs, id_col, text_col), training_labels(labels, id_col, label_col, folds))

    def accept(batches):
        for batch in batches:
            x = np.array([text_statistics(t) for t in texts(batch, text_col)], float).reshape(-1, len(FEATURES))
            yield batch.filter(pa.array(model.score(x) >= threshold))
        give_back()

    return docs.mapInArrow(accept, docs.schema)
