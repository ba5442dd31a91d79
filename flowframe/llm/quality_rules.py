"""Quality rules on whole texts and robust outliers per language and source, in DataFrame operations only.

Every text becomes counts and from them a vector of transformed statistics.
For each (language, source), each language and the whole corpus a
minimum-covariance-determinant estimate is fitted to the documents that pass
the base rules: from two deterministic starts (hyperbolic-tangent and
spatial-sign scatter of the median-scaled vectors, as in DetMCD, Hubert,
Rousseeuw and Verdonck, 2012), concentration steps keep the ``COVERAGE``
share of the rows with the smallest Mahalanobis distance and re-estimate until
no determinant falls; the start with the smaller determinant wins.  The estimate is scaled to the
chi-square median and re-weighted once.  A document is judged by its own
(language, source) from its first row beyond ``P`` on: the scatter of a group is
averaged with that of its language, and that of the language with the
corpus's, by a weight that grows smoothly with the group's rows (``shrunk``).
It is rejected when its squared distance is above the chi-square quantile
``CUT``.

Variances carry a floor per statistic (a regularised MCD): most clean texts
have no symbols and no repeated lines at all, and without it the first symbol
would be infinitely far.  All sums are map-side combined; quantiles are read off
histograms of fixed bins (``_quantiles``), whose counts are spread over tasks by
bin, so that no task merges what a whole group sends; the Cholesky factor of a
group is spelled out in column expressions over the table of groups.
"""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowframe.llm.common import stage, word_array

MIN_WORDS = 50
#: Statistics and the floor of their standard deviation, in their own unit.
STATISTICS = {"log_words": 0.3, "log_word_length": 0.05, "symbols": 0.05, "repeated_lines": 0.2,
              "repeated_words": 0.2, "upper": 0.05}
NAMES = list(STATISTICS)
P = len(NAMES)
#: The half-sample: of all shares it withstands the most outliers, just under half of a group's rows.
COVERAGE = 0.5
#: A log determinant that falls by less has settled.
SETTLED = 1e-3
#: Rows beyond the first P at which the scatter of a group counts as much as that of the group above it.
SHRINK = 5 * P
#: Chi-square probabilities of the re-weighting and of the verdict.
REWEIGHT, CUT = 0.975, 1 - 1e-6
#: Bins of a histogram: of a statistic to the floor of its deviation, of a distance to the factor 2.
BINS = 64
#: Smaller squared distances share a bin.
NEAREST = 2.0 ** -20
#: Parts into which the rows of a group are dealt.
SALTS = 64


def chi_square(probability: float, degrees: int = P) -> float:
    """The quantile by Wilson and Hilferty's cube-root approximation."""
    z, c = NormalDist().inv_cdf(probability), 2 / (9 * degrees)
    return degrees * (1 - c + z * c ** 0.5) ** 3


def measured(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_upper added (long).

    Null texts have no words.  A three-word window is known by the 64-bit
    hash of its words; windows are compared within one text only.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    out = docs.withColumn("__words", word_array(F.col(text_col)))
    out = out.withColumn("__windows", F.when(F.size("__words") >= 3, F.transform(
        F.sequence(F.lit(0), F.size("__words") - 3),
        lambda i: F.xxhash64(F.get("__words", i), F.get("__words", i + 1), F.get("__words", i + 2)))).otherwise(
        F.array().cast("array<bigint>")))
    # only texts with a repeated window sort theirs
    out = out.withColumn("__sorted", F.when(
        F.size(F.array_distinct("__windows")) < F.size("__windows"),
        F.sort_array(F.transform("__windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(
        F.array().cast("array<struct<h:bigint,i:int>>")))
    out = out.withColumn("__twice", F.sort_array(F.transform(F.filter(
        "__sorted", lambda s, k: F.coalesce(F.get("__sorted", k - 1)["h"] == s["h"], F.lit(False))
        | F.coalesce(F.get("__sorted", k + 1)["h"] == s["h"], F.lit(False))), lambda s: s["i"])))
    covered = F.aggregate(
        F.transform("__twice", lambda p, k: F.least(F.lit(3), F.coalesce(p - F.get("__twice", k - 1), F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    out = out.withColumn("__lines", lines)
    return out.withColumns({
        "n_words": F.size("__words").cast("long"),
        "word_chars": F.length(F.array_join("__words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long"),
        "n_upper": F.length(F.regexp_replace(text, r"[^A-Z]+", "")).cast("long"),
        "n_lines": F.size("__lines").cast("long"),
        "n_dup_lines": (F.size("__lines") - F.size(F.array_distinct("__lines"))).cast("long"),
        "n_repeat_words": covered.cast("long"),
    }).drop("__words", "__windows", "__sorted", "__twice", "__lines")


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


def _share(part: str, whole: str) -> Column:
    return F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))


def vector() -> dict[str, Column]:
    """The transformed statistics of a measured text."""
    return {
        "log_words": F.log1p("n_words"),
        "log_word_length": F.log1p(F.col("word_chars") / F.greatest(F.col("n_words"), F.lit(1))),
        "symbols": _share("n_symbols", "word_chars"),
        "repeated_lines": _share("n_dup_lines", "n_lines"),
        "repeated_words": _share("n_repeat_words", "n_words"),
        "upper": _share("n_upper", "word_chars"),
    }


def _cells() -> list[tuple[int, int]]:
    return [(i, j) for i in range(P) for j in range(i + 1)]


def _moments() -> list[Column]:
    """Aggregates of the scaled columns z0..: number, sums, sums of products."""
    z = [F.col(f"z{i}") for i in range(P)]
    return ([F.count(F.lit(1)).alias("m")] + [F.sum(z[i]).alias(f"s{i}") for i in range(P)]
            + [F.sum(z[i] * z[j]).alias(f"q{i}_{j}") for i, j in _cells()])


def _estimate(sums: DataFrame, *keep: str, centred: bool = True) -> DataFrame:
    """Mean mu, inverse Cholesky factor as one array and log determinant of each row of sums.

    The variance floor is in scaled units, f0.. on the row.
    """
    m = F.greatest(F.col("m"), F.lit(1))
    out = sums.withColumns({f"mu{i}": (F.col(f"s{i}") / m) if centred else F.lit(0.0) for i in range(P)})
    out = out.withColumns({
        f"c{i}_{j}": F.coalesce(F.col(f"q{i}_{j}") / m - F.col(f"mu{i}") * F.col(f"mu{j}"), F.lit(0.0))
        + (F.col(f"f{i}") * F.col(f"f{i}") if i == j else F.lit(0.0)) for i, j in _cells()})
    return _factored(out, *keep)


def _factored(out: DataFrame, *keep: str) -> DataFrame:
    """Mean, scatter, inverse Cholesky factor and log determinant of each row of means mu0.. and scatters c0_0.."""
    for j in range(P):
        diagonal = F.col(f"c{j}_{j}")
        for k in range(j):
            diagonal = diagonal - F.col(f"l{j}_{k}") * F.col(f"l{j}_{k}")
        out = out.withColumn(f"l{j}_{j}", F.sqrt(F.greatest(diagonal, F.lit(1e-12))))
        below = {}
        for i in range(j + 1, P):
            v = F.col(f"c{i}_{j}")
            for k in range(j):
                v = v - F.col(f"l{i}_{k}") * F.col(f"l{j}_{k}")
            below[f"l{i}_{j}"] = v / F.col(f"l{j}_{j}")
        out = out.withColumns(below) if below else out
    for i in range(P):
        row = {}
        for j in range(i + 1):
            if i == j:
                row[f"v{i}_{j}"] = 1 / F.col(f"l{i}_{i}")
            else:
                v = F.lit(0.0)
                for k in range(j, i):
                    v = v - F.col(f"l{i}_{k}") * F.col(f"v{k}_{j}")
                row[f"v{i}_{j}"] = v / F.col(f"l{i}_{i}")
        out = out.withColumns(row)
    log_det = sum((F.log(F.col(f"l{i}_{i}")) * 2 for i in range(P)), F.lit(0.0))
    return out.select(*keep, F.array(*[F.col(f"mu{i}") for i in range(P)]).alias("mu"),
                      F.array(*[F.col(f"c{i}_{j}") for i, j in _cells()]).alias("scatter"),
                      F.array(*[F.col(f"v{i}_{j}") for i, j in _cells()]).alias("inverse"), log_det.alias("log_det"))


def _distance(z: list[Column], mu: str = "mu", inverse: str = "inverse") -> Column:
    """Squared Mahalanobis distance of scaled values under a group's estimate."""
    at = {c: k for k, c in enumerate(_cells())}
    d = [z[i] - F.col(mu)[i] for i in range(P)]
    total = F.lit(0.0)
    for i in range(P):
        y = sum((F.col(inverse)[at[i, j]] * d[j] for j in range(i + 1)), F.lit(0.0))
        total = total + y * y
    return total


def _with_group(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Rows joined with the figures of their key.

    A key (the whole corpus is one) may hold a third of all rows, so rows
    carry one of ``SALTS`` salts and the few figures are repeated for each:
    the join deals a hot key to many tasks, and an aggregate by key above it
    still has a map-side part.
    """
    salted = groups.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(salted, ["key", "salt"])


def _quantiles(rows: DataFrame, by: list[str], value: str, bin: Column, share: float) -> DataFrame:
    """Per ``by`` its rows ``n`` and ``at``, the value of rank ceil(share * n).

    ``bin`` grows with the value and takes a bounded number of values.  Rows
    are counted by bin first, map-side and then over tasks by (``by``, bin);
    only the counts of the bins of one ``by`` meet in one task.  Inside its bin
    the rank is placed evenly between the smallest and the largest value
    there, which is exact where a bin holds at most two rows or one value.
    """
    counts = rows.withColumn("bin", bin).groupBy(*by, "bin").agg(
        F.count(F.lit(1)).alias("c"), F.min(value).alias("low"), F.max(value).alias("high"))
    whole = Window.partitionBy(*by)
    counts = counts.withColumns({"upto": F.sum("c").over(whole.orderBy("bin")), "n": F.sum("c").over(whole)})
    place = F.ceil(F.col("n") * share) - (F.col("upto") - F.col("c"))
    step = (F.col("high") - F.col("low")) / F.greatest(F.col("c") - 1, F.lit(1))
    return counts.where((place >= 1) & (place <= F.col("c"))).select(*by, "n", (F.col("low") + (place - 1) * step).alias("at"))


def _medians(rows: DataFrame, values: list[Column], out: str) -> DataFrame:
    """Per key its ``rows`` and the medians of the values of every statistic, as columns out0.. ."""
    floors = F.array(*[F.lit(f / BINS) for f in STATISTICS.values()])
    long = rows.select("key", F.posexplode(F.array(*values)).alias("i", "x"))
    found = _quantiles(long, ["key", "i"], "x", F.floor(F.col("x") / F.get(floors, F.col("i"))), 0.5)
    return found.groupBy("key").agg(F.max("n").alias("rows"), *[
        F.max(F.when(F.col("i") == i, F.col("at"))).alias(f"{out}{i}") for i in range(P)])


def _distance_quantile(rows: DataFrame, by: list[str], distance: Column, share: float, out: str) -> DataFrame:
    """Per ``by`` the quantile of the squared distances."""
    bin = F.floor(F.log2(F.greatest(F.col("d"), F.lit(NEAREST))) * BINS)
    return _quantiles(rows.select(*by, distance.alias("d")), by, "d", bin, share).select(*by, F.col("at").alias(out))


def fit_groups(vectors: DataFrame) -> DataFrame:
    """``vectors`` (key, the statistics; any others) -> per key its rows, scale and robust estimate.

    Result: (key, rows, mid_at, unit, mu, scatter, inverse arrays, grown).
    """
    floors = list(STATISTICS.values())
    vectors = vectors.withColumn("salt", (F.monotonically_increasing_id() % SALTS).cast("int"))
    mids = stage(_medians(vectors, [F.col(n) for n in NAMES], "a"), "mids")
    spread = _medians(_with_group(vectors, mids), [F.abs(F.col(n) - F.col(f"a{i}")) for i, n in enumerate(NAMES)], "b")
    mads = mids.join(spread.drop("rows"), "key")
    unit = {f"b{i}": F.sqrt(F.col(f"b{i}") * F.col(f"b{i}") * 1.4826 ** 2 + F.lit(floors[i] ** 2)) for i in range(P)}
    scales = stage(mads.withColumns(unit).withColumns({f"f{i}": F.lit(floors[i]) / F.col(f"b{i}") for i in range(P)}), "scales")
    scaled = stage(_with_group(vectors, scales).select(
        "key", "salt", *[((F.col(n) - F.col(f"a{i}")) / F.col(f"b{i}")).alias(f"z{i}") for i, n in enumerate(NAMES)]), "scaled")
    floor = scales.select("key", *[f"f{i}" for i in range(P)])
    z = [F.col(f"z{i}") for i in range(P)]
    norm = F.sqrt(sum((x * x for x in z), F.lit(1e-12)))
    starts = None
    for name, values in (("tanh", [F.tanh(x) for x in z]), ("sign", [x / norm * P ** 0.5 for x in z])):
        first = scaled.select("key", *[v.alias(f"z{i}") for i, v in enumerate(values)]).groupBy("key").agg(*_moments())
        one = _estimate(first.join(floor, "key").withColumn("start", F.lit(name)), "key", "start", centred=False)
        starts = one if starts is None else starts.union(one)
    # the first determinants are those of transformed values: the fall is counted from the second step on
    moving, settled = stage(_concentrated(scaled, stage(starts, "estimates"), floor, z), "estimates"), None
    while not moving.isEmpty():
        before = moving.select("key", "start", F.col("log_det").alias("before"))
        step = stage(_concentrated(scaled, moving, floor, z).join(before, ["key", "start"]), "estimates")
        fell = F.col("log_det") < F.col("before") - SETTLED
        still = step.where(~fell).drop("before")
        moving, settled = step.where(fell).drop("before"), still if settled is None else settled.union(still)
    best = (moving if settled is None else settled).groupBy("key").agg(F.min_by(F.struct("mu", "inverse"), F.struct("log_det", "start")).alias("e")).select(
        "key", "e.mu", "e.inverse", F.lit("best").alias("start"), F.lit(0.0).alias("log_det"))
    distance = _distance(z)
    best = stage(best, "estimates")
    scale = _distance_quantile(_with_group(scaled, best), ["key"], distance, 0.5, "mid")
    best = stage(best.join(scale, "key").withColumn("limit", F.col("mid") / chi_square(0.5) * chi_square(REWEIGHT)), "estimates")
    sums = _with_group(scaled, best).where(distance <= F.col("limit")).groupBy("key").agg(*_moments())
    final = stage(_estimate(sums.join(floor, "key"), "key"), "estimates")
    # the floor is part of the scatter, so the distances are only ever stretched to the chi-square median, never shrunk
    scale = _distance_quantile(_with_group(scaled, final), ["key"], distance, 0.5, "mid")
    grown = F.greatest(F.lit(1.0), F.col("mid") / chi_square(0.5))
    return scales.select("key", "rows", F.array(*[F.col(f"a{i}") for i in range(P)]).alias("mid_at"),
                         F.array(*[F.col(f"b{i}") for i in range(P)]).alias("unit")).join(
        final.join(scale, "key").select("key", "mu", "scatter", "inverse", grown.alias("grown")), "key")


def shrunk(groups: DataFrame, paths: DataFrame) -> DataFrame:
    """Per path of ``paths`` (keys, finest first) the estimate its documents are judged by: (key, mu, inverse), unscaled.

    A scatter of ``P`` statistics needs more than ``P`` rows; with x rows
    beyond those, a group's scatter is averaged with that of the group above
    it by the weight x / (x + ``SHRINK``) and its centre by x / P up to 1,
    and the scatter of the mixture of both centres is added.  All weights
    begin at 0 and none jumps.
    """
    cells = _cells()
    at = {c: k for k, c in enumerate(cells)}
    raw = stage(groups.select(
        "key", "rows", *[(F.col("mid_at")[i] + F.col("unit")[i] * F.col("mu")[i]).alias(f"mu{i}") for i in range(P)],
        *[(F.col("scatter")[at[i, j]] * F.col("unit")[i] * F.col("unit")[j] * F.col("grown")).alias(f"c{i}_{j}") for i, j in cells]),
        "raw-groups")
    names = [f"mu{i}" for i in range(P)] + [f"c{i}_{j}" for i, j in cells]
    out = paths.distinct()
    out = out.join(raw.select(F.col("key").alias("k"), *names), F.col("keys")[2] == F.col("k")).drop("k")
    for level in (1, 0):
        own = raw.select(F.col("key").alias("k"), "rows", *[F.col(n).alias(f"own_{n}") for n in names])
        out = out.join(own, F.col("keys")[level] == F.col("k"))
        beyond = F.greatest(F.col("rows") - P, F.lit(0))
        w, v = beyond / (beyond + F.lit(SHRINK)), F.least(F.lit(1.0), beyond / F.lit(P))
        gap = [F.col(f"own_mu{i}") - F.col(f"mu{i}") for i in range(P)]
        out = out.select("keys", *[(F.col(f"mu{i}") + v * gap[i]).alias(f"mu{i}") for i in range(P)], *[
            (w * F.col(f"own_c{i}_{j}") + (1 - w) * F.col(f"c{i}_{j}") + v * (1 - v) * gap[i] * gap[j]).alias(f"c{i}_{j}")
            for i, j in cells])
    return _factored(out.withColumn("key", F.col("keys")[0]), "key").select("key", "mu", "inverse")


def _concentrated(scaled: DataFrame, current: DataFrame, floor: DataFrame, z: list[Column]) -> DataFrame:
    """One concentration step of every group and start."""
    distance = _distance(z)
    near = _distance_quantile(_with_group(scaled, current), ["key", "start"], distance, COVERAGE, "limit")
    # written first: the planner then knows how few figures these are and leaves the rows where they lie
    chosen = stage(current.join(near, ["key", "start"]), "chosen")
    sums = _with_group(scaled, chosen).where(distance <= F.col("limit")).groupBy("key", "start").agg(*_moments())
    return _estimate(sums.join(floor, "key"), "key", "start")


def _keys(lang: str, source: str) -> list[Column]:
    """The three groups of a document, finest first; null is a language or source of its own."""
    none = F.lit(None).cast("string")
    return [F.to_json(F.array(F.lit(level), a, b)) for level, a, b in (
        ("source", F.col(lang).cast("string"), F.col(source).cast("string")),
        ("lang", F.col(lang).cast("string"), none), ("all", none, none))]


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source") -> DataFrame:
    """Per row of ``docs``: (id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept).

    ``distance`` is the squared Mahalanobis distance (null where the base
    rules fail); ``kept`` is false where they fail or the distance is above
    the cut.  Null and empty texts fail the base rules.  Null ids, languages
    and sources are values like any other; repeated rows are judged one by
    one.  Where no document passes the base rules nothing is kept.
    """
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                         F.array(*_keys(lang_col, source_col)).alias("keys"))
    counted = measured(narrow).withColumn("base_failed", base_failed()).withColumns(vector()).drop("text")
    rows = stage(counted, "measured")
    groups = stage(fit_groups(rows.where(~F.col("base_failed")).select(F.explode("keys").alias("key"), *NAMES)), "groups")
    passed = rows.where(~F.col("base_failed")).select("keys")
    own = stage(shrunk(groups, passed), "judging").withColumnRenamed("key", "k0")
    out = rows.join(own, F.col("keys")[0] == F.col("k0"), "left").drop("k0")
    distance = F.when(~F.col("base_failed"), _distance([F.col(n) for n in NAMES]))
    return out.withColumn("distance", distance).select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "distance", F.coalesce(~F.col("base_failed") & (F.col("distance") <= chi_square(CUT)), F.lit(False)).alias("kept"))

