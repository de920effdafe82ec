"""Quality rules: robust multivariate outliers of document statistics.

Every document's counts become a vector of five transformed statistics. For
each (language, source) a minimum-covariance-determinant estimate is found by
concentration steps: mean and covariance of the current core, Mahalanobis
distance of every row, the closest ``core`` share (cut at an edge of bins of
1/64 of a power of two) becomes the next core. Three deterministic starts make
two steps each; that of the least determinant goes on until its determinant
falls no more. A document is rejected if its squared distance exceeds a
chi-square quantile.

Only DataFrame functions are used: one pass makes the statistics (array
functions within a row, no shuffle), the steps run on that narrow table with
one map-side aggregated row per group, and the Cholesky factor of a group's
covariance is a chain of column expressions.

Defined results: null or empty text has no words and fails the base rule.
Groups of fewer than ``min_group`` rows are pooled per language, then over
all; a pool still smaller judges nothing (kept by the method). Null language
or source is a group of its own. ``FLOORS`` are the least standard deviations
of the estimates, so a statistic without spread has a distance too. Repeated
rows are each judged; other columns of the table are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import SPACE_CLASS, binned_cut, register, save, small, words_of, work_dir

#: transformed statistics, and the least standard deviation that each is given
FLOORS = {"x_len": 0.5, "x_word": 0.25, "x_sym": 0.5, "x_lines": 0.5, "x_rep": 0.1}
DIMS = list(FLOORS)
CORE = 0.75        # share of a group that its estimate is made from; up to the rest may be spoilt
STARTS = 3         # first estimates of a group
FIRST_STEPS = 2    # concentration steps that each of them makes
STEPS = 30         # most steps of the best one; it stops when no determinant falls by more than TOLERANCE
TOLERANCE = 1e-9   # of its logarithm
MIN_GROUP = 50     # rows that a group needs for an estimate of its own
ALPHA = 1e-6       # share of a clean normal group beyond the cut
MIN_WORDS = 50
MAX_REPEAT_PCT = 50


def chi2_cdf(x: float, d: int) -> float:
    """Distribution function of chi-square with ``d`` degrees (incomplete gamma series)."""
    if x <= 0:
        return 0.0
    a, z = d / 2, x / 2
    term = total = 1 / a
    for n in range(1, 2000):
        term *= z / (a + n)
        total += term
        if term < total * 1e-15:
            break
    return min(1.0, total * math.exp(-z + a * math.log(z) - math.lgamma(a)))


def chi2_quantile(p: float, d: int) -> float:
    lo, hi = 0.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if chi2_cdf(mid, d) < p else (lo, mid)
    return (lo + hi) / 2


# ------------------------------------------------------------- statistics
def document_stats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple = ()) -> DataFrame:
    """Counts of every text: words, their code points, symbols, repeated
    lines and words in repeated 3-word windows. Windows are compared by their
    64-bit hash, within one document: sorted with their positions, equal
    neighbours are the repeats."""
    t = F.coalesce(F.col("_t"), F.lit(""))
    d = docs.select(F.col(id_col).alias("doc_id"), *keep, F.col(text_col).alias("_t"))
    d = d.withColumns({
        "_w": words_of(F.col("_t"), SPACE_CLASS),
        "n_symbols": F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long"),
        "_lines": F.filter(F.split(t, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")),
    })
    d = d.withColumns({
        "n_words": F.size("_w").cast("long"),
        "word_chars": F.length(F.array_join("_w", "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "_g": F.when(F.size("_w") >= 3, F.transform(
            F.sequence(F.lit(1), F.size("_w") - 2),
            lambda i: F.xxhash64(F.get("_w", i - 1), F.get("_w", i), F.get("_w", i + 1)))),
    })
    sorted_grams = F.sort_array(F.transform("_g", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    d = d.withColumn("_s", F.when(F.size(F.array_distinct("_g")) < F.size("_g"), sorted_grams))
    same = lambda x, y: F.get("_s", x)["h"] == F.get("_s", y)["h"]
    starts = F.sort_array(F.transform(
        F.filter(F.sequence(F.lit(0), F.size("_s") - 1),
                 lambda k: F.coalesce(same(k, k - 1), F.lit(False)) | F.coalesce(same(k, k + 1), F.lit(False))),
        lambda k: F.get("_s", k)["i"]))
    d = d.withColumn("_p", F.when(F.col("_s").isNotNull(), starts))
    # windows cover [p, p + 3): each start adds what the next one does not cover
    covered = F.aggregate(
        F.transform("_p", lambda p, k: F.least(F.lit(3), F.coalesce(F.get("_p", k + 1) - p, F.lit(3)))),
        F.lit(0), lambda a, x: a + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).select(
        "doc_id", *keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _vector(s: DataFrame) -> DataFrame:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return s.withColumns({
        "x_len": F.log1p(F.col("n_words").cast("double")),
        "x_word": F.col("word_chars") / words,
        "x_sym": F.log1p(100.0 * F.col("n_symbols") / words),
        "x_lines": F.log1p(100.0 * F.col("n_dup_lines") / words),
        "x_rep": F.col("n_repeat_words") / words,
    })


# --------------------------------------------------------------- estimate
_PAIRS = [(i, j) for i in range(len(DIMS)) for j in range(i + 1)]
_MEANS = [f"m_{i}" for i in range(len(DIMS))]
_FACTOR = [f"l_{i}{j}" for i, j in _PAIRS]
_ESTIMATE = [*_MEANS, *_FACTOR, "logdet"]


def _cholesky(e: DataFrame, keys: list[str]) -> DataFrame:
    """From covariances c_ij their Cholesky factor l_ij and the logarithm of the
    determinant. A variance is at least its statistic's floor squared."""
    for i, j in _PAIRS:
        s = F.greatest(F.col(f"c_{i}{j}"), F.lit(FLOORS[DIMS[i]] ** 2)) if i == j else F.col(f"c_{i}{j}")
        for k in range(j):
            s = s - F.col(f"l_{i}{k}") * F.col(f"l_{j}{k}")
        e = e.withColumn(f"l_{i}{j}", F.sqrt(F.greatest(s, F.lit(1e-9))) if i == j else s / F.col(f"l_{j}{j}"))
    logdet = sum((F.log(f"l_{i}{i}") for i in range(1, len(DIMS))), F.log("l_00")) * 2
    return e.withColumn("logdet", logdet).select(*keys, *_ESTIMATE)


def _distance(rows: DataFrame, est: DataFrame, estimates: int, extra: tuple = (), how: str = "left") -> DataFrame:
    """``rows`` with ``d2``, once for each of the group's estimates; null (or
    left out, by ``how``) where it has none. The rows stay where they are if all
    ``estimates`` may be broadcast."""
    r = rows.join(small(est, estimates), "_g", how)
    for i, a in enumerate(DIMS):  # forward substitution: L z = x - m
        s = F.col(a) - F.col(f"m_{i}")
        for k in range(i):
            s = s - F.col(f"l_{i}{k}") * F.col(f"z_{k}")
        r = r.withColumn(f"z_{i}", s / F.col(f"l_{i}{i}"))
    d2 = sum((F.col(f"z_{i}") ** 2 for i in range(1, len(DIMS))), F.col("z_0") ** 2)
    return r.withColumn("d2", d2).select(*rows.columns, *extra, "d2")


def _starts(used: DataFrame, groups: int, path: str) -> DataFrame:
    """Three estimates per group (``_s``), all at its medians and with its median
    absolute deviations: without correlation, with that of the hyperbolic
    tangents, and with that of the spatial signs of the standardised statistics."""
    long = used.select("_g", F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.col(a).alias("x")) for i, a in enumerate(DIMS)])).alias("_v"))
    long = long.select("_g", F.col("_v.i").alias("_i"), F.col("_v.x").alias("_x"))
    med = save(binned_cut(long, ["_g", "_i"], "_x", 0.5, "_m"), f"{path}/medians")
    off = long.join(small(med, groups * len(DIMS)), ["_g", "_i"]).withColumn("_d", F.abs(F.col("_x") - F.col("_m")))
    mad = binned_cut(off, ["_g", "_i"], "_d", 0.5, "_mad")
    pick = lambda i, c: F.max(F.when(F.col("_i") == i, c))
    centre = med.join(mad, ["_g", "_i"]).groupBy("_g").agg(
        *[pick(i, F.col("_m")).alias(f"m_{i}") for i in range(len(DIMS))],
        *[pick(i, F.greatest(1.4826 * F.col("_mad"), F.lit(FLOORS[a]))).alias(f"d_{i}") for i, a in enumerate(DIMS)])
    centre = save(centre, f"{path}/centre")
    z = [(F.col(a) - F.col(f"m_{i}")) / F.col(f"d_{i}") for i, a in enumerate(DIMS)]
    norm = F.sqrt(sum((x * x for x in z[1:]), z[0] * z[0]) + 1e-12)
    flat = used.join(small(centre, groups), "_g").select(
        "_g", *[F.tanh(x).alias(f"t_{i}") for i, x in enumerate(z)], *[(x / norm).alias(f"u_{i}") for i, x in enumerate(z)])
    sums = flat.groupBy("_g").agg(*[F.covar_pop(f"t_{i}", f"t_{j}").alias(f"t_{i}{j}") for i, j in _PAIRS],
                                  *[F.avg(F.col(f"u_{i}") * F.col(f"u_{j}")).alias(f"u_{i}{j}") for i, j in _PAIRS])
    wide = save(centre.join(sums, "_g"), f"{path}/scatter")

    def start(number: int, kind: str | None) -> DataFrame:
        def cov(i: int, j: int):
            d = F.col(f"d_{i}") * F.col(f"d_{j}")
            if i == j:
                return d
            if kind is None:
                return F.lit(0.0)
            both = F.sqrt(F.col(f"{kind}_{i}{i}") * F.col(f"{kind}_{j}{j}"))
            return F.when(both > 1e-12, d * F.col(f"{kind}_{i}{j}") / both).otherwise(0.0)
        return _cholesky(wide.select("_g", F.lit(number).alias("_s"), *_MEANS, *[cov(i, j).alias(f"c_{i}{j}") for i, j in _PAIRS]),
                         ["_g", "_s"])

    return save(start(0, None).unionByName(start(1, "t")).unionByName(start(2, "u")), f"{path}/starts")


def _concentrate(used: DataFrame, est: DataFrame, estimates: int, core: float) -> DataFrame:
    """One concentration step of every estimate: mean and covariance of the
    closest ``core`` share of its group's rows."""
    near = _distance(used, est, estimates, ("_s",), "inner")
    cut = binned_cut(near, ["_g", "_s"], "d2", core, "_cut")
    # the covariance of the closest share is too small by this factor
    factor = core / chi2_cdf(chi2_quantile(core, len(DIMS)), len(DIMS) + 2)
    e = near.join(small(cut, estimates), ["_g", "_s"]).filter(F.col("d2") <= F.col("_cut")).groupBy("_g", "_s").agg(
        *[F.avg(a).alias(f"m_{i}") for i, a in enumerate(DIMS)],
        *[(F.covar_pop(DIMS[i], DIMS[j]) * factor).alias(f"c_{i}{j}") for i, j in _PAIRS])
    return _cholesky(e, ["_g", "_s"])


def minimum_determinant(used: DataFrame, groups: int, path: str, core: float = CORE, steps: int = STEPS) -> DataFrame:
    """The estimate of each of ``groups`` groups ``_g``: after ``FIRST_STEPS`` steps
    of every start the one of the least determinant goes on until its
    determinant falls no more (or for ``steps`` steps)."""
    est = _starts(used, groups, path)
    for k in range(FIRST_STEPS):
        est = save(_concentrate(used, est, STARTS * groups, core), f"{path}/first{k}")
    least = F.min(F.struct("logdet", "_s", *[c for c in _ESTIMATE if c != "logdet"])).alias("_e")
    est = save(est.groupBy("_g").agg(least).select("_g", "_e.*").withColumn("_open", F.lit(True)), f"{path}/least")
    for k in range(steps):
        new = _concentrate(used, est.filter("_open").select("_g", "_s", *_ESTIMATE), groups, core)
        new = new.select("_g", F.struct(*_ESTIMATE).alias("_new"))
        both = est.join(new, "_g", "left").withColumn("_falls", F.coalesce(F.col("_new.logdet") < F.col("logdet") - TOLERANCE, F.lit(False)))
        est = save(both.select("_g", "_s", *[F.when(F.col("_falls"), F.col(f"_new.{c}")).otherwise(F.col(c)).alias(c) for c in _ESTIMATE],
                               F.col("_falls").alias("_open")), f"{path}/step{k}")
        if est.filter("_open").isEmpty():
            break
    return est.select("_g", *_ESTIMATE)


def robust_outliers(stats: DataFrame, usable: str, lang: str = "lang", source: str = "source",
                    core: float = CORE, steps: int = STEPS, min_group: int = MIN_GROUP,
                    alpha: float = ALPHA) -> DataFrame:
    """``stats`` (see ``document_stats``) with ``d2`` (null: no estimate) and
    ``outlier``. Rows where ``usable`` is false get a distance too but no
    part in the estimates."""
    spark = stats.sparkSession
    path = work_dir(spark, "mcd")
    name = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("null"))
    rows = _vector(stats).withColumns({"_l": name(lang), "_o": name(source)})
    sizes = save(rows.filter(usable).groupBy("_l", "_o").agg(F.count(F.lit(1)).alias("_n")), f"{path}/sizes")
    own = sizes.filter(F.col("_n") >= min_group).select("_l", "_o", F.concat("_l", F.lit("\t"), "_o").alias("_own"))
    pools = (sizes.filter(F.col("_n") < min_group).groupBy("_l").agg(F.sum("_n").alias("_n"))
             .filter(F.col("_n") >= min_group).select("_l", F.col("_l").alias("_pool")))
    n = sizes.count()  # bounds every table of groups; rows learn their group where they are
    rows = (rows.join(small(own, n), ["_l", "_o"], "left").join(small(pools, n), "_l", "left")
            .withColumn("_g", F.coalesce("_own", "_pool", F.lit("all"))).drop("_l", "_o", "_own", "_pool"))
    rows = save(rows, f"{path}/rows")
    used = rows.filter(usable).select("_g", *DIMS)
    size = used.groupBy("_g").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_group)
    size = save(size, f"{path}/size")
    n = size.count()
    est = minimum_determinant(used.join(small(size.select("_g"), n), "_g", "left_semi"), n, path, core, steps)
    limit = chi2_quantile(1 - alpha, len(DIMS))
    return (_distance(rows, est, n).withColumn("outlier", F.coalesce(F.col("d2") > limit, F.lit(False)))
            .drop("_g", *DIMS))


def judge_documents(docs: DataFrame) -> DataFrame:
    """Statistics, base rule, distance and verdict of every document."""
    path = work_dir(docs.sparkSession, "stats")
    stats = save(document_stats(docs, keep=("lang", "source")), f"{path}/stats")
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PCT * F.col("n_words"))
    out = robust_outliers(stats.withColumn("base_failed", base), "not base_failed")
    return out.withColumn("kept", ~F.col("base_failed") & ~F.col("outlier"))


@register("op7_quality_rules")
def q_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source")
    return judge_documents(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "d2", "lang", "source")
