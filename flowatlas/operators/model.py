"""Random-forest baseline for corridor strength, and its explanation tables.

Training data is the corridor-year table (``spatial.corridor_year``); its
size is bounded by countries^2 x years whatever the size of the stock
table, and MLlib builds the trees distributed over the executors.

* temporal split: the last 3 distinct years are the test set (last 2 when
  fewer than 8 years); gates refuse with a reason instead of raising;
* forest: ``RandomForestRegressor`` on log1p(value) with all features per
  split, min 2 rows per leaf, seed 42, depth 30 (MLlib's maximum; the
  reference grows unbounded trees) and 256 bins;
* explanations: test metrics, importances, predictions for one year with
  a fallback to the latest year, actual vs predicted band mix, per-tree
  uncertainty of the band mix, top destinations, a 2-d similarity map.
"""

from __future__ import annotations

import threading
import uuid
from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.functions.columns import share_or_zero, sum0
from flowatlas.operators.spatial import feature_matrix
from flowatlas.schemas import DISTANCE_BANDS, FEATURE_COLUMNS
from flowatlas.session import shared_dir

# Series labels, model gates (rows, years, train rows, test
# rows) and the reasons given when a gate refuses.
ACTUAL = "Actual observed"
PREDICTED = "ML predicted"
MIN_ROWS, MIN_YEARS, MIN_TRAIN, MIN_TEST = 80, 5, 50, 10
REASON_ROWS = "too_few_rows"
REASON_YEARS = "too_few_years"
REASON_SPLIT = "split_too_small"


# ------------------------------------------------------------------ split
def test_years(cy: DataFrame) -> DataFrame:
    """The hold-out years: last 3 distinct years, or last 2 with < 8 years."""
    years = cy.select("year").where(F.col("year").isNotNull()).distinct()
    n_years = years.agg(F.count(F.lit(1))).scalar()
    r = years.withColumn("_r", F.row_number().over(Window.orderBy(F.col("year").desc())))
    return r.filter(F.col("_r") <= F.when(n_years >= 8, F.lit(3)).otherwise(F.lit(2))).select("year")


def temporal_split(cy: DataFrame) -> DataFrame:
    """``cy`` plus ``is_test`` (broadcast join with the <= 3 test years)."""
    t = F.broadcast(test_years(cy).withColumn("is_test", F.lit(True)))
    return cy.join(t, "year", "left").withColumn("is_test", F.coalesce("is_test", F.lit(False)))


def train_gates(cy: DataFrame) -> DataFrame:
    """One row: ok, reason, train_rows, test_rows."""
    s = temporal_split(cy)
    a = s.agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("year").alias("years"),
              F.count_if(~F.col("is_test")).alias("train_rows"),
              F.count_if(F.col("is_test")).alias("test_rows"))
    reason = (F.when(F.col("rows") < MIN_ROWS, F.lit(REASON_ROWS))
              .when(F.col("years") < MIN_YEARS, F.lit(REASON_YEARS))
              .when((F.col("train_rows") < MIN_TRAIN) | (F.col("test_rows") < MIN_TEST), F.lit(REASON_SPLIT))
              .otherwise(F.lit("OK")))
    return a.select((reason == "OK").alias("ok"), reason.alias("reason"), "train_rows", "test_rows")


# ------------------------------------------------------------------ fit
ROWS_PER_PARTITION = 10_000


@dataclass
class ForestBundle:
    ok: bool
    reason: str
    model: PipelineModel | None = None
    train_rows: int = 0
    test_rows: int = 0

    @property
    def forest(self):
        return self.model.stages[-1] if self.model is not None else None


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=FEATURE_COLUMNS, outputCol="features")


def _split_memory_mb(spark) -> int:
    """Memory for split statistics per pass: 1/8 of the executor heap
    (the driver's in local mode), between 128 and 1024 MB."""
    conf = spark.sparkContext.getConf()
    master = conf.get("spark.master", "")
    raw = conf.get("spark.driver.memory" if master.startswith("local") else "spark.executor.memory", "1g")
    units = {"k": 1 / 1024, "m": 1, "g": 1024, "t": 1024 * 1024}
    r = raw.strip().lower().rstrip("b")
    try:
        mb = float(r[:-1]) * units[r[-1]] if r[-1] in units else float(r) / (1024 * 1024)
    except ValueError:
        mb = 1024
    return int(min(1024, max(128, mb // 8)))


def fit_forest(cy: DataFrame, n_trees: int = 140, seed: int = 42, max_depth: int = 30,
               max_bins: int = 256, partitions: int | None = None) -> ForestBundle:
    """Train on the non-test years (checked by the gates first: one
    one-row action). Bagging is seeded per partition, so the rows are dealt
    to a number of ``partitions`` that the training rows alone decide (one for
    ``ROWS_PER_PARTITION``) by their key and sorted: one seed gives one model on
    any cluster, and small data does not pay for empty tasks at every level."""
    g = train_gates(cy).first()
    if not g["ok"]:
        return ForestBundle(False, g["reason"], None, g["train_rows"], g["test_rows"])
    # cached for the level-by-level passes
    key = ["year", "origin", "host"]
    train = feature_matrix(temporal_split(cy).filter(~F.col("is_test"))).repartition(
        int(partitions or -(-g["train_rows"] // ROWS_PER_PARTITION)), *key).sortWithinPartitions(*key).persist()
    rf = RandomForestRegressor(featuresCol="features", labelCol="target_log_flow", numTrees=int(n_trees),
                               minInstancesPerNode=2, featureSubsetStrategy="all", maxDepth=int(max_depth),
                               maxBins=int(max_bins), seed=int(seed), subsamplingRate=1.0, bootstrap=True,
                               # fewer, larger passes over the data for deep trees,
                               # within an eighth of the executor heap
                               maxMemoryInMB=_split_memory_mb(cy.sparkSession), cacheNodeIds=True)
    try:
        model = Pipeline(stages=[assembler(), rf]).fit(train)
    finally:
        train.unpersist()
    return ForestBundle(True, "OK", model, g["train_rows"], g["test_rows"])


_MODELS: dict = {}
_LOCK = threading.Lock()


def fit_forest_cached(key, cy: DataFrame, **kw) -> ForestBundle:
    """One fit per key (application, data, scope, parameters) per run."""
    with _LOCK:
        if key not in _MODELS:
            _MODELS[key] = fit_forest(cy, **kw)
        return _MODELS[key]


def save_forest(bundle: ForestBundle, path: str) -> None:
    """Persist the fitted pipeline (assembler + forest) with MLlib's writer."""
    if bundle.model is not None:
        bundle.model.write().overwrite().save(path)


def load_forest(path: str, train_rows: int = 0, test_rows: int = 0) -> ForestBundle:
    return ForestBundle(True, "OK", PipelineModel.load(path), train_rows, test_rows)


def _predict(bundle: ForestBundle, cy: DataFrame) -> DataFrame:
    """``cy`` with ``prediction``; without rows if the model was refused."""
    if bundle.model is None:
        return feature_matrix(cy).limit(0).withColumn("prediction", F.lit(None).cast("double"))
    return bundle.model.transform(feature_matrix(cy))


def model_metrics(bundle: ForestBundle, cy: DataFrame) -> DataFrame:
    """Test MAE of log flow and R^2 (1 - SSE / SST) on the test years."""
    test = temporal_split(cy).filter(F.col("is_test"))
    p = _predict(bundle, test)
    y = F.col("target_log_flow")
    e = y - F.col("prediction")
    a = p.agg(F.avg(F.abs(e)).alias("mae_log"), F.sum(e * e).alias("_sse"),
              (F.var_pop(y) * F.count(y)).alias("_sst"))
    return a.select(F.lit(bundle.train_rows).cast("long").alias("train_rows"),
                    F.lit(bundle.test_rows).cast("long").alias("test_rows"), "mae_log",
                    (F.lit(1.0) - F.try_divide("_sse", "_sst")).alias("r2"), F.lit(bundle.reason).alias("reason"))


def feature_importance(bundle: ForestBundle, spark) -> DataFrame:
    """Importances of all features, ranked, with percent of the largest; empty
    if the model was refused. The vector has one entry per feature (8 values)
    - driver-sized by design."""
    imp = bundle.forest.featureImportances.toArray().tolist() if bundle.model is not None else []
    df = spark.createDataFrame(list(zip(FEATURE_COLUMNS, [float(x) for x in imp])),
                               "feature string, importance double")
    mx = F.greatest(df.agg(F.max("importance")).scalar(), F.lit(1e-9))
    order = Window.orderBy(F.col("importance").desc(), F.col("feature"))  # 8 rows
    return (df.withColumn("rank", F.row_number().over(order))
            .withColumn("pct_of_max", F.lit(100.0) * F.col("importance") / mx))


def predict_corridors(bundle: ForestBundle, cy: DataFrame, year: int | None = None) -> DataFrame:
    """Score the corridors of ``year`` (of the latest year when ``year`` is
    None or has none): predicted = max(expm1(prediction), 0)."""
    asked = F.lit(year).cast("int")
    target = cy.agg(F.coalesce(F.max(F.when(F.col("year") == asked, F.col("year"))),
                               F.max("year")).alias("prediction_year"))
    base = cy.join(F.broadcast(target), cy["year"] == target["prediction_year"], "inner")
    p = _predict(bundle, base)
    return p.select(*cy.columns, "prediction_year",
                    F.greatest(F.expm1("prediction"), F.lit(0.0)).alias("predicted_value"),
                    F.greatest(F.col("value_observed"), F.lit(0.0)).alias("actual_value"))


def _dense_band_shares(df: DataFrame, value: str, keys: list[str]) -> DataFrame:
    """Per ``keys``: value and share of each of the three bands (0 when the
    total is 0), dense."""
    per = df.groupBy(*keys).agg(*[sum0(F.when(F.col("distance_band") == b, F.col(value))).alias(b)
                                  for b in DISTANCE_BANDS])
    total = sum([F.col(f"`{b}`") for b in DISTANCE_BANDS[1:]], F.col(f"`{DISTANCE_BANDS[0]}`"))
    long = per.withColumn("_total", total).unpivot([*keys, "_total"], DISTANCE_BANDS, "distance_band", "value")
    return long.select(*keys, "distance_band", "value", share_or_zero("value", "_total").alias("share"))


def distance_mix_actual_vs_predicted(pred: DataFrame) -> DataFrame:
    """Band mix of actual and of predicted values, stacked by series."""
    long = pred.select("distance_band", F.col("prediction_year").alias("year"),
                       F.explode(F.array(
                           F.struct(F.lit(ACTUAL).alias("series"), F.col("actual_value").alias("v")),
                           F.struct(F.lit(PREDICTED).alias("series"), F.col("predicted_value").alias("v")))
                       ).alias("e")).select("distance_band", "year", "e.series", "e.v")
    return _dense_band_shares(long, "v", ["series", "year"]).select(
        "distance_band", "value", "share", "series", "year")


def leaf_values(bundle: ForestBundle, spark) -> DataFrame:
    """(tree, leaf, value) of every leaf, from the model's own saved nodes: a
    tree's leaves are numbered from left to right, and nodes by preorder, so
    the n-th leaf node is leaf n."""
    path = f"{shared_dir(spark)}/flowatlas_out/forest-{uuid.uuid4().hex}"
    bundle.forest.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").filter("nodeData.leftChild < 0")
    order = Window.partitionBy("treeID").orderBy("nodeData.id")
    return nodes.select(F.col("treeID").alias("tree_id"), (F.row_number().over(order) - 1).alias("leaf"),
                        F.col("nodeData.prediction").alias("_log"))


def distance_uncertainty(bundle: ForestBundle, pred: DataFrame, n_trees: int | None = None) -> DataFrame:
    """Per-tree band shares of all (or the first ``n_trees``) trees -> p10/p50/p90
    per band; empty if the model was refused. One pass finds the leaf of every
    tree that a row falls into; rows are counted per (band, tree, leaf) before
    the leaves' values are joined, so what is joined grows with the model, not
    with the rows."""
    if bundle.model is None:
        return pred.select("distance_band", *[F.lit(None).cast("double").alias(p) for p in ("p10", "p50", "p90")]).limit(0)
    x = bundle.model.stages[0].transform(feature_matrix(
        pred.drop(*[c for c in pred.columns if c in ("features", "prediction")])))
    forest = bundle.forest
    forest = forest.copy({forest.leafCol: "_leaf", forest.predictionCol: "_all"})
    leaves = forest.transform(x).select("distance_band", F.posexplode(vector_to_array("_leaf")).alias("tree_id", "_at"))
    if n_trees is not None:
        leaves = leaves.filter(F.col("tree_id") < int(n_trees))
    n = leaves.groupBy("distance_band", "tree_id", F.col("_at").cast("int").alias("leaf")).agg(F.count(F.lit(1)).alias("_n"))
    per_tree = n.join(leaf_values(bundle, pred.sparkSession), ["tree_id", "leaf"])
    per_tree = per_tree.withColumn("_v", F.col("_n") * F.greatest(F.expm1("_log"), F.lit(0.0)))
    shares = _dense_band_shares(per_tree, "_v", ["tree_id"])
    q = shares.groupBy("distance_band").agg(
        F.percentile("share", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9))).alias("_q"))
    return q.select("distance_band", F.col("_q")[0].alias("p10"), F.col("_q")[1].alias("p50"),
                    F.col("_q")[2].alias("p90"))


def top_destinations(pred: DataFrame, n: int = 10) -> DataFrame:
    """Hosts by max(actual, predicted) total, top ``n``, in long form."""
    a = pred.groupBy("host").agg(F.sum("actual_value").alias("a"), F.sum("predicted_value").alias("p"))
    top = a.withColumn("score", F.greatest("a", "p")).orderBy(F.col("score").desc(), F.col("host")).limit(int(n))
    return top.select("host", F.explode(F.array(
        F.struct(F.lit(ACTUAL).alias("series"), F.col("a").alias("people")),
        F.struct(F.lit(PREDICTED).alias("series"), F.col("p").alias("people")))).alias("e")) \
        .select("host", "e.series", "e.people")


def corridor_similarity(cy: DataFrame, k: int | None = None) -> DataFrame:
    """All corridor-years (or only the ``k`` largest) on two
    principal components of the z-scored features. z uses the population
    standard deviation; each component's sign is fixed so that its largest
    loading is positive."""
    d = cy
    if k is not None:
        d = d.orderBy(F.col("value_observed").desc(), "year", "origin", "host").limit(int(k))
    fm = assembler().transform(feature_matrix(d))
    scaler = StandardScaler(inputCol="features", outputCol="_z0", withMean=True, withStd=True).fit(fm)
    # MLlib scales by the sample std; sqrt(n / (n - 1)) turns that into the
    # population std (n from a one-row scalar subquery, no driver count)
    n = fm.agg(F.count(F.lit(1)).cast("double")).scalar()
    z = (scaler.transform(fm)
         .withColumn("_c", F.when(n > 1, F.sqrt(n / (n - F.lit(1.0)))).otherwise(F.lit(1.0))))
    z = z.withColumn("_z", array_to_vector(F.transform(vector_to_array("_z0"), lambda v: v * F.col("_c"))))
    pca = PCA(k=2, inputCol="_z", outputCol="_pc").fit(z)
    pc = pca.pc.toArray()
    signs = [1.0 if pc[abs(pc[:, j]).argmax(), j] >= 0 else -1.0 for j in range(pc.shape[1])]
    out = pca.transform(z).withColumn("_pca", vector_to_array("_pc"))
    return out.select(
        "year", "origin", "host",
        F.concat(F.col("origin"), F.lit(" → "), F.col("host")).alias("route"),
        "distance_band",
        (F.col("_pca")[0] * F.lit(signs[0])).alias("component_1"),
        (F.col("_pca")[1] * F.lit(signs[1])).alias("component_2"),
        F.log1p("value_observed").alias("flow_size"))

