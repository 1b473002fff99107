"""Late-arrival classifier with ``pyspark.ml``.

Nothing is pulled to the driver except a handful of scalars (class counts,
split thresholds, bucket boundaries); features, fitting (distributed L-BFGS),
scoring and evaluation all run as Spark jobs.

* Split (M2): a deterministic hash of the event key, thresholded per class at
  the 25 % quantile of the hash, gives a reproducible stratified split whose
  test share is exact (within one row) at any size: counts over the hash's top
  16 bits name the bucket that holds the rank, and only that bucket is ranked.
* Model (M3/M4): one-hot line and weekday (unknown category -> all zeros) plus
  five raw numerics; logistic regression with balanced class weights and the
  L2 strength of a unit-C penalised likelihood (``regParam = 1 / n_train``).
* ROC AUC (M8): exact, tie-aware rank statistic computed from per-score class
  counts by a distributed prefix sum over ranges of the score, so no window ever holds
  all scores in one task.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..functions.columns import is_suburban

CAT_FEATURES = ("line_code", "day_of_week")
NUM_FEATURES = ("sched_hour", "route_type", "precip_mm", "is_suburban_i", "is_raining_i")
LABEL = "is_late_5min"
KEY_COLUMNS = ("trip_id", "service_date", "stop_id")


def _flag(c: str) -> F.Column:
    return F.when(F.col(c), 1).otherwise(0)


def ml_features(silver: DataFrame) -> DataFrame:
    """Model input rows (lines known); missing numerics -1/0, booleans 0/1, text 'NA'."""
    out = silver.where(F.col("line_code").isNotNull()).select(
        "trip_id", "stop_id", "service_date", "line_code", "day_of_week",
        F.coalesce("sched_hour", F.lit(-1)).alias("sched_hour"),
        F.coalesce("route_type", F.lit(-1)).alias("route_type"),
        F.coalesce("precip_mm", F.lit(0.0)).alias("precip_mm"),
        _flag("is_suburban").alias("is_suburban_i"),
        _flag("is_raining").alias("is_raining_i"),
        F.coalesce("delay_minutes", F.lit(0.0)).alias("delay_minutes"),
        _flag("is_late_5min").alias(LABEL),
    )
    return out.na.fill("NA", list(CAT_FEATURES))


def class_balance(features: DataFrame, label: str = LABEL) -> DataFrame:
    """M1: rows, positives and positive rate."""
    return features.agg(F.count(F.lit(1)).alias("rows"),
                        F.sum(label).cast(T.LongType()).alias("positives")).withColumn(
        "rate", F.col("positives").cast(T.DoubleType()) / F.col("rows"))


def split_hash(keys=KEY_COLUMNS, seed: int = params.SPLIT_SEED) -> F.Column:
    """48-bit hash of the event key (md5 based, identical in any SQL engine)."""
    parts = [F.lit(str(seed))] + [F.coalesce(F.col(k).cast(T.StringType()), F.lit("")) for k in keys]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 12), 16, 10).cast(T.LongType())


def train_test_split(features: DataFrame, test_fraction: float = params.TEST_FRACTION,
                     seed: int = params.SPLIT_SEED, label: str = LABEL, keys=KEY_COLUMNS,
                     min_positives: int = params.MIN_POSITIVES_TO_STRATIFY) -> DataFrame:
    """M2: adds ``is_test``; stratified on the label when there are >= ``min_positives`` positives.

    A row is in the test part when its key hash is at or below its class's
    ``test_fraction`` quantile of the hash (one quantile over all rows when not
    stratified).  Deterministic for a given seed and independent of partitioning.
    """
    hashed = features.withColumn("_h", split_hash(keys, seed)).withColumn("_top", F.shiftright("_h", 32))
    # one pass counts the hash's top bits in each class (2^16 a class at most); the same counts tell whether to stratify
    counts = hashed.groupBy(F.col(label).alias("_class"), "_top").agg(F.count(F.lit(1)).alias("_n"))
    positives = F.coalesce(F.sum(F.col("_class") * F.col("_n")).over(Window.partitionBy(F.lit(0))), F.lit(0))
    counts = counts.withColumn("_apart", positives >= min_positives)
    counts = counts.groupBy(F.when(F.col("_apart"), F.col("_class")).otherwise(0).alias("_g"), "_apart", "_top").agg(F.sum("_n").alias("_n"))
    of_class = Window.partitionBy("_g")
    rank = F.greatest(F.ceil(F.lit(test_fraction) * F.sum("_n").over(of_class)), F.lit(1))
    counts = counts.withColumn("_upto", F.sum("_n").over(of_class.orderBy("_top"))).withColumn("_rank", rank)
    bucket = counts.where((F.col("_upto") >= F.col("_rank")) & (F.col("_upto") - F.col("_n") < F.col("_rank")))
    # at most two thresholds: one bucket's rows of a class are ranked
    classes = F.explode(F.when(F.col("_apart"), F.array("_g")).otherwise(F.array(F.lit(0), F.lit(1)))).alias(label)
    bucket = bucket.select(classes, "_g", "_apart", "_top", (F.col("_rank") - F.col("_upto") + F.col("_n")).alias("_place"))
    ranked = (hashed.select(label, "_top", "_h").join(F.broadcast(bucket), [label, "_top"])
              .withColumn("_row", F.row_number().over(of_class.orderBy("_h"))))
    limits = ranked.where(F.col("_row") == F.col("_place")).select(classes, F.col("_h").alias("_t"))
    split = hashed.join(F.broadcast(limits), label).withColumn("is_test", F.col("_h") <= F.col("_t"))
    return split.select(*features.columns, "is_test")


def encoder_stages(cat=CAT_FEATURES, num=NUM_FEATURES) -> list:
    """M3: StringIndexer(keep) + OneHotEncoder(dropLast) + VectorAssembler.

    With ``handleInvalid='keep'`` an unseen category gets the extra last index,
    which ``dropLast`` removes: it encodes as all zeros.
    """
    idx = [f"{c}_idx" for c in cat]
    ohe = [f"{c}_ohe" for c in cat]
    return [StringIndexer(inputCols=list(cat), outputCols=idx, handleInvalid="keep",
                          stringOrderType="alphabetAsc"),
            OneHotEncoder(inputCols=idx, outputCols=ohe, dropLast=True),
            VectorAssembler(inputCols=ohe + list(num), outputCol="features")]


def balanced_weights(train: DataFrame, label: str = LABEL, rows: str | None = None) -> tuple[DataFrame, int]:
    """Adds ``weight = n / (k * n_class)`` (balanced class weights); returns (frame, n).

    ``rows``: a column that tells how many rows of the original a row stands for.
    """
    of = F.col(rows) if rows else F.lit(1)
    found = train.groupBy(label).agg(F.sum(of).alias("n")).collect()      # at most two rows
    counts = {int(r[label]): int(r["n"]) for r in found}
    n = sum(counts.values())
    k = max(len(counts), 1)
    w = F.create_map(*[x for c, m in counts.items() for x in (F.lit(c), F.lit(n / (k * m)))])
    return train.withColumn("weight", w[F.col(label)] * of), n


def compacted(train: DataFrame, label: str = LABEL) -> DataFrame:
    """One row for each distinct (features, label) with its number of rows: the same likelihood, far fewer terms.

    Features are a line, a weekday, an hour, a route type, rain by the tenth of a millimetre and two flags, so the
    distinct rows are bounded by the network's size, not by how many days it has run.
    """
    return train.groupBy(*CAT_FEATURES, *NUM_FEATURES, label).agg(F.count(F.lit(1)).alias("rows"))


def fit_model(train: DataFrame, label: str = LABEL, max_iter: int = params.MAX_ITER) -> PipelineModel:
    """M4: fit the encode + logistic-regression pipeline on the training part.

    The training rows are read once and compacted; every L-BFGS pass reads the distinct rows,
    which are kept in memory (and recomputed if an executor is lost).
    """
    distinct = compacted(train, label).persist()
    try:
        weighted, n_train = balanced_weights(distinct, label, "rows")
        lr = LogisticRegression(featuresCol="features", labelCol=label, weightCol="weight",
                                family="binomial", standardization=False, elasticNetParam=0.0,
                                regParam=1.0 / max(n_train, 1), maxIter=max_iter, tol=1e-6)
        return Pipeline(stages=encoder_stages() + [lr]).fit(weighted)
    finally:
        distinct.unpersist()


class Weights(NamedTuple):
    """A linear classifier by name: a category that is not listed weighs nothing."""

    intercept: float
    categories: dict[str, dict[str, float]]
    numbers: dict[str, float]


def weights(model: PipelineModel) -> Weights:
    """The fitted coefficients by feature and category (as many numbers as the model has)."""
    indexer, lr = model.stages[0], model.stages[-1]
    beta = iter(lr.coefficients.toArray().tolist())
    categories = {c: {x: next(beta) for x in labels}
                  for c, labels in zip(CAT_FEATURES, indexer.labelsArray, strict=True)}
    return Weights(float(lr.intercept), categories, {c: next(beta) for c in NUM_FEATURES})


def _linear(w: Weights) -> F.Column:
    z = F.lit(w.intercept)
    for c, known in w.categories.items():
        if known:
            by_name = F.create_map(*[F.lit(x) for pair in known.items() for x in pair])
            z = z + F.coalesce(by_name[F.col(c)], F.lit(0.0))
    for c, x in w.numbers.items():
        z = z + F.lit(x) * F.col(c).cast(T.DoubleType())
    return z


def score(model: PipelineModel | Weights, features: DataFrame,
          threshold: float = params.PREDICT_THRESHOLD) -> DataFrame:
    """M5: probability of being late and the 0/1 prediction for every row.

    ``model`` is a fitted pipeline or its :func:`weights`, which score without leaving
    generated code and without the feature vector's columns.
    """
    if isinstance(model, Weights):
        scored = features.withColumn("prob_late", F.lit(1.0) / (F.lit(1.0) + F.exp(-_linear(model))))
    else:
        scored = model.transform(features).withColumn("prob_late", vector_to_array("probability").getItem(1))
    return scored.withColumn("pred_late", (F.col("prob_late") >= threshold).cast(T.IntegerType()))


def fit_gradient(model: PipelineModel, train: DataFrame, label: str = LABEL) -> DataFrame:
    """M4's check: the penalised, balanced likelihood's gradient at the fitted coefficients.

    One row a position of the feature vector (-1: the intercept): the gradient as a share
    of what residuals of one in every row would give.  Equal rows are taken together, as in :func:`fit_model`.
    """
    weighted, _ = balanced_weights(compacted(train, label), label, "rows")
    lr = model.stages[-1]
    residual = (F.col("weight") * (F.col("prob_late") - F.col(label))).alias("residual")
    x = F.concat(vector_to_array("features"), F.array(F.lit(1.0)))
    rows = score(model, weighted).select("weight", residual, F.posexplode(x).alias("position", "x"))
    beta = F.array(*[F.lit(float(b)) for b in [*lr.coefficients.toArray(), 0.0]])     # the intercept is not penalised
    sums = rows.groupBy("position").agg(F.sum(F.col("residual") * F.col("x")).alias("g"),
                                        F.sum(F.col("weight") * F.abs("x")).alias("scale"))
    last = lr.numFeatures
    return sums.select(F.when(F.col("position") == last, -1).otherwise(F.col("position")).alias("position"),
                       ((F.col("g") + beta[F.col("position")]) / (F.col("scale") + 1)).alias("gradient"))


def predictions(scored: DataFrame) -> DataFrame:
    """The 9 columns of the prediction table."""
    return scored.select(
        "trip_id", "stop_id", "service_date", "line_code", "sched_hour", "delay_minutes",
        F.col(LABEL).cast(T.IntegerType()).alias(LABEL), "prob_late", "pred_late")


def delay_predictions(model: PipelineModel | Weights, features: DataFrame) -> DataFrame:
    """M5: the prediction table (all rows, training rows included)."""
    return predictions(score(model, features))


def classifier_metrics(split_scored: DataFrame, label: str = LABEL, pred: str = "pred_late") -> DataFrame:
    """M6: precision, recall, F1 (0/0 -> 0) on the test part; n_train, n_test, n_pos overall."""
    y, p, t = F.col(label) == 1, F.col(pred) == 1, F.col("is_test")

    def cnt(c):
        return F.sum(F.when(c, 1).otherwise(0)).cast(T.LongType())
    m = split_scored.agg(cnt(t & y & p).alias("tp"), cnt(t & ~y & p).alias("fp"),
                         cnt(t & y & ~p).alias("fn"), cnt(~t).alias("n_train"), cnt(t).alias("n_test"),
                         cnt(y).alias("n_pos"))

    def ratio(a, b):
        return F.when(b > 0, a.cast(T.DoubleType()) / b).otherwise(F.lit(0.0))
    prec = ratio(F.col("tp"), F.col("tp") + F.col("fp"))
    rec = ratio(F.col("tp"), F.col("tp") + F.col("fn"))
    return m.select(prec.alias("precision"), rec.alias("recall"),
                    ratio(F.col("tp") * 2, F.col("tp") * 2 + F.col("fp") + F.col("fn")).alias("f1"),
                    "n_train", "n_test", "n_pos")


def confusion_matrix(test_scored: DataFrame, label: str = LABEL, pred: str = "pred_late") -> DataFrame:
    """M7: [[tn, fp], [fn, tp]] as four (actual, predicted, n) rows, zeros included."""
    cells = [(a, b) for a in (0, 1) for b in (0, 1)]
    agg = test_scored.agg(*[F.sum(F.when((F.col(label) == a) & (F.col(pred) == b), 1).otherwise(0))
                            .cast(T.LongType()).alias(f"c{a}{b}") for a, b in cells])
    grid = F.array(*[F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"),
                              F.coalesce(F.col(f"c{a}{b}"), F.lit(0)).alias("n")) for a, b in cells])
    return agg.select(F.inline(grid))


def roc_auc(test_scored: DataFrame, score_col: str = "prob_late", label: str = LABEL,
            buckets: int | None = None) -> DataFrame:
    """M8: exact ROC AUC (ties count one half); NaN when the test part has one class.

    AUC = sum_s pos_s * (2 * neg_below_s + neg_s) / (2 * P * N), all counts exact
    integers, so the single final division is the only rounding.  ``neg_below`` is a distributed
    prefix sum: the per-score counts are dealt to ``buckets`` ranges of the score (Spark's choice if
    not given), running sums are taken inside each range, and a range's sum lacks only
    2 * pos * (negatives of the ranges before), which its totals give.
    """
    per_score = test_scored.groupBy(F.col(score_col).alias("score")).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast(T.LongType()).alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast(T.LongType()).alias("neg"))
    ranged = per_score.repartitionByRange(*([buckets] if buckets else []), "score").withColumn("range", F.spark_partition_id())
    within = Window.partitionBy("range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    wide, long = T.DecimalType(38, 0), T.DecimalType(18, 0)  # pairs of rows outgrow 64 bits
    before = F.coalesce(F.sum("neg").over(within), F.lit(0))
    ranged = ranged.withColumn("pairs", F.col("pos").cast(long) * (before * 2 + F.col("neg")).cast(T.DecimalType(19, 0)))
    ranges = ranged.groupBy("range").agg(F.sum(F.col("pairs").cast(wide)).cast(wide).alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    # a row a range from here on
    earlier = F.coalesce(F.sum("neg").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.withColumn("lacking", F.col("pos").cast(long) * (earlier * 2).cast(T.DecimalType(19, 0)))
    total = ranges.agg(F.sum((F.col("pairs") + F.col("lacking")).cast(wide)).cast(wide).alias("num"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.when((F.col("P") > 0) & (F.col("N") > 0),
                 F.col("num").cast(T.DoubleType()) / (F.col("P").cast(T.DoubleType()) * F.col("N") * 2)
                 ).otherwise(F.lit(float("nan")))
    return total.select(auc.alias("auc"))


def scenario_features(silver: DataFrame, wet_mm: float = params.SCENARIO_WET_MM,
                      dry_mm: float = params.SCENARIO_DRY_MM, rain_mm: float = params.RAIN_MM) -> DataFrame:
    """M9 input: every observed (line, weekday, hour, route type), once raining and once dry."""
    base = ml_features(silver).select("line_code", "day_of_week", "sched_hour", "route_type").distinct()
    s = base.withColumn("rain", F.explode(F.array(F.lit(True), F.lit(False))))
    return scenario_inputs(s, wet_mm, dry_mm, rain_mm)


def scenario_inputs(s: DataFrame, wet_mm: float = params.SCENARIO_WET_MM,
                    dry_mm: float = params.SCENARIO_DRY_MM, rain_mm: float = params.RAIN_MM) -> DataFrame:
    """Model inputs for scenario rows (line_code, day_of_week, sched_hour, route_type, rain)."""
    precip = F.when(F.col("rain"), F.lit(wet_mm)).otherwise(F.lit(dry_mm))
    return s.select(
        "line_code", "day_of_week", "sched_hour", "route_type", "rain",
        precip.alias("precip_mm"),
        F.coalesce(is_suburban("line_code").cast(T.IntegerType()), F.lit(0)).alias("is_suburban_i"),
        (precip >= rain_mm).cast(T.IntegerType()).alias("is_raining_i"))


def scenario_scores(model: PipelineModel | Weights, scenarios: DataFrame,
                    threshold: float = params.PREDICT_THRESHOLD) -> DataFrame:
    """M9: probability and verdict for each scenario row."""
    s = score(model, scenarios, threshold)
    verdict = F.when(F.col("prob_late") >= threshold, F.lit(params.LIKELY_LATE)).otherwise(
        F.lit(params.PROBABLY_ON_TIME))
    return s.select("line_code", "day_of_week", "sched_hour", "route_type", "rain", "prob_late",
                    verdict.alias("verdict"))
