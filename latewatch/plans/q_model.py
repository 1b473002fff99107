"""Model queries (P14, M1-M9) over the fixture silver table.

``delay_predictions`` and ``scenario_scores`` score with the documented weights below,
so that SQL gives the same probabilities; ``fit_optimum`` fits the model and tells for
each position of its feature vector whether the likelihood's gradient is near zero there.
The evaluation operators are checked on the deterministic score ``sched_hour / 24``.
``ml_encode`` returns the encoded vectors as one row per (event, position).
"""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import params
from ..operators import model as M
from ..session import scratch_path
from .catalog_base import fixture_silver
from . import sql as Q
from .registry import register

FEATURES_SQL = """
SELECT trip_id, stop_id, service_date, coalesce(line_code, 'NA') AS line_code,
  coalesce(day_of_week, 'NA') AS day_of_week, coalesce(sched_hour, -1) AS sched_hour,
  coalesce(route_type, -1) AS route_type, coalesce(precip_mm, CAST(0 AS DOUBLE)) AS precip_mm,
  CASE WHEN is_suburban THEN 1 ELSE 0 END AS is_suburban_i,
  CASE WHEN is_raining THEN 1 ELSE 0 END AS is_raining_i,
  coalesce(delay_minutes, CAST(0 AS DOUBLE)) AS delay_minutes,
  CASE WHEN is_late_5min THEN 1 ELSE 0 END AS is_late_5min
FROM silver WHERE line_code IS NOT NULL"""

_H = (f"CAST('0x' || substr(md5(concat_ws('|', '{params.SPLIT_SEED}', coalesce(CAST(trip_id AS VARCHAR), ''), "
      "coalesce(CAST(service_date AS VARCHAR), ''), coalesce(CAST(stop_id AS VARCHAR), ''))), 1, 12) AS BIGINT)")

SPLIT_SQL = f"""
SELECT h.*, h._h <= th.t AS is_test
FROM (SELECT *, {_H} AS _h,
        CASE WHEN (SELECT sum(is_late_5min) FROM features) >= {params.MIN_POSITIVES_TO_STRATIFY}
             THEN is_late_5min ELSE 0 END AS _g
      FROM features) h
JOIN (SELECT _g, quantile_disc(_h, {params.TEST_FRACTION}) AS t FROM (
        SELECT {_H} AS _h,
          CASE WHEN (SELECT sum(is_late_5min) FROM features) >= {params.MIN_POSITIVES_TO_STRATIFY}
               THEN is_late_5min ELSE 0 END AS _g
        FROM features) x GROUP BY _g) th ON th._g = h._g"""

SCORED_SQL = f"""
SELECT *, CAST(sched_hour AS DOUBLE) / 24.0 AS prob_late,
  CASE WHEN CAST(sched_hour AS DOUBLE) / 24.0 >= {params.PREDICT_THRESHOLD} THEN 1 ELSE 0 END AS pred_late
FROM split"""


def _over(body: str, *names: str) -> str:
    ctes = [("features", FEATURES_SQL), ("split", SPLIT_SQL), ("scored", SCORED_SQL)]
    wanted = {"features": 1, "split": 2, "scored": 3}[names[-1]] if names else 1
    return Q.over_silver(body, *ctes[:wanted])


def features(spark: SparkSession, d: str) -> DataFrame:
    return M.ml_features(fixture_silver(spark, d))


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split(spark: SparkSession, d: str) -> DataFrame:
    """The split reads its rows three times, so silver is built once, before."""
    return M.train_test_split(_written(features(spark, d), "features"))


def deterministic_scores(spark: SparkSession, d: str) -> DataFrame:
    """The split with score ``sched_hour / 24`` and its 0.5-threshold prediction."""
    s = split(spark, d).withColumn("prob_late", F.col("sched_hour").cast(T.DoubleType()) / 24.0)
    return s.withColumn("pred_late", (F.col("prob_late") >= params.PREDICT_THRESHOLD).cast(T.IntegerType()))


register("ml_features", _over("SELECT * FROM features", "features"))(features)

register("class_balance", _over("""
SELECT count(*) AS rows, CAST(sum(is_late_5min) AS BIGINT) AS positives,
  CAST(sum(is_late_5min) AS DOUBLE) / count(*) AS rate FROM features""", "features"))(
    lambda spark, d: M.class_balance(features(spark, d)))

register("train_test_split", _over("""
SELECT trip_id, stop_id, service_date, is_late_5min, is_test FROM split""", "split"))(
    lambda spark, d: split(spark, d).select("trip_id", "stop_id", "service_date", "is_late_5min", "is_test"))


def _cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


register("classifier_metrics", _over(f"""
SELECT CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
  CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
  n_train, n_test, n_pos
FROM (SELECT {_cnt('is_test AND is_late_5min = 1 AND pred_late = 1')} AS tp,
             {_cnt('is_test AND is_late_5min = 0 AND pred_late = 1')} AS fp,
             {_cnt('is_test AND is_late_5min = 1 AND pred_late = 0')} AS fn,
             {_cnt('NOT is_test')} AS n_train, {_cnt('is_test')} AS n_test,
             {_cnt('is_late_5min = 1')} AS n_pos
      FROM scored) m""", "scored"))(
    lambda spark, d: M.classifier_metrics(deterministic_scores(spark, d)))

register("confusion_matrix", _over(" UNION ALL ".join(
    f"SELECT {a} AS actual, {b} AS predicted, "
    f"{_cnt(f'is_late_5min = {a} AND pred_late = {b}')} AS n FROM scored WHERE is_test"
    for a in (0, 1) for b in (0, 1)), "scored"))(
    lambda spark, d: M.confusion_matrix(deterministic_scores(spark, d).where(F.col("is_test"))))

register("roc_auc", _over("""
SELECT CASE WHEN sum(pos) > 0 AND sum(neg) > 0
            THEN CAST(sum(pos * (2 * nb + neg)) AS DOUBLE) / (CAST(sum(pos) AS DOUBLE) * sum(neg) * 2)
            ELSE CAST('NaN' AS DOUBLE) END AS auc
FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS nb
      FROM (SELECT prob_late AS score, sum(CASE WHEN is_late_5min = 1 THEN 1 ELSE 0 END) AS pos,
                   sum(CASE WHEN is_late_5min = 1 THEN 0 ELSE 1 END) AS neg
            FROM scored WHERE is_test GROUP BY prob_late) ps) c""", "scored"))(
    lambda spark, d: M.roc_auc(deterministic_scores(spark, d).where(F.col("is_test"))))

_SCEN = (f"SELECT line_code, day_of_week, sched_hour, route_type, {{rain}} AS rain, "
         f"CAST({{mm}} AS DOUBLE) AS precip_mm, "
         f"CASE WHEN regexp_matches(line_code, '{params.SUBURBAN_LINE_PATTERN}') THEN 1 ELSE 0 END AS is_suburban_i, "
         f"CASE WHEN CAST({{mm}} AS DOUBLE) >= {params.RAIN_MM} THEN 1 ELSE 0 END AS is_raining_i "
         f"FROM (SELECT DISTINCT line_code, day_of_week, sched_hour, route_type FROM features) b")
register("scenario_features", _over(
    _SCEN.format(rain="true", mm=params.SCENARIO_WET_MM) + " UNION ALL " +
    _SCEN.format(rain="false", mm=params.SCENARIO_DRY_MM), "features"))(
    lambda spark, d: M.scenario_features(fixture_silver(spark, d)))


_NUMERIC = "".join(f"""
UNION ALL SELECT trip_id, stop_id, service_date,
  CAST((SELECT count(*) FROM lines) + (SELECT count(*) FROM days) + {i} AS INTEGER), CAST({c} AS DOUBLE) FROM features"""
                   for i, c in enumerate(M.NUM_FEATURES))
ENCODE_SQL = f"""
SELECT trip_id, stop_id, service_date, CAST(l.at AS INTEGER) AS position,
  CASE WHEN f.line_code = l.name THEN CAST(1 AS DOUBLE) ELSE 0 END AS value FROM features f, lines l
UNION ALL SELECT trip_id, stop_id, service_date, CAST((SELECT count(*) FROM lines) + w.at AS INTEGER),
  CASE WHEN f.day_of_week = w.name THEN CAST(1 AS DOUBLE) ELSE 0 END FROM features f, days w{_NUMERIC}"""


def _categories(c: str) -> str:
    return f"SELECT {c} AS name, row_number() OVER (ORDER BY {c}) - 1 AS at FROM features GROUP BY {c}"


@register("ml_encode", Q.over_silver(ENCODE_SQL, ("features", FEATURES_SQL), ("lines", _categories("line_code")),
                                     ("days", _categories("day_of_week"))))
def ml_encode(spark: SparkSession, d: str) -> DataFrame:
    f = features(spark, d)
    enc = Pipeline(stages=M.encoder_stages()).fit(f)
    return enc.transform(f).select("trip_id", "stop_id", "service_date",
                                   F.posexplode(vector_to_array("features")).alias("position", "value"))


# scoring with documented weights -----------------------------------------------------------
#: Lines and days that are not listed weigh nothing, as categories unseen in training do.
WEIGHTS = M.Weights(
    intercept=-1.5,
    categories={"line_code": {"T1": 0.5, "T2": -0.25, "T4": 1.0, "T8": -0.75, "C11": 0.25},
                "day_of_week": {"Mon": 0.25, "Tue": 0.125, "Fri": 0.5, "Sat": -0.5, "Sun": -1.0}},
    numbers={"sched_hour": 0.0625, "route_type": 0.125, "precip_mm": 0.375, "is_suburban_i": 0.25, "is_raining_i": 0.5})
PROB_DIGITS = 9          # engines may differ in the last bit of exp()


def _linear_sql(w: M.Weights) -> str:
    cases = [f"CASE {c} {' '.join(f'WHEN {x!r} THEN {b}' for x, b in known.items())} ELSE 0 END"
             for c, known in w.categories.items()]
    return " + ".join([str(w.intercept), *cases, *[f"{b} * {c}" for c, b in w.numbers.items()]])


_PROB = f"1 / (1 + exp(-CAST({_linear_sql(WEIGHTS)} AS DOUBLE)))"


def _rounded(df: DataFrame) -> DataFrame:
    return df.withColumn("prob_late", F.round("prob_late", PROB_DIGITS))


@register("delay_predictions", _over(f"""
SELECT trip_id, stop_id, service_date, line_code, sched_hour, delay_minutes, is_late_5min,
  round(p, {PROB_DIGITS}) AS prob_late, CASE WHEN p >= {params.PREDICT_THRESHOLD} THEN 1 ELSE 0 END AS pred_late
FROM (SELECT *, {_PROB} AS p FROM features) f""", "features"))
def delay_predictions(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.delay_predictions(WEIGHTS, features(spark, d)))


_RAIN_OR_NOT = [_SCEN.format(rain="true", mm=params.SCENARIO_WET_MM), _SCEN.format(rain="false", mm=params.SCENARIO_DRY_MM)]


@register("scenario_scores", _over(f"""
SELECT line_code, day_of_week, sched_hour, route_type, rain, round(p, {PROB_DIGITS}) AS prob_late,
  CASE WHEN p >= {params.PREDICT_THRESHOLD} THEN '{params.LIKELY_LATE}' ELSE '{params.PROBABLY_ON_TIME}' END AS verdict
FROM (SELECT *, {_PROB} AS p FROM ({' UNION ALL '.join(_RAIN_OR_NOT)}) s) t""", "features"))
def scenario_scores(spark: SparkSession, d: str) -> DataFrame:
    return _rounded(M.scenario_scores(WEIGHTS, M.scenario_features(fixture_silver(spark, d))))


# the fit -----------------------------------------------------------------------------------
GRADIENT_LIMIT = 1e-3


@register("fit_optimum", _over(f"""
SELECT CAST(position AS INTEGER) AS position, true AS at_optimum
FROM (SELECT unnest(range(-1, count(DISTINCT line_code) + count(DISTINCT day_of_week) + {len(M.NUM_FEATURES)})) AS position
      FROM split WHERE NOT is_test) p""", "split"))
def fit_optimum(spark: SparkSession, d: str) -> DataFrame:
    train = _written(split(spark, d).where(~F.col("is_test")), "train")
    gradient = M.fit_gradient(M.fit_model(train), train)
    return gradient.select("position", (F.abs("gradient") < GRADIENT_LIMIT).alias("at_optimum"))
