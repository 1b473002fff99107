"""Train-and-score job (M1-M8 composed), reading and writing lake folders.

Reads the written silver table, splits, fits, evaluates on the test part and
batch-scores every row into ``gold/delay_predictions``; the fitted pipeline is
saved with Spark ML's writer under ``models/late5_classifier``.  The split and the
scored rows are each written once below ``spark.checkpoint.dir`` and everything
else reads them there (a local session without that setting: ``work`` in the lake).  Only scalar metrics come back to the driver.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import model as M
from ..session import scratch_path
from ..sources import sinks


def lake_path(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def train_and_score(spark: SparkSession, lake_root: str, max_iter: int = M.params.MAX_ITER) -> dict:
    """Fit on the training part, write predictions and the model; return the metrics."""
    from .pipeline import read_silver
    silver = read_silver(spark, lake_root)
    feats = M.ml_features(silver)
    work = scratch_path(spark, "training", lake_path(lake_root, "work"))
    split = _written(M.train_test_split(feats), f"{work}/split")
    model = M.fit_model(split.where(~F.col("is_test")), max_iter=max_iter)
    model.write().overwrite().save(lake_path(lake_root, "models", "late5_classifier"))

    scored = M.score(M.weights(model), split)
    scored = _written(scored, f"{work}/scored")
    test = scored.where(F.col("is_test"))
    metrics = M.classifier_metrics(scored).first().asDict()
    metrics["auc"] = M.roc_auc(test).first()["auc"]
    balance = M.class_balance(scored).first()
    metrics.update(rows=balance["rows"], positives=balance["positives"], rate=balance["rate"])
    cm = {(r["actual"], r["predicted"]): r["n"] for r in M.confusion_matrix(test).collect()}   # 4 rows
    metrics["confusion_matrix"] = [[cm[(0, 0)], cm[(0, 1)]], [cm[(1, 0)], cm[(1, 1)]]]
    sinks.replace_table(M.predictions(scored), path=lake_path(lake_root, "gold", "delay_predictions"))
    sinks.delete(spark, work)
    return metrics


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def load_model(lake_root: str) -> PipelineModel:
    return PipelineModel.load(lake_path(lake_root, "models", "late5_classifier"))


def predict_scenarios(spark: SparkSession, lake_root: str, scenarios: DataFrame) -> DataFrame:
    """M9 with the saved model.  ``scenarios``: line_code, day_of_week, sched_hour, route_type, rain."""
    feats = M.scenario_inputs(scenarios)
    return M.scenario_scores(load_model(lake_root), feats)
