"""Model operators: split proportions and determinism, encoding, metrics edge cases."""

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from latewatch.operators import model as M
from latewatch.plans.catalog_base import fixture_silver
from conftest import SF_CHECK, SF_SMALL


def test_split_is_stratified_and_deterministic(spark):
    f = M.ml_features(fixture_silver(spark, SF_CHECK))
    s1 = M.train_test_split(f)
    counts = {(r.is_late_5min, r.is_test): r["count"] for r in s1.groupBy("is_late_5min", "is_test").count().collect()}
    for label in (0, 1):
        n = counts.get((label, True), 0) + counts.get((label, False), 0)
        assert abs(counts.get((label, True), 0) - 0.25 * n) <= 1
    s2 = M.train_test_split(f.repartition(3))
    a = s1.where("is_test").select("trip_id", "stop_id", "service_date")
    b = s2.where("is_test").select("trip_id", "stop_id", "service_date")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_unknown_category_encodes_as_zeros(spark):
    train = spark.createDataFrame([("T1", "Mon", 8, 2, 0.0, 1, 0), ("T4", "Tue", 9, 2, 0.0, 1, 0)],
                                  "line_code string, day_of_week string, sched_hour int, route_type int, "
                                  "precip_mm double, is_suburban_i int, is_raining_i int")
    enc = Pipeline(stages=M.encoder_stages()).fit(train)
    test = spark.createDataFrame([("XX", "Mon", 8, 2, 0.0, 1, 0)], train.schema)
    v = enc.transform(test).select(vector_to_array("features").alias("v")).first().v
    assert v[:2] == [0.0, 0.0] and v[2:4] == [1.0, 0.0] and v[4:] == [8.0, 2.0, 0.0, 1.0, 0.0]


def test_metrics_edge_cases(spark):
    df = spark.createDataFrame([(0, 0, True), (0, 0, True), (1, 0, False)],
                               "is_late_5min int, pred_late int, is_test boolean")
    m = M.classifier_metrics(df).first()
    assert (m.precision, m.recall, m.f1, m.n_train, m.n_test, m.n_pos) == (0.0, 0.0, 0.0, 1, 2, 1)
    one_class = df.where("is_test").withColumn("prob_late", F.lit(0.3))
    assert str(M.roc_auc(one_class).first().auc) == "nan"
    cm = {(r.actual, r.predicted): r.n for r in M.confusion_matrix(df.where("is_test")).collect()}
    assert cm == {(0, 0): 2, (0, 1): 0, (1, 0): 0, (1, 1): 0}


def test_auc_matches_pairwise_definition(spark):
    rows = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.5), (0, 0.5), (0, 0.2)]
    df = spark.createDataFrame(rows, "is_late_5min int, prob_late double")
    pos = [s for y, s in rows if y == 1]
    neg = [s for y, s in rows if y == 0]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    assert abs(M.roc_auc(df).first().auc - want) < 1e-15
    assert abs(M.roc_auc(df, buckets=4).first().auc - want) < 1e-15


def test_fit_and_score(spark):
    f = M.ml_features(fixture_silver(spark, SF_CHECK))
    s = M.train_test_split(f)
    model = M.fit_model(s.where(~F.col("is_test")), max_iter=200)
    p = M.delay_predictions(model, s)
    assert p.count() == f.count() and len(p.columns) == 9
    auc = M.roc_auc(M.score(model, s.where("is_test"))).first().auc
    assert 0.0 <= auc <= 1.0          # fixture lateness carries no signal


def test_auc_of_many_scores(spark):
    """More distinct scores than runs, most of them in a sliver of the range."""
    rng = np.random.default_rng(3)
    y, score = rng.integers(0, 2, 6000), rng.random(6000) ** 12
    score[::7] = score[0]
    df = spark.createDataFrame(list(zip(y.tolist(), score.tolist())), "is_late_5min int, prob_late double")
    pos, neg = score[y == 1], score[y == 0]
    want = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))
    for buckets in (2, 32):
        assert abs(M.roc_auc(df, buckets=buckets).first().auc - want) < 1e-12


def test_weights_score_like_the_pipeline(spark):
    s = M.train_test_split(M.ml_features(fixture_silver(spark, SF_CHECK)))
    model = M.fit_model(s.where(~F.col("is_test")), max_iter=50)
    s = s.withColumn("line_code", F.when(F.col("is_test"), F.col("line_code")).otherwise("unseen"))
    both = M.score(M.weights(model), M.score(model, s).withColumnRenamed("prob_late", "p"))
    assert both.where(F.abs(F.col("p") - F.col("prob_late")) < 1e-12).count() == s.count()


def test_model_learns_a_signal(spark):
    rows = [(f"trip{i}", "s1", "T1" if i % 2 else "CCN", "Mon", h, 2, 0.0, i % 2, 0, 0.0, int(h >= 17))
            for i in range(240) for h in [i % 24]]
    f = spark.createDataFrame(rows, "trip_id string, stop_id string, line_code string, day_of_week string, "
                                    "sched_hour int, route_type int, precip_mm double, is_suburban_i int, "
                                    "is_raining_i int, delay_minutes double, is_late_5min int") \
        .withColumn("service_date", F.to_date(F.lit("2024-01-01")))
    s = M.train_test_split(f)
    model = M.fit_model(s.where(~F.col("is_test")))
    auc = M.roc_auc(M.score(model, s.where("is_test"))).first().auc
    assert auc > 0.9
    sc = M.scenario_scores(model, spark.createDataFrame(
        [("T1", "Mon", 20, 2, True, 2.0, 1, 1), ("T1", "Mon", 3, 2, False, 0.0, 1, 0)],
        "line_code string, day_of_week string, sched_hour int, route_type int, rain boolean, "
        "precip_mm double, is_suburban_i int, is_raining_i int")).orderBy("sched_hour").collect()
    assert [r.verdict for r in sc] == ["probably on time", "LIKELY LATE"]


def test_fit_is_at_its_optimum(spark):
    """The gradient of the balanced, penalised likelihood is near zero at the fitted coefficients."""
    f = M.ml_features(fixture_silver(spark, SF_CHECK))
    train = M.train_test_split(f).where(~F.col("is_test"))
    model = M.fit_model(train, max_iter=500)
    rows = model.transform(train).select(vector_to_array("features").alias("x"), "is_late_5min").toPandas()
    x, y = np.stack(rows["x"]), rows["is_late_5min"].to_numpy(float)
    w = np.where(y == 1, len(y) / (2 * y.sum()), len(y) / (2 * (1 - y).sum()))
    lr = model.stages[-1]
    beta = lr.coefficients.toArray()
    residual = w * (1 / (1 + np.exp(-(x @ beta + lr.intercept))) - y)
    scale = (w[:, None] * np.abs(x)).sum(0) + 1          # of a residual of one in every row
    assert np.abs((x.T @ residual + beta) / scale).max() < 1e-3
    assert abs(residual.mean()) < 1e-3


def test_split_without_stratifying(spark):
    """Fewer positives than needed: one threshold over all rows; classes may be missing, tables empty."""
    for positives in (0, 7, 8):
        rows = [(f"t{i}", "s", int(i < positives)) for i in range(400)]
        f = spark.createDataFrame(rows, "trip_id string, stop_id string, is_late_5min int").withColumn("service_date", F.to_date(F.lit("2024-01-01")))
        s = M.train_test_split(f).withColumn("h", M.split_hash()).collect()
        assert len(s) == 400
        for group in ([r for r in s if r.is_late_5min], [r for r in s if not r.is_late_5min]) if positives >= 8 else (s,):
            limit = sorted(r.h for r in group)[max(1, -(-len(group) // 4)) - 1]
            assert all(r.is_test == (r.h <= limit) for r in group)
    assert M.train_test_split(f.limit(0)).count() == 0


def test_the_compacted_rows_have_the_same_likelihood(spark):
    """The fit over distinct rows equals the fit over every row."""
    from pyspark.ml.classification import LogisticRegression
    train = M.train_test_split(M.ml_features(fixture_silver(spark, SF_CHECK))).where(~F.col("is_test")).persist()
    weighted, n = M.balanced_weights(train)
    lr = LogisticRegression(featuresCol="features", labelCol=M.LABEL, weightCol="weight", family="binomial", standardization=False,
                            elasticNetParam=0.0, regParam=1.0 / n, maxIter=500, tol=1e-12)
    every = M.weights(Pipeline(stages=M.encoder_stages() + [lr]).fit(weighted))
    compact, n2 = M.balanced_weights(M.compacted(train), rows="rows")
    few = M.weights(Pipeline(stages=M.encoder_stages() + [lr]).fit(compact))
    assert n == n2 and M.compacted(train).count() < train.count()
    flat = lambda w: [w.intercept, *[x for c in w.categories.values() for x in c.values()], *w.numbers.values()]
    assert np.abs(np.array(flat(every)) - np.array(flat(few))).max() < 1e-5        # where the two searches stop
    # the likelihood itself is the same at either end
    loss = lambda rows, w: M.score(w, rows).agg(F.sum(-F.col("weight") * F.log(F.when(F.col(M.LABEL) == 1, F.col("prob_late")).otherwise(1 - F.col("prob_late"))))).first()[0]
    for w in (every, few):
        assert abs(loss(weighted, w) / loss(compact, w) - 1) < 1e-12
    train.unpersist()


def test_the_split_builds_silver_once(spark):
    """The split and the fit read their rows several times: from a written table, not from the events."""
    from latewatch.plans import q_model
    for df in (q_model.split(spark, SF_SMALL), q_model.fit_optimum(spark, SF_SMALL)):
        assert df.inputFiles() and not [f for f in df.inputFiles() if "events" in f]
        assert df.count()
