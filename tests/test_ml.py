import numpy as np
import pytest
from pyspark.sql import functions as F

from sparklab.operators import ml


def _auc_brute(p, y):
    pos = [a for a, b in zip(p, y) if b]
    neg = [a for a, b in zip(p, y) if not b]
    s = sum((1.0 if a > b else 0.5 if a == b else 0.0) for a in pos for b in neg)
    return s / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def scores(spark):
    rng = np.random.default_rng(3)
    y = rng.random(400) < 0.3
    p = np.round(np.clip(rng.normal(0.3 + 0.3 * y, 0.2), 0, 0.99), 2)  # rounded: many ties
    rows = [(i, float(a), bool(b)) for i, (a, b) in enumerate(zip(p, y))]
    return spark.createDataFrame(rows, "id int, p double, y boolean"), p, y


def test_auc_with_ties_matches_brute_force(scores):
    df, p, y = scores
    got = ml.roc_auc(df, "p", F.col("y")).first()[0]
    assert abs(got - _auc_brute(p, y)) < 1e-12


def test_pr_auc_matches_numpy(scores):
    df, p, y = scores
    order = sorted(set(p), reverse=True)
    P = y.sum()
    ap = 0.0
    for s in order:
        m = p >= s
        tp = (m & y).sum()
        ap += ((p == s) & y).sum() / P * tp / m.sum()
    assert abs(ml.pr_auc(df, "p", F.col("y")).first()[0] - ap) < 1e-12


def test_confusion_and_roc_consistency(scores):
    df, p, y = scores
    cm = df.withColumn("a", F.when(F.col("y"), "Yes").otherwise("No"))
    total = sum(r["No"] + r["Yes"] for r in ml.confusion_matrix(cm, "p", "a").collect())
    assert total == 400
    roc = ml.roc_curve(df, "p", F.col("y"), 100).orderBy("threshold").collect()
    for r in roc:
        th = r.threshold
        assert r.true_positives == int(((p >= th) & y).sum())
        assert r.true_positives + r.false_negatives == int(y.sum())
    tps = [r.true_positives for r in roc]
    assert tps == sorted(tps, reverse=True)


def test_evaluate_classifier_fields(scores):
    df, p, y = scores
    r = ml.evaluate_classifier(df, "p", F.col("y"), 0.5).first()
    acc = (((p >= 0.5) == y).sum()) / len(y)
    assert abs(r.accuracy - round(acc, 6)) < 1e-9 and 0 < r.log_loss


def test_splits(spark):
    df = spark.range(0, 300).withColumn("label", (F.col("id") % 5 == 0).cast("int"))
    assert ml.data_split(df, "AUTO", key="id").where("is_eval").count() == 0  # < 500 rows: all train
    s = ml.stratified_split(df, "label", "id", 0.2)
    got = {r.label: r.n for r in s.where("is_eval").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert got == {0: 48, 1: 12}
    seq = ml.data_split(df, "SEQ", key="id", seq_col="id", eval_fraction=0.1)
    assert seq.where("is_eval").agg(F.min("id")).first()[0] == 270


def test_class_weights(spark):
    df = spark.createDataFrame([(1,)] * 10 + [(0,)] * 30, "y int")
    w = {r.y: r.weight for r in ml.auto_class_weights(df, "y").distinct().collect()}
    assert w == {1: 2.0, 0: 40 / 60}


def test_bound_model_round_trip(spark, tmpdir_path):
    from pyspark.ml import PipelineModel
    from pyspark.ml.classification import LogisticRegression
    from sparklab.operators.transforms import bound_pipeline
    rows = [(float(i % 17), "a" if i % 3 else "b", float(i % 2)) for i in range(200)] + [(None, None, 1.0)]
    df = spark.createDataFrame(rows, "x double, c string, label double")
    m = bound_pipeline(["x"], ["c"], LogisticRegression(labelCol="label")).fit(df)
    m.write().overwrite().save(tmpdir_path + "/m")
    m2 = PipelineModel.load(tmpdir_path + "/m")
    raw = spark.createDataFrame([(3.0, "a"), (None, "unseen")], "x double, c string")
    a = [r.probability[1] for r in m.transform(raw).collect()]
    b = [r.probability[1] for r in m2.transform(raw).collect()]
    assert a == b and len(a) == 2
