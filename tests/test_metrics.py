import numpy as np
import pytest

from tabwarden.functions import class1_probability
from tabwarden.operators import curves, metrics, profile, scale


def predictions(spark, tp, fp, fn, tn):
    counts = [(1, 1, tp), (0, 1, fp), (1, 0, fn), (0, 0, tn)]
    df = spark.createDataFrame(counts, "label int, prediction int, n int")
    return df.selectExpr("label", "prediction", "explode(sequence(1, n)) AS i").drop("i") if min(tp, fp, fn, tn) else df.where("n > 0")


def test_published_scores(spark):
    counts = metrics.confusion(predictions(spark, 1212, 32, 19, 948))
    row = metrics.binary_scores(counts).first()
    assert [round(row[c], 4) for c in ("precision", "recall", "f1_score")] == [0.9743, 0.9846, 0.9794]
    weighted = metrics.weighted_scores(counts).first()
    assert weighted["recall"] == pytest.approx(weighted["accuracy"])
    assert weighted["accuracy"] == pytest.approx(2160 / 2211)


def test_one_class_only(spark):
    df = spark.createDataFrame([(1, 1), (1, 0)], "label int, prediction int")
    row = metrics.confusion(df).first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (0, 0, 1, 1)
    report = {r["class_name"]: r for r in metrics.class_report(metrics.confusion(df)).collect()}
    assert report["Legitimate"]["support"] == 0 and report["Legitimate"]["recall"] == 0.0
    assert report["Phishing"]["recall"] == 0.5 and report["accuracy"]["f1_score"] == 0.5
    assert curves.roc_auc(df.withColumnRenamed("prediction", "p"), "label", "p").first()[0] is None


def test_empty_predictions(spark):
    df = spark.createDataFrame([], "label int, prediction int")
    assert metrics.weighted_scores(metrics.confusion(df)).first()["accuracy"] == 0.0


def test_average_precision_example(spark):
    df = spark.createDataFrame([(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.5, 1)], "score double, y int")
    assert curves.average_precision(df, "y", "score").first()[0] == pytest.approx(0.755556, abs=1e-6)
    assert curves.roc_auc(df, "y", "score").first()[0] == pytest.approx(0.5)


def _scored(spark, n=500):
    rng = np.random.default_rng(3)
    y = rng.integers(0, 2, n)
    score = np.round(rng.random(n) * 0.7 + y * 0.2, 2)
    return spark.createDataFrame([(float(s), int(v)) for s, v in zip(score, y)], "score double, y int"), score, y


@pytest.mark.parametrize("sizes", [{}, {"window_keys": 5, "slice_keys": 20}])
def test_curves_against_brute_force(spark, sizes):
    df, score, y = _scored(spark)
    p, n = y.sum(), (1 - y).sum()
    pairs = score[y == 1][:, None] - score[y == 0][None, :]
    auc = ((pairs > 0) + 0.5 * (pairs == 0)).mean()
    assert curves.roc_auc(df, "y", "score", **sizes).first()[0] == pytest.approx(auc)
    flipped = df.withColumn("score", 1 - df.score)
    assert curves.roc_auc(flipped, "y", "score", **sizes).first()[0] == pytest.approx(1 - auc)

    steps = sorted(set(score), reverse=True)
    points = [(t, (y[score >= t] == 0).sum() / n, (y[score >= t] == 1).sum() / p) for t in steps]
    per_step = [((y[score == t] == 0).sum(), (y[score == t] == 1).sum()) for t in steps]
    kept = [pt for i, pt in enumerate(points) if i in (0, len(points) - 1) or per_step[i] != per_step[i + 1]]
    got = curves.roc_curve(df, "y", "score", **sizes).where("threshold is not null").orderBy("threshold", ascending=False).collect()
    np.testing.assert_allclose(np.array([tuple(r) for r in got]), np.array(kept))

    want = [(t, (y[score >= t] == 1).mean(), (y[score >= t] == 1).sum() / p) for t in steps]
    got = curves.pr_curve(df, "y", "score", **sizes).where("threshold is not null").orderBy("threshold", ascending=False).collect()
    np.testing.assert_allclose(np.array([tuple(r) for r in got]), np.array(want))
    assert curves.pr_curve(df, "y", "score").where("threshold is null").first()[1:] == (1.0, 0.0)


@pytest.mark.parametrize("most", [3, 8, 41, 5000])
def test_bounded_roc_curve_stays_within_its_error(spark, most):
    df, _, _ = _scored(spark, 3000)
    full = [tuple(r)[1:] for r in curves.roc_curve(df, "y", "score").collect()]
    kept = sorted(tuple(r)[1:] for r in curves.roc_curve(df, "y", "score", max_points=most).collect())
    assert len(kept) <= most and set(kept) <= set(full) and kept[0] == (0.0, 0.0) and kept[-1] == (1.0, 1.0)
    part = 2 / ((most - 1) // 2)
    for fpr, tpr in set(full) - set(kept):
        after = next(i for i, p in enumerate(kept) if sum(p) > fpr + tpr)
        (x0, y0), (x1, y1) = kept[after - 1], kept[after]
        assert x0 <= fpr <= x1 and y0 <= tpr <= y1 and (x1 - x0) + (y1 - y0) <= part + 1e-12


@pytest.mark.parametrize("most", [5, 41, 5000])
def test_bounded_pr_curve_keeps_the_outline(spark, most):
    df, _, _ = _scored(spark, 3000)
    full = [tuple(r) for r in curves.pr_curve(df, "y", "score").collect()]
    kept = [tuple(r) for r in curves.pr_curve(df, "y", "score", max_points=most).collect()]
    assert len(kept) == len(set(kept)) <= most and set(kept) <= set(full)
    part = 4 / (most - 4)
    for _, precision, recall in set(full) - set(kept):
        near = [p for _, p, r in kept if abs(r - recall) <= part]
        assert min(near) <= precision <= max(near)


def test_bounded_curves_of_odd_rows(spark):
    one_class = spark.createDataFrame([(0.1, 1), (0.2, 1), (None, 0), (0.3, None)], "score double, y int")
    assert curves.roc_curve(one_class, "y", "score", max_points=3).count() <= 3
    assert curves.pr_curve(one_class, "y", "score", max_points=5).count() <= 5
    assert curves.roc_curve(one_class.limit(0), "y", "score", max_points=3).count() == 1
    with pytest.raises(ValueError):
        curves.roc_curve(one_class, "y", "score", max_points=2)
    with pytest.raises(ValueError):
        curves.pr_curve(one_class, "y", "score", max_points=4)


def test_probability_inputs(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(0.3, 0.7), [0.3, 0.7], 0.7)], ["v", "a", "s"])
    row = df.select(*[class1_probability(df, c).alias(c) for c in ("v", "a", "s")]).first()
    assert list(row) == [0.7, 0.7, 0.7]


def test_r2(spark):
    df = spark.createDataFrame([(1.0, 1.5), (2.0, 2.0), (3.0, 2.0)], "y double, p double")
    assert metrics.r2_score(df, "y", "p").first()["r2"] == pytest.approx(1 - 1.25 / 2)
    flat = spark.createDataFrame([(1.0, 1.0), (1.0, 1.0)], "y double, p double")
    assert metrics.r2_score(flat, "y", "p").first()["r2"] == 1.0
    assert metrics.r2_score(flat.withColumn("p", flat.p + 1), "y", "p").first()["r2"] == 0.0


def test_profiles(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (None, float("nan"), -1), (3, None, 1)], "a int, b double, Result int")
    nulls = {r["column_name"]: r["missing"] for r in profile.null_profile(df).collect()}
    assert nulls == {"a": 1, "b": 2, "Result": 0, "(all)": 3}
    assert [tuple(r) for r in profile.value_counts(df, "Result").collect()] == [(1, 2), (-1, 1)]
    row = profile.class_balance(df.where("a > 5"), "Result").first()
    assert row["total_rows"] == 0 and row["positive_ratio"] is None
    bounds = {r["column_name"]: (r["min_value"], r["max_value"]) for r in profile.range_profile(df, ["a", "Result"]).collect()}
    assert bounds == {"a": (1.0, 3.0), "Result": (-1.0, 1.0), "(all)": (-1.0, 3.0)}


def test_scaling(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    got = [tuple(r) for r in scale.standard_scale(df, scale.scaler_stats(df, ["a", "b"])).collect()]
    assert sorted(got) == [(-1.0, 0.0), (1.0, 0.0)]
