import itertools
import random

from tillpoint.operators import evaluate


def test_auc_matches_pairwise_brute_force(spark):
    rnd = random.Random(7)
    rows = [(i, rnd.randint(0, 1), round(rnd.random(), 2)) for i in range(300)]
    df = spark.createDataFrame(rows, "merchant_id long, target int, prob double")
    auc = evaluate.roc_auc(df).first().auc
    pos = [p for _, y, p in rows if y == 1]
    neg = [p for _, y, p in rows if y == 0]
    wins = sum(1.0 if a > b else 0.5 if a == b else 0.0 for a, b in itertools.product(pos, neg))
    assert abs(auc - wins / (len(pos) * len(neg))) < 1e-12


def test_sweep_and_roc_consistent(spark):
    rows = [(i, i % 2, (i % 10) / 10.0) for i in range(100)]
    df = spark.createDataFrame(rows, "merchant_id long, target int, prob double")
    sweep = {r.threshold: r for r in evaluate.threshold_sweep(df).collect()}
    pp = sum(1 for _, _, p in rows if p > 0.5)
    tp = sum(1 for _, y, p in rows if p > 0.5 and y == 1)
    assert sweep[0.5].predicted_positive == pp and abs(sweep[0.5].precision - tp / pp) < 1e-12
    roc = sorted((r.fpr, r.tpr) for r in evaluate.roc_curve(df).collect())
    assert roc[-1] == (1.0, 1.0)
    assert all(a[1] <= b[1] for a, b in zip(roc, roc[1:]))


def test_split_and_downsample_exact_counts(spark):
    from tillpoint.operators import ml

    rows = [(i, 1 if i % 4 == 0 else 0) for i in range(4000)]
    df = spark.createDataFrame(rows, "merchant_id long, target int")
    train, test = ml.stratified_split(df, "target", 0.25, seed=3)
    by = {r.target: r["count"] for r in test.groupBy("target").count().collect()}
    assert by == {1: 250, 0: 750}
    assert train.count() + test.count() == 4000
    ds = ml.downsample_negatives(df, "target", seed=3)
    by = {r.target: r["count"] for r in ds.groupBy("target").count().collect()}
    assert by == {1: 1000, 0: 1000}


def test_missing_scores_count_as_lowest(spark):
    from tillpoint.operators import evaluate

    df = spark.createDataFrame([(1, 0.9), (0, 0.4), (0, None)], "target int, prob double")
    curve = evaluate.roc_curve(df).orderBy("fpr").collect()
    assert [(r["threshold"], r["tpr"], r["fpr"]) for r in curve] == [(0.9, 1.0, 0.0), (0.4, 1.0, 0.5), (None, 1.0, 1.0)]
    assert evaluate.accuracy(df, 0.5).first()["accuracy"] == 1.0
    cells = {(r["target"], r["predicted"]): r["n"] for r in evaluate.confusion_matrix(df, 0.5).collect()}
    assert cells == {(1, 1): 1, (1, 0): 0, (0, 0): 2, (0, 1): 0}


def test_one_class_has_no_rates(spark):
    from tillpoint.operators import evaluate

    df = spark.createDataFrame([(1, 0.9), (1, 0.4)], "target int, prob double")
    assert evaluate.roc_auc(df).first()["auc"] is None
    assert {r["fpr"] for r in evaluate.roc_curve(df).collect()} == {None}


def test_histogram_of_a_constant(spark):
    from tillpoint.operators import score

    df = spark.createDataFrame([(1.0,)] * 3, "x double")
    got = score.histogram(df, "x", 10).orderBy("bin").collect()
    assert [r["n"] for r in got] == [0] * 5 + [3] + [0] * 4 and (got[0]["lo"], got[-1]["hi"]) == (0.5, 1.5)


def test_positives_are_never_trimmed(spark):
    from tillpoint.operators import ml

    df = spark.createDataFrame([(i, int(i > 1)) for i in range(12)], "merchant_id long, target int")
    assert ml.downsample_negatives(df).count() == 12
    df = spark.createDataFrame([(i, int(i < 3)) for i in range(12)], "merchant_id long, target int")
    got = ml.downsample_negatives(df).collect()
    assert sum(r["target"] for r in got) == 3 and len(got) == 6
