"""Trees as rows, metrics per round and the model contract."""

import math
import random
import threading

import pytest
from pyspark.sql import functions as F

from tillpoint.operators import evaluate, ml

NUMERIC = ["a", "b"]
CATEGORICAL = ["c", "geohash4"]


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(6)
    rows = []
    for k in range(600):
        a, b, c, g = rng.random(), rng.choice([None, rng.random()]), rng.choice("xyz"), f"g{rng.randint(0, 40)}"
        y = int(a + 0.5 * (c == "x") + rng.gauss(0, 0.3) > 0.8)
        rows.append((k, a, b, c, g, y))
    return spark.createDataFrame(rows, "merchant_id long, a double, b double, c string, geohash4 string, target int")


@pytest.fixture(scope="module")
def model(data):
    return ml.train_gbt(data, numeric=NUMERIC, categorical=CATEGORICAL, max_iter=12, max_depth=3, feature_subset="all")


def walk(node, out):
    """Splits per feature of a tree, through the public tree interface of the JVM model."""
    if node.numDescendants() > 0:
        out[node.split().featureIndex()] = out.get(node.split().featureIndex(), 0) + 1
        walk(node.leftChild(), out)
        walk(node.rightChild(), out)
    return out


def test_products_are_fitted_side_by_side(data, model, monkeypatch):
    meet = threading.Barrier(3, timeout=60)  # passed only if three fits are begun together
    monkeypatch.setattr(ml, "train_gbt", lambda df, f=ml.train_gbt, **kw: (meet.wait(), f(df, **kw))[1])
    args = dict(numeric=NUMERIC, categorical=CATEGORICAL, max_iter=12, max_depth=3, feature_subset="all")
    other = data.withColumn("target", 1 - F.col("target"))
    got = ml.train_all({"x": data, "y": other, "z": data}, **args)
    trees = lambda m: sorted(map(str, ml.node_table(m).collect()))
    assert list(got) == ["x", "y", "z"] and trees(got["x"]) == trees(got["z"]) == trees(model) != trees(got["y"])
    assert ml.train_all({}) == {}


def test_split_counts_of_a_known_tree(spark):
    rows = [(float(x), float(z), int(x > 4) if z < 5 else int(x > 7)) for x in range(10) for z in range(10)]
    df = spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "merchant_id long, a double, b double, target int")
    df = df.withColumn("c", F.lit("only"))
    one = ml.train_gbt(df, numeric=NUMERIC, categorical=["c"], max_iter=1, max_depth=2, feature_subset="all", ranked=())
    names = one.stages[-2].getInputCols()
    counts = {names[r.feature]: r.split_count for r in ml.split_counts(one).collect()}
    # x > 7 or x <= 4 decides alone, else z: the root splits on x, and one more split on each of x and z at most
    assert counts["a__v"] >= 1 and sum(counts.values()) == ml.node_table(one).filter("feature IS NOT NULL").count() <= 3
    tree = ml.node_table(one).orderBy("node").collect()
    assert tree[0].node == 0 and tree[0].left_child == 1 and names[tree[0].feature] == "a__v"
    leaves = [r for r in tree if r.left_child is None]
    assert len(leaves) == sum(counts.values()) + 1 and all(r.feature is None for r in leaves)


def test_split_counts_equal_the_model_s_trees(model):
    want = {}
    for tree in model.stages[-1]._java_obj.trees():
        walk(tree.rootNode(), want)
    got = {r.feature: r.split_count for r in ml.split_counts(model).collect()}
    assert got == want
    top = ml.feature_importance(model, 3).collect()
    names = model.stages[-2].getInputCols()
    assert [r.gain_importance for r in top] == sorted(map(float, model.stages[-1].featureImportances.toArray()), reverse=True)[:3]
    assert all(r.split_count == want.get(names.index(r.feature), 0) for r in top)


def brute(rows, r):
    """logloss, error, AUC of round r from (label, margins)."""
    n = len(rows)
    loss = sum(math.log1p(math.exp(-2 * m[r] * (1 if y else -1))) for y, m in rows) / n
    wrong = sum((m[r] > 0) != bool(y) for y, m in rows) / n
    pos, neg = [m[r] for y, m in rows if y], [m[r] for y, m in rows if not y]
    auc = sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg)) if pos and neg else None
    return loss, wrong, auc


@pytest.mark.parametrize("buckets", [1024, 3])
def test_every_round_is_recomputed(data, model, buckets):
    test = data.filter("merchant_id % 3 = 0")
    rows = [(r.target, r.margins) for r in ml.round_margins(model, test).collect()]
    got = {r["round"]: r for r in ml.round_metrics(model, test, buckets=buckets).collect()}
    assert sorted(got) == list(range(1, 13))
    spark_losses = model.stages[-1].evaluateEachIteration(
        model.transform(test.withColumn("target", F.col("target").cast("double"))).select("target", "features")
    )
    for k in range(12):
        loss, wrong, auc = brute(rows, k)
        r = got[k + 1]
        assert r.logloss == pytest.approx(loss, rel=1e-9) == pytest.approx(spark_losses[k] / 2, rel=1e-9)
        assert r.error == pytest.approx(wrong) and r.auc == pytest.approx(auc, rel=1e-12)
    scored = ml.score(model, test, "prob")
    assert got[12].auc == pytest.approx(evaluate.roc_auc(scored).first().auc, abs=1e-9)
    assert got[12].error == pytest.approx(1 - evaluate.accuracy(scored, 0.5).first().accuracy)


def test_one_class_has_no_auc(data, model):
    for r in ml.round_metrics(model, data.filter("target = 1")).collect():
        assert r.auc is None and r.logloss > 0
    assert ml.round_metrics(model, data.filter("target = 7")).count() == 0


def test_contract_is_stored_and_checked(spark, data, model, tmp_path):
    path = f"{tmp_path}/m"
    ml.save(model, path, "swipe")
    own = ml.load(path, "swipe")
    assert own.contract.features == ("a", "b", "c", "geohash4")
    assert own.contract.encodings == ("numeric", "numeric", "nominal", "ranked")
    assert sorted(own.contract.labels["c"]) == ["x", "y", "z"]
    want = [tuple(r) for r in ml.score(model, data).select("merchant_id", "prob").orderBy("merchant_id").collect()]
    assert [tuple(r) for r in ml.score(own, data).select("merchant_id", "prob").orderBy("merchant_id").collect()] == want
    mixed = data.select("b", "a", "c", "geohash4", "merchant_id")
    with pytest.raises(ml.ContractError, match="feature 0 is 'b', trained with 'a'"):
        ml.score(own, mixed)
    assert ml.score(own, ml.in_order(mixed, own.contract.features)).count() == 600
    with pytest.raises(ml.ContractError, match="missing features .'c'"):
        ml.score(own, data.drop("c"))
    with pytest.raises(ml.ContractError, match="c is int, trained as nominal"):
        ml.score(own, data.withColumn("c", F.lit(1)))
    with pytest.raises(ml.ContractError, match="a is string, trained as numeric"):
        ml.score(own, data.withColumn("a", F.lit("1")))
    with pytest.raises(ml.ContractError, match="is for 'swipe', not 'loan'"):
        ml.load(path, "loan")
    model.write().save(f"{tmp_path}/bare")
    with pytest.raises(ml.ContractError, match="no contract"):
        ml.load(f"{tmp_path}/bare")
    other = ml.train_gbt(data, numeric=["a"], categorical=CATEGORICAL, max_iter=1, max_depth=1)
    ml.save(other, f"{tmp_path}/other", "swipe")
    spark.read.parquet(f"{path}/contract").write.mode("overwrite").parquet(f"{tmp_path}/other/contract")
    with pytest.raises(ml.ContractError, match="not those of its contract"):
        ml.load(f"{tmp_path}/other")
