"""Propensity models with Spark ML: split, down-sampling, GBT training,
scoring, per-round loss, error and AUC, and feature importance.

Training and scoring share one ordered feature list (``MODEL_NUMERIC`` +
``CATEGORICAL_FEATURES``) and one fitted pipeline, so category codes are fixed
at training time and reused when scoring.
"""

from __future__ import annotations

import dataclasses
import json
import math
import uuid
from collections.abc import Sequence
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import SQLTransformer, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, StringType, TimestampNTZType, TimestampType

from tillpoint.config import (
    CATEGORICAL_FEATURES,
    GBT_PARAMS,
    LOCATION_FEATURES,
    RATIO_FEATURES,
    ROLLING_FEATURES,
)
from tillpoint.session import checkpoint_dir
from tillpoint.sources.sinks import is_committed, stage

MODEL_NUMERIC = (
    list(ROLLING_FEATURES)
    + [r[0] for r in RATIO_FEATURES]
    + ["w1_sessions", "m1_sessions", "vintage"]
    + list(LOCATION_FEATURES)
)
MODEL_FEATURES = MODEL_NUMERIC + list(CATEGORICAL_FEATURES)


#: Categoricals that enter as their frequency rank (a numeric column); all others are nominal.
RANKED_CATEGORICALS = ("geohash4",)


def _hash(seed: int):
    """A non-negative 60-bit hash of the merchant and seed that any SQL engine with md5 can recompute."""
    text = F.concat(F.col("merchant_id").cast("string"), F.lit(f":{seed}"))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("long")


def kth_smallest(df: DataFrame, h, k: int):
    """Exact k-th smallest value of the 64-bit hash column ``h`` in ``df``,
    without funnelling rows through one task.

    Pass 1 counts rows per bucket of the top 16 of its 60 bits (at most 65,536
    bucket counts, bounded); the bucket holding the k-th value is found from
    their running sum; pass 2 sorts only that bucket (about n / 65,536 rows for
    a uniform hash) to pick the exact value.
    """
    if k <= 0:
        return None
    b = F.shiftright(h, 44)  # the top 16 of 60 bits keep the hash order
    counts = sorted((r[0], r[1]) for r in df.groupBy(b.alias("_b")).count().collect())
    seen = 0
    for bucket, n in counts:
        if seen + n >= k:
            rest = k - seen
            inside = df.filter(b == F.lit(bucket)).select(h.alias("_h")).orderBy("_h").limit(rest)
            return inside.agg(F.max("_h")).first()[0]
        seen += n
    return None


def stratified_split(df: DataFrame, label: str = "target", test_frac: float = 0.25, seed: int = 0):
    """Seeded, exact per-class split: in each class the ``floor(test_frac*n + 0.5)``
    rows with the smallest seeded hash go to the test side (class threshold
    from :func:`kth_smallest`).  Returns (train, test)."""
    h = _hash(seed)
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    test_cond = None
    for cls, n in counts.items():
        k = math.floor(test_frac * n + 0.5)
        thr = kth_smallest(df.filter(F.col(label) == cls), h, k)
        if thr is None:
            continue
        c = (F.col(label) == F.lit(cls)) & (h <= F.lit(thr))
        test_cond = c if test_cond is None else test_cond | c
    if test_cond is None:
        return df, df.limit(0)
    flagged = df.withColumn("_is_test", F.coalesce(test_cond, F.lit(False)))
    return flagged.filter(~F.col("_is_test")).drop("_is_test"), flagged.filter(F.col("_is_test")).drop("_is_test")


def downsample_negatives(df: DataFrame, label: str = "target", seed: int = 0) -> DataFrame:
    """Keep every positive row, and of the negatives as many as the smaller class has (those
    with the smallest seeded hashes).  With one class only, nothing is dropped."""
    counts = {r[0]: r[1] for r in df.groupBy(label).count().collect()}  # one row per class
    if len(counts) < 2:
        return df
    h = _hash(seed)
    thr = kth_smallest(df.filter(F.col(label) == 0), h, min(counts.values()))
    return df.filter((F.col(label) != 0) | (h <= F.lit(thr)))


def _missing_handler(numeric: list[str]) -> SQLTransformer:
    """NULL numerics -> -1 sentinel plus a 0/1 ``<col>__missing`` indicator
    (tree learners here reject NaN); part of the saved pipeline."""
    cols = ", ".join(
        f"COALESCE(CAST(`{c}` AS DOUBLE), -1.0) AS `{c}__v`, CAST(`{c}` IS NULL AS DOUBLE) AS `{c}__missing`" for c in numeric
    )
    return SQLTransformer(statement=f"SELECT *, {cols} FROM __THIS__")


def train_all(data: dict[str, DataFrame], parallelism: int = 3, **kwargs) -> dict[str, PipelineModel]:
    """One model of every product's training rows, fitted side by side (as a cross-validator fits
    its folds): the jobs of one model are too short to keep a cluster busy."""
    if not data:
        return {}
    fit = inheritable_thread_target(next(iter(data.values())).sparkSession)(lambda df: train_gbt(df, **kwargs))
    with ThreadPool(min(parallelism, len(data))) as pool:
        return dict(zip(data, pool.map(fit, data.values())))


def train_gbt(
    train: DataFrame,
    label: str = "target",
    numeric: list[str] | None = None,
    categorical: list[str] | None = None,
    max_iter: int = GBT_PARAMS["max_iter"],
    max_depth: int = GBT_PARAMS["max_depth"],
    step_size: float = GBT_PARAMS["step_size"],
    feature_subset: str = GBT_PARAMS["feature_subset"],
    subsampling_rate: float = GBT_PARAMS["subsampling_rate"],
    seed: int = 0,
    ranked: tuple[str, ...] = RANKED_CATEGORICALS,
    min_info_gain: float = 0.0,
) -> PipelineModel:
    """Fit missing-value handling, category indexers (unseen -> extra code),
    the assembler and a boosted-tree classifier as one PipelineModel.

    ``maxBins`` is set from the fitted indexers so every category keeps its
    own split value.  ``min_info_gain`` prunes like the source's ``gamma`` but is the gain of a
    row on average, not of a node's sum, so the source's value has no equal; 0 prunes nothing."""
    numeric = list(numeric or MODEL_NUMERIC)
    categorical = list(categorical or CATEGORICAL_FEATURES)
    prep = Pipeline(
        stages=[_missing_handler(numeric)]
        + [
            StringIndexer(inputCol=c, outputCol=f"{c}__idx", handleInvalid="keep", stringOrderType="frequencyDesc")
            for c in categorical
        ]
    ).fit(train)
    # the encoding of a column is declared, whatever the data; Spark raises if a nominal
    # column has more categories than training rows
    ranked = [c for c in categorical if c in ranked]
    nominal = [c for c in categorical if c not in ranked]
    stages = list(prep.stages)
    if ranked:
        stages.append(
            SQLTransformer(
                statement="SELECT *, " + ", ".join(f"CAST(`{c}__idx` AS DOUBLE) AS `{c}__rank`" for c in ranked) + " FROM __THIS__"
            )
        )
    n_labels = max([len(m.labelsArray[0]) for c, m in zip(categorical, prep.stages[1:]) if c in nominal] + [1])
    inputs = [f"{c}__v" for c in numeric] + [f"{c}__missing" for c in numeric]
    inputs += [f"{c}__idx" for c in categorical if c in nominal] + [f"{c}__rank" for c in ranked]
    assembler = VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep")
    gbt = GBTClassifier(
        labelCol=label,
        featuresCol="features",
        maxIter=max_iter,
        maxDepth=max_depth,
        stepSize=step_size,
        featureSubsetStrategy=feature_subset,
        subsamplingRate=subsampling_rate,
        minInfoGain=min_info_gain,
        maxBins=max(32, n_labels + 1),
        seed=seed,
    )
    prepped = PipelineModel(stages=stages).transform(train.withColumn(label, F.col(label).cast("double")))
    model = gbt.fit(assembler.transform(prepped))
    return PipelineModel(stages=stages + [assembler, model])


def score(model: PipelineModel, df: DataFrame, prob_col: str = "prob") -> DataFrame:
    """Positive-class probability per row (keeps the input columns).  A loaded model first checks
    that ``df`` meets its contract."""
    contract = getattr(model, "contract", None)
    if contract is not None:
        contract.check(df)
    out = model.transform(df)
    return out.select(*df.columns, vector_to_array(F.col("probability"))[1].alias(prob_col))


# --------------------------------------------------------------------------
# the trees of a model as rows
# --------------------------------------------------------------------------


def node_table(model: PipelineModel) -> DataFrame:
    """(tree, node, prediction, left_child, right_child, feature) of the boosted trees, read from
    the node rows of the saved model (written below the shared checkpoint folder); nodes are
    numbered in pre-order, a leaf has no children and no feature."""
    spark = SparkSession.getActiveSession()
    path = f"{checkpoint_dir(spark).rstrip('/')}/model-{uuid.uuid4().hex}"
    model.stages[-1].write().save(path)
    n = F.col("nodeData")
    inner = n["leftChild"] >= 0
    return spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        n["id"].alias("node"),
        n["prediction"].alias("prediction"),
        F.when(inner, n["leftChild"]).alias("left_child"),
        F.when(inner, n["rightChild"]).alias("right_child"),
        F.when(inner, n["split"]["featureIndex"]).alias("feature"),
    )


def split_counts(model: PipelineModel) -> DataFrame:
    """(feature index, split_count): how many nodes split on each feature."""
    return node_table(model).filter(F.col("feature").isNotNull()).groupBy("feature").agg(F.count(F.lit(1)).cast("int").alias("split_count"))


def feature_importance(model: PipelineModel, top: int = 20) -> DataFrame:
    """(feature, gain_importance, split_count): normalised gain from the model
    and the number of splits on each feature."""
    names = model.stages[-2].getInputCols()
    gain = model.stages[-1].featureImportances.toArray()
    spark = SparkSession.getActiveSession()
    rows = spark.createDataFrame([(i, n, float(gain[i])) for i, n in enumerate(names)], "i int, feature string, gain_importance double")
    splits = split_counts(model).withColumnRenamed("feature", "i")
    return (
        rows.join(splits, "i", "left")
        .select("feature", "gain_importance", F.coalesce("split_count", F.lit(0)).alias("split_count"))
        .orderBy(F.desc("gain_importance"), F.asc("feature"))
        .limit(top)
    )


def round_margins(model: PipelineModel, test: DataFrame, label: str = "target") -> DataFrame:
    """(label, margins): the cumulative margin of every row after each round, as one array.

    The model gives the leaf each row reaches in every tree (numbered in pre-order); the
    leaves' weighted values are model metadata (rounds x 2^depth numbers)."""
    gbt = model.stages[-1]
    leaves: dict[int, list[float]] = {}
    rows = node_table(model).filter(F.col("left_child").isNull()).select("tree", "node", "prediction")
    for r in sorted(rows.collect()):
        leaves.setdefault(r["tree"], []).append(r["prediction"] * gbt.treeWeights[r["tree"]])
    values = F.lit([leaves[t] for t in sorted(leaves)])
    reached = PipelineModel(stages=model.stages[:-1] + [gbt.copy({gbt.leafCol: "__leaf"})]).transform(test)
    gains = F.transform(vector_to_array(F.col("__leaf")), lambda leaf, i: F.get(F.get(values, i), leaf.cast("int")))
    sums = F.aggregate(
        gains,
        F.array().cast("array<double>"),
        lambda acc, x: F.array_append(acc, F.coalesce(F.get(acc, F.size(acc) - 1), F.lit(0.0)) + x),
    )
    return reached.select(F.col(label).cast("int").alias(label), sums.alias("margins"))


def round_metrics(model: PipelineModel, test: DataFrame, label: str = "target", buckets: int = 1024) -> DataFrame:
    """(round, logloss, error, auc) on the hold-out rows after each boosting round.

    The probability is ``1 / (1 + exp(-2 * margin))``, a row is positive above one half, and AUC is
    the rank sum of the positives with ties shared.  Rows are counted per (round, score), the
    scores are dealt to equal-width buckets of the round's range (any dealing that keeps the
    order is exact), and a score's rank is the rows of the buckets below plus those below
    it in its own, so no window holds a whole round.  AUC is NULL with one class."""
    rows = stage(
        round_margins(model, test, label).select(label, F.posexplode("margins").alias("k", "m"))
        .groupBy((F.col("k") + 1).alias("round"), F.col("m"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )
    m, pos, neg = F.col("m"), F.col("pos"), F.col("neg")
    totals = rows.groupBy("round").agg(  # one row a round
        F.min("m").alias("lo"), F.max("m").alias("hi"), F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(pos * F.log1p(F.exp(-2 * m)) + neg * F.log1p(F.exp(2 * m))).alias("loss"),
        F.sum(F.when(m > 0, neg).otherwise(pos)).alias("wrong"),
    )
    place = F.coalesce(F.floor(F.try_divide(m - F.col("lo"), F.col("hi") - F.col("lo")) * buckets), F.lit(0)).alias("bucket")
    dealt = rows.join(F.broadcast(totals.select("round", "lo", "hi")), "round").select("round", "m", "pos", "neg", place)
    below = Window.partitionBy("round").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = dealt.groupBy("round", "bucket").agg(F.sum("neg").alias("n")).select(
        "round", "bucket", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("before")
    )
    inside = Window.partitionBy("round", "bucket").orderBy("m").rowsBetween(Window.unboundedPreceding, -1)
    lower = F.col("before") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    won = dealt.join(offsets, ["round", "bucket"]).withColumn("won", pos * (2 * lower + neg))
    area = won.groupBy("round").agg(F.sum("won").alias("won"))
    n = F.col("P") + F.col("N")
    return totals.join(area, "round").select(
        F.col("round").cast("int").alias("round"),
        (F.col("loss") / n).alias("logloss"),
        (F.col("wrong") / n).alias("error"),
        F.try_divide(F.col("won"), F.lit(2.0) * F.col("P") * F.col("N")).alias("auc"),
    )


# --------------------------------------------------------------------------
# saved models and what they expect of their input
# --------------------------------------------------------------------------


class ContractError(ValueError):
    """The input or the saved model is not what the model was trained on."""


@dataclasses.dataclass(frozen=True)
class Contract:
    """What a model was trained on: the product, the features in order, how each one enters
    (``numeric``, ``nominal`` or ``ranked``) and the labels of every categorical, by code."""

    product: str
    features: tuple[str, ...]
    encodings: tuple[str, ...]
    labels: dict[str, tuple[str, ...]]

    @classmethod
    def of(cls, model: PipelineModel, product: str) -> "Contract":
        inputs = set(model.stages[-2].getInputCols())
        indexers = {x.getInputCol(): x for x in model.stages if isinstance(x, StringIndexerModel)}
        numeric = [c[:-3] for c in model.stages[-2].getInputCols() if c.endswith("__v")]
        encodings = ["numeric"] * len(numeric) + ["nominal" if f"{c}__idx" in inputs else "ranked" for c in indexers]
        return cls(product, (*numeric, *indexers), tuple(encodings), {c: tuple(x.labelsArray[0]) for c, x in indexers.items()})

    def check(self, df: DataFrame) -> None:
        """Raise unless ``df`` has every feature once, in the order of training, text for a
        categorical and a number for a numeric one (other columns may stand between them)."""
        given = [c for c in df.columns if c in set(self.features)]
        missing = [c for c in self.features if c not in given]
        if missing:
            raise ContractError(f"{self.product} model: missing features {missing}")
        if given != list(self.features):
            at = next(k for k, (a, b) in enumerate(zip(given, self.features)) if a != b)
            raise ContractError(f"{self.product} model: feature {at} is {given[at]!r}, trained with {self.features[at]!r}")
        for c, e in zip(self.features, self.encodings):
            text = isinstance(df.schema[c].dataType, (StringType, BooleanType, DateType, TimestampType, TimestampNTZType))
            if text != (e != "numeric"):
                raise ContractError(f"{self.product} model: {c} is {df.schema[c].dataType.simpleString()}, trained as {e}")


def in_order(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """``df`` with the features last, in the given order."""
    return df.select(*[c for c in df.columns if c not in set(features)], *features)


def save(model: PipelineModel, path: str, product: str = "") -> None:
    """Save the model and, beside its stages, its contract; the contract is written last."""
    model.write().overwrite().save(path)
    text = json.dumps(dataclasses.asdict(Contract.of(model, product)))
    SparkSession.getActiveSession().createDataFrame([(text,)], "contract string").coalesce(1).write.mode("overwrite").parquet(f"{path}/contract")


def load(path: str, product: str | None = None) -> PipelineModel:
    """The saved model with its contract.  Raises if there is none, if it is another product's,
    or if the saved stages do not have its features, encodings and labels."""
    spark = SparkSession.getActiveSession()
    if not is_committed(spark, f"{path}/contract"):
        raise ContractError(f"no contract beside the model at {path}")
    raw = json.loads(spark.read.parquet(f"{path}/contract").first()["contract"])
    own = Contract(raw["product"], tuple(raw["features"]), tuple(raw["encodings"]), {c: tuple(x) for c, x in raw["labels"].items()})
    if product is not None and own.product != product:
        raise ContractError(f"the model at {path} is for {own.product!r}, not {product!r}")
    model = PipelineModel.load(path)
    if Contract.of(model, own.product) != own:
        raise ContractError(f"the stages of the model at {path} are not those of its contract")
    model.contract = own
    return model
