"""Quality rules: text statistics and a learned decision list (DataFrame operations only).

Statistics are built-in expressions over the whole text.  The decision list is learned by
sequential covering: thresholds are quantiles of the labelled rows; a rule grows one
threshold condition at a time by FOIL gain on the growing part, is pruned from its end on
the pruning part, is accepted while it is precise there, and the rows it covers leave.
The result is an ordered ``CASE WHEN`` expression over the statistics.

The labelled rows are counted into cells (one per combination of threshold bins and label) in
Spark; at most ``MAX_LABELLED`` labelled documents, those with the smallest id hashes,
are used, so at most that many cells reach the driver.

Edge rules: a null text has no words and all counts 0 (and fails the base rule); labels that
are null or of unknown documents are ignored, of several labels of one document the
lowest counts; without labels of both kinds the list is empty and keeps everything the base keeps.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import SPACE_RE, narrow, stage, text_key, text_of

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
MAX_LABELLED = 20_000
N_THRESHOLDS = 24
MAX_CONDITIONS = 4
MAX_RULES = 12
MIN_PRECISION = 0.9
MIN_COVERED = 3
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
FEATURES = ["mean_word", "symbol_share", "dup_line_share", "repeat_share", "distinct_share", "upper_share", "punct_share", "words"]


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, the base counts and ``FEATURES`` of every document."""
    d = narrow(docs).select("doc_id", text_key().alias("tkey"), text_of().alias("text"))
    d = d.withColumn("w", F.filter(F.split("text", SPACE_RE), lambda x: x != ""))
    d = d.withColumn("wh", F.transform("w", lambda x: F.xxhash64(x)))
    # hashes of the 3-word windows
    d = d.withColumn(
        "g",
        F.transform(
            F.slice("wh", F.lit(1), F.greatest(F.size("wh") - 2, F.lit(0))),
            lambda x, i: F.xxhash64(x, F.get("wh", i + 1), F.get("wh", i + 2)),
        ),
    )
    # windows found twice or more: sorted (hash, position) pairs that equal a neighbour
    d = d.withColumn(
        "s",
        F.when(
            F.size(F.array_distinct("g")) < F.size("g"),
            F.sort_array(F.transform("g", lambda h, i: F.struct(h.alias("h"), i.alias("i")))),
        ),
    )
    d = d.withColumn(
        "p",
        F.sort_array(
            F.transform(
                F.filter(
                    "s",
                    lambda x, j: x["h"].eqNullSafe(F.get("s", j - 1)["h"]) | x["h"].eqNullSafe(F.get("s", j + 1)["h"]),
                ),
                lambda x: x["i"],
            )
        ),
    )
    # a window covers its three words, less what the next one covers again
    covered = F.aggregate(
        F.transform("p", lambda x, j: F.least(F.coalesce(F.get("p", j + 1) - x, F.lit(3)), F.lit(3))),
        F.lit(0),
        lambda a, x: a + x,
    )
    full = F.filter(F.split("text", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    d = d.withColumn("lines", full)
    chars = F.length("text")
    count = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    d = d.select(
        "doc_id", "tkey",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("text", SPACES, "")).cast("long").alias("word_chars"),
        (chars - F.length(F.translate("text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        count(covered).alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("wh")).cast("long").alias("n_distinct"),
        F.regexp_count("text", F.lit("[A-Z]")).cast("long").alias("n_upper"),
        F.regexp_count("text", F.lit("[.,;:!?]")).cast("long").alias("n_punct"),
    )
    per = lambda a, b: F.coalesce(F.try_divide(F.col(a).cast("double"), F.col(b)), F.lit(0.0))
    return d.select(
        "doc_id", "tkey", *BASE,
        per("word_chars", "n_words").alias("mean_word"),
        per("n_symbols", "word_chars").alias("symbol_share"),
        per("n_dup_lines", "n_lines").alias("dup_line_share"),
        per("n_repeat_words", "n_words").alias("repeat_share"),
        per("n_distinct", "n_words").alias("distinct_share"),
        per("n_upper", "word_chars").alias("upper_share"),
        per("n_punct", "word_chars").alias("punct_share"),
        F.col("n_words").cast("double").alias("words"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)


@dataclass
class Rule:
    """A conjunction of (feature, "<=" or ">", threshold); documents that meet it are rejected."""

    conditions: list[tuple[str, str, float]]

    def column(self) -> Column:
        tests = [F.col(f) <= F.lit(t) if op == "<=" else F.col(f) > F.lit(t) for f, op, t in self.conditions]
        return reduce(lambda a, b: a & b, tests)


@dataclass
class DecisionList:
    rules: list[Rule] = field(default_factory=list)

    def verdict(self) -> Column:
        """True keeps.  Rules are tried in order; the default keeps."""
        out = None
        for r in self.rules:
            out = (F if out is None else out).when(r.column(), F.lit(False))
        return out.otherwise(F.lit(True)) if out is not None else F.lit(True)


def labelled(stats: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """Statistics of at most ``max_labelled`` labelled documents (smallest id hashes) with ``bad``."""
    lab = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("lab_id"))
        .agg((F.min("quality") == 0).alias("bad"))
        .orderBy(F.xxhash64("lab_id"), "lab_id")
        .limit(max_labelled)
    )
    return stats.join(lab, F.col("doc_id") == F.col("lab_id")).select("doc_id", "bad", *FEATURES)


def learn(sample: DataFrame) -> DecisionList:
    """Sequential covering over labelled statistics."""
    sample = stage(sample)
    edges_row = sample.agg(
        *[F.percentile_approx(f, [(k + 0.5) / N_THRESHOLDS for k in range(N_THRESHOLDS)], 10_000).alias(f) for f in FEATURES],
        *[
            F.percentile_approx(F.when(F.col("bad"), F.col(f)), [(k + 0.5) / 8 for k in range(8)], 10_000).alias(f"{f}_bad")
            for f in FEATURES
        ],
    ).first()
    edges = {f: sorted({*(edges_row[f] or []), *(edges_row[f"{f}_bad"] or [])}) for f in FEATURES}
    # bin b holds values over exactly b of the feature's edges
    bins = [sum([(F.col(f) > F.lit(e)).cast("int") for e in edges[f]], F.lit(0)).alias(f) for f in FEATURES]
    cells = (
        sample.select("bad", (F.pmod(F.xxhash64("doc_id"), F.lit(3)) == 0).alias("prune"), *bins)
        .groupBy("bad", "prune", *FEATURES)
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()  # at most MAX_LABELLED cells
    )
    rows = [(tuple(r[f] for f in FEATURES), r["bad"], r["prune"], r["n"]) for r in cells]
    return DecisionList([Rule([(FEATURES[f], op, edges[FEATURES[f]][e]) for f, op, e in c]) for c in _cover(rows, [len(edges[f]) for f in FEATURES])])


def _meets(cell: tuple, cond: tuple[int, str, int]) -> bool:
    f, op, e = cond
    return cell[f] <= e if op == "<=" else cell[f] > e


def _counts(rows: list, conds: list) -> tuple[int, int]:
    bad = good = 0
    for cell, is_bad, _, n in rows:
        if all(_meets(cell, c) for c in conds):
            bad, good = (bad + n, good) if is_bad else (bad, good + n)
    return bad, good


def _grow(rows: list, n_edges: list[int]) -> list[tuple[int, str, int]]:
    conds: list[tuple[int, str, int]] = []
    live = rows
    while len(conds) < MAX_CONDITIONS:
        p0, n0 = _counts(live, [])
        if not p0 or not n0:
            break
        best, found = 0.0, None
        for f, k in enumerate(n_edges):
            hist = [[0, 0] for _ in range(k + 1)]
            for cell, is_bad, _, n in live:
                hist[cell[f]][0 if is_bad else 1] += n
            p = q = 0
            for e in range(k):
                p, q = p + hist[e][0], q + hist[e][1]
                for op, pp, qq in (("<=", p, q), (">", p0 - p, n0 - q)):
                    if pp:
                        gain = pp * (math.log2(pp / (pp + qq)) - math.log2(p0 / (p0 + n0)))
                        if gain > best + 1e-9:
                            best, found = gain, (f, op, e)
        if found is None:
            break
        conds.append(found)
        live = [r for r in live if _meets(r[0], found)]
    return conds


def _cover(rows: list, n_edges: list[int]) -> list[list[tuple[int, str, int]]]:
    out: list[list[tuple[int, str, int]]] = []
    while len(out) < MAX_RULES:
        grow, prune = [r for r in rows if not r[2]], [r for r in rows if r[2]]
        conds = _grow(grow, n_edges)
        if not conds:
            break
        worth = lambda c: (lambda p, n: ((p - n) / (p + n) if p + n else -1.0, -len(c)))(*_counts(prune, c))
        conds = max((conds[:k] for k in range(1, len(conds) + 1)), key=worth)
        p, n = _counts(prune, conds)
        if p < MIN_COVERED or p < MIN_PRECISION * (p + n):
            break
        out.append(conds)
        rows = [r for r in rows if not all(_meets(r[0], c) for c in conds)]
    return out


def judged(docs: DataFrame, labels: DataFrame) -> tuple[DataFrame, DecisionList]:
    """Statistics with base_failed and kept, and the decision list behind them."""
    stats = stage(statistics(docs))
    rules = learn(labelled(stats, labels))
    failed = base_failed()
    return stats.withColumn("base_failed", failed).withColumn("kept", ~F.col("base_failed") & rules.verdict()), rules


def quality_verdicts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The digest of every document."""
    return judged(docs, labels)[0].select("doc_id", *BASE, "base_failed", "kept")


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that are kept, with all their columns.  Verdicts are joined by id and
    text fingerprint; equal rows have equal verdicts, so distinct verdicts lose nothing."""
    kept = judged(docs, labels)[0].filter("kept").select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key")).distinct()
    key = docs.withColumn("__tkey", text_key())
    return key.join(
        kept, key["doc_id"].cast("long").eqNullSafe(kept["__id"]) & (key["__tkey"] == kept["__key"]), "left_semi"
    ).drop("__tkey")
