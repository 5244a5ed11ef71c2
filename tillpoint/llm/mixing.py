"""Mixing sources to target weights by pivotal dependent rounding.

A source's target is its share, by weight, of all words, at most ``most`` times its own words;
what is above is shared again, by weight, among the others (``targets``).  Target over words is
the copy rate of all documents of a source: its whole part is taken from each of them, and the
rest is a probability that is rounded to 0 or 1 so that the source's words stay near the target.

Method (pivotal dependent rounding): two documents' probabilities are paired, and words are
moved from one to the other, in a random direction that keeps both expectations, until one
is 0 or 1; the other goes on.  The words of a pair never change.  Documents are dealt by hash
to leaves of about ``LEAF``; a leaf pairs within classes of sizes that differ by less than a
factor of two until at most ``KEEP`` documents of a class are open, and these residuals are
combined ``FAN`` leaves at a time up a tree (one grouped Spark stage a level, staged).  At the root
of a source the open documents are settled from the largest on, each against all smaller ones
together (``settle``), so what is missed in the end is the rounding of the smallest one, unless
a document outweighs all others.  The order of settling is the only place where an expectation is
kept up to the pool's proportions, not exactly.

Scale: a source of any size spreads over its leaves, and only ``KEEP`` rows of each of about 20 size classes of a node go up.
Sources are ranked by range partitions, not in one task.  The driver sees scalars only.  Leaves
follow from hashes of (id, text), so reruns and other partitionings agree.

Edge rules: a null or blank text has size 0 and is taken 0 words; a null source is a source, the
last one; rows that repeat an id are documents of their own (equal rows are interchangeable); an
empty table, or one without words, takes nothing.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

from tillpoint.llm.common import python_tasks, stage, tasks_for, text_key, text_of

WORD_RE = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
MOST = 3
LEAF = 4096
FAN = 32
KEEP = 8
SEED = 12
NODE = "sid long, nodes long, node long, key long, doc_id long, size long, p double"


def sized(docs: DataFrame, source_col: str = "source") -> DataFrame:
    """doc_id, source, size in words and a hash of every document; staged."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col("text").alias("text")
    )
    key = F.xxhash64("doc_id", text_key())
    size = F.regexp_count(text_of(), F.lit(WORD_RE)).cast("long")
    return stage(rows.select("doc_id", "source", size.alias("size"), key.alias("key")))


def ranked_sources(rows: DataFrame) -> DataFrame:
    """source, source_size, docs and ``sid``, its place by code point from 0, null last; staged.
    Places are counted in range partitions and shifted by the sources of the partitions before."""
    n = max(1, min(tasks_for(rows.sparkSession), 200))
    sums = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("docs"))
    order = F.col("source").asc_nulls_last()
    dealt = stage(sums.repartitionByRange(n, order).withColumn("part", F.spark_partition_id()))
    parts = dealt.groupBy("part").agg(F.count(F.lit(1)).alias("n"))  # one row for each of n partitions
    before = parts.select("part", (F.sum("n").over(W.Window.orderBy("part")) - F.col("n")).alias("before"))
    place = F.row_number().over(W.Window.partitionBy("part").orderBy(order)) - 1
    return stage(dealt.withColumn("place", place).join(before, "part").select("source", "source_size", "docs", (F.col("before") + F.col("place")).alias("sid")))


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """``sources`` with weight and target.  A target is ``level`` times the weight, at most
    ``most`` times the size; every round caps all targets that are above and raises the level."""
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("sid") % len(weights) + 1).cast("int"))
    rows = sources.withColumn("weight", weight.cast("long"))
    cap = F.col("source_size") * most
    level, last = 0.0, None
    while True:
        above = F.col("weight") * F.lit(level) > cap
        got = rows.agg(
            F.sum("source_size").alias("total"), F.count(F.when(above, 1)).alias("capped"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("held"), F.sum(F.when(~above, F.col("weight"))).alias("free"),
        ).first()
        if not got["total"] or not got["free"] or got["capped"] == last:
            break
        last, level = got["capped"], (got["total"] - got["held"]) / got["free"]
    return rows.withColumn("target", F.least(cap.cast("double"), F.col("weight") * F.lit(level)))


# --------------------------------------------------------------------------
# one node of the tree
# --------------------------------------------------------------------------


def pivot(size: list[int], p: list[float], rows: list[int], luck) -> int | None:
    """Round ``p`` at ``rows`` in place, pair by pair; the row that is left, if any.  The sum of
    size * p is kept, and so is every expectation."""
    held = None
    for k in rows:
        if p[k] <= 0.0 or p[k] >= 1.0:
            p[k] = float(p[k] >= 1.0)
            continue
        if held is None:
            held = k
            continue
        a, b = size[held], size[k]
        room, own, other, space = (1.0 - p[held]) * a, p[held] * a, p[k] * b, (1.0 - p[k]) * b
        up, down = min(room, other), min(own, space)  # words to the held row, or from it
        if next(luck) * (up + down) < down:
            full, empty = held if room <= other else None, k if other <= room else None
            p[held], p[k] = p[held] + up / a, p[k] - up / b
        else:
            full, empty = k if space <= own else None, held if own <= space else None
            p[held], p[k] = p[held] - down / a, p[k] + down / b
        if full is not None:
            p[full] = 1.0
        if empty is not None:
            p[empty] = 0.0
        held = next((x for x in (held, k) if x != full and x != empty), None)
    return held


def settle(size: list[int], p: list[float], rows: list[int], luck) -> None:
    """Round the last rows, the largest first: each is paired with all smaller ones together,
    which take or give the words it gains or loses, in proportion to their room or their own.  If
    they can do so both ways, luck decides; if in one way only, that; else what misses less."""
    rows = sorted(rows, key=lambda k: -size[k])
    for n, k in enumerate(rows):
        pool = rows[n + 1 :]
        own = sum(size[j] * p[j] for j in pool)
        room = sum(size[j] for j in pool) - own
        short = (1.0 - p[k]) * size[k] - own  # what the pool lacks if the row is taken
        over = p[k] * size[k] - room  # and what it can't hold if not
        take = next(luck) < p[k] if max(short, over) <= 0 else short < over
        moved = (p[k] - take) * size[k]
        p[k] = float(take)
        for j in pool:
            if moved > 0:
                p[j] = min(1.0, p[j] + (1.0 - p[j]) * moved / room) if room > 0 else p[j]
            elif moved < 0:
                p[j] = max(0.0, p[j] + p[j] * moved / own) if own > 0 else p[j]


def _node(table):
    """All rows of a node: decided (``p`` 0 or 1), or at most ``KEEP`` a size class going up."""
    import pyarrow as pa

    table = table.sort_by([("key", "ascending"), ("doc_id", "ascending"), ("size", "ascending")])
    size, p = table["size"].to_pylist(), table["p"].to_pylist()
    sid, nodes, node = (table[c][0].as_py() for c in ("sid", "nodes", "node"))
    luck = iter(np.random.default_rng([SEED, sid, nodes, node]).random(2 * len(size)).tolist())
    classes: dict[int, list[int]] = {}
    for k, n in enumerate(size):
        classes.setdefault(n.bit_length(), []).append(k)
    for c in sorted(classes, reverse=True):
        pivot(size, p, classes[c][: 1 - KEEP or None], luck)
    if nodes == 1:
        settle(size, p, [k for k, x in enumerate(p) if 0.0 < x < 1.0], luck)
    return table.set_column(table.schema.get_field_index("p"), "p", pa.array(p, pa.float64()))


def rounded(rows: DataFrame, most_docs: int) -> DataFrame:
    """``rows`` (see ``NODE``) with ``p`` 0 or 1, up the tree; ``most_docs``: of the largest source."""
    python_tasks(rows.sparkSession)
    done, nodes = [], max(1, math.ceil(most_docs / LEAF))
    while True:
        out = stage(rows.groupBy("sid", "node").applyInArrow(_node, NODE))
        done.append(out.filter("p IN (0, 1)"))
        if nodes == 1:
            break
        nodes = math.ceil(nodes / FAN)
        up = F.col("nodes")
        rows = out.filter("p NOT IN (0, 1)").withColumn("node", F.expr(f"node DIV {FAN}")).withColumn("nodes", F.ceil(up / FAN)).select(*rows.columns)
    whole = done[0]
    for d in done[1:]:
        whole = whole.union(d)
    return whole


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST, source_col: str = "source") -> DataFrame:
    """doc_id, size, source_size, target, taken (words, repeats counted), source, copies."""
    rows = sized(docs, source_col)
    sources = stage(targets(ranked_sources(rows), weights, most).withColumn("rate", F.coalesce(F.try_divide("target", "source_size"), F.lit(0.0))))
    own = sources.select(F.col("source").alias("of"), "sid", "docs", "rate")
    rate = F.when(F.col("size") > 0, F.col("rate")).otherwise(0.0)
    each = rows.join(own, F.col("source").eqNullSafe(F.col("of"))).select(
        "sid", "key", "doc_id", "size", "docs", F.floor(rate).alias("base"), (rate - F.floor(rate)).alias("p")
    )
    most_docs = sources.agg(F.max("docs")).first()[0] or 0
    nodes = F.ceil(F.col("docs") / LEAF)
    leaves = each.filter("p > 0").select("sid", nodes.alias("nodes"), F.pmod(F.xxhash64("key"), nodes).alias("node"), "key", "doc_id", "size", "p")
    narrow = ["sid", "doc_id", "size", "p"]
    whole = rounded(leaves, most_docs).select(*narrow).union(each.filter("p = 0").select(*narrow))
    copies = F.when(F.col("size") > 0, F.floor("rate") + F.col("p")).otherwise(0).cast("long")
    return whole.join(sources, "sid").select(
        "doc_id", "size", "source_size", "target", (F.col("size") * copies).alias("taken"), "source", copies.alias("copies")
    )
