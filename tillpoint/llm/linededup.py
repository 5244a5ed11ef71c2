"""Removal of repeated multi-line chunks with content-defined boundaries (DataFrame operations only).

Lines are hashed; a rolling hash over ``WINDOW`` consecutive line hashes puts a chunk
boundary after a line when it is divisible by ``DIVISOR``, so an inserted line moves only
the boundaries next to it.  Chunks of two or more lines with text are counted over the
whole corpus by a 64-bit fingerprint; those that occur again are compared byte for byte
(grouping by the chunk text itself, copies collapse map-side), the occurrence with the
smallest (id, text fingerprint, position) stays and all others go.

Such chunks depend on the lines around a passage, so most short passages stay.
``remove_repeated_passages`` (the pipeline's) takes the repeated chunks as seeds: the lines of a later
occurrence go as one chunk.  What chunk boundaries cut off is found line by line: every two
successive lines with text that are not both inside a later occurrence are compared in the same
way, those inside the first occurrence of a repeated chunk being known to occur again.  So every
line of a repeated passage of two or more lines with text goes, but for the first occurrence.
There only fingerprints are shuffled to be counted; the texts of those that occur again are then
cut out of their documents and compared.

Edge rules: a null text stays null; a document whose chunks are all repeated ends with the
empty text; blank lines alone never make a removable chunk; rows equal in id and text
get the same decision; a null id is smaller than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillpoint.llm.common import narrow, stage, text_key, text_of

WINDOW = 2
DIVISOR = 3
MIN_LINES = 2


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 7), 16, 10).cast("long")


def split_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, lines, chunks (start, end: line numbers from 0) of every text."""
    d = narrow(docs).filter(F.col("text").isNotNull()).select(
        "doc_id", text_key().alias("tkey"), F.split("text", "\n", -1).alias("lines")
    )
    d = d.withColumn("h", F.transform("lines", line_hash))
    rolled = lambda i: F.pmod(F.get("h", i - 2) * F.lit(31) + F.get("h", i - 1), F.lit(DIVISOR)) == 0
    d = d.withColumn(
        "ends",
        F.filter(
            F.sequence(F.lit(1), F.size("lines")),
            lambda i: (i == F.size("h")) | ((i >= WINDOW) & rolled(i)),
        ),
    )
    return d.withColumn(
        "chunks",
        F.transform(
            "ends",
            lambda e, k: F.struct(F.coalesce(F.get("ends", k - 1), F.lit(0)).alias("start"), e.alias("end")),
        ),
    ).drop("h", "ends")


def full_lines(lines: Column | str) -> Column:
    """Numbers of the lines with text."""
    lines = F.col(lines) if isinstance(lines, str) else lines
    return F.filter(F.sequence(F.lit(0), F.size(lines) - 1), lambda i: F.length(F.trim(F.get(lines, i))) > 0)


def chunked(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, start (line number from 0), n, ctext of every chunk that may be removed; head, body:
    its lines before the first one with text, and those from there to the last one with text."""
    # explode_outer: explode would push a filter on the whole chunk expression below the scan
    d = split_lines(docs)
    c = d.select("doc_id", "tkey", "lines", F.explode_outer("chunks").alias("c")).filter(F.col("c.end") - F.col("c.start") >= MIN_LINES)
    part = F.slice("lines", F.col("c.start") + F.lit(1), F.col("c.end") - F.col("c.start"))
    return (
        c.withColumn("part", part).withColumn("full", full_lines("part"))
        .filter(F.size("full") >= MIN_LINES)
        .select(
            "doc_id", "tkey", F.col("c.start").alias("start"), F.size("part").alias("n"),
            F.concat_ws("\n", "part").alias("ctext"),
            F.get("full", F.lit(0)).alias("head"), (F.get("full", F.size("full") - 1) - F.get("full", F.lit(0)) + 1).alias("body"),
        )
    )


def line_pairs(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, start, n, ctext of every two successive lines with text (and the blank lines between
    them); inside: the start of the chunk that holds both, null if a boundary parts them."""
    d = split_lines(docs)
    # of each line the start of its chunk
    of = F.flatten(F.transform("chunks", lambda c: F.array_repeat(c["start"], c["end"] - c["start"])))
    d = d.withColumn("of", of).withColumn("full", full_lines("lines"))
    pairs = F.transform(
        F.slice("full", F.lit(1), F.greatest(F.size("full") - 1, F.lit(0))),
        lambda i, k: F.struct(i.alias("a"), F.get("full", k + 1).alias("b")),
    )
    inside = lambda x: F.when(F.get("of", x["a"]) == F.get("of", x["b"]), F.get("of", x["a"]))
    pairs = F.transform(
        pairs,
        lambda x: F.struct(
            x["a"].alias("start"),
            (x["b"] - x["a"] + 1).alias("n"),
            F.concat_ws("\n", F.slice("lines", x["a"] + 1, x["b"] - x["a"] + 1)).alias("ctext"),
            inside(x).alias("inside"),
        ),
    )
    return d.select("doc_id", "tkey", F.explode_outer(pairs).alias("c")).filter("c is not null").select("doc_id", "tkey", "c.*")


def occurrences(chunks: DataFrame) -> DataFrame:
    """doc_id, tkey, start, n, is_first of every occurrence of a chunk that occurs again."""
    chunks = chunks.withColumn("fp", F.xxhash64("ctext"))
    again = chunks.groupBy("fp").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("fp")
    # rows with equal fingerprints, staged: both the comparison and the marking read them
    same = stage(chunks.join(again, "fp", "left_semi"))
    first = F.min(F.struct("doc_id", "tkey", "start"))
    verified = same.groupBy("fp", "ctext").agg(first.alias("first"), F.count(F.lit(1)).alias("c"))
    # nearly always one text per fingerprint; only fingerprints with several keep their texts
    texts = verified.groupBy("fp").agg(F.count(F.lit(1)).alias("texts"))
    verified = verified.join(texts, "fp").filter("c > 1").select(
        "fp", "first", F.when(F.col("texts") > 1, F.col("ctext")).alias("only_text")
    )
    v = verified.withColumnRenamed("fp", "vfp")
    hit = same.join(
        v, (same["fp"] == v["vfp"]) & (v["only_text"].isNull() | (v["only_text"] == same["ctext"]))
    )
    own = F.struct("doc_id", "tkey", "start")
    return hit.select("doc_id", "tkey", "start", "n", own.eqNullSafe(F.col("first")).alias("is_first"))


def _of_row(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
    """``left`` with the columns that ``right`` has of the same document."""
    r = right.withColumnsRenamed({"doc_id": "__id", "tkey": "__key"})
    return left.join(r, left["doc_id"].eqNullSafe(r["__id"]) & (left["tkey"] == r["__key"]), how).drop("__id", "__key")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, whole (a chunk, else a pair of lines), start, n, head, body, inside, fp of every
    chunk (``chunked``) and pair (``line_pairs``), without their texts."""
    fp, none = F.xxhash64("ctext").alias("fp"), F.lit(None).cast("int")
    chunks = chunked(docs).select("doc_id", "tkey", F.lit(True).alias("whole"), "start", "n", "head", "body", none.alias("inside"), fp)
    pairs = line_pairs(docs).select("doc_id", "tkey", F.lit(False).alias("whole"), "start", "n", none.alias("head"), none.alias("body"), "inside", fp)
    return chunks.unionByName(pairs)


def compared(docs: DataFrame) -> DataFrame:
    """The ``fingerprints`` that occur again, staged; only_text: their text if the fingerprint has
    several.  So rows are copies if and only if fp and only_text are equal.

    Texts are read only where a fingerprint occurs again: the places go to their documents,
    which cut them out, and the texts of each fingerprint are compared byte for byte."""
    rows = fingerprints(docs)
    again = rows.groupBy("whole", "fp").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select("whole", "fp")
    place = F.struct("whole", "start", "n", "head", "body", "inside", "fp")
    places = rows.join(again, ["whole", "fp"], "left_semi").groupBy("doc_id", "tkey").agg(F.collect_set(place).alias("places"))
    d = narrow(docs).filter(F.col("text").isNotNull()).select("doc_id", text_key().alias("tkey"), "text")
    found = _of_row(d, places, "inner").withColumn("lines", F.split("text", "\n", -1))
    found = found.select("doc_id", "tkey", "lines", F.explode("places").alias("p"))
    part = F.slice("lines", F.col("p.start") + F.lit(1), F.col("p.n"))
    found = stage(found.select("doc_id", "tkey", "p.*", F.concat_ws("\n", part).alias("ctext")))
    several = found.select("whole", "fp", "ctext").distinct().groupBy("whole", "fp").agg(F.count(F.lit(1)).alias("texts")).filter("texts > 1")
    # broadcast: n texts have about n * n / 2^65 fingerprints with two of them
    found = found.join(F.broadcast(several), ["whole", "fp"], "left")
    return stage(found.withColumn("only_text", F.when(F.col("texts") > 1, F.col("ctext"))).drop("ctext", "texts"))


def paired(pairs: DataFrame, seeds: DataFrame) -> DataFrame:
    """``pairs`` but those inside a later occurrence of a repeated chunk; again: they are inside its first
    one.  ``seeds``: doc_id, tkey, first and later (starts of such chunks)."""
    has = lambda c: F.coalesce(F.array_contains(c, F.col("inside")), F.lit(False))
    return _of_row(pairs, seeds, "left").filter(~has("later")).withColumn("again", has("first")).drop("first", "later")


def first_ones(rows: DataFrame) -> DataFrame:
    """Those ``compared`` rows that have copies among ``rows`` or occur ``again``; is_first: the first of them."""
    own = F.struct("doc_id", "tkey", "start")
    groups = rows.groupBy("fp", "only_text").agg(F.min(own).alias("first"), F.sum(F.lit(1) + F.col("again").cast("int")).alias("c"))
    g = groups.filter("c > 1").select(F.col("fp").alias("__fp"), F.col("only_text").alias("__text"), "first")
    hit = rows.join(g, (rows["fp"] == g["__fp"]) & rows["only_text"].eqNullSafe(g["__text"]))
    return hit.withColumn("is_first", own.eqNullSafe(F.col("first"))).drop("__fp", "__text", "first")


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, start, n of every chunk occurrence to remove."""
    return occurrences(chunked(docs)).filter(~F.col("is_first")).drop("is_first")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, tkey, start, n (1) of every line of a passage that occurs earlier: the lines of later
    occurrences of chunks and of pairs of lines, but those of a pair's first occurrence."""
    rows = compared(docs)
    chunks = stage(first_ones(rows.filter("whole").withColumn("again", F.lit(False))))
    seeds = chunks.groupBy("doc_id", "tkey").agg(
        F.collect_set(F.when(F.col("is_first"), F.col("start"))).alias("first"), F.collect_set(F.when(~F.col("is_first"), F.col("start"))).alias("later")
    )
    pairs = first_ones(paired(rows.filter("not whole"), seeds)).select("doc_id", "tkey", "start", "n", "is_first")
    copies = chunks.filter(~F.col("is_first")).select("doc_id", "tkey", (F.col("start") + F.col("head")).alias("start"), F.col("body").alias("n"), "is_first")
    span = lambda x: F.sequence(x["start"], x["start"] + x["n"] - 1)
    lines = lambda c: F.flatten(F.transform(c, span))
    own = F.struct("start", "n")
    by_doc = pairs.unionByName(copies).groupBy("doc_id", "tkey").agg(
        F.collect_set(F.when(~F.col("is_first"), own)).alias("later"), F.collect_set(F.when(F.col("is_first"), own)).alias("first")
    )
    return by_doc.select("doc_id", "tkey", F.explode(F.array_except(lines("later"), lines("first"))).alias("start"), F.lit(1).alias("n"))


def remove_repeated_chunks(docs: DataFrame) -> DataFrame:
    """``docs`` with the text changed, plus __lines and __removed (line counts)."""
    return _without(docs, repeated_chunks(docs))


def remove_repeated_passages(docs: DataFrame) -> DataFrame:
    """As ``remove_repeated_chunks``, of all passages of two or more lines with text."""
    return _without(docs, repeated_lines(docs))


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    gone = gone.groupBy("doc_id", "tkey").agg(
        F.sort_array(F.collect_set(F.struct("start", "n"))).alias("__gone")
    )
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("tkey").alias("__key"), "__gone")
    d = docs.withColumn("__tkey", text_key())
    d = d.join(gone, d["doc_id"].cast("long").eqNullSafe(gone["__id"]) & (d["__tkey"] == gone["__key"]), "left")
    lines = F.split("text", "\n", -1)
    d = d.withColumn("__all", lines)
    # the lines between removed chunks, chunk by chunk
    kept = F.flatten(
        F.transform(
            F.sequence(F.lit(0), F.size("__gone")),
            lambda k: F.slice(
                F.col("__all"),
                F.coalesce(F.get("__gone", k - 1)["start"] + F.get("__gone", k - 1)["n"], F.lit(0)) + F.lit(1),
                F.coalesce(F.get("__gone", k)["start"], F.size("__all"))
                - F.coalesce(F.get("__gone", k - 1)["start"] + F.get("__gone", k - 1)["n"], F.lit(0)),
            ),
        )
    )
    return d.withColumns(
        {
            "__lines": F.coalesce(F.size("__all"), F.lit(0)).cast("long"),
            "__removed": F.coalesce(
                F.aggregate("__gone", F.lit(0), lambda a, x: a + x["n"]), F.lit(0)
            ).cast("long"),
            "text": F.when(F.col("__gone").isNull(), F.col("text")).otherwise(F.concat_ws("\n", kept)),
        }
    ).drop("__tkey", "__id", "__key", "__gone", "__all")


def deduplicated_lines(docs: DataFrame) -> DataFrame:
    """doc_id, text, n_lines, n_removed of every document."""
    out = remove_repeated_chunks(docs.select("doc_id", "text"))
    return out.select("doc_id", "text", F.col("__lines").alias("n_lines"), F.col("__removed").alias("n_removed"))


ORACLE_SQL = """
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i
  FROM documents WHERE text IS NOT NULL
), h AS (
  SELECT *, CAST('0x' || substr(md5(line), 1, 7) AS BIGINT) AS h FROM l
), e AS (
  SELECT *, CASE WHEN i >= 2 AND (lag(h) OVER w * 31 + h) % 3 = 0 THEN 1 ELSE 0 END AS ends
  FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)
), k AS (
  SELECT *, coalesce(sum(ends) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk
  FROM e
), c AS (
  SELECT doc_id, chunk, min(i) AS start, string_agg(line, chr(10) ORDER BY i) AS ctext,
         count(*) FILTER (WHERE length(trim(line)) > 0) AS full_lines
  FROM k GROUP BY doc_id, chunk
), r AS (
  SELECT *, row_number() OVER (PARTITION BY md5(ctext), ctext ORDER BY doc_id, start) AS rn FROM c WHERE full_lines >= 2
), g AS (
  SELECT k.doc_id, k.i, k.line, coalesce(r.rn, 1) > 1 AS gone
  FROM k LEFT JOIN r ON k.doc_id = r.doc_id AND k.chunk = r.chunk
)
SELECT doc_id, coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '') AS text,
       count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed
FROM g GROUP BY doc_id
UNION ALL
SELECT doc_id, NULL, 0, 0 FROM documents WHERE text IS NULL
"""
