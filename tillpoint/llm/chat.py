"""Chat formatting with a grammar round trip (DataFrame operations only).

The template writes each turn as ``### <role>:\\n<text>\\n</turn>\\n``.  A deterministic parser
(split at the end mark, header up to the first line break, one backslash taken from each
escaped control string, none may stand bare in a text) reads it back.  Each turn is first rendered as it is and
reparsed; where the result differs from the source, its control strings get one
backslash and it is reparsed again; a turn that still differs raises an error.

Edge rules: null text and null role are empty; a null conversation id is one
conversation; turns are ordered by (turn, role, text), nulls first, so ties and repeated
rows have one order; roles may hold anything (``%`` and line breaks are written as
``%25`` and ``%0A``); a conversation without assistant turns has an empty mask.
One conversation is one output string, so it is built in one task by its nature.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import window as W

END = "\n</turn>\n"
#: Control strings of the template: fixed values.
CONTROL_RE = r"(\\*(?:### |</turn>))"
BARE_RE = r"(?<!\\)(### |</turn>)"
ESCAPED_RE = r"\\(\\*(?:### |</turn>))"
LOSS_ROLE = "assistant"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL_RE, r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED_RE, "$1")


def _enc(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A"))


def _dec(role: Column) -> Column:
    return F.replace(F.replace(role, F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def header(role: Column) -> Column:
    return F.concat(F.lit("### "), _enc(role), F.lit(":\n"))


def parse_turn(piece: Column) -> Column:
    """One piece between end marks -> struct(role, text)."""
    cut = F.instr(piece, "\n")
    return F.struct(
        _dec(F.substring(piece, F.lit(5), F.greatest(cut - F.lit(6), F.lit(0)))).alias("role"),
        unescape(F.substring(piece, cut + F.lit(1), F.length(piece))).alias("text"),
    )


def pieces(formatted: Column) -> Column:
    """The parser's first step; what follows the last end mark is empty."""
    p = F.split(formatted, END, -1)
    return F.slice(p, F.lit(1), F.size(p) - F.lit(1))


def reads_as(rendered: Column, role: Column, text: Column) -> Column:
    p = F.split(rendered, END, -1)
    first = F.get(p, F.lit(0))
    one = parse_turn(first)
    body = F.substring(first, F.instr(first, "\n") + F.lit(1), F.length(rendered))
    # a control string without a backslash inside a text is an error of the grammar
    return (F.size(p) == 2) & (one["role"] == role) & (one["text"] == text) & ~body.rlike(BARE_RE)


def format_conversations(rows: DataFrame) -> DataFrame:
    """conv_id, formatted, loss_spans (byte offset and length, and the same in code points)."""
    r = rows.select(
        "conv_id", "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    role, text = F.col("role"), F.col("text")
    r = r.withColumn("head", header(role))
    r = r.withColumn("plain", F.concat("head", text, F.lit(END)))
    r = r.withColumn("body", F.when(reads_as(F.col("plain"), role, text), text).otherwise(escape(text)))
    r = r.withColumn("rendered", F.concat("head", "body", F.lit(END)))
    r = r.withColumn(
        "rendered",
        F.when(reads_as(F.col("rendered"), role, text), F.col("rendered"))
        .otherwise(F.raise_error(F.lit("a turn does not survive the round trip")).cast("string")),
    )
    order = W.Window.partitionBy("conv_id").orderBy(*[F.col(c).asc_nulls_first() for c in ("turn", "role", "text")])
    before = order.rowsBetween(W.Window.unboundedPreceding, -1)
    r = (
        r.withColumn("seq", F.row_number().over(order))
        .withColumn("byte0", F.coalesce(F.sum(F.octet_length("rendered").cast("long")).over(before), F.lit(0).cast("long")))
        .withColumn("char0", F.coalesce(F.sum(F.length("rendered").cast("long")).over(before), F.lit(0).cast("long")))
    )
    part = F.struct(
        "seq", "rendered",
        (F.col("role") == LOSS_ROLE).alias("loss"),
        F.struct(
            (F.col("byte0") + F.octet_length("head")).alias("byte0"), F.octet_length("body").cast("long").alias("bytes"),
            (F.col("char0") + F.length("head")).alias("char0"), F.length("body").cast("long").alias("chars"),
        ).alias("span"),
    )
    g = r.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"))
    return g.select(
        "conv_id",
        F.concat_ws("", F.col("parts.rendered")).alias("formatted"),
        F.transform(F.filter("parts", lambda p: p["loss"]), lambda p: p["span"]).alias("loss_spans"),
    )


def parse(formatted: DataFrame) -> DataFrame:
    """Read formatted conversations back: adds ``turns`` and ``loss_texts`` (by the mask)."""
    out = formatted.withColumn("raw", F.col("formatted").cast("binary"))
    # raw is used twice so that it stays a column and is not built again for each span
    return out.withColumn("raw_bytes", F.octet_length("raw")).select(
        "conv_id", "formatted", "loss_spans", "raw_bytes",
        F.transform(pieces(F.col("formatted")), parse_turn).alias("turns"),
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substring(F.col("raw"), (s["byte0"] + 1).cast("int"), s["bytes"].cast("int")).cast("string")),
        ).alias("loss_texts"),
    )


def conversation_digests(rows: DataFrame) -> DataFrame:
    """The digest of every conversation, read back from its formatted text."""
    p = parse(format_conversations(rows))
    said = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    p = p.withColumn("loss_text", F.concat_ws("", "loss_texts"))
    return p.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.concat_ws("", said).cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def with_hard_case(rows: DataFrame) -> DataFrame:
    """``rows`` plus conversation -7, whose texts hold the template's own control strings."""
    hard = "\\### Assistant: </turn> ok"
    extra = rows.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(hard).alias("text"),
    )
    base = rows.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), "role", "text")
    return base.unionByName(extra)


ORACLE_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, t, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
       CAST(sum(4 + length(replace(replace(role, '%', '%25'), chr(10), '%0A')) + 2 + length(text)
           + len(regexp_extract_all(text, '### |</turn>')) + 9) AS BIGINT) AS formatted_chars
FROM c GROUP BY conv_id
"""
