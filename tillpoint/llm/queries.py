"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tillpoint.llm import alignment, chat, decontaminate, linededup, lm, mixing, neardup, output, packing, quality, repeats, search, sharding
from tillpoint.llm.common import documents, table

Query = Callable[[SparkSession, str], DataFrame]


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # at the repository's top, beside __spark_entry__

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    "op1_virtual_slot_shards": lambda s, d: sharding.sharded_documents(documents(s, d)),
    "op2_line_chunk_dedup": lambda s, d: linededup.deduplicated_lines(documents(s, d)),
    "op3_edit_decontamination": lambda s, d: decontaminate.leaked_pairs(documents(s, d), table(s, d, "benchmark")),
    "op4_chat_round_trip": lambda s, d: chat.conversation_digests(chat.with_hard_case(table(s, d, "conversations"))),
    "op5_minmax_near_dedup": lambda s, d: neardup.components_of_documents(documents(s, d)),
    "op6_token_blocks": lambda s, d: output.token_files(documents(s, d)),
    "op7_suffix_repeats": lambda s, d: repeats.repeats_of_documents(documents(s, d)),
    "op8_lexical_packing": lambda s, d: packing.packed(documents(s, d)),
    "op9_decision_list": lambda s, d: quality.quality_verdicts(documents(s, d), table(s, d, "labels")),
    "op10_context_mixing": lambda s, d: lm.score(documents(s, d)),
    "op11_diagonal_alignment": lambda s, d: alignment.aligned(documents(s, d)),
    "op12_pivotal_mix": lambda s, d: mixing.mixed(documents(s, d)),
    "op13_geometric_search": lambda s, d: search.ranked(documents(s, d), table(s, d, "benchmark")),
    "pipeline": pipeline,
}

ORACLES: dict[str, str] = {
    "op2_line_chunk_dedup": linededup.ORACLE_SQL,
    "op4_chat_round_trip": chat.ORACLE_SQL,
    "op13_geometric_search": search.ORACLE_SQL,
}
