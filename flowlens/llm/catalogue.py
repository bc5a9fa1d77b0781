"""The registered queries of the package and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from flowlens.llm.common import table
from flowlens.llm.decontam import ORACLE as _DECONTAM_SQL

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn
    return deco


@register("op2_mix_sources")
def q_mix(spark, sf_dir):
    from flowlens.llm.mix import op2
    return op2(table(spark, sf_dir, "documents"))


@register("op5_shard_minimax")
def q_shard(spark, sf_dir):
    from flowlens.llm.shards import op5
    return op5(table(spark, sf_dir, "documents"))


@register("op1_language_id")
def q_langid(spark, sf_dir):
    from flowlens.llm.langid import op1
    return op1(table(spark, sf_dir, "documents"))


@register("op9_nearest_neighbours")
def q_ann(spark, sf_dir):
    from flowlens.llm.ann import op9
    return op9(table(spark, sf_dir, "embeddings"))


@register("op6_token_wavelet")
def q_wavelet(spark, sf_dir):
    import public_tokenizers

    from flowlens.llm.wavelet import op6
    return op6(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@register("op10_context_tree_score")
def q_ctw(spark, sf_dir):
    from flowlens.llm.ctw import op10
    return op10(table(spark, sf_dir, "documents"))


@register("op7_decontaminate", _DECONTAM_SQL)
def q_decontam(spark, sf_dir):
    from flowlens.llm.decontam import op7
    return op7(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("op4_near_duplicates")
def q_neardup(spark, sf_dir):
    from flowlens.llm.neardup import op4
    return op4(table(spark, sf_dir, "documents"))


@register("op3_substring_dedup")
def q_pfp(spark, sf_dir):
    from flowlens.llm.pfp import op3
    return op3(table(spark, sf_dir, "documents"))


@register("op8_near_passages")
def q_passages(spark, sf_dir):
    from flowlens.llm.passages import op8
    return op8(table(spark, sf_dir, "documents"))


@register("op11_secret_scan")
def q_secrets(spark, sf_dir):
    from flowlens.llm.novelty import op11
    return op11(table(spark, sf_dir, "documents"))


@register("op12_collocations")
def q_collocations(spark, sf_dir):
    from flowlens.llm.collocations import op12
    return op12(table(spark, sf_dir, "documents"))


@register("op13_spelling_variants")
def q_variants(spark, sf_dir):
    from flowlens.llm.variants import op13
    return op13(table(spark, sf_dir, "documents"))
