"""Corpus pipeline: language ID, near-dedup, decontamination, mixing, sharding.

``STAGES`` lists (name, function) in order; each function takes
(spark, docs, sf_dir) and returns a DataFrame.  ``run`` writes the result of each
stage as Parquet to the shared folder and reads it again as the next one's
``docs``.  All stages but the last return the columns of ``documents``.

Nulls, empty texts, repeated rows and empty tables are handled as the operator
of each stage states; extra columns of ``docs`` are carried along.
"""

from __future__ import annotations

from flowlens.llm.common import materialize, table


def language(spark, docs, sf_dir):
    """Drop documents without a language: those with no letter at all."""
    from flowlens.llm.langid import known_language
    return known_language(docs)


def near_dedup(spark, docs, sf_dir):
    """Keep one document of each group of near-duplicates."""
    from flowlens.llm.neardup import deduplicated
    return deduplicated(docs)


def decontaminate(spark, docs, sf_dir):
    """Drop documents that contain a benchmark item."""
    from flowlens.llm.decontam import clean_documents
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix(spark, docs, sf_dir):
    """Repeat or drop documents so that the sources come near their target weights."""
    from flowlens.llm.mix import mixed_corpus
    return mixed_corpus(docs)


def shard(spark, docs, sf_dir):
    """Place every document into one of 16 shards of near-equal bytes."""
    from flowlens.llm.shards import op5
    return op5(docs)


STAGES = [("language", language), ("near_dedup", near_dedup), ("decontaminate", decontaminate), ("mix", mix),
          ("shard", shard)]

#: SQL cannot express the stages (trained classifier, seeded hash order); the tests use brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, f"stage-{name}")
    return docs
