"""Stages of the pipeline: clashing column names, nothing learned, empty tables, repeated rows."""

from collections import Counter

from pyspark.sql import functions as F

CLASHES = ["_size", "_h", "_pass", "_passes", "_members", "_lid", "_bad_id", "_bad_hash", "_row", "_id", "_hash", "_node", "_many", "n", "d", "a.b"]


def test_columns_of_any_name_pass_through_every_stage(spark, docs):
    import corpus_pipeline as cp
    from tests.conftest import SF_SMALL
    base = docs.drop("size", "shard")
    odd = base.select("*", *[F.lit(f"mine {x}").alias(x) for x in CLASHES])
    for name, stage in cp.STAGES[:-1]:
        plain, got = stage(spark, base, SF_SMALL), stage(spark, odd, SF_SMALL)
        assert got.columns == odd.columns, name
        rows = got.collect()
        assert all(r[x] == f"mine {x}" for r in rows for x in CLASHES), name
        key = [F.col(f"`{x}`") for x in base.columns]
        assert Counter(map(tuple, got.select(*key).collect())) == Counter(map(tuple, plain.collect())), name


def test_nothing_learned_keeps_documents_with_letters(spark):
    from flowlens.llm.langid import known_language
    rows = [(i, f"words of document {i}", None, "s", 1) for i in range(40)] + [(50, "123 !", None, "s", 1), (51, None, None, "s", 1), (52, "ñ", None, None, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    assert {r["doc_id"] for r in known_language(df).collect()} == {*range(40), 52}


def test_every_stage_takes_an_empty_table(spark, no_docs):
    import corpus_pipeline as cp
    from tests.conftest import SF_SMALL
    for name, stage in cp.STAGES:
        assert stage(spark, no_docs.drop("size", "shard"), SF_SMALL).count() == 0, name


def test_near_dedup_keeps_one_of_repeated_rows(spark):
    from flowlens.llm.neardup import deduplicated
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(5, text, "x")] * 3 + [(4, text, "y")] * 2 + [(None, text, "z"), (7, None, "n"), (7, None, "n"), (None, "other text here", "o"), (None, "other text here", "p")]
    df = spark.createDataFrame(rows, "doc_id long, text string, tag string").repartition(4)
    got = Counter((r["doc_id"], r["text"]) for r in deduplicated(df).collect())
    assert got == {(4, text): 1, (7, None): 2, (None, "other text here"): 1}
