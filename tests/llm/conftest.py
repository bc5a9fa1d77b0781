import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size long, shard int"


def sentence(rng, words, n):
    return " ".join(rng.choice(words) for _ in range(n))


@pytest.fixture(scope="session")
def rows():
    """Nulls in every column, empty and long texts, copies, near copies, shared passages, repeated rows."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdeghilmnorstuv") for _ in range(rng.randint(2, 9))) for _ in range(4000)]
    texts = [sentence(rng, words, rng.randint(80, 200)) for _ in range(40)]
    passage = sentence(rng, words, 90)
    out = [(i, t, "en" if i % 2 else "fr", f"src{i % 3}") for i, t in enumerate(texts)]
    out += [(100 + i, texts[i], "en", "src0") for i in range(6)]                         # exact copies
    for i in range(6, 12):                                                                # near copies
        w = texts[i].split()
        w[len(w) // 2] = "edited"
        out.append((100 + i, " ".join(w), "en", "src1"))
    out += [(200 + i, sentence(rng, words, 70) + " " + passage + " " + sentence(rng, words, 60), "fr", "src2") for i in range(5)]
    out += [(300, None, "en", "src0"), (301, "", "fr", "src1"), (302, " \t\n", None, None), (303, "123 456!", "en", None),
            (304, "Été déjà vu, naïve! " * 3, None, "src2"), (None, sentence(rng, words, 60), "en", "src1"),
            (305, sentence(rng, words, 9000), "en", "src2"), (306, "one two three", "en", "src0"),
            (307, "same same " * 300, "fr", "src1")]
    out += [(308, texts[0], "en", "src0")] * 3 + [(300, None, "en", "src0")]              # repeated rows
    return [(d, t, lang, s, None if t is None else len(t), 7, 3) for d, t, lang, s in out]


@pytest.fixture(scope="session")
def docs(spark, rows):
    """The rows with extra columns whose names clash with result columns."""
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def table_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is not None, str(x)) for x in r))
