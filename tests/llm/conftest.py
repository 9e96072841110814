"""Small fixtures with everything an operator must stand: nulls, blanks, repeats, long texts, clashing columns."""

import random

import pytest

CLASHES = ("size place hash key shard slot score kept text_hash fp root a b first count word bits removed n_near "
           "n_words class containment item_id target drawn before").split()


def documents(spark, rows):
    """A documents table from (doc_id, text, source), with extra columns that clash with names used inside."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    full = [(d, t, "en", s, None if t is None else len(t)) + tuple(f"x{i}" for i in range(len(CLASHES))) for d, t, s in rows]
    return spark.createDataFrame(full, schema)


def sample_rows():
    rng = random.Random(11)
    words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7))) for _ in range(60)]

    def prose(n):
        return " ".join(rng.choice(words).capitalize() if rng.random() < 0.1 else rng.choice(words) for _ in range(n))

    base = prose(70)
    rows = [(i, prose(rng.randint(1, 90)), f"s{i % 4}") for i in range(40)]
    rows += [(100 + i, base, "hot") for i in range(30)]                                   # a third: one group of copies
    rows += [(200 + i, base.replace(words[i], "zz"), "hot") for i in range(6)]             # near copies
    rows += [(300, None, None), (301, "", ""), (302, " \t\n ", "s1"), (303, "one", "s1"), (304, "one two", None)]
    rows += [(None, base, "s2"), (None, base, "s2"), (None, prose(20), None), (5, prose(30), "s1"), (6, base, "s3"), (6, base, "s3")]
    rows += [(400, "\n".join([prose(12), "same line here", "same line here", prose(3)] * 3), "s0"), (401, "x" * 3000, "s0")]
    rows += [(402, prose(4000), "s2"), (403, "tab\tand  two spaces nbsp   wide\x1cfs ", "s3"), (404, "😀".encode("utf-16", "surrogatepass").decode("utf-16") + " a" * 40, "s3")]
    return rows


@pytest.fixture(scope="module")
def rows():
    return sample_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return documents(spark, rows).repartition(3).cache()


@pytest.fixture(scope="module")
def none(spark):
    return documents(spark, [])
