import random

import pytest

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, size long, row string, key string, "
          "digest string, label string, kept string, score string, node long, bucket string")


def words(n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 7))) for _ in range(n))


@pytest.fixture
def frame(spark):
    """Documents with columns whose names operators use inside, from (doc_id, text, source) rows."""
    def make(rows):
        return spark.createDataFrame([(d, t, None, s, None, 1, "r", None, "x", "y", "z", None, 7, "b") for d, t, s in rows], SCHEMA)
    return make


@pytest.fixture
def edge_rows():
    base = words(300, 1)
    near = base.split()
    near[100] = "changed"
    return [
        (1, base, "a"), (2, base, "b"), (2, base, "b"),          # copies; a row repeated
        (3, " ".join(near), "a"), (4, None, None), (5, "", "c"),  # a near copy; null and empty texts
        (6, "   \n\t ", "c"), (7, "one", "a"), (8, "one", None),  # white space; single words
        (9, words(20_000, 2), "é"), (None, "no id here", "a"), (None, None, None),
        (10, "x" * 50_000, "b"), (11, "a b " * 4000, "b"), (12, words(120, 3) + " " + base, "a"),
        (13, "ONE", "a"), (14, "line one\nline two\nline one", "d")]
