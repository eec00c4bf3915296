import re

import pytest

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, id long, key string, n int, label int, size long, rank int, row string, h double"


def words(text):
    return WORD.findall(text or "")


def sentence(rng, n, vocabulary=400):
    return " ".join("w" + "".join(chr(97 + int(c) % 26) for c in str(rng.randrange(vocabulary) * 7919)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls in any column, empty and blank and long texts, odd characters, ties, repeated rows, clashing names."""
    import random

    rng = random.Random(5)
    long = sentence(rng, 30_000)
    texts = ["", None, " \n\t ", "a", "A b", "é ünï x y ́z", "the quick <|endoftext|> it's", "x" * 3000, "ab " * 400, sentence(rng, 300) + "\n" + sentence(rng, 80), long, "1\n\n2\n", "\x00\x1c odd", "\U0001f600 🎉", "İ H̱ ǅ ſ K"]
    rows = [(k, t, "en", f"s{k % 4}", len(t or "")) for k, t in enumerate(texts)]
    rows += [(None, "no id", None, None, None), (None, None, None, None, None), (3, "a", "en", "s3", 1), (3, "a", "en", "s3", 1), (40, texts[9], None, None, 5), (41, texts[9], "fr", "s1", 5), (-7, "minus", "de", "", 5)]
    return spark.createDataFrame([(*r, 1, "k", 2, 0, 3, 4, "r", 0.5) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def marks(spark):
    return spark.createDataFrame([(0, 1, 0), (3, 0, 1), (9, 1, 0), (9, 0, 0), (10, 1, None), (None, 1, 0), (12, None, 0)], "doc_id long, quality int, toxic int")
