import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)
# for the Python workers, which start after this
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon".split()


def prose(n, seed=0):
    """n words without repeats of eight in a row."""
    import random

    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + str(rng.randint(0, 999)) for _ in range(n))


#: null and empty texts, blanks, long text, repeated rows, one long word, null id, odd characters
ODD = [(1, None, "a"), (2, "", "b"), (3, " \n\t ", None), (4, prose(20_000, 4), "c"), (5, prose(60, 5), "a"), (5, prose(60, 5), "a"), (6, "x" * 50_000, "d"),
       (None, prose(60, 7), "e"), (7, "é 𝒳 ́ 你好 \x00 end.", "f"), (8, prose(60, 5), "z")]


@pytest.fixture(scope="session")
def odd(spark):
    """Odd documents, with columns whose names clash with results and helpers."""
    df = spark.createDataFrame(ODD, "doc_id long, text string, source string")
    return df.selectExpr("*", "'en' as lang", "cast(length(text) as long) as n_chars", "1 as score", "2 as piece", "3 as kept", "4 as bucket", "5 as `start`", "6 as verdict")


@pytest.fixture(scope="session")
def no_documents(spark):
    return spark.createDataFrame([], "doc_id long, text string, source string, lang string, n_chars long")
