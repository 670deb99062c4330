import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Names the operators use inside, here as columns of the input.
CLASHING = "row key text_ score shard digest h gram label copies rank size leaf fingerprint id copy cell node".split()
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
    f"`{c}` string" for c in CLASHING
)
LONG = "lorem ipsum dolor sit amet " * 20_000


def rows_of(pairs):
    """Documents rows from (doc_id, text), with a value in every clashing column."""
    return [(i, t, None, f"src{(i or 0) % 3}" if i != 5 else None, len(t or ""), *CLASHING) for i, t in pairs]


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda pairs: spark.createDataFrame(rows_of(pairs), SCHEMA)


@pytest.fixture(scope="session")
def odd_pairs():
    """NULL ids and texts, empty, blank and very long texts, ties and repeated rows."""
    prose = "the quick brown fox jumps over the lazy dog and runs away from all of them at once today " * 4
    return [
        (1, prose),
        (2, prose),
        (2, prose),
        (3, None),
        (4, ""),
        (5, " \t\n "),
        (6, LONG),
        (7, "short"),
        (None, prose),
        (None, None),
        (8, prose.replace("fox", "cat", 1)),
        (9, "Ünïcode wörds and ümläuts: naïve café, 中文字符, emoji 😀 done"),
    ]


@pytest.fixture(scope="session")
def sf_dir():
    return os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
