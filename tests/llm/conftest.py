import os

import pytest
from pyspark.sql import types as T

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

#: Columns that clash with names the operators use inside.
EXTRA = ["key", "row", "id", "n", "bucket", "h", "size", "node", "rec", "n_chars"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with extra columns that clash."""
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())] + [T.StructField(c, T.LongType()) for c in EXTRA]
    )

    def make(pairs):
        return spark.createDataFrame([(i, t, *[None if k % 3 else k for k in range(len(EXTRA))]) for i, t in pairs], schema)

    return make


@pytest.fixture(scope="session")
def documents(spark):
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables here")
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


_WORDS = "the quick brown fox jumps over one lazy dog and then some other animal comes along to see what is going on".split()


def prose(seed, n):
    """n words that depend on the seed."""
    return " ".join(_WORDS[(seed * 7 + k * k + k * seed) % len(_WORDS)] + str((seed * 31 + k) % 97) for k in range(n))


PASSAGE = prose(3, 60)
#: NULLs, empty and wordless texts, repeated rows, ties, copies, a shared passage, a very long text.
EDGES = [
    (None, None), (None, "lonely row without an id"), (1, None), (2, ""), (3, " \n\t"), (4, "One two"), (5, "one TWO"), (6, "one two"), (6, "one two"),
    (7, prose(1, 80)), (8, prose(1, 80)), (9, prose(1, 79) + " other"), (10, prose(2, 30) + " " + PASSAGE), (11, PASSAGE + "\n" + prose(4, 30)),
    (12, "word " * 300), (13, prose(5, 20_000)), (14, "é😀 " * 40), (None, prose(1, 80)), (15, prose(1, 80).upper()),
]
