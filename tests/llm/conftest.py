import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"

#: Nulls in every column, empty and blank texts, ties, repeated rows, clashing columns.
ODD_ROWS = [
    (1, None, None, None, None), (2, "", "en", "s", 0), (3, " \n\t ", None, None, 3), (4, "one two three", "en", "s", 13),
    (4, "one two three", "en", "s", 13), (5, "word " * 30000, "en", "s", 150000), (None, "no id here at all", "en", None, 17),
    (6, "Ünïcödé ñandú \U0001f600 'tis don't I'll  \n\n x", "de", "s", 40), (7, "a" * 5000, "en", "s", 5000),
    (8, "x\x00y    z", "fr", "s", 9),
]
ODD_SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def odd(spark):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(ODD_ROWS, ODD_SCHEMA)
    clashing = ("n_words", "n_hit", "kept", "score", "ids", "spans", "start", "hit", "node", "key", "n", "bytes", "rid",
                "quality", "_text", "_lang", "_bad", "_kept_id", "middle", "wide", "band_lang", "a.b")
    return docs.withColumns({c: F.lit("clash") for c in clashing})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], ODD_SCHEMA)
