import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import pytest  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

#: Documents with a column of every awkward kind: nulls, empty and very long texts, ties,
#: repeated rows, and extra columns whose names operators use for themselves.
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _text string, h long, label string"


@pytest.fixture(scope="session")
def awkward(spark):
    def row(doc_id, text, lang="en"):
        return doc_id, text, lang, None, None if text is None else len(text), "clash", 1, None

    prose = "the quick brown fox jumps over the lazy dog and runs on and on "
    texts = [
        None, "", " ", "\n\t ", "a", "1", "@", "+", "x" * 50_000, prose * 2_000, "1" * 20_000, "a@" * 5_000,
        "1.1." * 3_000, "word " * 20_000, prose * 3, prose * 3, prose.upper() * 3, "ÄÖ ß İ Σς ﬁ ½ ² ́é    日本語 🙂",
        "mail bob.x@mail.example.org or +1 (555) 123-4567 from 10.0.0.255 card 4111 1111 1111 1111",
    ]
    rows = [row(i, t) for i, t in enumerate(texts)]
    rows += [row(100, prose), row(100, prose), row(101, None, None), row(102, "été", "fr"), row(103, "", None)]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def make_vectors(spark):
    schema = T.StructType().add("vec_id", "long").add("embedding", T.ArrayType(T.FloatType())).add("label", "integer")

    def make(rows):
        return spark.createDataFrame([(i, v, 0) for i, v in rows], schema)

    return make
