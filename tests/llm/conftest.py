import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, key string, shard string, n int, score string"


@pytest.fixture(scope="session")
def docs(spark):
    """Texts with everything that operators must stand: nulls, empties, copies, repeated rows, a long
    text, and columns named as operators' own."""
    words = "the cat sat on a mat and looked at nine birds in one tree by old stone walls near water".split()
    base = " ".join(words * 3)
    rows = [(i, " ".join(words[(i * 7 + j * (i + 3)) % len(words)] + str(i * j % 5) for j in range(30 + i)), "en", f"s{i % 3}") for i in range(20)]
    rows += [(100, None, "en", "s0"), (101, "", None, None), (102, "   \n\t", "en", "s1"), (103, base, "en", "s0"), (104, base, "en", None), (104, base, "en", None), (105, base + " tail", "fr", "s2"), (None, "no id here at all", "en", "s0")]
    rows += [(106, "mail a.b@c.example.com or +1 (415) 555-2671 card 4111 1111 1111 1111 ip 10.0.0.255 and 999.1.1.1 token = \"04dbebab91ab85687d33eeaaf9ac699e1188f962\" end", "en", "s0"), (107, "long " * 40_000 + "END", "en", "s1"), (108, "ÀÉ ß 日本 \U0001f600 O'Reilly's it's", "fr", "s2")]
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), "x", "x", "x", 1, "x") for r in rows], DOCS)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], DOCS)
