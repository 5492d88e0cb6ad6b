import os
import random
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("node", T.IntegerType()),
        T.StructField("score", T.StringType()),
        T.StructField("h", T.StringType()),
        T.StructField("name", T.StringType()),
    ]
)


def prose(seed, words):
    draw = random.Random(seed)
    return " ".join(draw.choice("the of and tion ing ent river stone quiet bank lamp Straße été 12 x-y").strip() + draw.choice("abcdefgh") for _ in range(words))


LONG = prose(1, 40_000)
COPY = prose(2, 120)
NEAR = COPY.split()
NEAR[60] = "changed"
ROWS = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "word"),
    (5, COPY),
    (6, COPY.replace(" ", "  \n")),
    (7, " ".join(NEAR)),
    (8, LONG),
    (9, LONG + " end"),
    (10, "a" * 3000),
    (11, "two words\n\n\nand lines"),
    (12, "漢字 かな 😀 " * 30),
    (13, COPY.upper()),
    (14, "\x00\x01  odd ﻿"),
]
REPEATED = [(5, COPY), (5, "another text under the same id"), (None, COPY), (None, None), (12, ROWS[11][1])]


@pytest.fixture(scope="session")
def make(spark):
    def build(rows, langs=("en", "de", None)):
        filled = [
            (i, text, langs[k % len(langs)], "kept", k, "0.5", "h", None if k % 2 else "n") for k, (i, text) in enumerate(rows)
        ]
        return spark.createDataFrame(filled, SCHEMA)

    return build


@pytest.fixture(scope="session")
def awkward(make):
    return make(ROWS)


@pytest.fixture(scope="session")
def repeated(make):
    return make(ROWS + REPEATED)


@pytest.fixture(scope="session")
def empty(make):
    return make([])


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame(
        [(i, (i + 1) % 2, i % 2) for i in range(1, 13)] + [(None, 1, 1), (3, None, None), (99, 1, 0), (4, 0, 1)],
        "doc_id long, quality int, toxic int",
    )
