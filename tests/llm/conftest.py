from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent))

from llm_rows import CLASHES, SCHEMA, corpus, odd_rows  # noqa: E402


@pytest.fixture(scope="session")
def rows():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def odd(spark, rows):
    """Odd rows among others, with extra columns of clashing names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows[:40] + odd_rows(), SCHEMA)
    return df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES}).cache()


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark, rows):
    long = next(r[1] for r in rows if len(r[1].split()) > 100)
    texts = [(1, " ".join(long.split()[20:60])), (2, "Twice twice TWICE"), (10, None), (11, ""), (12, " ".join(long.split()[5:10])), (None, " ".join(long.split()[70:90])), (2, "Twice twice TWICE"), (13, "東京")]
    return spark.createDataFrame(texts, "item_id bigint, text string")


@pytest.fixture(scope="session")
def labels(spark, rows):
    values = [(r[0], i % 2, int(i % 5 == 0)) for i, r in enumerate(rows)] + [(None, 1, 1), (999, None, None), (rows[0][0], 0, 1)]
    return spark.createDataFrame(values, "doc_id bigint, quality int, toxic int")
