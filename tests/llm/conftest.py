"""Fixtures of the text operators' tests: small tables with the awkward rows."""

from __future__ import annotations

import os
import sys

import pytest
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from llm_rows import AWKWARD_ROWS  # noqa: E402

DOCUMENTS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                          T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                          T.StructField("n_chars", T.LongType())])


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text) pairs; source and lang may follow."""

    def make(rows, parts=3):
        full = [(r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "src0",
                 len(r[1]) if r[1] is not None else None) for r in rows]
        df = spark.createDataFrame(full, DOCUMENTS)
        return df.repartition(parts) if full else df

    return make


@pytest.fixture(scope="session")
def awkward(make_docs):
    return make_docs(AWKWARD_ROWS)
