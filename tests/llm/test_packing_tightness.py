"""Sequences of the grouped packing against best-fit decreasing over all pieces at once."""

from __future__ import annotations

import random

import pytest

from ontime.llm import bin_completion as B

SIZES = {"uniform": lambda rng: rng.randrange(1, 4096), "two": lambda rng: rng.choice([2500, 1500]),
         "middle": lambda rng: rng.randrange(1000, 3000)}


@pytest.mark.parametrize("kind", SIZES)
def test_groups_need_hardly_more_sequences_than_one_packing_of_all(spark, kind):
    rng = random.Random(9)
    sizes = [SIZES[kind](rng) for _ in range(30_000)]
    rows = [(i, 0, 0, n, 0) for i, n in enumerate(sizes)]
    pieces = spark.createDataFrame(rows, "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")
    assert sum(sizes) / 4096 / B.GROUP_BINS > 20
    out = B.pack(pieces.repartition(4)).select("doc_id", "length", "sequence_id", "offset").toPandas()
    assert sorted(zip(out["doc_id"], out["length"], strict=True)) == list(enumerate(sizes))
    assert out.groupby("sequence_id")["length"].sum().max() <= 4096
    assert out["sequence_id"].nunique() <= 1.002 * len(B.best_fit(sorted(sizes, reverse=True), 4096)) + 1


def test_pieces_are_dealt_evenly(spark):
    pieces = spark.range(10_000).selectExpr("id AS uid", "CAST(1 + id % 7 * (id % 2) AS BIGINT) AS length")
    rows = B.dealt(pieces, 12).toPandas()
    assert sorted(rows["uid"]) == list(range(10_000))
    # Of each length no group has two more than another: ranks of a length follow one another.
    each = rows.groupby(["length", "g"]).size().unstack(fill_value=0)
    assert (each.max(axis=1) - each.min(axis=1)).max() <= 1 and sorted(each.columns) == list(range(12))
