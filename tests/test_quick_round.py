"""Rounding without decimal arithmetic gives what ``round`` gives, bit for bit."""

from __future__ import annotations

import random
import struct

from pyspark.sql import functions as F

from ontime.functions.expressions import quick_round


def test_equals_round(spark):
    rng = random.Random(3)
    values = [None, 0.0, -0.0, 1e-7, -1e-7, 5e-7, -5e-7, 4.9999999e-7, 1.0000005, -2.6750005, 0.49999999999999994, 999.9999995,
              -999.9999995, 1000.0, 1e15, -1.7e308, 2.0 ** 53 + 2, float("nan"), float("inf"), float("-inf"), 5e-324]
    values += [rng.gauss(0, 1) * 10 ** rng.randrange(-8, 12) for _ in range(5000)]
    values += [(rng.randrange(-3_000_000, 3_000_000) + 0.5) / 1e6 for _ in range(2000)]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    bits = lambda v: None if v is None else struct.pack(">d", v)
    got = rows.select("x", quick_round("x").alias("q"), F.round("x", 6).alias("r")).collect()
    assert len(got) == len(values)
    assert [r["x"] for r in got if bits(r["q"]) != bits(r["r"])] == []
