"""Declared schemas of the flight layers, column-name variants and cast rules.

The raw layer is an open CSV header; every later layer is fixed here so a
reader never needs ``inferSchema`` (an extra pass over the input) and a
writer never hand-writes DDL.
"""

from __future__ import annotations

from pyspark.sql import types as T

# The 14 feature columns, in the order the feature table uses.
FEATURE_COLUMNS = [
    "Year", "Month", "DayofMonth", "DayOfWeek",
    "DepTime", "CRSDepTime", "ArrTime", "CRSArrTime",
    "DepDelay", "Distance", "Cancelled", "TaxiIn", "TaxiOut", "ArrDelay",
]

# Cast target of each feature column.
FEATURE_TYPES = {
    "Year": "int", "Month": "int", "DayofMonth": "int", "DayOfWeek": "int",
    "DepTime": "int", "CRSDepTime": "int", "ArrTime": "int", "CRSArrTime": "int",
    "DepDelay": "double", "Distance": "double", "Cancelled": "int",
    "TaxiIn": "double", "TaxiOut": "double", "ArrDelay": "double",
}

# Spelling variants seen in flight files, variant -> canonical.
COLUMN_ALIASES = {
    "Canceled": "Cancelled",
    "DayOfMonth": "DayofMonth",
}

# The numeric columns the transform step casts to double and imputes.
TRANSFORM_NUMERICS = ["ArrTime", "DepDelay", "DepTime", "ArrDelay", "Distance", "TaxiIn", "TaxiOut"]

# Model features and label.
MODEL_FEATURES = ["DepDelay", "Distance", "TaxiIn", "TaxiOut", "DepHour", "ArrHour", "DayOfWeek", "Month"]
LABEL = "ArrDelay"

# Partition keys of the written layers.
PARTITION_KEYS = ["Year", "Month"]

# Type names used in the specs above.
_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "smallint": T.ShortType(), "tinyint": T.ByteType(),
    "double": T.DoubleType(), "float": T.FloatType(), "string": T.StringType(), "boolean": T.BooleanType(),
    "date": T.DateType(), "timestamp": T.TimestampType(),
}


def data_type(name: str) -> T.DataType:
    """DataType for a simple type name (``int``, ``double``, ``string`` ...)."""
    try:
        return _TYPES[name.lower()]
    except KeyError:
        raise ValueError(f"unsupported type name {name!r}") from None


def _struct(spec: list[tuple[str, str]]) -> T.StructType:
    return T.StructType([T.StructField(n, data_type(t), True) for n, t in spec])


def raw_schema_typed(extra: list[tuple[str, str]] | None = None) -> T.StructType:
    """Typed raw schema used to read a flight CSV without inference.

    Text tokens such as ``NA`` are turned into nulls by the reader's
    ``nullValue`` option, so numeric columns can be declared numeric.
    """
    spec = [
        ("Year", "int"), ("Month", "int"), ("DayofMonth", "int"), ("DayOfWeek", "int"),
        ("DepTime", "int"), ("CRSDepTime", "int"), ("ArrTime", "int"), ("CRSArrTime", "int"),
        ("DepDelay", "double"), ("ArrDelay", "double"), ("Distance", "double"),
        ("Cancelled", "int"), ("TaxiIn", "double"), ("TaxiOut", "double"),
    ]
    return _struct(spec + list(extra or []))


def transformed_types() -> dict[str, str]:
    """Types of the transformed layer: features, 7 numerics as double, hours as int."""
    types = dict(FEATURE_TYPES)
    types.update({c: "double" for c in TRANSFORM_NUMERICS})
    types.update({"DepHour": "int", "ArrHour": "int"})
    return types
