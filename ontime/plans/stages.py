"""The reference's stages as lazy, parameterised functions (§3 of the survey).

ETL -> register -> clean -> features -> transformed -> model input.  Each
returns a DataFrame (or writes a layer) and runs no job it does not need:
the reference's before/after counts and previews become ``cleaning_report``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ontime.operators.cleaning import Selection, clean_target, dropna_subset, typed_features
from ontime.operators.ml import add_hours, impute_mean
from ontime.schema import LABEL, PARTITION_KEYS, TRANSFORM_NUMERICS
from ontime.sources.catalog import Candidate, load_first, register_external
from ontime.sources.files import read_csv_typed
from ontime.sources.sinks import write_layer
from ontime.operators.cleaning import cast_columns


def etl_csv_to_parquet(spark: SparkSession, csv_path: str, out_path: str,
                       partition_by: list[str] | None = None) -> list[str]:
    """Stage 1: flight CSV -> Parquet layer, partitioned by Year/Month if present."""
    raw = read_csv_typed(spark, csv_path)
    keys = [k for k in (partition_by or PARTITION_KEYS) if k in raw.columns]
    raw = dropna_subset(raw, keys)
    return write_layer(raw, out_path, keys)


def register_layer(spark: SparkSession, table: str, path: str) -> DataFrame:
    """Stage 2: external table over a layer, partitions recovered."""
    return register_external(spark, table, path)


def load_and_clean(spark: SparkSession, candidates: list[Candidate], target: str = LABEL) -> tuple[DataFrame, Candidate]:
    """Stage 3 entry point (S24): first available source, target typed and cleaned."""
    df, used = load_first(spark, candidates)
    return clean_target(df, target), used


def feature_layer(clean: DataFrame) -> Selection:
    """Stage 4: the typed 14-column feature table (F2)."""
    return typed_features(clean)


@dataclass
class Transformed:
    df: DataFrame
    imputed: list[str]
    dropped_all_null: list[str]


def transformed_layer(features: DataFrame, impute: bool = False, label: str = LABEL,
                      reference_compat: bool = False) -> Transformed:
    """Stage 5: hours added, numerics as double (F3); imputation optional.

    The reference wrote the un-imputed frame (``df_trans``); ``impute=True``
    returns the imputed one it kept in memory, label excluded (D7).
    """
    df = add_hours(cast_columns(features, {c: "double" for c in TRANSFORM_NUMERICS}))
    if not impute:
        return Transformed(df, [], [])
    imp = impute_mean(df, [c for c in TRANSFORM_NUMERICS if c in df.columns], label, reference_compat)
    return Transformed(imp.df, imp.imputed, imp.dropped_all_null)
