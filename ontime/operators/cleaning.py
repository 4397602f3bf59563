"""Projection, typing and cleaning operators.

Each operator is one ``select`` / ``filter`` over its input, so a chain of them
collapses into a single projection that Catalyst pushes down to the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.functions.expressions import is_valid_number, to_double
from ontime.schema import COLUMN_ALIASES, FEATURE_COLUMNS, FEATURE_TYPES, LABEL


@dataclass
class Selection:
    """Result of a tolerant select: the frame plus what was asked but absent."""
    df: DataFrame
    present: list[str]
    missing: list[str] = field(default_factory=list)


def select_existing(df: DataFrame, wanted: list[str]) -> Selection:
    """Select the wanted columns that exist, report the others."""
    have = set(df.columns)
    present = [c for c in wanted if c in have]
    missing = [c for c in wanted if c not in have]
    return Selection(df.select(*present), present, missing)


def canonical_names(df: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Rename spelling variants to canonical names.

    A variant is renamed only when the canonical name is not already there.
    """
    aliases = COLUMN_ALIASES if aliases is None else aliases
    have = set(df.columns)
    renames = {v: c for v, c in aliases.items() if v in have and c not in have}
    return df.withColumnsRenamed(renames) if renames else df


def cast_columns(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast the listed columns that exist, in one projection.

    ``try_cast`` turns text that is not a number into null instead of failing
    the job under ANSI mode (D1).  To an integer type, decimal text is cut
    towards zero (``'745.0'`` is 745); out of range is null.
    """
    present = {c: t for c, t in types.items() if c in df.columns}
    if not present:
        return df
    return df.withColumns({c: _cast(c, t) for c, t in present.items()})


def _cast(column: str, kind: str) -> Column:
    x = F.col(column)
    if kind in ("tinyint", "smallint", "int", "bigint"):
        return F.coalesce(x.try_cast(kind), x.try_cast("double").try_cast(kind))
    return x.try_cast(kind)


def typed_features(df: DataFrame, keep_extra: list[str] | None = None) -> Selection:
    """The 14-column feature layer with its cast rules."""
    df = canonical_names(df)
    sel = select_existing(df, FEATURE_COLUMNS + list(keep_extra or []))
    typed = cast_columns(sel.df, FEATURE_TYPES)
    return Selection(typed, sel.present, sel.missing)


def dropna_subset(df: DataFrame, subset: list[str]) -> DataFrame:
    """Drop rows null in any of ``subset``."""
    return df.dropna(how="any", subset=[c for c in subset if c in df.columns])


def dropna_any(df: DataFrame) -> DataFrame:
    """Drop rows null (or NaN) in any column."""
    return df.na.drop(how="any")


def cast_target(df: DataFrame, target: str = LABEL) -> DataFrame:
    """Target text to double, bad values to null (P5)."""
    return df.withColumn(target, to_double(target))


def clean_target(df: DataFrame, target: str = LABEL) -> DataFrame:
    """Cast the target and keep rows where it is a real number."""
    return cast_target(df, target).filter(is_valid_number(target))


def cleaning_report(df: DataFrame, target: str = LABEL) -> DataFrame:
    """Rows before, after and removed by ``clean_target`` in one pass."""
    valid = is_valid_number(to_double(target))
    return (df.agg(F.count(F.lit(1)).alias("rows_before"),
                   F.count_if(valid).alias("rows_after"))
              .withColumn("rows_removed", F.col("rows_before") - F.col("rows_after")))


def not_cancelled(df: DataFrame, column: str = "Cancelled") -> DataFrame:
    """Keep flights that were not cancelled when the column exists."""
    df = canonical_names(df)
    if column not in df.columns:
        return df
    return df.filter(F.col(column) == 0)


def drop_and_rename(df: DataFrame, drop: list[str] | None = None,
                    rename: dict[str, str] | None = None) -> DataFrame:
    """Drop and rename columns that exist."""
    drop = [c for c in (drop or []) if c in df.columns]
    out = df.drop(*drop) if drop else df
    rename = {k: v for k, v in (rename or {}).items() if k in out.columns}
    return out.withColumnsRenamed(rename) if rename else out


def describe_schema(df: DataFrame) -> DataFrame:
    """Schema as a DataFrame of (position, column, type, nullable)."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string, nullable boolean")


def numeric_columns(df: DataFrame, wanted: list[str] | None = None, exclude: list[str] | None = None) -> list[str]:
    """Numeric columns by schema (P18); unknown wanted names are ignored."""
    exclude = set(exclude or [])
    fields = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in exclude]
    names = [f.name for f in fields]
    if wanted is None:
        return names
    keep = set(names)
    return [c for c in wanted if c in keep]


def first_k_features(df: DataFrame, target: str = LABEL, k: int = 8) -> list[str]:
    """The first ``min(k, n-1)`` numeric non-target columns."""
    nums = numeric_columns(df)
    k = min(k, max(len(nums) - 1, 0))
    return [c for c in nums if c != target][:k]
