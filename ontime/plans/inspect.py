"""Plan inspection through the public ``explain`` output.

Used by tests and by anyone reviewing a query: how many file scans a plan
has, which filters reached the Parquet reader and which partition
directories were pruned.
"""

from __future__ import annotations

import io
import re
from contextlib import redirect_stdout

from pyspark.sql import DataFrame


def plan_text(df: DataFrame, mode: str = "formatted") -> str:
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain(mode=mode)
    return buf.getvalue()


def physical_section(df: DataFrame) -> str:
    """The physical plan of ``explain(extended)`` (AQE's initial plan before execution)."""
    text = plan_text(df, "extended")
    return text.split("== Physical Plan ==", 1)[-1]


def file_scans(df: DataFrame) -> int:
    """Number of file-scan nodes in the physical plan (reused exchanges not counted)."""
    return len(re.findall(r"FileScan \w+", physical_section(df)))


def pushed_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PushedFilters: \[([^\]]*)\]", physical_section(df))


def partition_filters(df: DataFrame) -> list[str]:
    return re.findall(r"PartitionFilters: \[([^\]]*)\]", physical_section(df))


def read_schemas(df: DataFrame) -> list[str]:
    return re.findall(r"ReadSchema: (struct<[^>]*>)", physical_section(df))


def whole_stage_spans(df: DataFrame) -> int:
    """Number of whole-stage-codegen subtrees (``*(n)`` markers).

    Under AQE the markers appear in the final plan, i.e. after an action.
    """
    return len(set(re.findall(r"\*\((\d+)\)", physical_section(df))))
