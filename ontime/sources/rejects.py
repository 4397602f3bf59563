"""CSV with a reject table: lines that don't fit the declared schema are kept, with file and reason.

``read_csv_typed`` turns a malformed value into null.  Here each line is read
as text once, parsed and checked against the schema, and one write puts fitting
rows and rejected lines side by side: accepted + rejected = lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ontime.operators.cleaning import cast_columns
from ontime.sources.files import DEFAULT_NULL_TOKEN
from ontime.sources.sinks import write_layer

#: Columns a checked line has beside its own; they take these names only if the schema doesn't.
FILE, LINE, REASONS = "_file", "_line", "_reasons"
STATUS, ACCEPTED, REJECTED = "_status", "accepted", "rejected"


def read_csv_checked(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",",
                     null_value: str = DEFAULT_NULL_TOKEN, header: bool = True, lenient: tuple[str, ...] = ()) -> DataFrame:
    """Each line's typed columns, its file, text and reasons (none: the line fits).

    A reason is ``column: text`` for a value that isn't of its type, ``fields``
    for a line with another number of fields, ``required: column`` for a missing
    value of a column that the schema declares not null.  Values of ``lenient``
    columns become null instead.  Decimal text fits an integer column (cut
    towards zero), as in ``read_csv_typed``.  Lines equal to the header are
    dropped, empty lines too; a record must be one line.
    """
    names = schema.fieldNames()
    clash = {FILE, LINE, REASONS, STATUS} & set(names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are taken")
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias(FILE), F.col("value").alias(LINE))
    lines = lines.filter(F.trim(LINE) != "")
    if header:
        lines = lines.filter(F.col(LINE) != F.lit(sep.join(names)))
    broken = "_broken"
    text = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))] + [T.StructField(broken, T.StringType())])
    options = {"sep": sep, "nullValue": null_value, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": broken}
    parsed = lines.withColumn("_p", F.from_csv(LINE, text.simpleString().removeprefix("struct<").removesuffix(">")
                                               .replace(":", " "), options))
    raw = parsed.select(FILE, LINE, F.col(f"_p.{broken}").isNotNull().alias("_odd"),
                        *[F.col(f"_p.c{i}").alias(f"_t{i}") for i in range(len(names))],
                        *[F.col(f"_p.c{i}").alias(f"_v{i}") for i in range(len(names))])
    typed = cast_columns(raw, {f"_v{i}": f.dataType.simpleString() for i, f in enumerate(schema.fields)})
    reasons: list[Column] = [F.when(F.col("_odd"), F.lit("fields"))]
    for i, f in enumerate(schema.fields):
        there = F.col(f"_t{i}").isNotNull()
        if f.name not in lenient:
            reasons.append(F.when(~F.col("_odd") & there & F.col(f"_v{i}").isNull(), F.concat(F.lit(f"{f.name}: "), f"_t{i}")))
        if not f.nullable:
            reasons.append(F.when(~F.col("_odd") & ~there, F.lit(f"required: {f.name}")))
    return typed.select(*[F.col(f"_v{i}").alias(c) for i, c in enumerate(names)], FILE, LINE,
                        F.array_compact(F.array(*reasons)).alias(REASONS))


@dataclass(frozen=True)
class Ingested:
    """What ``ingest_csv`` wrote: accepted rows in their schema, and rejected lines (file, line, reasons)."""
    accepted: DataFrame
    rejected: DataFrame


def ingest_csv(spark: SparkSession, csv: str, out: str, schema: T.StructType, partition_by: list[str] | None = None,
               **options) -> Ingested:
    """Read ``csv`` once and write accepted rows and rejected lines in the same pass, under ``out``.

    A row counts as accepted or rejected, never both; accepted rows are
    partitioned by ``partition_by`` as in ``write_layer``.
    """
    rows = read_csv_checked(spark, csv, schema, **options)
    bad = F.size(REASONS) > 0
    names = schema.fieldNames()
    # A rejected line keeps its text only; an accepted row its columns only.
    out_rows = rows.select(*[F.when(~bad, F.col(c)).alias(c) for c in names], F.when(bad, F.col(FILE)).alias(FILE),
                           F.when(bad, F.col(LINE)).alias(LINE), F.when(bad, F.col(REASONS)).alias(REASONS),
                           F.when(bad, REJECTED).otherwise(ACCEPTED).alias(STATUS))
    keys = [c for c in partition_by or [] if c in names]
    write_layer(out_rows, out, [STATUS, *keys])
    everything = spark.read.schema(out_rows.schema).parquet(out)
    return Ingested(everything.filter(F.col(STATUS) == ACCEPTED).select(*names),
                    everything.filter(F.col(STATUS) == REJECTED).select(
                        F.col(FILE).alias("file"), F.col(LINE).alias("line"), F.col(REASONS).alias("reasons")))
