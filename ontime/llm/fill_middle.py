"""Fill-in-middle transformation by repeated captures.

A document is one match of ``(unit)*``: the ``regex`` library keeps every
repetition of the group, so ``match.ends(1)`` holds the end of each unit.  Its
length is the number of units and two of its entries are the cut offsets; the
text is never walked in Python.  Where to cut and which form to write follow
from a SHA-256 of the document's id, so a document gets the same form on any
layout and in any run.

Texts are handled as bytes decoded with ``surrogateescape``: whatever a string
column holds comes back unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A unit is a line with its line end.
LINE = r"[^\n]*\n|[^\n]+"
# Marks before prefix, suffix and middle.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
#: Per cent of documents that are transformed, and of these that get suffix before prefix.
RATE, SPM_RATE = 100, 50

SCHEMA = "id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output binary"


def cut(text: str, doc_id: str, units: regex.Pattern, seed: int = SEED, rate: int = RATE,
        spm_rate: int = SPM_RATE) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, prefix length, middle length, output) of one text."""
    ends = units.fullmatch(text).ends(1)
    n = len(ends)
    digest = sha256(f"{seed}:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k:k + 8], 16) for k in (0, 8, 16, 24))
    if not text or PREFIX in text or SUFFIX in text or MIDDLE in text or h3 % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
    a, b = ends[low - 1] if low else 0, ends[high - 1] if high else 0
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h4 % 100 < spm_rate:
        return n, "spm", a, b - a, "".join((SUFFIX, suffix, PREFIX, prefix, MIDDLE, middle))
    return n, "psm", a, b - a, "".join((PREFIX, prefix, SUFFIX, suffix, MIDDLE, middle))


def fill_in_middle(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", unit: str = LINE,
                   seed: int = SEED, rate: int = RATE, spm_rate: int = SPM_RATE) -> DataFrame:
    """(id, n, form, prefix_chars, middle_chars, output): one row per input row.

    ``unit`` must split any text without gaps.  A null text is empty; a null id
    hashes like empty digits.  Empty texts and texts that hold a mark stay as
    they are (``plain``, null lengths).  Repeated rows give equal rows, an
    empty table none; other columns are left out, so their names can't clash.
    One row at a time, no shuffle.
    """
    pattern = f"({unit})*"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = regex.compile(pattern)
        schema = pa.schema([("id", pa.int64()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                            ("middle_chars", pa.int64()), ("output", pa.binary())])

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for i, t in zip(batch.column(0), batch.column(1), strict=True):
                i, t = i.as_py(), (t.as_py() or b"").decode("utf-8", "surrogateescape")
                *found, output = cut(t, "" if i is None else str(i), units, seed, rate, spm_rate)
                yield (i, *found, output.encode("utf-8", "surrogateescape"))

        for batch in batches:
            made = rows(batch)
            while some := list(islice(made, 256)):
                yield pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(zip(*some), schema)], schema=schema)

    found = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("binary").alias("t")) \
        .mapInArrow(run, SCHEMA)
    return found.withColumn("output", F.col("output").cast("string")).withColumnRenamed("id", id_column)


def restore(output: str | Column, form: str | Column) -> Column:
    """The text that ``output`` was made of: its parts stand between marks the text itself doesn't hold.

    Split one byte a character, so that texts of any bytes come back as they were.
    """
    out, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(F.decode(out.cast("binary"), "ISO-8859-1"), f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)
    join = lambda *order: F.encode(F.concat(*[F.element_at(parts, i) for i in order]), "ISO-8859-1").cast("string")
    return F.when(form == "psm", join(2, 4, 3)).when(form == "spm", join(3, 4, 2)).otherwise(out)


ORACLE_SQL = r"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
units AS (SELECT *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') AS u FROM docs),
cuts AS (SELECT *, len(u) AS n, t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') AS plain,
  CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(u) + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(u) + 1) AS c2,
  CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 AS spm FROM units),
parts AS (SELECT *, coalesce(array_to_string(u[1:least(c1, c2)], ''), '') AS p,
  coalesce(array_to_string(u[least(c1, c2) + 1:greatest(c1, c2)], ''), '') AS m,
  coalesce(array_to_string(u[greatest(c1, c2) + 1:], ''), '') AS s FROM cuts)
SELECT doc_id, n, CASE WHEN plain THEN 'plain' WHEN spm THEN 'spm' ELSE 'psm' END AS form,
  CASE WHEN NOT plain THEN length(p) END AS prefix_chars, CASE WHEN NOT plain THEN length(m) END AS middle_chars,
  sha256(CASE WHEN plain THEN t WHEN spm THEN '<S>' || s || '<P>' || p || '<M>' || m
    ELSE '<P>' || p || '<S>' || s || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256
FROM parts
"""
