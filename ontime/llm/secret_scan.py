"""Secret scan with corpus-wide ownership frequency; DataFrame and SQL functions only.

1. ``find_spans``: three kinds of candidate spans per document, found by
   regular expressions; positions come from the lengths of the pieces between
   matches.
2. ``ownership``: each candidate value is hashed (values themselves are never
   written); distinct (hash, owner, repository) triples are folded in two
   steps, so a value pasted into a third of the corpus is counted map-side.
3. A value seen with ``EXAMPLE_OWNERS`` or more owners is a widely copied
   example; one that few owners share and that looks random is a live-looking
   credential.  Both add a span of the value to the document's spans.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ontime.llm.common import materialize, text_or_empty

# Patterns, least lengths and kinds of the contract.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
          r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = "AKIA[A-Z0-9]+"
# A run of at least 24 is the leftmost match of [0-9a-f]+ that passes: matches are whole runs.
HEX = "[0-9a-f]{24,}"
KINDS = ["assign", "access", "hex", "example", "live"]
LEAST_VALUE = 6
LEAST_ACCESS = 20

#: Distinct owners from which a value is an example; distinct characters from which it looks random.
EXAMPLE_OWNERS = 3
LIVE_CHARACTERS = 6


def _spans(kind: str, pattern: str, group: int) -> Column:
    """Array of (kind, start, end, value) from a kind's matches and the pieces before them."""
    return F.transform(
        F.aggregate(
            F.arrays_zip(F.col(f"{kind}_m").alias("m"), F.col(f"{kind}_p").alias("p")),
            F.array().cast("array<struct<e:bigint,m:string>>"),
            lambda acc, x: F.concat(acc, F.array(F.struct(
                (F.coalesce(F.try_element_at(acc, F.lit(-1))["e"], F.lit(0).cast("bigint"))
                 + F.length(x["p"]) + F.length(x["m"])).cast("bigint").alias("e"), x["m"].alias("m"))))),
        lambda x: F.struct(F.lit(kind).alias("kind"), (x["e"] - F.length(x["m"])).cast("bigint").alias("start"),
                           x["e"].alias("end"), F.regexp_extract(x["m"], pattern, group).alias("value")))


def _long_enough(least: int) -> Callable[[Column], Column]:
    return lambda span: F.length(span["value"]) >= least


def find_spans(docs: DataFrame, text_column: str = "text") -> DataFrame:
    """Adds ``base``: array of (kind, start, end, value), code points, end exclusive, in no set order."""
    out = docs.withColumn("_t", text_or_empty(text_column))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    for kind, pattern in patterns.items():
        # All but the last piece stand before a match.
        out = out.withColumn(f"{kind}_m", F.regexp_extract_all("_t", F.lit(pattern), F.lit(0)))
        out = out.withColumn(f"{kind}_p", F.when(F.size(f"{kind}_m") > 0, F.slice(
            F.split("_t", pattern, -1), F.lit(1), F.size(f"{kind}_m"))).otherwise(F.array().cast("array<string>")))
    found = [_spans(k, p, 2 if k == "assign" else 0) for k, p in patterns.items()]
    least = {"assign": LEAST_VALUE, "access": LEAST_ACCESS, "hex": 0}
    found = [F.filter(s, _long_enough(least[k])) for s, k in zip(found, patterns, strict=True)]
    return out.withColumn("base", F.concat(*found)).drop("_t", *(f"{k}_{x}" for k in patterns for x in "mp"))


def ownership(candidates: DataFrame) -> DataFrame:
    """(hash, n_owners, n_repositories) of candidates (hash, owner, repository); nulls are one unknown owner."""
    triples = candidates.select("hash", F.coalesce("owner", F.lit("")).alias("owner"),
                                F.coalesce("repository", F.lit("")).alias("repository")).distinct()
    by_owner = triples.groupBy("hash", "owner").agg(F.count(F.lit(1)).alias("n"))
    return by_owner.groupBy("hash").agg(F.count(F.lit(1)).alias("n_owners"), F.sum("n").alias("n_repositories"))


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", owner_column: str = "source",
         repository_columns: tuple[str, ...] = ("source", "lang"), example_owners: int = EXAMPLE_OWNERS) -> DataFrame:
    """One row per input row: id, n_assign, n_access, n_hex, spans (array of kind, start, end, n_owners, n_repositories).

    Spans are in order of start, then kind as in ``KINDS``.  ``example`` and
    ``live`` spans cover a candidate's value.  Null and empty texts have none;
    repeated rows and null ids are rows of their own.
    """
    repository = F.concat_ws("/", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in repository_columns))
    found = find_spans(docs.select(F.col(id_column).cast("bigint").alias("_id"), F.col(text_column).alias("text"),
                                   F.col(owner_column).cast("string").alias("owner"), repository.alias("repository")))
    # live-looking: enough different characters, letters and digits both.
    value = lambda s: s["value"]
    random = lambda s: ((F.size(F.array_distinct(F.split(value(s), ""))) >= LIVE_CHARACTERS)
                        & value(s).rlike("[0-9]") & value(s).rlike("[A-Za-z]"))
    base = F.transform("base", lambda s: F.struct(
        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
        (s["end"] - F.length(value(s))).cast("bigint").alias("value_start"),
        F.sha2(value(s), 256).alias("hash"), random(s).alias("random")))
    rows = materialize(found.select(F.monotonically_increasing_id().alias("uid"), "_id", "owner", "repository",
                                    base.alias("base")), "spans")
    each = rows.select("uid", "owner", "repository", F.explode("base").alias("s")).select(
        "uid", "owner", "repository", "s.*")
    owners = materialize(ownership(each), "owners").withColumnRenamed("hash", "_hash")
    judged = each.join(owners, each["hash"] == owners["_hash"]).withColumn(
        "verdict", F.when(F.col("n_owners") >= example_owners, "example").when(F.col("random"), "live"))
    span = lambda kind, start: F.struct(F.col(start).alias("start"), kind.alias("kind"), F.col("end").alias("end"),
                                        "n_owners", "n_repositories")
    rank = F.array_position(F.array(*map(F.lit, KINDS)), F.col("x.kind"))
    all_spans = (judged.select("uid", F.explode(F.array(span(F.col("kind"), "start"),
                                                         span(F.col("verdict"), "value_start"))).alias("x"))
                 .filter("x.kind IS NOT NULL").distinct()
                 .select("uid", F.struct("x.start", rank.alias("rank"), "x.end", "x.kind", "x.n_owners",
                                         "x.n_repositories").alias("x"))
                 .groupBy("uid").agg(F.array_sort(F.collect_list("x")).alias("spans")).withColumnRenamed("uid", "_uid"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return (rows.join(all_spans, rows["uid"] == all_spans["_uid"], "left")
            .select(F.col("_id").alias(id_column), *map(count, ("assign", "access", "hex")),
                    F.transform(F.coalesce("spans", F.array().cast(dict(all_spans.dtypes)["spans"])), lambda s: F.struct(
                        s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                        s["n_owners"].alias("n_owners"), s["n_repositories"].alias("n_repositories"))).alias("spans")))


def spans_text(spans: Column) -> Column:
    """kind:start:end of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"),
                                                                 s["end"].cast("string"))), ",")


def _sql() -> str:
    quote = lambda p: "'" + p.replace("'", "''") + "'"
    kinds = [("assign", ASSIGN, 2, LEAST_VALUE), ("access", ACCESS, 0, LEAST_ACCESS), ("hex", HEX, 0, 0)]
    found = " UNION ALL ".join(
        f"SELECT uid, owner, repo, '{k}' AS kind, {i} AS rank, {g} AS grp, {n} AS least, regexp_extract_all(t, {quote(p)}) AS ms,"
        f" string_split_regex(t, {quote(p)}) AS ps FROM d" for i, (k, p, g, n) in enumerate(kinds, 1))
    return f"""
WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t, coalesce(source, '') AS owner,
                  coalesce(source, '') || '/' || coalesce(lang, '') AS repo FROM documents),
f AS ({found}),
u AS (SELECT uid, owner, repo, kind, rank, grp, least, unnest(ms) AS m, unnest(ps[1:len(ms)]) AS p,
             generate_subscripts(ms, 1) AS i FROM f WHERE len(ms) > 0),
e AS (SELECT *, CAST(sum(length(p) + length(m)) OVER (PARTITION BY uid, kind ORDER BY i) AS BIGINT) AS stop,
             CASE WHEN grp = 2 THEN regexp_extract(m, {quote(ASSIGN)}, 2) ELSE m END AS v FROM u),
b AS (SELECT uid, owner, repo, kind, rank, stop - length(m) AS start, stop, v, sha256(v) AS hash FROM e WHERE length(v) >= least),
o AS (SELECT hash, count(DISTINCT owner) AS owners, count(DISTINCT repo) AS repos FROM b GROUP BY hash),
j AS (SELECT b.*, CASE WHEN owners >= {EXAMPLE_OWNERS} THEN 'example'
        WHEN len(list_distinct(string_split(v, ''))) >= {LIVE_CHARACTERS} AND regexp_matches(v, '[0-9]')
             AND regexp_matches(v, '[A-Za-z]') THEN 'live' END AS verdict FROM b JOIN o USING (hash)),
a AS (SELECT uid, kind, rank, start, stop FROM j UNION
      SELECT uid, verdict, CASE verdict WHEN 'example' THEN 4 ELSE 5 END, stop - length(v), stop FROM j
      WHERE verdict IS NOT NULL),
g AS (SELECT uid, string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) AS spans,
             string_agg(kind || ':' || start || ':' || stop, ',' ORDER BY start, rank, stop) FILTER (rank <= 3) AS base,
             count(*) FILTER (rank = 1) AS n1, count(*) FILTER (rank = 2) AS n2, count(*) FILTER (rank = 3) AS n3
      FROM a GROUP BY uid)
SELECT doc_id, coalesce(n1, 0) AS n_assign, coalesce(n2, 0) AS n_access, coalesce(n3, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (uid)
"""


ORACLE_SQL = _sql()
