"""DuckDB twins of the registered queries (the correctness oracle).

Each string runs on DuckDB over the pre-registered views of the driver's
tables.  The common CTEs rebuild the flight view (FIXTURES F5) and the
clean/typed layers with the same rules the Spark operators use, so a match
checks the Spark implementation, not a copy of it.
"""

from __future__ import annotations

FL = """
SELECT
  CAST(year(l_shipdate) AS INT) AS Year,
  CAST(month(l_shipdate) AS INT) AS Month,
  CAST(day(l_shipdate) AS INT) AS DayofMonth,
  CAST(isodow(l_shipdate) AS INT) AS DayOfWeek,
  CASE WHEN l_orderkey % 50 = 0 THEN 'NA' ELSE CAST(CAST((l_partkey % 24)*100 + l_suppkey % 60 AS INT) AS VARCHAR) END AS DepTime,
  CAST((l_partkey % 24)*100 + l_linenumber*5 AS INT) AS CRSDepTime,
  CASE WHEN l_orderkey % 50 IN (0,1) THEN 'NA' ELSE CAST(CAST(((l_partkey + l_linenumber) % 24)*100 + l_suppkey % 60 AS INT) AS VARCHAR) END AS ArrTime,
  CAST(((l_partkey + l_linenumber) % 24)*100 + 30 AS INT) AS CRSArrTime,
  CASE WHEN l_orderkey % 50 = 0 THEN 'NA' ELSE CAST(CAST(l_quantity AS INT) - 25 AS VARCHAR) END AS DepDelay,
  CASE WHEN l_orderkey % 50 IN (0,1) THEN 'NA' ELSE CAST(CAST(l_quantity AS INT) - 30 + CAST(round(l_discount*100) AS INT) + l_linenumber AS VARCHAR) END AS ArrDelay,
  CAST(floor(l_extendedprice / 40) AS INT) AS Distance,
  CAST(CASE WHEN l_orderkey % 50 = 0 THEN 1 ELSE 0 END AS INT) AS Cancelled,
  CAST(round(l_tax*100) AS INT) AS TaxiIn,
  CAST(round(l_discount*200) AS INT) AS TaxiOut,
  l_returnflag AS UniqueCarrier,
  l_suppkey AS Origin,
  l_orderkey, l_linenumber
FROM lineitem
"""

# Feature layer rules: 14 columns, try_cast to their types (F2).
FEATURES_SELECT = """
  TRY_CAST(Year AS INT) AS Year, TRY_CAST(Month AS INT) AS Month,
  TRY_CAST(DayofMonth AS INT) AS DayofMonth, TRY_CAST(DayOfWeek AS INT) AS DayOfWeek,
  TRY_CAST(DepTime AS INT) AS DepTime, TRY_CAST(CRSDepTime AS INT) AS CRSDepTime,
  TRY_CAST(ArrTime AS INT) AS ArrTime, TRY_CAST(CRSArrTime AS INT) AS CRSArrTime,
  TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, TRY_CAST(Distance AS DOUBLE) AS Distance,
  TRY_CAST(Cancelled AS INT) AS Cancelled, TRY_CAST(TaxiIn AS DOUBLE) AS TaxiIn,
  TRY_CAST(TaxiOut AS DOUBLE) AS TaxiOut, TRY_CAST(ArrDelay AS DOUBLE) AS ArrDelay
"""

CLEAN = """
SELECT * REPLACE (TRY_CAST(ArrDelay AS DOUBLE) AS ArrDelay) FROM fl
WHERE TRY_CAST(ArrDelay AS DOUBLE) IS NOT NULL AND NOT isnan(TRY_CAST(ArrDelay AS DOUBLE))
"""

# Typed raw layer as the CSV reader declares it.
FL_TYPED = """
SELECT TRY_CAST(Year AS INT) AS Year, TRY_CAST(Month AS INT) AS Month,
  TRY_CAST(DayofMonth AS INT) AS DayofMonth, TRY_CAST(DayOfWeek AS INT) AS DayOfWeek,
  TRY_CAST(DepTime AS INT) AS DepTime, TRY_CAST(CRSDepTime AS INT) AS CRSDepTime,
  TRY_CAST(ArrTime AS INT) AS ArrTime, TRY_CAST(CRSArrTime AS INT) AS CRSArrTime,
  TRY_CAST(DepDelay AS DOUBLE) AS DepDelay, TRY_CAST(ArrDelay AS DOUBLE) AS ArrDelay,
  TRY_CAST(Distance AS DOUBLE) AS Distance, TRY_CAST(Cancelled AS INT) AS Cancelled,
  TRY_CAST(TaxiIn AS DOUBLE) AS TaxiIn, TRY_CAST(TaxiOut AS DOUBLE) AS TaxiOut,
  UniqueCarrier, Origin, l_orderkey, l_linenumber
FROM fl
"""

# Transformed layer: features + 7 numerics as double + hours (F3), from the clean layer.
TRANSFORMED = """
SELECT Year, Month, DayofMonth, DayOfWeek,
  CAST(DepTime AS DOUBLE) AS DepTime, CRSDepTime, CAST(ArrTime AS DOUBLE) AS ArrTime, CRSArrTime,
  DepDelay, Distance, Cancelled, TaxiIn, TaxiOut, ArrDelay,
  CAST(trunc(DepTime / 100) AS INT) AS DepHour, CAST(trunc(ArrTime / 100) AS INT) AS ArrHour
FROM features
"""

# A row's hash whose key column may be null: the null hashes as text.
def null_safe_hash(column: str) -> str:
    return f"CAST('0x' || substr(md5(coalesce(CAST({column} AS VARCHAR), '~null~')), 1, 8) AS BIGINT)"


HASH_KEY = "CAST('0x' || substr(md5(CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)), 1, 8) AS BIGINT)"
TEST_BOUND = int(0.2 * (1 << 32))


def with_ctes(body: str, *names: str, extra: str | None = None) -> str:
    """Prefix ``body`` with the CTEs it needs (dependencies first).

    ``extra`` holds further ``name AS (...)`` definitions placed after them.
    """
    defs = {
        "fl": FL,
        "clean": CLEAN,
        "fl_typed": FL_TYPED,
        "features": f"SELECT {FEATURES_SELECT} FROM clean",
        "raw_features": f"SELECT {FEATURES_SELECT} FROM fl",
        "transformed": TRANSFORMED,
    }
    deps = {"clean": ["fl"], "fl_typed": ["fl"], "features": ["fl", "clean"], "raw_features": ["fl"],
            "transformed": ["fl", "clean", "features"], "fl": []}
    order: list[str] = []
    for n in names:
        for d in deps[n] + [n]:
            if d not in order:
                order.append(d)
    ctes = ",\n".join(f"{n} AS ({defs[n]})" for n in order)
    if extra:
        ctes += ",\n" + extra
    return f"WITH {ctes}\n{body}"
