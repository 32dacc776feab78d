"""The ``homes`` table: house sales derived by Spark from the order tables.

The texts run unchanged on Spark and on the SQL engine used for checking.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..session import spread

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

HOMES_SQL = """
SELECT o_orderkey AS pid,
 CASE WHEN o_orderkey % 500 = 9 THEN 600000.0E0 + o_orderkey % 1000
   ELSE 40000 + (1 + (o_orderkey*7 + o_custkey) % 10) * 12000 + (800 + (o_orderkey*37) % 3200) * 20
     + c_nationkey * 2500 + o_totalprice * 0.05E0 END AS sale_price,
 CAST(1 + (o_orderkey*7 + o_custkey) % 10 AS INT) AS overall_qual,
 CAST(1 + (o_custkey*13) % 9 AS INT) AS overall_cond,
 CAST(1950 + (o_custkey*31) % 59 AS INT) AS year_built,
 CASE WHEN o_orderkey % 97 = 0 THEN NULL ELSE CAST(1950 + (o_custkey*31) % 59
   + (CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 20 ELSE 0 END) AS INT) END AS year_remod_add,
 CAST(2006 + o_orderkey % 5 AS INT) AS yr_sold, CAST(1 + o_orderkey % 12 AS INT) AS mo_sold,
 CASE WHEN o_orderkey % 700 = 11 THEN 0.0E0 ELSE CAST(800 + (o_orderkey*37) % 3200 AS DOUBLE) END AS gr_liv_area,
 CASE WHEN o_orderkey % 200 = 7 THEN NULL WHEN o_custkey % 11 = 0 THEN 0.0E0
   ELSE CAST((o_orderkey*53) % 2000 AS DOUBLE) END AS total_bsmt_sf,
 CAST(400 + (o_orderkey*41) % 1600 AS DOUBLE) AS first_flr_sf,
 CASE WHEN o_orderkey % 2 = 0 THEN 0.0E0 ELSE CAST((o_orderkey*29) % 1200 AS DOUBLE) END AS second_flr_sf,
 CAST(1 + o_orderkey % 3 AS INT) AS full_bath, CAST(o_custkey % 2 AS INT) AS half_bath,
 CASE WHEN o_orderkey % 800 = 13 THEN NULL ELSE CAST(o_custkey % 2 AS DOUBLE) END AS bsmt_full_bath,
 CAST((CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END) AS DOUBLE) AS bsmt_half_bath,
 CASE WHEN o_orderkey % 150 = 3 THEN NULL ELSE CAST(o_custkey % 4 AS DOUBLE) END AS garage_cars,
 CASE WHEN o_orderkey % 150 = 3 THEN NULL ELSE CAST((o_custkey % 4) * 230 AS DOUBLE) END AS garage_area,
 CAST(o_orderkey % 3 AS INT) AS fireplaces,
 CAST((o_orderkey*19) % 200 AS DOUBLE) AS open_porch_sf,
 CAST((CASE WHEN o_orderkey % 7 = 0 THEN 100 + o_custkey % 100 ELSE 0 END) AS DOUBLE) AS enclosed_porch,
 CAST((CASE WHEN o_orderkey % 90 = 1 THEN 150 ELSE 0 END) AS DOUBLE) AS three_ssn_porch,
 CAST((CASE WHEN o_orderkey % 11 = 0 THEN 120 + o_custkey % 80 ELSE 0 END) AS DOUBLE) AS screen_porch,
 CASE WHEN o_orderkey % 6 = 0 THEN NULL ELSE CAST(20 + (o_orderkey*17) % 130 AS DOUBLE) END AS lot_frontage,
 CAST(1300 + ((o_orderkey*43) % 100) * ((o_orderkey*43) % 100) * ((o_orderkey*43) % 100) * 0.2E0 AS DOUBLE) AS lot_area,
 CASE WHEN o_orderkey % 40 = 0 THEN CAST(100 + o_custkey % 400 AS DOUBLE) ELSE 0.0E0 END AS pool_area,
 CASE WHEN o_orderkey % 14 = 0 THEN 'Grvl' ELSE NULL END AS alley,
 CASE WHEN o_orderkey % 36 = 5 THEN NULL ELSE o_orderpriority END AS garage_type,
 CASE WHEN o_orderkey % 10 IN (4, 5) THEN NULL WHEN o_orderkey % 2 = 0 THEN 'TA' ELSE 'Gd' END AS exter_qual,
 CASE WHEN o_orderkey % 400 = 1 THEN 'C (all)' WHEN o_custkey % 5 < 3 THEN 'RL' ELSE 'RM' END AS ms_zoning,
 n_name AS neighborhood
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""

# Over homes: bad prices, qualities and years, text that is no number, gaps.
HOMES_BAD_SQL = """
SELECT pid, CASE WHEN pid % 1000 = 1 THEN -1.0E0 WHEN pid % 1000 = 2 THEN 2500000.0E0 WHEN pid % 1000 = 3 THEN NULL ELSE sale_price END AS sale_price,
 CASE WHEN pid % 900 = 4 THEN 99 ELSE overall_qual END AS overall_qual,
 CASE WHEN pid % 1100 = 5 THEN 2099 ELSE yr_sold END AS yr_sold,
 CASE WHEN pid % 1300 = 6 THEN 'abc' ELSE CAST(year_built AS STRING) END AS year_built_text, garage_cars FROM homes
"""

# Column names of the housing table, by the names used above.
CANONICAL = {
    "pid": "PID",
    "sale_price": "SalePrice",
    "overall_qual": "Overall Qual",
    "overall_cond": "Overall Cond",
    "year_built": "Year Built",
    "year_remod_add": "Year Remod/Add",
    "yr_sold": "Yr Sold",
    "mo_sold": "Mo Sold",
    "gr_liv_area": "Gr Liv Area",
    "total_bsmt_sf": "Total Bsmt SF",
    "first_flr_sf": "1st Flr SF",
    "second_flr_sf": "2nd Flr SF",
    "full_bath": "Full Bath",
    "half_bath": "Half Bath",
    "bsmt_full_bath": "Bsmt Full Bath",
    "bsmt_half_bath": "Bsmt Half Bath",
    "garage_cars": "Garage Cars",
    "garage_area": "Garage Area",
    "fireplaces": "Fireplaces",
    "open_porch_sf": "Open Porch SF",
    "enclosed_porch": "Enclosed Porch",
    "three_ssn_porch": "3Ssn Porch",
    "screen_porch": "Screen Porch",
    "lot_frontage": "Lot Frontage",
    "lot_area": "Lot Area",
    "pool_area": "Pool Area",
    "alley": "Alley",
    "garage_type": "Garage Type",
    "exter_qual": "Exter Qual",
    "ms_zoning": "MS Zoning",
    "neighborhood": "Neighborhood",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def homes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order; the join strategies are left to Spark, by table size."""
    sources = {n: table(spark, sf_dir, n) for n in ("orders", "customer", "nation")}
    sources["orders"] = spread(sources["orders"])
    text = HOMES_SQL
    for n in sources:
        text = text.replace(f"FROM {n} ", f"FROM {{{n}}} ").replace(f"JOIN {n} ", f"JOIN {{{n}}} ")
    return spark.sql(text, **sources)


def homes_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(HOMES_BAD_SQL.replace("FROM homes", "FROM {homes}"), homes=homes(spark, sf_dir))


def canonical(df: DataFrame) -> DataFrame:
    """The same rows under the housing table's own names."""
    return df.withColumnsRenamed({k: v for k, v in CANONICAL.items() if k in set(df.columns)})
