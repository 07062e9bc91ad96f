"""Registered queries: addresses located by a table of address ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.operators.enrich import first_location
from engage.operators.ranges import ADDRESSES, address_text, locate_by_ranges
from engage.queries.inputs import table

NATION_WIDTH = 171_798_691  # the address space in 25 parts


def _mixed(key: str, factor: int) -> Column:
    return (F.col(key).cast("bigint") * factor) % ADDRESSES


def customer_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(address_text(_mixed("c_custkey", 2654435761)).alias("last_login_ip"))


def nested_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide ranges of nations, narrower ones of suppliers and parts that lie across each other and across the nations."""

    def ranges(name: str, first: Column, width: Column, city: str, kind: str) -> DataFrame:
        last = F.least(first + width - 1, F.lit(ADDRESSES - 1))
        return table(spark, sf_dir, name).select(
            first.alias("first"), last.alias("last"), F.col(city).alias("city"), F.lit(kind).alias("region")
        )

    supplier, part = _mixed("s_suppkey", 18581050327), _mixed("p_partkey", 2654469611)
    return (
        ranges("nation", F.col("n_nationkey").cast("bigint") * NATION_WIDTH, F.lit(NATION_WIDTH), "n_name", "nation")
        .union(ranges("supplier", supplier, F.col("s_suppkey") % 5 * 3_000_000 + 78, "s_name", "supplier"))
        .union(ranges("part", part, F.col("p_partkey") % 3_000 * 100 + 1, "p_name", "part"))
    )


def range_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return locate_by_ranges(customer_addresses(spark, sf_dir), nested_ranges(spark, sf_dir), ["city", "region"])


def range_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations of a provider for every third customer's address; the ranges for all others."""
    addresses = customer_addresses(spark, sf_dir)
    ranges = nested_ranges(spark, sf_dir).select(
        "first", "last", "city", "region", F.col("city").alias("country_name"), F.lit("").alias("country_code")
    )
    landed = table(spark, sf_dir, "customer").where("c_custkey % 3 = 0").select(
        address_text(_mixed("c_custkey", 2654435761)).alias("ip"),
        F.col("c_name").alias("city"),
        *[F.lit("").alias(name) for name in ("region", "country_name", "country_code")],
        F.lit("ipwho.is").alias("source"),
    )
    found = landed.unionByName(locate_by_ranges(addresses, ranges))
    return first_location(found, ["ipwho.is", "ranges"]).select("ip", "city", "source")


RANGES_SQL = f"""
ranges AS (
  SELECT n_nationkey::BIGINT * {NATION_WIDTH} AS first, n_nationkey::BIGINT * {NATION_WIDTH} + {NATION_WIDTH - 1} AS last, n_name AS city,
    'nation' AS region FROM nation
  UNION ALL
  SELECT first, least(first + s_suppkey % 5 * 3000000 + 77, {ADDRESSES - 1}), s_name, 'supplier'
  FROM (SELECT (s_suppkey::BIGINT * 18581050327) % {ADDRESSES} AS first, * FROM supplier)
  UNION ALL
  SELECT first, least(first + p_partkey % 3000 * 100, {ADDRESSES - 1}), p_name, 'part'
  FROM (SELECT (p_partkey::BIGINT * 2654469611) % {ADDRESSES} AS first, * FROM part)
),
addresses AS (SELECT DISTINCT c_custkey, (c_custkey::BIGINT * 2654435761) % {ADDRESSES} AS number, c_name FROM customer),
dotted AS (
  SELECT *, concat_ws('.', number >> 24, (number >> 16) & 255, (number >> 8) & 255, number & 255) AS ip FROM addresses
),
located AS (
  SELECT ip, city, region FROM dotted JOIN ranges ON number BETWEEN first AND last
  QUALIFY row_number() OVER (PARTITION BY ip ORDER BY last - first, first, city, region) = 1
)
"""

QUERIES = {
    "range_locations": (range_locations, f"WITH {RANGES_SQL} SELECT ip, city, region, 'ranges' AS source FROM located"),
    "range_fallback": (
        range_fallback,
        f"""WITH {RANGES_SQL}
        SELECT ip, c_name AS city, 'ipwho.is' AS source FROM dotted WHERE c_custkey % 3 = 0
        UNION ALL
        SELECT ip, city, 'ranges' FROM located WHERE ip NOT IN (SELECT ip FROM dotted WHERE c_custkey % 3 = 0)""",
    ),
}
