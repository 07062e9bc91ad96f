"""Dimension enrichment: addresses to locations with ordered fallback, posts to metadata."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.functions.posts import URN_KINDS, URN_PREFIX, percent_encoded, post_key, urn_candidates
from engage.functions.times import as_instant
from engage.operators.flatten import metadata_columns
from engage.operators.merge import merge_update_only
from engage.sources.tables import evolve

# Location field -> response field, per provider shape.
PROVIDER_FIELDS = {
    "ip-api.com": {"city": "city", "region": "regionName", "country_name": "country", "country_code": "countryCode"},
    "freeipapi.com": {
        "city": "cityName",
        "region": "regionName",
        "country_name": "countryName",
        "country_code": "countryCode",
    },
    "ipwho.is": {"city": "city", "region": "region", "country_name": "country", "country_code": "country_code"},
    "ipapi.co": {"city": "city", "region": "region", "country_name": "country_name", "country_code": "country_code"},
}
# Order in which providers are tried.
BULK_ORDER = ["ip-api.com", "freeipapi.com", "ipwho.is", "ipapi.co"]
SYNC_ORDER = ["ip-api.com", "ipwho.is", "freeipapi.com"]
LOCATION = ["city", "region", "country_name", "country_code"]
RESPONSE = (
    "status string, success string, city string, cityName string, region string, regionName string, country string,"
    "countryName string, country_name string, countryCode string, country_code string"
)
# Texts of a JSON value that count as false.
FALSY = ["false", "0", "", "[]", "{}"]


Lookup = Callable[[str], dict | None]


def addresses_to_enrich(users: DataFrame, force: bool = False, limit: int | None = None) -> DataFrame:
    """Distinct addresses of users without a city (``force``: of all users); with ``limit`` the smallest ones."""
    rows = users.where(F.col("last_login_ip").isNotNull())
    if not force:
        rows = rows.where(F.col("last_login_city").isNull())
    addresses = rows.select("last_login_ip").distinct()
    return addresses if limit is None else addresses.orderBy("last_login_ip").limit(limit)


def normalize_locations(responses: DataFrame) -> DataFrame:
    """Successful provider responses as (ip, city, region, country_name, country_code, source).

    Success is provider-specific: a status, a flag, the presence of a field, or the absence of an error field.
    Unreadable bodies fail; missing texts become empty.
    """
    parsed = responses.withColumns({"keys": F.json_object_keys("body"), "r": F.from_json("body", RESPONSE)})
    parsed = parsed.where(F.col("keys").isNotNull())
    truthy = F.col("r.success").isNotNull() & ~F.col("r.success").isin(FALSY)
    success = {
        "ip-api.com": F.col("r.status") == "success",
        "freeipapi.com": F.array_contains("keys", "cityName"),
        "ipwho.is": truthy,
        "ipapi.co": ~F.array_contains("keys", "error"),
    }
    ok, location = F.lit(False), None
    for provider, test in success.items():
        here = F.col("provider") == provider
        ok |= here & F.coalesce(test, F.lit(False))
        texts = [
            F.coalesce(F.col(f"r.{field}"), F.lit("")).alias(name) for name, field in PROVIDER_FIELDS[provider].items()
        ]
        value = F.struct(*texts)
        location = F.when(here, value) if location is None else location.when(here, value)
    return parsed.where(ok).select("ip", location.alias("l"), F.col("provider").alias("source")).select(
        "ip", "l.*", "source"
    )


def lookup_locations(addresses: DataFrame, lookups: dict[str, Lookup], tasks: int | None = None) -> DataFrame:
    """Locations of ``last_login_ip`` values from caller-supplied lookup functions, tried in order per address.

    A lookup takes an address and returns the location fields or ``None``; one that raises counts as a failure, and a batch of
    addresses for which every call failed raises the last error: a wholly broken lookup is not "no location". Addresses are spread over ``tasks`` partitions, which is how many lookups run at a time.
    """
    functions = list(lookups.items())

    def locate(address: str, outcome: list) -> tuple | None:
        for source, lookup in functions:
            try:
                found = lookup(address)
                outcome.append(None)
            except Exception as error:  # whatever the caller's function raised
                outcome.append(error)
                continue
            if found:
                return (address, *[found.get(name, "") for name in LOCATION], source)
        return None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            outcome: list = []
            hits = [hit for hit in (locate(address, outcome) for address in batch["last_login_ip"]) if hit is not None]
            if outcome and all(error is not None for error in outcome):
                raise RuntimeError("every location lookup failed") from outcome[-1]
            yield pd.DataFrame(hits, columns=["ip", *LOCATION, "source"])

    spread = addresses.select("last_login_ip")
    spread = spread.repartition("last_login_ip") if tasks is None else spread.repartition(tasks, "last_login_ip")
    return spread.mapInPandas(run, ", ".join(f"{name} string" for name in ["ip", *LOCATION, "source"]))


def first_location(locations: DataFrame, order: list[str] = BULK_ORDER) -> DataFrame:
    """Per address, the location of the first provider in ``order`` that succeeded."""
    rank = F.array_position(F.array(*[F.lit(p) for p in order]), F.col("source"))
    value = F.struct(*LOCATION, "source")
    return (
        locations.where(F.col("source").isin(order))
        .groupBy("ip")
        .agg(F.min_by(value, F.struct(rank, value)).alias("best"))
        .select("ip", "best.*")
    )


def locate_users(users: DataFrame, locations: DataFrame) -> DataFrame:
    """Copy each address's location to all users with that address; the country becomes the location's code."""
    source = locations.select(
        F.col("ip").alias("last_login_ip"),
        F.col("city").alias("last_login_city"),
        F.col("region").alias("last_login_region"),
        F.col("country_name").alias("last_login_country_name"),
        F.col("country_code").alias("last_login_country"),
    )
    return merge_update_only(users, source, "last_login_ip", source_unique=True)


def coverage(users: DataFrame) -> DataFrame:
    """Users, users with a city, distinct cities and distinct countries.

    Counting per (city, country) first keeps the two distinct counts off the full table.
    """
    per_place = users.groupBy("last_login_city", "last_login_country_name").agg(F.count("*").alias("n"))
    with_city = F.when(F.col("last_login_city").isNotNull(), F.col("n")).otherwise(F.lit(0))
    return per_place.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_users"),
        F.coalesce(F.sum(with_city), F.lit(0)).alias("users_with_city"),
        F.count_distinct("last_login_city").alias("unique_cities"),
        F.count_distinct("last_login_country_name").alias("unique_countries"),
    )


# --- post metadata --------------------------------------------------------------------------------------------------
def requested_urns(posts: DataFrame) -> DataFrame:
    """Distinct URNs under which metadata of the posts may be filed, also percent-encoded as a file or path name."""
    key = post_key(F.col("id"), F.col("urn"))
    urns = posts.select(F.explode(urn_candidates(key)).alias("urn")).distinct()
    return urns.withColumn("encoded", percent_encoded(F.col("urn")))


def _record() -> Column:
    return F.struct("urn", "commentsState", "commentSummary", "reactionSummaries")


def _best_record(metadata: DataFrame, key: Column, rank: Column, column: str) -> DataFrame:
    """One metadata record per key: lowest rank, then a fixed order so that repeated records do not matter."""
    order = F.struct(rank, F.col("commentSummary"), F.col("commentsState"))
    return metadata.groupBy(key.alias("__key")).agg(F.min_by(_record(), order).alias(column))


def attach_metadata(posts: DataFrame, metadata: DataFrame, column: str = "metadata") -> DataFrame:
    """Posts with the metadata record of their best URN candidate as a struct column.

    Each metadata record is keyed by its URN and, where an all-digit post id could stand for that URN, also by the
    bare number; the best record per key is chosen on the metadata side. Posts are then shuffled once, whatever the
    number of candidates, and need not be regrouped.
    """
    pattern = f"^{URN_PREFIX}({'|'.join(URN_KINDS)}):([0-9]+)$"
    rank = F.array_position(F.array(*[F.lit(kind) for kind in URN_KINDS]), F.regexp_extract("urn", pattern, 1))
    own = F.struct(F.col("urn").alias("key"), F.lit(0).cast("bigint").alias("rank"))
    bare = F.struct(F.regexp_extract("urn", pattern, 2).alias("key"), rank.alias("rank"))
    # A bare number is never looked up as it stands, so a record filed under one is not reachable.
    keyed = metadata.where(~F.col("urn").rlike("^[0-9]+$")).withColumn(
        "__k", F.explode(F.when(rank > 0, F.array(own, bare)).otherwise(F.array(own)))
    )
    best = _best_record(keyed, F.col("__k.key"), F.col("__k.rank"), column)
    with_key = posts.withColumn("__key", post_key(F.col("id"), F.col("urn")))
    return with_key.join(best, "__key", "left").drop("__key")


def attach_metadata_budgeted(
    posts: DataFrame, metadata: DataFrame, budget: int | None, created: str = "createdAt", column: str = "metadata"
) -> DataFrame:
    """Metadata by the post's own id, newest posts first, until ``budget`` posts have received some.

    Posts without a metadata record do not use up the budget.
    """
    known = metadata
    if budget is not None:
        served = (
            posts.select(F.col("id").alias("urn"), created)
            .join(metadata.select("urn"), "urn", "left_semi")
            .orderBy(F.col(created).desc_nulls_last(), "urn")
            .limit(budget)
        )
        known = metadata.join(served.select("urn"), "urn", "left_semi")
    best = _best_record(known, F.col("urn"), F.lit(0), column)
    return posts.withColumn("__key", F.col("id")).join(best, "__key", "left").drop("__key")


def backfill_rows(
    posts: DataFrame, metadata: DataFrame, max_calls: int | None = None, as_of: dt.datetime | str | None = None
) -> DataFrame:
    """New metadata columns of posts without reactions, where metadata exists; ``max_calls`` takes only the newest of them."""
    missing = posts.where((F.col("total_reactions") == 0) | F.col("total_reactions").isNull()).select(
        F.col("post_id").alias("urn"), "created_at"
    )
    if max_calls is not None:
        missing = missing.orderBy(F.col("created_at").desc_nulls_last(), "urn").limit(max_calls)
    found = _best_record(metadata.join(missing.select("urn"), "urn", "left_semi"), F.col("urn"), F.lit(0), "metadata")
    columns = {**metadata_columns("metadata"), "fetched_at": as_instant(as_of)}
    return found.select(F.col("__key").alias("post_id"), *[column.alias(name) for name, column in columns.items()])


def apply_backfill(posts: DataFrame, rows: DataFrame) -> DataFrame:
    fields = [(f.name, f.dataType.simpleString()) for f in rows.schema.fields]
    return merge_update_only(evolve(posts, fields), rows, "post_id", source_unique=True)


def backfill_metadata(
    posts: DataFrame, metadata: DataFrame, max_calls: int | None = None, as_of: dt.datetime | str | None = None
) -> DataFrame:
    return apply_backfill(posts, backfill_rows(posts, metadata, max_calls, as_of))


def newest_details(search: DataFrame, details: DataFrame, published: Column, newest: int) -> DataFrame:
    """Details of the newest ``newest`` search hits; hits without id or without details are dropped."""
    hits = search.where(F.col("id.videoId") != "").orderBy(published.desc(), "id.videoId").limit(newest)
    ids = hits.select(F.col("id.videoId").alias("id"))
    return details.join(ids, "id", "left_semi")
