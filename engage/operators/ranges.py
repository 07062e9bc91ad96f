"""Locations of addresses from a table of address ranges.

A range is cut into aligned blocks of 1 to 2^16 addresses; what is wider than such a bucket is repeated, once for each bucket it
covers. Blocks of one size are disjoint, so of each size only the last block that starts at or before an address can hold it.
One sorted pass over a bucket's blocks and addresses finds these of all sizes, without pairing addresses with ranges. A bucket
has at most 2^16 different addresses and 2^17 different blocks, whatever the tables hold.

Ranges are dealt out before they are cut, and buckets to as many tasks as the number of blocks and addresses asks for, so that what a task
holds does not grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from engage.operators.enrich import LOCATION

BUCKET_BITS = 16
TASK_ROWS = 1 << 18  # blocks and addresses of a task, about
CUTTERS = 200  # tasks that cut ranges, at most; they pass blocks on and hold none
NO_BLOCK = BUCKET_BITS + 1  # stands for the size of a block in the row of an address, so that it comes after the blocks at its number
ADDRESSES = 1 << 32
_OCTET = "(25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
_ADDRESS = rf"\A{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}\z"
_NETWORK = r"\A([^/]+)(?:/(3[0-2]|[12]?[0-9]))?\z"


def address_number(address: Column) -> Column:
    """The number of a dotted address of four octets without leading zeros; null for any other text."""
    a, b, c, d = (F.regexp_extract(address, _ADDRESS, k).try_cast("bigint") for k in range(1, 5))
    return ((a * 256 + b) * 256 + c) * 256 + d


def address_text(number: Column) -> Column:
    return F.concat_ws(".", *[F.shiftright(number, bits).bitwiseAND(255).cast("string") for bits in (24, 16, 8, 0)])


def network_bounds(network: Column) -> Column:
    """``first, last`` of ``address/length`` (a bare address is a network of its own); null fields for any other text."""
    base = address_number(F.regexp_extract(network, _NETWORK, 1))
    length = F.regexp_extract(network, _NETWORK, 2)
    free = F.lit(32) - F.when(length == "", 32).otherwise(length.try_cast("int"))
    size = F.call_function("shiftleft", F.lit(1).cast("bigint"), free)
    first = base - base % size
    return F.struct(first.alias("first"), (first + size - 1).alias("last"))


def with_bounds(ranges: DataFrame) -> DataFrame:
    """``ranges`` with ``first`` and ``last``; where it has a column ``network`` they are made from that."""
    if "network" not in ranges.columns:
        return ranges
    bounds = network_bounds(F.col("network"))
    return ranges.withColumns({"first": bounds["first"], "last": bounds["last"]})


def _blocks(first: Column, last: Column) -> Column:
    """The aligned blocks, as start and size in bits, that together are the range. Of each size below a bucket there are at most
    two: one that ends where a block of twice the size may begin, one that starts where such a block must end."""

    def block(number: Column, bits: int) -> Column:
        return F.struct(F.shiftleft(number, bits).alias("start"), F.lit(bits).alias("bits"))

    parts = []
    for bits in range(BUCKET_BITS + 1):
        left, right = F.shiftright(first + ((1 << bits) - 1), bits), F.shiftright(last + 1, bits)
        some = left < right
        if bits < BUCKET_BITS:
            parts.append(F.when(some & (left % 2 == 1), block(left, bits)))
            parts.append(F.when(some & (right % 2 == 1), block(right - 1, bits)))
    whole = F.transform(F.sequence(left, F.greatest(left, right - 1)), lambda number: block(number, BUCKET_BITS))
    edges = F.array_compact(F.array(*parts))
    return F.when(some, F.concat(edges, whole)).otherwise(edges)


def locate_by_ranges(
    addresses: DataFrame,
    ranges: DataFrame,
    columns: list[str] = LOCATION,
    address: str = "last_login_ip",
    source: str = "ranges",
) -> DataFrame:
    """``ip``, ``columns`` and ``source`` for each different address that lies in a range of ``ranges(first, last, *columns)``.

    The narrowest range decides, then the one that starts first, then the smallest values of ``columns``. Addresses that are
    null, no dotted address or in no range give no row; ranges with a null bound, a bound outside the address space or
    bounds in the wrong order hold nothing. Repeated rows on either side change nothing, other columns are ignored.
    """
    first, last = F.col("first").cast("bigint"), F.col("last").cast("bigint")
    held = ranges.select(first.alias("first"), last.alias("last"), F.struct(*columns).alias("place")).where(
        (F.col("first") >= 0) & (F.col("first") <= F.col("last")) & (F.col("last") < ADDRESSES)
    )
    asked = addresses.select(address_number(F.col(address)).alias("number")).where(F.col("number").isNotNull())
    # About a block of each size, and whole buckets.
    size = F.lit(BUCKET_BITS + 1) + F.shiftright(F.col("last") - F.col("first"), BUCKET_BITS)
    tasks = 1 + ((held.agg(F.sum(size)).first()[0] or 0) + asked.count()) // TASK_ROWS
    blocks = (
        held.repartition(min(tasks, CUTTERS), "first", "last")
        .withColumn("block", F.explode(_blocks(F.col("first"), F.col("last"))))
        .select(
            F.col("block.start").alias("number"),
            F.col("block.bits").alias("bits"),
            F.struct((F.col("last") - F.col("first")).alias("width"), "first", "place").alias("best"),
        )
    )
    rows = (
        blocks.unionByName(asked.withColumn("bits", F.lit(NO_BLOCK)), allowMissingColumns=True)
        .withColumn("bucket", F.shiftright("number", BUCKET_BITS))
        .repartition(tasks, "bucket")
        .groupBy("bucket", "number", "bits")
        .agg(F.min("best").alias("best"))
    )
    passed = W.partitionBy("bucket").orderBy("number", "bits").rowsBetween(W.unboundedPreceding, W.currentRow)
    sizes = range(BUCKET_BITS + 1)
    seen = {
        f"of_{bits}": F.last(F.when(F.col("bits") == bits, F.struct("number", "best")), ignorenulls=True).over(passed)
        for bits in sizes
    }
    holding = [
        F.when(F.col(f"of_{bits}.number") == F.shiftleft(F.shiftright("number", bits), bits), F.col(f"of_{bits}.best"))
        for bits in sizes
    ]
    found = rows.withColumns(seen).where(F.col("bits") == NO_BLOCK).select("number", F.array_min(F.array(*holding)).alias("best"))
    # Only one text has a number.
    ip = address_text(F.col("number")).alias("ip")
    return found.where(F.col("best").isNotNull()).select(ip, "best.place.*", F.lit(source).alias("source"))
