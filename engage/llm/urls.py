"""URL filter: a blocked Bloom filter of the listed hosts and paths, then an exact hash join.

A list holds rules ``(host, path, action)``. A rule fits its host and all subdomains where the URL's path starts with
the rule's path; of those that fit, the longest wins. A URL is compared with the list by a few canonical candidates: one
per *shape* of rule (number of host labels, length of path). The candidates are probed against the Bloom filter, which
is a table of 256-bit blocks of bounded number, so nearly all of them end in the scan's own task. Only possible hits
travel on to the exact join, which removes the false positives.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.llm.common import ascii_lower

ALLOW, BLOCK = "allow", "block"
MAX_BLOCKS = 1 << 17  # 4 MiB of filter bits: the bound of what is broadcast, however long the list
RULES_PER_BLOCK = 16  # 16 bits for each listed rule until the bound is reached
WORDS = 4  # 64-bit words of a block; one bit of each is set for a rule


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL; both empty where it is null or has no ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"(?s)\A[^/?#]*", 0)
    path = F.regexp_extract(rest, r"(?s)\A[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def _labels(host: Column) -> Column:
    return F.length(host) - F.length(F.replace(host, F.lit("."))) + 1


def _block(host: Column, path: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(host, path), F.lit(blocks)).cast("int")


def _bit(host: Column, path: Column, word: int) -> Column:
    """The bit of a 64-bit word that a rule sets: six bits of a second hash for each word."""
    place = F.shiftrightunsigned(F.xxhash64(path, host, F.lit(1)), 6 * word).bitwiseAND(F.lit(63))
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def bloom_blocks(rules: DataFrame, blocks: int) -> DataFrame:
    """The non-empty blocks of the filter: ``block, w0 .. w3``; at most ``blocks`` rows."""
    host, path = F.col("host"), F.col("path")
    return rules.groupBy(_block(host, path, blocks).alias("block")).agg(
        *[F.bit_or(_bit(host, path, i)).alias(f"w{i}") for i in range(WORDS)]
    )


def canonical_rules(rules: DataFrame) -> DataFrame:
    """Distinct rules with lower-case host; where a list both allows and blocks the same rule, it blocks it.

    Rows with a null or empty host, a null path or another action than allow and block are left out.
    """
    return (
        rules.select(ascii_lower(F.col("host")).alias("host"), "path", "action")
        .where((F.length("host") > 0) & F.col("path").isNotNull() & F.col("action").isin(ALLOW, BLOCK))
        .groupBy("host", "path")
        .agg(F.max("action").alias("action"))
    )


def judge_urls(urls: DataFrame, rules: DataFrame, max_blocks: int = MAX_BLOCKS, default: str = ALLOW) -> DataFrame:
    """Verdict for each row of ``urls(page_id, url)``: ``page_id, host, path, rule, verdict``.

    ``rules(host, path, action)`` is the list. ``rule`` is the text ``host + path`` of the longest rule that fits (of
    equally long ones, that with the longer host), else null, and ``verdict`` its action, else ``default``.

    Null URLs and URLs without ``://`` have empty host and path and get the default. Repeated rows stay, each with its
    verdict. Other columns of ``urls`` are ignored. An empty list gives every row the default; no rows give no rows.
    The list is read three times (shapes, filter, join), the URLs once for the candidates and once for the result. Only
    the distinct shapes (label count, path length) come to the driver; their number is bounded by the longest rule.
    """
    host, path = host_and_path(F.col("url"))
    pages = urls.select("page_id", host.alias("host"), path.alias("path"))
    listed = canonical_rules(rules)
    shapes = [
        (r["labels"], r["length"])
        for r in listed.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("length"))
        .groupBy("labels", "length")
        .count()
        .collect()
    ]
    if not shapes:
        return pages.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    blocks = min(max_blocks, 1 << max(0, (listed.count() // RULES_PER_BLOCK).bit_length()))

    h, p = F.col("host"), F.col("path")
    candidates = F.array(
        *[
            F.when(
                (_labels(h) >= labels) & (F.length(p) >= length),
                F.struct(
                    F.substring_index(h, ".", -labels).alias("rule_host"), F.substring(p, 1, length).alias("rule_path")
                ),
            )
            for labels, length in sorted(shapes)
        ]
    )
    tried = (
        pages.select("host", "path", F.explode(candidates).alias("c"))
        .where(F.col("c").isNotNull())
        .select("host", "path", "c.rule_host", "c.rule_path")
    )
    rh, rp = F.col("rule_host"), F.col("rule_path")
    hit = F.lit(True)
    for i in range(WORDS):
        hit = hit & (F.col(f"w{i}").bitwiseAND(_bit(rh, rp, i)) != 0)
    # At most max_blocks rows of four words each, whatever the length of the list.
    possible = (
        tried.withColumn("block", _block(rh, rp, blocks))
        .join(F.broadcast(bloom_blocks(listed, blocks)), "block")
        .where(hit)
        .select("host", "path", "rule_host", "rule_path")
        .distinct()  # combines on the map side, so a host with a third of all rows costs little
    )
    found = (
        possible.join(
            listed.select(F.col("host").alias("rule_host"), F.col("path").alias("rule_path"), "action"),
            ["rule_host", "rule_path"],
        )
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    (F.length(rh) + F.length(rp)).alias("length"),
                    F.length(rh).alias("host_length"),
                    F.concat(rh, rp).alias("rule"),
                    F.col("action").alias("verdict"),
                )
            ).alias("best")
        )
    )
    # Hot URLs: a plain join, whose skewed partitions the adaptive planner splits.
    return pages.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict")
    )
