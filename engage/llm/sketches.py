"""Document fingerprints: threshold-scaled sketches of word shingles, in DataFrame functions alone.

A sketch holds every distinct shingle hash below a fixed fraction of all hash values. Sketches of different documents
are therefore samples by the same rule: they can be merged by union, and the share of common hashes estimates
resemblance and containment even between very unequal documents.
"""

from __future__ import annotations

from bisect import bisect_left

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SHINGLE = 5
FRACTION = 1 / 8
SEPARATOR = "[\\x20\\x09-\\x0D]+"
SPLITS = 255  # ids that cut the order into coarse ranges
ROWS = 2000  # rows of a bucket of neighbouring documents, about
MAX_BUCKETS = 1 << 18  # bounds the table of bucket heads, which is broadcast (a few MB)


def _bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def shingle_hashes(text: Column, size: int = SHINGLE) -> Column:
    """64-bit hashes of all runs of ``size`` words, in order; of fewer words, the hash of the whole sequence."""

    def hashes(words: Column) -> Column:
        run = lambda w, i: F.xxhash64(w, *[F.get(words, i + k) for k in range(1, size)])
        return (
            F.when(F.size(words) >= size, F.transform(F.slice(words, F.lit(1), F.size(words) - (size - 1)), run))
            .when(F.size(words) > 0, F.array(F.xxhash64(F.array_join(words, " "))))
            .otherwise(F.array().cast("array<bigint>"))
        )

    return _bind(F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATOR), ""), hashes)


def sketch(text: Column, fraction: float = FRACTION, size: int = SHINGLE) -> Column:
    """The sorted distinct hashes below ``fraction`` of all values; where there is none, the smallest hash alone, so that
    short texts have a fingerprint too. Empty for a null text or one without words."""
    below = F.lit(int(fraction * (1 << 64)) - (1 << 63))
    kept = lambda all_: F.filter(all_, lambda h: h < below)

    def chosen(all_: Column) -> Column:
        return _bind(
            kept(all_),
            lambda k: F.when(F.size(k) > 0, F.array_sort(F.array_distinct(k)))
            .when(F.size(all_) > 0, F.array(F.array_min(all_)))
            .otherwise(k),
        )

    return _bind(shingle_hashes(text, size), chosen)


def fingerprint(hashes: Column) -> Column:
    """A sketch as text: its hashes in hexadecimal, joined by points."""
    return F.array_join(F.transform(hashes, lambda h: F.lower(F.hex(h))), ".")


def resemblance(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two sketches: 1 for two empty ones, 0 for one."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, F.lit(1.0)).otherwise(common / union)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the shingles of ``a`` that ``b`` has: 1 where ``a`` is empty."""
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def merge(sketches: Column) -> Column:
    """Aggregate: the sketch of all rows' texts together."""
    return F.array_sort(F.array_distinct(F.flatten(F.collect_set(sketches))))


def _buckets(docs: DataFrame, ident: str) -> Column | None:
    """Number of a range of ids, in the ids' order: coarse ranges between quantiles, each cut into equal widths.

    Ids of any distribution give ranges of similar numbers of rows. Null for a null id; None if there is no id at all.
    """
    ids = docs.select(F.col(ident).cast("long").alias("v")).where(F.col("v").isNotNull())
    rows, low, high = ids.agg(F.count("*"), F.min("v"), F.max("v")).first()
    if not rows:
        return None
    buckets = min(MAX_BUCKETS, -(-rows // ROWS))
    coarse = min(SPLITS + 1, buckets)
    cuts = {int(q) for q in ids.approxQuantile("v", [k / coarse for k in range(1, coarse)], 0.001)} if coarse > 1 else set()
    edges = sorted(c for c in cuts | {low} if c >= low)
    fine = -(-buckets // len(edges))
    value, bounds = F.col(ident).cast("long"), F.array(*[F.lit(e) for e in [*edges, high + 1]])
    at = F.size(F.filter(F.slice(bounds, F.lit(1), F.lit(len(edges))), lambda e: e <= value))
    assert bisect_left(edges, low) == 0

    def within(k: Column) -> Column:
        start, end = F.element_at(bounds, k).cast("double"), F.element_at(bounds, k + 1).cast("double")
        part = F.floor((value.cast("double") - start) / (end - start) * fine).cast("long")
        return (k - 1) * fine + F.greatest(F.lit(0), F.least(F.lit(fine - 1), part))

    return F.when(F.col(ident).isNotNull(), _bind(at, within))


def with_next(docs: DataFrame, ident: str, payload: list[str]) -> DataFrame:
    """``ident``, ``payload`` and ``next_<payload>``: the values of the next row in descending order of ``ident``.

    After the last row comes the first. Rows of equal ids are ordered by the payload. A row with a null id has no place in
    the order and is its own next. The rows move once: to buckets of neighbouring ids, each of which also gets the first row
    of the bucket that comes next.
    """
    mine = [F.col(c) for c in payload]
    bucket = _buckets(docs, ident)
    if bucket is None:
        return docs.select(ident, *mine, *[c.alias(f"next_{n}") for n, c in zip(payload, mine)])
    rows = docs.select(ident, *mine, bucket.cast("long").alias("_bucket"))
    heads = rows.where(F.col("_bucket").isNotNull()).groupBy("_bucket").agg(F.max(ident).alias("_head"))
    order = Window.orderBy(F.col("_bucket").desc())  # over at most MAX_BUCKETS rows
    lent = heads.select(
        "_head", F.coalesce(F.lag("_bucket").over(order), F.min("_bucket").over(Window.partitionBy())).alias("_to")
    )
    borrowed = (
        rows.join(F.broadcast(lent), F.col(ident) == F.col("_head"))
        .select(ident, *mine, F.col("_to").alias("_bucket"), F.lit(1).alias("_lent"))
    )
    alone = rows.where(F.col("_bucket").isNull()).select(ident, *mine, *[c.alias(f"next_{n}") for n, c in zip(payload, mine)])
    own = rows.where(F.col("_bucket").isNotNull()).select("*", F.lit(0).alias("_lent"))
    line = Window.partitionBy("_bucket").orderBy("_lent", F.col(ident).desc(), *mine)
    joined = own.unionByName(borrowed).select(
        ident, *mine, "_lent", *[F.lead(c).over(line).alias(f"next_{n}") for n, c in zip(payload, mine)]
    )
    return joined.where(F.col("_lent") == 0).drop("_lent").unionByName(alone)


def edited_text(text: Column, following: Column) -> Column:
    """The text with its last half (rounded down, in code points) replaced by as much of the start of another."""
    n = F.length(text)
    half = F.floor(n / 2).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - half), F.substring(following, F.lit(1), half))


def compare_edited(docs: DataFrame, fraction: float = FRACTION, size: int = SHINGLE) -> DataFrame:
    """Fingerprint of each text, of its edited text and their likeness, and the likeness to the next document.

    ``docs(doc_id, text)`` gives ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    kept_edited``; the edited text has the last half replaced by the start of the next document in descending order of
    ``doc_id`` (after the last: the first), ``kept_edited`` is the share of the text's shingles found in it. Null texts are
    empty ones; empty texts have an empty fingerprint, likeness 1 to each other and 0 to any other. A row with a null id is its own
    next; rows that repeat an id follow each other. Other columns are ignored; whole texts are used, however long.
    """
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    told = with_next(base.select("*", sketch(F.col("text"), fraction, size).alias("hashes")), "doc_id", ["text", "hashes"])
    edited = told.select(
        "doc_id", F.length("text").cast("long").alias("n_chars"), "hashes", "next_hashes",
        edited_text(F.col("text"), F.col("next_text")).alias("edited"),
    )
    hashed = edited.select(
        "doc_id", "n_chars", "hashes", "next_hashes", F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("edited"), fraction, size).alias("edited_hashes"),
    )
    return hashed.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        fingerprint(F.col("hashes")).alias("fingerprint"),
        fingerprint(F.col("edited_hashes")).alias("edited_fingerprint"),
        resemblance(F.col("hashes"), F.col("edited_hashes")).alias("near_edited"),
        resemblance(F.col("hashes"), F.col("next_hashes")).alias("near_next"),
        containment(F.col("hashes"), F.col("edited_hashes")).alias("kept_edited"),
    )
