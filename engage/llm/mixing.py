"""Mixing sources to target weights: whole epochs, then a subset of documents that fits the rest of the budget.

Each source has a target number of words. As many whole passes over the source as fit are taken; what remains of the
target is filled with a subset of its documents. The subset is chosen by length alone: from the histogram of exact
lengths, every length first gives its proportional share, then long documents are added while they fit, and a
bounded-knapsack dynamic program over the leftover documents of each length hits the last ``WINDOW`` words, or twice the
longest document if that is more, as closely as possible. The histogram, not the documents, reaches a task, so a source with a third of all rows costs no more than
another. Which documents of a length are taken is decided by a seeded hash.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from engage.llm.common import free_name, word_count

WEIGHTS = (3.0, 1.0, 2.0)
SHARE = 1.5
MAX_REPEATS = 2
SEED = 20240229
WINDOW = 1 << 14  # words left for the exact dynamic program, at least
BUCKETS = 64  # hash buckets in which the documents of one length are ranked


def targets(sources: DataFrame, weights: tuple[float, ...], share: float, max_repeats: int) -> DataFrame:
    """``source, source_size, target`` from ``source, source_size``, one row for each source.

    Sources in code point order, null last, take the weights in turn and share ``share`` times the sum of all sizes. A
    target stops at ``max_repeats`` times the source's size; the excess is shared again by weight among the others until
    none is above. One task sees one row for each source, never documents.
    """

    def share_out(groups: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(groups), ignore_index=True)
        if not len(pdf):
            return
        order = sorted(range(len(pdf)), key=lambda i: (pdf["source"][i] is None, pdf["source"][i] or ""))
        size = [int(pdf["source_size"][i]) for i in order]
        weight = [weights[k % len(weights)] for k in range(len(order))]
        cap = [float(max_repeats * n) for n in size]
        target: list[float | None] = [None] * len(order)
        left = share * sum(size)
        while True:
            free = [k for k in range(len(order)) if target[k] is None]
            total = sum(weight[k] for k in free)
            above = [k for k in free if left * weight[k] / total > cap[k]] if free else []
            for k in above:
                target[k] = cap[k]
            if not above:
                for k in free:
                    target[k] = left * weight[k] / total
                break
            left -= sum(cap[k] for k in above)
        yield pd.DataFrame({"source": [pdf["source"][i] for i in order], "source_size": size, "target": target})

    return sources.coalesce(1).mapInPandas(share_out, "source string, source_size long, target double")


def knapsack(lengths: list[int], counts: list[int], budget: int) -> list[int]:
    """How many of each length to take so that their sum is the largest possible one up to ``budget``.

    Bounded knapsack over sums 0 .. budget: reachable sums are the bits of an integer, each length enters in binary
    portions of its count, and the portions used are read back from the stored bit sets.
    """
    parts: list[tuple[int, int]] = []
    for k, (n, c) in enumerate(zip(lengths, counts)):
        c, step = min(c, budget // n if n else 0), 1
        while c > 0:
            parts.append((k, min(step, c)))
            c -= step
            step *= 2
    mask, reach, before = (1 << (budget + 1)) - 1, 1, []
    for k, times in parts:
        before.append(reach)
        reach |= (reach << (lengths[k] * times)) & mask
        if reach >> budget & 1:
            break
    left, taken = reach.bit_length() - 1, [0] * len(lengths)
    for (k, times), earlier in zip(reversed(parts[: len(before)]), reversed(before)):
        if not earlier >> left & 1:
            left -= lengths[k] * times
            taken[k] += times
    return taken


def fit(lengths: list[int], counts: list[int], budget: int, window: int = WINDOW) -> list[int]:
    """Documents to take of each length (``lengths`` ascending and positive) for a sum close to ``budget``, not above.

    Proportional share first, so that all lengths are represented; then the longest that fit, down to the window; then
    the exact dynamic program. The window holds the two longest documents at least, so that the choice among long ones is the
    program's. Its cost is bounded by the window and the number of different lengths.
    """
    window = max(window, 2 * max(lengths, default=0))
    whole = sum(n * c for n, c in zip(lengths, counts))
    if budget >= whole:
        return list(counts)
    # Leave the window free, so that the program has a choice of short and long documents.
    take = [c * max(0, budget - window) // whole for c in counts]
    left = budget - sum(n * t for n, t in zip(lengths, take))
    for k in range(len(lengths) - 1, -1, -1):
        if left <= window:
            break
        more = min(counts[k] - take[k], max(0, -(-(left - window) // lengths[k])), left // lengths[k])
        take[k] += more
        left -= more * lengths[k]
    rest = knapsack(lengths, [c - t for c, t in zip(counts, take)], left)
    return [t + r for t, r in zip(take, rest)]


def _order(ident: Column, seed: int) -> Column:
    return F.xxhash64(ident, F.lit(seed))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    max_repeats: int = MAX_REPEATS,
    seed: int = SEED,
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """``keep..., size, source_size, target, copies`` for each row of ``docs(doc_id, text, source, ...)``.

    ``size`` is the number of words of the whole text (0 for null), ``copies`` how often the mix takes the row: the
    whole passes over its source, and one more if the row is in the fitted subset. Rows without words get the passes
    only. Repeated rows are separate rows; among equal hashes (repeated ids) the order is arbitrary, the number taken is
    not. A null source is a source of its own; an empty table gives no rows. ``keep`` names the columns returned besides
    the computed ones and must not clash with them.

    Two passes over the texts (the histogram and the result), which count words only; documents are shuffled without
    their text unless ``keep`` asks for it.
    """
    size = word_count(F.col("text"))
    bucket = F.pmod(_order(F.col("doc_id"), seed), F.lit(BUCKETS)).cast("int")
    histogram = docs.groupBy("source", size.alias("size"), bucket.alias("_bucket")).agg(F.count("*").alias("n"))
    sources = histogram.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    goal = targets(sources, weights, share, max_repeats)

    def fit_source(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["size", "_bucket"], kind="stable").reset_index(drop=True)
        whole = int(pdf["source_size"].iloc[0])
        target = float(pdf["target"].iloc[0])
        passes = min(max_repeats, int(target // whole)) if whole else 0
        left = int(target - passes * whole) if passes < max_repeats else 0
        counted = pdf[pdf["size"] > 0].groupby("size")["n"].sum()
        lengths, counts = [int(x) for x in counted.index], [int(x) for x in counted]
        wanted = dict(zip(lengths, fit(lengths, counts, left))) if left > 0 and lengths else {}
        # Whole buckets in turn, then a part of one.
        pdf["_before"] = pdf.groupby("size")["n"].cumsum() - pdf["n"]
        want = pdf["size"].map(wanted).fillna(0).astype("int64")
        pdf["_take"] = (want - pdf["_before"]).clip(lower=0)
        pdf["_take"] = pdf[["_take", "n"]].min(axis=1)
        pdf["_passes"] = passes
        return pdf[["source", "size", "_bucket", "source_size", "target", "n", "_take", "_passes"]]

    plan = (
        histogram.join(goal, F.equal_null(histogram["source"], goal["source"]))
        .select(histogram["source"], "size", "_bucket", "n", "source_size", "target")
        .groupBy("source")
        .applyInPandas(
            fit_source,
            "source string, size long, _bucket int, source_size long, target double, n long, _take long, _passes int",
        )
    )
    rows = docs.select(*keep, "source", size.alias("size"), bucket.alias("_bucket"), _order(F.col("doc_id"), seed).alias("_hash"))
    p = plan.select(*[F.col(c).alias(f"{c}_") for c in plan.columns])
    joined = rows.join(
        p,
        F.equal_null("source", F.col("source_")) & (F.col("size") == F.col("size_")) & (F.col("_bucket") == F.col("_bucket_")),
    )
    # Only a bucket that is taken in part needs ranks; rows of all others spread by their hash.
    partial = (F.col("_take_") > 0) & (F.col("_take_") < F.col("n_"))
    spread = F.when(partial, F.lit(0).cast("long")).otherwise(F.col("_hash"))
    ranked = joined.withColumn("_spread", spread).withColumn(
        "_rank", F.row_number().over(Window.partitionBy("source", "size", "_bucket", "_spread").orderBy("_hash"))
    )
    chosen = F.col("_rank") <= F.col("_take_")
    return ranked.select(
        *keep,
        "size",
        F.col("source_size_").alias("source_size"),
        F.col("target_").alias("target"),
        (F.col("_passes_") + F.when(chosen, 1).otherwise(0)).cast("int").alias("copies"),
    )


def repeat(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with each row as often as the mix takes it; columns pass through.

    The rows' texts move once, to the decisions on them, which are made without texts.
    """
    plain = docs.select("doc_id", "source", "text")
    tag = F.xxhash64("text", "source")
    taken = (
        mix(plain.withColumn("_tag", tag), keep=("doc_id", "_tag"), **options)
        .groupBy("doc_id", "_tag")
        .agg(F.sum("copies").cast("int").alias("times"))
        .where("times > 0")
    )
    own_tag, own_id, times = (free_name(docs, name) for name in ("_tag", "_id", "_times"))
    taken = taken.select(F.col("doc_id").alias(own_id), F.col("_tag").alias(f"{own_tag}_of"), F.col("times").alias(times))
    rows = docs.withColumn(own_tag, tag)
    met = rows.join(taken, F.equal_null("doc_id", F.col(own_id)) & (F.col(own_tag) == F.col(f"{own_tag}_of")))
    # Repeated rows were counted together.
    once = met.dropDuplicates(["doc_id", own_tag])
    return once.withColumn(times, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*docs.columns)
