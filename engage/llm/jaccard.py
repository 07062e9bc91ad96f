"""Exact Jaccard similarity join of word shingles, by regions around pivots.

The space is that of shingle sets under the size of the symmetric difference. Documents as pivots do not part it: nearly
all texts are at the same distance (no common shingle) from nearly all others, so every window would hold everything.
Pivots of the first kind are therefore single shingles. All shingles have one common order; the distance of a set to a shingle it
holds is the number of its shingles before that one, and its region is that of its nearest pivot, its first shingle. Two
linked sets differ in few shingles, and their first common shingle is preceded in each by shingles of the difference alone.
So a set is also placed in the regions of the next shingles, as far as the difference may reach (the window of boundary
documents), and every linked pair meets in the region of its first common shingle.

Within a region, documents are pivots of the second kind: each set is compared with two of them, which joins groups of
near copies without comparing all their pairs. Regions whose sets are then all in one component are done. In the others
only sets of different components are paired; a region too large for that is cut again, by the second common shingle, and so
on. Two exact bounds keep pairs from being compared in full: sizes and places of the common shingle, and a parity
sketch, whose distance never exceeds that of the sets. Every set takes its sketch into its regions, into small ones folded no
further than sets without a common shingle can be told by, so that the pairs that leave a region do not grow with its square.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.llm import words
from engage.llm.bloom import blocked_filter, may_hold
from engage.llm.common import WORD, free_name, written
from engage.llm.components import components

SHINGLE = 3
PERCENT = 90
HASH_BITS = 52  # of a shingle; the rest of a 64-bit word numbers the texts of a chunk
SKETCH = 512  # bits of the parity sketch, at least; doubled until there is one for every two shingles
FREQUENT = 1 << 16  # most frequent shingles, which come last in the order; bounds the list that travels to all tasks
OFTEN = 5000  # a shingle is frequent if more than one in so many documents has it
SEEN = 4  # documents of one batch that must have a shingle for it to be counted
SMALL = 64  # sets of a region that are paired in one row
REGION = 2000  # sets of a region that are paired without cutting it again
DEPTH = 4  # common shingles by which regions are cut, at most
IDENT = ["s1", "s2", "n"]  # what tells sets apart
GATHER = 1 << 22  # shingles that are counted at once


def shingle_sets(texts: pa.Array, size: int = SHINGLE) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, hashes, bounds`` of runs of texts: the distinct shingles of each, ascending."""
    mask = np.uint64((1 << HASH_BITS) - 1)
    for first, last, data, bounds in words.chunks(texts, most_rows=1 << (64 - HASH_BITS)):
        starts, ends, place = words.word_bounds(data, bounds)
        hashed = words.word_hashes(data, starts, ends, lower=True)
        count = np.diff(place)
        row = np.repeat(np.arange(last - first, dtype=np.uint64), count)
        keys = np.zeros(0, dtype=np.uint64)
        if len(hashed) >= size:
            grams = words.gram_hashes(hashed, size)
            whole = row[: len(grams)] == row[size - 1 :]
            keys = (row[: len(grams)][whole] << np.uint64(HASH_BITS)) | (grams[whole] & mask)
        for k in range(1, size):  # shorter texts are one shingle
            short = np.flatnonzero(count == k)
            if len(short):
                h = np.full(len(short), k, dtype=np.uint64)
                for j in range(k):
                    h = words.mix64(h + hashed[place[short] + j])
                keys = np.concatenate([keys, (short.astype(np.uint64) << np.uint64(HASH_BITS)) | (h & mask)])
        keys = np.sort(keys)
        if len(keys):
            keys = keys[np.concatenate([[True], keys[1:] != keys[:-1]])]
        edges = np.searchsorted(keys, np.arange(last - first, dtype=np.uint64) << np.uint64(HASH_BITS))
        yield first, last, (keys & mask).astype(np.int64), np.append(edges, len(keys))


def frequent_shingles(docs: DataFrame, size: int = SHINGLE) -> np.ndarray:
    """The shingles of more than one in ``OFTEN`` documents, at most ``FREQUENT`` of them, ascending.

    Each batch of documents counts its own and hands on those it saw several times. What the list holds decides only the
    order of shingles, hence the size of regions, never the result.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def counted() -> pa.RecordBatch:
            # Sorted in place, so that no more than one copy is held: only runs of at least SEEN equal values count.
            found = np.concatenate(held)
            held.clear()
            found.sort()
            fresh = np.concatenate([[True], found[1:] != found[:-1]])[: len(found)]
            starts = np.flatnonzero(fresh[: max(0, len(found) - SEEN + 1)])
            start = starts[found[starts] == found[starts + SEEN - 1]]
            values = found[start]
            n = np.searchsorted(found, values, side="right") - start
            return pa.RecordBatch.from_arrays([pa.array(values), pa.array(n)], names=["shingle", "n"])

        for batch in batches:
            for _, _, hashes, _ in shingle_sets(batch.column(0), size):
                held.append(hashes)
                if sum(map(len, held)) > GATHER:
                    yield counted()
        if held:
            yield counted()

    least = max(SEEN, docs.count() // OFTEN)
    found = (
        docs.select("text")
        .mapInArrow(count, "shingle long, n long")
        .groupBy("shingle")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > least)
        .orderBy(F.desc("n"), "shingle")
        .limit(FREQUENT)
    )
    return np.sort(found.select("shingle").toArrow().column(0).to_numpy().astype(np.int64))


def described(docs: DataFrame, frequent: np.ndarray, size: int, percent: int) -> DataFrame:
    """``doc_id, tag, n, s1, s2, sketch, prefix``: a hash of the text, the number of shingles, two sums that tell sets apart, the parity sketch, and
    the first shingles of the set in the order (frequent ones last, then by hash), as far as a difference may reach, and
    ``DEPTH - 1`` more."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, bounds in shingle_sets(batch.column(2), size):
                n = np.diff(bounds)
                row = np.repeat(np.arange(last - first), n)
                spread = words.mix64(hashes.astype(np.uint64))
                twice = words.mix64(spread ^ np.uint64(0x5DEECE66D))
                full = n > 0
                sums = np.zeros((2, last - first), dtype=np.uint64)
                for k, h in enumerate((spread, twice)):
                    if full.any():
                        sums[k, full] = np.add.reduceat(h, bounds[:-1][full])
                # Parity of the number of shingles that fall on each bit.
                bits = SKETCH << np.maximum(0, np.ceil(np.log2(np.maximum(n, 1) / (2 * SKETCH)))).astype(np.int64)
                base = np.concatenate([[0], np.cumsum(bits)])
                at = base[row] + (twice & (bits[row] - 1).astype(np.uint64)).astype(np.int64)
                odd = (np.bincount(at, minlength=int(base[-1])) & 1).astype(np.uint8)
                packed = np.packbits(odd, bitorder="little").view("<i8")
                late = np.zeros(len(hashes), dtype=np.int64)
                if len(frequent) and len(hashes):
                    at = np.minimum(np.searchsorted(frequent, hashes), len(frequent) - 1)
                    late = (frequent[at] == hashes).astype(np.int64)
                order = np.argsort((row * 2 + late), kind="stable")  # hashes ascend within a row already
                key = hashes[order] | (late[order] << HASH_BITS)
                place = np.arange(len(hashes)) - np.repeat(bounds[:-1], n)
                reach = np.minimum(n, n - (percent * n + 99) // 100 + DEPTH)
                front = place < np.repeat(reach, n)
                ends = np.concatenate([[0], np.cumsum(reach)]).astype(np.int32)
                width = (base >> 6).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(1).slice(first, last - first),
                        pa.array(n.astype(np.int64)),
                        pa.array(sums[0].view(np.int64)),
                        pa.array(sums[1].view(np.int64)),
                        pa.ListArray.from_arrays(pa.array(width), pa.array(packed)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(key[front])),
                    ],
                    names=["doc_id", "tag", "n", "s1", "s2", "sketch", "prefix"],
                )

    return docs.select("doc_id", _tag().alias("tag"), "text").mapInArrow(
        describe, "doc_id long, tag long, n long, s1 long, s2 long, sketch array<long>, prefix array<long>"
    )


def least_common(n: Column, m: Column, percent: int) -> Column:
    """Shingles that two sets of n and m must share to be linked."""
    return F.ceil(F.lit(percent) * (n + m) / F.lit(100 + percent))


def _may_link(n: Column, i: Column, m: Column, j: Column, before: Column, percent: int) -> Column:
    """Sizes n and m with a common shingle after i and j others, of which ``before`` are common too, allow a link."""
    return F.least(n - i, m - j) + before >= least_common(n, m, percent)


def _near_sketches(a: Column, b: Column, n: Column, m: Column, percent: int) -> Column:
    """Whether the parity sketches allow a link. The larger is folded to the size of the smaller; sets whose sizes allow a link have
    sketches of the same size or of the next one or two."""
    xor = lambda x, y: x.bitwiseXOR(y)
    half = lambda s, size: F.zip_with(F.slice(s, F.lit(1), size), F.slice(s, size + 1, size), xor)
    once = lambda s, t: F.when(F.size(s) > F.size(t), half(s, F.floor(F.size(s) / 2).cast("int"))).otherwise(s)
    fold = lambda s, t: once(once(s, t), t)
    distance = F.aggregate(F.zip_with(fold(a, b), fold(b, a), lambda x, y: F.bit_count(xor(x, y))), F.lit(0), lambda t, c: t + c)
    return distance <= n + m - 2 * least_common(n, m, percent)


def jaccard_components(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, n_shingles, component_id`` for each row of ``docs(doc_id, text)``.

    A document's set holds its distinct runs of ``size`` words (A-Z lower-cased); one with fewer words is a single shingle, one
    without words or with a null text is empty and linked with nothing. Documents are linked when ``100 * common >= percent *
    union``; ``component_id`` is the smallest ``doc_id`` that links reach, the document's own included. All links count: none is left
    out for the size of a group.

    Rows with the same set, repeated ones among them, form one class, which is compared once. Rows are told apart by their
    sets, not by their ids, so rows that repeat an id with other texts each have their own links. A row with a null id links like any
    other but names no component; if no row of its component has an id, its component is null. An empty table gives no rows; other
    columns are ignored.
    """
    table, reached = _reached(docs, size, percent)
    least = reached.groupBy("root").agg(F.min("best.doc_id").alias("component"))
    named = reached.join(least, "root").select(*IDENT, "component")
    return table.select("doc_id", *IDENT).join(named, IDENT, "left").select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    )


def one_of_each_group(docs: DataFrame, size: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """``docs`` with one row of each component of linked documents: that with the smallest ``doc_id`` (null after all
    others, then by a hash of the text). Rows without words are linked with nothing and all stay. Columns pass through."""
    _, reached = _reached(docs, size, percent)
    own, own_id = free_name(docs, "_own"), free_name(docs, "_id")
    best = reached.groupBy("root").agg(F.min("best").alias("best"))
    chosen = best.select(F.col("best.doc_id").alias(own_id), F.col("best.tag").alias(f"{own}_tag"))
    wordless = ~F.coalesce(F.col("text").rlike(WORD), F.lit(False))
    rows = docs.where(~wordless).withColumn(own, _tag())
    same = F.equal_null(F.col("doc_id").cast("long"), F.col(own_id)) & (F.col(own) == F.col(f"{own}_tag"))
    kept = rows.join(chosen, same, "left_semi")
    return kept.dropDuplicates(["doc_id", own]).drop(own).unionByName(docs.where(wordless))


def _tag() -> Column:
    return F.xxhash64("text")


def _reached(docs: DataFrame, size: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The description of each row, and for each class of equal sets its best row and the root of its component."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table = written(described(docs, frequent_shingles(docs, size), size, percent), "sets")
    best = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tag"))
    classes = written(
        table.where("n > 0")
        .groupBy(*IDENT)
        .agg(best.alias("best"), F.first("sketch").alias("sketch"), F.first("prefix").alias("prefix"))
        .select(F.col("s1").alias("node"), *IDENT, "best", "sketch", "prefix"),
        "classes",
    )
    reached = classes.join(_joined(docs, classes, size, percent), "node", "left")
    return table, reached.select(*IDENT, "best", F.coalesce("component", "node").alias("root"))


def _joined(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """``node, component`` of the linked classes."""
    window = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1
    places = classes.select("n", F.posexplode("prefix").alias("place", "key")).where(F.col("place") < window)
    regions = written(places.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1"), "regions")
    small, large = regions.where(F.col("sets") <= SMALL), regions.where(F.col("sets") > SMALL)
    in_small, in_large = blocked_filter(small.select("key")), blocked_filter(large.select("key"))

    members = written(_postings(classes, in_large, percent, whole=True).join(large, "key"), "members")
    stars = _small_pairs(_postings(classes, in_small, percent).join(small, "key"), True, percent)
    links = _linked(docs, classes, stars.union(_star_pairs(members, 1, percent)).distinct(), size, percent)
    reached = components(links)

    told = classes.join(reached, "node", "left")
    # Of three sets the first and the last have been compared with all.
    several = small.where(F.col("sets") > 3)
    crossed = _small_pairs(_postings(told, blocked_filter(several.select("key")), percent).join(several, "key"), False, percent)
    open_ = written(_unsettled(members, reached), "open")
    for depth in range(1, DEPTH + 1):
        pairs = _region_pairs(open_.where(F.col("sets") <= REGION), depth, percent)
        rest = open_.where(F.col("sets") > REGION)
        if depth == 1:
            pairs = pairs.union(crossed)
        if depth == DEPTH:
            pairs = pairs.union(_cross_pairs(rest, depth, percent))
        links = written(links.union(_linked(docs, classes, pairs.distinct(), size, percent)), "links")
        if depth == DEPTH or rest.isEmpty():
            break
        cut = _cut_again(rest, classes, depth, percent)
        counted = cut.groupBy("key").agg(F.count("*").alias("sets")).where("sets > 1")
        members = written(cut.join(counted, "key"), "members")
        links = written(links.union(_linked(docs, classes, _star_pairs(members, depth + 1, percent), size, percent)), "links")
        open_ = written(_unsettled(members, components(links)), "open")
    return components(links)


_POSTING = "key long, node long, n long, place long, component long, sketch array<long>"
_PAIR = "a long, b long"
_MEMBER = ["node", "n", "place", "component", "sketch"]
COMPARED = 1 << 18  # words of sketches that are compared at once
MEMBERS = 1 << 13  # members of small regions that are paired at once; also places that are handed on at once


def _postings(classes: DataFrame, table: np.ndarray, percent: int, whole: bool = False) -> DataFrame:
    """The places of each set in regions that may be in the filter, with its component and its sketch, folded or ``whole``."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, n, component = (batch.column(k).to_numpy(zero_copy_only=False) for k in range(3))
            prefix = batch.column(3)
            offsets, keys = prefix.offsets.to_numpy(), prefix.flatten().to_numpy()
            row = np.repeat(np.arange(len(node)), np.diff(offsets))
            place = np.arange(len(keys)) - (offsets[:-1] - offsets[0])[row]
            kept = np.flatnonzero(place < (n - (percent * n + 99) // 100 + 1)[row])
            kept = kept[may_hold(table, keys[kept])]
            sketches = batch.column(4) if whole else _small_sketches(n, batch.column(4), percent)
            # A few at a time: sketches are repeated in every region of their set.
            for k in range(0, len(kept), MEMBERS):
                at = kept[k : k + MEMBERS]
                own = row[at]
                columns = [keys[at], node[own], n[own], place[at], component[own]]
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(c, type=pa.int64()) for c in columns], sketches.take(pa.array(own))],
                    names=[c.split()[0] for c in _POSTING.split(", ")],
                )

    component = F.coalesce("component", "node") if "component" in classes.columns else F.col("node")
    return classes.select("node", "n", component.alias("component"), "prefix", "sketch").mapInArrow(emit, _POSTING)


def _small_sketches(n: np.ndarray, sketch: pa.ListArray, percent: int) -> pa.ListArray:
    """Sketches folded to the fewest words that tell sets without a common shingle from linked ones: half of the bits differ for
    the former, by four standard deviations more than may for the latter."""
    offsets = sketch.offsets.to_numpy().astype(np.int64)
    words_, start, width = sketch.flatten().to_numpy(), offsets[:-1] - offsets[0], np.diff(offsets)
    differ = 2 * n * (100 - percent) / (100 + percent)
    bits = np.full(len(n), 64.0)
    for _ in range(40):
        spread = np.minimum(np.sqrt(bits) / 2, 2 * n * np.sqrt(2 / bits))
        bits = np.where(bits / 2 * (1 - np.exp(-4 * n / bits)) < differ + 4 * spread, 2 * bits, bits)
    target = np.minimum(width, np.minimum(bits, 1 << 30).astype(np.int64) >> 6)
    ends = np.concatenate([[0], np.cumsum(target)])
    out = np.zeros(int(ends[-1]), dtype=np.int64)
    for w, t in {*zip(width.tolist(), target.tolist())}:
        rows = np.flatnonzero((width == w) & (target == t))
        whole = words_[start[rows][:, None] + np.arange(w)].reshape(len(rows), w // t, t)
        out[ends[rows][:, None] + np.arange(t)] = np.bitwise_xor.reduce(whole, axis=1)
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(out))


class _Regions:
    """Members of regions as arrays, ordered by region and node."""

    def __init__(self, region: np.ndarray, node, n, place, component, sketch: pa.ListArray, common: int, percent: int):
        order = np.lexsort((node, region))
        self.region, self.node, self.n, self.place, self.component = (c[order] for c in (region, node, n, place, component))
        offsets = sketch.offsets.to_numpy().astype(np.int64)
        self.words = sketch.flatten().to_numpy().view(np.uint64)
        self.start, self.width = (offsets[:-1] - offsets[0])[order], np.diff(offsets)[order]
        self.common, self.percent = common, percent

    def near(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which pairs of members of different components sizes, places and sketches allow a link."""
        n, m = self.n[a], self.n[b]
        need = -(-self.percent * (n + m) // (100 + self.percent))
        ok = np.minimum(n - self.place[a], m - self.place[b]) + self.common >= need
        ok &= (self.component[a] != self.component[b]) & (np.maximum(n, m) * self.percent <= np.minimum(n, m) * 100)
        at = np.flatnonzero(ok)
        width = np.minimum(self.width[a[at]], self.width[b[at]])
        for w in np.unique(width):
            rows = at[width == w]
            for part in np.array_split(rows, -(-len(rows) * int(w) // COMPARED)):
                differ = np.bitwise_count(self._folded(a[part], w) ^ self._folded(b[part], w)).sum(axis=1, dtype=np.int64)
                ok[part] = differ <= n[part] + m[part] - 2 * need[part]
        return ok

    def _folded(self, x: np.ndarray, width: int) -> np.ndarray:
        """Sketches in so many words. A larger one is the exclusive or of its parts: the parity of a union of bits is that of their sum."""
        at = self.start[x][:, None] + np.arange(width)
        out = self.words[at]
        for k in range(1, int(self.width[x].max()) // int(width)):
            more = np.flatnonzero(self.width[x] > k * width)
            out[more] ^= self.words[at[more] + k * width]
        return out

    def pairs(self, steps: bool) -> np.ndarray:
        """Each pair once, smaller node first: of all members, or of each with the first and the last of its region."""
        every = np.arange(len(self.node))
        starts = np.flatnonzero(np.concatenate([[True], self.region[1:] != self.region[:-1]]))[: len(every)]
        ends = np.append(starts[1:], len(every))
        found = [np.zeros((2, 0), dtype=np.int64)]
        if steps:
            tried = ((a, a + step) for step in range(1, int((ends - starts).max(initial=1))) for a in [every[: len(every) - step]])
            tried = ((a[same], b[same]) for a, b in tried for same in [self.region[a] == self.region[b]])
        else:
            own = np.repeat(np.arange(len(starts)), ends - starts)
            tried = ((pivot[own], every) for pivot in (starts, ends - 1))
        for a, b in tried:
            ok = self.near(a, b)
            found.append(np.stack([self.node[a[ok]], self.node[b[ok]]]))
        pairs = np.sort(np.concatenate(found, axis=1), axis=0)
        pairs = pairs[:, np.lexsort(pairs[::-1])]
        fresh = np.ones(pairs.shape[1], dtype=bool)
        fresh[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
        return pairs[:, fresh]


def _small_pairs(members: DataFrame, stars: bool, percent: int) -> DataFrame:
    """Pairs ``a, b`` of small regions that sizes, places and sketches allow: of each set with the region's first and
    last, or of all sets of different components."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets, first = batch.column(0).offsets.to_numpy(), 0
            while first < batch.num_rows:
                last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + MEMBERS, side="right")) - 1)
                lists = batch.column(0).slice(first, last - first)
                flat = lists.flatten()
                region = np.repeat(np.arange(last - first), np.diff(offsets[first : last + 1]))
                node, n, place, component = (flat.field(k).to_numpy() for k in range(4))
                pairs = _Regions(region, node, n, place, component, flat.field(4), 0, percent).pairs(steps=not stars)
                yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])
                first = last

    lists = members.groupBy("key").agg(F.collect_list(F.struct(*_MEMBER)).alias("members"))
    return lists.select("members").mapInArrow(emit, _PAIR)


def _region_pairs(members: DataFrame, depth: int, percent: int) -> DataFrame:
    """Pairs ``a, b`` of sets of different components in regions of bounded size; the key stands for ``depth`` common shingles."""

    def emit(region: pa.Table) -> pa.Table:
        region = region.combine_chunks()
        node, n, place, component = (region[c].to_numpy() for c in _MEMBER[:4])
        sketch = region["sketch"].chunk(0)
        pairs = _Regions(np.zeros(len(node), dtype=np.int64), node, n, place, component, sketch, depth - 1, percent).pairs(steps=True)
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return members.select("key", *_MEMBER).groupBy("key").applyInArrow(emit, _PAIR)


def _with_sketches(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` that the whole sketches allow."""
    side = lambda c: classes.select(F.col("node").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"s_{c}"))
    near = _near_sketches(F.col("s_a"), F.col("s_b"), F.col("n_a"), F.col("n_b"), percent)
    return pairs.join(side("a"), "a").join(side("b"), "b").where(near).select("a", "b")


def _star_pairs(members: DataFrame, depth: int, percent: int) -> DataFrame:
    """Each set with two documents of each of its regions, the region's pivots, where sizes, places and sketches allow a link."""
    pick = F.struct("node", "n", "place", "sketch")
    pivots = members.groupBy("key").agg(F.min_by(pick, "node").alias("one"), F.min_by(pick, F.xxhash64("node", "key")).alias("two"))
    pivots = pivots.select("key", F.explode(F.array("one", "two")).alias("p"))
    return (
        members.select("key", "node", "n", "place", "sketch")
        .join(pivots, "key")
        .where(
            (F.col("node") != F.col("p.node"))
            & (F.greatest("n", "p.n") * percent <= F.least("n", "p.n") * 100)
            & _may_link(F.col("n"), F.col("place"), F.col("p.n"), F.col("p.place"), F.lit(depth - 1), percent)
            & _near_sketches(F.col("sketch"), F.col("p.sketch"), F.col("n"), F.col("p.n"), percent)
        )
        .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b"))
        .distinct()
    )


def _unsettled(members: DataFrame, reached: DataFrame) -> DataFrame:
    """Members, with their component, of regions that hold more than one component."""
    told = members.drop("component").join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = told.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi")
    return told.join(mixed.select("key"), "key").select("key", "sets", *_MEMBER)


def _cross_pairs(members: DataFrame, depth: int, percent: int) -> DataFrame:
    """Pairs of sets of different components of a region of any size, where a link is possible.

    Sets meet in bands of size as well: linked sizes lie in the same band or in the next, so the smaller set goes to
    its own band and to the one above.
    """
    band = F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent)) + 1e-9)
    side = lambda c: [F.col(m).alias(f"{m}_{c}") for m in _MEMBER]
    left = members.select("key", *side("x"), F.explode(F.array(band, band + 1)).alias("band"))
    right = members.select("key", *side("y"), band.alias("band"))
    smaller = (F.col("n_x") < F.col("n_y")) | ((F.col("n_x") == F.col("n_y")) & (F.col("node_x") < F.col("node_y")))
    return (
        left.join(right, ["key", "band"])
        .where((F.col("component_x") != F.col("component_y")) & smaller)
        .where(_may_link(F.col("n_x"), F.col("place_x"), F.col("n_y"), F.col("place_y"), F.lit(depth - 1), percent))
        .where(F.greatest("n_x", "n_y") * percent <= F.least("n_x", "n_y") * 100)
        .where(_near_sketches(F.col("sketch_x"), F.col("sketch_y"), F.col("n_x"), F.col("n_y"), percent))
        .select(F.least("node_x", "node_y").alias("a"), F.greatest("node_x", "node_y").alias("b"))
    )


def _cut_again(members: DataFrame, classes: DataFrame, depth: int, percent: int) -> DataFrame:
    """Postings of large regions under their key and one more common shingle, later in the order.

    Linked sets that share fewer shingles than the next depth would be lost; sets so small are never cut: there are
    no more distinct ones of them in a region than shingles allow, and they stay in regions of their own.
    """
    enough = F.floor((percent * F.col("n") + 99) / 100) > depth
    window = F.col("n") - F.floor((percent * F.col("n") + 99) / 100) + 1 + depth
    more = (
        members.where(enough)
        .select("key", "node", "n", "place", "sketch")
        .join(classes.select("node", "prefix"), "node")
        .select("key", "node", "n", "sketch", F.col("place").alias("last"), F.posexplode("prefix").alias("place", "next"))
        .where((F.col("place") > F.col("last")) & (F.col("place") < window))
        .select(F.xxhash64("key", "next").alias("key"), "node", "n", "place", "sketch")
    )
    few = members.where(~enough).select(F.xxhash64("key", F.lit("few")).alias("key"), "node", "n", "place", "sketch")
    return more.unionByName(few)


def _linked(docs: DataFrame, classes: DataFrame, pairs: DataFrame, size: int, percent: int) -> DataFrame:
    """``u, v`` of the candidate pairs ``a, b`` that are linked, by their full sets; written.

    Only documents of candidate pairs are turned into sets again: a bounded filter of their rows travels to the scan, so texts
    do not move.
    """
    pairs = written(_with_sketches(pairs, classes, percent), "pairs")
    nodes = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    wanted = blocked_filter(classes.join(nodes, "node").select(F.xxhash64("best.doc_id", "best.tag").alias("row")))

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).filter(pa.array(may_hold(wanted, batch.column(0).to_numpy())))
            for _, _, hashes, bounds in shingle_sets(texts, size):
                full = np.diff(bounds) > 0
                sums = np.add.reduceat(words.mix64(hashes.astype(np.uint64)), bounds[:-1][full]) if full.any() else bounds[:0]
                lists = pa.ListArray.from_arrays(pa.array(np.append(bounds[:-1][full], bounds[-1]).astype(np.int32)), pa.array(hashes))
                yield pa.RecordBatch.from_arrays([pa.array(sums.astype(np.uint64).view(np.int64)), lists], names=["node", "set"])

    texts = docs.select(F.xxhash64("doc_id", _tag()).alias("row"), "text")
    held = written(texts.mapInArrow(sets, "node long, set array<long>").join(nodes, "node", "left_semi"), "full")
    # A class may have been read more than once, by rows that repeat its set and id.
    held = held.groupBy("node").agg(F.first("set").alias("set"))

    both = pairs.join(held.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
        held.select(F.col("node").alias("b"), F.col("set").alias("y")), "b"
    )
    common = F.size(F.array_intersect("x", "y"))
    linked = 100 * common >= percent * (F.size("x") + F.size("y") - common)
    return written(both.where(linked).select(F.col("a").alias("u"), F.col("b").alias("v")), "links")
