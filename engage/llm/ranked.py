"""Ranked lexical search by range-maximum queries over posting lists.

Each task inverts its documents shard by shard. A posting list has the impact of its term on each document, in the order of
the documents, and a sparse table that gives the place of the largest impact in any run of the list. An
item's search starts with the whole shard as one interval of documents. The sum of its terms' maxima bounds the score of any
document of an interval; intervals are taken by falling bound. One is split at the document with the largest impact of any of
the item's terms: that document is scored, both rests are bounded and put back. Intervals with few postings are scored whole.
The search ends when no bound reaches the k-th best score; this score is carried from shard to shard of a task, so later
shards are mostly dismissed by their first bounds.

Only the items, in blocks of bounded size, and the statistics of their terms reach the driver and all tasks.
"""

from __future__ import annotations

import bisect
import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from engage.llm import words
from engage.llm.common import small_batches, written

BEST = 10
# A term is a run of ASCII letters and digits and of all characters beyond ASCII, A-Z lower-cased.
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_SEPARATOR = np.ones(256, dtype=bool)
_SEPARATOR[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
BLOCK_ITEMS = 2000  # items that are searched in one pass over the documents
BLOCK_TERMS = 200_000  # their terms with repeats; an item with more is a block of its own
DOC_BITS = 13
SHARD_DOCS = 1 << DOC_BITS
SHARD_POSTINGS = 1 << 19  # of a shard; sparse tables hold 4 bytes for each and each doubling of the longest list
LEAF = 1024  # postings of an interval that is scored whole
POSTINGS = "doc_id long, n long, terms array<int>, tfs array<int>"
FOUND = "item long, doc_id long, score long"


@dataclass
class Item:
    """An item's distinct terms, as places in the block's vocabulary, and how often it holds each."""

    item_id: object
    terms: np.ndarray
    times: np.ndarray


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, hashes, bounds`` of runs of texts: the 64-bit hashes of all terms in their order."""
    for first, last, data, bounds in words.chunks(texts):
        starts, ends, place = words.word_bounds(data, bounds, _SEPARATOR)
        yield first, last, words.word_hashes(data, starts, ends, lower=True), place


def item_blocks(items: DataFrame) -> Iterator[list[tuple[object, Counter]]]:
    """Items with the hashes of their terms, in blocks of bounded size."""
    block: list[tuple[object, Counter]] = []
    held = 0
    for row in items.select("item_id", "text").toLocalIterator():
        counts: Counter = Counter()
        for _, _, hashes, _ in term_hashes(pa.array([row["text"]], type=pa.string())):
            counts.update(hashes.tolist())
        if block and (len(block) >= BLOCK_ITEMS or held + counts.total() > BLOCK_TERMS):
            yield block
            block, held = [], 0
        block.append((row["item_id"], counts))
        held += counts.total()
    if block:
        yield block


def postings(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tfs`` of each row with a term: the number of its terms, and its counts of those in the vocabulary.

    Terms are compared by 64-bit hashes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, hashes, place in term_hashes(batch.column(1)):
                n = np.diff(place)
                row = np.repeat(np.arange(last - first), n)
                at = np.minimum(np.searchsorted(vocabulary, hashes), max(0, len(vocabulary) - 1))
                known = vocabulary[at] == hashes if len(vocabulary) else np.zeros(len(hashes), dtype=bool)
                key, tf = np.unique(row[known] * len(vocabulary) + at[known], return_counts=True)
                ends = np.searchsorted(key, np.arange(last - first + 1) * len(vocabulary)).astype(np.int32)
                terms = key % max(1, len(vocabulary))
                out = pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        pa.array(n.astype(np.int64)),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(terms.astype(np.int32))),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(tf.astype(np.int32))),
                    ],
                    names=["doc_id", "n", "terms", "tfs"],
                )
                yield out.filter(pa.array(n > 0))

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, POSTINGS)


class Best:
    """The k best documents of an item: highest score, then smallest id, rows without an id last."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple[int, bool, int]] = []  # score negated, id missing, id

    def may_enter(self, score: int, missing: bool, doc_id: int) -> bool:
        return len(self.rows) < self.k or (-score, missing, doc_id) < self.rows[-1]

    def offer(self, score: int, missing: bool, doc_id: int) -> None:
        if score > 0 and self.may_enter(score, missing, doc_id):
            bisect.insort(self.rows, (-score, missing, doc_id))
            del self.rows[self.k :]

    def least(self) -> int:
        """A score that a document must reach to enter."""
        return -self.rows[-1][0] if len(self.rows) == self.k else 1


class Shard:
    """Posting lists of a run of documents, with a sparse table of the places of their maxima.

    ``missing`` and ``doc_id`` are those of the documents, in the order of the result; ``term``, ``doc``, ``impact`` are the postings
    in the order of terms and documents.
    """

    def __init__(self, missing: np.ndarray, doc_id: np.ndarray, term: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        self.missing, self.doc_id, self.doc, self.impact = missing, doc_id, doc, impact
        self.terms, self.start = np.unique(term, return_index=True)
        self.end = np.append(self.start[1:], len(term)).astype(np.int64)
        slot = np.repeat(np.arange(len(self.terms)), self.end - self.start)
        self.key = (slot << DOC_BITS) + doc
        place = np.arange(len(term), dtype=np.int32)
        self.table, span = [place], 1
        longest = int((self.end - self.start).max()) if len(term) else 0
        while 2 * span <= longest:
            a = self.table[-1]
            a, b = a[: len(a) - span], a[span:]
            self.table.append(np.where(impact[b] > impact[a], b, a))  # of equals, the first document
            span *= 2

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The place of the largest impact of each range, -1 for an empty one."""
        size = high - low
        level = np.frexp(size.astype(np.float64))[1] - 1
        out = np.full(len(size), -1, dtype=np.int64)
        for k in np.unique(level[size > 0]):
            rows = np.flatnonzero((level == k) & (size > 0))
            a, b = self.table[k][low[rows]], self.table[k][high[rows] - (1 << int(k))]
            out[rows] = np.where(self.impact[b] > self.impact[a], b, a)
        return out

    def search(self, item: Item, best: Best) -> None:
        """Offer all documents that may be among the item's best."""
        at = np.searchsorted(self.terms, item.terms)
        held = np.flatnonzero(at < len(self.terms))
        held = held[self.terms[at[held]] == item.terms[held]]
        slots, times = at[held], item.times[held]
        heap: list[tuple[int, int, int, np.ndarray, np.ndarray, np.ndarray]] = []

        def put(first: int, last: int, low: np.ndarray, high: np.ndarray) -> None:
            places = self.maxima(low, high)
            values = np.where(places >= 0, self.impact[places] * times, 0)
            bound = int(values.sum())
            if bound >= best.least():
                heapq.heappush(heap, (-bound, first, last, low, high, places[np.argmax(values) : np.argmax(values) + 1]))

        if len(slots):
            put(0, len(self.doc_id), self.start[slots], self.end[slots])
        while heap:
            bound, first, last, low, high, top = heapq.heappop(heap)
            if -bound < best.least():
                return
            if not best.may_enter(-bound, bool(self.missing[first]), int(self.doc_id[first])):
                continue  # all its documents come after the k-th best, even with this score
            if (high - low).sum() <= LEAF:
                self._score(first, last, low, high, times, best)
                continue
            middle = int(self.doc[top[0]])
            cut = np.searchsorted(self.key, (slots << DOC_BITS) + middle)
            own = (cut < high) & (self.doc[np.minimum(cut, len(self.doc) - 1)] == middle)
            score = int((self.impact[cut[own]] * times[own]).sum())
            best.offer(score, bool(self.missing[middle]), int(self.doc_id[middle]))
            put(first, middle, low, cut)
            put(middle + 1, last, cut + own, high)

    def _score(self, first: int, last: int, low: np.ndarray, high: np.ndarray, times: np.ndarray, best: Best) -> None:
        """Score all documents of an interval."""
        size = high - low
        at = np.repeat(low - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(int(size.sum()))
        doc, at_doc = np.unique(self.doc[at], return_inverse=True)
        score = np.zeros(len(doc), dtype=np.int64)
        np.add.at(score, at_doc, self.impact[at] * np.repeat(times, size))
        rows = np.flatnonzero(score >= best.least())
        for k in rows[np.lexsort((doc[rows], -score[rows]))[: best.k]]:
            best.offer(int(score[k]), bool(self.missing[doc[k]]), int(self.doc_id[doc[k]]))


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


def searched(table: DataFrame, items: list[Item], weights: np.ndarray, documents: int, terms: int, k: int) -> DataFrame:
    """``item, doc_id, score`` of the k best documents of each task for each item; ``item`` is the place in the list."""

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[Shard]:
        held: list[pa.RecordBatch] = []
        docs = count = 0
        for batch in batches:
            start = 0
            ends = batch.column(2).offsets.to_numpy().astype(np.int64)
            while start < batch.num_rows:
                stop = min(start + SHARD_DOCS - docs, batch.num_rows)
                stop = max(min(stop, int(np.searchsorted(ends, ends[start] + SHARD_POSTINGS - count, side="right")) - 1), start)
                if stop > start or not held:
                    stop = max(stop, start + 1)
                    held.append(batch.slice(start, stop - start))
                    docs, count, start = docs + stop - start, count + int(ends[stop] - ends[start]), stop
                if start < batch.num_rows:
                    yield inverted(held)
                    held, docs, count = [], 0, 0
        if held:
            yield inverted(held)

    def inverted(held: list[pa.RecordBatch]) -> Shard:
        rows = pa.Table.from_batches(held)
        ids = rows["doc_id"]
        missing = ids.is_null().to_numpy()
        doc_id = ids.fill_null(0).to_numpy()
        order = np.lexsort((doc_id, missing))
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        n = rows["n"].to_numpy()
        size = rows["terms"].combine_chunks().value_lengths().to_numpy()
        term, tf = (rows[c].combine_chunks().flatten().to_numpy().astype(np.int64) for c in ("terms", "tfs"))
        doc, m = np.repeat(place, size), np.repeat(25 + (75 * n * documents) // terms, size)
        impact = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))
        sort = np.lexsort((doc, term))
        return Shard(missing[order], doc_id[order], term[sort], doc[sort], impact[sort])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = [Best(k) for _ in items]
        for shard in shards(batches):
            for item, best in zip(items, found):
                shard.search(item, best)
        rows = [(i, None if missing else doc_id, -score) for i, best in enumerate(found) for score, missing, doc_id in best.rows]
        if rows:
            columns = [pa.array(c, type=pa.int64()) for c in zip(*rows)]
            yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return table.mapInArrow(run, FOUND)


def rank(docs: DataFrame, items: DataFrame, k: int = BEST) -> DataFrame:
    """``item_id, rank, doc_id, score`` of the ``k`` best documents for each row of ``items(item_id, text)``.

    With N documents that have a term, L terms in all (with repeats) and df documents that hold a term, its weight is
    ``floor(1000 ln((2N + 2) / (2 df + 1)))``, and a document with n terms, tf times this one, gains the weight times
    ``10^9 tf div (1000 tf + 8 m)`` with ``m = 25 + 75 n N div L`` for each time the item has the term. Statistics are those of all
    documents. Documents with a score above 0 rank by score, then by ``doc_id`` (null last).

    A null or empty text has no terms: such a document is never found, such an item finds nothing, as does any item where
    there are no documents. Repeated rows of documents are documents of their own, repeated rows of items are ranked each. Other
    columns are ignored. Items are searched in blocks, each in one pass over all documents.
    """
    kind = items.schema["item_id"].dataType.simpleString()
    out = docs.sparkSession.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")
    for block in item_blocks(items):
        out = out.union(_ranked(docs, block, k, kind))
    return out


def _ranked(docs: DataFrame, block: list[tuple[object, Counter]], k: int, kind: str) -> DataFrame:
    vocabulary = np.array(sorted({h for _, counts in block for h in counts}), dtype=np.uint64)
    items = []
    for item_id, counts in block:
        hashes = np.array(sorted(counts), dtype=np.uint64)
        times = np.array([counts[int(h)] for h in hashes], dtype=np.int64)
        items.append(Item(item_id, np.searchsorted(vocabulary, hashes), times))
    table = written(postings(docs, vocabulary), "postings")
    documents, terms = table.agg(F.count("*"), F.sum("n")).first()
    weights = np.zeros(len(vocabulary), dtype=np.int64)
    for term, frequency in table.select(F.explode("terms").alias("term")).groupBy("term").count().collect():
        weights[term] = weight(documents, frequency)  # no more rows than the vocabulary has terms
    found = searched(table, items, weights, documents, terms, k)
    order = W.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = docs.sparkSession.createDataFrame([(n, i.item_id) for n, i in enumerate(items)], f"item long, item_id {kind}")
    return best.join(names, "item").select("item_id", "rank", "doc_id", "score")
