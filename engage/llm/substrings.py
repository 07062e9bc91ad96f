"""Removal of repeated passages: every window of words that also starts earlier is cut out.

Windows are dealt to shards by content, so that all occurrences of a window meet in one shard and each shard is compared with
itself alone. The anchor of a window is the least of the hashes of its runs of ``GRAM`` words. Consecutive windows with the
same anchor place form a segment, and only segments whose anchor occurs elsewhere go on. Equal segments are one: all
occurrences but the first are repeated whole. The rest, segments that share an anchor but differ, are indexed: a shard
is a compressed FM-index of its segments in document order, against which each window is searched backward; the window
is repeated if the earliest place of its interval is not its own.

Anchors with very many different segments (the edges of a passage that a large part of all documents quotes) are not indexed
in one shard; their windows are compared by an aggregation over window hashes instead.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm import words
from engage.llm.bloom import blocked_filter, may_hold
from engage.llm.common import written
from engage.llm.fmindex import FMIndex

WINDOW = 20
GRAM = 5
SHARD = 400_000  # words of a shard, about
HOT = 20_000  # different segments of an anchor beyond which its windows are aggregated
_PLACE = 28  # bits of a word's number within a chunk
_TAG = 24  # bits that tell rows of equal id apart
_SEGMENTS = "anchor long, segment long, doc long, pos long"


def _sliding_least(keys: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive keys."""
    span = 1
    while span * 2 <= width:
        keys = np.minimum(keys[:-span], keys[span:])
        span *= 2
    rest = width - span
    return np.minimum(keys[:-rest], keys[rest:]) if rest else keys


def segments(hashed: np.ndarray, place: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """``row, start, windows, anchor, hash`` of all segments of some texts.

    ``hashed`` are the words of all texts, ``place`` the first word of each. A segment's windows start at ``start`` and the
    ``windows - 1`` words after it, counted within its text.
    """
    count = np.diff(place)
    empty = np.zeros(0, dtype=np.int64)
    if len(hashed) < window or not (count >= window).any():
        return empty, empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = words.gram_hashes(hashed, gram)
    low = np.uint64((1 << _PLACE) - 1)
    keys = (grams & ~low) | np.arange(len(grams), dtype=np.uint64)
    at = (_sliding_least(keys, window - gram + 1) & low).astype(np.int64)  # anchor place of each window
    row = np.repeat(np.arange(len(count)), count)
    valid = np.flatnonzero(row[: len(at)] == row[window - 1 :])
    at = at[valid]
    new = np.concatenate([[True], (at[1:] != at[:-1]) | (valid[1:] != valid[:-1] + 1)])
    first = np.flatnonzero(new)
    windows = np.diff(np.append(first, len(valid)))
    start, anchor = valid[first], grams[at[first]]
    total = np.zeros(len(hashed) + 1, dtype=np.uint64)
    np.cumsum(hashed * words._powers(words._BASE, len(hashed)), out=total[1:])
    end = start + windows + window - 1
    content = (total[end] - total[start]) * words._powers(words._INVERSE, len(hashed) + 1)[start]
    content = words.mix64(content + windows.astype(np.uint64))
    owner = row[start]
    return owner, start - place[owner], windows, anchor, content


def _segment_rows(window: int, gram: int, table: np.ndarray | None):
    """Arrow function: all segments whose anchor may be in the filter, as ``anchor, segment, doc, pos``.

    ``pos`` packs start, number of windows and the row's tag.
    """

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc, tag = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for first, _, data, bounds in words.chunks(batch.column(2)):
                starts, ends, place = words.word_bounds(data, bounds)
                row, start, windows, anchor, content = segments(words.word_hashes(data, starts, ends), place, window, gram)
                if table is not None:
                    kept = may_hold(table, anchor.view(np.int64))
                    row, start, windows, anchor, content = row[kept], start[kept], windows[kept], anchor[kept], content[kept]
                pos = (start << (_TAG + 5)) | (windows << _TAG) | tag[first + row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(content.view(np.int64)), pa.array(doc[first + row]), pa.array(pos)],
                    names=["anchor", "segment", "doc", "pos"],
                )

    return emit


def _extract(window: int, shards: int):
    """Words of the wanted segments of each document, for the index; hashes of single windows for hot anchors."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # Repeated rows come one after another from the join; one of them is enough.
            same = pc.and_(pc.equal(batch.column(0)[1:], batch.column(0)[:-1]), pc.equal(batch.column(1)[1:], batch.column(1)[:-1]))
            batch = batch.filter(pa.array(np.append(True, ~same.to_numpy(zero_copy_only=False))[: len(batch)]))
            doc, wanted = batch.column(0).to_numpy(), batch.column(2)
            offsets = wanted.offsets.to_numpy()
            fields = wanted.flatten()
            pos, segment, anchor, hot = (fields.field(k).to_numpy(zero_copy_only=False) for k in range(4))
            offsets = offsets - offsets[0]
            for first, last, data, bounds in words.chunks(batch.column(1)):
                starts, ends, place = words.word_bounds(data, bounds)
                hashed = words.word_hashes(data, starts, ends)
                lo, hi = offsets[first], offsets[last]
                row = np.repeat(np.arange(first, last), np.diff(offsets[first : last + 1]))
                start = (pos[lo:hi] >> (_TAG + 5)).astype(np.int64)
                windows = ((pos[lo:hi] >> _TAG) & 31).astype(np.int64)
                at = place[row - first] + start
                for is_hot in (False, True):
                    own = np.flatnonzero(hot[lo:hi] == is_hot)
                    if not len(own):
                        continue
                    s, n = at[own], windows[own]
                    if is_hot:  # one row for each window
                        s = np.repeat(s, n)
                        step = np.arange(len(s)) - np.repeat(np.cumsum(n) - n, n)
                        own, s, size = np.repeat(own, n), s + step, np.full(len(s), window)
                    else:
                        step, size = np.zeros(len(own), dtype=np.int64), n + window - 1
                    ends_ = np.cumsum(size)
                    flat = np.repeat(s - (ends_ - size), size) + np.arange(int(ends_[-1]))
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends_).astype(np.int32)), pa.array(hashed[flat].view(np.int64)))
                    spread = words.mix64(anchor[lo:hi][own].view(np.uint64)) % np.uint64(shards)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(spread.astype(np.int64)), pa.array(doc[row[own]]), pa.array(pos[lo:hi][own]),
                            pa.array(segment[lo:hi][own]), pa.array(step), pa.array(np.full(len(own), is_hot)), lists,
                        ],
                        names=["shard", "doc", "pos", "segment", "step", "hot", "words"],
                    )

    return emit


_EXTRACTED = "shard long, doc long, pos long, segment long, step long, hot boolean, words array<long>"


def _search_shard(window: int):
    """Index the segments of one shard and report, for each, which of its windows start earlier (bits of ``mask``).

    A segment that was read from several equal rows is taken once. Places are compared by document and start, so rows that
    share an id count as one document.
    """

    def search(table: pa.Table) -> pa.Table:
        doc, pos = table.column("doc").to_numpy(), table.column("pos").to_numpy()
        order = np.lexsort((table.column("segment").to_numpy(), pos, doc))
        again = np.stack([doc[order], pos[order], table.column("segment").to_numpy()[order]])
        order = order[np.append(True, (again[:, 1:] != again[:, :-1]).any(axis=0))]
        lists = table.column("words").combine_chunks()
        offsets, flat = lists.offsets.to_numpy(), lists.flatten().to_numpy()
        offsets = offsets - offsets[0]
        size = np.diff(offsets)[order]
        doc, first = doc[order], pos[order] >> (_TAG + 5)
        # Each segment in order, closed by an end mark.
        ends = np.cumsum(size + 1)
        begin = ends - size - 1
        _, ids = np.unique(flat, return_inverse=True)
        text = np.zeros(int(ends[-1]), dtype=np.int64)
        inner = np.ones(len(text), dtype=bool)
        inner[ends - 1] = False
        source = np.repeat(offsets[:-1][order] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        text[inner] = ids[source] + 1
        index = FMIndex(text, int(ids.max()) + 2, int(size.max()) + 1)
        windows = size - window + 1
        starts = np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))
        bit = np.arange(len(starts)) - np.repeat(np.cumsum(windows) - windows, windows)
        # Windows in the order of document and start, equal where both are.
        owner = np.repeat(np.arange(len(size)), windows)
        place = np.stack([doc[owner], first[owner] + bit])
        ranked = np.lexsort(place[::-1])
        rank = np.empty(len(ranked), dtype=np.int64)
        rank[ranked] = np.append(0, np.cumsum((place[:, ranked[1:]] != place[:, ranked[:-1]]).any(axis=0)))
        ranks = np.full(len(text), len(text), dtype=np.int64)
        ranks[starts] = rank
        repeated = index.least(starts, window, ranks) < rank
        mask = np.add.reduceat(np.where(repeated, 1 << bit, 0), np.cumsum(windows) - windows)
        found = np.flatnonzero(mask)
        return pa.table({"segment": table.column("segment").to_numpy()[order][found], "mask": mask[found]})

    return search


def _cut(window: int):
    """Remove the words of repeated windows from each text."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total, gone, kept = [], [], []
            for text, found in zip(batch.column(1), batch.column(2)):
                own = (text.as_py() or "").encode().split()
                remove = np.zeros(len(own) + 1, dtype=np.int64)
                if found.is_valid and len(found):
                    pos, mask = found.values.field(0).to_numpy(), found.values.field(1).to_numpy()
                    for bit in range(32):
                        start = (pos[(mask >> bit) & 1 == 1] >> (_TAG + 5)) + bit
                        np.add.at(remove, start, 1)
                        np.add.at(remove, np.minimum(start + window, len(own)), -1)
                covered = np.cumsum(remove)[:-1] > 0
                total.append(len(own))
                gone.append(int(covered.sum()))
                kept.append(b" ".join(w for w, c in zip(own, covered) if not c) if gone[-1] else b" ".join(own))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(total, pa.int64()), pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                names=["doc_id", "n_words", "n_removed", "kept"],
            )

    return emit


def remove_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, hot: int = HOT, shard: int = SHARD) -> DataFrame:
    """``doc_id, n_words, n_removed, kept`` for each row of ``docs(doc_id, text)``.

    A window is ``window`` consecutive words of one text (``window - gram`` at most 30); each word covered by a window that also
    starts earlier is removed: in a document with a smaller ``doc_id``, or earlier in the same. Windows are judged on the input.
    ``kept`` holds the remaining words joined by single blanks. Nothing is left out for size: whole texts, all documents.

    A null or empty text has no words and stays empty. A null id comes before all others. Rows with the same id are one document
    as far as order goes: of two equal windows that start at the same place of such rows neither is removed for the other, so
    repeated rows lose nothing to each other. An empty table gives no rows; other columns are ignored.
    """
    tag = F.xxhash64("text").bitwiseAND(F.lit((1 << _TAG) - 1))
    ordered = F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), ordered.alias("doc"), tag.alias("tag"), "text")
    source = rows.select("doc", "tag", "text").where(F.length("text") > 2 * window - 2)
    anchors = source.mapInArrow(_segment_rows(window, gram, None), _SEGMENTS).groupBy("anchor").agg(F.count("*").alias("times"))
    repeated = written(anchors.where("times > 1").select("anchor"), "anchors")
    passing = source.mapInArrow(_segment_rows(window, gram, blocked_filter(repeated)), _SEGMENTS)
    met = written(passing.join(repeated, "anchor"), "segments")
    first = F.min(F.struct("doc", F.shiftright("pos", _TAG + 5).alias("start"), "pos"))
    distinct = written(met.groupBy("anchor", "segment").agg(first.alias("first")), "distinct")
    mixed = distinct.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1")
    compared = distinct.join(mixed, "anchor").select(
        F.col("first.doc").alias("doc"), F.col("first.pos").alias("pos"), "segment", "anchor", (F.col("kinds") > hot).alias("hot")
    )
    shards = max(1, distinct.count() * (window + 8) // shard)
    by_row = lambda t: t.withColumn("tag", F.col("pos").bitwiseAND(F.lit((1 << _TAG) - 1)))
    wanted = by_row(compared).groupBy("doc", "tag").agg(F.collect_list(F.struct("pos", "segment", "anchor", "hot")).alias("wanted"))
    fetched = written(
        source.join(wanted, ["doc", "tag"]).select("doc", "text", "wanted").mapInArrow(_extract(window, shards), _EXTRACTED), "extracts"
    )
    masks = (
        fetched.where("NOT hot").groupBy("shard").applyInArrow(_search_shard(window), "segment long, mask long")
    )
    single = fetched.where("hot").withColumn("w", F.xxhash64("words"))
    place = F.struct("doc", (F.shiftright("pos", _TAG + 5) + F.col("step")).alias("start"))
    least = single.groupBy("w").agg(F.min(place).alias("least"))
    hot_masks = (
        single.join(least, "w")
        .where(place != F.col("least"))
        .select("segment", F.call_function("shiftleft", F.lit(1).cast("long"), F.col("step").cast("int")).alias("mask"))
    )
    mask = masks.unionByName(hot_masks).groupBy("segment").agg(F.bit_or("mask").alias("mask"))
    # Written, so that the join below is one of two plain tables, whose hot segments the adaptive planner splits.
    known = written(distinct.join(mask, "segment", "left").select("segment", "first", "mask"), "known")
    is_first = (F.col("doc") == F.col("first.doc")) & (F.shiftright("pos", _TAG + 5) == F.col("first.start"))
    whole = F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright("pos", _TAG).bitwiseAND(F.lit(31)).cast("int")) - 1
    removed = by_row(
        met.join(known, "segment").select("doc", "pos", F.when(is_first, F.coalesce("mask", F.lit(0))).otherwise(whole).alias("mask")).where("mask <> 0")
    )
    found = removed.groupBy("doc", "tag").agg(F.collect_list(F.struct("pos", "mask")).alias("found"))
    return (
        rows.join(found, ["doc", "tag"], "left")
        .select("doc_id", "text", "found")
        .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept string")
    )
