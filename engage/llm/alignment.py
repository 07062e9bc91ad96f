"""Alignment of two tokenizers' tokens over the same bytes, and how often their ids are linked in the whole corpus.

Both tokenizations of a text end tokens at byte offsets; offsets at which both end cut the text into groups. They are found by
merging the two ascending lists of ends, for all texts of a batch in lockstep: one numpy vector holds the place of each text in A's list
and one its place in B's. A step compares all places at once, emits a link and a cut where the ends agree, moves on
the side that ends first (both where they agree) and drops the texts that are done. Long texts would keep a batch
waiting; they are several lanes of the vector, parted at an offset where both tokenizers end.

Links are counted over the corpus without moving them: each task gathers documents into chunks of bounded size, gives
every chunk a list of its distinct id pairs, and describes documents by places in it. Only the chunks' lists are joined
with the corpus-wide counts, and go back to their chunk.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm.common import small_batches, written
from engage.llm.packing import RANKS

PIECES = "piece_bpe_32k.model"
LANE = 1024  # tokens of A after which a long text goes on in another lane
SEARCH = 256  # tokens of A among which a common end for the next lane is looked for at once
TEXT_BYTES = 1 << 20  # of texts that are aligned at once; a longer text is on its own
CODED_BYTES = 1 << 16  # of texts whose ids are Python numbers at once, ten times the size of arrays
CHUNK_LINKS = 1 << 18  # links of a chunk; a text with more is a chunk of its own
CHUNK_BITS = 32  # number of a chunk within its partition
PAIR_BITS = 32  # an id pair is A's id shifted left by so many bits, plus B's

ALIGNED = "doc_id long, a_ids array<int>, b_ids array<int>, a_cuts array<int>, b_cuts array<int>"
CHUNKS = (
    "chunk long, docs array<struct<doc_id: long, n_a: long, n_b: long, n_groups: long, groups_sha256: string>>, "
    "pairs array<long>, counts array<long>, doc_ends array<int>, doc_pairs array<int>, doc_counts array<int>"
)
LINKED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


class Tokenizers:
    """Both encoders and the bytes of their tokens: A from a file of ranks, B from a model of pieces."""

    def __init__(self, ranks: str = RANKS, pieces: str = PIECES):
        import base64

        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(public_tokenizers.path(ranks), "rb") as lines:
            table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        # Without special tokens their strings are text like any other.
        self.a = tiktoken.Encoding(ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(pieces))
        self.a_bytes = [b""] * (max(table.values()) + 1)
        for token, rank in table.items():
            self.a_bytes[rank] = token
        names = [self.b.id_to_piece(k) for k in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(name[3:-1], 16)]) if self.b.is_byte(k) else name.replace("▁", " ").encode()
            for k, name in enumerate(names)
        ]
        self.a_size, self.b_size = (np.array([len(t) for t in tokens]) for tokens in (self.a_bytes, self.b_bytes))

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids by A and B of a space and each text; none where the bytes of either are not those of the text."""
        full = [t for t in texts if t]
        found = iter(zip(full, self.b.encode(full, num_threads=1) if full else []))
        out = []
        for text in texts:
            if not text:
                out.append(([], []))
                continue
            _, b = next(found)
            a, whole = self.a.encode_ordinary(" " + text), b" " + text.encode()
            same = all(
                b"".join(map(tokens.__getitem__, ids)) == whole for tokens, ids in ((self.a_bytes, a), (self.b_bytes, b))
            )
            out.append((a, b) if same else ([], []))
        return out


def lanes(
    a_end: np.ndarray, b_end: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray, lane: int = LANE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the lanes of texts start in A and B, and where they stop in A. ``bounds`` part the texts' ends."""
    i, j = [], []
    for k in np.flatnonzero(np.diff(a_bounds) > lane):
        ours = b_end[b_bounds[k] : b_bounds[k + 1]]
        target, last = a_bounds[k] + lane, a_bounds[k + 1]
        while target < last:
            ends = a_end[target : min(target + SEARCH, last)]
            place = np.searchsorted(ours, ends)  # the last end is that of the text, so no place is behind the list
            common = np.flatnonzero(ours[place] == ends)
            if len(common):
                start = target + common[0] + 1
                if start < last:
                    i.append(start)
                    j.append(b_bounds[k] + place[common[0]] + 1)
                target = start + lane
            else:
                target += len(ends)
    full = np.diff(a_bounds) > 0
    i = np.sort(np.concatenate([a_bounds[:-1][full], np.array(i, dtype=np.int64)]))
    j = np.sort(np.concatenate([b_bounds[:-1][full], np.array(j, dtype=np.int64)]))
    return i, j, np.append(i[1:], a_bounds[-1])


def lockstep(
    a_end: np.ndarray, b_end: np.ndarray, a_bounds: np.ndarray, b_bounds: np.ndarray, lane: int = LANE
) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of tokens of A and of B before each common end, of all texts together and in order."""
    i, j, stop = lanes(a_end, b_end, a_bounds, b_bounds, lane)
    cuts_a, cuts_b = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)]
    while len(i):
        ours, theirs = a_end[i], b_end[j]
        step_a, step_b = ours <= theirs, theirs <= ours
        both = step_a & step_b
        i, j = i + step_a, j + step_b
        cuts_a.append(i[both])
        cuts_b.append(j[both])
        going = i < stop
        if not going.all():
            i, j, stop = i[going], j[going], stop[going]
    return np.sort(np.concatenate(cuts_a)), np.sort(np.concatenate(cuts_b))


def _batches(texts: pa.Array, most: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of rows with at most so many bytes of text, ``TEXT_BYTES`` if none is given."""
    most = most or TEXT_BYTES
    size = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    first, held = 0, 0
    for k, n in enumerate(size):
        if held + n > most and k > first:
            yield first, k
            first, held = k, 0
        held += int(n)
    if len(size):
        yield first, len(size)


def _coded(own: Tokenizers, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids by A and B of each text as arrays; only those of a few texts are Python numbers at a time."""
    return [
        (np.array(a, dtype=np.int32), np.array(b, dtype=np.int32))
        for first, last in _batches(texts, CODED_BYTES)
        for a, b in own.encode(texts.slice(first, last - first).to_pylist())
    ]


def _bounds(sizes: list[int]) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(np.array(sizes, dtype=np.int64))]).astype(np.int64)


def _ends(ids: np.ndarray, size: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Byte offset, within its text, at which each token ends."""
    total = np.concatenate([[0], np.cumsum(size[ids])])
    return total[1:] - np.repeat(total[bounds[:-1]], np.diff(bounds))


def _lists(values: np.ndarray, bounds: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values.astype(np.int32)))


def align(docs: DataFrame, ranks: str = RANKS, pieces: str = PIECES, lane: int = LANE) -> DataFrame:
    """``doc_id, a_ids, b_ids, a_cuts, b_cuts`` for each row of ``docs(doc_id, text)``.

    The ids of both tokenizers for a space and the whole text, and for each group the number of tokens of A and of B up to its end;
    the last tokens of a group are linked. A null or empty text, and one that a tokenizer does not give back byte for byte, has no
    tokens. Rows are independent, so repeated rows and null ids need no rule; an empty table gives no rows; other columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Tokenizers(ranks, pieces)
        for batch in batches:
            for first, last in _batches(batch.column(1)):
                coded = _coded(own, batch.column(1).slice(first, last - first))
                a_bounds, b_bounds = _bounds([len(a) for a, _ in coded]), _bounds([len(b) for _, b in coded])
                a_ids, b_ids = (np.concatenate([ids[k] for ids in coded]) for k in range(2))
                a_end, b_end = _ends(a_ids, own.a_size, a_bounds), _ends(b_ids, own.b_size, b_bounds)
                a_cuts, b_cuts = lockstep(a_end, b_end, a_bounds, b_bounds, lane)
                cuts = np.searchsorted(a_cuts, a_bounds, side="right")  # a cut behind a text's last token is its own
                text = np.repeat(np.arange(last - first), np.diff(cuts))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        _lists(a_ids, a_bounds),
                        _lists(b_ids, b_bounds),
                        _lists(a_cuts - a_bounds[text], cuts),
                        _lists(b_cuts - b_bounds[text], cuts),
                    ],
                    names=["doc_id", "a_ids", "b_ids", "a_cuts", "b_cuts"],
                )

    small_batches(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(run, ALIGNED)


def _flat(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(), offsets - offsets[0]


def groups_text(a_ids: pa.ListArray, b_ids: pa.ListArray, a_cuts: pa.ListArray, b_cuts: pa.ListArray) -> pa.Array:
    """``a1,a2|b1;a3|b2,b3`` of each row: its groups' ids of A and B; an empty text for a row without tokens."""
    sides = []
    for ids, cuts in ((a_ids, a_cuts), (b_ids, b_cuts)):
        (values, bounds), (ends, rows) = _flat(ids), _flat(cuts)
        ends = ends + np.repeat(bounds[:-1], np.diff(rows))
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        names = pa.array(values).cast(pa.string())
        sides.append(pc.binary_join(pa.ListArray.from_arrays(pa.array(offsets), names), ","))
    groups = pc.binary_join_element_wise(*sides, "|")
    return pc.binary_join(pa.ListArray.from_arrays(pa.array(rows.astype(np.int32)), groups), ";")


def _chunked(aligned: DataFrame) -> DataFrame:
    """Documents in chunks, with the chunk's distinct pairs and the places and counts of each document's pairs among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made = TaskContext.get().partitionId() << CHUNK_BITS, 0
        docs: list[dict] = []
        links: list[np.ndarray] = []
        count = 0

        def close() -> pa.RecordBatch:
            nonlocal made, count
            sizes = np.array([len(x) for x in links], dtype=np.int64)
            pairs, at = np.unique(np.concatenate(links), return_inverse=True)
            row = np.repeat(np.arange(len(links)), sizes)
            own, times = np.unique(row * max(1, len(pairs)) + at, return_counts=True)
            ends = np.searchsorted(own, np.arange(1, len(links) + 1) * max(1, len(pairs)))
            values = [
                [base + made],
                [docs.copy()],
                [pairs],
                [np.bincount(at, minlength=len(pairs))],
                [ends.astype(np.int32)],
                [(own % max(1, len(pairs))).astype(np.int32)],
                [times.astype(np.int32)],
            ]
            made, count = made + 1, 0
            docs.clear()
            links.clear()
            return pa.RecordBatch.from_arrays([pa.array(v, type=f.type) for v, f in zip(values, schema)], schema=schema)

        for batch in batches:
            doc_id, a_ids, b_ids, a_cuts, b_cuts = batch.columns
            names = groups_text(a_ids, b_ids, a_cuts, b_cuts)
            (a, a_bounds), (b, b_bounds), (i, rows), (j, _) = map(_flat, (a_ids, b_ids, a_cuts, b_cuts))
            text = np.repeat(np.arange(batch.num_rows), np.diff(rows))
            pair = (a[a_bounds[text] + i - 1].astype(np.int64) << PAIR_BITS) + b[b_bounds[text] + j - 1]
            for k in range(batch.num_rows):
                name = names[k].as_py()
                docs.append(
                    {
                        "doc_id": doc_id[k].as_py(),
                        "n_a": int(a_bounds[k + 1] - a_bounds[k]),
                        "n_b": int(b_bounds[k + 1] - b_bounds[k]),
                        "n_groups": int(rows[k + 1] - rows[k]),
                        "groups_sha256": hashlib.sha256(name.encode()).hexdigest() if name else "",
                    }
                )
                links.append(pair[rows[k] : rows[k + 1]])
                count += len(links[-1])
                if count >= CHUNK_LINKS or len(docs) >= CHUNK_LINKS >> 4:
                    yield close()
        if docs:
            yield close()

    document = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("groups_sha256", pa.string())]
    longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
    schema = pa.schema(
        [("chunk", pa.int64()), ("docs", pa.list_(pa.struct(document))), ("pairs", longs), ("counts", longs), ("doc_ends", ints), ("doc_pairs", ints), ("doc_counts", ints)]
    )
    return aligned.mapInArrow(run, CHUNKS)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """``pair, total, best``: how many links hold an id pair, and whether no pair of the same id of B has more."""
    pairs = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("p")).groupBy(F.col("p.pairs").alias("pair"))
    totals = pairs.agg(F.sum("p.counts").alias("total"))
    b_id = F.col("pair").bitwiseAND((1 << PAIR_BITS) - 1)
    most = totals.groupBy(b_id.alias("b_id")).agg(F.max("total").alias("most"))
    return totals.withColumn("b_id", b_id).join(most, "b_id").select("pair", "total", (F.col("total") == F.col("most")).alias("best"))


def linked(aligned: DataFrame) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` for each row that ``align`` gives.

    A link's count is how many links of the whole corpus hold its id pair. ``n_best`` counts the links whose count is the highest of
    any pair with their id of B (ties included), ``count_sum`` adds the counts of all links. A row without tokens has zeros and an empty text.
    """
    chunks = written(_chunked(aligned), "chunks")
    counted = written(pair_counts(chunks), "pairs")
    listed = chunks.select(F.col("chunk").alias("own"), F.posexplode("pairs").alias("place", "pair"))
    told = listed.join(counted, "pair").select("own", "place", "total", "best")

    def run(_, chunk: pa.Table, told: pa.Table) -> pa.Table:
        docs = chunk["docs"].combine_chunks().flatten()
        order = np.argsort(told["place"].to_numpy())
        total, best = told["total"].to_numpy()[order], told["best"].to_numpy(zero_copy_only=False)[order]
        pairs, times, ends = (chunk[c].combine_chunks().flatten().to_numpy() for c in ("doc_pairs", "doc_counts", "doc_ends"))
        ends = np.concatenate([[0], ends])
        n_best, sums, n_links = (
            np.diff(np.concatenate([[0], np.cumsum(v.astype(np.int64))])[ends])
            for v in (times * best[pairs], times * total[pairs], times)
        )
        found = {"n_links": pa.array(n_links), "n_best": pa.array(n_best), "count_sum": pa.array(sums)}
        names = [c.split()[0] for c in LINKED.split(", ")]
        return pa.table({c: found[c] if c in found else docs.field(c) for c in names})

    return chunks.groupBy("chunk").cogroup(told.groupBy("own")).applyInArrow(run, LINKED)
