"""Sum-of-squares online packing of token sequences into windows of fixed length.

Documents come one after another. What is longer than a window is cut into whole windows and a rest; the rest goes to
that fill level for which the sum over all levels of the squared number of partially filled windows is smallest after
the placement (a new window is the level 0, a window that becomes full leaves the sum). The state is a level array: how
many windows are open at each level. Each task packs the stream of its own partition, so nothing is shuffled and
memory is bounded by the open windows, of which the rule keeps few.

At the end of a partition the windows still open are filled up: pieces of the emptiest are cut to fill the fullest, so
that at most one window of a partition stays partly filled. It is cut into sequences of power-of-two lengths, which need
no padding.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

LENGTH = 2048
END_TOKEN = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, padded long"
)
SEQUENCES_BITS = 40  # sequence ids of a task: its partition's number shifted left by so many bits, plus a counter
# A text with this in it is encoded by the tokenizer file itself, which knows it as one token.
SPECIAL = "<|endoftext|>"


class Encoder:
    """Token ids of texts. The rank file holds the same vocabulary as the tokenizer file and encodes it much faster."""

    def __init__(self, tokenizer: str = TOKENIZER, ranks: str | None = RANKS):
        import public_tokenizers

        self.path = public_tokenizers.path(tokenizer)
        self.whole = self.fast = None
        if ranks:
            import tiktoken

            with open(public_tokenizers.path(ranks), "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding(
                ranks, pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
            )

    def __call__(self, text: str) -> np.ndarray:
        if self.fast is not None and SPECIAL not in text:
            return np.asarray(self.fast.encode_ordinary(text), dtype="<u4")
        if self.whole is None:
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(self.path)
        return np.asarray(self.whole.encode(text, add_special_tokens=False).ids, dtype="<u4")


class SumOfSquares:
    """The level array and the open windows of one stream.

    A piece is ``(document, start, ids, document's tokens)``. ``place`` and ``finish`` yield closed sequences as lists of
    pieces.
    """

    def __init__(self, length: int = LENGTH):
        self.length = length
        self.open: list[list[list]] = [[] for _ in range(length)]  # open windows by fill level
        self.count = np.zeros(length + 1, dtype=np.int64)  # open windows at each level; 0 and ``length`` stay 0

    def choose(self, size: int) -> int:
        """The level for a piece: moving a window from level h to h + size changes the sum of squares by
        2 (N[h + size] - N[h]) + 2, opening one by 2 N[size] + 1, closing one by -2 N[h] + 1. Of equals, the fullest."""
        n, most = self.count, self.length - size
        best, level = (2 * n[size] + 1 if size < self.length else 0), 0
        if most > 0:
            change = 2 * (n[size + 1 : self.length + 1] - n[1 : most + 1]) + 2
            change[-1] -= 1  # full windows are not counted
            change[n[1 : most + 1] == 0] = np.iinfo(np.int64).max
            at = most - 1 - int(np.argmin(change[::-1]))
            if change[at] <= best:
                level = at + 1
        return level

    def _add(self, level: int, piece: tuple) -> list | None:
        window = []
        if level:
            window = self.open[level].pop()
            self.count[level] -= 1
        window.append(piece)
        level += len(piece[2])
        if level == self.length:
            return window
        self.open[level].append(window)
        self.count[level] += 1
        return None

    def place(self, document, ids: np.ndarray) -> Iterator[list]:
        total, start = len(ids), 0
        while total - start >= self.length:
            yield [(document, start, ids[start : start + self.length], total)]
            start += self.length
        if start < total:
            piece = (document, start, ids[start:], total)
            full = self._add(self.choose(total - start), piece)
            if full:
                yield full

    def finish(self) -> Iterator[list]:
        """Fill the fullest windows with pieces cut from the emptiest; the last is cut into powers of two."""
        windows = [(level, w) for level in range(self.length - 1, 0, -1) for w in self.open[level]]
        self.open = [[] for _ in range(self.length)]
        self.count[:] = 0
        stock: list[tuple] = []  # pieces of the windows given up, to be used from the end
        first, last = 0, len(windows)
        while first < last:
            level, window = windows[first]
            first += 1
            while level < self.length:
                if not stock:
                    if first == last:
                        break
                    last -= 1
                    stock = windows[last][1]
                document, start, ids, total = stock.pop()
                part = ids[: self.length - level]
                window.append((document, start, part, total))
                level += len(part)
                if len(part) < len(ids):
                    stock.append((document, start + len(part), ids[len(part) :], total))
            if level == self.length:
                yield window
            else:
                stock = window[::-1]
        left = sum(len(p[2]) for p in stock)
        while left:
            size = 1 << (left.bit_length() - 1)
            left -= size
            window = []
            while size:
                document, start, ids, total = stock.pop()
                part = ids[:size]
                window.append((document, start, part, total))
                size -= len(part)
                if len(part) < len(ids):
                    stock.append((document, start + len(part), ids[len(part) :], total))
            yield window


def pack(docs: DataFrame, length: int = LENGTH, tokenizer: str = TOKENIZER, ranks: str | None = RANKS) -> DataFrame:
    """One row for each piece of each document: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset,
    padded``.

    A document is its token ids and the end token; a null or empty text is the end token alone. ``start`` counts the
    document's ids before the piece, ``offset`` the ids before it in its sequence, ``padded`` is the length of the whole
    sequence (all are full or a power of two, so nothing is padded). Repeated rows and rows with a null id are packed like any
    other; an empty table gives no rows; other columns are ignored.

    There is no shuffle: each input partition is one stream, and ids of sequences are unique by the partition's number. Read
    the input from files, so that a task that runs again sees the same rows in the same order.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = Encoder(tokenizer, ranks), SumOfSquares(length)
        base, made = TaskContext.get().partitionId() << SEQUENCES_BITS, 0
        end = np.array([END_TOKEN], dtype="<u4")
        rows: list[tuple] = []

        def put(window: list) -> None:
            nonlocal made
            offset, size = 0, sum(len(p[2]) for p in window)
            for document, start, ids, total in window:
                crc = zlib.crc32(np.ascontiguousarray(ids).tobytes())
                rows.append((document, start, len(ids), crc, total, base + made, offset, size))
                offset += len(ids)
            made += 1

        def flush() -> pa.RecordBatch:
            columns = list(zip(*rows)) if rows else [()] * 8
            rows.clear()
            names = [c.split()[0] for c in PIECES.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=names)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                ids = np.concatenate([encode(text), end]) if text else end
                for window in packer.place(doc_id, ids):
                    put(window)
                if len(rows) >= 10_000:
                    yield flush()
        for window in packer.finish():
            put(window)
        if rows:
            yield flush()

    return docs.select("doc_id", "text").mapInArrow(stream, PIECES)
