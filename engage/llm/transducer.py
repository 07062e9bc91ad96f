"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding as a byte-to-text state machine.

**How far ahead an encoder must see.** Take two texts that agree on their first n symbols and apply the merge list to both, rule
by rule. At any time both have the same tokens up to some boundary, the front, at first n. A rule ``u v`` moves the front
back by the length of ``u``, and only if a token ``v`` starts at the front in one of the texts. That token has grown there since the
rule ``u' v'`` that moved the front before, so it starts with ``u'``. The rules that move the front thus form a chain, in the order of
the list, each of whose right sides starts with the left side of the one before. The heaviest such chain (the sum of its left sides) is
found by one pass over the list: no continuation of a text can change tokens that end further than that from its end. Nor can
what was emitted change what follows, since no merge crosses a boundary of the result.

A list in which a rule takes a part that a later rule also makes has no such order; its lookahead is unbounded, and
pieces are then held whole.

The encoder takes a text in slices and holds, between them, only what is not decided: symbols within the lookahead, the last
pieces of the splitting pattern, letters that a combining mark may still change, and the start of a special token.
"""

from __future__ import annotations

import codecs
import functools
import heapq
import json
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKENIZER = "word_bpe_49k.json"
BLOCK = 4096  # symbols that are merged at once beyond the lookahead
SLICE = 8192  # characters of a long word that are taken at once
LONG = 512  # bytes of a word that is streamed and not remembered
REMEMBERED = 1 << 19  # words whose ids a task remembers, at most
_SPACE = re.compile(r"\s")
OPEN = 3  # characters at the end of a slice that may still be split otherwise ('re, 've, 'll)


def sufficient_lookahead(merges: list[tuple[str, str]], suffix: str = "") -> int | None:
    """Symbols behind a place that decide all tokens before it, whatever follows; null if the list allows no bound.

    ``suffix`` is the mark of a word's last symbol; it has no length.
    """
    heaviest: dict[str, int] = {}  # chains so far by the left side of their last rule
    needed: set[str] = set()
    most = 0
    for left, right in merges:
        if left + right in needed:
            return None
        needed.update((left, right))
        before = max(heaviest.get(right[:k], 0) for k in range(1, len(right) + 1))
        weight = before + len(left.removesuffix(suffix) if suffix else left)
        heaviest[left] = max(heaviest.get(left, 0), weight)
        most = max(most, weight)
    return most


class Merges:
    """A merge list over token ids."""

    def __init__(self, vocabulary: dict[str, int], merges: list[tuple[str, str]], suffix: str = ""):
        self.suffix = suffix
        self.lookahead = sufficient_lookahead(merges, suffix)
        self.ids = vocabulary
        self.span = max(vocabulary.values(), default=0) + 1
        self.ranks: dict[int, int] = {}
        for rank, (left, right) in enumerate(merges):
            self.ranks.setdefault(vocabulary[left] * self.span + vocabulary[right], rank)
        self.made = [vocabulary[left + right] for left, right in merges]

    def symbols(self, piece: str) -> list[int]:
        return [self.ids[c] for c in piece]

    @functools.cached_property
    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """The same rules as arrays: sorted pairs, their ranks, what each rank makes, and symbols by code point (within and last)."""
        pairs = np.array(sorted(self.ranks), dtype=np.int64)
        ranks = np.array([self.ranks[p] for p in pairs.tolist()], dtype=np.int64)
        symbols = [t for t in self.ids if len(t) == 1]
        inner = np.full(max(map(ord, symbols)) + 1, -1, dtype=np.int64)
        last = inner.copy()
        for t in symbols:
            inner[ord(t)] = self.ids[t]
            last[ord(t)] = self.ids.get(t + self.suffix, -1)
        return pairs, ranks, np.array(self.made, dtype=np.int64), inner, last

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        pairs, ranks = self.tables[:2]
        key = left * self.span + right
        at = np.minimum(np.searchsorted(pairs, key), len(pairs) - 1)
        return np.where((pairs[at] == key) & (left >= 0) & (right >= 0), ranks[at], len(self.made))

    def many(self, pieces: list[str]) -> list[bytes]:
        """The packed ids of many short pieces: all are merged in lockstep, one rule of each at a time."""
        made, inner, last = self.tables[2:]
        none, out = len(self.made), [b""] * len(pieces)
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        for width in (4, 8, 12, 16, 24, 32, 48, 1 << 30):
            rows = np.flatnonzero((size > 0) & (size <= width))
            size[rows] = 0
            if not len(rows):
                continue
            if width > 48:
                for k in rows:
                    symbols = self.symbols(pieces[k][:-1]) + [self.ids[pieces[k][-1] + self.suffix]]
                    out[k] = _packed(self.merged(symbols)[0])
                continue
            code = np.frombuffer("".join(pieces[k].ljust(width, "\0") for k in rows).encode("utf-32-le"), dtype="<u4")
            code = code.reshape(len(rows), width).astype(np.int64)
            length = (code > 0).sum(axis=1)
            token = np.where(code > 0, inner[code], -1)
            token[np.arange(len(rows)), length - 1] = last[code[np.arange(len(rows)), length - 1]]
            rank = np.full((len(rows), width), none, dtype=np.int64)
            rank[:, :-1] = self._rank(token[:, :-1], token[:, 1:])
            column = np.arange(width)
            while len(rows):
                k = rank.argmin(axis=1)
                best = rank[np.arange(len(rows)), k]
                done = best == none
                if done.any():
                    for row, ids, n in zip(rows[done].tolist(), token[done].astype("<u4"), length[done].tolist()):
                        out[row] = ids[:n].tobytes()
                    rows, token, rank, length, k, best = (x[~done] for x in (rows, token, rank, length, k, best))
                every = np.arange(len(rows))
                after = np.minimum(column + (column > k[:, None]), width - 1)
                token[every, k] = made[best]
                token = np.take_along_axis(token, after, axis=1)
                token[:, -1] = -1
                length = length - 1
                rank = np.take_along_axis(rank, np.minimum(column + (column >= k[:, None]), width - 1), axis=1)
                rank[:, -1] = none
                before = np.maximum(k - 1, 0)
                rank[every, before] = np.where(k > 0, self._rank(token[every, before], token[every, k]), rank[every, before])
                rank[every, k] = self._rank(token[every, k], token[every, np.minimum(k + 1, width - 1)])
        return out

    def merged(self, tokens: list[int]) -> tuple[list[int], list[int]]:
        """The tokens of a sequence of symbols, and the number of symbols of each."""
        return self._short(tokens) if len(tokens) < 48 else self._long(tokens)

    def _short(self, tokens: list[int]) -> tuple[list[int], list[int]]:
        tokens, sizes, rank, span, none = list(tokens), [1] * len(tokens), self.ranks.get, self.span, len(self.made)
        found = [rank(a * span + b, none) for a, b in zip(tokens, tokens[1:])]
        while found and (best := min(found)) < none:
            k = found.index(best)  # the leftmost
            tokens[k] = self.made[best]
            sizes[k] += sizes[k + 1]
            del tokens[k + 1], sizes[k + 1], found[k]
            if k:
                found[k - 1] = rank(tokens[k - 1] * span + tokens[k], none)
            if k < len(found):
                found[k] = rank(tokens[k] * span + tokens[k + 1], none)
        return tokens, sizes

    def _long(self, tokens: list[int]) -> tuple[list[int], list[int]]:
        n, ranks, span = len(tokens), self.ranks, self.span
        token, size = list(tokens), [1] * n
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[int, int, int, int]] = []

        def offer(k: int) -> None:
            if 0 <= k and after[k] < n:
                rank = ranks.get(token[k] * span + token[after[k]])
                if rank is not None:
                    heapq.heappush(queue, (rank, k, token[k], token[after[k]]))

        for k in range(n - 1):
            offer(k)
        while queue:
            rank, k, left, right = heapq.heappop(queue)
            if token[k] != left or after[k] >= n or token[after[k]] != right:
                continue
            gone = after[k]
            token[k], token[gone] = self.made[rank], -1
            size[k] += size[gone]
            after[k] = after[gone]
            if after[k] < n:
                before[after[k]] = k
            offer(before[k])
            offer(k)
        out = [k for k in range(n) if token[k] >= 0]
        return [token[k] for k in out], [size[k] for k in out]


class PieceEncoder:
    """The transducer of one piece: symbols go in, tokens come out as soon as nothing that follows can change them."""

    def __init__(self, merges: Merges, block: int = BLOCK):
        self.merges, self.block = merges, block
        self.held: list[int] = []

    def push(self, symbols: list[int]) -> list[int]:
        out: list[int] = []
        ahead = self.merges.lookahead
        if ahead is None:
            self.held += symbols
            return out
        for start in range(0, len(symbols), self.block):
            self.held += symbols[start : start + self.block]
            # The last symbol may yet be the last of the piece, which is another symbol: it counts as unseen.
            stable = len(self.held) - 1 - ahead
            if stable >= self.block:
                tokens, sizes = self.merges.merged(self.held)
                ends = np.cumsum(sizes)
                count = int(np.searchsorted(ends, stable, side="right"))
                if count:
                    out += tokens[:count]
                    del self.held[: int(ends[count - 1])]
        return out

    def close(self, last: int | None = None) -> list[int]:
        """All that is left; ``last`` takes the place of the last symbol."""
        symbols, self.held = self.held, []
        if symbols and last is not None:
            symbols[-1] = last
        return self.merges.merged(symbols)[0] if symbols else []


@functools.cache
def _composing() -> frozenset[str]:
    """Characters that may join the one before them in normal form C though they are no combining marks."""
    second = set()
    for code in range(0x110000):
        parts = unicodedata.decomposition(chr(code)).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            second.add(chr(int(parts[1], 16)))
    return frozenset(second) | {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}


def settled(text: str) -> int:
    """The last place where the text may be cut so that normal form C of both parts joined is that of the whole."""
    for at in range(len(text) - 1, 0, -1):
        c = text[at]
        if c < "\x80" or (unicodedata.category(c) != "Cn" and not unicodedata.combining(c) and c not in _composing()):
            return at
    return 0


class Tokenizer:
    """A tokenizer file of the kind that drops white space: normal form and splitting are the file's own, merging is done here.

    ``encode`` gives the ids of a whole text as little-endian unsigned 32-bit integers, ``stream`` those of a text in slices.
    """

    def __init__(self, file: str = TOKENIZER, long: int = LONG):
        import public_tokenizers
        from tokenizers import Tokenizer as File

        path = public_tokenizers.path(file)
        with open(path, encoding="utf-8") as text:
            spec = json.load(text)
        model = spec["model"]
        self.suffix = model.get("end_of_word_suffix") or ""
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.merges = Merges(model["vocab"], pairs, self.suffix)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        library = File.from_file(path)
        self.normal = library.normalizer.normalize_str if library.normalizer else str
        self.split = library.pre_tokenizer.pre_tokenize_str
        if self.split("a b") != [("a", (0, 1)), ("b", (2, 3))]:
            raise ValueError(f"{file} keeps white space in its tokens")
        if any(re.search(r"\s", s) for s in self.special):
            raise ValueError(f"{file} has special tokens with white space")
        ordered = sorted(self.special, key=len, reverse=True)
        self.parts = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self.longest = max(map(len, ordered), default=1)
        self.long = long
        self.words = _Words(self)
        self.pieces: dict[str, bytes] = {}

    def piece(self, piece: str) -> list[int]:
        """Ids of one piece of the split text (bytes as printable characters)."""
        return self.merges.merged([*self.merges.symbols(piece[:-1]), self.last(piece[-1])])[0]

    def last(self, symbol: str) -> int:
        return self.merges.ids[symbol + self.suffix]

    def word(self, text: str) -> list[int]:
        """Ids of a short text at once."""
        out: list[int] = []
        for k, part in enumerate(self.parts.split(text) if self.parts else [text]):
            if k % 2:
                out.append(self.special[part])
            elif part:
                for piece, _ in self.split(self.normal(part)):
                    out += self.piece(piece)
        return out

    def stream(self, slices: Iterable[str]) -> Iterator[list[int]]:
        """Ids of a text that comes in slices, cut anywhere; memory does not depend on the text's length."""
        text, part = "", _Part(self)
        for slice_ in slices:
            text += slice_
            if self.parts:
                *whole, text = self.parts.split(text)
                for k, content in enumerate(whole):
                    if k % 2:
                        yield part.close()
                        yield [self.special[content]]
                        part = _Part(self)
                    else:
                        yield part.push(content)
            kept = max(0, len(text) - self.longest + 1)
            yield part.push(text[:kept])
            text = text[kept:]
        yield part.push(text)
        yield part.close()

    def encode(self, text: bytes) -> bytes:
        """Ids of a text in UTF-8. White space in ASCII parts words, which are independent; frequent ones are remembered."""
        return b"".join(map(self.words.__getitem__, text.split()))

    def encode_all(self, texts: list[bytes]) -> list[bytes]:
        """The same for a batch of texts; the short words that are new in it are encoded together."""
        if len(self.words) > REMEMBERED:
            self.words.clear()
            self.pieces.clear()
        split = [text.split() for text in texts]
        new = [w for w in set().union(*split) if w not in self.words and len(w) <= self.long]
        self._learn([(w, t) for w in new for t in [w.decode("utf-8")] if not (self.parts and self.parts.search(t)) and not _SPACE.search(t)])
        return [b"".join(map(self.words.__getitem__, words)) for words in split]

    def _learn(self, words: list[tuple[bytes, str]]) -> None:
        """Remember the ids of words without any white space or special token: as one text, they are parted by the spaces between them."""
        text = self.normal(" ".join(t for _, t in words))
        pieces = self.split(text) if text else []
        start = np.flatnonzero(np.frombuffer(text.encode("utf-32-le"), dtype="<u4") == 32)
        owner = np.searchsorted(start, np.array([s for _, (s, _) in pieces], dtype=np.int64)).tolist()
        fresh = list({p for p, _ in pieces if p not in self.pieces})
        self.pieces.update(zip(fresh, self.merges.many(fresh)))
        found = [b""] * len(words)
        for k, (piece, _) in zip(owner, pieces):
            found[k] += self.pieces[piece]
        self.words.update(zip((w for w, _ in words), found))


class _Words(dict):
    """Ids of words as bytes. Long words are streamed and not kept."""

    def __init__(self, tokenizer: Tokenizer):
        super().__init__()
        self.tokenizer = tokenizer

    def __missing__(self, word: bytes) -> bytes:
        text = word.decode("utf-8")
        if len(word) > self.tokenizer.long:
            slices = (text[k : k + SLICE] for k in range(0, len(text), SLICE))
            return b"".join(_packed(ids) for ids in self.tokenizer.stream(slices))
        found = self[word] = _packed(self.tokenizer.word(text))
        return found


def _packed(ids: list[int]) -> bytes:
    return array("I", ids).tobytes() if sys.byteorder == "little" else np.asarray(ids, dtype="<u4").tobytes()


class _Part:
    """A stretch of text without special tokens, in slices."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.raw = ""  # not in normal form yet
        self.text = ""  # in normal form, not split yet
        self.run: PieceEncoder | None = None  # of the piece that reaches to the end of what was split
        self.kind = ""  # a character that continues that piece
        self.end = ""  # its last symbol

    def push(self, text: str) -> list[int]:
        self.raw += text
        at = settled(self.raw)
        self.text += self.tokenizer.normal(self.raw[:at])
        self.raw = self.raw[at:]
        return self._split(False)

    def close(self) -> list[int]:
        self.text += self.tokenizer.normal(self.raw)
        self.raw = ""
        return self._split(True)

    def _split(self, ends: bool) -> list[int]:
        out: list[int] = []
        text = self.text
        if not ends and len(text) < LONG:
            return out
        if self.run is not None and text:
            # The piece goes on as far as it would behind a character of its kind.
            piece, (_, reach) = self.tokenizer.split(self.kind + text)[0]
            self._extend(piece[1:], out)
            text = text[reach - 1 :]
            if text:
                self._finish(out)
        if ends and self.run is not None:
            self._finish(out)
        pieces = self.tokenizer.split(text) if text else []
        self.text = ""
        for k, (piece, (start, reach)) in enumerate(pieces):
            if not ends and start >= len(text) - OPEN:
                self.text = text[start:]
                break
            if not ends and reach == len(text):
                self.run = PieceEncoder(self.tokenizer.merges)
                self.kind = next((c for c in "a." if len(self.tokenizer.split(c + text[start])) == 1), "")
                if self.kind:
                    self._extend(piece, out)
                    break
                self.run = None  # a piece of one character, which nothing continues
            out += self.tokenizer.piece(piece)
        return out

    def _extend(self, piece: str, out: list[int]) -> None:
        if piece:
            out += self.run.push(self.tokenizer.merges.symbols(piece))
            self.end = piece[-1]

    def _finish(self, out: list[int]) -> None:
        out += self.run.close(self.tokenizer.last(self.end))
        self.run = None


class Decoder:
    """Text of ids that come in runs of any length.

    A file whose decoder is byte-level gives the bytes of its tokens; they become text as soon as a character is complete, and
    what is no UTF-8 becomes U+FFFD. A file without decoder gives its tokens as they are written, parted by spaces.
    """

    def __init__(self, file: str = TOKENIZER):
        import public_tokenizers

        with open(public_tokenizers.path(file), encoding="utf-8") as text:
            spec = json.load(text)
        kind = (spec.get("decoder") or {}).get("type")
        if kind not in (None, "ByteLevel"):
            raise ValueError(f"{file}: no state machine for the decoder {kind}")
        self.joined = kind is None
        special = {t["id"]: t["content"] for t in spec["added_tokens"]}
        names = {i: t for t, i in spec["model"]["vocab"].items()} | special
        size = max(names) + 1
        if self.joined:
            table = [(" " + names[i]).encode() if i in names else b"" for i in range(size)]
        else:
            byte = {c: b for b, c in enumerate(_printable())}
            table = [special[i].encode() if i in special else bytes(byte[c] for c in names.get(i, "")) for i in range(size)]
        self.table = table
        self.reset()

    def reset(self) -> None:
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")
        self.first = True

    def feed(self, ids: Iterable[int]) -> str:
        data = b"".join(map(self.table.__getitem__, ids))
        if self.joined and self.first and data:
            data, self.first = data[1:], False
        return self.machine.decode(data)

    def close(self) -> str:
        rest = self.machine.decode(b"", True)
        self.reset()
        return rest

    def decode(self, ids: bytes, run: int = 1 << 14) -> str:
        values = array("I", ids)
        text = [self.feed(values[k : k + run]) for k in range(0, len(values), run)]
        return "".join([*text, self.close()])


def _printable() -> list[str]:
    """The character that stands for each byte: itself where it is printable in Latin-1, else the next one from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(rest)) for b in range(256)]


def round_trip(docs: DataFrame, file: str = TOKENIZER) -> DataFrame:
    """``doc_id, n_tokens, ids, decoded`` for each row of ``docs(doc_id, text)``: the ids of the whole text as binary, and the text
    they decode to.

    A null text counts as empty: no ids, an empty text. Rows are independent, so repeated rows, rows without an id and empty tables
    need no rule, and other columns are ignored. Nothing is shuffled; a task's memory is that of its batch, the vocabulary and
    at most ``REMEMBERED`` words.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, decoder = Tokenizer(file), Decoder(file)
        for batch in batches:
            ids = tokenizer.encode_all([text or b"" for text in batch.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(i) // 4 for i in ids], type=pa.int64()),
                    pa.array(ids, type=pa.binary()),
                    pa.array(map(decoder.decode, ids), type=pa.string()),
                ],
                names=["doc_id", "n_tokens", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_tokens long, ids binary, decoded string")
