"""Toxicity by a convolutional text classifier, trained in numpy on all labelled rows.

Words and their first letters are hashed into a table of embeddings, so that forms of a word share what is learned of
one; filters of several widths slide over the words of the whole text, the largest response of each filter is kept, and a linear layer turns these into a logit. Texts of a language share a
threshold that is calibrated on labelled rows kept out of training; the language is guessed from the text.

Each part of the labelled rows trains a replica. In each epoch every replica goes on from the common network with its own rows, in a task
of its own; then their moves are averaged, those of a word's embedding over the replicas that have the word. So all rows
teach in every epoch without being moved, and what one task holds and what comes to the driver (the network) do not grow with them.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage.llm import langid, words
from engage.llm.bloom import blocked_filter, may_hold
from engage.llm.common import free_name, written

BUCKETS = 1 << 16
PREFIXES = (4, 5)  # bytes of a word's start that are hashed besides the word
DIMENSIONS = 16
FILTERS = 16
WIDTHS = (1, 2, 3)
REPLICA = 8192  # labelled rows of a replica, at least, if there are so many; also the rows that are held and shuffled at once
EPOCHS = 6
BATCH = 64
PART_WORDS = 1 << 16  # words of a batch whose gradients are computed at once
RATE = 0.01
SCORED = 1 << 13  # words that are scored at once, or one longer text
BLOCK = 1 << 14  # numbers of the network that are averaged in one row
STEPS = 256  # parts of a unit of a logit that thresholds are told by
PAD = max(WIDTHS)  # blank places after each text, so that no filter reaches into the next


def _separator() -> np.ndarray:
    """All bytes but ASCII letters and digits and those of other scripts part words."""
    parts = np.ones(256, dtype=bool)
    parts[128:] = False
    for span in (range(48, 58), range(65, 91), range(97, 123)):
        parts[list(span)] = False
    return parts


def word_ids(texts: pa.Array, buckets: int = BUCKETS) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``first row, row after the last, ids, bounds`` of runs of texts. A word has several ids, 1 .. buckets - 1: its own and
    those of its starts (0 where the word is no longer than that); each text is followed by ``PAD`` rows of zeros."""
    separator = _separator()
    for first, last, data, bounds in words.chunks(texts):
        starts, ends, place = words.word_bounds(data, bounds, separator)
        row = np.repeat(np.arange(last - first), np.diff(place))
        laid = np.zeros((len(starts) + PAD * (last - first), 1 + len(PREFIXES)), dtype=np.int64)
        stops = np.stack([ends, *[np.minimum(starts + k, ends) for k in PREFIXES]])
        hashed = words.word_hashes(data, np.broadcast_to(starts, stops.shape), stops, lower=True)
        hashed = words.mix64(hashed + np.arange(len(stops), dtype=np.uint64)[:, None])
        ids = ((hashed >> np.uint64(33)) % np.uint64(buckets - 1) + np.uint64(1)).astype(np.int64)
        ids[1:][stops[1:] == ends] = 0
        laid[np.arange(len(starts)) + PAD * row] = ids.T
        yield first, last, laid, place + PAD * np.arange(last - first + 1)


@dataclass
class Network:
    embedding: np.ndarray  # buckets x dimensions; row 0 is blank and stays 0
    filters: list[np.ndarray]  # for each width: width x dimensions x filters
    bias: list[np.ndarray]
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, random: np.random.Generator) -> Network:
        e = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
        e[0] = 0
        f = [random.normal(0, (w * DIMENSIONS) ** -0.5, (w, DIMENSIONS, FILTERS)).astype(np.float32) for w in WIDTHS]
        out = random.normal(0, 0.1, FILTERS * len(WIDTHS)).astype(np.float32)
        return cls(e, f, [np.zeros(FILTERS, np.float32) for _ in WIDTHS], out, np.zeros(1, np.float32))

    def tables(self) -> list[np.ndarray]:
        """For each width the response of its filters to every word at every place, so that scoring only looks up and adds."""
        return [np.hstack([self.embedding @ part for part in f]) for f in self.filters]

    def logits(self, tables: list[np.ndarray], ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        # Some texts at a time, so that what is looked up stays in the processor's cache.
        cuts, pooled = [0], []
        while cuts[-1] < len(bounds) - 1:
            cuts.append(max(cuts[-1] + 1, int(np.searchsorted(bounds, bounds[cuts[-1]] + SCORED, side="right")) - 1))
        for first, last in zip(cuts[:-1], cuts[1:]):
            at = bounds[first : last + 1] - bounds[first]
            pooled.append(self._pooled(tables, np.ascontiguousarray(ids[bounds[first] : bounds[last]].T), at))
        return np.concatenate(pooled) @ self.out + self.out_bias[0] if pooled else np.zeros(0, np.float32)

    def _pooled(self, tables: list[np.ndarray], ids: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The largest response of every filter in each text; ``ids`` has a row for each feature."""
        pooled = []
        for table, b in zip(tables, self.bias):
            found = table.take(ids[0], axis=0)
            for own in ids[1:]:
                found += table.take(own, axis=0)
            response = np.ascontiguousarray(found[:, :FILTERS])
            for k in range(1, table.shape[1] // FILTERS):
                response[:-k] += found[k:, k * FILTERS : (k + 1) * FILTERS]
            # Places where a filter would reach into the next text lie in the blanks; they count for nothing.
            for k in range(1, PAD):
                response[bounds[1:] - k] = -np.inf
            pooled.append(np.maximum(np.maximum.reduceat(response, bounds[:-1], axis=0) + b, 0))
        return np.hstack(pooled)

    def parameters(self) -> list[np.ndarray]:
        return [self.embedding, *self.filters, *self.bias, self.out, self.out_bias]


def _gradients(net: Network, ids: np.ndarray, bounds: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Gradients of the mean logistic loss, in the order of ``parameters``."""
    n = len(y)
    x = net.embedding[ids].sum(axis=1)
    tops, places = [], []
    for f, b in zip(net.filters, net.bias):
        w = len(f)
        response = x @ f[0]
        for k in range(1, w):
            response[: len(ids) - k] += x[k:] @ f[k]
        at = np.stack(
            [lo + response[lo : hi - PAD + 1].argmax(axis=0) for lo, hi in zip(bounds[:-1], bounds[1:])]
        )
        tops.append(np.take_along_axis(response, at, axis=0) + b)
        places.append(at)
    hidden = np.hstack([np.maximum(t, 0) for t in tops])
    logit = hidden @ net.out + net.out_bias[0]
    slope = (weight * (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y) / n).astype(np.float32)
    back = slope[:, None] * net.out * (hidden > 0)
    g_embedding = np.zeros_like(net.embedding)
    g_filters, g_bias = [], []
    for i, (f, at) in enumerate(zip(net.filters, places)):
        g = back[:, i * FILTERS : (i + 1) * FILTERS]
        g_bias.append(g.sum(axis=0))
        g_f = np.zeros_like(f)
        for k in range(len(f)):
            spot = at + k
            g_f[k] = np.einsum("dfe,df->ef", x[spot], g)
            back_x = (g[:, :, None] * f[k].T[None]).reshape(-1, DIMENSIONS)
            for feature in range(ids.shape[1]):
                # One number at a time, which numpy adds faster than rows.
                at_once = ids[spot, feature].reshape(-1, 1) * DIMENSIONS + np.arange(DIMENSIONS)
                np.add.at(g_embedding.reshape(-1), at_once.ravel(), back_x.ravel())
        g_filters.append(g_f)
    g_embedding[0] = 0
    return [g_embedding, *g_filters, *g_bias, hidden.T @ slope, np.array([slope.sum()], dtype=np.float32)]


def _by_words(rows: np.ndarray, texts: list[np.ndarray]) -> Iterator[np.ndarray]:
    """The rows of a batch in parts of bounded words, so that long texts do not widen its memory; a longer one is a part of its own."""
    start = held = 0
    for k, row in enumerate(rows):
        if k > start and held + len(texts[row]) > PART_WORDS:
            yield rows[start:k]
            start, held = k, 0
        held += len(texts[row])
    yield rows[start:]


def _vector(parts: list[np.ndarray]) -> np.ndarray:
    return np.concatenate([p.ravel() for p in parts])


def _parts(vector: np.ndarray, net: Network) -> list[np.ndarray]:
    """A vector as arrays of the shapes of the network's parameters."""
    ends = np.cumsum([p.size for p in net.parameters()])
    return [v.reshape(p.shape) for v, p in zip(np.split(vector, ends[:-1]), net.parameters())]


def _network(vector: np.ndarray) -> Network:
    net = Network.fresh(np.random.default_rng(0))
    for p, own in zip(net.parameters(), _parts(vector, net)):
        p[...] = own
    return net


def learn(net: Network, rate: float, parts: Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]], seed: list[int]) -> None:
    """Train the network in place by Adam on ``texts, y, weight`` of each part, shuffled, in batches; ``texts`` are padded word ids."""
    first, second = ([np.zeros_like(p) for p in net.parameters()] for _ in range(2))
    steps, random = 0, np.random.default_rng(seed)
    for texts, y, weight in parts:
        order = random.permutation(len(texts))
        for start in range(0, len(order), BATCH):
            rows = order[start : start + BATCH]
            steps += 1
            total: list[np.ndarray] | None = None
            for part in _by_words(rows, texts):
                ids = np.concatenate([texts[r] for r in part]).astype(np.int64)
                bounds = np.concatenate([[0], np.cumsum([len(texts[r]) for r in part])])
                found = [g * (len(part) / len(rows)) for g in _gradients(net, ids, bounds, y[part], weight[part])]
                total = found if total is None else [t + g for t, g in zip(total, found)]
            for p, g, m, v in zip(net.parameters(), total, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**steps)) / (np.sqrt(v / (1 - 0.999**steps)) + 1e-8)


def _word_arrays(ids: pa.ChunkedArray | pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x.as_py(), dtype=np.uint16).reshape(-1, 1 + len(PREFIXES)) for x in ids]


def train(rows: DataFrame, counts: dict[int, int], epochs: int = EPOCHS, seed: int = 11) -> Network:
    """The network learned from all of ``rows(toxic, ids)``, of which each class has so many; both classes weigh the same."""
    share = {c: 0.5 * sum(counts.values()) / n for c, n in counts.items()}
    rows = rows.select("toxic", "ids").coalesce(max(1, sum(counts.values()) // REPLICA))
    state = _vector(Network.fresh(np.random.default_rng(seed)).parameters())
    size = len(state)

    def one(state: np.ndarray, rate: float, epoch: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            replica = TaskContext.get().partitionId()
            # What a word's row was moved to without an occurrence of the word is momentum alone and not told.
            seen = np.ones(-(-size // DIMENSIONS), dtype=np.float32)
            seen[:BUCKETS] = 0

            def parts() -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray]]:
                texts: list[np.ndarray] = []
                toxic: list[int] = []

                def part() -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
                    y = np.array(toxic, dtype=np.float32)
                    return texts, y, np.where(y > 0, share.get(1, 0), share.get(0, 0))

                for batch in batches:
                    for label, ids in zip(batch.column(0).to_pylist(), _word_arrays(batch.column(1))):
                        seen[ids.ravel()] = 1
                        texts.append(ids)
                        toxic.append(label)
                        if len(texts) == REPLICA:
                            yield part()
                            texts, toxic = [], []
                if texts:
                    yield part()

            net = _network(state)
            learn(net, rate, parts(), [seed, epoch, replica])
            moved = ((_vector(net.parameters()) - state) * np.repeat(seen, DIMENSIONS)[:size]).astype(np.float16)
            for block, k in enumerate(range(0, size, BLOCK)):
                told = seen[k // DIMENSIONS : (k + BLOCK) // DIMENSIONS].astype(np.float16)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([block], type=pa.int32()),
                        pa.array([replica], type=pa.int32()),
                        pa.array([moved[k : k + BLOCK].tobytes()]),
                        pa.array([told.tobytes()]),
                    ],
                    names=["block", "replica", "moved", "seen"],
                )

        return run

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                own = sums.setdefault(row["block"], [0.0, 0.0])
                for k, name in enumerate(("moved", "seen")):
                    own[k] = own[k] + np.frombuffer(row[name], dtype=np.float16).astype(np.float64)
        for block, (moved, seen) in sums.items():
            mean = moved / np.maximum(1, np.repeat(seen, DIMENSIONS)[: len(moved)])
            yield pa.RecordBatch.from_arrays([pa.array([block], type=pa.int32()), pa.array([mean.astype(np.float32).tobytes()])], names=["block", "moved"])

    for epoch in range(epochs):
        rate = RATE * (1 - epoch / (epochs + 1))
        moves = rows.mapInArrow(one(state, rate, epoch), "block int, replica int, moved binary, seen binary")
        # Added up in one order, so that reruns agree.
        mean = moves.repartition("block").sortWithinPartitions("block", "replica").mapInArrow(add, "block int, moved binary")
        state = state + np.concatenate([np.frombuffer(x.as_py(), dtype=np.float32) for x in mean.toArrow().sort_by("block")["moved"]])
    return _network(state)


def best_threshold(logit: np.ndarray, y: np.ndarray, weight: np.ndarray) -> float:
    """The cut with the best F1 of weighted rows, midway between two logits."""
    order = np.argsort(-logit, kind="stable")
    hit = np.cumsum((weight * y)[order])
    called = np.cumsum(weight[order])
    f1 = 2 * hit / (called + (weight * y).sum())
    sorted_ = logit[order]
    f1[:-1][sorted_[:-1] == sorted_[1:]] = -1
    best = int(np.argmax(f1))
    return float((sorted_[best] + sorted_[min(best + 1, len(order) - 1)]) / 2)


def calibrate(logit: np.ndarray, y: np.ndarray, lang: list[str], weight: np.ndarray, least: int = 25) -> dict[str, float]:
    """Threshold of each language with enough rows of both classes; the entry "" is that of all rows, for the others. ``weight`` counts rows.

    A language's own best cut is drawn towards that of all rows, the more so the fewer toxic rows it has.
    """
    cut = {"": best_threshold(logit, y, weight)}
    names = np.array(lang, dtype=object)
    for name in sorted(set(lang)):
        own = names == name
        hits, misses = (weight[own & side].sum() for side in (y > 0, y <= 0))
        if min(hits, misses) >= least:
            best = best_threshold(logit[own], y[own], weight[own])
            cut[name] = float((hits * best + 100 * cut[""]) / (hits + 100))
    return cut


def _taught(texts: DataFrame, labels: DataFrame, centres: langid.Centres) -> DataFrame:
    """``toxic, lang, ids, aside`` of all labelled texts: the label, the guessed language, the word ids, and whether the row is kept out
    of training, alike for equal texts. Only texts whose id may be labelled move, as their ids."""
    kind = labels.schema["doc_id"].dataType
    taught = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("_id").isNotNull() & F.col("toxic").isin(0, 1)
    )
    wanted = blocked_filter(taught.select(F.xxhash64("_id").alias("key")))
    whole = texts.select(F.col("doc_id").cast(kind).alias("id"), "text").dropna()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(wanted, batch.column(0).to_numpy()), type=pa.bool_()))
            for first, last, ids, bounds in word_ids(batch.column(2)):
                each = [ids[a:b].astype(np.uint16).tobytes() for a, b in zip(bounds[:-1], bounds[1:])]
                lang = centres.nearest(batch.column(2).slice(first, last - first))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(first, last - first), pa.array(lang, type=pa.string()), pa.array(each, type=pa.binary())],
                    names=["id", "lang", "ids"],
                )

    coded = whole.select(F.xxhash64("id").alias("key"), "id", "text").mapInArrow(read, f"id {kind.simpleString()}, lang string, ids binary")
    aside = F.pmod(F.xxhash64("ids", F.lit(5)), F.lit(5)) == 0
    # Not broadcast at any size: the labels grow with the texts, and word ids of labelled texts alone are dealt out.
    return coded.join(taught.hint("merge"), coded["id"] == taught["_id"]).select("toxic", "lang", "ids", aside.alias("aside"))


def thresholds(net: Network, rows: DataFrame) -> dict[str, float]:
    """``calibrate`` on all of ``rows``: they are counted by language, label and logit in steps, so that only counts come to the driver."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables()
        for batch in batches:
            logit = [net.logits(tables, t.astype(np.int64), np.array([0, len(t)]))[0] for t in _word_arrays(batch.column(2))]
            step = np.floor(np.array(logit, dtype=np.float64) * STEPS).astype(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(step)], names=["toxic", "lang", "step"])

    told = rows.select("toxic", "lang", "ids").mapInArrow(run, "toxic int, lang string, step long")
    found = told.groupBy("lang", "step", "toxic").agg(F.count("*").alias("times")).orderBy("lang", "step", "toxic").toArrow()
    toxic = found["toxic"].to_numpy()
    if len(set(toxic.tolist())) < 2:
        return {"": 0.0}
    logit, times = (found["step"].to_numpy() + 0.5) / STEPS, found["times"].to_numpy().astype(np.float64)
    return calibrate(logit, toxic.astype(np.float64), found["lang"].to_pylist(), times)


def score_texts(docs: DataFrame, texts: DataFrame, labels: DataFrame, languages: DataFrame) -> DataFrame:
    """``docs`` with ``score`` (0 to 1, from 0.5 on toxic) and ``predicted`` (0 or 1) added.

    ``labels(doc_id, toxic)`` are the labels to learn from, ``texts(doc_id, text)`` holds their texts, and
    ``languages(text, lang)`` the rows from which the language guess is learned. All labelled rows teach, with their whole texts, however
    long: four fifths of them the network, the others the thresholds.

    Only the text is read to score, whole. A null or empty text, or one without words, gets the network's answer to no words.
    Rows with a null id, text or label teach nothing; with one class or none, every score is that class (0 if none). Repeated
    rows get equal scores; columns ``score`` and ``predicted`` of ``docs`` are replaced, others pass through.
    """
    centres = langid.centres(languages)
    rows = written(_taught(texts, labels, centres), "taught")
    counts = {(r["aside"], r["toxic"]): r["n"] for r in rows.groupBy("aside", "toxic").agg(F.count("*").alias("n")).collect()}
    classes = sorted({c for _, c in counts})
    if len(classes) < 2:
        only = classes[0] if classes else 0
        return docs.withColumns({"score": F.lit(float(only)), "predicted": F.lit(only)})
    # With so few rows that a class is only among those kept out, all of them train.
    apart = all((False, c) in counts for c in classes)
    fitted = {c: sum(counts.get((side, c), 0) for side in ((False,) if apart else (False, True))) for c in classes}
    net = train(rows.where(~F.col("aside")) if apart else rows, fitted)
    cuts = thresholds(net, rows.where("aside"))

    @F.arrow_udf("double")
    def respond(column: pa.Array) -> pa.Array:
        at = net.tables()
        found = [net.logits(at, ids, bounds) for _, _, ids, bounds in word_ids(column)]
        logit = np.concatenate(found).astype(np.float64) if found else np.zeros(0)
        return pa.array(logit - np.array([cuts.get(name, cuts[""]) for name in centres.nearest(column)], dtype=np.float64))

    own = free_name(docs, "_logit")
    told = docs.withColumn(own, respond(F.coalesce("text", F.lit(""))))
    return (
        told.withColumn("score", 1 / (1 + F.exp(-F.col(own))))
        .withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))
        .drop(own)
    )
