"""Language identification by hierarchical discrimination.

A text is first given a language family, then a language of that family. Families are learned: languages whose mean
profiles of letter sequences are closest are put together. Families are told apart by one linear support vector machine
each (one versus the rest), the languages of a family by one machine for each pair, which vote.

Features are hashed sequences of one to three bytes of the lower-cased text, in which all but letters is blank; counts
are damped by the square root and the vector scaled to length one. Models are fitted in numpy on a bounded sample of
labelled rows; the texts themselves never leave the executors, only their profiles do.

The machines always choose some learned language. Whether a text fits it is judged apart, by the mean log odds of its sequences
under the mean profile of that language: how far it lies below the median of labelled texts, in units that widen for short
texts, against a bound that nearly all labelled texts stay within.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.llm import words
from engage.llm.common import free_name

FEATURES = 1 << 12
PER_LANGUAGE = 1000  # labelled rows of a language that are used to fit, at most
UNKNOWN = "und"
PREDICTION = "lang string, score double"
SMOOTH = 0.01  # share of the mean profile that is spread over all features
OWN_SPREAD = 256  # different sequences from which texts differ by their subject rather than by chance
LEAST_LABELLED = 20  # labelled rows of a language without which nothing is said to miss it
_ROWS = 256  # texts whose profiles are held at once


def _alphabet() -> np.ndarray:
    """Bytes as features see them: a-z, A-Z folded, bytes of other scripts as they are, all else blank."""
    code = np.full(256, 32, dtype=np.uint32)
    code[97:123] = np.arange(97, 123)
    code[65:91] = np.arange(97, 123)
    code[128:] = np.arange(128, 256)
    return code


def profiles(texts: pa.Array, features: int = FEATURES) -> Iterator[tuple[int, int, np.ndarray]]:
    """``first row, row after the last, profiles`` of runs of texts; a profile has length one, or is 0 for no text."""
    code = _alphabet()
    for first, last, data, bounds in words.chunks(texts, most_rows=_ROWS):
        rows = last - first
        row = np.repeat(np.arange(rows, dtype=np.int64) * features, np.diff(bounds))
        c = code[data]
        counts = np.zeros(rows * features, dtype=np.float64)
        for n in (1, 2, 3):
            if len(c) < n:
                break
            size = len(c) - n + 1
            h = np.full(size, n, dtype=np.uint32)
            for k in range(n):
                h = (h ^ c[k : k + size]) * np.uint32(0x01000193)
                h ^= h >> np.uint32(15)
            whole = row[:size] == row[n - 1 :]  # not across two texts
            at = row[:size] + (h % np.uint32(features))
            counts += np.bincount(at[whole], minlength=rows * features)
        x = np.sqrt(counts.reshape(rows, features)).astype(np.float32)
        norm = np.sqrt((x * x).sum(axis=1, keepdims=True))
        yield first, last, x / np.maximum(norm, 1e-9)


def linear_svm(x: np.ndarray, y: np.ndarray, strength: float = 1e-4, steps: int = 150) -> np.ndarray:
    """Weights (the last is the bias) of a linear machine for ``y`` in -1, 1: squared hinge loss, classes weighted
    equally, by accelerated gradient descent. No copy of ``x`` is made."""
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())).astype(np.float32)
    w = np.zeros(x.shape[1] + 1, dtype=np.float32)
    ahead, rate, momentum = w.copy(), 0.25, 0.0
    for step in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (x @ ahead[:-1] + ahead[-1]))
        pull = (share * y * slack).astype(np.float32)
        gradient = strength * ahead - 2 * np.append(pull @ x, pull.sum(dtype=np.float32))
        new = ahead - rate * gradient
        momentum = (step - 1) / (step + 2)
        ahead = new + momentum * (new - w)
        w = new
    return w


@dataclass
class Usual:
    """Log odds of the features in texts of a language, their median over labelled texts, and the largest distance that fits."""

    odds: np.ndarray
    median: float
    bound: float = np.inf

    def distance(self, x: np.ndarray) -> np.ndarray:
        return _units(self.median - (x * x) @ self.odds, x)


def _units(below: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Chance alone moves the mean of n sequences by about one in the root of n."""
    return below / np.sqrt(1 / np.maximum(1, (x > 0).sum(axis=1)) + 1 / OWN_SPREAD)


def _log_odds(share: np.ndarray) -> np.ndarray:
    return np.log((1 - SMOOTH) * np.maximum(share, 0) + SMOOTH / share.shape[-1])


def usual_texts(x: np.ndarray, right: np.ndarray) -> Usual:
    """From the profiles of labelled rows of one language. Each row is judged by the mean of the others; the bound is twice the
    distance that one in 200 of the rows whose language is told right (``right``) exceeds; with fewer than
    ``LEAST_LABELLED`` of them there is none."""
    q = x * x
    mean = q.mean(axis=0)
    usual = Usual(_log_odds(mean), 0.0)
    if right.sum() >= LEAST_LABELLED:
        seen = np.concatenate([(p * _log_odds((len(q) * mean - p) / (len(q) - 1))).sum(axis=1) for p in np.array_split(q, -(-len(q) // _ROWS))])
        usual.median = float(np.median(seen[right]))
        usual.bound = 2 * max(1.0, float(np.quantile(_units(usual.median - seen, x)[right], 0.995)))
    return usual


@dataclass
class Model:
    """Families (lists of languages), the machine of each family, and the machine of each pair within a family."""

    families: list[list[str]]
    family: np.ndarray
    pairs: dict[tuple[str, str], np.ndarray] = field(default_factory=dict)
    usual: dict[str, Usual] = field(default_factory=dict)

    def fits(self, x: np.ndarray, names: list[str]) -> np.ndarray:
        """Whether each profile is like labelled texts of the language given for it."""
        out, names = np.ones(len(x), dtype=bool), np.array(names, dtype=object)
        for name, usual in self.usual.items():
            rows = np.flatnonzero(names == name)
            if len(rows):
                out[rows] = usual.distance(x[rows]) <= usual.bound
        return out

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        """Language and score in 0 .. 1 of each profile."""
        margin = x @ self.family[:, :-1].T + self.family[:, -1]
        family_odds = np.exp(4 * (margin - margin.max(axis=1, keepdims=True)))
        family_odds /= family_odds.sum(axis=1, keepdims=True)
        chosen = margin.argmax(axis=1)
        names, score = np.empty(len(x), dtype=object), np.zeros(len(x))
        for f, languages in enumerate(self.families):
            rows = np.flatnonzero(chosen == f)
            if not len(rows):
                continue
            votes = np.zeros((len(rows), len(languages)))
            for (i, a), (j, b) in combinations(enumerate(languages), 2):
                w = self.pairs[a, b]
                p = 1 / (1 + np.exp(np.clip(-4 * (x[rows] @ w[:-1] + w[-1]), -50, 50)))
                votes[:, i] += p
                votes[:, j] += 1 - p
            best = votes.argmax(axis=1)
            names[rows] = np.array(languages, dtype=object)[best]
            within = votes.max(axis=1) / max(1, len(languages) - 1) if len(languages) > 1 else 1.0
            score[rows] = family_odds[rows, f] * within
        return list(names), np.clip(score, 0.0, 1.0)


def group_families(names: list[str], centroids: np.ndarray) -> list[list[str]]:
    """Join the two closest groups of languages (mean cosine) until about the square root of their number is left."""
    groups = [[k] for k in range(len(names))]
    centred = centroids - centroids.mean(axis=0)
    centred /= np.maximum(np.linalg.norm(centred, axis=1, keepdims=True), 1e-9)
    near = centred @ centred.T
    while len(groups) > max(1, round(len(names) ** 0.5)):
        a, b = max(combinations(range(len(groups)), 2), key=lambda p: near[np.ix_(groups[p[0]], groups[p[1]])].mean())
        groups[a] += groups.pop(b)
    return [sorted(names[k] for k in g) for g in groups]


def _sparse(profile: np.ndarray) -> bytes:
    """Places and values of the features that are not 0, two bytes each."""
    at = np.flatnonzero(profile)
    return np.concatenate([at.astype("<u2"), profile[at].astype("<f2").view("<u2")]).tobytes()


def _fill(row: np.ndarray, sparse: bytes) -> None:
    at, values = np.frombuffer(sparse, dtype="<u2").reshape(2, -1)
    row[at] = values.view("<f2")


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE, features: int = FEATURES) -> Model | None:
    """Learn from ``labelled(doc_id, text, lang)``; null if no row has a language and a letter.

    Of each language at most about ``per_language`` rows are used, those with the smallest hash of ``doc_id`` and text.
    Their profiles are all that comes to the driver, as the few hundred features that are not 0.
    """
    rows = labelled.select("doc_id", "text", "lang").where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if not counts:
        return None
    span = 1 << 30
    share = F.create_map(
        *[F.lit(v) for lang, n in counts.items() for v in (lang, int(span * min(1.0, 1.1 * per_language / n)))]
    )
    place = F.pmod(F.xxhash64("doc_id", "text"), F.lit(span))
    sample = rows.select("lang", "text", place.alias("place")).where(F.col("place") <= F.element_at(share, F.col("lang")))

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, x in profiles(batch.column(1), features):
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, last - first),
                        batch.column(2).slice(first, last - first),
                        pa.array(map(_sparse, x), type=pa.binary()),
                    ],
                    names=["lang", "place", "profile"],
                )

    found = sample.mapInArrow(describe, "lang string, place long, profile binary").toArrow()
    order = sorted(range(len(found)), key=list(zip(found["lang"].to_pylist(), found["place"].to_pylist())).__getitem__)
    lang, profile = found["lang"].to_pylist(), found["profile"]
    used: dict[str, list[int]] = {}
    for k in order:
        if len(used.setdefault(lang[k], [])) < per_language:
            used[lang[k]].append(k)
    names = sorted(used)
    y = np.array([n for n in names for _ in used[n]], dtype=object)
    x = np.zeros((len(y), features), dtype=np.float32)
    for row, k in enumerate(k for name in names for k in used[name]):
        _fill(x[row], profile[k].as_py())
    del found, profile
    families = group_families(names, np.stack([x[y == n].mean(axis=0) for n in names]))
    member = {n: f for f, group in enumerate(families) for n in group}
    of = np.array([member[n] for n in y])
    one = len(families) == 1
    machines = [
        np.zeros(features + 1, dtype=np.float32) if one else linear_svm(x, np.where(of == f, 1, -1).astype(np.float32))
        for f in range(len(families))
    ]
    model = Model(families, np.stack(machines))
    for group in families:
        for a, b in combinations(group, 2):
            rows_ab = np.flatnonzero((y == a) | (y == b))
            model.pairs[a, b] = linear_svm(x[rows_ab], np.where(y[rows_ab] == a, 1, -1).astype(np.float32))
    told = [name for part in np.array_split(x, -(-len(x) // _ROWS)) for name in model.predict(part)[0]]
    right = np.array(told, dtype=object) == y
    model.usual = {n: usual_texts(x[y == n], right[y == n]) for n in names}
    return model


CENTRE_UNITS = 1 << 20  # profiles are added up as whole numbers, so that their order changes nothing


@dataclass
class Centres:
    """Mean profile of each language, less that of all, with length one."""

    names: list[str]
    middle: np.ndarray
    vectors: np.ndarray

    def nearest(self, texts: pa.Array) -> list[str]:
        """The language whose mean profile is closest to that of each text; empty where nothing was learned."""
        if not self.names:
            return [""] * len(texts)
        return [self.names[k] for _, _, x in profiles(texts) for k in ((x - self.middle) @ self.vectors.T).argmax(axis=1)]


def centres(labelled: DataFrame) -> Centres:
    """Learn from all rows of ``labelled(text, lang)`` with a language and a letter. Tasks add up profiles; only the sums travel."""
    rows = labelled.select("lang", "text").where(F.col("lang").isNotNull() & has_letter(F.col("text")))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for first, last, x in profiles(batch.column(1)):
                lang = np.array(batch.column(0).slice(first, last - first).to_pylist(), dtype=object)
                for name in set(lang):
                    part = np.rint(x[lang == name] * np.float32(CENTRE_UNITS)).sum(axis=0, dtype=np.float64).astype(np.int64)
                    sums[name] = sums.get(name, 0) + np.append(part, (lang == name).sum())
        for name, total in sums.items():
            places = np.arange(len(total), dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(total)), pa.array(places), pa.array(total)], names=["lang", "place", "total"]
            )

    found = rows.mapInArrow(add, "lang string, place int, total long").groupBy("lang", "place").agg(F.sum("total").alias("total")).toArrow()
    lang, place, total = (found[c].to_numpy(zero_copy_only=False) for c in ("lang", "place", "total"))
    names = sorted(set(lang))
    sums = np.zeros((len(names), FEATURES + 1))
    sums[np.searchsorted(np.array(names, dtype=object), lang), place] = total
    means = sums[:, :-1] / np.maximum(sums[:, -1:], 1) / CENTRE_UNITS
    middle = means.mean(axis=0) if names else np.zeros(FEATURES)
    vectors = means - middle
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return Centres(names, middle.astype(np.float32), vectors.astype(np.float32))


def predictor(model: Model | None, features: int = FEATURES):
    """Column function ``text -> struct<lang, score, fits>``: ``und`` with score 0 that does not fit for a null text, one without
    letters, or where nothing was learned."""

    @F.arrow_udf("struct<lang: string, score: double, fits: boolean>")
    def predict(texts: pa.Array) -> pa.Array:
        names: list[str] = []
        scores: list[np.ndarray] = []
        fits: list[bool] = []
        for _, _, x in profiles(texts, features):
            got, score = model.predict(x)
            names += got
            scores.append(score)
            fits += model.fits(x, got).tolist()
        score = np.concatenate(scores) if scores else np.zeros(0)
        return pa.StructArray.from_arrays(
            [pa.array(names, type=pa.string()), pa.array(score, type=pa.float64()), pa.array(fits, type=pa.bool_())],
            names=["lang", "score", "fits"],
        )

    # Else a filter on what it gives is moved before it and has every text judged twice, each time by a Python worker of its own.
    predict = predict.asNondeterministic()
    unknown = F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"), F.lit(False).alias("fits"))

    def column(text: Column) -> Column:
        if model is None:
            return unknown
        return F.when(has_letter(text), predict(text)).otherwise(unknown)

    return column


def identify(docs: DataFrame, labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``docs`` with the columns ``lang_pred``, ``lang_score`` and ``lang_fits`` added, learned from ``labelled(doc_id, text, lang)``.

    Only ``text`` is read to predict. Null texts and texts without any letter are ``und``, score 0, and do not fit, as is every
    row if there is nothing to learn from. The score compares the learned languages with each other; ``lang_fits`` tells
    whether the text is like labelled texts of its language at all. Repeated rows get equal results; very long texts are
    read whole; columns of ``docs`` with the three names are replaced.
    """
    guess = predictor(fit(labelled, per_language))
    own = free_name(docs, "_guess")
    named = docs.withColumn(own, guess(F.col("text")))
    return named.withColumns(
        {"lang_pred": F.col(f"{own}.lang"), "lang_score": F.col(f"{own}.score"), "lang_fits": F.col(f"{own}.fits")}
    ).drop(own)
