"""Ranked search against SQL and against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import oracle
import pytest

from engage.llm import queries, ranked

PATTERN = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return PATTERN.findall(folded)


def by_force(docs, items, k=10):
    counted = [(doc_id, Counter(terms(text))) for doc_id, text in docs]
    counted = [(doc_id, c, c.total()) for doc_id, c in counted if c]
    n_docs, n_terms = len(counted), sum(n for _, _, n in counted)
    frequency = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c, n in counted:
            m = 25 + 75 * n * n_docs // n_terms
            score = 0
            for t in terms(text):
                if c[t]:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * frequency[t] + 1)))
                    score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        for rank, (score, _, _, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, doc_id, -score))
    return sorted(out, key=str)


def found(df):
    return sorted([(r.item_id, r["rank"], r.doc_id, r.score) for r in df.collect()], key=str)


def test_query(spark, data_dir):
    sql = queries.ORACLE["op11_ranked"]
    assert oracle.differences(queries.op11_ranked(spark, data_dir), oracle.connect(data_dir), sql) == []


@pytest.mark.parametrize("shard, postings, leaf, block", [(8192, 1 << 19, 1024, 2000), (50, 400, 0, 3), (7, 90, 5, 1), (64, 1, 40, 7)])
def test_all_shards_leaves_and_blocks_agree(spark, monkeypatch, shard, postings, leaf, block):
    for name, value in (("SHARD_DOCS", shard), ("SHARD_POSTINGS", postings), ("LEAF", leaf), ("BLOCK_ITEMS", block)):
        monkeypatch.setattr(ranked, name, value)
    r = random.Random(leaf)
    vocabulary = [f"w{k}" for k in range(60)] + ["É", "é", "中文", "Ab", "aB"]
    skewed = [vocabulary[min(int(r.paretovariate(0.6)), len(vocabulary) - 1)] for _ in range(4000)]
    docs = [(r.choice([None, r.randrange(400)]), " ,".join(r.choices(skewed, k=r.choice([1, 3, 30, 200])))) for _ in range(350)]
    docs += [(1000 - k, docs[5][1]) for k in range(40)] + [(1, None), (2, ""), (3, "...!")] + [docs[7]] * 3
    items = [(k, " ".join(r.choices(vocabulary + skewed[:50], k=r.randint(1, 25)))) for k in range(12)]
    items += [(3, "w1 w1 w2"), (20, None), (21, "?"), (22, "unknown"), (None, docs[5][1])]
    table = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS terms", "2 AS n", "3 AS item", "4 AS score").repartition(3)
    asked = spark.createDataFrame(items, "item_id int, text string").selectExpr("*", "5 AS rank", "6 AS doc_id")
    assert found(ranked.rank(table, asked)) == by_force(docs, items)
    assert found(ranked.rank(table, asked, k=3)) == by_force(docs, items, 3)


def test_empty_tables_and_long_texts(spark):
    docs = spark.createDataFrame([(1, "a b " * 300_000), (2, "b"), (3, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "A c"), (2, "b " * 5000)], "item_id long, text string")
    assert found(ranked.rank(docs, items)) == by_force([(r.doc_id, r.text) for r in docs.collect()], [(1, "A c"), (2, "b " * 5000)])
    assert ranked.rank(docs, items.limit(0)).count() == ranked.rank(docs.limit(0), items).count() == 0
    assert ranked.rank(docs.where("text IS NULL"), items).count() == 0


def test_maxima_are_the_first_largest():
    r = np.random.default_rng(3)
    term = np.sort(r.integers(0, 5, size=300))
    doc = np.concatenate([np.arange((term == t).sum()) for t in range(5)])
    impact = r.integers(1, 9, size=300)
    shard = ranked.Shard(np.zeros(300, dtype=bool), np.arange(300), term, doc, impact)
    low = r.integers(0, 300, size=500)
    high = np.minimum(low + r.integers(0, 60, size=500), shard.end[np.searchsorted(shard.end, low, side="right")])
    for a, b, place in zip(low, high, shard.maxima(low, high)):
        assert place == (a + int(np.argmax(impact[a:b])) if b > a else -1)


def test_bounds_dismiss_most_documents(monkeypatch):
    """With one document far ahead the search scores few others."""
    scored = []
    monkeypatch.setattr(ranked, "LEAF", 4)
    r = np.random.default_rng(1)
    impact = r.integers(1, 100, size=4000)
    impact[[77, 2077]] = 10_000
    shard = ranked.Shard(np.zeros(2000, dtype=bool), np.arange(2000), np.repeat([0, 1], 2000), np.tile(np.arange(2000), 2), impact)
    best = ranked.Best(1)
    monkeypatch.setattr(best, "offer", lambda *row: (scored.append(row), ranked.Best.offer(best, *row)))
    shard.search(ranked.Item(0, np.array([0, 1]), np.array([1, 1])), best)
    assert best.rows == [(-20_000, False, 77)] and len(scored) == 1
