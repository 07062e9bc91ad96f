"""Nulls in any column, empty and very long texts, repeated rows, empty tables and clashing column names."""

import os

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from engage.llm import forest, jaccard, langid, mixing, packing, pseudonyms, sketches, substrings, toxicity, urls

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Names that the operators use for columns of their own.
CLASHES = (
    "n size tag pos doc key node start length copies target source_size component label n_replaced lang_pred lang_score "
    "predicted _found _guess _logit _lang _own _id _tag _copy _times fingerprint hashes place best sets kept found vector block"
).split()
LONG = " ".join(f"wort{i % 977} der die und" for i in range(30_000))
ROWS = [
    (1, "the cat sat on the mat and then it ran away from the dog that was in the house of the man by the river", "en", "a", 3),
    (1, "the cat sat on the mat and then it ran away from the dog that was in the house of the man by the river", "en", "a", 3),
    (2, None, None, None, None),
    (3, "", "en", "b", 0),
    (4, " \t\n ", None, "b", 3),
    (5, "12345 !!! 9", "de", None, 1),
    (6, LONG, "de", "c", 0),
    (None, "ein Satz ohne Nummer, mail a.b@example.org", "de", "c", 0),
    (None, None, None, None, None),
    (7, "une phrase et une autre phrase avec le mot", None, "a", 5),
    (8, "\u00e9\u00e8 \U0001f600 \u4e2d\u6587", "fr", "a", 5),
]


@pytest.fixture(scope="module", params=["rows", "no rows", "only nulls", "clashing columns"])
def docs(spark, request):
    if request.param == "no rows":
        return spark.createDataFrame([], SCHEMA)
    if request.param == "only nulls":
        return spark.createDataFrame([(None,) * 5] * 3, SCHEMA)
    df = spark.createDataFrame(ROWS, SCHEMA)
    if request.param == "clashing columns":
        df = df.withColumns({c: F.lit("x") for c in CLASHES})
    return df


def test_packing(docs):
    out = packing.pack(docs).collect()
    heads = [r for r in out if r.start == 0]
    assert len(heads) == docs.count()
    assert sum(r.length for r in out) == sum(r.doc_tokens for r in heads)


def test_pseudonyms(docs):
    out = pseudonyms.pseudonymise(docs, "key")
    assert out.count() == docs.count()
    assert out.where("text IS NULL").count() == docs.where("text IS NULL").count()
    assert not [r for r in out.collect() if r.text and "a.b@example.org" in r.text]


def test_languages(docs):
    out = langid.identify(docs, docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert 0 <= r.lang_score <= 1
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.lang_score) == ("und", 0.0)


@pytest.mark.parametrize("taught", [[], [(1, 1)], [(1, 1), (3, 0), (6, 0), (7, 1), (99, 1), (None, 1), (5, None)]])
def test_toxicity(spark, docs, taught):
    labels = spark.createDataFrame(taught, "doc_id long, toxic int")
    out = toxicity.score_texts(docs, docs, labels, docs).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in out)


def test_sketches(docs):
    out = sketches.compare_edited(docs).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in out)


def test_jaccard(docs):
    out = jaccard.jaccard_components(docs).collect()
    assert len(out) == docs.count()
    assert all(r.component_id == r.doc_id for r in out)
    kept = jaccard.one_of_each_group(docs)
    assert kept.columns == docs.columns
    assert kept.count() == docs.count() - (1 if docs.where("doc_id = 1").count() == 2 else 0)


def test_substrings(docs):
    out = substrings.remove_repeats(docs).collect()
    assert len(out) == docs.count()
    for r in out:
        assert r.n_words == r.n_removed + len(r.kept.split())
        assert r.doc_id == 6 or r.n_removed == 0


def test_mixing(docs):
    out = mixing.mix(docs).collect()
    assert len(out) == docs.count()
    assert all(0 <= r.copies <= 2 for r in out)
    assert mixing.repeat(docs).count() == sum(r.copies for r in out)


def test_pipeline(spark, docs):
    rows = docs.select(*corpus_pipeline.COLUMNS)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        rows = stage(spark, rows, "")
        assert rows.columns == corpus_pipeline.COLUMNS
        rows = corpus_pipeline.written(rows, "stage")
    assert {r.start for r in corpus_pipeline.STAGES[-1][1](spark, rows, "").collect()} <= set(range(0, 1 << 20, 1))


def test_pages(spark):
    rules = spark.createDataFrame(
        [("Example.com", "/a/", "block"), ("example.com", "/a/", "allow"), ("", "/", "block"), (None, "/", "block"), ("x.org", None, "block"), ("org", "/", "else")],
        "host string, path string, action string",
    )
    rows = [(1, "http://EXAMPLE.com/a/b?c"), (1, "http://EXAMPLE.com/a/b?c"), (2, None), (None, "no scheme"), (3, ""), (4, "http://" + "a." * 5000 + "example.com/a/" + "x" * 50_000), (5, "http://notexample.com/a/")]
    pages = spark.createDataFrame(rows, "page_id long, url string").withColumns({c: F.lit(1) for c in ("host", "path", "rule", "block")})
    got = {(r.page_id, r.verdict, r.rule) for r in urls.judge_urls(pages, rules).collect()}
    assert got == {(1, "block", "example.com/a/"), (2, "allow", None), (None, "allow", None), (3, "allow", None), (4, "block", "example.com/a/"), (5, "allow", None)}
    assert urls.judge_urls(pages, rules).count() == len(rows)
    assert urls.judge_urls(pages, rules.limit(0)).where("verdict = 'allow'").count() == len(rows)
    assert urls.judge_urls(pages.limit(0), rules).count() == 0


def test_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, None), (5, []), (6, [0.0, 0.0]), (7, [nan, 1.0]),
        (8, [inf, 1.0]), (9, [None, 1.0]), (10, [1.0, 0.0, 0.0]), (None, [1.0, 0.0]), (11, [1e38, 1e30]),
    ]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumns({c: F.lit(1) for c in ("rep", "size", "leaf", "label")})
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in forest.near_vectors(vectors).collect())
    linked = [(i, 4, 1, i == 1) for i in (0, 1, 2, 2, 11)]
    assert got == sorted(linked + [(i, 0, i, True) for i in (3, 4, 5, 6, 7, 8, 9, 10)])
    assert forest.near_vectors(vectors.limit(0)).count() == 0
    assert forest.near_vectors(vectors.where("vec_id IN (4, 5)")).count() == 2


def test_rest_works_without_the_package():
    import __spark_entry__ as entry

    from engage.queries.registry import QUERIES

    assert set(QUERIES) < set(entry.queries())
    assert {f"op{n}" for n in range(1, 14)} == {q.split("_")[0] for q in entry.queries() if q.startswith("op")}
    assert os.path.dirname(corpus_pipeline.__file__) == os.path.dirname(entry.__file__)
