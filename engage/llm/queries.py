"""Registered queries of this package and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.llm import alignment, forest, jaccard, langid, mixing, packing, pseudonyms, ranked, sketches, substrings, toxicity, transducer, urls
from engage.llm.common import table

PSEUDONYM_KEY = "registered query"  # whoever uses the operator passes a secret of their own
# Fixed values of the URL list: host, path, action.
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the URL list for every page."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, action string")
    return urls.judge_urls(table(spark, sf_dir, "pages"), rules)


_FITS = " ".join(
    f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}'"
    for h, p, _ in sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
)
_VERDICT = " ".join(f"WHEN '{h}{p}' THEN '{a}'" for h, p, a in URL_RULES)
OP1_SQL = rf"""
WITH cut AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), fits AS (SELECT *, CASE {_FITS} END AS rule FROM parts)
SELECT page_id, host, path, rule, CASE rule {_VERDICT} ELSE 'allow' END AS verdict FROM fits
"""


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words of windows that also start earlier."""
    kept = substrings.remove_repeats(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with personal data replaced by pseudonyms."""
    return pseudonyms.pseudonymise(table(spark, sf_dir, "documents"), PSEUDONYM_KEY).select("doc_id", "text", "n_replaced")


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and their places in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


def remainder(divisor: int) -> Column:
    """crc32 of the decimal ``doc_id`` modulo the divisor; null for a null id."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % divisor


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from two thirds of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    learned = docs.where(remainder(3) != 1)
    told = langid.identify(docs.select("doc_id", "text"), learned)
    held_out = F.coalesce(remainder(3) == 1, F.lit(False))
    return told.select("doc_id", held_out.alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from four fifths of the labelled ones."""
    docs = table(spark, sf_dir, "documents")
    learned = docs.where(remainder(5) != 0)
    labels = table(spark, sf_dir, "labels").where(remainder(5) != 0)
    scored = toxicity.score_texts(docs.select("doc_id", "text"), learned, labels, learned)
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


def op7_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint of every document and of its edited text, and their likeness."""
    return sketches.compare_edited(table(spark, sf_dir, "documents"))


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles agree to 90 percent."""
    return jaccard.jaccard_components(table(spark, sf_dir, "documents"))


def op9_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and components of all vectors at a cosine of 0.95."""
    return forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words taken of every document by the mix."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "copies"
    )


def op11_ranked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents of every benchmark item."""
    return ranked.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_TERMS = f"unnest(regexp_extract_all(translate(text, {_LOWER}), '{ranked.TERM}'))"
OP11_SQL = f"""
WITH rows AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents
), occurrences AS (SELECT r, doc_id, {_TERMS} AS term FROM rows
), sizes AS (SELECT r, doc_id, count(*) AS n FROM occurrences GROUP BY r, doc_id
), whole AS (SELECT count(*) AS documents, CAST(sum(n) AS BIGINT) AS terms FROM sizes
), asked AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {_TERMS} AS term FROM benchmark) GROUP BY item_id, term
), counts AS (SELECT r, term, count(*) AS tf FROM occurrences WHERE term IN (SELECT term FROM asked) GROUP BY r, term
), weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(documents) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM counts, whole GROUP BY term
), scores AS (
  SELECT item_id, r, s.doc_id, CAST(sum(times * w *
    ((1000000000 * tf) // (1000 * tf + 8 * (100 - 75 + ((75 * n * documents) // terms))))) AS BIGINT) AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes s USING (r), whole GROUP BY item_id, r, s.doc_id
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers over every document, and how common the links are in the corpus."""
    return alignment.linked(alignment.align(table(spark, sf_dir, "documents")))


def op13_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the text they decode to, as digests."""
    coded = transducer.round_trip(table(spark, sf_dir, "documents"))
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_urls": op1_urls,
    "op2_substrings": op2_substrings,
    "op3_pseudonyms": op3_pseudonyms,
    "op4_packing": op4_packing,
    "op5_langid": op5_langid,
    "op6_toxicity": op6_toxicity,
    "op7_sketches": op7_sketches,
    "op8_jaccard": op8_jaccard,
    "op9_embeddings": op9_embeddings,
    "op10_mixing": op10_mixing,
    "op11_ranked": op11_ranked,
    "op12_alignment": op12_alignment,
    "op13_bpe": op13_bpe,
}
ORACLE: dict[str, str] = {"op1_urls": OP1_SQL.strip(), "op11_ranked": OP11_SQL.strip()}
