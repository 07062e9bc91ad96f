"""From documents to packed training sequences: five stages, each over all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.llm import jaccard, langid, mixing, packing, pseudonyms
from engage.llm.common import small_batches, table, written

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
SHINGLE, PERCENT = 5, 80  # of near duplicates: words of a run, and the least share of common runs

KEY = "corpus pipeline"  # of the pseudonyms; use a secret where the result leaves the house

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Set ``lang`` to the predicted language; drop texts without a letter and those that do not fit it.

    Null and empty texts have no letter and go. A null language teaches nothing; if no row teaches, all rows go. Repeated rows are
    judged alike; an empty table stays empty; other columns than ``COLUMNS`` go.
    """
    small_batches(spark)
    told = langid.identify(docs, docs)
    return told.where("lang_fits").withColumn("lang", F.col("lang_pred")).select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of linked ones: those that share 0.8 or more of their five-word runs.

    A row without an id comes after all others, ties go by a hash of the text; of repeated rows one stays. Null, empty and blank
    texts are linked with nothing and stay; an empty table stays empty.
    """
    small_batches(spark)
    return jaccard.one_of_each_group(docs, size=SHINGLE, percent=PERCENT).select(*COLUMNS)


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data by pseudonyms of the same format.

    All rows stay, null and empty texts as they are (``n_chars`` null and 0). Repeated rows get equal texts.
    """
    hidden = pseudonyms.pseudonymise(docs, KEY)
    return hidden.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat each document as often as the mix takes it; drop those it does not take.

    Rows without words (null and empty texts among them) have size 0 and are not taken; a null source is a source of its own, the
    last. Repeated rows are documents of their own; which of equal ones is taken makes no difference. An empty table stays empty.
    """
    return mixing.repeat(docs).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences of 2048 tokens.

    A null or empty text is its end token. Copies of a document made by the mix are packed each; an empty table has no pieces.
    """
    small_batches(spark)
    return packing.pack(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("personal_data", hide_personal_data),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

# Learned classifiers, keyed permutations and sequential packing have no SQL counterpart; tests use brute force instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, for the documents of ``sf_dir``. Every other stage is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
