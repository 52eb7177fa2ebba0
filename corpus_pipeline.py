"""Corpus pipeline over documents: language ID, line dedup, near-duplicate documents,
secrets, packing.

Each stage takes ``(spark, docs, sf_dir)``; its result is written and read again as the
next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, line_dedup, packing, secret_scan, setsketch
from millrace.llm.common import Scratch, numbered, small_side, table

#: A document whose language is less sure than this, from 0 (chance) to 1, is rejected, as is
#: one without letters or less familiar than the network's labelled rows allow.
LEAST_MARGIN = 1 / 15


def _counted(docs: DataFrame) -> DataFrame:
    """``n_chars`` of the text as it is now."""
    if "n_chars" not in docs.columns:
        return docs
    kind = docs.schema["n_chars"].dataType
    return docs.withColumn("n_chars", F.char_length("text").cast(kind))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language the network can tell. If no row can teach it, all stay.

    A NULL or empty text, or one without a letter, goes. Rows are judged one by one by
    their text: equal texts alike, repeated and NULL ids too. An empty table stays one.
    Columns of any name stay as they are.
    """
    network = langid.train_on(docs)
    if network is None:
        return docs
    text = f"c{docs.columns.index('text')}"
    named = langid.with_language(numbered(docs), network, text, familiar=True)
    sure = (F.col("lang_pred") != langid.UNDETERMINED) & (network.margins(F.col("score")) >= LEAST_MARGIN)
    known = F.col("familiarity") >= network.least_familiar
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)]
    return named.filter(sure & known).select(*own)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that occur earlier, in full or, if they are not short,
    but for two edits.

    Of equal lines that of the smallest id stays, NULL ids last, then of the smallest line
    number; rows equal in id and text share their lines' fate. A document that loses all
    lines but blank ones goes; a NULL or empty text has lost none, and stays. An empty
    table stays one. Columns other than the text stay as they are.
    """
    return _counted(line_dedup.drop_repeated_lines(docs))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate group.

    Rows are known by id and text: of rows that repeat an id only those go whose own text
    is a copy. Equal rows go or stay together. A row with a NULL id, and one whose text is
    NULL or holds no word, stays. An empty table stays one. Columns of any name stay as
    they are.
    """
    scratch = Scratch(spark, "near-deduplication")
    judged = setsketch.near_duplicates(docs, shingle_words=5, threshold=80, with_key=True)
    gone = scratch.save(judged.filter(~F.col("kept")).select("doc_id", "text_key").distinct(), "gone")
    own = (F.col("docs.doc_id") == F.col("gone.doc_id")) & (
        F.xxhash64(F.coalesce(F.col("docs.text").cast("string"), F.lit(""))) == F.col("gone.text_key")
    )
    return docs.alias("docs").join(small_side(gone, scratch.path("gone")).alias("gone"), own, "left_anti")


def secret_removal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced.

    NULL and empty texts, repeated rows, and columns of any name stay as they are. An empty
    table stays one.
    """
    return _counted(secret_scan.redact(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences.

    A NULL text is an empty one: a piece of the closing id alone. Repeated rows are
    documents each, equal lengths are placed in any order, and an empty table gives no
    sequence. Columns other than id and text are not looked at.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_deduplication),
    ("minhash_near_dedup", near_deduplication),
    ("secret_scans", secret_removal),
    ("best_fit_packing", best_fit_packing),
]

#: The network's predictions cannot be stated in SQL; the tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (name, stage) in enumerate(STAGES):
        docs = scratch.save(stage(spark, docs, sf_dir), f"{number}-{name}")
    return docs
