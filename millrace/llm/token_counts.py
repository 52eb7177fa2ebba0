"""Token counts through a digest cache.

A text is known by the digest of its content, a tokenizer by the digest of its file.
Texts whose pair of digests is in the cache table are not encoded again; of the others
each distinct text is encoded once and its count appended.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from functools import cache
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import (
    SMALL_BYTES,
    Scratch,
    column,
    give_back_memory,
    grouped,
    path_exists,
    prepare_workers,
    small_side,
    stored_bytes,
    table,
    text_or_empty,
)
from .merges import LONGEST, from_tokenizer_file

CACHE_SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: Entries a worker's piece cache may hold before it starts anew.
CACHE_ENTRIES = 150_000
#: Stands in for the count of a piece that cannot be told from its surroundings.
UNCLEAR = -(1 << 60)


def tokenizer_digest(path: str) -> str:
    return hashlib.sha256(Path(path).read_bytes()).hexdigest()


class PieceCounter:
    """Counts tokens of a byte-level tokenizer file, remembering counts of pieces.

    A lone space or line feed between two characters that are not white space always
    begins a new pre-token, so the pieces between such places are counted one by one.
    Words of Latin-1 letters and ASCII punctuation are merged many at a time by the
    file's own merge table; every other piece goes to the tokenizer, and texts with
    more white space at a piece's edge go there whole.
    """

    PLAIN = re.compile(r"(\n?)([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\[-`{-~]*)")

    def __init__(self, path: str, entries: int = CACHE_ENTRIES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.merger, self.first, _ = from_tokenizer_file(path)
        self.entries = entries
        self.counts: dict[str, int] = {}

    def whole(self, text: str) -> int:
        return len(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _learn(self, pieces: list[str]) -> None:
        known = self.counts
        plain, words, other = [], {}, []
        for piece in pieces:
            found = self.PLAIN.fullmatch(piece)
            if found and len(piece) <= LONGEST // 2 - 1:
                begin = found[2] if found[1] else " " + found[2]
                plain.append((piece, len(found[1]), begin, found[3]))
                words[begin] = words[found[3]] = 0
            else:
                body = piece[1:] if piece[:1] == "\n" else piece
                if not body or body[0].isspace() or body[-1].isspace():
                    known[piece] = UNCLEAR
                else:
                    other.append(piece)
        words.pop("", None)
        _, counts = self.merger.merge([w.encode("utf-8") for w in words], self.first)
        words = dict(zip(words, counts.tolist())) | {"": 0}
        for piece, line_feeds, begin, tail in plain:
            known[piece] = line_feeds + words[begin] + words[tail]
        texts = [p if p[0] == "\n" else " " + p for p in other]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        for piece, encoding in zip(other, found):
            known[piece] = len(encoding.ids)

    def count_all(self, texts: list[str]) -> list[int]:
        if len(self.counts) > self.entries:
            self.counts.clear()
        split = [text.replace("\n", " \n").split(" ") for text in texts]
        # What is not after a space is counted with its text's first piece.
        heads = [pieces.pop(0) for pieces in split]
        self._learn([p for p in dict.fromkeys(chain.from_iterable(split)) if p not in self.counts])
        known, out = self.counts, []
        for text, head, pieces in zip(texts, heads, split):
            n = sum(map(known.__getitem__, pieces))
            if not text:
                out.append(0)
            elif n < 0 or not head or head[0].isspace() or head[-1].isspace():
                out.append(self.whole(text))
            else:
                out.append(n + self.whole(head))
        return out


@cache
def piece_counter(path: str) -> PieceCounter:
    return PieceCounter(path)


def _count_batches(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = piece_counter(path)
        for batch in batches:
            texts = grouped(t.as_py() for t in batch.column("text"))
            counts = list(chain.from_iterable(map(counter.count_all, texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("digest"), pa.array(counts, pa.int64())], ["digest", "n_tokens"]
            )
        counter.counts.clear()
        give_back_memory()

    return run


def cached_counts(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    """The cache's counts for one tokenizer, one row per digest whoever appended it."""
    stored = spark.read.schema(CACHE_SCHEMA).parquet(cache_path)
    return (
        stored.filter(F.col("tokenizer") == version)
        .groupBy("digest")
        .agg(F.max("n_tokens").alias("n_tokens"))
    )


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    cache_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    limit: int = 1024,
) -> DataFrame:
    """One row per input row: id, ``n_bytes`` (UTF-8), ``n_tokens``, ``over_limit``.

    The tokenizer's own handling of special strings applies; none are added. Content
    is normalised only as far as no count can change: a NULL text becomes an empty
    one, of 0 tokens. Repeated and NULL ids give a row each. An empty table gives an
    empty result; other columns are not looked at.
    """
    spark = df.sparkSession
    prepare_workers(spark)
    version = tokenizer_digest(tokenizer_path)
    text = text_or_empty(text_col)
    digest = F.unhex(F.sha2(text, 256)).alias("digest")
    scratch = Scratch(spark, "token-counts")
    texts, missing = df.select(digest, text.alias("text")), None
    if path_exists(spark, cache_path):
        # Digests are compared first: few misses, or none, leave the texts where they are.
        missing = df.select(digest).distinct().join(cached_counts(spark, cache_path, version), "digest", "left_anti")
        missing = scratch.save(missing, "missing")
        if stored_bytes(spark, scratch.path("missing")) <= SMALL_BYTES:
            texts, missing = texts.join(F.broadcast(missing), "digest", "left_semi"), None
    once = texts.groupBy("digest").agg(F.any_value("text").alias("text"))
    if missing is not None:
        # Repeats of a text are combined before this join, so that no key of it is hot.
        once = once.join(missing, "digest", "left_semi")
    (
        once.mapInArrow(_count_batches(tokenizer_path), "digest binary, n_tokens long")
        .select(F.lit(version).alias("tokenizer"), "digest", "n_tokens")
        .write.mode("append")
        .parquet(cache_path)
    )
    rows = df.select(
        column(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), digest
    )
    # From a stored copy both sides of the join are plain shuffles, which AQE splits where
    # one text has most rows.
    counts = scratch.save(cached_counts(spark, cache_path, version), "counts")
    return rows.join(small_side(counts, scratch.path("counts")), "digest").select(
        F.col("id").alias(id_col),
        "n_bytes",
        "n_tokens",
        (F.col("n_tokens") > limit).alias("over_limit"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twice on one cache: the first call fills it, the second finds every text there."""
    import public_tokenizers

    cache = Scratch(spark, "token-counts").path("cache")
    documents = table(spark, sf_dir, "documents")
    for _ in range(2):
        counted = count_tokens(documents, public_tokenizers.path("byte_bpe_50k.json"), cache)
    return counted
