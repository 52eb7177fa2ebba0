"""Exact dedup with a heavy-hitter split.

Misra-Gries summaries, one per task, find the digests that hold a large share of all
rows. Their winners (counted exactly) are few by construction and are broadcast, so
rows of hot groups are settled where they are read. All other digests meet in an
ordinary shuffle, which then holds no hot key.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SPACE_RUN, Scratch, column, prepare_workers, table, text_or_empty

#: A digest with at least 1/512 of the rows is certain to be treated as hot.
HOT_SHARE = 1 / 512
#: Counters per Misra-Gries summary; its error is rows / (COUNTERS + 1).
COUNTERS = 2047


def merge_counters(held: pd.Series, more: pd.Series, size: int) -> pd.Series:
    """Misra-Gries merge: add, then take the (size+1)-th count off every counter."""
    both = held.add(more, fill_value=0) if len(held) else more
    if len(both) > size:
        both = both - both.nlargest(size + 1).iloc[-1]
        both = both[both > 0]
    return both


def _summaries(size: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = pd.Series(dtype="int64")
        for batch in batches:
            held = merge_counters(held, batch["digest"].value_counts(), size)
        if len(held):
            yield pd.DataFrame({"digest": held.index, "held": held.to_numpy("int64")})

    return run


def hot_digests(digests: DataFrame, rows: int, share: float, counters: int) -> DataFrame:
    """Every digest with ``share`` of the rows, and at most ``1 / (share - 1 / counters)``
    digests in all: counters never exceed true counts, whose sum is ``rows``."""
    least = max(2.0, (share - 1 / (counters + 1)) * rows)
    return (
        digests.select("digest")
        .mapInPandas(_summaries(counters), "digest binary, held long")
        .groupBy("digest")
        .agg(F.sum("held").alias("held"))
        .filter(F.col("held") >= least)
        .select("digest")
    )


def exact_dedup(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    hot_share: float = HOT_SHARE,
    counters: int = COUNTERS,
) -> DataFrame:
    """One row per input row: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they are after each run of white space became one space; a
    NULL text is an empty one. The smallest id of a group stays. Rows that repeat that
    id stay with it. NULL ids stay only where a group has no other; ``keep_id`` is NULL
    then. An empty table gives an empty result. Other columns are not looked at.
    """
    if not hot_share > 1 / (counters + 1):
        raise ValueError("hot_share must exceed the error of the summaries")
    prepare_workers(df.sparkSession)
    scratch = Scratch(df.sparkSession, "exact-dedup")
    text = F.regexp_replace(text_or_empty(text_col), SPACE_RUN, " ")
    digests = scratch.save(
        df.select(column(id_col).alias("id"), F.unhex(F.sha2(text, 256)).alias("digest")),
        "digests",
    )
    hot = scratch.save(hot_digests(digests, digests.count(), hot_share, counters), "hot")
    totals = (F.min("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    winners = scratch.save(
        digests.join(F.broadcast(hot), "digest").groupBy("digest").agg(*totals), "winners"
    )
    settled = digests.join(F.broadcast(winners), "digest")
    rest = digests.join(F.broadcast(hot), "digest", "left_anti")
    rest = rest.join(rest.groupBy("digest").agg(*totals), "digest")
    return settled.unionByName(rest).select(
        F.col("id").alias(id_col),
        "keep_id",
        "group_size",
        F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op3_exact_dedup(spark, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
         AS text_sha256
  FROM documents
), g AS (
  SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM d JOIN g USING (text_sha256)
"""
