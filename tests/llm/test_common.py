"""What the operators share."""

from __future__ import annotations

import public_tokenizers

from millrace.llm.common import BATCH_BYTES, Scratch, grouped, path_exists, prepare_workers, small_side
from millrace.llm.packing import pack
from millrace.runtime import in_bytes, settings

SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_batches_are_bounded_and_never_made_larger(spark):
    for given, want in (("32m", BATCH_BYTES), ("1m", 1 << 20)):
        with settings(spark, {SETTING: given}):
            prepare_workers(spark)
            assert in_bytes(spark, SETTING) == want


def test_text_operators_take_smaller_batches(spark):
    with settings(spark, {SETTING: "32m"}):
        pack(spark.createDataFrame([(1, "a b")], "doc_id long, text string"), public_tokenizers.path("word_bpe_49k.json"))
        rows = spark.range(0, 100, 1, 1).selectExpr("id", "repeat('x', 200000) AS text")
        sizes = rows.mapInArrow(lambda batches: (b.from_pydict({"n": [b.nbytes]}) for b in batches), "n long")
        assert max(r["n"] for r in sizes.collect()) <= 3 << 20


def test_only_small_tables_are_marked_for_broadcast(spark, monkeypatch):
    scratch = Scratch(spark, "test-common")
    df = scratch.save(spark.range(1000), "t")
    hinted = lambda: "ResolvedHint" in small_side(df, scratch.path("t"))._jdf.queryExecution().analyzed().toString()
    assert hinted()
    monkeypatch.setattr("millrace.llm.common.SMALL_BYTES", 10)
    assert not hinted()
    scratch.drop("t")
    assert not path_exists(spark, scratch.path("t"))


def test_grouped_keeps_every_text():
    texts = ["a" * n for n in (1, 5, 900, 2, 3, 0)]
    lists = list(grouped(iter(texts), 6))
    assert [t for some in lists for t in some] == texts
    assert [len(some) for some in lists] == [2, 1, 3]
