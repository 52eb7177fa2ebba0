"""Whole jobs: rows that earlier versions of the operators passed over."""

from __future__ import annotations

import pytest

import corpus_pipeline
from millrace.llm.common import Scratch
from millrace.llm.line_dedup import drop_repeated_lines, near_lines
from millrace.llm.queries import QUERIES

from .support import documents, documents_of
from .test_dedup import lines_by_force


def whole_lines_by_force(rows):
    """``lines_by_force``, with exact repeats of the lines that it leaves alone."""
    place = lambda doc, n: (doc is None, doc or 0, n)
    text = {(doc, n): line for doc, whole in rows for n, line in enumerate((whole or "").split("\n"))}
    occurs = {}
    for at, line in text.items():
        occurs.setdefault(line, []).append(at)
    out = []
    for doc, n, copies, links, kept in lines_by_force(rows):
        line = text[doc, n]
        if len(line) < 20:
            first = min(place(*at) for at in occurs[line]) == place(doc, n)
            copies, links, kept = len(occurs[line]), 0, first or not line.strip()
        out.append((doc, n, copies, links, kept))
    return sorted(out, key=str)


def test_short_lines_are_counted_and_judged(spark):
    long = "a line that is long enough to be near to others"
    rows = [
        (1, f"brief\n\n{long}\nbrief\nbrieg"), (2, f"brief\n{long}!\n \n"), (3, "19 characters here."),
        (4, "19 characters here.\n19 characters here"), (5, None), (6, ""), (None, "brief\nowned"),
    ]
    got = near_lines(documents(spark, rows))
    got = got.select("id", "line_no", "copies", "links", "kept").collect()
    assert sorted(map(tuple, got), key=str) == whole_lines_by_force(rows)
    left = {r["doc_id"]: r["text"] for r in drop_repeated_lines(documents(spark, rows)).collect()}
    # 2 has only blank lines left, which is none
    assert left == {
        1: f"brief\n\n{long}\nbrieg", 3: "19 characters here.", 4: "19 characters here", 5: None, 6: "", None: "owned",
    }


def test_lines_of_documents_with_text_ids(spark):
    line = "a line that is long enough to be near to others"
    rows = [("b", f"{line}\nown"), ("a", f"{line}!"), ("ä", f"{line}\nbrief"), (None, line), ("10", "brief")]
    got = near_lines(spark.createDataFrame(rows, "doc_id string, text string"))
    assert {(r["id"], r["line_no"]): (r["copies"], r["links"], r["kept"]) for r in got.collect()} == {
        ("b", 0): (3, 1, False), ("b", 1): (1, 0, True), ("a", 0): (1, 1, True), ("ä", 0): (3, 1, False),
        ("ä", 1): (2, 0, False), (None, 0): (3, 1, False), ("10", 0): (2, 0, True),
    }


def test_line_dedup_query_and_stage_judge_short_lines(spark, sf_dir):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    got = QUERIES["op2_line_dedup"](spark, sf_dir)
    short = {}
    for doc, text in documents_of(spark, sf_dir):
        for n, line in enumerate(text.split("\n")):
            if len(line) < 20:
                short.setdefault(line, []).append((doc, n))
    want = {at: (len(places), at == min(places)) for places in short.values() for at in places}
    found = {(r["doc_id"], r["line_no"]): (r["copies"], r["kept"]) for r in got.collect()}
    assert {at: found[at] for at in want} == want and len(want) > len(short)
    some = source.filter("doc_id < 120")
    rows = [tuple(r) for r in some.select("doc_id", "text").collect()]
    kept = {(doc, n) for doc, n, _, _, keep in whole_lines_by_force(rows) if keep}
    left = {}
    for doc, text in rows:
        lines = [line for n, line in enumerate(text.split("\n")) if (doc, n) in kept]
        if lines:
            left[doc] = "\n".join(lines)
    staged = corpus_pipeline.line_deduplication(spark, some, sf_dir).collect()
    assert {r["doc_id"]: r["text"] for r in staged} == left


UNLEARNED = [
    (9101, "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью."),
    (9102, "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι και ίσοι στην αξιοπρέπεια και τα δικαιώματα."),
    (9103, "人人生而自由,在尊严和权利上一律平等。他们赋有理性和良心,并应以兄弟关系的精神相对待。"),
    (9104, "#@!% a &*(^ ~~ {}[] <> || \\\\ ++ == -- ;; 0x12 %% $$ @@ !! ?? 99 88 b ^^"),
]


@pytest.mark.parametrize("languages", [["en"], ["en", "fr"], ["de", "en", "es", "fr"]])
def test_unlearned_languages_go_and_clean_documents_stay(spark, sf_dir, languages):
    source = spark.read.parquet(f"{sf_dir}/documents.parquet")
    clean = source.filter(source["lang"].isin(languages))
    odd = spark.createDataFrame([(doc, text, None, "s", len(text)) for doc, text in UNLEARNED], source.schema)
    left = corpus_pipeline.language_id(spark, clean.unionByName(odd), sf_dir)
    assert left.columns == source.columns
    assert sorted(r[0] for r in left.select("doc_id").collect()) == sorted(r[0] for r in clean.select("doc_id").collect())


@pytest.mark.parametrize("name", ["op1_near_duplicates", "op2_line_dedup", "op4_token_counts", "op9_warc", "op12_source_divergence"])
def test_no_task_holds_a_whole_group(spark, sf_dir, name, monkeypatch):
    """No window over a key of the data, and no join that aggregates right before it
    meets the rows of a group, as AQE cannot split either."""
    plans = []
    save = Scratch.save

    def watched(self, df, label):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return save(self, df, label)

    monkeypatch.setattr(Scratch, "save", watched)
    result = QUERIES[name](spark, sf_dir)
    plans.append(result._jdf.queryExecution().executedPlan().toString())
    ranks = ("row_number", "sum(terms")  # ranks are limited map-side; bases are a row per transducer
    for plan in plans:
        windows = [line for line in plan.splitlines() if "Window [" in line]
        assert all(any(r in w for r in ranks) for w in windows), windows
