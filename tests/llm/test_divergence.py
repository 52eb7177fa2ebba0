"""Source divergence and its transducers against brute force, and their edge cases."""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from millrace.llm import transducer
from millrace.llm.divergence import source_divergence, terms_of

CLASHES = ["term", "ordinal", "share", "block", "value", "rank", "kept", "all", "base", "first"]


def documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` string" for c in CLASHES)
    return spark.createDataFrame([(*r, *("x" for _ in CLASHES)) for r in rows], schema)


def words(text):
    folded = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", folded)


def by_force(rows, least=10, top=10):
    rows = [(text, lang or "", source or "") for _, text, lang, source in rows]
    held, groups = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        held[lang].update(set(words(text)))
        groups[lang, source].update(words(text))
    out = []
    for lang in held.keys() | {g[0] for g in groups}:
        kept = sorted((t for t, n in held[lang].items() if n >= least), key=str.encode)
        of = {s: {t: c[t] for t in kept} for (g, s), c in groups.items() if g == lang}
        whole = {t: sum(c[t] for c in of.values()) for t in kept}
        share = lambda c: {t: 1 + Fraction(10**9 * (n + 2), sum(c.values()) + 2 * len(kept)).__floor__() for t, n in c.items()}  # noqa: B023, E731
        usual, shares = share(whole), {s: share(c) for s, c in of.items()}
        f = lambda p, q: Fraction((p - q) ** 2, p + q).__floor__()
        for s, p in shares.items():
            pairs = [(-sum(f(p[t], q[t]) for t in kept), o) for o, q in shares.items() if o != s]
            more = [(-f(p[t], usual[t]), t) for t in kept if of[s][t] and p[t] > usual[t]]
            for part, items in (("pair", pairs), ("term", more)):
                ranked = sorted(items, key=lambda x: (x[0], x[1].encode()))
                out += [
                    (lang, s, part, item, -v, n)
                    for n, (v, item) in enumerate(ranked, 1)
                    if part == "pair" or n <= top
                ]
    return sorted(out)


def found(df):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in df.collect())


@settings(max_examples=60, deadline=None)
@given(st.sets(st.text("abcé", max_size=6), max_size=40), st.lists(st.text("abcdé", max_size=7), max_size=20))
def test_transducer_numbers_its_terms_and_knows_no_others(terms, others):
    data = sorted(t.encode() for t in terms)
    built = transducer.Transducer.from_bytes(transducer.build(data).to_bytes())
    assert list(built) == data and built.terms == len(data)
    asked = data + [o.encode() for o in others]
    sizes = np.array([len(a) for a in asked], np.int64)
    whole = np.frombuffer(b"".join(asked) + b"\0", np.uint8)
    want = [data.index(a) if a in data else -1 for a in asked]
    assert built.ordinals(whole, np.cumsum(sizes) - sizes, sizes).tolist() == want


def test_transducer_is_minimal():
    """As many states as there are different sets of continuations."""
    random = np.random.default_rng(2)
    terms = {"".join(random.choice(list("ab"), random.integers(1, 8))) + end for end in ("ing", "ed", "s") for _ in range(60)}
    data = sorted(t.encode() for t in terms)
    futures = {frozenset(t[i:] for t in data if t.startswith(p)) for d in data for i in range(len(d) + 1) for p in [d[:i]]}
    built = transducer.build(data)
    assert len(built.final) == len(futures)
    assert len(built.final) < sum(len(d) for d in data) / 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("aZ é1@[`{\x7f\n\x00ß漢😀", max_size=12), max_size=8))
def test_terms_are_those_of_the_pattern(texts):
    coded, text = terms_of(pa.array(["skipped", *texts], pa.string()).slice(1))
    got = list(zip(text.tolist(), coded.cast(pa.large_string()).to_pylist()))
    assert got == [(i, w) for i, t in enumerate(texts) for w in words(t)]


def rows_of():
    random = np.random.default_rng(7)
    vocabulary = [f"{a}{b}" for a in ("alp", "Bet", "gamé", "漢", "zz") for b in ("", "a", "ON", "é", "ing", "q")]
    rows = []
    for i in range(400):
        lang = [None, "en", "de", "fr"][i % 4]
        source = "hot" if i % 3 == 0 else [None, "s1", "s2", "S2", "é"][i % 5]
        picked = random.choice(vocabulary, random.integers(0, 25), p=None)
        rows.append((i, " ".join(picked) + random.choice(["", ".", "\n", " x1y "]), lang, source))
    rows += [rows[5], rows[5], (None, None, "en", "empty"), (9001, "", "en", "empty"), (9002, "12 34", "en", "digits")]
    rows += [(9003, "only once", "it", "a"), (9004, "never again", "it", "b"), (9005, None, "xx", None)]
    rows += [(9006, "long" * 50_000 + " " + "alp " * 50_000, "en", "long")]
    return rows


@pytest.mark.parametrize("shard, pass_bytes, block", [(32_768, 32 << 20, 1024), (4, 1, 3)])
def test_against_brute_force(spark, shard, pass_bytes, block):
    rows = rows_of()
    got = found(source_divergence(documents(spark, rows), shard=shard, pass_bytes=pass_bytes, block=block))
    assert got == by_force(rows)
    assert {g[2] for g in got if g[0] == "it"} == {"pair"} and not [g for g in got if g[0] == "xx"]


def test_equal_values_are_ranked_in_byte_order(spark):
    rows = [(i, "é z a Z", "en", f"s{i % 3}") for i in range(30)]
    got = found(source_divergence(documents(spark, rows)))
    assert got == by_force(rows)
    own = [g for g in got if g[1] == "s0"]
    assert [(g[3], g[4], g[5]) for g in own if g[2] == "pair"] == [("s1", 0, 1), ("s2", 0, 2)]
    terms = {g[3]: g[4:] for g in own if g[2] == "term"}
    assert terms["a"][0] == terms["é"][0] and terms["a"][1] == terms["é"][1] - 1


def test_an_empty_table_gives_an_empty_result(spark):
    assert found(source_divergence(documents(spark, []))) == []


def test_shares_are_exact_beyond_a_long(spark):
    from millrace.llm.divergence import _share
    from pyspark.sql import functions as F

    n, all_, kept = 123_456_789_012_345, 987_654_321_098_765, 40_000_000
    row = spark.range(1).select(_share(*(F.lit(x).cast("long") for x in (n, all_, kept))).alias("share")).first()
    assert row["share"] == 1 + 10**9 * (n + 2) // (all_ + 2 * kept)
