"""How far the sources of a language differ in their vocabulary.

First pass over the texts: in how many documents of its language each term occurs. Terms
in enough of them are sorted and built into minimal acyclic transducers, each of a bounded
range of a language's terms; a term's ordinal, counted over the ranges, is its rank in
byte order. Second pass: texts stream through the transducers, and occurrences are counted
by ordinal, so no term travels as text any more. Ordinals also break ties, and lead back
to terms in the end.

Texts are folded and cut into terms as bytes, a batch at a time; equal terms of a batch
take one walk. Sources are compared in blocks of terms: a block holds every source of the
language, and adds up its share of each pair of sources.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import transducer
from .common import Scratch, give_back_memory, prepare_workers, small_side, table, text_or_empty

#: Documents of its language that a kept term occurs in, and terms reported per source.
LEAST_DOCUMENTS, TOP_TERMS = 10, 10
#: Terms of a transducer, bytes of transducers a task holds in one pass over the texts,
#: and terms of a block in which sources are compared.
SHARD_TERMS, PASS_BYTES, BLOCK_TERMS = 32_768, 32 << 20, 1024

# Terms are runs of ASCII letters and of anything beyond ASCII, which no byte of a
# character beyond ASCII is mistaken for; only A to Z are folded.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x61:0x7B] = np.arange(0x61, 0x7B)
_FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)
_FOLD[0x80:] = np.arange(0x80, 0x100)


# -- terms of a batch ------------------------------------------------------------------


def terms_of(texts: pa.Array) -> tuple[pa.DictionaryArray, np.ndarray]:
    """The terms of all texts, as codes of distinct terms, and the text of each."""
    texts = texts.cast(pa.large_string())
    ends = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    folded = _FOLD[np.frombuffer(data, np.uint8)[ends[0] : ends[-1]]] if data else np.empty(0, np.uint8)
    ends = ends - ends[0]
    inside = np.zeros(len(folded) + 2, bool)
    inside[1:-1] = folded != 0
    begins = inside[1:] & ~inside[:-1]
    # a text that begins with a term begins a term, whatever is before it
    cut = ends[:-1][ends[:-1] < ends[1:]]
    begins[cut] |= inside[1:][cut]
    starts = np.flatnonzero(begins)
    letters = folded[inside[1:-1]]
    place = np.cumsum(inside[1:-1])[starts] - 1 if len(starts) else starts
    offsets = np.append(place, len(letters)).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(letters))
    text = np.searchsorted(ends, starts, side="right") - 1
    return terms.dictionary_encode(), text


def _codes(values: pa.Array) -> tuple[np.ndarray, list]:
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()


def _document_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per batch: documents of each language that hold a term."""
    for batch in batches:
        coded, text = terms_of(batch.column("text"))
        lang, langs = _codes(batch.column("lang"))
        n = max(1, len(coded.dictionary))
        held = np.unique(text * n + coded.indices.to_numpy())
        told, documents = np.unique(lang[held // n] * n + held % n, return_counts=True)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()).take(pa.array(told // n)),
                coded.dictionary.cast(pa.string()).take(pa.array(told % n)),
                pa.array(documents.astype(np.int64)),
            ],
            ["lang", "term", "documents"],
        )
    give_back_memory()


# -- vocabulary ------------------------------------------------------------------------


def _shards(size: int):
    """Sorted ``lang, term`` rows as transducers of at most ``size`` terms."""

    def row(lang: str, terms: list[str]) -> pa.RecordBatch:
        data = [t.encode() for t in terms]
        packed = transducer.build(data).to_bytes()
        values = {"lang": [lang], "first": [data[0]], "terms": [len(data)], "packed": [packed]}
        return pa.RecordBatch.from_pydict(values, pa.schema([("lang", pa.string()), ("first", pa.binary()), ("terms", pa.int64()), ("packed", pa.binary())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_lang, held = None, []
        for batch in batches:
            for lang, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if held and (lang != held_lang or len(held) == size):
                    yield row(held_lang, held)
                    held = []
                held_lang = lang
                held.append(term)
        if held:
            yield row(held_lang, held)
        give_back_memory()

    return run


def build_vocabulary(kept: DataFrame, scratch: Scratch, shard: int = SHARD_TERMS) -> DataFrame:
    """``lang, term`` rows as stored transducers: ``lang``, ``first`` (smallest term),
    ``terms``, ``packed`` and ``base``, the ordinal of the first term."""
    ranged = kept.select("lang", "term").repartitionByRange("lang", "term").sortWithinPartitions("lang", "term")
    shards = scratch.save(ranged.mapInArrow(_shards(shard), "lang string, first binary, terms long, packed binary"), "shards")
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    bases = shards.select("lang", "first", F.coalesce(F.sum("terms").over(before), F.lit(0).cast("long")).alias("base"))
    bases = scratch.save(bases, "bases")  # a row per transducer
    joined = shards.join(small_side(bases, scratch.path("bases")), ["lang", "first"])
    return scratch.save(joined, "vocabulary")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every term of every transducer with its ordinal."""
    for batch in batches:
        for lang, base, packed in zip(*(batch.column(c) for c in ("lang", "base", "packed"))):
            terms = [t.decode() for t in transducer.Transducer.from_bytes(packed.as_py())]
            ordinals = pa.array(base.as_py() + np.arange(len(terms), dtype=np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang.as_py()] * len(terms), pa.string()), ordinals, pa.array(terms, pa.string())],
                ["lang", "ordinal", "term"],
            )


class Vocabulary:
    """Transducers of some ranges of terms, by language."""

    def __init__(self, rows: list[tuple]):
        self.ranges: dict[str, list[tuple]] = {}
        for lang, first, base, packed in sorted(rows, key=lambda r: (r[0], r[1])):
            held = (bytes(first), base, transducer.Transducer.from_bytes(packed))
            self.ranges.setdefault(lang, []).append(held)

    def ordinals(self, lang: str, terms: pa.Array) -> np.ndarray:
        """Of every term, -1 for one that is not in any of these ranges."""
        out = np.full(len(terms), -1, np.int64)
        ranges = self.ranges.get(lang, [])
        if not ranges or not len(terms):
            return out
        ends = np.frombuffer(terms.buffers()[1], np.int64)[terms.offset : terms.offset + len(terms) + 1]
        data = np.frombuffer(terms.buffers()[2], np.uint8)
        starts, sizes = ends[:-1], np.diff(ends)
        if len(ranges) == 1:
            chosen = np.zeros(len(terms), np.int64)
        else:
            firsts = [r[0] for r in ranges]
            chosen = np.array([bisect_right(firsts, t.encode()) - 1 for t in terms.to_pylist()])
        for i, (_, base, held) in enumerate(ranges):
            some = np.flatnonzero(chosen == i)
            found = held.ordinals(data, starts[some], sizes[some])
            out[some] = np.where(found < 0, -1, found + base)
        return out


def _recounted(shipped):
    """Per batch: occurrences of each kept term by language and source."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(shipped.value)
        for batch in batches:
            coded, text = terms_of(batch.column("text"))
            lang, langs = _codes(batch.column("lang"))
            source, sources = _codes(batch.column("source"))
            n, m = max(1, len(coded.dictionary)), max(1, len(sources))
            group = lang * m + source
            told, times = np.unique(group[text] * n + coded.indices.to_numpy(), return_counts=True)
            of_lang, code = told // n // m, told % n
            ordinal = np.full(len(told), -1, np.int64)
            for i, name in enumerate(langs):
                here = of_lang == i
                used, back = np.unique(code[here], return_inverse=True)
                ordinal[here] = vocabulary.ordinals(name, coded.dictionary.take(pa.array(used)))[back]
            kept = ordinal >= 0
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(langs, pa.string()).take(pa.array(of_lang[kept])),
                    pa.array(sources, pa.string()).take(pa.array((told // n % m)[kept])),
                    pa.array(ordinal[kept]),
                    pa.array(times[kept].astype(np.int64)),
                ],
                ["lang", "source", "ordinal", "times"],
            )
        give_back_memory()

    return run


def recount(texts: DataFrame, vocabulary: DataFrame, scratch: Scratch, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """``lang, source, ordinal, times`` of every kept term that occurs in a source.

    Transducers are sent to all tasks, ``pass_bytes`` of them at most in one pass over the
    texts; a vocabulary beyond that takes further passes. The driver lists transducers,
    one row for each range of terms.
    """
    spark = texts.sparkSession
    sizes = vocabulary.select("lang", "first", F.octet_length("packed").alias("size")).orderBy("lang", "first").collect()
    passes, room = [], 0
    for lang, first, size in sizes:
        if not passes or size > room:
            passes.append([])
            room = pass_bytes
        passes[-1].append((lang, first))
        room -= size
    schema = "lang string, source string, ordinal long, times long"
    parts = []
    for number, some in enumerate(passes):
        wanted = spark.createDataFrame(some, "lang string, first binary")
        rows = vocabulary.join(F.broadcast(wanted), ["lang", "first"]).select("lang", "first", "base", "packed")
        shipped = spark.sparkContext.broadcast([tuple(r) for r in rows.collect()])
        counted = texts.mapInArrow(_recounted(shipped), schema).groupBy("lang", "source", "ordinal").agg(F.sum("times").alias("times"))
        parts.append(scratch.save(counted, f"counts-{number}"))
        shipped.unpersist()
    counts = spark.createDataFrame([], schema) if not parts else parts[0]
    for more in parts[1:]:
        counts = counts.unionByName(more)
    return counts


# -- divergence ------------------------------------------------------------------------


def _share(times: Column, all_: Column, kept: Column) -> Column:
    """1 + floor(10**9 * (times + 2) / (all + 2 * kept)), through decimals: at a hundred
    billion occurrences the product is beyond a long."""
    top = F.lit(1_000_000_000).cast("decimal(10,0)") * (times + 2).cast("decimal(20,0)")
    return 1 + F.call_function("div", top, (all_ + 2 * kept).cast("decimal(20,0)"))


def _difference(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def _pair_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the blocks of a task. Rows come sorted by language and block; a block's
    rows without an ordinal list all sources, with the share of a term that they lack."""
    lang, sources, sums = None, [], np.empty((0, 0), np.int64)

    def told() -> pa.RecordBatch:
        names, n = pa.array(sources, pa.string()), len(sources)
        one, other = np.nonzero(~np.eye(n, dtype=bool))
        columns = [pa.array([lang] * len(one), pa.string()), names.take(pa.array(one)), names.take(pa.array(other)), pa.array((sums + sums.T)[one, other])]
        return pa.RecordBatch.from_arrays(columns, ["lang", "source", "other", "value"])

    for rows in _blocks(batches):
        bare = rows.filter(pa.compute.is_null(rows.column("ordinal")))
        if rows.column("lang")[0].as_py() != lang:
            if lang is not None:
                yield told()
            lang, sources = rows.column("lang")[0].as_py(), bare.column("source").to_pylist()
            sums = np.zeros((len(sources), len(sources)), np.int64)
        shares = np.repeat(bare.column("share").to_numpy()[:, None], bare.column("terms")[0].as_py(), axis=1)
        full = rows.filter(pa.compute.is_valid(rows.column("ordinal")))
        at = pa.compute.index_in(full.column("source"), bare.column("source").combine_chunks()).to_numpy()
        shares[at, full.column("ordinal").to_numpy() - bare.column("begin")[0].as_py()] = full.column("share").to_numpy()
        for i in range(len(sources) - 1):
            gap = shares[i + 1 :] - shares[i]
            sums[i, i + 1 :] += (gap * gap // (shares[i + 1 :] + shares[i])).sum(axis=1)
    if lang is not None:
        yield told()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one language and block each, in the order of their sources."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        lang, _ = _codes(batch.column("lang"))
        block = batch.column("block").to_numpy()
        cuts = np.flatnonzero((lang[1:] != lang[:-1]) | (block[1:] != block[:-1])) + 1
        cuts = [0, *cuts.tolist(), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:]):
            if hi > lo:
                key = batch.column("lang")[lo].as_py(), int(block[lo])
                if held and key != last:
                    yield pa.Table.from_batches(held)
                    held = []
                last = key
                held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held)


def source_divergence(
    df: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    source_col: str = "source",
    least_documents: int = LEAST_DOCUMENTS,
    top: int = TOP_TERMS,
    shard: int = SHARD_TERMS,
    pass_bytes: int = PASS_BYTES,
    block: int = BLOCK_TERMS,
) -> DataFrame:
    """``lang, source, part, item, value, rank``: how far each source of a language is from
    its other sources (``pair``), and which terms it has more of than the language has
    (``term``, the ``top`` ones).

    Terms are runs of ASCII letters and characters beyond ASCII, A-Z in lower case; those
    that ``least_documents`` rows of the language hold are kept. A source's share of a
    term is 1 + floor(10**9 * (times + 2) / (all its occurrences of kept terms + 2 * kept
    terms)); the difference of two shares is floor((p - q)**2 / (p + q)). Ranks start
    from 1, values falling, ties in byte order. NULLs in any of the three columns are
    empty strings; repeated rows are documents each. A source without a kept term has the
    shares of one that never uses any; a language without kept terms has values of 0 and
    no ``term`` rows, one with a single source no ``pair`` rows. An empty table gives an
    empty result. Other columns are not looked at.

    The ``pair`` part has a row for each ordered pair of sources of a language, and a task
    holds a sum for each, so the sources of one language must be few (thousands).
    """
    spark = df.sparkSession
    prepare_workers(spark)
    scratch = Scratch(spark, "divergence")
    texts = df.select(
        text_or_empty(lang_col).alias("lang"), text_or_empty(source_col).alias("source"), text_or_empty(text_col).alias("text")
    )
    held = texts.select("lang", "text").mapInArrow(_document_counts, "lang string, term string, documents long")
    kept = held.groupBy("lang", "term").agg(F.sum("documents").alias("documents"))
    kept = scratch.save(kept.filter(F.col("documents") >= least_documents).select("lang", "term"), "kept")
    vocabulary = build_vocabulary(kept, scratch, shard)
    counts = recount(texts, vocabulary, scratch, pass_bytes)

    zero = F.lit(0).cast("long")
    kept_of = vocabulary.groupBy("lang").agg(F.sum("terms").alias("kept"))
    all_of = counts.groupBy("lang", "source").agg(F.sum("times").alias("all"))
    groups = (
        texts.select("lang", "source").distinct()
        .join(kept_of, "lang", "left").join(all_of, ["lang", "source"], "left")
        .select("lang", "source", F.coalesce("kept", zero).alias("kept"), F.coalesce("all", zero).alias("all"))
    )
    groups = scratch.save(groups, "groups")
    near_groups = small_side(groups, scratch.path("groups"))
    shares = counts.join(near_groups, ["lang", "source"])
    shares = scratch.save(
        shares.select("lang", "source", "ordinal", "times", _share(F.col("times"), F.col("all"), F.col("kept")).alias("share")), "shares"
    )

    pairs = _pairs(groups, shares, block)
    terms = _terms(groups, shares, vocabulary, scratch, top)
    return pairs.unionByName(terms)


def _ranked(rows: DataFrame, tie: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), tie)
    return rows.withColumn("rank", F.row_number().over(order))


def _pairs(groups: DataFrame, shares: DataFrame, block: int) -> DataFrame:
    number = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.lit(0), F.col("kept") - 1).cast("long"), F.lit(block).cast("long")))
    lacking = F.when(F.col("kept") > 0, _share(F.lit(0).cast("long"), F.col("all"), F.col("kept"))).otherwise(0).cast("long")
    bare = groups.select("lang", "source", "kept", lacking.alias("share"), number.alias("begin")).select(
        "lang", F.expr(f"begin div {block}").alias("block"), "source", F.lit(None).cast("long").alias("ordinal"), "share",
        "begin", F.least(F.lit(block), F.col("kept") - F.col("begin")).cast("long").alias("terms"),
    )
    none = F.lit(None).cast("long")
    rows = shares.select(
        "lang", F.expr(f"ordinal div {block}").alias("block"), "source", "ordinal", "share", none.alias("begin"), none.alias("terms")
    ).unionByName(bare)
    sums = (
        rows.repartition("lang", "block").sortWithinPartitions("lang", "block", "source")
        .mapInArrow(_pair_sums, "lang string, source string, other string, value long")
        .groupBy("lang", "source", "other").agg(F.sum("value").alias("value"))
    )
    return _ranked(sums, "other").select("lang", "source", F.lit("pair").alias("part"), F.col("other").alias("item"), "value", "rank")


def _terms(groups: DataFrame, shares: DataFrame, vocabulary: DataFrame, scratch: Scratch, top: int) -> DataFrame:
    langs = scratch.save(groups.groupBy("lang").agg(F.max("kept").alias("kept"), F.sum("all").alias("all")), "langs")
    common = (
        shares.groupBy("lang", "ordinal").agg(F.sum("times").alias("times"))
        .join(small_side(langs, scratch.path("langs")), "lang")
        .select("lang", "ordinal", _share(F.col("times"), F.col("all"), F.col("kept")).alias("usual"))
    )
    more = (
        shares.join(common, ["lang", "ordinal"]).filter(F.col("share") > F.col("usual"))
        .select("lang", "source", "ordinal", _difference(F.col("share"), F.col("usual")).alias("value"))
    )
    best = scratch.save(_ranked(more, "ordinal").filter(F.col("rank") <= top), "best")
    listed = vocabulary.select("lang", "base", "packed").mapInArrow(_listed, "lang string, ordinal long, term string")
    return listed.join(small_side(best, scratch.path("best")), ["lang", "ordinal"]).select(
        "lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank"
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLE = rf"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}') AS t FROM documents),
w AS MATERIALIZED (
  SELECT doc, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM w GROUP BY 1, 2 HAVING count(DISTINCT doc) >= {LEAST_DOCUMENTS}),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY 1),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY ALL),
s AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY 1, 2),
g AS MATERIALIZED (
  SELECT lang, source, coalesce(v.v, 0) AS v, coalesce(s.n, 0)::HUGEINT AS n
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN v USING (lang) LEFT JOIN s USING (lang, source)),
p AS MATERIALIZED (
  SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * g.v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (sum(p.n) + 2)) // (any_value(l.n) + 2 * any_value(l.v)) AS q
  FROM p JOIN (SELECT lang, sum(n) AS n, max(v) AS v FROM g GROUP BY 1) AS l USING (lang) GROUP BY 1, 2),
f AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p AS a JOIN p AS b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g AS a JOIN g AS b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
  FROM p JOIN q USING (lang, term) WHERE p.n > 0 AND p > q),
r AS (
  SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP_TERMS}
"""
