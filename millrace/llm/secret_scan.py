"""Secrets through a trigram inverted index, in DataFrame functions only.

From each rule's regex a Boolean query over trigrams is derived that every match must
satisfy. The index lists, for each trigram that some rule asks for, the documents that
hold it (letters in lower case). Postings are intersected per branch of a query; only
documents that come through are verified against the rule. A rule without mandatory
trigrams scans every document.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Scratch, column, numbered, small_side, table, text_or_empty

try:  # the parser of the standard library, under its names old and new
    from re import _parser as regex_parser
except ImportError:
    import sre_parse as regex_parser


@dataclass(frozen=True)
class Rule:
    """``pattern`` is matched leftmost, without overlaps; a match counts if its ``group``
    (0: all of it) has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The three base kinds, then kinds with a form of their own.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"""([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=12,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=18),
    Rule("hex", r"[0-9a-f]{16,}", least=16),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
)
RULES = BASE_RULES + MORE_RULES

#: Limits on how many strings an expression may stand for before it counts as anything.
_STRINGS, _CHARACTERS = 64, 8
REPLACEMENT = "[SECRET]"

# -- trigram queries -------------------------------------------------------------------

Branches = frozenset[frozenset[str]]  # any of these sets of trigrams, in full
ANYTHING: Branches = frozenset([frozenset()])


def _all_of(a: Branches, b: Branches) -> Branches:
    return _plain(x | y for x, y in product(a, b))


def _plain(branches) -> Branches:
    """Without branches that ask for more than another one does."""
    branches = set(branches)
    return frozenset(b for b in branches if not any(o < b for o in branches))


def _trigrams(strings: set[str]) -> Branches:
    return _plain(frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings)


def _read(parsed) -> tuple[set[str] | None, Branches]:
    """The strings an expression stands for (None: too many), and its query."""
    done, held, exact = ANYTHING, {""}, True
    for op, arg in parsed:
        strings, query = _read_one(str(op), arg)
        joined = {a + b for a in held for b in strings} if strings is not None else None
        if joined is not None and len(joined) <= _STRINGS:
            held = joined
            continue
        done = _all_of(_all_of(done, _trigrams(held)), query)
        held, exact = (strings or {""}), False
        if strings is None:
            held = {""}
    return (held if exact else None), _all_of(done, _trigrams(held))


def _read_one(op: str, arg) -> tuple[set[str] | None, Branches]:
    if op == "LITERAL":
        return {chr(arg).lower()}, ANYTHING
    if op == "AT":
        return {""}, ANYTHING
    if op == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= _CHARACTERS:
        return {chr(c).lower() for _, c in arg}, ANYTHING
    if op == "SUBPATTERN":
        return _read(arg[3])
    if op == "BRANCH":
        parts = [_read(p) for p in arg[1]]
        if all(strings is not None for strings, _ in parts):
            return set().union(*(strings for strings, _ in parts)), ANYTHING
        return None, _plain(b for _, query in parts for b in query)
    if op == "MAX_REPEAT":
        low, high, part = arg
        strings, query = _read(part)
        if strings is not None and high == 1:
            return strings | {""} if low == 0 else strings, ANYTHING
        if strings is not None and low == high and len(strings) ** low <= _STRINGS:
            return {"".join(s) for s in product(strings, repeat=low)}, ANYTHING
        return None, query if low else ANYTHING
    return None, ANYTHING


def trigram_query(pattern: str) -> Branches:
    """Sets of lower-case trigrams; a text that matches holds all of one set."""
    return _read(regex_parser.parse(pattern))[1]


# -- index -----------------------------------------------------------------------------


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_or_empty(text_col)
    return df.select(column(id_col).alias("id"), F.xxhash64(text).alias("key"), text.alias("text"))


def trigram_index(documents: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings ``trigram, id, key`` of the given trigrams."""
    low = documents.select("id", "key", F.lower("text").alias("low"))
    held = [F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]
    return low.select(F.explode(F.array_compact(F.array(*held))).alias("trigram"), "id", "key")


def candidates(postings: DataFrame, queries: dict[int, Branches]) -> DataFrame:
    """``id, key, rules``: a bit for every rule with a branch whose trigrams all occur."""
    rows = [
        (1 << rule, number, trigram, 1 << bit, (1 << len(branch)) - 1)
        for rule, branches in queries.items()
        for number, branch in enumerate(sorted(map(sorted, branches)))
        for bit, trigram in enumerate(branch)
    ]
    asked = postings.sparkSession.createDataFrame(
        rows, "rule long, branch int, trigram string, bit long, all_bits long"
    )
    # As many rows as the rules have trigrams.
    found = postings.join(F.broadcast(asked), "trigram")
    whole = found.groupBy("id", "key", "rule", "branch").agg(
        F.bit_or("bit").alias("bits"), F.max("all_bits").alias("all_bits")
    )
    return whole.filter("bits = all_bits").groupBy("id", "key").agg(F.bit_or("rule").alias("rules"))


# -- verification ----------------------------------------------------------------------


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Array of (start, order, end, kind), in code points, of the matches that count.

    Gaps and matches alternate from the start of the text, so their lengths add up to
    places; \\G keeps a search that fails from being begun anew at every character.
    """
    pattern = F.lit(rf"\G(?s:(.*?))({rule.pattern})")
    part = lambda n: F.regexp_extract_all(text, pattern, F.lit(n))
    parts = F.arrays_zip(
        part(1).alias("gap"), part(2).alias("hit"), part(2 + rule.group).alias("judged")
    )
    span_type = "array<struct<start:bigint,order:int,end:bigint,kind:string>>"
    state = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast(span_type).alias("spans"))

    def step(held, x):
        start = held["at"] + F.char_length(x["gap"])
        end = start + F.char_length(x["hit"])
        span = F.struct(
            start.alias("start"), F.lit(order).alias("order"), end.alias("end"),
            F.lit(rule.kind).alias("kind"),
        )
        counts = F.char_length(x["judged"]) >= rule.least
        return F.struct(
            end.alias("at"),
            F.when(counts, F.concat(held["spans"], F.array(span))).otherwise(held["spans"]).alias("spans"),
        )

    return F.aggregate(parts, state, step, lambda s: s["spans"])


def with_spans(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``df`` with ``secret_spans`` (array of start, order, end, kind) as a last column,
    which replaces a column of that name.

    A NULL or empty text has no spans. Repeated and NULL ids are scanned row by row. An
    empty table gives an empty result.
    """
    queries = {i: trigram_query(rule.pattern) for i, rule in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if q != ANYTHING}
    spark = df.sparkSession
    scratch = Scratch(spark, "secrets")
    names = [c for c in df.columns if c != "secret_spans"]
    named = numbered(df.select(*[column(c) for c in names]))
    own_id, own_key = "id", "key"
    own_text = f"c{names.index(text_col)}"
    rows = named.withColumns({own_id: column(f"c{names.index(id_col)}"), own_key: F.xxhash64(text_or_empty(own_text))})
    if indexed:
        terms = sorted({t for q in indexed.values() for branch in q for t in branch})
        postings = scratch.save(trigram_index(_documents(df, id_col, text_col), terms), "postings")
        found = scratch.save(candidates(postings, indexed), "candidates")
        scratch.drop("postings")
        found = small_side(found, scratch.path("candidates")).alias("found")
        rows = rows.alias("rows").join(
            found,
            F.col(f"rows.{own_id}").eqNullSafe(F.col("found.id"))
            & (F.col(f"rows.{own_key}") == F.col("found.key")),
            "left",
        )
        hit = F.coalesce(F.col("found.rules"), F.lit(0).cast("long"))
        base = [F.col(f"rows.{c}") for c in named.columns]
    else:
        hit, base = F.lit(0).cast("long"), [column(c) for c in named.columns]
    rows = rows.select(*base, hit.alias("hit"))
    text, none = text_or_empty(own_text), F.array().cast("array<struct<start:bigint,order:int,end:bigint,kind:string>>")
    spans = []
    for i, rule in enumerate(rules):
        if i in indexed:
            verify = F.col("hit").bitwiseAND(F.lit(1 << i).cast("long")) != 0
        else:
            verify = text.rlike(rule.pattern)
        spans.append(F.when(verify, rule_spans(text, rule, i)).otherwise(none))
    own = [F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return rows.select(*own, F.array_sort(F.concat(*spans)).alias("secret_spans"))


def redact(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    rules: tuple[Rule, ...] = RULES,
    replacement: str = REPLACEMENT,
) -> DataFrame:
    """``df`` with every span of ``text_col`` replaced; spans that meet become one.

    Columns of any name, rows (repeated ones and NULL ids too) and texts without secrets,
    NULL ones among them, stay as they are. An empty table gives an empty result.
    """
    own_id, own_text = (f"c{df.columns.index(c)}" for c in (id_col, text_col))
    text, spans = text_or_empty(own_text), F.col("secret_spans")
    state = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

    def step(held, x):
        gap = F.substring(text, (held["at"] + 1).cast("int"), (x["start"] - held["at"]).cast("int"))
        fresh = (x["start"] > held["at"]) | (held["at"] == 0)
        return F.struct(
            F.greatest(held["at"], x["end"]).alias("at"),
            F.when(fresh, F.concat(held["out"], gap, F.lit(replacement))).otherwise(held["out"]).alias("out"),
        )

    rest = lambda s: F.concat(
        s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.lit((1 << 31) - 1))
    )
    clean = F.when(F.size(spans) == 0, F.col(own_text)).otherwise(F.aggregate(spans, state, step, rest))
    found = with_spans(numbered(df), own_id, own_text, rules)
    return found.select(
        *[(clean if c == text_col else F.col(f"c{i}")).alias(c) for i, c in enumerate(df.columns)]
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = with_spans(table(spark, sf_dir, "documents").select("doc_id", "text"))
    spans = F.col("secret_spans")
    said = lambda array: F.concat_ws(
        ",",
        F.transform(array, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))),
    )
    count = lambda kind: F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda s: s["order"] < len(BASE_RULES))
    return found.select(
        "doc_id",
        *[count(rule.kind).alias(f"n_{rule.kind}") for rule in BASE_RULES],
        F.sha2(said(base), 256).alias("base_sha256"),
        said(spans).alias("spans"),
    )


def _sql_spans(order: int, rule: Rule) -> str:
    pattern = f"(?s:(.*?))({rule.pattern})".replace("'", "''")
    part = lambda n: f"unnest(regexp_extract_all(t, '{pattern}', {n}))"
    return f"""SELECT doc_id, '{rule.kind}' AS kind, {order} AS o, e - length(h) AS s, e FROM (
    SELECT *, sum(length(g) + length(h)) OVER (PARTITION BY doc_id ORDER BY i) AS e FROM (
      SELECT doc_id, {part(1)} AS g, {part(2)} AS h, {part(2 + rule.group)} AS j,
             unnest(range(len(regexp_extract_all(t, '{pattern}', 1)))) AS i FROM d))
  WHERE length(j) >= {rule.least}"""


ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({" UNION ALL ".join(_sql_spans(i, r) for i, r in enumerate(RULES))}),
a AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS n_assign,
         count(*) FILTER (kind = 'access') AS n_access, count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) FILTER (o < {len(BASE_RULES)}) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, o) AS spans
  FROM s GROUP BY 1)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
       coalesce(spans, '') AS spans
FROM d LEFT JOIN a USING (doc_id)
"""
