"""Secret scans through a trigram inverted index; DataFrame functions only.

Each rule's regular expression yields a Boolean query over trigrams that any match
must contain. Postings of those trigrams are intersected, and only the documents
that remain are searched for the rule. A rule without mandatory trigrams is
searched for in every document.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from itertools import product
from re import _parser as regex_tree  # the standard library's own parse of a pattern

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import table, text_or_empty, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret. A match counts if `group` of it has at least `least` code points."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0
    base: bool = False


RULES = (
    # The base rules. A run of hex digits or of an access key's characters is matched
    # whole or not at all, so the least length can stand in the pattern; the assigned
    # value's cannot, since a match that is too short still uses up its text.
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", group=2, least=12, base=True),
    Rule("access", r"AKIA[A-Z0-9]{14,}", base=True),
    Rule("hex", r"[0-9a-f]{16,}", base=True),
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("repo_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]*://[^\s/:@]+:[^\s/:@]+@"),
)
#: Sets of exact strings larger than this are given up for the trigrams found so far.
EXACT = 64

#: A Boolean query: any of these sets of trigrams must be present as a whole; None: every text may match.
Query = frozenset[frozenset[str]] | None


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i : i + 3] for i in range(len(s) - 2))


def _both(a: Query, b: Query) -> Query:
    return b if a is None else a if b is None else frozenset(x | y for x, y in product(a, b))


def _needs(exact: set[str]) -> Query:
    """Every match contains one of these strings; a short one says nothing."""
    sets = {_trigrams(s) for s in exact}
    return None if not sets or frozenset() in sets else frozenset(sets)


def _derive(items) -> tuple[set[str] | None, Query]:
    """For a run of parsed items: all strings that it matches, if they are few, and what
    its matches must contain."""
    exact: set[str] | None = {""}
    query: Query = None
    run: set[str] = {""}  # the strings that the latest items match

    def close() -> None:
        nonlocal query, run, exact
        query, run, exact = _both(query, _needs(run)), {""}, None

    for op, arg in items:
        name, some, needs = str(op), None, None
        if name == "LITERAL":
            some = {chr(arg).lower()}
        elif name == "IN" and str(arg[0][0]) != "NEGATE":
            size = sum(hi - lo + 1 for lo, hi in (a if str(o) == "RANGE" else (a, a) if str(o) == "LITERAL" else (0, EXACT) for o, a in arg))
            if size <= 8:
                some = {chr(c).lower() for o, a in arg for c in (range(a[0], a[1] + 1) if str(o) == "RANGE" else (a,))}
        elif name == "SUBPATTERN":
            some, needs = _derive(arg[-1])
        elif name == "BRANCH":
            parts = [_derive(x) for x in arg[1]]
            if all(p[0] is not None for p in parts):
                some = set().union(*(p[0] for p in parts))
            elif all(p[1] is not None for p in parts):
                needs = frozenset().union(*(p[1] for p in parts))
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            inner, inner_needs = _derive(arg[2])
            if arg[:2] == (0, 1) and inner is not None:
                some = inner | {""}
            elif arg[0] == arg[1] and inner is not None and len(inner) == 1:
                some = {next(iter(inner)) * arg[0]}
            elif arg[0]:
                needs = inner_needs if inner is None else _needs(inner)
        if some is not None and len(some) * len(run) <= EXACT:
            run = {a + b for a, b in product(run, some)}
            if exact is not None:
                exact = run
        else:
            close()
            query = _both(query, needs if some is None else _needs(some))
    return exact, _both(query, _needs(run))


def trigram_query(pattern: str) -> Query:
    """The trigrams (lower case) that a match of the pattern must contain."""
    query = _derive(regex_tree.parse(pattern))[1]
    return query and frozenset(q for q in query if not any(p < q for p in query))  # a subset asks for less


def _row_key() -> Column:
    """Equal rows share it; if others do by chance, they are searched in vain, no more."""
    return F.xxhash64("id", "text")


def candidates(rows: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """row, rules: for each row that may match rules with mandatory trigrams, their kinds.

    postings: trigram -> rows. A clause, one set of trigrams, holds for the rows that
    are in the postings of all of them.
    """
    clauses = [(r.kind, i, c) for r in rules for i, c in enumerate(sorted(map(sorted, trigram_query(r.pattern) or ())))]
    wanted = sorted({t for _, _, c in clauses for t in c})
    if not wanted:
        return rows.sparkSession.createDataFrame([], "row long, rules array<string>")
    low = F.lower("text")
    found = F.filter(F.array(*map(F.lit, wanted)), lambda t: F.contains(F.col("low"), t))
    postings = rows.select(_row_key().alias("row"), low.alias("low")).select("row", F.explode(found).alias("trigram"))
    # The rules' side is a constant table: one row for each trigram of a clause.
    terms = rows.sparkSession.createDataFrame([(t, f"{kind}/{i}", len(c)) for kind, i, c in clauses for t in c], "trigram string, clause string, needed int")
    met = postings.join(F.broadcast(terms), "trigram").groupBy("row", "clause", "needed").agg(F.count_distinct("trigram").alias("n")).where("n = needed")
    return met.groupBy("row").agg(F.collect_set(F.substring_index("clause", "/", 1)).alias("rules"))


def _spans(rule: Rule, order: int, text: Column) -> Column:
    """array<struct<start, order, span>> of a rule's matches: the text's pieces between
    them give their places, in code points."""
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    pieces = F.split(text, rule.pattern, -1)
    kept = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else matches
    zipped = F.arrays_zip(F.slice(pieces, F.lit(1), F.size(matches)).alias("gap"), F.transform(matches, lambda m: F.length(m)).alias("size"), F.transform(kept, lambda m: F.length(m) >= rule.least).alias("keep"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,order:int,span:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["gap"])
        end = begin + x["size"]
        one = F.array(F.struct(begin.alias("start"), F.lit(order).alias("order"), F.concat_ws(":", F.lit(rule.kind), begin.cast("string"), end.cast("string")).alias("span")))
        return F.struct(end.alias("at"), F.when(x["keep"], F.concat(acc["out"], one)).otherwise(acc["out"]).alias("out"))

    return F.aggregate(zipped, start, step, lambda acc: acc["out"])


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans: array<struct<start, order, span>> by start, then by the rule's place
    in `rules`; span is kind:start:end, code points, end exclusive. One row per row of docs.

    Null text counts as empty: no spans. Equal rows and null ids each get a row.
    Texts are searched whole. Empty table: empty result. Other columns are not read.
    """
    rows = docs.select(F.col("doc_id").alias("id"), text_or_empty().alias("text"))
    hits = candidates(rows, rules)
    joined = rows.withColumn("row", _row_key()).join(hits, "row", "left")
    nothing = F.array().cast("array<struct<start:int,order:int,span:string>>")
    found = []
    for i, rule in enumerate(rules):
        spans = _spans(rule, i, F.col("text"))
        found.append(spans if trigram_query(rule.pattern) is None else F.when(F.array_contains("rules", rule.kind), spans).otherwise(nothing))
    return joined.select(F.col("id").alias("doc_id"), F.array_sort(F.concat(*found)).alias("spans"))


def _joined(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: s["span"]), ",")


def _of_rule(spans: Column, order: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["order"] == order)).cast("long")


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_secrets(table(spark, sf_dir, "documents"))
    base = [(i, r.kind) for i, r in enumerate(RULES) if r.base]
    counts = [_of_rule(F.col("spans"), i).alias(f"n_{kind}") for i, kind in base]
    own = F.filter("spans", lambda s: s["order"] < len(base))
    return found.select("doc_id", *counts, F.sha2(_joined(own), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"))


def _sql_spans(rule: Rule, order: int) -> str:
    p = rule.pattern.replace("'", "''")
    return f"""
      SELECT doc_id, n, {order} AS ord, '{rule.kind}' AS kind,
             unnest(regexp_extract_all(text, '{p}', 0)) AS m,
             unnest(regexp_extract_all(text, '{p}', {rule.group})) AS g,
             unnest(range(1, len(regexp_extract_all(text, '{p}', 0)) + 1)) AS i,
             unnest(string_split_regex(text, '{p}')[1:len(regexp_extract_all(text, '{p}', 0))]) AS gap
      FROM docs"""


OP9_SQL = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, row_number() OVER () AS n FROM documents),
raw AS ({' UNION ALL '.join(_sql_spans(r, i) for i, r in enumerate(RULES))}),
placed AS (
  SELECT *, sum(length(gap) + length(m)) OVER (PARTITION BY n, ord ORDER BY i) AS stop,
         CASE ord {' '.join(f'WHEN {i} THEN {r.least}' for i, r in enumerate(RULES))} END AS least
  FROM raw),
spans AS (
  SELECT n, ord, stop - length(m) AS start, kind || ':' || (stop - length(m))::BIGINT || ':' || stop::BIGINT AS span
  FROM placed WHERE length(g) >= least)
SELECT d.doc_id, count(*) FILTER (ord = 0) AS n_assign, count(*) FILTER (ord = 1) AS n_access, count(*) FILTER (ord = 2) AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, ord) FILTER (ord < 3), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, ord), '') AS spans
FROM docs d LEFT JOIN spans s ON s.n = d.n GROUP BY d.n, d.doc_id
"""
