"""Conversation structure repair by error-correcting Earley parsing.

The grammar of roles, S -> nothing | P, P -> H u a | P u a, H -> nothing | s, has its
non-terminals leftmost, so every Earley item starts at column 0 and the chart need only keep
its latest column. Error productions let a row be deleted or its role be changed, and a turn
be inserted; an item retains the least (cost, audit) of all ways to it, the audit being the
edits so far, a letter each.

A column depends on the one before by least sums alone, so a stretch of rows is a table from
items to items. Conversations are dealt in ranges of their rows: one that lies within a range is
parsed there, one that is cut by a border is put together from the tables of its pieces. No
conversation is gathered, however many rows it has; what its digest needs in order is streamed.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache
from os.path import commonprefix

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import bounded_broadcast, table, written

GRAMMAR = (("S", ""), ("S", "P"), ("P", "Hua"), ("P", "Pua"), ("H", ""), ("H", "s"))
START, TERMINALS, MADE = "S", "sua", {"u": "user", "a": "assistant"}  # what an edit may make of a turn
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: White space of texts, and what ends a sentence.
SPACES, STOPS = " \t\n\x0b\x0c\r", ".!?"
#: Symbols of rows: the role's initial (another one: o), a capital if it is truncated; x must go.
FORCED = "x"
#: Texts of a conversation that are held until its parse is known; a longer one is streamed twice.
HELD_CHARS = 4 << 20
#: Rows of ids or repeated turns up to which they are broadcast (under 100 bytes a row).
SMALL = 100_000

Item = tuple[int, int]  # production and dot; the origin is column 0
Column_ = dict[Item, tuple[int, str]]


def _next(item: Item) -> str:
    """The symbol after the dot; '' at the end."""
    return GRAMMAR[item[0]][1][item[1] : item[1] + 1]


def _settle(items: list[Item]) -> tuple[Item, ...]:
    """Predictor and completer: the items that wait for a row (or have completed the start
    symbol) once these have been reached."""
    seen, todo, waiting = set(), list(items), []
    while todo:
        item = todo.pop()
        if item in seen:
            continue
        seen.add(item)
        symbol = _next(item)
        if symbol in TERMINALS and symbol or not symbol and GRAMMAR[item[0]][0] == START:
            waiting.append(item)
        if not symbol:  # complete: whatever waits in column 0 for its non-terminal moves on
            todo += [(p, 1) for p, (_, body) in enumerate(GRAMMAR) if body[:1] == GRAMMAR[item[0]][0]]
        elif symbol not in TERMINALS and item[1] == 0:
            todo += [(p, 0) for p, (head, _) in enumerate(GRAMMAR) if head == symbol]
    return tuple(sorted(waiting))


@lru_cache(None)
def _advanced(item: Item) -> tuple[Item, ...]:
    return _settle([(item[0], item[1] + 1)])


def _closed(column: Column_) -> Column_:
    """With all insertions, the cheapest first."""
    heap = [(*v, k) for k, v in column.items()]
    heapq.heapify(heap)
    out: Column_ = {}
    while heap:
        cost, audit, item = heapq.heappop(heap)
        if item in out:
            continue
        out[item] = cost, audit
        if _next(item) in MADE:
            for to in _advanced(item):
                if to not in out:
                    heapq.heappush(heap, (cost + INSERT, f"{audit}I", to))
    return out


def start() -> Column_:
    return _closed(dict.fromkeys(_settle([(p, 0) for p, (head, _) in enumerate(GRAMMAR) if head == START]), (0, "")))


def scan(column: Column_, symbol: str, times: int = 1) -> Column_:
    """The column after a row of this symbol, or after so many that must go."""
    gone = "D" * times
    found = {item: (cost + DELETE * times, audit + gone) for item, (cost, audit) in column.items()}
    if symbol != FORCED:
        initial, more = symbol.lower(), TRUNCATED * symbol.isupper()
        for item, (cost, audit) in column.items():
            wants = _next(item)
            if wants == initial:
                value = cost + more, f"{audit}K"
            elif wants in MADE:
                value = cost + REROLE + more, f"{audit}R"
            else:
                continue
            for to in _advanced(item):
                if to not in found or value < found[to]:
                    found[to] = value
    return _closed(found)


def run(column: Column_, symbols: str) -> Column_:
    """The column after these rows. What all audits begin with is set aside now and then, so
    that steps do not copy it."""
    done: list[str] = []
    for n, part in enumerate(re.findall(f"{FORCED}+|.", symbols)):
        column = scan(column, part[0], len(part))
        if n % 256 == 255 and (same := commonprefix([a for _, a in column.values()])):
            done.append(same)
            column = {k: (c, a[len(same) :]) for k, (c, a) in column.items()}
    prefix = "".join(done)
    return {k: (c, prefix + a) for k, (c, a) in column.items()}


def accepted(column: Column_) -> tuple[int, str]:
    """The least (cost, audit) of a completed chart."""
    return min(v for k, v in column.items() if not _next(k))


@lru_cache(1 << 16)
def _known(symbols: str) -> tuple[int, str]:
    return accepted(run(start(), symbols))


def parsed(symbols: str) -> tuple[int, str]:
    """The cheapest edits of a conversation; short ones repeat, and are remembered."""
    return _known(symbols) if len(symbols) <= 64 else accepted(run(start(), symbols))


def transfer(symbols: str) -> dict[Item, Column_]:
    """What each item that can wait before these rows comes to after them."""
    return {item: run({item: (0, "")}, symbols) for item in start_items()}


@lru_cache(None)
def start_items() -> tuple[Item, ...]:
    return tuple(sorted({to for p, (_, body) in enumerate(GRAMMAR) for d in range(len(body) + 1) for to in _settle([(p, d)])}))


def through(column: Column_, table_: dict[Item, Column_]) -> Column_:
    """The column after a stretch of rows, of the column before it and the stretch's table."""
    out: Column_ = {}
    for item, (cost, audit) in column.items():
        for to, (c, a) in table_.get(item, {}).items():
            if to not in out or (cost + c, audit + a) < out[to]:
                out[to] = cost + c, audit + a
    return out


class Repaired:
    """SHA-256 of the repaired turns, `role:text` joined by newlines, as rows come in order."""

    def __init__(self, audit: str):
        self.audit, self.at, self.n, self.lead = audit, 0, 0, 0
        self.sha = hashlib.sha256()

    def _put(self, role: str, text: str) -> None:
        self.sha.update(f"{chr(10) if self.n else ''}{role}:{text}".encode(errors="surrogatepass"))
        self.n += 1

    def _due(self) -> str:
        return MADE["ua"[(self.n - self.lead) % 2]]

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self._put(self._due(), "")
            self.at += 1

    def row(self, role: str, text: str, times: int) -> None:
        for _ in range(times):
            self._inserted()
            edit = self.audit[self.at]
            self.at += 1
            if edit == "K":
                self.lead += not self.n and role[:1] == "s"
                self._put(role, text)
            elif edit == "R":
                self._put(self._due(), text)

    def hex(self) -> str:
        self._inserted()
        return self.sha.hexdigest()


def damaged(rows: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, n: each row after its damage and how often it stands there,
    adjacently; 0, with the other columns empty, if it was dropped."""
    blank = lambda c: F.coalesce(c, F.lit(" "))
    key = F.concat_ws(":", blank(F.col("conv_id").cast("string")), blank(F.col("turn").cast("string")))
    code = F.col("code")
    found = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), blank(F.col("role")).alias("role"), blank(F.col("text")).alias("text"), (F.crc32(key) % 20).alias("code"))
    text = F.when(code == 1, "").when(code == 2, F.translate("text", STOPS, "")).otherwise(F.col("text"))
    here = lambda c: F.when(code != 0, c)
    return found.select("conv_id", here(F.col("turn")).alias("turn"), F.coalesce(here(F.when(code == 4, "user").otherwise(F.col("role"))), F.lit("")).alias("role"), F.coalesce(here(text), F.lit("")).alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("n"))


def _digest() -> Column:
    return F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")))


def _rows(rows: DataFrame) -> DataFrame:
    """conv_id, turn, head (of the role), digest, role, text, n, flag: equal rows as one, n times; flag b for
    blank ones, d if the same was said on an earlier turn, t for truncated ones."""
    own = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("n").alias("n"))
    # Turns that repeat on another turn are few as a rule; only they have to be known elsewhere.
    said = rows.where("n > 0").select("conv_id", "turn", _digest().alias("digest")).groupBy("conv_id", "digest")
    said = said.agg(F.min("turn").alias("lo"), F.max("turn").alias("hi"), F.count_if(F.col("turn").isNull()).alias("nulls"))
    again = said.where("lo <> hi OR (nulls > 0 AND lo IS NOT NULL)").select(F.col("conv_id").alias("of"), F.col("digest").alias("same"), F.when(F.col("nulls") == 0, F.col("lo")).alias("first"))
    again = bounded_broadcast(written(again, "repeated-turns"), SMALL)
    own = own.withColumn("digest", _digest())
    met = own.join(again, own.conv_id.eqNullSafe(again.of) & (own.digest == again.same), "left")
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    flag = F.when(bare == "", "b").when(F.col("same").isNotNull() & ~F.col("turn").eqNullSafe(F.col("first")), "d").when(~F.right(bare, F.lit(1)).isin(*STOPS), "t").otherwise("")
    return met.select("conv_id", "turn", F.substring("role", 1, 16).alias("head"), "digest", "role", "text", "n", flag.alias("flag"))


ORDER = ("conv_id", "turn", "head", "digest")
PIECE = (
    "part int, n_rows long, n_turns long, lo long, hi long, first string, last string, blank long, duplicate long, truncated long, illegal long, cost long, audit string, sha string, "
    "tables array<struct<a:string,b:string,cost:long,audit:string>>"
)
LEGAL = ("su", "ua", "au")


class _Piece:
    """What a stretch of one conversation's rows says."""

    def __init__(self):
        self.symbols: list[str] = []
        self.held: list[tuple[str, str, int]] | None = []
        self.chars = self.rows = self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.lo = self.hi = self.first = self.last = None

    def add(self, turn, role: str, text: str, n: int, flag: str) -> None:
        if not n:
            return
        initial = role[:1]
        if turn is not None and turn != self.hi:
            self.turns += 1
            self.hi = turn
            self.lo = turn if self.lo is None else self.lo
        if self.last is None:
            self.first = initial
        else:
            self.illegal += self.last + initial not in LEGAL
        self.illegal += n - 1  # a role after itself
        self.last = initial
        self.rows += n
        if flag == "b":
            self.blank += n
        elif flag == "d":
            self.duplicate += n
        else:
            self.duplicate += n - 1
            self.truncated += flag == "t"
        kept = "" if flag in ("b", "d") else (initial if initial in TERMINALS and initial else "o")
        self.symbols.append((kept.upper() if flag == "t" else kept) + FORCED * (n - len(kept)))
        if self.held is not None:
            self.chars += len(role) + len(text)
            self.held.append((role, text, n))
            if self.chars > HELD_CHARS:
                self.held = None

    def told(self, conv, part: int, at_border: bool) -> tuple:
        symbols = "".join(self.symbols)
        cost = audit = sha = tables = None
        if self.held is not None:
            cost, audit = parsed(symbols)
            r = Repaired(audit)
            for row in self.held:
                r.row(*row)
            sha = r.hex()
        if at_border or sha is None:
            tables = [{"a": f"{a[0]}.{a[1]}", "b": f"{b[0]}.{b[1]}", "cost": c, "audit": w} for a, to in transfer(symbols).items() for b, (c, w) in to.items()]
        return conv, part, self.rows, self.turns, self.lo, self.hi, self.first, self.last, self.blank, self.duplicate, self.truncated, self.illegal, cost, audit, sha, tables


def _value(x):
    return None if x is None or x != x else x


def _ints(*names: str) -> dict[str, str]:
    return dict.fromkeys(names, "Int64")


def _pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    part, conv, piece, first = TaskContext.get().partitionId(), None, None, True
    names = ["conv_id", *(x.split()[0] for x in PIECE.split(", "))]
    frame = lambda out: pd.DataFrame(out, columns=names).astype(_ints("lo", "hi", "cost"))
    for b in batches:
        out = []
        for c, turn, role, text, n, flag in zip(b.conv_id.tolist(), b.turn.tolist(), b.role, b.text, b.n.tolist(), b.flag):
            c = _value(c)
            if piece is None or c != conv:
                if piece is not None:
                    out.append(piece.told(conv, part, first))
                    first = False
                conv, piece = c, _Piece()
            piece.add(_value(turn), role, text, n, flag)
        if out:
            yield frame(out)
    if piece is not None:
        yield frame([piece.told(conv, part, True)])


def _folded(pieces: pd.DataFrame) -> pd.DataFrame:
    """One conversation of its pieces."""
    item = lambda s: tuple(map(int, s.split(".")))
    rows = [r for r in pieces.sort_values("part").to_dict("records")]
    column, last, hi, turns, illegal = start(), None, None, 0, 0
    for r in rows:
        tables: dict[Item, Column_] = {}
        for x in r["tables"]:
            tables.setdefault(item(x["a"]), {})[item(x["b"])] = (int(x["cost"]), x["audit"])
        column = through(column, tables)
        turns += int(r["n_turns"]) - (hi is not None and _value(r["lo"]) == hi)
        hi = hi if _value(r["hi"]) is None else r["hi"]
        illegal += int(r["illegal"])
        if r["first"] is not None:
            illegal += last is not None and last + r["first"] not in LEGAL
            last = r["last"]
    cost, audit = accepted(column)
    out = pieces.head(1)[["conv_id"]].reset_index(drop=True)
    out["n_turns"], out["lo"], out["hi"] = turns, pieces.lo.min(), pieces.hi.max()
    for c in ("blank", "duplicate", "truncated"):
        out[c] = int(pieces[c].sum())
    out["illegal"], out["cost"], out["audit"] = int(illegal), cost, audit
    return out.astype(_ints("lo", "hi"))


def _hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows by conversation, its audit ahead of them, to the digest of each."""
    conv, r = None, None
    for b in batches:
        out = []
        for c, ahead, role, text, n in zip(b.conv_id.tolist(), b.ahead.tolist(), b.role, b.text, b.n.tolist()):
            if ahead:
                if r is not None:
                    out.append((conv, r.hex()))
                conv, r = _value(c), Repaired(text)
            else:
                r.row(role, text, n)
        if out:
            yield pd.DataFrame(out, columns=["conv_id", "sha"])
    if r is not None:
        yield pd.DataFrame([(conv, r.hex())], columns=["conv_id", "sha"])


def repair(conversations: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256: one row per conv_id
    of damaged rows (conv_id, turn, role, text, n; see `damaged`), also of those that have none left.

    Rows come by turn, those without one first; of one turn by the role's first 16 code points, then by a digest of role
    and text, so that ties are settled alike in every run. Rows without conv_id are one conversation, whose
    conv_id is null. Equal rows of one turn are repeats of the first. Empty texts are blank; an empty role
    is none of the grammar's. Empty table: empty result. Other columns are not read.
    """
    rows = _rows(conversations)
    kind = conversations.schema["conv_id"].dataType.simpleString()
    dealt = rows.repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
    pieces = written(dealt.mapInPandas(_pieces, f"conv_id {kind}, {PIECE}"), "conversation-pieces")
    plain = ("conv_id", "n_turns", "lo", "hi", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha")
    # Only the first and last conversation of a range can have been cut, or one with very long texts.
    border = pieces.where("tables IS NOT NULL")
    cut = border.groupBy("conv_id").agg(F.count("*").alias("k"), F.count_if(F.col("sha").isNull()).alias("unhashed")).where("k > 1 OR unhashed > 0")
    long = written(cut.select(F.col("conv_id").alias("id")), "cut-conversations")
    whole = pieces.select(*plain)
    if not long.isEmpty():
        known = bounded_broadcast(long, SMALL)
        of = lambda d: d.join(known, d.conv_id.eqNullSafe(known.id), "left_semi")
        whole = whole.join(known, whole.conv_id.eqNullSafe(known.id), "left_anti")
        shape = f"conv_id {kind}, n_turns long, lo long, hi long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
        folded = written(of(border).groupBy("conv_id").applyInPandas(_folded, shape), "cut-conversations-parsed")
        none = F.lit(None)
        ahead = folded.select("conv_id", F.lit(True).alias("ahead"), none.cast("long").alias("turn"), F.lit("").alias("head"), F.lit("").alias("digest"), F.lit("").alias("role"), F.col("audit").alias("text"), F.lit(0).cast("long").alias("n"))
        own = _rows(of(conversations)).where("n > 0").select("conv_id", F.lit(False).alias("ahead"), "turn", "head", "digest", "role", "text", "n")
        stream = ahead.unionByName(own).repartition("conv_id").sortWithinPartitions("conv_id", F.desc("ahead"), "turn", "head", "digest")
        hashes = stream.mapInPandas(_hashed, f"conv_id {kind}, sha string").withColumnRenamed("conv_id", "id")
        whole = whole.unionByName(folded.join(hashes, folded.conv_id.eqNullSafe(hashes.id)).select(*plain))
    gaps = F.coalesce(F.col("hi") - F.col("lo") + 1 - F.col("n_turns"), F.lit(0)).cast("long")
    return whole.select("conv_id", gaps.alias("gaps"), "blank", "duplicate", "truncated", "illegal", "cost", "audit", F.col("sha").alias("repaired_sha256"))


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


#: CRC-32 of an ASCII string, a byte at a time and a bit at a time.
CRC32_SQL = "xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({0}, ''), lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda a, i: xor(a >> 1, (a & 1) * 3988292384))), 4294967295)"


def _plus(value: str, cost: str, edit: str) -> str:
    """A cost and audit in one string, eight digits and then letters, with one more edit."""
    return f"(printf('%08d', substr({value}, 1, 8)::INT + {cost}) || substr({value}, 9) || '{edit}')"


#: The same by states in place of items: 1 nothing yet, 2 after s, 3 after u, 4 after a.
OP13_SQL = f"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         {CRC32_SQL.format("coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')")} % 20 AS code FROM conversations),
hurt AS (
  SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
         CASE code WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
         unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM src WHERE code <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, substr(role, 1, 16), md5(length(role) || ':' || role || text), copy) AS i,
         regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare FROM hurt),
flagged AS (
  SELECT *, left(role, 1) AS ini, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
         CASE WHEN bare = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS flag
  FROM placed),
convs AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (flag = 'b') AS blank,
         count(*) FILTER (flag = 'd') AS duplicate, count(*) FILTER (flag = 't') AS truncated,
         count(*) FILTER (i > 1 AND before || ini NOT IN ('su', 'ua', 'au')) AS illegal, list([ini, flag, NULL, NULL] ORDER BY i) AS symbols
  FROM flagged GROUP BY conv_id),
ends AS (
  SELECT *, list_reduce(list_concat([['00000000', NULL, '00000003I', '00000006II']], symbols), lambda v, r:
    list_transform([[
      {_plus('v[1]', '4', 'D')},
      least({_plus('v[2]', '4', 'D')}, CASE WHEN r[2] NOT IN ('b', 'd') AND r[1] = 's' THEN {_plus('v[1]', "CASE r[2] WHEN 't' THEN 3 ELSE 0 END", 'K')} END),
      least({_plus('v[3]', '4', 'D')}, CASE WHEN r[2] IN ('b', 'd') THEN NULL WHEN r[1] = 'u' THEN {_plus('least(v[1], v[2], v[4])', "CASE r[2] WHEN 't' THEN 3 ELSE 0 END", 'K')} ELSE {_plus('least(v[1], v[2], v[4])', "CASE r[2] WHEN 't' THEN 6 ELSE 3 END", 'R')} END),
      least({_plus('v[4]', '4', 'D')}, CASE WHEN r[2] IN ('b', 'd') THEN NULL WHEN r[1] = 'a' THEN {_plus('v[3]', "CASE r[2] WHEN 't' THEN 3 ELSE 0 END", 'K')} ELSE {_plus('v[3]', "CASE r[2] WHEN 't' THEN 6 ELSE 3 END", 'R')} END)]],
    lambda w: list_transform([least(w[3], {_plus('least(w[1], w[2], w[4])', '3', 'I')})], lambda u: [w[1], w[2], u, least(w[4], {_plus('u', '3', 'I')})])[1])[1]) AS v FROM convs),
best AS (SELECT *, substr(least(v[1], v[4]), 1, 8)::BIGINT AS cost, substr(least(v[1], v[4]), 9) AS audit FROM ends),
edits AS (SELECT conv_id, unnest(string_split(audit, '')) AS e, unnest(range(1, length(audit) + 1)) AS n FROM best WHERE audit <> ''),
counted AS (SELECT *, count(*) FILTER (e <> 'I') OVER w AS i, count(*) FILTER (e <> 'D') OVER w AS o FROM edits WINDOW w AS (PARTITION BY conv_id ORDER BY n)),
made AS (
  SELECT c.conv_id, o, e, f.role, f.text, max(CASE WHEN o = 1 AND e = 'K' AND f.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c.conv_id) AS lead
  FROM counted c LEFT JOIN flagged f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.i = c.i AND c.e <> 'I' WHERE e <> 'D'),
texts AS (
  SELECT conv_id, string_agg(CASE e WHEN 'K' THEN role ELSE CASE (o - 1 - lead) % 2 WHEN 0 THEN 'user' ELSE 'assistant' END END || ':' || CASE e WHEN 'I' THEN '' ELSE text END, chr(10) ORDER BY o) AS t
  FROM made GROUP BY conv_id)
SELECT a.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
       coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) a LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM a.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM a.conv_id
"""
