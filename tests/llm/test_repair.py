import hashlib
import heapq
import random
import re
import zlib

import duckdb

from gleanery.llm import repair as m
from tests.llm.fixtures import save, words

SHAPE = "conv_id long, turn long, role string, text string"
PREFIX = re.compile(r"(s?(ua)*u?)?\Z")
WHOLE = re.compile(r"(s?(ua)+)?\Z")


def cheapest(rows):
    """(cost, audit) of rows (initial, flag) by trying edits in order of cost, then letters."""
    heap = [(0, "", 0, "")]
    while heap:
        cost, audit, i, out = heapq.heappop(heap)
        if i == len(rows) and WHOLE.match(out):
            return cost, audit
        moves = [(3, "I", i, c) for c in "ua"]
        if i < len(rows):
            initial, flag = rows[i]
            moves.append((4, "D", i + 1, ""))
            if flag not in ("b", "d"):
                more = 3 * (flag == "t")
                moves += [(more, "K", i + 1, initial or "-")] + [(3 + more, "R", i + 1, c) for c in "ua"]
        for c, e, j, made in moves:
            if PREFIX.match(out + made):
                heapq.heappush(heap, (cost + c, audit + e, j, out + made))
    raise AssertionError


def brute(rows):
    """The query's rows; ties of a turn as repair() settles them."""
    hurt = {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = hurt.setdefault(conv, [])
        if code:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
            own += [(turn, "user" if code == 4 else role, text)] * (2 if code == 3 else 1)
    out = []
    for conv, own in hurt.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1][:16], hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
        seen, flags = set(), []
        for _, role, text in own:
            bare = text.rstrip(" \t\n\x0b\x0c\r")
            flags.append("b" if not bare else "d" if (role, text) in seen else "" if bare[-1] in ".!?" else "t")
            seen.add((role, text))
        turns = {t for t, _, _ in own if t is not None}
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = cheapest([(r[:1], f) for (_, r, _), f in zip(own, flags)])
        made, left, lead = [], iter(own), 0
        for e in audit:
            row = next(left) if e != "I" else None
            if e == "D":
                continue
            lead += e == "K" and not made and row[1][:1] == "s"
            due = ("user", "assistant")[(len(made) - lead) % 2]
            made.append(f"{row[1] if e == 'K' else due}:{row[2] if row else ''}")
        sha = hashlib.sha256("\n".join(made).encode()).hexdigest()
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, flags.count("b"), flags.count("d"), flags.count("t"), illegal, cost, audit, sha))
    return sorted(out, key=str)


def conversations(n, seed=1):
    r = random.Random(seed)
    say = lambda: r.choice(("", " \t", "yes.", "yes.", "no", "well! ", "é😀?\n", words(r.randrange(99), 3) + "."))
    rows = []
    for c in range(n):
        rows += [(c, t if r.random() < 0.9 else r.choice((None, 0, 9)), r.choice(("user", "assistant", "user", "assistant", "system", "tool", "", None)), None if r.random() < 0.05 else say()) for t in range(r.randrange(1, 6))]
    rows += [(None, 0, "user", "hi."), (None, None, "assistant", "yes."), *[(1000, 1, "user", "again.")] * 4, (1001, 3, None, None), (1002, -5, "ugly", "x"), (1002, 7, "s", "x.")]
    r.shuffle(rows)
    return rows


def frame(spark, rows, clash=True):
    if not clash:
        return spark.createDataFrame(rows, SHAPE)
    return spark.createDataFrame([(*r, 1, "x", "y") for r in rows], f"{SHAPE}, n long, digest string, code string")


def run(spark, folder, rows):
    return sorted((tuple(r) for r in m.op13(spark, save(frame(spark, rows), folder, "conversations")).collect()), key=str)


def test_against_brute_force(spark, tmp_path):
    rows = conversations(150)
    assert run(spark, tmp_path, rows) == brute(rows)


def test_cut_conversations(spark, tmp_path):
    """Ranges of few rows cut conversations; very long texts are hashed apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        r = random.Random(5)
        long = [(7, t, r.choice(("user", "assistant", "system")), f"{words(t, 3)}{r.choice(('.', ''))}") for t in range(900)]
        few = [(3, t, "user" if t % 2 else "assistant", f"{t}.") for t in range(4)] + [(9, 0, "user", "x" * (m.HELD_CHARS + 9) + ".")]
        same = [(8, 2, "user", "so.")] * 300
        assert zlib.crc32(b"8:2") % 20 == 3  # each row is repeated
        got = run(spark, tmp_path, long + few + same)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = {x[0]: x for x in brute(few)}
    assert {x[0]: x for x in got if x[0] in want} == want
    by = {x[0]: x for x in got}
    assert by[8][1:8] == (0, 0, 599, 0, 599, 599 * 4 + 3, "K" + "D" * 599 + "I")
    # The long one against the same grammar row by row, without pieces.
    hurt = [(c, t, role, text) for c, t, role, text in long]
    whole = cheap_states(hurt)
    assert (by[7][6], by[7][7]) == whole


def cheap_states(rows):
    """As cheapest(), over the language's four states, for many rows."""
    seen, best = set(), {0: (0, "")}

    def inserted(b):
        for _ in range(3):
            for s, to in ((0, "u"), (1, "u"), (3, "u"), (2, "a")):
                if s in b:
                    t, v = {"u": 2, "a": 3}[to], (b[s][0] + 3, b[s][1] + "I")
                    b[t] = min(b.get(t, v), v)
        return b

    best = inserted(best)
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{conv}:{turn}".encode()) % 20
        if not code:
            continue
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        role = "user" if code == 4 else role
        for _ in range(2 if code == 3 else 1):
            flag = "b" if not text.strip() else "d" if (role, text) in seen else "" if text[-1] in ".!?" else "t"
            seen.add((role, text))
            new = {s: (c + 4, a + "D") for s, (c, a) in best.items()}
            if flag not in ("b", "d"):
                more = 3 * (flag == "t")
                for s, (c, a) in best.items():
                    for x, t in {0: (("s", 1), ("u", 2)), 1: (("u", 2),), 2: (("a", 3),), 3: (("u", 2),)}[s]:
                        v = (c + more, a + "K") if role[0] == x else (c + 3 + more, a + "R") if x != "s" else None
                        if v:
                            new[t] = min(new.get(t, v), v)
            best = inserted(new)
    return min(best[0], best[3])


def test_tables_of_stretches():
    r = random.Random(2)
    for _ in range(60):
        z = "".join(r.choice("suaoSUAOx") for _ in range(r.randrange(0, 12)))
        k = r.randrange(len(z) + 1)
        column = m.start()
        for part in (z[:k], z[k:]):
            column = m.through(column, m.transfer(part))
        flags = [(c.lower() if c in "suaSUA" else "o", "b" if c == "x" else "t" if c.isupper() else "") for c in z]
        assert m.accepted(column) == m.parsed(z) == cheapest(flags), z


def test_sql(spark, tmp_path):
    rows = conversations(120, seed=9)
    frame(spark, rows).coalesce(1).write.parquet(f"{tmp_path}/c")
    db = duckdb.connect()
    db.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/c/*.parquet'")
    assert sorted(db.execute(m.OP13_SQL).fetchall(), key=str) == brute(rows)


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, []) == []
