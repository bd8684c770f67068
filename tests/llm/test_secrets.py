import hashlib
import re

from gleanery.llm import secrets_scan as m
from tests.llm.fixtures import docs, words

KEY = "AKIA" + "Q" * 14


def brute(text):
    text = text or ""
    out = []
    base = [("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", r"AKIA[A-Z0-9]+", 0, 18), ("hex", r"[0-9a-f]+", 0, 16)]
    for i, (kind, p, group, least) in enumerate(base + [(r.kind, r.pattern, r.group, r.least) for r in m.RULES if not r.base]):
        out += [(x.start(), i, f"{kind}:{x.start()}:{x.end()}") for x in re.finditer(p, text) if len(x[group]) >= least]
    return sorted(out)


CASES = [
    "", None, "nothing here", f"key {KEY} end", "AKIA" + "Q" * 13, "deadbeefdeadbeef", "deadbeefdeadbee", "xdeadbeefdeadbeef0g",
    "password: token: abcdefghijklmnop", "PassWord = 'abcdefghijkl'", 'api_key="AAAABBBBCCCC1"; APIKEY=short; apikey : 0123456789abcdef',
    "é😀 secret=0123456789abcdef0123 é", "token=token=abcdefghijkl", "-----BEGIN RSA PRIVATE KEY-----", "gh" + "p_" + "a1" * 20,
    "https://user:pw@host/x", "x" * 50_000 + f" passwd={'z' * 30} " + "y" * 1000, f"{KEY}{KEY} {KEY}", "eyJhbGciOiJI.eyJzdWIiOiIx.SflKxwRJSM",
]


def test_against_brute_force(spark):
    rows = [(i, t) for i, t in enumerate(CASES)] + [(None, CASES[9]), (3, CASES[3]), (3, CASES[3])] + [(100 + i, words(i, 80)) for i in range(20)]
    got = m.find_secrets(docs(spark, rows, clash=True)).collect()
    want = sorted((str(i), [s for *_, s in brute(t)]) for i, t in rows)
    assert sorted((str(r.doc_id), [s.span for s in r.spans]) for r in got) == want


def test_query_columns(spark, tmp_path):
    from tests.llm.fixtures import save

    rows = [(i, t) for i, t in enumerate(CASES)]
    for r in m.op9(spark, save(docs(spark, rows), tmp_path, "documents")).collect():
        found = brute(CASES[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(i == k for _, i, _ in found) for k in range(3))
        assert r.base_sha256 == hashlib.sha256(",".join(s for _, i, s in found if i < 3).encode()).hexdigest()
        assert r.spans == ",".join(s for *_, s in found)


def test_empty(spark):
    assert m.find_secrets(docs(spark, [])).count() == 0


def test_trigram_queries():
    def grams(s):
        return frozenset(s[i : i + 3] for i in range(len(s) - 2))

    assert m.trigram_query("hex|[0-9]+") is None and m.trigram_query("[a-f]{16,}") is None
    assert m.trigram_query("abcd") == {grams("abcd")}
    assert m.trigram_query("(?i)ABC(D|E)f?") == {grams("abcd"), grams("abce")}
    assert m.trigram_query("abc.*defg") == {grams("abc") | grams("defg")}
    assert m.trigram_query("(abc|xyz)+q") == {grams("abc"), grams("xyz")}
