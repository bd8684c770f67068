import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from gleanery.llm import token_counts as m
from tests.llm.fixtures import docs, words

PATH = public_tokenizers.path(m.TOKENIZER)
TEXTS = [
    "", "don't we'll I've 'r 've 'll'd", "<|endoftext|>a<|startoftext|> x<|endoftex", "été ñ", "İstanbul ΑΣ ΣΑΣ", "a\x1cb \x85c d　e", "漢字かな交じり", "😀😀 👍🏽",
    "12345 ²³ Ⅷ", "a" * 700, "über ß!!<|endoftext|>!!", "각 Å é", "q​q ﻿", "हिन्दी", "'''s'S'Ll", words(1, 60), "%%% &&& $$$.",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def counter():
    return m.PrefixCounter(PATH)


def test_totals_match_the_library(library, counter):
    texts = TEXTS + [words(i, 40) for i in range(50)]
    assert counter.counts(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_every_prefix_matches_the_library(library, counter):
    for t in TEXTS:
        t = t[:250]
        want = [len(library.encode(t[:i], add_special_tokens=False)) for i in range(len(t) + 1)]
        assert counter.prefix_counts(t) == want, t
        for budget in (0, 1, 4, 30):
            assert counter.fit(t, budget) == max(i for i, n in enumerate(want) if n <= budget)


def test_pairs_follow_as_merging_says(library, counter):
    r = random.Random(1)
    tokens = [t for t in counter.vocab if not t.endswith(m.END) and len(t) > 1]
    ends = [t for t in counter.vocab if t.endswith(m.END)]
    spec = counter.symbols
    back = {s: b for b, s in spec.items()}
    for _ in range(400):
        a, b = r.choice(tokens), r.choice(ends)
        try:
            text = bytes(back[c] for c in a + b.removesuffix(m.END)).decode()
        except UnicodeDecodeError:
            continue
        got = library.encode(text, add_special_tokens=False).tokens
        if counter.words.findall(counter.normal(text)) == [text]:
            assert counter.follows(a, b) == (got == [a, b]), (a, b)


def test_small_caches_change_nothing(library, monkeypatch):
    monkeypatch.setattr(m, "KEPT_WORDS", 20)
    monkeypatch.setattr(m, "KEPT_PAIRS", 10)
    monkeypatch.setattr(m, "GROUP", 300)
    texts = [words(i % 7, 30 + i) for i in range(40)]
    assert m.PrefixCounter(PATH).counts(texts) == [len(library.encode(t, add_special_tokens=False)) for t in texts]


def test_rows(spark, library):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100, None), (None, "two words"), (3, TEXTS[3]), (101, words(5, 4000))]
    got = m.count_tokens(docs(spark, rows, clash=True)).collect()
    want = []
    for i, t in rows:
        n = len(library.encode(t or "", add_special_tokens=False))
        want.append((i, len((t or "").encode()), n, n > m.LIMIT))
    assert sorted([tuple(r)[:4] for r in got], key=str) == sorted(want, key=str)
    long = next(r for r in got if r.doc_id == 101)
    assert len(library.encode(rows[-1][1][: long.fit_chars], add_special_tokens=False)) <= m.LIMIT < len(library.encode(rows[-1][1][: long.fit_chars + 1], add_special_tokens=False))
    assert m.count_tokens(docs(spark, [])).count() == 0
