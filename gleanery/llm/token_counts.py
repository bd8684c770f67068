"""Exact token counts of every prefix of a text, by dynamic programming over BPE.

A sequence of tokens is the BPE encoding of its text exactly if each neighbouring
pair is the encoding of the pair's own text. So of all tokens that end at a
position just one follows the last token of what stands before it, and one pass
over a word finds the last token, and with it the count, of each of its prefixes.
Words repeat; their prefix tables are kept. The count of any prefix of a document
is then a sum of table entries, with nothing encoded again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator, Sequence
from functools import cache

import pandas as pd
import public_tokenizers
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanery.llm.common import table, text_or_empty

TOKENIZER = "word_bpe_49k.json"
LIMIT = 2048
#: Words and pairs of tokens whose counts a worker keeps, twice as many at most.
KEPT_WORDS, KEPT_PAIRS = 800_000, 500_000
#: Code points of texts whose new words are learned together.
GROUP = 4_000_000
SPACE = "\t-\r \x85\xa0  -     　"
END = "</w>"
#: What str.split() takes for white space and the tokenizer does not.
ODD_SPACE = re.compile("[\x1c-\x1f]")


def byte_symbols() -> dict[int, str]:
    """Byte-level BPE's rule: printable Latin-1 bytes stand for themselves, the others
    for the code points from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(others)}


class PrefixCounter:
    """Prefix counts for a word-end BPE tokenizer file (byte-level, lower case)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        assert model["end_of_word_suffix"] == END, "a BPE with word ends is needed"
        self.ranks = {tuple(m if isinstance(m, list) else m.split(" ")): i for i, m in enumerate(model["merges"])}
        self.symbols = byte_symbols()
        #: token: rank and parts of the merge that makes it
        self.made: dict[str, tuple[int, str, str]] = {}
        for (a, b), i in self.ranks.items():
            self.made.setdefault(a + b, (i, a, b))
        #: tokens that are the encoding of their own text; others never occur
        self.vocab: set[str] = {s + e for s in self.symbols.values() for e in ("", END)}
        self.pairs: dict[tuple[str, str], bool] = {}
        for t, (_, a, b) in self.made.items():
            if a in self.vocab and b in self.vocab and self._reached(a, b):
                self.vocab.add(t)
        self.pairs.clear()
        self.longest = max(len(t.removesuffix(END)) for t in self.vocab)
        split = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split.replace(r"\s", SPACE))
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = regex.compile("|".join(map(regex.escape, special))) if special else None
        self.contractions = {p for p in split.split("|") if regex.fullmatch("'[a-z]{2}", p)}
        #: the greatest length of a token that ends in these two symbols
        self.reach: dict[str, int] = {}
        for t in self.vocab:
            if len(t) > 1 and not t.endswith(END):
                self.reach[t[-2:]] = max(self.reach.get(t[-2:], 2), len(t))
        #: counts of words and chunks, and those of the generation before
        self.totals: dict[str, int] = {}
        self.older: dict[str, int] = {}
        self.at: tuple[str, list[str], list[int]] = ("", [""], [0])

    def _reached(self, a: str, b: str) -> bool:
        """Whether a, b is the encoding of their text but for the merge of the two."""
        rank = self.ranks.pop((a, b))
        try:
            return self._follows(a, b)
        finally:
            self.ranks[a, b] = rank

    def follows(self, a: str, b: str) -> bool:
        """Whether the encoding of a's and b's text is a, b.

        Merges happen in the order of their ranks. Undo those of both tokens, the
        latest first: at no time may the two tokens that meet at the boundary have a
        merge that comes before the ones that took each of them up (of equal merges
        the left one comes first).
        """
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[a, b] = self._follows(a, b)
        return known

    def _follows(self, a: str, b: str) -> bool:
        never = len(self.ranks)
        taken_a = taken_b = never
        made, nothing = self.made, (-1, "", "")
        while True:
            rank = self.ranks.get((a, b), never)
            if rank < taken_a and (rank <= taken_b) and rank < never:
                return False
            of_a, of_b = made.get(a, nothing), made.get(b, nothing)
            if of_a[0] < 0 and of_b[0] < 0:
                return True
            if of_a[0] > of_b[0]:
                taken_a, a = of_a[0], of_a[2]
            else:
                taken_b, b = of_b[0], of_b[1]

    def _extend(self, word: str) -> tuple[str, list[str], list[int]]:
        """The word's symbols and, for each prefix of them that goes on, the last token
        and the count of its encoding. What the word before began with alike is kept, so
        words in sorted order cost little more than what is new in each."""
        if word.isascii() and word.isprintable():
            chars = word  # these bytes are their own symbols
        else:
            chars = "".join([self.symbols[b] for b in word.encode("utf-8", "surrogatepass")])
        before, last, inner = self.at
        same, top = 0, min(len(before), len(chars)) - 1
        while same < top and before[same] == chars[same]:
            same += 1
        del last[same + 1 :], inner[same + 1 :]
        vocab, pairs, reach = self.vocab, self.pairs, self.reach
        for end in range(len(last), len(chars)):
            for start in range(max(0, end - reach.get(chars[max(0, end - 2) : end], 2)), end):
                token = chars[start:end]
                if token in vocab:
                    if not start:
                        break
                    ok = pairs.get((last[start], token))
                    if ok or (ok is None and self.follows(last[start], token)):
                        break
            else:
                raise ValueError(f"no token ends at {end} of {word!r}")
            inner.append(inner[start] + 1)
            last.append(token)
        self.at = chars, last, inner
        return self.at

    def _ended(self, chars: str, last: list[str], inner: list[int], end: int) -> int:
        """The count of chars[:end] as a whole word."""
        for start in range(max(0, end - self.longest), end):
            token = chars[start:end] + END
            if token in self.vocab and (not start or self.follows(last[start], token)):
                return inner[start] + 1
        raise ValueError(f"no token ends {chars[:end]!r}")

    def word_count(self, word: str) -> int:
        chars, last, inner = self._extend(word)
        return self._ended(chars, last, inner, len(chars))

    def word_table(self, word: str) -> list[int]:
        """Token counts of word[:1], word[:2], ..., word, each as a word of its own."""
        chars, last, inner = self._extend(word)
        end, whole = 0, []
        for c in word:
            end += len(c.encode("utf-8", "surrogatepass"))
            whole.append(self._ended(chars, last, inner, end))
        if word in self.contractions:  # cut after one letter it is an apostrophe and a word
            whole[1] = self.word_count("'") + self.word_count(word[1])
        return whole

    @staticmethod
    def normal(text: str) -> str:
        if not text.isascii() and not unicodedata.is_normalized("NFC", text):
            text = unicodedata.normalize("NFC", text)
        return text.replace("Σ", "σ").lower()  # lower() alone would look at a sigma's neighbours

    def _learn(self, chunks: set[str]) -> None:
        """Puts the counts of chunks (runs without white space) into `totals`."""
        older, totals = self.older, self.totals
        fresh: dict[str, list[str]] = {}
        for c in chunks:
            n = older.get(c)
            if n is None:
                fresh[c] = self.words.findall(c)
            else:
                totals[c] = n
        new = {w for ws in fresh.values() for w in ws}.difference(totals)
        for w in sorted(new):
            n = older.get(w)
            totals[w] = self.word_count(w) if n is None else n
        for c, ws in fresh.items():
            totals[c] = sum([totals[w] for w in ws])

    def _pieces(self, text: str) -> list[str]:
        low = self.normal(text)
        return low.split() if not ODD_SPACE.search(low) else [c for _, c in self.chunks(low)]

    def counts(self, texts: Sequence[str]) -> list[int]:
        """Tokens of each whole text: the last entries of their prefix counts. Words that
        are new are learned for many texts at once, in sorted order."""
        out: list[int] = []
        at = 0
        while at < len(texts):
            group, size = [], 0
            while at < len(texts) and (not group or size + len(texts[at]) < GROUP):
                t = texts[at]
                parts = [t] if self.special is None or "<|" not in t else self.special.split(t)
                group.append((len(parts) - 1, [c for p in parts for c in self._pieces(p)] if len(parts) > 1 else self._pieces(t)))
                size += len(t)
                at += 1
            if len(self.totals) > KEPT_WORDS:  # the older generation goes
                self.totals, self.older = {}, self.totals
            new = set().union(*(c for _, c in group)).difference(self.totals)
            if new:
                self._learn(new)
            get = self.totals.__getitem__
            out += [n + sum(map(get, c)) for n, c in group]
        return out

    def count(self, text: str) -> int:
        return self.counts([text])[0]

    def chunks(self, text: str) -> Iterator[tuple[int, str]]:
        """The text's runs without white space, which are encoded independently."""
        for m in regex.finditer(f"[^{SPACE}]+", text):
            yield m.start(), m[0]

    def chunk_table(self, chunk: str) -> list[int]:
        low = self.normal(chunk)
        if len(low) != len(chunk) or not unicodedata.is_normalized("NFC", chunk) or (self.special and self.special.search(chunk)):
            return [self.count(chunk[:i]) for i in range(1, len(chunk) + 1)]
        out: list[int] = []
        done = 0
        for w in self.words.findall(low):
            t = self.word_table(w)
            out += [done + n for n in t]
            done += t[-1]
        return out

    def prefix_counts(self, text: str) -> list[int]:
        """Entry i: the tokens of text[:i] (code points), for i = 0 ... len(text)."""
        out = [0]
        for start, chunk in self.chunks(text):
            done = out[-1]
            out += [done] * (start + 1 - len(out))
            out += [done + n for n in self.chunk_table(chunk)]
        return out + [out[-1]] * (len(text) + 1 - len(out))

    def fit(self, text: str, budget: int) -> int:
        """The most code points of a prefix of no more than `budget` tokens (the last
        such prefix: counts may fall where a word is completed)."""
        done, best = 0, 0
        for start, chunk in self.chunks(text):
            if done > budget:
                break
            best = start  # what stands before it, with the white space
            n = self.count(chunk) if self.special and "<|" in chunk else self.totals.get(self.normal(chunk))
            if n is None:
                n = self.count(chunk)
            if done + n <= budget:
                best = start + len(chunk)
            else:  # the budget ends within this chunk: its own prefixes tell where
                best = max([best, *(start + i for i, k in enumerate(self.chunk_table(chunk), 1) if done + k <= budget)])
            done += n
        if done <= budget:
            best = len(text)
        return best


@cache
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def count_tokens(docs: DataFrame, limit: int = LIMIT, path: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit, fit_chars: one row per row of docs.

    fit_chars: code points of the longest prefix with no more than `limit` tokens.
    Null text counts as empty: 0 bytes, 0 tokens. Texts of any length are taken
    whole; repeated rows and null ids give a row each; other columns are not read.
    `path` is the tokenizer file, at the same place on every executor.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = counter(path)
        for b in batches:
            n = c.counts([*b.text])
            fit = [len(t) if k <= limit else c.fit(t, limit) for t, k in zip(b.text, n)]
            yield pd.DataFrame({"doc_id": b.doc_id, "n_bytes": b.n_bytes, "n_tokens": n, "over_limit": [k > limit for k in n], "fit_chars": fit})

    rows = docs.select("doc_id", text_or_empty().alias("text")).withColumn("n_bytes", F.octet_length("text").cast("long"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(counted, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean, fit_chars long")


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"))
