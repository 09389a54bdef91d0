"""Exact token counts of every prefix of a text, for a BPE tokenizer with word ends.

The tokenizer drops white space and encodes each word on its own, so a text's counts are sums over words. Within a word,
dynamic programming over its bytes keeps, for each prefix, the last token of its encoding and how many tokens there
are. A token sequence is the encoding of its text exactly if each pair of neighbours is the encoding of the pair's own
text; so the last token of a prefix is the one that ends there and agrees with the last token of the prefix before it.
The same step with tokens that close a word gives the count if the text ended there. No prefix is encoded again.
"""

from __future__ import annotations

import json
import re
import unicodedata
from array import array
from bisect import bisect_right
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts

#: Words that a worker keeps for good, and how many later ones it keeps until they are dropped together.
KEPT_WORDS, PASSING_WORDS = 250_000, 250_000


def _byte_letters() -> dict[int, str]:
    """The printable letter that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _classes(limit: int = 0x300) -> tuple[str, str]:
    """Character classes of letters and of numbers below ``limit``."""
    found = {"L": "", "N": ""}
    for c in map(chr, range(limit)):
        kind = unicodedata.category(c)[0]
        if kind in found:
            found[kind] += re.escape(c)
    return found["L"], found["N"]


class PrefixCounter:
    """Counts tokens at every prefix as the tokenizer file's library does."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.end = spec["model"]["end_of_word_suffix"]
        to_byte = {c: b for b, c in _byte_letters().items()}
        self.names = ["", *spec["model"]["vocab"]]
        self.root: list = [{}, 0, 0]  # a tree of bytes; in each node its children, the inner and the closing token there
        for at, token in enumerate(self.names):
            body = token.removesuffix(self.end)
            if body and all(c in to_byte for c in body):
                node = self.root
                for c in body:
                    node = node[0].setdefault(to_byte[c], [{}, 0, 0])
                node[2 if token.endswith(self.end) else 1] = at
        number = {token: i for i, token in enumerate(self.names)}
        self.parts: dict[int, tuple[int, int, int]] = {}  # by token: the merge that makes it
        self.pairs: dict[int, int] = {}  # by pair of tokens: the rank of their merge
        for rank, merge in enumerate(spec["model"]["merges"]):
            x, y = merge if isinstance(merge, list) else merge.split(" ")
            self.pairs[number[x] << 17 | number[y]] = rank
            self.parts.setdefault(number[x + y], (rank, number[x], number[y]))
        self.edges: tuple[dict, dict] = ({}, {})
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.special_split = re.compile("|".join(map(re.escape, self.special)))
        letters, numbers = _classes()
        self.words = re.compile(rf"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^\s{letters}{numbers}]+")
        # Letters below whose lower case isn't are left to the library too.
        leaving = "".join(c for c in map(chr, range(0x300)) if any(ord(x) >= 0x300 for x in c.lower()))
        self.unusual = re.compile(f"[^\t\n\r\x20-\x7e\xa1-˿]|[{leaving}]")
        self.agreed: dict[int, bool] = {}
        self.ids: dict[str, int] = {}
        self.starts = array("q", [0])
        self.ends = array("i")
        self.last = array("i")
        self.passing: list[str] = []

    def _forget(self) -> None:
        """Drop the words beyond the first ones, among which the common ones are."""
        for w in self.passing:
            del self.ids[w]
        self.passing = []
        n = len(self.ids)
        del self.starts[n + 1 :], self.last[n:], self.ends[self.starts[n] :]
        if len(self.agreed) > 1 << 20:
            self.agreed = {}

    def _edge(self, token: int, side: int) -> list[tuple[int, float]]:
        """The symbols that stand at one edge (0: the first, 1: the last) while the token is built, each with the rank
        of the merge that takes it in; ranks grow, as a merge's parts are made by earlier merges."""
        found = self.edges[side].get(token)
        if found is None:
            found, taken = [(token, float("inf"))], token
            while taken in self.parts:
                rank, *both = self.parts[taken]
                taken = both[side]
                found.append((taken, rank))
            self.edges[side][token] = found = found[::-1]
        return found

    def _agree(self, left: int, right: int) -> bool:
        """Is [left, right] the encoding of their joined text: does no merge across their border come first?"""
        a, b = self._edge(left, 1), self._edge(right, 0)
        i = j = 0
        while True:
            (x, x_taken), (y, y_taken) = a[i], b[j]
            rank = self.pairs.get(x << 17 | y)
            if rank is not None and rank < x_taken and rank <= y_taken:
                return False
            if x_taken == y_taken == float("inf"):
                return True
            if x_taken <= y_taken:
                i += 1
            else:
                j += 1

    def prefixes(self, word: str) -> list[int]:
        """For each prefix of the word, by code point: its number of tokens."""
        raw, agreed = word.encode(), self.agreed
        n = len(raw)
        last, tokens, closed = [0] * (n + 1), [0] * (n + 1), [0] * (n + 1)
        for j in range(n):
            before, count = last[j], tokens[j] + 1
            node, i = self.root, j
            for byte in raw[j:] if n - j < 64 else raw[j : j + 512]:  # no token is longer
                node = node[0].get(byte)
                if node is None:
                    break
                i += 1
                _, inner, final = node
                if inner and not last[i]:
                    pair = before << 17 | inner
                    ok = agreed.get(pair)
                    if ok is None:
                        ok = agreed[pair] = not before or self._agree(before, inner)
                    if ok:
                        last[i], tokens[i] = inner, count
                if final and not closed[i]:
                    pair = before << 17 | final
                    ok = agreed.get(pair)
                    if ok is None:
                        ok = agreed[pair] = not before or self._agree(before, final)
                    if ok:
                        closed[i] = count
        return closed[1:] if n == len(word) else [closed[i] for i in range(1, n + 1) if i == n or raw[i] & 0xC0 != 0x80]

    def counts_of(self, chunk: str) -> list[int]:
        """The same for a text without white space, which may hold several words, or for a special string."""
        if chunk in self.special:
            return [0] * (len(chunk) - 1) + [1]
        out: list[int] = []
        for word in self.words.findall(chunk) if not self.unusual.search(chunk) else [chunk]:
            base = out[-1] if out else 0
            out += [base + n for n in self.prefixes(word)]
        return out

    def chunks(self, text: str) -> list[str]:
        """The normalised text cut at white space; words of other scripts and special strings stand alone."""
        if "<|" in text and self.special_split.search(text):
            out, at = [], 0
            for m in self.special_split.finditer(text):
                out += [*self.chunks(text[at : m.start()]), m[0]]
                at = m.end()
            return out + self.chunks(text[at:])
        if self.unusual.search(text):  # normal forms, other scripts: as the library cuts them
            normal = self.library.normalizer.normalize_str(text)
            spans = self.library.pre_tokenizer.pre_tokenize_str(normal)
            return [normal[a:b] for _, (a, b) in spans]
        return text.lower().split()

    def known(self, text: str) -> np.ndarray:
        """The numbers of the text's chunks."""
        if len(self.passing) > PASSING_WORDS:
            self._forget()
        chunks = self.chunks(text)
        ids = list(map(self.ids.get, chunks))
        if None in ids:
            for at, n in enumerate(ids):
                if n is None:
                    ids[at] = self.id_of(chunks[at])
        return np.array(ids, dtype=np.int64)

    def id_of(self, chunk: str) -> int:
        found = self.ids.get(chunk)
        if found is None:
            counts = self.counts_of(chunk)
            found = self.ids[chunk] = len(self.ids)
            self.ends.extend(counts)
            self.starts.append(len(self.ends))
            self.last.append(counts[-1])
            if found >= KEPT_WORDS:
                self.passing.append(chunk)
        return found

    def prefix_counts(self, text: str) -> np.ndarray:
        """Token count after each code point of the text as normalised, white space left out."""
        ids = self.known(text)
        if not len(ids):
            return np.zeros(0, np.int64)
        starts = np.frombuffer(self.starts, np.int64)
        lengths = starts[ids + 1] - starts[ids]
        first = np.cumsum(lengths) - lengths
        at = np.arange(lengths.sum()) + np.repeat(starts[ids] - first, lengths)
        totals = np.frombuffer(self.last, np.int32)[ids]
        return np.frombuffer(self.ends, np.int32)[at] + np.repeat(np.cumsum(totals) - totals, lengths)

    def cut(self, text: str, budget: int) -> tuple[int, int, int]:
        """(tokens of the text, code points and tokens of the longest prefix within the budget), white space left out."""
        ids = self.known(text)
        totals = np.frombuffer(self.last, np.int32)[ids].cumsum() if len(ids) else np.zeros(0, np.int64)
        n = int(totals[-1]) if len(ids) else 0
        starts = np.frombuffer(self.starts, np.int64)
        lengths = starts[ids + 1] - starts[ids]
        if n <= budget:
            return n, int(lengths.sum()), n
        whole = bisect_right(totals, budget)
        base = int(totals[whole - 1]) if whole else 0
        chars = int(lengths[:whole].sum())
        inside = np.frombuffer(self.ends, np.int32)[starts[ids[whole]] : starts[ids[whole] + 1]]
        fits = np.flatnonzero(base + inside <= budget)
        return (n, chars + int(fits[-1]) + 1, base + int(inside[fits[-1]])) if len(fits) else (n, chars, base)


@lru_cache(2)
def counter(path: str) -> PrefixCounter:
    return PrefixCounter(path)


def prefix_table(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ``counts``: the exact token count after each code point of the text as normalised, white space left out.

    Entry i answers "how many tokens has the text cut after its i-th such code point?". Null and empty texts have an
    empty list. Repeated rows come out repeated; other columns are not looked at.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                counts = [counter(path).prefix_counts(t) for t in texts(part)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.list_(pa.int32()))], ["doc_id", "counts"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, counts array<int>")


def count_tokens(docs: DataFrame, path: str, budget: int = 2048) -> DataFrame:
    """Token counts of whole texts and where they reach the budget.

    doc_id, n_bytes, n_tokens, over_limit, cut_chars and cut_tokens: code points (white space left out, text as
    normalised) and tokens of the longest prefix of at most ``budget`` tokens. Null text counts as empty: all zero.
    Every row gives one row, repeated ones too; other columns are not looked at; no rows in, no rows out.
    """

    def run(batches):
        for batch in batches:
            for part in slices(batch):
                cuts = np.array([counter(path).cut(t, budget) for t in texts(part)], np.int64).reshape(-1, 3)
                columns = [part.column("doc_id"), part.column("n_bytes"), *(pa.array(cuts[:, i]) for i in range(3))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens", "cut_chars", "cut_tokens"])

    sized = docs.select("doc_id", "text", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"))
    counted = sized.mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, cut_chars long, cut_tokens long")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > budget).alias("over_limit"), "cut_chars", "cut_tokens")
