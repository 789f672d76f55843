"""Token counts by a map-side two-tier lookup, and token ids for packing.

Tier one is a compact table of frequent pre-tokens and their lengths in tokens, counted on a bounded sample of the
documents and broadcast: sorted hashes, lengths, and the words themselves to tell equal hashes apart. Tier two is a
cache in each Python worker, which the tokenizer fills for what the table misses. No pre-token is ever shuffled.
"""

from __future__ import annotations

import base64
import os
import re
import unicodedata
from collections import Counter
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import map_batches, named

SPECIAL = "<|endoftext|>"
#: Entries that a worker's cache holds before it is emptied (about 200 MB), and pre-tokens of a text that are looked up together.
CACHE_ENTRIES, TOGETHER = 1_000_000, 200_000
#: Bounds of the sample that frequent pre-tokens are counted on, texts and characters of each, and the most entries of the table.
SAMPLE_TEXTS, SAMPLE_CHARS, ENTRIES = 4000, 1000, 1 << 16


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load_tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


class Splitter:
    """Pre-tokens of a text by the vocabulary's own pattern; None where the library must split the text itself.

    That is so for special strings, and for characters without a place in this Python's Unicode tables, on which
    libraries of other ages may differ. Characters once found to have one are remembered.
    """

    def __init__(self, pattern: str):
        import regex

        self.find, self.fine = regex.compile(pattern).findall, set(map(chr, range(128)))

    def __call__(self, text: str) -> list[str] | None:
        if SPECIAL in text:
            return None
        if not text.isascii():
            for c in set(text) - self.fine:
                if unicodedata.category(c) in ("Cn", "Cs"):
                    return None
                self.fine.add(c)
        return self.find(text)


@dataclass(frozen=True)
class LengthTable:
    """Frequent pre-tokens: ``hashes`` in order, and for each its length and where its UTF-8 bytes lie in ``words``."""

    hashes: np.ndarray
    lengths: np.ndarray
    ends: np.ndarray
    words: bytes

    @staticmethod
    def of(lengths: dict[str, int]) -> LengthTable:
        rows = sorted((xxhash.xxh64_intdigest(w), w, n) for word, n in lengths.items() for w in (word.encode(),))
        return LengthTable(
            np.array([r[0] for r in rows], np.uint64), np.array([r[2] for r in rows], np.uint16),
            np.cumsum([0, *(len(r[1]) for r in rows)]).astype(np.uint32), b"".join(r[1] for r in rows),
        )

    def find(self, words: list[str]) -> np.ndarray:
        """Lengths of words, 0 for those that are not in the table."""
        out = np.zeros(len(words), np.int64)
        if not len(self.hashes) or not words:
            return out
        data = [w.encode() for w in words]
        wanted = np.array([xxhash.xxh64_intdigest(w) for w in data], np.uint64)
        at = np.minimum(np.searchsorted(self.hashes, wanted), len(self.hashes) - 1)
        for k in np.flatnonzero(self.hashes[at] == wanted):
            i = at[k]
            if self.words[self.ends[i] : self.ends[i + 1]] == data[k]:
                out[k] = self.lengths[i]
        return out


class Lengths:
    """Both tiers in a worker: a cache of lengths, filled from the table and, for what that misses, by the tokenizer."""

    def __init__(self, tokenizer, table: LengthTable, split: Splitter):
        self.tokenizer, self.table, self.split, self.cache = tokenizer, table, split, {}

    def total(self, words: list[str]) -> int:
        """Tokens of pre-tokens."""
        n = 0
        for k in range(0, len(words), TOGETHER):
            some = words[k : k + TOGETHER]
            if len(self.cache) > CACHE_ENTRIES:
                self.cache.clear()
            self.learn(list(set(some).difference(self.cache)))
            n += sum(map(self.cache.__getitem__, some))
        return n

    def learn(self, new: list[str]) -> None:
        found = self.table.find(new)
        self.cache.update(zip(new, found.tolist(), strict=True))
        missed = [w for w, n in zip(new, found, strict=True) if not n]
        if missed:
            encoded = self.tokenizer.encode_batch(missed, add_special_tokens=False)
            self.cache.update((w, len(e.ids)) for w, e in zip(missed, encoded, strict=True))


_LENGTHS: dict[tuple, Lengths] = {}


def worker_lengths(path: str, table) -> Lengths:
    """This worker's tiers, kept between its tasks of one table."""
    key = path, int(table.value.hashes.sum())
    if key not in _LENGTHS:
        import public_tokenizers

        _LENGTHS.clear()
        _LENGTHS[key] = Lengths(load_tokenizer(path), table.value, Splitter(public_tokenizers.PATTERN))
    return _LENGTHS[key]


def count_tokens(text: str, lengths: Lengths) -> int:
    """Tokens of one whole text, as the library counts them."""
    if not text:
        return 0
    words = lengths.split(text)
    if words is None:
        return len(lengths.tokenizer.encode(text, add_special_tokens=False).ids)
    return lengths.total(words)


def sample_counts(docs: DataFrame, text: str = "text", texts: int = SAMPLE_TEXTS) -> Counter:
    """Pre-tokens of a bounded sample: at most ``texts`` passages of ``SAMPLE_CHARS`` characters, of texts dealt by their hash.

    It only says what is worth a place in the table; whatever it is, counts come out the same.
    """
    import public_tokenizers

    rows = docs.select(named(text).cast("string").alias("t")).where("t <> ''")
    h = F.xxhash64("t")
    n = docs.count()
    start = F.pmod(h, F.greatest(F.lit(1), F.length("t") - SAMPLE_CHARS)).cast("int") + 1
    some = rows.where(F.pmod(h, F.lit(1_000_000)) < max(1, min(1_000_000, 1_000_000 * texts // max(1, n))))
    split, found = Splitter(public_tokenizers.PATTERN), Counter()
    for r in some.select(F.substring("t", start, F.lit(SAMPLE_CHARS)).alias("t")).limit(texts).collect():
        found.update(split(r["t"]) or ())
    return found


def frequent_lengths(counts: Counter, path: str, entries: int = ENTRIES) -> dict[str, int]:
    """True lengths in tokens of the most frequent pre-tokens that came more than once, as the tokenizer gives them."""
    words = [w for w, n in sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:entries] if n > 1]
    return {w: len(e.ids) for w, e in zip(words, load_tokenizer(path).encode_batch(words, add_special_tokens=False), strict=True)}


def table_for(docs: DataFrame, text: str = "text", path: str | None = None) -> LengthTable:
    return LengthTable.of(frequent_lengths(sample_counts(docs, text), path or tokenizer_path()))


def hit_rates(docs: DataFrame, table: LengthTable, text: str = "text") -> DataFrame:
    """(pretokens, in_table) over all of ``docs``: pre-tokens with repeats, and those whose length the table has."""
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def setup():
        import public_tokenizers

        split = Splitter(public_tokenizers.PATTERN)

        def work(texts):
            found = [Counter(split(t or "") or ()) for t in texts]
            hits = [int((np.array(list(c.values()), np.int64) * (shared.value.find(list(c)) > 0)).sum()) for c in found]
            return None, {"pretokens": [c.total() for c in found], "in_table": hits}

        return work

    rows = map_batches(docs.select(F.lit(0).alias("k"), named(text).cast("string").alias("text")), setup, [("pretokens", "long"), ("in_table", "long")])
    return rows.agg(F.sum("pretokens").alias("pretokens"), F.sum("in_table").alias("in_table"))


def token_counts(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None, limit: int = 1024, table: LengthTable | None = None) -> DataFrame:
    """(id, n_bytes, n_tokens, over_limit) of every row of ``docs``, one row for each, without a shuffle.

    ``table`` is that of ``table_for``, by default made from these documents. Null and empty texts have no bytes and no
    tokens. Repeated rows are each counted. Null ids stay, and ids may be of any type. Other columns of ``docs`` are not
    read, so their names never clash. An empty table gives an empty table. Texts of any length and script are counted
    whole; those with a special string or an unassigned character are left to the library.
    """
    path = path or tokenizer_path()
    table = docs.sparkSession.sparkContext.broadcast(table or table_for(docs, text, path))

    def setup():
        lengths = worker_lengths(path, table)

        def work(texts):
            return None, {"n_bytes": [len((t or "").encode()) for t in texts], "n_tokens": [count_tokens(t, lengths) for t in texts]}

        return work

    found = map_batches(docs.select(named(id).alias("id"), named(text).cast("string").alias("text")), setup, [("n_bytes", "long"), ("n_tokens", "long")])
    return found.select(F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


class IdEncoder:
    """Ids of whole texts, equal to the json vocabulary's.

    The rank file holds the same vocabulary and its library is several times as fast; both split alike
    at every code point (a test compares them). Texts with a special string go to the json's library.
    """

    def __init__(self, path: str, ranks_path: str, pattern: str):
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.path, self.exact = path, None

    def __call__(self, text: str) -> np.ndarray:
        if not text:
            return np.zeros(0, np.uint32)
        if SPECIAL in text:
            self.exact = self.exact or load_tokenizer(self.path)
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=())


_ENCODERS: dict[str, IdEncoder] = {}


def id_encoder(path: str) -> IdEncoder:
    """This worker's encoder for the vocabulary at ``path``."""
    if path not in _ENCODERS:
        import public_tokenizers

        _ENCODERS[path] = IdEncoder(path, re.sub(r"\.json$", ".tiktoken", path), public_tokenizers.PATTERN)
    return _ENCODERS[path]
