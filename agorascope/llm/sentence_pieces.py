"""SentencePiece encoding and decoding with merge-type vocabularies.

A text is escaped (a space is the space mark, one stands in front) and cut before space marks: where no entry of
the vocabulary holds two characters side by side, no merge can cross. Within a part, adjacent symbols lie on an
agenda ordered by score; the best pair is merged first, until no pair is in the vocabulary. Characters that are
no entry are spelled in bytes. Parts that come again are looked up in a worker's cache; the agendas of those that don't
are worked off together, a merge of each at a time, in arrays.

In each Arrow batch the sentencepiece library encodes every part that the worker meets for the first time, and rows
whose text doesn't come back whole; where it differs, its result is given and the row says so.
"""

from __future__ import annotations

import codecs
import heapq
import re
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, pairwise

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agorascope.llm.common import map_batches, named

MARK = "▁"
#: Entries of each of the two generations of a worker's cache (about 100 MB each), and the longest part that stays in it.
CACHE_ENTRIES, CACHE_CHARS = 400_000, 40
#: Characters that are looked at together, of one text or several.
SEGMENT_CHARS = 500_000
#: Up to so many characters the agenda is a stretch of an array or a list, beyond it a heap.
SHORT_CHARS = 32


def model_path(name: str = "piece_bpe_32k.model") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def library(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _each_byte(error: UnicodeError) -> tuple[str, int]:
    """One replacement character for each byte that is no part of a character, as the library has it."""
    return "�", error.start + 1


codecs.register_error("each_byte", _each_byte)


class Pieces:
    """A merge-type vocabulary. A symbol is an entry's place by falling score, from 1; 0 stands for a character without entry."""

    def __init__(self, processor):
        n = processor.get_piece_size()
        special = [i for i in range(n) if processor.is_byte(i) or processor.is_control(i) or processor.is_unknown(i)]
        plain = sorted(set(range(n)) - set(special), key=lambda i: -processor.get_score(i))
        if any(processor.is_unused(i) for i in plain):
            raise ValueError("entries that may not be used are not supported")
        self.said = [processor.id_to_piece(i) for i in range(n)]
        self.ids = [processor.unk_id(), *plain]
        self.symbols = {self.said[i]: k for k, i in enumerate(plain, 1)}
        self.size = len(self.ids)
        #: Two symbols, as one number, to the one that they make.
        self.pairs = {
            self.symbols[p[:k]] * self.size + self.symbols[p[k:]]: s
            for p, s in self.symbols.items() for k in range(1, len(p)) if p[:k] in self.symbols and p[k:] in self.symbols
        }
        #: Two symbols to the rank of the score of what they make; equal scores rank alike, the leftmost of them goes first.
        places = {s: k for k, s in enumerate(sorted({processor.get_score(i) for i in plain}, reverse=True))}
        self.ranks, self.none = {pair: places[processor.get_score(self.ids[s])] for pair, s in self.pairs.items()}, len(places)
        self.id_of, self.symbol_of = np.array(self.ids), np.zeros(0x110000, np.int64)
        for p, s in self.symbols.items():
            if len(p) == 1:
                self.symbol_of[ord(p)] = s
        inside = {p[k : k + 2] for p in self.symbols for k in range(len(p) - 1)}
        self.inside, self.at_spaces = inside, not any(a[0] != MARK and a[1] == MARK for a in inside)
        self.bytes = {int(self.said[i][3:5], 16): i for i in special if processor.is_byte(i)}
        self.byte_of = {i: b for b, i in self.bytes.items()}
        #: What decoding gives for an id; None for bytes that are read together, which those of ASCII never are.
        self.texts = [(chr(b) if b < 128 else None) if (b := self.byte_of.get(i)) is not None else " ⁇ " if processor.is_unknown(i) else "" if processor.is_control(i) else p.replace(MARK, " ") for i, p in enumerate(self.said)]
        self.young: dict[str, list[int]] = {}
        self.old: dict[str, list[int]] = {}

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Pairs in order, what they make, and its rank."""
        order = sorted(self.ranks)
        return np.array(order, np.int64), np.array([self.pairs[p] for p in order], np.int64), np.array([self.ranks[p] for p in order], np.int32)

    def segments(self, text: str) -> Iterator[str]:
        """The escaped text in stretches that no merge crosses."""
        escaped, at = MARK + text.replace(" ", MARK), 0
        gap = re.compile(f"[^{MARK}](?={MARK})")
        while at < len(escaped):
            m = gap.search(escaped, at + SEGMENT_CHARS) if self.at_spaces else None
            end = m.end() if m else len(escaped)
            yield escaped[at:end]
            at = end

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text."""
        return self.encode_all([text])[0]

    def encode_all(self, texts: list[str], fresh: dict[str, list[int]] | None = None) -> list[list[int]]:
        """Ids of whole texts; parts met for the first time are added to ``fresh``."""
        out, near, chars = [[] for _ in texts], [], 0
        for ids, text in zip(out, texts, strict=True):
            for segment in self.segments(text) if text else ():
                near.append((ids, re.findall(f"{MARK}+[^{MARK}]*", segment) if self.at_spaces else [segment]))
                chars += len(segment)
                if chars >= SEGMENT_CHARS:
                    self._put(near, fresh)
                    near, chars = [], 0
        self._put(near, fresh)
        return out

    def _put(self, near: list[tuple[list[int], list[str]]], fresh: dict[str, list[int]] | None) -> None:
        """Add the ids of parts to the lists beside them."""
        if len(self.young) > CACHE_ENTRIES:
            self.young, self.old = {}, self.young
        young, unknown = self.young, []
        new = set().union(*(parts for _, parts in near)).difference(young)
        for part in new:
            known = self.old.get(part)
            if known is None:
                unknown.append(part)
            else:
                young[part] = known
        made = dict(zip(unknown, self.encode_parts(unknown), strict=True))
        young.update(made)
        if fresh is not None:
            fresh.update(made)
        for ids, parts in near:
            ids += chain.from_iterable(map(young.__getitem__, parts))
        for part in new:
            if len(part) > CACHE_CHARS:
                del young[part]

    def encode_parts(self, parts: list[str]) -> list[list[int]]:
        short = [p for p in parts if len(p) <= SHORT_CHARS]
        merged = iter(self._merge_together(short))
        return [next(merged) if len(p) <= SHORT_CHARS else self.encode_part(p) for p in parts]

    def _ranked(self, pairs: np.ndarray) -> np.ndarray:
        keys, _, ranks = self.table
        at = np.minimum(np.searchsorted(keys, pairs), len(keys) - 1)
        return np.where(keys[at] == pairs, ranks[at], self.none)

    def _merge_together(self, parts: list[str]) -> list[list[int]]:
        """As ``_merge_listed`` of each part. All agendas lie in a row, the rank of a symbol and the next at the first of the
        two; in each turn the first of the least of every part is merged, and parts that have none leave."""
        keys, makes, _ = self.table
        if not parts or not len(keys):
            return [self._merge_listed(p) for p in parts]
        size, none = self.size, self.none
        symbols = self.symbol_of[np.frombuffer("".join(parts).encode("utf-32-le"), "<u4")]
        of = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
        ranks = np.full(len(of), none, np.int32)
        ranks[:-1] = np.where(of[1:] == of[:-1], self._ranked(symbols[:-1] * size + symbols[1:]), none)
        done = []
        while len(of):
            starts = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
            lengths = np.diff(np.append(starts, len(of)))
            least = np.minimum.reduceat(ranks, starts)
            going = least < none
            if not going.all():
                stay = np.repeat(going, lengths)
                done.append((of[~stay], symbols[~stay]))
                of, symbols, ranks, least, lengths = of[stay], symbols[stay], ranks[stay], least[going], lengths[going]
                if not len(of):
                    break
            at = np.flatnonzero(ranks == np.repeat(least, lengths))
            at = at[np.concatenate(([True], of[at[1:]] != of[at[:-1]]))]  # the first of each part
            symbols[at] = makes[np.searchsorted(keys, symbols[at] * size + symbols[at + 1])]
            stay = np.ones(len(of), bool)
            stay[at + 1] = False
            of, symbols, ranks = of[stay], symbols[stay], ranks[stay]
            at = at - np.arange(len(at))
            changed = np.concatenate((at, at[at > 0] - 1))
            inner = changed[changed < len(of) - 1]
            inner = inner[of[inner] == of[inner + 1]]
            ranks[at] = none
            ranks[inner] = self._ranked(symbols[inner] * size + symbols[inner + 1])
        of, symbols = (np.concatenate(x) for x in zip(*done, strict=True))
        order = np.argsort(of, kind="stable")
        symbols, ends = symbols[order], np.cumsum(np.bincount(of, minlength=len(parts))).tolist()
        ids = self.id_of[symbols].tolist()
        found = [ids[a:b] for a, b in pairwise([0, *ends])]
        for k in np.unique(of[order][symbols == 0]).tolist():
            found[k] = self._spelled(symbols[ends[k - 1] if k else 0 : ends[k]].tolist(), parts[k])
        return found

    def encode_part(self, part: str) -> list[int]:
        if len(part) <= SHORT_CHARS:
            return self._merge_listed(part)
        inside, out = self.inside, []
        edges = [0, *[k for k in range(1, len(part)) if part[k - 1 : k + 1] not in inside], len(part)]
        for a, b in pairwise(edges):
            out += self._merge_listed(part[a:b]) if b - a <= SHORT_CHARS else self._merge_heaped(part[a:b])
        return out

    def _merge_listed(self, part: str) -> list[int]:
        """The agenda is a list of the ranks of what each pair makes; the first of the least is merged."""
        rank, size, none = self.ranks.get, self.size, self.none
        symbols = [self.symbols.get(c, 0) for c in part]
        agenda = [rank(a * size + b, none) for a, b in pairwise(symbols)]
        while agenda and (least := min(agenda)) < none:
            k = agenda.index(least)
            made = symbols[k] = self.pairs[symbols[k] * size + symbols[k + 1]]
            del symbols[k + 1], agenda[k]
            if k < len(agenda):
                agenda[k] = rank(made * size + symbols[k + 1], none)
            if k:
                agenda[k - 1] = rank(symbols[k - 1] * size + made, none)
        return self._spelled(symbols, part)

    def _merge_heaped(self, part: str) -> list[int]:
        """The agenda is a heap of the ranks of what pairs make and where; pairs that no longer stand are passed over."""
        rank, size, n = self.ranks.get, self.size, len(part)
        symbols = [self.symbols.get(c, 0) for c in part]
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda = [r * n + k for k, (a, b) in enumerate(pairwise(symbols)) if (r := rank(a * size + b)) is not None]
        heapq.heapify(agenda)
        while agenda:
            r, k = divmod(heapq.heappop(agenda), n)
            if symbols[k] < 0 or (following := right[k]) < 0 or rank(pair := symbols[k] * size + symbols[following]) != r:
                continue
            made = symbols[k] = self.pairs[pair]
            symbols[following] = -1
            after, before = right[following], left[k]
            right[k] = after
            if after >= 0:
                left[after] = k
                if (r := rank(made * size + symbols[after])) is not None:
                    heapq.heappush(agenda, r * n + k)
            if before >= 0 and (r := rank(symbols[before] * size + made)) is not None:
                heapq.heappush(agenda, r * n + before)
        return self._spelled([s for s in symbols if s >= 0], part)

    def _spelled(self, symbols: list[int], part: str) -> list[int]:
        """Ids of symbols; characters without entry, which never merge, in bytes if there are any."""
        ids = self.ids
        if 0 not in symbols or not self.bytes:
            return [ids[s] for s in symbols]
        odd = (c for c in part if c not in self.symbols)
        return [i for s in symbols for i in ([ids[s]] if s else [self.bytes[b] for b in next(odd).encode()])]

    def decode(self, ids: list[int]) -> str:
        """The text of any ids: bytes in a row are read as UTF-8, space marks become spaces, the one in front goes."""
        front = next((i for i in ids if self.texts[i] != ""), None)
        marked = front is not None and self.said[front].startswith(MARK)
        try:
            text = "".join(map(self.texts.__getitem__, ids))
        except TypeError:  # there are bytes
            out, run = [], bytearray()
            for i in ids:
                if self.texts[i] is None:
                    run.append(self.byte_of[i])
                else:
                    if run:
                        out.append(run.decode(errors="each_byte"))
                        run.clear()
                    out.append(self.texts[i])
            text = "".join((*out, run.decode(errors="each_byte")))
        return text[1:] if marked else text


_WORKER: dict[str, tuple] = {}


def worker(path: str) -> tuple:
    """This worker's vocabulary and library, kept between its tasks."""
    if path not in _WORKER:
        processor = library(path)
        _WORKER[path] = Pieces(processor), processor
    return _WORKER[path]


def checked(texts: list[str], pieces: Pieces, processor) -> tuple[list[list[int]], list[str], list[bool]]:
    """(ids, decoded texts, whether the library agrees) of a batch, each as the library has it."""
    fresh: dict[str, list[int]] = {}
    ids = pieces.encode_all(texts, fresh)
    decoded = [pieces.decode(i) for i in ids]
    # The library puts a mark in front, so it gets a part without its own. A lone mark, before a space or at the end of
    # a text, leaves no text to give; it is an entry.
    fresh.pop(MARK, None)
    sound = pieces.at_spaces and processor.encode([p[1:].replace(MARK, " ") for p in fresh], num_threads=1) == list(fresh.values())
    agrees = [True] * len(texts)
    for k, t in enumerate(texts):
        if not sound or decoded[k] != t.replace(MARK, " "):
            own = processor.encode(t)
            back = processor.decode(own)
            agrees[k] = (ids[k], decoded[k]) == (own, back)
            ids[k], decoded[k] = own, back
    return ids, decoded, agrees


def encoded(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids, decoded, agrees) of every row of ``docs``, one row for each, without a shuffle.

    ``ids`` are those of the whole text, without begin or end, and ``decoded`` is the text that they give, both as the
    library has them; ``agrees`` is false where the agenda gave others. Null and empty texts have no ids and an empty
    text. Repeated rows are each encoded, null ids stay, ids may be of any type, other columns are not read, and an
    empty table gives an empty table.
    """
    path = path or model_path()

    def setup():
        pieces, processor = worker(path)

        def work(texts):
            ids, decoded, agrees = checked([t or "" for t in texts], pieces, processor)
            return None, {"ids": ids, "decoded": decoded, "agrees": agrees}

        return work

    given = docs.select(named(id).alias("id"), named(text).cast("string").alias("text"))
    return map_batches(given, setup, [("ids", "array<int>"), ("decoded", "string"), ("agrees", "boolean")]).withColumnRenamed("id", id)


def digests(docs: DataFrame, id: str = "doc_id", text: str = "text", path: str | None = None) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256, agrees) of every row: what ``encoded`` gives, as hashes.

    ``ids_sha256`` is of the decimal ids joined by commas, ``decoded_sha256`` of the decoded text in UTF-8. Rows, nulls
    and odd tables are handled as there.
    """
    found = encoded(docs, id, text, path)
    joined = F.array_join(F.col("ids").cast("array<string>"), ",")
    return found.select(
        named(id), F.size("ids").cast("long").alias("n_tokens"), F.sha2(joined.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "agrees",
    )
