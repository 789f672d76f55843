"""Best-fit packing of tokenized documents into sequences under several capacities.

The packing itself works on the histogram of piece lengths, which has at most ``tokens`` rows
whatever the corpus holds: all pieces of a length are interchangeable, so bins with the same
residual capacities are handled as one class with a multiplicity. The plan says which ranks
within each length go to which bins; Spark ranks the pieces and looks their places up.
"""

from __future__ import annotations

import heapq
import zlib
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agorascope.llm.common import cut, map_batches, named
from agorascope.llm.tokens import id_encoder, tokenizer_path


@dataclass(frozen=True)
class Capacity:
    """Of one sequence: tokens, documents, and attention cost (the sum of squared piece lengths)."""

    tokens: int = 1024
    documents: int = 1024
    attention: int = 1024 * 1024
    #: Weights of the three dimensions when bins are compared.
    weights: tuple[float, float, float] = (1.0, 0.05, 0.05)
    #: "norm": least weighted residual norm after placing; "dot": largest weighted dot-product of piece and residual.
    select: str = "norm"

    def vector(self) -> np.ndarray:
        return np.array([self.tokens, self.documents, self.attention], np.int64)


@dataclass
class Plan:
    """Runs of consecutive ranks of a length: rank ``low + i`` goes to bin ``bin + i`` at ``offset``."""

    runs: dict[int, list[tuple[int, int, int]]] = field(default_factory=dict)
    bins: int = 0

    def lookup(self) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
        return {n: tuple(np.array(c, np.int64) for c in zip(*sorted(runs), strict=True)) for n, runs in self.runs.items()}


def plan(histogram: dict[int, int], capacity: Capacity = Capacity()) -> Plan:
    """Vector best-fit, longest first, over piece lengths and their counts.

    Each step either uses a class of equal bins up or places the length's last piece, so the
    number of steps follows the number of lengths and classes, not the number of pieces.
    """
    total, out = capacity.vector(), Plan()
    classes: dict[tuple[int, int, int], list[list[int]]] = {}  # residual: [first bin, bins]

    def fits(room: tuple) -> bool:
        return all(r >= k for r, k in zip(room, size, strict=True))

    def place(rank: int, spans: list[list[int]], residual: tuple, each: int) -> tuple[int, tuple]:
        """``each`` pieces of the length into every bin of ``spans``; the rank that follows, and what room is left."""
        runs, room = out.runs.setdefault(length, []), residual
        for _ in range(each):
            offset = int(total[0]) - room[0]
            for first, n in spans:
                runs.append((rank, first, offset))
                rank += n
            room = tuple(r - k for r, k in zip(room, size, strict=True))
        if min(room) > 0:
            classes.setdefault(room, []).extend(spans)
        return rank, room

    for length in sorted(histogram, reverse=True):
        left, rank, size = histogram[length], 0, (length, 1, length * length)
        if not fits(tuple(map(int, total))):
            raise ValueError(f"a piece of {length} tokens exceeds the capacity {total.tolist()}")
        best = [(*key, room) for room, key in preference(list(classes), size, capacity)]
        heapq.heapify(best)
        while left:
            residual = heapq.heappop(best)[-1] if best else tuple(map(int, total))
            new = residual not in classes
            # A new bin takes the length until it is full: no other bin fits. By the norm a bin just used is the tightest
            # for the next piece; by the dot-product it is worse than before, so its class gets one piece a bin.
            each = min(r // k for r, k in zip(residual, size, strict=True)) if new or capacity.select == "norm" else 1
            each = min(each, left)
            if new:
                spans = [[out.bins, max(1, left // each)]]
                out.bins += spans[0][1]
            else:
                spans, rest = _take(classes.pop(residual), max(1, left // each))
                if rest:
                    classes[residual] = rest
                    heapq.heappush(best, (*preference([residual], size, capacity)[0][1], residual))
            known = set(classes)
            rank, room = place(rank, spans, residual, each)
            left = histogram[length] - rank
            if room in classes and room not in known and fits(room):
                heapq.heappush(best, (*preference([room], size, capacity)[0][1], room))
    return out


def preference(rooms: list[tuple], size: tuple, capacity: Capacity) -> list[tuple[tuple, tuple]]:
    """(residual, sort key) of the residuals that ``size`` fits: the least key is chosen, of equal scores the least residual."""
    known = np.array(rooms, np.int64).reshape(-1, 3)
    known = known[(known >= np.array(size)).all(1)]
    scaled, own, weights = known / capacity.vector(), np.array(size) / capacity.vector(), np.array(capacity.weights)
    scores = -(scaled * own * weights).sum(1) if capacity.select == "dot" else (((scaled - own) ** 2) * weights).sum(1)
    return [(tuple(map(int, room)), (float(score),)) for room, score in zip(known, scores, strict=True)]


def _take(spans: list[list[int]], bins: int) -> tuple[list[list[int]], list[list[int]]]:
    """The first ``bins`` bins of ``spans``, and the others."""
    taken, at = [], 0
    while bins and at < len(spans):
        first, n = spans[at]
        if n > bins:
            return [*taken, [first, bins]], [[first + bins, n - bins], *spans[at + 1 :]]
        taken.append([first, n])
        bins -= n
        at += 1
    return taken, spans[at:]


def cut_lengths(n: int, most: int) -> list[int]:
    """Lengths of a document's pieces: all ``most`` long but the first, which has the rest."""
    return ([n % most] if n % most else []) + [most] * (n // most)


def pieces(docs: DataFrame, path: str | None = None, most: int = 1024, end_id: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32): the pieces of every whole text; null texts are empty."""
    path = path or tokenizer_path()

    def setup():
        encode = id_encoder(path)

        def work(texts):
            rows, out = [], {"piece": [], "start": [], "length": [], "ids_crc32": []}
            for row, t in enumerate(texts):
                tokens, at = np.append(encode(t or ""), np.uint32(end_id)).astype("<u4"), 0
                for k, n in enumerate(cut_lengths(len(tokens), most)):
                    rows.append(row)
                    for c, v in zip(out.values(), (k, at, n, zlib.crc32(tokens[at : at + n].tobytes())), strict=True):
                        c.append(v)
                    at += n
            return rows, out

        return work

    kinds = [("piece", "int"), ("start", "long"), ("length", "long"), ("ids_crc32", "long")]
    return map_batches(docs.select(named(id).alias("id"), named(text).cast("string").alias("text")), setup, kinds)


def pack(docs: DataFrame, capacity: Capacity = Capacity(), path: str | None = None, end_id: int = 2, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every piece of every document with its sequence and its offset there.

    A null or empty text is one piece with the end id alone. Repeated rows are packed each by
    itself, null ids stay, ids may be of any type with an order, other columns are not read, and an empty
    table gives an empty table.
    Documents longer than a sequence are cut; all others stay whole. The pieces are cut to the
    shared folder once, so that tokenizing and ranking see the same rows after a lost executor.
    """
    rows = cut(pieces(docs, path, capacity.tokens, end_id, id, text).withColumn("row", F.monotonically_increasing_id()))
    histogram = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places = docs.sparkSession.sparkContext.broadcast(plan(histogram, capacity).lookup())
    # A length that a third of all pieces share is dealt over many salts, equal pieces too; ranks run on from salt to salt.
    salts = max(64, sum(histogram.values()) // 1_000_000)
    rows = rows.withColumn("salt", F.pmod(F.xxhash64("piece", "ids_crc32", "row"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "salt").orderBy("id", "piece", "start", "ids_crc32")
    ranked = rows.withColumn("rank", F.row_number().over(within) - 1).join(starts, ["length", "salt"])

    def setup():
        table = places.value

        def work(length, rank):
            size, order = np.array(length), np.array(rank)
            bins, offsets = np.zeros(len(size), np.int64), np.zeros(len(size), np.int64)
            for n in np.unique(size):
                low, first, offset = table[int(n)]
                own = np.flatnonzero(size == n)
                run = np.searchsorted(low, order[own], "right") - 1
                bins[own], offsets[own] = first[run] + order[own] - low[run], offset[run]
            return None, {"sequence_id": bins, "offset": offsets}

        return work

    given = ranked.select("id", "piece", "start", "length", "ids_crc32", F.col("length").alias("size"), (F.col("rank") + F.col("first")).alias("rank"))
    return map_batches(given, setup, [("sequence_id", "long"), ("offset", "long")], carried=5).withColumnRenamed("id", id)
