"""Ranked lexical search over a document-sharded inverted index.

A shard holds some documents: their ids in order, their terms, and for each term its documents and their impacts, in
compressed sparse rows. An impact is the whole part of a term's score that doesn't depend on the query, an integer, so
scores are exact sums. A search takes the queries' terms one at a time, adds their impacts up in a dense array with a
place for each document of the shard, and selects the best with all ties at the limit. Each task merges the best of
its shards, and Spark merges those of the tasks.
"""

from __future__ import annotations

import math
import uuid
from array import array
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from agorascope.llm.common import bounded_batches, named, slices
from agorascope.session import kept, shared_folder

#: A term is a longest run of these; of its characters only A-Z are lower-cased. In UTF-8 it is a run of the same bytes.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SPLIT = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))
#: A shard is closed at so many postings; ``docs`` are numbered in 16 bits. One document's postings are never split.
SHARD_POSTINGS, SHARD_DOCS = 1_000_000, 1 << 16
#: Bytes of a row group, as each row of an index is a shard, and of the query texts that are searched for together.
GROUP_BYTES, BLOCK_BYTES = 16 << 20, 4 << 20


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text with repeats, in UTF-8."""
    return (text or "").encode().translate(SPLIT).split()


@dataclass(frozen=True)
class Weighting:
    """What scores need of the whole collection: documents with a term, and all their terms with repeats."""

    documents: int
    length: int
    #: Thousandths of saturation, and percent of normalisation by length.
    saturation: int = 8
    by_length: int = 75

    def term(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.documents + 2) / (2 * df + 1)))

    def norm(self, n: int) -> int:
        return 100 - self.by_length + (self.by_length * n * self.documents) // self.length

    def impacts(self, tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return (1_000_000_000 * tf) // (1000 * tf + self.saturation * norms)


@dataclass(frozen=True)
class Index:
    """``shards``: a row each, (ids, terms, starts, docs, impacts)."""

    shards: DataFrame
    weighting: Weighting


class _Shard:
    """Documents and postings of a shard that is being filled."""

    def __init__(self):
        self.ids: list[pa.Array] = []
        self.norms: list[int] = []
        self.place: defaultdict[bytes, int] = defaultdict()
        self.place.default_factory = self.place.__len__
        self.term, self.doc, self.tf = array("i"), array("i"), array("q")

    def add(self, id: pa.Array, words: list[bytes], weighting: Weighting) -> bool:
        """Whether the shard is full with this document."""
        counts = Counter(words)
        self.term.extend(map(self.place.__getitem__, counts))
        self.tf.extend(counts.values())
        self.doc.extend([len(self.norms)] * len(counts))
        self.ids.append(id)
        self.norms.append(weighting.norm(len(words)))
        return len(self.term) >= SHARD_POSTINGS or len(self.norms) >= SHARD_DOCS

    def row(self, weighting: Weighting) -> list[pa.Array]:
        ids = pa.concat_arrays(self.ids)
        order = pc.sort_indices(ids).to_numpy()  # nulls last
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        term, tf = np.frombuffer(self.term, np.int32), np.frombuffer(self.tf, np.int64)
        doc = np.frombuffer(self.doc, np.int32)
        impacts, doc = weighting.impacts(tf, np.array(self.norms, np.int64)[doc]), number[doc]
        by_term = np.argsort(term * np.int64(len(order)) + doc)
        starts = np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(self.place)))))
        blobs = (b" ".join(self.place), starts.astype("<i4").tobytes(), doc[by_term].astype("<u2").tobytes(), impacts[by_term].astype("<i4").tobytes())
        return [pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.take(pa.array(order))), *(pa.array([b], pa.binary()) for b in blobs)]


def collection(docs: DataFrame, text: str = "text") -> tuple[int, int]:
    """Documents with a term, and all their terms, over the whole table."""
    n = F.regexp_count(F.coalesce(named(text).cast("string"), F.lit("")), F.lit(TERM)).cast("long")
    row = docs.select(n.alias("n")).where("n > 0").agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return row[0], row[1]


def build(docs: DataFrame, path: str | None = None, id: str = "doc_id", text: str = "text") -> Index:
    """Index every row of ``docs``, without a shuffle, and write it to ``path``, by default a new place in the shared folder.

    The index is Parquet with a row for each shard; ``opened`` finds it again. Texts are indexed whole. Rows without a
    term, null texts among them, are not in it. Repeated rows are a document each, null ids stay, ids may be of any type
    that Arrow can order, other columns are not read, and an empty table gives an index without shards.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    path = path or f"{shared_folder(spark)}/{uuid.uuid4()}"
    weighting = Weighting(*collection(docs, text))
    names = ["ids", "terms", "starts", "docs", "impacts"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = _Shard()
        for whole in batches:
            for batch in slices(whole, 4 << 20):
                for k, t in enumerate(batch.column(1)):
                    words = terms(t.as_py())
                    if words and shard.add(batch.column(0).slice(k, 1), words, weighting):
                        yield pa.RecordBatch.from_arrays(shard.row(weighting), names=names)
                        shard = _Shard()
        if shard.norms:
            yield pa.RecordBatch.from_arrays(shard.row(weighting), names=names)

    given = docs.select(named(id).alias("id"), named(text).cast("string").alias("text"))
    schema = StructType([StructField("ids", ArrayType(given.schema["id"].dataType)), *(StructField(n, BinaryType()) for n in names[1:])])
    given.mapInArrow(run, schema).write.option("parquet.block.size", GROUP_BYTES).parquet(f"{path}/shards")
    spark.createDataFrame([(weighting.documents, weighting.length)], "documents long, length long").coalesce(1).write.parquet(f"{path}/collection")
    return opened(spark, path)


def opened(spark: SparkSession, path: str) -> Index:
    """An index that ``build`` has written."""
    row = spark.read.parquet(f"{path}/collection").first()
    return Index(spark.read.parquet(f"{path}/shards"), Weighting(row["documents"], row["length"]))


def _positions(blob: bytes) -> dict[bytes, int]:
    return {t: k for k, t in enumerate(blob.split())}


def document_counts(index: Index, wanted: list[bytes]) -> list[int]:
    """In how many documents each of some terms occurs; only the shards' terms and starts are read."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(wanted), np.int64)
        for batch in batches:
            for blob, at in zip(batch.column(0), batch.column(1), strict=True):
                place, starts = _positions(blob.as_py()), np.frombuffer(at.as_py(), "<i4")
                found = np.array([place.get(t, -1) for t in wanted], np.int64)
                known = found >= 0
                total[known] += starts[found[known] + 1] - starts[found[known]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(total[some])], names=["term", "n"])

    out = [0] * len(wanted)
    schema = StructType([StructField("term", IntegerType()), StructField("n", LongType())])
    for row in index.shards.select("terms", "starts").mapInArrow(run, schema).groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[row["term"]] = row["n"]
    return out


def best_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` greatest scores above 0, greatest first, of equal ones the first places."""
    least = 1
    if len(scores) > k:
        least = max(1, int(scores[np.argpartition(scores, len(scores) - k)[len(scores) - k]]))
    some = np.flatnonzero(scores >= least)  # all that tie with the last
    return some[np.lexsort((some, -scores[some]))[:k]]


def _order() -> list[Column]:
    return [F.desc("score"), F.asc_nulls_last("id")]


def _search_block(index: Index, queries: list[Counter], k: int) -> DataFrame:
    """(query, id, score): for each query's terms, counted, the ``k`` best of every task."""
    wanted = sorted({t for q in queries for t in q})
    weights = dict(zip(wanted, map(index.weighting.term, document_counts(index, wanted)), strict=True))
    asked = index.shards.sparkSession.sparkContext.broadcast([[(t, n * weights[t]) for t, n in q.items() if weights[t]] for q in queries])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in asked.value]
        kind = None
        for batch in batches:
            for row in range(batch.num_rows):
                ids = batch.column(0)[row].values
                kind = ids.type
                place = _positions(batch.column(1)[row].as_py())
                starts, docs, impacts = (np.frombuffer(batch.column(c)[row].as_py(), t) for c, t in ((2, "<i4"), (3, "<u2"), (4, "<i4")))
                impacts = impacts.astype(np.int64)
                for query, held in zip(asked.value, best, strict=True):
                    scores = np.zeros(len(ids), np.int64)
                    for term, weight in query:
                        at = place.get(term)
                        if at is not None:
                            a, b = starts[at], starts[at + 1]
                            scores[docs[a:b]] += weight * impacts[a:b]  # a term names a document once
                    top = best_of(scores, k)
                    if len(held) == k:
                        top = top[scores[top] >= -held[-1][0]]
                    if len(top):
                        held += [(-int(scores[i]), v is None, v) for i, v in zip(top, ids.take(pa.array(top)).to_pylist(), strict=True)]
                        held.sort(key=lambda x: x[:2] if x[1] else x)
                        del held[k:]
        if kind is not None:
            rows = [(q, v, -s) for q, held in enumerate(best) for s, _, v in held]
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], kind), pa.array([r[2] for r in rows], pa.int64())], names=["query", "id", "score"])

    bounded_batches(index.shards.sparkSession)
    schema = StructType([StructField("query", IntegerType()), StructField("id", index.shards.schema["ids"].dataType.elementType), StructField("score", LongType())])
    return index.shards.mapInArrow(run, schema)


def search(index: Index, items: DataFrame, k: int = 10, item: str = "item_id", text: str = "text", id: str = "doc_id", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item, rank, id, score): the ``k`` best documents with a score above 0 of every row of ``items``.

    Equal scores go by ascending id, null ids last. Equal texts are searched for once and joined back, so repeated rows of
    ``items``, and null item ids, each get their ranks. Texts are taken whole; null ones and those without a term have no
    rows. The queries are dealt into blocks of about ``block_bytes`` of text, which are searched for one after the
    other, so what is broadcast is bounded whatever ``items`` holds. An empty index or table gives no rows.
    """
    spark, kind = index.shards.sparkSession, items.schema[item].dataType
    digest = F.sha2(F.coalesce(named(text).cast("string"), F.lit("")).cast("binary"), 256)
    asked = items.select(named(item).alias("item"), digest.alias("digest"), named(text).cast("string").alias("text"))
    texts = asked.groupBy("digest").agg(F.max("text").alias("text")).where("text is not null")
    blocks = max(1, -(-(texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // block_bytes))
    if blocks > 1:
        texts = kept(texts)
    found = None
    for block in range(blocks):
        rows = texts.where(F.pmod(F.xxhash64("digest"), F.lit(blocks)) == block).collect()  # about ``block_bytes``
        rows = [(r["digest"], c) for r in rows if (c := Counter(terms(r["text"])))]
        if rows:
            names = spark.createDataFrame([(k, d) for k, (d, _) in enumerate(rows)], "query int, digest string")
            hits = _search_block(index, [c for _, c in rows], k).join(F.broadcast(names), "query").drop("query")
            found = hits if found is None else found.unionByName(hits)
    if found is None:
        schema = StructType([StructField(item, kind), StructField("rank", IntegerType()), StructField(id, index.shards.schema["ids"].dataType.elementType), StructField("score", LongType())])
        return spark.createDataFrame([], schema)
    # a query's rows are as many as tasks times k: first the best of parts of them, then the best of all
    part = Window.partitionBy("digest", F.pmod(F.xxhash64("id", "score"), F.lit(64))).orderBy(*_order())
    found = found.withColumn("rank", F.row_number().over(part)).where(F.col("rank") <= k)
    found = found.withColumn("rank", F.row_number().over(Window.partitionBy("digest").orderBy(*_order()))).where(F.col("rank") <= k)
    return asked.select("item", "digest").join(found, "digest").select(F.col("item").alias(item), "rank", F.col("id").alias(id), "score")


def sql(k: int = 10) -> str:
    """The registered query in DuckDB SQL."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{TERM}')"
    return f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents),
c AS (SELECT count(*) FILTER (len(w) > 0) AS n, sum(len(w))::HUGEINT AS l FROM d),
postings AS (SELECT rid, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT rid, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * c.n + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM postings, c GROUP BY term, c.n),
asked AS (SELECT qid, item_id, term, count(*)::BIGINT AS times FROM (
  SELECT row_number() OVER () AS qid, item_id, unnest({words}) AS term FROM benchmark) GROUP BY ALL),
scores AS (
  SELECT qid, item_id, doc_id, rid,
    sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + ((75 * p.n * c.n) // c.l)))))::BIGINT AS score
  FROM asked JOIN postings p USING (term) JOIN weights USING (term), c GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= {k}"""
