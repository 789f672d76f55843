"""Importance resampling towards a target distribution, by hashed word n-grams.

DuckDB works on each Arrow batch inside its task: words are unnested, n-grams are made by a window over their places,
and a registered zlib CRC gives each its bucket. The bucket counts of each document, and their sums over each task, are
spilled to Parquet in the shared folder; Spark merges the sums of the documents and of the target, scores every
document from its stored counts, and draws those with the highest scores, to which a Gumbel term made from the id's
hash has been added. Texts are read once.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, ShortType, StructField, StructType

from agorascope.llm.common import bounded_batches, named, slices
from agorascope.session import cut, kept

#: A word is a longest run of these, A-Z lower-cased.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
BUCKETS = 10_000
#: Bytes of the texts, and words of one text, that a DuckDB statement looks at together.
BATCH_BYTES, SEGMENT_WORDS = 1 << 20, 200_000

WORDS = f"""
CREATE OR REPLACE TEMP TABLE texts AS
SELECT row, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), '{WORD}') AS words FROM given"""
#: Counts of the n-grams that begin in one segment of each text; its last ones reach into the next.
COUNTS = """
WITH placed AS (
  SELECT row, unnest(part) AS a, generate_subscripts(part, 1) AS place
  FROM (SELECT row, list_slice(words, $start + 1, $start + $size + 2) AS part FROM texts WHERE len(words) > $start)),
grams AS (
  SELECT row, place, a, lead(a, 1) OVER ordered AS b, lead(a, 2) OVER ordered AS c
  FROM placed WINDOW ordered AS (PARTITION BY row ORDER BY place)),
features AS (SELECT row, unnest([a, a || ' ' || b, a || ' ' || b || ' ' || c]) AS feature FROM grams WHERE place <= $size)
SELECT row, (crc(feature) % $buckets)::INTEGER AS bucket, count(*) AS n FROM features WHERE feature IS NOT NULL GROUP BY ALL"""


def crc(features: pa.Array) -> pa.Array:
    """Unsigned CRC-32 of each text's UTF-8 bytes."""
    if isinstance(features, pa.ChunkedArray):
        features = features.combine_chunks()
    offsets = np.frombuffer(features.buffers()[1], np.int32)[features.offset : features.offset + len(features) + 1].tolist()
    data, crc32 = features.buffers()[2].to_pybytes() if features.buffers()[2] else b"", zlib.crc32
    return pa.array([crc32(data[a:b]) for a, b in pairwise(offsets)], pa.uint32())


def connection():
    """A database in memory, with one thread as a task has one core, and the CRC."""
    import duckdb

    db = duckdb.connect(config={"threads": 1, "memory_limit": "1GB", "preserve_insertion_order": False})
    db.create_function("crc", crc, ["VARCHAR"], "UINTEGER", type="arrow")
    return db


def bucket_counts(db, texts: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Words of each text, and (row, bucket, n) ordered by row and bucket."""
    db.register("given", pa.table({"row": pa.array(np.arange(len(texts)), pa.int64()), "text": texts}))
    db.execute(WORDS)
    words = db.execute("SELECT len(words) AS n FROM texts ORDER BY row").fetchnumpy()["n"].astype(np.int64)
    keys, counts = [], []
    for start in range(0, int(words.max(initial=0)), SEGMENT_WORDS):
        found = db.execute(COUNTS, {"start": start, "size": SEGMENT_WORDS, "buckets": buckets}).fetchnumpy()
        keys.append(found["row"].astype(np.int64) * buckets + found["bucket"])
        counts.append(found["n"].astype(np.int64))
    key, place = np.unique(np.concatenate(keys or [np.zeros(0, np.int64)]), return_inverse=True)
    n = np.zeros(len(key), np.int64)
    np.add.at(n, place, np.concatenate(counts or [np.zeros(0, np.int64)]))
    return words, (key // buckets, key % buckets, n)


def spilled(rows: DataFrame, id: str, text: str, buckets: int = BUCKETS) -> DataFrame:
    """(id, n_words, n_features, buckets, counts) of every row, and beside them one row a task with ``sums``, in the shared folder."""
    bounded_batches(rows.sparkSession)
    names = ["id", "n_words", "n_features", "buckets", "counts", "sums"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        db, sums, kind = connection(), np.zeros(buckets, np.int64), pa.null()
        for whole in batches:
            kind = whole.schema.field(0).type
            for batch in slices(whole, BATCH_BYTES):
                words, (row, bucket, n) = bucket_counts(db, batch.column(1), buckets)
                np.add.at(sums, bucket, n)
                ends = np.searchsorted(row, np.arange(batch.num_rows + 1)).astype(np.int32)
                total = np.concatenate(([0], np.cumsum(n)))
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(v, t)) for v, t in ((bucket, pa.int16()), (n, pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(words), pa.array(total[ends[1:]] - total[ends[:-1]]), *lists, pa.nulls(batch.num_rows, pa.list_(pa.int64()))], names=names)
        if sums.any():
            none = [pa.nulls(1, t) for t in (kind, pa.int64(), pa.int64(), pa.list_(pa.int16()), pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*none, pa.array([sums.tolist()], pa.list_(pa.int64()))], names=names)

    given = rows.select(named(id).alias("id"), named(text).cast("string").alias("text"))
    kinds = [LongType(), LongType(), ArrayType(ShortType()), ArrayType(IntegerType()), ArrayType(LongType())]
    return kept(given.mapInArrow(run, StructType([StructField("id", given.schema["id"].dataType), *(StructField(n, k) for n, k in zip(names[1:], kinds, strict=True))])))


def merged(counts: DataFrame, name: str) -> DataFrame:
    """(bucket, ``name``): the sums of all tasks."""
    return counts.where("sums is not null").select(F.posexplode("sums").alias("bucket", "n")).groupBy("bucket").agg(F.sum("n").alias(name))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> Column:
    """The array of each bucket's gain, thousandths of the log odds of the target against the source, as a scalar subquery."""
    both = source.sparkSession.range(buckets).select(F.col("id").cast("int").alias("bucket")).join(merged(source, "s"), "bucket", "left").join(merged(target, "t"), "bucket", "left").na.fill(0, ["s", "t"])
    totals = both.agg(F.sum("s").alias("all_s"), F.sum("t").alias("all_t"))
    real = lambda c, more: F.col(c).cast("double") + more
    odds = real("t", 1) * real("all_s", buckets) / (real("s", 1) * real("all_t", buckets))
    gained = both.join(F.broadcast(totals)).select("bucket", F.floor(1000 * F.log(odds)).alias("gain"))  # totals: one row
    return gained.agg(F.transform(F.array_sort(F.collect_list(F.struct("bucket", "gain"))), lambda x: x["gain"])).scalar()  # ``buckets`` rows


def gumbel(id: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variable that follows from the id and the seed; a null id counts as an empty text."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def resample(
    docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, seed: int = 42, id: str = "doc_id", text: str = "text",
    target_text: str = "text", buckets: int = BUCKETS,
) -> DataFrame:
    """(id, n_features, weight, score, rank) of every row of ``docs``; the rows that are drawn have a rank, from 1.

    Features are all runs of one to three words of a whole text. Of the rows with ``least_words`` words, ``percent``
    in a hundred are drawn, the highest scores first, of equal ones the smaller id first, nulls last. Null and empty
    texts have no features, a weight of 0, and are never drawn. Repeated rows count, and are ranked, each by itself; ids
    may be of any type with an order; other columns are not read; an empty table gives an empty table, and an empty
    target weighs every bucket against what all have.
    """
    spark = docs.sparkSession
    counts = spilled(docs, id, text, buckets)
    gain = gains(counts, spilled(target.withColumn("_id", F.lit(0)), "_id", target_text, buckets), buckets)
    sums = F.zip_with("buckets", "counts", lambda b, n: n * F.get("gain", b.cast("int")))
    rows = counts.where("sums is null").select("id", "n_words", "n_features", "buckets", "counts", gain.alias("gain"))
    rows = rows.select("id", "n_words", "n_features", F.aggregate(sums, F.lit(0).cast("long"), lambda a, b: a + b).alias("weight"))
    rows = kept(rows.withColumn("score", F.col("weight") + gumbel(F.col("id"), seed)).withColumn("row", F.monotonically_increasing_id()))
    fit = F.col("n_words") >= least_words
    drawn = rows.where(fit).count() * percent // 100
    # ranges of the order, then the rank within a range and the rows of the ranges before; ``row`` parts what is equal
    order = [F.desc("score"), F.asc_nulls_last("id"), F.asc("row")]
    ranges = rows.where(fit).repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *order)
    ranges = cut(ranges.withColumn("range", F.spark_partition_id()))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    starts = ranges.groupBy("range").agg(F.count(F.lit(1)).alias("n")).select("range", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    place = F.col("first") + F.row_number().over(Window.partitionBy("range").orderBy(*order))
    ranked = ranges.join(F.broadcast(starts), "range").withColumn("rank", F.when(place <= drawn, place))
    out = ranked.unionByName(rows.where(~fit), allowMissingColumns=True)
    return out.select(F.col("id").alias(id), "n_features", "weight", "score", "rank")
