"""What the training-data operators share: Arrow batches bounded in bytes, lineage cuts, skew-safe components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType, VariantType

from agorascope.session import cut

ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "string": pa.string(),
    "boolean": pa.bool_(),
    "binary": pa.binary(),
    "array<int>": pa.list_(pa.int32()),
    "array<struct<kind:string,start:int,end:int>>": pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])),
}

#: Bytes of an Arrow batch, and of the texts that an operator turns into Python objects at a time, one longer text aside.
BATCH_BYTES = 4 << 20


def named(column: str) -> Column:
    """The column of that very name, dots and all."""
    return F.col("`" + column.replace("`", "``") + "`")


def bounded_batches(spark: SparkSession) -> None:
    """Lower the session's bound of an Arrow batch in bytes, where it is higher: the JVM and the worker each hold a batch and
    its copies, for every core. It is a setting of the session, as the plan reads it only when it runs, and changes no result."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not 0 < int(spark.conf.get(key).rstrip("bB")) <= BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def slices(batch: pa.RecordBatch, most: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about ``most`` bytes of texts each, should the batch be larger after all."""
    sizes = np.ones(batch.num_rows, np.int64)
    for c in batch.columns:
        if pa.types.is_string(c.type) or pa.types.is_binary(c.type):
            sizes += pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False)
    part = (np.cumsum(sizes) - 1) // most
    edges = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), batch.num_rows]
    for a, b in zip(edges, edges[1:], strict=False):
        if b > a:
            yield batch.slice(a, b - a)


def map_batches(df: DataFrame, setup: Callable[[], Callable], schema: list[tuple[str, str]], carried: int = 1) -> DataFrame:
    """Arrow-batched map without a shuffle.

    The first ``carried`` columns go through as they are, of any type. ``setup()`` runs once a task and
    returns ``work(*columns)``, which takes the other columns of some rows as Python lists and returns
    ``(rows, lists)``: a dict of lists with the columns of ``schema``, and for each element the position
    of its row, or None for one element a row.
    """
    bounded_batches(df.sparkSession)
    names = [*df.columns[:carried], *(n for n, _ in schema)]
    kinds = [pa.field(n, ARROW[k]).type for n, k in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = setup()
        for whole in batches:
            for batch in slices(whole, BATCH_BYTES):
                rows, lists = work(*(c.to_pylist() for c in batch.columns[carried:]))
                kept = batch.columns[:carried]
                if rows is not None:
                    kept = [c.take(pa.array(rows, pa.int64())) for c in kept]
                yield pa.RecordBatch.from_arrays([*kept, *(pa.array(lists[n], k) for (n, _), k in zip(schema, kinds, strict=True))], names=names)

    made = StructType.fromDDL(", ".join(f"`{n}` {k}" for n, k in schema))
    return df.mapInArrow(run, StructType([*df.schema.fields[:carried], *made.fields]))


#: Columns of ``rows_apart``: all columns of the input as one, and what tells rows apart.
ROW, KEY = "row", ("id", "digest", "other")


def rows_apart(docs: DataFrame, id: str, text: str) -> DataFrame:
    """(row, id, digest, other, text): each whole row as a struct, so that no name clashes, beside a key of its contents.

    The key is the id of any type, the SHA-256 of the text, and a hash of all other columns but maps and
    variants. It is the same whenever a row is computed again. Rows that agree in all of it are copies.
    """
    def hashable(kind) -> bool:
        inner = [f.dataType for f in kind.fields] if isinstance(kind, StructType) else [kind.elementType] if hasattr(kind, "elementType") else []
        return not isinstance(kind, MapType | VariantType) and all(map(hashable, inner))

    others = [f.name for f in docs.schema.fields if f.name not in (id, text) and hashable(f.dataType)]
    row = F.struct(*[named(c).alias(c) for c in docs.columns]).alias(ROW)
    digest = F.unhex(F.sha2(named(text).cast("string").cast("binary"), 256))
    return docs.select(row, named(id).alias("id"), digest.alias("digest"), F.xxhash64(*map(named, others), F.lit(0)).alias("other"), named(text).cast("string").alias("text"))


def same_row(key: tuple[str, ...] = KEY) -> Column:
    """Null-safe equality of the key with the other side's, whose columns end in ``_``."""
    condition = F.lit(True)
    for k in key:
        condition &= F.col(k).eqNullSafe(F.col(f"{k}_"))
    return condition


def other_side(keys: DataFrame, key: tuple[str, ...] = KEY) -> DataFrame:
    return keys.select(*[F.col(k).alias(f"{k}_") for k in key])


def unpacked(rows: DataFrame) -> DataFrame:
    return rows.select(f"{ROW}.*")


def components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected link table: (node, component), smallest node first.

    Alternating large-star and small-star rounds: each node's neighbours are hung on the
    smallest node seen, until nothing changes. A hub's neighbourhood is only ever reduced by
    ``min`` (partial aggregation before the shuffle) and joined back (which adaptive execution
    can split), so no group is gathered in one task. Every round is cut to the shared folder.

    Only linked nodes are returned. Nulls and self-links are ignored; an empty table gives an
    empty table.
    """
    def tidy(pairs: DataFrame) -> DataFrame:
        return pairs.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()

    edges = cut(tidy(links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u is not null and v is not null")))
    state = _signature(edges)
    for _ in range(max_rounds):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        # large star: larger neighbours of u go to the smallest of its neighbourhood
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = tidy(large.unionByName(low.select("u", F.col("m").alias("v"))))
        # small star: smaller neighbours of u, and u, go to the smallest of them
        low = edges.groupBy("u").agg(F.min("v").alias("m"))
        small = edges.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = cut(tidy(small.unionByName(low.select("u", F.col("m").alias("v")))))
        before, state = state, _signature(edges)
        if before == state:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("component"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _signature(edges: DataFrame) -> tuple:
    """Count and order-free hash of the links; equal only when a round changed nothing."""
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return tuple(row)
