"""Session settings that every query of the package assumes, and reading and cutting of tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table of fewer bytes than this may lie in one row group, which one task reads; it is dealt over all cores instead.
SMALL = 64 << 20


def session(app: str = "agorascope", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; ``conf`` wins over the defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
        "spark.ui.showConsoleProgress": "false",
    }
    return builder.config(map=defaults | conf).getOrCreate()


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """One table of a data folder. The path goes to Spark's reader unopened, so any store works."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def read_texts(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """As ``read``, for tables whose rows are costly to work on: one of fewer than ``SMALL`` bytes, whose size is
    asked of the store, is dealt over the cores; larger ones have row groups enough and are never shuffled."""
    rows = read(spark, sf_dir, table)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{sf_dir}/{table}.parquet")
    size = files.agg(F.sum("length")).first()[0] or 0  # lists the files without reading them
    return rows.repartition(spark.sparkContext.defaultParallelism) if size < SMALL else rows


def shared_folder(spark: SparkSession) -> str:
    """The session's reliable folder, which the cluster names in spark.checkpoint.dir.

    Only on a local master, where there are no other machines, one is made if none is named.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and not sc.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there: it is computed once however often it is used, and a lost
    executor repeats nothing before."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def kept(df: DataFrame) -> DataFrame:
    """As ``cut``, but as Parquet in the shared folder, so that each use reads only its columns and rows. ``forget`` removes it."""
    path = f"{shared_folder(df.sparkSession)}/{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _place(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _place(spark, path)
    return files.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder and what is in it, in any store that Spark writes to."""
    files, place = _place(spark, path)
    files.delete(place, True)


def put_in_place(spark: SparkSession, source: str, target: str) -> None:
    """Move a folder to where another may be, which is removed. No file is read or written again."""
    files, place = _place(spark, target)
    files.delete(place, True)
    files.mkdirs(place.getParent())
    if not files.rename(spark._jvm.org.apache.hadoop.fs.Path(source), place):
        raise OSError(f"{source} can't be moved to {target}")


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    files, place = _place(spark, path)
    return sorted(f.getPath().getName() for f in files.listStatus(place)) if files.exists(place) else []


def forget(*tables: DataFrame) -> None:
    """Remove what ``kept`` has written; the tables and what was made of them can't be read any more."""
    for table in tables:
        spark = table.sparkSession
        folder = shared_folder(spark)
        for path in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if path.split(":", 1)[-1].lstrip("/").startswith(folder.split(":", 1)[-1].lstrip("/")):
                remove(spark, path)
