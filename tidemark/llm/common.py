"""What the operators share: table reading, shared-folder tables, column helpers."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the ASCII space and the controls 9 to 13.
WORD_GAP = r"[\x20\x09-\x0D]+"
MAX_LONG = 2**63 - 1


#: The temporary folder of each local application without a shared one.
_own: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine (tests) a
    temporary one is set; a cluster without it is refused.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        master = spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _own:
            _own[app] = tempfile.mkdtemp(prefix="tidemark-")
            spark.sparkContext.setCheckpointDir(_own[app])
        found = _own[app]
    return found.rstrip("/")


#: Spark deletes the shuffle files of a query that has ended, where this is set.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def dropping_shuffles(spark: SparkSession):
    """Queries that are built and run inside leave no shuffle files behind; each must be run once only."""
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors.

    The table replaces the shuffle files of its making, which go as soon as it is written.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tidemark/{name}-{uuid.uuid4().hex}"
    with dropping_shuffles(spark):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete materialised tables that no one reads any more."""
    for df in tables:
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def as_struct(df: DataFrame) -> Column:
    """All columns of df as one struct, row, beside which new columns may have any name; ``row.*`` gives them back."""
    return F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("row")


def word_count(text: Column) -> Column:
    """Words of a text as a long; null and blank texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_GAP)
    blank_ends = (F.element_at(parts, 1) == "").cast("int") + ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")
    return (F.size(parts) - blank_ends).cast("long")


def hash52(*parts: Column | str) -> Column:
    """A hash of 52 bits that any SQL engine with md5 can repeat; exact as a double."""
    text = F.concat_ws(":", *[F.lit(p) if isinstance(p, str) else F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 13), 16, 10).cast("long")


def in_range(dividend: Column, divisor: int) -> Column:
    return F.pmod(dividend, F.lit(divisor)).cast("int")


def most_frequent(counts: DataFrame, key: str, times: str, bound: int, *more: str):
    """The keys with the largest counts, and more columns of them, as an Arrow table of at most bound rows.

    A histogram of the counts, in steps of a quarter of a power of two, gives the
    least count; so nothing is sorted, and a step that would not fit is left out whole.
    """
    level = F.floor(F.log2(times) * 4).cast("int")
    least, total = None, 0
    for at, n in sorted(counts.groupBy(level.alias("level")).count().collect(), reverse=True):
        if total + n > bound:
            break
        least, total = at, total + n
    return counts.filter(F.lit(False) if least is None else level >= least).select(key, times, *more).toArrow()
