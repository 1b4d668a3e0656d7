"""What the text operators share: reading tables, lower-casing A-Z, and cutting lineage in the shared folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: str.translate table for the same.
LOWER_AZ = {ord(a): b for a, b in zip(UPPER, LOWER)}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_az(c: Column) -> Column:
    """Lower-case A-Z and nothing else."""
    return F.translate(c, UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, of spark.checkpoint.dir.

    Only where the session names none and runs in one process (local mode, as in tests) a temporary one is made; on a
    cluster that is an error, since no other machine could read it.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        made = spark.sparkContext._jsc.sc().getCheckpointDir()
        if made.isDefined():
            return made.get()
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="tessera-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, what: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: the lineage ends in files that outlive any executor."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def forget(*dfs: DataFrame) -> None:
    """Delete the files of tables from written() that nothing reads any more."""
    for df in dfs:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df.written_to)
        path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)


BITMAP_WORDS = 1 << 14


def bitmap(keys: DataFrame, key: str, words: int = BITMAP_WORDS) -> Column:
    """A scalar subquery: 64 * words bits (128 KB, whatever keys holds) with those of the keys' hashes set.

    With maybe() it drops most rows that a later join would drop; the join itself stays, so more keys only drop less.
    """
    h = F.pmod(F.col(key), F.lit(64 * words))
    set_ = keys.select(F.shiftright(h, 6).cast("long").alias("w"), F.expr(f"shiftleft(1L, cast(pmod({key}, 64) as int))").alias("b"))
    set_ = set_.groupBy("w").agg(F.bit_or("b").alias("b"))
    every = keys.sparkSession.range(words).withColumnRenamed("id", "w").join(set_, "w", "left")
    rows = every.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("rows"))
    return rows.select(F.transform("rows", lambda r: r["b"]).alias("bits")).scalar()


def maybe(bits: Column, key: Column, words: int = BITMAP_WORDS) -> Column:
    """False only if key's bit isn't set."""
    at = F.pmod(key, F.lit(64 * words))
    word = F.get(bits, F.shiftright(at, 6).cast("int"))
    return F.getbit(word, F.pmod(key, F.lit(64)).cast("int")) == 1
