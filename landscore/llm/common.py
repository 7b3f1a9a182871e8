"""What the text operators share: staged tables, size-checked broadcasts, row keys, folding of case."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A table is broadcast only if its counted rows are at most this many, and its files at most so many bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 50_000, 16 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_staged: list[tuple[SparkSession, str]] = []


def fresh(columns: Iterable[str], *names: str) -> list[str]:
    """The names, with underscores in front until none is that of a column (names that differ in case only are the same)."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def shared_root(spark: SparkSession) -> str:
    """The folder that the driver and all executors share. Only a session whose executors are the driver's own process, and
    that names none, gets a temporary one: on a cluster each machine would write to its own disk."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    sc = spark.sparkContext
    held = sc._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not sc.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    own = "file://" + tempfile.mkdtemp(prefix="staged-")
    sc.setCheckpointDir(own)
    return own


def hadoop_path(spark: SparkSession, path: str):
    """(file system, path) of Hadoop for a path of any scheme."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _clear() -> None:
    while _staged:
        spark, path = _staged.pop()
        try:
            fs, p = hadoop_path(spark, path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001  the session has ended; the folder is the cluster's to clean
            return


atexit.register(_clear)


def new_folder(spark: SparkSession, name: str) -> str:
    path = f"{shared_root(spark)}/staged/{name}-{uuid.uuid4().hex}"
    _staged.append((spark, path))
    return path


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there, so a lost executor costs no more than
    a read, and its size is known to the planner."""
    path = new_folder(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    fs, p = hadoop_path(df.sparkSession, path)
    if not any(s.getPath().getName().startswith("part-") for s in fs.listStatus(p)):
        raise FileNotFoundError(f"{path} holds no part file: the executors don't write where the driver reads")
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def unstage(df: DataFrame) -> None:
    """Delete a staged table that nothing will read again."""
    fs, p = hadoop_path(df.sparkSession, df._folder)
    fs.delete(p, True)


def sized(df: DataFrame, rows: int = BROADCAST_ROWS, most_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The staged table, marked for broadcast if the planner's size of it (of its files) and its counted rows are at most so
    many; else Spark joins it by a shuffle."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return F.broadcast(df) if size <= most_bytes and df.limit(rows + 1).count() <= rows else df


def folded(text: Column) -> Column:
    """A-Z in lower case and nothing else. Where there are only ASCII bytes, lower() is the same and faster."""
    ascii_only = F.octet_length(text) == F.char_length(text)
    return F.when(ascii_only, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def row_key(doc_id: Column, text: Column) -> tuple[Column, Column]:
    """Two columns that tell documents apart, whole rows repeated or not, without nulls: rows that share an id are
    separate documents if their texts differ."""
    return F.coalesce(doc_id.cast("long"), F.lit(-(2**63))), F.xxhash64(doc_id, text)
