"""What the text operators share: table access, the shared work folder, importability on executors."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words: space and \t \n \v \f \r. ``bytes.split()`` cuts at exactly these.
WORD = r"[^\x20\x09-\x0D]+"

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the data folder; the path may be in any store that Spark reads."""
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed but on a path they share."""
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if _ROOT not in have.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (_ROOT, have) if x)


#: Bytes of the batches that Python workers get, unless the session has a limit of its own. A batch is held
#: several times over: by the buffers that the JVM doubles to fill it, and by the worker.
ARROW_BYTES = 4 << 20
_ARROW_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def _lean(run, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    yield from run(batches)
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def in_arrow(df: DataFrame, run, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of about ``ARROW_BYTES``; at a task's end its worker, which waits for others,
    gives back what it no longer uses. The limit stays set in the session, as the result may run at any time."""
    conf = df.sparkSession.conf
    if conf.get(_ARROW_LIMIT, None) is None:
        conf.set(_ARROW_LIMIT, str(ARROW_BYTES))
    return df.mapInArrow(partial(_lean, run), schema)


def from_arrays(spark: SparkSession, **columns) -> DataFrame:
    """A small table of numpy arrays. Rows of Python would be unpickled by Python workers of executors, which have a
    daemon of their own and stay."""
    return spark.createDataFrame(pa.table(columns))


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``. Where that is unset, a local session (tests) has one
    of its own; on a cluster there is no folder that all could see, so that is an error."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "sigloom-checkpoints")
    return f"{base.rstrip('/')}/{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again: its lineage ends there, and
    every executor and the driver can read it after any of them is lost."""
    spark = df.sparkSession
    path = work_folder(spark)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Keys with over one in so many of all rows are joined by broadcast; there are at most as many of them.
HOT_KEYS = 10_000


def join_hot(rows: DataFrame, keyed: DataFrame, key: str, total: int, keys: int = HOT_KEYS) -> DataFrame:
    """``rows`` joined with ``keyed(key, n, ...)``, which says how many of the ``total`` rows have each key.
    No key that is dealt out has over ``total / keys`` rows, and no more than ``keys`` are broadcast."""
    hot = F.col("n") * keys > total
    often, seldom = F.broadcast(keyed.where(hot)), keyed.where(~hot)
    rest = rows.join(F.broadcast(keyed.where(hot).select(key)), key, "left_anti")
    return rows.join(often, key).unionByName(rest.join(seldom.hint("merge"), key))


def discard(spark: SparkSession, df: DataFrame) -> None:
    """Remove the files of a ``stored`` table that no later plan reads."""
    jvm = spark.sparkContext._jvm
    for name in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def quoted(name: str):
    """A column by its name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def text_of(name: str = "text"):
    """The text column with null read as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit("")).alias("text")
