"""What the operators share: where intermediate tables go, and how texts are cut into words."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import uuid
import weakref

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

_written: dict[str, weakref.ref] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, everything else as it is; null is empty."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor sees: spark.checkpoint.dir, or the warehouse where that is unset."""
    folder = spark.conf.get("spark.checkpoint.dir", "") or spark.conf.get("spark.sql.warehouse.dir")
    return folder.rstrip("/")


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a table in the shared folder, read back: computed once, safe from lost executors.

    The files stay until `forget` is called or the interpreter ends, because frames made from
    the result are lazy and still read them.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{label}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    back = spark.read.schema(schema).parquet(path)
    _written[path] = weakref.ref(spark)
    back._llm_path = path
    return back


def forget(df: DataFrame) -> None:
    """Delete the files behind a frame that `written` gave."""
    path = df._llm_path
    if _written.pop(path, None) is not None:
        _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


@atexit.register
def _forget_all() -> None:
    for path, ref in list(_written.items()):
        spark = ref()
        try:
            if spark is not None and spark._jsc is not None and not spark._jsc.sc().isStopped():
                _delete(spark, path)
        except Exception:  # noqa: BLE001  the session may be gone by now; the folder then stays
            return


#: Rows of an Arrow batch of texts: texts are long, and a batch is held several times over.
BATCH_ROWS = 1000


def small_batches() -> None:
    """Lower the session's Arrow batches to BATCH_ROWS rows, so that they fit small executors.

    Spark reads the setting when a query starts, so it stays for the session.
    """
    spark = SparkSession.active()
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Return freed memory to the system at the end of a task's texts.

    Python workers are used again by the operators that follow, and would else keep it.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # a C library without it
        ctypes.CDLL(None).malloc_trim(0)


def cores(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
