"""Where intermediate tables are written, and how a frame is cut from its lineage."""

import atexit
import gc
import shutil
import tempfile
import threading
import time
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Rows of one file of vectors, or of rows that are turned to vectors as they are read.
VECTORS_PER_FILE = 25_000
_DIR_SETTING = "spark.checkpoint.dir"
#: Bytes of a generated method above which the JVM does not compile it: a wide projection is then interpreted, row by row.
_METHOD_SETTING, _METHOD_BYTES = "spark.sql.codegen.hugeMethodLimit", "8000"
_local_roots: dict[str, str] = {}
_lock = threading.Lock()
_small_methods: dict[int, list] = {}
_made: ContextVar[list | None] = ContextVar("made", default=None)


def staging_root(spark: SparkSession) -> str:
    """Shared folder named by the cluster.

    Only a local session without that setting gets a folder of its own; on a cluster a
    machine's own folder would not be seen by the other machines.
    """
    root = spark.conf.get(_DIR_SETTING, None)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_DIR_SETTING} to a folder that all machines share")
    if context.applicationId not in _local_roots:
        root = _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="lendframe-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    return _local_roots[context.applicationId]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{staging_root(spark)}/{name}-{uuid.uuid4().hex}"


def discard(df: DataFrame) -> None:
    """Delete the files of a frame that ``staged`` returned, when nothing reads it any more."""
    path = getattr(df, "staged_path", None)
    if path:
        jvm = df.sparkSession._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


@contextmanager
def small_methods(spark: SparkSession):
    """What runs inside, in any thread, evaluates the expressions of a stage by methods of their own where the stage's one
    method would be too large for the JVM to compile. The session's setting is put back when the last one leaves."""
    session = spark._jsparkSession.hashCode()
    with _lock:
        held = _small_methods.setdefault(session, [0, spark.conf.get(_METHOD_SETTING, None)])
        held[0] += 1
        # a session's own setting stays
        if held[1] is None:
            spark.conf.set(_METHOD_SETTING, _METHOD_BYTES)
    try:
        yield
    finally:
        with _lock:
            held[0] -= 1
            if not held[0]:
                del _small_methods[session]
                if held[1] is None:
                    spark.conf.unset(_METHOD_SETTING)


def release(spark: SparkSession) -> None:
    """Have the shuffle files deleted that no frame can read any more. Spark does so as the driver's garbage is collected, by itself
    every half hour; until then all steps of a long job lie on disk together."""
    # the first round lets go of frames, the second of what they held
    for _ in range(2):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.3)


def staged(df: DataFrame, name: str, partition_by: list[str] | None = None, rows_per_file: int | None = None) -> DataFrame:
    """Write ``df`` as Parquet to the shared folder and read it back.

    Preferred over ``checkpoint()`` because later passes read only the columns they
    need. The files outlive the executors that wrote them. ``rows_per_file`` bounds the rows of
    a task that reads them, however well they are compressed: Spark reckons each file at 4 MB or more of a task's 128.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    writer = df.write.mode("errorifexists")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with small_methods(spark):
        writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_path = path
    if (made := _made.get()) is not None:
        made.append(back)
    return back


@contextmanager
def temporary():
    """Tables that ``staged`` writes inside are deleted at the end: for work whose result is written inside too."""
    made: list = []
    before = _made.set(made)
    try:
        yield
    finally:
        _made.reset(before)
        for df in made:
            discard(df)
