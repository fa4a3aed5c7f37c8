"""Session defaults for tests, benches and local runs.

On a cluster the session is the caller's: nothing here is applied to it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# Stored size up to which a result of `durable` is worth sending to every executor.
BROADCAST_BYTES = 4 << 20
BROADCAST_ROWS = 100_000
# Entries (about 100 bytes each) of nested rows up to which they are sent.
BROADCAST_ENTRIES = 200_000

# Stored bytes of cells to a partition in which they are sorted: about a million cells, which
# take some 170 MB in memory.
PARTITION_BYTES = 4 << 20
UNKNOWN_BYTES = 1 << 50     # what the planner assumes of a frame whose size it cannot tell lies above

_kept_until_exit: set[str] = set()


def local_session(cores: int | str = "*", *, app: str = "sheetloom",
                  shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        # call sites of every Column operation: costs more than planning does
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """This application's own folder for intermediate tables; removed when it ends.

    It lies in the checkpoint folder that the cluster names in ``spark.checkpoint.dir``.
    Without one, a local session uses its warehouse; a cluster is refused, as executors
    would each write to their own disk.
    """
    sc = spark.sparkContext
    named = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_intermediate"
        sc.setCheckpointDir(named)
    folder = f"{named.rstrip('/')}/sheetloom-{sc.applicationId}"
    if folder not in _kept_until_exit:
        path = sc._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _kept_until_exit.add(folder)
    return folder


def durable(df: DataFrame) -> DataFrame:
    """Store a result as a table in the shared folder and go on from there.

    That cuts the lineage, survives lost executors, and gives the planner the true
    size of the result to choose join strategies by.
    """
    folder = f"{shared_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _stored_bytes(df: DataFrame) -> int:
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def partitions_for(df: DataFrame) -> int:
    """Partitions over which to deal the rows of a stored table: as many as a shuffle has,
    more where the table is large, so that what a task sorts does not grow with it."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = _stored_bytes(df)
    return max(least, -(-size // PARTITION_BYTES)) if size < UNKNOWN_BYTES else least


def durable_in_buckets(df: DataFrame, *keys: str, buckets: int) -> DataFrame:
    """As :func:`durable`, dealt by ``keys`` over ``buckets``.

    A frame that is hashed by ``keys`` over as many partitions already is written as it lies;
    joins and aggregates by ``keys`` read the result without moving it.  The name that the
    session's catalogue needs for a bucketed table goes as soon as the table is bound; its
    files stay.
    """
    spark = df.sparkSession
    name = f"rows_{uuid.uuid4().hex}"
    df.write.bucketBy(buckets, *keys).option("path", f"{shared_folder(spark)}/{name}").saveAsTable(name)
    stored = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    return stored


def broadcast_if_small(df: DataFrame, sized_by: DataFrame) -> DataFrame:
    """Broadcast hint behind a size check.

    ``sized_by`` is a stored table that bounds ``df``: one row of it makes at most one
    short row of ``df``.  Files are smaller than rows in memory, so both its stored size
    and its rows are limited; beyond the limits the join is left to shuffle.
    """
    small = _stored_bytes(sized_by) <= BROADCAST_BYTES and sized_by.count() <= BROADCAST_ROWS
    return F.broadcast(df) if small else df


def broadcast_within(df: DataFrame, entries: Column, limit: int = BROADCAST_ENTRIES) -> DataFrame | None:
    """The frame with a broadcast hint if the entries of its rows, added up, stay within
    ``limit``; None if they do not.  It is the very frame sent that is measured."""
    total = df.agg(F.sum(entries)).first()[0] or 0
    return F.broadcast(df) if total <= limit else None
