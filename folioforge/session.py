"""Session settings and lineage cuts."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Spark's own switch: shuffle files go when the query that wrote them has ended.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("folioforge")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        # small inputs still get work for every core
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.files.openCostInBytes", "256k")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Folder of this process where the session names none, and the tables written so far.
_own_folder: list[str] = []
_tables: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession, folder: str | None = None) -> str:
    """The folder for intermediate tables.

    `folder` if given, else the session's `spark.checkpoint.dir`, else what
    `setCheckpointDir` has set, else a temporary folder of this process, which is refused
    when executors run on other machines.
    """
    named = folder or spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _own_folder:
        _own_folder.append(tempfile.mkdtemp(prefix="folioforge-"))
    return _own_folder[0]


def cut_lineage(rows: DataFrame, folder: str | None = None) -> DataFrame:
    """Write `rows` as a table in the shared folder and read on from there.

    For a result that feeds several passes: later passes read only the columns
    they need, and a lost executor costs no more than its own tasks. Shuffle files
    behind the table are dropped once it is written; the table itself stays until
    `drop_tables` or the end of the process.
    """
    path = new_folder(rows.sparkSession, folder)
    write_table(rows, path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def new_folder(spark: SparkSession, folder: str | None = None) -> str:
    """A path in the shared folder that nothing uses; what is written there goes as `cut_lineage`'s tables do."""
    path = f"{shared_folder(spark, folder)}/table-{uuid.uuid4().hex}"
    _tables.append((spark, path))
    return path


def write_table(rows: DataFrame, path: str) -> None:
    """Write `rows` as Parquet to `path`, in small files; the shuffle files behind them go once that is done."""
    conf = rows.sparkSession.conf
    before = conf.get(_CLEANUP, "false")
    conf.set(_CLEANUP, "true")
    try:
        rows.write.parquet(path, compression="zstd")
    finally:
        conf.set(_CLEANUP, before)


def drop_table(rows: DataFrame) -> None:
    """Delete the table behind a result of `cut_lineage` that nothing reads any more."""
    places = {part for file in rows.inputFiles() for part in file.split("/") if part.startswith("table-")}
    _drop([entry for entry in _tables if entry[1].rsplit("/", 1)[1] in places])


def drop_tables(spark: SparkSession) -> None:
    """Delete every table that `cut_lineage` has written in this process.

    Call it when the results that read them have been written or collected.
    """
    _drop([entry for entry in _tables if entry[0] is spark])


def _drop(entries: list[tuple[SparkSession, str]]) -> None:
    for spark, path in entries:
        jvm = spark.sparkContext._jvm
        place = jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        _tables.remove((spark, path))


@atexit.register
def _at_exit() -> None:
    """Tables go with the process; a session that has stopped before leaves its own."""
    for entry in list(_tables):
        if entry[0].sparkContext._jsc is not None:
            with contextlib.suppress(Exception):
                _drop([entry])
