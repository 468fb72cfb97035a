"""Session defaults, shared staging space and size checks."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# UTC keeps wall-clock timestamps stable; the adaptive settings coalesce small
# shuffle partitions and split skewed ones at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "snappy",
}


def build_session(app_name: str = "orelayer", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the library defaults; keyword names use ``__`` for dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {**DEFAULTS, **{k.replace("__", "."): str(v) for k, v in conf.items()}}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_LOCAL_DIRS: dict[str, str] = {}  # application id -> folder, local sessions only


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    A machine-local folder is only chosen when the whole session runs on one
    machine and nothing was configured, which is the case in tests.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    if context.applicationId not in _LOCAL_DIRS:
        _LOCAL_DIRS[context.applicationId] = tempfile.mkdtemp(prefix="orelayer-")
    return _LOCAL_DIRS[context.applicationId]


class Workspace:
    """A private folder below the shared one for tables written mid-pipeline.

    Writing a table cuts the lineage, survives the loss of executors, lets
    later steps read only the columns and partitions they need, and gives the
    optimizer the true size of the data. The folder goes when the ``with``
    block ends, or with the process for results that are read later.
    """

    def __init__(self, spark: SparkSession, label: str = "work"):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
        self._where = _fs(spark, self.root)
        _OPEN.add(self)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def stage(self, df: DataFrame, name: str, partition_by: Sequence[str] = ()) -> DataFrame:
        """Write ``df`` once and return the written table."""
        target = self.path(name)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(target)
        return self.spark.read.schema(df.schema).parquet(target)

    def drop(self) -> None:
        fs, jpath = self._where
        if fs.exists(jpath):
            fs.delete(jpath, True)
        _OPEN.discard(self)

    def __enter__(self) -> "Workspace":
        return self

    def __exit__(self, *exc) -> None:
        self.drop()


_OPEN: set[Workspace] = set()


@atexit.register
def _drop_open() -> None:
    for workspace in list(_OPEN):
        try:
            workspace.drop()
        except Exception:  # the JVM is gone: nothing more can be done here
            return


def _fs(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def is_dir(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath) and fs.getFileStatus(jpath).isDirectory()


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below a folder, sorted; empty when it does not exist."""
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath))


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Rename within one file system; False when the target is there already."""
    fs, jpath = _fs(spark, source)
    goal = spark._jvm.org.apache.hadoop.fs.Path(target)
    fs.mkdirs(goal.getParent())
    return False if fs.exists(goal) else bool(fs.rename(jpath, goal))


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file with a text; False if there is one already, whoever made it."""
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath.getParent())
    try:
        out = fs.create(jpath, False)
    except Py4JJavaError as error:
        if fs.exists(jpath):
            return False
        raise error
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def make_dir(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.mkdirs(jpath)


def delete(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    if fs.exists(jpath):
        fs.delete(jpath, True)


def observed(seen: Observation, *names: str) -> list[int]:
    """Counts that were observed while rows were written. A plan that turns out to be empty at run
    time is replaced as a whole, its counts with it: then all of them are 0."""
    try:
        found = seen.get
    except Py4JJavaError:
        return [0 for _ in names]
    return [found[n] or 0 for n in names]


def has_shuffle(df: DataFrame) -> bool:
    """Whether the plan moves rows, so that their order may change when a task
    is repeated. Rows straight from files keep their order."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's estimate of the size of ``df``, no bound; runs no job."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def broadcast_limit(spark: SparkSession) -> int:
    """The session's limit in bytes, in any unit that Spark accepts; -1 turns broadcasts off."""
    raw = str(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760"))
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(raw)) if raw.strip() != "-1" else -1


def fits_broadcast(df: DataFrame) -> bool:
    """True when ``df`` is proven to take no more than the session's broadcast limit.

    The optimizer's estimate starts from compressed files and is no bound: it only rules out what
    is too large already. What is left is measured, by reading one row more than the limit could
    hold at most: its rows times their fixed width, and the real bytes of its texts and nested
    values.
    """
    limit = broadcast_limit(df.sparkSession)
    if limit <= 0 or estimated_bytes(df) > limit:
        return False
    fixed = 8 * (len(df.columns) + 1)
    most = limit // fixed
    sizes = [F.lit(0)]
    for f in df.schema.fields:
        c = F.col(quoted(f.name))
        if isinstance(f.dataType, T.AtomicType):
            if isinstance(f.dataType, (T.StringType, T.BinaryType)):
                sizes.append(F.coalesce(F.octet_length(c), F.lit(0)))
        else:
            sizes.append(F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0)))
    row = df.select(sum(sizes[1:], sizes[0]).cast("bigint").alias("b")).limit(most + 1).agg(F.count("*"), F.sum("b")).first()
    return row[0] <= most and row[0] * fixed + (row[1] or 0) <= limit


def quoted(name: str) -> str:
    """A column's name as Spark reads it, dots and ticks included."""
    return "`" + name.replace("`", "``") + "`"


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """Broadcast hint only behind the measured size; otherwise left to the optimizer."""
    return F.broadcast(df) if fits_broadcast(df) else df
