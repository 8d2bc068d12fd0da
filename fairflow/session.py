"""Session settings, the shared staging folder and what lives there for how long."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, field
from pathlib import Path
from threading import Lock

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F

CHECKPOINT_DIR = "spark.checkpoint.dir"


def build_session(app: str = "fairflow", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for: UTC, AQE with
    skew-join splitting, ANSI arithmetic.  On a cluster leave ``master`` unset and
    let spark-submit decide; shuffle partitions stay at the cluster's setting."""
    builder = SparkSession.builder.appName(app)
    if master is not None:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    ship_package(spark)
    return spark


_SHIPPING = Lock()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which import the functions that run in tasks.

    `build_session` does it; call it once for a session started elsewhere, unless the package is installed on every machine.
    """
    context, package = spark.sparkContext, Path(__file__).resolve().parent
    with _SHIPPING:
        if getattr(context, "_shipped", None) == str(package) or not package.is_dir():
            return
        archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"  # read by the driver's own file server
        with zipfile.ZipFile(archive, "w", zipfile.ZIP_DEFLATED) as out:
            for source in sorted(package.rglob("*.py")):
                out.write(source, source.relative_to(package.parent))
        context.addPyFile(str(archive))
        context._shipped = str(package)


def _is_local(spark: SparkSession) -> bool:
    """One JVM; ``local-cluster`` has executors of its own and counts as a cluster."""
    return re.match(r"local($|\[)", spark.sparkContext.master) is not None


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a
    machine-local path would be lost with its machine, so a missing setting is an
    error there.
    """
    context = spark.sparkContext
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if context.getCheckpointDir() is None:
        if not root and not _is_local(spark):
            raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder shared by all executors")
        context.setCheckpointDir(root or tempfile.mkdtemp(prefix="run-"))
    return root or context.getCheckpointDir()


def _files(spark: SparkSession, path: str):
    """The file system of a path and the path for it."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


@dataclass
class Scope:
    """The scratch folders made while a ``staging_scope`` is open."""
    spark: SparkSession
    paths: list[str] = field(default_factory=list)

    def drop(self, *keep: DataFrame) -> None:
        """Delete every folder of this scope that none of the frames to keep reads."""
        read = "\n".join(_plan_text(df) for df in keep)
        for path in [p for p in self.paths if p.rsplit("/", 1)[1] not in read]:
            fs, hadoop = _files(self.spark, path)
            fs.delete(hadoop, True)
            fs.cancelDeleteOnExit(hadoop)
            self.paths.remove(path)


_SCOPES: list[Scope] = []
_WIDE = "spark.sql.maxMetadataStringLength"


def _plan_text(df: DataFrame) -> str:
    """The physical plan with the folders it reads, those of subqueries included."""
    spark = df.sparkSession
    before = spark.conf.get(_WIDE)
    spark.conf.set(_WIDE, str(1 << 30))
    try:
        mode = spark.sparkContext._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        # A plan of its own: one that was already made keeps its shortened texts.
        return df.select("*")._jdf.queryExecution().explainString(mode)
    finally:
        spark.conf.set(_WIDE, before)


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[Scope]:
    """What is staged inside can be dropped step by step: ``scope.drop(frame)`` deletes all that the frame
    does not read.  What is left belongs to the enclosing scope, or goes with the session; after an error
    everything of the scope goes at once."""
    scope = Scope(spark)
    _SCOPES.append(scope)
    try:
        yield scope
    except BaseException:
        _SCOPES.remove(scope)
        scope.drop()
        raise
    _SCOPES.remove(scope)
    if _SCOPES:
        _SCOPES[-1].paths += scope.paths


@contextmanager
def reused(df: DataFrame, level: StorageLevel = StorageLevel.MEMORY_AND_DISK) -> Iterator[DataFrame]:
    """A small result that several actions read: kept in memory while the block lasts, computed once.

    Blocks lost with an executor are computed again from the lineage.  For results that outlive the block, or
    are not small, use `stage`.
    """
    kept = df.persist(level)
    try:
        yield kept
    finally:
        kept.unpersist()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder; never reused, so concurrent runs do not collide.

    What is written there goes when an open ``staging_scope`` drops it, or when the session's JVM ends.
    """
    path = f"{staging_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    fs, hadoop = _files(spark, path)
    fs.deleteOnExit(hadoop)
    if _SCOPES:
        _SCOPES[-1].paths.append(path)
    return path


def _write(df: DataFrame, partition_by: Sequence[str] = (), **options: str) -> tuple[DataFrame, str]:
    path = scratch_path(df.sparkSession, "stage")
    df.write.options(**options).partitionBy(*partition_by).parquet(path)
    written = df.sparkSession.read.schema(df.schema).parquet(path).select(*[F.col(f"`{c}`") for c in df.columns])
    return written, path


def stage(df: DataFrame, partition_by: Sequence[str] = ()) -> DataFrame:
    """Cut the lineage: write the rows as Parquet in the shared folder and read them back.

    The rows are computed once, survive lost executors, and keep any partition id column that
    was computed before the cut.  Later scans read only the columns and, with ``partition_by``,
    only the partitions they need.
    """
    return _write(df, partition_by)[0]


# Rows that a task of `spread` has at least and at most, about.
FEW_ROWS, MANY_ROWS = 1 << 10, 1 << 17


def spread(df: DataFrame, few: int = FEW_ROWS, many: int = MANY_ROWS) -> DataFrame:
    """Deal rows for work that takes long per row, as growing a forest does: over every core, in parts that stay bounded.

    Files are packed into tasks by their bytes, so a million narrow rows may fill a single one.  Counts the rows, which for
    a staged frame is in the footers.
    """
    rows, cores = df.count(), df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(1, min(cores, rows // few), -(-rows // many)))


MAX_ROWS, MAX_BYTES = 1_000_000, 64 << 20


def _within(spark: SparkSession, path: str, max_rows: int, max_bytes: int) -> bool:
    """Whether the Parquet files of a folder hold no more rows and bytes, as their footers say.

    Stops at the first file past a bound; no row is read.
    """
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    fs, hadoop = _files(spark, path)
    files = [f for f in fs.listStatus(hadoop) if f.getPath().getName().endswith(".parquet")]
    if sum(f.getLen() for f in files) > max_bytes:
        return False
    rows = size = 0
    for file in files:
        reader = jvm.org.apache.parquet.hadoop.ParquetFileReader.open(
            jvm.org.apache.parquet.hadoop.util.HadoopInputFile.fromStatus(file, conf))
        try:
            blocks = reader.getRowGroups()
            rows += reader.getRecordCount()
            size += sum(blocks.get(k).getTotalByteSize() for k in range(blocks.size()))
        finally:
            reader.close()
        if rows > max_rows or size > max_bytes:
            return False
    return True


# Without dictionaries a footer's sizes are those of the values themselves.
_PLAIN = {"parquet.enable.dictionary": "false"}


def size_checked(df: DataFrame, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Stage a derived dimension and mark it for broadcast only when it is small.

    Spark's own estimate for an aggregate is that of its input, so a join with a
    tiny aggregate of a huge table would shuffle the huge side.  Rows and bytes come from the footers of
    the staged files, without another job.  Past either bound the
    frame is marked for a sort-merge join instead, whose skewed partitions Spark
    splits at run time; without that mark the estimate, which knows nothing of
    exploded rows, could still pick a broadcast.
    """
    staged, path = _write(df, **_PLAIN)
    return F.broadcast(staged) if _within(df.sparkSession, path, max_rows, max_bytes) else staged.hint("merge")


FILTER_BITS = 1 << 26


def _with_match(df: DataFrame, side: DataFrame, keys: Sequence[str], bits: int, how: str) -> DataFrame:
    """``df`` with ``_may``: whether its keys may occur in ``side``."""
    slot = F.pmod(F.xxhash64(*keys), F.lit(bits)) + 1  # bitmaps number their bits from 1
    held = side.select(slot.alias("_slot")).groupBy(F.bitmap_bucket_number("_slot").alias("_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("_slot")).alias("_bitmap"))
    known = F.lit(True)
    for key in keys:
        known = known & F.col(key).isNotNull()
    place = F.bitmap_bit_position("_slot")
    byte = F.conv(F.hex(F.substring("_bitmap", (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    may = known & F.coalesce(F.getbit(byte, (place % 8).cast("int")) == 1, F.lit(False))
    return (df.withColumn("_slot", slot).withColumn("_bucket", F.bitmap_bucket_number("_slot"))
            .join(F.broadcast(held), "_bucket", how).withColumn("_may", may))


def may_match(df: DataFrame, side: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """The rows of ``df`` whose keys may occur in ``side``: a Bloom filter with one hash, held as bitmaps.

    What is broadcast has a fixed bound, an eighth of ``bits`` in bytes, however many keys there are; the more there are,
    the less is filtered.  NULL keys match nothing.
    """
    return _with_match(df, side, keys, bits, "inner").filter("_may").select(*[F.col(f"`{c}`") for c in df.columns])


def split_matches(df: DataFrame, side: DataFrame, keys: Sequence[str], bits: int = FILTER_BITS) -> tuple[DataFrame, DataFrame]:
    """The rows that `may_match`, and those that surely do not: only the first need a shuffle to be joined."""
    marked, columns = _with_match(df, side, keys, bits, "left"), [F.col(f"`{c}`") for c in df.columns]
    return marked.filter("_may").select(*columns), marked.filter("NOT _may").select(*columns)


def join_checked(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str = "inner", max_rows: int = MAX_ROWS,
                 max_bytes: int = MAX_BYTES) -> DataFrame:
    """Join a large frame with a derived side, of which only the columns given are staged.

    Within the bounds the side is broadcast.  Beyond, both are shuffled for a sort-merge join; in an inner join the rows
    of the large frame whose keys the side does not have go first.
    """
    staged, path = _write(side, **_PLAIN)
    if _within(df.sparkSession, path, max_rows, max_bytes):
        return df.join(F.broadcast(staged), list(keys), how)
    if how == "inner":
        df = may_match(df, staged, keys)
    return df.join(staged.hint("merge"), list(keys), how)
