"""Tables replaced in one step: versions in folders of their own, and a pointer to the present one.

Below a table's folder lie ``_versions/<id>/``, one folder per version, and ``_versions/current``, a file with the
ids of the present version and the one before.  A replacement writes a hidden folder, renames it to the new version and then renames a new
pointer over the old one; until that moment, and for good if the write fails, readers resolve the old
version.  The version before stays for readers that have resolved it and goes with the next replacement.  A table
without a pointer is a plain folder, as other tools write it, and so is a new table, which is renamed into place as a whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

_PLAIN = "-"  # the version that is the table's own folder


def _jvm(spark: SparkSession):
    return spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()


def _path(spark: SparkSession, path: str):
    return _jvm(spark)[0].org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(_jvm(spark)[1])


def _pointer(path: str) -> str:
    return f"{path.rstrip('/')}/_versions/current"


def _read(spark: SparkSession, path: str) -> list[str]:
    """The present version and the one before, as far as there are any."""
    fs = _file_system(spark, path)
    if not fs.isDirectory(_path(spark, path)) or not fs.exists(_path(spark, _pointer(path))):
        return []
    stream = fs.open(_path(spark, _pointer(path)))
    try:
        return _jvm(spark)[0].org.apache.commons.io.IOUtils.toString(stream, "UTF-8").split()
    finally:
        stream.close()


def _folder(path: str, version: str) -> str:
    return path if version == _PLAIN else f"{path.rstrip('/')}/_versions/{version}"


def resolve(spark: SparkSession, path: str) -> str:
    """The folder that holds the table's present rows."""
    held = _read(spark, path)
    return _folder(path, held[0]) if held else path


def _rename(spark: SparkSession, old: str, new: str, over: bool = False) -> None:
    """Rename in one step; unless ``over``, an error if the new name is taken."""
    jvm, conf = _jvm(spark)
    kind = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kind, 1)
    options[0] = kind.OVERWRITE if over else kind.NONE
    fs = _file_system(spark, old)
    source = fs.makeQualified(_path(spark, old))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(source.toUri(), conf)
    context.rename(source, fs.makeQualified(_path(spark, new)), options)


def _point(spark: SparkSession, path: str, versions: Sequence[str]) -> None:
    """Write a new pointer and rename it over the old one."""
    fs = _file_system(spark, path)
    new = f"{_pointer(path)}-{uuid.uuid4().hex}"
    stream = fs.create(_path(spark, new))
    try:
        stream.write(bytearray("\n".join(versions).encode()))
    finally:
        stream.close()
    _rename(spark, new, _pointer(path), over=True)


def _delete(spark: SparkSession, path: str, version: str) -> None:
    fs = _file_system(spark, path)
    if version != _PLAIN:
        fs.delete(_path(spark, _folder(path, version)), True)
        return
    for file in fs.listStatus(_path(spark, path)):  # what lay there before there were versions
        if file.getPath().getName() != "_versions":
            fs.delete(file.getPath(), True)


def add_file(df: DataFrame, path: str, name: str, fmt: str = "parquet") -> str:
    """Add a few rows to a folder as one file, by one rename.

    Spark's own append shares a working folder among all writers of a table; here each has its own, so
    any number may add files at the same time.  The file must not exist.
    """
    spark = df.sparkSession
    fs = _file_system(spark, path)
    work, target = f"{path.rstrip('/')}/_adding-{uuid.uuid4().hex}", f"{path.rstrip('/')}/{name}.{fmt}"
    try:
        df.coalesce(1).write.format(fmt).save(work)
        parts = [f.getPath() for f in fs.listStatus(_path(spark, work)) if f.getPath().getName().startswith("part-")]
        if fs.exists(_path(spark, target)) or not fs.rename(parts[0], _path(spark, target)):
            raise FileExistsError(target)
    finally:
        fs.delete(_path(spark, work), True)
    return target


def _create(df: DataFrame, path: str, fmt: str, partition_by: Sequence[str]) -> str:
    """Write a table that is not there yet and rename it into place; an error if another writer was faster."""
    spark = df.sparkSession
    fs = _file_system(spark, path)
    parent, name = path.rstrip("/").rsplit("/", 1)
    work = f"{parent}/_creating-{name}-{uuid.uuid4().hex}"
    try:
        df.write.format(fmt).partitionBy(*partition_by).save(work)
        _rename(spark, work, path)
    finally:
        fs.delete(_path(spark, work), True)
    return path


def replace(df: DataFrame, path: str, fmt: str = "parquet", partition_by: Sequence[str] = ()) -> str:
    """Replace a table's rows and schema in one step; ``df`` may read the table itself.  The new folder."""
    spark = df.sparkSession
    fs = _file_system(spark, path)
    if not fs.exists(_path(spark, path)):
        return _create(df, path, fmt, partition_by)
    before = _read(spark, path) or [_PLAIN]
    version = uuid.uuid4().hex
    # Tasks that still end when a write has failed may make their folder anew: a hidden one, never a version's.
    folder, work = _folder(path, version), _folder(path, f".{version}")
    try:
        df.write.format(fmt).partitionBy(*partition_by).save(work)
        _rename(spark, work, folder)
    finally:
        fs.delete(_path(spark, work), True)
    _point(spark, path, [version, *before[:1]])
    for old in before[1:2]:
        _delete(spark, path, old)
    return folder
