"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_made: list[str] = []  # folders of this process


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where that is unset, a session of one machine takes the folder ``paperlane-shared`` of its working directory; a
    cluster has no such place, so there it is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = Path("paperlane-shared").absolute().as_uri()
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def new_folder(spark: SparkSession, name: str) -> str:
    """An unused folder for one result of one call; ``removed`` deletes it."""
    _made.append(f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def written(df: DataFrame, name: str) -> DataFrame:
    """df as a Parquet table in the shared folder: cuts the lineage, and a lost executor costs nothing."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for p in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)
    return len(paths)


def removed(spark: SparkSession) -> int:
    """Deletes the folders made so far and returns their number; results that still read them must be saved before."""
    n = _delete(spark, _made)
    _made.clear()
    return n


@contextmanager
def scoped(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside are deleted at its end, whether it succeeds or not: save what is to stay."""
    before = len(_made)
    try:
        yield
    finally:
        own, _made[before:] = _made[before:], []
        _delete(spark, own)


def unused(df: DataFrame, name: str) -> str:
    """name, or name with more underscores, that no column of df has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
