"""Written tables that cut a plan's lineage: several later steps read files instead of computing their input again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Row, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share (spark.checkpoint.dir); a temporary one in local sessions without it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="strandflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root


def fresh(spark: SparkSession, name: str = "kept") -> str:
    """A path in the shared folder that nothing has used."""
    return f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


#: Whether Spark removes the shuffle files of an execution when it ends.
CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: The paths kept in each step() that is being built, the innermost last.
_steps: ContextVar[tuple[list[str], ...]] = ContextVar("steps", default=())


@contextmanager
def _cleaned(spark: SparkSession) -> Iterator[None]:
    was = spark.conf.get(CLEAN)
    spark.conf.set(CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEAN, was)


def collected(df: DataFrame) -> list[Row]:
    """The few rows of df; its shuffle files go."""
    with _cleaned(df.sparkSession):
        return df.collect()


def kept(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder. It is written now, while the plan that reads it is built, and its shuffle files go."""
    path = fresh(df.sparkSession)
    with _cleaned(df.sparkSession):
        df.write.parquet(path)
    for paths in _steps.get()[-1:]:
        paths.append(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def step(make: Callable[[], DataFrame]) -> DataFrame:
    """make() as kept() gives it. What make() itself keeps is removed, since only its result reads it."""
    paths: list[str] = []
    token = _steps.set((*_steps.get(), paths))
    try:
        df = make()
    finally:
        _steps.reset(token)
    out = kept(df)
    for path in paths:
        _drop(df.sparkSession, path)
    return out


def _drop(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def drop_scratch(spark: SparkSession) -> None:
    """Remove what this application has kept, once no result that reads it is needed."""
    _drop(spark, f"{shared_dir(spark)}/{spark.sparkContext.applicationId}")
