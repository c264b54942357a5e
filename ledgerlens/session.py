"""Session helpers: the shared folder, materialised tables and size-checked broadcasts."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast; callers pass narrow tables only.
BROADCAST_ROWS = 200_000


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``; where that is unset, a temporary one if all tasks run on this
    machine, else RuntimeError: each executor would write to a disk of its own."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        at = "file://" + tempfile.mkdtemp(prefix="ledgerlens-")
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # noqa: BLE001 - the session may be gone already
        pass


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one, removed when the driver's Python ends."""
    path = f"{shared_dir(spark)}/ledgerlens/{name}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def drop_scratch(spark: SparkSession, path: str) -> None:
    _delete(spark, path)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives lost executors, has a known size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_small(big: DataFrame, small: DataFrame, on: list[str], how: str = "inner", limit: int = BROADCAST_ROWS) -> DataFrame:
    """Join with a materialised side that is broadcast if it has at most ``limit`` rows, else shuffled (AQE splits skewed keys)."""
    rows = small.limit(limit + 1).count()
    return big.join(F.broadcast(small) if rows <= limit else small.hint("merge"), on, how)


def require_columns(df: DataFrame, names: Iterable[str]) -> None:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
