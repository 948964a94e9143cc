"""Tables between the steps of an operator, and helpers shared by the operators."""

from __future__ import annotations

import pickle
from collections.abc import Callable
from typing import Any

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from reelrank.session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs no recomputation of earlier steps.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it (Spark ignores case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def without(df: DataFrame, *names: str, keep: str | None = None) -> DataFrame:
    """``df`` without columns of these names (Spark ignores case), which a result's own columns replace; ``keep`` stays."""
    gone = {n.lower() for n in names}
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c == keep or c.lower() not in gone])


def shipped(spark: SparkSession, value: Any) -> Callable[[], Any]:
    """A call for tasks that gives ``value``; sent once to each executor, with the classes of this package.

    Only for values of bounded size.
    """
    sent = spark.sparkContext.broadcast(cloudpickle.dumps(value))
    return lambda: pickle.loads(sent.value)
