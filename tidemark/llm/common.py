"""What the operators of this subpackage share: reading tables, size checks, durable intermediate tables."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import shared_folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes df as a table in the shared folder and reads it: cuts lineage, survives lost executors."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Removes the folders of tables that `stored` made and nothing reads any more."""
    for t in tables:
        jvm, conf = t.sparkSession._jvm, t.sparkSession._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in t.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, each action's shuffle files go when it ends, not when the driver happens to collect its garbage; nothing of one action is read by another."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def fits(df: DataFrame, most: int) -> bool:
    """Whether df has at most `most` rows; counts no further."""
    return df.limit(most + 1).count() <= most


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def sum_blocks(df: DataFrame, fan_in: int = 64) -> DataFrame:
    """df(block int, part int, sums binary of int64): adds the rows of each block, `fan_in` parts a task and round, so that no task reads a row of every input partition."""
    import numpy as np
    import pyarrow as pa

    def add(t: pa.Table) -> pa.Table:
        total = None
        for chunk in t["sums"].chunks:
            for x in chunk:
                row = np.frombuffer(x.as_buffer(), np.int64)
                total = row.copy() if total is None else total + row
        return pa.table({"block": t["block"][:1], "part": t["part"][:1], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "block int, part int, sums binary"
    first = df.withColumn("part", F.pmod("part", F.lit(fan_in * fan_in))).groupBy("block", "part").applyInArrow(add, schema)
    second = first.withColumn("part", (F.col("part") / fan_in).cast("int")).groupBy("block", "part").applyInArrow(add, schema)
    return second.groupBy("block").applyInArrow(add, schema)
