"""Session helpers: one place for the settings the library relies on."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(app: str = "barloom", master: str | None = None, shuffle_partitions: int | None = None) -> SparkSession:
    """A session with adaptive execution, UTC dates and no web page.

    On a cluster leave `master` and `shuffle_partitions` unset: the submit command and
    adaptive coalescing decide both.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        # wide feature plans hold more generated classes than the default cache of 100
        .config("spark.sql.codegen.cache.maxEntries", "2000")
        # The JIT compiler refuses methods above 8,000 bytes of bytecode; a wide projection fused
        # into one method would be interpreted for good. Past the limit Spark uses split methods.
        .config("spark.sql.codegen.hugeMethodLimit", "8000")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master).config("spark.driver.memory", "16g")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder under the cluster's shared `spark.checkpoint.dir`.

    Where that setting is absent, a temporary folder is used on a local master only: executors of
    a cluster could not see it, so there the call is refused.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        root = tempfile.mkdtemp(prefix="barloom-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


#: Bytes of a file that one task reads where it sorts or combines all rows it has read: some 3 million ticks fit in its memory.
SPLIT_BYTES = 32 << 20


@contextmanager
def small_splits(spark: SparkSession, limit: int = SPLIT_BYTES) -> Iterator[None]:
    """Jobs started inside read files in splits of at most `limit` bytes; the session's own smaller setting stays."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    size = int(spark.sparkContext._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before))
    spark.conf.set(name, str(min(size, limit)))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared file system that the library made."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
