"""Session helpers: shipping the package to executors and shared scratch tables."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_SHIPPED: set[str] = set()
BATCH_BYTES, MOST_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 2 << 20


def ship(spark: SparkSession) -> None:
    """Make this package importable in every Python worker of the application.

    The package folder is zipped once per application and handed to Spark's own
    file server, so that executors need no shared file system to import it.  Arrow
    batches are held to 2 MB, unless the session asks for less: rows may carry whole
    documents, and what an executor's threads have allocated for large buffers stays
    with the process.
    """
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(BATCH_BYTES, "64m")) > MOST_BATCH_BYTES:
        spark.conf.set(BATCH_BYTES, f"{MOST_BATCH_BYTES}b")
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    if not os.path.isdir(root):  # already imported from a shipped archive
        _SHIPPED.add(app)
        return
    target = os.path.join(tempfile.mkdtemp(prefix="syllaspark"), "syllaspark.zip")
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.join("syllaspark", os.path.relpath(full, root)))
    spark.sparkContext.addPyFile(target)
    _SHIPPED.add(app)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it on a cluster.  Only where that is unset, as
    in a local test, a folder of our own is made; on a cluster that is an error, as a
    folder of the driver's own machine would be no use to executors.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    master = spark.sparkContext.master
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"spark.checkpoint.dir is unset: it must name a folder that all executors of {master} share")
    own = spark.conf.get("syllaspark.shared.dir", None)
    if not own:
        own = tempfile.mkdtemp(prefix="syllaspark-shared")
        spark.conf.set("syllaspark.shared.dir", own)
    return own


class Scratch:
    """Intermediate tables, written to the shared folder and read back.

    Writing cuts the lineage, survives the loss of executors, and lets a result
    that several later steps need be computed once.  Tables that the rest of a result
    doesn't read are deleted on the way (``drop``, ``keep``); what a result reads stays until a
    caller who has written that result asks for ``release``.
    """

    made: list[tuple[SparkSession, str]] = []

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self.count = 0
        self.saved: list[DataFrame] = []
        Scratch.made.append((spark, self.base))

    def save(self, frame: DataFrame, label: str = "t") -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}-{label}"
        frame.write.mode("overwrite").parquet(path)
        out = self.spark.read.schema(frame.schema).parquet(path)
        out._scratch_path = path
        self.saved.append(out)
        return out

    def keep(self, *frames: DataFrame) -> None:
        """Delete all saved tables but those given, when nothing later reads the others."""
        self.drop(*[f for f in self.saved if not any(f is k for k in frames)])
        self.saved = [f for f in self.saved if any(f is k for k in frames)]

    def drop(self, *frames: DataFrame) -> None:
        """Delete tables that no later step reads."""
        for frame in frames:
            path = getattr(frame, "_scratch_path", None)
            if path:
                _delete(self.spark, path)

    @classmethod
    def release(cls, since: int) -> None:
        """Delete all tables of the scratches made after the first ``since``."""
        while len(cls.made) > since:
            _delete(*cls.made.pop())


def _delete(spark: SparkSession, path: str) -> None:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def spread(frame: DataFrame, least_bytes: int = 4 << 20) -> DataFrame:
    """``frame``, dealt over all cores if its scan has fewer splits, before costly work on each row.

    A file of one row group is one split, however large.  Tables of many files, and
    plans that shuffle anyway, are left as they are.
    """
    plan = frame._jdf.queryExecution().executedPlan()
    if plan.nodeName() == "AdaptiveSparkPlan":
        return frame
    cores = frame.sparkSession.sparkContext.defaultParallelism
    return frame.repartition(cores) if plan.execute().getNumPartitions() < cores and plan_bytes(frame) > least_bytes else frame


def plan_bytes(frame: DataFrame) -> int:
    """The bytes that a plan reads: Catalyst's estimate for a scan of files, else a measurement."""
    guess = int(str(frame._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if guess < 1 << 50:
        return guess
    strings = [F.coalesce(F.octet_length(frame[f.name]), F.lit(0)) for f in frame.schema.fields if f.dataType.typeName() == "string"]
    total = F.lit(8 * len(frame.columns)).cast("long")
    for size in strings:
        total = total + size
    return int(frame.select(F.sum(total)).first()[0] or 0)


def tasks_for(frame: DataFrame, bytes_per_task: int, least: int = 8) -> int:
    """A number of tasks that grows with the input."""
    return max(least, -(-plan_bytes(frame) // bytes_per_task))
