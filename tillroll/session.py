"""Session settings and the shared work folder."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

_local_folders = {}


def local_session(cpus="*", app="tillroll", memory="8g"):
    """A single-machine session for tests and benchmarks."""
    slots = 8 if cpus == "*" else int(cpus)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(slots))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_folder(spark):
    """The folder every executor can reach, as the cluster names it.

    Without ``spark.checkpoint.dir`` only a single-machine session can go on,
    with a folder of its own that lasts as long as the application.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_folders:
        _local_folders[context.applicationId] = tempfile.mkdtemp(prefix="tillroll-")
    return _local_folders[context.applicationId]


def fresh_folder(spark, label):
    """A new, unused path below the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/tillroll/{app}/{label}-{uuid.uuid4().hex}"


@contextmanager
def open_writers(spark, number):
    """Within it, a task of a partitioned write holds up to ``number`` files open, and its
    rows go to them as they come: none are sorted, held or spilled for the split."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name)
    spark.conf.set(name, number)
    try:
        yield
    finally:
        spark.conf.set(name, before)


@contextmanager
def short_shuffles(spark):
    """Within it, what a job shuffled is deleted as the job ends, and does not wait until
    the driver happens to collect its garbage. For steps that read each other's written
    tables; a frame that runs twice as the same object would shuffle its rows again."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, "false")
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)
