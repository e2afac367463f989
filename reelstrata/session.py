"""Session settings the models rely on, and sizing that follows the data."""

from __future__ import annotations

import math
import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

SETTINGS = {
    # Bad text must fail the job instead of turning into NULL.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Joins on person and series keys are skewed; let a hot partition be split even where the
    # next join of the same chain then has to shuffle again.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Keys unpack to many times their stored size in a task's hash table or sort: what a task scans and what AQE merges for
    # it stay small, so that its memory does not grow with the input.
    "spark.sql.files.maxPartitionBytes": "32m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}

INPUT_BYTES_PER_SHUFFLE_PARTITION = 512 * 1024**2
#: Up to FINE_PARTITIONS, a shuffle has a partition for so many bytes of input; AQE merges them.
FINE_BYTES, FINE_PARTITIONS = 8 * 1024**2, 4096
SCAN_BYTES = 128 * 1024**2
MAX_SCAN_TASKS = 200_000


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def as_bytes(size: str) -> int:
    """Bytes of a Spark size such as `134217728b`, `128m` or `128MB`."""
    number, unit = re.fullmatch(r"\s*(\d+)\s*([a-z]*)\s*", size.lower()).groups()
    return int(number) << 10 * "bkmgtp".index((unit or "b")[0])


def size_shuffles(spark: SparkSession, input_bytes: int) -> int:
    """Size scan and shuffle tasks for this much input; AQE merges shuffle partitions left small.

    Both sizes only ever grow from what the session asks for.
    """
    wanted = math.ceil(input_bytes / INPUT_BYTES_PER_SHUFFLE_PARTITION)
    fine = min(math.ceil(input_bytes / FINE_BYTES), FINE_PARTITIONS)
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), wanted, fine)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(partitions))
    split = math.ceil(input_bytes / MAX_SCAN_TASKS)
    if split > as_bytes(spark.conf.get("spark.sql.files.maxPartitionBytes")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
    return partitions


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the folder all executors share (`spark.checkpoint.dir`)."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder shared by all executors")
        shared = _local_scratch()
    return f"{shared.rstrip('/')}/{label}-{uuid.uuid4().hex}"


@cache
def _local_scratch() -> str:
    return tempfile.mkdtemp(prefix="run-")
