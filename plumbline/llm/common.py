"""What several operators of this subpackage share: scratch folders, files that
executors can reach, and text cut into bounded batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession

#: Bytes of text that one vectorised step holds at once.
STEP_BYTES = 2 << 20


def scratch(spark: SparkSession, tag: str) -> str:
    """A new folder, as a URI, that the driver and all executors share.

    It lies in ``spark.checkpoint.dir``; where the session has none (tests in
    local mode) a temporary folder is made and set for the session.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="plumbline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{qualified(spark, base).rstrip('/')}/plumbline/{tag}-{uuid.uuid4().hex}"


def qualified(spark: SparkSession, path: str) -> str:
    """A path as a URI; one without a scheme is in the cluster's default store."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    whole = where.getFileSystem(context._jsc.hadoopConfiguration()).makeQualified(where).toString()
    return whole if "://" in whole or not whole.startswith("file:") else "file://" + whole.removeprefix("file:")


def materialise(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written as Parquet to a shared scratch folder and read again.

    This cuts the lineage: lost executors cost the tasks that were running, and
    later jobs plan with the true size of the table.
    """
    spark = df.sparkSession
    path = scratch(spark, tag)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a URI (file, hdfs, s3, gs), on any machine."""
    return pafs.FileSystem.from_uri(uri)


def write_file(uri: str, parts: Iterable[bytes]) -> int:
    """Write a file under a name of its own, then rename it: a task that runs
    twice leaves one whole file. Returns its bytes."""
    fs, path = filesystem(uri)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    held = f"{path}.{uuid.uuid4().hex}.tmp"
    n = 0
    with fs.open_output_stream(held) as out:
        for part in parts:
            out.write(part)
            n += len(part)
    if fs.get_file_info(path).type != pafs.FileType.NotFound:
        fs.delete_file(path)
    fs.move(held, path)
    return n


def text_steps(batch: pa.RecordBatch, column: str, limit: int = STEP_BYTES) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, row after the last, texts as UTF-8) of slices of a batch, each
    of about ``limit`` bytes or one row; a null text is empty."""
    # a worker goes from stage to stage: what an earlier one no longer needs is given back
    pa.default_memory_pool().release_unused()
    at = batch.column(column).cast(pa.large_binary())
    n, start, held, size = len(at), 0, [], 0
    for i in range(n):
        v = at[i].as_py() or b""
        if held and size + len(v) > limit:
            yield start, i, held
            start, held, size = i, [], 0
        held.append(v)
        size += len(v)
    if held:
        yield start, n, held
