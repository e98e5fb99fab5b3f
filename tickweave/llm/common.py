"""Shared helpers of the training-data operators."""

from __future__ import annotations

import io
import os
import uuid
import zipfile
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweave.session import checkpoint_root
from tickweave.sources.tables import read_table

#: Fixed value: the white space of the words, space and the controls 9 to 13.
SPACE_CHARS = " \t\n\x0b\x0c\r"
#: Rows of an Arrow batch handed to Python: bounds a worker's memory with texts of ordinary length.
BATCH_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Characters of the texts that one numpy step works on; a longer text is a step of its own.
STEP_CHARS = 2_000_000

ArrowMap = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new folder name below the shared checkpoint folder."""
    return f"{checkpoint_root(spark).rstrip('/')}/tickweave-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and go on from the copy: it is computed
    once, and a retry after a lost executor starts from the files.  ``batch_rows``
    sets larger Arrow batches for narrow rows."""
    spark, path = df.sparkSession, shared_path(df.sparkSession, name)
    if batch_rows:
        spark.conf.set(ARROW_ROWS, str(batch_rows))
    df.write.option("compression", "zstd").parquet(path)
    if batch_rows:
        spark.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return spark.read.schema(df.schema).parquet(path)


def text_col(name: str = "text") -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Hand this package to the executors once per application (a zip in the
    shared folder), so that their workers can import it."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    here = os.path.dirname(os.path.abspath(__file__))
    top = os.path.dirname(os.path.dirname(here))
    data = io.BytesIO()
    with zipfile.ZipFile(data, "w") as z:
        for folder, _, names in os.walk(os.path.dirname(here)):
            for name in sorted(names):
                if name.endswith(".py"):
                    z.write(os.path.join(folder, name), os.path.relpath(os.path.join(folder, name), top))
    path = shared_path(spark, "package") + "/tickweave_package.zip"
    files, at = filesystem(path)
    files.create_dir(os.path.dirname(at), recursive=True)
    with files.open_output_stream(at) as out:
        out.write(data.getvalue())
    sc.addPyFile(path)
    _shipped.add(sc.applicationId)


def filesystem(path: str):
    """The file system of a folder's address, and the path in it."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


def map_arrow(df: DataFrame, fn: ArrowMap, schema: StructType | str) -> DataFrame:
    """``mapInArrow`` with the batch size that the operators here count on."""
    ship_package(df.sparkSession)
    df.sparkSession.conf.set(ARROW_ROWS, str(BATCH_ROWS))
    return df.mapInArrow(fn, schema)


def steps(batches: Iterable[pa.RecordBatch], chars: int = STEP_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Slices of the batches with their texts (column ``text``), at most about
    ``chars`` characters in each."""
    for batch in batches:
        texts = [x or "" for x in batch.column("text").to_pylist()]
        start = held = 0
        for i, text in enumerate(texts):
            if i > start and held + len(text) > chars:
                yield batch.slice(start, i - start), texts[start:i]
                start, held = i, 0
            held += len(text)
        if texts:
            yield batch.slice(start), texts[start:]


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with underscores before it until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)
