"""Small helpers of the operators: Arrow kernels, shared checkpoints, words and hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from appfacet.sources.publish import remove_folder

_ARROW = {
    "long": pa.int64(),
    "int": pa.int32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
}


def importable(df: DataFrame) -> None:
    """Let Python workers on this machine import the package from where the driver has it;
    elsewhere it is installed, or passed with --py-files."""
    df.sparkSession.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))


def map_batches(df: DataFrame, kernel: Callable[[Iterator[dict]], Iterator[dict]], columns: dict[str, str]) -> DataFrame:
    """Run `kernel` over each partition; it gets and gives batches as {column: sequence}."""
    importable(df)
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in columns.items()])

    def run(batches):
        inputs = ({name: batch.column(i).to_pylist() for i, name in enumerate(batch.schema.names)} for batch in batches)
        for out in kernel(inputs):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return df.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in columns.items()))


def map_arrays(df: DataFrame, kernel: Callable[[Iterator[dict]], Iterator[dict]], columns: dict[str, str]) -> DataFrame:
    """As `map_batches`, with inputs as numpy arrays; for columns without nulls."""
    importable(df)
    schema = pa.schema([(name, _ARROW[kind]) for name, kind in columns.items()])

    def run(batches):
        inputs = ({name: batch.column(i).to_numpy(zero_copy_only=False) for i, name in enumerate(batch.schema.names)} for batch in batches)
        for out in kernel(inputs):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return df.mapInArrow(run, ", ".join(f"{name} {kind}" for name, kind in columns.items()))


def free_name(df: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `df` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def rewrite_text(df: DataFrame, change: Callable, helpers: list[str]) -> DataFrame:
    """`df` without `helpers`, its text changed to change(text, *helpers), n_chars following."""
    importable(df)
    schema = StructType([f for f in df.schema if f.name not in helpers])

    def run(batches):
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("text", *helpers)]
            texts = pa.array([change(*row) for row in zip(*columns, strict=True)], pa.string())
            arrays = [texts if f.name == "text" else batch.column(i) for i, f in enumerate(batch.schema) if f.name not in helpers]
            yield pa.RecordBatch.from_arrays(arrays, names=[f.name for f in schema])

    out = df.mapInArrow(run, schema)
    return out.withColumn("n_chars", F.length("text").cast(schema["n_chars"].dataType)) if "n_chars" in out.columns else out


def ensure_shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; only a local master may get one of its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return context.getCheckpointDir()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="llm-checkpoints-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """The rows of `df`, kept in the shared folder: computed once, not lost with an executor."""
    ensure_shared_folder(df.sparkSession)
    return df.checkpoint()


class Frames:
    """Frames kept as columns in a folder of their own in the shared one: computed once, smaller than
    checkpoints, and gone as soon as they are dropped or the block ends, not when the driver collects garbage."""

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{ensure_shared_folder(spark)}/frames-{uuid.uuid4().hex}"

    def __enter__(self) -> Frames:
        return self

    def __exit__(self, *failure) -> None:
        remove_folder(self.spark, self.folder)

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """The rows of `df`, to which those kept under the same name since its last drop are added."""
        df.write.mode("append").parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            remove_folder(self.spark, f"{self.folder}/{name}")


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Inside, shuffle files go as soon as the job that wrote them ends, not when the driver collects garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def words_of(text: str | None) -> list[bytes]:
    """Runs of characters other than space and U+0009..U+000D, as UTF-8."""
    return text.encode().split() if text else []


def hash64(data: bytes) -> int:
    return xxhash.xxh3_64_intdigest(data)


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over 64 bits (fixed constants of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))
