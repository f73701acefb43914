"""What the operators on documents share: words, batches of texts, the training split and checkpoints."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a batch that are held as Python objects at a time.
SLICE = 512
#: Rows of ids up to which a table may be broadcast (some 40 MB); more are joined by shuffle.
MOST_IDS = 1_000_000


#: Rows of an Arrow batch of whole texts: Spark's 10,000 are tens of MB, held by the JVM and by Python for each task.
BATCH_ROWS = 1000


def words(text: bytes) -> list[bytes]:
    """Words `[^\\x20\\x09-\\x0D]+` of UTF-8 text; bytes.split() parts at exactly these six characters."""
    return text.split()


def lower(text: bytes) -> bytes:
    """Lower-cases A-Z and nothing else."""
    return text.lower()


def slices(batches: Iterator[pa.RecordBatch], text: str = "text") -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Parts of the batches with their texts in UTF-8; a null text is empty."""
    for batch in batches:
        for start in range(0, batch.num_rows, SLICE):
            part = batch.slice(start, SLICE)
            column = part.column(part.schema.get_field_index(text))
            kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
            yield part, [x or b"" for x in column.cast(kind).to_pylist()]


def short_batches(spark: SparkSession) -> None:
    """Batches that this session hands to Python have BATCH_ROWS at most; a lower setting stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key, "10000")) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def give_back() -> None:
    """Gives freed memory back to the system: Python workers live on after a task, and so does what they hold."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def thrifty(f: Batches) -> Batches:
    """The function on batches; once its task is done, what it held is given back."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        give_back()

    return run


def remainder(doc_id: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % mod


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names.

    Only a local master, whose tasks all run in this process (tests), may leave it unset; a cluster without it is an
    error, as a folder of one machine would be lost with it and can't be read by the others.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not context.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all machines of the cluster share")
    return tempfile.mkdtemp(prefix="sluice-")


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the folder that spark.checkpoint.dir names."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def swept(spark: SparkSession, *folders: str) -> None:
    """Lets Spark delete the shuffle files of finished stages, and deletes folders that no later stage reads.

    Shuffle files go once the driver's JVM has collected the objects that stand for them; Spark asks for that every half
    an hour (spark.cleaner.periodicGC.interval), here it is asked for between the stages of one operator.
    """
    gc.collect()
    spark._jvm.System.gc()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Steps of a share: a hash of 63 bits is compared with it.
STEPS = 1 << 62


def share_of(sample: int, n: int) -> int:
    """How many of STEPS steps give about `sample` of n rows; never zero for a positive sample."""
    return STEPS if n <= sample else max(1, STEPS * sample // n)


def draw(*columns: str | Column) -> Column:
    """A uniform number below STEPS, by a hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(*columns), 2)


def small(ids: DataFrame, most: int = MOST_IDS) -> DataFrame:
    """ids (rows that are cheap to count) with a broadcast hint if they are few enough, else as they are."""
    return F.broadcast(ids) if ids.limit(most + 1).count() <= most else ids
