"""Tables that cut lineage, and single files, where the driver and every executor can reach them."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder under ``spark.checkpoint.dir``. Where that is unset, a run on one machine gets a
    folder of its own for the session; a cluster is refused, since nothing else is shared for sure."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        base = tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/corpusloom-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once, stored as Parquet in the shared folder and read back."""
    spark = df.sparkSession
    folder = shared_dir(spark)
    df.write.parquet(f"{folder}/{name}")
    out = spark.read.schema(df.schema).parquet(f"{folder}/{name}")
    out.stored_in = folder
    return out


def discard(*tables: DataFrame) -> None:
    """Removes tables that ``written`` made and nothing reads any more."""
    for df in tables:
        fs, path = _located(df.sparkSession, df.stored_in)
        fs.delete(path, True)


def release(spark: SparkSession) -> None:
    """Shuffle files and broadcasts of steps that are done go when the driver collects its garbage,
    which a large heap puts off for long; so it is asked to after a step that shuffles much."""
    spark.sparkContext._jvm.System.gc()


#: Bytes of the rows that a Python worker is sent at once. A worker holds several forms of a batch: of
#: Spark's own 64 MB each, four workers pass 4 GB.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds the batches that Python gets by bytes, unless the session has a bound of its own below
    Spark's; rows alone, 10,000 of them, bound nothing where texts are long."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(name).rstrip("b")) >= 64 << 20:
        spark.conf.set(name, f"{BATCH_BYTES}b")


def _located(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    """Whether anything matches ``path``, which may hold wildcards."""
    fs, p = _located(spark, path)
    found = fs.globStatus(p)
    return found is not None and len(found) > 0


def listed(spark: SparkSession, path: str) -> list[str]:
    """Paths of what stands in a folder, sorted; none if the folder is missing."""
    fs, p = _located(spark, path)
    return sorted(x.getPath().toString() for x in fs.listStatus(p)) if fs.exists(p) else []


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _located(spark, path)
    fs.delete(p, True)


def rename_new(spark: SparkSession, old: str, new: str) -> bool:
    """Renames a file to a name that must be free; False if it is taken."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    _, src = _located(spark, old)
    _, dst = _located(spark, new)
    context = hadoop.FileContext.getFileContext(src.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        context.rename(src, dst, none)
    except Py4JJavaError as e:
        if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
            return False
        raise
    return True


def files(spark: SparkSession, path: str) -> list[str]:
    """Paths of all files under a folder, sorted."""
    fs, p = _located(spark, path)
    found, it = [], fs.listFiles(p, True)
    while it.hasNext():
        found.append(it.next().getPath().toString())
    return sorted(found)


def read_bytes(spark: SparkSession, path: str) -> bytes:
    fs, p = _located(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
    finally:
        stream.close()


def write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    fs, p = _located(spark, path)
    stream = fs.create(p, True)
    try:
        stream.write(data)
    finally:
        stream.close()


def size_of(spark: SparkSession, path: str) -> int:
    fs, p = _located(spark, path)
    return fs.getFileStatus(p).getLen()


def opened(spark: SparkSession, path: str, at: int = 0):
    """A stream of the file's bytes from ``at`` on, inside the driver's JVM. Streams are copied there by
    ``copied``, in small buffers, so a large file is never held."""
    fs, p = _located(spark, path)
    stream = fs.open(p)
    stream.seek(at)
    return stream


def created(spark: SparkSession, path: str):
    fs, p = _located(spark, path)
    return fs.create(p, True)


def copied(spark: SparkSession, source, target, most: int = -1) -> int:
    """Bytes copied from one stream of the JVM to another, ``most`` of them if it is given."""
    return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.copyLarge(source, target, 0, most)
