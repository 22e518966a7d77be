"""What the operators of this folder share: Arrow column maps, checkpoints, keys."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A slice of a batch handed to Python code at once.
SLICE_ROWS = 512
SLICE_BYTES = 4 << 20

#: Everything that counts as white space between words, as a Java/RE2 class.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's ``spark.checkpoint.dir``.

    One of our own is made only where none is set and all of Spark runs on one
    machine, as in tests; on a cluster that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="quirespark-checkpoint-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder


def checkpoint(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it from there.

    Unlike ``DataFrame.checkpoint`` this also gives the planner the true size:
    there the estimates of joins are multiplied from one checkpoint to the next,
    and those of an iteration outgrow the driver. The table goes when the
    program ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/quirespark-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._quirespark_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``checkpoint`` that nothing reads any more; other DataFrames are left alone."""
    for df in tables:
        if path := getattr(df, "_quirespark_path", None):
            _delete(df.sparkSession, path)


def _delete(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the session may have ended first
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


def bound_batches(spark: SparkSession) -> None:
    """Hold the session's Arrow batches to SLICE_BYTES or so; a smaller bound stays.

    Spark's own are of 10,000 rows or 64 MB: the JVM builds such a batch in buffers that
    double, outside its heap, and the worker holds it again, for each of an executor's tasks.
    """
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(limit)) > SLICE_BYTES:
        spark.conf.set(limit, str(SLICE_BYTES))


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for a context; workers import from it."""
    bound_batches(spark)
    sc = spark.sparkContext
    if getattr(sc, "_quirespark_sent", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="quirespark-")) / f"{root.name}.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._quirespark_sent = True


def unplaced(key: str) -> Column:
    """``key`` (long) as a new expression, so that a join deals both sides anew.

    An aggregate's output is already dealt by its key, and then Spark cannot
    split a hot key of the other side; with two plain exchanges it can.
    """
    return F.col(key).bitwiseXOR(F.lit(0).cast("long")).alias(key)


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names like ``stems`` that ``df`` doesn't have."""
    taken, out = {c.lower() for c in df.columns}, []
    for s in stems:
        while s.lower() in taken:
            s += "_"
        taken.add(s.lower())
        out.append(s)
    return out


#: Bits of a filter of ids, whatever their number.
SLOTS = 1 << 23


def prefilter(df: DataFrame, key: str, ids: DataFrame, id_: str = "id") -> DataFrame:
    """Rows of ``df`` whose ``key`` may be among ``ids``, before anything is moved.

    A bit is set for the slot of each id. The bits fit into SLOTS / 64 rows of a
    long each, 2 MB at most, and only those are broadcast; with very many ids
    the filter lets everything pass, and an exact join has to follow in any case.
    """

    def slot(c: str) -> Column:
        return F.xxhash64(F.lit(7), c).bitwiseAND(SLOTS - 1)

    bits = ids.select(slot(id_).alias("__i")).groupBy(F.shiftright("__i", 6).alias("__k")).agg(F.bit_or(F.expr("shiftleft(1L, cast(__i & 63 as int))")).alias("__m"))
    hit = df.withColumn("__slot", slot(key)).withColumn("__row", F.shiftright("__slot", 6))
    hit = hit.join(F.broadcast(bits), F.col("__row") == F.col("__k"))
    return hit.filter("(shiftrightunsigned(__m, cast(__slot & 63 as int)) & 1L) = 1L").drop("__slot", "__row", "__k", "__m")


#: Caches that Python workers keep from task to task.
_CACHES: list = []


def cache(x):
    """``x``, a dictionary that fills up by itself, known to ``clear_caches``."""
    _CACHES.append(x)
    return x


def clear_caches() -> None:
    """Give back what the operators before have kept in this worker; they fill their caches anew."""
    for x in _CACHES:
        x.clear()


def slices(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of rows of at most SLICE_ROWS rows and about SLICE_BYTES bytes."""
    start = total = 0
    for i, n in enumerate(sizes):
        if i > start and (i - start >= SLICE_ROWS or total + n > SLICE_BYTES):
            yield start, i
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield start, len(sizes)


def add_columns(
    df: DataFrame,
    inputs: list[str],
    new_fields: list[tuple[str, str]],
    make: Callable[[], Callable[..., list[pa.Array]]],
) -> DataFrame:
    """Append columns computed from ``inputs`` by Arrow batches; rows stay.

    ``make()`` runs once per task and returns a function from the input columns
    (as Arrow arrays, of one slice) to the arrays of ``new_fields`` (name, type). A column of
    ``df`` with the name of a new one is replaced.
    """
    ship(df.sparkSession)
    fields = [T.StructField(n, T._parse_datatype_string(kind), True) for n, kind in new_fields]
    new = {f.name.lower() for f in fields}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    kept_names = [f.name for f in kept]
    # inputs travel under names of their own: they may be replaced, or clash
    carried = df.select(
        *[F.col(f"`{n}`") for n in kept_names],
        *[F.col(f"`{c}`").alias(f"__in_{i}") for i, c in enumerate(inputs)],
    )
    n_kept, n_in = len(kept), len(inputs)
    schema = T.StructType([*kept, *fields])
    names = schema.fieldNames()

    def run(batches):
        f, pool = make(), pa.default_memory_pool()
        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(n_kept + i) for i in range(n_in)]
            sizes = [0] * batch.num_rows
            for c in columns:
                if pa.types.is_string(c.type) or pa.types.is_binary(c.type) or pa.types.is_large_string(c.type):
                    sizes = [a + (b or 0) for a, b in zip(sizes, pa.compute.binary_length(c).to_pylist(), strict=True)]
            for a, b in slices(sizes):
                out = f(*[c.slice(a, b - a) for c in columns])
                rows = [batch.column(i).slice(a, b - a) for i in range(n_kept)]
                yield pa.RecordBatch.from_arrays([*rows, *out], names=names)
            del batch, columns
            pool.release_unused()  # workers live on from task to task

    import pyarrow.compute  # noqa: F401  used in run

    return carried.mapInArrow(run, schema)
