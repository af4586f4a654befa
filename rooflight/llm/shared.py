"""What several corpus operators need: the shared folder, written tables, connected components."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import uuid
from collections.abc import Iterator

from py4j.protocol import Py4JError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of every contract here: space and U+0009 to U+000D.
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
_LOCAL_DEFAULT = "file:///tmp/checkpoints"


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors share.

    The cluster names it in ``spark.checkpoint.dir``. Only where that is unset (tests in local
    mode) a folder of our own is used.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = _LOCAL_DEFAULT
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it again.

    Cuts the lineage and survives the loss of executors. The files go when the JVM ends. What the steps
    before held (shuffle files, broadcasts, plans) is let go at once: the driver frees it when it is collected.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rooflight/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _settled(spark, path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def bucketed(df: DataFrame, name: str, key: str) -> Iterator[DataFrame]:
    """Like ``written``, as a table in buckets of ``key``, so that joins by it move only the other side.

    The table's name is dropped from the catalog at the end; its files go when the JVM ends.
    """
    spark = df.sparkSession
    table = f"rooflight_{name}_{uuid.uuid4().hex}"
    path = f"{shared_dir(spark)}/rooflight/{table}"
    df.write.bucketBy(int(spark.conf.get("spark.sql.shuffle.partitions")), key).option("path", path).saveAsTable(table, format="parquet")
    try:
        _settled(spark, path)
        yield spark.table(table)
    finally:
        spark.sql(f"DROP TABLE {table}")


def _settled(spark: SparkSession, path: str) -> None:
    """What is at ``path`` is written: mark it for deletion, let go what its making held."""
    jvm = spark.sparkContext._jvm
    there = jvm.org.apache.hadoop.fs.Path(path)
    there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(there)
    _release(spark)


def _release(spark: SparkSession) -> None:
    """Collect the driver's garbage and give the free memory of its Python and its JVM back to the system, where that can be done."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    with contextlib.suppress(OSError, AttributeError):
        ctypes.CDLL(None).malloc_trim(0)
    trim_native(spark)


def trim_native(spark: SparkSession) -> str | None:
    """Let the driver's JVM return the native memory that it has freed (compilers, buffers), which it else keeps; None where it cannot."""
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway

    def array(kind, *items):
        out = gateway.new_array(kind, len(items))
        for i, x in enumerate(items):
            out[i] = x
        return out

    with contextlib.suppress(Py4JError, PySparkException, TypeError):
        class_ = jvm.java.lang.Class
        kinds = ("javax.management.ObjectName", "java.lang.String", "[Ljava.lang.Object;", "[Ljava.lang.String;")
        invoke = class_.forName("javax.management.MBeanServer").getMethod("invoke", array(class_, *map(class_.forName, kinds)))
        command = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand")
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        return invoke.invoke(server, array(jvm.Object, command, "systemTrimNativeHeap", None, None))
    return None


def as_row(df: DataFrame):
    """All columns of ``df`` as one struct ``row``, so that no name of theirs meets one of ours."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


#: A key is hot if it has more than this share of all rows; there are fewer such keys than its inverse.
HOT_SHARE = 1 / 2000


def look_up(rows: DataFrame, table: DataFrame, key: str, total: int, how: str = "inner") -> DataFrame:
    """``rows`` joined with ``table`` (``key``, ``n``: how many rows have it, further columns); ``n`` is dropped.

    Keys with more than HOT_SHARE of the ``total`` rows, under 2000 whatever the data, are broadcast;
    the rows of the other keys are shuffled, of which no key has many.
    """
    name = F.col(key)
    hot = F.broadcast(table.where(F.col("n") > max(total * HOT_SHARE, 1)).drop("n"))
    cold = table.where(F.col("n") <= max(total * HOT_SHARE, 1)).drop("n")
    common = rows.join(hot, key)
    others = rows.join(hot.select(name.alias("hot_key")), name == F.col("hot_key"), "left_anti").join(cold, key, how)
    return common.unionByName(others)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def held_out(modulus: int, remainder: int, key: str = "doc_id"):
    """Is crc32(doc_id as text) mod ``modulus`` equal to ``remainder``? A null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % modulus == remainder


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Components of an undirected graph of ``(src, dst)``: one ``(node, component)`` per node.

    ``component`` is the smallest node reached. Large-star and small-star rounds alternate until
    nothing changes; minima are combined before each shuffle, so a node of very high degree costs
    one row per task, and every round is written to the shared folder. Self-loops and null ends are
    ignored, an empty table gives an empty result.
    """

    def sign(e: DataFrame):
        return e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()

    now = written(
        edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges"
    )
    before = sign(now)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        now = written(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct(), "edges")
        after = sign(now)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )
