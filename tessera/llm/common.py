"""Helpers shared by the corpus operators: tables, materialised stages, skew-safe joins, components."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A group of copies counts as hot when it holds over 1/HOT_SHARE of all rows, so
#: there are never more than HOT_SHARE hot groups: that bounds what is broadcast.
HOT_SHARE = 1000
#: Rows up to which the rows of one key burden no task: a third of them are read by one in about a minute, without holding them.
MANY_ROWS = 50_000_000

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as Spark reads it; the path may be in any store."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; null becomes the empty string."""
    return F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from spark.checkpoint.dir or the context's checkpoint folder."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        jvm_dir = spark.sparkContext._jsc.sc().getCheckpointDir()
        found = jvm_dir.get() if jvm_dir.isDefined() else None
    if not found and spark.sparkContext.master.startswith("local"):
        # one machine is the whole cluster: the session's warehouse serves as the shared folder
        found = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        spark.sparkContext.setCheckpointDir(found)
    if not found:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def make_text_file(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file in any store; it has its name only once it is whole."""
    draft, fs = _file_system(spark, path + ".draft")
    out = fs.create(draft, True)
    out.write(text.encode())
    out.close()
    fs.rename(draft, _file_system(spark, path)[0])


def read_latest(spark: SparkSession, folder: str, prefix: str) -> str:
    """The text of the small file under folder whose name, with this prefix, comes last."""
    at, fs = _file_system(spark, folder)
    names = sorted(f.getPath().getName() for f in fs.listStatus(at))
    names = [n for n in names if n.startswith(prefix) and not n.endswith(".draft")]
    if not names:
        raise FileNotFoundError(f"{folder} holds no {prefix} file")
    stream = fs.open(_file_system(spark, f"{folder}/{names[-1]}")[0])
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def rename_parts(spark: SparkSession, folder: str, old: str, new: str) -> None:
    """Give the part files under folder another ending, which may stand before that of a compression."""
    at, fs = _file_system(spark, folder)
    for f in fs.listStatus(at):
        name = f.getPath().getName()
        if name.startswith("part-") and old in name:
            fs.rename(f.getPath(), _file_system(spark, f"{folder}/{name.replace(old, new)}")[0])


class Stages:
    """Written tables of one query run; each cuts the lineage at a shared folder.

    The tables outlive the call because results are lazy; the folder goes when
    the driver ends, or earlier by drop().
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{shared_dir(spark)}/tessera-{label}-{uuid.uuid4().hex}"
        self._n = 0
        atexit.register(self.drop)

    def keep(self, df: DataFrame, label: str = "t") -> DataFrame:
        """Write df and read it back."""
        self._n += 1
        path = f"{self.path}/{self._n}-{label}"
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, label: str, buckets: int, by: list[str], apart: str) -> DataFrame:
        """Write df in buckets of ``by``, so that joins on these columns leave it where it lies, in one folder per value of ``apart``."""
        self._n += 1
        name = "tessera_" + uuid.uuid4().hex
        df.write.format("parquet").partitionBy(apart).bucketBy(buckets, *by).option("path", f"{self.path}/{self._n}-{label}").option("compression", "zstd").saveAsTable(name)
        return self.spark.table(name)

    def drop(self, path: str | None = None) -> None:
        try:
            p, fs = _file_system(self.spark, path or self.path)
            fs.delete(p, True)
        except Exception:  # noqa: BLE001  the session may have ended before the interpreter
            pass


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """Left-join each row to its group's row without sending a large group to one task.

    groups has one row per key.  Groups of more than total/HOT_SHARE rows are
    fewer than HOT_SHARE, so they are broadcast (a fixed bound on their number);
    the others are too small to skew a shuffle.
    """
    hot_size = max(total // HOT_SHARE, 1)
    extra = [c for c in groups.columns if c != key]
    hot = groups.filter(F.col(size) > hot_size).select(F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in extra])
    tagged = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left")
    of_hot = tagged.filter(F.col("_hot_key").isNotNull()).select(*rows.columns, *[F.col(f"_hot_{c}").alias(c) for c in extra])
    rest = tagged.filter(F.col("_hot_key").isNull()).select(*rows.columns)
    return of_hot.unionByName(rest.join(groups.filter(F.col(size) <= hot_size), key, "left").select(*of_hot.columns))


def join_large(rows: DataFrame, groups: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """The inner join of rows with their group's row: by join_groups from MANY_ROWS rows on, plainly below.

    Both give the same rows; the plain join has the shorter plan, which spares the
    driver where many rounds follow each other.
    """
    if total < MANY_ROWS:
        return rows.join(groups, key)
    return join_groups(rows, groups, key, size, total).filter(F.col(size).isNotNull())


def join_salted(rows: DataFrame, wide: DataFrame, key: str, by: Column, total: int) -> DataFrame:
    """Join each of ``total`` rows to wide's row of its key, however wide that row is.

    A key of more than total/HOT_SHARE rows is dealt over several salts, by the
    other column, and wide's row goes to each; only those keys (fewer than
    HOT_SHARE) and their numbers of salts are broadcast.
    """
    hot_size = max(total // HOT_SHARE, 1)
    hot = rows.groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > hot_size).select(F.col(key).alias("_hot_key"), F.ceil(F.col("_n") / hot_size).cast("int").alias("_salts"))
    left = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), "_salts"), F.lit(0)).cast("int")).drop("_hot_key", "_salts")
    right = wide.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))).drop("_hot_key", "_salts")
    return left.join(right, [key, "_salt"]).drop("_salt")


def connected_components(stages: Stages, edges: DataFrame) -> DataFrame:
    """(id, component) for every id in edges(a, b); component is the least id reachable.

    Alternates the large-star and small-star steps; each round is written, and
    the rounds stop when the edge set no longer changes.
    """
    now = stages.keep(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    seen, total = None, now.count()
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"), F.count("*").alias("degree"))
        large = join_large(both.filter("b > a"), least, "a", "degree", 2 * total).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.filter("a <> b")
        best = down.groupBy("a").agg(F.min("b").alias("m"), F.count("*").alias("degree"))
        small = join_large(down, best, "a", "degree", total).select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.a", "e.b").filter("a <> b").distinct()
        nxt = stages.keep(small, "star")
        row = nxt.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(row) == seen:
            break
        seen, now, total = tuple(row), nxt, row[0]
    members = nxt.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return members.unionByName(nxt.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct())
