"""Reading the input tables and materialising intermediate results on shared storage."""

from __future__ import annotations

import gc
import os
import shutil
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gamelake.session import scratch_path

# White space of the word rule: space and U+0009..U+000D. Everything else belongs to a word.
SPACE = r"[\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


_shipped: set[str] = set()

# Arrow batches that hold at most this much: texts are long, and a batch exists several
# times between the JVM and Python. Set where the session has Spark's own default.
ARROW_LIMITS = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"),
                "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864", "4194304")}


def ship(spark: SparkSession) -> None:
    """Give the package's code to the Python workers, once a Spark application.

    Workers unpickle functions by module name, so they need the package even where the
    launcher did not put it on their path. Arrow batches get their limits, too.
    """
    sc = spark.sparkContext
    for key, (usual, ours) in ARROW_LIMITS.items():
        if spark.conf.get(key, usual) in (usual, "64MB") and not sc.getConf().contains(key):
            spark.conf.set(key, ours)
    if sc.applicationId not in _shipped:
        root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        made = tempfile.mkdtemp(prefix="gamelake-code-")
        sc.addPyFile(shutil.make_archive(os.path.join(made, "gamelake_code"), "zip", root, "gamelake"))
        _shipped.add(sc.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table; also makes sure that the workers have the code."""
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def lower_ascii(c: Column) -> Column:
    """A-Z lower-cased, every other character as it is."""
    return F.translate(c, UPPER, UPPER.lower())


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the shared checkpoint folder and read it back.

    Cuts the lineage with a table every executor can read again, so a lost executor
    repeats a scan and not the work before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    schema = df.schema
    df.write.parquet(path)
    table = spark.read.schema(schema).parquet(path)
    table.stored_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``stored`` wrote, when nothing reads them any more, and old shuffle files."""
    for t in tables:
        sc = t.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(t.stored_path)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)
    if tables:
        release(tables[0].sparkSession)


def release(spark: SparkSession) -> None:
    """Let the executors delete the shuffle files of finished queries.

    Spark's cleaner removes what the driver has no reference to, which it learns when the
    driver collects its garbage; between two large steps that would be a matter of luck.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; null and blank texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), SPACE), lambda w: w != "")


def training_row(doc_id: Column) -> Column:
    """Rows whose label may be learned: crc32 of the id as text, mod 5, is not 0."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 != 0, F.lit(False))


BROADCAST_ROWS = 1_000_000


def joined_ids(docs: DataFrame, side: DataFrame, how: str, on: str = "doc_id") -> DataFrame:
    """Documents joined with a narrow table of ids.

    The table is counted first: up to ``BROADCAST_ROWS`` rows it is broadcast, so the texts
    stay where they are; beyond, it is a plain equi-join that AQE splits when skewed. ``on``
    names the id on both sides.
    """
    side = stored(side, "ids")
    few = side.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    name = free_name(docs, "other_id")
    side = side.withColumnRenamed(on, name)
    joined = docs.join(F.broadcast(side) if few else side, docs[on] == F.col(name), how)
    return joined.drop(name)
