"""What the operators of this package share: the shared folder, saved tables, input columns."""
from __future__ import annotations

import gc
import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The folder that holds the ``sonora`` package; Python workers get it on their path.
CODE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


#: Rows of an Arrow batch, where the session has Spark's default: rows of these tables are whole texts.
BATCH_ROWS = {"10000": "2000"}


def prepare(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package from where the driver found it, and read texts in smaller batches.

    On a cluster whose nodes do not share that folder, pass the package with ``--py-files``.
    """
    rows = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS.get(rows, rows))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if CODE_ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, CODE_ROOT])
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in ``spark.checkpoint.dir``; a scratch folder only in local mode."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(found)
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, deleted when the application ends."""
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(hadoop_path)
    fs.deleteOnExit(hadoop_path)
    return path


def saved(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here and lost executors cost no recomputation."""
    spark = df.sparkSession
    path = f"{fresh_path(spark, name)}/table"
    df.write.option("compression", codec).parquet(path)
    # Spark deletes shuffle files once the driver's collector finds them unused; it may do so now.
    gc.collect()
    spark._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def attached(rows: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner", most: int = 1000) -> DataFrame:
    """``rows`` joined ("inner" or "left") to ``per_key``, which has one row for each key and the key's number of rows as
    ``copies``.

    A key with over one in ``most`` of the counted rows is joined by broadcast, so that its rows stay where they are;
    there are fewer than ``most`` such keys, whatever the input.
    """
    hot = F.col("copies") * most > per_key.agg(F.coalesce(F.sum("copies"), F.lit(0)).alias("copies")).first()[0]
    hot_keys = F.broadcast(per_key.where(hot))
    cold = rows.join(F.broadcast(per_key.where(hot).select(*keys)), keys, "left_anti").join(per_key.where(~hot), keys, how)
    return rows.join(hot_keys, keys).unionByName(cold).drop("copies")


def row_keys(docs: DataFrame, seed: int) -> dict[str, Column]:
    """Two hashes of a whole row; only rows that are equal share both. Columns with maps are hashed as JSON."""
    columns = {c: docs[f"`{c}`"] for c in docs.columns}
    nulls = F.concat(*(F.when(c.isNull(), "0").otherwise("1") for c in columns.values()))
    parts = [F.to_json(F.struct(columns[c])) if "map<" in kind else columns[c] for c, kind in docs.dtypes]
    return {f"row_key{k}": F.xxhash64(F.lit(seed), F.lit(k), nulls, *parts) for k in (1, 2)}


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % modulus


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")
