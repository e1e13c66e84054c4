"""Helpers shared by the operators of this subpackage.

Conventions
-----------
* A document row is identified by ``(doc_id, text hash)``.  Rows equal in both
  are one document: they get the same decision.  Rows that share a ``doc_id``
  but differ in text are different documents, ordered by the hash.
* A null text is the empty text.  A null ``doc_id`` is an id of its own that
  sorts first.
* Operators take the names of the id and text columns.  Inside a plan the columns
  of the input have neutral names (``seal``), so none of them can clash with a
  column that the operator adds; result columns replace columns of the same name.
"""

from __future__ import annotations

import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given Parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names.

    It is shared by the driver and all executors.  Only a ``local`` master may
    do without: it gets one scratch folder per process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    if "dir" not in _LOCAL:
        _LOCAL["dir"] = tempfile.mkdtemp(prefix="run-")
    return _LOCAL["dir"]


def cut(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends here.

    A lost executor then costs a re-read, not a recomputation.  The shuffle
    files of the job that wrote it are removed at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    # Spark's own clean-up of shuffle files when an execution ends: without it
    # they stay until the driver happens to collect garbage.
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables that ``cut`` wrote and that no plan still to run reads."""
    for table_ in tables:
        spark = table_.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table_._cut_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def seal(docs: DataFrame, *columns: str):
    """``docs`` with neutral column names, the new names of ``columns``, and the way back.

    ``unseal(df, *results)`` restores the names and appends the result columns.
    """
    names = docs.columns
    low = [n.lower() for n in names]
    inner = docs.toDF(*(f"_c{i}" for i in range(len(names))))

    def unseal(df: DataFrame, *results: str) -> DataFrame:
        new = {r.lower() for r in results}
        return df.select(*(F.col(f"_c{i}").alias(n) for i, n in enumerate(names) if low[i] not in new), *results)

    return inner, [f"_c{low.index(c.lower())}" for c in columns], unseal


def whole_text(text_col: str = "text") -> Column:
    """The text; empty where null."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def text_hash(text_col: str = "text") -> Column:
    """64-bit hash that tells apart rows with one ``doc_id`` and different texts."""
    return F.xxhash64(whole_text(text_col))


def ids_repeat(docs: DataFrame, id_col: str) -> bool:
    """Whether some id occurs more than once."""
    return not docs.groupBy(F.col(id_col)).count().where("count > 1").isEmpty()


def one_of_each(docs: DataFrame, id_col: str, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``docs`` with ``_th``, and the rows (doc_id, th, text) to work on: one of those equal in id and text.

    ``_th`` is the text hash where some id occurs more than once, else 0 (nothing to tell apart).
    """
    repeated = ids_repeat(docs, id_col)
    keyed = docs.withColumn("_th", text_hash(text_col) if repeated else F.lit(0).cast("long"))
    rows = keyed.select(F.col(id_col).alias("doc_id"), F.col("_th").alias("th"), whole_text(text_col).alias("text"))
    return keyed, cut(rows.dropDuplicates(["doc_id", "th"]), "one-of-each") if repeated else rows


def sha256_hex(col: Column) -> Column:
    return F.sha2(col, 256)


def utf8(array: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string array and the n+1 offsets of its values; nulls are empty."""
    if isinstance(array, pa.ChunkedArray):
        array = array.combine_chunks()
    if array.null_count:
        array = array.fill_null("")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    offsets = np.frombuffer(array.buffers()[1], dtype=np.int64 if wide else np.int32)
    offsets = offsets[array.offset:array.offset + len(array) + 1].astype(np.int64)
    data = array.buffers()[2]
    if data is None or not len(array):
        return np.zeros(0, np.uint8), np.zeros(len(array) + 1, np.int64)
    return np.frombuffer(data, dtype=np.uint8), offsets


def texts(array: pa.Array):
    """The UTF-8 bytes of each value, one at a time."""
    data, offsets = utf8(array)
    view = memoryview(data)
    for i in range(len(offsets) - 1):
        yield view[offsets[i]:offsets[i + 1]].tobytes()
