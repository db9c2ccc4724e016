"""Folders and files to DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip, unix_newlines

# Texts a CSV reader of the pandas kind takes for a missing value (fixed list).
CSV_MISSING = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)

QA_SCHEMA = "question string, answer string, verified boolean"


def _whole_files(spark: SparkSession, path: str, pattern: str) -> DataFrame:
    return (
        spark.read.option("pathGlobFilter", pattern).option("recursiveFileLookup", "false")
        .text(path, wholetext=True)
        .select(unix_newlines("value").alias("text"), F.col("_metadata.file_name").alias("_file"))
    )


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    """``text, source``: every ``.txt`` file of one folder is a document."""
    return _whole_files(spark, path, "*.txt").select("text", F.col("_file").alias("source"))


def read_mail_csv(spark: SparkSession, path: str, schema: T.StructType | str = "file string, message string") -> DataFrame:
    """Mail CSV with a header; bodies span lines and double their quotes. Give the file's
    schema (one column must be ``message``); texts that stand for a missing value are null."""
    df = (
        spark.read.schema(schema)
        .options(header=True, multiLine=True, quote='"', escape='"', enforceSchema=False)
        .csv(path)
    )
    missing = F.col("message").isin(*CSV_MISSING)
    return df.withColumn("message", F.when(~missing, F.col("message")))


def read_qa_pairs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(QA_SCHEMA).json(path, multiLine=True)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """``file, pos, text`` from the ``.json`` arrays and ``.jsonl`` lines of one folder.

    ``pos`` orders the chunks of a file; the text is ``text`` or else ``content``.
    """
    item = "struct<text:string,content:string>"
    arrays = _whole_files(spark, path, "*.json").select(
        F.col("_file").alias("file"), F.posexplode(F.from_json("text", f"array<{item}>")).alias("_i", "_c")
    ).select("file", F.struct(F.lit(0).cast("bigint").alias("block"), F.col("_i").cast("bigint").alias("line")).alias("pos"), "_c")
    lines = (
        spark.read.option("pathGlobFilter", "*.jsonl").text(path)
        .select(
            F.col("_metadata.file_name").alias("file"),
            F.struct(
                F.col("_metadata.file_block_start").alias("block"),
                F.monotonically_increasing_id().alias("line"),
            ).alias("pos"),
            F.from_json("value", item).alias("_c"),
        )
    )
    both = arrays.unionByName(lines)
    return both.select("file", "pos", F.coalesce("_c.text", "_c.content", F.lit("")).alias("text"))


def read_receipt_pairs(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(texts: ``name, input``, labels: ``name, output``) of a receipt folder, for pairing by stem."""
    texts = _whole_files(spark, path, "*.txt").select(F.col("_file").alias("name"), strip("text").alias("input"))
    labels = _whole_files(spark, path, "*.json").select(F.col("_file").alias("name"), strip("text").alias("output"))
    return texts, labels


MANIFESTS = "_manifests"


def vector_parts(spark: SparkSession, path: str) -> tuple[int, list[str]]:
    """Number of the last whole manifest of a vector table and the folders it names; (0, []) without one."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{MANIFESTS}")
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return 0, []
    names = sorted((f.getPath().getName() for f in files.listStatus(folder)), reverse=True)
    numbers = [n for n in names if n.isdigit()]
    for name in numbers:
        lines = [r.value for r in spark.read.text(f"{path}/{MANIFESTS}/{name}").coalesce(1).collect()]  # a line per append
        if lines and lines[-1] == f"{len(lines) - 1} parts":
            return int(numbers[0]), lines[:-1]
    return int(numbers[0]) if numbers else 0, []


def read_vectors(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a vector table as its last manifest has them."""
    _, parts = vector_parts(spark, path)
    if not parts:
        raise FileNotFoundError(f"no vector table at {path}")
    return spark.read.parquet(*[f"{path}/{p}" for p in parts])
