"""Helpers the operators share: ids, bounded samples, tables in the shared folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters between words: space and the controls from tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACES_RE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_mod(column: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit(""))), F.lit(modulus))


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Rows of an Arrow batch while the block runs: whole texts can be long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Store:
    """Tables below the folder that driver and executors share.

    Writing a table cuts its lineage: what later steps read survives the loss
    of any executor. The folder is the session's ``spark.checkpoint.dir``; a
    local session without one (tests) gets a temporary folder.
    """

    def __init__(self, spark: SparkSession, name: str):
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            root = tempfile.mkdtemp(prefix="shortfall-llm-")
        self.spark = spark
        self.root = f"{root}/{name}-{uuid.uuid4().hex}"
        self.written = 0

    def put(self, df: DataFrame, partition_by: str | None = None) -> DataFrame:
        """Write a table and return it as read back."""
        self.written += 1
        path = f"{self.root}/{self.written}"
        writer = df.write.partitionBy(partition_by) if partition_by else df.write
        writer.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, df: DataFrame) -> None:
        """Delete the table behind a frame that ``put`` returned and nothing reads any more."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def sample_texts(rows: DataFrame, label: str, per_label: int, most_chars: int) -> DataFrame:
    """``per_label`` different texts of each label at most, as rows (label, text, repeats).

    Texts are told apart and chosen by 64-bit hashes, so that repeated rows and
    ids, null ids too, change nothing. The choice ranks hashes within 256 parts
    of a label before it ranks the parts' best: no label, however frequent,
    meets in one task. Repeats are added up, not returned as rows. Of a text
    the first ``most_chars`` characters are returned. Null labels are left out.
    """
    rows = rows.filter(F.col(label).isNotNull()).select(
        label, F.coalesce("text", F.lit("")).alias("text"), text_key().alias("text_key")
    )
    return _texts_of(rows, sample_keys(rows, label, per_label), [label, "text_key"], label, most_chars)


def sample_texts_of_ids(
    docs: DataFrame, labels: DataFrame, label: str, per_label: int, most_chars: int
) -> DataFrame:
    """``sample_texts`` of documents whose label stands in another table, by ``doc_id``.

    The texts are chosen by hash first, so only hashes meet the labels in a
    shuffle. The chosen hashes, ``per_label`` of each label, go to the texts by
    broadcast: there must be few labels.
    """
    keyed = docs.select("doc_id", text_key().alias("text_key")).join(labels, "doc_id")
    keys = sample_keys(keyed.filter(F.col(label).isNotNull()), label, per_label)
    texts = docs.select(F.coalesce("text", F.lit("")).alias("text"), text_key().alias("text_key"))
    return _texts_of(texts, F.broadcast(keys), ["text_key"], label, most_chars)


def text_key() -> Column:
    """By what different texts are told apart; a missing text is an empty one."""
    return F.xxhash64(F.coalesce("text", F.lit("")), F.lit(17))


def sample_keys(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """The chosen (label, text_key) of ``sample_texts`` with their repeats."""
    keys = rows.select(label, "text_key").groupBy(label, "text_key").agg(F.count(F.lit(1)).alias("repeats"))
    order = [F.abs(F.col("text_key").bitwiseAND((1 << 62) - 1)), F.col("text_key")]
    for part in ([F.pmod("text_key", F.lit(256))], []):
        rank = F.row_number().over(Window.partitionBy(label, *part).orderBy(*order))
        keys = keys.withColumn("rank", rank).filter(F.col("rank") <= per_label).drop("rank")
    return keys


def _texts_of(
    rows: DataFrame, keys: DataFrame, on: list[str], label: str, most_chars: int
) -> DataFrame:
    cut = rows.withColumn("text", F.substring("text", 1, most_chars))
    return (
        cut.join(keys, on)
        .groupBy(label, "text_key")
        .agg(F.min("text").alias("text"), F.first("repeats").alias("repeats"))
        .drop("text_key")
    )
