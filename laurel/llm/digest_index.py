"""Exact dedup against a persistent digest index (operator 9).

The index is a table bucketed and sorted by digest, so that each later batch meets it in a
sort-merge anti-join that shuffles the batch only.  Digests that the index lacks are
appended in the same layout.
"""

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel.llm.common import free_name
from laurel.session import stage, stage_dir

WHITE = r"[\x20\x09-\x0D]+"
BUCKETS = "buckets-"


def text_digest(text):
    """Lower-case hex SHA-256 of the text, runs of ASCII white space as one space, null as ''."""
    return F.sha2(F.regexp_replace(F.coalesce(text, F.lit("")), WHITE, " "), 256)


class DigestIndex:
    """A digest table ``(digest, keep_id, batch)`` in the shared folder, which outlives the session.

    ``add`` takes a batch of documents and returns one row per row of the batch: ``doc_id,
    keep_id, group_size, kept, text_sha256``.  The row that stays is the one the index has
    from an earlier batch, else the smallest doc_id of equal texts; group_size counts the
    equal rows of the batch.  Defined cases: a null text counts as empty, and all empty
    texts are equal; among equal texts null ids lose to any id; if all are null, keep_id is
    null and each counts as kept; rows that repeat both id and text all name that id as
    keep_id.  An empty batch leaves the index as it is.  Other columns of the batch play no
    part.

    The files are the index: a later session opens it by the same name, and the folder's name
    holds the number of buckets, so that the session's settings don't matter; another number
    is refused.  A batch that failed is added again under its own number, ``batch``: what it
    had written already is found and stays its own.  One writer at a time.
    """

    def __init__(self, spark: SparkSession, name: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.name = name or f"digest_index_{uuid.uuid4().hex}"
        self.folder = f"{stage_dir(spark)}/{self.name}"
        there = self._buckets_there()
        if there and buckets not in (None, there):
            raise ValueError(f"the index {self.name} has {there} buckets, not {buckets}")
        self.buckets = there or buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.batches = 0
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # what a session knows of it, not the files
        if there:
            self._create(self.spark.read.parquet(self._path()).schema["keep_id"].dataType.simpleString())
            self.batches = self.table().agg(F.max("batch")).first()[0] or 0

    def _path(self) -> str:
        return f"{self.folder}/{BUCKETS}{self.buckets}"

    def _buckets_there(self) -> int | None:
        """The bucket count of an index that has been written here; None if there is none."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{BUCKETS}*/*.parquet")
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return int(files[0].getPath().getParent().getName().removeprefix(BUCKETS)) if files else None

    def _create(self, id_type: str) -> None:
        self.spark.sql(
            f"CREATE TABLE {self.name} (digest string, keep_id {id_type}, batch int) USING parquet "
            f"CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{self._path()}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Take the table out of the session's catalog; the files stay."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def add(self, docs: DataFrame, batch: int | None = None) -> DataFrame:
        rows = docs.select("doc_id", text_digest(F.col("text")).alias("digest"))
        groups = self._register(rows, batch)
        known = self.table().select("digest", "keep_id")
        decided = groups.join(known.hint("merge"), "digest").select("digest", "keep_id", "group_size")
        # written first: a join of two shuffled sides lets Spark split the rows of a hot text
        decided = stage(decided, "decided")
        return rows.join(decided, "digest").select(
            "doc_id", "keep_id", "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            F.col("digest").alias("text_sha256"),
        )

    def _register(self, rows: DataFrame, batch: int | None = None) -> DataFrame:
        """Append the digests that are new; returns the batch's groups of equal texts."""
        groups = rows.groupBy("digest").agg(
            F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("group_size")
        )
        number = self.batches + 1 if batch is None else batch
        self.batches = max(self.batches, number)
        entries = groups.select("digest", F.col("first_id").alias("keep_id"), F.lit(number).alias("batch"))
        if not self.spark.catalog.tableExists(self.name):
            self._create(rows.schema["doc_id"].dataType.simpleString())
        self._append(entries.join(self.table().select("digest").hint("merge"), "digest", "left_anti"))
        return groups

    def _append(self, entries: DataFrame) -> None:
        (
            entries.repartition(self.buckets, "digest")
            .write.format("parquet").mode("append").option("path", self._path())
            .bucketBy(self.buckets, "digest").sortBy("digest")
            .saveAsTable(self.name)
        )


def exact_dedup(docs: DataFrame, index: DigestIndex | None = None, batch: int | None = None) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns, one for each new text.

    Rows whose text the index knows from an earlier batch go.  A row that repeats both id
    and text stays once.
    """
    own = index is None
    index = index or DigestIndex(docs.sparkSession)
    digest, rank = free_name(docs, "digest"), free_name(docs, "keep_id")
    index._register(docs.select("doc_id", text_digest(F.col("text")).alias("digest")), batch)
    stays = index.table().where(F.col("batch") == (index.batches if batch is None else batch))
    if own:
        index.close()  # the frame keeps its files
    stays = stays.select(F.col("digest").alias(digest), F.col("keep_id").alias(rank))
    keyed = docs.withColumn(digest, text_digest(F.col("text")))
    pairs = (F.col(f"d.{digest}") == F.col(f"s.{digest}")) & F.col("d.doc_id").eqNullSafe(F.col(f"s.{rank}"))
    found = keyed.alias("d").join(stays.alias("s"), pairs, "left_semi")
    # ids differ within a group of copies, so a hot text is dealt over all tasks
    return found.dropDuplicates([digest, "doc_id"]).select(*docs.columns)
