"""Readers: posts, people, gold answers."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from laurel.operators.posts import dense_positions
from laurel.sources import split

RAW_POST = ST.StructType(
    [
        ST.StructField("text", ST.StringType()),
        ST.StructField(
            "user",
            ST.StructType(
                [
                    ST.StructField("screen_name", ST.StringType()),
                    ST.StructField("id", ST.LongType()),
                ]
            ),
        ),
        ST.StructField("id", ST.LongType()),
        ST.StructField("timestamp_ms", ST.LongType()),
    ]
)
GOLD = (
    "hosts ARRAY<STRING>, award_data MAP<STRING, STRUCT<nominees: ARRAY<STRING>, "
    "presenters: ARRAY<STRING>, winner: STRING>>"
)


def read_posts_json(
    spark: SparkSession, path, one_array=False, default_text=None, schema=RAW_POST
) -> DataFrame:
    """Posts with keys ``(post_id, pos, ts, account, text)``.

    Files are JSON lines.  ``one_array``: a file is one JSON array.  Both are read by byte
    ranges.  ``pos`` is the place by time and id, from 0 without gaps.
    """
    if one_array:
        raw = split.json_objects(spark, path).select(F.from_json("value", schema).alias("o")).select("o.*")
    else:
        raw = spark.read.schema(schema).json(path)
    text = F.col("text")
    if default_text is not None:
        text = F.coalesce(text, F.lit(default_text))
    posts = raw.select(
        F.col("id").alias("post_id"),
        F.timestamp_millis(F.col("timestamp_ms")).alias("ts"),
        F.col("user.screen_name").alias("account"),
        text.alias("text"),
    )
    return dense_positions(posts, "ts", "post_id").select("post_id", "pos", "ts", "account", "text")


def read_text_csv(spark: SparkSession, path, schema="text STRING", header=True, multi_line=True) -> DataFrame:
    """``multi_line``: quoted values may hold line ends; files are read by byte ranges all the same.

    A value that holds a quote must then be quoted, with its quotes doubled.  ``header``: the
    first record of a file is left out.
    """
    if not multi_line:
        return spark.read.schema(schema).csv(path, header=header, quote='"', escape='"')
    records = split.csv_records(spark, path).where(F.trim("value") != "")
    if header:
        records = records.where(~F.col("first"))
    schema = schema if isinstance(schema, str) else schema.simpleString()
    options = {"quote": '"', "escape": '"', "multiLine": "true"}
    return records.select(F.from_csv("value", schema, options).alias("o")).select("o.*")


def as_posts(df: DataFrame, post_id, text, pos=None, ts=None, account=None, dense=True) -> DataFrame:
    """Any table with a text column as a post table.

    ``dense``: the position counts posts, with few gaps.  Else it gives the order only, and
    is replaced by the place in that order.
    """
    pos = post_id if pos is None else pos
    posts = df.select(
        F.expr(post_id).cast("bigint").alias("post_id"),
        F.expr(pos).cast("bigint").alias("pos"),
        (F.expr(ts) if ts else F.lit(None)).cast("timestamp").alias("ts"),
        (F.expr(account) if account else F.lit(None)).cast("string").alias("account"),
        F.expr(text).alias("text"),
    )
    return posts if dense else dense_positions(posts, "pos")


def first_posts(posts: DataFrame, n: int) -> DataFrame:
    """The row-limited read: the first ``n`` posts by position."""
    return posts.orderBy("pos").limit(n)


def read_gold(spark: SparkSession, path) -> DataFrame:
    """Rows ``(category, award, answers)``: one per award and category, one for hosts.

    The key list of the award map itself is the category ``awards``.
    """
    doc = spark.read.schema(GOLD).json(path, multiLine=True)
    return gold_rows(doc)


def gold_rows(doc: DataFrame) -> DataFrame:
    per_award = doc.select(F.explode("award_data").alias("award", "a")).select(
        "award",
        F.explode(
            F.create_map(
                F.lit("nominees"), F.coalesce("a.nominees", F.array().cast("array<string>")),
                F.lit("presenters"), F.coalesce("a.presenters", F.array().cast("array<string>")),
                F.lit("winner"), F.filter(F.array("a.winner"), lambda w: w.isNotNull()),
            )
        ).alias("category", "answers"),
    )
    lists = doc.select(
        F.explode(
            F.create_map(
                F.lit("hosts"), F.col("hosts"), F.lit("awards"), F.map_keys("award_data")
            )
        ).alias("category", "answers")
    ).withColumn("award", F.lit(""))
    return per_award.unionByName(lists).select("category", "award", "answers")


def read_people(spark: SparkSession, path) -> DataFrame:
    """The person dimension ``(name, summary)`` that stands in for a page lookup."""
    return spark.read.schema("name STRING, summary STRING").json(path)


def list_frame(spark: SparkSession, values, column="award", key=None) -> DataFrame:
    """A short literal list as a DataFrame, with its order in ``key`` if asked."""
    if key:
        return spark.createDataFrame(list(enumerate(values)), f"{key} INT, {column} STRING")
    return spark.createDataFrame([(v,) for v in values], f"{column} STRING")
