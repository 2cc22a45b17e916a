"""Where in the order of posts an award is talked about."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.functions import predicates as P
from laurel.functions import spans as S
from laurel.session import stage

WINDOWS = 1024  # windows of one bucket that a task compares with the posts there


def position_stats(found: DataFrame, awards: DataFrame = None, half_width=50) -> DataFrame:
    """Rows ``(award, n, mean, std, lo, hi)``; std is the population deviation.

    With ``awards`` every listed award has a row, with nulls if it is never mentioned.
    """
    stats = found.groupBy("award").agg(
        F.count("*").alias("n"),
        F.avg("pos").alias("mean"),
        F.stddev_pop("pos").alias("std"),
    )
    if awards is not None:
        stats = awards.select("award").join(stats, "award", "left")
    return stats.select(
        "award",
        F.coalesce("n", F.lit(0)).alias("n"),
        "mean",
        "std",
        (F.col("mean") - half_width).alias("lo"),
        (F.col("mean") + half_width).alias("hi"),
    )


def positions_in_range(found: DataFrame, stats: DataFrame) -> DataFrame:
    """Every mention position as a row, with a flag for the range of its award.

    Kept as rows: the list of one much-discussed award has no bound.
    """
    return found.join(stats.select("award", "lo", "hi"), "award").select(
        "award", "pos", F.col("pos").between(F.col("lo"), F.col("hi")).alias("in_range")
    )


def posts_in_windows(posts: DataFrame, stats: DataFrame, half_width=50) -> DataFrame:
    """Posts strictly inside the whole-numbered window of each award.

    Range join as an equi-join: a window touches at most three buckets of its own width,
    and positions are unique, so a bucket of posts holds at most that many rows.  Where many
    windows lie on one place, they are dealt into parts, and the few posts there go to each.
    """
    width = 2 * half_width
    bounds = stats.where(F.col("mean").isNotNull()).select(
        "award", F.col("lo").cast("bigint").alias("lo"), F.col("hi").cast("bigint").alias("hi")
    )
    windows = bounds.withColumn(
        "_bucket",
        F.explode(F.sequence(F.floor(F.col("lo") / width), F.floor(F.col("hi") / width))),
    )
    windows = stage(windows, "windows")  # read twice
    parts = windows.groupBy("_bucket").agg(F.ceil(F.count("*") / WINDOWS).cast("int").alias("_parts"))
    crowded = parts.where("_parts > 1")
    windows = windows.join(crowded, "_bucket", "left").withColumn(
        "_part", F.pmod(F.xxhash64("award"), F.coalesce("_parts", F.lit(1))).cast("int")
    )
    # buckets without windows end here, before anything is copied
    near = posts.withColumn("_bucket", F.floor(F.col("pos") / width)).join(parts, "_bucket")
    near = near.withColumn("_part", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    return (
        near.drop("_parts")
        .join(windows.drop("_parts"), ["_bucket", "_part"])
        .where((F.col("pos") > F.col("lo")) & (F.col("pos") < F.col("hi")))
        .drop("_bucket", "_part", "lo", "hi")
    )


def first_person(posts: DataFrame, person=S.PERSON) -> DataFrame:
    """The first person of each post, without handles and tags."""
    name = F.get(S.person_spans(F.col("text"), person), F.lit(0))
    return posts.withColumn("name", name).where(
        F.col("name").isNotNull() & ~F.col("name").contains("#") & ~F.col("name").contains("@")
    )


def candidate_counts(named: DataFrame) -> DataFrame:
    return named.groupBy("award", "name").agg(F.count("*").alias("n"))
