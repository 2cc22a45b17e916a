"""Operators on the post table: cleaning, accounts, first posts."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from laurel import constants as K
from laurel.functions import predicates as P
from laurel.functions import text as T
from laurel.session import stage


def _cleaned(posts, text, value):
    """All columns with a new text, made by a generator: filters on the cleaned text
    then read it instead of cleaning again."""
    return [
        F.explode(F.array(value)).alias(text) if c == text else F.col(c) for c in posts.columns
    ]


def clean_posts(posts: DataFrame, strict_ascii=False, text="text") -> DataFrame:
    """Drop foreign-character and blank posts, clean the others.  One narrow stage."""
    raw = F.col(text)
    return (
        posts.where(raw.isNotNull() & ~T.has_foreign_characters(raw, strict_ascii))
        .select(*_cleaned(posts, text, T.clean(raw)))
        .where(F.col(text) != "")
    )


def clean_posts_alternate(posts: DataFrame, text="text") -> DataFrame:
    raw = F.col(text)
    return (
        posts.where(raw.isNotNull() & ~raw.rlike(K.RETWEET_POST))
        .select(*_cleaned(posts, text, T.clean_alternate(raw)))
        .where(F.col(text) != "")
    )


def dense_positions(rows: DataFrame, *order, name="pos") -> DataFrame:
    """Add the row's place in the order, from 0 on without gaps.

    Rows are dealt out by range and sorted within the parts; a part's first place is the
    number of rows in the parts before it.  Only one count for each part meets in one task.
    """
    dealt = stage(
        rows.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id()),
        "ordered",
    )
    # the number is part << 33 | row, and parts ascend with the order
    part = F.shiftright("_at", 33).alias("_part")
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = dealt.groupBy(part).agg(F.count("*").alias("n")).select(
        "_part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_start")
    )
    placed = dealt.withColumn("_part", F.shiftright("_at", 33)).join(starts, "_part")
    place = F.col("_start") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    others = [c for c in rows.columns if c != name]
    return placed.select(*others, place.alias(name)).select(*dict.fromkeys([*rows.columns, name]))


def account_counts(posts: DataFrame, account=None) -> DataFrame:
    """Rows ``(account, n, first_pos)``; null accounts are skipped."""
    account = T.retweet_token(F.col("text")) if account is None else account
    return (
        posts.select(account.alias("account"), "pos")
        .where(F.col("account").isNotNull())
        .groupBy("account")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    )


def top_k(counts: DataFrame, k: int, *ties) -> DataFrame:
    """The ``k`` most frequent rows, the earlier seen first on equal counts."""
    return counts.orderBy(F.desc("n"), *(ties or ("first_pos",))).limit(k)


def reputable_posts(posts: DataFrame, top_accounts: DataFrame, legacy=False) -> DataFrame:
    """Posts that retweet or mention one of the top accounts.

    ``top_accounts`` comes from ``top_k``, so its names fit one scalar array and no
    post is shuffled.  An account counts if it stands as a token of the post, with or
    without a colon.  ``legacy``: one alternation, any case, where the
    retweet mark binds to the first account only.
    """
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("r"), "first_pos", "account")))
    names = top_accounts.select(ranked.alias("a")).select(
        F.transform("a", lambda x: x["account"]).alias("names")
    )
    if legacy:
        # \Q..\E: an account is data and may hold any character
        quoted = F.transform("names", lambda a: F.concat(F.lit(r"\Q"), F.replace(a, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E")))
        pattern = names.select(F.concat(F.lit(r"(?i)RT\s"), F.array_join(quoted, "|")))
        return posts.where(F.rlike("text", pattern.scalar()))
    plain = names.select(
        F.transform("names", lambda a: F.lower(F.regexp_replace(a, "^@|:$", "")))
    )
    mentioned = F.transform(
        F.regexp_extract_all("text", F.lit(r"@\w+"), F.lit(0)),
        lambda m: F.lower(F.substring(m, 2, 1_000_000)),
    )
    return posts.where(F.arrays_overlap(mentioned, plain.scalar()))


def posts_from_accounts(posts: DataFrame, accounts: DataFrame) -> DataFrame:
    """Posts whose account is in the list (``accounts`` has one column ``account``)."""
    return posts.join(accounts.select("account"), "account", "left_semi")


def first_fraction(posts: DataFrame, fraction=0.1, width=1 << 20) -> DataFrame:
    """The first ``int(fraction * n)`` posts by position, exactly and without a sort.

    ``pos`` is unique, so a bucket of ``width`` positions never holds more than
    ``width`` rows.  Buckets are counted, the one with the cut is found on the counts,
    and only that bucket is ranked.  The posts themselves are then filtered by the cut
    position and never shuffled.
    """
    bucket = F.expr(f"pos div {width}")
    counts = posts.groupBy(bucket.alias("b")).agg(F.count("*").alias("n"))
    upto = Window.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
    everything = Window.orderBy("b").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing
    )
    sized = counts.select(
        "b",
        (F.sum("n").over(upto) - F.col("n")).alias("before"),
        F.sum("n").over(upto).alias("upto"),
        F.floor(F.lit(float(fraction)) * F.sum("n").over(everything)).alias("k"),
    )
    cut = sized.where((F.col("before") < F.col("k")) & (F.col("k") <= F.col("upto"))).select(
        F.struct("b", (F.col("k") - F.col("before")).alias("rank")).alias("cut")
    )
    in_cut = posts.select("pos", bucket.alias("b"), cut.scalar().alias("cut")).where(
        F.col("b") == F.col("cut.b")
    )
    ranked = in_cut.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy("pos")))
    last = ranked.where(F.col("r") == F.col("cut.rank")).select("pos")
    return posts.where(F.col("pos") <= last.scalar())


def keyword_posts(posts: DataFrame, words, ignore_case=True, whole=True) -> DataFrame:
    return posts.where(P.has_word(F.col("text"), words, ignore_case, whole))
