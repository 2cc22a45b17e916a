"""Precompute once, serve many times, grade.

``precompute`` writes one table per question; the getters only read and link.
"""

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from laurel import constants as K
from laurel.operators import evidence as E
from laurel.operators import scoring as G
from laurel.plans import questions as Q
from laurel.session import drop_folder, stage
from laurel.sources import sinks


def precompute(raw: DataFrame, folder: str, keep=2):
    """Clean the posts and publish the tables of the draft service under ``folder``.

    The tables go to a version of their own, and a line of the manifest makes it the one that
    is read: readers see the old answers or the new ones, whatever fails on the way.  The last
    ``keep`` versions stay, so that a reader that has begun can end.  One writer at a time.
    """
    spark = raw.sparkSession
    posts = stage(Q.clean_data(raw), "clean")
    wide = E.award_evidence(
        posts, K.WINNER_WORDS_WIDE, filter_ignores_case=True, drop_artefacts=False, suffix_rule=False
    )
    awards = stage(E.first_wins(wide, distinct=True), "winners")
    pairs = stage(E.presenters_by_award(E.presenter_pairs(posts, "sentence")), "presenters")
    done = versions(spark, folder)
    number = done[0][0] + 1 if done else 1
    name = f"version-{number}-{uuid.uuid4().hex}"
    sinks.write_json(awards, f"{folder}/{name}/winners")
    sinks.write_json(pairs, f"{folder}/{name}/presenters")
    sinks.write_json(Q.hosts(posts, fraction=None, show_names=()).select("name", "n"), f"{folder}/{name}/hosts")
    sinks.write_json(E.distinct_awards(awards, pairs), f"{folder}/{name}/awards")
    line = spark.createDataFrame([(number, name)], MANIFEST).coalesce(1)
    sinks.write_json(line, f"{folder}/manifest", mode="append")
    for _, old in done[max(keep - 1, 0):]:
        drop_folder(spark, f"{folder}/{old}")


MANIFEST = "number BIGINT, name STRING"


def versions(spark: SparkSession, folder: str) -> list[tuple[int, str]]:
    """The published versions, newest first; one line was written for each run."""
    try:
        found = spark.read.schema(MANIFEST).json(f"{folder}/manifest")
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return [(r.number, r["name"]) for r in found.orderBy(F.desc("number")).collect()]


TABLES = {
    "winners": "award STRING, role STRING, name STRING, pos BIGINT",
    "presenters": "award STRING, name STRING",
    "hosts": "name STRING, n BIGINT",
    "awards": "award STRING",
}


def read_table(spark: SparkSession, folder: str, question: str) -> DataFrame:
    """A table of the version published last."""
    return spark.read.schema(TABLES[question]).json(f"{folder}/{versions(spark, folder)[0][1]}/{question}")


def served_winners(spark, folder, awards: DataFrame) -> DataFrame:
    """Canonical awards with the winner of the best token-set match."""
    won = read_table(spark, folder, "winners").where(F.col("role") == "winner")
    return Q.fuzzy_values(awards, won.select("award", "name"))


def served_names(spark, folder, awards: DataFrame, question) -> DataFrame:
    """Rows ``(award, name)`` of the best token-set match: presenters or nominees."""
    table = read_table(spark, folder, "presenters" if question == "presenters" else "winners")
    if question == "nominees":
        table = table.where(F.col("role") == "nominee")
    names = table.select("award", "name").distinct()
    best = Q.fuzzy_values(awards, names.select("award").distinct())
    return best.join(names.withColumnRenamed("award", "key"), "key", "left").select("award", "name")


def predictions(
    hosts: DataFrame, awards: DataFrame, nominees: DataFrame, presenters: DataFrame, winners: DataFrame
) -> DataFrame:
    """All answers as rows ``(category, award, result)``; list answers have award ``''``.

    ``nominees`` and ``winners`` are linked rows with ``name``; ``presenters`` with ``names``.
    """
    def listed(df, category, column):
        return df.select(F.lit(category).alias("category"), F.lit("").alias("award"), F.col(column).alias("result"))

    def per_award(df, category, value):
        return df.select(F.lit(category).alias("category"), "award", value.alias("result"))

    out = listed(hosts, "hosts", "name").unionByName(listed(awards, "awards", "award"))
    out = out.unionByName(per_award(nominees, "nominees", F.col("name")))
    out = out.unionByName(per_award(presenters, "presenters", F.explode("names")))
    out = out.unionByName(per_award(winners, "winner", F.col("name")))
    return out.where(F.col("result").isNotNull())


def grade(posts: DataFrame, gold: DataFrame, awards: DataFrame, people=None, year=2013, categories=None) -> DataFrame:
    predicted = predictions(
        Q.hosts(posts, people),
        Q.award_names(posts),
        Q.nominees(posts, awards),
        Q.presenters(posts, awards),
        Q.winners(posts, awards),
    )
    kwargs = {"categories": categories} if categories else {}
    return G.score_grid(predicted, gold, year, **kwargs)
