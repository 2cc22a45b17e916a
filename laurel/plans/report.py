"""The readable report, as ordered lines."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.functions import text as T
from laurel.plans import questions as Q
from laurel.session import stage


def _one_row(answers: DataFrame, k=2):
    """A few ranked names as one comma list; an empty text if there are none."""
    names = F.array_sort(
        F.collect_list(F.struct((-F.col("n")).alias("r"), "first_pos", "first_idx", "name"))
    )
    return answers.agg(F.transform(names, lambda x: x["name"]).alias("names"))


def report_lines(
    awards: DataFrame,
    hosts: DataFrame,
    presenters: DataFrame,
    nominees: DataFrame,
    winners: DataFrame,
    dressed: DataFrame,
    joke: DataFrame,
    predicted: DataFrame,
) -> DataFrame:
    """Rows ``(ord, line)`` in reading order.

    ``awards`` is ``(award_id, award)``; the three answer frames are ``(award, names)``;
    hosts, dressed and joke are ranked mentions; ``predicted`` has a column ``award``.
    """
    def names_of(df, alias):
        return df.select("award", T.comma_list(F.col("names")).alias(alias))

    per_award = (
        awards.join(names_of(presenters, "p"), "award", "left")
        .join(names_of(nominees, "n"), "award", "left")
        .join(names_of(winners, "w"), "award", "left")
    )
    award_lines = per_award.select(
        F.posexplode(
            F.array(
                F.concat(F.lit("Award: "), "award"),
                F.concat(F.lit("Presenters: "), F.coalesce("p", F.lit(""))),
                F.concat(F.lit("Nominees: "), F.coalesce("n", F.lit(""))),
                F.concat(F.lit("Winner: "), F.coalesce("w", F.lit(""))),
                F.lit(""),
            )
        ).alias("i", "line"),
        "award_id",
    ).select(_order(1, F.col("award_id"), F.col("i")), "line")

    host_lines = _one_row(hosts).select(
        F.posexplode(
            F.array(F.concat(F.lit("Host: "), T.comma_list(F.col("names"))), F.lit(""))
        ).alias("i", "line")
    ).select(_order(0, F.lit(0), F.col("i")), "line")

    def single(df, label, section, blank):
        value = F.coalesce(F.get("names", F.lit(0)), F.lit("None"))
        lines = [F.concat(F.lit(label), value)] + ([F.lit("")] if blank else [])
        return _one_row(df, 1).select(F.posexplode(F.array(*lines)).alias("i", "line")).select(
            _order(section, F.lit(0), F.col("i")), "line"
        )

    title = awards.sparkSession.createDataFrame([("List of Predicted Awards:",)], "line STRING")
    listed = predicted.select(
        _order(5, -F.length("award"), F.lit(0)), F.col("award").alias("line")
    )
    out = host_lines.unionByName(award_lines)
    out = out.unionByName(single(dressed, "Best Dressed: ", 2, False))
    out = out.unionByName(single(joke, "Best Joke: ", 3, True))
    out = out.unionByName(title.select(_order(4, F.lit(0), F.lit(0)), "line"))
    return out.unionByName(listed)


def _order(section, group, i):
    return F.struct(
        F.lit(section).alias("section"), group.cast("bigint").alias("grp"), i.cast("int").alias("i")
    ).alias("ord")


def full_report(posts: DataFrame, awards: DataFrame, people: DataFrame = None, n=10) -> DataFrame:
    """All questions over cleaned posts; ``awards`` is ``(award_id, award)``.

    The cleaned posts are written once and read by all questions.
    """
    posts = stage(posts, "clean")
    names = awards.select("award")
    return report_lines(
        awards,
        Q.hosts(posts, people),
        Q.answer_arrays(Q.presenters(posts, names, n), "names"),
        Q.answer_arrays(Q.nominees(posts, names, n)),
        Q.answer_arrays(Q.winners(posts, names, n)),
        Q.best_dressed(posts),
        Q.best_joke(posts),
        Q.award_names(posts, limit=None),
    )
