"""Writers.  Every sink is a distributed write; ordered ones sort by range first."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from laurel.functions import text as T


def _flat(df: DataFrame) -> DataFrame:
    nested = (ST.ArrayType, ST.MapType, ST.StructType)
    return df.select(
        *[
            F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name)
            for f in df.schema
        ]
    )


def write_csv(df: DataFrame, path, header=True, mode="overwrite"):
    """CSV; nested columns become JSON text."""
    _flat(df).write.mode(mode).csv(path, header=header, quote='"', escape='"')


def write_award_winner_csv(winners: DataFrame, path, mode="overwrite"):
    winners.select("award_name", "winner_name").write.mode(mode).csv(path, header=True)


def write_json(df: DataFrame, path, mode="overwrite"):
    df.write.mode(mode).json(path)


def record_text(records: DataFrame, pretty=True) -> DataFrame:
    """One JSON document per record, as column ``value``."""
    options = {"pretty": "true"} if pretty else {}
    return records.select(F.to_json(F.struct("*"), options).alias("value"))


def write_records(records: DataFrame, path, pretty=True, mode="overwrite"):
    record_text(records, pretty).write.mode(mode).text(path)


def long_record_lines(votes: DataFrame, counted=True) -> DataFrame:
    """Lines ``value`` of one JSON object per award, an entry a line, from rows ``(award, role, name, n)``.

    The objects are those of ``award_records``, entries by name and count; a null award or name
    is left out of its entry.  An object is never held whole: its lines are sorted, and
    each needs only the line before it.
    """
    roles = {"winner": "winner", "nominee": "nominees", "presenter": "presenters"}
    place = F.create_map(*[F.lit(v) for i, r in enumerate(roles) for v in (r, i)])
    entry = F.to_json(F.struct("name", "n")) if counted else F.to_json(F.struct("name"))
    if not counted:
        entry = F.substring(entry, F.lit(9), F.length(entry) - 9)  # the bare string of {"name":...}
    told = F.col("role").isin(list(roles)) & (F.lit(counted) | F.col("name").isNotNull())
    entries = votes.where(told).select(
        "award", place[F.col("role")].alias("part"), F.lit(1).alias("kind"), "name", "n", entry.alias("value")
    )
    name = F.to_json(F.struct(F.col("award").alias("name")))
    head = F.concat(F.expr("substring(value, 1, length(value) - 1)"), F.when(F.col("value") == "{}", "").otherwise(","))
    awards = votes.groupBy("award").agg(F.sum("n").alias("votes")).withColumn("value", name).withColumn("head", head)
    opened = [F.concat("head", F.lit('"winner":['))] + [F.lit(f'],"{r}":[') for r in list(roles.values())[1:]]
    closed = F.concat(F.lit("]"), F.coalesce(F.concat(F.lit(',"votes":'), F.col("votes")), F.lit("")), F.lit("}"))
    marks = F.array(*[F.struct(F.lit(i).alias("part"), v.alias("value")) for i, v in enumerate([*opened, closed])])
    borders = awards.select("award", F.inline(marks)).select(
        "award", "part", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("name"), F.lit(None).cast("long").alias("n"), "value"
    )
    order = Window.partitionBy("award").orderBy("part", "kind", "name", "n")
    rows = entries.unionByName(borders).withColumn("last", F.lag("kind").over(order))
    comma = F.when((F.col("kind") == 1) & (F.col("last") == 1), ",").otherwise("")
    return rows.select(F.concat(comma, "value").alias("value"))


def write_long_records(votes: DataFrame, path, counted=True, mode="overwrite"):
    """Records of any size; ``sources.split.json_objects`` reads them by byte ranges."""
    long_record_lines(votes, counted).write.mode(mode).text(path)


def triple_lines(votes: DataFrame, role="winner") -> DataFrame:
    """``name | award | role`` lines of one role; null names are left out."""
    return votes.where((F.col("role") == role) & F.col("name").isNotNull()).select(
        T.make_triple(F.col("name"), F.col("award"), F.lit(role)).alias("value")
    )


def write_triples(votes: DataFrame, path, role="winner", mode="overwrite"):
    triple_lines(votes, role).write.mode(mode).text(path)


def write_report(lines: DataFrame, path, mode="overwrite"):
    """Lines ``(ord, line)`` in order; the part files keep the order by name."""
    lines.orderBy("ord").select("line").write.mode(mode).text(path)
