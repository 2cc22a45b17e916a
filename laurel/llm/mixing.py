"""Mixing sources to target weights by hierarchical budgeting (operator 10).

A token budget flows down a tree of domain, language and source.  Siblings share their
parent's budget by weight.  One that can't use its share (all its tokens, for as many epochs
as allowed) takes what it can, and its siblings share the rest by weight; since a parent's
own limit is the sum below it, a shortage leaves a parent only when all its children are
full.  Each leaf then takes a prefix, in tokens, of its documents in the seeded order of
each epoch.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from laurel.llm.common import free_name, stage

WORD = r"[^\x20\x09-\x0D]+"
LEVELS = ("domain", "lang", "source")
# Defaults: the domain is read off the source's last letter; English and domain d0 weigh more.
DOMAIN = "CASE WHEN coalesce(source, '') = '' THEN 'none' ELSE concat('d', cast(ascii(right(source, 1)) % 3 AS string)) END"
WEIGHTS = (
    "CASE domain WHEN 'd0' THEN 3 WHEN 'd1' THEN 2 ELSE 1 END",
    "CASE lang WHEN 'en' THEN 4 WHEN 'none' THEN 1 ELSE 2 END",
    "1",
)
DIGITS = 3  # hex digits of the order key that make a bucket


def _level(nodes: DataFrame, parent: str, name: str, weight: str) -> DataFrame:
    """Adds ``given``, what each node gets of its parent's budget; all whole numbers.

    ``nodes`` have ``parent, name, cap, budget``.  Siblings are taken by rising cap for their
    weight.  Those whose cap is at most their share of what is left are full; they come first
    in this order.  The others divide the rest by weight, rounded down.
    """
    big = "decimal(38,0)"
    rows = nodes.withColumn("w", F.expr(weight).cast("long"))
    order = Window.partitionBy(parent).orderBy(F.col("cap") / F.col("w"), F.col(name))
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    weights = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    rows = rows.withColumn("left", F.col("budget") - before).withColumn("weights", weights)
    full = F.col("cap").cast(big) * F.col("weights").cast(big) <= F.col("w").cast(big) * F.col("left").cast(big)
    rows = rows.withColumn("full", full)
    all_ = Window.partitionBy(parent)
    rest = F.col("budget") - F.coalesce(F.sum(F.when(F.col("full"), F.col("cap"))).over(all_), F.lit(0))
    open_ = F.sum(F.when(~F.col("full"), F.col("w"))).over(all_)
    rows = rows.withColumn("rest", rest.cast(big)).withColumn("open", open_.cast(big))
    share = F.expr(f"CASE WHEN full THEN cap ELSE cast(cast(w AS {big}) * rest DIV open AS bigint) END")
    return rows.withColumn("given", share).drop("w", "left", "weights", "full", "rest", "open")


def allocate(leaves: DataFrame, budget: float, epochs: int, weights=WEIGHTS) -> DataFrame:
    """``domain, lang, source, tokens, given`` of leaves with ``tokens``.

    ``budget`` is a share of all tokens.  A leaf's limit is ``epochs`` times its tokens.
    """
    caps = leaves.withColumn("cap", F.col("tokens") * epochs).withColumn("root", F.lit("all"))
    total = caps.groupBy("root").agg(F.floor(F.sum("tokens") * F.lit(budget)).cast("long").alias("budget"))
    top = caps.groupBy("root", "domain").agg(F.sum("cap").alias("cap")).join(total, "root")
    top = _level(top, "root", "domain", weights[0]).select("domain", F.col("given").alias("budget"))
    mid = caps.groupBy("domain", "lang").agg(F.sum("cap").alias("cap")).join(top, "domain")
    mid = _level(mid, "domain", "lang", weights[1]).select("domain", "lang", F.col("given").alias("budget"))
    low = caps.join(mid, ["domain", "lang"]).withColumn("above", F.to_json(F.struct("domain", "lang")))
    return _level(low, "above", "source", weights[2]).select("domain", "lang", "source", "tokens", "given")


def _key(doc_id: Column, epoch: Column, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def mix(docs: DataFrame, budget=0.8, epochs=2, seed=1, domain=DOMAIN, weights=WEIGHTS, epoch_column=None) -> DataFrame:
    """The chosen documents, with all columns of ``docs``, once for each epoch they are in.

    ``epoch_column`` names a column to add for the epoch, from 0.  ``weights`` are whole
    numbers above zero, SQL over ``domain, lang, source``.  Defined cases: a null lang or
    source is the branch 'none'; a null text has no tokens; a document without tokens is
    chosen wherever the prefix reaches it.  Rows that repeat an id have one place in the
    order and are chosen together or not at all.  A leaf's prefix ends before the document
    that would overrun it.  An empty table gives an empty result.
    """
    own = {c: free_name(docs, c) for c in ("leaf", "tokens", "whole", "rest", "cut", "before", "key", "epoch", "sum")}
    none = F.lit("none")
    where = docs.select(
        "*",
        F.struct(
            F.expr(domain).alias("domain"),
            F.coalesce(F.col("lang").cast("string"), none).alias("lang"),
            F.coalesce(F.col("source").cast("string"), none).alias("source"),
        ).alias(own["leaf"]),
        F.regexp_count(F.coalesce(F.col("text"), F.lit("")), F.lit(WORD)).cast("long").alias(own["tokens"]),
    )
    leaf, tokens = F.col(own["leaf"]), F.col(own["tokens"])
    stats = where.groupBy(leaf.alias("leaf")).agg(F.sum(tokens).alias("tokens")).select("leaf.*", "tokens")
    given = stage(allocate(stats, budget, epochs, weights), "given")
    # whole epochs, and how far into the next
    plan = given.select(
        F.struct("domain", "lang", "source").alias(own["leaf"]),
        F.expr("CASE WHEN tokens = 0 THEN 0 ELSE given DIV tokens END").cast("int").alias(own["whole"]),
        # after the last epoch allowed nothing more fits, not even a document without tokens
        F.expr(f"CASE WHEN tokens = 0 THEN 0 WHEN given DIV tokens >= {epochs} THEN -1 ELSE given % tokens END")
        .cast("long").alias(own["rest"]),
    )
    keyed = where.join(plan, own["leaf"]).withColumn(own["key"], _key(F.col("doc_id"), F.col(own["whole"]), seed))
    bucket = F.substring(own["key"], 1, DIGITS)
    sums = keyed.groupBy(leaf.alias("leaf"), F.col(own["rest"]).alias("rest"), bucket.alias("bucket")).agg(F.sum(tokens).alias("n"))
    running = F.sum("n").over(Window.partitionBy("leaf").orderBy("bucket"))
    # the first bucket that overruns holds the cut; without one, all of the epoch fits
    cut = sums.withColumn("upto", running).where("upto > rest").groupBy("leaf").agg(
        F.min_by(F.struct("bucket", (F.col("upto") - F.col("n")).alias("before")), "bucket").alias("c")
    )
    cut = stage(
        cut.select(F.col("leaf").alias(own["leaf"]), F.col("c.bucket").alias(own["cut"]), F.col("c.before").alias(own["before"])),
        "cuts",
    )
    placed = keyed.join(cut, own["leaf"], "left")
    at = F.col(own["cut"])
    sure = placed.withColumn(
        own["epoch"],
        F.explode(F.when(at.isNull() | (bucket < at), F.sequence(F.lit(0), F.col(own["whole"])))
                  .when(F.col(own["whole"]) > 0, F.sequence(F.lit(0), F.col(own["whole"]) - 1))),
    )
    # only documents of the cut's bucket are ordered one by one
    inside = Window.partitionBy(own["leaf"]).orderBy(own["key"])
    edge = placed.where(bucket == at).withColumn(own["sum"], F.sum(own["tokens"]).over(inside) + F.col(own["before"]))
    edge = edge.where(F.col(own["sum"]) <= F.col(own["rest"])).withColumn(own["epoch"], F.col(own["whole"]))
    names = [*docs.columns, own["epoch"]] if epoch_column else docs.columns
    out = sure.select(names).unionByName(edge.select(names))
    return out.withColumnRenamed(own["epoch"], epoch_column) if epoch_column else out
