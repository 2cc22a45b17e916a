"""Merging near-duplicate names and moving their votes."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.functions import predicates as P
from laurel.functions import similarity as M
from laurel.functions.linkage_keys import gram_pair_keys, min_shared_bigrams, numbered_bigrams
from laurel.operators import linkage as L
from laurel.session import stage


PAIRS_PER_ROW = 32  # candidate pairs a key row, beyond which heads go first
CONTAINS, SIMILAR = 0, 1
TAKERS = 1024  # awards of one person under one pair of words that a task compares


def _ranked(nodes: DataFrame) -> DataFrame:
    """Rows ``(id, name, rank)``; the smaller rank comes first: longer, more votes, then name."""
    rank = F.struct((-F.length("name")).alias("l"), (-F.col("votes")).alias("m"), F.col("name").alias("x"))
    return nodes.select(F.monotonically_increasing_id().alias("id"), "name", "votes", rank.alias("rank"))


def _keys(nodes: DataFrame, threshold) -> DataFrame:
    """Rows ``(key, kind, id, rank, looks, holds)``.

    If ``u`` may absorb ``v``, some key has ``u`` as a holder and ``v`` as a looker.  Similar
    names share a pair of rare bigrams, and each is both.  A contained name looks under its
    anchor; the longer one holds it.
    """
    alike = gram_pair_keys(nodes.select("name", "votes"), threshold).select(
        F.xxhash64(F.lit(SIMILAR), "key").alias("key"), F.lit(SIMILAR).alias("kind"), "name",
        F.lit(True).alias("looks"), F.lit(True).alias("holds"),
    )
    anchors = stage(L.anchors_of(nodes.where(F.col("name") != "").select("name")).select("key", "name", "size"), "anchors")
    inner = nodes.select("name", L.sizes_of(anchors).alias("sizes")).select(
        F.explode(L.keys_in(F.col("name"), F.col("sizes"))).alias("key"), "name"
    )
    contained = anchors.select("key", F.lit(CONTAINS).alias("kind"), "name", F.lit(True).alias("looks"), F.lit(False).alias("holds"))
    longer = inner.join(anchors.select("key").distinct(), "key", "left_semi").select(
        "key", F.lit(CONTAINS).alias("kind"), "name", F.lit(False).alias("looks"), F.lit(True).alias("holds")
    )
    return alike.unionByName(contained).unionByName(longer).join(nodes.select("name", "id", "rank"), "name").drop("name")


def _candidates(holders: DataFrame, lookers: DataFrame, threshold) -> DataFrame:
    """Distinct ids ``(u, v)`` that share a key, with lengths that allow a merge; ``u`` ranks first."""
    shorter, longer = -F.col("v.rank.l"), -F.col("u.rank.l")
    fits = F.when(F.col("u.kind") == CONTAINS, longer > shorter).otherwise(2.0 * shorter / (longer + shorter) >= threshold)
    on = (F.col("u.key") == F.col("v.key")) & (F.col("u.kind") == F.col("v.kind")) & (F.col("u.rank") < F.col("v.rank")) & fits
    pairs = holders.where("holds").alias("u").join(lookers.where("looks").alias("v"), on)
    return pairs.select(F.col("u.id").alias("u"), F.col("v.id").alias("v")).distinct()


def _verified(pairs: DataFrame, nodes: DataFrame, threshold) -> DataFrame:
    """The pairs whose first name may absorb the second: it contains it, or the ratio is high enough."""
    side = lambda c: nodes.select(F.col("id").alias(c), F.col("name").alias(f"{c}_name"), F.col("grams").alias(f"{c}_grams"))
    both = pairs.join(side("u"), "u").join(side("v"), "v").where(P.may_merge(F.col("u_name"), F.col("v_name")))
    total = F.length("u_name") + F.length("v_name")
    inside = F.contains("u_name", "v_name") & (F.length("u_name") > F.length("v_name"))
    enough = F.size(F.array_intersect("u_grams", "v_grams")) >= min_shared_bigrams(total, threshold)
    similar = both.where(~inside & (2.0 * F.length("v_name") / total >= threshold) & enough)
    similar = similar.where(M.block_ratio_udf("u_name", "v_name") >= threshold)
    return both.where(inside).select("u", "v").unionByName(similar.select("u", "v"))


def _absorbed_in(edges: DataFrame) -> DataFrame | None:
    """Ids ``v`` that the greedy order absorbs, given all edges between names that are open.

    In rounds: a name that nothing open points at leads, and its successors are absorbed;
    both leave the open edges.
    """
    absorbed = []
    while not edges.isEmpty():
        heads = edges.select("u").distinct().join(edges.select(F.col("v").alias("u")), "u", "left_anti")
        new = stage(edges.join(heads, "u", "left_semi").select("v").distinct(), "absorbed")
        absorbed.append(new)
        gone = heads.unionByName(new.withColumnRenamed("v", "u"))
        edges = stage(edges.join(gone, "u", "left_anti").join(new, "v", "left_anti"), "open")
    return reduce(DataFrame.unionByName, absorbed) if absorbed else None


def _without(rows: DataFrame, ids: DataFrame) -> DataFrame:
    return rows.join(ids.toDF("id"), "id", "left_anti")


def leaders(nodes: DataFrame, threshold=0.85, pairs_per_row=PAIRS_PER_ROW) -> DataFrame:
    """Rows ``(name, leader)``: the greedy consolidation by falling rank.

    Names share keys; a name that no open name of better rank shares a key with can't be
    absorbed and leads.  Where the open names would make too many pairs, as in a large group
    of copies, such heads are taken first: they meet all names under their keys, and what
    they absorb is compared with nothing but leaders from then on, so that a group of copies
    costs about as many comparisons as it has names.  Once few pairs are left, or a round of
    heads no longer helps, the open names meet each other.  Both ways are exact, and a name's
    owner is the best-ranked of all leaders that may absorb it, whenever they turn up.
    """
    nodes = stage(_ranked(nodes.select("name", "votes").where(F.col("name").isNotNull())).withColumn("grams", numbered_bigrams(F.col("name"))), "names")
    keyed = stage(_keys(nodes, threshold), "keys")
    open_keys, ids, followers = keyed, nodes.select("id"), keyed.where("looks")
    edges, taken, led, before = [], [], [], None
    while True:
        sums = open_keys.groupBy("key").agg(F.sum(F.col("holds").cast("double")).alias("h"), F.sum(F.col("looks").cast("double")).alias("l"))
        pairs, rows = sums.agg(F.sum(F.col("h") * F.col("l")), F.sum(F.col("h") + F.col("l"))).first()
        if not pairs or pairs <= pairs_per_row * rows or (before and pairs > 0.9 * before):
            break
        before = pairs
        best = open_keys.where("holds").groupBy("key").agg(F.min("rank").alias("best"))
        beaten = open_keys.where("looks").join(best, "key").where("best < rank").select("id").distinct()
        heads = stage(_without(ids, beaten), "heads")
        followers = followers.join(heads, "id", "left_anti")
        holders = keyed.join(heads, "id", "left_semi")
        found = stage(_verified(_candidates(holders, followers, threshold), nodes, threshold), "edges")
        new = stage(found.select(F.col("v").alias("id")).distinct().join(ids, "id", "left_semi"), "absorbed")
        ids = stage(_without(_without(ids, heads), new), "open")
        open_keys = stage(open_keys.join(ids, "id", "left_semi"), "keys")
        edges.append(found)
        taken.append(new)
        led.append(heads)
    among = stage(_verified(_candidates(open_keys, open_keys, threshold), nodes, threshold), "edges")
    absorbed = _absorbed_in(among)
    last = ids if absorbed is None else _without(ids, absorbed)
    edges.append(among.join(last.withColumnRenamed("id", "u"), "u", "left_semi"))
    if taken:
        # names that heads have absorbed may belong to a better-ranked leader found since
        gone = followers.join(reduce(DataFrame.unionByName, taken), "id", "left_semi")
        edges.append(_verified(_candidates(keyed.join(last, "id", "left_semi"), gone, threshold), nodes, threshold))
    names = nodes.select(F.col("id").alias("u"), F.col("name").alias("leader"), "rank")
    owners = reduce(DataFrame.unionByName, edges).join(names, "u").groupBy(F.col("v").alias("id")).agg(
        F.min_by("leader", "rank").alias("leader")
    )
    return nodes.select("id", "name").join(owners, "id", "left").select("name", F.coalesce("leader", "name").alias("leader"))


def consolidate_votes(votes: DataFrame, threshold=0.85, name_votes=None) -> DataFrame:
    """Votes ``(award, role, name, n)`` with near-duplicate awards merged.

    ``name_votes`` ranks awards of equal length, ``(name, votes)``; by default each award
    has one vote, and a merged award has as many votes as names went into it.
    """
    votes = stage(votes, "votes")  # read twice
    if name_votes is None:
        name_votes = votes.select(F.col("award").alias("name")).distinct().withColumn(
            "votes", F.lit(1)
        )
    owner = leaders(name_votes, threshold).withColumnRenamed("name", "award")
    return (
        votes.join(owner, "award")
        .groupBy(F.col("leader").alias("award"), "role", "name")
        .agg(F.sum("n").alias("n"))
    )


def merged_votes(name_votes: DataFrame, threshold=0.85) -> DataFrame:
    """Rows ``(name, votes)`` of the awards that remain, votes summed."""
    name_votes = stage(name_votes, "votes")  # read twice
    owner = leaders(name_votes, threshold)
    return (
        name_votes.join(owner, "name")
        .groupBy(F.col("leader").alias("name"))
        .agg(F.sum("votes").alias("votes"))
    )


def move_subset_votes(votes: DataFrame) -> DataFrame:
    """Move a person's votes from an award to one that holds all its words.

    An award gives the votes of (role, name) to another award with the same (role, name)
    whose words are a strict superset.  Among several it takes one that gives nothing
    itself, with the fewest award votes, then by name.  Counts add up.

    A superset holds the giver's two rarest words, so each giver looks under that pair only.
    The pairs that an award holds are found once an award, not once a vote.  Where a person
    has many awards under one pair, those that may take are dealt into parts.
    """
    votes = stage(votes, "votes")  # read three times
    award_votes = votes.groupBy("award").agg(F.sum("n").alias("votes"))
    tokens = stage(
        award_votes.select("award", "votes", F.array_sort(F.array_distinct(F.split("award", r"\s+"))).alias("words")), "words"
    )
    listed = tokens.select("award", F.explode("words").alias("word"))
    frequency = listed.groupBy("word").agg(F.count("*").alias("f"))
    rare = F.slice(F.array_sort(F.collect_list(F.struct("f", "word"))), 1, 2)  # of the words of one award
    anchors = listed.join(frequency, "word").groupBy("award").agg(rare.alias("rare")).select(
        "award", F.col("rare")[0]["word"].alias("first"), F.element_at("rare", -1)["word"].alias("second")
    )
    anchors = stage(anchors, "anchors")
    held = (
        tokens.select("award", "words", F.explode("words").alias("first"))
        .join(anchors.select("first", "second").distinct(), "first")
        .where(F.array_contains("words", F.col("second")))
        .select("award", "first", "second")
    )
    rows = votes.select("award", "role", "name").distinct().join(tokens, "award")
    keys = ["first", "second", "role", "name"]
    takers = stage(rows.join(held, "award"), "takers")
    crowds = takers.groupBy(keys).agg(F.ceil(F.count("*") / TAKERS).cast("int").alias("parts")).where("parts > 1")
    whole = F.coalesce("parts", F.lit(1))
    takers = takers.join(crowds, keys, "left").withColumn("part", F.pmod(F.xxhash64("award"), whole).cast("int"))
    givers = rows.join(anchors, "award").join(crowds, keys, "left").withColumn(
        "part", F.explode(F.sequence(F.lit(0), whole - 1))
    )
    a, b = givers.alias("a"), takers.alias("b")
    same = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "part"]]
    pairs = a.join(
        b,
        reduce(lambda x, y: x & y, same)
        & (F.size("a.words") < F.size("b.words"))
        & (F.size(F.array_except("a.words", "b.words")) == 0),
    ).select(
        F.col("a.award").alias("award"),
        F.col("a.role").alias("role"),
        F.col("a.name").alias("name"),
        F.col("b.award").alias("to_award"),
        F.col("b.votes").alias("to_votes"),
    )
    pairs = stage(pairs, "subsets")  # read twice
    giving = pairs.select(F.col("award").alias("to_award"), "role", "name").distinct()
    moves = (
        pairs.join(giving, ["to_award", "role", "name"], "left_anti")
        .groupBy("award", "role", "name")
        .agg(F.min_by("to_award", F.struct("to_votes", "to_award")).alias("to_award"))
    )
    return (
        votes.join(moves, ["award", "role", "name"], "left")
        .groupBy(F.coalesce("to_award", "award").alias("award"), "role", "name")
        .agg(F.sum("n").alias("n"))
    )
