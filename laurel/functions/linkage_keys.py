"""Join keys that find all pairs of names with a high sequence ratio.

Let M be the characters two names share in order, so the ratio is 2M / (len u + len v).
Deleting a character breaks at most two bigrams of ``u``, inserting one breaks at most one.
With ratio >= t the names therefore share at least (1.5 t - 1)(len u + len v) - 1 bigrams,
repeated ones counted.  If each name is sorted by bigram rarity and its first
``bigrams - shared + 2`` are kept, the two prefixes have two bigrams in common, and a pair of
bigrams is a far rarer join key than one.  Names too short for two shared bigrams use
single ones.
"""

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def min_shared_bigrams(total_length, threshold):
    return F.ceil((1.5 * threshold - 1) * total_length - 1 - 1e-9)


def numbered_bigrams(name):
    """Bigrams with the number of their occurrence, so that repeats stay apart."""
    last = F.length(name) - 1
    plain = F.transform(
        F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>")),
        lambda i: F.substring(name, i, 2),
    )
    return F.transform(
        plain,
        lambda g, i: F.concat(
            g, F.size(F.filter(F.slice(plain, 1, i + 1), lambda h: h == g)).cast("string")
        ),
    )


def gram_pair_keys(names: DataFrame, threshold: float) -> DataFrame:
    """``names`` (name, votes) exploded to rows with ``key`` and all bigrams ``grams``."""
    if threshold <= 0.7:
        raise ValueError("the bigram bound needs a threshold above 0.7")
    per_char = 1.5 * threshold - 1
    partner = 2 / (2 - threshold)  # (shortest allowed partner + own length) / own length
    grams = names.select("name", "votes", numbered_bigrams(F.col("name")).alias("grams"))
    frequency = (
        grams.select(F.explode("grams").alias("gram")).groupBy("gram").agg(F.count("*").alias("f"))
    )
    rare_first = (
        grams.select("name", F.explode("grams").alias("gram"))
        .join(frequency, "gram")
        .groupBy("name")
        .agg(F.array_sort(F.collect_list(F.struct("f", "gram"))).alias("sorted"))
        .select("name", F.transform("sorted", lambda s: s["gram"]).alias("sorted"))
    )
    length = F.length("name")
    shared = F.ceil(per_char * partner * length - 1 - 1e-9)
    # every name this short, and every partner it may have, also uses single bigrams
    short = (2 / per_char) / partner
    short_partner = math.ceil(short * (2 - threshold) / threshold)
    prefix = lambda k: F.slice("sorted", 1, F.greatest(F.size("sorted") - shared + k, F.lit(k)))
    pairs = F.transform(
        prefix(2),
        lambda g, i: F.transform(
            F.slice(prefix(2), i + 2, 1_000_000),
            lambda h: F.concat_ws("\u0001", F.array_sort(F.array(g, h))),
        ),
    )
    keys = F.concat(
        F.when(shared >= 2, F.flatten(pairs)).otherwise(F.array().cast("array<string>")),
        F.when(length <= short_partner, F.col("sorted")).otherwise(F.array().cast("array<string>")),
    )
    return grams.join(rare_first.select("name", keys.alias("keys")), "name").select(
        "name", "votes", "grams", F.explode(F.array_distinct("keys")).alias("key")
    )
