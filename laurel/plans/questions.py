"""The questions asked of a post table, each a plan from posts to answers.

All take cleaned posts ``(post_id, pos, ts, account, text)``.  Word lists and rules are
parameters; the defaults answer the questions for the built-in event.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel import constants as K
from laurel.functions import predicates as P
from laurel.functions import spans as S
from laurel.functions import text as T
from laurel.operators import consolidate as C
from laurel.operators import evidence as E
from laurel.operators import linkage as L
from laurel.operators import posts as O
from laurel.operators import timing as TI
from laurel.sources.posts import list_frame


def clean_data(raw: DataFrame, **kwargs) -> DataFrame:
    return O.clean_posts(raw, **kwargs)


def hosts(
    posts: DataFrame,
    people: DataFrame = None,
    words=tuple(K.HOST_WORDS),
    fraction=0.1,
    k=2,
    skip=0,
    show_names=tuple(K.SHOW_NAMES),
    person=S.PERSON,
) -> DataFrame:
    """The most named persons in the first posts that speak of hosts: ``(name, n, …)``.

    ``people`` is the lookup dimension; without it every name counts as a person.
    """
    early = O.keyword_posts(posts, words)
    if fraction is not None:
        early = O.first_fraction(early, fraction)
    counts = E.mention_counts(E.mentions(early, S.person_spans(F.col("text"), person)))
    counts = counts.where(~P.is_listed(F.col("name"), show_names))
    if people is not None:
        counts = L.known_people(counts, people)
    return E.ranked_mentions(counts, k, skip)


def hosts_by_top_accounts(posts: DataFrame, n_accounts=1, words=tuple(K.HOST_WORDS), person=S.PERSON) -> DataFrame:
    """Draft form: all persons in host posts retweeted from the top accounts."""
    source = posts.withColumn("account", T.retweeted_account(F.col("text")))
    top = O.top_k(O.account_counts(source, F.col("account")), n_accounts)
    told = O.keyword_posts(O.posts_from_accounts(source, top), words)
    return E.ranked_mentions(E.mention_counts(E.mentions(told, S.person_spans(F.col("text"), person))))


def host_pairs(posts: DataFrame, k=1) -> DataFrame:
    """The most frequent "A and B" post beginnings, split into two names."""
    pairs = posts.select("pos", S.name_pair(F.col("text")).alias("pair")).where("pair IS NOT NULL")
    counts = pairs.groupBy("pair").agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
    two = F.split("pair", " and ")
    return O.top_k(counts, k).select(
        F.get(two, F.lit(0)).alias("name_a"), F.get(two, F.lit(1)).alias("name_b"), "n", "first_pos"
    )


def award_names(
    posts: DataFrame,
    limit=40,
    n_accounts=10,
    words=tuple(K.AWARD_WORDS),
    show_names=tuple(K.SHOW_NAMES),
    legacy_accounts=False,
    **rules,
) -> DataFrame:
    """Award names told by the most retweeted accounts, longest first."""
    top = O.top_k(O.account_counts(posts), n_accounts)
    told = O.reputable_posts(posts, top, legacy_accounts)
    told = told.where(P.has_award_word(F.col("text"), words))
    name = S.award_name(T.token_text(F.col("text")), show_names, **rules)
    found = told.select(F.lower(name).alias("award")).where(F.col("award").isNotNull()).distinct()
    return L.longest_first(L.drop_contained(found), limit)


def _value_per_award(evidence: DataFrame, choice) -> DataFrame:
    value = E.last_value(evidence) if choice == "last" else E.majority_value(evidence)
    return value.select("award", "name")


def winners(posts: DataFrame, awards: DataFrame, n=1, choice="majority", words=tuple(K.WINNER_WORDS), **rules) -> DataFrame:
    """Per canonical award the value of its ``n`` most similar extracted awards.

    ``choice``: an extracted award stands for its most frequent value, or for its ``last``.
    """
    evidence = E.award_evidence(posts, words, "winner", **rules)
    return L.link_values(awards, _value_per_award(evidence, choice), n)


def nominees(posts: DataFrame, awards: DataFrame, n=1, choice="majority", words=tuple(K.NOMINEE_WORDS), **rules) -> DataFrame:
    evidence = E.award_evidence(posts, words, "nominee", **rules)
    return L.link_values(awards, _value_per_award(evidence, choice), n)


def presenters(posts: DataFrame, awards: DataFrame, n=1, scope="post", **rules) -> DataFrame:
    """Per canonical award the presenters (array ``names``) of similar extracted awards."""
    pairs = E.presenter_pairs(posts, scope, **rules)
    return L.link_values(awards, E.last_names(pairs).select("award", "names"), n)


def best_dressed(posts: DataFrame, phrases=tuple(K.DRESS_PHRASES)) -> DataFrame:
    return E.ranked_mentions(E.mention_counts(E.phrase_mentions(posts, phrases)), 1)


def best_joke(posts: DataFrame, phrases=tuple(K.JOKE_PHRASES)) -> DataFrame:
    return E.ranked_mentions(E.mention_counts(E.phrase_mentions(posts, phrases)), 1)


def answer_arrays(linked: DataFrame, column="name") -> DataFrame:
    """Linked rows as one sorted array per award; never null."""
    value = F.collect_set(column)
    if dict(linked.dtypes)[column].startswith("array"):
        return linked.groupBy("award").agg(T.chained_distinct(F.collect_list(column)).alias("names"))
    return linked.groupBy("award").agg(F.array_sort(value).alias("names"))


def fuzzy_values(awards: DataFrame, values: DataFrame) -> DataFrame:
    """Draft linkage: the value of the key with the best token-set ratio."""
    best = L.token_set_best(
        awards.select(F.col("award").alias("target")), values.select(F.col("award").alias("key"))
    )
    return best.join(values.withColumnRenamed("award", "key"), "key", "left").withColumnRenamed(
        "target", "award"
    )


def vote_summary(lines: DataFrame, threshold=0.85) -> DataFrame:
    """Triples to consolidated votes ``(award, role, name, n)``."""
    return C.consolidate_votes(E.votes(E.parse_triples(lines)), threshold)


def timing_candidates(
    posts: DataFrame, awards: DataFrame, people: DataFrame, half_width=50, ignore_case=False, person=S.PERSON
) -> DataFrame:
    """Persons named around the mean position of each award, checked by role."""
    found = L.pattern_mentions(posts, awards, ignore_case)
    stats = TI.position_stats(found, half_width=half_width)
    named = TI.first_person(TI.posts_in_windows(posts, stats, half_width), person)
    return TI.candidate_counts(L.known_people_by_role(named, people))


def timing_award_votes(posts: DataFrame, n_accounts=20, words=tuple(K.AWARD_WORDS), **rules) -> DataFrame:
    """Award names in winner triples of reputable award posts, by falling votes."""
    told = O.reputable_posts(posts, O.top_k(O.account_counts(posts), n_accounts))
    told = told.where(P.has_award_word(F.col("text"), words))
    return E.award_votes(E.hope_triples(told, **rules)).orderBy(F.desc("votes"), "award")


def canonical_awards(spark, names=None) -> DataFrame:
    return list_frame(spark, K.CANONICAL_AWARDS if names is None else names)
