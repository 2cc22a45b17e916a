"""Extraction of evidence rows and their aggregation.

Evidence is one row per finding, ``(post_id, pos, award, name, role)``.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel import constants as K
from laurel.functions import predicates as P
from laurel.functions import spans as S
from laurel.functions import text as T


# --- extraction -----------------------------------------------------------------


def _once(value):
    """A one-row generator: filters above it read the value instead of making it again.

    ``inline(array(struct(…)))`` below serves the same end for several values.
    """
    return F.explode(F.array(value))


def award_evidence(
    posts: DataFrame,
    words=tuple(K.WINNER_WORDS),
    role="winner",
    filter_ignores_case=False,
    show_names=tuple(K.SHOW_NAMES),
    drop_artefacts=True,
    verbs=tuple(K.SUBJECT_VERBS),
    suffix_rule=True,
    **rules,
) -> DataFrame:
    """One (award, name) pair per keyword post.

    The first keyword test is on the post as it is; the second ignores case and runs on
    the post without retweet marks.
    """
    body = F.col("body")
    name = F.coalesce(S.subject(body, verbs), S.first_entity(body))
    award = S.award_name(body, show_names, suffix_rule, **rules)
    found = (
        posts.where(P.has_word(F.col("text"), words, filter_ignores_case))
        .select("post_id", "pos", _once(T.drop_retweet_marks(F.col("text"))).alias("body"))
        .where(P.has_word(body, words))
        .select("post_id", "pos", F.inline(F.array(F.struct(award.alias("award"), name.alias("name")))))
        .where(P.both_present(F.col("award"), F.col("name")))
    )
    if drop_artefacts:
        found = found.where(~P.has_artefact(F.col("award")) & ~P.has_artefact(F.col("name")))
    return found.withColumn("role", F.lit(role))


def hope_triples(posts: DataFrame, words=tuple(K.WINNER_WORDS_CAPTURE), **rules) -> DataFrame:
    """Winner evidence that turns into nominee evidence when the post only hopes.

    Without an award name the text between "wins" and an award word is taken.
    """
    rules = {
        "stop_tokens": K.AFTER_STOP_TOKENS_HYPHEN, "stop_words": (), "max_marks": 0, **rules
    }
    body, text = F.col("body"), F.col("text")
    name = F.coalesce(S.subject(body), S.first_entity(body))
    award = F.coalesce(
        S.award_name(body, (), suffix_rule=False, **rules), S.award_after_verb(text)
    )
    role = F.when(P.has_word(text, K.HOPE_WORDS, whole=False), "nominee").otherwise("winner")
    return (
        posts.select("post_id", "pos", "text", _once(T.drop_retweet_marks(text)).alias("body"))
        .where(P.has_word(body, words))
        .select(
            "post_id",
            "pos",
            F.inline(F.array(F.struct(award.alias("award"), name.alias("name"), role.alias("role")))),
        )
        .where(P.both_present(F.col("award"), F.col("name")))
    )


def nominee_triples(posts: DataFrame, words=tuple(K.NOMINEE_WORDS_HOPE), **rules) -> DataFrame:
    rules = {
        "stop_tokens": K.AFTER_STOP_TOKENS_HYPHEN, "stop_words": (), "max_marks": 0, **rules
    }
    body = F.col("body")
    name = F.coalesce(S.subject(body), S.first_entity(body))
    return (
        posts.select("post_id", "pos", _once(T.drop_retweet_marks(F.col("text"))).alias("body"))
        .where(P.has_word(body, words))
        .select(
            "post_id",
            "pos",
            F.inline(
                F.array(
                    F.struct(S.award_after_best(body, **rules).alias("award"), name.alias("name"))
                )
            ),
        )
        .where(P.both_present(F.col("award"), F.col("name")))
        .withColumn("role", F.lit("nominee"))
    )


def nominations(posts: DataFrame, **rules) -> DataFrame:
    """Evidence of "is nominated for" and "is a nominee for"."""
    return (
        posts.select("post_id", "pos", F.inline(F.array(S.nomination(F.col("text"), **rules))))
        .where(P.both_present(F.col("award"), F.col("name")))
        .withColumn("role", F.lit("nominee"))
        .select("post_id", "pos", "award", "name", "role")
    )


def presenter_pairs(
    posts: DataFrame,
    scope="post",
    words=None,
    show_names=tuple(K.SHOW_NAMES),
    person=S.PERSON,
    width=50,
    suffix_rule=True,
    **rules,
) -> DataFrame:
    """Rows ``(post_id, pos, award, name)``, one per distinct presenter of a post.

    ``scope``: the person stands in the ``post``, in a ``sentence`` with a keyword, or in
    the ``window`` of ``width`` characters around one.
    """
    text = F.col("text")
    if words is None:
        words = K.PRESENTER_WORDS if scope == "post" else K.PRESENTER_WORDS_NEAR
    award = S.award_name(T.token_text(text), show_names, suffix_rule, **rules)
    if scope == "post":
        people = S.person_spans(text, person)
    else:
        people = S.person_spans_not_listed(text, show_names, person)
    if scope == "sentence":
        near = F.filter(
            F.transform(T.sentences(text), F.lower), lambda s: P.has_word(s, words, whole=False)
        )
        people = F.filter(people, lambda p: F.exists(near, lambda s: F.contains(s, F.lower(p))))
    elif scope == "window":
        near = S.windows_around(text, words, width)
        people = F.filter(people, lambda p: F.exists(near, lambda w: F.contains(w, p)))
    return (
        posts.where(P.has_word(text, words, whole=scope != "sentence"))
        .select(
            "post_id",
            "pos",
            F.inline(F.array(F.struct(award.alias("award"), F.array_distinct(people).alias("names")))),
        )
        .where(F.col("award").isNotNull() & (F.size("names") > 0))
        .select("post_id", "pos", "award", F.explode("names").alias("name"))
    )


def mentions(posts: DataFrame, spans=None) -> DataFrame:
    """Rows ``(post_id, pos, idx, name)``, one per span of a post."""
    spans = S.person_spans(F.col("text")) if spans is None else spans
    return posts.select("post_id", "pos", F.posexplode(spans).alias("idx", "name"))


def labelled_entities(posts: DataFrame, gazetteer: DataFrame, labels=None, spans=None) -> DataFrame:
    """Spans with the label of a gazetteer ``(name, label)``, any case."""
    spans = S.entity_spans(F.col("text")) if spans is None else spans
    known = gazetteer.select(F.lower("name").alias("key"), "label").distinct()
    if labels:
        known = known.where(F.col("label").isin(list(labels)))
    return (
        mentions(posts, spans)
        .withColumn("key", F.lower("name"))
        .join(known, "key")
        .select("post_id", "pos", "idx", "name", "label")
    )


def gazetteer_spans(posts: DataFrame, gazetteer: DataFrame) -> DataFrame:
    """Gazetteer names found as word runs of a post, any case.

    For lower-case posts, where capitals give no hint.  Each post emits its word runs of
    the lengths that the gazetteer has; a hash join keeps the known ones.
    """
    toks = T.tokens(F.lower(F.col("text")))
    known = gazetteer.select(
        T.tokens(F.lower("name")).alias("toks"), F.col("name"), "label"
    ).where(F.size("toks") > 0)
    lengths = known.agg(F.collect_set(F.size("toks"))).scalar()
    known = known.select(F.array_join("toks", " ").alias("key"), "name", "label").distinct()
    fitting = F.filter("lengths", lambda n: n <= F.size("toks") - F.col("idx"))
    return (
        posts.select("post_id", "pos", toks.alias("toks"), lengths.alias("lengths"))
        .select("post_id", "pos", "toks", "lengths", F.posexplode("toks").alias("idx", "first"))
        .select(
            "post_id",
            "pos",
            "idx",
            F.explode(
                F.transform(fitting, lambda n: F.array_join(F.slice("toks", F.col("idx") + 1, n), " "))
            ).alias("key"),
        )
        .join(known, "key")
        .select("post_id", "pos", "idx", "name", "label")
    )


def first_spans(spans: DataFrame) -> DataFrame:
    """The first span of each post, the longest on equal places."""
    best = F.min(F.struct("idx", (-F.length("name")).alias("l"), "name")).alias("m")
    return spans.groupBy("post_id", "pos").agg(best).select("post_id", "pos", "m.name")


def near_winners(posts: DataFrame, words=tuple(K.WINNER_WORDS_LOOSE), **kwargs) -> DataFrame:
    """The combined record: persons near a winner word and the category behind it."""
    text = F.col("text")
    toks = T.token_text(text)
    people = F.filter(S.persons_near_keyword(toks, words, **kwargs), lambda p: ~P.is_handle_or_tag(p))
    winners = F.when(F.size(people) > 0, people)
    record = F.struct(
        winners.alias("winner"),
        winners.alias("nominees"),
        F.array().cast("array<string>").alias("presenters"),
        F.coalesce(S.category_after_keyword(text, words), F.lit("N/A")).alias("award_category"),
    )
    return posts.where(P.has_word(text, words, whole=False)).select(
        "post_id", "pos", F.inline(F.array(record))
    )


def subject_entities(posts: DataFrame, verbs=tuple(K.SUBJECT_VERBS)) -> DataFrame:
    """The first entity that contains the subject's last word."""
    text = F.col("text")
    head = F.element_at(F.split(S.subject(text, verbs), " "), -1)
    hits = F.filter(S.entity_spans(text), lambda e: P.contains_ignore_case(e, head))
    return posts.select("post_id", "pos", F.get(hits, F.lit(0)).alias("name")).where(
        F.col("name").isNotNull()
    )


def pattern_matches(posts: DataFrame) -> DataFrame:
    return posts.select("post_id", "pos", F.inline(S.two_part_patterns(F.col("text"))))


def phrase_mentions(posts: DataFrame, phrases, person=S.PERSON_ANY) -> DataFrame:
    """Human names in posts with one of the phrases (best dressed, best joke)."""
    named = mentions(posts.where(P.has_phrase(F.col("text"), phrases)), S.person_spans(F.col("text"), person))
    return named.where(P.is_human_name(F.col("name")))


# --- counting ----------------------------------------------------------------------


def mention_counts(named: DataFrame) -> DataFrame:
    """Rows ``(name, n, first_pos, first_idx)``; the first place breaks ties.

    Place and index travel as one number, which a hash aggregate can hold; the minimum of
    a struct would sort all mentions.
    """
    place = F.col("pos").cast("decimal(19,0)") * F.lit(10**9) + F.col("idx")
    return (
        named.groupBy("name")
        .agg(F.count("*").alias("n"), F.min(place).alias("first"))
        .select(
            "name",
            "n",
            F.expr("first div 1000000000").cast("bigint").alias("first_pos"),
            (F.col("first") % F.lit(10**9)).cast("int").alias("first_idx"),
        )
    )


def ranked_mentions(counts: DataFrame, k=None, skip=0) -> DataFrame:
    """The listing by falling count; ``k`` names after the first ``skip``."""
    ordered = counts.orderBy(F.desc("n"), "first_pos", "first_idx")
    if skip:
        ordered = ordered.offset(skip)
    return ordered if k is None else ordered.limit(k)


def _last_rows(evidence: DataFrame) -> DataFrame:
    """Rows of each award's last post, with the place where the award was seen first.

    Both places come from a hash aggregate; the rows are joined back to it.
    """
    places = evidence.groupBy("award").agg(
        F.max("pos").alias("pos"), F.min("pos").alias("key_order")
    )
    return evidence.join(places, ["award", "pos"])


def last_value(evidence: DataFrame) -> DataFrame:
    """Per award the value of its last post, and where the award was seen first."""
    return _last_rows(evidence).select("award", "name", "key_order")


def majority_value(evidence: DataFrame) -> DataFrame:
    """Per award the most frequent value, the earlier seen on ties."""
    return (
        evidence.groupBy("award", "name")
        .agg(F.count("*").alias("n"), F.min("pos").alias("first_pos"))
        .groupBy("award")
        .agg(
            F.min_by("name", F.struct(-F.col("n"), "first_pos", "name")).alias("name"),
            F.min("first_pos").alias("key_order"),
        )
    )


def last_names(pairs: DataFrame) -> DataFrame:
    """Per award all names of its last post, as one short sorted array."""
    return (
        _last_rows(pairs)
        .groupBy("award", "key_order")
        .agg(F.array_sort(F.collect_set("name")).alias("names"))
    )


def first_wins(evidence: DataFrame, distinct=False) -> DataFrame:
    """Rows ``(award, role, name, pos)``: the first name wins, later ones are nominees.

    The winner comes from a partial aggregate, so an award with very many posts is never
    sorted in one task.  ``distinct``: each other name once, by its first place.
    """
    first = evidence.groupBy("award").agg(F.min("pos").alias("first_pos"))
    placed = evidence.select("award", "name", "pos").join(first, "award")
    is_first = F.col("pos") == F.col("first_pos")
    role = F.when(is_first, "winner").otherwise("nominee").alias("role")
    if not distinct:
        return placed.select("award", role, "name", "pos")
    # a later value equal to the winner still becomes a nominee, once
    return (
        placed.groupBy("award", role, "name")
        .agg(F.min("pos").alias("pos"))
        .select("award", "role", "name", "pos")
    )


def presenters_by_award(pairs: DataFrame) -> DataFrame:
    """The set of presenters per award, as rows."""
    return pairs.select("award", "name").distinct()


def votes(evidence: DataFrame) -> DataFrame:
    return evidence.groupBy("award", "role", "name").agg(F.count("*").alias("n"))


def single_winner(evidence: DataFrame) -> DataFrame:
    """The winner as a single value: the last one seen."""
    return last_value(evidence.where(F.col("role") == "winner")).select("award", "name")


def award_votes(evidence: DataFrame) -> DataFrame:
    """Votes per award: every occurrence counts."""
    return evidence.groupBy("award").agg(F.count("*").alias("votes"))


def distinct_awards(*evidence: DataFrame) -> DataFrame:
    """Distinct award names over several questions."""
    out = evidence[0].select("award")
    for other in evidence[1:]:
        out = out.unionByName(other.select("award"))
    return out.distinct()


def triples(evidence: DataFrame) -> DataFrame:
    return evidence.select(
        "post_id", "pos", T.make_triple(F.col("name"), F.col("award"), F.col("role")).alias("triple")
    )


def parse_triples(lines: DataFrame, column="triple", lower=False) -> DataFrame:
    """Evidence rows from ``name | award | role`` texts; others are dropped."""
    value = F.lower(column) if lower else F.col(column)
    others = [c for c in lines.columns if c != column]
    return lines.select(*others, F.inline(F.array(T.split_triple(value)))).where(
        F.col("role").isNotNull()
    )


ROLES = ["winner", "nominee", "presenter"]


def award_records(votes: DataFrame, counted=True) -> DataFrame:
    """One record per award, at any size: name, role lists and votes, for the JSON sinks.

    A record is one JSON object, so it is as large as its award's list of names; the rows of
    ``votes`` with ``award_votes`` hold the same facts without lists.
    """
    entry = F.struct("name", "n") if counted else F.col("name")

    def role_list(role):
        return F.array_sort(F.collect_list(F.when(F.col("role") == role, entry)))

    return (
        votes.groupBy("award")
        .agg(
            F.sum("n").alias("votes"),
            *[role_list(r).alias(a) for r, a in zip(ROLES, ["winner", "nominees", "presenters"])],
        )
        .select(F.col("award").alias("name"), "winner", "nominees", "presenters", "votes")
    )


def fill_defaults(records: DataFrame) -> DataFrame:
    none = F.array().cast("array<string>")
    return records.select(
        "award",
        F.coalesce("nominees", none).alias("nominees"),
        F.coalesce("presenters", none).alias("presenters"),
        "winner",
    )
