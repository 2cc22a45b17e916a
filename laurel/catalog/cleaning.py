"""Cleaning, filters and accounts."""

import uuid

from pyspark.sql import functions as F

from laurel import constants as K
from laurel.catalog import data as D
from laurel.catalog import sql as Q
from laurel.catalog.registry import query
from laurel.functions import predicates as P
from laurel.functions.spans import entity_spans
from laurel.functions import text as T
from laurel.operators import posts as O
from laurel.session import stage_dir
from laurel.sources import sinks
from laurel.sources.posts import first_posts, read_posts_json, read_text_csv



@query(
    "clean_posts",
    f"SELECT doc_id AS post_id, {D.clean_sql('text')} AS text FROM documents "
    f"WHERE text IS NOT NULL AND NOT {D.FOREIGN_SQL} AND {D.clean_sql('text')} <> ''",
)
def _(spark, sf):
    return O.clean_posts(D.document_posts(spark, sf)).select("post_id", "text")


@query(
    "clean_posts_strict",
    f"SELECT conv_id * 100000 + turn AS post_id, {D.clean_sql('text')} AS text FROM conversations "
    r"WHERE NOT regexp_matches(text, '[^\x00-\x7F]') " + f"AND {D.clean_sql('text')} <> ''",
)
def _(spark, sf):
    return O.clean_posts(D.turn_posts(spark, sf), strict_ascii=True).select("post_id", "text")


@query("clean_event_posts", f"WITH {D.POSTS_SQL} SELECT post_id, account, ts, text FROM posts")
def _(spark, sf):
    return D.clean_event_posts(spark, sf).select("post_id", "account", "ts", "text")


@query(
    "clean_alternate",
    rf"""WITH {D.RAW_SQL}, u AS (SELECT post_id, text FROM raw UNION ALL
      SELECT -doc_id - 1, text FROM documents),
    c AS (SELECT post_id, lower(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text,
      'http\S+|www\S+|pic.twitter\S+', '', 'g'), '{D.EMOJI}', '', 'g'), '#\S+', '', 'g'),
      '[^A-Za-z0-9@ ]+', '', 'g'), ' +', ' ', 'g'))) AS text
      FROM u WHERE NOT regexp_matches(text, '(?i)^rt @\w+'))
    SELECT * FROM c WHERE text <> ''""",
)
def _(spark, sf):
    documents = D.document_posts(spark, sf).withColumn("post_id", -F.col("post_id") - 1)
    both = D.event_posts(spark, sf).unionByName(documents)
    return O.clean_posts_alternate(both).select("post_id", "text")


@query(
    "strip_urls_emoji",
    rf"""WITH {D.RAW_SQL}, u AS (SELECT post_id, text FROM raw UNION ALL SELECT -page_id - 1, 'see ' || url || ' now' FROM pages)
    SELECT post_id, regexp_replace(text, 'http\S+|www\S+|pic.twitter\S+', '', 'g') AS no_url,
           regexp_replace(text, '{D.EMOJI}', '', 'g') AS no_emoji FROM u""",
)
def _(spark, sf):
    pages = D.table(spark, sf, "pages").select(
        (-F.col("page_id") - 1).alias("post_id"), F.concat(F.lit("see "), "url", F.lit(" now")).alias("text")
    )
    posts = D.event_posts(spark, sf).select("post_id", "text").unionByName(pages)
    return posts.select(
        "post_id", T.strip_urls(F.col("text")).alias("no_url"), T.strip_emoji(F.col("text")).alias("no_emoji")
    )


@query(
    "retweet_sources",
    rf"""WITH {D.RAW_SQL} SELECT post_id, nullif(regexp_extract(text, '^RT @(\w+):', 1), '') AS account,
      CASE WHEN string_split(text, ' ')[1] = 'RT' THEN string_split(text, ' ')[2] END AS token,
      CASE WHEN lower(string_split(text, ' ')[1]) = 'rt' THEN string_split(text, ' ')[2] END AS any_token
    FROM raw""",
)
def _(spark, sf):
    return D.event_posts(spark, sf).select(
        "post_id",
        T.retweeted_account(F.col("text")).alias("account"),
        T.retweet_token(F.col("text")).alias("token"),
        T.retweet_token(F.col("text"), ignore_case=True).alias("any_token"),
    )


@query(
    "drop_retweet_marks",
    f"""WITH {D.POSTS_SQL} SELECT post_id, {Q.drop_marks('text')} AS body FROM posts
    UNION ALL SELECT -doc_id - 1, {Q.drop_marks('text')} FROM documents""",
)
def _(spark, sf):
    documents = D.document_posts(spark, sf).withColumn("post_id", -F.col("post_id") - 1)
    both = D.clean_event_posts(spark, sf).unionByName(documents)
    return both.select("post_id", T.drop_retweet_marks(F.col("text")).alias("body"))


@query(
    "norm_text",
    r"SELECT doc_id, lower(regexp_replace(text, '[^\p{L}\p{N}\s]', '', 'g')) AS norm FROM documents",
)
def _(spark, sf):
    return D.table(spark, sf, "documents").select("doc_id", T.norm_text(F.col("text")).alias("norm"))


@query(
    "loose_patterns",
    rf"""SELECT DISTINCT p_name || ' of the ' || p_type || ' - ' || p_brand AS name,
      '\b' || array_to_string(list_filter(regexp_split_to_array(regexp_replace(
        lower(p_name || ' of the ' || p_type || ' - ' || p_brand), '[^\p{{L}}\p{{N}}_\s]', ' ', 'g'), '\s+'),
        lambda w: w <> '' AND w NOT IN ({Q.listed(K.PATTERN_STOP_WORDS)})), '\s*') || '\b' AS pattern
    FROM part""",
)
def _(spark, sf):
    name = F.concat("p_name", F.lit(" of the "), "p_type", F.lit(" - "), "p_brand")
    names = D.table(spark, sf, "part").select(name.alias("name")).distinct()
    return names.select("name", T.loose_pattern(F.col("name")).alias("pattern"))


WORD_FLAGS = {
    "wins": (K.WINNER_WORDS, False, True),
    "wins_wide": (K.WINNER_WORDS_WIDE, True, True),
    "wins_capture": (K.WINNER_WORDS_CAPTURE, True, True),
    "wins_loose": (K.WINNER_WORDS_LOOSE, True, False),
    "nominee": (K.NOMINEE_WORDS, False, True),
    "nominee_noun": (K.NOMINEE_WORDS_NOUN, False, True),
    "nominee_hope": (K.NOMINEE_WORDS_HOPE, True, True),
    "presenter": (K.PRESENTER_WORDS, True, True),
    "host": (K.HOST_WORDS, True, True),
}
_flags = ", ".join(f"{Q.word_match('text', *spec)} AS {name}" for name, spec in WORD_FLAGS.items())


@query(
    "keyword_filters",
    f"WITH {D.POSTS_SQL} SELECT post_id, {_flags}, {Q.word_match('lower(text)', K.AWARD_WORDS, False)} AS award_word FROM posts",
)
def _(spark, sf):
    flags = [P.has_word(F.col("text"), *spec).alias(name) for name, spec in WORD_FLAGS.items()]
    return D.clean_event_posts(spark, sf).select(
        "post_id", *flags, P.has_award_word(F.col("text")).alias("award_word")
    )


@query(
    "keyword_filter_documents",
    f"""WITH {D.DOCUMENTS_SQL} SELECT post_id, {Q.word_match('text', ['that'], False)} AS that,
      {Q.word_match('text', ['from', 'with'])} AS from_with, {Q.word_match('text', ['th'], True, False)} AS th
    FROM posts WHERE {Q.word_match('text', ['from', 'with', 'that'])}""",
)
def _(spark, sf):
    posts = O.keyword_posts(D.document_posts(spark, sf), ["from", "with", "that"])
    return posts.select(
        "post_id",
        P.has_word(F.col("text"), ["that"], ignore_case=False).alias("that"),
        P.has_word(F.col("text"), ["from", "with"]).alias("from_with"),
        P.has_word(F.col("text"), ["th"], whole=False).alias("th"),
    )


@query(
    "phrase_filters",
    f"""WITH {D.POSTS_SQL} SELECT post_id, contains(lower(text), 'best dressed') AS dressed,
      {' OR '.join(f"contains(lower(text), '{p}')" for p in K.JOKE_PHRASES)} AS joke,
      regexp_matches(text, 'award.*wins|(?:wins|Wins|WINS|winner|WINNER).*award|AWARD.*wins') AS award_and_win,
      contains(lower(text), lower('BEST actor')) AS literal FROM posts""",
)
def _(spark, sf):
    return D.clean_event_posts(spark, sf).select(
        "post_id",
        P.has_phrase(F.col("text"), K.DRESS_PHRASES).alias("dressed"),
        P.has_phrase(F.col("text"), K.JOKE_PHRASES).alias("joke"),
        P.has_award_and_win(F.col("text")).alias("award_and_win"),
        P.contains_ignore_case(F.col("text"), F.lit("BEST actor")).alias("literal"),
    )


@query(
    "phrase_filter_documents",
    "SELECT doc_id AS post_id FROM documents WHERE contains(lower(text), 'of the') OR contains(lower(text), 'que la')",
)
def _(spark, sf):
    return D.document_posts(spark, sf).where(P.has_phrase(F.col("text"), ["of the", "que la"])).select("post_id")


_COUNTS = """counts AS (SELECT token AS account, count(*) AS n, min(pos) AS first_pos FROM (
  SELECT pos, CASE WHEN string_split(text, ' ')[1] = 'RT' THEN string_split(text, ' ')[2] END AS token FROM posts)
  WHERE token IS NOT NULL GROUP BY token)"""


@query("account_counts", f"WITH {D.POSTS_SQL}, {_COUNTS} SELECT * FROM counts")
def _(spark, sf):
    return O.account_counts(D.clean_event_posts(spark, sf))


@query(
    "top_accounts",
    f"WITH {D.POSTS_SQL}, {_COUNTS} SELECT * FROM counts ORDER BY n DESC, first_pos LIMIT 3",
)
def _(spark, sf):
    return O.top_k(O.account_counts(D.clean_event_posts(spark, sf)), 3)


@query(
    "source_counts",
    "SELECT source AS account, count(*) AS n, min(doc_id) AS first_pos FROM documents WHERE source IS NOT NULL GROUP BY source",
)
def _(spark, sf):
    return O.account_counts(D.document_posts(spark, sf), F.col("account"))


@query(
    "top_source_posts",
    """WITH top AS (SELECT source FROM documents GROUP BY source ORDER BY count(*) DESC, min(doc_id) LIMIT 2)
    SELECT doc_id AS post_id, source AS account FROM documents WHERE source IN (SELECT source FROM top)""",
)
def _(spark, sf):
    posts = D.document_posts(spark, sf)
    top = O.top_k(O.account_counts(posts, F.col("account")), 2)
    return O.posts_from_accounts(posts, top).select("post_id", "account")


_TOP3 = f"{_COUNTS}, top AS (SELECT * FROM counts ORDER BY n DESC, first_pos LIMIT 3)"


@query(
    "reputable_posts",
    rf"""WITH {D.POSTS_SQL}, {_TOP3},
      m AS (SELECT post_id, unnest(regexp_extract_all(text, '@\w+')) AS m FROM posts)
    SELECT DISTINCT post_id FROM m WHERE lower(substr(m, 2)) IN
      (SELECT lower(regexp_replace(account, '^@|:$', '', 'g')) FROM top)""",
)
def _(spark, sf):
    posts = D.clean_event_posts(spark, sf)
    return O.reputable_posts(posts, O.top_k(O.account_counts(posts), 3)).select("post_id")


@query(
    "reputable_posts_legacy",
    rf"""WITH {D.POSTS_SQL}, {_TOP3} SELECT post_id FROM posts WHERE regexp_matches(text,
      (SELECT '(?i)RT\s' || string_agg(account, '|' ORDER BY n DESC, first_pos) FROM top))""",
)
def _(spark, sf):
    posts = D.clean_event_posts(spark, sf)
    top = O.top_k(O.account_counts(posts), 3)
    return O.reputable_posts(posts, top, legacy=True).select("post_id")


@query(
    "first_fraction",
    "SELECT doc_id AS post_id FROM documents WHERE contains(text, 'the') "
    "QUALIFY row_number() OVER (ORDER BY doc_id) <= floor(0.1 * count(*) OVER ())",
)
def _(spark, sf):
    posts = D.document_posts(spark, sf).where(F.contains(F.col("text"), F.lit("the")))
    return O.first_fraction(posts, 0.1, width=64).select("post_id")


@query("first_posts", "SELECT doc_id AS post_id, text FROM documents ORDER BY doc_id LIMIT 200")
def _(spark, sf):
    return first_posts(D.document_posts(spark, sf), 200).select("post_id", "text")


@query(
    "name_tests",
    f"""WITH {D.POSTS_SQL}, s AS (SELECT post_id, unnest(regexp_extract_all(text, '{Q.ENTITY}')) AS span FROM posts)
    SELECT span, count(*) AS n, NOT regexp_matches(span, '[@#]') AND lower(span) NOT IN ({Q.listed(K.NOT_A_PERSON)})
        AND regexp_matches(span, '^{Q.PERSON_ANY}$') AS human,
      lower(trim(span)) IN ({Q.listed(K.SHOW_NAMES, True)}) AS show,
      regexp_matches(span, '(?i)(win|#|@)') AS artefact,
      len(list_intersect(regexp_split_to_array(lower(span), '\\s+'), ['small', 'golden', 'the'])) > 0 AS overlaps,
      contains(span, 'Actor') = contains('Best Actor', 'Actor') AND contains(span, 'Actress') = contains('Best Actor', 'Actress')
        AND contains(span, 'Director') = contains('Best Actor', 'Director') AND contains(span, 'Screenplay') = contains('Best Actor', 'Screenplay') AS mergeable
    FROM s GROUP BY span""",
)
def _(spark, sf):
    span = F.col("span")
    spans = D.clean_event_posts(spark, sf).select(F.explode(entity_spans(F.col("text"))).alias("span"))
    return spans.groupBy("span").agg(F.count("*").alias("n")).select(
        "span",
        "n",
        P.is_human_name(span).alias("human"),
        P.is_listed(span, K.SHOW_NAMES).alias("show"),
        P.has_artefact(span).alias("artefact"),
        P.names_overlap(span, F.lit("Small Golden The")).alias("overlaps"),
        P.may_merge(span, F.lit("Best Actor")).alias("mergeable"),
    )


# --- files that hold records over several lines ------------------------------------------


@query(
    "array_posts",
    "SELECT doc_id AS post_id, row_number() OVER (ORDER BY doc_id) - 1 AS pos, source AS account, text FROM documents",
)
def _(spark, sf):
    """The documents as JSON arrays of posts, read back by byte ranges."""
    docs = D.table(spark, sf, "documents")
    user = F.struct(F.col("source").alias("screen_name"), F.col("doc_id").cast("long").alias("id"))
    rows = docs.select("text", user.alias("user"), F.col("doc_id").alias("id"), (F.col("doc_id") * 1000).alias("timestamp_ms"))
    folder = f"{stage_dir(spark)}/arrays-{uuid.uuid4().hex}"
    rows.select(F.to_json(F.struct("*"))).write.option("lineSep", ",").text(folder)
    return read_posts_json(spark, folder, one_array=True).select("post_id", "pos", "account", "text")


@query("quoted_csv", "SELECT doc_id, source, text FROM documents WHERE text <> ''")
def _(spark, sf):
    """The documents as CSV with line ends in quotes, read back by byte ranges."""
    docs = D.table(spark, sf, "documents").select("doc_id", "source", "text").where("text <> ''")
    folder = f"{stage_dir(spark)}/csv-{uuid.uuid4().hex}"
    sinks.write_csv(docs, folder)
    return read_text_csv(spark, folder, "doc_id bigint, source string, text string")
