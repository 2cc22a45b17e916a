"""Span rules and evidence rows."""

from pyspark.sql import functions as F

from laurel import constants as K
from laurel.catalog import data as D
from laurel.catalog import sql as Q
from laurel.catalog.registry import query
from laurel.functions import predicates as P
from laurel.functions import spans as S
from laurel.functions import text as T
from laurel.operators import evidence as E
from laurel.operators import linkage as L


def posts_of(spark, sf):
    return D.clean_event_posts(spark, sf)


def with_sql(*ctes, select):
    return "WITH " + ", ".join([D.POSTS_SQL, *ctes]) + " " + select


PEOPLE_SPANS = f"regexp_extract_all(text, '{Q.PERSON}')"
ENTITIES = f"regexp_extract_all(text, '{Q.ENTITY}')"


def exploded(spans, source="posts", name="spans"):
    return (
        f"{name} AS (SELECT post_id, pos, text, generate_subscripts(sp, 1) - 1 AS idx, unnest(sp) AS name "
        f"FROM (SELECT *, {spans} AS sp FROM {source}))"
    )


# --- names ----------------------------------------------------------------------------


@query("person_spans", with_sql(exploded(PEOPLE_SPANS), select="SELECT post_id, idx::INTEGER AS idx, name FROM spans"))
def _(spark, sf):
    return E.mentions(posts_of(spark, sf)).select("post_id", "idx", "name")


@query(
    "document_entity_spans",
    f"WITH {D.DOCUMENTS_SQL}, {exploded(ENTITIES)} SELECT post_id, idx::INTEGER AS idx, name FROM spans",
)
def _(spark, sf):
    spans = S.entity_spans(F.col("text"))
    return E.mentions(D.document_posts(spark, sf), spans).select("post_id", "idx", "name")


@query(
    "first_entity",
    f"""WITH {D.DOCUMENTS_SQL}, u AS (SELECT post_id, text FROM posts UNION ALL
      SELECT -conv_id * 100000 - turn - 1, text FROM conversations)
    SELECT post_id, {Q.first_entity('text')} AS name FROM u""",
)
def _(spark, sf):
    turns = D.turn_posts(spark, sf).withColumn("post_id", -F.col("post_id") - 1)
    both = D.document_posts(spark, sf).unionByName(turns)
    return both.select("post_id", S.first_entity(F.col("text")).alias("name"))


@query(
    "persons_not_listed",
    with_sql(
        exploded(PEOPLE_SPANS),
        select=f"""SELECT post_id, (row_number() OVER (PARTITION BY post_id ORDER BY idx) - 1)::INTEGER AS i, name
          FROM spans WHERE lower(trim(name)) NOT IN ({Q.listed(K.SHOW_NAMES, True)})""",
    ),
)
def _(spark, sf):
    spans = S.person_spans_not_listed(F.col("text"), K.SHOW_NAMES)
    return E.mentions(posts_of(spark, sf), spans).select("post_id", F.col("idx").alias("i"), "name")


GAZETTEER_SQL = """gaz AS (SELECT p AS name, CASE WHEN min(p_partkey) % 2 = 0 THEN 'PERSON' ELSE 'WORK_OF_ART' END AS label
  FROM names GROUP BY p)"""


def gazetteer(spark, sf):
    return (
        D.table(spark, sf, "part")
        .groupBy(D.part_name().alias("name"))
        .agg(F.min("p_partkey").alias("id"))
        .select(
            "name", F.when(F.col("id") % 2 == 0, "PERSON").otherwise("WORK_OF_ART").alias("label")
        )
    )


@query(
    "labelled_entities",
    with_sql(
        GAZETTEER_SQL, exploded(PEOPLE_SPANS),
        select="SELECT post_id, idx::INTEGER AS idx, s.name, label FROM spans s JOIN gaz g ON lower(g.name) = lower(s.name) WHERE label = 'PERSON'",
    ),
)
def _(spark, sf):
    spans = S.person_spans(F.col("text"))
    return E.labelled_entities(posts_of(spark, sf), gazetteer(spark, sf), ["PERSON"], spans).select(
        "post_id", "idx", "name", "label"
    )


@query(
    "gazetteer_spans",
    with_sql(
        GAZETTEER_SQL,
        f"toks AS (SELECT post_id, {Q.tokens('lower(text)')} AS t FROM posts)",
        "runs AS (SELECT post_id, i - 1 AS idx, array_to_string(t[i:i+2], ' ') AS k FROM (SELECT post_id, t, unnest(range(1, len(t)+1)) AS i FROM toks))",
        select="SELECT post_id, idx::INTEGER AS idx, name, label FROM runs JOIN gaz ON lower(name) = k",
    ),
)
def _(spark, sf):
    found = E.gazetteer_spans(posts_of(spark, sf), gazetteer(spark, sf))
    return found.select("post_id", "idx", "name", "label")


@query(
    "first_gazetteer_name",
    with_sql(
        GAZETTEER_SQL,
        f"toks AS (SELECT post_id, pos, {Q.tokens('lower(text)')} AS t FROM posts)",
        "runs AS (SELECT post_id, pos, i, array_to_string(t[i:i+2], ' ') AS k FROM (SELECT post_id, pos, t, unnest(range(1, len(t)+1)) AS i FROM toks))",
        select="SELECT post_id, pos, name FROM runs JOIN gaz ON lower(name) = k QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY i) = 1",
    ),
)
def _(spark, sf):
    return E.first_spans(E.gazetteer_spans(posts_of(spark, sf), gazetteer(spark, sf)))


# --- subjects and award names ---------------------------------------------------------------


@query(
    "subject_spans",
    with_sql(select=f"SELECT post_id, {Q.subject('text')} AS name FROM posts"),
)
def _(spark, sf):
    return posts_of(spark, sf).select("post_id", S.subject(F.col("text")).alias("name"))


@query(
    "subject_spans_documents",
    f"SELECT doc_id AS post_id, {Q.subject('text', ['is', 'was', 'are'])} AS name FROM documents",
)
def _(spark, sf):
    return D.document_posts(spark, sf).select(
        "post_id", S.subject(F.col("text"), ["is", "was", "are"]).alias("name")
    )


def _phrases_sql(source, text, **rules):
    return (
        f"tk AS (SELECT *, {Q.tokens(text)} AS t FROM {source}), "
        f"ph AS (SELECT *, {Q.phrases_after('t', **rules)} AS ph FROM tk)"
    )


@query(
    "award_after_best",
    with_sql(_phrases_sql("posts", "text"), select=f"SELECT post_id, {Q.longest('ph')} AS award, len(ph)::INTEGER AS n FROM ph"),
)
def _(spark, sf):
    toks = T.token_text(F.col("text"))
    return posts_of(spark, sf).select(
        "post_id", S.award_after_best(toks).alias("award"), F.size(S.phrases_after(toks)).alias("n")
    )


STRICT = {"stop_tokens": K.AFTER_STOP_TOKENS_HYPHEN, "stop_words": ["for"], "max_marks": 0}


@query(
    "award_after_best_strict",
    with_sql(_phrases_sql("posts", "text", **STRICT), select=f"SELECT post_id, {Q.longest('ph')} AS award FROM ph"),
)
def _(spark, sf):
    toks = T.token_text(F.col("text"))
    return posts_of(spark, sf).select("post_id", S.award_after_best(toks, **STRICT).alias("award"))


OF_RULES = {"marker": "of", "stop_words": ["for", "by", "is"]}


@query(
    "phrase_after_of",
    f"""WITH turns AS (SELECT conv_id * 100000 + turn AS post_id, text FROM conversations),
      {_phrases_sql('turns', 'text', verbs=['with', 'and'], **OF_RULES)}
    SELECT post_id, {Q.longest('ph')} AS phrase FROM ph""",
)
def _(spark, sf):
    toks = T.token_text(F.col("text"))
    return D.turn_posts(spark, sf).select(
        "post_id", S.award_after_best(toks, clause_verbs=["with", "and"], **OF_RULES).alias("phrase")
    )


@query(
    "award_before_marker",
    with_sql(
        f"tk AS (SELECT *, {Q.tokens('text')} AS t FROM posts)",
        select=f"SELECT post_id, {Q.award_before('t')} AS before, {Q.award_suffix(Q.token_text('text'))} AS suffix FROM tk",
    ),
)
def _(spark, sf):
    toks = T.token_text(F.col("text"))
    return posts_of(spark, sf).select(
        "post_id", S.award_before(toks).alias("before"), S.award_suffix(toks).alias("suffix")
    )


@query(
    "award_name_per_post",
    with_sql(Q.with_awards(), select="SELECT post_id, award, award_any FROM awarded"),
)
def _(spark, sf):
    toks = T.token_text(F.col("text"))
    return posts_of(spark, sf).select(
        "post_id", S.award_name(toks).alias("award"), S.award_name(toks, ()).alias("award_any")
    )


@query(
    "award_after_verb",
    with_sql(
        select=r"SELECT post_id, nullif(regexp_extract(text, '(?i)wins\s+(.*?\b(?:award|prize|honor|medal|trophy)\b)', 1), '') AS award FROM posts"
    ),
)
def _(spark, sf):
    return posts_of(spark, sf).select("post_id", S.award_after_verb(F.col("text")).alias("award"))


_pairs = ", ".join(
    f"nullif(regexp_extract(text, '(?i){d}.*{c}', 0), '')"
    for d in K.AWARD_DESCRIPTORS
    for c in K.AWARD_CATEGORIES
)


@query("infer_category", with_sql(select=f"SELECT post_id, coalesce({_pairs}) AS award FROM posts"))
def _(spark, sf):
    return posts_of(spark, sf).select("post_id", S.descriptor_category(F.col("text")).alias("award"))


_COLOURS, _THINGS = ["red", "small", "hot"], ["widget", "gear", "bolt", "ring"]
_part_pairs = ", ".join(
    f"nullif(regexp_extract(p_name, '(?i){c}.*{o}', 0), '')" for c in _COLOURS for o in _THINGS
)


@query("infer_category_parts", f"SELECT p_partkey, coalesce({_part_pairs}) AS category FROM part")
def _(spark, sf):
    return D.table(spark, sf, "part").select(
        "p_partkey", S.descriptor_category(F.col("p_name"), _COLOURS, _THINGS).alias("category")
    )


# --- evidence --------------------------------------------------------------------------------

EVIDENCE = ["post_id", "pos", "award", "name"]


@query(
    "winner_evidence",
    with_sql(Q.evidence(K.WINNER_WORDS), select="SELECT * FROM evidence"),
)
def _(spark, sf):
    return E.award_evidence(posts_of(spark, sf)).select(*EVIDENCE)


@query(
    "winner_evidence_wide",
    with_sql(
        Q.evidence(K.WINNER_WORDS_WIDE, first_ignores_case=True, artefacts=False, suffix_rule=False),
        select="SELECT * FROM evidence",
    ),
)
def _(spark, sf):
    return E.award_evidence(
        posts_of(spark, sf), K.WINNER_WORDS_WIDE, filter_ignores_case=True,
        drop_artefacts=False, suffix_rule=False,
    ).select(*EVIDENCE)


@query(
    "nominee_evidence",
    with_sql(Q.evidence(K.NOMINEE_WORDS), select="SELECT * FROM evidence"),
)
def _(spark, sf):
    return E.award_evidence(posts_of(spark, sf), K.NOMINEE_WORDS, "nominee").select(*EVIDENCE)


DOC_WORDS, DOC_VERBS = ["with", "from"], ["is", "was", "are", "by"]
DOC_RULES = {"marker": "the", "stop_words": ["for", "by"], "verbs": ["is", "was", "are", "and"]}


@query(
    "evidence_turns",
    "WITH turns AS (SELECT conv_id * 100000 + turn AS post_id, conv_id * 100000 + turn AS pos, text FROM conversations), "
    + f"""ev_in AS (SELECT * FROM turns WHERE {Q.word_match('text', DOC_WORDS)}),
{Q.with_awards('ev_in', Q.drop_marks('text'), 'ev_a', **DOC_RULES)}
SELECT post_id, pos, award, name FROM (SELECT *, coalesce({Q.subject('body', DOC_VERBS)}, {Q.first_entity('body')}) AS name FROM ev_a)
WHERE award IS NOT NULL AND name IS NOT NULL""",
)
def _(spark, sf):
    return _free_evidence(D.turn_posts(spark, sf))


def _free_evidence(posts):
    rules = {"clause_verbs" if k == "verbs" else k: v for k, v in DOC_RULES.items()}
    return E.award_evidence(
        posts, DOC_WORDS, filter_ignores_case=True, drop_artefacts=False, verbs=DOC_VERBS, **rules
    ).select(*EVIDENCE)


@query(
    "evidence_documents",
    f"""WITH ev_in AS (SELECT doc_id AS post_id, doc_id AS pos, {Q.drop_marks('text')} AS body FROM documents WHERE {Q.word_match('text', DOC_WORDS)}),
ev_tk AS (SELECT *, string_split(body, ' ') AS tk FROM ev_in),
{Q.longest_phrase_rows('ev_tk', 'ev_ph', **DOC_RULES)},
ev_a AS (SELECT post_id, pos, body, {Q.not_show('aw0')} AS award FROM (
  SELECT t.post_id, pos, body, coalesce(phrase, {Q.award_suffix('body')}) AS aw0 FROM ev_tk t LEFT JOIN ev_ph USING (post_id)))
SELECT post_id, pos, award, name FROM (SELECT *, coalesce({Q.subject('body', DOC_VERBS)}, {Q.first_entity('body')}) AS name FROM ev_a)
WHERE award IS NOT NULL AND name IS NOT NULL""",
)
def _(spark, sf):
    return _free_evidence(D.document_posts(spark, sf))


def _hope_sql():
    rules = dict(stop_tokens=K.AFTER_STOP_TOKENS_HYPHEN, stop_words=[], max_marks=0)
    return f"""{Q.with_awards('posts', Q.drop_marks('text'), 'h', suffix_rule=False, **rules)},
hope AS (SELECT post_id, pos, award, name, role FROM (SELECT post_id, pos,
  coalesce(award_any, nullif(regexp_extract(text, '(?i)wins\\s+(.*?\\b(?:award|prize|honor|medal|trophy)\\b)', 1), '')) AS award,
  coalesce({Q.subject('body')}, {Q.first_entity('body')}) AS name,
  CASE WHEN {Q.word_match('text', K.HOPE_WORDS, True, False)} THEN 'nominee' ELSE 'winner' END AS role
  FROM h WHERE {Q.word_match('body', K.WINNER_WORDS_CAPTURE)}) WHERE award IS NOT NULL AND name IS NOT NULL)"""


HOPE_SQL = _hope_sql()


@query("hope_triples", with_sql(HOPE_SQL, select="SELECT post_id, name || ' | ' || award || ' | ' || role AS triple FROM hope"))
def _(spark, sf):
    return E.triples(E.hope_triples(posts_of(spark, sf))).select("post_id", "triple")


def _nominee_sql():
    rules = dict(stop_tokens=K.AFTER_STOP_TOKENS_HYPHEN, stop_words=[], max_marks=0)
    return f"""nt AS (SELECT *, string_split(body, ' ') AS t FROM (SELECT *, {Q.drop_marks('text')} AS body FROM posts)),
np AS (SELECT *, {Q.phrases_after('t', **rules)} AS ph FROM nt WHERE {Q.word_match('body', K.NOMINEE_WORDS_HOPE)}),
nominee AS (SELECT post_id, pos, {Q.longest('ph')} AS award, coalesce({Q.subject('body')}, {Q.first_entity('body')}) AS name FROM np)"""


@query(
    "nominee_triples",
    with_sql(_nominee_sql(), select="SELECT * FROM nominee WHERE award IS NOT NULL AND name IS NOT NULL"),
)
def _(spark, sf):
    return E.nominee_triples(posts_of(spark, sf)).select(*EVIDENCE)


@query(
    "nominations",
    with_sql(
        _phrases_sql("posts", "text"),
        select=rf"""SELECT * FROM (SELECT post_id, nullif(regexp_extract(text, '{Q.PERSON}', 0), '') AS name,
          coalesce({Q.longest('ph')}, nullif(trim(regexp_extract(text, '(?i)\w+\s+(?:is nominated for|is a nominee for)(.*?\b(?:award|prize|honor|medal|trophy)\b)', 1)), '')) AS award
          FROM ph WHERE regexp_matches(text, '(?i:is nominated for|is a nominee for)')) WHERE name IS NOT NULL AND award IS NOT NULL""",
    ),
)
def _(spark, sf):
    return E.nominations(posts_of(spark, sf)).select("post_id", "name", "award")


def presenter_sql(scope, person=Q.PERSON, source="posts", words=None, name="pairs", **rules):
    words = words or (K.PRESENTER_WORDS if scope == "post" else K.PRESENTER_WORDS_NEAR)
    whole = scope != "sentence"
    spans = f"regexp_extract_all(text, '{person}')"
    unlisted = f"lower(trim(name)) NOT IN ({Q.listed(K.SHOW_NAMES, True)})" if scope != "post" else "true"
    if scope == "sentence":
        near = (
            "len(list_filter(regexp_split_to_array(text, '[.!?]+\\s+'), lambda s: "
            f"{Q.word_match('lower(s)', words, True, False)} AND contains(lower(s), lower(name)))) > 0"
        )
    elif scope == "window":
        body = "|".join(words)
        # a hit starts at i if the text from i on begins with a keyword and i is a word start
        near = (
            f"len(list_filter(range(1, len(text) + 1), lambda i: regexp_matches(substr(text, i), '^(?i:{body})\\b') "
            "AND (i = 1 OR NOT regexp_matches(substr(text, i - 1, 1), '[A-Za-z0-9_]')) "
            "AND (contains(substr(text, greatest(1, i - 50), i - greatest(1, i - 50)), name) "
            f"OR contains(substr(text, i + len(regexp_extract(substr(text, i), '^(?i:{body})\\b')), 50), name)))) > 0"
        )
    else:
        near = "true"
    return f"""{name}_in AS (SELECT * FROM {source} WHERE {Q.word_match('text', words, True, whole)}),
{Q.with_awards(name + '_in', None, name + '_a', **rules)},
{name}_x AS (SELECT post_id, pos, text, award, unnest({spans}) AS name FROM {name}_a WHERE award IS NOT NULL),
{name} AS (SELECT DISTINCT post_id, pos, award, name FROM {name}_x WHERE {unlisted} AND {near})"""


@query("presenter_pairs_post", with_sql(presenter_sql("post"), select="SELECT * FROM pairs"))
def _(spark, sf):
    return E.presenter_pairs(posts_of(spark, sf)).select(*EVIDENCE)


@query("presenter_pairs_sentence", with_sql(presenter_sql("sentence"), select="SELECT * FROM pairs"))
def _(spark, sf):
    return E.presenter_pairs(posts_of(spark, sf), "sentence").select(*EVIDENCE)


@query("presenter_pairs_window", with_sql(presenter_sql("window"), select="SELECT * FROM pairs"))
def _(spark, sf):
    return E.presenter_pairs(posts_of(spark, sf), "window").select(*EVIDENCE)


TURN_RULES = {"marker": "of", "stop_words": ["for", "by", "is"]}


@query(
    "presenter_pairs_turns",
    "WITH turns AS (SELECT conv_id * 100000 + turn AS post_id, conv_id * 100000 + turn AS pos, text FROM conversations), "
    + presenter_sql("sentence", "[A-Z][a-z]+", "turns", ["with"], **TURN_RULES)
    + " SELECT * FROM pairs",
)
def _(spark, sf):
    return E.presenter_pairs(
        D.turn_posts(spark, sf), "sentence", ["with"], person="[A-Z][a-z]+", **TURN_RULES
    ).select(*EVIDENCE)


_LOOSE = "(?i:" + "|".join(K.WINNER_WORDS_LOOSE) + ")"


def _near_sql():
    """Persons whose first or last token is near a keyword, from token positions."""
    return f"""nt AS (SELECT post_id, pos, text, {Q.tokens('text')} AS t FROM posts WHERE {Q.word_match('text', K.WINNER_WORDS_LOOSE, True, False)}),
cap AS (SELECT *, list_transform(t, lambda x: regexp_full_match(x, '[A-Z][a-z]+')) AS c FROM nt),
starts AS (SELECT *, unnest(list_filter(range(1, len(t)+1), lambda i: c[i] AND (i = 1 OR NOT c[i-1]))) AS s FROM cap),
runs AS (SELECT *, coalesce(list_filter(range(s, len(t)+1), lambda j: NOT c[j])[1], len(t)+1) AS e FROM starts),
near AS (SELECT DISTINCT post_id, array_to_string(t[s:e-1], ' ') AS name FROM runs WHERE e - s >= 2 AND
  len(list_filter(range(1, len(t)+1), lambda i: regexp_matches(t[i], '{_LOOSE}') AND (abs(i - s) <= 3 OR abs(i - e) <= 3 OR (i >= s AND i < e)))) > 0)"""


@query("near_winner_persons", with_sql(_near_sql(), select="SELECT * FROM near"))
def _(spark, sf):
    record = E.near_winners(posts_of(spark, sf))
    return record.select("post_id", F.explode("winner").alias("name"))


@query(
    "near_winner_categories",
    with_sql(
        _phrases_sql("posts", "text"),
        select=rf"""SELECT post_id, coalesce(CASE WHEN list_contains(list_transform(list_filter(regexp_split_to_array(
          regexp_extract(text, '(?is){_LOOSE}(.*)$', 1), '\s+'), lambda w: w <> '')[1:4], lambda w: lower(w)), 'best') THEN ph[1] END, 'N/A') AS award_category
        FROM ph WHERE {Q.word_match('text', K.WINNER_WORDS_LOOSE, True, False)}""",
    ),
)
def _(spark, sf):
    return E.near_winners(posts_of(spark, sf)).select("post_id", "award_category")


@query(
    "subject_entities",
    with_sql(
        f"s AS (SELECT post_id, text, {ENTITIES} AS en, string_split({Q.subject('text')}, ' ')[-1] AS head FROM posts)",
        select="SELECT * FROM (SELECT post_id, list_filter(en, lambda x: contains(lower(x), lower(head)))[1] AS name FROM s) WHERE name IS NOT NULL",
    ),
)
def _(spark, sf):
    return E.subject_entities(posts_of(spark, sf)).select("post_id", "name")


@query(
    "name_pairs",
    with_sql(
        select=r"""SELECT * FROM (SELECT post_id, nullif(regexp_extract(text,
          '^([A-Z][a-z]+(?: [A-Z][a-z]+)?) and ([A-Z][a-z]+(?: [A-Z][a-z]+)?)\b', 0), '') AS pair FROM posts) WHERE pair IS NOT NULL"""
    ),
)
def _(spark, sf):
    pairs = posts_of(spark, sf).select("post_id", S.name_pair(F.col("text")).alias("pair"))
    return pairs.where("pair IS NOT NULL")


_P, _A = "([A-Z][a-z]+(?: [A-Z][a-z]+)*)", "([A-Z][A-Za-z0-9-]*(?: [A-Z][A-Za-z0-9-]*)*)"
_DET = "(?:[Tt]he |[Aa]n? )?"
_FORMS = {
    "WINNER": f"{_P} (?:wins|win|won|winning) {_DET}{_A}",
    "NOMINEE": f"{_P} is (?:nominated|nominate) for {_DET}{_A}",
    "SPEAKER": f"{_P} will be speaking at {_DET}{_A}",
    "AWARD_WIN": f"(?i:congratulations to) {_P} on winning {_DET}{_A}",
}


@query(
    "four_patterns",
    with_sql(
        select=" UNION ALL ".join(
            f"SELECT post_id, '{label}' AS label, unnest(regexp_extract_all(text, '{p}', 1)) AS person, "
            f"unnest(regexp_extract_all(text, '{p}', 2)) AS target FROM posts"
            for label, p in _FORMS.items()
        )
    ),
)
def _(spark, sf):
    return E.pattern_matches(posts_of(spark, sf)).select("post_id", "label", "person", "target")


# --- known names ---------------------------------------------------------------------------


def _benchmark_names(spark, sf):
    return D.table(spark, sf, "benchmark").select(F.col("text").alias("award"))


@query(
    "known_name_mentions",
    "SELECT DISTINCT d.doc_id AS post_id, b.text AS award FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))",
)
def _(spark, sf):
    posts = D.document_posts(spark, sf)
    return L.known_name_mentions(posts, _benchmark_names(spark, sf)).select("post_id", "award")


@query(
    "known_name_mentions_by_gram",
    "SELECT DISTINCT d.doc_id AS post_id, b.text AS award FROM documents d JOIN benchmark b ON contains(lower(d.text), lower(b.text))",
)
def _(spark, sf):
    posts = D.document_posts(spark, sf)
    found = L.known_name_mentions(posts, _benchmark_names(spark, sf), gram=12)
    return found.select("post_id", "award")


_AWARDS_SQL = (
    f"canon AS (SELECT DISTINCT 'Best ' || split_part('{D.CAPS}', ',', i) AS award FROM (SELECT unnest(range(1, 9)) AS i) "
    "WHERE (SELECT count(*) FROM part) > 0)"
)


def canonical(spark, sf):
    """``Best <category>`` for every category that an event names."""
    events = D.table(spark, sf, "events")
    k = F.expr("cast(regexp_extract(props, '[0-9]+', 0) as int)")
    names = F.split(F.lit(D.CAPS), ",")
    return events.select(
        F.concat(F.lit("Best "), F.element_at(names, k % 8 + 1)).alias("award")
    ).distinct()


@query(
    "award_nominees_by_name",
    with_sql(
        _AWARDS_SQL,
        f"hit AS (SELECT post_id, award, unnest({PEOPLE_SPANS}) AS name FROM posts JOIN canon ON contains(lower(text), lower(award)) WHERE {Q.word_match('text', K.NOMINEE_WORDS_HOPE)})",
        select="SELECT post_id, award, name, count(*) AS n FROM hit GROUP BY ALL",
    ),
)
def _(spark, sf):
    spans = S.person_spans(F.col("text"))
    found = L.award_nominees_by_name(posts_of(spark, sf), canonical(spark, sf), spans=spans)
    return found.select("post_id", "award", "name", "n")
