"""Counts, votes, records and set operations."""

import uuid

from pyspark.sql import functions as F

from laurel import constants as K
from laurel.catalog import data as D
from laurel.catalog import sql as Q
from laurel.catalog.extraction import (
    EVIDENCE, HOPE_SQL, PEOPLE_SPANS, exploded, posts_of, presenter_sql, with_sql,
)
from laurel.catalog.registry import query
from laurel.functions import spans as S
from laurel.functions import text as T
from laurel.operators import evidence as E
from laurel.operators import linkage as L
from laurel.plans import questions as P
from laurel.session import stage_dir
from laurel.sources import sinks, split

NAMED = exploded(PEOPLE_SPANS)
COUNTED = """counted AS (SELECT name, n, first_pos, first_idx::INTEGER AS first_idx FROM (
  SELECT name, count(*) AS n, min(pos) AS first_pos, arg_min(idx, pos * 1000 + idx) AS first_idx FROM spans GROUP BY name))"""
RANKED = "ORDER BY n DESC, first_pos, first_idx"


@query("mention_counts", with_sql(NAMED, COUNTED, select="SELECT * FROM counted"))
def _(spark, sf):
    return E.mention_counts(E.mentions(posts_of(spark, sf)))


DOC_NAMED = exploded(f"regexp_extract_all(text, '{Q.PERSON_ANY}')")


@query(
    "mention_top_documents",
    f"WITH {D.DOCUMENTS_SQL}, {DOC_NAMED}, {COUNTED.replace('pos * 1000', 'pos * 100000')} SELECT name, n, first_pos, first_idx FROM counted {RANKED} LIMIT 20",
)
def _(spark, sf):
    spans = S.person_spans(F.col("text"), S.PERSON_ANY)
    counts = E.mention_counts(E.mentions(D.document_posts(spark, sf), spans))
    return E.ranked_mentions(counts, 20)


_EARLY = f"""early AS (SELECT * FROM posts WHERE {Q.word_match('text', K.HOST_WORDS)}
  QUALIFY row_number() OVER (ORDER BY pos) <= floor(0.1 * count(*) OVER ()))"""
_HOSTS = f"""{_EARLY}, {exploded(PEOPLE_SPANS, 'early')}, {COUNTED},
  host_rank AS (SELECT * FROM counted WHERE lower(trim(name)) NOT IN ({Q.listed(K.SHOW_NAMES, True)}))"""


@query("host_names", with_sql(_HOSTS, select=f"SELECT * FROM host_rank {RANKED} LIMIT 2"))
def _(spark, sf):
    return P.hosts(posts_of(spark, sf))


@query(
    "host_names_known",
    with_sql(
        _HOSTS, D.PEOPLE_SQL,
        select=f"SELECT * FROM host_rank WHERE name IN (SELECT name FROM people WHERE regexp_matches(summary, '(?i)born')) {RANKED} LIMIT 2",
    ),
)
def _(spark, sf):
    return P.hosts(posts_of(spark, sf), D.people(spark, sf))


@query(
    "host_names_skip_first",
    with_sql(_HOSTS, select=f"SELECT * FROM host_rank {RANKED} LIMIT 2 OFFSET 1"),
)
def _(spark, sf):
    return P.hosts(posts_of(spark, sf), skip=1)


@query(
    "persons_by_top_account",
    with_sql(
        r"acc AS (SELECT *, nullif(regexp_extract(text, '^RT @(\w+):', 1), '') AS acct FROM posts)",
        "best AS (SELECT acct FROM acc WHERE acct IS NOT NULL GROUP BY acct ORDER BY count(*) DESC, min(pos) LIMIT 1)",
        f"told AS (SELECT post_id, pos, text FROM acc WHERE acct IN (SELECT acct FROM best) AND {Q.word_match('text', K.PRESENTER_WORDS)})",
        exploded(PEOPLE_SPANS, "told"),
        COUNTED,
        select="SELECT * FROM counted",
    ),
)
def _(spark, sf):
    return P.hosts_by_top_accounts(posts_of(spark, sf), 1, K.PRESENTER_WORDS)


@query(
    "host_pairs",
    with_sql(
        r"""pr AS (SELECT pos, nullif(regexp_extract(text, '^([A-Z][a-z]+(?: [A-Z][a-z]+)?) and ([A-Z][a-z]+(?: [A-Z][a-z]+)?)\b', 0), '') AS pair FROM posts)""",
        select="""SELECT split_part(pair, ' and ', 1) AS name_a, split_part(pair, ' and ', 2) AS name_b, count(*) AS n, min(pos) AS first_pos
          FROM pr WHERE pair IS NOT NULL GROUP BY pair ORDER BY n DESC, first_pos LIMIT 5""",
    ),
)
def _(spark, sf):
    return P.host_pairs(posts_of(spark, sf), 5)


def _phrase_top(phrases):
    cond = " OR ".join(f"contains(lower(text), '{p}')" for p in phrases)
    return with_sql(
        f"told AS (SELECT * FROM posts WHERE {cond})",
        exploded(f"regexp_extract_all(text, '{Q.PERSON_ANY}')", "told"),
        COUNTED,
        select=f"SELECT * FROM counted WHERE lower(name) NOT IN ({Q.listed(K.NOT_A_PERSON)}) {RANKED} LIMIT 1",
    )


@query("best_dressed", _phrase_top(K.DRESS_PHRASES))
def _(spark, sf):
    return P.best_dressed(posts_of(spark, sf))


@query("best_joke", _phrase_top(K.JOKE_PHRASES))
def _(spark, sf):
    return P.best_joke(posts_of(spark, sf))


# --- values per award ----------------------------------------------------------------------

# every event is a piece of evidence: its type names the award, its user the person
EVENTS_SQL = """ev AS (SELECT event_id AS pos, event_type AS award, 'u' || user_id AS name,
  CASE event_id % 3 WHEN 0 THEN 'winner' WHEN 1 THEN 'nominee' ELSE 'presenter' END AS role FROM events)"""


def event_evidence(spark, sf):
    return D.table(spark, sf, "events").select(
        F.col("event_id").alias("post_id"),
        F.col("event_id").alias("pos"),
        F.col("event_type").alias("award"),
        F.concat(F.lit("u"), "user_id").alias("name"),
        F.expr(
            "CASE event_id % 3 WHEN 0 THEN 'winner' WHEN 1 THEN 'nominee' ELSE 'presenter' END"
        ).alias("role"),
    )


@query(
    "first_wins_rest",
    f"""WITH {EVENTS_SQL} SELECT award, CASE WHEN row_number() OVER (PARTITION BY award ORDER BY pos) = 1
      THEN 'winner' ELSE 'nominee' END AS role, name, pos FROM ev""",
)
def _(spark, sf):
    return E.first_wins(event_evidence(spark, sf))


@query(
    "first_wins_distinct",
    f"""WITH {EVENTS_SQL}, r AS (SELECT *, row_number() OVER (PARTITION BY award ORDER BY pos) AS i FROM ev)
    SELECT award, 'winner' AS role, name, pos FROM r WHERE i = 1
    UNION ALL SELECT award, 'nominee', name, min(pos) FROM r WHERE i > 1 GROUP BY award, name""",
)
def _(spark, sf):
    return E.first_wins(event_evidence(spark, sf), distinct=True)


@query(
    "last_wins",
    f"WITH {EVENTS_SQL} SELECT award, arg_max(name, pos) AS name, min(pos) AS key_order FROM ev GROUP BY award",
)
def _(spark, sf):
    return E.last_value(event_evidence(spark, sf))


@query(
    "majority_wins",
    f"""WITH {EVENTS_SQL}, c AS (SELECT award, name, count(*) AS n, min(pos) AS f FROM ev GROUP BY ALL)
    SELECT award, name, min(f) OVER (PARTITION BY award) AS key_order FROM c
    QUALIFY row_number() OVER (PARTITION BY award ORDER BY n DESC, f, name) = 1""",
)
def _(spark, sf):
    return E.majority_value(event_evidence(spark, sf))


@query(
    "single_winner",
    f"WITH {EVENTS_SQL} SELECT award, arg_max(name, pos) AS name FROM ev WHERE role = 'winner' GROUP BY award",
)
def _(spark, sf):
    return E.single_winner(event_evidence(spark, sf))


@query(
    "presenters_by_award",
    with_sql(presenter_sql("sentence"), select="SELECT DISTINCT award, name FROM pairs"),
)
def _(spark, sf):
    return E.presenters_by_award(E.presenter_pairs(posts_of(spark, sf), "sentence"))


@query(
    "presenters_last_post",
    with_sql(
        presenter_sql("post"),
        select="""SELECT award, min(pos) AS key_order, (SELECT string_agg(name, ', ' ORDER BY name) FROM pairs q
          WHERE q.award = p.award AND q.pos = max(p.pos)) AS names FROM pairs p GROUP BY award""",
    ),
)
def _(spark, sf):
    last = E.last_names(E.presenter_pairs(posts_of(spark, sf)))
    return last.select("award", "key_order", T.comma_list(F.col("names")).alias("names"))


# --- votes ------------------------------------------------------------------------------------


@query("votes", f"WITH {EVENTS_SQL} SELECT award, role, name, count(*) AS n FROM ev GROUP BY ALL")
def _(spark, sf):
    return E.votes(event_evidence(spark, sf))


@query("award_votes", with_sql(HOPE_SQL, select="SELECT award, count(*) AS votes FROM hope GROUP BY award"))
def _(spark, sf):
    return E.award_votes(E.hope_triples(posts_of(spark, sf)))


@query(
    "reputable_award_votes",
    with_sql(
        HOPE_SQL,
        """rt AS (SELECT string_split(text, ' ')[2] AS account, count(*) AS n, min(pos) AS first_pos FROM posts
          WHERE string_split(text, ' ')[1] = 'RT' GROUP BY 1 ORDER BY n DESC, first_pos LIMIT 20)""",
        r"""told AS (SELECT DISTINCT post_id FROM (SELECT post_id, unnest(regexp_extract_all(text, '@\w+')) AS m FROM posts
          WHERE """ + Q.word_match("lower(text)", K.AWARD_WORDS, False) + r""")
          WHERE lower(substr(m, 2)) IN (SELECT lower(regexp_replace(account, '^@|:$', '', 'g')) FROM rt))""",
        select="SELECT award, count(*) AS votes FROM hope JOIN told USING (post_id) GROUP BY award",
    ),
)
def _(spark, sf):
    return P.timing_award_votes(posts_of(spark, sf))


@query(
    "parse_triples",
    with_sql(
        HOPE_SQL,
        """lines AS (SELECT post_id, lower(name || ' | ' || award || ' | ' || role) AS t FROM hope
          UNION ALL SELECT post_id, text FROM posts)""",
        select="""SELECT post_id, string_split(t, ' | ')[1] AS name, string_split(t, ' | ')[2] AS award, string_split(t, ' | ')[3] AS role
          FROM lines WHERE len(string_split(t, ' | ')) = 3""",
    ),
)
def _(spark, sf):
    posts = posts_of(spark, sf)
    lines = E.triples(E.hope_triples(posts)).select("post_id", F.lower("triple").alias("triple"))
    lines = lines.unionByName(posts.select("post_id", F.col("text").alias("triple")))
    return E.parse_triples(lines).select("post_id", "name", "award", "role")


def _role_list(role, entry):
    return f"coalesce(string_agg({entry}, ', ' ORDER BY name) FILTER (WHERE role = '{role}'), '')"


_VOTE_RECORDS = f"""WITH {EVENTS_SQL}, v AS (SELECT award, role, name, count(*) AS n FROM ev GROUP BY ALL)
    SELECT award AS name, {_role_list('winner', "name || '=' || n")} AS winner, {_role_list('nominee', "name || '=' || n")} AS nominees,
      {_role_list('presenter', "name || '=' || n")} AS presenters, sum(n)::BIGINT AS votes FROM v GROUP BY award"""


@query(
    "vote_records",
    _VOTE_RECORDS,
)
def _(spark, sf):
    records = E.award_records(E.votes(event_evidence(spark, sf)))
    shown = [
        T.comma_list(F.transform(c, lambda e: F.concat(e["name"], F.lit("="), e["n"]))).alias(c)
        for c in ("winner", "nominees", "presenters")
    ]
    return records.select("name", *shown, "votes")


@query("long_vote_records", _VOTE_RECORDS)
def _(spark, sf):
    """The records written an entry a line, and read back by byte ranges."""
    folder = f"{stage_dir(spark)}/records-{uuid.uuid4().hex}"
    sinks.write_long_records(E.votes(event_evidence(spark, sf)), folder)
    entry = "array<struct<name: string, n: bigint>>"
    shape = f"name string, winner {entry}, nominees {entry}, presenters {entry}, votes bigint"
    records = split.json_objects(spark, folder).select(F.from_json("value", shape).alias("o")).select("o.*")
    shown = [
        T.comma_list(F.transform(c, lambda e: F.concat(e["name"], F.lit("="), e["n"]))).alias(c)
        for c in ("winner", "nominees", "presenters")
    ]
    return records.select("name", *shown, "votes")


@query(
    "short_records",
    f"""WITH {EVENTS_SQL}, v AS (SELECT DISTINCT award, role, name FROM ev)
    SELECT award, {_role_list('nominee', 'name')} AS nominees, {_role_list('presenter', 'name')} AS presenters,
      (SELECT arg_max(name, pos) FROM ev e WHERE e.award = v.award AND role = 'winner') AS winner FROM v GROUP BY award""",
)
def _(spark, sf):
    evidence = event_evidence(spark, sf)
    lists = E.award_records(E.votes(evidence), counted=False).select(
        F.col("name").alias("award"), "nominees", "presenters"
    )
    single = E.single_winner(evidence).withColumnRenamed("name", "winner")
    filled = E.fill_defaults(lists.join(single, "award", "left"))
    return filled.select(
        "award",
        T.comma_list(F.col("nominees")).alias("nominees"),
        T.comma_list(F.col("presenters")).alias("presenters"),
        "winner",
    )


@query(
    "winner_lines",
    f"""WITH {EVENTS_SQL} SELECT DISTINCT name || ' | ' || award || ' | winner' AS value FROM ev WHERE role = 'winner'""",
)
def _(spark, sf):
    return sinks.triple_lines(E.votes(event_evidence(spark, sf)))


@query(
    "distinct_awards",
    with_sql(
        Q.evidence(K.WINNER_WORDS), presenter_sql("post"),
        select="SELECT award FROM evidence UNION SELECT award FROM pairs",
    ),
)
def _(spark, sf):
    posts = posts_of(spark, sf)
    return E.distinct_awards(E.award_evidence(posts), E.presenter_pairs(posts))


@query(
    "union_evidence",
    with_sql(
        Q.evidence(K.WINNER_WORDS), Q.evidence(K.NOMINEE_WORDS, name="nom"),
        select="SELECT *, 'winner' AS role FROM evidence UNION ALL SELECT *, 'nominee' FROM nom",
    ),
)
def _(spark, sf):
    posts = posts_of(spark, sf)
    both = E.award_evidence(posts).unionByName(
        E.award_evidence(posts, K.NOMINEE_WORDS, "nominee")
    )
    return both.select(*EVIDENCE, "role")


@query(
    "set_ops",
    """WITH w AS (SELECT d.doc_id, list_distinct(list_filter(regexp_split_to_array(lower(d.text), '\\s+'), lambda x: x <> '')) AS a,
        list_distinct(list_filter(regexp_split_to_array(lower(b.text), '\\s+'), lambda x: x <> '')) AS b
      FROM documents d JOIN benchmark b ON d.doc_id % (SELECT count(*) FROM benchmark) = b.item_id)
    SELECT doc_id, len(list_intersect(a, b))::INTEGER AS common, len(a)::INTEGER - len(list_intersect(a, b))::INTEGER AS only_a,
      len(list_distinct(list_concat(a, b)))::INTEGER AS united FROM w""",
)
def _(spark, sf):
    items = D.table(spark, sf, "benchmark").select("item_id", T.words(F.lower("text")).alias("b"))
    n = items.agg(F.count("*")).scalar()
    docs = D.table(spark, sf, "documents").select(
        "doc_id", T.words(F.lower("text")).alias("a"), (F.col("doc_id") % n).alias("item_id")
    )
    return docs.join(items, "item_id").select(
        "doc_id",
        F.size(F.array_intersect("a", "b")).alias("common"),
        F.size(F.array_except("a", "b")).alias("only_a"),
        F.size(F.array_union("a", "b")).alias("united"),
    )


@query(
    "known_people",
    with_sql(
        NAMED, D.PEOPLE_SQL,
        select="SELECT DISTINCT name FROM spans WHERE name IN (SELECT name FROM people WHERE regexp_matches(summary, '(?i)born'))",
    ),
)
def _(spark, sf):
    named = E.mentions(posts_of(spark, sf)).select("name").distinct()
    return L.known_people(named, D.people(spark, sf))


@query(
    "top_names_listing",
    with_sql(NAMED, COUNTED, select=f"SELECT name, n, first_pos, first_idx FROM counted"),
)
def _(spark, sf):
    # the whole listing; its order is a global sort, not a rank given in one task
    return E.ranked_mentions(E.mention_counts(E.mentions(posts_of(spark, sf))))
