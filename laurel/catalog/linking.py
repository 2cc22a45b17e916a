"""Linking, consolidation and the questions built on them."""

from pyspark.sql import functions as F

from laurel import constants as K
from laurel.catalog import data as D
from laurel.catalog import sql as Q
from laurel.catalog.extraction import HOPE_SQL, posts_of, presenter_sql, with_sql
from laurel.catalog.registry import query
from laurel.functions import text as T
from laurel.operators import consolidate as C
from laurel.operators import evidence as E
from laurel.operators import linkage as L
from laurel.plans import questions as P


def _texts(df, key):
    return df.select(F.col(key).alias("id"), F.col("text"))


def _benchmark_to_documents(spark, sf, n):
    best = L.tfidf_top_n(
        _texts(D.table(spark, sf, "benchmark"), "item_id"),
        _texts(D.dealt_out(D.table(spark, sf, "documents")), "doc_id"),
        n,
    )
    return best.select(
        F.col("target").alias("item_id"), F.col("key").alias("doc_id"),
        F.round("sim", 6).alias("sim"), F.col("rank").cast("bigint").alias("rank"),
    )


def _tfidf_sql(n):
    return f"""WITH bt AS (SELECT item_id AS id, text FROM benchmark), dk AS (SELECT doc_id AS id, text FROM documents),
    {Q.tfidf('bt', 'dk', n)} SELECT target AS item_id, key AS doc_id, round(sim, 6) AS sim, rank FROM ranked WHERE rank <= {n} AND sim > 0"""


@query("tfidf_best", _tfidf_sql(1))
def _(spark, sf):
    return _benchmark_to_documents(spark, sf, 1)


@query("tfidf_top10", _tfidf_sql(10))
def _(spark, sf):
    return _benchmark_to_documents(spark, sf, 10)


@query(
    "tfidf_questions",
    f"""WITH rows AS (SELECT conv_id * 100000 + turn AS id, role, text FROM conversations),
    bt AS (SELECT id, text FROM rows WHERE role = 'user'), dk AS (SELECT id, text FROM rows WHERE role = 'assistant'),
    {Q.tfidf('bt', 'dk', 1)} SELECT target AS question, key AS answer, round(sim, 6) AS sim FROM ranked WHERE rank = 1 AND sim > 0""",
)
def _(spark, sf):
    """The answer most like each question: both lists grow with the table."""
    turns = D.table(spark, sf, "conversations").selectExpr("conv_id * 100000 + turn AS id", "role", "text")
    best = L.tfidf_top_n(turns.where("role = 'user'").drop("role"), turns.where("role = 'assistant'").drop("role"))
    return best.select(F.col("target").alias("question"), F.col("key").alias("answer"), F.round("sim", 6).alias("sim"))


CANON_SQL = """canon AS (SELECT unnest([{}]) AS award)""".format(Q.listed(K.CANONICAL_AWARDS))


def _linked_sql(value_ctes, value, n):
    """Canonical awards with values of similar keys; ``vals(award, <value>)`` given."""
    return with_sql(
        value_ctes, CANON_SQL,
        "ct AS (SELECT award AS id, award AS text FROM canon)",
        "vk AS (SELECT award AS id, award AS text FROM vals)",
        Q.tfidf("ct", "vk", n),
        select=f"""SELECT c.award, r.rank, r.key, round(r.sim, 6) AS sim, v.{value} FROM canon c
          LEFT JOIN (SELECT * FROM ranked WHERE rank <= {n} AND sim > 0) r ON r.target = c.award
          LEFT JOIN vals v ON v.award = r.key""",
    )


def _flat(linked, value):
    return linked.select(
        "award", F.col("rank").cast("bigint").alias("rank"), "key", F.round("sim", 6).alias("sim"), value
    )


def _majority(source):
    return (
        f"cnt AS (SELECT award, name, count(*) AS n, min(pos) AS f FROM {source} GROUP BY ALL), "
        "vals AS (SELECT award, name FROM cnt QUALIFY row_number() OVER (PARTITION BY award ORDER BY n DESC, f, name) = 1)"
    )


@query("winners_linked", _linked_sql(f"{Q.evidence(K.WINNER_WORDS)}, {_majority('evidence')}", "name", 1))
def _(spark, sf):
    return _flat(P.winners(posts_of(spark, sf), P.canonical_awards(spark)), "name")


@query(
    "winners_linked_last",
    _linked_sql(
        f"{Q.evidence(K.WINNER_WORDS)}, vals AS (SELECT award, arg_max(name, pos) AS name FROM evidence GROUP BY award)",
        "name", 10,
    ),
)
def _(spark, sf):
    linked = P.winners(posts_of(spark, sf), P.canonical_awards(spark), 10, "last")
    return _flat(linked, "name")


@query("nominees_linked", _linked_sql(f"{Q.evidence(K.NOMINEE_WORDS)}, {_majority('evidence')}", "name", 10))
def _(spark, sf):
    return _flat(P.nominees(posts_of(spark, sf), P.canonical_awards(spark), 10), "name")


_PRESENTER_VALS = f"""{presenter_sql('post')}, vals AS (SELECT award, string_agg(name, ', ' ORDER BY name) AS names
  FROM pairs p WHERE pos = (SELECT max(pos) FROM pairs q WHERE q.award = p.award) GROUP BY award)"""


@query("presenters_linked", _linked_sql(_PRESENTER_VALS, "names", 1))
def _(spark, sf):
    linked = P.presenters(posts_of(spark, sf), P.canonical_awards(spark))
    return _flat(linked.withColumn("names", T.comma_list(F.col("names"))), "names")


_REPUTABLE = rf"""cnts AS (SELECT string_split(text, ' ')[2] AS account, count(*) AS n, min(pos) AS first_pos FROM posts
    WHERE string_split(text, ' ')[1] = 'RT' GROUP BY 1),
  topa AS (SELECT * FROM cnts ORDER BY n DESC, first_pos LIMIT 10),
  told_ids AS (SELECT DISTINCT post_id FROM (SELECT post_id, unnest(regexp_extract_all(text, '@\w+')) AS m FROM posts)
    WHERE lower(substr(m, 2)) IN (SELECT lower(regexp_replace(account, '^@|:$', '', 'g')) FROM topa)),
  told AS (SELECT * FROM posts JOIN told_ids USING (post_id) WHERE {Q.word_match('lower(text)', K.AWARD_WORDS, False)}),
  {Q.with_awards('told', None, 'told_a')},
  said AS (SELECT DISTINCT lower(award) AS award FROM told_a WHERE award IS NOT NULL),
  kept AS (SELECT award FROM said a WHERE NOT EXISTS (SELECT 1 FROM said b WHERE len(b.award) > len(a.award) AND contains(b.award, a.award)))"""


@query(
    "predicted_awards",
    with_sql(_REPUTABLE, select="SELECT award FROM kept ORDER BY len(award) DESC, award LIMIT 40"),
)
def _(spark, sf):
    return P.award_names(posts_of(spark, sf))


@query(
    "drop_substrings",
    r"""WITH n AS (SELECT DISTINCT award FROM (SELECT p_name AS award FROM part UNION ALL SELECT unnest(string_split(p_name, ' ')) FROM part
      UNION ALL SELECT p_name || ' ' || p_type FROM part UNION ALL SELECT unnest(regexp_split_to_array(text, '[.!?]+\s+')) FROM conversations) WHERE award <> '')
    SELECT award FROM n a WHERE NOT EXISTS (SELECT 1 FROM n b WHERE len(b.award) > len(a.award) AND contains(b.award, a.award))""",
)
def _(spark, sf):
    part = D.table(spark, sf, "part")
    names = (
        part.select(F.col("p_name").alias("award"))
        .unionByName(part.select(F.explode(F.split("p_name", " ")).alias("award")))
        .unionByName(part.select(F.concat("p_name", F.lit(" "), "p_type").alias("award")))
        .unionByName(
            D.turn_posts(spark, sf).select(F.explode(T.sentences(F.col("text"))).alias("award"))
        )
    )
    return L.drop_contained(names).where("award <> ''")


@query(
    "update_existing_winners",
    with_sql(
        Q.evidence(K.WINNER_WORDS), _majority("evidence"), CANON_SQL,
        """recs AS (SELECT award, arg_max(name, pos) AS winner FROM evidence GROUP BY award)""",
        """mapped AS (SELECT award, name AS new FROM vals WHERE contains(award, 'actor'))""",
        select="SELECT r.award, coalesce(m.new, r.winner) AS winner FROM recs r LEFT JOIN mapped m USING (award)",
    ),
)
def _(spark, sf):
    evidence = E.award_evidence(posts_of(spark, sf))
    records = E.last_value(evidence).select("award", F.col("name").alias("winner"))
    linked = E.majority_value(evidence).where(F.col("award").contains("actor"))
    return L.update_existing(records, linked.select("award", "name")).select("award", "winner")


# --- sequence measures ------------------------------------------------------------------------


@query(
    "token_set_best",
    f"""WITH t AS (SELECT DISTINCT p_type || ' ' || string_split(p_name, ' ')[-1] AS target FROM part),
    k AS (SELECT DISTINCT p_name || ' ' || p_type AS key FROM part), tk AS (SELECT * FROM t, k),
    {Q.token_set_best('tk')} SELECT target, key, score FROM t LEFT JOIN best USING (target)""",
)
def _(spark, sf):
    part = D.table(spark, sf, "part")
    targets = part.select(F.concat_ws(" ", "p_type", F.element_at(F.split("p_name", " "), -1)).alias("target")).distinct()
    keys = part.select(F.concat_ws(" ", "p_name", "p_type").alias("key"))
    return L.token_set_best(targets, keys)


_LAST = f"{Q.evidence(K.WINNER_WORDS)}, vals AS (SELECT award, arg_max(name, pos) AS name FROM evidence GROUP BY award)"


@query(
    "token_set_winners",
    with_sql(
        _LAST, CANON_SQL, "tk AS (SELECT c.award AS target, v.award AS key FROM canon c, vals v)", Q.token_set_best("tk"),
        select="""SELECT c.award, b.key, b.score, v.name FROM canon c LEFT JOIN best b ON b.target = c.award
          LEFT JOIN vals v ON v.award = b.key""",
    ),
)
def _(spark, sf):
    values = E.last_value(E.award_evidence(posts_of(spark, sf))).select("award", "name")
    return P.fuzzy_values(P.canonical_awards(spark), values)


def _merged_sql(ctes, names, select):
    """Consolidated names over ``with_sql`` CTEs; the block search needs a recursive WITH."""
    return with_sql(*ctes, f"names_in AS ({names})", Q.greedy("names_in"), select=select).replace("WITH ", "WITH RECURSIVE ", 1)


@query(
    "merged_awards",
    _merged_sql(
        [HOPE_SQL], "SELECT award AS name, count(*) AS votes FROM hope GROUP BY award",
        "SELECT leader AS name, sum(votes)::BIGINT AS votes FROM owner JOIN names_in USING (name) GROUP BY leader",
    ),
)
def _(spark, sf):
    votes = E.award_votes(E.hope_triples(posts_of(spark, sf))).withColumnRenamed("award", "name")
    return C.merged_votes(votes)


@query(
    "consolidated_votes",
    _merged_sql(
        [HOPE_SQL, """said AS (SELECT award, role, name, count(*) AS n FROM (SELECT string_split(name || ' | ' || award || ' | ' || role, ' | ') AS p FROM hope),
          LATERAL (SELECT p[1] AS name, p[2] AS award, p[3] AS role) WHERE len(p) = 3 GROUP BY ALL)"""],
        "SELECT DISTINCT award AS name, 1 AS votes FROM said",
        """SELECT leader AS award, role, s.name, sum(n)::BIGINT AS n FROM said s JOIN owner o ON o.name = s.award GROUP BY ALL""",
    ),
)
def _(spark, sf):
    lines = E.triples(E.hope_triples(posts_of(spark, sf)))
    return P.vote_summary(lines)


@query(
    "merged_part_names",
    f"""WITH RECURSIVE names_in AS (SELECT p_name || ' ' || p_type AS name, count(*) AS votes FROM part GROUP BY 1),
    {Q.greedy('names_in')} SELECT name, leader FROM owner""",
)
def _(spark, sf):
    names = D.table(spark, sf, "part").groupBy(F.concat_ws(" ", "p_name", "p_type").alias("name")).agg(
        F.count("*").alias("votes")
    )
    return C.leaders(names)


MOVE_SQL = """v AS (SELECT award, role, name, count(*) AS n FROM m GROUP BY ALL),
  av AS (SELECT award, sum(n) AS votes, list_distinct(string_split(any_value(award), ' ')) AS w FROM v GROUP BY award),
  r AS (SELECT v.*, votes, w FROM v JOIN av USING (award)),
  pr AS (SELECT a.award, a.role, a.name, b.award AS to_award, b.votes AS to_votes FROM r a JOIN r b ON a.role = b.role AND a.name = b.name
    AND len(a.w) < len(b.w) AND list_has_all(b.w, a.w)),
  mv AS (SELECT award, role, name, to_award FROM pr p WHERE NOT EXISTS (SELECT 1 FROM pr q WHERE q.award = p.to_award AND q.role = p.role AND q.name = p.name)
    QUALIFY row_number() OVER (PARTITION BY award, role, name ORDER BY to_votes, to_award) = 1)"""


@query(
    "token_subset_move",
    f"""WITH m AS (SELECT unnest([p_name, p_name || ' ' || p_type, p_name || ' ' || p_type || ' ' || p_brand]) AS award,
        CASE p_size % 2 WHEN 0 THEN 'winner' ELSE 'presenter' END AS role, 's' || (p_partkey % 13) AS name FROM part),
    {MOVE_SQL} SELECT coalesce(to_award, award) AS award, role, name, sum(n)::BIGINT AS n
    FROM v LEFT JOIN mv USING (award, role, name) GROUP BY ALL""",
)
def _(spark, sf):
    full = F.concat_ws(" ", "p_name", "p_type")
    evidence = D.table(spark, sf, "part").select(
        F.explode(F.array(F.col("p_name"), full, F.concat_ws(" ", full, "p_brand"))).alias("award"),
        F.when(F.col("p_size") % 2 == 0, "winner").otherwise("presenter").alias("role"),
        F.concat(F.lit("s"), F.col("p_partkey") % 13).alias("name"),
    )
    return C.move_subset_votes(E.votes(evidence))
