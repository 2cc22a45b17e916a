"""Scores against gold, and the report."""

from pyspark.sql import functions as F

from laurel import constants as K
from laurel.catalog import data as D
from laurel.catalog import sql as Q
from laurel.catalog.counting import RANKED, _HOSTS
from laurel.catalog.extraction import posts_of, presenter_sql, with_sql
from laurel.catalog.linking import _REPUTABLE, _majority
from laurel.catalog.registry import query
from laurel.functions import similarity as M
from laurel.functions import text as T
from laurel.operators import scoring as G
from laurel.plans import report as R
from laurel.sources.posts import list_frame

_NORM = r"lower(regexp_replace({}, '[^\p{{L}}\p{{N}}\s]', '', 'g'))"


@query(
    "spelling_scores",
    f"""SELECT p_partkey, round(1 - levenshtein(lower(p_name), {_NORM.format("p_type || ' ' || p_brand")}) /
      greatest(len(p_name), len({_NORM.format("p_type || ' ' || p_brand")}))::DOUBLE, 6) AS score FROM part""",
)
def _(spark, sf):
    other = T.norm_text(F.concat_ws(" ", "p_type", "p_brand"))
    return D.table(spark, sf, "part").select(
        "p_partkey", F.round(M.spelling(F.lower("p_name"), other), 6).alias("score")
    )


@query(
    "completeness_scores",
    """WITH c AS (SELECT c_custkey % 40 AS g, list(DISTINCT n_name) AS a FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
      r AS (SELECT n_regionkey, list(n_name) AS b FROM nation GROUP BY 1),
      x AS (SELECT g, n_regionkey, len(a) AS na, len(b) AS nb, len(list_intersect(a, b)) AS k, len(list_distinct(list_concat(a, b))) AS u
        FROM c JOIN r ON g % 5 = n_regionkey)
    SELECT g, round(k / u::DOUBLE * CASE WHEN na = nb AND k = nb THEN 1.0 WHEN k = na THEN 0.95 WHEN k = nb THEN 0.9 WHEN k > 0 THEN 0.85 ELSE 0 END, 6) AS score FROM x""",
)
def _(spark, sf):
    nation = D.table(spark, sf, "nation")
    regions = nation.groupBy("n_regionkey").agg(F.collect_list("n_name").alias("b"))
    found = (
        D.table(spark, sf, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .groupBy((F.col("c_custkey") % 40).alias("g"))
        .agg(F.collect_set("n_name").alias("a"))
    )
    return found.join(regions, F.col("g") % 5 == F.col("n_regionkey")).select(
        "g", F.round(M.completeness(F.col("a"), F.col("b")), 6).alias("score")
    )


_BRAND = "replace(p_brand, '#', ' number ')"
NOISY = """CASE {0} % 6 WHEN 0 THEN upper({1}) WHEN 1 THEN concat({1}, ' of the line') WHEN 2 THEN replace({1}, 'e', '3')
  WHEN 3 THEN split_part({1}, ' ', 1) WHEN 4 THEN concat('music of ', {2}) ELSE concat({1}, ' ', {1}) END"""
_ALIAS = next(iter(K.WORK_ALIASES))
# rows (category, award, name, id): the answers; the same text is run by both engines
ANSWERS = f"""SELECT 'nominees' AS category, p_brand AS award, p_name AS name, min(p_partkey) AS id FROM part GROUP BY p_brand, p_name
  UNION ALL SELECT 'presenters', p_brand, concat(lower(p_type), ' sold by ', {_BRAND}), min(p_partkey) FROM part GROUP BY p_brand, p_type
  UNION ALL SELECT 'winner', p_brand, min(p_name), min(p_partkey) FROM part GROUP BY p_brand
  UNION ALL SELECT 'hosts', '', lower(n_name), n_nationkey FROM nation
  UNION ALL SELECT 'awards', '', concat('best ', p_name, ' in ', lower(p_type)), min(p_partkey) FROM part GROUP BY p_name, p_type"""
# every answer comes back in some form, two of seven of another award's
PREDICTED = f"""SELECT DISTINCT category, award, {NOISY.format("id", "name", "'" + _ALIAS + "'")} AS result FROM answers_in WHERE id % 7 < 5
  UNION SELECT category, award, name FROM answers_in WHERE id % 7 > 3"""
_NORM_ANY = r"lower(regexp_replace({}, '[^\p{{L}}\p{{N}}\s]', '', 'g'))"
GRADING_SQL = f"""WITH RECURSIVE answers_in AS ({ANSWERS}),
gold_in AS (SELECT category, award, list(DISTINCT name ORDER BY name) AS answers FROM answers_in GROUP BY ALL), pred_in AS ({PREDICTED}),
{Q.translations('pred_in', 'gold_in', K.WORK_ALIASES, _NORM_ANY)}"""


def grading(spark, sf):
    """Predictions and gold of all five categories, from parts and nations."""
    part, nation = D.table(spark, sf, "part"), D.table(spark, sf, "nation")
    answers = spark.sql(ANSWERS.replace("FROM part", "FROM {part}").replace("FROM nation", "FROM {nation}"), part=part, nation=nation)
    predicted = spark.sql(PREDICTED.replace("FROM answers_in", "FROM {answers}"), answers=answers)
    gold = answers.groupBy("category", "award").agg(F.array_sort(F.collect_set("name")).alias("answers"))
    return predicted, gold


@query(
    "answer_translations",
    GRADING_SQL + " SELECT category, award, result, target, round(score, 6) AS score, kind FROM tr",
)
def _(spark, sf):
    predicted, gold = grading(spark, sf)
    found = G.translations(predicted, gold, G.alias_frame(spark))
    return found.select("category", "award", "result", "target", F.round("score", 6).alias("score"), "kind")


@query(
    "score_grid",
    GRADING_SQL + f", {Q.grid('pred_in', 'gold_in')} SELECT year, category, metric, round(value, 6) AS value FROM grid",
)
def _(spark, sf):
    grid = G.score_grid(*grading(spark, sf))
    return grid.withColumn("value", F.round("value", 6))


# exact hits alone, so that the check needs no fuzzy matching of its own
@query(
    "score_grid_exact",
    """WITH gold AS (SELECT p_brand AS award, list(DISTINCT p_name) AS answers FROM part GROUP BY 1),
      pred AS (SELECT DISTINCT p_brand AS award, p_name AS result FROM part WHERE p_size % 3 = 0),
      x AS (SELECT award, count(*) AS n FROM pred GROUP BY award),
      s AS (SELECT g.award, coalesce(n, 0) AS n, len(answers) AS m FROM gold g LEFT JOIN x USING (award))
    SELECT 2013 AS year, 'nominees' AS category, metric, round(value, 6) AS value FROM (
      SELECT 'spelling' AS metric, avg(CASE WHEN n > 0 THEN 1.0 ELSE 0.0 END) AS value FROM s
      UNION ALL SELECT 'completeness', avg(n / m::DOUBLE * CASE WHEN n = m THEN 1.0 WHEN n > 0 THEN 0.95 ELSE 0 END) FROM s)""",
)
def _(spark, sf):
    part = D.table(spark, sf, "part")
    named = part.select(F.lit("nominees").alias("category"), F.col("p_brand").alias("award"), "p_name", "p_size")
    gold = named.groupBy("category", "award").agg(F.array_sort(F.collect_set("p_name")).alias("answers"))
    predicted = named.where("p_size % 3 = 0").select("category", "award", F.col("p_name").alias("result")).distinct()
    grid = G.score_grid(predicted, gold)
    return grid.withColumn("value", F.round("value", 6))


# --- report --------------------------------------------------------------------------------


def canonical_frame(spark):
    return list_frame(spark, K.CANONICAL_AWARDS, "award", key="award_id")


_CANON_ID = "canon AS (SELECT i - 1 AS award_id, ([{0}])[i] AS award FROM (SELECT unnest(range(1, {1})) AS i))".format(
    Q.listed(K.CANONICAL_AWARDS), len(K.CANONICAL_AWARDS) + 1
)


def _top_sql(tag, values):
    """CTE ``<tag>(award, names)``: the distinct values of the ten most similar keys."""
    body = Q.tfidf("ct", f"{tag}_k", 10)
    for cte in ("tt", "kt", "total", "idf", "tx", "kx", "sims", "ranked"):
        body = body.replace(f"{cte} AS (", f"{tag}_{cte} AS (").replace(f"FROM {cte}", f"FROM {tag}_{cte}")
        body = body.replace(f"JOIN {cte} ", f"JOIN {tag}_{cte} ").replace(f"{cte}.", f"{tag}_{cte}.")
    return (
        f"{tag}_k AS (SELECT DISTINCT award AS id, award AS text FROM {values}), {body}, "
        f"{tag} AS (SELECT target AS award, string_agg(DISTINCT name, ', ' ORDER BY name) AS names "
        f"FROM {tag}_ranked r JOIN {values} v ON v.award = r.key WHERE rank <= 10 AND sim > 0 GROUP BY target)"
    )


_WIN = f"{Q.evidence(K.WINNER_WORDS, name='we')}, {_majority('we').replace('cnt ', 'wc ').replace('FROM cnt', 'FROM wc').replace('vals AS', 'wv AS')}"
_NOM = f"{Q.evidence(K.NOMINEE_WORDS, name='ne')}, {_majority('ne').replace('cnt ', 'nc ').replace('FROM cnt', 'FROM nc').replace('vals AS', 'nv AS')}"
_PRE = f"{presenter_sql('post')}, pv AS (SELECT award, name FROM pairs p WHERE pos = (SELECT max(pos) FROM pairs q WHERE q.award = p.award))"


def _one_sql(phrases, tag):
    cond = " OR ".join(f"contains(lower(text), '{p}')" for p in phrases)
    return (
        f"{tag}_t AS (SELECT post_id, pos, unnest(regexp_extract_all(text, '{Q.PERSON_ANY}')) AS name, "
        f"unnest(range(len(regexp_extract_all(text, '{Q.PERSON_ANY}')))) AS idx FROM posts WHERE {cond}), "
        f"{tag} AS (SELECT name FROM {tag}_t WHERE lower(name) NOT IN ({Q.listed(K.NOT_A_PERSON)}) "
        f"GROUP BY name ORDER BY count(*) DESC, min(pos * 1000 + idx) LIMIT 1)"
    )


REPORT_SQL = with_sql(
    _HOSTS, _CANON_ID, "ct AS (SELECT award AS id, award AS text FROM canon)",
    _WIN, _NOM, _PRE, _top_sql("w", "wv"), _top_sql("n", "nv"), _top_sql("p", "pv"),
    _one_sql(K.DRESS_PHRASES, "dressed"), _one_sql(K.JOKE_PHRASES, "joke"), _REPUTABLE,
    f"topk AS (SELECT *, row_number() OVER ({RANKED}) AS rk FROM host_rank {RANKED} LIMIT 2)",
    "per AS (SELECT award_id, c.award, p.names AS p, n.names AS n, w.names AS w FROM canon c LEFT JOIN p USING (award) LEFT JOIN n USING (award) LEFT JOIN w USING (award))",
    select="""SELECT section, grp::BIGINT AS grp, i, line FROM (
      SELECT 0 AS section, 0 AS grp, 0 AS i, 'Host: ' || coalesce((SELECT string_agg(name, ', ' ORDER BY rk) FROM topk), '') AS line
      UNION ALL SELECT 0, 0, 1, ''
      UNION ALL SELECT 1, award_id, 0, 'Award: ' || award FROM per
      UNION ALL SELECT 1, award_id, 1, 'Presenters: ' || coalesce(p, '') FROM per
      UNION ALL SELECT 1, award_id, 2, 'Nominees: ' || coalesce(n, '') FROM per
      UNION ALL SELECT 1, award_id, 3, 'Winner: ' || coalesce(w, '') FROM per
      UNION ALL SELECT 1, award_id, 4, '' FROM per
      UNION ALL SELECT 2, 0, 0, 'Best Dressed: ' || coalesce((SELECT name FROM dressed), 'None')
      UNION ALL SELECT 3, 0, 0, 'Best Joke: ' || coalesce((SELECT name FROM joke), 'None')
      UNION ALL SELECT 3, 0, 1, ''
      UNION ALL SELECT 4, 0, 0, 'List of Predicted Awards:'
      UNION ALL SELECT 5, -len(award), 0, award FROM kept)""",
)


@query("report_lines", REPORT_SQL)
def _(spark, sf):
    lines = R.full_report(posts_of(spark, sf), canonical_frame(spark))
    return lines.select("ord.section", "ord.grp", "ord.i", "line")
