"""Mention positions, windows around them, candidates."""

from pyspark.sql import functions as F

from laurel.catalog import data as D
from laurel.catalog.counting import EVENTS_SQL, event_evidence
from laurel.catalog.extraction import PEOPLE_SPANS, posts_of, with_sql
from laurel.catalog.registry import query
from laurel.operators import linkage as L
from laurel.operators import timing as TI
from laurel.plans import questions as P
from laurel.sources.posts import list_frame

PHRASES = ["of the", "that is", "in the", "to be", "with and"]
PHRASE_PATTERNS = {
    "of the": None, "that is": r"that\s*is", "in the": None, "to be": r"to\s*be", "with and": r"with\s*and",
}
_hits = " UNION ALL ".join(
    f"SELECT '{name}' AS award, post_id, pos FROM posts WHERE regexp_matches(text, '(?:^|[^\\p{{L}}\\p{{N}}_])(?:{pattern})(?:$|[^\\p{{L}}\\p{{N}}_])')"
    for name, pattern in PHRASE_PATTERNS.items()
    if pattern
)


@query("pattern_mentions", f"WITH {D.DOCUMENTS_SQL} {_hits}")
def _(spark, sf):
    names = list_frame(spark, PHRASES)
    return L.pattern_mentions(D.document_posts(spark, sf), names)


CANON = [f"best {c} {m}" for c in ("actor", "actress", "director") for m in ("in a drama", "in a series")]
_canon_hits = " UNION ALL ".join(
    "SELECT '{0}' AS award, post_id, pos FROM posts WHERE regexp_matches(text, '(?i){1}')".format(
        name, r"\b" + r"\s*".join(w for w in name.split() if w not in ("in", "a")) + r"\b"
    )
    for name in CANON
)
# the rule leaves out "in" and "a", so the posts' "in a" must be dropped to match
_SHORT = r"""posts2 AS (SELECT post_id, pos, replace(text, ' in a ', ' ') AS text FROM posts)"""
_FOUND = f"found AS ({_canon_hits.replace('FROM posts ', 'FROM posts2 ')})"
_STATS = """stats AS (SELECT award, count(*) AS n, avg(pos) AS mean, stddev_pop(pos) AS std,
  avg(pos) - 50 AS lo, avg(pos) + 50 AS hi FROM found GROUP BY award)"""


def short_posts(spark, sf):
    return posts_of(spark, sf).withColumn("text", F.replace("text", F.lit(" in a "), F.lit(" ")))


def canon(spark):
    return list_frame(spark, [*CANON, "best unseen award"])


def found_in(spark, sf):
    return L.pattern_mentions(short_posts(spark, sf), canon(spark), ignore_case=True)


def rounded(df):
    return df.select("award", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std", "lo", "hi")])


_ROUND = ", ".join(f"round({c}, 6) AS {c}" for c in ("mean", "std", "lo", "hi"))


@query(
    "position_stats",
    with_sql(
        _SHORT, _FOUND, _STATS,
        select=f"""SELECT award, n, {_ROUND} FROM stats UNION ALL SELECT 'best unseen award', 0, NULL, NULL, NULL, NULL""",
    ),
)
def _(spark, sf):
    return rounded(TI.position_stats(found_in(spark, sf), canon(spark)))


@query(
    "positions_in_range",
    with_sql(
        _SHORT, _FOUND, _STATS,
        select="SELECT award, pos, pos BETWEEN lo AND hi AS in_range FROM found JOIN stats USING (award)",
    ),
)
def _(spark, sf):
    found = found_in(spark, sf)
    return TI.positions_in_range(found, TI.position_stats(found))


_INSIDE = """inside AS (SELECT s.award, p.post_id, p.pos, p.text FROM posts2 p JOIN stats s
  ON p.pos > trunc(s.lo)::BIGINT AND p.pos < trunc(s.hi)::BIGINT)"""


@query("posts_in_windows", with_sql(_SHORT, _FOUND, _STATS, _INSIDE, select="SELECT award, post_id FROM inside"))
def _(spark, sf):
    posts = short_posts(spark, sf)
    stats = TI.position_stats(found_in(spark, sf))
    return TI.posts_in_windows(posts, stats).select("award", "post_id")


@query(
    "timing_candidates",
    with_sql(
        _SHORT, _FOUND, _STATS, _INSIDE, D.PEOPLE_SQL,
        f"named AS (SELECT award, ({PEOPLE_SPANS})[1] AS name FROM inside)",
        """roled AS (SELECT *, CASE WHEN contains(award, 'actor') THEN 'actor' WHEN contains(award, 'actress') THEN 'actress'
          WHEN contains(award, 'director') THEN 'director' END AS role FROM named WHERE name IS NOT NULL)""",
        select="""SELECT award, name, count(*) AS n FROM roled r WHERE EXISTS (SELECT 1 FROM people p
          WHERE p.name = r.name AND contains(lower(p.summary), r.role)) GROUP BY ALL""",
    ),
)
def _(spark, sf):
    return P.timing_candidates(
        short_posts(spark, sf), canon(spark), D.people(spark, sf), ignore_case=True
    )


@query(
    "event_position_stats",
    f"""WITH {EVENTS_SQL} SELECT name AS award, count(*) AS n, round(avg(pos), 6) AS mean, round(stddev_pop(pos), 6) AS std,
      round(avg(pos) - 50, 6) AS lo, round(avg(pos) + 50, 6) AS hi FROM ev GROUP BY name""",
)
def _(spark, sf):
    found = event_evidence(spark, sf).select(F.col("name").alias("award"), "pos")
    return rounded(TI.position_stats(found))


@query(
    "event_windows",
    f"""WITH {EVENTS_SQL}, s AS (SELECT name, avg(pos) - 50 AS lo, avg(pos) + 50 AS hi FROM ev GROUP BY name)
    SELECT s.name AS award, e.pos FROM ev e JOIN s ON e.pos > trunc(lo)::BIGINT AND e.pos < trunc(hi)::BIGINT""",
)
def _(spark, sf):
    events = event_evidence(spark, sf)
    stats = TI.position_stats(events.select(F.col("name").alias("award"), "pos"))
    return TI.posts_in_windows(events.select("pos"), stats).select("award", "pos")
