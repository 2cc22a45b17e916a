"""Inputs of the registered queries: the given tables, and posts made from them.

``event_posts`` words each event as a short post: names come from ``part``, categories
from the event's properties.  It has retweets, links, emoji, foreign letters and blanks,
so that every default rule has something to find, and it grows with ``events``.
"""

from pyspark.sql import functions as F

from laurel.operators.posts import clean_posts
from laurel.sources.posts import as_posts

CATS = "actor,actress,director,picture,screenplay,song,score,animated film"
CAPS = "Actor,Actress,Director,Picture,Screenplay,Song,Score,Animated Film"
MEDIA = "drama,comedy,musical,series,film"
MEDIA_CAPS = "Drama,Comedy,Musical,Series,Film"

# one wording per remainder; columns p, q (names), k, user_id, event_id
WORDINGS = [
    "p || ' wins best ' || cat || ' in a ' || med",
    "'RT @' || h || ': ' || p || ' wins Best ' || ccat || ' - ' || cmed || ' http://t.co/' || event_id",
    "'I hope ' || p || ' wins best ' || cat || '   for the ' || med || ' \U0001F600'",
    "p || ' is nominated for Best ' || ccat || ' in a ' || med || '!'",
    "p || ' and ' || q || ' presenting best ' || cat || ' at the Golden Globes'",
    "p || ' hosting with ' || q || ' tonight #GoldenGlobes www.tv.example'",
    "p || ' is best dressed of the evening'",
    "'best joke by ' || p || '. funniest moment ever'",
    "'Congratulations to ' || p || ' on winning Best ' || ccat",
    "'RT @' || h || ': Best ' || ccat || ' in a ' || cmed || ' - ' || p || '. ' || q || ' presents the ' || med || ' award'",
    "p || ' receives the ' || ccat || ' ' || cmed || ' award'",
    "'Félicitations, ' || p || ' wins best ' || cat",
    "'   '",
    "p || ' will host \U0001F917'",
    "p || ' will be speaking at the ' || cmed || ' Gala pic.twitter.com/x' || event_id",
    "'the nominee ' || p || ' should get best ' || cat || ', I think. AWARD wins'",
    "'rt @' || h || ' ' || p || ' wins the golden ' || med || ' trophy'",
]
_CASE = "CASE event_id % {} {} END".format(
    len(WORDINGS), " ".join(f"WHEN {i} THEN {w}" for i, w in enumerate(WORDINGS))
)

_PARTS = [
    f"split_part('{CATS}', ',', k % 8 + 1) AS cat",
    f"split_part('{CAPS}', ',', k % 8 + 1) AS ccat",
    f"split_part('{MEDIA}', ',', k % 5 + 1) AS med",
    f"split_part('{MEDIA_CAPS}', ',', k % 5 + 1) AS cmed",
    "'src' || (user_id % 7) AS h",
]

def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SPLITS = 8


def dealt_out(df):
    """A table of fewer than eight splits, so of a GB at most, in eight parts.

    The test files have one row group each, and so one split; the text rules need more hands.
    """
    return df.repartition(SPLITS) if df.rdd.getNumPartitions() < SPLITS else df


def part_name():
    """A part's name with its key spelt in letters, so that each part has a name of its own."""
    serial = F.translate(F.col("p_partkey").cast("string"), "0123456789", "abcdefghij")
    return F.initcap(F.concat_ws(" ", F.col("p_name"), serial))


def event_posts(spark, sf_dir):
    """One post for each event; a user speaks of thirteen parts and those next to them."""
    part = table(spark, sf_dir, "part")
    n = part.agg(F.count("*")).scalar()
    events = dealt_out(table(spark, sf_dir, "events")).select(
        "event_id", "ts", "user_id", ((F.col("user_id") * 13 + F.col("event_id") % 13) % n).alias("u"),
        F.expr("cast(regexp_extract(props, '[0-9]+', 0) as int)").alias("k"),
    )
    names = part.select(F.col("p_partkey").alias("u"), part_name().alias("p"))
    others = part.select(((F.col("p_partkey") + n - 1) % n).alias("u"), part_name().alias("q"))
    worded = events.join(names, "u").join(others, "u")
    parts = worded.selectExpr("*", *_PARTS)
    # a generator, so that later filters on the text do not repeat its wording
    text = parts.select("event_id", "ts", "user_id", F.explode(F.array(F.expr(_CASE))).alias("text"))
    return as_posts(text, "event_id", "text", ts="ts", account="'user' || user_id")


def clean_event_posts(spark, sf_dir):
    return clean_posts(event_posts(spark, sf_dir))


def document_posts(spark, sf_dir):
    return as_posts(
        dealt_out(table(spark, sf_dir, "documents")), "doc_id", "text", account="source"
    )


def turn_posts(spark, sf_dir):
    return as_posts(
        dealt_out(table(spark, sf_dir, "conversations")), "conv_id * 100000 + turn", "text", account="role"
    )


def people(spark, sf_dir):
    """Every part name as a person page; the summary names a role, and some say "born"."""
    return (
        table(spark, sf_dir, "part")
        .groupBy(part_name().alias("name"))
        .agg(F.min("p_partkey").alias("id"))
        .select(
            "name",
            F.expr(
                "CASE id % 3 WHEN 0 THEN 'American Actor born in ' || id "
                "WHEN 1 THEN 'An Actress, Born ' || id ELSE 'film Director since ' || id END"
            ).alias("summary"),
        )
    )


# --- the same inputs in SQL ---------------------------------------------------------

_NAME = (
    "upper(substr(split_part(p_name,' ',1),1,1)) || substr(split_part(p_name,' ',1),2) || ' ' || "
    "upper(substr(split_part(p_name,' ',2),1,1)) || substr(split_part(p_name,' ',2),2) || ' ' || "
    "upper(substr(translate(p_partkey::VARCHAR,'0123456789','abcdefghij'),1,1)) || "
    "substr(translate(p_partkey::VARCHAR,'0123456789','abcdefghij'),2)"
)
NAMES_SQL = f"names AS (SELECT p_partkey, {_NAME} AS p FROM part)"
RAW_SQL = f"""{NAMES_SQL}, worded AS (
  SELECT e.*, n.p, o.p AS q, {", ".join(_PARTS)}
  FROM (SELECT event_id, ts, user_id, (user_id * 13 + event_id % 13) % (SELECT count(*) FROM part) AS u,
               CAST(regexp_extract(props, '[0-9]+', 0) AS INTEGER) AS k FROM events) e
  JOIN names n ON n.p_partkey = e.u JOIN names o ON o.p_partkey = (e.u + 1) % (SELECT count(*) FROM part)
), raw AS (
  SELECT event_id AS post_id, event_id AS pos, ts, 'user' || user_id AS account, {_CASE} AS text
  FROM worded
)"""
EMOJI = r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}]"


def clean_sql(text):
    return (
        rf"regexp_replace(regexp_replace(regexp_replace(regexp_replace({text}, "
        rf"'http\S+|www\S+|pic.twitter\S+', '', 'g'), '{EMOJI}', '', 'g'), ' +', ' ', 'g'), "
        r"'^\s+|\s+$', '', 'g')"
    )


FOREIGN_SQL = r"regexp_matches(text, '[^\x00-\x7F\x{263A}-\x{1F645}]')"
POSTS_SQL = f"""{RAW_SQL}, posts AS (
  SELECT post_id, pos, ts, account, t AS text FROM (
    SELECT *, {clean_sql('text')} AS t FROM raw WHERE text IS NOT NULL AND NOT {FOREIGN_SQL}
  ) WHERE t <> ''
)"""
DOCUMENTS_SQL = """posts AS (SELECT doc_id AS post_id, doc_id AS pos, source AS account, text FROM documents)"""
PEOPLE_SQL = f"""people AS (
  SELECT p AS name, CASE min(p_partkey) % 3 WHEN 0 THEN 'American Actor born in ' || min(p_partkey)
    WHEN 1 THEN 'An Actress, Born ' || min(p_partkey)
    ELSE 'film Director since ' || min(p_partkey) END AS summary
  FROM names GROUP BY p
)"""
