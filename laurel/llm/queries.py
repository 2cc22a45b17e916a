"""The registered queries of the numbered operators, with SQL where SQL can express them."""

import functools

from pyspark.sql import functions as F

from laurel.llm import (
    chat_format, collocations, digest_index, divergence, forest_ann, gam_quality, hamming_dedup, hpylm, html_blocks,
    language_id, mixing, packing, token_counts,
)
from laurel.llm.common import held_out, ship, table

QUERIES = {}
SQL = {}


def query(name, sql=None):
    def add(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return add


@query("op1_language_id")
def op1_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = held_out("doc_id", 4, 2)
    profiles = language_id.learn_profiles(docs.where(~out))
    found = language_id.identify(docs.select("doc_id", "text"), profiles)
    return found.select("doc_id", out.alias("held_out"), F.col("language.lang").alias("lang_pred"), "language.score")


@query("op2_best_fit_packing")
def op2_best_fit_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


@query("op3_forest_ann")
def op3_forest_ann(spark, sf_dir):
    return forest_ann.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


@query("op4_html_blocks")
def op4_html_blocks(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    return html_blocks.extract(pages, html_blocks.learn(pages))


OP5_SQL = r"""WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, length(text) + length(regexp_replace(text, '[^\\\[\]<]', '', 'g')) + CASE role WHEN 'system' THEN 13
    WHEN 'user' THEN 15 WHEN 'assistant' THEN 17
    ELSE 16 + length(role) + length(regexp_replace(role, '[^\\\[\]<]', '', 'g')) END AS chars FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


@query("op5_chat_format", OP5_SQL)
def op5_chat_format(spark, sf_dir):
    names = ["conv_id", "turn", "role", "text"]
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return chat_format.conversation_digests(table(spark, sf_dir, "conversations").select(names).union(more))


@query("op6_pitman_yor")
def op6_pitman_yor(spark, sf_dir):
    return hpylm.score_documents(table(spark, sf_dir, "documents"), held_out("doc_id", 5, 1))


@query("op7_gam_quality")
def op7_gam_quality(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = held_out("doc_id", 5, 0)
    gam = gam_quality.learn(docs, labels.where(~out))
    # a generator between, so that the score is worked out once
    scored = docs.select("doc_id", out.alias("held_out"), F.explode(F.array(gam_quality.quality_of(F.col("text"), gam))).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


OP8_SQL = r"""WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS same
  FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * same >= 75 * (p.n + q.n - same)
), edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, t.b FROM reach r JOIN edges t ON r.b = t.a
), roots AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM documents JOIN roots USING (doc_id) LEFT JOIN sizes USING (doc_id)"""


@query("op8_minhash_hamming", OP8_SQL)
def op8_minhash_hamming(spark, sf_dir):
    return hamming_dedup.near_duplicates(table(spark, sf_dir, "documents"))


OP9_SQL = r"""WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
), g AS (SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY 1)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)"""


@query("op9_digest_index", OP9_SQL)
def op9_digest_index(spark, sf_dir):
    index = digest_index.DigestIndex(spark)
    decided = index.add(table(spark, sf_dir, "documents"))
    index.close()
    return decided


def _level_sql(source, out, parent, name, weight):
    """One level of the budget: siblings by cap for their weight, full ones first."""
    return f"""{out}_w AS (SELECT *, CAST({weight} AS HUGEINT) AS w FROM {source}
), {out}_s AS (
  SELECT *, budget - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
    sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM {out}_w WINDOW o AS (PARTITION BY {parent} ORDER BY cap / w, {name})
), {out}_f AS (SELECT *, cap * weights <= w * remaining AS is_full FROM {out}_s
), {out} AS (
  SELECT *, CASE WHEN is_full THEN cap ELSE w * (budget - coalesce(sum(CASE WHEN is_full THEN cap END) OVER p, 0))
    // sum(CASE WHEN NOT is_full THEN w END) OVER p END AS given
  FROM {out}_f WINDOW p AS (PARTITION BY {parent}))"""


OP10_EPOCHS, OP10_BUDGET, OP10_SEED = 2, 0.8, 1
_KEY = f"md5('{OP10_SEED}:' || {{}} || ':' || coalesce(CAST(doc_id AS VARCHAR), ''))"
OP10_SQL = rf"""WITH docs AS (
  SELECT doc_id, CASE WHEN coalesce(source, '') = '' THEN 'none' ELSE 'd' || (ascii(right(source, 1)) % 3) END AS domain,
    coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS tokens FROM documents
), leaves AS (
  SELECT domain, lang, source, CAST(sum(tokens) AS HUGEINT) AS tokens, CAST(sum(tokens) * {OP10_EPOCHS} AS HUGEINT) AS cap
  FROM docs GROUP BY ALL
), top AS (
  SELECT 'all' AS root, domain, sum(cap) AS cap,
    (SELECT CAST(floor(CAST(sum(tokens) AS DOUBLE) * {OP10_BUDGET}) AS HUGEINT) FROM leaves) AS budget
  FROM leaves GROUP BY domain
), {_level_sql("top", "t", "root", "domain", mixing.WEIGHTS[0])}
, mid AS (
  SELECT l.domain, l.lang, sum(l.cap) AS cap, any_value(t.given) AS budget
  FROM leaves l JOIN t USING (domain) GROUP BY l.domain, l.lang
), {_level_sql("mid", "m", "domain", "lang", mixing.WEIGHTS[1])}
, low AS (SELECT l.*, m.given AS budget FROM leaves l JOIN m USING (domain, lang)
), {_level_sql("low", "f", "domain, lang", "source", mixing.WEIGHTS[2])}
, placed AS (
  SELECT d.*, e.epoch, f.given - e.epoch * f.tokens AS room,
    sum(d.tokens) OVER (PARTITION BY d.domain, d.lang, d.source, e.epoch ORDER BY {_KEY.format("e.epoch")}) AS upto
  FROM docs d JOIN f USING (domain, lang, source), (SELECT CAST(unnest(range({OP10_EPOCHS})) AS INTEGER) AS epoch) e
  WHERE f.given >= e.epoch * f.tokens AND (e.epoch = 0 OR f.tokens > 0)
)
SELECT doc_id, lang, source, epoch, CAST(tokens AS BIGINT) AS n_tokens FROM placed WHERE upto <= room"""


@query("op10_mixing", OP10_SQL)
def op10_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    mixed = mixing.mix(docs, OP10_BUDGET, OP10_EPOCHS, OP10_SEED, epoch_column="epoch")
    none = F.lit("none")
    return mixed.select(
        "doc_id", F.coalesce("lang", none).alias("lang"), F.coalesce("source", none).alias("source"), "epoch",
        F.regexp_count(F.coalesce("text", F.lit("")), F.lit(mixing.WORD)).cast("long").alias("n_tokens"),
    )


OP11_SQL = r"""WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), words AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), spans AS (
  SELECT lang, w, unnest(range(1, least(k, len(w)) + 1)) AS k, unnest_at AS i
  FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS unnest_at, 5 AS k FROM words)
), f AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k, count(*) AS c FROM spans
  WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang
), cand AS (SELECT lang, phrase, k, c AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND c >= 100
), starts AS (SELECT *, unnest(range(1, k + 1)) AS i FROM cand
), inner_ AS (SELECT lang, w, k, a, i, unnest(range(2, k)) AS m FROM starts
), held AS (
  SELECT DISTINCT lang, phrase FROM (
    SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, a AS longer FROM inner_ WHERE i + m - 1 <= k)
  JOIN (SELECT lang, phrase, a FROM cand) USING (lang, phrase) WHERE 100 * longer >= 100 * a
), cuts AS (
  SELECT lang, phrase, a, w, k, unnest(range(1, k)) AS j FROM cand ANTI JOIN held USING (lang, phrase)
), scored AS (
  SELECT c.lang, c.phrase, c.a, j, l.c AS l, r.c AS r, n,
    1000::HUGEINT * c.a::HUGEINT * n::HUGEINT // (l.c::HUGEINT * r.c::HUGEINT) AS score
  FROM cuts c JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ') JOIN totals t ON t.lang = c.lang
), best AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000"""


@query("op11_collocations", OP11_SQL)
def op11_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


OP12_SQL = r"""WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, unnest(regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
), kept AS (SELECT lang, term FROM d GROUP BY ALL HAVING count(DISTINCT doc_id) >= 3
), sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang
), groups AS (SELECT DISTINCT coalesce(lang, '') AS lang, coalesce(source, '') AS source FROM documents
), counts AS (SELECT lang, source, term, count(*) AS c FROM d JOIN kept USING (lang, term) GROUP BY ALL
), totals AS (SELECT lang, source, sum(c) AS n FROM counts GROUP BY ALL
), shares AS (
  SELECT lang, source, term, coalesce(c, 0) AS c,
    1 + 1000000000::HUGEINT * (coalesce(c, 0) + 1) // (coalesce(n, 0) + v) AS p
  FROM groups JOIN sizes USING (lang) JOIN kept USING (lang)
  LEFT JOIN totals USING (lang, source) LEFT JOIN counts USING (lang, source, term)
), usual AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (sum(c) + 1) // (any_value(n) + any_value(v)) AS q
  FROM counts JOIN (SELECT lang, sum(n) AS n FROM totals GROUP BY lang) USING (lang) JOIN sizes USING (lang) GROUP BY lang, term
), sums AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), rows AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM shares JOIN usual USING (lang, term) WHERE c > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM rows QUALIFY part = 'pair' OR rank <= 200"""


@query("op12_divergence", OP12_SQL)
def op12_divergence(spark, sf_dir):
    return divergence.audit(table(spark, sf_dir, "documents"))


@query("op13_token_counts")
def op13_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


@query("pipeline")
def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)
