"""Pieces of check SQL: the span rules written with list functions."""

from laurel import constants as K

TOKENS = r"regexp_extract_all({t}, '@\w+|[\p{{L}}\p{{N}}_]+(?:''\p{{L}}+)?|[^\s\p{{L}}\p{{N}}_]')"
PERSON = "[A-Z][a-z]+(?: [A-Z][a-z]+)+"
PERSON_ANY = "[A-Z][a-z]+(?: [A-Z][a-z]+)*"
ENTITY = "[A-Z][A-Za-z0-9''-]*(?: [A-Z][A-Za-z0-9''-]*)*"
MARK = r"(regexp_matches({x}, '^[^\p{{L}}\p{{N}}_@]') OR {x} = '@')"


def listed(values, lower=False):
    return ", ".join("'" + (v.lower() if lower else v).replace("'", "''") + "'" for v in values)


def tokens(text):
    return TOKENS.format(t=text)


def token_text(text):
    return f"array_to_string({tokens(text)}, ' ')"


def drop_marks(text):
    return (
        f"array_to_string(list_filter({tokens(text)}, "
        "lambda tk: lower(tk) <> 'rt' AND NOT starts_with(tk, '@')), ' ')"
    )


def phrases_after(
    t, marker="best", stop_tokens=K.AFTER_STOP_TOKENS, stop_words=K.AFTER_STOP_WORDS,
    verbs=K.CLAUSE_VERBS, max_marks=1,
):
    """All phrases after the marker, from the token list ``t``."""
    exact = listed(list(stop_tokens) + list(verbs))
    is_mark = MARK.format(x=f"{t}[j]")
    next_mark = MARK.format(x=f"{t}[j+1]")
    inner = MARK.format(x="y")
    words = f"lower({t}[j]) IN ({listed(stop_words)})" if stop_words else "false"
    stop = (
        f"({t}[j] IN ({exact}) OR {words} OR ({is_mark} AND ("
        f"len(list_filter({t}[i+1:j], lambda y: {inner})) > {max_marks} "
        f"OR (j < len({t}) AND {next_mark}))))"
    )
    return (
        f"list_transform(list_filter(range(1, len({t})+1), lambda i: lower({t}[i]) = '{marker}'), "
        f"lambda i: array_to_string({t}[i : coalesce(list_filter(range(i+1, len({t})+1), "
        f"lambda j: {stop})[1], len({t})+1) - 1], ' '))"
    )


def longest(phrases):
    return f"list_filter({phrases}, lambda x: len(x) = list_max(list_transform({phrases}, lambda z: len(z))))[1]"


def or_null(expr):
    return f"nullif({expr}, '')"


def subject(text, verbs=K.SUBJECT_VERBS):
    return or_null(
        f"regexp_extract({text}, '((?:(?:[Tt]he|[Aa]n?) )?[A-Z][A-Za-z0-9-]*(?: [A-Z][A-Za-z0-9-]*)*) "
        f"(?:{'|'.join(verbs)})(?: |$)', 1)"
    )


def first_entity(text):
    return or_null(f"regexp_extract({text}, '{ENTITY}', 0)")


def award_suffix(text):
    end = "(?:award|honor|prize|trophy)"
    return or_null(
        rf"regexp_extract({text}, '(?:^| )((?:[A-Z][\p{{L}}\p{{N}}]* (?:\. )?)*(?:{end} )*{end})$', 1)"
    )


def award_before(t, marker="award", stop_tokens=K.AFTER_STOP_TOKENS_HYPHEN, verbs=K.CLAUSE_VERBS):
    """The longest run left of a marker, from the token list ``t``."""
    exact = listed(list(stop_tokens) + list(verbs))
    is_mark = MARK.format(x=f"{t}[j]")
    runs = (
        f"list_filter(list_transform(list_filter(range(1, len({t})+1), lambda i: lower({t}[i]) = '{marker}'), "
        f"lambda i: array_to_string({t}[coalesce(list_max(list_filter(range(1, i), "
        f"lambda j: {t}[j] IN ({exact}) OR {is_mark})), 0) + 1 : i - 1], ' ')), lambda r: r <> '')"
    )
    return longest(runs)


def not_show(award):
    return f"CASE WHEN lower(trim({award})) NOT IN ({listed(K.SHOW_NAMES, True)}) THEN {award} END"


def word_match(text, words, ignore_case=True, whole=True):
    body = "|".join(words)
    # word bounds spelt out: those of this dialect know ASCII only
    body = rf"(?:^|[^\p{{L}}\p{{N}}_])(?:{body})(?:$|[^\p{{L}}\p{{N}}_])" if whole else f"(?:{body})"
    return f"regexp_matches({text}, '{'(?i)' if ignore_case else ''}{body}')"


def with_awards(source="posts", body=None, name="awarded", suffix_rule=True, **rules):
    """CTEs from ``source(post_id, pos, text)`` to ``name(…, body, tk, award)`` with X7."""
    body = token_text("text") if body is None else body
    before = award_suffix("body") if suffix_rule else award_before("tk", **{})
    return f"""{name}_tk AS (SELECT *, string_split(body, ' ') AS tk FROM (SELECT *, {body} AS body FROM {source})),
{name}_ph AS (SELECT *, {phrases_after('tk', **rules)} AS ph FROM {name}_tk),
{name}_aw AS (SELECT *, coalesce({longest('ph')}, {before}) AS aw0 FROM {name}_ph),
{name} AS (SELECT * EXCLUDE (aw0), {not_show('aw0')} AS award, aw0 AS award_any FROM {name}_aw)"""


def evidence(words, source="posts", name="evidence", first_ignores_case=False, artefacts=True, suffix_rule=True, verbs=K.SUBJECT_VERBS):
    """CTEs for the (award, name) pair of each keyword post."""
    drop = (
        "AND NOT regexp_matches(award, '(?i)(win|#|@)') AND NOT regexp_matches(name, '(?i)(win|#|@)')"
        if artefacts
        else ""
    )
    return f"""{name}_in AS (SELECT * FROM {source} WHERE {word_match('text', words, first_ignores_case)}),
{with_awards(name + '_in', drop_marks('text'), name + '_a', suffix_rule)},
{name} AS (SELECT post_id, pos, award, name FROM (
  SELECT *, coalesce({subject('body', verbs)}, {first_entity('body')}) AS name FROM {name}_a
  WHERE {word_match('body', words)}) WHERE award IS NOT NULL AND name IS NOT NULL {drop})"""


def tfidf(targets, keys, n):
    """CTEs over ``targets(id, text)`` and ``keys(id, text)``; result ``ranked``."""
    term = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]{2,}')"
    return f"""tt AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({term}) AS term FROM {targets}) GROUP BY ALL),
kt AS (SELECT id, term, count(*) AS tf FROM (SELECT id, unnest({term}) AS term FROM {keys}) GROUP BY ALL),
total AS (SELECT (SELECT count(*) FROM {targets}) + (SELECT count(*) FROM {keys}) AS n),
idf AS (SELECT term, ln((1.0 + (SELECT n FROM total)) / (1.0 + count(*))) + 1.0 AS idf
        FROM (SELECT term FROM tt UNION ALL SELECT term FROM kt) GROUP BY term),
tx AS (SELECT id, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY id)) AS w FROM tt JOIN idf USING (term)),
kx AS (SELECT id, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY id)) AS w FROM kt JOIN idf USING (term)),
sims AS (SELECT tx.id AS target, kx.id AS key, sum(tx.w * kx.w) AS sim FROM tx JOIN kx USING (term) GROUP BY ALL),
ranked AS (SELECT target, key, sim, row_number() OVER (PARTITION BY target ORDER BY round(sim, 12) DESC, key) AS rank FROM sims)"""


# --- sequence measures ------------------------------------------------------------------


def subsequence(a, b):
    """Length of the longest common subsequence of two texts of at most 120 characters.

    One bit for each character of ``a``; each character of ``b`` adds its places and keeps
    what was free on their left.
    """
    full = f"((1::HUGEINT << len({a})::INTEGER) - 1)"
    places = (
        f"coalesce(list_sum(list_transform(range(len({a})), lambda i: "
        f"CASE WHEN {a}[i + 1] = ch THEN 1::HUGEINT << i::INTEGER ELSE 0::HUGEINT END)), 0)::HUGEINT"
    )
    masks = f"list_transform(string_split({b}, ''), lambda ch: {places})"
    fold = f"list_reduce(list_prepend({full}, {masks}), lambda v, m: ((v + (v & m)) | (v - (v & m))) & {full})"
    return f"(CASE WHEN {a} = '' OR {b} = '' THEN 0 ELSE len({a}) - bit_count({fold}) END)"


def token_set(pairs, name="scored"):
    """CTEs from ``pairs(target, key)`` to ``name(target, key, score)``, in any case."""
    words = r"list_sort(list_distinct(list_filter(regexp_split_to_array(lower({}), '\s+'), lambda w: w <> '')))"
    less = "array_to_string(list_filter({0}, lambda w: NOT list_contains({1}, w)), ' ')"
    return f"""{name}_w AS (SELECT target, key, {words.format('target')} AS x, {words.format('key')} AS y FROM {pairs}),
{name}_s AS (SELECT target, key, len(x) AS nx, len(y) AS ny, {less.format('x', 'y')} AS l, {less.format('y', 'x')} AS r,
  array_to_string(list_filter(x, lambda w: list_contains(y, w)), ' ') AS s FROM {name}_w),
{name}_c AS (SELECT *, {subsequence('l', 'r')} AS k FROM {name}_s),
{name} AS (SELECT target, key, CASE WHEN nx = 0 OR ny = 0 THEN 0.0 WHEN s <> '' AND (l = '' OR r = '') THEN 100.0
  WHEN s = '' THEN 200.0::DOUBLE * k / (len(l) + len(r))
  ELSE 100.0::DOUBLE * greatest((2 * (len(s) + 1 + k))::DOUBLE / (2 * len(s) + 2 + len(l) + len(r)),
    (2 * len(s))::DOUBLE / (2 * len(s) + 1 + len(l)), (2 * len(s))::DOUBLE / (2 * len(s) + 1 + len(r))) END AS score FROM {name}_c)"""


def token_set_best(pairs):
    """CTEs to ``best(target, key, score)``: the best key of each target, ties to the smaller."""
    return f"""{token_set(pairs)},
best AS (SELECT target, key, score FROM scored WHERE score > 0
  QUALIFY row_number() OVER (PARTITION BY target ORDER BY score DESC, key) = 1)"""


def blocks(pairs, name="blk"):
    """CTEs from ``pairs(pid, x, y)``, two lists, to ``name(pid, k)``: sizes of their common runs.

    The longest run, leftmost among equals, splits both lists; so do the parts on each side.
    """
    clipped = (
        "least(r.k, w.ahi - r.i, w.bhi - r.j) - greatest(0, w.alo - r.i, w.blo - r.j)"
    )
    best = f"max(({clipped}) * 100000000 - (r.i + greatest(0, w.alo - r.i, w.blo - r.j)) * 10000 - (r.j + greatest(0, w.alo - r.i, w.blo - r.j)))"
    # k * 10^8 - i * 10^4 - j, taken apart again
    parts = "(b + 99999999) // 100000000 AS k, ((b + 99999999) // 100000000 * 100000000 - b) // 10000 AS i, ((b + 99999999) // 100000000 * 100000000 - b) % 10000 AS j"
    return f"""{name}_at AS (SELECT pid, x, y, i, j FROM (SELECT pid, x, y, unnest(range(len(x))) AS i FROM {pairs}),
    LATERAL (SELECT unnest(range(len(y))) AS j) WHERE x[i + 1] = y[j + 1] AND (i = 0 OR j = 0 OR x[i] <> y[j])),
{name}_run AS (SELECT pid, i, j, coalesce(list_filter(range(least(len(x) - i, len(y) - j)), lambda d: x[i + 1 + d] <> y[j + 1 + d])[1],
    least(len(x) - i, len(y) - j)) AS k FROM {name}_at),
{name}_win AS (SELECT pid, 0::BIGINT AS alo, len(x) AS ahi, 0::BIGINT AS blo, len(y) AS bhi FROM {pairs}
  UNION ALL
  SELECT pid, s.alo, s.ahi, s.blo, s.bhi FROM (SELECT pid, unnest([
      {{'alo': alo, 'ahi': i, 'blo': blo, 'bhi': j}}, {{'alo': i + k, 'ahi': ahi, 'blo': j + k, 'bhi': bhi}}]) AS s
    FROM (SELECT pid, alo, ahi, blo, bhi, {parts} FROM (
      SELECT w.pid, alo, ahi, blo, bhi, {best} AS b FROM {name}_win w JOIN {name}_run r ON r.pid = w.pid AND {clipped} > 0
      GROUP BY w.pid, alo, ahi, blo, bhi)))
  WHERE s.alo < s.ahi AND s.blo < s.bhi),
{name} AS (SELECT pid, {parts.split(',')[0]} FROM (SELECT w.pid, {best} AS b FROM {name}_win w
  JOIN {name}_run r ON r.pid = w.pid AND {clipped} > 0 GROUP BY w.pid, alo, ahi, blo, bhi))"""


def greedy(names, threshold=0.85):
    """CTEs from ``names(name, votes)`` to ``owner(name, leader)``; starts a recursive WITH.

    By falling rank each name that no leader before it absorbs leads; a leader absorbs what
    it holds as a part or is like, if both have the same guard words.
    """
    guard = " AND ".join(f"contains(u.name, '{w}') = contains(v.name, '{w}')" for w in K.MERGE_GUARD_WORDS)
    common = (
        "list_sum(list_transform(list_distinct(u.ch), lambda c: least(len(list_filter(u.ch, lambda z: z = c)), "
        "len(list_filter(v.ch, lambda z: z = c)))))"
    )
    return f"""rk AS (SELECT name, string_split(name, '') AS ch, row_number() OVER (ORDER BY len(name) DESC, votes DESC, name) AS r FROM {names}),
near AS (SELECT u.r AS ru, v.r AS rv, u.ch AS x, v.ch AS y, row_number() OVER () AS pid, (contains(u.name, v.name) AND len(u.name) > len(v.name)) AS held
  FROM rk u JOIN rk v ON u.r < v.r AND {guard} AND ((contains(u.name, v.name) AND len(u.name) > len(v.name))
    OR (2.0 * len(v.name) / (len(u.name) + len(v.name)) >= {threshold} AND 2.0 * {common} / (len(u.name) + len(v.name)) >= {threshold}))),
open_pairs AS (SELECT pid, x, y FROM near WHERE NOT held),
{blocks('open_pairs')},
ratio AS (SELECT pid, sum(k) AS m FROM blk GROUP BY pid),
edge AS (SELECT ru, rv FROM near LEFT JOIN ratio USING (pid) WHERE held OR 2.0::DOUBLE * m / (len(x) + len(y)) >= {threshold}),
before AS (SELECT r, [r] || coalesce(list(ru) FILTER (ru IS NOT NULL), []) AS p FROM rk LEFT JOIN edge ON rv = r GROUP BY r),
lead AS (SELECT list_reduce(list_prepend([]::BIGINT[], list(p ORDER BY r)), lambda l, p:
  CASE WHEN list_has_any(l, p[2:]) THEN l ELSE list_append(l, p[1]) END) AS l FROM before),
owner AS (SELECT k.name, o.name AS leader FROM rk k JOIN before b USING (r)
  JOIN rk o ON o.r = coalesce((SELECT min(z) FROM (SELECT unnest(list_intersect(b.p, (SELECT l FROM lead))) AS z)), k.r))"""


def longest_phrase_rows(source, name, marker="best", stop_tokens=K.AFTER_STOP_TOKENS, stop_words=K.AFTER_STOP_WORDS, verbs=K.CLAUSE_VERBS, max_marks=1):
    """CTEs from ``source(post_id, tk)`` to ``name(post_id, phrase)``, one row for each token.

    The same phrases as ``phrases_after``; windows instead of nested lists, for long texts.
    """
    words = f"lower(tok) IN ({listed(stop_words)})" if stop_words else "false"
    return f"""{name}_t AS (SELECT post_id, j, tok, {MARK.format(x='tok')} AS mark, tok IN ({listed(list(stop_tokens) + list(verbs))}) OR {words} AS stop
  FROM (SELECT post_id, generate_subscripts(tk, 1) AS j, unnest(tk) AS tok FROM {source})),
{name}_c AS (SELECT *, stop OR (mark AND coalesce(lead(mark) OVER w, false)) AS hard, sum(mark::INTEGER) OVER w AS cm FROM {name}_t
  WINDOW w AS (PARTITION BY post_id ORDER BY j)),
{name}_n AS (SELECT *, min(CASE WHEN hard THEN j END) OVER (PARTITION BY post_id ORDER BY j ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING) AS h FROM {name}_c),
{name}_p AS (SELECT n.post_id, n.j, array_to_string(s.tk[n.j : least(coalesce(n.h, len(s.tk) + 1), coalesce(m.j, len(s.tk) + 1)) - 1], ' ') AS phrase
  FROM {name}_n n JOIN {source} s USING (post_id) LEFT JOIN {name}_c m ON m.post_id = n.post_id AND m.mark AND m.cm = n.cm + {max_marks} + 1
  WHERE lower(n.tok) = '{marker}'),
{name} AS (SELECT post_id, phrase FROM {name}_p QUALIFY row_number() OVER (PARTITION BY post_id ORDER BY len(phrase) DESC, j) = 1)"""


# --- scoring ----------------------------------------------------------------------------


def words(text):
    return rf"list_filter(regexp_split_to_array({text}, '\s+'), lambda w: w <> '')"


def overlap(pairs, name):
    """CTEs from distinct ``pairs(r, a)`` to ``name(r, a, m)``: word overlap of normal forms."""
    return f"""{name}_w AS (SELECT r, a, {words('r')} AS x, {words('a')} AS y, contains(r, a) OR contains(a, r) AS held,
    row_number() OVER () AS pid FROM {pairs}),
{name}_open AS (SELECT pid, x, y FROM {name}_w WHERE NOT held),
{blocks(name + '_open', name + '_blk')},
{name}_sum AS (SELECT pid, max(k) AS top, sum(CASE WHEN k > 1 THEN k ELSE 0 END) AS runs FROM {name}_blk GROUP BY pid),
{name}_n AS (SELECT *, greatest(len(x), len(y)) AS n, least(len(x), len(y)) AS least_n FROM {name}_w LEFT JOIN {name}_sum USING (pid)),
{name} AS (SELECT r, a, CASE WHEN n = 0 THEN 0.0 WHEN held THEN least_n::DOUBLE / n WHEN top IS NULL THEN 0.0
  WHEN top::DOUBLE / n <= 0.3 THEN top::DOUBLE / n ELSE runs::DOUBLE / n END AS m FROM {name}_n)"""


def spelling(a, b):
    return f"(1.0::DOUBLE - levenshtein({a}, {b})::DOUBLE / nullif(greatest(len({a}), len({b})), 0))"


def translations(pred, gold, aliases, norm):
    """CTEs over ``pred(category, award, result)`` and ``gold(category, award, answers)``.

    Result ``tr(category, award, result, r, target, score, kind)``; starts a recursive WITH.
    """
    near = f"(list_has_any({words('r')}, {words('{0}')}) OR contains(r, {{0}}) OR contains({{0}}, r))"
    listed_aliases = ", ".join("('{}', '{}')".format(*(x.replace("'", "''") for x in pair)) for pair in aliases.items())
    return f"""res AS (SELECT category, award, {norm.format('result')} AS r, max(result) AS result FROM {pred} JOIN {gold} USING (category, award) GROUP BY ALL),
ans AS (SELECT category, award, {norm.format('answer')} AS a, answer, min(i) AS i FROM (
  SELECT category, award, unnest(answers) AS answer, generate_subscripts(answers, 1) AS i FROM {gold}) GROUP BY ALL),
sizes AS (SELECT category, award, count(*) AS n_answers FROM ans GROUP BY ALL),
exact AS (SELECT category, award, result, r, arg_min(answer, i) AS target FROM res JOIN ans USING (category, award) WHERE a = r GROUP BY ALL),
free AS (SELECT * FROM res ANTI JOIN exact USING (category, award, r)),
pair AS (SELECT category, award, result, r, a, answer FROM free JOIN ans USING (category, award)),
close AS (SELECT DISTINCT r, a FROM pair WHERE {near.format('a')}),
{overlap('close', 'ov')},
strong AS (SELECT p.*, m FROM pair p JOIN ov USING (r, a) WHERE m >= 0.45),
taker AS (SELECT category, award, a, r, m FROM (SELECT DISTINCT category, award, a, r, m FROM strong)
  QUALIFY row_number() OVER (PARTITION BY category, award, a ORDER BY m DESC, r) = 1),
mutual AS (SELECT category, award, r, a FROM taker QUALIFY row_number() OVER (PARTITION BY category, award, r ORDER BY m DESC, a) = 1),
fuzzy AS (SELECT p.category, p.award, p.result, p.r, p.answer AS target, {spelling('p.r', 'p.a')} AS score
  FROM pair p JOIN mutual m USING (category, award, r, a)),
lone AS (SELECT f.*, n_answers, (SELECT count(*) FROM strong s WHERE s.category = f.category AND s.award = f.award AND s.r = f.r) AS n_strong
  FROM (SELECT * FROM free ANTI JOIN mutual USING (category, award, r)) f JOIN sizes USING (category, award)),
alias_in(alias, target) AS (VALUES {listed_aliases}),
alias_close AS (SELECT DISTINCT r, alias AS a FROM lone, alias_in WHERE n_answers > n_strong AND {near.format('alias')}),
{overlap('alias_close', 'oa')},
by_alias AS (SELECT l.category, l.award, l.result, l.r, x.target, 0.5 * {spelling('l.r', 'x.alias')} AS score
  FROM lone l JOIN oa ON oa.r = l.r JOIN alias_in x ON x.alias = oa.a WHERE n_answers > n_strong AND m > 0.45
  QUALIFY row_number() OVER (PARTITION BY l.category, l.award, l.r ORDER BY m DESC, x.alias, x.target) = 1),
tr AS (SELECT category, award, result, r, target, 1.0::DOUBLE AS score, 'exact' AS kind FROM exact
  UNION ALL SELECT *, 'fuzzy' FROM fuzzy UNION ALL SELECT *, 'alias' FROM by_alias
  UNION ALL SELECT category, award, result, r, NULL, NULL, NULL FROM lone ANTI JOIN by_alias USING (category, award, r))"""


def grid(pred, gold, year=2013):
    """CTEs from ``tr`` to ``grid(year, category, metric, value)``."""
    return f"""chain AS (SELECT category, award, target, score, row_number() OVER (PARTITION BY category, award, target ORDER BY kind <> 'exact', r) AS i,
    count(*) OVER (PARTITION BY category, award, target) AS n FROM tr WHERE target IS NOT NULL),
reached AS (SELECT category, award, target, sum(score * CASE WHEN i = 1 THEN 0.5 ** (n - 1) ELSE 0.5 ** (n - i + 1) END) AS s FROM chain GROUP BY ALL),
spelt AS (SELECT category, award, avg(s) AS spelling FROM reached GROUP BY ALL),
final AS (SELECT DISTINCT p.category, p.award, coalesce(t.target, p.result) AS x FROM {pred} p
  LEFT JOIN (SELECT category, award, result, target FROM tr WHERE target IS NOT NULL) t USING (category, award, result)),
had AS (SELECT g.category, g.award, len(list_distinct(answers)) AS nd, len(answers) AS m, count(f.x) AS n,
    coalesce(sum(list_contains(answers, f.x)::INTEGER), 0) AS k FROM {gold} g LEFT JOIN final f USING (category, award) GROUP BY ALL),
whole AS (SELECT category, award, CASE WHEN n + nd - k = 0 THEN 0.0 ELSE k::DOUBLE / (n + nd - k) * CASE WHEN n = m AND k = m THEN 1.0
    WHEN k = n THEN 0.95 WHEN k = m THEN 0.9 WHEN k > 0 THEN 0.85 ELSE 0.0 END END AS completeness FROM had),
both AS (SELECT g.category, avg(coalesce(spelling, 0)) AS s, avg(coalesce(completeness, 0)) AS c FROM {gold} g
  LEFT JOIN spelt USING (category, award) LEFT JOIN whole USING (category, award) GROUP BY ALL),
grid AS (SELECT {year} AS year, category, 'spelling' AS metric, s AS value FROM both
  UNION ALL SELECT {year}, category, 'completeness', c FROM both WHERE category <> 'winner')""".replace("both", "means")
