r"""Span rules: candidate names and categories from one text, in SQL expressions.

All rules are deterministic and take their trigger words as parameters.  The award
rules work on *token text*: tokens joined by single blanks (see ``text.token_text``).
"""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import constants as K
from laurel.functions import text as T

PERSON = r"[A-Z][a-z]+(?: [A-Z][a-z]+)+"
PERSON_ANY = r"[A-Z][a-z]+(?: [A-Z][a-z]+)*"
ENTITY = r"[A-Z][A-Za-z0-9'-]*(?: [A-Z][A-Za-z0-9'-]*)*"
CAPITAL_RUN = r"[A-Z][A-Za-z0-9-]*(?: [A-Z][A-Za-z0-9-]*)*"
NAME_PAIR = r"^([A-Z][a-z]+(?: [A-Z][a-z]+)?) and ([A-Z][a-z]+(?: [A-Z][a-z]+)?)\b"

_WORD = r"@?[\p{L}\p{N}_]++(?:'\p{L}++)?"
_MARK = r"[^\p{L}\p{N}_@ ]|@(?= |$)"
_END = r"(?= |$)"


def _options(words):
    return "|".join(re.escape(w) for w in words)


def _all(text: Column, pattern: str, group=0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def longest(phrases: Column) -> Column:
    """The longest member, the first one on ties; null for an empty array."""
    return F.aggregate(
        phrases,
        F.lit(None).cast("string"),
        lambda best, x: F.when(best.isNull() | (F.length(x) > F.length(best)), x).otherwise(best),
    )


# --- names -----------------------------------------------------------------


def person_spans(text: Column, pattern=PERSON) -> Column:
    """Capitalised runs of two or more words, without handles and tags."""
    return _all(text, pattern)


def person_spans_not_listed(text: Column, names, pattern=PERSON) -> Column:
    listed = [n.lower() for n in names]
    return F.filter(person_spans(text, pattern), lambda p: ~F.lower(F.trim(p)).isin(listed))


def entity_spans(text: Column) -> Column:
    return _all(text, ENTITY)


def first_entity(text: Column) -> Column:
    return T.empty_to_null(F.regexp_extract(text, ENTITY, 0))


def subject(text: Column, verbs=tuple(K.SUBJECT_VERBS)) -> Column:
    """The capitalised run, with an article, directly before one of the verbs."""
    pattern = (
        r"((?:(?:[Tt]he|[Aa]n?) )?[A-Z][A-Za-z0-9-]*(?: [A-Z][A-Za-z0-9-]*)*)"
        rf" (?:{_options(verbs)})(?: |$)"
    )
    return T.empty_to_null(F.regexp_extract(text, pattern, 1))


def name_pair(text: Column) -> Column:
    """``A and B`` at the start of a post."""
    return T.empty_to_null(F.regexp_extract(text, NAME_PAIR, 0))


# --- award names ------------------------------------------------------------


def after_marker_pattern(marker, stop_tokens, stop_words, clause_verbs, max_marks):
    single = "".join(re.escape(t) for t in stop_tokens if len(t) == 1 and t != "@")
    named = [t for t in stop_tokens if len(t) > 1]
    # stop words in any case; clause verbs and tokens as written ("Will" may be a name)
    barred = rf"(?:(?i:{_options(stop_words) or '(?!)'})"
    for exact in (_options(clause_verbs), _options(named)):
        barred += f"|{exact}" if exact else ""
    barred += ")"
    word = rf"(?: (?!{barred}{_END}){_WORD})*+"
    # one free punctuation token: not a stop token, and no punctuation after it
    at = "" if "@" in stop_tokens else r"|@(?= |$)"
    mark = rf" (?:[^\p{{L}}\p{{N}}_@ {single}]{at})(?! (?:{_MARK}))"
    marks = rf"(?:{mark}{word}){{0,{max_marks}}}" if max_marks else ""
    return rf"(?<![^ ])(?=((?i:{re.escape(marker)}){_END}{word}{marks}))"


def phrases_after(
    token_text: Column,
    marker="best",
    stop_tokens=tuple(K.AFTER_STOP_TOKENS),
    stop_words=tuple(K.AFTER_STOP_WORDS),
    clause_verbs=tuple(K.CLAUSE_VERBS),
    max_marks=1,
) -> Column:
    """One phrase per marker: the marker and what follows up to a stop.

    A phrase ends at a stop token, a stop word, a clause verb, the punctuation token
    after ``max_marks`` others, or punctuation that is followed by punctuation.
    """
    pattern = after_marker_pattern(marker, stop_tokens, stop_words, clause_verbs, max_marks)
    return _all(token_text, pattern, 1)


def award_after_best(token_text: Column, **rules) -> Column:
    return longest(phrases_after(token_text, **rules))


def award_suffix(token_text: Column, endings=tuple(K.AWARD_ENDINGS)) -> Column:
    """A text that ends in an award word, with the capitalised words before it."""
    ending = rf"(?:{_options(endings)})"
    pattern = rf"(?:^| )((?:[A-Z][\p{{L}}\p{{N}}]*+ (?:\. )?)*(?:{ending} )*{ending})$"
    return T.empty_to_null(F.regexp_extract(token_text, pattern, 1))


def award_before(
    token_text: Column,
    marker="award",
    stop_tokens=tuple(K.AFTER_STOP_TOKENS_HYPHEN),
    clause_verbs=tuple(K.CLAUSE_VERBS),
) -> Column:
    """The longest run of words left of any marker, back to a stop."""
    named = [t for t in stop_tokens if len(t) > 1]
    barred = f"(?:{_options(list(clause_verbs) + named)})"
    # cut the text at stops, then keep what precedes the last marker of each piece
    cut = F.regexp_replace(token_text, rf"(?<![^ ])(?:{barred}|{_MARK}){_END}", "\u0001")
    pieces = F.split(cut, "\u0001")
    pattern = rf"(?i)^(.*) {re.escape(marker)}(?: |$)"
    found = F.transform(pieces, lambda p: F.trim(F.regexp_extract(p, pattern, 1)))
    return longest(F.filter(found, lambda p: p != ""))


def award_name(token_text: Column, show_names=tuple(K.SHOW_NAMES), suffix_rule=True, **rules):
    """The phrase after "best", else the one before "award"; null for a show name."""
    before = award_suffix(token_text) if suffix_rule else award_before(token_text)
    award = F.coalesce(award_after_best(token_text, **rules), before)
    if not show_names:
        return award
    return F.when(~F.lower(F.trim(award)).isin([n.lower() for n in show_names]), award)


def award_after_verb(text: Column, verb="wins", endings=tuple(K.FALLBACK_AWARD_WORDS)) -> Column:
    """What stands between the verb and the first award word, that word included."""
    pattern = rf"(?i){re.escape(verb)}\s+(.*?\b(?:{_options(endings)})\b)"
    return T.empty_to_null(F.regexp_extract(text, pattern, 1))


def descriptor_category(
    text: Column, descriptors=tuple(K.AWARD_DESCRIPTORS), categories=tuple(K.AWARD_CATEGORIES)
) -> Column:
    """The first descriptor-category pair, in list order, found in the text."""
    any_pair = rf"(?i)(?:{_options(descriptors)}).*(?:{_options(categories)})"
    hits = [
        T.empty_to_null(F.regexp_extract(text, rf"(?i){re.escape(d)}.*{re.escape(c)}", 0))
        for d in descriptors
        for c in categories
    ]
    return F.when(text.rlike(any_pair), F.coalesce(*hits))


def category_after_keyword(
    text: Column, words=tuple(K.WINNER_WORDS_LOOSE), marker="best", reach=4, **rules
) -> Column:
    """The first phrase after the marker if the marker is near behind a keyword."""
    rest = F.regexp_extract(text, rf"(?is)(?:{_options(words)})(.*)$", 1)
    near = F.slice(T.words(rest), 1, reach)
    phrase = F.get(phrases_after(T.token_text(text), marker=marker, **rules), F.lit(0))
    return F.when(F.exists(near, lambda w: F.lower(w) == marker), phrase)


# --- closeness ----------------------------------------------------------------


def windows_around(text: Column, words, width=50):
    """Texts left and right of each keyword hit, at most ``width`` characters long."""
    hit = rf"(?:{_options(words)})\b"
    left = _all(text, rf"(?is)\b(?={hit})(?<=(^.{{0,{width - 1}}}|.{{{width}}})){hit}", 1)
    right = _all(text, rf"(?is)\b{hit}(?=(.{{0,{width}}}))", 1)
    return F.concat(left, right)


def persons_near_keyword(
    token_text: Column, words=tuple(K.WINNER_WORDS_LOOSE), reach=3, person=PERSON
) -> Column:
    """Persons with a keyword at most ``reach`` tokens from their first or last token."""
    key = rf"[^ ]*(?i:{_options(words)})[^ ]*"
    run = rf"(?>{person})(?![^ ])"
    behind = _all(token_text, rf"(?<![^ ])({run})(?=(?: [^ ]+){{0,{reach}}} {key})", 1)
    ahead = _all(
        token_text, rf"(?<![^ ])(?={key}(?: [^ ]+){{0,{reach - 1}}}? ({run}))", 1
    )
    inside = F.filter(_all(token_text, rf"(?<![^ ]){run}"), lambda p: p.rlike(f"(?i)(?:{_options(words)})"))
    return F.array_distinct(F.concat(behind, F.filter(ahead, lambda p: p != ""), inside))


# --- patterns with two parts ------------------------------------------------------


def two_part_patterns(text: Column) -> Column:
    """Array of (label, person, target) for the four fixed sentence forms."""
    forms = [
        ("WINNER", rf"({PERSON_ANY}) (?:wins|win|won|winning) (?:[Tt]he |[Aa]n? )?({CAPITAL_RUN})"),
        ("NOMINEE", rf"({PERSON_ANY}) is (?:nominated|nominate) for (?:[Tt]he |[Aa]n? )?({CAPITAL_RUN})"),
        ("SPEAKER", rf"({PERSON_ANY}) will be speaking at (?:[Tt]he |[Aa]n? )?({CAPITAL_RUN})"),
        (
            "AWARD_WIN",
            rf"(?i:congratulations to) ({PERSON_ANY}) on winning (?:[Tt]he |[Aa]n? )?({CAPITAL_RUN})",
        ),
    ]
    def rows_of(label, pattern):
        return F.zip_with(
            _all(text, pattern, 1),
            _all(text, pattern, 2),
            lambda p, t: F.struct(
                F.lit(label).alias("label"), p.alias("person"), t.alias("target")
            ),
        )

    rows = [rows_of(*form) for form in forms]
    return F.concat(*rows)


def nomination(text: Column, **rules):
    """(person, award) of "X is nominated for / is a nominee for Y"."""
    verb = r"(?i:is nominated for|is a nominee for)"
    person = T.empty_to_null(F.regexp_extract(text, PERSON, 0))
    fallback = T.empty_to_null(
        F.trim(
            F.regexp_extract(
                text, rf"(?i)\w+\s+{verb}(.*?\b(?:{_options(K.FALLBACK_AWARD_WORDS)})\b)", 1
            )
        )
    )
    award = F.coalesce(award_after_best(T.token_text(text), **rules), fallback)
    return F.when(
        text.rlike(verb), F.struct(person.alias("name"), award.alias("award"))
    )
