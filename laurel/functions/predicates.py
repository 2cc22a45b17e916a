"""Row filters as boolean columns."""

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import constants as K


def word_pattern(words, ignore_case=True, whole=True):
    body = "|".join(re.escape(w) for w in words)
    return ("(?i)" if ignore_case else "") + (rf"\b(?:{body})\b" if whole else f"(?:{body})")


def has_word(text: Column, words, ignore_case=True, whole=True) -> Column:
    """Any of the words occurs; a null text counts as no."""
    return F.coalesce(text.rlike(word_pattern(words, ignore_case, whole)), F.lit(False))


def has_award_word(text, words=tuple(K.AWARD_WORDS)):
    return has_word(F.lower(text), words, ignore_case=False)


def has_phrase(text: Column, phrases) -> Column:
    """Any phrase occurs in the lower-cased text."""
    low = F.lower(text)
    hit = F.lit(False)
    for phrase in phrases:
        hit = hit | low.contains(phrase)
    return hit


def has_award_and_win(text: Column) -> Column:
    """An award word and a win word on one line.

    The lower-case spellings "award" and "wins" may come in any order; the other
    spellings count only where they come first.
    """
    return text.rlike(
        r"award.*wins|(?:wins|Wins|WINS|winner|WINNER).*award|AWARD.*wins"
    )


def is_listed(name: Column, names) -> Column:
    return F.lower(F.trim(name)).isin([n.lower() for n in names])


def has_artefact(value: Column) -> Column:
    return value.rlike(K.ARTEFACT)


def is_human_name(name: Column) -> Column:
    return (
        ~name.rlike("[@#]")
        & ~F.lower(name).isin(K.NOT_A_PERSON)
        & name.rlike(r"^[A-Z][a-z]+(?: [A-Z][a-z]+)*$")
    )


def is_handle_or_tag(name: Column) -> Column:
    return name.startswith("@") | name.startswith("#") | F.lower(name).startswith("rt @")


def contains_ignore_case(text: Column, part: Column) -> Column:
    return F.contains(F.lower(text), F.lower(part))


def names_overlap(a: Column, b: Column) -> Column:
    return F.arrays_overlap(F.split(F.lower(a), r"\s+"), F.split(F.lower(b), r"\s+"))


def both_present(award: Column, name: Column) -> Column:
    return award.isNotNull() & name.isNotNull()


def may_merge(a: Column, b: Column, words=tuple(K.MERGE_GUARD_WORDS)) -> Column:
    """Each guard word is in both names or in neither."""
    ok = F.lit(True)
    for word in words:
        ok = ok & (a.contains(word) == b.contains(word))
    return ok
