"""Cleaning, tokens and normal forms."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from laurel import constants as K

# A handle, a word with an optional apostrophe part, or one other visible character.
TOKEN = r"@\w+|[\p{L}\p{N}_]+(?:'\p{L}+)?|[^\s\p{L}\p{N}_]"


def empty_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def has_foreign_characters(text: Column, strict_ascii=False) -> Column:
    """Letters outside ASCII; the default lets one wide symbol range pass as well."""
    return text.rlike(K.NON_ASCII_CHARACTER if strict_ascii else K.FOREIGN_CHARACTER)


def strip_urls(text: Column) -> Column:
    return F.regexp_replace(text, K.URL, "")


def strip_emoji(text: Column) -> Column:
    return F.regexp_replace(text, K.EMOJI_BLOCKS, "")


def squeeze(text: Column) -> Column:
    """Runs of blanks become one blank; outer white space goes."""
    return F.regexp_replace(F.regexp_replace(text, " +", " "), r"^\s+|\s+$", "")


def clean(text: Column) -> Column:
    return squeeze(strip_emoji(strip_urls(text)))


def clean_alternate(text: Column) -> Column:
    """Lower-case words and handles only; a retweet becomes an empty text."""
    bare = F.regexp_replace(strip_urls(text), K.EMOJI_BLOCKS, "")
    bare = F.regexp_replace(bare, K.HASHTAG, "")
    bare = F.regexp_replace(bare, K.NOT_ALNUM_AT_BLANK, "")
    bare = F.lower(F.trim(F.regexp_replace(bare, " +", " ")))
    return F.when(text.rlike(K.RETWEET_POST), F.lit("")).otherwise(bare)


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TOKEN), F.lit(0))


def token_text(text: Column) -> Column:
    return F.array_join(tokens(text), " ")


def drop_retweet_marks(text: Column) -> Column:
    """Tokens without ``rt`` and handles, joined by one blank."""
    kept = F.filter(tokens(text), lambda t: (F.lower(t) != "rt") & ~t.startswith("@"))
    return F.array_join(kept, " ")


def retweeted_account(text: Column) -> Column:
    return empty_to_null(F.regexp_extract(text, K.RETWEETED_ACCOUNT, 1))


def retweet_token(text: Column, marker="RT", ignore_case=False) -> Column:
    """The second blank-separated token when the first is the marker."""
    parts = F.split(text, " ")
    first = F.get(parts, F.lit(0))
    if ignore_case:
        first, marker = F.lower(first), marker.lower()
    return F.when(first == marker, F.get(parts, F.lit(1)))


def norm_text(text: Column) -> Column:
    return F.lower(F.regexp_replace(text, r"[^\p{L}\p{N}\s]", ""))


def words(text: Column) -> Column:
    """Non-empty parts between white space."""
    return F.filter(F.split(text, r"\s+"), lambda w: w != "")


def loose_words(name: Column, stop_words=None) -> Column:
    """The name's main words, lower-cased, in order."""
    stop = K.PATTERN_STOP_WORDS if stop_words is None else stop_words
    parts = words(F.regexp_replace(F.lower(name), r"[^\p{L}\p{N}_\s]", " "))
    return F.filter(parts, lambda w: ~w.isin(list(stop)))


def loose_pattern(name: Column, stop_words=None) -> Column:
    """A regex that finds the name's main words with any blanks between them."""
    return F.concat(F.lit(r"\b"), F.array_join(loose_words(name, stop_words), r"\s*"), F.lit(r"\b"))


def sentences(text: Column) -> Column:
    return F.filter(F.split(text, r"[.!?]+\s+"), lambda s: s != "")


def split_triple(triple: Column) -> Column:
    """``name | award | role`` as a struct; null unless there are exactly three parts."""
    parts = F.split(triple, r" \| ")
    return F.when(
        F.size(parts) == 3,
        F.struct(
            F.get(parts, F.lit(0)).alias("name"),
            F.get(parts, F.lit(1)).alias("award"),
            F.get(parts, F.lit(2)).alias("role"),
        ),
    )


def make_triple(name: Column, award: Column, role: Column) -> Column:
    """The reverse; null if any part is missing."""
    return F.concat(name, F.lit(" | "), award, F.lit(" | "), role)


def comma_list(names: Column) -> Column:
    return F.array_join(names, ", ")


def chained_distinct(nested: Column) -> Column:
    """Distinct members of an array of arrays, sorted so that runs agree."""
    return F.array_sort(F.array_distinct(F.flatten(nested)))
