"""Text normalisation as Column expressions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from armazem.vocabulary import ACCENTED, LOWERCASE_PARTICLES, UNACCENTED

# A word is a run of letters and digits; everything else separates words and is kept.
_WORD_OR_GAP = r"([\p{L}\p{N}]+|[^\p{L}\p{N}]+)"
_TO_END = 2147483647


def blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def code(c: Column) -> Column:
    """Canonical form of a code column such as status or payment type."""
    return F.lower(F.trim(c))


def state_code(c: Column) -> Column:
    return F.upper(F.trim(c))


def zip_prefix(c: Column) -> Column:
    return F.lpad(F.trim(c.cast("string")), 5, "0")


def capitalize_words(c: Column) -> Column:
    """Capitalise every word, where apostrophes, hyphens and the like also end a word.

    The built-in ``initcap`` only breaks at blanks ("D'oeste"), so the text is cut into
    words and gaps first. A letter whose capital is not a single letter ("ß") stays.
    """

    def capitalize(piece: Column) -> Column:
        capital = F.upper(F.substring(piece, 1, 1))
        raised = F.concat(capital, F.substring(piece, 2, _TO_END))
        return F.when(F.length(capital) == 1, raised).otherwise(piece)

    pieces = F.regexp_extract_all(F.lower(c), F.lit(_WORD_OR_GAP), F.lit(1))
    return F.array_join(F.transform(pieces, capitalize), "")


def normalize_label(c: Column) -> Column:
    """City or category label: no accents, single blanks, capitalised, particles in lower case."""
    plain = F.translate(F.lower(F.trim(c)), ACCENTED, UNACCENTED)
    titled = capitalize_words(F.regexp_replace(plain, r"\s+", " "))
    lowered = reduce(
        lambda text, word: F.replace(text, F.lit(f" {word} "), F.lit(f" {word.lower()} ")),
        LOWERCASE_PARTICLES,
        titled,
    )
    return F.nullif(lowered, F.lit(""))


def category_label(c: Column) -> Column:
    return normalize_label(F.replace(c, F.lit("_"), F.lit(" ")))
