"""Tokenising and text formatting as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The common words that the normalised word count leaves out.
COMMON_WORDS = (
    "the", "be", "a", "an", "and", "of", "to", "in", "am", "is", "are", "at", "not", "that", "have", "i", "it",
    "for", "on", "with", "he", "she", "as", "you", "do", "this", "but", "his", "by", "from", "they", "we", "her",
    "or", "will", "my", "one", "all", "s", "if", "any", "our", "may", "your", "these", "d", " ", "me", "so", "what",
    "him",
)

# Fixed value: the characters between two words of a sentence. In the class, "(-)" is the range from "(" to ")",
# so a hyphen is part of a word; digits are not.
SENTENCE_DELIMITERS = r"""[\s~`!@#$%^&*(-)+=_:;'",.<>?/\\0-9\]\[\}\{]+"""

# Delimiters of title words when the caller names none.
DEFAULT_DELIMITERS = " \t,;.?!-:@[](){}_*/"


def delimiter_class(delimiters: str) -> str:
    """Regular expression for a run of any of the ``delimiters``; a line break always delimits."""
    escaped = "".join(c if c.isalnum() or c in " \t" else f"\\{c}" for c in delimiters)
    return f"[\n\r{escaped}]+"


def _without_empty(words: Column) -> Column:
    return F.filter(words, lambda word: word != "")


def tokenize_delimiters(text: Column, delimiters: str = DEFAULT_DELIMITERS) -> Column:
    """Array of the non-empty pieces of ``text`` between delimiter characters."""
    return _without_empty(F.split(text, delimiter_class(delimiters)))


def tokenize_sentence(text: Column, keep_empty: bool = False) -> Column:
    """Array of the words of a sentence.

    ``keep_empty`` keeps the one empty word that precedes a leading delimiter or stands for an empty line;
    trailing empty words are never kept.
    """
    words = F.split(text, SENTENCE_DELIMITERS)
    if not keep_empty:
        return _without_empty(words)
    ends_empty = (F.size(words) > 1) & (F.element_at(words, -1) == "")
    return F.when(ends_empty, F.slice(words, 1, F.size(words) - 1)).otherwise(words)


def normalize(word: Column) -> Column:
    """Trimmed lower-case form of a word."""
    return F.lower(F.trim(word))


def split_whitespace(text: Column) -> Column:
    """Fields of a line separated by runs of white space."""
    return F.split(F.trim(text), r"\s+")


def strip_character(text: Column, character: str = ":") -> Column:
    return F.replace(text, F.lit(character), F.lit(""))


def format_top_words(words: Column) -> Column:
    """``top-words = [ (word , count) , ... ]`` from an ordered array of (word, n) structs."""
    pairs = F.transform(words, lambda w: F.concat(F.lit("("), w["word"], F.lit(" , "), w["n"].cast("string"), F.lit(")")))
    return F.concat(F.lit("top-words = [ "), F.array_join(pairs, " , "), F.lit(" ]"))
