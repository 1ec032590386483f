"""Quality rules and the score of a conversation pair as columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions import text as X


def bad_length(text: Column) -> Column:
    n = F.length(text)
    return (n < fixed.MIN_CHARS) | (n > fixed.MAX_CHARS)


def repetitive(text: Column, limit: float = fixed.REPETITION_LIMIT) -> Column:
    return X.let(
        X.lower_words(text),
        lambda t: F.when(F.size(t) < fixed.REPETITION_MIN_WORDS, F.lit(False)).otherwise(
            X.has_frequent_word(t, (limit, lambda share: share > limit))
        ),
    )


def looks_english(text: Column) -> Column:
    def share_is_high(letters):
        n = F.length(letters)
        ascii_share = X.ascii_letter_count(letters).cast("double") / F.nullif(n, F.lit(0))
        return F.when(n == 0, F.lit(True)).otherwise(ascii_share > fixed.ASCII_LETTER_SHARE)

    return F.when(text == "", F.lit(False)).otherwise(X.let(X.letters(text), share_is_high))


def has_placeholder(text: Column) -> Column:
    return text.contains(fixed.PLACEHOLDER)


def _penalty(rule: Column, points: float) -> Column:
    return F.when(rule, F.lit(points)).otherwise(F.lit(0.0))


def _after_lengths(u: Column, a: Column) -> Column:
    points = fixed.LENGTH_PENALTY
    return F.lit(1.0) - _penalty(bad_length(u), points) - _penalty(bad_length(a), points)


def quality_score(user="user", assistant="assistant") -> Column:
    """One minus the penalties, subtracted in a set order, never below zero."""
    u, a = X.text_or_empty(user), X.text_or_empty(assistant)
    score = (
        _after_lengths(u, a)
        - _penalty(repetitive(u) | repetitive(a), fixed.REPETITION_PENALTY)
        - _penalty(~looks_english(u) | ~looks_english(a), fixed.LANGUAGE_PENALTY)
        - _penalty(has_placeholder(u) | has_placeholder(a), fixed.PLACEHOLDER_PENALTY)
    )
    return F.greatest(F.lit(0.0), score)


def reaches(least: float, user="user", assistant="assistant") -> Column:
    """Whether the score is at least so high.  Words and letters are only looked at where the lengths, the first
    penalties, leave that open."""
    most = F.greatest(F.lit(0.0), _after_lengths(X.text_or_empty(user), X.text_or_empty(assistant)))
    least = F.lit(float(least))
    return F.when(most >= least, quality_score(user, assistant) >= least).otherwise(F.lit(False))
