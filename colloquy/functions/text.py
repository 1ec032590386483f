"""Row-local text columns: words, n-grams, word counts, letter counts."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from colloquy import fixed
from colloquy.functions.picks import constant


def text_or_empty(text) -> Column:
    """Missing text is the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def strip(text: Column) -> Column:
    """Remove white space at both ends."""
    return F.btrim(text, F.lit(fixed.SPACE_CHARS))


def words(text: Column) -> Column:
    """White-space separated words; no empty words."""
    parts = F.split(text, f"[{fixed.SPACE_CLASS}]+")
    return F.filter(parts, lambda w: w != "")


def lower_words(text: Column) -> Column:
    return words(F.lower(text))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times.  Spark re-evaluates an outer
    expression for every element when a lambda mentions it; a lambda variable it
    does not."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(value: Column) -> Column:
    """For a select list: compute ``value`` as its own step, so that merged
    projections above do not repeat it."""
    return F.explode_outer(F.array(value))


def _grams_of(t: Column, n: int) -> Column:
    last = F.size(t) - (n - 1)
    starts = F.when(last > 0, F.sequence(F.lit(0), last - 1)).otherwise(
        F.array().cast("array<int>")
    )
    return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(t, i + k) for k in range(n)]))


def grams(tokens: Column, n: int) -> Column:
    """All n-grams of a token array, with repeats, joined by one space."""
    return tokens if n == 1 else let(tokens, lambda t: _grams_of(t, n))


def shingles(text: Column, n: int = fixed.DEDUP_NGRAM) -> Column:
    """The set of word n-grams; a text of fewer words stands for itself."""
    whole = strip(F.lower(text))
    return let(
        words(whole),
        lambda t: F.when(F.size(t) < n, F.array(whole)).otherwise(
            F.array_distinct(t if n == 1 else _grams_of(t, n))
        ),
    )


def gram_hashes(whole: Column, tokens: Column, n: int, seed: int) -> Column:
    """The set of n-grams of a text and its words as 64-bit hashes, without building their strings."""
    one = lambda t, i: F.xxhash64(F.lit(seed), *[F.get(t, i + k) for k in range(n)])
    return let(
        tokens,
        lambda t: F.when(F.size(t) < n, F.array(F.xxhash64(F.lit(seed), whole))).otherwise(
            F.array_distinct(
                F.transform(F.sequence(F.lit(0), F.size(t) - n), lambda i: one(t, i))
            )
        ),
    )


def shingle_hashes(text: Column, n: int, seed: int) -> Column:
    """The shingles as 64-bit hashes."""
    whole = strip(F.lower(text))
    return gram_hashes(whole, words(whole), n, seed)


def jaccard(left: Column, right: Column) -> Column:
    """Shared over all elements of two sets; zero when either is empty."""
    sizes = F.size(left) + F.size(right)
    return let(
        F.size(F.array_intersect(left, right)),
        lambda shared: F.when(shared == 0, F.lit(0.0)).otherwise(
            shared.cast("double") / (sizes - shared)
        ),
    )


def has_frequent_word(tokens: Column, too_many) -> Column:
    """Whether some word's count, as a share of all words, satisfies ``too_many``, a
    rule that once true stays true for larger counts.  In the sorted words a word
    that occurs ``k`` times equals the one ``k - 1`` places on."""

    def search(s):
        n = F.size(s)
        share = lambda c: c.cast("double") / n
        guess, fits = too_many
        low = F.floor(n * F.lit(guess)).cast("int")
        least = F.when(fits(share(low)), low).when(fits(share(low + 1)), low + 1).otherwise(low + 2)
        return let(
            least,
            lambda k: F.exists(
                F.sequence(F.lit(0), n - k), lambda i: F.get(s, i) == F.get(s, i + k - 1)
            ),
        )

    return let(F.sort_array(tokens), search)


def letters(text: Column) -> Column:
    return F.regexp_replace(text, r"[^\p{L}]+", "")


def ascii_letter_count(text: Column) -> Column:
    return F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))


def any_inside(text: Column, phrases) -> Column:
    """Whether any of the phrases occurs in the text."""
    return F.exists(constant(list(phrases), "array<string>"), lambda p: F.contains(text, p))


def grams_up_to(tokens: Column, n: Column) -> Column:
    """N-grams for an ``n`` that is a column; see ``grams``."""
    last = F.size(tokens) - n
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(tokens, i + 1, n), " "))
