"""Tokens, bags of terms and prompt sizes as column expressions."""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# A word character is a letter, a number or an underscore of any script. The
# engine's own \w is ASCII only and would split accented words.
WORD = r"[\p{L}\p{N}_]++"
TERM = r"[\p{L}\p{N}_]{2,}+"

# The white space of Unicode text, of which the engine's own \\s knows only the
# ASCII part.
SPACES = r"\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

# The English stop words of Spark's StopWordsRemover.
ENGLISH_STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
"""

# Signature of a text without terms: the hash of nothing.
NO_TERMS = hashlib.md5(b"").hexdigest()

PASSTHROUGH_WORDS = 50
CHARS_PER_TOKEN = 4


def default_stop_words() -> list[str]:
    """The default stop list; callers may pass any other."""
    return ENGLISH_STOP_WORDS.split()


def tokens(text: Column) -> Column:
    """Lower-cased words of one or more word characters; null text has none."""
    return _found(text, WORD)


def terms(text: Column) -> Column:
    """Lower-cased words of two or more word characters, stop words included."""
    return _found(text, TERM)


def _found(text: Column, pattern: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(pattern), F.lit(0))


def bag_of(text: Column, stop_words: Sequence[str]) -> Column:
    """The sorted terms of a text, repeated ones included, without stop words."""
    bag = terms(text)
    if stop_words:
        bag = F.filter(bag, lambda w: ~w.isin(list(stop_words)))
    return F.sort_array(bag)


def bag_signature(bag: Column) -> Column:
    """Hash of a bag. Terms hold no spaces, so the joined sorted terms identify it."""
    return F.md5(F.concat_ws(" ", bag))


def ngrams(words: Column, n: int) -> Column:
    """Space-joined n-grams; words hold no spaces, so the joined text identifies the gram."""
    size = F.size(words)
    return F.when(
        size >= n,
        F.transform(
            F.sequence(F.lit(0), F.greatest(size - n, F.lit(0))),
            lambda p: F.concat_ws(" ", *[F.get(words, p + k) for k in range(n)]),
        ),
    ).otherwise(F.array().cast("array<string>"))


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(f"[^{SPACES}]+")).cast("bigint")


def approx_tokens(text: Column) -> Column:
    """The larger of the word count and a quarter of the characters."""
    chars = F.char_length(F.coalesce(text, F.lit(""))).cast("bigint")
    return F.greatest(word_count(text), F.floor(chars / CHARS_PER_TOKEN).cast("bigint"))


def is_blank(text: Column) -> Column:
    """Null, empty or white space only."""
    return ~F.coalesce(text, F.lit("")).rlike(f"[^{SPACES}]")


def is_filled(value: Column, data_type: str) -> Column:
    """Not null, and not an empty string, array or map. Blanks and zeros are filled."""
    if data_type == "string":
        return value.isNotNull() & (value != "")
    if data_type.startswith(("array", "map")):
        return value.isNotNull() & (F.size(value) > 0)
    return value.isNotNull()
