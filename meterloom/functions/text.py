"""Unicode-sensitive text expressions.

Everything is a Spark SQL expression except NFC composition, for which Spark has no
builtin; that one step is an Arrow UDF and only sees rows that might not be composed.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Unicode classes, spelled out because Java's \s and \w are ASCII only.
# Few terms per class: the regex engine tries every term of a class on every character.
# Whitespace other than the newline, as Python's str.isspace() defines it; \p{Z} holds the
# plain space and all separators beyond ASCII.
ODD_SPACE = r"\x09\x0b\x0c\x0d\x1c\x1d\x1e\x1f\x85"
INLINE_SPACE = ODD_SPACE + r"\p{Z}"
SPACE = r"\x0a" + INLINE_SPACE
# A letter in any script: categories L*, Nl and No, without combining marks.
LETTER = r"\p{L}\p{Nl}\p{No}"
# A word character: letters, numbers and the underscore.
WORD = r"\p{L}\p{N}_"
# Precomposed syllables, conjoining jamo, compatibility jamo.
HANGUL = r"\x{ac00}-\x{d7a3}\x{1100}-\x{11ff}\x{3130}-\x{318f}"

# Code points that NFC may change, or that may combine with what precedes them, lie in these
# ranges; so do many that stay as they are. Latin, dashes and quotes, Hangul syllables,
# Chinese characters, kana and full-width forms do not, so such a text is composed already
# and skips the Arrow hop. The coarse class has few ranges, because the regex engine tries
# each on every character; the fine one is asked only where the coarse one has found
# something. Written as what to find: negated classes of several ranges are slow to match.
NFC_SUSPECT = r"\x{300}-\x{200f}\x{2028}-\x{abff}\x{d7a4}-\x{10ffff}"
NFC_SUSPECT_FINE = (
    r"\x{300}-\x{200f}\x{2028}-\x{2fff}\x{302a}-\x{302f}\x{3099}\x{309a}"
    r"\x{a66f}-\x{abff}\x{d7a4}-\x{feff}\x{fff0}-\x{10ffff}"
)


AT_ONCE = 64  # texts that are Python strings at the same time


@F.arrow_udf(StringType())
def _compose(texts: pa.Array) -> pa.Array:
    if texts.null_count == len(texts):
        return texts
    parts = (texts.slice(at, AT_ONCE) for at in range(0, len(texts), AT_ONCE))
    return pa.concat_arrays([
        pa.array([t if t is None else unicodedata.normalize("NFC", t) for t in part.to_pylist()], texts.type)
        for part in parts
    ])


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is mentioned."""
    return F.get(F.transform(F.array(value), use), 0)


def nfc(text: Column) -> Column:
    """Canonical composition. Rows that cannot change cross to Python as null."""
    found = F.when(text.rlike(f"[{NFC_SUSPECT}]"), text.rlike(f"[{NFC_SUSPECT_FINE}]"))
    suspect = F.when(found, text)
    return F.coalesce(_compose(suspect), text)


# What tidying would change: any space but the plain one (beyond Latin all of them lie in one
# range), and the runs it shortens. Plain searches are far cheaper than a class of them.
_UNTIDY = (
    *(chr(c) for c in (0x09, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x85, 0xA0)),
    "  ", "\n\n\n", " \n", "\n ",
)
_SPACES_BEYOND_LATIN = r"[\x{1680}-\x{3000}]"


def tidy_layout(text: Column) -> Column:
    """T1 without composition: newlines, whitespace runs, blank-line runs, line strips.

    A text in which nothing but its ends can change is only stripped. Patterns match only
    where something changes, not at every plain space; once runs are single spaces,
    stripping lines is plain replacement.
    """
    untidy = text.rlike(_SPACES_BEYOND_LATIN)
    for mark in _UNTIDY:
        untidy = text.contains(mark) | untidy
    even = F.replace(text, F.lit("\r\n"), F.lit("\n"))
    even = F.replace(even, F.lit("\r"), F.lit("\n"))
    even = F.regexp_replace(
        even, f"(?: [{INLINE_SPACE}]|[{INLINE_SPACE}&&[^ ]])[{INLINE_SPACE}]*", " "
    )
    even = F.regexp_replace(even, r"\n{3,}", "\n\n")
    even = F.replace(even, F.lit(" \n"), F.lit("\n"))
    even = F.replace(even, F.lit("\n "), F.lit("\n"))
    return F.btrim(F.when(untidy, even).otherwise(text), F.lit(" \n"))


def normalize_text(text: Column) -> Column:
    """T1. Apply once: a second pass can shorten blank-line runs further."""
    return tidy_layout(nfc(F.coalesce(text, F.lit(""))))


def length_chars(text: Column) -> Column:
    """T5: length in Unicode code points."""
    return F.length(text)


def letters_of(text: Column) -> Column:
    return F.regexp_replace(text, f"[^{LETTER}]+", "")


def count_in_class(letters: Column, script: str) -> Column:
    return F.length(letters) - F.length(F.regexp_replace(letters, f"[{script}]+", ""))


def script_ratio(text: Column, script: str = HANGUL) -> Column:
    """Share of the letters that belong to ``script``; 0.0 without letters."""
    return once(
        letters_of(F.coalesce(text, F.lit(""))),
        lambda letters: ratio_or_zero(count_in_class(letters, script), F.length(letters)),
    )


def ratio_or_zero(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def canonical_form(composed: Column) -> Column:
    """Lower-cased word characters of an NFC text.

    Whitespace is not a word character, so layout tidying would not change the result.
    """
    return F.regexp_replace(F.lower(composed), f"[^{WORD}]+", "")


def dedup_key(text: Column) -> Column:
    """SHA-1 of the canonical form."""
    return F.sha1(canonical_form(nfc(F.coalesce(text, F.lit("")))))


def tokens(text: Column) -> Column:
    """Whitespace-separated tokens, without empty ones."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), f"[{SPACE}]+"), "")


def repetition_ratio(text: Column) -> Column:
    """T4: share of the most frequent token; 0.0 under four tokens."""

    def ratio(ordered: Column) -> Column:
        # One pass over the sorted tokens, with the current run and the longest run.
        longest = F.aggregate(
            ordered,
            F.struct(
                F.lit(None).cast("string").alias("token"),
                F.lit(0).alias("run"),
                F.lit(0).alias("best"),
            ),
            lambda acc, token: once(
                F.when(acc["token"] == token, acc["run"] + 1).otherwise(F.lit(1)),
                lambda run: F.struct(
                    token.alias("token"),
                    run.alias("run"),
                    F.greatest(acc["best"], run).alias("best"),
                ),
            ),
            lambda acc: acc["best"],
        )
        n = F.size(ordered)
        return F.when(n >= 4, longest / n).otherwise(F.lit(0.0))

    return once(F.sort_array(tokens(text)), ratio)


def is_dominated(words: Column, max_ratio: float = 0.5) -> Column:
    """Whether one token of ``words`` exceeds ``max_ratio``, a half or more of the list.

    A token above half of the list outlives a count that rises with each copy of the token
    it holds and falls with each other token, so only that token has to be counted.
    """
    if max_ratio < 0.5:
        raise ValueError("a token below half of the list need not outlive the others")

    def vote(held: Column, word: Column) -> Column:
        return (
            F.when(held["n"] == 0, F.struct(word.alias("word"), F.lit(1).alias("n")))
            .when(held["word"] == word, F.struct(held["word"].alias("word"), (held["n"] + 1).alias("n")))
            .otherwise(F.struct(held["word"].alias("word"), (held["n"] - 1).alias("n")))
        )

    nobody = F.struct(F.lit("").alias("word"), F.lit(0).alias("n"))

    def exceeds(words: Column) -> Column:
        def counted(left: Column) -> Column:
            count = F.size(words) - F.size(F.array_remove(words, left["word"]))
            # A token with over half of the votes is still held at the end.
            return F.when(left["n"] > 0, count > F.lit(max_ratio) * F.size(words)).otherwise(F.lit(False))

        return F.when(F.size(words) >= 4, once(F.aggregate(words, nobody, vote), counted)).otherwise(
            F.lit(False)
        )

    return once(words, exceeds)


def is_repetitive(text: Column, max_ratio: float = 0.5) -> Column:
    """T4 compared with a limit."""
    if max_ratio < 0.5:
        return repetition_ratio(text) > F.lit(max_ratio)
    return once(tokens(text), lambda words: is_dominated(words, max_ratio))


def strip(text: Column) -> Column:
    """Python's str.strip(): Unicode whitespace off both ends."""
    return F.regexp_replace(text, rf"\A[{SPACE}]+|[{SPACE}]+\z", "")


def is_blank(text: Column) -> Column:
    """True for null and for whitespace-only text."""
    return F.coalesce(~text.rlike(f"[^{SPACE}]"), F.lit(True))


def first_filled(*candidates: Column) -> Column:
    """T6 over string columns: the first one that is not blank."""
    return F.coalesce(*[F.when(~is_blank(c), c) for c in candidates])
