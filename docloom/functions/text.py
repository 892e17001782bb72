"""Text functions, Column to Column. Everything stays in the JVM: no Python UDF."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.ml.feature import StopWordsRemover
from pyspark.sql import Column
from pyspark.sql import functions as F

# The custom stop words that extend a base list, lower-cased because
# they are compared with lower-cased tokens.
CUSTOM_STOP_WORDS = [
    "doi", "preprint", "copyright", "peer", "reviewed", "org", "https", "et", "al", "author",
    "figure", "rights", "reserved", "permission", "used", "using", "biorxiv", "medrxiv",
    "license", "fig", "fig.", "al.", "elsevier", "pmc", "czi", "www",
]

# The 32 ASCII punctuation characters in code order.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

# Java's \s. Spelled out, like the class below: a listed ASCII class is one table lookup
# per character, while ranges and escapes inside a negation are several calls.
_BLANKS = r" \t\n\x0B\f\r"
_NOT_KEPT = f"[^abcdefghijklmnopqrstuvwxyz0123456789{_BLANKS}]"

# Whitespace runs as str.split() sees them; the class is understood by Java and RE2 alike.
WHITESPACE_RUN = r"[\s\p{Z}]+"


def let(value: Column, body) -> Column:
    """Bind ``value`` once and return ``body`` of the bound name.

    A column used inside a lambda is evaluated again for every element; a bound one is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def flatten_sections(sections: Column) -> Column:
    """Join the ``text`` of every section with newlines; no section gives ''."""
    return F.array_join(F.transform(sections, lambda s: s["text"]), "\n")


def space_words(text: Column) -> Column:
    """Split on every single space, keeping empty strings."""
    return F.split(text, " ", -1)


def first_words(text: Column, n: int) -> Column:
    """The first ``n`` space-separated words, joined by spaces again."""
    return F.array_join(F.slice(space_words(text), 1, n), " ")


def get_breaks(text: Column, length: int) -> Column:
    """Insert ``<br>`` before the word whose arrival lifts the running count over ``length``.

    Spaces are not counted and the count restarts at zero after each break. Finished
    lines go to an array so that the string being grown stays one line long and the
    fold is linear in the text instead of copying the whole prefix at every word.
    """
    start = F.struct(
        F.array().cast("array<string>").alias("done"),
        F.lit("").alias("line"),
        F.lit(0).alias("chars"),
    )

    def step(acc: Column, word: Column) -> Column:
        total = acc["chars"] + F.char_length(word)
        over = total > F.lit(length)
        return F.struct(
            F.when(over, F.concat(acc["done"], F.array(acc["line"])))
            .otherwise(acc["done"]).alias("done"),
            F.when(over, F.concat(F.lit("<br>"), word))
            .otherwise(F.concat(acc["line"], F.lit(" "), word)).alias("line"),
            F.when(over, F.lit(0)).otherwise(total).alias("chars"),
        )

    def finish(acc: Column) -> Column:
        return F.concat(F.array_join(acc["done"], ""), acc["line"])

    return F.when(text.isNotNull(), F.aggregate(space_words(text), start, step, finish))


def abstract_summary(abstract: Column, words: int = 100, length: int = 40) -> Column:
    """Short display form of an abstract: broken lines, at most ``words`` words."""
    return (
        F.when(abstract == "", F.lit("Not provided."))
        .when(
            F.size(space_words(abstract)) > words,
            F.concat(get_breaks(first_words(abstract, words), length), F.lit("...")),
        )
        .otherwise(get_breaks(abstract, length))
    )


def format_authors(authors: Column, length: int = 40) -> Column:
    """``a;b;c`` to ``a. b. c``; three or more authors also get line breaks; null stays null."""
    names = F.split(authors, ";", -1)
    joined = F.array_join(names, ". ")
    return F.when(F.size(names) > 2, get_breaks(joined, length)).otherwise(joined)


def format_title(title: Column, length: int = 40) -> Column:
    """Title with line breaks; null stays null."""
    return get_breaks(title, length)


def _words(text: Column) -> Column:
    return F.filter(F.split(text, WHITESPACE_RUN, -1), lambda w: w != "")


def word_count(text: Column) -> Column:
    """Number of whitespace-separated words; blank text has none."""
    return F.size(_words(text))


def unique_words(text: Column) -> Column:
    """Number of different words, case kept."""
    return F.size(F.array_distinct(_words(text)))


def clean_text(text: Column) -> Column:
    """Lower-case, drop a leading ``rt ``, URLs, then all but ASCII letters, digits, whitespace."""
    lowered = F.lower(text)
    no_rt = F.regexp_replace(lowered, r"^rt ", "")
    no_url = F.regexp_replace(no_rt, r"https?://\S+", "")
    return F.regexp_replace(no_url, _NOT_KEPT, "")


def tokenize(text: Column) -> Column:
    """Lower-case and split at every single whitespace character.

    Leading and inner empty tokens stay, trailing ones go. The empty text is one empty
    token; text of nothing but whitespace has no token.
    """

    def split(lowered: Column) -> Column:
        return let(
            F.regexp_replace(lowered, f"[{_BLANKS}]+$", ""),
            lambda stripped: F.when(
                (stripped == "") & (lowered != ""), F.array().cast("array<string>")
            ).otherwise(F.split(stripped, f"[{_BLANKS}]", -1)),
        )

    return let(F.lower(text), split)


def default_stop_words() -> list[str]:
    """Spark's English stop words (needs an active session)."""
    return StopWordsRemover.loadDefaultStopWords("english")


def stop_words(
    base: Iterable[str], extra: Iterable[str] = CUSTOM_STOP_WORDS, letters: bool = True
) -> list[str]:
    """Union of base list, extra words and (by default) the letters a to z, order kept."""
    alphabet = [chr(c) for c in range(ord("a"), ord("z") + 1)] if letters else []
    return list(dict.fromkeys([w.lower() for w in [*base, *extra, *alphabet]]))


def remove_stop_words(tokens: Column, words: Sequence[str]) -> Column:
    """Drop stop words, case ignored. The word list is a hash set in the plan (InSet)."""
    wanted = [w.lower() for w in words]
    return F.filter(tokens, lambda t: ~F.lower(t).isin(wanted))


def drop_numeric(tokens: Column) -> Column:
    """Drop all-digit tokens; the empty token stays."""
    return F.filter(tokens, lambda t: ~t.rlike("^[0-9]+$"))


def drop_empty(tokens: Column) -> Column:
    """Drop empty and null tokens."""
    return F.filter(tokens, lambda t: t != "")


def drop_punctuation(tokens: Column) -> Column:
    """Drop tokens that are a substring of the punctuation string; '' is one of them."""
    return F.filter(tokens, lambda t: ~F.lit(PUNCTUATION).contains(t))


def word_runs(text: Column, at_least: int = 2) -> Column:
    """Lower-cased runs of at least ``at_least`` word characters, in order."""
    return F.regexp_extract_all(
        F.lower(text), F.lit(r"[\p{L}\p{N}_]{%d,}" % at_least), F.lit(0)
    )


def char_ngrams(word: Column, low: int, high: int) -> Column:
    """All character n-grams of `` word `` (padded with a space), except the bare space.

    A look-ahead finds overlapping n-grams in one native scan. It steps by UTF-16 units, so
    words with characters beyond the basic plane are cut from their list of characters.
    """
    padded = F.concat(F.lit(" "), word, F.lit(" "))

    def scan(n: int) -> Column:
        if n == 1:
            return F.regexp_extract_all(padded, F.lit("[^ ]"), F.lit(0))
        return F.regexp_extract_all(padded, F.lit("(?s)(?=(.{%d}))" % n), F.lit(1))

    def cut(chars: Column, n: int) -> Column:
        last = F.size(chars) - (n - 1)
        return F.when(
            last >= 1,
            F.transform(F.sequence(F.lit(1), last), lambda i: F.array_join(F.slice(chars, i, n), "")),
        ).otherwise(F.array().cast("array<string>"))

    sizes = range(low, high + 1)
    listed = let(
        F.filter(F.split(padded, "", -1), lambda c: c != ""),
        lambda chars: F.filter(F.concat(*[cut(chars, n) for n in sizes]), lambda g: g != " "),
    )
    return F.when(word.rlike(r"[\x{10000}-\x{10FFFF}]"), listed).otherwise(
        F.concat(*[scan(n) for n in sizes])
    )


def format_weights(weights: Column) -> Column:
    """Each number with four decimals."""
    return F.transform(weights, lambda w: F.format_string("%1.4f", w))
