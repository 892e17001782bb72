"""Edge rules of the text functions against plain Python."""

import string

import pytest
from pyspark.sql import functions as F

from docloom.functions import text as tx
from docloom.plans import sql


def breaks(content, length):
    out, chars = [], 0
    for word in content.split(" "):
        chars += len(word)
        out.append(("<br>" if chars > length else " ") + word)
        chars = 0 if chars > length else chars
    return "".join(out)


TEXTS = ["", " ", "a  b", "x" * 50, "aaaa " * 30, "ab cd ef gh", "ééé über " * 9, "a\nb c"]


@pytest.mark.parametrize("length", [3, 8, 40])
def test_get_breaks(one, length):
    assert one(lambda c: tx.get_breaks(c, length), TEXTS) == [breaks(t, length) for t in TEXTS]


def test_get_breaks_null_and_exact_limit(one):
    assert one(lambda c: tx.get_breaks(c, 4), [None, "ab cd", "ab cd e"]) == [None, " ab cd", " ab cd<br>e"]


def test_abstract_summary(one):
    hundred, more = " ".join(["w"] * 100), " ".join(["w"] * 101)
    assert one(tx.abstract_summary, ["", "a b", hundred, more]) == [
        "Not provided.", " a b", breaks(hundred, 40), breaks(hundred, 40) + "...",
    ]


def test_format_authors_and_title(one):
    long = "Ann Example; Bob Example; Cyd Example"
    assert one(tx.format_authors, [None, "A", "A;B", long]) == [
        None, "A", "A. B", breaks(". ".join(long.split(";")), 40),
    ]
    assert one(tx.format_title, [None, "t"]) == [None, " t"]


def test_word_counts(one):
    values = ["", "  ", " a b\t a\n", "A a"]
    assert one(tx.word_count, values) == [len(v.split()) for v in values]
    assert one(tx.unique_words, values) == [len(set(v.split())) for v in values]


def test_first_words(one):
    assert one(lambda c: tx.first_words(c, 2), ["a b c", "a", "", "a  b"]) == ["a b", "a", "", "a "]


def test_clean_text(one):
    values = ["RT Hello", "rt rt x", "see https://a.b/c?d=1 now HTTP://x.y z", "café 12 don't", "a_b-c", "A\tB\nÇ"]
    assert one(tx.clean_text, values) == ["hello", "rt x", "see  now  z", "caf 12 dont", "abc", "a\tb\n"]


def test_tokenize_keeps_inner_and_leading_blanks(one):
    values = ["a  b c ", " a", "", "   ", "A\tB\n", "a\x0bb\x0c\r", None]
    assert one(tx.tokenize, values) == [["a", "", "b", "c"], ["", "a"], [""], [], ["a", "b"], ["a", "b"], None]


def test_stop_words(one):
    assert tx.stop_words(["The", "a"], ["DOI"]) [:3] == ["the", "a", "doi"]
    assert tx.stop_words([], [], letters=False) == []
    kept = one(lambda c: tx.remove_stop_words(c, ["The"]), [["the", "THE", "cat", ""]], "array<string>")
    assert kept == [["cat", ""]]


def test_english_stop_words_are_those_of_spark(spark):
    assert sql.ENGLISH_STOP_WORDS == tx.default_stop_words()


def test_number_blank_and_punctuation_filters(one):
    values = [["12", "", "a1", "٣", "007"]]
    assert one(tx.drop_numeric, values, "array<string>") == [["", "a1", "٣"]]
    assert one(tx.drop_empty, [["", "a", None]], "array<string>") == [["a"]]
    tokens = ["", "!", "()", ")(", "a", "a!", "./"]
    kept = one(tx.drop_punctuation, [tokens], "array<string>")
    assert kept == [[t for t in tokens if t not in string.punctuation]]
    assert tx.PUNCTUATION == string.punctuation


def test_flatten_sections(one):
    kind = "array<struct<text:string,section:string>>"
    assert one(tx.flatten_sections, [[], [("a", "s"), ("b", "t")]], kind) == ["", "a\nb"]


def test_char_ngrams(one):
    def grams(word):
        p = f" {word} "
        return [g for n in (1, 2, 3) for g in (p[i:i + n] for i in range(len(p) - n + 1)) if g != " "]

    values = ["", "é", "abc", "naïve", "a😀b", "😀"]
    assert one(lambda c: tx.char_ngrams(c, 1, 3), values) == [grams(v) for v in values]


def test_format_weights(one):
    assert one(tx.format_weights, [[0.12346, 2.0]], "array<double>") == [["0.1235", "2.0000"]]


def test_text_functions_need_no_python_worker(spark):
    from docloom.plans.pipeline import token_table

    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = token_table(df, "text", ["a"]).select("vector_no_stopw", tx.get_breaks(F.col("text"), 3))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
