from pyspark.sql import functions as F

from skytally.functions.text import COMMON_WORDS, tokenize_delimiters, tokenize_sentence
from skytally.operators import words
from tests.conftest import rows


def tokens(lines, expression, *values):
    return [r[0] for r in lines(*values).select(expression).collect()]


def test_delimiters(lines):
    split = lambda *values: tokens(lines, tokenize_delimiters(F.col("value"), " ,-[]^\\_"), *values)
    assert split("a,b--c [d]^e\\f_g", " ,- ", "", "one\ntwo\r\n three") == [
        ["a", "b", "c", "d", "e", "f", "g"], [], [], ["one", "two", "three"]]


def test_sentences(lines):
    split = lambda *values: tokens(lines, tokenize_sentence(F.col("value")), *values)
    assert split("The well-known cow's 3 moons!", "42 !", "", "a|b (c) d4e") == [
        ["The", "well-known", "cow", "s", "moons"], [], [], ["a|b", "c", "d", "e"]]
    kept = tokens(lines, tokenize_sentence(F.col("value"), keep_empty=True), "!a b!", "", "a")
    assert kept == [["", "a", "b"], [""], ["a"]]


def test_count_without_stop_words(spark, lines, monkeypatch):
    titles = lines("The cow, the MOON", "A cow; a hen", None)
    stops = spark.createDataFrame([("the",), ("a",), ("Cow",), (" hen",)], "word STRING")  # the list counts as it stands
    expected = [("cow", 2), ("hen", 1), ("moon", 1)]
    counted = lambda: rows(words.count_without(words.title_words(titles, " ,;"), stops))
    assert counted() == expected
    inner = words.count_without(words.title_words(lines("Cow, cow,a , the moon"), ","), stops)
    assert rows(inner) == [(" cow", 1), (" the moon", 1), ("cow", 1)]
    monkeypatch.setattr("skytally.operators.words.fits_broadcast", lambda df: False)
    assert counted() == expected


def test_normalized_words(lines):
    assert len(COMMON_WORDS) == len(set(COMMON_WORDS)) == 51
    spoken = words.sentence_words(lines("The Cow AND his moon", "cow"))
    assert rows(words.word_count(words.normalized_words(spoken))) == [("cow", 2), ("moon", 1)]
    assert rows(words.word_count(spoken)) == [("AND", 1), ("Cow", 1), ("The", 1), ("cow", 1), ("his", 1), ("moon", 1)]


def test_top_words_and_statistics(spark):
    counts = spark.createDataFrame([("a", 4), ("b", 7), ("c", 7), ("d", 1)], "word STRING, n BIGINT")
    top = words.top_words(counts, 3)
    assert rows(top, "kept") == [("c", 7), ("b", 7), ("a", 4)]
    # mean 18 / 3 = 6, variance (1 + 1 + 4) / 3 = 2
    assert dict(rows(words.count_statistics(top))) == {"Mean": 6, "Sum": 18, "Min": 4, "Max": 7, "Var": 2}
    two = words.top_words(counts, 4)
    # mean 19 / 4 -> 4; variance around 4: (0 + 9 + 9 + 9) / 4 -> 6; exactly 4.75 and 6.1875
    assert dict(rows(words.count_statistics(two))) == {"Mean": 4, "Sum": 19, "Min": 1, "Max": 7, "Var": 6}
    assert dict(rows(words.count_statistics(two, exact=True))) == {
        "Mean": 4.75, "Sum": 19.0, "Min": 1.0, "Max": 7.0, "Var": 6.1875}


def test_report(spark):
    counts = spark.createDataFrame([("b", 7), ("a", 7), ("c", 9), ("d", 1)], "word STRING, n BIGINT")
    assert rows(words.top_words_report(counts, 3)) == [("top-words = [ (c , 9) , (a , 7) , (b , 7) ]",)]


def test_statistics_of_large_counts(spark):
    top = spark.createDataFrame([("a", 4_000_000_000), ("b", 0)], "word string, n long")
    found = dict(rows(words.count_statistics(top)))
    assert (found["Mean"], found["Var"]) == (2_000_000_000, 4 * 10**18)
