import pytest
from pyspark.sql import functions as F

from lexweave.functions import text as T


@pytest.mark.parametrize("word,n", [("rope", 1), ("table", 2), ("the", 1), ("appeared", 2), ("wishes", 2), ("tables", 2), ("wanted", 2), ("2026", 4)])
def test_syllables(spark, word, n):
    assert spark.range(1).select(T.syllable_count(f"'{word}'")).first()[0] == n


@pytest.mark.parametrize("text,words,sentences", [("", 0, 0), ("No stop here", 3, 1), ("One. Two! — Three?", 3, 3), ("...", 0, 0), ("don't café", 2, 1)])
def test_counts(spark, text, words, sentences):
    df = spark.createDataFrame([(text,)], "t string")
    assert tuple(df.select(T.word_count("t"), T.sentence_count("t")).first()) == (words, sentences)


def test_null_text(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert tuple(df.select(T.word_count("t"), T.sentence_count("t"), T.folded("t")).first()) == (0, 0, "")


def test_forms_and_lemmas(spark):
    df = spark.createDataFrame([("stop",), ("city",), ("make",)], "w string")
    assert [r[0] for r in df.select(T.forms("w")).collect()] == [["stops", "stopped", "stopping"], ["cities", "citied", "citying"], ["makes", "maked", "making"]]
    back = spark.createDataFrame([("running",), ("cities",), ("happiest",)], "w string").select(T.lemma_candidates("w")).collect()
    assert "run" in back[0][0] and "city" in back[1][0] and "happy" in back[2][0]


def test_markdown(spark):
    df = spark.createDataFrame([("# Head\n- **people** and *more* `code` grade_1",)], "t string")
    assert df.select(T.strip_markdown("t")).first()[0] == "Head\npeople and more code grade_1"


def test_grade_of_nothing(spark):
    zero = F.lit(0)
    assert spark.range(1).select(T.fk_grade(zero, zero, zero)).first()[0] == 0.0
