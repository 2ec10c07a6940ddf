"""Line-first quality rules against SQL and on small cases."""

import random

import pytest

from compare import assert_same, duck
from soleprint.llm import quality
from soleprint.llm.catalog import QUERIES
from soleprint.llm.oracles import ORACLES

RANDOM = random.Random(1)


def sentence() -> str:
    return " ".join(f"word{RANDOM.randrange(10**6)}" for _ in range(12)) + "."


SENTENCES = "\n".join(sentence() for _ in range(8))


def judge(spark, *texts, **options):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: r for r in quality.line_quality(rows, **options).collect()}


def test_equals_sql(spark, sf_dir):
    sql = duck(sf_dir).execute(ORACLES["op10_line_quality"]).df()
    assert len(sql) > 0
    assert_same(QUERIES["op10_line_quality"](spark, sf_dir).toPandas(), sql)


def test_null_empty_and_blank(spark):
    got = judge(spark, None, "", " \n\t\n")
    for row in got.values():
        assert (row["n_words"], row["word_chars"], row["n_dup_lines"]) == (0, 0, 0)
        assert row["base_failed"] and not row["kept"]


def test_counts(spark):
    row = judge(spark, "a b c a b c\n# x\n# x\n\nend.")[0]
    assert row["n_words"] == 11
    assert row["n_symbols"] == 2
    assert row["n_dup_lines"] == 1
    # "a b c" twice, "# x" twice but "# x #" and "x # x" once.
    assert row["n_repeat_words"] == 6


def test_lines_are_judged_before_the_document(spark):
    menu = "Home | News | Sport | About | Contact"
    row = judge(spark, f"{menu}\n{SENTENCES}\nAll rights reserved.")[0]
    assert row["kept"] and row["cleaned"] == SENTENCES
    lost = judge(spark, "\n".join(sentence().replace(" ", " | ") for _ in range(12)) + "\n" + SENTENCES)[0]
    assert not lost["base_failed"] and not lost["kept"]


@pytest.mark.parametrize("line", ["DEALS!! NOW!! HERE!!", "x### y*** z%%%", "Read more"])
def test_failing_lines(spark, line):
    assert judge(spark, f"{SENTENCES}\n{line}")[0]["cleaned"] == SENTENCES


def test_repeats_extra_columns_and_empty_table(spark):
    rows = spark.createDataFrame(
        [(1, SENTENCES, "a", 5)] * 2, "doc_id long, text string, n_words string, kept long")
    got = quality.line_quality(rows, prefix="q_")
    assert got.count() == 2 and {"n_words", "q_n_words", "kept", "q_kept"} <= set(got.columns)
    assert quality.keep_quality(rows).columns == rows.columns
    assert quality.line_quality(rows.limit(0)).count() == 0


def test_long_text(spark):
    row = judge(spark, "\n".join(sentence() for _ in range(20_000)))[0]
    assert row["n_words"] > 200_000 and row["kept"]
