"""Counts against plain Python, the order of the cascade, odd rows."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tokenloom.llm import quality as q

BLANK = re.compile("[\x20\x09-\x0d]+")


def plain(text):
    text = text or ""
    words = [w for w in BLANK.split(text) if w]
    grams = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, g in enumerate(grams) if grams.count(g) > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if BLANK.sub("", line)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def counted(frame):
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = frame.select("doc_id", q.words_of(text).alias("w"), q.word_chars(text).alias("c"), q.symbols(text).alias("s"), q.repeated_lines(text).alias("l"))
    return [(r.doc_id, len(r.w), r.c, r.s, r.l, r.n_repeat_words) for r in q.with_repeated_words(rows, "w").collect()]


@pytest.mark.parametrize("bits", [14, 3])
def test_counts(spark, monkeypatch, bits):
    monkeypatch.setattr(q, "PLACE_BITS", bits)
    draw = random.Random(4)
    texts = ["".join(draw.choice(["a", "b", "cé", " ", " ", "\n", "\t", "#", " ", "a b a\n"]) for _ in range(draw.randrange(0, 120))) for _ in range(60)]
    texts += [None, "", " \n\t", "one", "a a a", "a a a a", "x y z x y z", "l\nl\n l\n\n\n"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    assert sorted(counted(frame)) == [(i, *plain(t)) for i, t in enumerate(texts)]


def test_cascade_runs_the_best_rule_first():
    rules = [q.Rule(name, lambda m: F.lit(False)) for name in "abc"]
    order = q.cascade_order(rules, {"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (0.1, 0.0)})
    assert [r.name for r in order] == ["b", "a", "c"]


def test_costs_leave_out_what_a_job_costs_anyway(spark):
    """A rule that does much work costs more than one that does none, whose cost is near nothing."""
    frame = spark.range(300).select(F.concat_ws(" ", F.array_repeat(F.concat(F.lit("word"), F.col("id")), 200)).alias("text"))
    rules = [q.Rule("idle", lambda m: m("n_symbols") < 0), q.Rule("busy", lambda m: F.size(F.array_distinct(F.transform(q.words_of(F.col("text")), lambda w: F.sha2(w, 512)))) > 1)]
    measured = q.measure(frame, "text", rules)
    assert measured["busy"][0] > 3 * measured["idle"][0] and measured["idle"][1] == measured["busy"][1] == 0
    assert 0 <= measured["idle"][0] < measured["busy"][0]


def test_rows_that_fail_the_base_enter_no_rule(spark):
    """A rule that raises an error is not reached by rows that an earlier rule or the base rejects."""
    frame = spark.createDataFrame([(1, "#### ####"), (2, "short"), (3, "fine words")], "doc_id int, text string")
    rules = [q.Rule("a_noise", lambda m: m("n_symbols") > 3), q.Rule("b_fails", lambda m: F.when(m("n_symbols") > 3, F.raise_error(F.lit("reached")).cast("boolean")).otherwise(F.lit(False)))]
    order = sorted(rules, key=lambda rule: rule.name)
    verdict = q.first_rejection(q.measures(F.col("text")), order)
    got = {r.doc_id: r.v for r in frame.select("doc_id", F.when(F.col("doc_id") == 2, F.lit("base")).otherwise(verdict).alias("v")).collect()}
    assert got == {1: "a_noise", 2: "base", 3: None}
    kept = {r.doc_id: (r.kept, r.rejected_by) for r in q.quality_cascade(frame, unless=F.col("doc_id") == 2).collect()}
    assert kept[2] == (False, "base") and kept[3] == (True, None) and not kept[1][0]


def test_letters_and_endless_words(spark):
    rows = [(1, "9" * 80 + " ok"), (2, "x" * 1001), (3, "x" * 1000), (4, "ab 1234"), (5, "é" * 30)]
    frame = spark.createDataFrame(rows, "doc_id int, text string")
    rules = [r for r in q.DEFAULT_RULES if r.name in ("letter_share", "endless_word")]
    assert {r.doc_id: r.rejected_by for r in q.quality_cascade(frame, rules=rules).collect()} == {1: "letter_share", 2: "endless_word", 3: None, 4: None, 5: None}


def test_verdicts_and_odd_rows(spark):
    rows = [(1, None, "x"), (1, "", "y"), (None, "good words in a row", None), (3, "#### | $$$$ | %%%%", "z"), (4, "123 456 789", "w"), (5, "word " * 40000, "v")]
    frame = spark.createDataFrame(rows, "doc_id int, text string, kept string")
    got = {(r.doc_id, r.rejected_by) for r in q.quality_cascade(frame).collect()}
    assert (None, None) in got and (5, None) in got and {r for i, r in got if i == 4} <= {"no_letters", "letter_share"}
    assert all(r for i, r in got if i in (1, 3))
    assert q.quality_cascade(frame.limit(0)).collect() == []


def test_no_python_in_the_plan(spark):
    plan = q.op10(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
