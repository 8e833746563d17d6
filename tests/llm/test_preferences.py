"""Pairs against plain Python, and odd conversations."""

from tokenloom.llm import preferences as p


def rendered(turns):
    return "".join(f"<|{role or ''}|>\n{text or ''}<|end|>\n" for role, text in turns)


def test_prompt_and_completions(spark):
    chosen = [("a", 0, "user", "q"), ("a", 1, "assistant", "good"), ("b", 0, "user", "hi"), ("c", 0, "user", None), (None, 0, "user", "n"), ("e", 0, "user", "x"), ("e", None, "system", "s")]
    rejected = [("a", 0, "user", "q"), ("a", 1, "assistant", "bad"), ("a", 2, "user", "why"), ("b", 0, "user", "hi"), ("c", 0, None, "user"), ("d", 0, "user", "only"), (None, 0, "user", "m"), ("e", 0, "user", "y"), ("e", None, "system", "s")]
    schema = "id string, turn int, role string, text string"
    got = {(r.id, r.block): r for r in p.preference_pairs(spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()}
    a = got["a", 0]
    assert (a.prompt, a.prompt_turns) == (rendered([("user", "q")]), 1)
    assert (a.chosen, a.rejected) == (rendered([("assistant", "good")]), rendered([("assistant", "bad"), ("user", "why")]))
    assert [a.chosen[s.begin : s.end] for s in a.chosen_loss] == ["good<|end|>\n"] and [a.rejected[s.begin : s.end] for s in a.rejected_loss] == ["bad<|end|>\n"]
    assert (got["b", 0].prompt, got["b", 0].chosen, got["b", 0].rejected) == (rendered([("user", "hi")]), "", "")
    assert got["c", 0].prompt_turns == 0 and got["d", 0].chosen == "" and got["d", 0].rejected == rendered([("user", "only")])
    assert got[None, 0].chosen == rendered([("user", "n")]) and got[None, 0].rejected == rendered([("user", "m")])
    assert sum(r.prompt == rendered([("system", "s")]) for (i, _), r in got.items() if i == "e") == 1


def test_long_conversations_come_in_blocks(spark):
    turns = [(1, t, "user" if t % 2 == 0 else "assistant", f"t{t}") for t in range(150)]
    other = [*turns[:100], *[(1, t, r, "other") for _, t, r, _ in turns[100:]]]
    schema = "id int, turn int, role string, text string, block int"
    rows = p.preference_pairs(*(spark.createDataFrame([(*t, 7) for t in side], schema) for side in (turns, other))).orderBy("block").collect()
    assert [r.block for r in rows] == [0, 1, 2]
    assert "".join(r.prompt for r in rows) == rendered([t[2:] for t in turns[:100]])
    assert "".join(r.chosen for r in rows) == rendered([t[2:] for t in turns[100:]])
    assert "".join(r.rejected for r in rows) == rendered([t[2:] for t in other[100:]])


def test_repeated_turns_and_empty_tables(spark):
    schema = "id int, turn int, role string, text string"
    one = spark.createDataFrame([(1, 0, "user", "a"), (1, 0, "user", "a"), (1, 0, "user", "b")], schema)
    two = spark.createDataFrame([(1, 0, "user", "b"), (1, 0, "user", "a"), (1, 0, "user", "a")], schema)
    assert p.preference_pairs(one, two).first().prompt == rendered([("user", "a"), ("user", "a"), ("user", "b")])
    assert p.preference_pairs(one, two.limit(2)).first().prompt_turns == 0
    assert p.preference_pairs(one.limit(0), two.limit(0)).collect() == []
