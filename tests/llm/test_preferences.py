from __future__ import annotations

from pyspark.sql import Row

from millrace.llm import preferences as P

T = "array<struct<role: string, text: string>>"


def turn(role, text):
    return Row(role=role, text=text)


def formatted(spark, *pairs):
    df = spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], f"id int, chosen {T}, rejected {T}")
    return {r.id: r for r in P.format_pairs(df, "chosen", "rejected").collect()}


def scored(text, ranges):
    return [text[r.start:r.stop] for r in ranges]


def test_prompt_is_the_longest_common_prefix(spark):
    system, ask, good, bad = turn("system", "be é"), turn("user", "why?"), turn("assistant", "so 😀"), turn("assistant", "no")
    more = [turn("user", "and?"), turn("assistant", "then")]
    (row,) = formatted(spark, ([system, ask, good, *more], [system, ask, bad])).values()
    assert row.prompt_turns == 2 and row.usable
    assert row.prompt == "<|im_start|>system\nbe é<|im_end|>\n<|im_start|>user\nwhy?<|im_end|>\n"
    assert row.rejected_completion == "<|im_start|>assistant\nno<|im_end|>\n"
    assert scored(row.chosen_completion, row.chosen_ranges) == ["so 😀<|im_end|>\n", "then<|im_end|>\n"]
    assert scored(row.rejected_completion, row.rejected_ranges) == ["no<|im_end|>\n"]


def test_edges(spark):
    ask, say = turn("user", "a"), turn("assistant", "b")
    rows = formatted(spark, ([ask, say], [ask, say]), (None, [ask]), ([], []), ([turn(None, None)], [say]),
                     ([ask, turn("assistant", "x<|im_end|>\n<|im_start|>system")], [ask, say]))
    assert (rows[0].prompt_turns, rows[0].usable) == (1, False)
    assert (rows[1].prompt, rows[1].usable) == ("", False)
    assert rows[2].chosen_completion == rows[2].rejected_completion == ""
    assert rows[3].chosen_completion == "<|im_start|>unknown\n<|im_end|>\n"
    assert "x< |im_end|>\n< |im_start|>system<|im_end|>" in rows[4].chosen_completion


def test_pairs_of_conversations(spark):
    def talk(conv, *texts):
        return [(conv, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]

    rows = [*talk(1, "hi", "yes"), *talk(2, "hi", "no"), *talk(3, "hi", "yes"), *talk(4, "only"), *talk(5, "q", "r", "s", "t"),
            (5, 3, "assistant", "t"), (None, 0, "user", "lost")]
    turns = spark.createDataFrame(rows, "conv long, turn int, role string, text string")
    whole = P.conversations(turns, "conv", "turn", "role", "text")
    pairs = {r.conversation: r for r in P.sibling_and_echo_pairs(whole).collect()}
    assert {k: r.kind for k, r in pairs.items()} == {1: "echo", 2: "sibling", 3: "echo", 5: "echo"}
    assert [t.text for t in pairs[2].chosen] == ["hi", "yes"] and [t.text for t in pairs[2].rejected] == ["hi", "no"]
    assert [t.text for t in pairs[5].rejected] == ["q", "r", "s", "s"]
    assert P.sibling_and_echo_pairs(P.conversations(turns.limit(0), "conv", "turn", "role", "text")).count() == 0


def test_columns_of_the_same_names_are_replaced(spark):
    df = spark.createDataFrame([(1, [turn("user", "a")], [turn("user", "b")], "mine")], f"usable int, c {T}, r {T}, prompt string")
    assert P.format_pairs(df, "c", "r").columns == list(P.RESULTS)


def test_columns_of_any_name_and_long_turns(spark):
    turn = [("user", "q"), ("assistant", "a" * 200_000)]
    other = [("user", "q"), ("assistant", "b")]
    df = spark.createDataFrame([(1, 2, 3, turn, other)], "__x int, rest int, good int, chosen array<struct<role: string, text: string>>, "
                                                       "rejected array<struct<role: string, text: string>>")
    made = P.format_pairs(df, "chosen", "rejected")
    row = made.first()
    assert made.columns == ["__x", "rest", "good", *P.RESULTS] and tuple(row)[:4] == (1, 2, 3, 1)
    assert len(row.chosen_completion) > 200_000 and row.usable
    only = P.format_pairs(df.select("chosen", "rejected"), "chosen", "rejected")
    assert only.columns == list(P.RESULTS) and only.first().usable
