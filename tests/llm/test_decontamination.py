from __future__ import annotations

import random

import pytest

from millrace.llm import decontamination as D


def brute(words, items, window):
    """Hit places and items of a word list, by looking for every window everywhere."""
    hit, found = set(), set()
    for name, item in items:
        size = min(window, len(item))
        for a in range(len(item) - size + 1) if item else ():
            for b in range(len(words) - size + 1):
                if words[b:b + size] == item[a:a + size]:
                    hit |= set(range(b, b + size))
                    found.add(name)
    return hit, found


@pytest.mark.parametrize("seed", range(40))
def test_automaton_agrees_with_brute_force(seed):
    draw = random.Random(seed)
    letters = [str(i).encode() for i in range(1, draw.choice([2, 3, 6]) + 1)]
    items = [(str(draw.randrange(6)), [draw.choice(letters) for _ in range(draw.randrange(0, 14))]) for _ in range(draw.randrange(1, 7))]
    window = draw.choice([2, 4, 6])
    machine = D.SuffixAutomaton(items, window)
    for _ in range(10):
        text = [draw.choice([*letters, b"99"]) for _ in range(draw.randrange(0, 40))]
        row = D.np.zeros(len(text), D.np.int64)
        distinct = sorted(set(text))
        words = D.Words(row, row, row, D.np.array([distinct.index(w) for w in text], D.np.int64), D.pa.array(distinct, D.pa.large_binary()))
        hits, found = machine.scan(words, 1)
        places = {p for a, b in hits.get(0, []) for p in range(a, b)}
        assert (places, found[0]) == brute(text, items, window)


PASSAGE = "one two three four five six seven eight nine ten eleven twelve"


def frames(spark):
    bench = spark.createDataFrame([(1, PASSAGE), (2, "Alpha beta"), (2, "gamma, delta!"), (3, None), (4, " .. "), (None, PASSAGE[4:])],
                                  "item_id long, text string")
    docs = spark.createDataFrame([
        (1, "Before it. " + PASSAGE.upper() + ", and after it come quite some more words that are nothing but harmless text."),
        (2, PASSAGE), (3, "no match here: two three four five six seven eight nine ten"), (4, None), (5, ""),
        (6, "so it says ALPHA-Beta and goes on and on with gamma delta inside"), (7, "alpha gamma beta delta")],
        "doc_id long, text string")
    return docs, bench


@pytest.mark.parametrize("block_words", [1_000_000, 6])
def test_matches_and_removal(spark, block_words):
    docs, bench = frames(spark)
    found = {r.doc_id: r for r in D.find_matches(docs, "text", D.automata(bench, block_words=block_words)).collect()}
    spans = {k: [(x.start, x.stop) for x in r.hit_words] for k, r in found.items()}
    assert spans == {1: [(2, 14)], 2: [(0, 12)], 3: [], 4: [], 5: [], 6: [(3, 5), (11, 13)], 7: []}
    assert {k: r.hit_items for k, r in found.items() if r.hit_items} == {1: ["1"], 2: ["1"], 6: ["2"]}
    clean = {r.doc_id: r.text for r in D.remove_matches(docs, "text", bench, block_words=block_words).collect()}
    assert clean == {1: "Before it.  , and after it come quite some more words that are nothing but harmless text.",
                     3: docs.collect()[2].text, 4: None, 5: "", 6: "so it says   and goes on and on with   inside", 7: "alpha gamma beta delta"}


def test_a_gap_that_closes_to_a_new_match_is_cleaned_again(spark):
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b a b c c x x x x x x x x x")], "doc_id long, text string")
    assert D.remove_matches(docs, "text", bench).first().text.split() == ["x"] * 9


def test_edges(spark, odd):
    _, bench = frames(spark)
    made = D.remove_matches(odd.withColumnRenamed("kept", "n_words"), "text", bench)
    assert made.columns == ["doc_id", "text", "n_words", "score", "token_ids"]
    assert made.count() == 13
    assert D.remove_matches(odd, "text", bench.limit(0)).count() == 13
    assert D.remove_matches(odd.limit(0), "text", bench).count() == 0
