"""Two long words that every sum of powers modulo 2^64 takes for one (Thue-Morse and its complement)."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from millrace.llm import decontamination, line_cleaning, near_duplicates, pieces, token_files
from millrace.llm import words as W


def thue_morse(a, b, steps):
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


X, Y = thue_morse("ab", "ba", 11)
TEXTS = [f"{X} {Y} {X}", f"{Y} {X}", X, Y, f"{X}\n{Y}", f"start {X} {Y} end"]


def frame(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_words_are_numbered_by_their_bytes():
    (part,) = W.slices(W.pa.array([f"{X} {Y} {X}"]))
    found = W.words(part, W.SPACED)
    assert found.index.tolist() == [0, 1, 0] and found.distinct == [X.encode(), Y.encode()]
    assert len(set(found.hash.tolist())) == 2


def test_token_files(spark, tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write(frame(spark, TEXTS), "doc_id", "text", str(tmp_path / "files"), path)
    got = {}

    def digest(doc_ids, starts, sizes, ids):
        lists = np.split(ids, np.cumsum(sizes)[:-1])
        return [doc_ids, W.pa.array([x.tolist() for x in lists], W.pa.list_(W.pa.int64()))]

    for row in token_files.documents(token_files.read_blocks(spark, str(tmp_path / "files")), "doc_id long, ids array<long>", digest).collect():
        got[row.doc_id] = row.ids
    tokenizer = Tokenizer.from_file(path)
    assert got == {i: tokenizer.encode(t, add_special_tokens=False).ids for i, t in enumerate(TEXTS)}


def test_sentencepiece(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    rows = pieces.encode(frame(spark, TEXTS), "text", pieces.load(path), verified="same").collect()
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    assert {r.doc_id: r.token_ids for r in rows} == {i: library.encode(t) for i, t in enumerate(TEXTS)}
    assert all(r.same for r in rows)


def test_lines_and_windows(spark):
    rows = line_cleaning.judge_lines(frame(spark, [f"{X}\n{Y}", f"{X}\n{X}", f"{X} b c d e f {Y} b c d e"]), "text").collect()
    assert {r.doc_id: (r.n_dup_lines, r.n_repeat_words) for r in rows} == {0: (0, 0), 1: (1, 0), 2: (0, 0)}


def test_windows_of_one_key_are_told_apart(monkeypatch):
    monkeypatch.setattr(line_cleaning, "mixed", lambda values: np.zeros_like(values))
    (part,) = W.slices(W.pa.array(["a b c d e f a b c d e", "a b c d e f g h i j k"]))
    covered = line_cleaning.repeated_words(W.words(part, W.SPACED), 5)
    assert covered.tolist() == [True] * 5 + [False] + [True] * 5 + [False] * 11


def test_decontamination(spark):
    bench = spark.createDataFrame([("i", X)], "item_id string, text string")
    found = decontamination.find_matches(frame(spark, TEXTS), "text", decontamination.automata(bench)).collect()
    assert {r.doc_id: (len(r.hit_words), r.hit_items) for r in found} == {
        0: (2, ["i"]), 1: (1, ["i"]), 2: (1, ["i"]), 3: (0, []), 4: (1, ["i"]), 5: (1, ["i"])}


def test_near_duplicates(spark):
    texts = [f"one two {X}", f"one two {Y}", f"one two {X}", f"{X}", f"{Y}"]
    rows = near_duplicates.near_duplicates(frame(spark, texts), "doc_id", "text").collect()
    assert {r.doc_id: r.class_id for r in rows} == {0: 0, 1: 1, 2: 0, 3: 3, 4: 4}


@pytest.mark.parametrize("table", [W.SPACED, W.ALPHANUMERIC])
def test_words_that_differ_only_in_where_they_are_cut(table):
    parts = [next(W.slices(W.pa.array([t]))) for t in ("ab c", "a bc")]
    one, two = (near_duplicates._prints(p, W.words(p, W.ALPHANUMERIC))[0][0].as_py() for p in parts)
    assert one != two
