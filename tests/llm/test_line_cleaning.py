from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import line_cleaning as L
from millrace.llm.words import slices


def counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    runs = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    covered = {j for i in range(len(w) - 4) if runs[tuple(w[i:i + 5])] > 1 for j in range(i, i + 5)}
    lines, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in lines
            lines.add(line)
    failed = len(w) < 10 or 100 * len(covered) > 20 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), failed


def judged(texts, limit=1 << 20):
    rows = []
    for part in slices(pa.array(texts, pa.string()), limit):
        j = L.Judged(part, L.np.ones(len(part), bool), L.Rules())
        rows += list(zip(*[getattr(j, n).tolist() for n in (*L.COUNTS, "base_failed", "kept")], j.cleaned(part), strict=True))
    return rows


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab #|é\n\t.", max_size=60), max_size=5), st.integers(1, 90))
def test_counts_agree_with_brute_force(texts, limit):
    assert [r[:6] for r in judged(texts, limit)] == [counts(t) for t in texts]


GOOD = "A plain sentence stands here, with enough words to be read as prose. Another one follows it."


@pytest.mark.parametrize("line", [
    "Home | News | Sport | Weather | Contact", "Prices ### are $$$ low *** today %%% only &&& here", "All rights reserved.",
    GOOD, "again again again again again again.", " ".join("word" for _ in range(50))])
def test_failing_lines_go(line):
    text = f"{GOOD}\n{line}\nThe end of this text, which is good as well."
    (row,) = judged([text])
    assert row[-1] == f"{GOOD}\nThe end of this text, which is good as well."


@pytest.mark.parametrize("line", ["Licensed under the MIT License.", "Short title", "« C'est la fin »", "Ist das so? (Ja.)", "\t"])
def test_good_lines_stay(line):
    text = f"{GOOD}\n\n{line}"
    (row,) = judged([text])
    assert row[-1] == text and row[-2]


def test_documents_that_lose_too_much_are_rejected():
    table = "\n".join("a | b | c | d | e" for _ in range(1)) + "\n" + "\n".join(f"x{i} | y{i} | z{i} | u{i}" for i in range(30))
    assert judged([GOOD + "\n" + table])[0][-2] is False


def test_operator(spark, odd, documents):
    rows = L.judge_lines(odd, "text").collect()
    assert [tuple(r[c] for c in (*L.COUNTS, "base_failed")) for r in rows] == [counts(r.text) for r in odd.collect()]
    assert L.clean(documents, "text").columns == documents.columns
    assert L.clean(odd, "text").columns[0] == "doc_id"
    assert L.judge_lines(odd.limit(0), "text").count() == 0


def test_labelled_documents(spark):
    folder = "/root/testdata/sf0.01"
    rows = L.judge_lines(spark.read.parquet(f"{folder}/documents.parquet"), "text").join(
        spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").collect()
    long = [r for r in rows if not r.base_failed]
    assert sum(r.kept for r in long if r.quality == 1) >= 0.98 * sum(r.quality == 1 for r in long)
    assert sum(not r.kept for r in long if r.quality == 0) >= 0.95 * sum(r.quality == 0 for r in long)
