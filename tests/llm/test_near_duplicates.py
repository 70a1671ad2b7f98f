from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from millrace.llm import near_duplicates as N
from millrace.llm.components import components


def shingles(text, weights="count"):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    w = re.findall(rb"[0-9a-z\x80-\xff]+", data)
    runs = [tuple(w[i:i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] if w else []
    return Counter(runs) if weights == "count" else Counter(set(runs))


def brute_classes(rows, weights="count"):
    """Class of each (id, text) by comparing all pairs that share a shingle."""
    sets = [shingles(t, weights) for _, t in rows]
    holders = defaultdict(list)
    for i, s in enumerate(sets):
        for g in s:
            holders[g].append(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        for j in {j for g in s for j in holders[g] if j > i}:
            common = sum(min(k, sets[j][g]) for g, k in s.items())
            if common / (s.total() + sets[j].total() - common) >= 0.8:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[find(i)] = min(doc, least.get(find(i), doc))
    return {doc: least[find(i)] for i, (doc, _) in enumerate(rows)}


def classes(df, **options):
    return {r.doc_id: r.class_id for r in N.near_duplicates(df, "doc_id", "text", **options).collect()}


@pytest.mark.parametrize("weights", ["count", "set"])
def test_classes_agree_with_comparing_all_pairs(spark, weights):
    documents = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    assert classes(documents, weights=weights) == brute_classes(rows, weights)


@pytest.mark.parametrize("rounds", [0.2, 2.0])
def test_a_chain_of_copies_around_the_threshold(spark, monkeypatch, rounds):
    """Many texts that are all somewhat alike; with 2.0 the blocks do all the work the leader leaves."""
    monkeypatch.setattr(N, "WORTH_A_ROUND", rounds)
    monkeypatch.setattr(N, "BLOCK", 16)
    draw = random.Random(5)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(150):
        text = list(base)
        for _ in range(draw.choice([1, 2, 3, 4, 6])):
            text[draw.randrange(len(text))] = f"x{draw.randrange(10 ** 6)}"
        rows.append((i, " ".join(text)))
    assert classes(spark.createDataFrame(rows, "doc_id long, text string")) == brute_classes(rows)


def test_forest_joins_what_all_links_join():
    part = np.array([0, 1, 2, 2, 4])
    a, b = np.array([0, 1, 0, 3, 4]), np.array([1, 2, 3, 0, 0])
    kept = N._forest(a, b, part)
    assert len(kept) == 3


def test_common_cells_in_chunks(monkeypatch):
    monkeypatch.setattr(N, "BLOCK_CELLS", 3)
    draw = np.random.default_rng(1)
    cells = [np.unique(draw.integers(0, 40, 15)) for _ in range(9)]
    a, b = np.arange(4), np.arange(4, 9)
    assert (N._common(cells, a, b) == [[len(np.intersect1d(cells[i], cells[j])) for j in b] for i in a]).all()


def test_signatures_estimate_weighted_similarity():
    draw = np.random.default_rng(3)
    elements = draw.integers(0, 1 << 62, 60).astype(np.uint64)
    one, two = draw.uniform(0.1, 4, 60), draw.uniform(0.1, 4, 60)
    k = 3000
    sign = [N.signatures(elements, w, np.zeros(60, np.int64), 1, k)[0] for w in (one, two)]
    truth = np.minimum(one, two).sum() / np.maximum(one, two).sum()
    assert abs((sign[0] == sign[1]).mean() - truth) < 4 * np.sqrt(truth * (1 - truth) / k)


def test_edges(spark, odd):
    rows = N.near_duplicates(odd, "doc_id", "text").collect()
    assert len(rows) == 13
    found = {r.doc_id: r.class_id for r in rows}
    assert found[None] is None
    assert all(found[i] == i for i in (0, 1, 2, 3, 5, 6, 11))
    again = N.near_duplicates(odd.select("text", odd.doc_id.alias("class_id")), "class_id", "text")
    assert again.columns == ["class_id", "class_id"]
    assert N.near_duplicates(odd.limit(0), "doc_id", "text").count() == 0


def test_components(spark):
    draw = random.Random(1)
    links = [(draw.randrange(300), draw.randrange(300)) for _ in range(260)] + [(7, 7)]
    root = list(range(300))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {n: find(n) for pair in links if pair[0] != pair[1] for n in pair}


def test_members_that_reach_the_leader_through_others_are_compared(spark):
    """Bucket by bucket: leader 1, members with their similarity to it, and which of them are in its component."""
    buckets = {
        "through others": ({2: 0.5, 3: 0.55}, {2}, {2, 3}),
        "linked": ({2: 0.9, 3: 0.75}, {2}, {2, 3}),
        "too far": ({2: 0.9, 3: 0.55}, {2}, set()),
        "alone": ({3: 0.7}, set(), set()),
        "all in": ({2: 0.5, 4: 0.9}, {2, 4}, set()),
        "one of two in reach": ({2: 0.5, 4: 0.9, 3: 0.3}, {2, 4}, {2, 3}),
        "two apart": ({2: 0.9, 3: 0.2, 5: 0.4}, {2}, {3, 5}),
        "two apart, through others": ({2: 0.5, 4: 0.95, 3: 0.2, 5: 0.4}, {2, 4}, {2, 3, 5}),
    }
    members, checked, parts = [], [], []
    for number, (similarity, inside, _) in enumerate(buckets.values()):
        base = 10 * number
        members += [(number, base + 1, base + i) for i in similarity]
        checked += [(base + 1, base + i, s) for i, s in similarity.items()]
        parts += [(base + i, base + 1) for i in {1, *inside}]
    left = N._left_apart(
        spark.createDataFrame(members, "key long, leader long, id long"),
        spark.createDataFrame(checked, "x long, y long, similarity double"),
        spark.createDataFrame(parts, "node long, component long"), 0.8).collect()
    for number, (name, (_, inside, wanted)) in enumerate(buckets.items()):
        found = {r.id - 10 * number: r.apart for r in left if r.key == number}
        assert found == {i: i not in inside for i in wanted}, name
