from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from millrace.llm import simhash as S
from millrace.llm import workload


def print_of(text):
    data = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes)) if hashes else 0


def brute_components(prints):
    """Smallest id that each id reaches, by comparing all pairs of different fingerprints."""
    by_print: dict = {}
    for doc, p in prints:
        by_print.setdefault(p, []).append(doc)
    different = list(by_print)
    values = np.array(different, np.uint64)
    root = {p: p for p in different}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, p in enumerate(different):
        for j in np.flatnonzero(np.bitwise_count(values[i + 1:] ^ values[i]) <= 2).tolist():
            root[find(different[i + 1 + j])] = find(p)
    least: dict = {}
    for p, docs in by_print.items():
        for doc in docs:
            if doc is not None:
                least[find(p)] = min(doc, least.get(find(p), doc))
    return Counter((doc, f"{p:016x}", least.get(find(p))) for doc, p in prints)


def found(df):
    return Counter(tuple(r) for r in df.collect())


def test_query_agrees_with_all_pairs(spark):
    folder = "/root/testdata/sf0.01"
    rows = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    expected = brute_components([(r.doc_id, print_of(r.text)) for r in rows])
    assert found(workload.QUERIES["op13_simhash"](spark, folder)) == expected
    assert sum(n for (doc, _, component), n in expected.items() if doc != component) > 20


def linked(spark, prints):
    rows = [(int(np.uint64(p).astype(np.int64)), None if i % 5 == 0 else i) for i, p in enumerate(prints)]
    made = S.components(S.links(spark.createDataFrame(rows, "fingerprint long, least long")), "x", "y").collect()
    parts = {r.node.fingerprint: r.component.fingerprint for r in made}
    groups: dict = {}
    for (signed, _), p in zip(rows, prints, strict=True):
        groups.setdefault(parts.get(signed, signed), []).append(p)
    return sorted(sorted(g) for g in groups.values())


def expected_groups(prints):
    groups: dict = {}
    for p, _, least in brute_components([(p, p) for p in prints]):
        groups.setdefault(least, []).append(p)
    return sorted(sorted(g) for g in groups.values())


@pytest.mark.parametrize("long_list", [4, 1024])
def test_links_of_any_two_bits(spark, monkeypatch, long_list):
    """Neighbours at 0 to 4 bits in any bytes, and crowds of fingerprints around one; lists short and long."""
    monkeypatch.setattr(S, "LONG_LIST", long_list)
    draw = random.Random(long_list)
    prints = {0, (1 << 64) - 1}
    for _ in range(150):
        p = draw.getrandbits(64)
        prints |= {p ^ sum(1 << b for b in draw.sample(range(64), k)) for k in (0, 1, 2, 3, 4)}
    centre = draw.getrandbits(64)
    prints |= {centre ^ sum(1 << b for b in draw.sample(range(64), draw.randint(0, 9))) for _ in range(400)}
    prints |= {centre ^ draw.getrandbits(16) << 24 for _ in range(300)}
    prints = sorted(prints)
    assert linked(spark, prints) == expected_groups(prints)


def test_fingerprints_of_odd_texts(spark, odd):
    rows = S.near_duplicates(odd.withColumn("id", odd["score"]), "doc_id", "text")
    texts = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert found(rows) == brute_components([(d, print_of(t)) for d, t in texts])
    assert S.near_duplicates(odd.limit(0), "doc_id", "text").collect() == []


def test_null_ids_link_others(spark):
    """Texts without words share fingerprint 0; a component of null ids only has no name."""
    data = [(None, ""), (7, " "), (3, None), (None, "a b c"), (None, "A b  C")]
    rows = S.near_duplicates(spark.createDataFrame(data, "i long, t string"), "i", "t")
    assert found(rows) == brute_components([(d, print_of(t)) for d, t in data])
