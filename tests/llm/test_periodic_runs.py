from __future__ import annotations

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import periodic_runs as P
from millrace.llm import workload


def brute_runs(words, least=6, exponent=4):
    """Maximal stretches of every period by comparing word by word; the smallest period of a stretch counts."""
    found = {}
    for q in range(1, len(words) // exponent + 1):
        k = 0
        while k + q < len(words):
            if words[k] != words[k + q]:
                k += 1
                continue
            begin = k
            while k + q < len(words) and words[k] == words[k + q]:
                k += 1
            if k + q - begin >= max(least, exponent * q):
                found.setdefault((begin, k + q - begin), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def runs_of(*texts):
    numbers = {w: i + 1 for i, w in enumerate(sorted({w for t in texts for w in t}))}
    ids = np.array([numbers[w] for t in texts for w in t], np.int64)
    bounds = np.cumsum([0, *map(len, texts)])
    row, *rest = P.runs(ids, bounds)
    return [[tuple(int(v[i]) for v in rest) for i in np.flatnonzero(row == r)] for r in range(len(texts))]


@pytest.mark.parametrize("seed", range(6))
def test_runs_agree_with_comparing_word_by_word(seed):
    draw = random.Random(seed)
    texts = []
    for _ in range(150):
        words: list = []
        while len(words) < draw.choice([0, 3, 8, 40, 150, 400]):
            unit = draw.choices("ab" if draw.random() < 0.6 else "abcdefghij", k=draw.choice([1, 1, 2, 3, 5, 7, 16, 31]))
            if draw.random() < 0.5:
                unit = unit * draw.randint(1, 9) + unit[:draw.randrange(len(unit) + 1)]
            words += unit
        texts.append(words)
    expected = [brute_runs(t) for t in texts]
    assert sum(map(len, expected)) > 100
    assert runs_of(*texts) == expected


def test_texts_of_one_letter_pairs_by_counting():
    """All texts of two letters up to length 12, where runs touch, overlap and share their ends."""
    texts = [[c for c in f"{i:0{n}b}"] for n in range(13) for i in range(2 ** n)]
    assert runs_of(*texts) == [brute_runs(t) for t in texts]


def test_a_long_text_of_one_word_and_blocks_that_repeat_it():
    m = 30_000
    draw = random.Random(1)
    broken = (["a"] * 700 + ["b"]) * 40
    noise = [str(draw.randrange(50)) for _ in range(3_000)]
    assert runs_of(["a"] * m, broken, noise * 5 + noise[:17]) == [
        [(0, m, 1)],
        sorted([(0, len(broken), 701)] + [(701 * i, 700, 1) for i in range(40)]),
        sorted({(0, 15_017, 3_000), *brute_small(noise * 5 + noise[:17])})]


def brute_small(words):
    return [r for r in brute_runs(words[:3_200] + ["?"], 6, 4) if r[2] < 60] + [
        (s + 3_000 * i, n, q) for i in (1, 2, 3, 4) for s, n, q in brute_runs(words[:3_200], 6, 4) if q < 60 and s + 3_000 * i + n <= 15_017]


def test_sums_that_are_multiples_of_a_prime():
    """Word numbers may differ by so much that a sum of squares is 0 modulo a prime."""
    blocks, following = np.array([[5]], np.int64), np.array([[5 + P.PRIMES[0][0], 0]], np.int64)
    assert P.squared_differences(blocks, following, *P.PRIMES[0])[0, 0] == 0
    assert P.squared_differences(blocks, following, *P.PRIMES[1])[0, 0] != 0


@pytest.mark.parametrize("prime", range(len(P.PRIMES)))
@pytest.mark.parametrize("size", [1, 2, 8, 64])
def test_transform_gives_the_sums_of_squares(prime, size):
    draw = np.random.default_rng(size)
    blocks, following = draw.integers(0, 1000, (5, size)), draw.integers(0, 1000, (5, 2 * size))
    plain = [[((following[r, t:t + size] - blocks[r]) ** 2).sum() % P.PRIMES[prime][0] for t in range(size)] for r in range(5)]
    assert P.squared_differences(blocks, following, *P.PRIMES[prime]).tolist() == plain


def digest(doc_id, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    n = len(words)
    if doc_id is not None:
        h = zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    dropped = {i for s, m, q in runs for i in range(s + q, s + m)}
    start, length, period = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else (None, None, None)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
    return (doc_id, len(runs), start, length, period, 1000 * length // period if runs else None, hashlib.sha256(lines.encode()).hexdigest(),
            hashlib.sha256(b" ".join(w for i, w in enumerate(words) if i not in dropped)).hexdigest())


def test_query_agrees_with_brute_force(spark, documents):
    found = sorted(tuple(r) for r in workload.QUERIES["op12_periodic_runs"](spark, "/root/testdata/sf0.001").collect())
    expected = sorted(digest(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    assert found == expected
    assert sum(r[1] > 0 for r in found) > 10


def test_odd_texts(spark, odd):
    texts = odd.select("doc_id", "text").collect()
    found = P.find_runs(odd.withColumn("runs", odd["score"]), "text").collect()
    assert [(r.doc_id, r.text, r.kept) for r in found] == [(r.doc_id, r.text, "mine") for r in texts]
    for row in found:
        words = re.findall(r"[^\x20\x09-\x0D]+", row.text or "")
        expected = [(0, 40_000, 1)] if len(words) == 40_000 else brute_runs(words)
        assert [tuple(r) for r in row.runs] == expected
        assert row.n_words == len(words)
        assert row.collapsed == ("word" if expected else " ".join(words))
    assert P.find_runs(odd.limit(0), "text").collect() == []


def test_words_stand_between_ascii_white_space_only(spark):
    text = "".join(f"a{chr(c)}" for c in [*range(1, 256), 0x2003, 0x3000])
    row = P.find_runs(spark.createDataFrame([(text,)], "t string"), "t").first()
    assert row.n_words == len(re.findall(r"[^\x20\x09-\x0D]+", text))


def test_long_words_of_equal_checksums(spark):
    """Thue-Morse words collide under sums of powers; words are compared by what they are."""
    a, b = (("ab", "ba")[k] for k in (0, 1))
    for _ in range(10):
        a, b = a + b, b + a
    row = P.find_runs(spark.createDataFrame([(" ".join([a, b] * 2 + [a] * 6),)], "t string"), "t").first()
    assert [tuple(r) for r in row.runs] == brute_runs([a, b] * 2 + [a] * 6)
