from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import range_coder as R
from millrace.llm import token_files
from millrace.llm.workload import QUERIES, _digest
from millrace.session import new_path

PATH = public_tokenizers.path("word_bpe_49k.json")
FIELDS = "doc_id long, start long, n_tokens long, ids_crc32 long"


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2 ** 32 - 1) | st.integers(0, 6), max_size=300), max_size=8))
def test_blocks_turn_back(blocks):
    arrays = [np.array(b, np.uint32) for b in blocks]
    assert [a.tolist() for a in R.decode(R.encode(arrays))] == blocks


def test_long_and_predictable_blocks():
    draw = np.random.default_rng(2)
    blocks = [np.full(9000, 49407), np.arange(9000), draw.integers(0, 50_000, 9000), np.tile([5, 9, 9, 1], 2000),
              np.minimum(draw.geometric(0.02, 9000), 40_000)]
    coded = R.encode([b.astype(np.uint32) for b in blocks])
    assert all((a == b).all() for a, b in zip(blocks, R.decode(coded)))
    bits = [len(c.payload) * 8 / c.size for c in coded]
    assert bits[0] < 0.2 and bits[3] < 0.3 and bits[4] < 8


def test_each_block_can_be_read_alone_and_damage_is_found():
    blocks = [np.arange(500, dtype=np.uint32) % 17, np.arange(300, dtype=np.uint32) % 5]
    coded = R.encode(blocks)
    assert (R.decode(coded[1:])[0] == blocks[1]).all()
    payload = bytearray(coded[0].payload)
    payload[len(payload) // 2] ^= 64
    with pytest.raises(ValueError):
        R.decode([coded[0]._replace(payload=bytes(payload))])


def expected(rows, apart=True):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(PATH)
    at, out = 0, []
    for doc, text in rows:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        out.append((doc, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_query_equals_the_library(spark):
    folder = "/root/testdata/sf0.01"
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in documents.select("doc_id", "text").collect())
    assert sorted(tuple(r) for r in QUERIES["op3_token_files"](spark, folder).collect()) == expected(rows)


@pytest.mark.parametrize("apart", [True, False])
def test_documents_longer_than_blocks_and_odd_ones(spark, odd, monkeypatch, apart):
    path = new_path(spark, "tokens")
    extra = spark.createDataFrame([(50, "Said <|endoftext|> and <|STARTOFTEXT|> don't We'LL é́ Σας"), (51, "x")], "doc_id long, text string")
    docs = odd.select("doc_id", "text").union(extra).repartition(3)
    token_files.write(docs, "doc_id", "text", path, PATH, 2, apart=apart)
    found = token_files.documents(token_files.read_blocks(spark, path), FIELDS, _digest).collect()
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    assert sorted((tuple(r) for r in found), key=lambda r: r[1]) == expected(rows)


def test_empty_table(spark, odd):
    path = new_path(spark, "tokens")
    token_files.write(odd.limit(0), "doc_id", "text", path, PATH, 2)
    assert token_files.documents(token_files.read_blocks(spark, path), FIELDS, _digest).count() == 0


def test_blocks_in_sections_do_not_depend_on_their_group():
    draw = np.random.default_rng(5)
    sizes = [R.BLOCK, 1, R.SECTION, R.SECTION + 1, 40_000, 65_535, 3_000, 9_001]
    blocks = [np.minimum(draw.geometric(0.003, n), 40_000).astype(np.uint32) for n in sizes]
    coded = R.encode(blocks)
    assert all((a == b).all() for a, b in zip(blocks, R.decode(coded), strict=True))
    assert [R.encode([b])[0] for b in blocks] == coded
    assert all((R.decode([c])[0] == b).all() for b, c in zip(blocks, coded, strict=True))


def test_models_learn_from_many_places_at_a_time(monkeypatch):
    calls = []
    monkeypatch.setattr(R._Group, "learn", lambda self, *a, real=R._Group.learn: calls.append(a[0]) or real(self, *a))
    block = np.minimum(np.random.default_rng(6).geometric(0.01, 8192 * 4), 5000).astype(np.uint32)
    coded = R.encode([block])
    assert (R.decode(coded)[0] == block).all()
    assert len(calls) < len(block) / 100


def test_words_are_the_same_by_their_bytes_only(monkeypatch):
    monkeypatch.setattr(token_files, "_hashed", lambda letters, length: np.zeros(len(length), np.uint64))
    memory, draw = token_files.KnownWords(400), np.random.default_rng(7)
    asked = 0

    def encode_of(words):
        def encode(numbers):
            nonlocal asked
            asked += len(numbers)
            ids = [list(words[i]) for i in reversed(numbers.tolist())]  # any order will do
            size = np.array([len(i) for i in ids])
            return np.array(sum(ids, []), np.uint32), (np.cumsum(size) - size)[::-1], size[::-1]
        return encode

    for _ in range(30):
        words = list({bytes(draw.integers(97, 100, draw.choice([1, 2, 3, 4, 64, 65, 90])).astype(np.uint8)) for _ in range(60)})
        bounds = np.concatenate([[0], np.cumsum([len(w) for w in words])])
        at = memory.places(np.frombuffer(b"".join(words), np.uint8), bounds, encode_of(words))
        assert [memory.flat[s:s + n].tolist() for s, n in zip(memory.start[at], memory.size[at], strict=True)] == [list(w) for w in words]
    assert asked < 30 * 50


def test_new_words_are_encoded_together_as_alone():
    draw = np.random.default_rng(8)
    letters = [*"abzAZ09.,'!<|>#İΣςẞéﬁ漢한😀", "'s", "\0", "\x1c", "\u0301", "\u00a0", "\u3000", "\u200d"]
    texts = ["".join(draw.choice(letters, draw.integers(1, 9))) for _ in range(2000)]
    remembered = token_files.RememberedWords(PATH)
    plain = [t for t in (t.encode("ascii", "ignore").decode().lower().replace("\0", "").replace("\x1c", "") for t in texts) if t]
    for encode, some in ((remembered.encoded_words, texts), (remembered.encoded_plain, [*plain, "don't", "x" * 100, "<|endoftext|>a"])):
        flat, size = encode(some)
        alone, sizes = remembered.encoded(some)
        assert flat.tolist() == alone.tolist() and size.tolist() == sizes.tolist()
    remembered.length[:] = 1  # tokens whose lengths say nothing
    assert [a.tolist() for a in remembered.encoded_plain(plain)] == [a.tolist() for a in remembered.encoded_words(plain)]
