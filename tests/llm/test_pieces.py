from __future__ import annotations

import tracemalloc

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from sentencepiece import sentencepiece_model_pb2

from millrace.llm import pieces as M

PATH = public_tokenizers.path("piece_bpe_32k.model")


def proto(kind):
    made = sentencepiece_model_pb2.ModelProto()
    with open(PATH, "rb") as file:
        made.ParseFromString(file.read())
    made.trainer_spec.model_type = kind
    if kind == M.UNIGRAM:
        for p in made.pieces:
            p.score = max(p.score, -40_000.0)
    return made


@pytest.fixture(scope="module", params=[M.BPE, M.UNIGRAM])
def both(request):
    made = proto(request.param)
    return M.from_proto(made), sentencepiece.SentencePieceProcessor(model_proto=made.SerializeToString())


def encoded(model, texts):
    out = []
    for flat, sizes in M.Encoder(model)(pa.array(texts, pa.string())):
        stops = sizes.cumsum()
        out += [flat[b - n:b].tolist() for b, n in zip(stops, sizes, strict=True)]
    return out


TEXTS = ["", " ", "     ", "  a\n\tb  c😀 ", "▁a", "a" * 100, "日本語のテキスト、これは長い文です。", "é́x <s> </s> <0x41>", "x  y   z    ",
         "def f(x):\n        return   x+1", "a\x00b", "Ünïcödé 한국어 русский текст", "the" * 50, "   leading", "x" * 5000]


def test_odd_texts(both):
    model, library = both
    assert encoded(model, TEXTS) == library.encode(TEXTS)


@settings(max_examples=60, deadline=None)
@given(texts=st.lists(st.text(alphabet="theinr ▁aé日\n", max_size=40), max_size=5))
def test_any_text(both, texts):
    model, library = both
    assert encoded(model, texts) == library.encode(texts)


def test_documents_turn_back(spark, both):
    model, library = both
    documents = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    made = M.decode(M.encode(documents, "text", model, verified="same"), "token_ids", model, "back")
    rows = made.collect()
    assert all(r.text == r.back and r.same for r in rows)
    assert [r.token_ids for r in rows] == library.encode([r.text for r in rows])


def test_decoding_equals_the_library():
    model, library = M.load(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    for ids in ([], [28705], [264, 3, 200, 13], [1, 264, 2], [0, 264], [230, 160], [28705, 28705, 264]):
        flat, sizes = M.np.array(ids, M.np.int64), M.np.array([len(ids)])
        assert M.decoded(model, flat, sizes)[0].as_py() == library.decode(ids), ids


def test_bytes_that_are_cut_off_decode_as_in_the_library():
    """Every first byte with every way to go on: one to four bytes, valid or cut off, between letters."""
    model, library = M.load(PATH), sentencepiece.SentencePieceProcessor(model_file=PATH)
    byte = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
    tails = [[], [0x80], [0xBF], [0x90], [0x9F, 0x80], [0xA0, 0x80], [0x8F, 0xBF], [0x90, 0x80, 0x80], [0x80, 0x80, 0x80], [0xC3], [0x41]]
    for head in range(0x80, 0x100):
        for tail in tails:
            for ids in ([byte[b] for b in (head, *tail)], [264, *(byte[b] for b in (head, *tail)), 264]):
                flat, sizes = M.np.array(ids, M.np.int64), M.np.array([len(ids)])
                assert M.decoded(model, flat, sizes)[0].as_py() == library.decode(ids), (head, tail)


def test_words_with_several_ranks_out_of_order():
    """A model whose pieces need later pieces: merging is done plainly, and still equals the library."""
    made = proto(M.BPE)
    for piece in made.pieces:
        if piece.piece == "the":
            piece.score = -1.5
    model = M.from_proto(made)
    library = sentencepiece.SentencePieceProcessor(model_proto=made.SerializeToString())
    texts = ["the other theme breathes", "thethe then"]
    assert encoded(model, texts) == library.encode(texts)


def test_edges(spark, odd):
    model = M.load(PATH)
    rows = M.encode(odd, "text", model, verified="ok").collect()
    assert all(r.ok and isinstance(r.token_ids, list) for r in rows)
    assert [r.token_ids for r in rows if not r.text] == [[], []]
    assert M.decode(M.encode(odd.limit(0), "text", model), "token_ids", model).count() == 0
    nulls = spark.createDataFrame([(None,), ([],), ([264],)], "ids array<int>")
    assert [r.text for r in M.decode(nulls, "ids", model).collect()] == ["", "", "a"]
    made = proto(M.BPE)
    made.normalizer_spec.remove_extra_whitespaces = True
    with pytest.raises(ValueError):
        M.from_proto(made)


def test_memory_beside_a_large_batch_is_bounded(spark, monkeypatch):
    """What encoding and checking a batch takes does not grow with its rows; before, 2,048 rows took 67 MB and 512 took 30."""
    made = {}

    def run(df, fields, make, drop=(), rows=2048):
        made.update(work=make(), rows=rows)

    monkeypatch.setattr(M, "append", run)
    M.encode(spark.range(1), "text", M.load(PATH), verified="same")

    def peak(size):
        batch = pa.RecordBatch.from_arrays([pa.array(["some of the words come again\n" * 70] * size)], names=["text"])
        tracemalloc.start()
        for at in range(0, size, made["rows"]):
            ids, same = made["work"](batch.slice(at, made["rows"]))
            assert all(same.to_pylist())
        most = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        return most

    peak(16)
    assert peak(2048) < 2 * peak(512) and peak(2048) < 60 << 20


@pytest.mark.parametrize("gap, word", [(1, b"a"), (0, b"a"), (12, b"2\xff"), (3, b""), (1, b"")])
def test_keys_of_words_turn_back(gap, word):
    text = M.BLANK * gap + word.replace(b"\xff", b"\0").decode()
    assert M.Encoder._text(M.Encoder._key(gap, word)) == text
