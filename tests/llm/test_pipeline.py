from __future__ import annotations

import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

import __spark_entry__ as contract
import corpus_pipeline as C
from millrace.llm import decontamination, pseudonyms
from millrace.llm.workload import KEY_SETTING, QUERIES, SQL, pseudonym_key, quality_of_documents
from millrace.llm.quality_model import _statistics_of
from millrace.session import stage
from tests.conftest import bag
from tests.llm.test_near_duplicates import brute_classes
from tools.compare import compare, oracle

FOLDER = "/root/testdata/sf0.001"
KEY = "a key of these tests"


@pytest.fixture(autouse=True)
def key_of_pseudonyms(spark):
    spark.conf.set(KEY_SETTING, KEY)
    yield
    spark.conf.unset(KEY_SETTING)


def test_stages_against_brute_force(spark, documents):
    docs = documents
    kept = []
    for name, work in C.STAGES:
        after = stage(work(spark, docs, FOLDER), "test")
        if name != C.STAGES[-1][0]:
            assert after.columns == documents.columns and after.schema == docs.schema
        kept.append((docs, after))
        docs = after
    texts = [{r.doc_id: r.text for r in before.collect()} for before, _ in kept]

    model = quality_of_documents(spark, FOLDER, documents)
    scores = model.score(_statistics_of(C.pieces.pa.array(list(texts[0].values()))))
    assert texts[1] == {k: v for (k, v), s in zip(texts[0].items(), scores, strict=True) if s >= 0.5}
    classes = brute_classes(list(texts[1].items()))
    assert texts[2] == {k: v for k, v in texts[1].items() if classes[k] == k}

    def words(text):
        return re.findall(rb"[0-9a-z\x80-\xff]+", bytes(c + 32 if 65 <= c <= 90 else c for c in text.encode()))

    runs = set()
    for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect():
        w = words(r.text)
        runs |= {tuple(w[i:i + 10]) for i in range(len(w) - 9)}

    def hit(text):
        w = words(text)
        return any(tuple(w[i:i + 10]) in runs for i in range(len(w) - 9))

    assert any(hit(t) for t in texts[2].values()) and not any(hit(t) for t in texts[3].values())
    assert all(texts[3][k] == t for k, t in texts[2].items() if not hit(t))
    permute = pseudonyms.Permutation(KEY.encode())
    assert texts[4] == {k: pseudonyms.replaced(t, permute)[0] for k, t in texts[3].items()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.token_ids for r in docs.collect()} == {k: library.encode(t) for k, t in texts[4].items()}
    assert all(r.n_chars == len(r.text) for before, _ in kept for r in before.collect())


def test_stages_take_odd_tables(spark, odd):
    docs = odd
    for name, work in C.STAGES[1:]:
        after = stage(work(spark, docs, FOLDER), "test")
        if name != C.STAGES[-1][0]:
            assert after.columns == odd.columns
        docs = after
    assert docs.where("doc_id is null").count() == 1 and docs.count() == 12  # of the two rows of id 11 one stays
    assert C.quality(spark, odd, FOLDER).columns == odd.columns
    for _, work in C.STAGES:
        assert work(spark, odd.limit(0), FOLDER).count() == 0


def test_of_rows_of_one_id_the_smallest_text_stays(spark):
    schema = "doc_id long, text string, lang string"
    rows = [(1, "zebra one two three four five", "b"), (1, "apple one two three four five six", "c"), (1, "apple one two three four five six", "a"),
            (2, "something else that stands alone here", "x"), (2, None, "y"), (3, None, "q"), (3, None, None)]
    for order in (rows, rows[::-1]):
        docs = spark.createDataFrame(order, schema).repartition(3)
        assert sorted(map(tuple, C.near_dedup(spark, docs, FOLDER).collect())) == [
            (1, "apple one two three four five six", "a"), (2, "something else that stands alone here", "x"), (3, None, "q")]


def _sent(plan, name):
    """Rows that the exchanges of an executed plan sent, of those with a column of that name."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        return _sent(plan.executedPlan(), name)
    if kind.endswith("QueryStageExec"):
        return _sent(plan.plan(), name)
    below = plan.children()
    rows = sum(_sent(below.apply(i), name) for i in range(below.size()))
    output = plan.output()
    if kind == "ShuffleExchangeExec" and name in [output.apply(i).name() for i in range(output.size())]:
        rows += plan.metrics().apply("shuffleRecordsWritten").value()
    return rows


def test_dedup_sends_no_text_of_documents_that_are_no_copies(spark):
    alone = [(i, " ".join(f"w{i}x{j}" for j in range(8))) for i in range(400)]
    copies = [(1000 + i, alone[i][1]) for i in range(20)]
    docs = stage(spark.createDataFrame([*alone, *copies, (None, alone[0][1]), (None, None)], "doc_id long, text string"), "test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = C.near_dedup(spark, docs, FOLDER)
        assert bag(kept) == Counter([*alone, (None, alone[0][1]), (None, None)])
        assert 20 <= _sent(kept._jdf.queryExecution().executedPlan(), "text") <= 40
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_without_a_key_a_random_one_is_used(spark, documents):
    spark.conf.unset(KEY_SETTING)
    assert len(pseudonym_key(spark)) == 32 and pseudonym_key(spark) == pseudonym_key(spark)
    spark.conf.set(KEY_SETTING, KEY)
    assert pseudonym_key(spark) == KEY.encode()


def test_encoding_turns_its_ids_back(spark, documents):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = documents.limit(50).selectExpr("doc_id", "text", "n_chars", "'mine' as round_trip")
    made = {r.doc_id: r for r in C.encode(spark, docs, FOLDER).collect()}
    before = {r.doc_id: r.text for r in docs.collect()}
    assert made.keys() == before.keys()
    for doc, text in before.items():
        assert made[doc].round_trip == (library.decode(made[doc].token_ids) == text)


def test_registered_queries(spark):
    names = [n for n in contract.queries() if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in names) == list(range(1, 14))
    assert "pipeline" in contract.queries() and SQL.keys() <= contract.oracle_sql().keys()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_agrees_with_its_sql(spark, name):
    with oracle(FOLDER) as connection:
        rows, difference = compare(QUERIES[name](spark, FOLDER), connection, SQL[name])
    assert difference is None and rows
