"""Language identification and the quality classifier: held-out accuracy, brute force for their parts, edges."""

from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import languages, quality_model
from millrace.llm.workload import QUERIES, quality_of_documents

FOLDER = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def test_languages_of_held_out_documents(spark, docs):
    found = QUERIES["op10_language_spans"](spark, FOLDER).join(docs.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n, low, high = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*"), F.min("score"), F.max("score")).first()
    assert right >= 0.97 and n > 150 and 0 <= low <= high <= 1


@pytest.mark.parametrize("seed", range(15))
def test_viterbi_finds_the_best_labelling(seed):
    draw = np.random.default_rng(seed)
    sizes = draw.integers(0, 6, 4)
    scores = draw.normal(0, 3, (sizes.sum(), 3)).astype(np.float32)
    begins = np.concatenate([[0], np.cumsum(sizes)])
    found = languages.viterbi(scores, begins, 2.0)
    for a, b in zip(begins, begins[1:]):
        def total(labels):
            return sum(scores[a + i, l] for i, l in enumerate(labels)) - 2.0 * sum(x != y for x, y in itertools.pairwise(labels))

        best = max(itertools.product(range(3), repeat=int(b - a)), key=total)
        assert abs(total(best) - total(found[a:b])) < 1e-4


def test_spans_of_mixed_text_and_edges(spark, docs, odd):
    model = languages.learn(docs, "doc_id", "text", "lang")
    text = "The and of this was that heoning. Der die und ungenich schlich verbe einkeit."
    mixed = languages.identify(spark.createDataFrame([(text,)], "text string"), "text", model).first()
    assert [(s.lang, text[s.start:s.stop].split()[0]) for s in mixed.lang_spans] == [("en", "The"), ("de", "Der")]
    rows = languages.identify(odd, "text", model).collect()
    assert {r.lang_pred for r in rows if r.text in (None, "", " ", "\n\n", "…—")} == {"und"}
    assert all(r.score == 0 for r in rows if r.lang_pred == "und")
    nothing = languages.learn(docs.limit(0), "doc_id", "text", "lang")
    assert {r.lang_pred for r in languages.identify(odd, "text", nothing).collect()} == {"und"}
    assert languages.identify(odd.limit(0), "text", model).count() == 0


def test_letters_are_counted_and_not_bytes(spark):
    """19 Latin letters outweigh 16 Cyrillic ones, though these take 32 bytes; dashes and quotes count nothing."""
    rows = [(i, "привет мир как дела", "ru") for i in range(20)] + [(100 + i, "hello world how are you", "en") for i in range(20)]
    model = languages.learn(spark.createDataFrame(rows, "id long, text string, lang string"), "id", "text", "lang")
    text = "hello world how are you" + " — “” … " * 5 + "привет мир как дела"
    row = languages.identify(spark.createDataFrame([(text,)], "text string"), "text", model, penalty=0.5).first()
    assert row.lang_pred == "en" and abs(row.score - 19 / 35) < 1e-9
    flags = np.diff(languages._letters(np.frombuffer("aZ1é—字😀ß".encode(), np.uint8)))
    assert flags.sum() == 5


def plain_prediction(text, model, penalty=12.0, floor=8.0):
    """Language and score of one text, word by word and byte run by byte run in plain Python."""
    data = (text or "").encode()
    small = bytes(c + 32 if 65 <= c <= 90 else c for c in data)
    words, at = [], 0
    while at < len(data):
        stop = at
        while stop < len(data) and (97 <= small[stop] <= 122 or small[stop] >= 128):
            stop += 1
        if stop > at:
            words.append((at, stop))
        at = stop + 1
    best, letters = [], []
    for a, b in words:
        (part,) = languages.slices(languages.pa.array([text]))
        word = bytearray(b"\0" + small[a:b] + b"\0")
        for i in range(2, len(word)):
            if 0x80 <= word[i] <= 0x9E and word[i] != 0x97 and word[i - 1] == 0xC3:
                word[i] += 32
        total = np.zeros(len(model.languages), np.float32)
        for order, length in enumerate(languages.RUN_SIZES):
            runs = [word[i:i + length] for i in range(max(1, len(word) - length + 1))]
            for run in runs:
                value = int.from_bytes(bytes(run).ljust(length, b"\0"), "big")
                place = int(languages.mixed(np.array([value], np.uint64))[0] % np.uint64(model.buckets)) + order * model.buckets
                total += model.table[place]
        script = int(languages._scripts(part.data, np.array([a]))[0])
        allowed = model.scripts[script] if model.scripts[script].any() else np.ones(len(model.languages), bool)
        total = np.where(allowed, total, -np.inf)
        best.append(np.maximum(total - total.max(), np.where(allowed, -floor, -2 * floor)))
        letters.append(sum(c.isalpha() for c in data[a:b].decode()))
    if not sum(letters):
        return "und", 0.0
    scores, back = best[0], []
    for step in best[1:]:
        top = int(scores.argmax())
        stay = scores >= scores[top] - penalty
        back.append([i if stay[i] else top for i in range(len(scores))])
        scores = np.where(stay, scores, scores[top] - penalty) + step
    label = int(scores.argmax())
    path = [label]
    for links in reversed(back):
        path.append(links[path[-1]])
    share = np.bincount(path[::-1], letters, len(model.languages))
    return model.languages[int(share.argmax())], float(share.max() / share.sum())


def test_predictions_agree_with_plain_python(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text", "lang")
    model = languages.learn(docs, "doc_id", "text", "lang")
    found = {r.doc_id: (r.lang_pred, r.score) for r in languages.identify(docs, "text", model, spans=False).collect()}
    for row in docs.collect():
        if len(row.text or "") < 3_000:
            name, score = plain_prediction(row.text, model)
            assert found[row.doc_id][0] == name and abs(found[row.doc_id][1] - score) < 1e-6, row.doc_id


def test_scripts_narrow_candidates(spark):
    rows = [(i, "привет мир как дела", "ru") for i in range(20)] + [(100 + i, "hello world how are you", "en") for i in range(20)]
    model = languages.learn(spark.createDataFrame(rows, "id long, text string, lang string"), "id", "text", "lang")
    texts = spark.createDataFrame([("совсем другое",), ("quite another",)], "text string")
    assert [r.lang_pred for r in languages.identify(texts, "text", model, spans=False).collect()] == ["ru", "en"]


def test_every_language_is_learned_whatever_the_sample(spark):
    hot = spark.range(20_000).selectExpr("id", "'hello world how are you' as text", "'en' as lang")
    few = spark.range(20_000, 20_006).selectExpr("id", "'quelle heure est il maintenant' as text", "'fr' as lang")
    model = languages.learn(hot.union(few), "id", "text", "lang", sample_rows=40)
    assert model.languages == ["en", "fr"] and model.scripts[0].all()
    texts = spark.createDataFrame([("hello you",), ("quelle heure",)], "text string")
    assert [r.lang_pred for r in languages.identify(texts, "text", model, spans=False).collect()] == ["en", "fr"]
    one = languages.learn(few, "id", "text", "lang", sample_rows=1_000)
    assert np.allclose(model.table[:, 1], one.table[:, 0]), "all rows of the small language teach"


def test_rows_each_language_may_give():
    assert languages.rows_each([20_000, 6], 40) == 34
    assert languages.rows_each([5, 3, 9], 17) == 9
    assert languages.rows_each([100, 100, 2], 62) == 30
    assert languages.rows_each([7, 7, 7], 2) == 1
    assert languages.rows_each([], 40) == 0


def test_quality_of_held_out_documents(spark):
    found = QUERIES["op9_quality_classifier"](spark, FOLDER).join(
        spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in found]) >= 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)


def test_isotonic_is_the_best_non_decreasing_fit():
    places, good, count = np.arange(6.0), np.array([1, 0, 2, 1, 3, 4.0]), np.array([2, 1, 3, 4, 3, 4.0])
    knots, levels = quality_model.isotonic(places, good, count)
    assert (np.diff(levels) > 0).all()
    # pool adjacent violators by hand: (1/2, 0/1) -> 1/3; (2/3, 1/4) -> 3/7; then 1, 1 stay one step
    assert np.allclose(levels, [1 / 3, 3 / 7, 1]) and np.allclose(knots, [1 / 3, 18 / 7, 32 / 7])


def test_features_approximate_a_gaussian_kernel():
    draw = np.random.default_rng(0)
    k, width = 4, 0.5
    model = quality_model.QualityModel(np.zeros(k), np.ones(k), draw.normal(0, width, (k, 8000)), draw.uniform(0, 2 * np.pi, 8000),
                                       np.zeros(8001), np.empty(0), np.empty(0))
    x, y = draw.normal(size=(2, 5, k))
    near = model.features(x)[:, :-1] @ model.features(y)[:, :-1].T
    truth = np.exp(-0.5 * width ** 2 * ((x[:, None] - y[None]) ** 2).sum(axis=2))
    assert np.abs(near - truth).max() < 0.06


def test_quality_edges(spark, docs, odd):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    model = quality_model.learn(docs, "doc_id", "text", labels, "doc_id", "quality")
    rows = quality_model.score(odd, "text", model).collect()
    assert len(rows) == 13 and all(0 <= r.score <= 1 for r in rows)
    none = quality_model.learn(docs, "doc_id", "text", labels.limit(0), "doc_id", "quality")
    assert {r.score for r in quality_model.score(odd, "text", none).collect()} == {0.5}
    one = quality_model.learn(docs, "doc_id", "text", labels.where("quality = 1"), "doc_id", "quality")
    assert {r.predicted for r in quality_model.score(odd, "text", one).collect()} == {1}
    assert quality_model.score(odd.limit(0), "text", model).count() == 0
    assert quality_of_documents(spark, FOLDER, docs.limit(0)).score(np.zeros((1, len(quality_model.STATISTICS)))) == [0.5]
