"""The registered queries of this subpackage, one per operator, and the SQL they must agree with."""

from __future__ import annotations

import os
import secrets
import zlib
from collections.abc import Callable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, languages, line_cleaning, near_duplicates, periodic_runs, pieces, preferences, pseudonyms, quality_model, range_coder, simhash, token_files, url_trees, whitening
from millrace.llm.frames import held_out_remainder
from millrace.session import new_path, setting

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def importable(spark: SparkSession) -> None:
    """Lets Python workers on this machine import the package; on a cluster it comes with ``--py-files``."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)


def registered(build):
    def plan(spark: SparkSession, folder: str) -> DataFrame:
        importable(spark)
        return build(spark, folder)

    QUERIES[build.__name__] = plan
    return plan


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@registered
def op7_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    blocks = decontamination.automata(table(spark, folder, "benchmark"))
    found = decontamination.find_matches(documents, "text", blocks, drop=("text",))
    hit = F.aggregate("hit_words", F.lit(0).cast("long"), lambda n, r: n + r["stop"] - r["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit_items", ",").cast("binary"), 256).alias("items_sha256"), (hit > 0).alias("contaminated"))


SQL["op7_decontaminate"] = r"""
WITH item_words AS (
    SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
    SELECT DISTINCT item, list_aggregate(w[p:p + 9], 'string_agg', ' ') AS gram, least(len(w), 10) AS size
    FROM item_words, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0),
doc_words AS (
    SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
    FROM documents),
sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
    SELECT row, p, size, list_aggregate(w[p:p + size - 1], 'string_agg', ' ') AS gram
    FROM doc_words, sizes, unnest(range(1, len(w) - size + 2)) AS t(p)),
matched AS (SELECT d.row, d.p, d.size, i.item FROM doc_windows d JOIN item_windows i USING (gram, size)),
hit AS (
    SELECT row, count(DISTINCT q) AS n_hit FROM (SELECT DISTINCT row, p, size FROM matched), unnest(range(p, p + size)) AS t(q)
    GROUP BY row),
items AS (
    SELECT row, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT row, item FROM matched WHERE item IS NOT NULL) GROUP BY row)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit USING (row) LEFT JOIN items USING (row)
"""


@registered
def op5_line_cleaning(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    return line_cleaning.judge_lines(documents, "text", with_text=False)


@registered
def op10_language_spans(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text", "lang")
    documents = documents.withColumn("held_out", held_out_remainder(documents, "doc_id", 5) == 0)
    model = languages.learn(documents.where(~F.col("held_out")), "doc_id", "text", "lang")
    found = languages.identify(documents.drop("lang"), "text", model, spans=False, drop=("text",))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def quality_of_documents(spark: SparkSession, folder: str, documents: DataFrame) -> quality_model.QualityModel:
    """Model learned from the labels of two thirds of the ids, the others being held out."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    learning = held_out_remainder(labels, "doc_id", 3) != 1
    return quality_model.learn(documents, "doc_id", "text", labels, "doc_id", "quality", learning)


@registered
def op9_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_of_documents(spark, folder, documents)
    scored = quality_model.score(documents, "text", model, drop=("text",))
    return scored.select("doc_id", (held_out_remainder(scored, "doc_id", 3) == 1).alias("held_out"), "score", "predicted")


#: Where a session keeps the key of its pseudonyms.
KEY_SETTING = "spark.millrace.pseudonym.key"


@cache
def _random_key(application: str) -> bytes:
    return secrets.token_bytes(32)


def pseudonym_key(spark: SparkSession) -> bytes:
    """The session's key; where none is set a random one, so that no pseudonym can be turned back by who reads this code.

    With a random key equal values are linked within one application only.
    """
    key = setting(spark, KEY_SETTING)
    return key.encode() if key else _random_key(spark.sparkContext.applicationId)


@registered
def op2_pseudonyms(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    made = pseudonyms.pseudonymise(documents, "text", pseudonym_key(spark))
    return made.withColumn("n_replaced", F.size("pii_kinds").cast("long"))


@registered
def op1_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, folder, "documents"), "doc_id", "text")


#: Where a session keeps the path of its SentencePiece model.
MODEL_SETTING = "spark.millrace.sentencepiece.model"


def piece_model(spark: SparkSession) -> pieces.PieceModel:
    path = setting(spark, MODEL_SETTING)
    if not path:
        import public_tokenizers
        path = public_tokenizers.path("piece_bpe_32k.model")
    return pieces.load(path)


@registered
def op6_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    model = piece_model(spark)
    documents = table(spark, folder, "documents").select("doc_id", "text")
    encoded = pieces.encode(documents, "text", model, verified="round_trip", drop=("text",))
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), "token_ids", "round_trip")


#: Where a session keeps the path of its tokenizer.
TOKENIZER_SETTING = "spark.millrace.tokenizer"
END_ID = 2


def tokenizer_path(spark: SparkSession) -> str:
    path = setting(spark, TOKENIZER_SETTING)
    if not path:
        import public_tokenizers
        path = public_tokenizers.path("word_bpe_49k.json")
    return path


def _digest(doc_ids: pa.Array, starts: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> list[pa.Array]:
    stops = np.cumsum(sizes)
    sums = [range_coder.checksum(ids[b - n:b]) for b, n in zip(stops.tolist(), sizes.tolist(), strict=True)]
    return [doc_ids, pa.array(starts, pa.int64()), pa.array(sizes, pa.int64()), pa.array(sums, pa.int64())]


@registered
def op3_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "token-files")
    token_files.write(table(spark, folder, "documents"), "doc_id", "text", path, tokenizer_path(spark), END_ID)
    blocks = token_files.read_blocks(spark, path)
    return token_files.documents(blocks, "doc_id long, start long, n_tokens long, ids_crc32 long", _digest)


@registered
def op4_preferences(spark: SparkSession, folder: str) -> DataFrame:
    whole = preferences.conversations(table(spark, folder, "conversations"), "conv_id", "turn", "role", "text")
    made = preferences.format_pairs(preferences.sibling_and_echo_pairs(whole), "chosen", "rejected")

    def shown(ranges: str):
        return F.array_join(F.transform(ranges, lambda r: F.concat_ws("-", r["start"], r["stop"])), ",")

    return made.select(F.col("conversation").alias("conv_id"), "kind", "prompt_turns", "prompt", "chosen_completion",
                       shown("chosen_ranges").alias("chosen_ranges"), "rejected_completion",
                       shown("rejected_ranges").alias("rejected_ranges"), "usable")


SQL["op4_preferences"] = r"""
WITH turns AS (
    SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
whole AS (
    SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns
    FROM turns GROUP BY conv_id),
lead AS (
    SELECT turns[1] AS opening, arg_min(turns, conv_id) AS lead FROM whole GROUP BY turns[1] HAVING count(*) > 1),
placed AS (
    SELECT conv_id, turns, lead, coalesce(lead <> turns, false) AS sibling,
           coalesce(list_max([i FOR i IN range(1, len(turns) + 1) IF turns[i].role = 'assistant']), 0) AS place
    FROM whole LEFT JOIN lead ON whole.turns[1] = lead.opening),
pairs AS (
    SELECT conv_id, CASE WHEN sibling THEN 'sibling' ELSE 'echo' END AS kind,
           CASE WHEN sibling THEN lead ELSE turns END AS c,
           CASE WHEN sibling THEN turns ELSE [CASE WHEN i = place THEN {'role': turns[i].role, 'text': turns[i - 1].text}
                                                   ELSE turns[i] END FOR i IN range(1, len(turns) + 1)] END AS r
    FROM placed WHERE sibling OR place > 1),
cut AS (
    SELECT *, CAST(coalesce(list_min([i FOR i IN range(1, least(len(c), len(r))) IF c[i] IS DISTINCT FROM r[i]]) - 1,
                            greatest(least(len(c), len(r)) - 1, 0)) AS INTEGER) AS prompt_turns FROM pairs),
shown AS (
    SELECT conv_id, kind, prompt_turns, sides.side, sides.t AS t, sides.first AS first
    FROM cut, unnest([{'side': 'p', 't': c[1:prompt_turns], 'first': 0}, {'side': 'c', 't': c[prompt_turns + 1:], 'first': 0},
                      {'side': 'r', 't': r[prompt_turns + 1:], 'first': 0}]) AS s(sides)),
texts AS (
    SELECT conv_id, kind, prompt_turns, side, [x.role FOR x IN t] AS roles,
        ['<|im_start|>' || replace(replace(coalesce(x.role, 'unknown'), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')
         || chr(10) FOR x IN t] AS heads,
        [replace(replace(coalesce(x.text, ''), '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')
         || '<|im_end|>' || chr(10) FOR x IN t] AS tails
    FROM shown),
marked AS (
    SELECT conv_id, kind, prompt_turns, side,
        coalesce(array_to_string([heads[i] || tails[i] FOR i IN range(1, len(heads) + 1)], ''), '') AS body,
        coalesce(array_to_string([
            CAST(coalesce(list_sum([len(heads[j]) + len(tails[j]) FOR j IN range(1, i)]), 0) + len(heads[i]) AS BIGINT)::VARCHAR || '-' ||
            CAST(coalesce(list_sum([len(heads[j]) + len(tails[j]) FOR j IN range(1, i + 1)]), 0) AS BIGINT)::VARCHAR
            FOR i IN range(1, len(heads) + 1) IF roles[i] = 'assistant'], ','), '') AS ranges
    FROM texts)
SELECT conv_id, kind, prompt_turns, p.body AS prompt, c.body AS chosen_completion, c.ranges AS chosen_ranges,
       r.body AS rejected_completion, r.ranges AS rejected_ranges, c.ranges <> '' AND r.ranges <> '' AND c.body <> r.body AS usable
FROM (SELECT * FROM marked WHERE side = 'p') p JOIN (SELECT conv_id, body, ranges FROM marked WHERE side = 'c') c USING (conv_id)
JOIN (SELECT conv_id, body, ranges FROM marked WHERE side = 'r') r USING (conv_id)
"""


RULES = [url_trees.Rule("com", "/", "allow"), url_trees.Rule("example.com", "/en/", "block"),
         url_trees.Rule("www.example.com", "/en/", "allow"), url_trees.Rule("net", "/es/", "block"),
         url_trees.Rule("net", "/fr/", "block")]


@registered
def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    pages = table(spark, folder, "pages").select("page_id", "url")
    model = url_trees.train(url_trees.labelled_by_rules(pages, "url", RULES), "url", "blocked")
    return url_trees.judge(pages, "url", RULES, model).select("page_id", "host", "path", "rule", "verdict")


@registered
def op11_whitening(spark: SparkSession, folder: str) -> DataFrame:
    embeddings = table(spark, folder, "embeddings").select("vec_id", "embedding")
    model = whitening.fit(embeddings, "embedding", most=4)
    made = whitening.whiten(embeddings, "embedding", model, drop=("embedding",)).where("whitened is not null")
    each = made.select("vec_id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    explained = F.array(*[F.lit(share) for share in model.explained]).cast("array<double>")
    return each.select("vec_id", (F.col("place") + 1).alias("component"), F.lit(model.size).cast("long").alias("n"), "deviation",
                       "whitened", explained[F.col("place")].alias("explained"), F.lit(model.identity_error).alias("identity_error"))


def with_planted_runs(batch: pa.RecordBatch) -> pa.Array:
    """The texts of a batch, a tenth of them (by the crc32 of ``doc_id``) made to repeat from some word on."""
    texts = batch.column("text").to_pylist()
    for i, doc_id in enumerate(batch.column("doc_id").to_pylist()):
        if doc_id is None or not texts[i]:
            continue
        draw = zlib.crc32(str(doc_id).encode())
        if draw % 10 == 0 and (words := texts[i].encode().split()):
            n, g = len(words), draw // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            texts[i] = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)]).decode()
    return pa.array(texts, pa.large_string())


@registered
def op12_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents").select("doc_id", "text")
    found = periodic_runs.find_runs(documents, "text", prepare=with_planted_runs, drop=("text",))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    best = found.withColumn("best", F.array_max(order))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))


@registered
def op13_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), "doc_id", "text")
