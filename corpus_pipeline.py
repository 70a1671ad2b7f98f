"""From raw documents to token ids, in five stages.

    quality classifier      documents that it rejects go
    MinHash near-dedup      one document of each group of near-duplicates stays, the one with the smallest id
    benchmark decontamination   passages of the benchmark go, and documents that consist mostly of them
    PII                     validated personal data get pseudonyms
    SentencePiece           texts become token ids, which are turned back and compared

Every stage takes the session, the documents it works on and the folder of the tables. All but the
last return the columns of their documents, whatever these are; only ``text`` and ``n_chars``, the
number of its characters, change. Nulls, empty texts, repeated rows and empty tables pass as each
operator says; documents of a null id are kept by near-dedup, and of rows that share an id the one with the
smallest text stays.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import decontamination, near_duplicates, pieces, pseudonyms, quality_model
from millrace.llm.frames import quoted
from millrace.llm.workload import importable, piece_model, pseudonym_key, quality_of_documents, table
from millrace.session import stage


def _packed(docs: DataFrame) -> DataFrame:
    """``text`` beside one column with all others, so that no name can clash with an operator's results."""
    rest = [F.col(quoted(c)) for c in docs.columns if c != "text"]
    return docs.select("text", F.struct(*rest).alias("rest"))


def _unpacked(packed: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, with the number of characters of the text as it is now."""
    columns = []
    for name in docs.columns:
        column = F.col("text") if name == "text" else F.col("rest")[name]
        if name == "n_chars":
            column = F.coalesce(F.length("text").cast(docs.schema[name].dataType), column)
        columns.append(column.alias(name))
    return packed.select(*columns)


def _sorts(docs: DataFrame, name: str) -> bool:
    """Whether a column can be put in order, which maps cannot."""
    return "map<" not in docs.schema[name].dataType.simpleString() and "variant" not in docs.schema[name].dataType.simpleString()


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    model = quality_of_documents(spark, sf_dir, docs)
    scored = quality_model.score(_packed(docs), "text", model)
    return _unpacked(scored.where("predicted = 1"), docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    classes = stage(near_duplicates.near_duplicates(docs, "doc_id", "text"), "classes")
    kept = near_duplicates.without(docs, "doc_id", classes.where("doc_id <> class_id").select("doc_id"))
    repeated = classes.where("doc_id is not null").groupBy("doc_id").count().where("count > 1")
    if repeated.isEmpty():
        return kept
    named, nameless = kept.where("doc_id is not null"), kept.where("doc_id is null")
    # Of rows of one id the one with the smallest text stays, and of equal texts the smallest in the order of the columns.
    rest = [F.struct(F.col(quoted(c)).isNull(), F.col(quoted(c))) for c in docs.columns if c not in ("doc_id", "text") and _sorts(docs, c)]
    smallest = F.min_by(F.struct(*[quoted(c) for c in docs.columns]), F.struct(F.col("text").isNull(), "text", *rest)).alias("row")
    return named.groupBy("doc_id").agg(smallest).select("row.*").union(nameless)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    benchmark = table(spark, sf_dir, "benchmark")
    return _unpacked(decontamination.remove_matches(_packed(docs), "text", benchmark), docs)


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    importable(spark)
    return _unpacked(pseudonyms.pseudonymise(_packed(docs), "text", pseudonym_key(spark)), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of text and ``n_chars``, and whether decoding them gave the text back (``round_trip``).

    Other columns stay, but for ``token_ids``, ``round_trip`` and ``n_tokens``.
    """
    importable(spark)
    kept = [c for c in docs.columns if c not in ("n_chars", "token_ids", "round_trip", "n_tokens")]
    encoded = pieces.encode(docs.select(*[quoted(c) for c in kept]), "text", piece_model(spark), verified="round_trip", drop=("text",))
    return encoded.withColumn("n_tokens", F.size("token_ids").cast("long"))


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("PII", pseudonymise),
    ("SentencePiece encoding and decoding", encode),
]

#: SQL expresses neither the trained scores nor the keyed pseudonyms; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for number, (name, work) in enumerate(STAGES):
        docs = work(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stage(docs, "pipeline")
    return docs
