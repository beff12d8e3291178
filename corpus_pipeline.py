"""Corpus pipeline over ``documents``: language ID, exact dedup, near dedup, repeated passages, packing.

Every stage is a function (spark, docs, sf_dir) -> DataFrame; ``docs`` is what its predecessor returned.  All but the
last return the columns they were given.  Rows without an id cannot be told apart by the two dedup stages and stay,
all of them; rows repeated under one id with the same text are one row after exact dedup (the one with the smallest other
columns).  Exact dedup decides by row, so texts of one repeated id are judged each; near dedup has one decision per id.
Ties go to the smaller id; very long texts pass every stage whole.
"""

from __future__ import annotations

from public_tokenizers import path as vocabulary
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskline.llm import exact_dedup, language, near_dedup, packing, suffix_dedup


def detect_language(spark: SparkSession, docs: DataFrame, sf_dir: str, languages: tuple[str, ...] | None = None) -> DataFrame:
    """Documents without a letter (null texts too) go, and those predicted in none of ``languages``, if any are named."""
    model = language.train(docs.select("doc_id", "lang", "text"), vocabulary("piece_bpe_32k.model"))
    found = language.predictor(model, spark)("text")
    return docs.where(~found["rejected"] if languages is None else ~found["rejected"] & found["lang_pred"].isin(*languages))


def _only(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose id is in ``kept``, and those without an id."""
    ids = kept.select("doc_id").where("doc_id is not null").distinct()
    return docs.join(ids, "doc_id", "left_semi").unionByName(docs.where("doc_id is null"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    kept = exact_dedup.exact_dedup(docs).where("kept and doc_id is not null").select("doc_id", "text_sha256").distinct()
    of_text = F.sha2(exact_dedup.normalised(docs["text"]), 256) == kept["text_sha256"]
    found = docs.join(kept, (docs["doc_id"] == kept["doc_id"]) & of_text, "left_semi")
    again = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not again.isEmpty():  # texts of repeated ids alone are moved once more
        found = found.join(again, "doc_id", "left_anti").unionByName(_one_row(found.join(again, "doc_id", "left_semi")))
    return found.select(docs.columns).unionByName(docs.where("doc_id is null"))


def _one_row(docs: DataFrame) -> DataFrame:
    """One row per (doc_id, text), the one whose other columns are smallest."""
    others = [f for f in docs.schema.fields if f.name not in ("doc_id", "text")]
    if not others:
        return docs.distinct()
    row = F.struct(*[F.col(f"`{f.name}`") for f in others])
    # columns without an order (maps, variants) cannot decide
    ordered = [F.col(f"`{f.name}`") for f in others if not any(k in f.dataType.simpleString() for k in ("map<", "variant"))]
    least = F.min(row) if len(ordered) == len(others) else F.min_by(row, F.struct(F.lit(0), *ordered))
    made = docs.groupBy("doc_id", "text").agg(least.alias("others"))
    return made.select(*[F.col(c) if c in ("doc_id", "text") else F.col(f"others.`{c}`").alias(c) for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the one with the smallest id stays."""
    return _only(docs, near_dedup.near_dedup(docs).where("kept"))


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose the passages that begin in a document with a smaller id; bytes of a cut character go with it."""
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    done = suffix_dedup.suffix_dedup(docs, carry=others or None, as_text=True)
    made = done.select("doc_id", F.col("kept").alias("text"), *(F.col(f"carried.`{c}`").alias(c) for c in others))
    if "n_chars" in others:
        made = made.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return made.select(docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces with their place in sequences of 2048 tokens."""
    return packing.pack(packing.token_pieces(docs, vocabulary("byte_bpe_50k.json"), vocabulary("byte_bpe_50k.tiktoken")))


STAGES = [
    ("language", detect_language),
    ("exact_dedup", drop_copies),
    ("near_dedup", drop_near_copies),
    ("repeated_passages", cut_repeats),
    ("packing", pack_sequences),
]

#: Language model, near-duplicate components and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage returns is written to the shared folder and read again as the next one's input."""
    from riskline.llm.common import Scratch, read_table

    scratch = Scratch(spark, "pipeline")
    docs = read_table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = scratch.write(docs, name)
    return docs
