"""The training-corpus pipeline over ``documents``.

Each stage takes ``(spark, docs, sf_dir)`` and works on all its predecessor
kept; all but the last return the columns of ``documents``. ``run`` writes a
stage's rows as Parquet under the shared checkpoint folder and reads them
again, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import decontaminate, langid, near_dup, packing, secrets
from ledgerline.llm.common import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# The mean position distribution of a document that reads as no language in
# particular is close to uniform: its best score is below this many times that
# of K languages alike, 1 / K.
ABOVE_UNIFORM = 1.1
# Similarity in percent, on word shingles, from which two documents are copies.
NEAR_PERCENT = 80


def keep_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9 names the language of every document. Those without a letter,
    or of no language the model tells apart from the others, go. With one
    language or none, only the letters count."""
    docs = docs.select(*COLUMNS)
    model = langid.train(docs)
    named = langid.predict(docs, model, whole=True)
    if model is None:  # nothing is named
        kept = named.where(F.col("text").rlike(r"\p{L}"))
    else:
        least = ABOVE_UNIFORM / len(model.langs) if len(model.langs) > 1 else 0.0
        kept = named.where((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= least))
    return kept.select(*COLUMNS)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the smallest id,
    once, with the smallest row of those that repeat it (text first). A document
    without an id stays."""
    docs = docs.select(*COLUMNS)
    found = near_dup.near_duplicates(spark, docs, percent=NEAR_PERCENT)
    rejected = found.where(~F.col("kept")).select("doc_id").distinct()
    if rejected.count() <= near_dup.BROADCAST_IDS:  # else both sides are shuffled
        rejected = F.broadcast(rejected)
    out = docs.join(rejected, "doc_id", "left_anti")
    repeated = found.where("kept and doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if repeated.isEmpty():
        return out.select(*COLUMNS)
    once = out.join(repeated, "doc_id", "left_anti").select(*COLUMNS)
    rest = [c for c in COLUMNS if c != "doc_id"]
    first = out.join(repeated, "doc_id", "left_semi").groupBy("doc_id").agg(F.min(F.struct(*rest)).alias("row"))
    return once.unionByName(first.select("doc_id", "row.*"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    return decontaminate.drop_contaminated(spark, docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is masked; the documents stay."""
    return secrets.redact(spark, docs.select(*COLUMNS))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of packed sequences, as ``op4_bounded_packing`` returns them."""
    return packing.pack(spark, docs, with_ids=False)


STAGES = [
    ("language_id", keep_languages),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("packing", pack_documents),
]

# The model, the tokenizer and the likelihood estimates are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs, last = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = scratch.keep(stage(spark, docs, sf_dir), name)
        if last:
            scratch.drop(last)
        last = name
    return docs
