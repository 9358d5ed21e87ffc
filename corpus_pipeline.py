"""The corpus pipeline: documents in, packed sequences out.

Each stage works on all that its predecessor kept. All but the last return the
columns of ``documents``; ``run`` writes each result as Parquet and reads it
again as the next stage's input.

In every stage a null id is an id like any other, further columns pass through
whatever their names, and an empty table gives an empty one; what a stage does
with null texts, ties and repeated rows is said at the stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import common, decontam, linededup, neardup, packing, quality


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weak-label classifier keeps: neither junk nor toxic.

    A null text, or one without a word, is junk. Repeated rows have equal scores and
    stay or go together; a score of exactly the threshold goes.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    own = docs.withColumnsRenamed({c: f"_docs{c}" for c in ("_junk", "_toxic", "_kept") if c in docs.columns})
    return quality.classify(own, labels).where("_kept").select(own.columns).toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without recurring lines; one of which no text is left goes, and so
    does a null text, which has no line.

    Of equal lines those of the least id stay; rows that repeat an id and a text are
    one document and are treated alike. ``n_chars`` is counted anew where lines went.
    """
    left = linededup.drop_lines(docs).where("_dropped = 0 OR trim(text) <> ''")
    chars = F.when(F.col("_dropped") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return left.withColumn("n_chars", chars).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8).

    It is the one of the least id (of one id, of the least hash of the text; of
    rows that repeat both, the one whose columns hash least). A null or wordless
    text is in no group and stays, once for each id and text.
    """
    return neardup.drop_near_duplicates(docs, neardup.Settings(words=5, percent=80)).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    A null or empty text holds none; repeated rows are treated alike; null items
    are left out.
    """
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select(docs.columns)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of what is left, packed into sequences of 2048 tokens.

    A null text is the end id alone; repeated rows are packed each; pieces of equal
    length are placed in order of id, text hash and piece.
    """
    import public_tokenizers

    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), length=2048)


STAGES = [
    ("quality", quality_classifier),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", best_fit_packing),
]

#: The classifier, the sketches and the tokenizer can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = common.materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
