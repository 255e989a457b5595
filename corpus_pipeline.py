"""The corpus pipeline: from documents to token ids, in five stages.

STAGES lists (name, function); each function takes (spark, docs, sf_dir) and returns a DataFrame.
`run` writes every stage's result as Parquet and reads it back as the next one's documents, so a
lost executor costs one stage at most; what a stage read, and staged on its way, then goes. All but the last stage return the columns of the documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trafficcast.llm import bpe, decontaminate, line_dedup, quality, simhash
from trafficcast.session import discard, settled, ship


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts; it is fitted on labelled texts of `docs`.

    Null and empty texts are scored like any other; rows that repeat are judged alike; labels without
    a document, or none at all, leave a model that accepts everything. An empty table gives none.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality.fit(docs, quality.ratings(labels))
    return quality.accepted(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that stand earlier; n_chars, if there is one, follows the text.

    No row goes: a text of which no line is left is empty, a null text stays null. Rows that repeat id
    and text are cut alike. An empty table gives none.
    """
    cut = line_dedup.dedup_lines(docs)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(docs.columns)


def copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group, that of the smallest id; rows without an id come last.

    Groups are those of the operator's own query: four-word shingles, four differing bits. Null and
    empty texts and texts without words have one fingerprint and are a group like any other. Rows
    that repeat id and text are one document. An empty table gives none.
    """
    return simhash.representatives(docs, words=4, max_bits=4).select(docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark.

    Null and empty texts have no words and stay; rows of one id go together if one is contaminated;
    rows without an id stay. An empty benchmark takes nothing, an empty table gives none.
    """
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontaminate.flagged(decontaminate.contamination(docs, benchmark))
    bad = found.where("contaminated").select("doc_id").distinct()
    return docs.join(bad, "doc_id", "left_anti").select(docs.columns)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_tokens of every row that is left; null and empty texts have no ids."""
    import public_tokenizers

    return bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids")


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("simhash", copies_stage),
    ("benchmark", benchmark_stage),
    ("tokens", token_stage),
]

#: A fitted classifier, a hash vote and BPE are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, on the documents of `sf_dir`."""
    ship(spark)
    docs = before = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = settled(lambda stage=stage, docs=docs: stage(spark, docs, sf_dir), f"stage-{name}")
        if name != STAGES[0][0]:
            discard(before)
        before = docs
    return docs
