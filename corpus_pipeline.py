"""A training corpus from documents: quality, near copies, repeated passages, mix, tokens.

Each stage takes (spark, docs, sf_dir) and returns the documents that its successor works on, with the columns
of documents; the last returns tokens. Stages call the operators of panelmill.llm.

In every stage: an empty table gives an empty one; columns of any other name go through unchanged; repeated rows are rows of
their own, except where the stage is there to drop them. Nulls and odd texts:

* quality classifier: a null or empty text is scored as one passage without characters; a null id is never learned from.
* n-gram Jaccard join: texts without words all stay; of a group the row of the least id stays, a null id last, of equal
  ids the one that is read first.
* suffix-array dedup: null ids come after all others, rows of one id take nothing from each other; a null text is empty.
* mixing: a null source is a source; texts without words are taken once, with 0 words; equal rows are taken together.
* BPE: a null or empty text has no tokens.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelmill.llm import bpe, mixing, quality, similar, substrings
from panelmill.llm.common import drop_work, made, written


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (a score below 0.3) go."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.accepted(docs, quality.fit(docs, labels, F.crc32(F.col("doc_id").cast("string")) % 5 != 0))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays: the one with the smallest doc_id."""
    return similar.linked(docs, keep_one=True)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose what a document with a smaller doc_id has too; n_chars follows."""
    kept = substrings.remove_repeats(docs, keep_rows=True)
    return kept.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else kept


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in training order: by the files' numbers, then by rows."""
    return mixing.mixed_rows(docs)


def _position(docs: DataFrame) -> Column:
    """A number that grows with the training order: file and row of a table that the mix wrote, else the row's place
    in the DataFrame itself."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(name, row)
    except AnalysisException:
        return F.monotonically_increasing_id()
    number = lambda pattern: F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("bigint"), F.lit(0).cast("bigint"))
    return F.shiftleft(number(r"part-(\d+)"), 44) + F.shiftleft(number(r"-c(\d+)"), 34) + row


def bpe_round_trip(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The tokens of each row, with the hashes of ids and decoded text, and position: its place in training order. A
    document that is taken twice has two rows, told apart by their positions."""
    return bpe.round_trip(docs, public_tokenizers.path("byte_bpe_50k.json"), keep_ids=True, position=_position(docs))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("suffix-array dedup", suffix_array_dedup),
    ("mixing sources to target weights", mix_sources),
    ("BPE encoding and decoding", bpe_round_trip),
]

#: Models and hashes decide; SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows; what the stages before it left, and their own working tables, are dropped on the way."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    since = made()
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        drop_work(spark, since, keep=docs)
    return STAGES[-1][1](spark, docs, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"pipeline": run}


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
