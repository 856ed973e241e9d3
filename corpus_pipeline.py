"""A training corpus from raw documents: five stages, each over all that its predecessor kept.

1. language: documents without an identifiable language go.
2. lines: lines that an earlier document has go from the texts.
3. near duplicates: of each group of similar documents the one with the smallest id stays. Rows that
   repeat an id are one document.
4. benchmark: documents that hold an item of the table ``benchmark`` go.
5. pieces: the texts are encoded and decoded; the result has the digests of both.

Stages 1 to 4 return the columns of ``documents``. Each stage's rows are written to the shared folder
and read again as the next one's documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.llm import decontam, langid, lines, neardup, pieces
from plumbline.llm.queries import vocabulary
from plumbline.llm.stored import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.only_identified(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A null text stays null; ``n_chars`` follows the text where lines went."""
    kept = lines.deduplicated(docs)
    shortened = F.col("n_dropped") > 0
    replaced = {
        "text": F.when(shortened, F.col("kept_text")).otherwise(F.col("text")),
        "n_chars": F.when(shortened, F.char_length("kept_text").cast("long")).otherwise(F.col("n_chars")),
    }
    return kept.select(*[replaced[c].alias(c) if c in replaced else c for c in docs.columns])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(docs)
    # Written, its size is known to the planner: where few go the texts are not shuffled.
    gone = stored(found.where("NOT kept").select("doc_id").distinct(), "gone")
    return docs.join(gone, docs["doc_id"].cast("long") == gone["doc_id"], "left_anti")


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontam.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def sentence_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = pieces.round_trips(docs, pieces.model_bytes(vocabulary()))
    return found.select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")


STAGES = [
    ("language_id", language),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_dedup),
    ("decontamination", decontamination),
    ("sentencepiece", sentence_pieces),
]

#: Hashed models and exact similarities over whole texts are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
