"""The corpus pipeline: quality, near-duplicates, decontamination, personal data, and token ids, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's rows as
Parquet in the shared folder and gives them to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillspark.llm.common import drop_path, drop_written, scratch, table, written
from quillspark.llm.decontaminate import drop_contaminated
from quillspark.llm.pii import mask
from quillspark.llm.quality import keep_good
from quillspark.llm.sentencepieces import encode_pieces
from quillspark.llm.simhash import drop_near_duplicates

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the co-trained classifiers don't reject."""
    return keep_good(docs, table(spark, sf_dir, "labels")).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return drop_near_duplicates(docs).select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark")).select(*COLUMNS)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return mask(docs).select(*COLUMNS)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, n_tokens, ids_crc32, n_chars, and whether the ids decode to the text, of all documents."""
    import public_tokenizers

    return encode_pieces(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("personal_data", personal_data), ("token_ids", token_ids)]

#: The classifiers, fingerprints, random field and pieces are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage wrote for itself goes once it is done, its rows once the next has written.

    The last stage's rows stay in the shared folder, for whoever reads the result. Nulls in any
    column, empty texts, repeated rows and empty tables go through; columns besides those of
    documents don't.
    """
    docs, path = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        out, before = scratch(spark, f"pipeline-{name}"), written()
        stage(spark, docs, sf_dir).write.parquet(out)
        drop_written(spark, before)
        if path:
            drop_path(spark, path)
        docs, path = spark.read.parquet(out), out
    return docs
