"""The corpus pipeline: quality rules, line dedup, near-dedup, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on every row that its predecessor
kept and returns a DataFrame; all but the last return the columns of documents.
Every stage's result is written as Parquet in the shared folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import line_dedup, mixing, near_copies, packing, quality
from tallyspark.llm.common import Saved, read_table
from tallyspark.llm.queries import tokenizer_file


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules reject go, null and empty texts among them.

    Rows are judged one by one: repeated rows and null ids fare alike, other
    columns stay whatever their names, an empty table stays empty.
    """
    return quality.keep_good(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines of windows that occurred before go; n_chars follows the text.

    Null texts stay null, texts of fewer lines than a window stay as they are,
    and a text may become empty. The first occurrence is that of the least id,
    null ids first; rows that repeat an id and its text fare alike. Other
    columns stay whatever their names, an empty table stays empty.
    """
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{k}") for k, c in enumerate(docs.columns)]).alias("row")
    found = line_dedup.dedup_lines(docs.select("doc_id", "text", row))
    new = {"text": F.col("text"), "n_chars": F.length("text").cast(docs.schema["n_chars"].dataType) if "n_chars" in docs.columns else None}
    return found.select(*[new.get(c, F.col("row")[f"c{k}"]).alias(c) for k, c in enumerate(docs.columns)])


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, that of the least id, null ids last.

    Copies are texts of the same words, near copies those whose five-word
    shingles are at least 0.8 alike. Null, empty and wordless texts are one
    group; repeated rows stay once. Other columns stay whatever their names, an
    empty table stays empty.
    """
    return near_copies.keep_one(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents occur as often as the mix takes them: never, once or twice.

    Null and wordless texts have no words and aren't taken; null sources are one
    source; repeated rows are rounded each for itself. Other columns stay
    whatever their names, an empty table stays empty.
    """
    return mixing.mixed(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The placed pieces of all documents.

    A null or empty text is its end id alone; repeated rows and null ids have
    pieces of their own. Other columns aren't read, an empty table gives none.
    """
    return packing.pack_documents(docs, tokenizer_file())


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", simhash_near_dedup),
    ("mixing", mix_sources),
    ("best_fit_packing", best_fit_packing),
]

#: Fingerprints, random rounding and tokens are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    before = None
    for name, stage in STAGES:
        now = Saved(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            before.remove()
        docs, before = now.df, now
    return docs
