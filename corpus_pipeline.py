"""From raw documents to packed sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` and the
check tool write it as Parquet and read it again as the next stage's docs.  The
tables that a stage stores on its way are deleted when the next one starts.  All
stages but the last return the columns of documents.

* quality_rules: rejects the documents that break the base or adaptive rules;
* line_dedup: drops repeated lines; a document whose lines all go is kept, empty;
* ngram_join: keeps one document of each near-duplicate group (five-word
  shingles, similarity 0.8);
* mixing: repeats and drops whole documents so that sources meet their target
  weights, in training order;
* packing: the pieces of the fixed-length training sequences, with their token
  ids (little-endian unsigned 32 bit): a sequence is its pieces' ids by offset.

Further columns go through all stages but the last unchanged, whatever their
names; ``n_chars`` follows a text that lost lines.

Defined cases: the quality stage rejects null, empty and short texts; a null
doc_id is a value of its own and may repeat; repeated rows are documents of
their own up to the near-duplicate stage, which keeps one (ties: the lowest
doc_id); texts of any length are read whole; an empty table gives no sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import common, line_dedup, mixing, ngram_join, packing, quality_rules

K, PERCENT = 5, 80


def columns(docs: DataFrame) -> list:
    return [F.col(f"`{c}`") for c in docs.columns]


def numbered(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with columns other than the operators' inputs renamed out of
    the operators' way, and the names to give back."""
    own = {"doc_id", "text", "lang", "source"}
    back = {f"_column_{i}": c for i, c in enumerate(docs.columns) if c not in own}
    return docs.select([F.col(f"`{c}`").alias(next((n for n, o in back.items() if o == c), c))
                        for c in docs.columns]), back


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    safe, back = numbered(docs)
    kept = quality_rules.judge(safe).filter("kept").select(*columns(safe))
    return kept.withColumnsRenamed(back)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    safe, back = numbered(docs)
    changed = F.col("keep").isNotNull()
    done = line_dedup.dedup(safe).withColumn(
        "text", F.when(changed, line_dedup.kept_text("text", "keep")).otherwise(F.col("text")))
    for c, name in back.items():
        if name == "n_chars":
            length = F.length("text").cast(docs.schema[name].dataType)
            done = done.withColumn(c, F.when(changed, length).otherwise(F.col(c)))
    return done.select(*columns(safe)).withColumnsRenamed(back)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    safe, back = numbered(docs)
    return ngram_join.keep_one(safe, K, PERCENT).select(*columns(safe)).withColumnsRenamed(back)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    safe, back = numbered(docs)
    order = mixing.training_order(mixing.mix(safe, whole=True))
    return order.select(*columns(safe)).withColumnsRenamed(back)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, carry=["doc_id"], with_ids=True)


_own: list[str] = []                    # tables that the latest stage has stored for itself


def freeing(stage):
    """The stage, after the one before has given back its own tables: its result
    is written by then.  (So call a stage once the one before is written.)"""
    def run(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        if stage is not quality_stage:                       # the first: nothing of this run is stored yet
            common.delete_tables(spark, _own)
        at = len(common.WRITTEN)
        out = stage(spark, docs, sf_dir)
        _own[:] = common.WRITTEN[at:]
        return out
    return run


STAGES = [(name, freeing(stage)) for name, stage in [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_join", near_duplicate_stage),
    ("mixing", mixing_stage),
    ("packing", packing_stage),
]]

# tokens and best-fit plans are not SQL; tests/llm compares the stages with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
