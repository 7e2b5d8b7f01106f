"""A corpus pipeline over ``documents``: five operators of postlake.llm, one after the other.

Every stage takes the whole of what its predecessor kept, as a written
table; all but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlake.llm import bpe, crf, pivotal, rlz, simhash
from postlake.llm.common import table, written


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the line field scores at 0.7 or more; fitted on the labelled documents that come in.

    Null or empty text: scored as one empty line.  Very long texts are scored
    line by line; a labelled one lends a run of its lines to the fit.  Equal
    rows score alike and stay or go together.  Rows without an id are scored
    like others and never fitted.  Without labels every score is one half, so
    nothing stays.  Empty table: no rows.
    """
    labels = table(spark, sf_dir, "labels").where(crf.fold_of(F.col("doc_id")) != 2)
    scored = crf.quality(docs, crf.fit(docs, labels))
    return scored.where(F.col("score") >= crf.THRESHOLD).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one with the smallest id, of each SimHash group.

    Null, empty and wordless texts have one fingerprint and are one group.
    Ties of the smallest id go to the smallest hash of the text, and of equal
    rows one stays; a null id counts as the largest.  Very long texts are
    hashed whole.  Empty table: no rows.
    """
    return simhash.keep_one(docs).select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand in a document with a smaller id; n_chars follows the text.

    Every row stays, also with a text that loses all its words.  Null, empty
    and short texts are unchanged.  Rows of one id don't cut each other, a
    null id is never a source.  Very long texts are batches of their own.
    Empty table: no rows.
    """
    done = rlz.substring_dedup(docs)
    return done.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
                           .cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, three times at most.

    Null, empty and wordless texts have size 0 and aren't taken.  Equal rows
    are drawn each by itself; a null source is a source, the last by name.
    Very long texts count with all their words.  Empty table: no rows.
    """
    return pivotal.repeat(pivotal.mix(docs)).select(*docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, the token ids of each text, their number, and the text decoded from them.

    Null or empty text: no ids and the empty text.  Equal rows are encoded
    alike and stay rows of their own.  Very long texts are encoded whole.
    Empty table: no rows.
    """
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = bpe.round_trip(docs.select("doc_id", "source", "text"), path, public_tokenizers.PATTERN)
    return done.select("doc_id", "source", "ids", F.size("ids").cast("long").alias("n_tokens"),
                       F.col("decoded").cast("string").alias("text"))


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mixing sources", mix),
    ("BPE encoding", encode),
]

#: The classifier, the mix and the encoding can't be put in SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
