"""The corpus pipeline: five stages over the documents table, each one of the library's operators.

Every stage reads what its predecessor wrote, works on all of it, and returns the columns of
documents (the last one returns tokens).  Clean documents pass all stages whole.

Cases, for all stages: a null text is an empty one and is kept as null; an empty text is kept by the
classifier and by the benchmark stage, and of all empty texts the near-duplicate stage keeps one; rows
repeated with equal id and text become one document in the near-duplicate stage; rows without an id
take part, after all others; ids are integers; very long texts are read whole, each by one task; columns
beside doc_id, text and n_chars are carried unchanged, whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catlink.llm.bpe import bpe_encode
from catlink.llm.decontaminate import drop_contaminated
from catlink.llm.simhash import drop_near_duplicates
from catlink.llm.suffix_dedup import suffix_dedup
from catlink.llm.token_rollup import delete_folder, shared_folder
from catlink.llm.weak_labels import drop_rejected

#: Repeated passages from this many bytes on lose their later copies: under 50 words of usual length.
PASSAGE_BYTES = 240
#: Shingle and radius of the candidates, which then need a five-word similarity of 0.8.
SHINGLE, RADIUS = 2, 8


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3; documents that it rejects go."""
    return drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2; one document of each group stays."""
    return drop_near_duplicates(docs, shingle=SHINGLE, radius=RADIUS)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5; later copies of repeated passages go, and documents that hold nothing else."""
    out = suffix_dedup(docs, min_bytes=PASSAGE_BYTES, keep="first", whole_chars=True, carry=tuple(docs.columns))
    whole = out.filter("n_removed = 0 or length(kept) > 0").withColumn("left", F.decode("kept", "UTF-8"))
    touched = F.col("n_removed") > 0
    changed = {"text": F.when(touched, F.col("left")).otherwise(F.col("carried.text")), "n_chars": F.when(touched, F.length("left").cast("long")).otherwise(F.col("carried.n_chars"))}
    return whole.select(*[changed.get(c, F.col(f"carried.`{c}`")).alias(c) for c in docs.columns])


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7; documents that hold a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10; ids and decoded text of each document."""
    import public_tokenizers

    return bpe_encode(docs, public_tokenizers.path("word_bpe_49k.json")).select("doc_id", "n_tokens", "ids", "decoded")


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("suffix-array dedup", suffix_array_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("BPE encoding and decoding", bpe_tokens),
]

#: SQL can't express these stages; tests/llm/test_pipeline.py holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages to documents; each result is written to the shared folder and read again; the last one stays there."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = shared_folder(spark, "pipeline")
    for i, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
        if i:  # its predecessor's rows are all written anew
            delete_folder(spark, f"{folder}/{i - 1}")
    return docs
