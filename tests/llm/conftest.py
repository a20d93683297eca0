import pytest
from pyspark.sql import functions as F

from tradewh.llm.common import let_workers_import

SF = "/root/testdata/sf0.001"

TEXTS = [
    (1, "The cat sat on the mat. The dog sat on the log, and the bird sang a song to them all day long."),
    (2, None),
    (None, "A text without an id. It says that all rights reserved is a phrase of three words."),
    (3, ""),
    (4, "word and other words in a very long line. " * 6000),
    (5, "The cat sat on the mat. The dog sat on the log, and the bird sang a song to them all day long."),
    (5, "The cat sat on the mat. The dog sat on the log, and the bird sang a song to them all day long."),
    (6, " \n\t\n "),
    (7, "Ünïcödé ▁ — İstanbul 日本語  x\x1cy <|endoftext|> a  b\n\n c"),
    (8, "x" * 50_000),
]
#: Columns whose names operators use inside themselves.
CLASH = ["n_words", "score", "fp", "key", "word", "row", "_row", "length", "piece", "text_hash", "spans", "kept", "label", "c", "n", "h",
         "_stay_id", "component_id", "ids", "guest", "shard"]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, repeated rows, clashing columns."""
    let_workers_import(spark)
    rows = spark.createDataFrame(TEXTS, "doc_id long, text string").repartition(3)
    return rows.select("doc_id", "text", F.lit(None).cast("string").alias("lang"), F.lit("s").alias("source"),
                       *[F.lit(f"own {c}").alias(c) for c in CLASH])


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.where("false")


@pytest.fixture(scope="session")
def documents(spark):
    let_workers_import(spark)
    return spark.read.parquet(f"{SF}/documents.parquet")
