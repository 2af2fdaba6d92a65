"""From raw documents to token ids: five stages, each a table that the next one reads.

1. ``language_id``: documents without a recognisable language go.  The model is
   learned from the labelled documents among the stage's input.
2. ``line_dedup``: of equal or nearly equal lines over all documents one stays;
   documents with no words left go.
3. ``near_duplicates``: of each group of linked documents the one with the
   smallest id stays.
4. ``mixing``: documents are drawn so that sources, languages and topics meet
   their target shares of the tokens.
5. ``tokenize``: token ids, their number and the check that they decode to the
   text.

The stages take (spark, docs, sf_dir).  All but the last return the columns of
``docs``, whatever further ones it has; null or empty texts end at stage 1.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopline.llm import op2_langid, op6_lines, op7_trees, op9_bpe, op10_mixing
from shopline.session import write_scratch


def _plain(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """The columns under names that no operator uses, and each column's new name."""
    names = {c: f"in_{i}" for i, c in enumerate(docs.columns)}
    return docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()]), names


def _restored(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.select(*[F.col(n).alias(c) for c, n in names.items()])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; their own label stays as it is."""
    model = op2_langid.learn(docs)
    own, names = _plain(docs)
    return _restored(op2_langid.predict(own, model, text=names["text"]).filter("lang_pred != 'und'"), names)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that another line stands for."""
    own, names = _plain(docs)
    return _restored(op6_lines.dedup_lines(own, names["doc_id"], names["text"]).filter("n_kept_lines > 0"), names)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    own, names = _plain(docs)
    return _restored(op7_trees.one_of_each(own, names["doc_id"], names["text"]), names)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn by their calibrated probabilities."""
    own, names = _plain(docs)
    own = own.withColumns({"source": F.col(names["source"]), "lang": F.col(names["lang"]), "n_tokens": op10_mixing.n_words(names["text"])})
    known = op10_mixing.topics(spark, sf_dir)
    narrow = op10_mixing.with_topic(own.select(names["doc_id"], "source", "lang", "n_tokens"), known, names["doc_id"])
    cells = op10_mixing.calibrated_cells(narrow)
    drawn = op10_mixing.with_probabilities(op10_mixing.with_topic(own, known, names["doc_id"]), cells, names["doc_id"])
    return _restored(drawn.filter("sampled"), names)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, lang, n_tokens, ids (little-endian unsigned 32-bit integers) and round_trip."""
    ranks, pattern = op9_bpe.vocabulary()
    keep = ["doc_id", "source", "lang"]
    back = op9_bpe.round_trip(docs.withColumn("sha", F.sha2("text", 256)), ranks, pattern, keep=[*keep, "sha"])
    return back.select(*keep, op9_bpe.n_tokens().alias("n_tokens"), "ids", (F.sha2("decoded", 256) == F.col("sha")).alias("round_trip"))


STAGES = [
    ("language_id", language_id),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("mixing", mixing),
    ("tokenize", tokenize),
]

#: Suffix automata, MinHash and tree joins can't be said in SQL; tests/llm holds the run against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``, each written to the shared
    scratch folder and read again; the files go when the driver ends."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = spark.read.parquet(write_scratch(spark, stage(spark, docs, sf_dir).write.parquet))
    return docs
