"""A training corpus from raw documents, stage by stage.

``STAGES`` are (name, function): each takes (spark, docs, sf_dir) and gets what
its predecessor kept, written as Parquet and read again.  All but the last return the
columns of ``documents``; the last packs what is left into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eligo.llm.common import materialize, read_table
from eligo.llm.decontaminate import contamination
from eligo.llm.langid import UNDETERMINED, held_out, one_language, predict_language, train_language_model
from eligo.llm.line_dedup import line_dedup
from eligo.llm.packing import pack
from eligo.llm.queries import tokenizer_path
from eligo.llm.simhash import simhash_dedup


#: Languages to keep (None: every one that is learned), and the least posterior of the predicted one: as likely as all others together.
LANGUAGES: frozenset[str] | None = None
MIN_SCORE = 0.5


def _numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` written once with a row number, by which verdicts find their row (ids may be null or shared)."""
    return materialize(docs.withColumn("_row", F.monotonically_increasing_id()), name)


def _without(numbered: DataFrame, gone: DataFrame, name: str) -> DataFrame:
    """The rows whose number is not in ``gone``."""
    return numbered.join(materialize(gone.select("_row"), name), "_row", "left_anti").drop("_row")


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps documents whose predicted language is one of ``LANGUAGES`` with a posterior of ``MIN_SCORE`` or more.

    So null texts, texts without a letter, other languages and texts that could be of several go.  The
    column ``lang`` trains the model and decides nothing about its own row.  Without a learned language (no labelled row outside the
    held-out fold) a model of one stands in, and only null texts and texts without a letter go.
    """
    model = train_language_model(docs.where(~held_out(F.col("doc_id"))))
    wanted = F.col("_pred") != UNDETERMINED
    if not model.langs:
        model = one_language()
    elif LANGUAGES is not None:
        wanted = F.col("_pred").isin(*LANGUAGES)
    return (predict_language(docs, model, lang_out="_pred", score_out="_score")
            .where(wanted & (F.col("_score") >= MIN_SCORE)).select(*docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts boilerplate lines of any length; drops documents that had nothing else.  Null texts stay as empty ones, a null source is no site."""
    cut = line_dedup(docs, min_sites=10, min_chars=1)
    kept = cut.where((F.col("n_removed") == 0) | (F.trim(F.translate("text", "\n\t\r", "")) != ""))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
                               .cast(docs.schema["n_chars"].dataType))
    return kept.select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one row of each group: that with the smallest id (null ids last), the first of equal ids."""
    numbered = _numbered(docs, "pipeline-simhash-docs")
    ids = numbered.select(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row").alias("id"), "text")
    found = simhash_dedup(ids, id_col="id", shingle_words=3, max_distance=3)
    return _without(numbered, found.where("id._row <> component_id._row").select("id._row"),
                    "pipeline-copies").select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    numbered = _numbered(docs, "pipeline-decontaminate-docs")
    found = contamination(numbered, read_table(spark, sf_dir, "benchmark"), id_col="_row", window=10)
    return _without(numbered, found.where(F.size("spans") > 0), "pipeline-contaminated").select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of what is left, each with its place in a sequence; a null text is the end mark alone, a null id stays null."""
    # Workers serve all stages one after the other, so what this one remembers is kept small.
    return pack(docs, tokenizer_path(), capacity=4096, end_id=1, cache_words=30_000)


STAGES = [("language_id", language_id), ("line_dedup", lines), ("simhash_dedup", near_duplicates),
          ("decontaminate", decontaminate), ("packing", packing)]

#: Language ID, SimHash and packing are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
