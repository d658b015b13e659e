"""A corpus from raw documents: STAGES, each written as Parquet and read again as the next one's documents.

1. language: documents without a determinable language are rejected: those without text or
   letters, and those that the raw code of 8 bits a byte describes better than any learned
   language, such as noise and unlearned scripts (``wildgrid.llm.langid``). Texts between
   two learned languages stay;
2. near duplicates: of each group of texts linked by 5-word shingles of similarity 0.8 or more
   the one with the smallest id stays (``wildgrid.llm.jaccard``);
3. mixture: sources are brought to their target weights; documents are left out or
   repeated as drawn (``wildgrid.llm.mixing``);
4. pieces: the ids of every document's text (``wildgrid.llm.pieces``).

A stage maps (spark, docs, sf_dir) to a DataFrame; all but the last return the columns
of documents. All work on every row that they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wildgrid.llm import jaccard, langid, mixing, pieces
from wildgrid.llm.common import forget, table, written

#: Least score of a language (its share at ``langid.SCORED`` bytes of text) for it to be accepted: low enough for texts that
#: mix languages, whose share is divided between these, and far above noise, whose share is that of the raw code.
LANGUAGE_SHARE = 0.1


def _columns(df: DataFrame, docs: DataFrame) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in docs.columns])


def _neutral(docs: DataFrame) -> DataFrame:
    """Columns that no stage reads under neutral names, so that none clashes with what the operators add."""
    used = ("doc_id", "text", "lang", "source")
    return docs.toDF(*[c if c in used else f"kept_{k}" for k, c in enumerate(docs.columns)])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that are ``und`` (null, empty, letterless), or whose score is below ``LANGUAGE_SHARE``.

    Languages are learned from the documents' own labels, but none is judged by a model that has seen it: texts fall into two
    halves by their hash, and each half is judged by what the labels of the other teach (so a label can't vouch for noise, nor can its copies). Both
    are read in lower case, so that a rare way of writing needs no examples of its own. Where
    a half has no label at all, both are judged by all; without any label every document is
    ``und`` and goes. Repeated rows are judged alike. Other columns come through as they are, whatever their names.
    """
    rows = _neutral(docs)
    half = F.crc32(F.coalesce(F.col("text"), F.lit(""))) % 2
    lower = rows.withColumn("kept_lower", F.lower("text"))
    known = lower.select("lang", F.col("kept_lower").alias("text"), half.alias("half"))
    models = [langid.train(known.where(F.col("half") != k)) for k in (0, 1)]
    if not all(m.langs for m in models):
        models = [langid.train(known)] * 2
    found = [langid.identify(lower.where(half == k), m, "kept_lower", ("kept_lang", "kept_score")) for k, m in enumerate(models)]
    kept = found[0].unionByName(found[1]).where((F.col("kept_lang") != langid.UNDETERMINED) & (F.col("kept_score") >= LANGUAGE_SHARE))
    return _columns(kept, rows).toDF(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicate texts stays: that with the smallest id.

    Groups are of texts: a row's id decides nothing but which row stays. So rows of one
    id with different texts all stay, unless they are near duplicates; of rows with equal
    ids in a group the one with the smaller hash of its text stays, null ids come last.
    Texts without words are no near duplicates. Repeated rows are a group like others.
    """
    ids = docs.where("doc_id is not null").groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1")
    if ids.limit(1).count() == 0 and docs.where("doc_id is null").limit(1).count() == 0:
        groups = jaccard.near_components(docs)
        dropped = groups.where("component_id < doc_id").select("doc_id")
        return _columns(docs.join(dropped, "doc_id", "left_anti"), docs)
    # the rows get numbers of their own, written once, so that a repeated task can't change them
    numbered = written(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")), "numbered")
    groups = jaccard.near_components(numbered.select(F.col("row").alias("doc_id"), F.col("doc.text").alias("text")))
    order = F.struct(F.col("doc.doc_id").isNull().alias("none"), "doc.doc_id", F.xxhash64("doc.text").alias("text"), "row")
    found = numbered.select("row", order.alias("order")).join(groups.select(F.col("doc_id").alias("row"), "component_id"), "row")
    first = found.groupBy("component_id").agg(F.min("order")["row"].alias("row")).select("row")
    return numbered.join(first, "row", "left_semi").select("doc.*").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: rows are left out or repeated as the splitting tree draws, and lie shard after shard, shuffled.

    A null source is a source of its own; null and empty texts have no words and are not
    drawn; equal rows are drawn alike. An empty table gives an empty mix. Other columns come through as they are.
    """
    rows = _neutral(docs)
    return _columns(mixing.in_order(mixing.mixed(rows)), rows).toDF(*docs.columns)


def piece_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces and ids of every row of the mixture. A null text has null ids and n_pieces, an empty one none and 0; repeated rows stay."""
    import public_tokenizers

    found = pieces.encode(docs.select("doc_id", "source", "text"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.select("doc_id", "source", F.when(F.col("ids").isNotNull(), F.size("ids")).alias("n_pieces"), "ids")


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("mixture", mixture), ("piece_ids", piece_ids)]

#: Learned code lengths and best piece paths can't be written in SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; a stage's table is deleted when the next one's is whole."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
        forget(*before)
        before = [docs]
    return docs
