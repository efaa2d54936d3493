"""The corpus pipeline: toxicity, near duplicates, benchmark decontamination, source mix, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next one's docs.
All but the last return the columns of documents. The package `lakelens.llm` holds the operators.

toxicity        removes the documents that the classifier calls toxic, whatever their label says.
near_duplicates keeps one document of each group of near copies (similarity 0.8 or more on five-word shingles), the one with the smallest doc_id,
                nulls last, and of texts with that id the one with the least hash.
decontamination removes documents that hold a benchmark item, also with other numbers or names.
source_mix      repeats documents as often as the mix takes them; those it does not take are left out.
token_ids       writes the binary token files and returns one row per document from them, with a hash of its ids.

Documents with null or empty texts pass the first three stages and are in no mix, as they hold no words. Rows with equal
ids and texts count as one document from the second stage on. An empty table passes as an empty table.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakelens.llm import toxicity
from lakelens.llm.columns import perhaps_among, written
from lakelens.llm.decontamination import contaminated
from lakelens.llm.mixing import mix, row_hash
from lakelens.llm.near_duplicates import near_duplicates
from lakelens.llm.token_files import read_token_files, token_folder, write_token_files
from lakelens.registry.base import table

VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
ORACLE_SQL = None
#: Least similarity of near copies, in percent.
NEAR = 80


def _free(docs: DataFrame, name: str) -> str:
    """A column name that no column of `docs` has, whatever its case."""
    taken = {column.lower() for column in docs.columns}
    while name in taken:
        name += "_"
    return name


def _matched(docs: DataFrame, rows: DataFrame, how: str, mark: Column | None = None) -> DataFrame:
    """`docs` joined with (doc_id, row, ...) on the id and the hash of id and text, so that one hash alone decides nothing."""
    key = _free(docs, "row_hash")
    keyed = docs.withColumn(key, F.xxhash64("doc_id", "text") if mark is None else mark)
    named = rows.withColumnsRenamed({"doc_id": _free(docs, "its_doc_id"), "row": _free(docs, "its_row")})
    its_id, its_row = (named[_free(docs, name)] for name in ("its_doc_id", "its_row"))
    return keyed.join(named, (keyed[key] == its_row) & keyed["doc_id"].eqNullSafe(its_id), how)


def _perhaps(docs: DataFrame, rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of `docs` whose id and hash are surely not in `rows`, and the others: only those need a join."""
    perhaps = _free(docs, "perhaps")
    marked = perhaps_among(docs, F.xxhash64("doc_id", "text"), rows.select("row"), _free(docs, "word"), _free(docs, "bits"), perhaps)
    return marked.where(~F.col(perhaps)).drop(perhaps), marked.where(perhaps).drop(perhaps)


def _without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """The rows whose id and hash are not in `gone`."""
    kept, perhaps = _perhaps(docs, gone)
    return kept.unionByName(_matched(perhaps, gone.select("doc_id", "row"), "left_anti").select(*docs.columns))


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return docs.where(toxicity.score(model, F.col("text")) < 0.5)


def remove_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = near_duplicates(docs, NEAR)
    gone = written(found.where("NOT chosen").select("doc_id", "row").distinct(), "duplicates")
    repeated = written(found.where("chosen").groupBy("doc_id", "row").count().where("count > 1").select("doc_id", "row"), "repeated")
    kept = _without(docs, gone)
    if repeated.isEmpty():
        return kept
    again = _matched(_perhaps(kept, repeated)[1], repeated, "left_semi")
    return _without(kept, repeated).unionByName(again.dropDuplicates(["doc_id", _free(docs, "row_hash")]).select(*docs.columns))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = contaminated(docs, table(spark, sf_dir, "benchmark"))
    return _without(docs, written(found.select("doc_id", "row").distinct(), "contaminated"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    copies = _free(docs, "copies")
    taken = written(mix(docs).where("copies > 0").groupBy("doc_id", "row").agg(F.max("copies").alias(copies)), "copies")
    repeated = _matched(docs, taken, "inner", row_hash(F.col("doc_id"), F.col("text")))
    return repeated.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col(copies))).alias(_free(docs, "copy"))).select(*docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    folder = token_folder(spark)
    files = written(write_token_files(docs, VOCABULARY, folder), "token-files")
    return read_token_files(files, folder)


STAGES = [
    ("toxicity", remove_toxic),
    ("near_duplicates", remove_near_duplicates),
    ("decontamination", remove_benchmark),
    ("source_mix", mix_sources),
    ("token_ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
