"""The registered queries of the training-data operators.

Each applies its operator with production parameters to the whole table and
derives the agreed columns from the operator's own result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from quarry.llm import bpe, decontam, html, lines, minhash, mixing, ppm, quality, rindex, search, toxicity, vectors, whitening
from quarry.llm.store import crc_fold, id_text, read_table


def _scored(scores: DataFrame, threshold: float, folds: int, held: int) -> DataFrame:
    fold = crc_fold(F.col("doc_id"), folds)
    return scores.select("doc_id", F.coalesce(fold == held, F.lit(True)).alias("held_out"), "score",
                         (F.col("score") >= threshold).cast("int").alias("predicted"))


def learned_ids(doc_id):
    """The ids that labels may be learned from: crc32 modulo 5 is not 0."""
    return crc_fold(doc_id, 5) != 0


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    machine = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), learned_ids)
    return _scored(toxicity.score(docs, machine), 0.5, 5, 0)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    ranking = quality.fit(docs, read_table(spark, sf_dir, "labels"), learned_ids)
    return _scored(quality.score(docs, ranking), quality.Params.cut, 5, 0)


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(read_table(spark, sf_dir, "documents"))


def _cut_lines(out: DataFrame) -> DataFrame:
    return out.select("doc_id", F.col("line_dedup.n_lines").cast("long").alias("n_lines"),
                      F.col("line_dedup.n_removed").cast("long").alias("n_removed"), F.md5("text").alias("kept_md5"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_lines(lines.dedup_lines(read_table(spark, sf_dir, "documents")))


def op4_line_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cut_lines(lines.dedup_passages(read_table(spark, sf_dir, "documents")))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.groups(read_table(spark, sf_dir, "documents"), minhash.Params(words=2))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"),
                                 decontam.Params(shortest=1))


def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read_table(spark, sf_dir, "pages"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.links(read_table(spark, sf_dir, "embeddings"))


def op9_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = ppm.scores(read_table(spark, sf_dir, "documents"), lambda doc_id: crc_fold(doc_id, 7) != 2)
    return out.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                      "base_score", "score")


def op10_run_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rindex.dedup(read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = whitening.whiten(read_table(spark, sf_dir, "embeddings"))
    return out.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.documents(read_table(spark, sf_dir, "documents"))
    return mixing.taken(placed, mixing.pieces_of(placed)).drop("source")


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_quality": op2_quality,
    "op3_bpe": op3_bpe,
    "op4_line_dedup": op4_line_dedup,
    "op4_line_passages": op4_line_passages,
    "op5_minhash": op5_minhash,
    "op6_decontamination": op6_decontamination,
    "op7_html": op7_html,
    "op8_embeddings": op8_embeddings,
    "op9_ppm": op9_ppm,
    "op10_run_index": op10_run_index,
    "op11_whitening": op11_whitening,
    "op12_mixing": op12_mixing,
    "op13_search": op13_search,
}

ORACLES = {
    "op4_line_dedup": "WITH " + lines.DEDUP_SQL.replace("{docs}", "documents").strip()
                      + "\nSELECT doc_id, n_lines, n_removed, md5(text) AS kept_md5 FROM deduped",
    "op4_line_passages": "WITH " + lines.PASSAGES_SQL.replace("{docs}", "documents").strip()
                         + "\nSELECT doc_id, n_lines, n_removed, md5(text) AS kept_md5 FROM deduped",
    "op6_decontamination": "WITH " + decontam.LEAKS_SQL.replace("{docs}", "documents").strip() + "\nSELECT * FROM leaks",
    "op13_search": "WITH " + search.SEARCH_SQL.replace("{docs}", "documents").replace("{items}", "benchmark").strip()
                   + "\nSELECT * FROM ranked",
}
