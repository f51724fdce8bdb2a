"""Exact deduplication by a heavy-hitter split, in DataFrame operations only.

A frequent-items sketch (the Misra-Gries family, Spark's approx_top_k) names candidate digests that many rows
carry. Their groups are then counted exactly: one partially aggregated row per digest and task. These verified
winners, at most `max_hot` rows, are broadcast, so that every copy in a hot group is settled where it is read.
All other digests go through an ordinary shuffle, whose groups are small by the sketch's guarantee.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ._store import matching, table, written

#: Most digests that are broadcast, counters of the sketch, and the least count worth a broadcast row.
MAX_HOT, TRACKED, MIN_HOT = 1000, 4096, 32


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_hot: int = MAX_HOT, tracked: int = TRACKED, min_hot: int = MIN_HOT) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Null text equals empty text. The largest id of equal texts stays. Rows that repeat an id are counted in
    group_size and each returned; all rows with the kept id are kept. A null id never wins unless the whole
    group is null; then keep_id is null and kept true. Other columns are ignored. Empty in, empty out.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    digests = written(docs.select(F.col(id_col).alias("doc_id"), F.sha2(text, 256).alias("text_sha256")))
    # The sketch only steers which path a group takes; what it misses or overstates changes no result.
    sketch = digests.select(F.xxhash64("text_sha256").alias("h")).agg(F.expr(f"approx_top_k(h, {max_hot}, {tracked})").alias("t"))
    hot = sketch.select(F.explode("t").alias("t")).filter(F.col("t.count") >= min_hot).select(F.col("t.item").alias("h"))
    winners = written(
        digests.withColumn("h", F.xxhash64("text_sha256")).join(F.broadcast(hot), "h", "left_semi")
        .groupBy("text_sha256").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")), 1)
    settled = digests.join(F.broadcast(winners), "text_sha256").select("doc_id", "keep_id", "group_size", "text_sha256")
    group = W.partitionBy("text_sha256")
    rest = digests.join(F.broadcast(winners.select("text_sha256")), "text_sha256", "left_anti").select(
        "doc_id", F.max("doc_id").over(group).alias("keep_id"), F.count("*").over(group).alias("group_size"), "text_sha256")
    return settled.unionByName(rest).select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")


def kept_documents(docs: DataFrame, **options) -> DataFrame:
    """docs without the copies that exact_dedup drops: of equal texts only the rows with the largest doc_id stay.

    Rows go by doc_id and text, so where a doc_id repeats, its row with another text stays, and a null doc_id goes
    where its text has a row with one. Rows with the same doc_id and text all stay.
    """
    row = lambda digest: F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), digest)
    gone = written(exact_dedup(docs, **options).filter(~F.col("kept")).select(row(F.col("text_sha256")).alias("_row")).distinct())
    own = row(F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    return matching(docs.withColumn("_row", own), gone, "_row", "left_anti").select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


SQL = """
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))
"""
