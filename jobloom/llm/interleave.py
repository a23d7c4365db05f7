"""Shards that each match the mixture of sources, with DataFrame functions only.

1. Rows: size, checksum and source of each document are written down once, without texts. Rows that
   are alike are numbered 0, 1, ... by input partition, so that they are told apart on every run in
   the same way and a row that repeats very often still spreads.
2. Seeded shuffle: a digest of seed, id, size, checksum and that number orders the rows of a source.
   The digest's range is cut into buckets; a row's rank in its source is the number of rows in lower
   buckets plus its place in its own. Buckets have about the square root of all rows, also those of a
   source that holds most rows.
3. Fractional rank: (rank + offset) / rows of the source, where a digest of seed and source gives the
   offset (0 to 1), so that small sources do not all meet in the middle.
4. Sort and cut: rows are put in order of their fractional rank, again by counted buckets, and the
   order is cut into shards whose counts are at most one apart (the law `rows`). The rows of a source
   in a shard are its share of the mixture, give or take a few.

No window spans a source or the table but those over bucket counts.

Defined cases: a null text has size 0 plus the fixed part and checksum 0; null is a source; rows may
repeat and each keeps its own place; ids may be null or shared; fewer rows than shards leave some
shards empty; an empty table gives an empty result. Copies of a text are rows like all others and are
not held together. Extra columns are not read, whatever their names; shard_documents hands them on,
but for `shard` and `slot`, which it replaces.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.llm.batches import free_name
from jobloom.session import shared_dir

SHARDS = 40
ROW_BYTES = 16
LAW = "rows"
# Hexadecimal digits of a digest that fit a double exactly, and a long.
DOUBLE_DIGITS, LONG_DIGITS = 12, 15


def digest(digits: int, *parts: Column) -> Column:
    """The first digits of an MD5 over the parts as a number; nulls are told apart from any text."""
    texts = [F.coalesce(F.concat(F.lit("="), p.cast("string")), F.lit("-")) for p in parts]
    return F.conv(F.substring(F.md5(F.concat_ws("|", *texts)), 1, digits), 16, 10).cast("bigint")


def _written(df: DataFrame, name: str) -> DataFrame:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _before(df: DataFrame, bucket: str, *, within: tuple[str, ...] = ()) -> DataFrame:
    """(within, bucket, base, all): rows in lower buckets, and in all."""
    counts = df.groupBy(*within, bucket).agg(F.count("*").alias("n"))
    lower = Window.partitionBy(*within).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    return counts.select(*within, bucket, F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("base"),
                         F.sum("n").over(Window.partitionBy(*within)).alias("all"))


def _copies_told_apart(rows: DataFrame) -> DataFrame:
    """`copy`: 0, 1, ... among the rows that are alike."""
    alike = ("doc_id", "source", "size", "text_crc32")
    rows = rows.withColumn("like", F.xxhash64(*alike))
    first = (rows.groupBy("like", "part").agg(F.count("*").alias("n"))
             .withColumn("first", F.sum("n").over(Window.partitionBy("like").orderBy("part"))
                         - F.col("n")).drop("n"))
    place = F.row_number().over(Window.partitionBy("like", "part").orderBy(*alike)) - 1
    return (rows.withColumn("place", place).join(first.hint("merge"), ["like", "part"])
            .withColumn("copy", F.col("first") + F.col("place")).drop("like", "place", "first"))


def _placed(rows: DataFrame, n_shards: int, seed: int) -> DataFrame:
    """`shard` and `slot` for (doc_id, source, size, text_crc32, part) rows."""
    total = rows.count()
    n_buckets = max(1, round(total ** 0.5))
    # Null sources meet as one; the texts of others start with "=".
    named = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    order = digest(LONG_DIGITS, F.lit(seed), F.col("doc_id"), F.col("size"), F.col("text_crc32"),
                   F.col("copy"))
    width = 16 ** LONG_DIGITS // n_buckets + 1
    shuffled = _written(
        _copies_told_apart(rows).withColumn("source", named).withColumn("order", order)
        .withColumn("bucket", F.floor(F.col("order") / F.lit(width)).cast("bigint")), "shards-shuffled")

    lower = _before(shuffled, "bucket", within=("source",))
    place = F.row_number().over(Window.partitionBy("source", "bucket").orderBy(
        "order", "doc_id", "size", "text_crc32", "copy"))
    rank = F.col("base") + F.col("place") - 1
    offset = digest(DOUBLE_DIGITS, F.lit(seed), F.col("source")) / F.lit(float(16 ** DOUBLE_DIGITS))
    fraction = (rank.cast("double") + offset) / F.col("all").cast("double")
    ranked = _written(
        shuffled.withColumn("place", place).join(lower.hint("merge"), ["source", "bucket"])
        .withColumn("fraction", fraction).drop("order", "bucket", "place", "base", "all", "copy")
        .withColumn("bucket", F.floor(F.col("fraction") * n_buckets).cast("bigint")), "shards-ranked")

    lower = _before(ranked, "bucket").select("bucket", "base")
    place = F.row_number().over(Window.partitionBy("bucket").orderBy("fraction", "source"))
    at = F.col("base") + F.col("place") - 1
    # Whole numbers only: a quotient of doubles may be one off for very large tables.
    shard = F.expr(f"(at * {n_shards}L) div {max(total, 1)}L")
    first = F.expr(f"(shard * {total}L + {n_shards - 1}L) div {n_shards}L")
    return (ranked.withColumn("place", place).join(lower.hint("merge"), "bucket")
            .withColumn("at", at).withColumn("shard", shard).withColumn("slot", F.col("at") - first)
            .withColumn("shard", F.col("shard").cast("int"))
            .drop("bucket", "place", "base", "at", "fraction", "source", "part"))


def _rows(docs: DataFrame, key: str, text: str, source: str, *more: Column) -> DataFrame:
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"),
        (F.octet_length(whole) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(whole).alias("text_crc32"), F.spark_partition_id().alias("part"), *more)


def interleave(docs: DataFrame, n_shards: int = SHARDS, seed: int = 0, *, key: str = "doc_id",
               text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, size, text_crc32, law, shard and slot of each row; grown_shard is null."""
    rows = _written(_rows(docs, key, text, source), "shards-rows")
    return _placed(rows, n_shards, seed).select(
        F.col("doc_id").alias(key), "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"))


def shard_documents(docs: DataFrame, n_shards: int = SHARDS, seed: int = 0, *, key: str = "doc_id",
                    text: str = "text", source: str = "source") -> DataFrame:
    """The documents themselves, with shard and slot."""
    row = free_name(docs, "row")
    kept = _written(docs.drop("shard", "slot").withColumn(row, F.monotonically_increasing_id()),
                    "shards-documents")
    rows = _written(_rows(kept, key, text, source, F.col(row).alias("row")), "shards-rows")
    places = _placed(rows, n_shards, seed).select(F.col("row").alias(row), "shard", "slot")
    return kept.join(places.hint("merge"), row).drop(row)


def write_shards(docs: DataFrame, path: str, files: int, n_shards: int = SHARDS, seed: int = 0,
                 **columns) -> None:
    """One folder per shard; its files, read in the order of their names, hold its slots in order.

    All shards together have about `files` files, so a shard of any size is written by many tasks.
    """
    (shard_documents(docs, n_shards, seed, **columns)
     .repartitionByRange(files, "shard", "slot").sortWithinPartitions("shard", "slot")
     .write.partitionBy("shard").parquet(path))
