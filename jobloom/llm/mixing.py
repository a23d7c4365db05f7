"""Mixing sources to target weights, with DataFrame functions only.

1. Sizes: the words of each document, written down once without texts.
2. Targets: sources share all words by weight; what exceeds `most` times a source's size is shared
   out again by weight (water filling, solved in closed form over the sorted ratios).
3. Packing: a source's documents, in a pseudorandom order, form one stream of words that is cut
   into blocks of `block_words`. The position of a document in its stream is a sum over buckets
   plus a sum within its bucket; both have about the square root of the documents.
4. Drawing: all output slots are put in a pseudorandom order and dealt to shards of `shard_slots`.
   That draws each shard's counts per source as independent multinomial draws would give them if
   only outcomes whose totals meet the targets are kept (the multivariate hypergeometric law), so
   the totals are exact and only the shards vary.
5. Slots: the j-th slot of a source takes block p(j) of it, p a keyed pseudorandom permutation of
   the block numbers for each time round; so no block is taken more than `most` times.
6. Slots and the documents' parts of blocks are joined by source and block number: `mixed_blocks`
   says which words of which document stand in each slot of each shard. What a document gives is
   summed over these, shard by shard.

Permutations are arithmetic (rounds of keyed hashes on a pair of digits, walked until the number is
below the count), so nothing is sorted, and a source of any size spreads over all tasks. The number of tasks that make slots grows with the slots.

Defined cases: a null text and one without words have size 0 and are taken 0 times; null is a source,
the last; a source without words has target 0; repeated rows are documents of their own; empty tables
give an empty result. Only id, text and source are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from jobloom.session import shared_dir

WEIGHTS = (5, 2, 1)
MOST = 3
BLOCK_WORDS = 32
SHARD_SLOTS = 4096
WORD = r"[^\x20\x09-\x0D]+"
SLOTS_PER_TASK = 1 << 16
MOST_TASKS = 20_000
HALF_ROUNDS = 4
WALK = 64


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def _sized(docs: DataFrame, key: str, text: str, source: str) -> DataFrame:
    """(doc_id, source, size, h) as written to the shared folder; h places the document."""
    spark = docs.sparkSession
    path = shared_dir(spark, "mix-sizes")
    rows = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"),
                       word_count(F.col(text)).alias("size"),
                       F.xxhash64(F.col(key), F.col(text)).alias("h"))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def source_targets(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
                   block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per source: number, source, source_size, target, blocks, slots and their offset.

    Its windows run over the sources, not over documents.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    every = Window.partitionBy()
    rows = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rows = rows.withColumn("number", F.row_number().over(by_name))
    share = F.element_at(F.array(*map(F.lit, weights)), (F.col("number") - 1) % len(weights) + 1)
    rows = (rows.withColumn("weight", share.cast("double"))
            .withColumn("cap", (F.col("source_size") * most).cast("double"))
            .withColumn("ratio", F.col("cap") / F.col("weight")))
    by_ratio = Window.orderBy("ratio", "number")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    rows = rows.withColumn("level", left / F.sum("weight").over(after))
    # The sources at their cap come first in this order; the level of the next one holds for the rest.
    level = F.min(F.when(F.col("ratio") > F.col("level"), F.struct("ratio", "number", "level"))
                  ).over(every)["level"]
    rows = rows.withColumn("target", F.least(F.col("cap"), F.coalesce(
        level * F.col("weight"), F.col("cap"))))
    size = F.greatest(F.col("source_size"), F.lit(1))
    blocks = F.ceil(F.col("source_size") / block_words)
    slots = F.least(F.round(F.col("target") / size * blocks).cast("bigint"), blocks * most)
    rows = rows.withColumn("blocks", blocks).withColumn("slots", slots)
    offset = F.coalesce(F.sum("slots").over(Window.orderBy("number").rowsBetween(
        Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select("number", "source", "source_size", "target", "blocks", "slots",
                       offset.alias("offset"), F.sum("slots").over(every).alias("all_slots"))


def permuted(value: Column, count: Column, *key: Column) -> Column:
    """A keyed pseudorandom permutation of 0 .. count - 1."""
    high = F.greatest(F.ceil(F.sqrt(count.cast("double"))), F.lit(1))
    low = F.greatest(F.ceil(count / high), F.lit(1))

    def once(v: Column) -> Column:
        x, y = F.floor(v / low).cast("bigint"), F.pmod(v, low)
        for i in range(HALF_ROUNDS):
            if i % 2:
                y = F.pmod(y + F.pmod(F.xxhash64(x, F.lit(i), *key), low), low)
            else:
                x = F.pmod(x + F.pmod(F.xxhash64(y, F.lit(i), *key), high), high)
        return x * low + y

    # Fewer than `high` numbers lie beyond count, so a walk of WALK steps reaches one below it:
    # surely where high <= WALK, else but for a chance of high ** -WALK, which the last step covers.
    first = once(value)
    walked = F.aggregate(F.sequence(F.lit(1), F.lit(WALK)), first,
                         lambda v, _: F.when(v < count, v).otherwise(once(v)))
    return F.when(first < count, first).otherwise(walked)


def slot_plan(targets: DataFrame, shard_slots: int = SHARD_SLOTS, seed: int = 0) -> DataFrame:
    """(shard, slot, number, block): which block fills each slot of each output shard."""
    # With a count of its own, AQE does not fold the few rows that make many slots into one task.
    slots = targets.agg(F.sum("slots")).head()[0] or 0
    tasks = min(max(-(-slots // SLOTS_PER_TASK), 1), MOST_TASKS)
    piece = F.explode(F.sequence(F.lit(0).cast("bigint"), F.floor((F.col("slots") - 1) / shard_slots)))
    pieces = (targets.filter("slots > 0")
              .select("number", "blocks", "slots", "offset", "all_slots", piece.alias("piece"))
              .repartition(tasks, F.col("number"), F.col("piece")))
    first = F.col("piece") * shard_slots
    j = F.explode(F.sequence(first, F.least(first + shard_slots, F.col("slots")) - 1))
    slots = pieces.select("number", "blocks", "offset", "all_slots", j.alias("j"))
    at = permuted(F.col("offset") + F.col("j"), F.col("all_slots"), F.lit(seed), F.lit(-1))
    time_round = F.floor(F.col("j") / F.col("blocks")).cast("bigint")
    block = permuted(F.pmod(F.col("j"), F.col("blocks")), F.col("blocks"), F.lit(seed),
                     F.col("number"), time_round)
    return slots.select("number", block.alias("block"), at.alias("at")).select(
        F.floor(F.col("at") / shard_slots).alias("shard"),
        F.pmod("at", F.lit(shard_slots)).alias("slot"), "number", "block")


def packed(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The documents with their source's number and their first word's place in its stream."""
    n_buckets = max(1, round(sized.count() ** 0.5))
    bucket = F.pmod("h", F.lit(n_buckets))
    known = targets.select(F.col("source").alias("_source"), "number", "source_size", "target")
    rows = sized.join(known, sized["source"].eqNullSafe(known["_source"])).drop("_source")
    rows = rows.withColumn("bucket", bucket)
    sums = rows.groupBy("number", "bucket").agg(F.sum("size").alias("words"))
    earlier = Window.partitionBy("number").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1)
    sums = sums.select("number", "bucket",
                       F.coalesce(F.sum("words").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("number", "bucket").orderBy("h", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    start = F.col("base") + F.coalesce(F.sum("size").over(within), F.lit(0))
    return rows.join(sums, ["number", "bucket"]).withColumn("start", start).drop("bucket", "base")


def _placed(docs: DataFrame, weights: tuple[int, ...], most: int, block_words: int, key: str,
            text: str, source: str) -> tuple[DataFrame, DataFrame]:
    """The documents in their sources' streams and the sources' targets, both written down."""
    spark = docs.sparkSession
    sized = _sized(docs, key, text, source)
    path = shared_dir(spark, "mix-targets")
    wanted = source_targets(sized, weights, most, block_words)
    wanted.write.parquet(path)
    targets = spark.read.schema(wanted.schema).parquet(path)
    placed = packed(sized, targets)
    path = shared_dir(spark, "mix-packed")
    placed.write.parquet(path)
    return spark.read.schema(placed.schema).parquet(path), targets


def _blocks(placed: DataFrame, targets: DataFrame, block_words: int, shard_slots: int,
            seed: int) -> DataFrame:
    """(shard, slot, number, block, start, low, high): the stream's words [low, high) of the document
    that starts at `start` stand in the slot."""
    first = F.floor(F.col("start") / block_words)
    last = F.floor((F.col("start") + F.col("size") - 1) / block_words)
    parts = placed.filter("size > 0").select(
        "number", "start", "size", "doc_id", F.explode(F.sequence(first, last)).alias("block"))
    low = F.greatest(F.col("start"), F.col("block") * block_words)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * block_words)
    slots = slot_plan(targets, shard_slots, seed)
    # Spark does not see that explode makes many rows of few, and must not broadcast them.
    return parts.withColumn("low", low).withColumn("high", high).drop("size").hint("merge").join(
        slots, ["number", "block"])


def mixed_blocks(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 0, *,
                 key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix itself: per shard and slot the documents whose words fill it, with their place in the
    block (`at`), the document's first word there (from 0) and how many words. A source's last block
    may be shorter than `block_words`."""
    placed, targets = _placed(docs, weights, most, block_words, key, text, source)
    found = _blocks(placed, targets, block_words, shard_slots, seed)
    return found.select(
        "shard", "slot", (F.col("low") - F.col("block") * block_words).alias("at"),
        F.col("doc_id").alias(key), (F.col("low") - F.col("start")).alias("first_word"),
        (F.col("high") - F.col("low")).alias("words"))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST,
        block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 0, *,
        key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """doc_id, h, size, source_size, target, taken (words the mix takes, with repeats) and shards (how
    many output shards hold words of the document)."""
    placed, targets = _placed(docs, weights, most, block_words, key, text, source)
    taken = (_blocks(placed, targets, block_words, shard_slots, seed)
             .groupBy("number", "start", "shard").agg(F.sum(F.col("high") - F.col("low")).alias("words"))
             .groupBy("number", "start").agg(F.sum("words").alias("taken"), F.count("*").alias("shards"))
             .withColumnsRenamed({"number": "_number", "start": "_start"}))
    same = ((placed["number"] == taken["_number"]) & (placed["start"] == taken["_start"])
            & (placed["size"] > 0))
    return placed.hint("merge").join(taken, same, "left").select(
        F.col("doc_id").alias(key), "h", "size", "source_size", "target",
        F.coalesce("taken", F.lit(0)).cast("bigint").alias("taken"),
        F.coalesce("shards", F.lit(0)).cast("bigint").alias("shards"))


def mix_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The documents that the mix takes words of, with size, source_size, target and taken.

    Columns of docs with these names are replaced. Rows that repeat both id and text share what is
    taken of them evenly, rounded up, so the totals exceed the mix by less than a word a repeated row.
    Where such rows differ in their source, all get the largest source_size and target of theirs.
    """
    made = ("size", "source_size", "target")
    found = mix(docs, key=key, text=text, **options).groupBy("h").agg(
        *(F.max(c).alias(c) for c in made),
        F.ceil(F.sum("taken") / F.count("*")).cast("bigint").alias("taken"),
    ).withColumnRenamed("h", "_h").filter("taken > 0")
    rows = docs.drop(*made, "taken")
    same = F.xxhash64(rows[key], rows[text]) == found["_h"]
    return rows.join(found.hint("merge"), same).drop(found["_h"])
