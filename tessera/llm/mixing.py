"""Mixing sources to target shares by systematic sampling.

Sizes are tokens. A source's rate is the expected number of copies of each of its documents: its target divided by its
tokens, at most ``max_repeats``. The documents of a source stand in a fixed order (size class, seeded hash within it), their
expected copies are summed up along it, one random offset is added, and a document is emitted once per integer
crossed. So a document appears floor(rate) or ceil(rate) times, never more than ``max_repeats``, and ordering by size
class keeps the emitted tokens close to the target.

Scale: the sums run in two levels. Documents fall into blocks (source, size class, leading bits of the hash), about ``BLOCK_BYTES`` of
the sizes' table each by the optimizer's estimate; the blocks' counts are aggregated before the shuffle and summed up within each size
class and over the classes, and only inside a block are rows numbered. A source with a third of all documents is spread over all its blocks.

Defined results: sources match ignoring case and outer blanks; documents of other or null sources take no part; null and empty
texts have no tokens but may be emitted (they weigh nothing); a target source without documents or tokens has an actual
size of 0; null max_repeats counts as 1, a null share or total as 0; repeated rows of ``targets`` for one source are taken once (the
largest). Rows are documents: two rows of one doc_id are two.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.sampling import seeded_priority
from tessera.session import stored

#: Bytes of the table of sizes for which there is one block of each source and class.
BLOCK_BYTES = 1 << 20


def source_key(column: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(column, r"(?U)^\s+|\s+$", "")))


def size_class(n: Column) -> Column:
    """Four classes for each doubling of the size; null counts as 0."""
    m = F.coalesce(n.cast("bigint"), F.lit(0)) + 1
    octave = F.length(F.bin(m)) - 1
    return (4 * octave + F.floor(m * 4 / F.pow(F.lit(2.0), octave)) - 4).cast("int")


def mix(sized: DataFrame, targets: DataFrame, seed: int = 7, blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(mix, report) of ``sized`` (doc_id, source, n_tokens) and ``targets`` (source, target_pct, max_repeats, total_tokens).

    mix: doc_id, source, n_tokens, copy (from 1). report: source, target_tokens, available_tokens, documents, rate,
    mixed_tokens, target_share, actual_share, short (every document is used as often as it may be, and the mix is still below the target).
    ``sized`` is read several times: give it written (see :func:`tessera.session.stored`).
    """
    wanted = targets.filter("source IS NOT NULL").groupBy(source_key(F.col("source")).alias("_key")).agg(
        F.min("source").alias("_source"), F.coalesce(F.max("target_pct").cast("bigint"), F.lit(0)).alias("_pct"), F.coalesce(F.max("max_repeats").cast("bigint"), F.lit(1)).alias("_repeats"),
        F.coalesce(F.max("total_tokens").cast("bigint"), F.lit(0)).alias("_total"),
    )
    docs = sized.select("doc_id", source_key(F.col("source")).alias("_key"), F.col("n_tokens").cast("bigint").alias("n_tokens")).join(wanted.select("_key"), "_key")
    if blocks is None:
        size = int(sized._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
        blocks = max(1, math.ceil((size if size < 1 << 60 else 32 * sized.count()) / BLOCK_BYTES))
    mark = seeded_priority(seed, F.col("doc_id"))
    placed = docs.withColumn("_mark", mark).withColumn("_class", size_class(F.col("n_tokens"))).withColumn("_block", F.floor(F.col("_mark") / 2.0**60 * blocks).cast("bigint"))
    counts = placed.groupBy("_key", "_class", "_block").agg(F.count("*").alias("_n"), F.sum("n_tokens").alias("_tokens"))
    classes = counts.groupBy("_key", "_class").agg(F.sum("_n").alias("_n"), F.sum("_tokens").alias("_tokens"))
    sizes = classes.groupBy("_key").agg(F.sum("_tokens").alias("_tokens"), F.sum("_n").alias("_documents"))
    goal = F.col("_pct") * F.col("_total") / 100
    rates = (
        wanted.join(sizes, "_key", "left").na.fill(0, ["_tokens", "_documents"])
        .withColumn("_rate", F.when(F.col("_tokens") > 0, F.least(F.col("_repeats").cast("double"), goal / F.col("_tokens"))).otherwise(0.0))
        .withColumn("_offset", seeded_priority(seed, F.concat(F.lit("offset|"), F.col("_key"))) / 2.0**60)
    )
    # Documents before a block: those of smaller classes (at most 256 numbers a source) and of blocks before it in its class.
    before = lambda *order: Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    of_class = classes.select("_key", "_class", F.coalesce(F.sum("_n").over(before("_class").partitionBy("_key")), F.lit(0)).alias("_smaller"))
    in_class = counts.select("_key", "_class", "_block", F.coalesce(F.sum("_n").over(before("_block").partitionBy("_key", "_class")), F.lit(0)).alias("_earlier"))
    firsts = in_class.join(of_class, ["_key", "_class"]).join(rates.select("_key", "_source", "_rate", "_repeats", "_offset"), "_key")
    inside = Window.partitionBy("_key", "_class", "_block").orderBy("_mark", "doc_id")
    ranked = placed.withColumn("_rank", F.row_number().over(inside)).join(firsts, ["_key", "_class", "_block"]).withColumn("_place", F.col("_smaller") + F.col("_earlier") + F.col("_rank"))
    upto = F.col("_rate") * F.col("_place") + F.col("_offset")
    from_ = F.col("_rate") * (F.col("_place") - 1) + F.col("_offset")
    # At the cap every document has as many copies, however the products are rounded.
    crossed = F.when(F.col("_rate") >= F.col("_repeats"), F.col("_repeats")).otherwise(F.least(F.floor(upto) - F.floor(from_), F.col("_repeats")))
    emitted = ranked.withColumn("_copies", crossed.cast("int")).filter("_copies > 0")
    mixed = emitted.select("doc_id", F.col("_source").alias("source"), "n_tokens", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("copy"))
    used = emitted.groupBy("_key").agg(F.sum(F.col("n_tokens") * F.col("_copies")).alias("_mixed"))
    over_all = Window.partitionBy()  # one row per target source
    filled = (F.col("_tokens") == 0) | (F.col("_rate") >= F.col("_repeats"))
    report = rates.join(used, "_key", "left").na.fill(0, ["_mixed"]).select(
        F.col("_source").alias("source"), goal.alias("target_tokens"), F.col("_tokens").alias("available_tokens"), F.col("_documents").alias("documents"),
        F.col("_rate").alias("rate"), F.col("_mixed").alias("mixed_tokens"), (F.col("_pct") / 100).alias("target_share"),
        F.coalesce(F.try_divide(F.col("_mixed"), F.sum("_mixed").over(over_all)), F.lit(0.0)).alias("actual_share"),
        (filled & (F.col("_mixed") * 100 < F.col("_pct") * F.col("_total"))).alias("short"),
    )
    return mixed, report


def sized_documents(documents: DataFrame, targets: DataFrame, n_tokens: Column) -> DataFrame:
    """(doc_id, source, n_tokens) of the documents of wanted sources, tokenised once and written to the shared folder."""
    wanted = targets.select(source_key(F.col("source")).alias("_key")).distinct()
    own = documents.select("doc_id", "source", "text", source_key(F.col("source")).alias("_key")).join(wanted, "_key", "left_semi")
    return stored(own.select("doc_id", "source", n_tokens.alias("n_tokens")))
