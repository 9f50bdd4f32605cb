"""Mixing sources to target weights by Sainte-Lague apportionment of equal blocks.

The words of a source are dealt into shards, and a shard's documents are laid end to end in
a seeded order and cut into blocks of equal length. Blocks are seats: sources get seats by
their targets, and shards by their words, each time by highest quotients w, w/3, w/5 and so
on. A shard whose quota is q of n blocks takes all of them q div n times and a run of
q mod n blocks from a seeded place.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candlemill.llm.common import saved

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
# Words in a block, and in a shard: a hot source has many shards, none of them large.
BLOCK_WORDS = 16
SHARD_WORDS = 1_000_000
SEED = 41
WORD = r"[^\x20\x09-\x0D]+"


def sainte_lague(weights: np.ndarray, seats: int, most: np.ndarray | None = None) -> np.ndarray:
    """Seats by highest quotients w / (2 k + 1), ties to the earlier; ``most`` bounds each.

    Seats that all bounds together leave over are not given.
    """
    weights = np.asarray(weights, float)
    given = np.zeros(len(weights), np.int64)
    if seats <= 0 or weights.sum() <= 0:
        return given
    # Rounding at a common divisor is right but for a few seats, which then move one by one.
    given = np.floor(weights * (seats / weights.sum()) + 0.5).astype(np.int64)
    most = np.full(len(weights), np.iinfo(np.int64).max) if most is None else np.asarray(most)
    given = np.minimum(given, most)
    missing = seats - int(given.sum())
    if missing < 0:
        last = [(w / (2 * g - 1), -i) for i, (w, g) in enumerate(zip(weights, given)) if g > 0]
        heapq.heapify(last)
        for _ in range(-missing):
            i = -heapq.heappop(last)[1]
            given[i] -= 1
            if given[i] > 0:
                heapq.heappush(last, (weights[i] / (2 * given[i] - 1), -i))
    else:
        ahead = [
            (-w / (2 * g + 1), i)
            for i, (w, g) in enumerate(zip(weights, given))
            if g < most[i] and w > 0
        ]
        heapq.heapify(ahead)
        while missing and ahead:
            i = heapq.heappop(ahead)[1]
            given[i] += 1
            missing -= 1
            if given[i] < most[i]:
                heapq.heappush(ahead, (-weights[i] / (2 * given[i] + 1), i))
    return given


def source_targets(
    sized: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_repeats: float = MOST_REPEATS,
) -> DataFrame:
    """(source, place, source_size, target) from (source, size).

    Sources in code point order, null last, weigh ``weights`` in turn and share ``share``
    times all sizes. A target stops at ``most_repeats`` times its source's size; with the
    sources in the order of size by weight, those that stop are the first ones, and the
    others share what these leave. One row for each source goes through one task.
    """
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    sources = sources.withColumn("place", F.row_number().over(in_order) - 1)
    turn = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int")
    )
    limit = F.col("source_size") * float(most_repeats)
    sources = sources.withColumn("weight", turn).withColumn("most", limit)
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("most") / F.col("weight"), "place").rowsBetween(
        Window.unboundedPreceding, -1
    )
    left = F.sum("source_size").over(whole) * float(share) - F.coalesce(
        F.sum("most").over(before), F.lit(0.0)
    )
    weight_left = F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    sources = sources.withColumn("level", left / weight_left)
    target = F.least("most", F.col("weight") * F.max("level").over(whole))
    return sources.select("source", "place", "source_size", target.alias("target"))


def _seats_of_sources(block_words: int):
    def run(sources: pd.DataFrame) -> pd.DataFrame:
        sources = sources.sort_values("place")
        seats = int(round(sources["target"].sum() / block_words))
        sources["seats"] = sainte_lague(sources["target"].to_numpy(), seats)
        return sources[["source", "place", "source_size", "target", "seats"]]

    return run


def _quotas_of_shards(most_repeats: int):
    def run(shards: pd.DataFrame) -> pd.DataFrame:
        shards = shards.sort_values("shard")
        words, blocks = shards["words"].to_numpy(), shards["blocks"].to_numpy()
        seats = int(shards["seats"].iloc[0])
        shards["quota"] = sainte_lague(words, seats, blocks * most_repeats)
        return shards[["place", "shard", "words", "blocks", "quota"]]

    return run


def _overlap(low, high):
    """Words of the document's stretch that lie in [low, high), as (from, to) of its own."""
    start, end = F.col("start"), F.col("start") + F.col("size")
    a, b = F.greatest(start, low), F.least(end, high)
    return F.when(b > a, F.struct((a - start).alias("a"), (b - start).alias("b")))


def mix(
    docs: DataFrame,
    weights: tuple[float, ...] = WEIGHTS,
    share: float = SHARE,
    most_repeats: int = MOST_REPEATS,
    block_words: int = BLOCK_WORDS,
    shard_words: int = SHARD_WORDS,
    seed: int = SEED,
) -> DataFrame:
    """How much of each row of ``docs`` (doc_id, text, source, ...) the mix takes.

    Returns (doc_id, size, source_size, target, taken, source, copies, parts): the words of
    the row and of its source, the source's target, the words taken, of which ``copies``
    times the whole and the word ranges ``parts`` (from a, to b, counted from 0). A null or
    empty text has no words and is not taken. Repeated rows are rows of their own. The
    same rows give the same mix whatever their order or partitions; rows alike in id and
    size cannot be told apart. No rows give no rows. Further columns are not looked at.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = saved(docs.select("doc_id", "source", size.alias("size")), "sized")
    targets = source_targets(sized, weights, share, most_repeats)
    seats = "source string, place int, source_size long, target double, seats long"
    targets = targets.withColumn("all", F.lit(0)).groupBy("all")
    targets = targets.applyInPandas(_seats_of_sources(block_words), seats)
    targets = saved(targets, "targets")

    shards = F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words))
    shard = F.pmod(F.xxhash64("doc_id", "size", F.lit(seed)), shards)
    dealt = (
        sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("shard", shard)
        .select("doc_id", "source", "size", "place", "shard", "source_size", "target", "seats")
    )
    words = dealt.groupBy("place", "shard").agg(
        F.sum("size").alias("words"), F.first("seats").alias("seats")
    )
    blocks = F.round(F.col("words") / block_words).cast("long")
    blocks = F.when(F.col("words") > 0, F.greatest(F.lit(1), blocks)).otherwise(0)
    quotas = words.withColumn("blocks", blocks).groupBy("place")
    quotas = quotas.applyInPandas(
        _quotas_of_shards(most_repeats), "place int, shard long, words long, blocks long, quota long"
    )

    order = F.xxhash64("doc_id", "size", F.lit(seed + 1))
    laid = Window.partitionBy("place", "shard").orderBy(order, "doc_id", "size")
    before = F.sum("size").over(laid.rowsBetween(Window.unboundedPreceding, -1))
    laid_out = dealt.withColumn("start", F.coalesce(before, F.lit(0)))
    out = laid_out.join(quotas, ["place", "shard"])
    out = out.withColumn("copies", F.expr("if(blocks = 0, 0, quota div blocks)"))
    out = out.withColumn("extra", F.expr("if(blocks = 0, 0, quota % blocks)"))
    first = F.expr(f"if(blocks = 0, 0, pmod(xxhash64(place, shard, {seed}), blocks))")
    out = out.withColumn("first", first)

    def edge(block: str):
        return F.expr(f"if(blocks = 0, 0, ({block}) * words div blocks)")

    ahead = _overlap(edge("first"), edge("least(first + extra, blocks)"))
    around = _overlap(F.lit(0), edge("greatest(first + extra - blocks, 0)"))
    out = out.withColumn("parts", F.array_compact(F.array(around, ahead)))
    taken = F.col("copies") * F.col("size") + F.aggregate(
        "parts", F.lit(0).cast("long"), lambda n, p: n + p["b"] - p["a"]
    )
    return out.select(
        "doc_id", "size", "source_size", "target", taken.alias("taken"), "source", "copies", "parts"
    )
