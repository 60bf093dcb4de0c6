"""Mixing sources to target weights: Sainte-Lague quotas for sources and shards, then a seeded choice of blocks.

Only DataFrame functions. A source's words form token lines, one per shard, in the order of a seeded hash; a line is cut
into blocks of equal length and a quota says how many blocks the mix takes, running round the line from a seeded start.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cohortlake.llm.common import WORD_PATTERN


def n_words(text: Column) -> Column:
    """Words between ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def word_weight_targets(
    sources: DataFrame, *, size: str, weight: str, share: float, max_epochs: int, source: str = "source"
) -> DataFrame:
    """Targets of a mix: ``share`` times all sizes split by weight, no source above ``max_epochs`` times its size.

    What a full source cannot take is reshared by weight among the others (water filling). Sources fill up in the
    order of size over weight, so the level is found from running sums over one row per source. Expects one row per
    source; adds ``target`` (double). Sources of size 0 get 0.
    """
    order = W.orderBy(F.col(size) * F.lit(1.0) / F.col(weight), F.col(source).asc_nulls_last())
    before = order.rowsBetween(W.unboundedPreceding, -1)
    after = order.rowsBetween(0, W.unboundedFollowing)
    everything = W.partitionBy()
    cap = F.col(size) * max_epochs
    budget = F.least(F.sum(size).over(everything) * share, F.sum(cap).over(everything).cast("double"))
    level = (budget - F.coalesce(F.sum(cap).over(before), F.lit(0))) / F.sum(weight).over(after)
    # the first source that its share does not fill sets the level for itself and all after it
    return (
        sources.withColumn("_level", level)
        .withColumn("_open", F.when(F.col("_level") * F.col(weight) <= cap, F.col("_level")))
        .withColumn("_level", F.first("_open", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, 0)))
        .withColumn("target", F.coalesce(F.least(F.col("_level") * F.col(weight), cap.cast("double")), cap.cast("double")))
        .drop("_level", "_open")
    )


def sainte_lague(df: DataFrame, *, key: Sequence[str], votes: str, seats: str, group: Sequence[str] = ()) -> DataFrame:
    """Seats per key in proportion to its votes within each group: the ``seats`` highest quotients votes / (2 k + 1) win.

    No loop over seats: with T votes for N seats and S keys, ``round(v / d)`` at d = T / (N - S/2) gives no key more than
    it wins and at d = T / (N + S/2) no key less, so that at most about 2 S quotients between the two need ranking.
    Ties go to the smaller key, nulls last. ``seats`` is the same for all rows of a group. Adds ``n_seats`` (long);
    keys without votes get none. A group's quotients are ranked together: groups are catalogues of sources or of
    shards, never documents.
    """
    g = W.partitionBy(*group)
    t, s = F.sum(votes).over(g), F.count("*").over(g)
    low = F.when(F.col(seats) > s / 2, F.greatest(F.floor(F.col(votes) * (F.col(seats) - s / 2) / t + 0.5) - 1, F.lit(0))).otherwise(0)
    high = F.floor(F.col(votes) * (F.col(seats) + s / 2) / t + 0.5) + 1
    bounds = df.withColumn("_low", F.when(t > 0, low).otherwise(0).cast("long")).withColumn(
        "_high", F.when((t > 0) & (F.col(votes) > 0), high).otherwise(0).cast("long")
    )
    open_seats = F.col(seats) - F.sum("_low").over(g)
    rank = F.row_number().over(
        W.partitionBy(*group).orderBy(
            (F.col(votes) / (2 * F.col("_k") + 1)).desc(), *[F.col(c).asc_nulls_last() for c in key]
        )
    )
    won = (
        bounds.withColumn("_open", open_seats)
        .where("_high > _low")
        .withColumn("_k", F.explode(F.sequence("_low", F.col("_high") - 1)))
        .withColumn("_rank", rank)
        .where("_rank <= _open")
        .groupBy(*group, *key)
        .agg(F.count("*").alias("_won"))
    )
    same = [F.col(f"b.{c}").eqNullSafe(F.col(f"w.{c}")) for c in (*group, *key)]
    joined = bounds.alias("b").join(won.alias("w"), on=_all(same), how="left")
    return joined.select(
        *[F.col(f"b.{c}") for c in df.columns],
        (F.col("b._low") + F.coalesce(F.col("w._won"), F.lit(0))).alias("n_seats"),
    )


def _all(conditions: Sequence[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def mix(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[int] = (5, 2, 1),
    share: float = 1.5,
    max_epochs: int = 2,
    block_words: int = 32,
    shard_words: int = 1 << 19,
    seed: str = "mix-1",
    keep: Sequence[str] = (),
) -> DataFrame:
    """What a mix of sources takes of every document.

    Sources in code-point order, null last, weigh ``weights`` in turn. Returns per input row ``doc_id, size,
    source_size, target, taken`` and the columns in ``keep``. A source's blocks of ``block_words`` are apportioned
    to its shards (about ``shard_words`` each, by hash of the id, so a hot source is many shards); a shard takes whole
    passes first and then a run of blocks from a seeded start, so that ``taken`` is at most ``max_epochs * size`` and
    a source misses its target by about a block per shard.

    Null and empty texts have size 0 and take 0. A null source is a source of its own. Repeated rows are taken like
    any others; where id and text are the same, either may come first, with the same rows in the result. Null ids
    share a place in the order that only their size settles. An empty table gives an empty one; other columns are ignored
    unless kept.
    """
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("null"))))
    base = docs.select(
        F.col(id_col).alias("_id"),
        F.col(source_col).alias("_source"),
        n_words(F.col(text_col)).alias("size"),
        digest.alias("_order"),
        F.struct(*[F.col(c) for c in keep] or [F.lit(None).cast("int").alias("none")]).alias("_kept"),
    )
    sized = base.groupBy("_source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(W.orderBy(F.col("_source").asc_nulls_last())) - 1
    weighted = sized.withColumn("_weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (place % len(weights) + 1).cast("int")))
    targets = word_weight_targets(
        weighted, size="source_size", weight="_weight", share=share, max_epochs=max_epochs, source="_source"
    )
    total = F.sum("target").over(W.partitionBy())
    quotas = sainte_lague(
        targets.withColumn("_blocks", F.round(total / block_words).cast("long")),
        key=["_source"], votes="target", seats="_blocks",
    ).withColumn("_shards", F.greatest(F.ceil(F.col("source_size") / shard_words), F.lit(1)).cast("long"))
    quotas = quotas.select("_source", "source_size", "target", "_shards", F.col("n_seats").alias("_source_blocks"))

    shard = F.conv(F.substring("_order", 1, 8), 16, 10).cast("long") % F.col("_shards")
    placed = base.alias("d").join(
        quotas.alias("q"), F.col("d._source").eqNullSafe(F.col("q._source"))
    ).select("d._id", "d._source", "d.size", "d._order", "d._kept", "q.source_size", "q.target", "q._source_blocks", shard.alias("_shard"))
    lines = placed.groupBy("_source", "_shard").agg(
        F.sum("size").alias("_line"), F.first("_source_blocks").alias("_source_blocks")
    )
    per_shard = sainte_lague(lines, key=["_shard"], votes="_line", seats="_source_blocks", group=["_source"])
    n_blocks = F.ceil(F.col("_line") / block_words).cast("long")
    words = F.least(F.col("n_seats") * block_words, F.col("_line") * max_epochs)
    start = F.conv(F.substring(F.md5(F.concat_ws(":", F.lit(seed), F.coalesce("_source", F.lit("null")), "_shard")), 1, 8), 16, 10).cast("long")
    per_shard = per_shard.select(
        F.col("_source").alias("_s"), F.col("_shard").alias("_h"), "_line",
        F.when(F.col("_line") > 0, F.floor(words / F.col("_line"))).otherwise(0).cast("long").alias("_passes"),
        F.when(F.col("_line") > 0, words % F.col("_line")).otherwise(0).cast("long").alias("_rest"),
        F.when(F.col("_line") > 0, start % n_blocks * block_words).otherwise(0).cast("long").alias("_from"),
    )
    line = W.partitionBy("_source", "_shard").orderBy("_order", F.col("_id").asc_nulls_last(), "size")
    runs = (
        placed.withColumn("_end", F.sum("size").over(line.rowsBetween(W.unboundedPreceding, 0)))
        .join(per_shard, F.col("_source").eqNullSafe(F.col("_s")) & (F.col("_shard") == F.col("_h")))
        .withColumn("_begin", F.col("_end") - F.col("size"))
    )
    to = F.col("_from") + F.col("_rest")

    def overlap(low: Column, high: Column) -> Column:
        return F.greatest(F.least(F.col("_end"), high) - F.greatest(F.col("_begin"), low), F.lit(0))

    partial = overlap(F.col("_from"), F.least(to, F.col("_line"))) + overlap(F.lit(0), to - F.col("_line"))
    return runs.select(
        F.col("_id").alias(id_col), "size", "source_size", "target",
        (F.col("_passes") * F.col("size") + partial).cast("long").alias("taken"),
        *[F.col(f"_kept.{c}").alias(c) for c in keep],
    )
