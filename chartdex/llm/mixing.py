"""Mixing sources to target weights by Pareto order sampling.

Each source gets a target in words, at most ``max_repeat`` times what it holds; what a
source cannot take is reshared among the others by weight. Within a source a document
is wanted ``e`` times, in proportion to the weight of its length class, such that the
wanted words add up to the target. ``floor(e)`` whole copies are certain. What is left,
``p = e - floor(e)``, is an inclusion probability: documents are ranked by random odds
divided by inclusion odds, ``(u / (1 - u)) / (p / (1 - p))``, and taken in that order up
to the rest of the target, so the sample has a fixed size in words (within half a
document) and unequal probabilities. ``u`` is a hash of the id and the seed: reruns agree.

A source may hold any share of the rows. Its order is never sorted in one task: sums of
words per 8-bit digit of the rank (256 rows per source) show in which interval the cut
falls, the same again for the next digit, and only the documents of that last interval,
about one in 65,536, are put in order.

Defined cases: a null source is a source of its own and comes last; null or empty texts
have size 0 and are never sampled; repeated rows are rows of their own; a source without
words has target 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartdex.llm.shared import Workspace, row_key, word_count

#: Words from which a weight holds: texts under 50 words are wanted half as often.
LENGTH_WEIGHTS: tuple[tuple[int, float], ...] = ((0, 0.5), (50, 1.0))
_DIGIT = 256


def source_targets(sources: DataFrame, weights: tuple[float, ...], max_repeat: float, share: float) -> DataFrame:
    """(source, source_size, target) from (source, source_size); one row per source.

    Sources are filled in the order in which they would reach their limit: the first
    ones are capped as long as the common level would lift them above it.
    """
    everything = Window.orderBy(F.col("source").asc_nulls_last())
    place = (F.row_number().over(everything) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), place + 1)
    limited = sources.select("*", weight.alias("weight"), (F.lit(float(max_repeat)) * F.col("source_size")).alias("most"))
    by_limit = Window.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, rest = by_limit.rowsBetween(Window.unboundedPreceding, -1), by_limit.rowsBetween(0, Window.unboundedFollowing)
    whole = by_limit.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    leveled = limited.select(
        "*",
        (F.sum("source_size").over(whole) * F.lit(float(share))).alias("total"),
        F.coalesce(F.sum("most").over(before), F.lit(0.0)).alias("capped_before"),
        F.sum("weight").over(rest).alias("weight_left"),
    ).withColumn("level", (F.col("total") - F.col("capped_before")) / F.col("weight_left"))
    capped = leveled.withColumn("capped", F.col("level") * F.col("weight") > F.col("most"))
    final = capped.select(
        "*",
        F.coalesce(F.sum(F.when(F.col("capped"), F.col("most"))).over(whole), F.lit(0.0)).alias("capped_words"),
        F.sum(F.when(~F.col("capped"), F.col("weight"))).over(whole).alias("free_weight"),
    )
    free = (F.col("total") - F.col("capped_words")) / F.col("free_weight") * F.col("weight")
    return final.select("source", "source_size", F.when(F.col("capped"), F.col("most")).otherwise(free).alias("target"))


def wanted_copies(strata: DataFrame, max_repeat: float) -> DataFrame:
    """(source, weight, copies) such that copies times words add up to each source's target."""
    heaviest = Window.partitionBy("source").orderBy(F.col("weight").desc())
    before, rest = heaviest.rowsBetween(Window.unboundedPreceding, -1), heaviest.rowsBetween(0, Window.unboundedFollowing)
    most = F.lit(float(max_repeat))
    capped_before = most * F.coalesce(F.sum("words").over(before), F.lit(0))
    weighed = F.sum(F.col("weight") * F.col("words")).over(rest)
    rate = F.when(weighed > 0, (F.col("target") - capped_before) / weighed).otherwise(F.lit(0.0))
    leveled = strata.select("*", rate.alias("rate")).withColumn("capped", F.col("rate") * F.col("weight") >= most)
    # the first stratum below the limit fixes the rate of all after it
    first_free = F.first(F.when(~F.col("capped"), F.col("rate")), ignorenulls=True).over(heaviest)
    copies = F.when(F.col("capped"), most).otherwise(F.least(most, F.coalesce(first_free, F.lit(0.0)) * F.col("weight")))
    return leveled.select("source", "source_size", "target", "weight", "words", F.greatest(copies, F.lit(0.0)).alias("copies"))


def _cut_digit(rows: DataFrame, digit: str, already: Column) -> DataFrame:
    """(source, edge, before): the digit in which each source's cut falls, and the words before it."""
    sums = rows.groupBy("source", "rest", already.alias("already"), digit).agg(F.sum("size").alias("words"))
    so_far = Window.partitionBy("source").orderBy(digit).rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("already") + F.coalesce(F.sum("words").over(so_far), F.lit(0))
    reached = sums.select("source", "rest", digit, before.alias("before")).where(F.col("before") <= F.col("rest"))
    return reached.groupBy("source").agg(F.max(digit).alias(f"{digit}_edge"), F.max("before").alias(f"{digit}_before"))


def _with(rows: DataFrame, table: DataFrame, *keys: str, how: str = "left") -> DataFrame:
    """Join on keys of which the first may be null."""
    renamed = table.select(*[F.col(c).alias(f"__{c}" if c in keys else c) for c in table.columns])
    same = F.col(keys[0]).eqNullSafe(F.col(f"__{keys[0]}"))
    for k in keys[1:]:
        same = same & (F.col(k) == F.col(f"__{k}"))
    return rows.join(renamed, same, how).drop(*[f"__{k}" for k in keys])


def mix_documents(
    docs: DataFrame,
    weights: tuple[float, ...] = (1, 2, 3),
    max_repeat: int = 3,
    share: float = 1.0,
    seed: int = 17,
    length_weights: tuple[tuple[int, float], ...] = LENGTH_WEIGHTS,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """One row per document: id, r1, r2 (its key by content), size, source_size, target, copies."""
    work = Workspace(docs.sparkSession, "mix")
    size = word_count(F.col(text_col))
    weight = F.lit(float(length_weights[0][1]))
    for least, w in length_weights[1:]:
        weight = F.when(F.col("size") >= least, F.lit(float(w))).otherwise(weight)
    r1, r2 = row_key(F.col(id_col), F.col(text_col))
    sized = work.cut(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), size.alias("size"),
            r1.alias("r1"), r2.alias("r2"),
        ).withColumn("weight", weight),
        "sized",
    )
    strata = work.cut(sized.groupBy("source", "weight").agg(F.sum("size").alias("words")), "strata")
    sources = strata.groupBy("source").agg(F.sum("words").alias("source_size"))
    targets = work.cut(source_targets(sources, weights, max_repeat, share), "targets")
    copies = wanted_copies(_with(strata, targets, "source"), max_repeat)
    chance = F.col("copies") - F.floor("copies")
    own = Window.partitionBy("source")
    plan = work.cut(
        copies.select(
            "source", "weight", "source_size", "target", F.floor("copies").alias("certain"), chance.alias("chance"),
            F.sum(chance * F.col("words")).over(own).alias("rest"),
        ),
        "plan",
    )

    # 53 random bits from row and seed, strictly between 0 and 1; rows of one id, or without one, draw apart
    bits = F.shiftright(F.xxhash64(F.lit(seed), F.col("id").isNull(), "id", "r1", "r2"), 11).cast("double") + F.lit(2.0**52)
    u = (bits + 0.5) / F.lit(2.0**53)
    p = F.col("chance")
    # odds / (1 + odds): the same order, within 0 and 1
    rank = u * (1 - p) / (u * (1 - p) + (1 - u) * p)
    digits = F.least(F.floor(F.col("rank") * _DIGIT * _DIGIT), F.lit(_DIGIT * _DIGIT - 1)).cast("int")
    ranked = work.cut(
        _with(sized, plan, "source", "weight")
        .withColumn("rank", F.when((p > 0) & (F.col("size") > 0), rank))
        .select(
            "*", F.floor(digits / _DIGIT).cast("int").alias("high"), (digits % _DIGIT).cast("int").alias("low"),
        ),
        "ranked",
    )
    open_rows = ranked.where(F.col("rank").isNotNull())
    high = work.cut(_cut_digit(open_rows, "high", F.lit(0).cast("bigint")), "high")
    in_high = _with(open_rows, high, "source").where(F.col("high") == F.col("high_edge"))
    low = work.cut(_cut_digit(in_high, "low", F.col("high_before")), "low")
    placed = _with(_with(ranked, high, "source"), low, "source")
    on_edge = F.coalesce((F.col("high") == F.col("high_edge")) & (F.col("low") == F.col("low_edge")), F.lit(False))
    below = (F.col("high") < F.col("high_edge")) | (
        (F.col("high") == F.col("high_edge")) & (F.col("low") < F.col("low_edge"))
    )
    order = Window.partitionBy("source").orderBy("rank", "id", "r1", "r2").rowsBetween(Window.unboundedPreceding, -1)
    words_before = F.col("low_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    edge = placed.where(on_edge).withColumn("more", (words_before + F.col("size") / 2 <= F.col("rest")).cast("int"))
    others = placed.where(~on_edge).withColumn("more", F.coalesce(below, F.lit(False)).cast("int"))
    return others.unionByName(edge).select(
        F.col("id").alias(id_col),
        "r1",
        "r2",
        "size",
        "source_size",
        "target",
        (F.col("certain") + F.col("more")).cast("bigint").alias("copies"),
    )


def repeat_documents(docs: DataFrame, mixed: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents of the mix, each as many times as it is taken.

    Rows that are equal in id and text share their copies out among themselves.
    """
    taken = mixed.groupBy("r1", "r2").agg(F.sum("copies").alias("copies"), F.count("*").alias("rows"))
    doc = docs.select(F.struct("*").alias("doc"))
    r1, r2 = row_key(F.col("doc")[id_col], F.col("doc")[text_col])
    joined = doc.select("doc", r1.alias("r1"), r2.alias("r2")).join(taken.where(F.col("copies") > 0), ["r1", "r2"])
    twin = F.row_number().over(Window.partitionBy("r1", "r2").orderBy(F.col("doc")[id_col]))
    own = F.floor((F.col("copies") + F.col("rows") - twin) / F.col("rows")).cast("int")
    repeated = joined.withColumn("own", own).where(F.col("own") > 0)
    return repeated.select("doc", F.explode(F.sequence(F.lit(1), F.col("own"))).alias("n")).select("doc.*")
