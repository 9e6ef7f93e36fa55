"""Mix sources to target weights by Efraimidis-Spirakis sampling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from cardtide.llm.common import WORD, small, stored, uniform

KEY_BUCKETS = 4096


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def mix(
    docs: DataFrame,
    weights: Sequence[float] = (5.0, 2.0, 1.0),
    share: float = 1.5,
    cap: float = 2.0,
    quality: DataFrame | None = None,
    seed: int = 17,
) -> DataFrame:
    """How many words of each document a mix takes: ``doc_id, source, size,
    source_size, target, taken``.

    Size is the number of words of ``text``. Sources in code point order, null last,
    weigh ``weights`` in turn and share ``share`` times all words; a target stops at
    ``cap`` times its source's words and the excess goes to the others by weight. A
    source gives as many whole epochs of all its documents as fit its target. What is
    left is filled by documents in the order of the keys ``-ln(u) / quality``, u
    uniform by a hash of ``doc_id`` and ``seed``: a weighted sample without
    replacement. The document at the edge gives only the words still wanted, so a
    source meets its target to the word.

    ``quality(doc_id, weight)`` holds positive weights; a document without one weighs
    1. A null or empty text has size 0 and is taken 0 times. Rows that repeat a
    ``doc_id`` are documents of their own with the same key; null ids too. An empty
    table gives an empty result. Columns other than doc_id, text, source are not read.

    No source is sorted in one task: keys are cut into 4,096 ranges, words are added up
    by (source, range), and only the one range of each source in which the target is
    met is summed up row by row.
    """
    sized = docs.select("doc_id", "source", words(F.col("text")).alias("size"))
    weight = F.lit(1.0)
    if quality is not None:
        best = quality.groupBy("doc_id").agg(F.max("weight").alias("weight"))
        sized = sized.join(best, "doc_id", "left")
        weight = F.coalesce("weight", F.lit(1.0))
    key = -F.ln(uniform(seed, "doc_id")) / weight
    rows = sized.select("doc_id", "source", "size", key.alias("key"))
    rows = rows.withColumn("range", F.floor(F.col("key") / (F.col("key") + 1) * KEY_BUCKETS))
    rows = stored(rows, "sized")

    plan = small(stored(source_targets(rows, weights, share, cap), "targets"), 50_000)
    planned = rows.alias("d").join(plan.alias("p"), F.expr("d.source <=> p.source")).select(
        "d.*", "p.rank", "p.source_size", "p.target", "p.epochs", "p.rest"
    )

    sums = (
        planned.filter(F.col("rest") > 0)
        .groupBy("rank", "rest", "range")
        .agg(F.sum("size").alias("words"))
    )
    upto = Window.partitionBy("rank").orderBy("range").rowsBetween(Window.unboundedPreceding, 0)
    edge = (
        sums.withColumn("upto", F.sum("words").over(upto))
        .withColumn("before", F.col("upto") - F.col("words"))
        .filter((F.col("before") < F.col("rest")) & (F.col("upto") >= F.col("rest")))
        .select(F.col("rank").alias("edge_rank"), F.col("range").alias("edge"), "before")
    )
    edge = small(stored(edge, "edges"), 50_000)
    marked = planned.join(edge, F.col("rank") == F.col("edge_rank"), "left")
    whole = marked.withColumn(
        "extra", F.when(F.col("range") < F.col("edge"), F.col("size")).otherwise(0)
    ).filter(F.col("edge").isNull() | (F.col("range") != F.col("edge")))
    ordered = (
        Window.partitionBy("rank")
        .orderBy("key", "doc_id", "size")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    left = F.col("rest") - F.col("before") - (F.sum("size").over(ordered) - F.col("size"))
    parted = marked.filter(F.col("range") == F.col("edge")).withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), left))
    )
    return whole.unionByName(parted).select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        (F.col("epochs") * F.col("size") + F.col("extra")).alias("taken"),
    )


def source_targets(
    sized: DataFrame, weights: Sequence[float], share: float, cap: float
) -> DataFrame:
    """One row per source: ``source, rank, source_size, target, epochs, rest``.

    The level that shares the total among the sources below their caps is found by
    reading them in the order in which they reach it. The windows are over one row
    per source.
    """
    per = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    ranked = per.withColumn("rank", rank)
    weigh = F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") - 1) % len(weights) + 1
    )
    full = F.col("source_size") * F.lit(float(cap))
    ranked = ranked.withColumn("weight", weigh).withColumn("full", full)
    by_reach = Window.orderBy(F.col("full") / F.col("weight"), "rank")
    before = F.coalesce(
        F.sum("full").over(by_reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    behind = F.coalesce(
        F.sum("weight").over(by_reach.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    onward = F.sum("weight").over(Window.partitionBy()) - behind
    everything = F.sum("source_size").over(Window.partitionBy()) * F.lit(float(share))
    read = ranked.withColumn("level", (everything - before) / onward).withColumn(
        "place", F.row_number().over(by_reach)
    )
    fits = F.when(
        F.col("level") * F.col("weight") <= F.col("full"), F.struct("place", "level")
    )
    level = F.min(fits).over(Window.partitionBy())["level"]
    target = F.coalesce(F.least("full", F.col("weight") * level), F.col("full"))
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(0)
    return (
        read.select("source", "rank", "source_size", target.alias("target"))
        .withColumn("epochs", epochs)
        .withColumn(
            "rest",
            F.round(F.col("target") - F.col("epochs") * F.col("source_size")).cast("long"),
        )
    )


def mixed_documents(docs: DataFrame, **how) -> DataFrame:
    """The documents of a mix, with the columns of ``docs``: a document of n whole
    epochs stands n times, and once more if the mix also takes a part of it, then
    whole. Rows that agree in doc_id, source and size are taken alike. Other columns may have
    any names."""
    taken = mix(docs, **how)
    copies = F.ceil(F.try_divide(F.col("taken"), F.col("size"))).cast("int")
    plan = (
        taken.groupBy("doc_id", "source", "size")
        .agg(F.max("taken").alias("taken"))
        .select("doc_id", "source", "size", copies.alias("copies"))
        .filter(F.col("copies") > 0)
    )
    plan = small(stored(plan, "copies")).alias("plan")
    # The caller's row travels in a struct of its own, so that no name meets one of these.
    given = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("given"))
    same = (
        F.col("given.doc_id").eqNullSafe(F.col("plan.doc_id"))
        & F.col("given.source").eqNullSafe(F.col("plan.source"))
        & (words(F.col("given.text")) == F.col("plan.size"))
    )
    each = given.join(plan, same).select("given", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return each.select(*[F.col(f"given.`{c}`").alias(c) for c in docs.columns])
