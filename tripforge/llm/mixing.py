"""Mixing sources to target weights by capped water-filling.

Sources share a budget of words (all words by default) by weight.  A source
stops at ``max_epochs`` times its size; what it cannot take is shared again
among the others by weight, until none is above its cap.  A source then takes
``floor(target / size)`` whole repetitions of every document, and a seeded
sample of its documents once more for the rest: documents in the order of
``md5(seed:doc_id)`` while they fit, and of the one document at the edge its
first words, so a source's words meet its target to a rounding.

Sizes are words.  A null source is a source of its own, after all others; null
and blank texts have size 0 and are never taken.  Repeated rows and equal ids
are documents of their own; among equal (id, size) rows it does not matter
which one is taken.  An empty table gives no rows; a source of size 0 has
target 0.  Extra columns pass through.

The texts are read once, into a table of sizes.  A source's order is cut into
4096 hash bins whose word sums decide all bins but the one at the edge; only
that bin is ordered document by document, so a source with a third of all rows
puts no more than a 4096th of them into one window.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tripforge.llm.common import bits_of, marked, numbered, staged, text_of, words_of

CYCLE = (1.0, 2.0, 3.0)


def cyclic_weights(totals: DataFrame, cycle=CYCLE) -> DataFrame:
    """Weights 1, 2, 3, repeating, to sources in code point order, null last
    (one row for each source)."""
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(cycle)
    return totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in cycle]), place + 1))


def water_fill(totals: DataFrame, budget: float | None = None, max_epochs: float = 3.0) -> DataFrame:
    """``totals`` (source_size, weight, ...) with ``target``: clamps the sources
    above their cap, shares the rest anew, and so on until none is above.

    Every round is one aggregate of the sources that are still below; the level
    only rises, so a clamped source stays clamped and the rounds end."""
    cap, w = F.col("source_size") * F.lit(float(max_epochs)), F.col("weight")
    level = -1.0
    while True:
        over = w * F.lit(level) > cap if level >= 0 else F.lit(False)
        r = totals.agg(F.sum("source_size").alias("all"), F.sum(F.when(over, cap).otherwise(0.0)).alias("clamped"),
                       F.sum(F.when(over, 0.0).otherwise(w)).alias("open")).first()
        if not r["open"]:          # no sources, or all at their cap
            break
        new = max(level, (float(budget if budget is not None else r["all"]) - r["clamped"]) / r["open"])
        if new <= level:
            break
        level = new
    return totals.withColumn("target", F.least(cap, w * F.lit(max(level, 0.0))))


def mix_plan(docs: DataFrame, weights: DataFrame | None = None, budget: float | None = None,
             max_epochs: float = 3.0, seed: int = 17, bins: int = 4096, key: str = "doc_id",
             order_by: str | None = None) -> DataFrame:
    """(key, source, size, source_size, target, taken): one row per document.

    ``weights``: (source, weight) by source name; None gives 1, 2, 3, repeating.
    ``taken`` counts words; ``taken // size`` whole repetitions and the first
    ``taken % size`` words of one more.  The sample's order is a hash of
    ``order_by`` (else of the key)."""
    sizes = staged(docs.select(
        F.col(key), F.col("source").cast("string").alias("source"),
        F.size(words_of(text_of())).cast("long").alias("size"),
        F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(order_by or key).cast("string"))).alias("order")).withColumn(
            "bin", F.conv(F.substring("order", 1, 8), 16, 10).cast("long") % bins), "sizes")
    bin_sums = staged(sizes.groupBy("source", "bin").agg(F.sum("size").alias("words")), "bins")
    totals = staged(bin_sums.groupBy("source").agg(F.sum("words").alias("source_size")), "sources")
    if weights is None:
        totals = cyclic_weights(totals)
    else:
        named = weights.select(F.col("source").alias("__s"), F.col("weight").cast("double").alias("weight"))
        totals = totals.join(named, F.col("source").eqNullSafe(F.col("__s")), "left").drop("__s").fillna(0.0, ["weight"])
    plan = water_fill(totals, budget, max_epochs).withColumn(
        "whole", F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long"))
    plan = staged(plan.withColumn("more", F.round("target").cast("long") - F.col("whole") * F.col("source_size")), "plan")

    def by_source(df: DataFrame, other: DataFrame, *more: str) -> DataFrame:
        right = other.select(F.col("source").alias("__s"), *[F.col(m).alias(f"__{m}") for m in more],
                             *[c for c in other.columns if c not in ("source", *more)])
        on = df["source"].eqNullSafe(F.col("__s"))
        for m in more:
            on = on & (df[m] == F.col(f"__{m}"))
        return df.join(right, on).drop("__s", *[f"__{m}" for m in more])

    # words of the bins before a bin; the bin in which the sample ends is split
    before = F.sum("words").over(Window.partitionBy("source").orderBy("bin")) - F.col("words")
    edges = by_source(bin_sums.withColumn("before", before), plan).select(
        "source", "bin", "source_size", "target", "whole",
        F.when(F.col("before") + F.col("words") <= F.col("more"), F.lit("in"))
        .when(F.col("before") >= F.col("more"), F.lit("out")).otherwise(F.lit("edge")).alias("state"),
        (F.col("more") - F.col("before")).alias("room"))
    placed = staged(by_source(sizes, staged(edges, "edges"), "bin"), "placed")
    window = Window.partitionBy("source", "bin").orderBy("order", key, "size").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    edge = placed.filter("state = 'edge'").withColumn("until", F.sum("size").over(window)).withColumn(
        "extra", F.greatest(F.lit(0), F.least(F.col("size"), F.col("room") - F.col("until") + F.col("size")))).drop("until")
    rest = placed.filter("state <> 'edge'").withColumn(
        "extra", F.when(F.col("state") == "in", F.col("size")).otherwise(0).cast("long"))
    return rest.unionByName(edge).select(
        key, "source", "size", "source_size", F.col("target").cast("double").alias("target"),
        (F.col("whole") * F.col("size") + F.col("extra")).alias("taken"))


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself, with the columns of ``docs``: every document as many
    times as it is taken whole, and the document at a source's edge once more
    with its first words (joined by one space)."""
    rows = numbered(docs)
    plan = mix_plan(rows, key="__row", order_by="doc_id", **options).filter("size > 0 AND target > 0")
    whole = F.floor(F.col("target") / F.col("source_size")).cast("long")
    plan = staged(plan.select("__row", "source", "size", whole.alias("whole"),
                              (F.col("taken") - whole * F.col("size")).alias("more")), "taken")
    # whole repetitions hang on the source, one more is a bit of the row, and a
    # source has at most one document of which only the first words are taken
    sources = staged(plan.groupBy(F.col("source").alias("__source")).agg(F.first("whole").alias("__whole")), "repetitions")
    once_more = staged(bits_of(plan.filter("more = size").select("__row")), "once-more")
    parts = staged(plan.filter("more > 0 AND more < size").select("__row", F.col("more").cast("int").alias("__more")), "parts")
    mine = rows.join(sources, rows["source"].cast("string").eqNullSafe(F.col("__source"))).drop("__source")
    mine = marked(mine, once_more, "__again").join(parts, "__row", "left")
    copies = F.concat(F.array_repeat(F.lit(0), F.col("__whole").cast("int") + F.col("__again").cast("int")),
                      F.when(F.col("__more").isNotNull(), F.array("__more")).otherwise(F.array().cast("array<int>")))
    out = mine.filter(text_of().rlike(r"[^\x20\x09-\x0D]")).withColumn("__part", F.explode(copies))
    head = F.array_join(F.slice(words_of(text_of()), 1, F.greatest(F.col("__part"), F.lit(1))), " ")
    cols = [F.col(f"`{c}`") for c in docs.columns]
    return out.withColumn("text", F.when(F.col("__part") > 0, head).otherwise(F.col("text"))).select(*cols)
