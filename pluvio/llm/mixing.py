"""Mixing sources to target weights by capped water-filling.

Every source asks for words in proportion to its weight. A source stops at
``max_epochs`` times its own words; what it cannot give is shared among the
rest by weight, until none is above its cap. A source's target is then met
by whole repetitions of all its documents and one seeded fractional
repetition of some of them.

The fractional repetition is a prefix of the source's documents in the
order of a seeded hash of id and text, so reruns agree. Rows that are equal in
both are one unit, of which some copies may be taken and the others not. The
prefix sums never gather a source in one task: they are taken over 4096 hash
buckets, then over the 4096 parts of the one bucket that holds the cut, then
over that part. Documents above a thousandth of their source's words, at most a
thousand per source, are chosen first, one by one, so that they cannot make
the sum miss its target by much. Where a unit is taken in part, its rows are
numbered over all tasks by a range sort.

All of it is DataFrame operations; one number (the water level) is on the
driver between rounds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.common import WORD, free_prefix, global_rank, staged

#: Documents above this share of their source's words are chosen one by one.
LONG_SHARE = 1 / 1000
#: Plans of at most so many sources are broadcast (each row under 10 KB).
BROADCAST_SOURCES = 5_000
CHOSEN = "array<struct<h:bigint,c:bigint,n:bigint>>"
MADE = ["size", "source_size", "target", "copies", "taken"]


def word_count(text: Column) -> Column:
    """Words of the whole text; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: Column) -> Column:
    """A source as a string that is never null."""
    return F.coalesce(F.concat(F.lit("s"), source.cast("string")), F.lit("n"))


def targets(sources: DataFrame, share: float, max_epochs: float, weights: tuple[int, ...]) -> DataFrame:
    """Add ``target`` to (source, source_size): capped water-filling.

    Sources by code point, null last, have the weights in turn.
    """
    ranked = global_rank(sources, "place", F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    open_ = staged(ranked.select("key", "source_size", weight.cast("double").alias("weight"),
                                 (F.col("source_size") * max_epochs).cast("double").alias("cap")), "sources")
    wanted = share * (open_.agg(F.sum("source_size")).first()[0] or 0)
    level = 0.0
    while True:  # the level only rises, and each round clamps at least one more source
        clamped = F.col("cap") <= F.col("weight") * level
        full, rest = open_.agg(F.sum(F.when(clamped, F.col("cap"))),
                               F.sum(F.when(~clamped, F.col("weight")))).first()
        if not rest or (higher := (wanted - (full or 0.0)) / rest) <= level:
            break
        level = higher
    return open_.withColumn("target", F.least("cap", F.col("weight") * level)).drop("weight", "cap")


def _long_choice(long_docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(key, chosen (hash, copies taken, copies), words chosen) among the long documents: in
    hash order, as many copies of each as still fit the share of the target that they hold."""
    units = long_docs.groupBy("key", "h").agg(F.max("size").alias("size"), F.count(F.lit(1)).alias("n"))
    lists = units.groupBy("key").agg(F.array_sort(F.collect_list(F.struct("h", "size", "n"))).alias("units"),
                                     F.sum(F.col("size") * F.col("n")).alias("words"))
    start = F.struct((F.col("extra") * F.col("words") / F.col("source_size")).alias("left"),
                     F.array().cast(CHOSEN).alias("chosen"), F.lit(0).cast("long").alias("words"))

    def step(so_far: Column, unit: Column) -> Column:
        fit = F.least(unit["n"], F.floor(so_far["left"] / unit["size"]))
        took = F.struct((so_far["left"] - fit * unit["size"]).alias("left"),
                        F.array_append(so_far["chosen"], F.struct(
                            unit["h"].alias("h"), fit.alias("c"), unit["n"].alias("n"))).alias("chosen"),
                        (so_far["words"] + fit * unit["size"]).alias("words"))
        return F.when(fit > 0, took).otherwise(so_far)

    return lists.join(plan, "key").select("key", F.aggregate("units", start, step).alias("made")).select(
        "key", "made.chosen", F.col("made.words").alias("long_words"))


def _short_cut(short_docs: DataFrame, plan: DataFrame) -> DataFrame:
    """(key, cut, c, n): short documents whose hash is below ``cut`` are chosen,
    and ``c`` of the ``n`` rows with that hash. Sources all of whose short
    documents fit have no row."""
    rows, left = short_docs, plan.select("key", "left")
    for shift in (52, 40, 0):  # 4096 buckets, 4096 parts of one, the hashes of one part
        sums = rows.groupBy("key", F.shiftright("h", shift).alias("part")).agg(
            F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        upto = F.sum("words").over(Window.partitionBy("key").orderBy("part"))
        crossed = (sums.withColumn("upto", upto).join(left, "key")
                   .where("upto > left and upto - words <= left")
                   .select("key", "part", "words", "n", (F.col("left") - F.col("upto") + F.col("words")).alias("left")))
        crossed = staged(crossed, "cut")
        left = crossed.select("key", "left")
        rows = rows.join(crossed.select("key", F.col("part").alias("at")), "key").where(
            F.shiftright("h", shift) == F.col("at")).drop("at")
    # of the rows at the cut as many as bring the sum nearest
    nearest = F.floor(F.col("left") * F.col("n") / F.col("words") + 0.5)
    return crossed.select("key", F.col("part").alias("cut"), F.greatest(F.lit(0), F.least("n", nearest)).alias("c"), "n")


def mixing_plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                share: float = 1.5, max_epochs: float = 2.0, weights: tuple[int, ...] = (5, 2, 1),
                seed: int = 7) -> DataFrame:
    """One row per source: its size, target, whole repetitions and cuts."""
    units = staged(docs.select(
        _key(F.col(source_col)).alias("key"), F.col(source_col).cast("string").alias("source"),
        word_count(F.col(text_col)).alias("size"), _hash(F.col(id_col), F.col(text_col), seed).alias("h")), "units")
    sources = units.groupBy("key", "source").agg(F.sum("size").alias("source_size"))
    plan = targets(sources, share, max_epochs, weights)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = staged(plan.withColumn("whole", whole.cast("int")).withColumn(
        "extra", F.col("target") - F.col("whole") * F.col("source_size")), "plan")
    sized = units.drop("source").join(plan.select("key", "source_size"), "key")
    is_long = F.col("size") > F.col("source_size") * LONG_SHARE
    choice = staged(_long_choice(sized.where(is_long).drop("source_size"), plan), "long")
    plan = staged(plan.join(choice, "key", "left").withColumn(
        "left", F.col("extra") - F.coalesce("long_words", F.lit(0))), "plan")
    cuts = _short_cut(sized.where(~is_long & (F.col("size") > 0)).drop("source_size"), plan)
    # without a cut either all short documents go in, or none
    all_fit = F.when(F.col("left") > 0, F.lit((1 << 63) - 1)).otherwise(F.lit(-(1 << 63)))
    return staged(plan.join(cuts, "key", "left").select(
        "key", "source_size", "target", "whole", F.coalesce("cut", all_fit).alias("cut"),
        F.coalesce("c", F.lit(0)).alias("cut_c"), F.coalesce("n", F.lit(0)).alias("cut_n"),
        F.coalesce("chosen", F.array().cast(CHOSEN)).alias("chosen")), "plan")


def _hash(doc_id: Column, text: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), doc_id, F.coalesce(text, F.lit("")))


def _first_of_units(rows: DataFrame, at: str) -> DataFrame:
    """``rows``, which belong to units that are taken in part, with ``extra``:
    true for the first ``c`` rows of each unit. A unit may hold most rows of the
    table, so rows are numbered by a range sort that is salted by row."""
    salted = staged(rows.withColumn(f"{at}salt", F.xxhash64(F.monotonically_increasing_id())), "partly")
    unit = [f"{at}key", f"{at}h"]
    ranked = global_rank(salted, f"{at}place", *unit, F.col(f"{at}salt"))
    firsts = ranked.groupBy(*unit).agg(F.min(f"{at}place").alias(f"{at}first"))
    return ranked.join(firsts, unit).withColumn(
        f"{at}extra", F.col(f"{at}place") - F.col(f"{at}first") < F.col(f"{at}c"))


def mix(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        share: float = 1.5, max_epochs: float = 2.0, weights: tuple[int, ...] = (5, 2, 1),
        seed: int = 7) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target (of the source),
    copies and taken (``copies * size``).

    A null or empty text has size 0 and takes no words. A null source is a
    source like any other, the last in order. Rows may share an id or have
    none; of rows that are equal in source, id and text as many are taken as
    the target asks for, and which of them is left open. An input column
    named like one of the five is replaced. An empty table stays empty.
    """
    plan = mixing_plan(docs, id_col=id_col, text_col=text_col, source_col=source_col, share=share,
                       max_epochs=max_epochs, weights=weights, seed=seed)
    at = free_prefix(docs, "_mix_")
    partly = (F.col("cut_c") > 0) & (F.col("cut_c") < F.col("cut_n")) | F.exists(
        "chosen", lambda x: (x["c"] > 0) & (x["c"] < x["n"]))
    split = not plan.where(partly).isEmpty()
    plan = plan.select(*[F.col(c).alias(f"{at}{c}") for c in plan.columns])
    if plan.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        plan = F.broadcast(plan)
    size, h = F.col(f"{at}size"), F.col(f"{at}h")
    own = F.get(F.filter(f"{at}chosen", lambda x: x["h"] == h), F.lit(0))
    is_long = size > F.col(f"{at}source_size") * LONG_SHARE
    cut = F.col(f"{at}cut")
    c = F.when(is_long, F.coalesce(own["c"], F.lit(0))).when(h < cut, F.lit(1)).when(h == cut, F.col(f"{at}cut_c")).otherwise(0)
    n = F.when(is_long, F.coalesce(own["n"], F.lit(1))).when(h == cut, F.col(f"{at}cut_n")).otherwise(1)
    joined = (docs.withColumn(f"{at}size", word_count(F.col(text_col)))
              .withColumn(f"{at}h", _hash(F.col(id_col), F.col(text_col), seed))
              .withColumn(f"{at}key", _key(F.col(source_col))).join(plan, f"{at}key", "left")
              .withColumn(f"{at}c", c).withColumn(f"{at}n", n))
    in_part = (F.col(f"{at}c") > 0) & (F.col(f"{at}c") < F.col(f"{at}n"))
    whole = joined.withColumn(f"{at}extra", F.col(f"{at}c") > 0)
    if split:
        cols = [f"`{x}`" for x in whole.columns]
        whole = whole.where(~in_part).unionByName(_first_of_units(joined.where(in_part), at).select(*cols))
    copies = F.col(f"{at}whole") + F.col(f"{at}extra").cast("int")
    kept = [whole[f"`{c}`"] for c in docs.columns if c.lower() not in MADE]
    return whole.select(
        *kept, size.alias("size"), F.col(f"{at}source_size").alias("source_size"),
        F.col(f"{at}target").alias("target"), copies.alias("copies"), (copies * size).alias("taken"))


def mixed(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as :func:`mix` takes it,
    with the columns of ``docs`` whatever they are called. What holds there for
    nulls, ties, repeated rows and an empty table holds here."""
    at = free_prefix(docs, "_mixed_")
    counted = mix(docs.select("*", F.struct("*").alias(f"{at}row")), **how)
    return (counted.where("copies > 0")
            .select(f"{at}row", F.explode(F.sequence(F.lit(1), "copies")).alias(f"{at}copy"))
            .select(f"{at}row.*"))
