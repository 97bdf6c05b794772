"""Mixing sources to target weights: hash-random keys, range sort within each source, distributed prefix sums
of word counts, and a cut at each source's exact budget."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .shared import prefix_offsets, row_hash, written

WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
WORD = r"[^\x20\x09-\x0D]+"


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_EPOCHS) -> DataFrame:
    """sizes: source, source_size, a row for each source. Adds target.

    Sources in order of their code points, null last, have the weights in turn and share the sum of all sizes;
    a target stops at most times its source's size and the excess is shared again by weight. That ends where
    all that have not stopped take level times their weight: sorted by the level at which they stop, the
    sources that stop are those before the first whose own level is enough. One row for each source is all
    that the windows see."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    ranked = sizes.withColumn("__w", F.element_at(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights) + 1)).cast("double"))
    ranked = ranked.withColumn("__cap", F.col("source_size").cast("double") * most).withColumn("__stop", F.col("__cap") / F.col("__w"))
    by_stop = Window.orderBy("__stop", F.col("source").asc_nulls_last())
    before, onward = by_stop.rowsBetween(Window.unboundedPreceding, -1), by_stop.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    total = F.sum(F.col("source_size").cast("double")).over(whole)
    ranked = ranked.withColumn("__level", (total - F.coalesce(F.sum("__cap").over(before), F.lit(0.0))) / F.sum("__w").over(onward))
    level = F.min(F.when(F.col("__level") <= F.col("__stop"), F.struct("__stop", "__level"))).over(whole)["__level"]
    ranked = ranked.withColumn("__share", F.coalesce(level, F.lit(0.0)) * F.col("__w"))
    return ranked.select("source", "source_size", F.least("__share", "__cap").alias("target"))


def mix(df: DataFrame, seed: str = "mix", id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """A row for each row of df: doc_id, source, size, source_size, target, taken, passes, partial, tie.

    The documents of a source stand in the order of a random key (md5 of the seed and the id), over and over;
    the mix takes the first target words of that line, rounded down. taken counts them with repeats: passes whole
    passes, and partial words of one more (of the one document at the cut that is not taken whole). A source
    is ordered in ranges of the key, each of bounded size; the ranges' sums give where each begins.

    A null text has no words; a null source is a source of its own, last in order; the key of a row without an
    id is of its text; repeated rows are rows of their own (in order of their text's checksum); a source without words
    has target 0; an empty table gives an empty one."""
    text = F.coalesce(df[text_col].cast("string"), F.lit(""))
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(df[id_col].cast("string"), F.concat(F.lit("null:"), F.md5(text.cast("binary"))))).cast("binary"))
    thin = written(df.select(df[id_col].cast("long").alias("doc_id"), df[source_col].cast("string").alias("source"), F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), key.alias("key"), F.crc32(text.cast("binary")).alias("tie")), "mix-rows")
    sums = thin.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("__rows"))
    targets = source_targets(sums.select("source", "source_size")).withColumnRenamed("source", "__source")
    targets = written(targets.join(sums.select(F.col("source").alias("__s"), "__rows"), F.col("__source").eqNullSafe(F.col("__s"))).drop("__s").withColumn("__ranges", F.ceil(F.sqrt(F.col("__rows").cast("double")) / 4).cast("int")), "mix-targets")
    rows = thin.join(targets, F.col("source").eqNullSafe(F.col("__source"))).drop("__source", "__rows")
    rows = rows.withColumn("__range", F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") / 4294967296.0 * F.col("__ranges")).cast("int"))
    offsets = prefix_offsets(rows.groupBy("source", "__range").agg(F.sum("size").alias("__sum")), ["source"], "__range", "__sum", "__before")
    offsets = offsets.select(F.col("source").alias("__source"), F.col("__range").alias("__r"), "__before")
    line = Window.partitionBy("source", "__range").orderBy("key", "tie", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__own", F.coalesce(F.sum("size").over(line), F.lit(0)))
    rows = rows.join(offsets, F.col("source").eqNullSafe(F.col("__source")) & (F.col("__range") == F.col("__r")))
    budget = F.floor("target").cast("long") - (F.col("__own") + F.col("__before"))  # words from this document's start to the cut
    words = lambda epoch: F.greatest(F.lit(0), F.least(F.col("size"), budget - epoch * F.col("source_size")))
    taken = [words(e) for e in range(MOST_EPOCHS)]
    rows = rows.withColumn("taken", sum(taken[1:], taken[0]).cast("long"))
    passes = F.when(F.col("size") > 0, F.floor(F.col("taken") / F.col("size"))).otherwise(0).cast("int")
    return rows.select("doc_id", "source", "size", "source_size", "target", "taken", passes.alias("passes"), (F.col("taken") - passes * F.col("size")).cast("long").alias("partial"), "tie")


def first_words(text, n):
    """The text up to the end of its n-th word."""
    return F.array_join(F.slice(F.split(text, r"(?<=[^\x20\x09-\x0D])(?=[\x20\x09-\x0D])"), 1, n), "")


def mixed(df: DataFrame, seed: str = "mix") -> DataFrame:
    """The mix itself, with the columns of df (which has doc_id, text, source): a document stands as often as it
    is taken whole; the document at a source's cut is there with its first words alone. Documents without
    words, of which the budgets say nothing, stay once. Rows of the same id, source and text share their passes
    evenly. Texts are shuffled once, to meet the plan."""
    passes = F.sum(F.when(F.col("size") == 0, 1).otherwise(F.col("passes")))
    plan = mix(df, seed).groupBy(F.col("doc_id").alias("id"), F.col("source").alias("src"), "tie").agg(
        F.count("*").alias("n"), passes.alias("passes"), F.array_sort(F.collect_list(F.when(F.col("partial") > 0, F.col("partial")))).alias("partial")
    )
    # the columns travel as one, so none of their names can clash
    rows = df.select(df["doc_id"].cast("long").alias("of"), df["source"].cast("string").alias("from"), F.crc32(F.coalesce(df["text"].cast("string"), F.lit("")).cast("binary")).alias("crc"), row_hash(df).alias("all"), F.struct(*(df[c] for c in df.columns)).alias("row"))
    met = rows.join(plan, F.col("of").eqNullSafe(F.col("id")) & F.col("from").eqNullSafe(F.col("src")) & (F.col("crc") == F.col("tie")))
    number = F.row_number().over(Window.partitionBy("id", "src", "tie").orderBy("all"))
    met = met.where("n = 1").withColumn("k", F.lit(1)).unionByName(met.where("n > 1").withColumn("k", number))
    own = F.floor(F.col("passes") / F.col("n")) + F.when(F.col("k") <= F.col("passes") % F.col("n"), 1).otherwise(0)
    cuts = F.concat(F.array_repeat(F.lit(0).cast("long"), own.cast("int")), F.slice("partial", F.col("k"), F.lit(1)))
    out = met.select("row", F.explode(cuts).alias("cut"))
    whole, text = F.col("cut") == 0, F.col("row")["text"]
    new = {"text": F.when(whole, text).otherwise(first_words(text, F.col("cut").cast("int")))}
    if "n_chars" in df.columns:
        new["n_chars"] = F.when(whole, F.col("row")["n_chars"]).otherwise(F.length(new["text"]).cast(dict(df.dtypes)["n_chars"]))
    return out.select(*(new.get(c, F.col("row")[c]).alias(c) for c in df.columns))
