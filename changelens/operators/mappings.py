"""Tables of relations: stale and external rows go, uncertain ones are lowered, doubles become one row with its provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changelens.functions.text import last_part, rank_of
from changelens.operators.relational import outside_prefixes

#: Fixed values, lowest first.
RISKS = ["low", "medium", "high", "critical"]
CONSTRUCTORS = ("__init__", "__new__")


def risk_rank(risk: Column) -> Column:
    """Rank of a risk; a missing one is low, an unknown one ranks below all."""
    return rank_of(F.coalesce(risk, F.lit("low")), RISKS)


def capped(risk: Column, most: str) -> Column:
    """The risk, but no more than most; unknown risks stay."""
    return F.when(rank_of(risk, RISKS, 0) > RISKS.index(most), F.lit(most)).otherwise(risk)


def canonical_files(df: DataFrame, owner: str, file: str, canonical: dict[str, str]) -> DataFrame:
    """Rewrites the file of rows whose owner has a canonical one; original_file keeps what was there."""
    better = F.lit(None).cast("string")
    for name, path in canonical.items():
        better = F.when(F.col(owner) == name, path).otherwise(better)
    return df.withColumn("original_file", F.col(file)).withColumn(file, F.coalesce(better, F.col(file)))


def existing_only(df: DataFrame, files: list[str], tree: DataFrame | None, path: str = "path") -> DataFrame:
    """Drops rows of which a named file is not in the tree; rows without a name pass, and without a tree all do."""
    if tree is None:
        return df
    known = tree.select(F.col(path).alias("__file")).distinct().withColumn("__there", F.lit(True))
    for f in files:
        df = df.join(known.withColumnRenamed("__file", f), f, "left").where(F.col(f).isNull() | F.col("__there")).drop("__there")
    return df


def without_fan_out(df: DataFrame, callee: str, member: str) -> DataFrame:
    """Drops rows that tie a constructor call (last name upper-case) to a member that is no constructor."""
    leaf = last_part(F.col(callee))
    return df.where(~F.coalesce(leaf.rlike(r"^\p{Lu}") & ~F.col(member).isin(*CONSTRUCTORS), F.lit(False)))


def downgraded(df: DataFrame) -> DataFrame:
    """Sets relation, risk, confidence and relationship_verified by what a relation can prove: an equal name alone is a low candidate,
    a verified relation is high, an override or patch that is not verified is high too, others are medium."""
    named = F.col("relation") == "same_name_protocol"
    verified = F.coalesce(F.col("relationship_verified") & (F.col("verification_status") == "verified"), F.lit(False))
    same = F.coalesce(named, F.lit(False))
    confidence = F.when(same, "low").when(verified | F.col("relation").isin("override", "monkey_patch"), "high").otherwise("medium")
    return df.withColumns({
        "source_relation": F.col("relation"), "confidence": confidence, "action": F.lit("review"), "relationship_verified": verified & ~same,
        "verification_status": F.when(verified & ~same, "verified").otherwise("candidate"),
        "risk": F.when(same, "low").otherwise(F.col("risk")), "relation": F.when(same, "same_name_candidate").otherwise(F.col("relation")),
    })


def winners(df: DataFrame, keys: list[str], order: str, relation: str = "source_relation") -> DataFrame:
    """The best row of each key by risk, then verification, then order, with n_sources, the number of the key's rows, and source_relations,
    their kinds. Null key parts are equal to each other.

    One grouping without a window: the winner is a minimum, and a key's rows are counted in parts, not gathered. Where they come
    from is a table of its own: provenance() and occurrences()."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(-risk_rank(F.col("risk")), ~F.coalesce("relationship_verified", F.lit(False)), F.col(order))
    best = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), rank).alias("__best"), F.count("*").alias("n_sources"), F.array_sort(F.collect_set(relation)).alias("source_relations"))
    return best.select(*keys, "__best.*", "n_sources", "source_relations")


def provenance(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Each row's key and source_index, to stand beside winners()."""
    return df.select(*keys, F.col(order).alias("source_index"))


def occurrences(df: DataFrame, keys: list[str], order: str, occurrence: list[str]) -> DataFrame:
    """Each key's distinct occurrences with source_index, the first of each, to stand beside winners()."""
    return df.groupBy(*keys, *[c for c in occurrence if c not in keys]).agg(F.min(order).alias("source_index"))


def one_per_key(df: DataFrame, keys: list[str], order: str, occurrence: list[str], relation: str = "source_relation") -> DataFrame:
    """winners() with occurrences (distinct, by first order) and source_indexes as lists, for tables whose keys are known to have few rows:
    a list holds all rows of its key."""
    same = lambda prefix: [F.col(k).eqNullSafe(F.col(f"{prefix}{k}")) for k in keys]
    named = lambda prefix: [F.col(k).alias(f"{prefix}{k}") for k in keys]
    listed = occurrences(df, keys, order, occurrence).groupBy(*named("__k_"))
    listed = listed.agg(F.transform(F.array_sort(F.collect_list(F.struct("source_index", *occurrence))), lambda x: F.struct(*[x[c].alias(c) for c in occurrence])).alias("occurrences"))
    indexes = provenance(df, keys, order).groupBy(*named("__i_")).agg(F.array_sort(F.collect_list("source_index")).alias("source_indexes"))
    best = winners(df, keys, order, relation)
    rest = [c for c in df.columns if c not in keys]
    return best.join(listed, same("__k_")).join(indexes, same("__i_")).select(*keys, *rest, "occurrences", "source_indexes", "source_relations")


def first_published(df: DataFrame, parts: list[str], order: str) -> DataFrame:
    """The first row of each key; rows with an empty or missing key part are dropped, functions without a class among them."""
    for c in parts:
        df = df.where(F.nullif(F.col(c), F.lit("")).isNotNull())
    rest = [c for c in df.columns if c not in parts]
    return df.groupBy(*parts).agg(F.min_by(F.struct(*rest), order).alias("__first")).select(*parts, "__first.*")


def statistics(before: DataFrame, kept: DataFrame, after: DataFrame) -> DataFrame:
    """input_total, output_total, removed_total, deduplicated; the first is always the sum of the others."""
    rows = before.select(F.lit(0).alias("at")).unionAll(kept.select(F.lit(1).alias("at"))).unionAll(after.select(F.lit(2).alias("at")))
    n_in, n_kept, n_out = (F.count_if(F.col("at") == k) for k in range(3))
    return rows.agg(n_in.alias("input_total"), n_out.alias("output_total"), (n_in - n_kept).alias("removed_total"), (n_kept - n_out).alias("deduplicated"))


def optimized_methods(df: DataFrame, keys: list[str], order: str, files: list[str], tree: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """(kept, winners): rows whose files exist, lowered to what their relation proves, one for each key."""
    kept = existing_only(df, files, tree)
    return kept, winners(downgraded(kept), keys, order)


def optimized_fields(df: DataFrame, keys: list[str], order: str, files: list[str], tree: DataFrame | None, canonical: dict[str, str], attribute: str, stop: list[str], most: str = "medium") -> tuple[DataFrame, DataFrame]:
    """(kept, winners) of rows about fields. An owner's canonical file is set before files are looked for; attributes whose first part is in the stop
    list are another library's and go; a field proves no more than most."""
    rows = canonical_files(outside_prefixes(df, attribute, stop), "owner", files[0], canonical)
    kept = existing_only(rows, files, tree)
    return kept, winners(kept.withColumns({"source_relation": F.col("relation"), "risk": capped(F.col("risk"), most)}), keys, order)


def optimized_calls(df: DataFrame, keys: list[str], order: str, files: list[str], tree: DataFrame | None, callee: str, member: str, keywords: str, most: str = "medium") -> tuple[DataFrame, DataFrame]:
    """(kept, winners) of rows about calls. A constructor's call tied to another member goes; keywords that are said to be missing are
    not known any more; a call that is not verified proves no more than most."""
    kept = existing_only(without_fan_out(df, callee, member), files, tree)
    sure = F.coalesce("relationship_verified", F.lit(False))
    rows = kept.withColumns({"source_relation": F.col("relation"), "risk": F.when(sure, F.col("risk")).otherwise(capped(F.col("risk"), most)), keywords: F.array().cast("array<string>")})
    return kept, winners(rows, keys, order)


def optimized_registrations(df: DataFrame, keys: list[str], order: str, files: list[str], tree: DataFrame | None, renamed: dict[str, str], most: str = "low") -> tuple[DataFrame, DataFrame]:
    """(kept, winners) of rows about registrations; relations with a new name take it, and what is only such a reference proves no more than most."""
    kept = existing_only(df, files, tree)
    relation, risk = F.col("relation"), F.col("risk")
    for old, new in renamed.items():
        relation, risk = F.when(F.col("relation") == old, new).otherwise(relation), F.when(F.col("relation") == old, capped(F.col("risk"), most)).otherwise(risk)
    return kept, winners(kept.withColumns({"source_relation": F.col("relation"), "relation": relation, "risk": risk}), keys, order)
