"""Projections of records onto the columns of a report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def filled(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns as text, '' for nulls and for columns that df has not."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in columns))


def date_or_text(text: Column) -> Column:
    """The day of a text that can be read as an instant, else the text itself."""
    return F.coalesce(F.date_format(F.try_to_timestamp(text), "yyyy-MM-dd"), text)


def looked_up(value: Column, table: dict[str, str], default: str = "") -> Column:
    """The table's entry for a value; default for others and null."""
    found = F.lit(default)
    for key, entry in table.items():
        found = F.when(value == key, entry).otherwise(found)
    return found


def overridden(override: Column, conclusion: Column, derived: dict[str, str], default: str = "") -> Column:
    """A flag that was given, else the one that follows from the conclusion; an empty text was given, null was not."""
    return F.coalesce(override, looked_up(conclusion, derived, default))


def best_label(labels: list[tuple[str, Column]], default: str) -> Column:
    """An aggregate: the first label whose condition holds for any row of the group."""
    found = F.lit(default)
    for name, holds in reversed(labels):
        found = F.when(F.bool_or(holds), name).otherwise(found)
    return found


def sheet(df: DataFrame, columns: dict[str, str | Column], default: str = "") -> DataFrame:
    """The rows of a sheet: for each heading a column's name, an expression, or a name that df has not, which gives default. Lists are
    joined by '; ', instants are days, and nulls are default."""
    kinds = dict(df.dtypes)

    def cell(name: str, source: str | Column) -> Column:
        if not isinstance(source, str):
            return F.coalesce(source.cast("string"), F.lit(default)).alias(name)
        if source not in kinds:
            return F.lit(default).alias(name)
        value = F.col(source)
        if kinds[source].startswith("array"):
            value = F.array_join(value, "; ")
        elif kinds[source].startswith("timestamp"):
            value = F.date_format(value, "yyyy-MM-dd")
        return F.coalesce(value.cast("string"), F.lit(default)).alias(name)

    return df.select(*(cell(n, x) for n, x in columns.items()))


def key_values(df: DataFrame, key: str) -> DataFrame:
    """key, item, value: a row for each column of each row, in order of the columns (pos), as text."""
    rest = [c for c in df.columns if c != key]
    return df.select(key, F.posexplode(F.array(*(F.struct(F.lit(c).alias("item"), F.col(c).cast("string").alias("value")) for c in rest))).alias("pos", "x")).select(key, "pos", "x.item", "x.value")


def first_filled(sources: list[tuple[Column, str]], default: str, most: int = 3) -> Column:
    """The first list that is not empty, as its text before and its first entries, or default."""
    found = F.lit(default)
    for values, before in reversed(sources):
        found = F.when(F.size(values) > 0, F.concat(F.lit(before), F.array_join(F.slice(values, 1, most), ", "))).otherwise(found)
    return found


def endpoint_label(file: Column, owner: Column, names: list[Column]) -> Column:
    """file::owner.name by the first name that is not empty, file::name without an owner, file alone without a name."""
    some = lambda x: F.nullif(x, F.lit(""))
    name = F.coalesce(*map(some, names))
    return F.concat(F.coalesce(file, F.lit("")), F.when(name.isNotNull(), F.concat(F.lit("::"), F.coalesce(F.concat(some(owner), F.lit(".")), F.lit("")), name)).otherwise(""))


def decided(rules: list[tuple[Column, Column | str]], default: str) -> Column:
    """The text of the first rule that holds; a rule that is null does not."""
    found = F.lit(default)
    for holds, text in reversed(rules):
        found = F.when(holds, text if isinstance(text, Column) else F.lit(text)).otherwise(found)
    return found
