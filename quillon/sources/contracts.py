"""Declared table contracts, checked in one aggregate pass and reported together."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quillon.functions.text import text_or_empty
from quillon.operators.joins import blank, repeated_keys


@dataclass(frozen=True)
class Contract:
    """What a table must hold."""

    columns: tuple[str, ...]
    filled: tuple[str, ...] = ()
    unique: tuple[tuple[str, ...], ...] = ()
    binary: tuple[str, ...] = ()
    unknown_if_blank: tuple[str, ...] = field(default=())


#: The tables of a relevance task.
CONTRACTS = {
    "items": Contract(("item_id", "title", "category", "brand", "gender", "age_group", "attributes"), ("title",), (("item_id",),), (), ("gender", "age_group")),
    "terms": Contract(("term_id", "query"), ("query",), (("term_id",),)),
    "training_pairs": Contract(("id", "term_id", "item_id", "label"), (), (("id",), ("term_id", "item_id")), ("label",)),
    "submission_pairs": Contract(("id", "term_id", "item_id"), (), (("id",), ("term_id", "item_id"))),
}


def normalize_unknowns(df: DataFrame, contract: Contract) -> DataFrame:
    """Null and blank values of the named columns become 'unknown'."""
    return df.withColumns({c: F.when(blank(F.col(c)), "unknown").otherwise(text_or_empty(F.col(c))) for c in contract.unknown_if_blank if c in df.columns}) if contract.unknown_if_blank else df


def violations(df: DataFrame, contract: Contract, positive_only: bool = False) -> DataFrame:
    """(check, column, n) of each check that finds something; absent columns are reported alone."""
    spark = df.sparkSession
    absent = [c for c in contract.columns if c not in df.columns]
    if absent:
        return spark.createDataFrame([("missing_column", c, 1) for c in absent], "check string, column string, n bigint")
    checks = {("blank", c): F.count_if(blank(F.col(c))) for c in contract.filled}
    checks |= {("not_binary", c): F.count_if(~F.col(c).isin(0, 1)) for c in contract.binary}
    if positive_only:
        checks |= {("not_positive", c): F.count_if(F.col(c) != 1) for c in contract.binary}
    parts = []
    if checks:
        row = df.agg(*(c.alias(f"{kind}|{name}") for (kind, name), c in checks.items()))
        each = F.explode(F.array(*(F.struct(F.lit(kind).alias("check"), F.lit(name).alias("column"), F.col(f"`{kind}|{name}`").alias("n")) for kind, name in checks)))
        parts.append(row.select(each.alias("x")).select("x.*"))
    for keys in contract.unique:
        repeats = df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")
        parts.append(repeats.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("n")).select(F.lit("repeated").alias("check"), F.lit("+".join(keys)).alias("column"), "n"))
    return reduce(DataFrame.unionByName, parts).where("n > 0")


def validated(df: DataFrame, kind: str, positive_only: bool = False) -> DataFrame:
    """The table with unknowns normalised; raises with all violations and examples of repeated keys."""
    contract = CONTRACTS[kind]
    found = violations(df, contract, positive_only).collect()
    if found:
        said = [f"{r.check} {r.column}: {r.n}" for r in found]
        for keys in contract.unique:
            if any(r.check == "repeated" and r.column == "+".join(keys) for r in found):
                said.append(f"examples of {'+'.join(keys)}: {[tuple(r)[:-1] for r in repeated_keys(df, list(keys)).collect()]}")
        raise ValueError(f"{kind}: " + "; ".join(said))
    return normalize_unknowns(df, contract)
