"""``key=value`` tokens, token arrays and rule text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_text(text: Column) -> Column:
    return F.lower(F.trim(F.coalesce(text.cast("string"), F.lit(""))))


def token(key: str, value: Column) -> Column:
    return F.concat(F.lit(f"{key}="), value)


def value_of(tok: Column) -> Column:
    """Everything after the first ``=``."""
    return F.split(tok, "=", 2)[1]


def has_key(tokens: Column, key: str) -> Column:
    return F.exists(tokens, lambda t: t.startswith(f"{key}="))


def token_value(tokens: Column, key: str) -> Column:
    """Value of the first token with this key, else NULL."""
    return value_of(F.try_element_at(F.filter(tokens, lambda t: t.startswith(f"{key}=")), F.lit(1)))


def rule_text(antecedent: Column, consequent: Column) -> Column:
    side = lambda items: F.concat(F.lit("{"), F.array_join(F.array_sort(items), ", "), F.lit("}"))
    return F.concat_ws(" -> ", side(antecedent), side(consequent))


def parse_rule(text: Column) -> Column:
    """Rule text back to a struct of two token arrays; both empty when it does not parse."""
    shape = r"^\{(.*)\}\s*->\s*\{(.*)\}$"

    def items(group: int) -> Column:
        parts = F.split(F.regexp_extract(F.trim(text), shape, group), ",")
        return F.filter(F.transform(parts, lambda part: F.trim(part)), lambda part: part != "")

    return F.struct(items(1).alias("antecedent"), items(2).alias("consequent"))
