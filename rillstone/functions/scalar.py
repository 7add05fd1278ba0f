"""Scalar function groups as column expressions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def strings(df: DataFrame, text: str, number: str) -> DataFrame:
    return df.withColumns({"head": F.substring(text, 1, 8), "bars": F.replace(F.col(text), F.lit("/"), F.lit("|")), "low": F.lower(text), "padded": F.lpad(F.col(number).cast("string"), 6, "0"), "has": F.col(text).contains("en")})


def arithmetic(df: DataFrame, a: str, b: str) -> DataFrame:
    x = F.col(a)
    return df.withColumns({"root": F.sqrt(F.abs(x)), "angle": F.degrees(F.atan(x / 100.0)), "low": F.floor(x / 7.0), "rest": F.pmod(x, F.lit(7)), "top": F.greatest(x, F.col(b))})


def casts(df: DataFrame, a: str, b: str) -> DataFrame:
    """cut drops digits towards zero, byte stays at the ends of its range."""
    return df.withColumns({"cut": (F.col(a) / 100.0).cast("int"), "flag": (F.col(b) > 50).cast("int"), "byte": F.least(F.lit(127), F.greatest(F.lit(-128), F.col(a))).cast("int")})


def nulls(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.withColumns({"filled": F.coalesce(a, F.lit(-1)), "missing": F.col(a).isNull(), "code": F.nullif(F.col(b), F.lit(0))})


def arrays(df: DataFrame, a: str) -> DataFrame:
    return df.withColumns({"positive": F.size(F.filter(a, lambda x: x > 0)), "top": F.array_max(a), "place": F.array_position(a, F.array_max(a))})


def map_lookup(df: DataFrame, key: str, codes: dict[str, int], default: int) -> DataFrame:
    table = F.create_map(*[F.lit(x) for p in codes.items() for x in p])
    return df.withColumn("code", F.coalesce(F.element_at(table, F.col(key)), F.lit(default)))


def json_field(df: DataFrame, text: str, field: str) -> DataFrame:
    return df.withColumn(field, F.from_json(text, f"{field} int")[field])


def elapsed(df: DataFrame, seconds: str) -> DataFrame:
    s = F.col(seconds)
    return df.withColumn("elapsed", F.format_string("%02d:%02d:%02d", F.floor(s / 3600), F.floor(s % 3600 / 60), s % 60))


def sample(df: DataFrame, fraction: float, seed: int) -> DataFrame:
    return df.sample(fraction, seed=seed)
