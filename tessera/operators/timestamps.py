"""Normalising the timestamp columns of a table (see :mod:`tessera.functions.timeparse`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.timeparse import instant_seconds, normal_date, utc_text


def with_normal_times(df: DataFrame, instants: list[str] = (), dates: list[str] = (), suffix: str = "_normal") -> DataFrame:
    """``df`` with a normalised text column beside each named one: ISO instants in UTC, ISO dates.

    No shuffle; all columns share one Arrow evaluation. Unreadable values give null (see the module named above).
    """
    seconds = {c: instant_seconds(F.col(f"`{c}`")) for c in instants}
    days = {c + suffix: normal_date(F.col(f"`{c}`")).cast("string") for c in dates}
    out = df.withColumns({f"{c}{suffix}": s for c, s in seconds.items()} | days)
    return out.withColumns({f"{c}{suffix}": utc_text(F.col(f"`{c}{suffix}`")) for c in instants})


def normal_values(df: DataFrame, key: str, order: str, instants: list[str], dates: list[str]) -> DataFrame:
    """Long form (key, field_name, normal_value): each key and field with a real value, once.

    Where repeated rows of a key disagree, the row last by ``order`` that has a real value counts (equal order:
    the greatest value); null keys have no rows. Repeated rows are combined before the shuffle (partial max_by).
    """
    fields = [*instants, *dates]
    normal = with_normal_times(df.select(key, order, *fields), instants, dates)
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("field_name"), F.col(f"{c}_normal").alias("normal_value")) for c in fields)))
    long = normal.filter(F.col(key).isNotNull()).select(key, order, pairs.alias("pair")).select(key, order, "pair.*")
    return (
        long.filter("normal_value IS NOT NULL")
        .groupBy(key, "field_name")
        .agg(F.max_by("normal_value", F.struct(F.col(order), F.col("normal_value"))).alias("normal_value"))
    )
