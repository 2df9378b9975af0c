"""Names and records in text: channel roles, conditions, run keys, measurement lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Nominal currents in ampere that a condition snaps to.
NOMINAL = (45.0, 60.0, 150.0, 225.0, 300.0, 450.0)


def channel_role(name: Column) -> Column:
    """segment, cell_voltage, temperature or other, by the channel's name."""
    n = F.trim(name)
    return F.when(n.rlike(r"^-?\d+$"), "segment").when(F.upper(n).startswith("UC"), "cell_voltage").when(F.lower(n).startswith("temp"), "temperature").otherwise("other")


def number_in(text: Column) -> Column:
    """The first decimal number of a text; null without one."""
    found = F.regexp_extract(text, r"([0-9]+(?:[.,][0-9]+)?)", 1)
    return F.when(found != "", F.regexp_replace(found, ",", ".").cast("double"))


def condition_order(condition: Column) -> list[Column]:
    """45A before 60A before 150A: by number, those without one last, then by name."""
    return [number_in(condition).asc_nulls_last(), condition.asc()]


def nominal_label(current: Column, tolerance: float = 0.02) -> Column:
    """The nominal current within a relative tolerance as "450A"; else the rounded current."""
    label = F.concat(F.round(current).cast("long").cast("string"), F.lit("A"))
    for value in NOMINAL:
        label = F.when(F.abs(current - value) <= tolerance * value, F.lit(f"{value:g}A")).otherwise(label)
    return F.when(current.isNotNull(), label)


def run_key(path: Column) -> list[Column]:
    """order_id, condition, test_id and eval_mode of a run's folder `<order>/<plate>/<condition>/test_<n>[/<mode>]`."""
    part = lambda i: F.regexp_extract(path, r"([^/]+)/([^/]+)/([0-9]+A)/test_([0-9]+)(?:/([a-z_]+))?/?$", i)
    return [part(1).alias("order_id"), part(2).alias("plate"), part(3).alias("condition"), part(4).alias("test_id"), part(5).alias("eval_mode")]


def file_parts(name: Column) -> list[Column]:
    """condition, test and card of a recording's file name `..._Current_<condition>_Test_<n>_Karte_<card>.DAT`."""
    part = lambda i: F.regexp_extract(name, r"(?i)_Current_([0-9]+A)_Test_([0-9]+)_Karte_([0-9]+)\.dat$", i)
    return [part(1).alias("condition"), part(2).alias("test_id"), part(3).alias("card")]


def instants(lines: DataFrame, order: list[str], key: str, group: list[str]) -> DataFrame:
    """The records with `instant`: a new one begins where a key comes again within the current one.

    A key's n-th record lies in instant n - 1 when every instant holds each key once at most, so the instant is the largest count so far.
    """
    from pyspark.sql import Window

    mine = Window.partitionBy(*group, key).orderBy(*order)
    so_far = Window.partitionBy(*group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("_n", F.row_number().over(mine)).withColumn("instant", F.max("_n").over(so_far) - 1).drop("_n")


def safe_column(name: str) -> str:
    """A name that every table format takes."""
    import re

    clean = re.sub(r"[^0-9a-z]+", "_", name.strip().lower()).strip("_")
    return clean if clean and not clean[0].isdigit() else f"c_{clean}"
