"""Interactive filters and period aggregates over a metric dataset."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meridia.functions import fields


DASH = "—"
MONTH = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")


def clamp(lo: str | None, hi: str | None, first: str, last: str) -> tuple[str, str]:
    """A range of months, each end within the data's own; the data's whole range if it was given backwards. What is no month is the data's end."""
    lo, hi = (min(max(x if x and MONTH.match(x) else whole, first), last) for x, whole in ((lo, first), (hi, last)))
    return (lo, hi) if lo <= hi else (first, last)


def chosen(values: list, allowed: list, fallback: list) -> list:
    """The values that are allowed; else the fallback's; else the first that is allowed."""
    for some in (values, fallback):
        kept = [v for v in some or [] if v in allowed]
        if kept:
            return kept
    return allowed[:1]


def is_default_view(view: dict, defaults: dict, user_types: list[str] | None = ("registered",), grain: str = "year", namespaces: list[int] | None = (0,)) -> bool:
    """Whether a view's filters (wiki, user_types, granularity, start, end, namespaces) are those of the prepared result."""
    meta = parse_meta(defaults)
    whole = meta["ranges"].get(meta["wiki"])
    same = lambda a, b: (not a and not b) if a is None or b is None else len(a) == len(b) and set(b) <= set(a)
    return whole is not None and (view["wiki"], view["granularity"], view["start"], view["end"]) == (meta["wiki"], grain, *whole) and same(view.get("user_types"), user_types) and same(view.get("namespaces"), namespaces)


def parse_meta(defaults: dict) -> dict:
    """Of a page's defaults (default_wiki, max_month, wikis, namespaces, ranges as rows): wikis, their namespaces and ranges, the wiki to begin with and the last month."""
    wikis = [r["wiki"] for r in defaults["wikis"]]
    by_wiki: dict[str, list[int]] = {}
    for r in defaults.get("namespaces") or ():
        by_wiki.setdefault(r["wiki"], []).append(r["page_namespace"])
    ranges = {r["wiki"]: (r["mn"], r["mx"]) for r in defaults["ranges"]}
    wiki = defaults.get("default_wiki")
    wiki = wiki if wiki in wikis else wikis[0] if wikis else None
    return {"wikis": wikis, "namespaces": by_wiki or None, "ranges": ranges, "wiki": wiki, "max_month": defaults.get("max_month") or max((hi for _, hi in ranges.values()), default=None)}


def filter_rows(df: DataFrame, wiki: str | None = None, user_types: list[str] = (), months: tuple[str | None, str | None] = (None, None), namespaces: list[int] = ()) -> DataFrame:
    """Rows by wiki, user types, months (both ends in) and namespaces; what is empty filters nothing."""
    if wiki:
        df = df.where(F.col("wiki") == wiki)
    if user_types:
        df = df.where(F.col("user_type").isin(list(user_types)))
    if months[0]:
        df = df.where(F.col("year_month") >= months[0])
    if months[1]:
        df = df.where(F.col("year_month") <= months[1])
    if namespaces:
        df = df.where(F.col("page_namespace").isin(list(namespaces)))
    return df


def by_period(df: DataFrame, grain: str, sums: list[str] = (), means: list[str] = (), keys: list[str] = ()) -> DataFrame:
    """Sums (of nothing: 0) and means (of nothing: null) by period and further keys."""
    aggregates = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in sums] + [F.avg(c).alias(c) for c in means]
    return df.groupBy(fields.period(F.col("year_month"), grain).alias("period"), *keys).agg(*aggregates)


def share_of_period(df: DataFrame, value: str, keys: list[str] = ("period",)) -> DataFrame:
    """With ``share``: the value over its period's sum, 0 where that is 0. The sums are joined back, not windowed."""
    sums = df.groupBy(*keys).agg(F.sum(value).alias("all"))
    return df.join(sums, list(keys)).withColumn("share", F.coalesce(F.try_divide(F.col(value).cast("double"), F.when(F.col("all") != 0, F.col("all"))), F.lit(0.0))).drop("all")


def grouped(df: DataFrame, grain: str, sums: list[str] = (), means: list[str] = (), **only) -> DataFrame:
    """``by_period`` over ``filter_rows``."""
    return by_period(filter_rows(df, **only), grain, sums, means).orderBy("period")


def _scaled(v: Column, units: tuple[tuple[float, str], ...], small: Column) -> Column:
    """The magnitude in the first unit that it reaches, one decimal; the sign before it; a dash for null or NaN."""
    a, out = F.abs(v), small
    for least, unit in reversed(units):
        out = F.when(a >= least, F.format_string(f"%.1f{unit}", a / least if unit != "K" else a / 1e3)).otherwise(out)
    return F.when(v.isNull() | F.isnan(v.cast("double")), DASH).otherwise(F.concat(F.when(v < 0, "−").otherwise(""), out))


def short_number(v: Column) -> Column:
    """1234567 as 1.2M, 45000 as 45.0K, 1234 as 1,234, 900 as 900, 0.25 as 0.3."""
    a = F.abs(v)
    small = F.when(a >= 1e3, F.format_number(F.floor(a + 0.5), 0)).when(a == F.floor(a), F.floor(a).cast("string")).otherwise(F.format_string("%.1f", a.cast("double")))
    return _scaled(v, ((1e9, "B"), (1e6, "M"), (1e4, "K")), small)


def short_bytes(v: Column) -> Column:
    """1234567 as 1.2 MB, 900 as 900 B."""
    return _scaled(v, ((1e9, " GB"), (1e6, " MB"), (1e3, " KB")), F.concat(F.abs(v).cast("string"), F.lit(" B")))


def write_json(df: DataFrame, path: str, most: int = 100_000) -> None:
    """A small result as one JSON array. More than ``most`` rows are an error, never cut."""
    rows = df.limit(most + 1).toJSON().collect()
    if len(rows) > most:
        raise ValueError(f"over {most} rows are not one document; write them as Parquet")
    Path(path).write_text(json.dumps([json.loads(r) for r in rows]))
