"""Column functions for dump fields: flags, user types, log parameters, timestamps, periods and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The numbers and labels of namespaces.
NAMESPACES = {
    0: "Article", 1: "Talk", 2: "User", 3: "User Talk", 4: "Wikipedia", 5: "Wikipedia Talk", 6: "File", 7: "File Talk", 8: "MediaWiki", 9: "MediaWiki Talk", 10: "Template", 11: "Template Talk",
    12: "Help", 13: "Help Talk", 14: "Category", 15: "Category Talk", 100: "Portal", 101: "Portal Talk", 828: "Module", 829: "Module Talk", 1728: "Draft", 1729: "Draft Talk",
    2300: "Gadget", 2301: "Gadget definition", 2302: "Gadget Talk", 2303: "Gadget definition Talk",
}
GRAINS = ("month", "quarter", "year")


def flag(c: Column, boolean: bool = False) -> Column:
    """A dump's flag: true only for the text 'true'; null stays null. A boolean column is taken as it is."""
    return c if boolean else c == F.lit("true")


def user_type(bot_by: Column, anonymous: Column, temporary: Column, patrol: bool = False) -> Column:
    """Bot before anonymous before temporary before registered. ``patrol``: the text 'false' marks no bot."""
    bot = bot_by.isNotNull() & (bot_by != "")
    if patrol:
        bot = bot & (F.lower(bot_by) != "false")
    return F.when(bot, "bot").when(anonymous, "anonymous").when(temporary, "temporary").otherwise("registered")


def year_month(ts: Column) -> Column:
    return F.substring(ts, 1, 7)


def year(ts: Column) -> Column:
    return F.substring(ts, 1, 4).try_cast("int")


def year_month_key(ts: Column) -> Column:
    """YYYYMM as a number; short or bad texts are null."""
    return F.when(F.length(ts) >= 7, F.substring(ts, 1, 4).try_cast("int") * 100 + F.substring(ts, 6, 2).try_cast("int"))


def shift_month(key: Column, by: int) -> Column:
    """A YYYYMM key some months on; null for a key whose month is not from 1 to 12."""
    month = F.pmod(key, F.lit(100))
    at = F.floor(key / 100) * 12 + month - 1 + by
    return F.when((month >= 1) & (month <= 12), (F.floor(at / 12) * 100 + F.pmod(at, F.lit(12)) + 1).cast("int"))


def period(month: Column, grain: str) -> Column:
    """A YYYY-MM text as a month, YYYY-Qn or YYYY."""
    if grain not in GRAINS:
        raise ValueError(f"unknown period: {grain}")
    if grain == "month":
        return month
    if grain == "year":
        return F.substring(month, 1, 4)
    return F.concat(F.substring(month, 1, 4), F.lit("-Q"), F.ceil(F.substring(month, 6, 2).cast("int") / 3).cast("string"))


def normal_timestamp(ts: Column) -> Column:
    """``T`` to a space, trailing ``Z`` and fractions off."""
    return F.split_part(F.rtrim(F.replace(ts, F.lit("T"), F.lit(" ")), F.lit("Z")), F.lit("."), F.lit(1))


def epoch(ts: Column) -> Column:
    return F.unix_timestamp(F.try_to_timestamp(normal_timestamp(ts), F.lit("yyyy-MM-dd HH:mm:ss")))


def week_start(ts: Column) -> Column:
    return F.date_trunc("week", F.to_date(F.substring(ts, 1, 10), "yyyy-MM-dd")).cast("date")


def activity_tier(edits: Column) -> Column:
    return F.when(edits == 1, "1 edit").when(edits < 5, "2-4 edits").when(edits < 25, "5-24 edits").when(edits < 100, "25-99 edits").otherwise("100+ edits")


def round1(v: Column) -> Column:
    """One decimal, half away from zero."""
    return F.round(v * 10, 0) / 10


def _php(params: Column, key: str) -> Column:
    value = F.regexp_extract(params, rf'"{key}";(?:i:(-?\d+);|s:\d+:"(-?\d+)";)', 0)
    return F.regexp_extract(value, r'[:"](-?\d+)"?;$', 1).try_cast("long")


def patrol_params(params: Column) -> Column:
    """Struct (current_revision_id, prev_revision_id, is_auto) of a patrol entry: three lines, or a serialised array."""
    lines = F.split(params, "\n")
    line = lambda k: F.trim(F.get(lines, F.lit(k))).try_cast("long")
    php = F.ltrim(params).startswith("a:")
    return F.struct(
        F.when(php, _php(params, "4::curid")).otherwise(line(0)).alias("current_revision_id"),
        F.coalesce(F.when(php, _php(params, "5::previd")).otherwise(line(1)), F.lit(0)).cast("long").alias("prev_revision_id"),
        (F.coalesce(F.when(php, _php(params, "6::auto")).otherwise(line(2)), F.lit(0)) != 0).alias("is_auto"),
    )


#: How deep braces are followed in a serialised array.
DEPTH = 8


def _php_groups(params: Column, key: str) -> Column:
    nested = r"[^{}]*"
    for _ in range(DEPTH):
        nested = rf"(?:[^{{}}]|\{{{nested}\}})*"
    body = F.regexp_extract(params, rf'"{key}";a:\d+:(\{{{nested}\}})', 1)
    found = F.regexp_extract_all(body, F.lit(r's:\d+:"([^"]*)"'), F.lit(1))
    return F.array_join(F.array_sort(F.array_distinct(F.filter(found, lambda x: ~x.rlike(r"^\d{14}$")))), ",")


def rights_params(params: Column) -> Column:
    """Struct (old_groups, new_groups) of a rights entry: two lines, or serialised arrays, nested up to ``DEPTH`` deep; a body without its end is empty."""
    lines, php = F.split(params, "\n"), F.ltrim(params).startswith("a:")
    line = lambda k: F.trim(F.coalesce(F.get(lines, F.lit(k)), F.lit("")))
    return F.struct(F.when(php, _php_groups(params, "4::oldgroups")).otherwise(line(0)).alias("old_groups"), F.when(php, _php_groups(params, "5::newgroups")).otherwise(line(1)).alias("new_groups"))


def title_user(title: Column) -> Column:
    """A title without its namespace."""
    return F.regexp_replace(title, "^[^:]*:", "")


def groups_of(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, ","), lambda x: F.trim(x)), lambda x: x != "")


def has_any(text: Column, groups: list[str]) -> Column:
    return F.arrays_overlap(groups_of(text), F.array(*map(F.lit, groups)))


def namespace_label(ns: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in NAMESPACES.items() for x in kv])
    return F.coalesce(F.try_element_at(names, ns), F.concat(F.lit("ns "), ns.cast("string")), F.lit("(no namespace)"))


def is_year_month(c: Column) -> Column:
    return c.rlike(r"^\d{4}-(0[1-9]|1[0-2])$")


def is_period(c: Column) -> Column:
    return is_year_month(c) | c.rlike(r"^\d{4}(-Q[1-4])?$")


def is_week_start(c: Column) -> Column:
    return F.try_to_timestamp(c, F.lit("yyyy-MM-dd")).isNotNull() & (F.length(c) == 10)
