"""Every registered query of the engine: relations resolved to Spark SQL, serving queries over them, and their oracles."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from meridia.functions import fields
from meridia.operators import filters
from meridia.operators.metrics import RELATIONS
from meridia.operators.serving import SERVING, Serving
from meridia.plans import oracles
from meridia.plans.views import VIEWS
from meridia.streaming.weekly import weekly_counts

TABLES = ("lineitem", "orders", "customer", "supplier", "part", "nation", "region", "events")
#: The wiki that the test tables stand for, and the groups there whose edits count as patrolled.
WIKI = "testwiki"
GROUPS = ("autopatrolled", "sysop")
DEFINED = {**VIEWS, **RELATIONS}
#: Registered name -> relation. Serving queries go by their own names.
METRICS = {
    "C1_gdp": "gdp", "C2_gdp_user_type_share": "gdp_user_type_share", "C3_gdp_activity_tiers": "gdp_activity_tiers", "C4_business_funnel": "business_funnel", "C5_labor_monthly": "labor_monthly",
    "C6_labor_cohorts": "labor_cohorts", "C7_labor_churn": "labor_churn", "C8_inequality": "inequality", "C9_D7_page_weekly_edits": "page_weekly_edits", "C10_patrol_revision_counts": "patrol_revision_counts",
    "C11_patrol_event_counts": "patrol_event_counts", "C12_patrol": "patrol", "C20_registered_editors": "registered_editors", "D5_patrol_latency": "patrol_latency", "D6_patrol_concentration": "patrol_concentration",
    "D9_autopatrol_intervals": "intervals", "E1_patrol_event_rows": "patrol_event_rows",
}


def _needs(sql: str) -> list[str]:
    return re.findall(r"\{(\w+)\}", sql)


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def with_ctes(name: str, given: tuple[str, ...] = (), wiki: str = WIKI, groups: tuple[str, ...] = GROUPS) -> str:
    """The relation's SQL with all that it reads as CTEs, each once, in order; relations in ``given`` stay in braces."""
    ctes: dict[str, str] = {}

    def visit(of: str) -> str:
        sql = DEFINED[of]
        for need in _needs(sql):
            if need not in ctes and need not in given:
                ctes[need] = visit(need)
        return re.sub(r"\{(\w+)\}", lambda m: m[0] if m[1] in given else m[1], sql)

    body = visit(name)
    sql = ("WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" if ctes else "") + body
    held = f"array({', '.join(map(_literal, groups))})" if groups else "CAST(array() AS ARRAY<STRING>)"
    return sql.replace(":groups", held).replace(":wiki", _literal(wiki))


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The relation over the tables of ``sf_dir``: one plan, left to Catalyst and adaptive execution."""
    sql = with_ctes(name)
    used = [t for t in TABLES if re.search(rf"\b{t}\b", sql)]
    frames = {f"t_{t}": spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in used}
    for t in used:
        sql = re.sub(rf"\b(FROM|JOIN) {t}\b", rf"\1 {{t_{t}}}", sql)
    return spark.sql(sql, **frames)


def over(spark: SparkSession, name: str, wiki: str = WIKI, groups: tuple[str, ...] = GROUPS, **inputs: DataFrame) -> DataFrame:
    """The relation, or the serving query, over frames of one's own: ``revisions``, ``patrol_events`` and so on, as the metrics' SQL names them."""

    def one(of: str) -> DataFrame:
        if of in inputs:
            return inputs[of]
        sql = with_ctes(of, tuple(inputs), wiki, groups)
        return spark.sql(sql, **{k: v for k, v in inputs.items() if f"{{{k}}}" in sql})

    return SERVING[name](Serving(one)) if name in SERVING else one(name)


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to so many places: sums of doubles depend on their order, and results are compared by hash."""
    return df.select(*[F.round(F.col(f"`{c}`"), places).alias(c) if t == "double" else F.col(f"`{c}`") for c, t in df.dtypes])


def _query(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(relation(spark, sf_dir, name))


def _served(name: str) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(SERVING[name](Serving(lambda of: relation(spark, sf_dir, of), WIKI)))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def field_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Queries on the column functions."""
    orders = lambda spark, d: _table(spark, d, "orders")
    stamp = lambda: F.col("o_orderdate").cast("string")

    def stamps(spark, d):
        ts = stamp()
        odd = F.concat(F.replace(ts, F.lit(" "), F.lit("T")), F.lit(".5Z"))
        return orders(spark, d).select("o_orderkey", fields.normal_timestamp(odd).alias("normal"), fields.epoch(odd).alias("epoch"), fields.year(ts).alias("year"), fields.year_month_key(ts).alias("month_key"), fields.shift_month(fields.year_month_key(ts), -13).alias("shifted"))

    def periods(spark, d):
        ts = stamp()
        month = fields.year_month(ts)
        return orders(spark, d).select("o_orderkey", *[fields.period(month, g).alias(g) for g in fields.GRAINS], fields.week_start(ts).cast("string").alias("week"), fields.is_period(month).alias("valid"))

    def tiers(spark, d):
        return _table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("edits")).select("l_suppkey", fields.activity_tier(F.col("edits")).alias("tier"), fields.round1(F.col("edits") / 8).alias("rounded"))

    def labels(spark, d):
        return _table(spark, d, "nation").select("n_nationkey", fields.namespace_label(F.col("n_nationkey") - 3).alias("label"), fields.namespace_label(F.when(F.col("n_nationkey") < 20, F.col("n_nationkey") * 100 + F.col("n_nationkey") % 2)).alias("far"), filters.short_number(F.col("n_nationkey") * F.col("n_nationkey") * 977).alias("short"), fields.title_user(F.concat(F.lit("User:"), "n_name")).alias("title"))

    def params(spark, d):
        legacy = F.concat_ws("\n", F.col("o_orderkey").cast("string"), (F.col("o_orderkey") - 1).cast("string"), F.lit("1"))
        return orders(spark, d).select("o_orderkey", fields.patrol_params(legacy).alias("p")).select("o_orderkey", "p.*")

    def weekly(spark, d):
        return weekly_counts(_table(spark, d, "events"))

    return {"B21_B24_timestamps": stamps, "B14_B19_periods": periods, "B12_B30_tiers": tiers, "B28_B31_labels": labels, "B25_patrol_params": params, "S1_weekly_events": weekly}


FIELD_ORACLES = {
    "B21_B24_timestamps": "SELECT o_orderkey, CAST(o_orderdate AS VARCHAR) AS normal, CAST(epoch(o_orderdate) AS BIGINT) AS epoch, CAST(year(o_orderdate) AS INT) AS year, CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INT) AS month_key, CAST(year(o_orderdate - INTERVAL 13 MONTHS) * 100 + month(date_trunc('month', o_orderdate) - INTERVAL 13 MONTHS) AS INT) AS shifted FROM orders",
    "B14_B19_periods": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, year(o_orderdate) || '-Q' || quarter(o_orderdate) AS quarter, CAST(year(o_orderdate) AS VARCHAR) AS year, CAST(CAST(date_trunc('week', o_orderdate) AS DATE) AS VARCHAR) AS week, TRUE AS valid FROM orders",
    "B12_B30_tiers": "SELECT l_suppkey, CASE WHEN count(*) = 1 THEN '1 edit' WHEN count(*) < 5 THEN '2-4 edits' WHEN count(*) < 25 THEN '5-24 edits' WHEN count(*) < 100 THEN '25-99 edits' ELSE '100+ edits' END AS tier, round(count(*) / 8e0 * 10) / 10 AS rounded FROM lineitem GROUP BY l_suppkey",
    "B28_B31_labels": f"SELECT n_nationkey, {oracles.label('n_nationkey - 3')} AS label, {oracles.label('CASE WHEN n_nationkey < 20 THEN n_nationkey * 100 + n_nationkey % 2 END')} AS far, n_name AS title, {oracles.SHORT.format('(n_nationkey * n_nationkey * 977)')} AS short FROM nation",
    "B25_patrol_params": "SELECT o_orderkey, o_orderkey AS current_revision_id, o_orderkey - 1 AS prev_revision_id, TRUE AS is_auto FROM orders",
    "S1_weekly_events": "SELECT CAST(CAST(date_trunc('week', ts) AS DATE) AS VARCHAR) AS week_start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {**field_queries(), **{k: _query(v) for k, v in METRICS.items()}, **{k: _served(k) for k in SERVING}}
ORACLES: dict[str, str] = {**FIELD_ORACLES, **{k: oracles.sql(v) for k, v in METRICS.items()}, **{k: oracles.sql(k) for k in SERVING}}
