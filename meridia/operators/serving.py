"""The fixed serving queries over the metric datasets, and what dashboards derive from them.

Every query takes the wiki and the last month as parameters; without them, the first wiki by name and all months. Months
that are null never show. Results are small and ordered, nulls first.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from meridia.functions import fields
from meridia.operators import filters
from meridia.plans.contracts import CONTRACTS

#: Talk and content namespaces, and the tiers that the business page shows.
TALK = (1, 3, 5, 7, 9, 11, 13, 15, 101, 829, 1729)
CONTENT = (0, 2, 4, 6, 8, 10, 12, 14, 100, 828, 1728)
SHOWN_TIERS = ("1-4 edits", "5-24 edits", "25-99 edits", "100+ edits")
LEAST_COHORT = 10
TOP = 20
#: page -> dataset of its wikis and months, dataset of its namespaces
PAGES = {"gdp": ("gdp", "gdp"), "labor": ("labor_monthly", "labor_monthly"), "inequality": ("inequality", None), "business": ("labor_monthly", "gdp"), "patrol": ("patrol", "patrol")}


def ratio(a: Column | str, b: Column | str, empty: float | None = 0.0) -> Column:
    """a / b as a double; ``empty`` where b is not above zero."""
    a, b = (F.col(x) if isinstance(x, str) else x for x in (a, b))
    return F.when(b > 0, a.cast("double") / b).otherwise(F.lit(empty).cast("double"))


def total(*columns: str) -> list[Column]:
    """Sums, of nothing zero; ``"a b"`` is the sum of a named b."""
    return [F.coalesce(F.sum(c.split()[0]), F.lit(0)).cast("long").alias(c.split()[-1]) for c in columns]


class Serving:
    """Queries over datasets that ``metric`` gives by name."""

    def __init__(self, metric: Callable[[str], DataFrame], wiki: str | None = None, until: str | None = None):
        self.metric, self.wiki, self.until = metric, wiki, until

    def months(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("year_month") <= self.until) if self.until else df.where("year_month IS NOT NULL")

    def of_wiki(self, name: str) -> DataFrame:
        df = self.metric(name)
        return df.where(F.col("wiki") == (F.lit(self.wiki) if self.wiki else df.agg(F.min("wiki")).scalar()))

    def rows(self, name: str, grain: str = "month", registered: bool = True, articles: bool = False) -> DataFrame:
        """A dataset's rows of the wiki and months, with ``period``."""
        df = self.months(self.of_wiki(name))
        if registered:
            df = df.where("user_type = 'registered'")
        if articles:
            df = df.where("page_namespace = 0")
        return df.withColumn("period", fields.period(F.col("year_month"), grain))

    def sums(self, name: str, keys: tuple[str, ...], columns: tuple[str, ...], more: tuple[Column, ...] = (), **rows) -> DataFrame:
        return self.rows(name, **rows).groupBy(*keys).agg(*total(*columns), *more).orderBy(*keys)

    # lists and ranges

    def wikis(self, page: str) -> DataFrame:
        return self.metric(PAGES[page][0]).select("wiki").distinct().orderBy("wiki")

    def namespaces(self, page: str) -> DataFrame:
        return self.metric(PAGES[page][1]).select("wiki", "page_namespace").distinct().orderBy("wiki", "page_namespace")

    def range(self, page: str) -> DataFrame:
        return self.months(self.metric(PAGES[page][0])).groupBy("wiki").agg(F.min("year_month").alias("mn"), F.max("year_month").alias("mx")).orderBy("wiki")

    def meta(self, page: str) -> DataFrame:
        """A page's wikis, ranges and namespaces under one another, told apart by ``kind``."""
        text = lambda c: F.lit(None).cast(c)
        parts = [self.wikis(page).select(F.lit("wiki").alias("kind"), "wiki", text("int").alias("page_namespace"), text("string").alias("mn"), text("string").alias("mx")), self.range(page).select(F.lit("range").alias("kind"), "wiki", text("int").alias("page_namespace"), "mn", "mx")]
        if PAGES[page][1]:
            parts.append(self.namespaces(page).select(F.lit("namespace").alias("kind"), "wiki", "page_namespace", text("string").alias("mn"), text("string").alias("mx")))
        return reduce(DataFrame.unionByName, parts)

    def defaults(self) -> DataFrame:
        """Each page's first wiki and last month."""
        one = lambda page: self.metric(PAGES[page][0]).agg(F.min("wiki").alias("wiki"), F.max("year_month").alias("max_month")).select(F.lit(page).alias("page"), "wiki", "max_month")
        return reduce(DataFrame.unionByName, map(one, PAGES))

    def counts(self) -> DataFrame:
        """Rows of every dataset."""
        return reduce(DataFrame.unionByName, (self.metric(n).agg(F.count("*").alias("rows")).select(F.lit(n).alias("dataset"), "rows") for n in CONTRACTS))

    # output

    def output(self) -> DataFrame:
        return self.sums("gdp", ("period",), ("gross_bytes_added", "net_bytes", "total_edits", "productive_edits", "reverted_edits", "unique_editors"), grain="year", articles=True)

    def by_type(self) -> DataFrame:
        return self.sums("gdp", ("period", "user_type"), ("gross_bytes_added", "net_bytes", "total_edits", "reverted_edits", "unique_editors"), registered=False, articles=True)

    def by_namespace(self) -> DataFrame:
        return self.sums("gdp", ("period", "page_namespace"), ("total_edits edits", "gross_bytes_added gross_bytes", "net_bytes"), articles=True)

    def tiers(self) -> DataFrame:
        return self.sums("gdp_activity_tiers", ("period", "activity_tier"), ("editors", "total_edits", "gross_bytes", "net_bytes"))

    def type_share(self) -> DataFrame:
        return self.sums("gdp_user_type_share", ("period", "user_type"), ("edits",), registered=False)

    def revert_rate(self) -> DataFrame:
        """Of the latest period."""
        return self.output().orderBy(F.desc("period")).limit(1).select("period", ratio("reverted_edits", "total_edits").alias("revert_rate"))

    def productivity(self) -> DataFrame:
        return self.by_type().withColumn("bytes_per_edit", ratio("net_bytes", "total_edits"))

    def tier_shares(self, value: str = "editors") -> DataFrame:
        return filters.share_of_period(self.tiers(), value)

    def type_shares(self) -> DataFrame:
        return filters.share_of_period(self.type_share(), "edits")

    def sectors(self, grain: str = "year") -> DataFrame:
        rows = self.rows("gdp", grain).withColumn("ns_label", fields.namespace_label(F.col("page_namespace")))
        return rows.groupBy("period", "ns_label").agg(*total("total_edits edits", "gross_bytes_added gross_bytes", "net_bytes")).orderBy("period", "ns_label")

    # labour

    def workforce(self) -> DataFrame:
        return self.sums("labor_monthly", ("period",), ("unique_editors", "total_edits", "net_bytes", "reverted_edits"), grain="year", articles=True)

    def labor_by_type(self) -> DataFrame:
        return self.sums("labor_monthly", ("period", "user_type"), ("unique_editors editors",), registered=False, articles=True)

    def _churn(self, grain: str, last: Column | None) -> DataFrame:
        rows = self.of_wiki("labor_churn").where(F.col("period_type") == grain)
        rows = rows.where(F.col("period") <= last) if last is not None else rows
        return rows.select("period", "period_type", "active_editors", "arrivals", "departures", "arrival_rate", "departure_rate").orderBy("period")

    def churn(self) -> DataFrame:
        return self._churn("month", F.lit(self.until) if self.until else None)

    def cohorts(self) -> DataFrame:
        return self.of_wiki("labor_cohorts").select("cohort_year", "year", "initial_editors", "survived_editors").orderBy("cohort_year", "year")

    def heatmap(self) -> DataFrame:
        rows = self.cohorts()
        latest = self.of_wiki("labor_cohorts").agg(F.max("year")).scalar()
        rows = rows.where("year >= cohort_year AND initial_editors > 0").withColumn("retention", ratio("survived_editors", "initial_editors"))
        return rows.withColumn("years_since", F.col("year").cast("int") - F.col("cohort_year").cast("int")).withColumn("is_partial", F.col("year") == latest)

    def cohort_sizes(self) -> DataFrame:
        return self.heatmap().groupBy("cohort_year").agg(F.min_by("initial_editors", "year").alias("initial_editors")).select("cohort_year", F.lit("n=").alias("year"), "initial_editors").orderBy("cohort_year")

    def survival_summary(self) -> DataFrame:
        """The last year but one; the only one, if there is no other."""
        years = self.of_wiki("labor_cohorts").select("year").distinct().orderBy(F.desc("year")).limit(2)
        return self.heatmap().where(F.col("year") == years.agg(F.min("year")).scalar()).select("cohort_year", "survived_editors", "initial_editors", "retention").orderBy("cohort_year")

    def churn_long(self) -> DataFrame:
        made = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(c).alias("rate")) for m, c in (("Arrival rate", "arrival_rate"), ("Departure rate", "departure_rate"))])
        return self.churn().select("*", F.explode(made).alias("x")).select("period", "x.metric", "x.rate", "active_editors", "arrivals", "departures", "arrival_rate", "departure_rate")

    # inequality

    def inequality(self) -> DataFrame:
        return self.sums("inequality", ("period",), ("total_editors", "total_edits", "min_editors_50pct"), tuple(F.avg(c).alias(c) for c in ("gini", "theil", "palma")), grain="year")

    def fragility(self) -> DataFrame:
        return self.inequality().withColumn("fragility_pct", ratio("min_editors_50pct", "total_editors") * 100)

    # business

    def business_churn(self) -> DataFrame:
        last = fields.period(F.lit(self.until), "quarter") if self.until else self.metric("labor_monthly").agg(F.max(fields.period(F.col("year_month"), "quarter"))).scalar()
        return self._churn("quarter", last)

    def business_tiers(self) -> DataFrame:
        return self.sums("gdp_activity_tiers", ("period", "activity_tier"), ("editors", "total_edits edits", "net_bytes", "gross_bytes"), grain="quarter").withColumnRenamed("activity_tier", "tier")

    def survival(self) -> DataFrame:
        return self.sums("gdp", ("period",), ("total_edits", "reverted_edits"), grain="quarter", articles=True)

    def edit_survival(self) -> DataFrame:
        return self.survival().withColumn("survival_rate", ratio(F.col("total_edits") - F.col("reverted_edits"), F.col("total_edits")))

    def equilibrium_rows(self) -> DataFrame:
        return self.sums("gdp", ("period", "page_namespace"), ("total_edits", "reverted_edits"), grain="quarter")

    def equilibrium(self) -> DataFrame:
        """Edits on talk pages over reverts of content; periods without such reverts are left out."""
        made = self.equilibrium_rows().groupBy("period").agg(
            F.coalesce(F.sum(F.when(F.col("page_namespace").isin(*TALK), F.col("total_edits"))), F.lit(0)).cast("long").alias("talk_edits"), F.coalesce(F.sum(F.when(F.col("page_namespace").isin(*CONTENT), F.col("reverted_edits"))), F.lit(0)).cast("long").alias("content_reverts")
        )
        return made.withColumn("ratio", ratio("talk_edits", "content_reverts", None)).where("ratio IS NOT NULL").orderBy("period")

    def yearly_bytes(self) -> DataFrame:
        return self.sums("gdp", ("period",), ("net_bytes", "unique_editors"), grain="year", articles=True).withColumnRenamed("period", "year")

    def bytes_per_editor(self) -> DataFrame:
        return self.yearly_bytes().select("year", ratio("net_bytes", "unique_editors").alias("bytes_per_editor"))

    def ltv(self) -> DataFrame:
        """Bytes that an editor of a cohort leaves over the years: survival times that year's bytes for each editor."""
        rows = self.cohorts().join(self.bytes_per_editor(), "year", "left")
        worth = ratio("survived_editors", "initial_editors") * F.col("bytes_per_editor")
        made = rows.groupBy("cohort_year").agg(F.min_by("initial_editors", "year").alias("initial_editors"), F.coalesce(F.sum(worth), F.lit(0.0)).alias("ltv_bytes"))
        return made.where(F.col("initial_editors") >= LEAST_COHORT).withColumnRenamed("cohort_year", "cohort").orderBy("cohort")

    def kpis(self) -> DataFrame:
        one = self.business_churn().agg(F.avg("departure_rate").alias("churn_rate"))
        one = one.crossJoin(self.survival().agg(ratio(F.sum("total_edits") - F.sum("reverted_edits"), F.sum("total_edits"), None).alias("survival")))  # a row each
        one = one.crossJoin(self.equilibrium().agg(ratio(F.sum("talk_edits"), F.sum("content_reverts"), None).alias("equilibrium")))
        return one.crossJoin(self.business_tiers().agg(ratio(F.sum(F.when(F.col("tier") == "100+ edits", F.col("editors")).otherwise(0)), F.sum("editors")).alias("conversion")))

    def funnel(self) -> DataFrame:
        return self.of_wiki("business_funnel").orderBy("cohort_year")

    def funnel_long(self) -> DataFrame:
        made = F.array(*[F.struct(F.lit(f"{n}+ edits").alias("milestone"), ratio(f"reached_{n}", "cohort_size").alias("pct"), F.col(f"reached_{n}").alias("editors")) for n in (5, 25, 100)])
        return self.funnel().select("cohort_year", F.explode(made).alias("x"), "cohort_size").select("cohort_year", "x.*", "cohort_size")

    def tier_bytes(self) -> DataFrame:
        """Of the tiers that the page shows; a dataset's two lowest go by other names, so they show in ``four_bands`` alone."""
        return self.business_tiers().where(F.col("tier").isin(*SHOWN_TIERS) & (F.col("editors") > 0)).withColumn("bytes_per_editor", ratio("net_bytes", "editors"))

    def four_bands(self) -> DataFrame:
        band = F.when(F.col("tier").isin("1 edit", "2-4 edits"), SHOWN_TIERS[0]).otherwise(F.col("tier"))
        return self.business_tiers().groupBy("period", band.alias("band")).agg(*total("editors", "net_bytes")).orderBy("period", "band")

    # weekly edits

    def _articles(self) -> DataFrame:
        return self.of_wiki("page_weekly_edits").where("page_namespace = 0")

    def weekly_summary(self) -> DataFrame:
        return self._articles().agg(F.count("*").alias("rows"), F.min("week_start").alias("min_week"), F.max("week_start").alias("max_week"))

    def surge(self) -> DataFrame:
        order = (F.desc("wow_change"), F.desc("edits"), "page_title", "week_start", "page_id")
        top = self._articles().where("previous_week_edits > 0").orderBy(*order).limit(TOP)
        return top.withColumn("week_end", F.date_add(F.to_date("week_start"), 6).cast("string")).select("week_start", "week_end", "page_title", "previous_week_edits", "edits", "wow_change", "wow_rate", "page_id")

    def surge_table(self, host: str = "test.wikipedia.org") -> DataFrame:
        """The ``TOP`` rows as text, with rank and address; a window over them alone."""
        rank = F.row_number().over(W.orderBy(F.desc("wow_change"), F.desc("edits"), "page_title", "week_start", "page_id")).cast("int")
        url = F.concat(F.lit(f"https://{host}/wiki/"), F.replace(F.url_encode("page_title"), F.lit("+"), F.lit("%20")))
        return self.surge().select(
            rank.alias("rank"), F.replace("page_title", F.lit("_"), F.lit(" ")).alias("label"), url.alias("url"), F.concat_ws(" to ", "week_start", "week_end").alias("week"), filters.short_number(F.col("previous_week_edits")).alias("previous"),
            filters.short_number(F.col("edits")).alias("edits"), F.concat(F.lit("+"), filters.short_number(F.col("wow_change"))).alias("change"), F.coalesce(F.format_string("%.2f%%", F.round(F.col("wow_rate") * 100, 2)), F.lit(filters.DASH)).alias("wow"),
        )

    # patrol

    def patrol(self) -> DataFrame:
        means = tuple(F.avg(c).alias(c) for c in ("median_latency_hours", "p90_latency_hours", "patrol_coverage_pct", "adjusted_coverage_pct", "top1_pct"))
        return self.sums("patrol", ("period",), ("total_patrols", "unique_patrollers", "patrol_new_pages", "patrol_diffs", "patrolled_revisions", "autopatrolled_revisions", "total_revisions", "min_patrollers_50pct"), means, grain="year", articles=True)

    def patrol_fragility(self) -> DataFrame:
        return self.patrol().withColumn("fragility_pct", ratio("min_patrollers_50pct", "unique_patrollers") * 100)

    def patrol_kpis(self) -> DataFrame:
        last = lambda c, name: F.max_by(c, "period").alias(name)
        with_latency = F.max_by("median_latency_hours", F.when(F.col("median_latency_hours").isNotNull(), F.col("period"))).alias("latest_latency")
        return self.patrol().agg(*total("total_patrols"), F.max("unique_patrollers").alias("most_patrollers"), with_latency, last("patrol_coverage_pct", "latest_coverage"), last("adjusted_coverage_pct", "latest_adjusted"), F.min("period").alias("first_period"), F.max("period").alias("last_period"))

    def patrol_stack(self) -> DataFrame:
        made = F.array(*[F.struct(F.lit(n).alias("type"), F.col(c).alias("value")) for n, c in (("New pages", "patrol_new_pages"), ("Diffs", "patrol_diffs"))])
        return self.patrol().select("period", F.explode(made).alias("x")).select("period", "x.*")

    # gates, filters and sets

    def by_period(self) -> DataFrame:
        return filters.by_period(self.metric("gdp"), "year", ["total_edits"], ["revert_rate"])

    def grouped(self) -> DataFrame:
        return filters.grouped(self.metric("gdp"), "quarter", ["total_edits"], ["bytes_per_edit"], wiki=self.wiki, user_types=["registered", "bot"], months=("1996-01", "1999-12"), namespaces=[0, 2])

    def patrol_range(self) -> DataFrame:
        return self.metric("patrol").groupBy("wiki").agg(F.min("year_month").alias("mn"), F.max("year_month").alias("mx"), F.array_join(F.array_sort(F.collect_set(F.col("page_namespace").cast("string"))), ",").alias("namespaces"))

    def gate(self) -> DataFrame:
        return self.metric("gdp").agg(F.min("year_month").alias("lo"), F.max("year_month").alias("hi"), *total("total_edits edits"), F.min("wiki").alias("wiki_min"), F.max("wiki").alias("wiki_max"), F.count("*").alias("n"))

    def survivors(self) -> DataFrame:
        back = W.partitionBy("first_year").orderBy(F.desc("last_year")).rowsBetween(W.unboundedPreceding, 0)
        return self.metric("editor_spans").select("first_year", "last_year", F.sum("n").over(back).alias("survivors"))

    def patrolled(self) -> DataFrame:
        return self.metric("patrol_revisions").join(self.metric("patrol_events"), F.col("revision_id") == F.col("current_revision_id"), "left_semi").agg(F.count("*").alias("n"))

    def missing(self) -> DataFrame:
        return self.metric("patrol_events").join(self.metric("patrol_revisions"), F.col("current_revision_id") == F.col("revision_id"), "left_anti").select("current_revision_id").distinct()


def _lists(prefix: str, page: str) -> dict[str, Callable[[Serving], DataFrame]]:
    out = {f"{prefix}_{page}_wikis": lambda s: s.wikis(page), f"{prefix}_{page}_range": lambda s: s.range(page)}
    return out | ({f"{prefix}_{page}_namespaces": lambda s: s.namespaces(page)} if PAGES[page][1] else {})


def _meta(page: str) -> Callable[[Serving], DataFrame]:
    return lambda s: s.meta(page)


#: registered name -> query
SERVING: dict[str, Callable[[Serving], DataFrame]] = {
    **_lists("H1", "gdp"), **_lists("H11", "labor"), **_lists("H12", "inequality"), **_lists("H13", "business"), **_lists("H24", "patrol"),
    **{f"H25_meta_{page}": _meta(page) for page in PAGES},
    "H2_gdp_yearly": Serving.output, "H3_gdp_by_type": Serving.by_type, "H4_gdp_by_namespace": Serving.by_namespace, "H5_gdp_tiers": Serving.tiers, "H6_gdp_type_share": Serving.type_share,
    "H7_labor_yearly": Serving.workforce, "H8_labor_by_type": Serving.labor_by_type, "H9_labor_churn": Serving.churn, "H10_labor_cohorts": Serving.cohorts, "H12_inequality_yearly": Serving.inequality,
    "H14_business_churn": Serving.business_churn, "H15_business_tiers": Serving.business_tiers, "H16_business_survival": Serving.survival, "H17_business_equilibrium": Serving.equilibrium_rows, "H18_business_cohorts": Serving.cohorts,
    "H19_business_yearly": Serving.yearly_bytes, "H20_business_funnel": Serving.funnel, "H21_weekly_summary": Serving.weekly_summary, "H22_weekly_top20": lambda s: s.surge().drop("page_id"), "H23_patrol_yearly": Serving.patrol, "H26_manifest": Serving.counts, "H27_defaults": Serving.defaults,
    "I1_edit_survival": Serving.edit_survival, "I2_equilibrium": Serving.equilibrium, "I3_bytes_per_editor": Serving.bytes_per_editor, "I3_D13_ltv": Serving.ltv, "I4_kpis": Serving.kpis, "I5_funnel_long": Serving.funnel_long, "I6_bytes_per_editor_tier": Serving.tier_bytes,
    "I7_retention": Serving.heatmap, "I7_cohort_sizes": Serving.cohort_sizes, "I8_D12_survival_summary": Serving.survival_summary, "I9_churn_long": Serving.churn_long, "I10_D10_type_share": Serving.type_shares, "I10_tier_share": Serving.tier_shares,
    "I11_C16_sector_output": Serving.sectors, "I12_productivity": Serving.productivity, "I12_revert_rate": Serving.revert_rate, "I13_fragility": Serving.fragility, "I13_patrol_fragility": Serving.patrol_fragility, "I14_patrol_kpis": Serving.patrol_kpis,
    "I14_patrol_stack": Serving.patrol_stack, "I15_surge_rank": Serving.surge_table, "C13_patrol_months": lambda s: s.metric("patrol_months"), "C14_by_period": Serving.by_period, "C15_B32_filtered": Serving.grouped, "C18_range": Serving.patrol_range, "C19_gate": Serving.gate,
    "D11_survivors_window": Serving.survivors, "E2_patrolled_semi": Serving.patrolled, "G5_missing_ids": Serving.missing, "R9_four_bands": Serving.four_bands,
}
