"""Contracts of the published datasets: schemas, minimum rows, conservation, dates and coverage."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

S, I, L, D = "string", "int", "bigint", "double"
#: The published columns and their kinds.
CONTRACTS = {
    "gdp": {"year_month": S, "page_namespace": I, "user_type": S, "gross_bytes_added": L, "net_bytes": L, "total_edits": L, "productive_edits": L, "reverted_edits": L, "unique_editors": L, "minor_edits": L, "bytes_per_edit": D, "bytes_per_editor": D, "revert_rate": D, "wiki": S},
    "gdp_user_type_share": {"year_month": S, "user_type": S, "edits": L, "net_bytes": L, "editors": L, "wiki": S},
    "gdp_activity_tiers": {"year_month": S, "user_type": S, "activity_tier": S, "editors": L, "total_edits": L, "net_bytes": L, "gross_bytes": L, "wiki": S},
    "business_funnel": {"cohort_year": S, "cohort_size": L, "reached_5": L, "reached_25": L, "reached_100": L, "wiki": S},
    "labor_monthly": {"year_month": S, "page_namespace": I, "user_type": S, "unique_editors": L, "total_edits": L, "net_bytes": L, "reverted_edits": L, "wiki": S},
    "labor_cohorts": {"cohort_year": S, "year": S, "survived_editors": L, "initial_editors": L, "wiki": S},
    "labor_churn": {"period": S, "active_editors": L, "arrivals": L, "departures": L, "period_type": S, "arrival_rate": D, "departure_rate": D, "wiki": S},
    "inequality": {"year_month": S, "user_type": S, "gini": D, "theil": D, "palma": D, "min_editors_50pct": L, "total_editors": L, "total_edits": L, "wiki": S},
    "page_weekly_edits": {"week_start": S, "iso_year": I, "iso_week": I, "page_id": L, "page_title": S, "page_namespace": I, "edits": L, "previous_week_edits": L, "wow_change": L, "wow_rate": D, "wiki": S},
    "patrol": {"year_month": S, "wiki": S, "page_namespace": I, "user_type": S, "total_patrols": L, "unique_patrollers": I, "patrol_new_pages": L, "patrol_diffs": L, "median_latency_hours": D, "p90_latency_hours": D, "patrolled_revisions": L, "autopatrolled_revisions": L, "total_revisions": L, "patrol_coverage_pct": D, "adjusted_coverage_pct": D, "top1_pct": D, "min_patrollers_50pct": I},
}
#: The columns whose sums a merge preserves, and the date columns, by which of them a dataset has first.
SUMS = {"gdp": "total_edits", "gdp_activity_tiers": "total_edits", "gdp_user_type_share": "edits", "inequality": "total_edits", "labor_monthly": "total_edits", "page_weekly_edits": "edits", "patrol": "total_patrols"}
DATES = ("year_month", "week_start", "period", "cohort_year")
VERSION = re.compile(r"^\d{4}-(0[1-9]|1[0-2])$")


def check_schema(name: str, df: DataFrame) -> None:
    if dict(df.dtypes) != CONTRACTS[name]:
        raise ValueError(f"{name}: {dict(df.dtypes)} is not {CONTRACTS[name]}")


def check_conservation(name: str, merged: DataFrame, parts: list[DataFrame], value: str | None) -> None:
    """The merged dataset has the parts' rows, and their sum of ``value``, if it has one, which is positive."""
    rows = lambda df: df.agg(F.count("*"), F.coalesce(F.sum(value), F.lit(0)) if value else F.lit(1)).first()
    got, want = rows(merged), [rows(p) for p in parts]
    if got[0] != sum(w[0] for w in want) or (value and (got[1] != sum(w[1] for w in want) or got[1] <= 0)):
        raise ValueError(f"{name}: merged rows and {value} {tuple(got)} are not the parts' {want}")


def check_wiki(name: str, df: DataFrame, wiki: str, least: int) -> None:
    n, lo, hi = df.agg(F.count("*"), F.min("wiki"), F.max("wiki")).first()
    if n < least or (lo, hi) != (wiki, wiki):
        raise ValueError(f"{name}: {n} rows of {lo} to {hi}; {least} of {wiki} are needed")


def check_dates(name: str, df: DataFrame) -> tuple[str | None, str | None]:
    """First and last date of the dataset's first date column, which must be dates of its kind."""
    column = next((c for c in DATES if c in df.columns), None)
    if column is None:
        return None, None
    lo, hi = df.agg(F.min(column), F.max(column)).first()
    kind = {"year_month": r"\d{4}-(0[1-9]|1[0-2])", "week_start": r"\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])", "period": r"\d{4}(-(0[1-9]|1[0-2])|-Q[1-4])?", "cohort_year": r"\d{4}"}[column]
    for value in (lo, hi):
        if value is not None and not re.fullmatch(kind, value):
            raise ValueError(f"{name}: {value} is no {column}")
    return lo, hi


def check_weekly(weekly: DataFrame, revisions: DataFrame) -> None:
    """Weekly edits add up to the revisions of a page, and no page has a week twice."""
    key = ("page_id", "page_namespace", "page_title", "week_start")
    twice = weekly.groupBy(*key).count().where("count > 1").limit(1).count()
    edits, want = weekly.agg(F.coalesce(F.sum("edits"), F.lit(0))).first()[0], revisions.agg(F.count("page_id")).first()[0]
    if twice or edits != want or weekly.where("edits IS NULL").limit(1).count():
        raise ValueError(f"page_weekly_edits: {edits} edits of {want} revisions{', a page with a week twice' if twice else ''}")


def summary(df: DataFrame) -> dict:
    """Schema, rows, and first and last date."""
    lo, hi = check_dates("dataset", df)
    return {"schema": [f"{c}:{t}" for c, t in df.dtypes], "rows": df.count(), "first": lo, "last": hi}


def version_at_lag(latest: str, lag: int) -> str:
    """The snapshot ``lag`` months before ``latest``."""
    if not VERSION.match(latest):
        raise ValueError(f"not a snapshot version: {latest}")
    at = int(latest[:4]) * 12 + int(latest[5:]) - 1 - lag
    return f"{at // 12:04d}-{at % 12 + 1:02d}"


def check_cutoff(version: str, cutoff: str, paused: bool = False) -> None:
    """Data end at most two months before a snapshot's month and one after it; exactly there, if it is paused."""
    gap = (int(version[:4]) - int(cutoff[:4])) * 12 + int(version[5:7]) - int(cutoff[5:7])
    if (gap != 0) if paused else not -1 <= gap <= 2:
        raise ValueError(f"cutoff {cutoff} is not plausible for snapshot {version}")


def check_coverage(published: set[str], merged: set[str], subset: set[str] | None = None) -> None:
    """All published wikis are merged, or exactly a subset that is named."""
    if merged != (published if subset is None else subset) or not merged <= published:
        raise ValueError(f"merged {sorted(merged)}; published {sorted(published)}, asked {sorted(subset or published)}")
