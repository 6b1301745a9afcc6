"""DuckDB SQL for every query of the engine, by definition: rows are looked at one by one where the engine works on counts.

Nothing here is made from the engine's own SQL but the four input views, which only say what the test tables stand for.
"""

from __future__ import annotations

import re

from meridia.plans.views import VIEWS

WIKI = "testwiki"
QUARTER = "left(year_month, 4) || '-Q' || ((CAST(substr(year_month, 6, 2) AS INT) + 2) // 3)"
YEAR = "left(year_month, 4)"
MINE = f"wiki = '{WIKI}' AND year_month IS NOT NULL"
HAS = "len(list_intersect(list_transform(string_split({}, ','), lambda g: trim(g)), ['autopatrolled', 'sysop'])) > 0"
KEY = "year_month, page_namespace, user_type"

METRICS = {
    "gdp": f"""SELECT left(event_timestamp, 7) AS year_month, page_namespace, user_type, coalesce(sum(diff) FILTER (diff > 0), 0)::BIGINT AS gross_bytes_added, coalesce(sum(diff), 0)::BIGINT AS net_bytes,
  count(revision_id) AS total_edits, count(*) FILTER (reverted = FALSE) AS productive_edits, count(*) FILTER (reverted) AS reverted_edits, count(DISTINCT coalesce(event_user_id, -1)) AS unique_editors, count(*) FILTER (minor) AS minor_edits,
  net_bytes::DOUBLE / total_edits AS bytes_per_edit, net_bytes::DOUBLE / unique_editors AS bytes_per_editor, reverted_edits::DOUBLE / total_edits AS revert_rate, '{WIKI}' AS wiki FROM {{revisions}} GROUP BY 1, 2, 3""",
    "gdp_user_type_share": f"SELECT left(event_timestamp, 7) AS year_month, user_type, count(revision_id) AS edits, sum(diff)::BIGINT AS net_bytes, count(DISTINCT coalesce(event_user_id, -1)) AS editors, '{WIKI}' AS wiki FROM {{revisions}} GROUP BY 1, 2",
    "editor_months": "SELECT left(event_timestamp, 7) AS year_month, user_type, event_user_id, count(revision_id) AS edits, sum(diff)::BIGINT AS net_bytes, coalesce(sum(diff) FILTER (diff > 0), 0)::BIGINT AS gross_bytes FROM {revisions} GROUP BY 1, 2, 3",
    "gdp_activity_tiers": f"""SELECT year_month, user_type, CASE WHEN edits >= 100 THEN '100+ edits' WHEN edits >= 25 THEN '25-99 edits' WHEN edits >= 5 THEN '5-24 edits' WHEN edits <> 1 THEN '2-4 edits' ELSE '1 edit' END AS activity_tier,
  count(event_user_id) AS editors, sum(edits)::BIGINT AS total_edits, sum(net_bytes)::BIGINT AS net_bytes, sum(gross_bytes)::BIGINT AS gross_bytes, '{WIKI}' AS wiki FROM {{editor_months}} GROUP BY 1, 2, 3""",
    "registered_editors": "SELECT event_user_id, count(revision_id) AS edits, min(left(event_timestamp, 4))::INT AS first_year, max(left(event_timestamp, 4))::INT AS last_year FROM {revisions} WHERE user_type = 'registered' AND event_user_id IS NOT NULL GROUP BY 1",
    "business_funnel": f"SELECT first_year::VARCHAR AS cohort_year, count(*) AS cohort_size, count(*) FILTER (edits >= 5) AS reached_5, count(*) FILTER (edits >= 25) AS reached_25, count(*) FILTER (edits >= 100) AS reached_100, '{WIKI}' AS wiki FROM {{registered_editors}} GROUP BY 1",
    "labor_monthly": f"SELECT left(event_timestamp, 7) AS year_month, page_namespace, user_type, count(DISTINCT coalesce(event_user_id, -1)) AS unique_editors, count(revision_id) AS total_edits, sum(diff)::BIGINT AS net_bytes, count(*) FILTER (reverted) AS reverted_edits, '{WIKI}' AS wiki FROM {{revisions}} GROUP BY 1, 2, 3",
    "labor_cohorts": f"""SELECT e.first_year::VARCHAR AS cohort_year, y.year::VARCHAR AS year, count(*) FILTER (e.last_year >= y.year) AS survived_editors, count(*) AS initial_editors, '{WIKI}' AS wiki
  FROM {{registered_editors}} e JOIN (SELECT first_year AS year FROM {{registered_editors}} UNION SELECT last_year FROM {{registered_editors}}) y ON y.year >= e.first_year GROUP BY 1, 2""",
    "editor_periods": "SELECT DISTINCT event_user_id AS u, t.period_type, CASE t.period_type WHEN 'month' THEN left(event_timestamp, 7) WHEN 'quarter' THEN left(event_timestamp, 4) || '-Q' || quarter(event_timestamp::TIMESTAMP) ELSE left(event_timestamp, 4) END AS period FROM {revisions}, (VALUES ('month'), ('quarter'), ('year')) t(period_type) WHERE user_type = 'registered' AND event_user_id IS NOT NULL",
    "labor_churn": f"""SELECT a.period, a.active AS active_editors, coalesce(f.n, 0) AS arrivals, coalesce(l.n, 0) AS departures, a.period_type, arrivals::DOUBLE / active_editors AS arrival_rate, departures::DOUBLE / active_editors AS departure_rate, '{WIKI}' AS wiki
  FROM (SELECT period_type, period, count(*) AS active FROM {{editor_periods}} GROUP BY 1, 2) a
  LEFT JOIN (SELECT period_type, p, count(*) AS n FROM (SELECT period_type, u, min(period) AS p FROM {{editor_periods}} GROUP BY 1, 2) GROUP BY 1, 2) f ON a.period_type = f.period_type AND a.period = f.p
  LEFT JOIN (SELECT period_type, p, count(*) AS n FROM (SELECT period_type, u, max(period) AS p FROM {{editor_periods}} GROUP BY 1, 2) GROUP BY 1, 2) l ON a.period_type = l.period_type AND a.period = l.p""",
    "inequality": f"""SELECT year_month, user_type, CASE WHEN any_value(s) = 0 THEN 0e0 ELSE 2e0 * sum(i::DOUBLE * edits) / (any_value(n) * any_value(s)::DOUBLE) - (any_value(n) + 1e0) / any_value(n) END AS gini,
  CASE WHEN any_value(s) = 0 THEN 0e0 ELSE sum(CASE WHEN edits > 0 THEN edits * n::DOUBLE / s * ln(edits * n::DOUBLE / s) ELSE 0e0 END) / any_value(n) END AS theil,
  CASE WHEN any_value(n) < 10 OR any_value(s) = 0 THEN 0e0 WHEN coalesce(sum(edits) FILTER (i <= floor(n * 0.4e0)), 0) = 0 THEN 'Infinity'::DOUBLE ELSE (sum(edits) FILTER (i > n - floor(n * 0.1e0)))::DOUBLE / (sum(edits) FILTER (i <= floor(n * 0.4e0))) END AS palma,
  CASE WHEN any_value(s) = 0 THEN 0 ELSE min(k) FILTER (2 * run >= s) END::BIGINT AS min_editors_50pct, any_value(n)::BIGINT AS total_editors, any_value(s)::BIGINT AS total_edits, '{WIKI}' AS wiki
  FROM (SELECT *, count(*) OVER g AS n, sum(edits) OVER g AS s, row_number() OVER (PARTITION BY year_month, user_type ORDER BY edits, event_user_id) AS i, row_number() OVER d AS k, sum(edits) OVER (d ROWS UNBOUNDED PRECEDING) AS run
    FROM {{editor_months}} WHERE year_month IS NOT NULL AND user_type IS NOT NULL WINDOW g AS (PARTITION BY year_month, user_type), d AS (PARTITION BY year_month, user_type ORDER BY edits DESC, event_user_id)) GROUP BY 1, 2 HAVING any_value(n) >= 2""",
    "weeks": "SELECT date_trunc('week', left(event_timestamp, 10)::DATE)::DATE AS week, page_id, page_title, page_namespace, count(page_id) AS edits FROM {revisions} GROUP BY ALL",
    "page_weekly_edits": f"""SELECT w.week::VARCHAR AS week_start, isoyear(w.week)::INT AS iso_year, weekofyear(w.week)::INT AS iso_week, w.page_id, w.page_title, w.page_namespace, w.edits, coalesce(p.edits, 0) AS previous_week_edits, w.edits - previous_week_edits AS wow_change, CASE WHEN previous_week_edits <> 0 THEN wow_change::DOUBLE / previous_week_edits END AS wow_rate, '{WIKI}' AS wiki
  FROM {{weeks}} w LEFT JOIN {{weeks}} p ON p.week = w.week - 7 AND p.page_id IS NOT DISTINCT FROM w.page_id AND p.page_title IS NOT DISTINCT FROM w.page_title AND p.page_namespace IS NOT DISTINCT FROM w.page_namespace""",
    "transitions": f"SELECT target_user, t, has FROM (SELECT target_user, t, has, lag(has) OVER (PARTITION BY target_user ORDER BY t) AS had FROM (SELECT target_user, event_timestamp AS t, max({HAS.format('new_groups')}) AS has FROM {{rights_events}} WHERE ({HAS.format('new_groups')}) <> ({HAS.format('old_groups')}) GROUP BY 1, 2)) WHERE had IS DISTINCT FROM has",
    "intervals": "SELECT s.target_user, s.t AS start_ts, (SELECT min(e.t) FROM {transitions} e WHERE e.target_user = s.target_user AND e.t > s.t) AS end_ts FROM {transitions} s WHERE s.has",
    "patrol_revision_counts": f"""SELECT left(r.event_timestamp, 7) AS year_month, coalesce(r.page_namespace, 0) AS page_namespace, r.user_type, count(*) AS total_revisions, count(*) FILTER (patrolled) AS patrolled_revisions, count(*) FILTER (NOT patrolled AND r.event_user_text IN (SELECT target_user FROM {{intervals}} i WHERE i.target_user = r.event_user_text AND i.start_ts <= r.event_timestamp AND coalesce(i.end_ts, '9999') > r.event_timestamp)) AS autopatrolled_revisions
  FROM (SELECT *, revision_id IN (SELECT current_revision_id FROM {{patrol_events}}) AS patrolled FROM {{patrol_revisions}} WHERE revision_id IS NOT NULL) r WHERE left(r.event_timestamp, 7) IN (SELECT left(event_timestamp, 7) FROM {{patrol_events}}) GROUP BY 1, 2, 3""",
    "patrol_event_rows": """SELECT left(e.event_timestamp, 7) AS year_month, coalesce(r.page_namespace, 0) AS page_namespace, coalesce(r.user_type, 'registered') AS user_type, e.log_id, e.patroller, coalesce(e.prev_revision_id, 0) AS prev_revision_id,
  CASE WHEN h > 0 AND h <= 8760 THEN h END AS latency FROM (SELECT e.*, r, (epoch(e.event_timestamp::TIMESTAMP) - epoch(r.event_timestamp::TIMESTAMP)) / 3600e0 AS h FROM {patrol_events} e LEFT JOIN {patrol_revisions} r ON e.current_revision_id = r.revision_id) e""",
    "patrol_event_counts": f"SELECT {KEY}, count(*) AS total_patrols, count(DISTINCT patroller) AS unique_patrollers, count(*) FILTER (prev_revision_id = 0) AS patrol_new_pages, count(*) FILTER (prev_revision_id <> 0) AS patrol_diffs FROM {{patrol_event_rows}} GROUP BY ALL",
    "patrol_latency": f"SELECT {KEY}, l[(len(l) - 1) // 2 + 1] AS median_latency, l[least(floor(len(l) * 0.9e0)::INT, len(l) - 1) + 1] AS p90_latency FROM (SELECT {KEY}, list(latency ORDER BY latency) AS l FROM {{patrol_event_rows}} WHERE latency IS NOT NULL GROUP BY ALL)",
    "patrol_concentration": f"""SELECT {KEY}, coalesce(max(c) FILTER (patroller IS NOT NULL), 0)::BIGINT AS top1, coalesce(min(k) FILTER (patroller IS NOT NULL AND 2 * run >= total), count(patroller))::BIGINT AS min50
  FROM (SELECT *, row_number() OVER w AS k, sum(c) OVER (w ROWS UNBOUNDED PRECEDING) AS run, sum(c) OVER (PARTITION BY {KEY}) AS total FROM (SELECT {KEY}, patroller, count(*) AS c FROM {{patrol_event_rows}} GROUP BY ALL) WINDOW w AS (PARTITION BY {KEY} ORDER BY patroller IS NULL, c DESC, patroller)) GROUP BY ALL""",
    "patrol": f"""SELECT year_month, '{WIKI}' AS wiki, page_namespace, user_type, coalesce(total_patrols, 0) AS total_patrols, coalesce(unique_patrollers, 0)::INT AS unique_patrollers, coalesce(patrol_new_pages, 0) AS patrol_new_pages, coalesce(patrol_diffs, 0) AS patrol_diffs,
  round(median_latency * 10) / 10 AS median_latency_hours, round(p90_latency * 10) / 10 AS p90_latency_hours, coalesce(patrolled_revisions, 0) AS patrolled_revisions, coalesce(autopatrolled_revisions, 0) AS autopatrolled_revisions, coalesce(total_revisions, 0) AS total_revisions,
  CASE WHEN total_revisions > 0 THEN round(1000e0 * patrolled_revisions / total_revisions) / 10 ELSE 0e0 END AS patrol_coverage_pct, CASE WHEN total_revisions > 0 THEN round(1000e0 * (patrolled_revisions + autopatrolled_revisions) / total_revisions) / 10 ELSE 0e0 END AS adjusted_coverage_pct,
  CASE WHEN total_patrols > 0 THEN round(1000e0 * top1 / total_patrols) / 10 ELSE 0e0 END AS top1_pct, coalesce(min50, 0)::INT AS min_patrollers_50pct
  FROM {{patrol_event_counts}} FULL JOIN {{patrol_revision_counts}} USING ({KEY}) LEFT JOIN {{patrol_latency}} USING ({KEY}) LEFT JOIN {{patrol_concentration}} USING ({KEY})""",
}


def sums(*columns: str) -> str:
    return ", ".join(f"coalesce(sum({c.split(' ')[0]}), 0)::BIGINT AS {c.split(' ')[-1]}" for c in columns)


def lists(prefix: str, dataset: str, ns_of: str | None = None, months_of: str | None = None) -> dict[str, str]:
    out = {f"{prefix}_wikis": f"SELECT DISTINCT wiki FROM {{{dataset}}}", f"{prefix}_range": f"SELECT wiki, min(year_month) AS mn, max(year_month) AS mx FROM {{{dataset}}} GROUP BY wiki"}
    return out | ({f"{prefix}_namespaces": f"SELECT DISTINCT wiki, page_namespace FROM {{{ns_of}}}"} if ns_of else {})


def meta(dataset: str, ns_of: str | None = None) -> str:
    parts = [f"SELECT 'wiki' AS kind, wiki, NULL::INT AS page_namespace, NULL::VARCHAR AS mn, NULL::VARCHAR AS mx FROM {{{dataset}}} GROUP BY wiki", f"SELECT 'range', wiki, NULL, min(year_month), max(year_month) FROM {{{dataset}}} GROUP BY wiki"]
    return " UNION ALL ".join(parts + ([f"SELECT DISTINCT 'namespace', wiki, page_namespace, NULL, NULL FROM {{{ns_of}}}"] if ns_of else []))


#: Labels of namespaces.
LABELS = {0: "Article", 1: "Talk", 2: "User", 3: "User Talk", 4: "Wikipedia", 5: "Wikipedia Talk", 6: "File", 7: "File Talk", 8: "MediaWiki", 9: "MediaWiki Talk", 10: "Template", 11: "Template Talk", 12: "Help", 13: "Help Talk", 14: "Category", 15: "Category Talk", 100: "Portal", 101: "Portal Talk", 828: "Module", 829: "Module Talk", 1728: "Draft", 1729: "Draft Talk", 2300: "Gadget", 2301: "Gadget definition", 2302: "Gadget Talk", 2303: "Gadget definition Talk"}


def label(n: str) -> str:
    return f"CASE {n} " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in LABELS.items()) + f" ELSE coalesce('ns ' || ({n}), '(no namespace)') END"


TOP20 = f"SELECT week_start, page_title, page_namespace, page_id, previous_week_edits, edits, wow_change, wow_rate FROM {{page_weekly_edits}} WHERE wiki = '{WIKI}' AND page_namespace = 0 AND previous_week_edits > 0 ORDER BY wow_change DESC, edits DESC, page_title, week_start, page_id LIMIT 20"
EQUILIBRIUM = f"SELECT {QUARTER} AS period, coalesce(sum(total_edits) FILTER (page_namespace IN (1, 3, 5, 7, 9, 11, 13, 15, 101, 829, 1729)), 0)::BIGINT AS talk_edits, coalesce(sum(reverted_edits) FILTER (page_namespace IN (0, 2, 4, 6, 8, 10, 12, 14, 100, 828, 1728)), 0)::BIGINT AS content_reverts FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' GROUP BY 1 HAVING content_reverts > 0"
AVERAGES = "avg(gini) AS gini, avg(theil) AS theil, avg(palma) AS palma"
HEATMAP = f"SELECT cohort_year, year, survived_editors, initial_editors, survived_editors::DOUBLE / initial_editors AS retention, year::INT - cohort_year::INT AS years_since, year = (SELECT max(year) FROM {{labor_cohorts}} WHERE wiki = '{WIKI}') AS is_partial FROM {{labor_cohorts}} WHERE wiki = '{WIKI}' AND year >= cohort_year AND initial_editors > 0"
PATROL_YEARLY = f"SELECT {YEAR} AS period, {sums('total_patrols', 'unique_patrollers', 'patrol_new_pages', 'patrol_diffs')}, avg(median_latency_hours) AS median_latency_hours, avg(p90_latency_hours) AS p90_latency_hours, {sums('patrolled_revisions', 'autopatrolled_revisions', 'total_revisions')}, avg(patrol_coverage_pct) AS patrol_coverage_pct, avg(adjusted_coverage_pct) AS adjusted_coverage_pct, avg(top1_pct) AS top1_pct, {sums('min_patrollers_50pct')} FROM {{patrol}} WHERE {MINE} AND page_namespace = 0 AND user_type = 'registered' GROUP BY 1"
INEQUALITY_YEARLY = f"SELECT {YEAR} AS period, {sums('total_editors', 'total_edits', 'min_editors_50pct')}, {AVERAGES} FROM {{inequality}} WHERE {MINE} AND user_type = 'registered' GROUP BY 1"
CHURN = "period, period_type, active_editors, arrivals, departures, arrival_rate, departure_rate"
BUSINESS_CHURN = f"SELECT {CHURN} FROM {{labor_churn}} WHERE wiki = '{WIKI}' AND period_type = 'quarter' AND period <= (SELECT max({QUARTER}) FROM {{labor_monthly}})"
MONTH_CHURN = f"SELECT {CHURN} FROM {{labor_churn}} WHERE wiki = '{WIKI}' AND period_type = 'month'"
BY_TYPE = f"SELECT year_month AS period, user_type, {sums('gross_bytes_added', 'net_bytes', 'total_edits', 'reverted_edits', 'unique_editors')} FROM {{gdp}} WHERE {MINE} AND page_namespace = 0 GROUP BY 1, 2"
BUSINESS_TIERS = f"SELECT {QUARTER} AS period, activity_tier AS tier, {sums('editors', 'total_edits edits', 'net_bytes', 'gross_bytes')} FROM {{gdp_activity_tiers}} WHERE {MINE} AND user_type = 'registered' GROUP BY 1, 2"
GDP_TIERS = f"SELECT year_month AS period, activity_tier, {sums('editors', 'total_edits', 'gross_bytes', 'net_bytes')} FROM {{gdp_activity_tiers}} WHERE {MINE} AND user_type = 'registered' GROUP BY 1, 2"
OUTPUT = f"SELECT {YEAR} AS period, {sums('gross_bytes_added', 'net_bytes', 'total_edits', 'productive_edits', 'reverted_edits', 'unique_editors')} FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' AND page_namespace = 0 GROUP BY 1"
SURVIVAL = f"SELECT {QUARTER} AS period, {sums('total_edits', 'reverted_edits')} FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' AND page_namespace = 0 GROUP BY 1"
FUNNEL = f"SELECT * FROM {{business_funnel}} WHERE wiki = '{WIKI}'"
BYTES = f"SELECT {YEAR} AS year, {sums('net_bytes', 'unique_editors')} FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' AND page_namespace = 0 GROUP BY 1"
SHORT = "CASE WHEN abs({0}) >= 1000000000 THEN printf('%.1fB', abs({0}) / 1e9) WHEN abs({0}) >= 1000000 THEN printf('%.1fM', abs({0}) / 1e6) WHEN abs({0}) >= 10000 THEN printf('%.1fK', abs({0}) / 1e3) WHEN abs({0}) >= 1000 THEN (abs({0}) // 1000) || ',' || lpad((abs({0}) % 1000)::VARCHAR, 3, '0') ELSE abs({0})::VARCHAR END"

SERVING = {
    **lists("H1_gdp", "gdp", "gdp"), **lists("H11_labor", "labor_monthly", "labor_monthly"), **lists("H12_inequality", "inequality"), **lists("H13_business", "labor_monthly", "gdp"), **lists("H24_patrol", "patrol", "patrol"),
    "H25_meta_gdp": meta("gdp", "gdp"), "H25_meta_labor": meta("labor_monthly", "labor_monthly"), "H25_meta_business": meta("labor_monthly", "gdp"), "H25_meta_patrol": meta("patrol", "patrol"), "H25_meta_inequality": meta("inequality"),
    "H2_gdp_yearly": OUTPUT,
    "H3_gdp_by_type": BY_TYPE,
    "H4_gdp_by_namespace": f"SELECT year_month AS period, page_namespace, {sums('total_edits edits', 'gross_bytes_added gross_bytes', 'net_bytes')} FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' AND page_namespace = 0 GROUP BY 1, 2",
    "H5_gdp_tiers": GDP_TIERS,
    "H6_gdp_type_share": f"SELECT year_month AS period, user_type, {sums('edits')} FROM {{gdp_user_type_share}} WHERE {MINE} GROUP BY 1, 2",
    "H7_labor_yearly": f"SELECT {YEAR} AS period, {sums('unique_editors', 'total_edits', 'net_bytes', 'reverted_edits')} FROM {{labor_monthly}} WHERE {MINE} AND user_type = 'registered' AND page_namespace = 0 GROUP BY 1",
    "H8_labor_by_type": f"SELECT year_month AS period, user_type, {sums('unique_editors editors')} FROM {{labor_monthly}} WHERE {MINE} AND page_namespace = 0 GROUP BY 1, 2",
    "H9_labor_churn": MONTH_CHURN,
    "H10_labor_cohorts": f"SELECT cohort_year, year, initial_editors, survived_editors FROM {{labor_cohorts}} WHERE wiki = '{WIKI}'",
    "H12_inequality_yearly": INEQUALITY_YEARLY,
    "H14_business_churn": BUSINESS_CHURN,
    "H15_business_tiers": BUSINESS_TIERS,
    "H16_business_survival": SURVIVAL,
    "H17_business_equilibrium": f"SELECT {QUARTER} AS period, page_namespace, {sums('total_edits', 'reverted_edits')} FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' GROUP BY 1, 2",
    "H18_business_cohorts": f"SELECT cohort_year, year, initial_editors, survived_editors FROM {{labor_cohorts}} WHERE wiki = '{WIKI}'",
    "H19_business_yearly": BYTES,
    "H20_business_funnel": FUNNEL,
    "H21_weekly_summary": f"SELECT count(*) AS \"rows\", min(week_start) AS min_week, max(week_start) AS max_week FROM {{page_weekly_edits}} WHERE wiki = '{WIKI}' AND page_namespace = 0",
    "H22_weekly_top20": f"SELECT week_start, (week_start::DATE + 6)::DATE::VARCHAR AS week_end, page_title, previous_week_edits, edits, wow_change, wow_rate FROM ({TOP20})",
    "H23_patrol_yearly": PATROL_YEARLY,
    "H26_manifest": " UNION ALL ".join(f"SELECT '{n}' AS dataset, count(*) AS \"rows\" FROM {{{n}}}" for n in ("gdp", "gdp_user_type_share", "gdp_activity_tiers", "business_funnel", "labor_monthly", "labor_cohorts", "labor_churn", "inequality", "page_weekly_edits", "patrol")),
    "H27_defaults": f"SELECT 'gdp' AS page, min(wiki) AS wiki, max(year_month) AS max_month FROM {{gdp}} UNION ALL SELECT 'labor', min(wiki), max(year_month) FROM {{labor_monthly}} UNION ALL SELECT 'business', min(wiki), max(year_month) FROM {{labor_monthly}} UNION ALL SELECT 'inequality', min(wiki), max(year_month) FROM {{inequality}} UNION ALL SELECT 'patrol', min(wiki), max(year_month) FROM {{patrol}}",
    "I1_edit_survival": f"SELECT *, CASE WHEN total_edits > 0 THEN (total_edits - reverted_edits)::DOUBLE / total_edits ELSE 0e0 END AS survival_rate FROM ({SURVIVAL})",
    "I2_equilibrium": f"SELECT *, talk_edits::DOUBLE / content_reverts AS ratio FROM ({EQUILIBRIUM})",
    "I3_bytes_per_editor": f"SELECT year, CASE WHEN unique_editors > 0 THEN net_bytes::DOUBLE / unique_editors ELSE 0e0 END AS bytes_per_editor FROM ({BYTES})",
    "I3_D13_ltv": f"SELECT c.cohort_year AS cohort, any_value(c.initial_editors) AS initial_editors, coalesce(sum(c.survived_editors::DOUBLE / c.initial_editors * b.net_bytes / b.unique_editors), 0e0) AS ltv_bytes FROM {{labor_cohorts}} c LEFT JOIN ({BYTES}) b ON b.year = c.year WHERE c.wiki = '{WIKI}' AND c.initial_editors >= 10 GROUP BY 1",
    "I4_kpis": f"SELECT (SELECT avg(departure_rate) FROM ({BUSINESS_CHURN})) AS churn_rate, (SELECT (sum(total_edits) - sum(reverted_edits))::DOUBLE / sum(total_edits) FROM ({SURVIVAL})) AS survival, (SELECT sum(talk_edits)::DOUBLE / sum(content_reverts) FROM ({EQUILIBRIUM})) AS equilibrium, (SELECT coalesce(sum(editors) FILTER (tier = '100+ edits'), 0)::DOUBLE / sum(editors) FROM ({BUSINESS_TIERS})) AS conversion",
    "I5_funnel_long": " UNION ALL ".join(f"SELECT cohort_year, '{n}+ edits' AS milestone, CASE WHEN cohort_size > 0 THEN reached_{n}::DOUBLE / cohort_size ELSE 0e0 END AS pct, reached_{n} AS editors, cohort_size FROM ({FUNNEL})" for n in (5, 25, 100)),
    "I6_bytes_per_editor_tier": f"SELECT *, net_bytes::DOUBLE / editors AS bytes_per_editor FROM ({BUSINESS_TIERS}) WHERE editors > 0 AND tier IN ('1-4 edits', '5-24 edits', '25-99 edits', '100+ edits')",
    "I7_retention": HEATMAP,
    "I7_cohort_sizes": f"SELECT cohort_year, 'n=' AS year, any_value(initial_editors) AS initial_editors FROM ({HEATMAP}) GROUP BY 1",
    "I8_D12_survival_summary": f"SELECT cohort_year, survived_editors, initial_editors, retention FROM ({HEATMAP}) WHERE year = (SELECT min(year) FROM (SELECT DISTINCT year FROM {{labor_cohorts}} WHERE wiki = '{WIKI}' ORDER BY year DESC LIMIT 2))",
    "I9_churn_long": " UNION ALL ".join(f"SELECT period, '{m}' AS metric, {c} AS rate, active_editors, arrivals, departures, arrival_rate, departure_rate FROM ({MONTH_CHURN})" for m, c in (("Arrival rate", "arrival_rate"), ("Departure rate", "departure_rate"))),
    "I10_D10_type_share": f"SELECT a.period, a.user_type, a.edits, CASE WHEN t.n > 0 THEN a.edits::DOUBLE / t.n ELSE 0e0 END AS share FROM (SELECT year_month AS period, user_type, sum(edits)::BIGINT AS edits FROM {{gdp_user_type_share}} WHERE {MINE} GROUP BY 1, 2) a JOIN (SELECT year_month AS period, sum(edits) AS n FROM {{gdp_user_type_share}} WHERE {MINE} GROUP BY 1) t ON a.period = t.period",
    "I10_tier_share": f"SELECT a.*, CASE WHEN t.n > 0 THEN a.editors::DOUBLE / t.n ELSE 0e0 END AS share FROM ({GDP_TIERS}) a JOIN (SELECT period, sum(editors) AS n FROM ({GDP_TIERS}) GROUP BY 1) t ON a.period = t.period",
    "I11_C16_sector_output": f"SELECT {YEAR} AS period, {label('page_namespace')} AS ns_label, {sums('total_edits edits', 'gross_bytes_added gross_bytes', 'net_bytes')} FROM {{gdp}} WHERE {MINE} AND user_type = 'registered' GROUP BY 1, 2",
    "I12_productivity": f"SELECT *, CASE WHEN total_edits > 0 THEN net_bytes::DOUBLE / total_edits ELSE 0e0 END AS bytes_per_edit FROM ({BY_TYPE})",
    "I12_revert_rate": f"SELECT period, CASE WHEN total_edits > 0 THEN reverted_edits::DOUBLE / total_edits ELSE 0e0 END AS revert_rate FROM ({OUTPUT}) ORDER BY period DESC LIMIT 1",
    "I13_fragility": f"SELECT *, CASE WHEN total_editors > 0 THEN min_editors_50pct::DOUBLE / total_editors * 100 ELSE 0e0 END AS fragility_pct FROM ({INEQUALITY_YEARLY})",
    "I13_patrol_fragility": f"SELECT *, CASE WHEN unique_patrollers > 0 THEN min_patrollers_50pct::DOUBLE / unique_patrollers * 100 ELSE 0e0 END AS fragility_pct FROM ({PATROL_YEARLY})",
    "I14_patrol_kpis": f"SELECT sum(total_patrols)::BIGINT AS total_patrols, max(unique_patrollers) AS most_patrollers, arg_max(median_latency_hours, period) FILTER (median_latency_hours IS NOT NULL) AS latest_latency, arg_max(patrol_coverage_pct, period) AS latest_coverage, arg_max(adjusted_coverage_pct, period) AS latest_adjusted, min(period) AS first_period, max(period) AS last_period FROM ({PATROL_YEARLY})",
    "I14_patrol_stack": f"SELECT period, 'New pages' AS type, patrol_new_pages AS value FROM ({PATROL_YEARLY}) UNION ALL SELECT period, 'Diffs', patrol_diffs FROM ({PATROL_YEARLY})",
    "I15_surge_rank": f"SELECT row_number() OVER (ORDER BY wow_change DESC, edits DESC, page_title, week_start, page_id)::INT AS rank, replace(page_title, '_', ' ') AS label, 'https://test.wikipedia.org/wiki/' || page_title AS url, week_start || ' to ' || (week_start::DATE + 6)::DATE::VARCHAR AS week, {SHORT.format('previous_week_edits')} AS previous, {SHORT.format('edits')} AS edits, CASE WHEN wow_change < 0 THEN '+−' ELSE '+' END || {SHORT.format('wow_change')} AS change, printf('%.2f%%', round(wow_rate * 100, 2)) AS wow FROM ({TOP20})",
    "C13_patrol_months": "SELECT DISTINCT left(event_timestamp, 7) AS year_month FROM {patrol_events}",
    "C14_by_period": f"SELECT {YEAR} AS period, {sums('total_edits')}, avg(revert_rate) AS revert_rate FROM {{gdp}} GROUP BY 1",
    "C15_B32_filtered": f"SELECT {QUARTER} AS period, {sums('total_edits')}, avg(bytes_per_edit) AS bytes_per_edit FROM {{gdp}} WHERE wiki = '{WIKI}' AND user_type IN ('registered', 'bot') AND year_month >= '1996-01' AND year_month <= '1999-12' AND page_namespace IN (0, 2) GROUP BY 1",
    "C18_range": "SELECT wiki, min(year_month) AS mn, max(year_month) AS mx, string_agg(DISTINCT page_namespace::VARCHAR, ',' ORDER BY page_namespace::VARCHAR) AS namespaces FROM {patrol} GROUP BY wiki",
    "C19_gate": "SELECT min(year_month) AS lo, max(year_month) AS hi, sum(total_edits)::BIGINT AS edits, min(wiki) AS wiki_min, max(wiki) AS wiki_max, count(*) AS n FROM {gdp}",
    "D11_survivors_window": "SELECT a.first_year, a.last_year, (SELECT count(*) FROM {registered_editors} b WHERE b.first_year = a.first_year AND b.last_year >= a.last_year) AS survivors FROM (SELECT DISTINCT first_year, last_year FROM {registered_editors}) a",
    "E2_patrolled_semi": "SELECT count(*) AS n FROM {patrol_revisions} WHERE revision_id IN (SELECT current_revision_id FROM {patrol_events})",
    "G5_missing_ids": "SELECT current_revision_id FROM {patrol_events} EXCEPT SELECT revision_id FROM {patrol_revisions}",
    "R9_four_bands": f"SELECT period, CASE WHEN tier IN ('1 edit', '2-4 edits') THEN '1-4 edits' ELSE tier END AS band, sum(editors)::BIGINT AS editors, sum(net_bytes)::BIGINT AS net_bytes FROM ({BUSINESS_TIERS}) GROUP BY 1, 2",
}

DEFINED = {**VIEWS, **METRICS, **SERVING}


def sql(name: str) -> str:
    """The query with all that it reads as CTEs, each once, in order, and doubles to six places."""
    ctes: dict[str, str] = {}

    def visit(of: str) -> str:
        text = DEFINED[of]
        for need in re.findall(r"\{(\w+)\}", text):
            if need not in ctes:
                ctes[need] = visit(need)
        return re.sub(r"\{(\w+)\}", r"\1", text)

    body = visit(name)
    head = "WITH " + ",\n".join(f"{k} AS ({v})" for k, v in ctes.items()) + "\n" if ctes else ""
    doubles = DOUBLES.get(name)
    return f"{head}SELECT * REPLACE ({', '.join(f'round({c}, 6) AS {c}' for c in doubles.split())}) FROM ({body}) q" if doubles else head + body


#: The columns that are doubles.
DOUBLES = {
    "gdp": "bytes_per_edit bytes_per_editor revert_rate",
    "labor_churn": "arrival_rate departure_rate",
    "inequality": "gini theil palma",
    "page_weekly_edits": "wow_rate",
    "patrol": "median_latency_hours p90_latency_hours patrol_coverage_pct adjusted_coverage_pct top1_pct",
    "patrol_latency": "median_latency p90_latency",
    "patrol_event_rows": "latency",
    "H9_labor_churn": "arrival_rate departure_rate",
    "H12_inequality_yearly": "gini theil palma",
    "H14_business_churn": "arrival_rate departure_rate",
    "H22_weekly_top20": "wow_rate",
    "H23_patrol_yearly": "median_latency_hours p90_latency_hours patrol_coverage_pct adjusted_coverage_pct top1_pct",
    "I1_edit_survival": "survival_rate",
    "I2_equilibrium": "ratio",
    "I3_bytes_per_editor": "bytes_per_editor",
    "I3_D13_ltv": "ltv_bytes",
    "I4_kpis": "churn_rate survival equilibrium conversion",
    "I5_funnel_long": "pct",
    "I6_bytes_per_editor_tier": "bytes_per_editor",
    "I7_retention": "retention",
    "I8_D12_survival_summary": "retention",
    "I9_churn_long": "rate arrival_rate departure_rate",
    "I10_D10_type_share": "share",
    "I10_tier_share": "share",
    "I12_productivity": "bytes_per_edit",
    "I12_revert_rate": "revert_rate",
    "I13_fragility": "gini theil palma fragility_pct",
    "I13_patrol_fragility": "median_latency_hours p90_latency_hours patrol_coverage_pct adjusted_coverage_pct top1_pct fragility_pct",
    "I14_patrol_kpis": "latest_latency latest_coverage latest_adjusted",
    "C14_by_period": "revert_rate",
    "C15_B32_filtered": "bytes_per_edit",
}
