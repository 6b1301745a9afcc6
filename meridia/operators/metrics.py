"""The ten metric datasets, as SQL over the input relations. Names in braces are relations that a plan reads.

Counting follows one rule throughout: a null user is one distinct value, sums of nothing are zero, counts of a column
skip nulls, and flags keep three states. ``:wiki`` is the wiki's name as a literal, ``:groups`` the groups that hold the
right to patrol their own edits. Order statistics come from counts of equal values, so that no window sees a row for
each editor, patroller or event.
"""

GDP = """
SELECT year_month, page_namespace, user_type, gross_bytes_added, net_bytes, total_edits, productive_edits, reverted_edits, unique_editors, minor_edits,
  CAST(net_bytes AS DOUBLE) / nullif(total_edits, 0) AS bytes_per_edit, CAST(net_bytes AS DOUBLE) / nullif(unique_editors, 0) AS bytes_per_editor,
  CAST(reverted_edits AS DOUBLE) / nullif(total_edits, 0) AS revert_rate, :wiki AS wiki
FROM (SELECT substr(event_timestamp, 1, 7) AS year_month, page_namespace, user_type,
    CAST(coalesce(sum(CASE WHEN diff > 0 THEN diff END), 0) AS BIGINT) AS gross_bytes_added, CAST(coalesce(sum(diff), 0) AS BIGINT) AS net_bytes,
    count(revision_id) AS total_edits, count(CASE WHEN NOT reverted THEN 1 END) AS productive_edits, count(CASE WHEN reverted THEN 1 END) AS reverted_edits,
    count(DISTINCT event_user_id) + max(CASE WHEN event_user_id IS NULL THEN 1 ELSE 0 END) AS unique_editors, count(CASE WHEN minor THEN 1 END) AS minor_edits
  FROM {revisions} GROUP BY substr(event_timestamp, 1, 7), page_namespace, user_type) g"""

USER_TYPE_SHARE = """
SELECT substr(event_timestamp, 1, 7) AS year_month, user_type, count(revision_id) AS edits, CAST(coalesce(sum(diff), 0) AS BIGINT) AS net_bytes,
  count(DISTINCT event_user_id) + max(CASE WHEN event_user_id IS NULL THEN 1 ELSE 0 END) AS editors, :wiki AS wiki
FROM {revisions} GROUP BY substr(event_timestamp, 1, 7), user_type"""

#: Edits of an editor in a month; feeds tiers and inequality.
EDITOR_MONTHS = """
SELECT substr(event_timestamp, 1, 7) AS year_month, user_type, event_user_id, count(revision_id) AS edits,
  CAST(coalesce(sum(diff), 0) AS BIGINT) AS net_bytes, CAST(coalesce(sum(CASE WHEN diff > 0 THEN diff END), 0) AS BIGINT) AS gross_bytes
FROM {revisions} GROUP BY substr(event_timestamp, 1, 7), user_type, event_user_id"""

ACTIVITY_TIERS = """
SELECT year_month, user_type, CASE WHEN edits = 1 THEN '1 edit' WHEN edits < 5 THEN '2-4 edits' WHEN edits < 25 THEN '5-24 edits'
    WHEN edits < 100 THEN '25-99 edits' ELSE '100+ edits' END AS activity_tier,
  count(event_user_id) AS editors, CAST(sum(edits) AS BIGINT) AS total_edits, CAST(sum(net_bytes) AS BIGINT) AS net_bytes, CAST(sum(gross_bytes) AS BIGINT) AS gross_bytes, :wiki AS wiki
FROM {editor_months} GROUP BY 1, 2, 3"""

REGISTERED_EDITORS = """
SELECT event_user_id, count(revision_id) AS edits, min(CAST(substr(event_timestamp, 1, 4) AS INT)) AS first_year, max(CAST(substr(event_timestamp, 1, 4) AS INT)) AS last_year
FROM {revisions} WHERE user_type = 'registered' AND event_user_id IS NOT NULL GROUP BY event_user_id"""

BUSINESS_FUNNEL = """
SELECT CAST(first_year AS STRING) AS cohort_year, count(*) AS cohort_size, count(CASE WHEN edits >= 5 THEN 1 END) AS reached_5,
  count(CASE WHEN edits >= 25 THEN 1 END) AS reached_25, count(CASE WHEN edits >= 100 THEN 1 END) AS reached_100, :wiki AS wiki
FROM {registered_editors} GROUP BY first_year"""

LABOR_MONTHLY = """
SELECT substr(event_timestamp, 1, 7) AS year_month, page_namespace, user_type,
  count(DISTINCT event_user_id) + max(CASE WHEN event_user_id IS NULL THEN 1 ELSE 0 END) AS unique_editors, count(revision_id) AS total_edits,
  CAST(coalesce(sum(diff), 0) AS BIGINT) AS net_bytes, count(CASE WHEN reverted THEN 1 END) AS reverted_edits, :wiki AS wiki
FROM {revisions} GROUP BY substr(event_timestamp, 1, 7), page_namespace, user_type"""

#: A row per (first, last) year: at most a square of the years, whatever the number of editors.
EDITOR_SPANS = "SELECT first_year, last_year, count(*) AS n FROM {registered_editors} GROUP BY first_year, last_year"

#: Years are those in which some editor began or ended; a row stands for each of them from the cohort's on. A cohort's spans are a list of at most as many entries as there are years.
LABOR_COHORTS = """
SELECT CAST(first_year AS STRING) AS cohort_year, CAST(year AS STRING) AS year, CAST(aggregate(filter(spans, s -> s.last_year >= year), 0L, (a, s) -> a + s.n) AS BIGINT) AS survived_editors,
  CAST(aggregate(spans, 0L, (a, s) -> a + s.n) AS BIGINT) AS initial_editors, :wiki AS wiki
FROM (SELECT first_year, spans, explode(filter(years, y -> y >= first_year)) AS year
  FROM (SELECT first_year, spans, array_distinct(flatten(collect_list(array_append(transform(spans, s -> s.last_year), first_year)) OVER ())) AS years
    FROM (SELECT first_year, collect_list(struct(last_year, n)) AS spans FROM {editor_spans} GROUP BY first_year) c) y) e"""

#: Each registered editor's active months, once; quarters and years come from them.
EDITOR_ACTIVE_MONTHS = """
SELECT event_user_id, substr(event_timestamp, 1, 7) AS month FROM {revisions}
WHERE user_type = 'registered' AND event_user_id IS NOT NULL GROUP BY event_user_id, substr(event_timestamp, 1, 7)"""

#: Arrivals and departures are an editor's first and last periods. Months are distinct when they are made three periods of.
LABOR_CHURN = """
SELECT period, period_type, active_editors, arrivals, departures, CAST(arrivals AS DOUBLE) / active_editors AS arrival_rate, CAST(departures AS DOUBLE) / active_editors AS departure_rate, :wiki AS wiki
FROM (SELECT p.period, p.period_type, count(*) AS active_editors, count(CASE WHEN p.period = p.first_period THEN 1 END) AS arrivals, count(CASE WHEN p.period = p.last_period THEN 1 END) AS departures
  FROM (SELECT x.at.period AS period, x.at.period_type AS period_type, x.at.first_period AS first_period, x.at.last_period AS last_period
    FROM (SELECT explode(concat(
        transform(months, m -> named_struct('period_type', 'month', 'period', m, 'first_period', array_min(months), 'last_period', array_max(months))),
        transform(quarters, q -> named_struct('period_type', 'quarter', 'period', q, 'first_period', array_min(quarters), 'last_period', array_max(quarters))),
        transform(years, y -> named_struct('period_type', 'year', 'period', y, 'first_period', array_min(years), 'last_period', array_max(years))))) AS at
      FROM (SELECT months, array_distinct(transform(months, m -> concat(substr(m, 1, 4), '-Q', CAST(CAST(ceil(CAST(substr(m, 6, 2) AS INT) / 3.0) AS INT) AS STRING)))) AS quarters, array_distinct(transform(months, m -> substr(m, 1, 4))) AS years
        FROM (SELECT event_user_id, collect_list(month) AS months FROM {editor_active_months} GROUP BY event_user_id) e) q) x) p
  GROUP BY p.period, p.period_type) t"""

EDIT_COUNTS = """
SELECT year_month, user_type, edits AS v, count(*) AS c FROM {editor_months} WHERE year_month IS NOT NULL AND user_type IS NOT NULL GROUP BY year_month, user_type, edits"""

INEQUALITY = """
SELECT year_month, user_type, gini, theil, palma, min_editors_50pct, total_editors, total_edits, :wiki AS wiki FROM (
SELECT year_month, user_type, max(n) AS total_editors, max(s) AS total_edits,
  CASE WHEN max(s) = 0 THEN 0e0 ELSE 2e0 * sum(v * (c * before + c * (c + 1) / 2e0)) / (max(n) * CAST(max(s) AS DOUBLE)) - (max(n) + 1e0) / max(n) END AS gini,
  CASE WHEN max(s) = 0 THEN 0e0 ELSE sum(CASE WHEN v > 0 THEN c * (v * CAST(n AS DOUBLE) / s) * ln(v * CAST(n AS DOUBLE) / s) ELSE 0e0 END) / max(n) END AS theil,
  CASE WHEN max(n) < 10 OR max(s) = 0 THEN 0e0
    WHEN sum(v * greatest(least(before + c, CAST(floor(n * 0.4e0) AS BIGINT)) - before, 0)) = 0 THEN CAST('Infinity' AS DOUBLE)
    ELSE sum(v * greatest(least(n - before, CAST(floor(n * 0.1e0) AS BIGINT)) - (n - before - c), 0)) / nullif(CAST(sum(v * greatest(least(before + c, CAST(floor(n * 0.4e0) AS BIGINT)) - before, 0)) AS DOUBLE), 0) END AS palma,
  CASE WHEN max(s) = 0 THEN 0 ELSE CAST(min(CASE WHEN 2 * (above + v * c) >= s AND v > 0 THEN (n - before - c) + greatest(CAST(ceil((s / 2e0 - above) / v) AS BIGINT), 1) END) AS BIGINT) END AS min_editors_50pct
FROM (SELECT year_month, user_type, v, c, CAST(sum(c) OVER (PARTITION BY year_month, user_type) AS BIGINT) AS n, CAST(sum(v * c) OVER (PARTITION BY year_month, user_type) AS BIGINT) AS s,
    CAST(sum(c) OVER (PARTITION BY year_month, user_type ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - c AS before,
    CAST(sum(v * c) OVER (PARTITION BY year_month, user_type ORDER BY v DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) - v * c AS above
  FROM {edit_counts}) w GROUP BY year_month, user_type HAVING max(n) >= 2) i"""

PAGE_WEEKLY_EDITS = """
SELECT CAST(CAST(week AS DATE) AS STRING) AS week_start, CAST(extract(YEAR FROM week + INTERVAL 3 DAYS) AS INT) AS iso_year, CAST(extract(WEEK FROM week) AS INT) AS iso_week, page_id, page_title, page_namespace, edits,
  previous_week_edits, edits - previous_week_edits AS wow_change, CAST(edits - previous_week_edits AS DOUBLE) / nullif(previous_week_edits, 0) AS wow_rate, :wiki AS wiki
FROM (SELECT week, page_id, page_title, page_namespace, edits,
    CASE WHEN lag(week) OVER (PARTITION BY page_id, page_namespace, page_title ORDER BY week) = week - INTERVAL 7 DAYS
      THEN lag(edits) OVER (PARTITION BY page_id, page_namespace, page_title ORDER BY week) ELSE 0 END AS previous_week_edits
  FROM (SELECT date_trunc('week', CAST(substr(event_timestamp, 1, 10) AS DATE)) AS week, page_id, page_title, page_namespace, count(page_id) AS edits
    FROM {revisions} GROUP BY 1, 2, 3, 4) w) p"""

#: A user's changes of the right; of several at one moment, having it wins.
TRANSITIONS = """
SELECT target_user, start_ts, lead(start_ts) OVER (PARTITION BY target_user ORDER BY start_ts) AS next_ts, has
FROM (SELECT target_user, start_ts, has, lag(has) OVER (PARTITION BY target_user ORDER BY start_ts) AS had
  FROM (SELECT target_user, event_timestamp AS start_ts, max(CASE WHEN arrays_overlap(transform(split(new_groups, ','), g -> trim(g)), :groups) THEN 1 ELSE 0 END) AS has
    FROM {rights_events}
    WHERE target_user IS NOT NULL AND try_to_timestamp(event_timestamp) IS NOT NULL
      AND coalesce(arrays_overlap(transform(split(new_groups, ','), g -> trim(g)), :groups), FALSE) <> coalesce(arrays_overlap(transform(split(old_groups, ','), g -> trim(g)), :groups), FALSE)
    GROUP BY target_user, event_timestamp) t) x
WHERE had IS NULL OR had <> has"""

INTERVALS = "SELECT target_user, start_ts, next_ts AS end_ts FROM {transitions} WHERE has = 1"

PATROL_MONTHS = "SELECT DISTINCT substr(event_timestamp, 1, 7) AS year_month FROM {patrol_events}"

#: Revisions of the months of the patrol log. A patrolled one is not looked up among the intervals.
PATROL_REVISION_COUNTS = """
SELECT year_month, page_namespace, user_type, count(*) AS total_revisions, count(CASE WHEN patrolled THEN 1 END) AS patrolled_revisions, count(CASE WHEN NOT patrolled AND auto THEN 1 END) AS autopatrolled_revisions
FROM (SELECT r.year_month, coalesce(r.page_namespace, 0) AS page_namespace, r.user_type, r.patrolled,
    EXISTS (SELECT 1 FROM {intervals} i WHERE r.unpatrolled_user = i.target_user AND r.event_timestamp >= i.start_ts AND (i.end_ts IS NULL OR r.event_timestamp < i.end_ts)) AS auto
  FROM (SELECT substr(r.event_timestamp, 1, 7) AS year_month, r.page_namespace, r.user_type, r.event_timestamp, i.current_revision_id IS NOT NULL AS patrolled, CASE WHEN i.current_revision_id IS NULL THEN r.event_user_text END AS unpatrolled_user
    FROM {patrol_revisions} r JOIN {patrol_months} m ON substr(r.event_timestamp, 1, 7) = m.year_month
    LEFT JOIN (SELECT DISTINCT current_revision_id FROM {patrol_events}) i ON r.revision_id = i.current_revision_id
    WHERE r.revision_id IS NOT NULL) r) f
GROUP BY year_month, page_namespace, user_type"""

#: An event with its revision: one join gives latency, namespace and type. A revision that stands twice counts once, the latest.
PATROL_EVENT_ROWS = """
SELECT substr(e.event_timestamp, 1, 7) AS year_month, coalesce(r.page_namespace, 0) AS page_namespace, coalesce(r.user_type, 'registered') AS user_type, e.log_id, e.patroller, coalesce(e.prev_revision_id, 0) AS prev_revision_id,
  CASE WHEN r.event_timestamp < e.event_timestamp AND unix_timestamp(try_to_timestamp(e.event_timestamp)) - unix_timestamp(try_to_timestamp(r.event_timestamp)) <= 8760 * 3600
    THEN (unix_timestamp(try_to_timestamp(e.event_timestamp)) - unix_timestamp(try_to_timestamp(r.event_timestamp))) / 3600e0 END AS latency
FROM {patrol_events} e LEFT JOIN (SELECT revision_id, max(event_timestamp) AS event_timestamp, max_by(page_namespace, event_timestamp) AS page_namespace, max_by(user_type, event_timestamp) AS user_type
  FROM {patrol_revisions} WHERE revision_id IS NOT NULL GROUP BY revision_id) r ON e.current_revision_id = r.revision_id"""

#: Events twice, by patroller and by latency, so that one join and one aggregate serve all order statistics.
PATROL_VALUES = """
SELECT year_month, page_namespace, user_type, x.kind, x.patroller, x.latency, count(*) AS n, count(CASE WHEN prev_revision_id = 0 THEN 1 END) AS new_pages
FROM (SELECT year_month, page_namespace, user_type, prev_revision_id, explode(array(named_struct('kind', 0, 'patroller', patroller, 'latency', CAST(NULL AS DOUBLE)), named_struct('kind', 1, 'patroller', CAST(NULL AS STRING), 'latency', latency))) AS x FROM {patrol_event_rows}) e
WHERE x.kind = 0 OR x.latency IS NOT NULL GROUP BY year_month, page_namespace, user_type, x.kind, x.patroller, x.latency"""

#: By kind and value (a patroller's events, or a latency): how many events and patrollers stand there. Null: events without a patroller.
PATROL_ORDERED = """
SELECT year_month, page_namespace, user_type, kind, v, CAST(sum(n) AS BIGINT) AS events, count(patroller) AS patrollers, CAST(sum(new_pages) AS BIGINT) AS new_pages
FROM (SELECT year_month, page_namespace, user_type, kind, CASE WHEN kind = 1 THEN latency WHEN patroller IS NOT NULL THEN CAST(n AS DOUBLE) END AS v, patroller, n, new_pages FROM {patrol_values}) x
GROUP BY year_month, page_namespace, user_type, kind, v"""

#: Patrollers from the busiest on, latencies from the least on. Half of all patrols: those without a patroller count, and if the rest never reach it, all patrollers do.
PATROL_EVENT_STATS = """
SELECT year_month, page_namespace, user_type, CAST(sum(CASE WHEN kind = 0 THEN events END) AS BIGINT) AS total_patrols, CAST(sum(CASE WHEN kind = 0 THEN patrollers END) AS BIGINT) AS unique_patrollers,
  CAST(sum(CASE WHEN kind = 0 THEN new_pages END) AS BIGINT) AS patrol_new_pages, CAST(sum(CASE WHEN kind = 0 THEN events - new_pages END) AS BIGINT) AS patrol_diffs,
  max(CASE WHEN kind = 1 AND before <= CAST(floor((total - 1) / 2e0) AS BIGINT) THEN v END) AS median_latency, max(CASE WHEN kind = 1 AND before <= least(CAST(floor(total * 0.9e0) AS BIGINT), total - 1) THEN v END) AS p90_latency,
  CAST(coalesce(max(CASE WHEN kind = 0 THEN v END), 0) AS BIGINT) AS top1,
  CAST(coalesce(min(CASE WHEN kind = 0 AND v IS NOT NULL AND 2 * (before + events) >= total THEN patrollers_before + greatest(CAST(ceil((total / 2e0 - before) / v) AS BIGINT), 1) END), sum(CASE WHEN kind = 0 THEN patrollers END)) AS BIGINT) AS min50
FROM (SELECT year_month, page_namespace, user_type, kind, v, events, patrollers, new_pages, sum(events) OVER (PARTITION BY year_month, page_namespace, user_type, kind) AS total,
    coalesce(sum(events) OVER (PARTITION BY year_month, page_namespace, user_type, kind ORDER BY v IS NULL, CASE WHEN kind = 0 THEN -v ELSE v END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
    coalesce(sum(patrollers) OVER (PARTITION BY year_month, page_namespace, user_type, kind ORDER BY v IS NULL, CASE WHEN kind = 0 THEN -v ELSE v END ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS patrollers_before
  FROM {patrol_ordered}) o
GROUP BY year_month, page_namespace, user_type"""

PATROL_EVENT_COUNTS = "SELECT year_month, page_namespace, user_type, total_patrols, unique_patrollers, patrol_new_pages, patrol_diffs FROM {patrol_event_stats}"
PATROL_LATENCY = "SELECT year_month, page_namespace, user_type, median_latency, p90_latency FROM {patrol_event_stats} WHERE median_latency IS NOT NULL"
PATROL_CONCENTRATION = "SELECT year_month, page_namespace, user_type, top1, min50 FROM {patrol_event_stats}"

#: Both halves under one another and one aggregate on the key, in place of a join.
PATROL = """
SELECT year_month, :wiki AS wiki, page_namespace, user_type, total_patrols, unique_patrollers, patrol_new_pages, patrol_diffs, median_latency_hours, p90_latency_hours, patrolled_revisions, autopatrolled_revisions, total_revisions,
  CASE WHEN total_revisions = 0 THEN 0e0 ELSE round(1000e0 * patrolled_revisions / total_revisions, 0) / 10 END AS patrol_coverage_pct,
  CASE WHEN total_revisions = 0 THEN 0e0 ELSE round(1000e0 * (patrolled_revisions + autopatrolled_revisions) / total_revisions, 0) / 10 END AS adjusted_coverage_pct,
  CASE WHEN total_patrols = 0 THEN 0e0 ELSE round(1000e0 * top1 / total_patrols, 0) / 10 END AS top1_pct, min_patrollers_50pct
FROM (SELECT year_month, page_namespace, user_type, CAST(coalesce(sum(total_patrols), 0) AS BIGINT) AS total_patrols, CAST(coalesce(sum(unique_patrollers), 0) AS INT) AS unique_patrollers, CAST(coalesce(sum(patrol_new_pages), 0) AS BIGINT) AS patrol_new_pages, CAST(coalesce(sum(patrol_diffs), 0) AS BIGINT) AS patrol_diffs,
    round(max(median_latency) * 10, 0) / 10 AS median_latency_hours, round(max(p90_latency) * 10, 0) / 10 AS p90_latency_hours, CAST(coalesce(sum(patrolled_revisions), 0) AS BIGINT) AS patrolled_revisions, CAST(coalesce(sum(autopatrolled_revisions), 0) AS BIGINT) AS autopatrolled_revisions,
    CAST(coalesce(sum(total_revisions), 0) AS BIGINT) AS total_revisions, coalesce(sum(top1), 0) AS top1, CAST(coalesce(sum(min50), 0) AS INT) AS min_patrollers_50pct
  FROM (SELECT *, NULL AS patrolled_revisions, NULL AS autopatrolled_revisions, NULL AS total_revisions FROM {patrol_event_stats}
    UNION ALL SELECT year_month, page_namespace, user_type, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, patrolled_revisions, autopatrolled_revisions, total_revisions FROM {patrol_revision_counts}) u
  GROUP BY year_month, page_namespace, user_type) p"""

#: name of the relation -> its SQL
RELATIONS = {
    "gdp": GDP, "gdp_user_type_share": USER_TYPE_SHARE, "editor_months": EDITOR_MONTHS, "gdp_activity_tiers": ACTIVITY_TIERS, "registered_editors": REGISTERED_EDITORS, "editor_spans": EDITOR_SPANS,
    "business_funnel": BUSINESS_FUNNEL, "labor_monthly": LABOR_MONTHLY, "labor_cohorts": LABOR_COHORTS, "editor_active_months": EDITOR_ACTIVE_MONTHS, "labor_churn": LABOR_CHURN, "edit_counts": EDIT_COUNTS, "inequality": INEQUALITY,
    "page_weekly_edits": PAGE_WEEKLY_EDITS, "transitions": TRANSITIONS, "intervals": INTERVALS, "patrol_months": PATROL_MONTHS, "patrol_revision_counts": PATROL_REVISION_COUNTS,
    "patrol_event_rows": PATROL_EVENT_ROWS, "patrol_values": PATROL_VALUES, "patrol_ordered": PATROL_ORDERED, "patrol_event_stats": PATROL_EVENT_STATS, "patrol_event_counts": PATROL_EVENT_COUNTS, "patrol_latency": PATROL_LATENCY, "patrol_concentration": PATROL_CONCENTRATION, "patrol": PATROL,
}

#: In what order a dataset is written; nulls first.
ORDER = {
    "gdp": ("year_month", "page_namespace", "user_type"), "labor_monthly": ("year_month", "page_namespace", "user_type"), "gdp_user_type_share": ("year_month", "user_type"), "inequality": ("year_month", "user_type"),
    "gdp_activity_tiers": ("year_month", "user_type", "activity_tier"), "business_funnel": ("cohort_year",), "labor_cohorts": ("cohort_year", "year"), "labor_churn": ("period_type", "period"),
    "page_weekly_edits": ("page_id", "page_namespace", "page_title", "week_start"), "patrol": ("year_month", "page_namespace", "user_type"),
}
