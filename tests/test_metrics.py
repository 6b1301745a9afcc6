"""Metrics by hand and by definition, on small frames."""

import math
from collections import Counter

import pytest

from meridia.operators.serving import SERVING, Serving
from meridia.plans import catalog, contracts

REVISION = "event_timestamp string, event_user_id long, user_type string, page_id long, page_title string, page_namespace int, revision_id long, diff long, reverted boolean, minor boolean"


def revisions(spark, rows, **more):
    base = {"user_type": "registered", "page": 3, "title": "Fern", "ns": 0, "diff": 25, "reverted": False}
    made = []
    for k, (ts, user, *given) in enumerate(rows):
        r = base | more | (given[0] if given else {})
        made.append((f"{ts} 06:00:00", user, r["user_type"], r["page"], r["title"], r["ns"], k, r["diff"], r["reverted"], False))
    return spark.createDataFrame(made, REVISION)


def test_labor_by_hand(spark):
    frame = revisions(spark, [("2011-03-02", 4), ("2011-03-09", 4), ("2011-05-01", 4), ("2011-05-30", 6), ("2012-01-01", 6), ("2012-01-02", 9)])
    labor = {r.year_month: (r.unique_editors, r.total_edits) for r in catalog.over(spark, "labor_monthly", revisions=frame).collect()}
    assert labor == {"2011-03": (1, 2), "2011-05": (2, 2), "2012-01": (2, 2)}
    churn = {r.period: (r.active_editors, r.arrivals, r.departures) for r in catalog.over(spark, "labor_churn", revisions=frame).collect()}
    assert churn == {"2011-03": (1, 1, 0), "2011-05": (2, 1, 1), "2012-01": (2, 1, 2), "2011-Q1": (1, 1, 0), "2011-Q2": (2, 1, 1), "2012-Q1": (2, 1, 2), "2011": (2, 2, 1), "2012": (2, 1, 2)}
    cohorts = {(r.cohort_year, r.year): (r.survived_editors, r.initial_editors) for r in catalog.over(spark, "labor_cohorts", revisions=frame).collect()}
    assert cohorts == {("2011", "2011"): (2, 2), ("2011", "2012"): (1, 2), ("2012", "2012"): (1, 1)}
    none = revisions(spark, []).limit(0)
    assert all(catalog.over(spark, m, revisions=none).count() == 0 for m in ("gdp", "labor_churn", "labor_cohorts", "inequality", "page_weekly_edits"))


def test_wiki_is_a_parameter(spark):
    frame = revisions(spark, [("2011-03-02", 4)])
    for metric in set(contracts.CONTRACTS) - {"patrol", "inequality"}:
        assert {r.wiki for r in catalog.over(spark, metric, "o'xwiki", revisions=frame).collect()} == {"o'xwiki"}, metric


def test_serving_by_wiki_and_month(spark):
    """Two wikis in one dataset do not add up, and months beyond the last are left out."""
    a = revisions(spark, [("2011-03-02", 4), ("2011-06-02", 4), ("2012-01-05", 5), ("2011-03-04", 8, {"user_type": "bot"}), ("2011-03-05", 5, {"ns": 1, "reverted": True}), ("2011-03-06", 5, {"ns": 2, "reverted": True})])
    b = revisions(spark, [("2011-03-02", 4)] * 7)
    made = {}

    def metric(name):
        if name not in made:
            made[name] = catalog.over(spark, name, "aawiki", revisions=a).unionByName(catalog.over(spark, name, "bbwiki", revisions=b))
        return made[name]

    edits = lambda s: {r.period: r.total_edits for r in s.output().collect()}
    assert edits(Serving(metric)) == {"2011": 2, "2012": 1} == edits(Serving(metric, "aawiki"))
    assert edits(Serving(metric, "bbwiki")) == {"2011": 7} and edits(Serving(metric, until="2011-05")) == {"2011": 1}
    assert [r.wiki for r in Serving(metric).wikis("gdp").collect()] == ["aawiki", "bbwiki"]
    assert {r.wiki: r.mx for r in Serving(metric, until="2011-12").range("labor").collect()} == {"aawiki": "2011-06", "bbwiki": "2011-03"}
    assert {r.period for r in Serving(metric, until="2011-05").churn().collect()} == {"2011-03"}
    assert [r.period for r in Serving(metric, until="2011-05").business_churn().collect()] == ["2011-Q1", "2011-Q2"]  # the quarter of the last month
    (even,) = Serving(metric, "aawiki").equilibrium().collect()
    assert (even.period, even.talk_edits, even.content_reverts, even.ratio) == ("2011-Q1", 1, 1, 1.0)
    assert Serving(metric, "aawiki").weekly_summary().first()["rows"] == 3  # articles alone
    assert {(r.period, r.ns_label): r.edits for r in Serving(metric, "aawiki").sectors().collect()} == {("2011", "Article"): 2, ("2011", "Talk"): 1, ("2011", "User"): 1, ("2012", "Article"): 1}
    assert Serving(metric, "aawiki").revert_rate().first().period == "2012"


def test_business_churn_to_the_last_quarter(spark):
    """The cut-off is the last quarter of labor_monthly, whatever the year."""
    frame = revisions(spark, [("1999-01-15", 1), ("2000-12-20", 2), ("2001-02-15", 1), ("2024-11-10", 3)])
    got = {r.period: r.active_editors for r in catalog.over(spark, "H14_business_churn", revisions=frame).collect()}
    assert {"1999-Q1", "2000-Q4", "2001-Q1", "2024-Q4"} <= set(got) and got["2024-Q4"] == 1


def test_weeks(spark):
    fern = ["2015-06-01", "2015-06-07", "2015-06-08", "2015-06-22", "2015-06-29", "2015-06-30", "2015-07-01"]  # 1 June was a Monday
    frame = revisions(spark, [*[(d, 1) for d in fern], ("2015-06-09", 1, {"page": 4, "title": "Moss"}), ("2015-06-02", 1, {"page": None, "title": None}), ("2015-06-10", 1, {"page": None, "title": None})])
    rows = catalog.over(spark, "page_weekly_edits", revisions=frame)
    got = {(r.page_id, r.week_start): (r.edits, r.previous_week_edits, r.wow_change, r.wow_rate) for r in rows.collect()}
    assert got == {
        (3, "2015-06-01"): (2, 0, 2, None), (3, "2015-06-08"): (1, 2, -1, -0.5), (3, "2015-06-22"): (1, 0, 1, None), (3, "2015-06-29"): (3, 1, 2, 2.0), (4, "2015-06-08"): (1, 0, 1, None),
        (None, "2015-06-01"): (0, 0, 0, None), (None, "2015-06-08"): (0, 0, 0, None),
    }
    contracts.check_weekly(rows, frame)
    for wrong in (rows.where("page_id = 3"), rows.unionByName(rows)):
        with pytest.raises(ValueError):
            contracts.check_weekly(wrong, frame)


def test_iso_year_at_the_turn(spark):
    (row,) = catalog.over(spark, "page_weekly_edits", revisions=revisions(spark, [("2021-01-02", 1)])).collect()
    assert (row.week_start, row.iso_year, row.iso_week) == ("2020-12-28", 2020, 53)


def test_null_users_are_one_editor(spark):
    frame = revisions(spark, [("2011-03-15", None), ("2011-03-16", None), ("2011-03-20", 2)])
    (row,) = catalog.over(spark, "gdp", revisions=frame).collect()
    assert (row.unique_editors, row.total_edits, row.gross_bytes_added, row.bytes_per_editor) == (2, 3, 75, 37.5)
    assert catalog.over(spark, "business_funnel", revisions=frame).first().cohort_size == 1


def direct(values):
    """Gini, Theil, Palma and fragility of a list, from their definitions."""
    v = sorted(values)
    n, s = len(v), sum(v)
    gini = 2 * sum((i + 1) * x for i, x in enumerate(v)) / (n * s) - (n + 1) / n
    theil = sum(x * n / s * math.log(x * n / s) for x in v if x) / n
    low, top = sum(v[: int(n * 0.4)]), sum(v[n - int(n * 0.1) :])
    palma = 0.0 if n < 10 else top / low if low else math.inf
    run, k = 0, 0
    for k, x in enumerate(reversed(v), 1):
        run += x
        if 2 * run >= s:
            break
    return gini, theil, palma, k


@pytest.mark.parametrize("values", [[1, 1, 3], [1] * 10, [1, 2], [5] * 9 + [1, 7, 30], [3, 3, 3, 1, 1, 8, 8, 2, 2, 2, 2], [0] * 4 + [1] * 6])
def test_inequality_by_definition(spark, values):
    counts = spark.createDataFrame([("2011-03", "registered", u, e, 0, 0) for u, e in enumerate(values)], "year_month string, user_type string, event_user_id long, edits long, net_bytes long, gross_bytes long")
    (row,) = catalog.over(spark, "inequality", editor_months=counts).collect()
    assert (row.gini, row.theil, row.palma, row.min_editors_50pct) == pytest.approx(direct(values), abs=1e-12)
    assert row.total_editors == len(values)


def patrol(spark, events, revised, rights=(), groups=("keeper",)):
    frames = {
        "patrol_events": spark.createDataFrame([(k, f"{ts} 00:00:00", who, rev, prev) for k, (ts, who, rev, prev) in enumerate(events)], "log_id long, event_timestamp string, patroller string, current_revision_id long, prev_revision_id long"),
        "patrol_revisions": spark.createDataFrame([(rev, f"{ts} 00:00:00", who, ns, kind) for rev, ts, who, ns, kind in revised], "revision_id long, event_timestamp string, event_user_text string, page_namespace int, user_type string"),
        "rights_events": spark.createDataFrame([(f"{ts} 00:00:00", *r) for ts, *r in rights], "event_timestamp string, target_user string, old_groups string, new_groups string"),
    }
    return {(r.year_month, r.page_namespace, r.user_type): r for r in catalog.over(spark, "patrol", "xxwiki", groups, **frames).collect()}


def test_patrol_by_definition(spark):
    """Patrols without a patroller count in the whole; a revision that stands twice does not multiply an event."""
    events = [("2018-04-10", "a", 1, 0)] * 3 + [("2018-04-11", "b", 1, 7)] * 2 + [("2018-04-12", None, 999, None)] * 5
    got = patrol(spark, events, [(1, "2018-04-09", "x", 0, "registered"), (1, "2018-04-09", "x", 0, "registered"), (2, "2018-04-09", "x", None, "bot")])
    row = got["2018-04", 0, "registered"]
    assert (row.total_patrols, row.unique_patrollers, row.patrol_new_pages, row.patrol_diffs, row.min_patrollers_50pct, row.top1_pct) == (10, 2, 8, 2, 2, 30.0)
    assert (row.median_latency_hours, row.p90_latency_hours, row.total_revisions, row.patrolled_revisions, row.patrol_coverage_pct) == (24.0, 48.0, 2, 2, 100.0)
    assert (got["2018-04", 0, "bot"].total_revisions, got["2018-04", 0, "bot"].total_patrols, got["2018-04", 0, "bot"].median_latency_hours) == (1, 0, None)


def test_patrol_statistics_of_many(spark):
    import random

    rng = random.Random(5)
    revised = [(k, f"2018-04-{rng.randint(1, 9):02d}", "x", 0, "registered") for k in range(40)]
    events = [(f"2018-04-{rng.randint(5, 28):02d}", rng.choice("aabbbccdefg"), rng.randrange(44), 1) for _ in range(300)]
    row = patrol(spark, events, revised)["2018-04", 0, "registered"]
    day = {k: int(ts[-2:]) for k, ts, *_ in revised}
    late = sorted(24.0 * (int(ts[-2:]) - day[rev]) for ts, _, rev, _ in events if rev in day and int(ts[-2:]) > day[rev])
    assert row.median_latency_hours == late[(len(late) - 1) // 2] and row.p90_latency_hours == late[min(int(0.9 * len(late)), len(late) - 1)]
    counts = sorted(Counter(who for _, who, _, _ in events).values(), reverse=True)
    assert row.min_patrollers_50pct == next(k for k in range(1, 9) if 2 * sum(counts[:k]) >= 300) and row.top1_pct == round(counts[0] / 3, 1)


def test_autopatrol_intervals(spark):
    """A group is held by its whole name; the right is lost at the moment it is taken."""
    rights = [("2018-04-02", "kim", "", "keeper, x"), ("2018-04-20", "kim", "keeper", "x"), ("2018-04-03", "lee", "", "keeper-aide"), ("2018-04-04", "kim", "keeper", "keeper,y"), ("2018-04-21", "kim", "", "keeper")]
    revised = [(1, "2018-04-01", "kim", 0, "registered"), (2, "2018-04-02", "kim", 0, "registered"), (3, "2018-04-19", "kim", 0, "registered"), (4, "2018-04-20", "kim", 0, "registered"), (5, "2018-04-25", "kim", 0, "registered"), (6, "2018-04-10", "lee", 0, "registered"), (7, "2018-05-10", "kim", 0, "registered")]
    events = [("2018-04-26", "a", 5, 1)]
    row = patrol(spark, events, revised, rights)["2018-04", 0, "registered"]
    assert (row.total_revisions, row.patrolled_revisions, row.autopatrolled_revisions, row.adjusted_coverage_pct) == (6, 1, 2, 50.0)  # May is not in the log
    assert patrol(spark, events, revised, rights, ())["2018-04", 0, "registered"].autopatrolled_revisions == 0


def test_schemas_and_conservation(spark):
    gdp = catalog.relation(spark, "/root/testdata/sf0.001", "gdp")
    for name in contracts.CONTRACTS:
        contracts.check_schema(name, catalog.relation(spark, "/root/testdata/sf0.001", name))
    contracts.check_conservation("gdp", gdp.unionByName(gdp), [gdp, gdp], "total_edits")
    contracts.check_wiki("gdp", gdp, "testwiki", 10)
    assert contracts.check_dates("gdp", gdp)[0] == "1995-01"
    with pytest.raises(ValueError):
        contracts.check_conservation("gdp", gdp, [gdp, gdp], "total_edits")
    with pytest.raises(ValueError):
        contracts.check_schema("gdp", gdp.drop("wiki"))


def test_every_serving_query_has_an_oracle():
    assert set(SERVING) <= set(catalog.ORACLES) and set(catalog.QUERIES) == set(catalog.ORACLES)
