"""From dumps to merged datasets, and what guards them."""

import gzip
import json

import pytest

from meridia import cli
from meridia.plans import contracts, jobs
from meridia.plans.store import Store
from tests.test_sources import dump, edit, items


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, str(tmp_path / "data"), str(tmp_path / "out"))


def registry(least=1, **wikis):
    some = {n: {"coverage": "all_published", "minimum_rows_per_wiki": least} for n in ("gdp", "labor_monthly", "page_weekly_edits")}
    return {"wikis": wikis, "publication_contract": {"datasets": some}}


SOME = ("gdp", "labor_monthly", "page_weekly_edits", "labor_churn")


def test_dumps_to_merged_datasets(store, tmp_path):
    """Two wikis, one of them with patrols: integers by hand all the way."""
    first = [edit(1, "2021-08-30 10:00:00.0", 1), edit(2, "2021-08-31 10:00:00.0", 2, event_user_text="Kim"), edit(3, "2021-09-06 10:00:00.0", 1, page_id=6, page_title="Reed")]
    jobs.ingest(store, "aawiki", "2021-09", [dump(tmp_path / "a.bz2", first), dump(tmp_path / "b.bz2", [edit(4, "2021-09-01 10:00:00.0", 2, event_user_text="Kim")])])
    jobs.ingest(store, "bbwiki", "2021-09", [dump(tmp_path / "c.bz2", [edit(1, "2021-09-02 10:00:00.0", 9)])])
    assert not jobs.ingest(store, "bbwiki", "2021-09", [str(tmp_path / "c.bz2")])  # stands already
    for wiki in ("aawiki", "bbwiki"):
        assert jobs.compute(store, wiki, SOME) and not jobs.compute(store, wiki, SOME)
    read = lambda n: store.spark.read.parquet(f"{store.out}/{n}").collect()
    assert jobs.merge(store)["gdp"] == ["aawiki", "bbwiki"]
    assert {(r.wiki, r.year_month): (r.total_edits, r.unique_editors, r.net_bytes) for r in read("gdp")} == {("aawiki", "2021-08"): (2, 2, 80), ("aawiki", "2021-09"): (2, 2, 80), ("bbwiki", "2021-09"): (1, 1, 40)}
    assert {(r.wiki, r.week_start, r.page_id): (r.edits, r.previous_week_edits) for r in read("page_weekly_edits")} == {("aawiki", "2021-08-30", 5): (3, 0), ("aawiki", "2021-09-06", 6): (1, 0), ("bbwiki", "2021-08-30", 5): (1, 0)}
    assert {(r.wiki, r.period): (r.arrivals, r.departures) for r in read("labor_churn") if r.period_type == "month"} == {("aawiki", "2021-08"): (2, 0), ("aawiki", "2021-09"): (0, 2), ("bbwiki", "2021-09"): (1, 1)}

    both = {"aawiki": {"publication": "published", "refresh": "scheduled"}, "bbwiki": {"publication": "published", "refresh": "paused", "imported_cutoff": "2021-09"}}
    assert jobs.validate(store, registry(**both))["reports"]["gdp"] == {"rows": 3, "wikis": ["aawiki", "bbwiki"]}
    jobs.verify(store)
    assert {w: v["status"] for w, v in jobs.manifest(store, registry(**both))["wikis"].items()} == {"aawiki": "complete", "bbwiki": "complete"}
    assert jobs.manifest(store, registry(**both, ccwiki={"publication": "published", "refresh": "scheduled"}))["wikis"]["ccwiki"]["status"] == "needs_fetch"
    for wrong in (registry(2, **both), registry(**{"aawiki": both["aawiki"]}), registry(**both | {"bbwiki": both["bbwiki"] | {"imported_cutoff": "2021-08"}})):
        with pytest.raises(ValueError):
            jobs.validate(store, wrong)
    assert jobs.merge(store, ["aawiki"])["gdp"] == ["aawiki"] and {r.wiki for r in read("gdp")} == {"aawiki"}
    with pytest.raises(ValueError):
        jobs.verify(store)  # not what the gate saw

    log = items((10, "2021-09-01T12:00:00Z", "Pat", "patrol", "Moss", "4\n0\n0"), (11, "2021-08-31T12:00:00Z", "Pat", "patrol", "Moss", "1\n0\n0"), (12, "2021-08-01T00:00:00Z", "Sys", "rights", "User:Kim", "\nkeeper"))
    (tmp_path / "log.xml.gz").write_bytes(gzip.compress(log.encode()))
    (tmp_path / "site.json").write_text(json.dumps({"query": {"usergroups": [{"name": "keeper", "rights": ["autopatrol"]}]}}))
    assert jobs.patrol_ingest(store, "aawiki", str(tmp_path / "log.xml.gz"), str(tmp_path / "site.json")) == {"items": 3, "used": 3}
    assert jobs.patrol_compute(store, "aawiki", limit_months=1) == ["2021-08"] and jobs.patrol_compute(store, "aawiki") == ["2021-09"] and jobs.patrol_compute(store, "aawiki") == []
    by_parts = {(r.year_month, r.total_revisions, r.patrolled_revisions, r.autopatrolled_revisions, r.median_latency_hours) for r in read("aawiki/patrol")}
    assert by_parts == {("2021-08", 2, 1, 1, 26.0), ("2021-09", 2, 1, 0, 2.0)}
    assert jobs.patrol_compute(store, "aawiki", rebuild=True) == ["2021-08", "2021-09"]
    assert {(r.year_month, r.total_revisions, r.patrolled_revisions, r.autopatrolled_revisions, r.median_latency_hours) for r in read("aawiki/patrol")} == by_parts
    assert set(jobs.bench(store, "bbwiki", 0, 1)) == {"load", *jobs.CORE}


def test_generations(store, tmp_path):
    """A later generation replaces what metrics are computed from; a failed one leaves nothing; the rest can be retired."""
    rows = [edit(1, "2021-07-01 00:00:00.0", 1), edit(2, "2021-07-02 00:00:00.0", 1)]
    jobs.ingest(store, "aawiki", "2021-07", [dump(tmp_path / "a.bz2", rows)])
    jobs.compute(store, "aawiki", ("gdp",))
    jobs.ingest(store, "aawiki", "2021-08", [dump(tmp_path / "b.bz2", [*rows, edit(3, "2021-08-02 00:00:00.0", 1)])])
    assert jobs.compute(store, "aawiki", ("gdp",))
    assert store.spark.read.parquet(f"{store.out}/aawiki/gdp").count() == 2
    with pytest.raises(Exception, match="bad event_timestamp"):
        jobs.ingest(store, "aawiki", "2021-09", [dump(tmp_path / "c.bz2", [edit(1, "bad", 1)])])
    assert store.version("aawiki") == "2021-08" and store.folders(store.warehouse("aawiki")) == ["2021-07", "2021-08"]
    assert store.retire("aawiki") == ["2021-07"] and store.folders(store.warehouse("aawiki")) == ["2021-08"]
    for version in ("2021-13", "2021-07"):
        with pytest.raises(ValueError):
            store.publish("aawiki", version)
    assert contracts.version_at_lag("2026-01", 2) == "2025-11"


def test_command_line(spark, tmp_path, capsys, monkeypatch):
    monkeypatch.setattr(cli, "session", lambda: spark)
    folders = ["--data", str(tmp_path / "d"), "--out", str(tmp_path / "o")]
    path = dump(tmp_path / "a.bz2", [edit(1, "2021-07-01 00:00:00.0", 1), edit(2, "2021-07-02 00:00:00.0", 2)])
    (tmp_path / "r.json").write_text(json.dumps(registry(aawiki={"publication": "published", "refresh": "scheduled"})))
    for args in (["snapshot-resolve", "2021-09"], ["run", "aawiki", "2021-07", path], ["publication-validate", str(tmp_path / "r.json")], ["publication-verify"], ["merge", "--registry", str(tmp_path / "r.json")], ["snapshot-finalize", "aawiki"], ["manifest", str(tmp_path / "r.json")]):
        assert cli.main([*folders, *args]) == 0
    assert capsys.readouterr().out.startswith("2021-07\n")
    site = tmp_path / "site"
    site.mkdir()
    (site / "index.html").write_text("x")
    assert [cli.main([*folders, f"site-fingerprint-{v}", str(site)]) for v in ("check", "record", "check")] == [1, 0, 0]
    (site / "index.html").write_text("xy")
    assert cli.main([*folders, "site-fingerprint-check", str(site)]) == 1
