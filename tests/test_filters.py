import json

import pytest

from meridia.operators import filters
from meridia.plans import contracts

SCHEMA = "wiki string, year_month string, user_type string, page_namespace int, edits long, rate double"
ROWS = [("a", "2024-01", "bot", 0, 5, 0.5), ("a", "2024-02", "bot", 1, None, None), ("a", "2024-04", "registered", 0, 7, None), ("b", "2024-04", "bot", 0, 1, 1.0)]


def test_filter_and_periods(spark, tmp_path):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert filters.filter_rows(df).count() == 4
    assert filters.filter_rows(df, "a", ["bot"], ("2024-01", "2024-03"), [1]).count() == 1
    got = {r.period: (r.edits, r.rate) for r in filters.by_period(filters.filter_rows(df, "a"), "quarter", ["edits"], ["rate"]).collect()}
    assert got == {"2024-Q1": (5, 0.5), "2024-Q2": (7, None)}
    shares = filters.share_of_period(filters.by_period(df, "year", ["edits"], keys=["user_type"]), "edits")
    assert sum(r.share for r in shares.collect()) == pytest.approx(1)
    filters.write_json(df, str(tmp_path / "x.json"))
    assert len(json.loads((tmp_path / "x.json").read_text())) == 4
    with pytest.raises(ValueError):
        filters.write_json(df, str(tmp_path / "y.json"), 2)
    assert filters.clamp("2025-01", None, "2024-01", "2024-12") == ("2024-12", "2024-12")
    assert filters.clamp("2024-09", "2024-03", "2024-01", "2024-12") == ("2024-01", "2024-12") == filters.clamp("x", None, "2024-01", "2024-12")
    assert filters.grouped(df, "year", ["edits"], wiki="a", user_types=["bot"]).first().edits == 5
    assert [filters.chosen(v, [1, 2], [2]) for v in ([1, 9], [9], None)] == [[1], [2], [2]] and filters.chosen([], [3], []) == [3]


def test_default_view():
    defaults = {"default_wiki": "b", "wikis": [{"wiki": "a"}, {"wiki": "b"}], "namespaces": [{"wiki": "a", "page_namespace": 0}, {"wiki": "a", "page_namespace": 1}], "ranges": [{"wiki": "a", "mn": "2024-01", "mx": "2024-09"}, {"wiki": "b", "mn": "2024-02", "mx": "2024-08"}]}
    meta = filters.parse_meta(defaults)
    assert (meta["wiki"], meta["max_month"], meta["namespaces"], meta["ranges"]["b"]) == ("b", "2024-09", {"a": [0, 1]}, ("2024-02", "2024-08"))
    view = {"wiki": "b", "granularity": "year", "start": "2024-02", "end": "2024-08", "user_types": ["registered"], "namespaces": [0]}
    assert filters.is_default_view(view, defaults)
    assert not any(filters.is_default_view(view | x, defaults) for x in ({"wiki": "a"}, {"granularity": "month"}, {"end": "2024-07"}, {"user_types": ["bot"]}, {"namespaces": [0, 1]}, {"namespaces": None}))
    assert filters.parse_meta(defaults | {"default_wiki": "gone"})["wiki"] == "a"


def test_gates():
    for cutoff in ("2025-11", "2025-12", "2026-02"):
        contracts.check_cutoff("2026-01", cutoff)
    contracts.check_coverage({"a", "b"}, {"a"}, {"a"})
    for bad in (lambda: contracts.check_cutoff("2026-01", "2025-10"), lambda: contracts.check_cutoff("2026-01", "2026-03"), lambda: contracts.check_cutoff("2026-01", "2026-02", True), lambda: contracts.check_coverage({"a", "b"}, {"a"})):
        with pytest.raises(ValueError):
            bad()
