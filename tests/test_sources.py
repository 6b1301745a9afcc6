"""Dumps, logs and fields."""

import bz2
import gzip

import pytest
from pyspark.sql import functions as F

from meridia.functions import fields
from meridia.operators import filters
from meridia.sources import dumps


def line(**given):
    row = dict.fromkeys(dumps.HISTORY, "")
    row.update(event_entity="revision", event_type="create", event_user_is_anonymous="false", event_user_is_temporary="false", page_namespace="0", revision_minor_edit="false", revision_is_identity_reverted="false", wiki_db="xxwiki")
    row.update({k: str(v) for k, v in given.items()})
    return "\t".join(row[c] for c in dumps.HISTORY)


def dump(path, rows):
    path.write_bytes(bz2.compress(("\n".join(line(**r) for r in rows) + "\n").encode()))
    return str(path)


def edit(k, ts, user, **more):
    return {"event_timestamp": ts, "event_user_id": user, "event_user_text": f"U{user}", "page_id": 5, "page_title": "Moss", "revision_id": k, "revision_text_bytes_diff": 40, **more}


def test_history_to_warehouse(spark, tmp_path):
    rows = [edit(1, "2019-11-03 08:00:00.0", 7, revision_minor_edit="true", page_title='A "quoted" \\N'), edit(2, "2020-02-29 08:00:00.0", 8, event_user_is_temporary="true"), edit(3, "2020-02-29 09:00:00.0", "", event_user_is_anonymous="true"), edit(4, "2020-02-29 10:00:00.0", 9, event_user_is_bot_by="group"), {**edit(5, "2020-02-29 11:00:00.0", 9), "event_entity": "page"}]
    history = dumps.read_history(spark, dump(tmp_path / "a.tsv.bz2", rows))
    dumps.write_warehouse(dumps.ingest(history), str(tmp_path / "w"))
    back = dumps.read_warehouse(spark, str(tmp_path / "w"))
    assert back.schema == dumps.WAREHOUSE and spark.conf.get("spark.sql.sources.partitionColumnTypeInference.enabled") == "true"
    got = {r.revision_id: (r.year, r.year_month, r.user_type, r.is_minor, r.page_title, r.event_user_id) for r in back.collect()}
    assert got == {1: (2019, "2019-11", "registered", True, 'A "quoted" \\N', 7), 2: (2020, "2020-02", "temporary", False, "Moss", 8), 3: (2020, "2020-02", "anonymous", False, "Moss", None), 4: (2020, "2020-02", "bot", False, "Moss", 9)}
    assert dumps.analytical(back).columns == list(dumps.ANALYTICAL)
    raw = dumps.analytical(history.withColumn("page_namespace", F.col("page_namespace").cast("int")))  # derived from raw columns
    assert {r.revision_id: r.user_type for r in raw.collect()} == {str(k): v[2] for k, v in got.items()}
    (tmp_path / "w" / "flat.parquet").mkdir()  # partitioned files come before flat ones
    assert dumps.read_analytical(spark, str(tmp_path / "w")).count() == 4


def test_bad_timestamp_fails(spark, tmp_path):
    with pytest.raises(Exception, match="bad event_timestamp"):
        dumps.ingest(dumps.read_history(spark, dump(tmp_path / "b.tsv.bz2", [edit(1, "yesterday", 1)]))).collect()


def items(*found):
    body = "".join(f"<logitem><id>{k}</id><timestamp>{ts}</timestamp><contributor><username>{who}</username><id>{k + 70}</id></contributor><type>{kind}</type><logtitle>{title}</logtitle><params>{params}</params></logitem>" for k, ts, who, kind, title, params in found)
    return f'<mediawiki xmlns="http://x/">{body}</mediawiki>'


def test_log_of_two_members(spark, tmp_path):
    whole = items((1, "2019-11-04T00:00:00Z", "Di", "move", "A", ""), (2, "2019-11-05T00:00:00.25Z", "Di", "patrol", "B", "<![CDATA[812\n811\n1]]>"), (3, "2019-11-06T00:00:00Z", "Em", "rights", "User:Flo:x", "\neditor, keeper"))
    cut = whole.index("<logitem><id>2")
    (tmp_path / "l.xml.gz").write_bytes(gzip.compress(whole[:cut].encode()) + gzip.compress(whole[cut:].encode()))
    log = dumps.read_log(spark, str(tmp_path / "l.xml.gz"))
    assert dumps.check_log(log) == (3, 2) and dumps.read_log(spark, str(tmp_path / "l.xml.gz"), 1).count() == 1
    (event,) = dumps.patrol_events(log).collect()
    assert (event.log_id, event.user, event.user_id, event.current_revision_id, event.prev_revision_id, event.is_auto, event.timestamp) == (2, "Di", 72, 812, 811, True, "2019-11-05 00:00:00")
    right = dumps.rights_events(log).first()
    assert (right.target_user, right.old_groups, right.new_groups) == ("Flo:x", "", "editor, keeper")
    with pytest.raises(ValueError):
        dumps.check_log(log.where("type = 'move'"), 1 << 21)  # substantial by its bytes
    (tmp_path / "bad.xml").write_text(whole.replace("</logitem><logitem><id>3", "<logitem><id>3"))
    with pytest.raises(Exception):
        dumps.read_log(spark, str(tmp_path / "bad.xml")).collect()


def test_site_and_csv(spark, tmp_path):
    (tmp_path / "site.json").write_text('{"query": {"usergroups": [{"name": "keeper", "rights": ["autopatrol", "edit"]}, {"name": "user", "rights": ["edit"]}]}}')
    assert [r.name for r in dumps.autopatrol_groups(spark, str(tmp_path / "site.json")).collect()] == ["keeper"]
    assert [dumps.api_domain(w) for w in ("nlwiki", "wiki", "wikidata")] == ["nl.wikipedia.org", None, None]
    dumps.write_csv(spark.createDataFrame([(1, 'a "b", c'), (2, None)], "k int, t string").coalesce(1), str(tmp_path / "c"))
    (part,) = (tmp_path / "c").glob("*.csv")
    assert part.read_text() == 'k,t\n1,"a ""b"", c"\n2,\n'


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_log_parameters(spark):
    patrol = lambda s: tuple(value(spark, fields.patrol_params(F.lit(s))))
    assert patrol("55\n54\n0") == (55, 54, False) and patrol("55") == (55, 0, False)
    serial = 'a:3:{s:8:"4::curid";%s;s:9:"5::previd";%s;s:7:"6::auto";%s;}'
    assert patrol(serial % ('s:3:"912"', "i:0", "i:0")) == (912, 0, False) and patrol(serial % ("i:4", 's:1:"3"', "i:1")) == (4, 3, True)
    rights = lambda s: tuple(value(spark, fields.rights_params(F.lit(s))))
    assert rights("keeper\neditor") == ("keeper", "editor") and rights("") == ("", "")
    group = lambda *g: f"a:{len(g)}:{{" + "".join(f'i:{k};s:{len(x)}:"{x}";' for k, x in enumerate(g)) + "}"
    both = lambda a, b: f'a:2:{{s:12:"4::oldgroups";{a}s:12:"5::newgroups";{b}}}'
    assert rights(both(group("zeta", "alpha", "zeta", "20200102030405"), group("alpha"))) == ("alpha,zeta", "alpha")
    deep = 's:4:"deep";'
    for _ in range(6):
        deep = f"a:1:{{i:0;{deep}}}"
    assert rights(both(f"a:1:{{i:0;{deep}}}", group("x"))) == ("deep", "x")
    assert rights('a:2:{s:12:"4::oldgroups";a:1:{i:0;s:1:"q";')[0] == ""  # no end
    assert value(spark, fields.has_any(F.lit(" keeper , x"), ["keeper"])) and not value(spark, fields.has_any(F.lit("keeper-aide"), ["keeper"]))


def test_fields(spark):
    assert [value(spark, fields.shift_month(F.lit(k), d)) for k, d in ((199912, 1), (200001, -1), (200013, 1), (200005, 20))] == [200001, 199912, None, 200201]
    bot = lambda b, patrol: value(spark, fields.user_type(F.lit(b), F.lit(False), F.lit(False), patrol))
    assert [bot("false", True), bot("name", True), bot("false", False), bot("", False)] == ["registered", "bot", "bot", "registered"]
    assert [value(spark, fields.round1(F.lit(x))) for x in (0.25, -0.25, 1.04)] == [0.3, -0.3, 1.0]
    assert [value(spark, fields.namespace_label(F.lit(n).cast("int"))) for n in (0, 5, 829, 99, None)] == ["Article", "Wikipedia Talk", "Module Talk", "ns 99", "(no namespace)"]
    assert value(spark, fields.epoch(F.lit("1970-01-02T00:00:00.5Z"))) == 86400 and value(spark, fields.epoch(F.lit("bad"))) is None
    assert [value(spark, filters.short_number(F.lit(x))) for x in (2_345_678, -45_000, 1234, 900, 0.25, float("nan"))] == ["2.3M", "−45.0K", "1,234", "900", "0.3", "—"]
    assert [value(spark, filters.short_bytes(F.lit(x))) for x in (2_345_678, -1500, 12)] == ["2.3 MB", "−1.5 KB", "12 B"]
    with pytest.raises(ValueError):
        fields.period(F.lit("2024-01"), "week")
