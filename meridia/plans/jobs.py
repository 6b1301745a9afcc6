"""The batch stages: ingest, compute, patrol, merge, the gate before publication, manifest and bench."""

from __future__ import annotations

import statistics
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meridia.operators.metrics import ORDER
from meridia.plans import catalog, contracts
from meridia.plans.store import Store
from meridia.sources import dumps

#: Counted up when a stage's results change, so that old receipts do not hold.
STAGE_VERSION = 2
DATASETS = tuple(contracts.CONTRACTS)
CORE = tuple(d for d in DATASETS if d != "patrol")


def ingest(store: Store, wiki: str, version: str, paths: list[str], columns: tuple[str, ...] = dumps.HISTORY) -> bool:
    """Dumps into a generation, which then is the one in use. False, if it stands already."""
    if not contracts.VERSION.match(version):
        raise ValueError(f"not a snapshot version: {version}")
    target, inputs = f"{store.warehouse(wiki)}/{version}", [[p, f] for p in sorted(paths) for f in store.inventory(p)]
    if store.version(wiki) == version and store.reusable(wiki, "ingest", inputs, {"stage": STAGE_VERSION}, {"warehouse": target}):
        return False
    part = f"{store.warehouse(wiki)}/.part-{version}"
    store.delete(part)
    try:
        dumps.write_warehouse(dumps.ingest(dumps.read_history(store.spark, sorted(paths), columns)), part)
        store.replace(part, target)
    finally:
        store.delete(part)
    store.publish(wiki, version)
    store.record(wiki, "ingest", inputs, {"stage": STAGE_VERSION}, {"warehouse": target}, rows=dumps.read_warehouse(store.spark, target).count())
    return True


def ordered(name: str, df: DataFrame) -> DataFrame:
    """In the dataset's order; the weekly one, of many rows, within each part by page."""
    return df.repartition("page_id").sortWithinPartitions(*ORDER[name]) if name == "page_weekly_edits" else df.orderBy(*ORDER[name])


def compute(store: Store, wiki: str, metrics: tuple[str, ...] = CORE) -> bool:
    """A wiki's datasets from the generation in use. False, if the receipt says that they stand already."""
    source = store.active(wiki)
    outputs, inputs, settings = {m: f"{store.out}/{wiki}/{m}" for m in metrics}, store.inventory(source), {"stage": STAGE_VERSION, "metrics": sorted(metrics)}
    if store.reusable(wiki, "compute", inputs, settings, outputs):
        return False
    revisions = dumps.revisions(dumps.read_analytical(store.spark, source))
    for name, path in outputs.items():
        made = catalog.over(store.spark, name, wiki, revisions=revisions)
        contracts.check_schema(name, made)
        store.write(ordered(name, made), path)
        if name == "page_weekly_edits":
            contracts.check_weekly(store.spark.read.parquet(path), revisions)
    store.record(wiki, "compute", inputs, settings, outputs, summaries={m: contracts.summary(store.spark.read.parquet(p)) for m, p in outputs.items()})
    return True


def patrol_ingest(store: Store, wiki: str, log_path: str, site_path: str | None = None, most: int | None = None) -> dict[str, int]:
    """A wiki's log into patrol and rights events, and the groups of its site; without a site, those kept from before."""
    root, groups = f"{store.data}/patrol/{wiki}", f"{store.data}/patrol/{wiki}/autopatrol_groups.json"
    log = dumps.read_log(store.spark, log_path, most)
    items, used = dumps.check_log(log, sum(f[1] for f in store.files(log_path)))
    store.write(dumps.patrol_events(log), f"{root}/patrol")
    store.write(dumps.rights_events(log), f"{root}/rights")
    if site_path is not None:
        store.write_json(groups, {"autopatrol_groups": sorted(r.name for r in dumps.autopatrol_groups(store.spark, site_path).collect())})
    elif not store.exists(groups):
        raise ValueError(f"no groups of {wiki}, and no site to read them from")
    return {"items": items, "used": used}


def patrol_compute(store: Store, wiki: str, rebuild: bool = False, limit_months: int | None = None) -> list[str]:
    """The patrol dataset, month by month: months of the log that have no part yet, the first ``limit_months`` of them. Returns them.

    Patrols of any month count for a revision; a month that stands is not looked at again unless all are rebuilt.
    """
    root, parts = f"{store.data}/patrol/{wiki}", f"{store.out}/{wiki}/_patrol_parts"
    if not store.exists(f"{root}/patrol"):
        raise ValueError(f"no patrol events of {wiki}")
    spark, target = store.spark, f"{store.out}/{wiki}/patrol"
    if rebuild:
        store.delete(parts)
    elif not store.exists(parts) and store.exists(target):
        spark.read.parquet(target).withColumn("month", F.col("year_month")).write.partitionBy("month").parquet(parts)
    log = dumps.log_relations(spark.read.parquet(f"{root}/patrol"), spark.read.parquet(f"{root}/rights"))
    done = {f.removeprefix("month=") for f in store.folders(parts)}
    months = [r.year_month for r in catalog.over(spark, "patrol_months", **log).orderBy("year_month").collect()]  # a row a month
    pending = [m for m in months if m not in done][:limit_months]
    if pending:
        groups = tuple(store.read_json(f"{root}/autopatrol_groups.json")["autopatrol_groups"])
        revisions = dumps.patrol_revisions(dumps.read_warehouse(spark, store.active(wiki)))
        made = catalog.over(spark, "patrol", wiki, groups, patrol_revisions=revisions, **log).where(F.col("year_month").isin(pending))
        contracts.check_schema("patrol", made)
        made.withColumn("month", F.col("year_month")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "zstd").partitionBy("month").parquet(parts)
    if pending or not store.exists(target):
        store.write(ordered("patrol", spark.read.parquet(parts).drop("month")), target)
    return pending


def wikis_of(store: Store, dataset: str) -> list[str]:
    return [w for w in store.folders(store.out) if w not in DATASETS and store.exists(f"{store.out}/{w}/{dataset}")]


def merge(store: Store, published: list[str] | None = None) -> dict[str, list[str]]:
    """Each dataset of all wikis, or of the published ones, into one. Returns the wikis merged, by dataset."""
    out = {}
    for name in DATASETS:
        wikis = [w for w in wikis_of(store, name) if published is None or w in published]
        if wikis:
            store.write(dumps.merge(store.spark, [f"{store.out}/{w}/{name}" for w in wikis], published), f"{store.out}/{name}")
            out[name] = wikis
    return out


def validate(store: Store, registry: dict) -> dict:
    """The gate: schemas, rows, wikis, dates, conservation, coverage and cut-offs of all merged datasets; then a receipt of what was seen.

    ``registry``: wikis (name -> publication, refresh, imported_cutoff) and publication_contract.datasets (name ->
    minimum_rows_per_wiki, and coverage ``all_published`` or wikis).
    """
    read = store.spark.read.parquet
    published = {w for w, v in registry["wikis"].items() if v["publication"] == "published"}
    reports, cutoffs = {}, {}
    for name, rules in registry["publication_contract"]["datasets"].items():
        if (rules.get("coverage") == "all_published") == ("wikis" in rules):
            raise ValueError(f"{name}: either all published wikis or a list of them")
        subset = set(rules["wikis"]) if "wikis" in rules else None
        merged, expected = read(f"{store.out}/{name}"), subset if subset is not None else published
        contracts.check_schema(name, merged)
        contracts.check_coverage(published, {r.wiki for r in merged.select("wiki").distinct().collect()}, subset)
        parts = {w: read(f"{store.out}/{w}/{name}") for w in sorted(expected)}
        for wiki, part in parts.items():
            contracts.check_schema(name, part)
            contracts.check_wiki(name, part, wiki, rules["minimum_rows_per_wiki"])
            last = contracts.check_dates(name, part)[1]
            if name == "gdp":
                cutoffs[wiki] = last
        contracts.check_conservation(name, merged, list(parts.values()), contracts.SUMS.get(name))
        reports[name] = {"rows": merged.count(), "wikis": sorted(parts)}
    for wiki in sorted(published & set(cutoffs)):
        entry = registry["wikis"][wiki]
        paused = entry.get("refresh") == "paused"
        version = entry["imported_cutoff"] if paused else store.version(wiki)
        if version is None:
            raise ValueError(f"{wiki}: no generation in use")
        contracts.check_cutoff(version, cutoffs[wiki], paused)
    receipt = {"reports": reports, "cutoffs": cutoffs, "artifacts": {n: store.inventory(f"{store.out}/{n}") for n in reports}}
    store.write_json(f"{store.data}/publication.json", receipt)
    return receipt


def verify(store: Store) -> None:
    """The gate's receipt still tells every artifact."""
    receipt = store.read_json(f"{store.data}/publication.json")
    if not receipt:
        raise ValueError("no publication receipt")
    for name, files in receipt["artifacts"].items():
        if store.inventory(f"{store.out}/{name}") != files:
            raise ValueError(f"{name} is not what the gate saw")


def manifest(store: Store, registry: dict) -> dict:
    """Merged datasets and, for each wiki, rows and what it waits for next."""
    count = lambda p: store.spark.read.parquet(p).count() if store.exists(p) else 0
    merged = {n: count(f"{store.out}/{n}") for n in DATASETS if store.exists(f"{store.out}/{n}")}
    names = set(registry["wikis"]) | set(store.folders(f"{store.data}/warehouse")) | {w for w in store.folders(store.out) if w not in DATASETS}
    wikis = {}
    for wiki in sorted(names):
        entry = registry["wikis"].get(wiki, {})
        rules = registry["publication_contract"]["datasets"] if entry.get("publication") == "published" else {}
        expected = [n for n, r in rules.items() if r.get("coverage") == "all_published" or wiki in r.get("wikis", ())]
        rows = {n: count(f"{store.out}/{wiki}/{n}") for n in DATASETS if store.exists(f"{store.out}/{wiki}/{n}")}
        root, version = f"{store.data}/patrol/{wiki}", store.version(wiki)
        ingested = version is not None and store.read_json(store.receipt(wiki, "ingest")) is not None
        sources = all(store.exists(f"{root}/{x}") for x in ("patrol", "rights", "autopatrol_groups.json"))
        scheduled, patrol = entry.get("refresh") == "scheduled", "patrol" in expected
        raw = bool(store.files(f"{store.data}/raw/{wiki}"))
        steps = (
            ("needs_fetch", scheduled and version is None and not raw), ("needs_ingest", scheduled and not ingested), ("needs_patrol_fetch", scheduled and patrol and not sources),
            ("needs_compute", any(n not in rows for n in expected if n != "patrol")), ("needs_patrol_compute", patrol and not rows.get("patrol")), ("needs_merge", any(n not in merged for n in expected)),
        )
        wikis[wiki] = {"version": version, "rows": rows, "expected": expected, "status": next((s for s, waits in steps if waits), "complete")}
    return {"datasets": merged, "wikis": wikis}


def bench(store: Store, wiki: str, warmup: int = 1, iterations: int = 5) -> dict[str, dict[str, float]]:
    """Milliseconds (mean, median, min, max) of reading a wiki and of computing its datasets."""
    revisions = dumps.revisions(dumps.read_analytical(store.spark, store.active(wiki)))
    stages = {"load": lambda: revisions, **{m: (lambda m=m: catalog.over(store.spark, m, wiki, revisions=revisions)) for m in CORE}}
    out = {}
    for name, make in stages.items():
        took = []
        for _ in range(warmup + iterations):
            began = time.perf_counter()
            make().write.format("noop").mode("overwrite").save()
            took.append(1000 * (time.perf_counter() - began))
        took = took[warmup:]
        out[name] = {"mean": statistics.mean(took), "median": statistics.median(took), "min": min(took), "max": max(took)}
    return out
