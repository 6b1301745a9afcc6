"""Command line over a store: ``--data`` and ``--out`` name its folders; the verbs are the stages."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from meridia.plans import catalog, contracts, jobs
from meridia.plans.store import Store


def session() -> SparkSession:
    return SparkSession.builder.config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").getOrCreate()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="meridia")
    top.add_argument("--data", default="data")
    top.add_argument("--out", default="output")
    verbs = top.add_subparsers(dest="verb", required=True)

    def verb(name: str, text: str, *names: str, **options: dict) -> None:
        one = verbs.add_parser(name, help=text)
        for n in names:
            one.add_argument(n, nargs="+" if n in ("wikis", "dumps") else None)
        for o, how in options.items():
            one.add_argument(f"--{o.replace('_', '-')}", **how)

    verb("snapshot-resolve", "the version so many months before the latest", "latest", lag={"type": int, "default": 2})
    verb("ingest", "history dumps of a wiki into a generation", "wiki", "version", "dumps")
    verb("compute", "datasets of wikis", "wikis", metric={"action": "append", "choices": jobs.CORE})
    verb("patrol-fetch", "a wiki's log and site, fetched before, into events", "wiki", "log", site={}, sample={"type": int})
    verb("patrol-compute", "the patrol dataset of wikis, month by month", "wikis", rebuild={"action": "store_true"}, limit_months={"type": int})
    verb("merge", "datasets of all wikis, or of the registry's published ones, into one each", registry={})
    verb("publication-validate", "the gate before publication", "registry")
    verb("publication-verify", "whether the gate's receipt still holds")
    verb("snapshot-finalize", "delete the generations not in use", "wikis")
    verb("manifest", "what there is and what waits", "registry")
    verb("site-fingerprint-check", "whether a site was published from these datasets", "site")
    verb("site-fingerprint-record", "record that a site was published from these datasets", "site")
    verb("bench", "times of a wiki's datasets", "wiki", warmup={"type": int, "default": 1}, iterations={"type": int, "default": 5})
    verb("run", "ingest, compute and merge a wiki", "wiki", "version", "dumps", log={}, site={})
    verb("query", "a registered query over a folder of tables, shown", "tables", "name")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    if a.verb == "snapshot-resolve":
        print(contracts.version_at_lag(a.latest, a.lag))
        return 0
    store = Store(session(), a.data, a.out)
    registry = store.read_json(a.registry) if getattr(a, "registry", None) else None
    if a.verb in ("ingest", "run"):
        jobs.ingest(store, a.wiki, a.version, a.dumps)
    if a.verb == "compute":
        for wiki in a.wikis:
            jobs.compute(store, wiki, tuple(a.metric or jobs.CORE))
    elif a.verb == "patrol-fetch":
        print(json.dumps(jobs.patrol_ingest(store, a.wiki, a.log, a.site, a.sample)))
    elif a.verb == "patrol-compute":
        for wiki in a.wikis:
            print(wiki, *jobs.patrol_compute(store, wiki, a.rebuild, a.limit_months))
    elif a.verb == "run":
        jobs.compute(store, a.wiki)
        if a.log:
            jobs.patrol_ingest(store, a.wiki, a.log, a.site)
            jobs.patrol_compute(store, a.wiki)
        jobs.merge(store)
    elif a.verb == "merge":
        published = [w for w, v in registry["wikis"].items() if v["publication"] == "published"] if registry else None
        print(json.dumps(jobs.merge(store, published)))
    elif a.verb == "publication-validate":
        print(json.dumps(jobs.validate(store, registry)["reports"]))
    elif a.verb == "publication-verify":
        jobs.verify(store)
    elif a.verb == "snapshot-finalize":
        for wiki in a.wikis:
            print(wiki, *store.retire(wiki))
    elif a.verb == "manifest":
        print(json.dumps(jobs.manifest(store, registry)))
    elif a.verb.startswith("site-fingerprint"):
        seen = [[n, store.inventory(f"{store.out}/{n}")] for n in jobs.DATASETS]
        if a.verb.endswith("check"):
            return 0 if store.reusable("_site", "site", seen, {}, {"site": a.site}) else 1
        store.record("_site", "site", seen, {}, {"site": a.site})
    elif a.verb == "bench":
        print(json.dumps(jobs.bench(store, a.wiki, a.warmup, a.iterations)))
    elif a.verb == "query":
        catalog.QUERIES[a.name](store.spark, a.tables).show(50, False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
