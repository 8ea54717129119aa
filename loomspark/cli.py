"""The command line: validate, check-catalog, build, screening, task, check-leaks."""

from __future__ import annotations

import argparse
import json
import sys
from datetime import date
from pathlib import Path

from .operators import screening
from .operators.vocabulary import Vocabulary
from .plans import build, leaks, manifest, provenance, spec
from .plans import config as C
from .session import session
from .sources import readers, sinks


def _inputs(spark, config: dict) -> build.Inputs:
    """Tables by the config's sources: catalog, corrections, vocabulary, mapping and look-ups (label: path and key)."""
    sources = config.get("sources") or {}
    read = lambda name: readers.read_table(spark, sources[name])
    catalog = readers.read_catalog(read("catalog"))
    rules = readers.correction_rules(read("corrections")) if "corrections" in sources else ()
    words = readers.vocabulary(readers.read_table(spark, config["vocabulary"])) if config.get("vocabulary") else Vocabulary()
    sites = {s: readers.read_table(spark, p if isinstance(p, str) else p["path"]) for s, p in config["sites"].items()}
    mapping = {s: readers.merge.mapping_of(readers.read_table(spark, p["mapping"]), p["source"], p["target"], tuple((config.get("mapping") or {}).get("exclude") or ())) for s, p in config["sites"].items() if isinstance(p, dict) and "mapping" in p}
    lookups = [(readers.read_table(spark, x["path"]), x["key"], label) for label, x in (sources.get("lookups") or {}).items()]
    return build.Inputs(sites, catalog, mapping, rules, lookups, None, words, [{"label": k, "path": str(v)} for k, v in sources.items()])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loomspark", description=__doc__)
    p.add_argument("--config", default="config.yaml")
    sub = p.add_subparsers(dest="command", required=True)
    v = sub.add_parser("validate", help="check the configuration and task files")
    v.add_argument("tasks", nargs="*")
    sub.add_parser("check-catalog", help="what the sources have that the catalog lacks")
    b = sub.add_parser("build", help="make the batch table")
    b.add_argument("--all-sites", action="store_true")
    b.add_argument("--order", help="the column that orders rows in time")
    update = sub.add_parser("update", help="check the catalog, then build")
    update.add_argument("--order")
    s = sub.add_parser("screening", help="the register of parameters that tasks leave out")
    s.add_argument("action", choices=("add", "status", "reset"))
    s.add_argument("register")
    s.add_argument("--proposals")
    s.add_argument("--table")
    s.add_argument("--author", default="")
    t = sub.add_parser("task", help="new, catalog, run, rerun, encode")
    t.add_argument("action", choices=("new", "catalog", "run", "rerun", "encode"))
    t.add_argument("path")
    t.add_argument("--table")
    t.add_argument("--rows")
    t.add_argument("--run")
    t.add_argument("--target", default="")
    t.add_argument("--out", default="runs")
    m = sub.add_parser("verify", help="whether a manifest's files are as it says")
    m.add_argument("manifest")
    k = sub.add_parser("check-leaks", help="private names in tracked files")
    k.add_argument("terms")
    k.add_argument("--root", default=".")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    try:
        return _run(args)
    except (ValueError, OSError) as fault:
        print(f"loomspark: {fault}", file=sys.stderr)
        return 1


def _run(args: argparse.Namespace) -> int:
    if args.command == "verify":
        faults = manifest.verify(Path(args.manifest))
        print("\n".join(faults) or "as written")
        return int(bool(faults))
    if args.command == "check-leaks":
        found = leaks.scan(leaks.tracked(args.root), Path(args.terms).read_text().splitlines())
        print("\n".join(f"{f['file']}:{f['line']}: {f['term']}" for f in found) or "none")
        return int(bool(found))
    if args.command == "task" and args.action == "new":
        path = Path(args.path)
        path.mkdir(parents=True, exist_ok=True)
        (path / "task.yaml").write_text(spec.template(path.name, args.target))
        print(path / "task.yaml")
        return 0
    if args.command == "validate":
        config = C.load(args.config)
        for t in args.tasks:
            spec.load(t)
        print(f"{args.config}: site {config['site']}; {len(args.tasks)} tasks")
        return 0
    spark = session()
    if args.command == "screening":
        sites = list(C.load(args.config)["sites"])
        log = [] if args.action == "reset" else readers.register(spark, args.register, sites) if args.action == "status" or Path(args.register).exists() else []
        if args.action == "add":
            rows = [r.asDict() for r in readers.read_table(spark, args.proposals).collect()]
            table = readers.read_table(spark, args.table)
            log = screening.add(log, rows, sites, table.columns, args.author, date.today(), provenance.frame_digest(table))
        if args.action != "status":
            sinks.write_register(spark, log, args.register)
        for r in screening.summary(screening.frame(spark, log), sites).orderBy("site", "track", "action").collect() if log else []:
            print(*r)
        return 0
    if args.command == "task":
        if args.action == "encode":
            out, lacking = build.encode_rows(Path(args.run), readers.read_table(spark, args.rows))
            sinks.write_table(out, args.out)
            print(f"{args.out}; empty inputs: {', '.join(lacking) or 'none'}")
            return 0
        task, table = spec.load(Path(args.path) / "task.yaml"), readers.read_table(spark, args.table)
        if args.action == "catalog":
            chosen, left = build.cohort.predictors(table.columns, [], roles=[task.id_column], target=task.target.column, excluded=list(task.exclude), include=task.include)
            print("\n".join(chosen))
            return 0
        if args.action == "rerun":
            same = build.rerun(spark, Path(args.run), table, task)
            print("the same" if same else "different")
            return int(not same)
        print(build.run_task(spark, table, task, args.out))
        return 0
    config = C.load(args.config)
    inputs = _inputs(spark, config)
    if args.command in ("check-catalog", "update"):
        print(json.dumps(build.run_catalog(spark, inputs, config), indent=2, ensure_ascii=False))
    if args.command in ("build", "update"):
        sites = list(config["sites"]) if getattr(args, "all_sites", False) else None
        print(build.run_build(spark, inputs, config, sites, args.order))
    return 0


if __name__ == "__main__":
    sys.exit(main())
