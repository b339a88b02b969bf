"""python -m canopyflow.cli: version, doctor, run, validate-sample, validate-chips, validate-report."""

from __future__ import annotations

import argparse
import csv
import io
import sys
from datetime import date

from canopyflow.functions.geo import slug_of

VERSION = "0.2.0"
#: What to do about a check that failed.
REMEDIES = {
    "round trip": "Spark does not answer: see the driver's log, and whether the master in spark.master can be reached.",
    "functions": "This Spark lacks functions that the engine needs: use 4.0 or newer.",
    "checkpoints": "Set spark.checkpoint.dir to a folder that the driver and all executors share.",
}


def doctor(spark) -> list[tuple[str, bool, str]]:
    """(check, passed, detail) in order: a round trip, and if it works the functions that the engine needs and shared storage."""
    try:
        answer = spark.sql("select 1 + 1 as two").first().two
    except Exception as e:  # whatever Spark raises is what this check is for
        return [("round trip", False, str(e).splitlines()[0])]
    if answer != 2:
        return [("round trip", False, f"1 + 1 gave {answer}")]
    missing = {"median", "max_by", "try_divide", "xxhash64"} - {f.name for f in spark.catalog.listFunctions()}
    folder = spark.conf.get("spark.checkpoint.dir", None)
    return [("round trip", True, ""), ("functions", not missing, ", ".join(sorted(missing))), ("checkpoints", bool(folder), folder or "not set")]


def diagnosis(checks: list[tuple[str, bool, str]]) -> list[str]:
    """A line for each check, then what to do about those that failed."""
    lines = [f"{'PASS' if ok else 'FAIL'}  {name}" + (f": {detail}" if detail else "") for name, ok, detail in checks]
    return lines + [f"  {name}: {REMEDIES[name]}" for name, ok, _ in checks if not ok]


def _run(spark, args) -> int:
    from canopyflow.functions.season import Season
    from canopyflow.operators import cycle, detect, report, scenes
    from canopyflow.sources import stores

    season, today, slug = Season(*map(int, args.season.split("-"))), date.fromisoformat(args.today), slug_of(args.aoi)
    vectors, land = spark.read.parquet(args.vectors), spark.read.parquet(args.land)
    try:
        years = scenes.years_to_compare(vectors, season, today, args.gap)
    except ValueError as e:
        print(e)
        return 1
    pixels = scenes.change_pixels(vectors, land, spark.read.parquet(args.scenes) if args.scenes else None, season, years)
    config = detect.Embedding(distance=args.distance, min_ha=args.min_ha, gate=bool(args.scenes), pixel_m=args.pixel_m)
    path = f"{args.store}/{slug}.json"
    before = stores.load_store(spark, path, slug)
    save = None if args.dry_run else lambda after: stores.save_store(spark, after, path, args.today)
    result = cycle.run_cycle(pixels, before, slug, years, args.today, args.west, args.north, args.step, config, save=save)
    print(f"{args.aoi}: {years[0]} against {years[1]}")
    for line in result.lines:
        print(line)
    if args.dry_run:
        print(report.digest(result.due, args.aoi, args.today))
    else:
        for written in report.write_reports(result.store, result.due, args.aoi, slug, args.today, args.reports):
            print(written)
    return 0


def _sample(spark, args) -> int:
    from canopyflow.functions import stats
    from canopyflow.operators import evaluate
    from canopyflow.sources import stores

    slug = slug_of(args.aoi)
    store = stores.load_store(spark, f"{args.store}/{slug}.json", slug)
    if store.isEmpty():
        print(f"no alerts of {args.aoi} to sample")
        return 1
    chosen = evaluate.stratified_sample([r.asDict() for r in store.collect()], args.per_stratum, args.seed)
    order = spark.createDataFrame([(a["alert_id"], i) for i, a in enumerate(chosen)], "alert_id string, k int")
    rows = stores.worksheet(store.join(order, "alert_id")).join(order, "alert_id").orderBy("k").drop("k").collect()
    out = io.StringIO()
    sheet = csv.writer(out, lineterminator="\n")
    sheet.writerow(stores.WORKSHEET)
    sheet.writerows([r[n] for n in stores.WORKSHEET] for r in rows)
    path = f"{args.out}/{slug}-sample-seed{args.seed}.csv"
    stores.put(spark, path, out.getvalue())
    for name, low, high in stats.STRATA:
        print(f"{name}: {sum(low <= a['area_ha'] < high for a in chosen)}")
    print(path)
    return 0


def _chips(spark, args) -> int:
    """What images are there for the alerts of a worksheet: no alert is left out for want of one."""
    from pyspark.sql import functions as F

    from canopyflow.sources import stores

    slug = slug_of(args.aoi)
    store = stores.load_store(spark, f"{args.store}/{slug}.json", slug)
    if not stores.is_there(spark, args.worksheet):
        print(f"no worksheet at {args.worksheet}")
        return 1
    wanted = store.join(stores.worksheet_ids(spark, args.worksheet), "alert_id", "left_semi")
    if wanted.isEmpty():
        print("no alert of the store is on the worksheet")
        return 1
    held = stores.chip_sets(wanted, spark.read.format("binaryFile").load(args.chips) if stores.is_there(spark, args.chips) else None)
    rows = held.orderBy("alert_id").collect()
    for r in rows:
        print(f"{r.alert_id}  {'complete' if r.complete else 'missing: ' + ', '.join(r.missing)}")
    print(f"{sum(r.complete for r in rows)} of {len(rows)} complete; sample {held.select(F.substring(F.sha2(F.array_join(F.array_sort(F.collect_list('alert_id')), ','), 256), 1, 12)).first()[0]}")
    return 0


def _report(spark, args) -> int:
    from canopyflow.operators import evaluate
    from canopyflow.sources import stores

    if not stores.is_there(spark, args.verdicts):
        print(f"no worksheet at {args.verdicts}")
        return 1
    judged = stores.read_verdicts(spark, args.verdicts)
    if judged.isEmpty():
        print("no verdicts filled in")
        return 1
    report = evaluate.precision_report(judged)
    for line in evaluate.as_rows(report):
        print(line)
    p = evaluate.pooled(report).first()
    print(f"all: {p.tp} of {p.judged} judged, precision {p.precision:.2f} [{p.lo:.2f}, {p.hi:.2f}] of what was sampled")
    return 0


def main(argv: list[str] | None = None) -> int:
    top = argparse.ArgumentParser(prog="canopyflow")
    sub = top.add_subparsers(dest="command", required=True)
    sub.add_parser("version")
    sub.add_parser("doctor")

    def command(name, does, **options):
        p = sub.add_parser(name, help=does)
        for option, default in options.items():
            flag = f"--{option.replace('_', '-')}"
            if default is ...:
                p.add_argument(flag, required=True)
            elif default is False:
                p.add_argument(flag, action="store_true")
            else:
                p.add_argument(flag, default=default, type=type(default))

    command("run", "detect, confirm, record and report for one area", aoi=..., vectors=..., land=..., scenes="", season="1-3", gap=1, store=..., reports=..., west=0.0, north=0.0, step=0.0001, distance=0.45, min_ha=0.2, pixel_m=10.0, today=date.today().isoformat(), dry_run=False)
    command("validate-sample", "draw a worksheet from an area's alerts", aoi=..., store=..., out=..., per_stratum=25, seed=42)
    command("validate-chips", "list the images of a worksheet's alerts", aoi=..., store=..., worksheet=..., chips=...)
    command("validate-report", "precision by size from a filled worksheet", verdicts=...)
    args = top.parse_args(argv)
    if args.command == "version":
        print(VERSION)
        return 0
    from canopyflow.settings import session

    spark = session()
    if args.command == "doctor":
        checks = doctor(spark)
        print("\n".join(diagnosis(checks)))
        return 0 if all(ok for _, ok, _ in checks[:2]) else 1
    return {"run": _run, "validate-sample": _sample, "validate-chips": _chips, "validate-report": _report}[args.command](spark, args)


if __name__ == "__main__":
    sys.exit(main())
