"""Command line: ``python -m telemark <job> <source> [<target>] [options]``."""

from __future__ import annotations

import argparse
import dataclasses

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from telemark import contract, jobs
from telemark.config import SpikeRepair, load_operator_config, load_pipeline_config
from telemark.sources import reports
from telemark.sources.annotations import read_annotations


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="telemark")
    sub = parser.add_subparsers(dest="job", required=True)
    for name in ("clean", "resample", "analyze-resampling", "convert", "audit", "repair-spikes", "quality", "operators", "jump-evidence"):
        job = sub.add_parser(name)
        job.add_argument("source")
        job.add_argument("target", help="folder for results and reports")
        job.add_argument("--config", help="TOML file with overrides")
        job.add_argument("--overwrite", action="store_true")
        if name in ("clean", "convert", "repair-spikes"):
            job.add_argument("--dry-run", action="store_true")
        if name == "resample":
            job.add_argument("--fps", type=float, default=20.0)
            job.add_argument("--mode", choices=("aligned", "unique"), default="aligned")
            job.add_argument("--topics", nargs="+", default=list(contract.REQUIRED_TOPICS))
            job.add_argument("--no-diagnostics", action="store_true")
            job.add_argument("--require-cleaned", action="store_true")
        if name in ("convert", "quality"):
            job.add_argument("--annotations", help="JSON object of episode settings")
            job.add_argument("--task", default="")
        if name == "operators":
            job.add_argument("--vector", default="action", help="vector of a converted dataset")
            job.add_argument("--operators", nargs="+", default=["motion", "action"])
            job.add_argument("--urdf", help="robot description with joint limits")
            job.add_argument("--episodes", nargs="+", type=int)
        if name == "jump-evidence":
            job.add_argument("--topic", default=contract.LEADER_JOINTS)
        if name == "repair-spikes":
            job.add_argument("--topic", default=contract.FOLLOWER_JOINTS)
            job.add_argument("--joint-prefix", default="arm_")
            for option in dataclasses.fields(SpikeRepair):
                job.add_argument("--" + option.name.replace("_", "-"), type=type(option.default), default=option.default)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"telemark {args.job}").getOrCreate()
    keep = {"overwrite": args.overwrite}
    if args.job == "clean":
        config = load_pipeline_config(args.config).head_timestamp
        jobs.clean(spark, args.source, args.target, config, dry_run=args.dry_run, **keep)
    elif args.job == "resample":
        options = {"fps": args.fps, "mode": args.mode, "topics": args.topics, "require_cleaned": args.require_cleaned}
        jobs.resample_recordings(spark, args.source, args.target, diagnostics=not args.no_diagnostics, **options, **keep)
    elif args.job == "analyze-resampling":
        mappings = spark.read.parquet(f"{args.source}/mappings")
        tables = jobs.analyze_resampling(mappings, spark.read.parquet(f"{args.source}/samples"), load_pipeline_config(args.config).timestamp)
        _report(tables, args)
    elif args.job == "convert":
        annotations = read_annotations(spark, args.annotations) if args.annotations else None
        config = load_pipeline_config(args.config).conversion
        jobs.convert(spark, args.source, args.target, annotations=annotations, task=args.task, config=config, dry_run=args.dry_run, **keep)
    elif args.job == "audit":
        _report(jobs.audit_joints(spark, args.source, load_operator_config(args.config)), args)
    elif args.job == "quality":
        annotations = read_annotations(spark, args.annotations) if args.annotations else None
        _report(jobs.inspect_quality(spark, args.source, annotations=annotations, config=load_pipeline_config(args.config), task=args.task), args)
    elif args.job == "operators":
        urdf = "\n".join(r.value for r in spark.read.text(args.urdf, wholetext=True).collect()) if args.urdf else None
        options = {"chosen": args.operators, "vector": args.vector, "urdf": urdf, "episodes": args.episodes}
        found = jobs.inspect_converted(spark, args.source, load_operator_config(args.config), **options)
        _report({f"{name}/{table}": rows for name, tables in found.items() for table, rows in tables.items()}, args)
    elif args.job == "jump-evidence":
        _report(jobs.jump_evidence(spark, args.source, topic=args.topic), args)
    else:
        config = SpikeRepair(**{f.name: getattr(args, f.name) for f in dataclasses.fields(SpikeRepair)})
        target = None if args.dry_run else args.target
        jobs.repair_spikes(spark, args.source, target, config, topic=args.topic, prefix=args.joint_prefix, **keep)["status"].show()


def _report(tables, args) -> None:
    for name, table in tables.items():
        if name.split("/")[-1] in ("events", "gap_events", "jumps"):
            table = reports.in_event_order(table)
        reports.write_csv(table, f"{args.target}/{name}", overwrite=args.overwrite)
    for name in tables:
        if name.split("/")[-1] in ("status", "episodes", "streams"):
            text = reports.markdown_table(tables[name], [F.col(tables[name].columns[0])])
            reports.write_text(f"{args.target}/{name}.md", f"# {name}\n\n{text}")


if __name__ == "__main__":
    main()
