"""Command line: the three jobs and the end-to-end run.

    python -m firmlink stage-registry --xml PATH --out DIR
    python -m firmlink stage-crawl --hits PATH --pages PATH --out DIR
    python -m firmlink unify --registry PATH --crawl PATH --out PATH [--verdicts PATH | --confirmer mod:fn]
                             [--mode append|overwrite|insert_if_absent]
    python -m firmlink run-all --xml PATH --hits PATH --pages PATH --out DIR [--verdicts PATH]

Tables are Parquet. Staging is insert-if-absent against what ``--out``
already holds, so reruns load nothing twice.
"""

from __future__ import annotations

import argparse
import json
import os

from pyspark.sql import SparkSession

from firmlink.config import MatchConfig
from firmlink.operators.dedup import insert_if_absent
from firmlink.operators.materialize import materialize, release
from firmlink.plans.run_all import ORDINAL, run_all
from firmlink.plans.stage_crawl import stage_crawl
from firmlink.plans.stage_registry import RECORD_FIELDS, stage_registry
from firmlink.plans.unify import unify
from firmlink.schemas import CRAWL, REGISTRY, UNIFIED
from firmlink.sources.index_hits import read_index_hits
from firmlink.sources.registry_xml import flatten_registry, read_registry_xml
from firmlink.sources.tables import existing_table, read_pages, write_quarantine


def parse_options(pairs: list[str]) -> dict[str, str]:
    """``["k=v", ...]`` -> ``{"k": "v"}`` (values may contain ``=``)."""
    out = {}
    for pair in pairs:
        key, sep, value = pair.partition("=")
        if not sep or not key:
            raise ValueError(f"option must be KEY=VALUE: {pair!r}")
        out[key] = value
    return out


def read_named(spark: SparkSession, fmt: str, name: str, opts: dict[str, str]):
    """A path for file formats; a table name (``dbtable``) for JDBC."""
    if fmt == "jdbc":
        return spark.read.format("jdbc").options(**opts, dbtable=name).load()
    return spark.read.format(fmt).options(**opts).load(name)


def write_named(df, fmt: str, name: str, mode: str, opts: dict[str, str]) -> None:
    if fmt == "jdbc":
        df.write.format("jdbc").mode(mode).options(**opts, dbtable=name).save()
    else:
        df.write.format(fmt).mode(mode).options(**opts).save(name)


def _config(args) -> MatchConfig:
    return MatchConfig(block_chars=args.block_chars, lo=args.lo, hi=args.hi, write_mode=args.mode,
                       confirm_limit=args.confirm_limit)


def _confirmer(spec: str | None):
    if not spec:
        return None
    import importlib

    module, _, name = spec.partition(":")
    return getattr(importlib.import_module(module), name)


def _verdicts(spark: SparkSession, path: str | None):
    return spark.read.parquet(path) if path else None


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> dict:
    p = argparse.ArgumentParser(prog="firmlink")
    sub = p.add_subparsers(dest="cmd", required=True)

    def match_opts(sp):
        sp.add_argument("--verdicts", help="Parquet table (reg_norm, crawl_norm, answer)")
        sp.add_argument("--confirmer", help="module:function, pandas (reg_norm, crawl_norm) -> answers")
        sp.add_argument("--confirm-limit", type=int, default=MatchConfig.confirm_limit)
        sp.add_argument("--block-chars", type=int, default=MatchConfig.block_chars)
        sp.add_argument("--lo", type=float, default=MatchConfig.lo)
        sp.add_argument("--hi", type=float, default=MatchConfig.hi)
        sp.add_argument("--mode", default=MatchConfig.write_mode,
                        choices=["append", "overwrite", "insert_if_absent"])

    r = sub.add_parser("stage-registry")
    r.add_argument("--xml", required=True)
    r.add_argument("--out", required=True)
    c = sub.add_parser("stage-crawl")
    c.add_argument("--hits", required=True)
    c.add_argument("--pages", required=True)
    c.add_argument("--out", required=True)
    c.add_argument("--max-stored-chars", type=int, help="leave longer pages out of the stored HTML")
    u = sub.add_parser("unify")
    u.add_argument("--registry", required=True, help="path, or table name with --format jdbc")
    u.add_argument("--crawl", required=True, help="path, or table name with --format jdbc")
    u.add_argument("--out", required=True, help="path, or table name with --format jdbc")
    u.add_argument("--format", default="parquet", help="storage format of the three tables (parquet, jdbc, ...)")
    u.add_argument("--option", action="append", default=[], metavar="KEY=VALUE",
                   help="reader/writer option, e.g. url=jdbc:postgresql://host/db, user=..., numPartitions=8")
    match_opts(u)
    a = sub.add_parser("run-all")
    a.add_argument("--xml", required=True)
    a.add_argument("--hits", required=True)
    a.add_argument("--pages", required=True)
    a.add_argument("--out", required=True)
    a.add_argument("--max-stored-chars", type=int, help="leave longer pages out of the stored HTML")
    match_opts(a)
    args = p.parse_args(argv)

    spark = spark or SparkSession.builder.appName(f"firmlink-{args.cmd}").getOrCreate()
    result: dict = {}
    if args.cmd == "stage-registry":
        flat = materialize(flatten_registry(read_registry_xml(spark, args.xml), keep=ORDINAL), "registry-parsed")
        target_path = os.path.join(args.out, "registry")
        load = stage_registry(flat, ORDINAL, target=existing_table(spark, target_path, REGISTRY))
        load.inserted.write.mode("append").parquet(target_path)
        write_quarantine(load.quarantine, os.path.join(args.out, "quarantine"), record_cols=RECORD_FIELDS)
        result = {"registry": spark.read.parquet(target_path).count()}
    elif args.cmd == "stage-crawl":
        target_path = os.path.join(args.out, "crawl")
        rows = stage_crawl(read_index_hits(spark, args.hits), read_pages(spark, args.pages), ORDINAL,
                           target=existing_table(spark, target_path, CRAWL), max_stored_chars=args.max_stored_chars)
        rows.write.mode("append").parquet(target_path)
        result = {"crawl": spark.read.parquet(target_path).count()}
    elif args.cmd == "unify":
        cfg = _config(args)
        opts = parse_options(args.option)
        read = lambda name: read_named(spark, args.format, name, opts)
        out = unify(read(args.registry), read(args.crawl), cfg,
                    verdicts=_verdicts(spark, args.verdicts), confirmer=_confirmer(args.confirmer))
        out = out.select([f.name for f in UNIFIED.fields])
        if cfg.write_mode == "insert_if_absent":
            existing = read(args.out) if args.format == "jdbc" else existing_table(spark, args.out, UNIFIED, args.format, **opts)
            out = insert_if_absent(out, existing, ["abn", "domain"], ["match_type"], nulls_equal=True)
            mode = "append"
        else:
            mode = cfg.write_mode
        write_named(out, args.format, args.out, mode, opts)
        result = {"unified": read(args.out).count()}
    else:
        result = run_all(spark, args.xml, args.hits, args.pages, args.out, _config(args),
                         verdicts=_verdicts(spark, args.verdicts),
                         max_stored_chars=args.max_stored_chars)
    release(spark)
    print(json.dumps(result))
    return result
