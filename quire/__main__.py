"""python -m quire FOLDER COMMAND ...: asks a stored corpus.

FOLDER holds passages and, where wanted, index (see quire.operators.index.write_index) as Parquet; works.json, aliases.json (lists of
records), rules.json; and for evidence topics, topic_aliases, records, record_topics and registry as Parquet. Answers are JSON.
"""

from __future__ import annotations

import argparse
import json
from datetime import date


def iso_date(value: str) -> str:
    return date.fromisoformat(value).isoformat()


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="quire", description=__doc__)
    p.add_argument("folder")
    sub = p.add_subparsers(dest="command", required=True)

    def searching(c: argparse.ArgumentParser) -> None:
        c.add_argument("--query", required=True)
        c.add_argument("--terms")
        c.add_argument("--canon", default="auto", choices=["auto", "huangdi", "zhongjing", "nanjing", "wenbing"])
        c.add_argument("--work", default="auto")
        c.add_argument("--layers", default="all")
        c.add_argument("--author")
        for name, n in (("core", 2), ("commentary", 2), ("total", 4)):
            c.add_argument(f"--limit-{name}", type=int, default=n)
        c.add_argument("--candidate-limit", type=int, default=240)
        c.add_argument("--no-route-fallback", dest="route_fallback", action="store_false")

    def assessing(c: argparse.ArgumentParser) -> None:
        c.add_argument("--topics")
        c.add_argument("--as-of", type=iso_date, default=date.today().isoformat())
        c.add_argument("--include-stale", action="store_true")

    searching(sub.add_parser("search"))
    sub.add_parser("passage").add_argument("--id", required=True)
    c = sub.add_parser("context")
    c.add_argument("--id", required=True)
    c.add_argument("--before", type=int, default=1)
    c.add_argument("--after", type=int, default=1)
    sub.add_parser("toc").add_argument("--work", required=True)
    for name in ("classify", "lookup", "plan", "assess"):
        c = sub.add_parser(name)
        c.add_argument("--query", required=True)
        assessing(c)
    c = sub.add_parser("render")
    c.add_argument("--input", required=True, help="a packet, as study gives it")
    c.add_argument("--format", default="markdown", choices=["markdown", "html"])
    c = sub.add_parser("segment")
    c.add_argument("--blocks", required=True)
    c.add_argument("--output", required=True)
    c.add_argument("--max-chars", type=int, default=700)
    c.add_argument("--min-chars", type=int, default=220)
    sub.add_parser("source-check").add_argument("--url", required=True)
    sub.add_parser("status").add_argument("--as-of", type=iso_date, default=date.today().isoformat())
    c = sub.add_parser("study")
    searching(c)
    assessing(c)
    c.add_argument("--character-budget", type=int, default=2500)
    c.add_argument("--anchor-id")
    c.add_argument("--context-before", type=int, default=1)
    c.add_argument("--context-after", type=int, default=1)
    c.add_argument("--include-classics-after-safety", action="store_true")
    c.add_argument("--compact", action="store_true")
    return p


def exists(spark, path: str) -> bool:
    """Whether a path exists, in any store that Spark reads."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)


def whole(spark, path: str) -> str | None:
    return spark.read.text(path, wholetext=True).first()[0] if exists(spark, path) else None


def corpus(spark, folder: str):
    from quire import api
    from quire.operators.index import Index
    from quire.operators.query import Alias, Rules, Work

    def read(name: str, default):
        text = whole(spark, f"{folder}/{name}.json")
        return default if text is None else json.loads(text)

    works = read("works", [])
    pick = lambda kind, row: kind(**{k: tuple(v) if isinstance(v, list) else v for k, v in row.items() if k in kind.__dataclass_fields__})
    stored = Index(spark, f"{folder}/index") if exists(spark, f"{folder}/index/current") else None
    return api.Corpus(spark, spark.read.parquet(f"{folder}/passages"), [pick(Work, w) for w in works], [pick(Alias, a) for a in read("aliases", [])], Rules.load(read("rules", {"schema_version": 1})), {w["id"]: w.get("canon", "") for w in works}, stored)


def known(spark, folder: str):
    from quire import api

    return api.Evidence(*[spark.read.parquet(f"{folder}/{t}") for t in ("topics", "topic_aliases", "records", "record_topics", "registry")])


def answer(spark, args: argparse.Namespace):
    from quire import api
    from quire.operators import packet, segment

    f = args.folder
    if args.command in ("search", "study"):
        limits = api.Limits(args.limit_core, args.limit_commentary, args.limit_total, args.candidate_limit)
        options = {k: getattr(args, k) for k in ("terms", "canon", "work", "layers", "author", "route_fallback")} | {"limits": limits}
    if args.command == "search":
        return corpus(spark, f).search(args.query, **options)
    if args.command == "study":
        return api.study(corpus(spark, f), known(spark, f), args.query, args.as_of, args.character_budget, args.anchor_id, args.context_before, args.context_after, args.include_classics_after_safety, args.topics, args.include_stale, args.compact, **options)
    if args.command == "passage":
        return corpus(spark, f).passage(args.id)
    if args.command == "context":
        return corpus(spark, f).context(args.id, args.before, args.after)
    if args.command == "toc":
        return corpus(spark, f).toc(args.work)
    if args.command == "classify":
        return known(spark, f).classify(args.query)
    if args.command in ("assess", "lookup", "plan"):
        return getattr(known(spark, f), args.command)(args.query, args.as_of, args.topics, args.include_stale)
    if args.command == "render":
        return packet.rendered(json.loads(whole(spark, args.input)), args.format)
    if args.command == "segment":
        blocks = spark.read.parquet(args.blocks)
        done = segment.segmented(blocks, [c for c in ("page_no", "token_no", "piece_no") if c in blocks.columns], least=args.min_chars, most=args.max_chars)
        segment.linked(done, ["work_id"], ["sequence"], "passage_id", done["citable"]).write.mode("overwrite").parquet(args.output)
        return {"output": args.output, "passages": spark.read.parquet(args.output).count()}
    return known(spark, f).source_check(args.url) if args.command == "source-check" else known(spark, f).status(args.as_of)


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    from pyspark.sql import SparkSession

    spark = SparkSession.builder.appName("quire").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    got = answer(spark, args)
    print(got if isinstance(got, str) else json.dumps(got, ensure_ascii=False, default=str, indent=1))


if __name__ == "__main__":
    main()
