"""Command line: crawl a site or a page table, upload files, convert one page."""

from __future__ import annotations

import argparse
import dataclasses
import logging
import sys
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from loomline.config import CrawlConfig
from loomline.functions import markdown as M
from loomline.operators import rules, stats, upload
from loomline.plans import crawl, full_run, uploads
from loomline.sources import fetch, state
from loomline.sources.services import KnowledgeBase, notify, summariser
from loomline.sources.transport import Http, fetchers


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="loomline")
    commands = top.add_subparsers(dest="command", required=True)
    run = commands.add_parser("crawl", help="crawl a site, or a table of fetched pages (url, html)")
    run.add_argument("--corpus", help="table of fetched pages; without it pages are fetched")
    run.add_argument("--state", required=True, help="folder of the generations")
    run.add_argument("--seed", action="append", default=[])
    run.add_argument("--explore-filter-json")
    for f in dataclasses.fields(CrawlConfig):
        if f.type in ("int", "float", "str"):
            run.add_argument(f"--{f.name.replace('_', '-')}", type={"int": int, "float": float, "str": str}[f.type], default=f.default)
    run.add_argument("--llm-base-url", default="", help="chat service; without it summaries are made from the text")
    run.add_argument("--llm-api-key", default="")
    run.add_argument("--llm-timeout", type=float, default=60.0)
    run.add_argument("--notify-endpoint", default="")
    run.add_argument("--notify-key", default="")
    run.add_argument("--notify-on-failure", action="store_true")
    run.add_argument("--progress-file", help="of the upload that follows if there is a --kb-id")
    for at in (run, commands.add_parser("plan-upload", help="list the files to upload, in batches"), commands.add_parser("upload", help="upload changed files; status 2 if some failed")):
        if at is not run:
            at.add_argument("--path", action="append", required=True)
            at.add_argument("--recursive", action="store_true")
            at.add_argument("--ext", action="append", default=[])
            at.add_argument("--progress-file", required=True)
            at.add_argument("--files-per-task", type=int, default=20)
        if "plan-upload" not in at.prog:
            at.add_argument("--kb-id", default="", required=at is not run)
            at.add_argument("--kb-base-url", default="http://127.0.0.1:6185")
            for name in ("token", "username", "password"):
                at.add_argument(f"--kb-{name}", default="")
            for name, value in (("chunk-size", 512), ("chunk-overlap", 50), ("batch-size", 32), ("tasks-limit", 3), ("max-retries", 3)):
                at.add_argument(f"--kb-{name}", type=int, default=value)
            at.add_argument("--kb-poll-interval", type=float, default=1.5)
            at.add_argument("--kb-timeout", type=float, default=120.0)
    top.add_argument("--verbose", action="store_true", help="debug messages")
    one = commands.add_parser("convert", help="convert one HTML file to Markdown")
    one.add_argument("path")
    one.add_argument("-o", "--output")
    return top


def knowledge_base(args: argparse.Namespace) -> KnowledgeBase:
    numbers = {k: getattr(args, f"kb_{k}") for k in ("token", "username", "password", "chunk_size", "chunk_overlap", "batch_size", "tasks_limit", "max_retries", "poll_interval")}
    return KnowledgeBase(Http(f"{args.kb_base_url.rstrip('/')}/api", args.kb_timeout), args.kb_id, **numbers)


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    logging.basicConfig(stream=sys.stdout, level=logging.WARNING, format="%(asctime)s | %(levelname)-8s | %(message)s", datefmt="%H:%M:%S")
    logging.getLogger("loomline").setLevel(logging.DEBUG if args.verbose else logging.INFO)
    spark = SparkSession.builder.appName("loomline").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    now = datetime.now(timezone.utc).isoformat()
    if args.command == "crawl":
        names = {f.name for f in dataclasses.fields(CrawlConfig)}
        config = CrawlConfig(**{k: v for k, v in vars(args).items() if k in names})
        patterns = rules.usable(rules.load(spark, args.explore_filter_json, config)) if args.explore_filter_json else []
        service = summariser(Http(args.llm_base_url, args.llm_timeout, {"Authorization": f"Bearer {args.llm_api_key}"}), config.model, config.llm_qps) if args.llm_base_url else None
        source = spark.read.parquet(args.corpus) if args.corpus else None
        page, fallback = fetchers(config)
        pages = (lambda urls: fetch.from_corpus(urls, source, config)) if args.corpus else (lambda urls: fetch.fetch_pages(urls, page, config, fallback))
        say = lambda title, text: notify(Http(args.notify_endpoint), args.notify_key, title, text)
        send = None
        if args.kb_id:
            progress = args.progress_file or f"{args.state.rstrip('/')}/upload.json"
            send = lambda: uploads.run(spark, [f"{args.state.rstrip('/')}/pages"], True, ["md"], progress, knowledge_base(args), now, config.files_per_task)
        print(full_run.run(spark, lambda: crawl.run(spark, args.state, args.seed, pages, config, now, patterns, service), send, say, config.model, now, args.notify_on_failure))
        return 0
    if args.command == "upload":
        totals = uploads.run(spark, args.path, args.recursive, args.ext, args.progress_file, knowledge_base(args), now, args.files_per_task)
        print(stats.render(spark, totals, stats.upload_message()))
        return uploads.exit_status(totals)
    if args.command == "plan-upload":
        found = state.files(spark, args.path, args.recursive)
        found = upload.of_extensions(found, args.ext) if args.ext else found
        todo = upload.pending(found, state.read_progress(spark, args.progress_file))
        planned = upload.batches(todo, args.files_per_task).orderBy("path")
        print("\t".join(planned.columns))
        for row in planned.toLocalIterator():
            print("\t".join("" if v is None else str(v) for v in row))
        return 0
    html = "\n".join(r["value"] for r in spark.read.text(args.path).toLocalIterator())
    text = M.to_markdown(html, "")
    if not text:
        return 2
    if args.output:
        folder, _, name = args.output.rpartition("/")
        state.Store(spark, folder or ".").write(name, text)
    else:
        print(text)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
