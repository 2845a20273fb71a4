"""A crawl from end to end, its state, uploads with bodies, and the HTTP transport against a local server."""

import dataclasses
import hashlib
import json
import pickle
import re
import threading
from http.server import BaseHTTPRequestHandler, HTTPServer

import pytest
from pyspark.sql import functions as F

from loomline import cli
from loomline.config import CrawlConfig
from loomline.plans import crawl, uploads
from loomline.sources import fetch, services, state, transport
from loomline.streaming import runner

C = CrawlConfig(wiki_qps=0, llm_qps=0, least_llm_chars=200)
NOW = "2026-01-01T00:00:00+00:00"
LONG = "words of a page that is long enough for a service. " * 8


def answer(method, path, headers, body):
    """A chat service; it runs on the executors."""
    import json as j

    title, _, excerpt = body["messages"][1]["content"].partition("\n\n")
    if "P3" in title:
        raise OSError("down")
    return j.dumps({"choices": [{"message": {"content": f"about {title}: {len(excerpt)}"}}], "usage": {"prompt_tokens": 5, "completion_tokens": 2, "total_tokens": 7}})


def get(url):
    key = url.rsplit("/", 1)[-1]
    if key == "P9":
        raise OSError("gone")
    if key == "P8":
        return {"title": "P8", "content": "  "}
    n = int(key[1:])
    return {"title": f"{key} - Wiki", "content": (LONG if n % 2 else "short. ") + "".join(f"[P{k}](/P{k})" for k in (n + 1, n + 2) if k < 12)}


@pytest.fixture(scope="module")
def crawled(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("crawl"))
    config = dataclasses.replace(C, fetch_attempts=1, fetch_batch_size=3)
    done = crawl.run(spark, root, ["https://wiki.test/P0"], lambda urls: fetch.fetch_pages(urls, get, config), config, NOW, service=services.summariser(answer, "m", 0))
    return root, done


def test_crawl_writes_the_pages_that_its_index_names(spark, crawled):
    root, done = crawled
    index = state.Generations(spark, root).load("index", state.INDEX).collect()
    assert sorted(r["title"] for r in index) == [f"P{i}" for i in range(8)]  # P8 and P9 fail, and alone lead on
    for r in index:
        text = open(f"{root}/{r['file_path']}").read()
        assert f"# {r['title']}" in text and f"source_url: {r['url']}" in text and f"summary: {r['summary']}" in text
    assert not [x for x in state.Store(spark, root).names() if x.startswith("work-")]


def test_summaries_come_from_the_executors(spark, crawled):
    root, done = crawled
    summaries = {r["title"]: r["summary"] for r in state.Generations(spark, root).load("index", state.INDEX).collect()}
    assert done.llm_success == 3 and done.prompt_tokens == 15 and done.total_tokens == 21  # P1, P5, P7
    assert all(summaries[f"P{i}"].startswith(f"about P{i}: ") for i in (1, 5, 7)) and not summaries["P3"].startswith("about")
    assert state.Generations(spark, root).load("cache", state.CACHE).count() == 3


def test_status_classes(spark, crawled):
    root, done = crawled
    errors = {r["url"][-2:]: r["last_error"] for r in state.Generations(spark, root).load("failures", state.FAILURES).collect()}
    assert errors == {"P9": "gone", "P8": "api_success_false"}
    assert (done.scanned, done.fetched, done.failed, done.empty) == (10, 8, 2, 1)
    rows = spark.createDataFrame([(True, None), (False, "empty content"), (False, "x"), (False, ""), (None, None)], "success boolean, fetch_error string")
    got = [(r["status"], r["error"]) for r in fetch.with_status(rows).collect()]
    assert got[:4] == [("ok", None), ("empty_content", "api_success_false"), ("fetch_failed", "x"), ("fetch_failed", "unknown_error")] and got[4][0] == "fetch_failed"


def test_summariser_travels_and_shares_its_rate():
    one = services.summariser(answer, "m", 8)
    one("t", "x")
    assert pickle.loads(pickle.dumps(one)).qps == 8 and one.shared_by(4).qps == 2


def test_generations_add_compact_and_prune(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state.Generations, "COMPACT", 4)
    store = state.Generations(spark, str(tmp_path))
    store.save({"visited": spark.createDataFrame([("u0", "u0")], state.VISITED), "queue": spark.createDataFrame([(0, "q", "q")], state.QUEUE)})
    row = lambda i: spark.createDataFrame([("same", f"t{i}", "", "", "", "")], state.INDEX)
    for i in range(1, 8):
        store.save({}, {"visited": spark.createDataFrame([(f"u{i}", f"u{i}")], state.VISITED), "index": row(i)})
        assert len(store.manifest()["visited"]) < 4
    assert sorted(r["url"] for r in store.load("visited", state.VISITED).collect()) == [f"u{i}" for i in range(8)]
    assert [r["title"] for r in store.load("index", state.INDEX).collect()] == ["t7"]  # later rows win
    assert store.load("queue", state.QUEUE).first()["url"] == "q"
    used = {x.split("/")[0] for folders in store.manifest().values() for x in folders}
    assert len([x for x in store.store.names() if x.startswith("gen-")]) <= len(used) + 6


def test_a_job_that_fails_names_no_page(spark, tmp_path):
    store = state.Store(spark, str(tmp_path))
    rows = spark.createDataFrame([(0, "a.md", "A", "u", "s", "one\n\n"), (1, "b c%.md", "B", "u", None, "two"), (2, "a.md", "A", "u", "s", "three")], "position long, file_name string, title string, url string, summary string, content string")
    fails = F.udf(lambda x: 1 / 0 if x == "two" else x, "string")
    with pytest.raises(Exception):
        crawl.pages_written(rows.withColumn("content", fails("content")), store, "work", NOW)
    assert store.names("pages") == []
    assert crawl.pages_written(rows, store, "work", NOW) == 2
    assert [x for x in store.names("pages") if not x.startswith(".")] == ["a.md", "b c%.md"]
    assert (tmp_path / "pages" / "a.md").read_text().endswith("## Content\n\nthree\n") and (tmp_path / "pages" / "b c%.md").read_text().startswith("---\ntitle: B\n")


def test_the_pointer_is_replaced_in_one_step(spark, tmp_path):
    store = state.Store(spark, str(tmp_path))
    for text in ("one", "two"):
        store.write("CURRENT", text)
        assert store.read("CURRENT") == text
    assert store.names() == [".CURRENT.crc", "CURRENT"] or store.names() == ["CURRENT"]


def test_streaming_keeps_the_crawl_tables(spark, crawled, tmp_path):
    root, _ = crawled
    store = state.Generations(spark, root)
    before = {k: store.load(k, v).count() for k, v in (("visited", state.VISITED), ("failures", state.FAILURES), ("cache", state.CACHE), ("index", state.INDEX))}
    spark.createDataFrame([(1, "https://wiki.test/new", "<title>New</title><p>x</p>")], "page_id long, url string, html string").write.parquet(str(tmp_path / "in"))
    runner.run_index(spark, str(tmp_path / "in"), root, C, NOW, str(tmp_path / "ck")).awaitTermination()
    after = {k: store.load(k, v).count() for k, v in (("visited", state.VISITED), ("failures", state.FAILURES), ("cache", state.CACHE), ("index", state.INDEX))}
    assert after == before | {"index": before["index"] + 1}


def test_upload_reads_each_file_once_for_its_plan_and_sends_its_bytes(spark, tmp_path, monkeypatch):
    folder = tmp_path / "files"
    folder.mkdir()
    for i in range(5):
        (folder / f"f{i}.md").write_bytes(b"body %d \xff" % i)
    listed, sent = [], []
    held = state.files
    monkeypatch.setattr(state, "files", lambda *a: listed.append(a) or held(*a))

    class Client:
        def login(self):
            pass

        def start(self, paths, bodies):
            sent.append(dict(zip(paths, bodies)))
            if len(sent) == 2:
                raise services.ServiceError("broken off")
            return "t"

        def wait(self, task):
            return {"failed": [{"file_name": "f0.md", "error": "no"}, {"file_name": "other", "error": ""}]} if len(sent) == 1 else {}

    out = uploads.run(spark, [str(folder)], False, ["md"], str(tmp_path / "p.json"), Client(), NOW, 2)
    assert len(listed) == 1 and [len(x) for x in sent] == [2, 2, 1]
    assert all(body == open(path, "rb").read() for x in sent for path, body in x.items())
    assert out == {"total_candidates": 5, "pending_files": 5, "skipped_files": 0, "batches": 3, "total_success": 2, "total_failed": 3, "failed_items": 4, "uploaded_files": 2, "failed_files": 3}
    records = json.loads((tmp_path / "p.json").read_text())["files"]
    for path, r in records.items():
        assert r["sha256"] == hashlib.sha256(open(path, "rb").read()).hexdigest()
    assert sorted(r["status"] for r in records.values()) == ["failed"] * 3 + ["success"] * 2
    assert sorted(x.name for x in tmp_path.iterdir() if "work" in x.name or "batches" in x.name) == []


def test_a_broken_upload_goes_on_from_its_records(spark, tmp_path):
    folder = tmp_path / "files"
    folder.mkdir()
    for i in range(4):
        (folder / f"f{i}.md").write_text(f"{i}")
    sent = []

    class Client:
        stop = True

        def login(self):
            pass

        def start(self, paths, bodies):
            if self.stop and len(sent) == 1:
                raise KeyboardInterrupt
            sent.append(paths)
            return "t"

        def wait(self, task):
            return {}

    with pytest.raises(KeyboardInterrupt):
        uploads.run(spark, [str(folder)], False, ["md"], str(tmp_path / "p.json"), Client(), NOW, 2)
    Client.stop = False
    out = uploads.run(spark, [str(folder)], False, ["md"], str(tmp_path / "p.json"), Client(), NOW, 2)
    assert (out["skipped_files"], out["pending_files"]) == (2, 2) and [p.rsplit("/", 1)[-1] for x in sent for p in x] == [f"f{i}.md" for i in range(4)]


@pytest.fixture(scope="module")
def server():
    log = []

    class Handler(BaseHTTPRequestHandler):
        def reply(self, text, status=200):
            self.send_response(status)
            self.send_header("Content-Type", "text/html; charset=utf-8")
            self.end_headers()
            self.wfile.write(text.encode())

        def do_GET(self):
            log.append((self.path, dict(self.headers), b""))
            if self.path.startswith("/api.php"):
                self.reply(json.dumps({"parse": {"text": "<p>From the API</p>", "displaytitle": "Shown"}}))
            elif self.path.startswith("/api/kb"):
                self.reply(json.dumps({"status": "ok", "data": {"status": "completed", "result": {}}}))
            elif self.path == "/broken":
                self.reply("no", 500)
            else:
                self.reply("<html><title>A &amp; B</title><p>Grüße</p></html>")

        def do_POST(self):
            log.append((self.path, dict(self.headers), self.rfile.read(int(self.headers["Content-Length"]))))
            self.reply(json.dumps({"status": "ok", "data": {"task_id": 1, "token": "t"}}))

        def log_message(self, *a):
            pass

    made = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=made.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{made.server_port}", log
    made.shutdown()


def test_pages_come_over_http_with_a_fallback(spark, server, monkeypatch):
    monkeypatch.setenv("http_proxy", "http://127.0.0.1:1")  # is not asked
    base, log = server
    page, fallback = transport.PageFetcher(transport.Http(timeout=5)), transport.ApiFetcher(transport.Http(timeout=5), base)
    got = page(f"{base}/A")
    assert got["title"] == "A & B" and "Grüße" in got["content"] and log[-1][1]["User-Agent"].startswith("loomline") and log[-1][1]["Accept-Language"].startswith("zh-CN")
    assert '"displaytitle": "Shown"' in fallback(f"{base}/zh/A%20B")["answer"] and "page=A+B" in log[-1][0]
    urls = spark.createDataFrame([(f"{base}/broken",), (f"{base}/A",)], "url string")
    rows = {r["url"][-2:]: r for r in fetch.fetch_pages(urls, page, dataclasses.replace(C, fetch_attempts=1), fallback).collect()}
    assert [(r["success"], r["title"], r["fetch_error"]) for r in (rows["en"], rows["/A"])] == [(True, "Shown", None), (True, "A & B", None)]
    assert rows["en"]["content"] == "# Shown\n\nFrom the API"
    with pytest.raises(OSError):
        page(f"{base}/broken")
    assert pickle.loads(pickle.dumps(page)).http.timeout == 5


def test_upload_command(spark, server, tmp_path, capsys):
    base, log = server
    (tmp_path / "a.md").write_bytes(b"\x00bytes")
    args = ["upload", "--path", str(tmp_path / "a.md"), "--progress-file", str(tmp_path / "p.json"), "--kb-id", "k", "--kb-base-url", base, "--kb-username", "u", "--kb-password", "p"]
    assert cli.main(args) == 0
    path, headers, body = next(x for x in log if x[0] == "/api/kb/document/upload")
    assert headers["Content-Type"].startswith("multipart/form-data") and b'name="file0"; filename="a.md"' in body and b"\x00bytes" in body and b'name="kb_id"\r\n\r\nk' in body
    assert "候选文件: 1" in capsys.readouterr().out
    assert cli.main(args) == 0 and "已跳过: 1" in capsys.readouterr().out


def test_progress_is_logged_at_its_cadence(spark, tmp_path, caplog):
    config = dataclasses.replace(C, fetch_batch_size=2, log_every=4)
    page = lambda url: {"title": "t", "content": f"[a](/Q{int(url.rsplit('Q')[-1]) + 1})"}
    with caplog.at_level("INFO", "loomline"):
        crawl.run(spark, str(tmp_path), [f"https://wiki.test/Q{i}" for i in range(0, 1000, 100)], lambda urls: fetch.fetch_pages(urls, page, config), config, NOW, n=10)
    assert [r.args[0] for r in caplog.records if "scanned" in r.msg] == [4, 8]


def test_anchors_with_attributes_and_markup(spark):
    from loomline.functions import markdown as M

    cases = {
        '<a href="/A">a</a>': "[a](/A)", "<a class='x' href='/B' title=\"t\">b</a>": "[b](/B)", '<a href=/C rel=x><b>c</b> <i class="y">d</i></a>': "[c d](/C)",
        '<a name="n">no link</a>': '<a name="n">no link</a>', '<b>bold</b> <a href="/D">d</a>': "<b>bold</b> [d](/D)", '<abbr href="/E">e</abbr>': '<abbr href="/E">e</abbr>',
    }
    rows = spark.createDataFrame([(k,) for k in cases], "h string").select("h", M.anchors_to_markdown(F.col("h")).alias("m")).collect()
    assert {r["h"]: r["m"] for r in rows} == cases


@pytest.mark.parametrize(
    "unit, n, start, length",
    [
        ("<b>x</b>", 1_000_000, "<b>x</b><b>", 8_000_000), ("<a href='/A'>", 100_000, "<a href='/A'><a", 1_300_000), ("<script ", 100_000, "", 0), ("<", 500_000, "<<<", 500_000),
        ("<a href='/A'><i>x</i></a> ", 100_000, "[x](/A) [x](/A)", 800_000),
    ],
)
def test_anchors_take_linear_time(spark, unit, n, start, length):
    from loomline.functions import markdown as M

    got = spark.range(1).select(M.anchors_to_markdown(F.repeat(F.lit(unit), n)).alias("m")).select(F.length("m"), F.left("m", F.lit(len(start)))).first()
    assert tuple(got) == (length, start)


def test_anchors_with_much_in_their_labels(spark):
    from loomline.functions import markdown as M

    label = F.repeat(F.lit("<b>x</b>"), 200_000)
    page = F.concat(F.lit("<style>p</style><a href='/A'>"), label, F.lit("</a> <a href='/B'><img>b</a> <a href='/C'>open <a href='/D'>d</A><script>'<a href=\"/E\">e</a>'"))
    got = spark.range(1).select(M.anchors_to_markdown(page).alias("m")).select(F.regexp_replace("m", "x+", "x")).first()[0]
    assert got == "[x](/A) <a href='/B'><img>b</a> <a href='/C'>open [d](/D)"


def test_a_site_laid_out_once_gives_the_same_pages_from_few_chunks(spark, tmp_path):
    url = "https://wiki.test/P{}".format
    rows = [(i, url(i), f"<title>P{i}</title><a href='/P{i + 1}'>x</a>") for i in range(400)] + [(900, url(3) + "/", "<title>other</title>"), (901, None, "no url"), (902, url(902), None)]
    spark.createDataFrame(rows, "page_id long, url string, html string").write.parquet(f"{tmp_path}/in")
    corpus = spark.read.parquet(f"{tmp_path}/in")
    site = fetch.Site(corpus, f"{tmp_path}/site", "page_id", C, chunk_rows=20)
    asked = spark.createDataFrame([(url(i),) for i in [*range(40, 60), 3, 902, 5000]] + [(None,)], "url string")
    plain = lambda df: sorted(map(tuple, df.collect()), key=repr)
    assert plain(site(asked)) == plain(fetch.from_corpus(asked, corpus, C))
    few = site(asked.where("url LIKE '%/P4_' OR url LIKE '%/P5_'"))
    assert few.where("success").count() == 20
    few.collect()
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert len(site.pages.inputFiles()) >= 15 and 0 < len(re.search(r"chunk#\d+ (?:IN \(([^)]*)\)|= (\d+))", plan)[0].split(",")) <= 4


def test_page_files_need_no_rename_by_the_driver(spark, tmp_path, monkeypatch):
    store = state.Store(spark, str(tmp_path))
    monkeypatch.setattr(state.Store, "rename", lambda *a: 1 / 0)
    rows = spark.range(30).select(F.col("id").alias("position"), F.concat(F.lit("f"), F.col("id") % 20, F.lit(".md")).alias("file_name"), F.lit("T").alias("title"), F.lit("u").alias("url"), F.lit(None).cast("string").alias("summary"), F.concat(F.lit("c"), "id").alias("content"))
    assert [crawl.pages_written(rows, store, "work", NOW) for _ in range(2)] == [20, 20]
    assert sorted(x.name for x in (tmp_path / "pages").iterdir()) == sorted(f"f{i}.md" for i in range(20))
    assert (tmp_path / "pages" / "f3.md").read_text().endswith("\nc23\n") and spark.read.text(f"{tmp_path}/pages/f3.md").count() > 5
