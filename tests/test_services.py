"""Services with a stub transport."""

import json

import pytest

from loomline.plans import uploads
from loomline.sources import services


def answers(log, fail=()):
    state = {"polls": 0}

    def send(method, path, headers, body):
        log.append((method, path, body))
        if path == "/auth/login":
            return json.dumps({"status": "ok", "data": {"token": "t"}})
        if path == "/kb/document/upload":
            state["files"] = [p.rsplit("/", 1)[-1] for p in body["files"]]
            return json.dumps({"status": "ok", "data": {"task_id": 7}})
        state["polls"] += 1
        progress = {"file_index": 0, "file_total": 1, "stage": "s", "current": 1, "total": 4}
        if state["polls"] % 3:
            return json.dumps({"status": "ok", "data": {"status": "running", "progress": progress}})
        bad = [{"file_name": f, "error": "no"} for f in state["files"] if f in fail]
        return json.dumps({"status": "ok", "data": {"status": "completed", "progress": progress, "result": {"failed": bad}}})

    return send


def test_upload_run(spark, tmp_path):
    for name in ("a.md", "b.md", "c.txt"):
        (tmp_path / name).write_text(name)
    log, progress = [], str(tmp_path / "p.json")
    client = services.KnowledgeBase(answers(log, {"b.md"}), "kb", username="u", password="p", say=lambda x: None, sleep=lambda s: None)
    first = uploads.run(spark, [str(tmp_path)], False, ["md"], progress, client, "now", 1)
    assert (first["pending_files"], first["total_success"], first["total_failed"], first["batches"]) == (2, 1, 1, 2) and uploads.exit_status(first) == 2
    assert client.lines == ["1/1 s 25.0%"]
    client.send = answers(log)
    second = uploads.run(spark, [str(tmp_path)], False, ["md"], progress, client, "later", 20)
    assert (second["pending_files"], second["skipped_files"], second["total_failed"]) == (1, 1, 0) and uploads.exit_status(second) == 0
    assert uploads.run(spark, [str(tmp_path)], False, ["md"], progress, client, "later")["pending_files"] == 0
    for name in ("d.md", "e.md", "f.md"):
        (tmp_path / name).write_text(name)
    log.clear()
    client.send = answers(log)
    third = uploads.run(spark, [str(tmp_path)], False, ["md"], progress, client, "later", 1)
    sent = [b["files"][0].rsplit("/", 1)[-1] for _, p, b in log if p.endswith("/upload")]
    assert third["total_success"] == third["batches"] == 3 and sent == ["d.md", "e.md", "f.md"]
    with pytest.raises(ValueError):
        uploads.run(spark, [str(tmp_path)], False, ["pdf"], progress, client, "now")


def test_envelope_and_login():
    assert services.unwrap('{"status": "ok"}') == {}
    for text in ("x", "[]", '{"status": "no", "message": "m"}'):
        with pytest.raises(services.ServiceError):
            services.unwrap(text)
    with pytest.raises(services.ServiceError):
        services.KnowledgeBase(lambda *a: "", "kb").login()


def test_summaries_and_messages():
    send = lambda m, p, h, b: json.dumps({"choices": [{"message": {"content": " a\n b "}}], "usage": {"total_tokens": 3}})
    assert services.summariser(send, "m", 0)("t", "e") == ("a b", 0, 0, 3)
    with pytest.raises(services.ServiceError):
        services.summariser(lambda *a: '{"choices": [{"message": {}}]}', "m", 0)("t", "e")
    assert services.notify(send, "", "t", "x") is False and services.notify(send, "k", "t", "x") is True


def test_full_run(spark):
    from loomline.plans import full_run
    from loomline.plans.crawl import RunStats

    sent = []
    say = lambda title, text: sent.append((title, text))
    totals = {"total_candidates": 3, "pending_files": 2, "skipped_files": 1, "batches": 1, "total_success": 2, "total_failed": 0, "failed_items": 0}
    text = full_run.run(spark, lambda: RunStats(scanned=4), lambda: totals, say, "m", "now")
    assert "扫描: 4" in text and "候选文件: 3" in text and sent == [("crawl done", text)]
    with pytest.raises(RuntimeError):
        full_run.run(spark, RunStats, lambda: totals | {"total_failed": 1}, say, "m", "now", notify_on_failure=True)
    assert sent[-1][0] == "crawl failed" and "错误: 1 uploads failed" in sent[-1][1]
    with pytest.raises(ZeroDivisionError):
        full_run.run(spark, lambda: 1 / 0, None, say, "m", "now")
    assert len(sent) == 2


def test_plan_upload_lists_every_file(spark, tmp_path, capsys):
    from loomline import cli

    for i in range(1100):
        (tmp_path / f"p{i:04d}.md").write_text(str(i))
    assert cli.main(["plan-upload", "--path", str(tmp_path), "--progress-file", str(tmp_path / "progress.json")]) == 0
    out = capsys.readouterr().out.splitlines()
    assert "path" in out[0].split("\t") and sum(".md" in line for line in out[1:]) == 1100
