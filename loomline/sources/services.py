"""Clients of outside services.  The transport is injected, so nothing here needs a network.

``send(method, path, headers, body) -> str`` gives the answer's text or raises.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from dataclasses import dataclass, field

from loomline.operators.pacing import Limiter

Send = Callable[[str, str, dict, object], str]


class ServiceError(RuntimeError):
    pass


def unwrap(text: str) -> dict:
    """The data of an answer whose status is ok; anything else is an error."""
    try:
        answer = json.loads(text)
    except ValueError:
        raise ServiceError("the answer is no JSON") from None
    if not isinstance(answer, dict) or answer.get("status") != "ok":
        answer = answer if isinstance(answer, dict) else {}
        raise ServiceError(answer.get("message") or answer.get("error") or "request failed")
    return answer.get("data") or {}


@dataclass
class KnowledgeBase:
    """Uploads batches of files as tasks and waits for their ends."""

    send: Send
    kb_id: str
    token: str = ""
    username: str = ""
    password: str = ""
    chunk_size: int = 512
    chunk_overlap: int = 50
    batch_size: int = 32
    tasks_limit: int = 3
    max_retries: int = 3
    poll_interval: float = 1.5
    say: Callable[[str], None] = print
    sleep: Callable[[float], None] = time.sleep
    lines: list[str] = field(default_factory=list)

    def login(self) -> None:
        if self.token:
            return
        if not (self.username and self.password):
            raise ServiceError("a token, or a user name and a password are needed")
        self.token = unwrap(self.send("POST", "/auth/login", {}, {"username": self.username, "password": self.password})).get("token") or ""
        if not self.token:
            raise ServiceError("the login gave no token")

    def start(self, paths: list[str], bodies: list[bytes] | None = None) -> str:
        """Starts a task for files; ``bodies`` are their contents, in the same order."""
        numbers = {k: str(getattr(self, k)) for k in ("chunk_size", "chunk_overlap", "batch_size", "tasks_limit", "max_retries")}
        data = unwrap(self.send("POST", "/kb/document/upload", {"Authorization": f"Bearer {self.token}"}, {"kb_id": self.kb_id, "files": paths, "bodies": bodies, **numbers}))
        if not data.get("task_id"):
            raise ServiceError("the upload gave no task id")
        return str(data["task_id"])

    def wait(self, task: str) -> dict:
        """The task's result: success_count, failed_count, failed."""
        while True:
            data = unwrap(self.send("GET", f"/kb/document/upload/progress?task_id={task}", {"Authorization": f"Bearer {self.token}"}, None))
            line = progress_line(data.get("progress") or {})
            if not self.lines or self.lines[-1] != line:
                self.lines.append(line)
                self.say(line)
            if data.get("status") == "completed":
                return data.get("result") or {}
            if data.get("status") == "failed":
                raise ServiceError(data.get("error") or "the task failed")
            self.sleep(max(self.poll_interval, 0.2))


def progress_line(progress: dict) -> str:
    total = float(progress.get("total") or 100)
    percent = max(0.0, min(100.0, float(progress.get("current") or 0) / total * 100)) if total > 0 else 0.0
    return f"{int(progress.get('file_index') or 0) + 1}/{int(progress.get('file_total') or 0)} {progress.get('stage') or ''} {percent:.1f}%"


@dataclass
class Summariser:
    """A summary service for ``summary.summarise`` over a chat endpoint; empty answers are errors.

    It travels to executors: its limiter is made where it is first called, and ``shared_by`` deals its rate out.
    """

    send: Send
    model: str
    qps: float
    limit: int = 65536

    def shared_by(self, tasks: int) -> Summariser:
        return Summariser(self.send, self.model, self.qps / tasks, self.limit)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "limiter"}

    def __call__(self, title: str, excerpt: str) -> tuple:
        if "limiter" not in self.__dict__:
            self.limiter = Limiter(self.qps)
        self.limiter.wait()
        messages = [{"role": "system", "content": "Summarise the page in a few sentences."}, {"role": "user", "content": f"{title}\n\n{excerpt[: self.limit]}"}]
        answer = json.loads(self.send("POST", "/chat/completions", {}, {"model": self.model, "messages": messages}))
        text = " ".join((answer["choices"][0]["message"].get("content") or "").split())
        if not text:
            raise ServiceError("an empty summary")
        usage = answer.get("usage") or {}
        return text, *(int(usage.get(k) or 0) for k in ("prompt_tokens", "completion_tokens", "total_tokens"))


def summariser(send: Send, model: str, qps: float, limit: int = 65536) -> Summariser:
    return Summariser(send, model, qps, limit)


def notify(send: Send, key: str, title: str, text: str) -> bool:
    """Posts a message; without a key nothing is sent, and errors don't end the run."""
    if not key:
        return False
    try:
        send("POST", f"/{key}.send", {"Content-Type": "application/x-www-form-urlencoded"}, {"title": title, "desp": text})
        return True
    except Exception:
        return False
