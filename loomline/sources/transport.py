"""HTTP by the standard library, as callables that travel to executors."""

from __future__ import annotations

import html as entities
import json
import re
import urllib.parse
import urllib.request
import uuid
from dataclasses import dataclass, field

from loomline.config import CrawlConfig
from loomline.functions import markdown as M

#: Accept-Language is a fixed value.
HEADERS = {"User-Agent": "loomline/1", "Accept": "text/html,application/json;q=0.9,*/*;q=0.5", "Accept-Language": "zh-CN,zh;q=0.9,en;q=0.6"}


@dataclass
class Http:
    """Requests with the same timeout and headers; a timeout of 0 or less is none.  Proxies of the environment are not asked.

    As ``send(method, path, headers, body)`` it serves the clients of ``services``: a body with ``bodies`` is
    sent as a form with files, other bodies as JSON, or as a form if the headers say so.
    """

    base: str = ""
    timeout: float = 30.0
    headers: dict = field(default_factory=lambda: dict(HEADERS))

    def get(self, url: str) -> str:
        return self.request("GET", url, {}, None)

    def request(self, method: str, url: str, headers: dict, data: bytes | None) -> str:
        asked = urllib.request.Request(url, data=data, headers=self.headers | headers, method=method)
        more = {"timeout": self.timeout} if self.timeout > 0 else {}
        direct = urllib.request.build_opener(urllib.request.ProxyHandler({}))
        with direct.open(asked, **more) as answer:
            return answer.read().decode(answer.headers.get_content_charset() or "utf-8", "replace")

    def __call__(self, method: str, path: str, headers: dict, body: object) -> str:
        data, headers = encoded(headers, body)
        return self.request(method, f"{self.base.rstrip('/')}{path}", headers, data)


def encoded(headers: dict, body: object) -> tuple[bytes | None, dict]:
    """A body's bytes, and the headers with their kind."""
    if body is None:
        return None, headers
    if isinstance(body, dict) and body.get("bodies") is not None:
        return with_files({k: v for k, v in body.items() if k not in ("files", "bodies")}, body["files"], body["bodies"], headers)
    if "form" in headers.get("Content-Type", ""):
        return urllib.parse.urlencode(body).encode(), headers
    return json.dumps(body, ensure_ascii=False).encode(), headers | {"Content-Type": "application/json"}


def with_files(fields: dict, paths: list[str], bodies: list[bytes], headers: dict) -> tuple[bytes, dict]:
    """A multipart form: the fields, then each file under file0, file1 and so on with its name."""
    edge = uuid.uuid4().hex
    parts = [f'--{edge}\r\nContent-Disposition: form-data; name="{k}"\r\n\r\n{v}\r\n'.encode() for k, v in fields.items()]
    for i, (path, content) in enumerate(zip(paths, bodies)):
        name = path.rsplit("/", 1)[-1].replace('"', "%22")
        parts += [f'--{edge}\r\nContent-Disposition: form-data; name="file{i}"; filename="{name}"\r\nContent-Type: application/octet-stream\r\n\r\n'.encode(), content, b"\r\n"]
    return b"".join([*parts, f"--{edge}--\r\n".encode()]), headers | {"Content-Type": f"multipart/form-data; boundary={edge}"}


@dataclass
class PageFetcher:
    """``fetch(url)`` for ``fetch.fetch_pages``: a page's title and Markdown."""

    http: Http

    def __call__(self, url: str) -> dict:
        html = self.http.get(url)
        title = re.search(r"(?is)<title\b[^>]*>(.*?)</title>", html)
        title = " ".join(entities.unescape(title[1]).split()) if title else ""
        return {"title": title, "content": M.to_markdown(html, title)}


@dataclass
class ApiFetcher:
    """The fallback: asks the site's parse API for a page; ``fetch.fetch_pages`` reads its answer."""

    http: Http
    origin: str

    def __call__(self, url: str) -> dict:
        last = urllib.parse.urlsplit(url).path.rstrip("/").split("/")[-1]
        fields = {"action": "parse", "format": "json", "formatversion": 2, "prop": "text|displaytitle", "page": urllib.parse.unquote(last) or "page"}
        return {"answer": self.http.get(f"{self.origin}/api.php?{urllib.parse.urlencode(fields)}")}


def fetchers(config: CrawlConfig) -> tuple[PageFetcher, ApiFetcher]:
    http = Http(timeout=config.fetch_timeout)
    return PageFetcher(http), ApiFetcher(http, config.origin)
