"""Configuration of a crawl: everything that is about one site is a parameter."""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class CrawlConfig:
    site_host: str = "wiki.test"
    site_name: str = "Wiki"
    #: Substrings of a URL that rule it out as a page.
    url_hints: tuple[str, ...] = ("/load.php", "/api.php", "/rest.php", "index.php?", "action=edit", "redlink=1")
    #: Namespaces that rule a decoded URL out; the site's own comes from its name.
    namespaces: tuple[str, ...] = ("Special:", "Template:", "Category:", "User:", "Talk:", "File:")
    #: "rewrite": links to other hosts become links to the site; "drop": they are left out.
    foreign_hosts: str = "rewrite"
    excerpt_chars: int = 65536
    least_llm_chars: int = 1024
    summary_chars: int = 220
    per_run: int = 100
    fetch_workers: int = 8
    fetch_batch_size: int = 0
    fetch_attempts: int = 3
    fetch_timeout: float = 30.0
    wiki_qps: float = 1.0
    llm_qps: float = 3.0
    retry_base_seconds: float = 30.0
    retry_max_seconds: float = 3600.0
    retry: int = 0
    target_total: int = 0
    files_per_task: int = 20
    #: Tasks that ask the summary service at once.
    summary_tasks: int = 4
    log_every: int = 10
    model: str = "none"

    @property
    def origin(self) -> str:
        return f"https://{self.site_host}"

    @property
    def path_hints(self) -> tuple[str, ...]:
        return (*self.namespaces, f"{self.site_name}:")

    @property
    def boilerplate(self) -> tuple[str, ...]:
        """Patterns of the site's standing bullets and of its jump link."""
        return (
            r"\*\s*欢迎加入\[本站QQ群\][^\n]*",
            r"\*\s*若发现内容有误[^\n]*",
            r"\*\s*想要为" + re.escape(self.site_name) + r"做出更多贡献[^\n]*",
            r"\[跳转到导航\][^\n]*",
        )

    @property
    def batch_size(self) -> int:
        """URLs of one fetch batch: twice the workers unless set."""
        return self.fetch_batch_size or 2 * self.fetch_workers
