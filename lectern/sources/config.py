"""Settings from the environment and an optional file of NAME=value lines, with typed fallbacks."""

from __future__ import annotations

import os
import re
from collections.abc import Mapping
from dataclasses import dataclass
from urllib.parse import urlsplit


def read_env_file(path: str) -> dict[str, str]:
    """Later lines win; comments, blank lines and quotes around values are dropped. No file: nothing."""
    found: dict[str, str] = {}
    if os.path.exists(path):
        with open(path, encoding="utf-8") as lines:
            for line in lines:
                name, equals, value = line.strip().removeprefix("export ").partition("=")
                if equals and not name.startswith("#"):
                    value = value.strip()
                    found[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return found


def as_int(value: str | None, fallback: int) -> int:
    try:
        return int((value or "").strip())
    except ValueError:
        return fallback


def as_float(value: str | None, fallback: float) -> float:
    try:
        return float((value or "").strip())
    except ValueError:
        return fallback


def as_ints(value: str | None, low: int = 1, high: int = 66) -> tuple[int, ...]:
    """Comma-separated; elements that are no number or out of bounds are dropped."""
    parsed = (as_int(x, low - 1) for x in (value or "").split(",") if x.strip())
    return tuple(n for n in parsed if low <= n <= high)


@dataclass(frozen=True)
class Settings:
    base_url: str = ""
    version_suffix: str = ""
    workers: int = 3
    per_second: float = 2.0
    timeout: int = 30
    retries: int = 5
    base_delay_ms: int = 1000
    books: tuple[int, ...] = ()

    @classmethod
    def load(cls, env: Mapping[str, str] | None = None, path: str = ".env") -> Settings:
        """The environment wins over the file."""
        e = read_env_file(path) | dict(os.environ if env is None else env)
        d = cls()
        return cls(
            e.get("BASE_URL", d.base_url),
            e.get("VERSION_SUFFIX", d.version_suffix),
            as_int(e.get("WORKERS"), d.workers),
            as_float(e.get("REQUESTS_PER_SECOND"), d.per_second),
            as_int(e.get("TIMEOUT_SECONDS"), d.timeout),
            as_int(e.get("MAX_RETRIES"), d.retries),
            as_int(e.get("BASE_DELAY_MS"), d.base_delay_ms),
            as_ints(e.get("BOOKS")),
        )

    def problems(self, hosts: tuple[str, ...]) -> list[str]:
        """Why these settings can't be used; empty if they can."""
        url = urlsplit(self.base_url)
        checks = (
            (not self.base_url, "base_url is required"),
            (url.scheme != "https", "base_url must be https"),
            (url.netloc not in hosts, "host is not allowed"),
            (not re.fullmatch(r"[\w%.-]{1,64}", self.version_suffix), "version_suffix is malformed"),
            (not 1 <= self.workers <= 50, "workers must be 1 to 50"),
            (not 0 < self.per_second <= 20, "per_second must be above 0 and at most 20"),
            (not 5 <= self.timeout <= 120, "timeout must be 5 to 120"),
        )
        return [message for failed, message in checks if failed]
