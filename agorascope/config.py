"""Settings. What defines the corpus has no default and fails by name; mechanical knobs may default."""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass


class ConfigError(ValueError):
    """A required setting is missing or malformed; ``setting`` is its name."""

    def __init__(self, setting: str, problem: str):
        super().__init__(f"{setting}: {problem}")
        self.setting = setting


def subreddits(env: Mapping[str, str]) -> list[str]:
    found = [s.strip() for s in (env.get("SUBREDDITS") or "").split(",") if s.strip()]
    if not found:
        raise ConfigError("SUBREDDITS", "a list of communities is required")
    return found


def _json(env: Mapping[str, str], name: str, kind: type):
    try:
        value = json.loads(env.get(name) or "")
    except ValueError:
        raise ConfigError(name, "JSON is required") from None
    if not isinstance(value, kind):
        raise ConfigError(name, f"a JSON {kind.__name__} is required")
    return value


def sub_tags(env: Mapping[str, str]) -> dict[str, str]:
    """Community to tag; communities without one are the population."""
    return _json(env, "SUB_TAGS", dict)


def streams(env: Mapping[str, str]) -> list[dict]:
    """Keyword streams: name, query (or the older q) and kind, topic or community."""
    found = _json(env, "BSKY_STREAMS", list)
    if not found:
        raise ConfigError("BSKY_STREAMS", "at least one stream is required")
    out = []
    for s in found:
        query, kind = s.get("query") or s.get("q"), s.get("kind", "topic")
        if not s.get("name") or not query:
            raise ConfigError("BSKY_STREAMS", "each stream needs a name and a query")
        if kind not in ("topic", "community"):
            raise ConfigError("BSKY_STREAMS", f"unknown kind {kind}")
        out.append({"name": s["name"], "query": query, "kind": kind})
    return out


def stream_kinds(env: Mapping[str, str]) -> dict[str, str]:
    """Stream to kind; empty, never an error, if the setting is malformed."""
    try:
        return {s["name"]: s["kind"] for s in streams(env)}
    except (ConfigError, AttributeError):
        return {}


def comment_policy(env: Mapping[str, str]) -> str:
    policy = env.get("COMMENT_ANALYZE_POLICY", "")
    return policy if policy in ("ingest-only", "filtered", "all") else "ingest-only"


def _number(env: Mapping[str, str], default: int, *names: str) -> int:
    for name in names:
        try:
            n = int(env.get(name, ""))
        except ValueError:
            continue
        if n > 0:
            return n
    return default


@dataclass(frozen=True)
class Boilerplate:
    """Repeats (strictly more make boilerplate), and the least normalised lengths."""

    min_repeats: int = 5
    body_chars: int = 120
    title_chars: int = 40

    @staticmethod
    def of(env: Mapping[str, str]) -> Boilerplate:
        return Boilerplate(_number(env, 5, "BOILERPLATE_MIN_REPEATS"), _number(env, 120, "BOILERPLATE_MIN_CHARS_BODY", "BOILERPLATE_MIN_CHARS"), _number(env, 40, "BOILERPLATE_MIN_CHARS_TITLE"))


def comment_min_chars(env: Mapping[str, str]) -> int:
    return _number(env, 400, "COMMENT_MIN_CHARS")


def daily_cap(env: Mapping[str, str]) -> tuple[int, str | None]:
    """(cap, problem): 0 with a message if the setting is missing or no number."""
    value = env.get("DAILY_ANALYZE_CAP", "")
    if not value.strip():
        return 0, "DAILY_ANALYZE_CAP is not set"
    try:
        return max(0, int(value)), None
    except ValueError:
        return 0, f"DAILY_ANALYZE_CAP is not a number: {value}"
