"""Paths into JSON messages, split on the driver when a job is described."""

from __future__ import annotations

import re

from ..spec import SpecError

_STEP = re.compile(r"\.([^.\[\]]+)|\['([^']+)'\]|\[(\d+)\]")


def steps(path: str) -> tuple[str | int, ...]:
    """`$.a.b`, `a.b`, `$['a']['b']` and `$.a[0]` as tuples of names and indexes."""
    text = path.strip()
    if ".." in text or "*" in text or "?" in text:
        raise SpecError(f"path [{path}]: only names and indexes are supported")
    body = text[1:] if text.startswith("$") else "." + text
    found, at = [], 0
    while at < len(body):
        match = _STEP.match(body, at)
        if not match:
            raise SpecError(f"path [{path}] cannot be read at [{body[at:]}]")
        dotted, quoted, index = match.groups()
        found.append(int(index) if index is not None else dotted or quoted)
        at = match.end()
    if not found:
        raise SpecError(f"path [{path}] names no field")
    return tuple(found)


def render(parts: tuple[str | int, ...]) -> str:
    """The path in the form `get_json_object` takes."""
    return "$" + "".join(f"[{p}]" if isinstance(p, int) else f"['{p}']" for p in parts)
