"""SQL that checks the jobs: written for another engine, from the rules rather than from the jobs."""

from __future__ import annotations

import re
from functools import cache

from ..sources.shapes import DRIVER_TABLES, SHAPES
from . import channels, leads, loads, models, sales, sessions

CHECKS: dict[str, str] = {}
for _module in (sessions, channels, leads, loads, sales, models):
    CHECKS.update(_module.CHECKS)


@cache
def _text(name: str) -> str:
    return (CHECKS.get(name) or SHAPES[name]).strip()


def statement(name: str) -> str:
    """One check with everything it builds on, as a single statement over the driver tables."""
    ordered: dict[str, str] = {}

    def add(part: str) -> None:
        if part in ordered or (part in DRIVER_TABLES and part not in CHECKS):
            return
        text = _text(part)
        for needed in dict.fromkeys(re.findall(r"\{(\w+)\}", text)):
            add(needed)
        ordered[part] = re.sub(r"\{(\w+)\}", r"\1", text)

    add(name)
    head = ",\n".join(f"{part} AS (\n{text}\n)" for part, text in ordered.items())
    return f"WITH {head}\nSELECT * FROM {name}"
