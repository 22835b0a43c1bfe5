"""Reports of schema differences as JSON, Markdown and console text (#17, #18, #22r)."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame

SEVERITIES = ("error", "warning", "info")
SHOWN = 10


def collected(differences: DataFrame) -> list[dict]:
    """Differences are as many as columns at most, so they fit the driver."""
    return [r.asDict(recursive=True) for r in differences.collect()]


#: The names in the JSON report.
NUMBERS = ("entities_in_dataverse", "entities_in_database", "entities_matched", "entities_missing_in_db", "entities_extra_in_db")
TOTALS = ("total_entities_checked", "total_differences", "errors", "warnings", "info")
SECTIONS = ("timestamp", "summary", "differences", "statistics")


def _numbers(expected: set[str], actual: set[str]) -> tuple[int, ...]:
    return len(expected), len(actual), len(expected & actual), len(expected - actual), len(actual - expected)


def as_json(found: list[dict], expected: set[str], actual: set[str], now: datetime | None = None) -> str:
    by = [sum(d["severity"] == s for d in found) for s in SEVERITIES]
    totals = dict(zip(TOTALS, (len(expected), len(found), *by), strict=True))
    values = ((now or datetime.now(timezone.utc)).isoformat(), totals, found, dict(zip(NUMBERS, _numbers(expected, actual), strict=True)))
    return json.dumps(dict(zip(SECTIONS, values, strict=True)), indent=2, ensure_ascii=False, default=str)


def as_markdown(found: list[dict], expected: set[str], actual: set[str], now: datetime | None = None) -> str:
    """A table of the differences by entity, most severe first."""
    wanted, held, both, missing, extra = _numbers(expected, actual)
    counts = ", ".join(f"{sum(d['severity'] == s for d in found)} {s}{'' if s == 'info' else 's'}" for s in SEVERITIES)
    lines = [f"# Schema check of {now or datetime.now(timezone.utc):%Y-%m-%d %H:%M} UTC", ""]
    lines += [f"The check {'fails' if any(d['severity'] == 'error' for d in found) else 'passes'}: {counts}.", ""]
    lines += [f"{wanted} entities are wanted and {held} stored; {both} are in both, {missing} are missing and {extra} are not wanted.", ""]
    if found:
        lines += ["| Entity | Severity | Difference | Details |", "|-|-|-|-|"]
    for d in sorted(found, key=lambda d: (d["entity"], SEVERITIES.index(d["severity"]))):
        details = "; ".join(f"{k} {v}" for k, v in (d["details"] or {}).items())
        cells = (d["entity"], d["severity"], f"{d['issue_type']}: {d['description']}", details)
        lines.append("| " + " | ".join(str(c).replace("|", "\\|") for c in cells) + " |")
    return "\n".join([*lines, ""])


def console(found: list[dict]) -> tuple[str, bool]:
    """(what to print, whether there is no error)."""
    errors = [d for d in found if d["severity"] == "error"]
    lines = [f"{s}: {sum(d['severity'] == s for d in found)}" for s in SEVERITIES]
    for d in (errors or found)[:SHOWN]:
        lines.append(f"  {d['entity']}: {d['description']}")
    more = len(errors or found) - SHOWN
    if more > 0:
        lines.append(f"  ... and {more} more")
    return "\n".join([*lines, "passed" if not errors else "failed"]), not errors
