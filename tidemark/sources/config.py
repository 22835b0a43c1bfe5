"""Configuration from JSON files and the environment (#15, #16)."""

from __future__ import annotations

import json
import os
from collections.abc import Mapping
from dataclasses import dataclass
from pathlib import Path

from ..model import EntityConfig

#: The names of the settings.
REQUIRED = ("DATAVERSE_API_URL", "DATAVERSE_CLIENT_ID", "DATAVERSE_CLIENT_SECRET", "DATAVERSE_SCOPE")


@dataclass(frozen=True)
class Settings:
    api_url: str
    client_id: str
    client_secret: str
    scope: str


def env_file(path: str | Path) -> dict[str, str]:
    """NAME=value lines; blank lines and those that start with # are skipped, quotes around a value go."""
    out = {}
    for line in Path(path).read_text(encoding="utf-8").splitlines():
        name, sep, value = line.strip().removeprefix("export ").partition("=")
        if sep and not name.startswith("#"):
            value = value.strip()
            out[name.strip()] = value[1:-1] if len(value) > 1 and value[0] == value[-1] and value[0] in "'\"" else value
    return out


def load_settings(path: str | None = None, environment: Mapping[str, str] | None = None) -> Settings:
    """From the named file, else `.env` here, else the environment; what the environment sets wins over a file."""
    own = dict(os.environ if environment is None else environment)
    file = path or (".env" if Path(".env").exists() else None)
    found = {**(env_file(file) if file else {}), **own}
    if missing := [n for n in REQUIRED if not found.get(n)]:
        raise ValueError(f"these settings are not set: {', '.join(missing)}")
    url, *rest = (found[n] for n in REQUIRED)
    return Settings(url.rstrip("/"), *rest)


def _json(path: str) -> object:
    with open(path, encoding="utf-8") as f:
        return json.load(f)


def load_entities(path: str) -> list[EntityConfig]:
    """{"entities": [{"name", "api_name", "filtered", "description"}, ...]}; api_name is the name with an s unless given."""
    data = _json(path)
    rows = data.get("entities") if isinstance(data, dict) else None
    if not isinstance(rows, list):
        raise ValueError(f"{path}: 'entities' must be a list")
    out = []
    for r in rows:
        if not isinstance(r, dict) or not isinstance(r.get("name"), str):
            raise ValueError(f"{path}: each entity needs a name")
        out.append(EntityConfig(r["name"], r.get("api_name") or f"{r['name']}s", bool(r.get("filtered", False)), r.get("description", "")))
    return out


def load_option_sets(path: str | None) -> dict[str, list[str]]:
    """{entity: [fields]}; none without a file."""
    if path is None:
        return {}
    data = _json(path)
    if not isinstance(data, dict) or not all(isinstance(v, list) and all(isinstance(x, str) for x in v) for v in data.values()):
        raise ValueError(f"{path}: must map entities to lists of fields")
    return data
