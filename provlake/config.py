"""Settings from a file of NAME=value lines and the environment, and the paths that follow from them."""

from __future__ import annotations

import os
from collections.abc import Mapping
from pathlib import Path

PREFIX = "PROVLAKE_"
PATHS = {"manifests": "manifests", "raw": "raw", "dataset": "dataset", "work": "work"}


def read_settings(path: str | Path) -> dict[str, str]:
    """NAME=value lines; blanks, ``#`` lines and ``export`` are passed over, quotes around a value go; no file, no settings."""
    p, out = Path(path), {}
    if not p.is_file():
        return out
    for line in p.read_text(encoding="utf-8").splitlines():
        text = line.strip().removeprefix("export ").strip()
        name, sep, value = text.partition("=")
        if not sep or not name.strip() or name.startswith("#"):
            continue
        value = value.strip()
        if len(value) > 1 and value[0] == value[-1] and value[0] in "\"'":
            value = value[1:-1]
        out[name.strip()] = value
    return out


def settings(path: str | Path = ".env", environ: Mapping[str, str] | None = None) -> dict[str, str]:
    """The file's settings; the environment's own come before them."""
    env = os.environ if environ is None else environ
    return read_settings(path) | {k: v for k, v in env.items() if k.startswith(PREFIX)}


def paths(values: Mapping[str, str]) -> dict[str, str]:
    """Folders by name: their own setting, else below the root."""
    root = values.get(f"{PREFIX}ROOT", "data").rstrip("/")
    return {k: values.get(f"{PREFIX}{k.upper()}", f"{root}/{v}") for k, v in PATHS.items()}
