"""Community definitions, settings and keys."""

from __future__ import annotations

import os
from dataclasses import dataclass, field
from pathlib import Path


@dataclass
class Community:
    """Who the corpus is about: names to look for, accession patterns, portals, which kinds are its own, and its passes."""

    name: str
    display_name: str = ""
    seed: str = ""
    group_by: str | None = None
    identity_strings: list[str] = field(default_factory=list)
    accession_patterns: dict[str, str] = field(default_factory=dict)
    own_kinds: list[str] = field(default_factory=list)
    portals: list[str] = field(default_factory=list)
    passes: list[str] = field(default_factory=list)

    @classmethod
    def of(cls, raw: dict) -> Community:
        corpus = raw.get("corpus") or {}
        lists = {k: list(raw.get(k) or []) for k in ("identity_strings", "own_kinds", "portals", "passes")}
        return cls(raw["community"], raw.get("display_name", ""), corpus.get("seed", ""), corpus.get("group_by"), accession_patterns=dict(raw.get("accession_patterns") or {}), **lists)

    @classmethod
    def load(cls, name_or_path: str, folder: str = "communities") -> Community:
        """From a YAML file, by path or by name in ``folder``."""
        import yaml

        path = Path(name_or_path)
        return cls.of(yaml.safe_load((path if path.exists() else Path(folder, f"{name_or_path}.yaml")).read_text()))


def read_env(path: str) -> dict[str, str]:
    """``KEY=value`` lines of a file, quotes removed; comments and blank lines are skipped."""
    pairs = (line.split("=", 1) for line in Path(path).read_text().splitlines() if "=" in line and not line.lstrip().startswith("#"))
    return {k.strip().removeprefix("export ").strip(): v.strip().strip("'\"") for k, v in pairs}


def key_of(name: str, env_file: str | None = None) -> str:
    """A key from the environment, else from the file; raises where it is in neither. It never enters a table."""
    value = os.environ.get(name) or (read_env(env_file).get(name) if env_file and Path(env_file).exists() else None)
    if not value:
        raise KeyError(f"{name} is not set")
    return value
