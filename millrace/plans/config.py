"""Configuration of a run: languages, the paths of their sources and their stop words."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

import yaml

from ..functions.text import is_language, parse_stopwords
from ..sources.registry import REGISTRY


class ConfigError(Exception):
    """exit_code: 2 for files that can't be read, 24 for languages that aren't known, 1 for the rest."""

    def __init__(self, message: str, exit_code: int = 1):
        super().__init__(message)
        self.exit_code = exit_code


@dataclass
class LanguageConfig:
    sources: dict[str, str] = field(default_factory=dict)
    stopwords: list[str] = field(default_factory=list)
    #: Patterns of paths to leave out, by source.
    excluded: dict[str, list[str]] = field(default_factory=dict)

    def active(self) -> str:
        """The sources' names, for people."""
        return ", ".join(self.sources)


def expanded(path: str) -> str:
    """~ as the first part of a path is the home folder."""
    return os.path.expanduser(path) if path == "~" or path.startswith("~/") else path


def _read(path: str) -> dict:
    try:
        with open(path, encoding="utf-8") as f:
            data = yaml.safe_load(f)
    except OSError as e:
        raise ConfigError(f"can't read {path}: {e}") from e
    except yaml.YAMLError as e:
        raise ConfigError(f"{path} is not YAML: {e}", 2) from e
    return data if isinstance(data, dict) else {}


def read_logging(path: str, section: str = "logging") -> dict | None:
    """The section that says where messages go (file, console, thresholds), as the standard library's dictConfig has it."""
    given = _read(path).get(section)
    if given is not None and not isinstance(given, dict):
        raise ConfigError(f"{path}: section {section} is no mapping", 2)
    return given and {"version": 1, "disable_existing_loggers": False, **given}


def read_config(path: str, section: str = "corpus") -> dict[str, LanguageConfig]:
    """Languages by ISO 639-3 code, sorted."""
    data = _read(path)
    if not isinstance(data.get(section), dict):
        raise ConfigError(f"{path} has no section {section}", 2)
    out = {}
    for code, given in sorted(data[section].items()):
        if not (isinstance(code, str) and is_language(code)):
            raise ConfigError(f"{code} is no ISO 639-3 code", 24)
        given = given or {}
        unknown = set(given) - set(REGISTRY) - {"stopwords"}
        if unknown:
            raise ConfigError(f"{code}: unknown sources {', '.join(sorted(unknown))}", 2)
        sources, excluded = {}, {}
        for name in REGISTRY:
            # a path, or a mapping with it and what is left out there
            asked = given.get(name)
            some = asked if isinstance(asked, dict) else {"path": asked}
            if set(some) - {"path", "exclude"} or asked and not isinstance(some.get("path"), str):
                raise ConfigError(f"{code}: {name} is neither a path nor a mapping of path and exclude", 2)
            if some["path"]:
                sources[name] = expanded(some["path"])
            if patterns := some.get("exclude"):
                excluded[name] = [patterns] if isinstance(patterns, str) else list(map(str, patterns))
        out[code] = LanguageConfig(sources, parse_stopwords(given.get("stopwords")), excluded)
    return out
