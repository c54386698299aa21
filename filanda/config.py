"""Settings of a run: given values, then a YAML-like file of plain keys, then the environment."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, fields

_LINE = re.compile(r"^\s*([A-Za-z_][\w-]*)\s*:\s*(.*?)\s*(?:#.*)?$")
_VARIABLE = re.compile(r"\$\{(\w+)(?::-([^}]*))?\}|\$(\w+)")


class MissingSetting(ValueError):
    """A setting that nothing gives."""


def expand(text: str, environment: dict[str, str] | None = None) -> str:
    """``$NAME``, ``${NAME}`` and ``${NAME:-default}`` and a leading ``~`` by the environment; an unknown name without default stays as it is."""
    env = os.environ if environment is None else environment
    done = _VARIABLE.sub(lambda m: env.get(m[1] or m[3], m[2] if m[2] is not None else m[0]), text)
    return env.get("HOME", "~") + done[1:] if done == "~" or done.startswith("~/") else done


def read_plain(text: str) -> dict[str, str]:
    """The top-level ``key: value`` lines of a file, quotes taken off; nested and list lines are left out."""
    out = {}
    for line in text.splitlines():
        m = _LINE.match(line)
        if m and not line[:1].isspace() and m[2]:
            out[m[1].replace("-", "_")] = m[2].strip("\"'")
    return out


@dataclass(frozen=True)
class Config:
    """Where a run reads and writes. Each may be given, stand in the file, or in the environment as ``FILANDA_<NAME>``."""

    source: str
    output: str
    taxonomy: str = ""

    @classmethod
    def load(cls, file_text: str = "", environment: dict[str, str] | None = None, **given: str | None) -> Config:
        env = dict(os.environ if environment is None else environment)
        plain = read_plain(file_text)
        values = {}
        for f in fields(cls):
            found = given.get(f.name) or plain.get(f.name) or env.get(f"FILANDA_{f.name.upper()}") or ("" if f.name == "taxonomy" else None)
            if found is None:
                raise MissingSetting(f"{f.name}: neither given, nor in the file, nor in FILANDA_{f.name.upper()}")
            values[f.name] = expand(found, env)
        return cls(**values)
