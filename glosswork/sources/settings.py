"""Settings: process environment over an env file, then defaults. Blank means unset; bad values are errors."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass

# Keys, their kinds and defaults. None: required.
KEYS = {
    "GLOSSWORK_DATA": ("text", None),
    "GLOSSWORK_WAREHOUSE": ("text", "warehouse"),
    "GLOSSWORK_MASTER": ("text", "local[*]"),
    "GLOSSWORK_SHUFFLE_PARTITIONS": ("count", "200"),
    "GLOSSWORK_PAGE_SIZE": ("count", "30"),
    "GLOSSWORK_SUGGESTIONS": ("count", "8"),
    "GLOSSWORK_BIND": ("text", "127.0.0.1:8080"),
    "GLOSSWORK_BASE_URL": ("text", "http://localhost:8080"),
    "GLOSSWORK_LOG": ("text", "info"),
    "GLOSSWORK_PASSWORD": ("secret", ""),
}


class SettingsError(ValueError):
    pass


def parse_env(text: str) -> dict[str, str]:
    """KEY=value lines; comments, blank lines, ``export`` and matching quotes are understood."""
    out = {}
    for n, line in enumerate(text.splitlines(), 1):
        line = line.strip()
        if not line or line.startswith("#"):
            continue
        m = re.fullmatch(r"(?:export\s+)?([A-Za-z_][A-Za-z0-9_]*)\s*=\s*(.*)", line)
        if not m:
            raise SettingsError(f"line {n} is no KEY=value")
        value = m[2]
        if len(value) >= 2 and value[0] == value[-1] and value[0] in "'\"":
            value = value[1:-1]
        out[m[1]] = value
    return out


@dataclass(frozen=True)
class Settings:
    values: dict[str, str]

    def __getitem__(self, key: str) -> str:
        return self.values[key]

    def count(self, key: str) -> int:
        return int(self.values[key])

    def scrub(self, message: str) -> str:
        """The message without the password."""
        secret = self.values.get("GLOSSWORK_PASSWORD", "")
        return message.replace(secret, "***") if secret else message


def load(env_text: str = "", environ: dict[str, str] | None = None) -> Settings:
    layers = [dict(os.environ) if environ is None else environ, parse_env(env_text)]
    out = {}
    for key, (kind, default) in KEYS.items():
        value = next((v.strip() for layer in layers if (v := layer.get(key)) is not None and v.strip()), default)
        if value is None:
            raise SettingsError(f"{key} is required")
        if kind == "count" and not re.fullmatch(r"[1-9][0-9]*", value):
            raise SettingsError(f"{key} is no positive number: {value!r}")
        out[key] = value
    return Settings(out)
