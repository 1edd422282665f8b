"""Driver-side helpers: flags, instants, names."""

from __future__ import annotations

import hashlib
import re
from datetime import UTC, datetime

#: Words for flags in configurations.
TRUE, FALSE = {"1", "true", "yes", "y", "on"}, {"0", "false", "no", "n", "off"}


def flag(value: object, default: bool | None = None) -> bool:
    """A flag from what a configuration holds; the default, if there is one, for what says neither."""
    word = str(value).strip().lower()
    if word in TRUE | FALSE:
        return word in TRUE
    if default is None:
        raise ValueError(f"not a flag: {value!r}")
    return default


def instant(text: str | None) -> datetime | None:
    """An ISO date or instant; without a zone it is in UTC. None for a blank text."""
    if not text or not text.strip():
        return None
    found = datetime.fromisoformat(text.strip().replace("Z", "+00:00"))
    return found.replace(tzinfo=UTC) if found.tzinfo is None else found.astimezone(UTC)


def iso(at: datetime) -> str:
    return at.astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def safe_name(text: str) -> str:
    """A run identifier that is fit for a path."""
    return re.sub(r"[^a-zA-Z0-9._-]", "_", text)


def md5(text: str) -> str:
    return hashlib.md5(text.encode()).hexdigest()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
