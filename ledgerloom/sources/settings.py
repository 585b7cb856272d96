"""Settings from the environment or a mapping, checked before anything is read."""

from __future__ import annotations

import dataclasses
import datetime
import os
import re
from collections.abc import Mapping

OFFICE = re.compile(r"^\d{4}-\d{4}$")


class ConfigError(ValueError):
    """A setting that is missing or malformed; the message never holds a key."""


@dataclasses.dataclass(frozen=True)
class Settings:
    api_key: str = dataclasses.field(repr=False)
    office_code: str | None
    data_dir: str
    start_date: datetime.date | None
    end_date: datetime.date | None
    journals_per_page: int
    transactions_per_page: int

    def office(self) -> str:
        if not self.office_code:
            raise ConfigError("an office code is needed")
        return self.office_code


def load_settings(env: Mapping[str, str] | None = None, prefix: str = "LEDGER_", key_prefix: str = "") -> Settings:
    """prefix names the settings: API_KEY, OFFICE_CODE (dddd-dddd; placeholders of one digit count as unset), DATA_DIR,
    START_DATE, END_DATE, JOURNALS_PER_PAGE (1 to 10000), TRANSACTIONS_PER_PAGE (10 to 500)."""
    env = os.environ if env is None else env
    get = lambda n: env.get(prefix + n, "").strip()

    def day(name: str) -> datetime.date | None:
        try:
            return datetime.date.fromisoformat(get(name)) if get(name) else None
        except ValueError:
            raise ConfigError(f"{prefix}{name} must be a date") from None

    def number(name: str, default: int, low: int, high: int) -> int:
        text = get(name)
        if text and not re.fullmatch(r"[+-]?\d+", text):
            raise ConfigError(f"{prefix}{name} must be a whole number")
        value = int(text) if text else default
        if not low <= value <= high:
            raise ConfigError(f"{prefix}{name} must be {low} to {high}")
        return value

    key = get("API_KEY")
    if not key:
        raise ConfigError(f"{prefix}API_KEY is not set")
    if "REPLACE" in key or "xxxx" in key or not key.startswith(key_prefix) or (key_prefix and key.count(key_prefix) > 1):
        raise ConfigError(f"{prefix}API_KEY is no key")
    office = get("OFFICE_CODE") or None
    if office and not OFFICE.match(office):
        raise ConfigError(f"{prefix}OFFICE_CODE must look like 1234-5678")
    if office and len(set(office) - {"-"}) == 1:
        office = None
    return Settings(key, office, get("DATA_DIR") or "data", day("START_DATE"), day("END_DATE"), number("JOURNALS_PER_PAGE", 1000, 1, 10_000), number("TRANSACTIONS_PER_PAGE", 500, 10, 500))
