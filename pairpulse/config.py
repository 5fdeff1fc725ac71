"""Code lists and switches. One frozen object is passed to every layer."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

# The focus countries and their readable names.
COUNTRY_NAMES = {
    "USA": "United States",
    "CHN": "China",
    "RUS": "Russia",
    "GBR": "United Kingdom",
    "FRA": "France",
    "DEU": "Germany",
    "UKR": "Ukraine",
    "ISR": "Israel",
    "PSE": "Palestine",
    "IRN": "Iran",
    "SYR": "Syria",
    "IND": "India",
    "BRA": "Brazil",
    "MEX": "Mexico",
    "TUR": "Turkey",
    "COD": "Democratic Republic of the Congo",
    "RWA": "Rwanda",
    "ETH": "Ethiopia",
    "ERI": "Eritrea",
    "PAK": "Pakistan",
    "EGY": "Egypt",
    "VEN": "Venezuela",
    "ARG": "Argentina",
    "PRK": "North Korea",
    "TWN": "Taiwan",
    "KOR": "South Korea",
}

# Root event codes counted as unrest (demand, threaten, protest).
UNREST_ROOT_CODES = ("10", "13", "14")

# Fixed value: the actor type code of a government.
GOVERNMENT_TYPE = "GOV"

# Columns a silver row cannot do without.
ESSENTIAL_COLUMNS = ("event_date", "Actor1CountryCode", "Actor2CountryCode", "EventRootCode")

# First day of the history and the source's outage (both ends included).
HISTORY_START = dt.date(2025, 1, 1)
OUTAGE_FIRST, OUTAGE_LAST = dt.date(2025, 6, 15), dt.date(2025, 7, 1)

# A slot file is <prefix>yyyyMMddHHmmss<suffix>, one per quarter of an hour.
SLOT_SUFFIX = ".export.CSV.zip"


def outage_days() -> tuple[dt.date, ...]:
    """Days for which the source published nothing."""
    n = (OUTAGE_LAST - OUTAGE_FIRST).days + 1
    return tuple(OUTAGE_FIRST + dt.timedelta(days=i) for i in range(n))


@dataclass(frozen=True)
class EngineConfig:
    """Everything the layers may be asked to do differently.

    ``null_type_is_nongov``  count an actor without a type as non-government (by
                             default such an event is in none of the three flows);
    ``measure_type``         SQL type of the gold counts. ``int`` is the published
                             schema and fails on overflow; ``bigint`` is for volumes
                             where one pair-month passes 2^31 - 1;
    ``dedup_scope``          ``file_date`` keeps one row per id and file date,
                             ``global`` one row per id, from its earliest file date.
    """

    country_names: dict[str, str] = field(default_factory=lambda: dict(COUNTRY_NAMES))
    unrest_root_codes: tuple[str, ...] = UNREST_ROOT_CODES
    government_type: str = GOVERNMENT_TYPE
    essential_columns: tuple[str, ...] = ESSENTIAL_COLUMNS
    null_type_is_nongov: bool = False
    measure_type: str = "int"
    dedup_scope: str = "file_date"
    slot_prefix: str = ""

    def __post_init__(self) -> None:
        if self.measure_type not in ("int", "bigint"):
            raise ValueError(f"measure_type must be int or bigint, not {self.measure_type}")
        if self.dedup_scope not in ("file_date", "global"):
            raise ValueError(f"dedup_scope must be file_date or global, not {self.dedup_scope}")
        # The list becomes an IN predicate, a literal array and a broadcast table.
        if not 1 <= len(self.country_names) <= 1024:
            raise ValueError("between 1 and 1024 focus countries are supported")

    @property
    def focus_countries(self) -> list[str]:
        return list(self.country_names)
