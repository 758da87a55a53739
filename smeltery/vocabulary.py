"""Words that steer schema-agnostic decisions, with their default values."""

from __future__ import annotations

from dataclasses import dataclass

# Texts that mean "missing", compared after trim and lower.
MISSING_TOKENS = ("", "na", "n/a", "null", "none", "..", ":")

# Name tokens that mark a text column as a candidate number.
NUMERIC_TOKENS = (
    "entry", "entries", "exit", "exits", "interchange", "interchanges",
    "passenger", "passengers", "usage", "journey", "journeys", "total",
    "easting", "northing", "latitude", "longitude",
)

# Names that identify an entity on their own.
IDENTITY_NAMES = ("station", "station_name", "station_code", "crs", "nlc")

# Name parts of a business metric.
METRIC_PARTS = (
    "entry", "entries", "exit", "exits", "interchange", "interchanges",
    "usage", "passenger", "passengers", "journey", "journeys", "footfall",
    "total",
)

# Name parts that rule a metric out.
NON_METRIC_PARTS = (
    "station_key", "code", "crs", "nlc", "easting", "northing", "latitude",
    "longitude", "year_start", "year_end", "financial_year", "rank",
)

# Name parts of the primary metric, best first.
PRIMARY_PARTS = (
    "entries_and_exits", "entries_exits", "entry_and_exit", "entry_exit",
    "total_entries", "entries", "exits", "usage", "passenger", "journey",
    "interchange",
)


@dataclass(frozen=True)
class Vocabulary:
    """Names and hints used when a table's columns are not known in advance.

    ``entity`` prefixes every produced column (``station_key``,
    ``station_usage_rank``, ...), so another domain only needs another word.
    """

    entity: str = "station"
    missing_tokens: tuple[str, ...] = MISSING_TOKENS
    numeric_tokens: tuple[str, ...] = NUMERIC_TOKENS
    identity_names: tuple[str, ...] = IDENTITY_NAMES
    max_identity_columns: int = 4
    metric_parts: tuple[str, ...] = METRIC_PARTS
    non_metric_parts: tuple[str, ...] = NON_METRIC_PARTS
    primary_parts: tuple[str, ...] = PRIMARY_PARTS
    activity_part: str = "interchange"
    activity_flag: str = "has_interchange_activity"

    @property
    def key(self) -> str:
        return f"{self.entity}_key"

    @property
    def rank(self) -> str:
        return f"{self.entity}_usage_rank"

    @property
    def percent_rank(self) -> str:
        return f"{self.entity}_usage_percent_rank"

    @property
    def band(self) -> str:
        return f"{self.entity}_usage_band"

    @property
    def record_count(self) -> str:
        return f"{self.entity}_record_count"

    @property
    def distinct_count(self) -> str:
        return f"distinct_{self.entity}_count"


DEFAULT = Vocabulary()
