"""Settings of a run."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field, fields
from pathlib import Path


# Names and defaults of the thresholds in a configuration.
@dataclass(frozen=True)
class Thresholds:
    min_name_score: float = 55.0
    min_candidate_score: float = 58.0
    possible_score: float = 58.0
    review_score: float = 60.0
    auto_accept_score: float = 94.0
    min_score_gap: float = 5.0
    max_days_origination_before_lead: float = 30.0
    ambiguous_gap: float = 2.0
    max_review_rows: int | None = None  # an optional cap on the review section, off by default


@dataclass(frozen=True)
class Source:
    """A partner: its files are those whose name has one of the markers."""

    name: str
    code: str
    markers: tuple[str, ...]


# The sources of a configuration that names none.
DEFAULT_SOURCES = (
    Source("Northwest Partners", "NWP", ("Northwest", "NWP")),
    Source("Great Lakes Collective", "GLC", ("Great Lakes", "GLC")),
    Source("Southwest Alliance", "SWA", ("Southwest", "SWA")),
    Source("Atlantic Community Fund", "ACF", ("Atlantic", "ACF")),
)


@dataclass(frozen=True)
class Database:
    """Where candidates' tables are; the password is read from an environment variable when they are."""

    url: str
    schema: str
    user: str
    password_variable: str

    def options(self) -> dict[str, str]:
        password = os.environ.get(self.password_variable)
        if not password:
            raise RuntimeError(f"the environment variable {self.password_variable} is not set")
        return {"user": self.user, "password": password}


@dataclass(frozen=True)
class Settings:
    live_path: str
    output_path: str
    history_path: str
    sources: tuple[Source, ...]
    candidates_csv: str | None = None
    database: Database | None = None
    thresholds: Thresholds = field(default_factory=Thresholds)
    notifications: bool = True
    report_enabled: bool = True
    report_format: str = "csv"


def thresholds(values: dict) -> Thresholds:
    unknown = set(values) - {f.name for f in fields(Thresholds)}
    if unknown:
        raise ValueError(f"unknown thresholds: {sorted(unknown)}")
    return Thresholds(**values)


def _database(raw: dict) -> Database:
    url = raw.get("url") or f"jdbc:postgresql://{raw['host']}/{raw['database']}"
    return Database(url, raw.get("schema", "public"), raw["user"], raw["password_env_var"])


def load_settings(path: str) -> Settings:
    """Settings from a JSON file, whose keys are fixed values; candidates come from a CSV file or else from a database.

    The folders of the output and the history are made where they are local.
    """
    raw = json.loads(Path(path).read_text())
    if not raw.get("candidates_csv") and not raw.get("db"):
        raise ValueError("either candidates_csv or db is needed")
    sources = tuple(Source(s["source_name"], s["source_code"], tuple(s["file_markers"])) for s in raw.get("source_mappings", []))
    for folder in (Path(raw["output_dir"]), Path(raw["history_db_path"]).parent):
        if "://" not in str(folder) and ":/" not in str(folder):
            folder.mkdir(parents=True, exist_ok=True)
    return Settings(
        live_path=raw["live_data_dir"],
        output_path=raw["output_dir"],
        history_path=raw["history_db_path"],
        sources=sources or DEFAULT_SOURCES,
        candidates_csv=raw.get("candidates_csv"),
        database=_database(raw["db"]) if raw.get("db") else None,
        thresholds=thresholds(raw.get("thresholds", {})),
        notifications=bool(raw.get("notifications", {}).get("enabled", True)),
        report_enabled=bool(raw.get("workbook_enabled", True)),
        report_format=raw.get("report_format", "csv"),
    )
