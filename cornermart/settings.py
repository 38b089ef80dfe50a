"""All tunables of a lake in one frozen object."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Settings:
    """Locations, business and thresholds.

    ``root`` and ``raw`` are URIs every executor can reach (a shared folder or object store).
    """

    root: str = ""
    raw: str = ""
    hive_raw_layout: bool = False  # False: <raw>/<name>_<date>.<ext>; True: dated key=value folders
    default_schema: str = "main"

    reporting_timezone: str = "America/New_York"
    churned_after_days: int = 60
    at_risk_after_days: int = 45
    tenure_lower_days: int = 90
    tenure_upper_days: int = 130
    refund_window_days: int = 30
    rolling_days: int = 7
    alert_multiplier: int = 2
    earliest_delivery: bool = False  # of an order's deliveries only the first counts: refunds are never repeated
    json_lines: bool = False  # JSON deliveries hold one object per line instead of one array per file

    def schema_for(self, custom: str | None) -> str:
        """Namespace of a table: the custom one verbatim, else the default."""
        return custom.strip() if custom is not None else self.default_schema

    def path(self, layer: str | None, name: str) -> str:
        return f"{self.root.rstrip('/')}/{self.schema_for(layer)}/{name}"
