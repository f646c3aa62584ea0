"""Settings as plain values: rule constants, table locations and the serving database."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

# The dimensions that have a metrics history, their serving tables and their row limits.
DIMENSIONS = ("payment_type", "risk_level", "city")
HISTORY_TABLES = {
    "payment_type": "payment_metrics_history",
    "risk_level": "risk_metrics_history",
    "city": "city_metrics_history",
}
# The ledger and its alerts in the serving database.
TRANSACTIONS_TABLE, ALERTS_TABLE = "transactions", "fraud_alerts"
TOP_N = {"payment_type": None, "risk_level": None, "city": 20}
TOP_CITIES_SHOWN = 10
STALE_AFTER_MINUTES = 10
TOPIC = "transactions_raw"


@dataclass(frozen=True)
class Thresholds:
    """Silver features. Amounts must exceed a threshold; the night hours include both ends."""

    # Fixed values
    high_value: float = 3000
    high_risk: float = 4000
    medium_risk: float = 2000
    night_hours: tuple[int, int] = (0, 6)


@dataclass(frozen=True)
class FraudRules:
    """Fraud scores in order of precedence. The unusual hours include both ends."""

    # Fixed values
    very_high_amount: float = 4500
    high_amount: float = 4000
    unusual_hours: tuple[int, int] = (0, 4)
    very_high: tuple[int, str] = (95, "Suspicious Very High Amount")
    high: tuple[int, str] = (80, "High Amount Transaction")
    unusual: tuple[int, str] = (70, "Transaction During Unusual Hours")


@dataclass(frozen=True)
class Paths:
    """Table and checkpoint locations under one root, which all executors must reach."""

    root: str

    def _at(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def bronze(self) -> str:
        return self._at("data", "bronze")

    @property
    def silver(self) -> str:
        return self._at("data", "silver")

    @property
    def rejects(self) -> str:
        return self._at("data", "rejects")

    @property
    def ledger(self) -> str:
        return self._at("data", "ledger", "transactions")

    @property
    def alerts(self) -> str:
        return self._at("data", "ledger", "fraud_alerts")

    @property
    def ledger_staging(self) -> str:
        return self._at("data", "ledger", "staging")

    def history(self, dimension: str) -> str:
        return self._at("data", "gold", HISTORY_TABLES.get(dimension, f"{dimension}_metrics_history"))

    def changes(self, query: str) -> str:
        """The values that the triggers of a gold query changed."""
        return self._at("data", "gold", f"{query}_changes")

    def checkpoint(self, name: str) -> str:
        return self._at("checkpoints", name)


@dataclass(frozen=True)
class JdbcTarget:
    """The serving database. Credentials come from the environment, never from code."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    @classmethod
    def from_env(cls, env=os.environ) -> "JdbcTarget":
        return cls(
            url=env["TIDEMARK_JDBC_URL"],
            user=env.get("TIDEMARK_JDBC_USER"),
            password=env.get("TIDEMARK_JDBC_PASSWORD"),
            driver=env.get("TIDEMARK_JDBC_DRIVER"),
        )

    @property
    def properties(self) -> dict[str, str]:
        given = {"user": self.user, "password": self.password, "driver": self.driver}
        return {k: v for k, v in given.items() if v is not None}
