"""Business-date resolution for the daily partitions."""

from __future__ import annotations

import datetime as dt
import os
from zoneinfo import ZoneInfo

# The business time zone of the daily runs and the environment
# variable that may pin the partition date.
BUSINESS_TIMEZONE = "America/Sao_Paulo"
PARTITION_DATE_ENV = "PARTITION_DATE"


def today_partition() -> str:
    return dt.datetime.now(ZoneInfo(BUSINESS_TIMEZONE)).date().isoformat()


def resolve_partition_date(explicit: str | dt.date | None = None) -> str:
    """Explicit argument, else ``$PARTITION_DATE``, else today in the business
    time zone. Always returned as a validated ``YYYY-MM-DD`` string, resolved once
    per run and passed to every layer."""
    value = explicit or os.environ.get(PARTITION_DATE_ENV) or today_partition()
    return dt.date.fromisoformat(str(value)).isoformat()
