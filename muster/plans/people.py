"""Dated snapshots of people: planned joiners, active people, contacts made."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import dates, text
from muster.operators import ranks
from muster.sources import contracts, snapshots
from muster.sources.tables import conform

Tables = Mapping[str, DataFrame]


def planned_joiners(t: Tables, as_of: dt.date) -> DataFrame:
    """People planned to join from the run date up to midnight 60 days on, with their line-up."""
    day = dates.as_date(as_of)
    start = F.col("start_date")
    planned = t["next_planned"].where(
        (start >= F.lit(day)) & (start <= F.lit(day + dt.timedelta(days=60)))
    )
    service = t["service_records"].select("service_record_id", "lineup_id_joiner")
    line_ups = t["line_ups"].select(
        F.col("line_up_id").alias("lineup_id_joiner"), "line_up_description", "line_up_created_on"
    )
    joined = planned.join(service, "service_record_id", "left").join(line_ups, "lineup_id_joiner", "left")
    return joined.select(F.lit(day).alias("date"), *contracts.PLANNED_COLUMNS, *contracts.LINE_UP_COLUMNS)


def write_planned_joiners(t: Tables, as_of: dt.date, path: str) -> int:
    return snapshots.replace_snapshot(planned_joiners(t, as_of).drop("date"), path, "date", as_of)


def active_people(t: Tables) -> DataFrame:
    """Active people, one row each, in the snapshot's columns."""
    rows = ranks.one_row_guard(t["active_snapshot"].where(text.same_text("crew_pool_status", "ACTIVE")))
    return conform(rows, contracts.ACTIVE_SNAPSHOT)


def contacts_made(t: Tables) -> DataFrame:
    """Contacts made to people who signed off, one row each, in the snapshot's columns."""
    return conform(ranks.one_row_guard(t["contacts_snapshot"]), contracts.CONTACTS_SNAPSHOT)


def write_active_people(t: Tables, as_of: dt.date, path: str) -> None:
    snapshots.retain_and_append(active_people(t), path, "date", as_of)


def write_contacts_made(t: Tables, as_of: dt.date, path: str) -> None:
    snapshots.retain_and_append(contacts_made(t), path, "date", as_of)
