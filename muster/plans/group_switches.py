"""Events of people leaving one client for another."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import dates
from muster.operators import filters, joins, lookups, ranks
from muster.plans import fixed_values as fixed
from muster.sources import snapshots
from muster.sources.tables import RunScope

Tables = Mapping[str, DataFrame]


def service_history(t: Tables, as_of: dt.date) -> DataFrame:
    """Completed company services at sea since the history start, each with the client served."""
    s = filters.in_period(
        t["service_records"], "start_date", as_of, "since_to_previous_month", since=fixed.HISTORY_START
    ).where((F.col("service_cancelled") == 0) & (F.col("status_id") == "OB") & (F.col("previous_experience") == 0))
    s = filters.not_equal_or_null(s, "service_active_status_id", 3)
    s = s.select(
        "service_record_id", "crew_id", "rank_id", "vessel_id", "vessel_mgmt_id", "service_vessel_client_id",
        F.col("start_date").alias("event_date"), F.col("end_date").alias("event_end"),
    )
    for table, key in (("crew", "crew_id"), ("ranks", "rank_id")):
        s = joins.keep_matching(s, t[table].select(key), key)
    s = s.join(t["vessel"].select("vessel_id", "ship_owner_id"), "vessel_id")
    s = s.join(t["mgmt_records"].select("vessel_mgmt_id", F.col("client_id").alias("managed_client")), "vessel_mgmt_id")
    clients = t["company"].select(F.col("company_id").alias("client_id"), F.col("company_name").alias("client"))
    s = joins.join_coalesced(s, clients, ["service_vessel_client_id", "ship_owner_id", "managed_client"], "client_id")
    return filters.remap(
        s, "client_id", fixed.MERGED_CLIENTS, {"client_id": fixed.MERGED_CLIENT_ID, "client": fixed.MERGED_CLIENT}
    ).select("service_record_id", "crew_id", "client_id", "client", "event_date", "event_end")


def group_switches(t: Tables, as_of: dt.date) -> DataFrame:
    """One row per last service with a client and the service that followed it.

    The history is worked out once for the run and only people with more than one client stay in it. A person's newest service has no successor, so it drops
    out by itself.
    """
    t = RunScope.of(t)
    every = t.shared("service_history", lambda: service_history(t, as_of))
    movers = ranks.multi_group_entities(every, "crew_id", "client_id")
    history = t.shared("moving_history", lambda: joins.keep_matching(every, movers, "crew_id"))
    last = ranks.latest_rows(history, ["crew_id", "client_id"], "event_date")
    pairs = lookups.next_event(
        history, "crew_id", "event_date",
        {"next_service": "service_record_id", "new_client": "client_id", "new_client_start": "event_date"}, of=last,
    )
    keyed = joins.join_on_date(pairs, t["date_dimension"].select("date", "date_key"), "event_end", "date")
    return keyed.select(
        F.col("next_service").alias("service_record_id"), "crew_id", F.col("client_id").alias("client_impacted"),
        dates.day_gap(F.col("event_end"), F.col("new_client_start")).alias("gap_days"),
        F.col("event_end").alias("end_date"), "new_client", "new_client_start", "date_key",
    ).distinct()


def append_group_switches(t: Tables, as_of: dt.date, path: str, strict: bool = False) -> None:
    """Appends the events whose following service is not stored yet."""
    scope = RunScope.of(t)
    try:
        snapshots.append_new(group_switches(scope, as_of), path, "service_record_id", strict=strict)
    finally:
        scope.close()
