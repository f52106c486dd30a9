"""Declared-policy status of people onboard, worked out from services, policies and attachments."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import dates, predicates, text
from muster.operators import filters, joins, lookups
from muster.plans import fixed_values as fixed

Tables = Mapping[str, DataFrame]


def onboard_services(t: Tables) -> DataFrame:
    """Running services of people on managed vessels, less exempt vessels, ranks, offices and agents."""
    metrics = filters.latest_snapshot(t["vessel_metrics"], "date").where(
        text.text_in("mgmt_type", fixed.SHIP_MANAGEMENT)
        & ~text.same_text("technical_office", fixed.POLICY_EXEMPT_OFFICE)
    )
    people = t["crew"].where(
        (F.col("mobilisation_office").isNull() | ~text.same_text("mobilisation_office", fixed.POLICY_EXEMPT_OFFICE))
        & (F.col("third_party_agent_id").isNull() | ~F.col("third_party_agent_id").isin(fixed.POLICY_EXEMPT_AGENTS))
    ).select("crew_id", "mobilisation_cell_id")
    running = t["service_records"].where(
        (F.col("status_id") == "OB") & (F.col("active_status") == 1) & (F.col("service_cancelled") == 0)
        & ~F.col("vessel_id").isin(fixed.POLICY_EXEMPT_VESSELS)
    )
    exempt_rank = F.col("vessel_id").isin(fixed.POLICY_VESSEL_RANK_VESSELS) & F.col("rank_id_budgeted").isin(
        fixed.POLICY_VESSEL_RANK_RANKS
    )
    rows = filters.exclude_when(running, exempt_rank).join(people, "crew_id")
    return joins.keep_matching(rows, metrics.select("vessel_id"), "vessel_id").select(
        "service_record_id", "crew_id", "mobilisation_cell_id", F.col("start_date").alias("sign_on")
    )


def onboard_moves(t: Tables, onboard: DataFrame, as_of: dt.date) -> DataFrame:
    """Services with the one they continue: the person's previous service, on the same vessel, at most two
    days earlier. Only people in `onboard` and company services of the last year count."""
    year_ago = dates.as_date(as_of) - dt.timedelta(days=365)
    services = t["service_records"].where(
        F.col("service_active_status_id").isin(1, 2) & (F.col("service_cancelled") == 0)
        & F.col("status_id").isin(fixed.OFF_VESSEL_STATUSES) & F.col("vessel_id").isNotNull()
        & (F.col("end_date") >= F.lit(year_ago)) & (F.col("previous_experience") == 0)
    ).select("service_record_id", "crew_id", "vessel_id", "start_date", "end_date", "sea_days")
    services = joins.keep_matching(services, onboard.select("crew_id"), "crew_id")
    end = F.coalesce(F.col("end_date"), F.timestamp_add("DAY", F.col("sea_days"), F.col("start_date")))
    linked = lookups.contiguous_predecessor(
        services, "crew_id", ["start_date", "service_record_id"], "vessel_id", "start_date", end, 2,
        {"earlier_service": "service_record_id", "earlier_sign_on": "start_date"},
    )
    return linked.where(F.col("earlier_service").isNotNull()).select(
        "service_record_id", "earlier_service", "earlier_sign_on"
    )


def declared_policy(t: Tables, as_of: dt.date) -> DataFrame:
    """Distinct people onboard with their cell and policy status, Signed or Missing.

    Signed means any of: an agreed policy or an attachment linked to the running service or to the one it
    continues, or a policy agreed later than 70 days before either sign-on.
    """
    onboard = onboard_services(t)
    services = onboard.join(onboard_moves(t, onboard, as_of), "service_record_id", "left")
    agreed = t["policy"].where((F.col("is_policy_agreed") == 1) & F.col("agreed_on").isNotNull())
    newest = agreed.groupBy("crew_id").agg(F.max("agreed_on").alias("agreed_on"))

    running = services.select("crew_id", F.col("service_record_id").alias("linked"))
    earlier = services.select("crew_id", F.col("earlier_service").alias("linked"))
    linked = running.unionByName(earlier)
    recent = services.join(newest, "crew_id").where(
        predicates.holds(dates.day_gap(F.col("agreed_on"), F.col("sign_on")) < fixed.POLICY_DAYS)
        | predicates.holds(dates.day_gap(F.col("agreed_on"), F.col("earlier_sign_on")) < fixed.POLICY_DAYS)
    )
    by_policy = agreed.select("crew_id", F.col("service_record_id").alias("linked"))
    by_attachment = t["policy_attachments"].select("crew_id", F.col("fk_document_id").alias("linked"))
    pair = ["crew_id", "linked"]
    signed = joins.any_link_match(services.select("crew_id").distinct(), "crew_id", [
        joins.keep_matching(linked, by_policy, pair), joins.keep_matching(linked, by_attachment, pair), recent,
    ])
    rows = joins.flag_presence(onboard, signed, "crew_id", "policy_status", "Signed", "Missing")
    return rows.select("policy_status", "crew_id", "mobilisation_cell_id").distinct()
