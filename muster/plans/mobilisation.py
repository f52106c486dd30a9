"""Mobilisation scorecard: 27 indicators per mobilisation cell, and the row sets they are counted from."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from muster.functions import dates, predicates, text
from muster.operators import aggregates, filters, joins, lookups, ranks
from muster.operators.scorecard import INT_AVG, SUM, Kpi, scorecard
from muster.plans import fixed_values as fixed
from muster.plans.declared_policy import declared_policy
from muster.sources import contracts, snapshots
from muster.sources.tables import RunScope, conform, shared

Tables = Mapping[str, DataFrame]


# --- shared conditions and row sets --------------------------------------------------------------

def _active_cell() -> Column:
    return ~F.col("mobilisation_cell_id").isin(fixed.RETIRED_INDIA_CELLS)


def _not_owner_supplied() -> Column:
    return predicates.differs_or_null("crew_contract_type_id", fixed.OWNER_SUPPLIED_CONTRACT)


def _standard_sign_on() -> Column:
    return F.col("sign_on_reason").isNull() | text.same_text("sign_on_reason", "Standard")


def without_transfers(df: DataFrame, t: Tables, key: str = "crew_id") -> DataFrame:
    """Drops people who ever had a management transfer."""
    moved = shared(t, "moved_people", lambda: t["crew_events"].where(
        text.same_text("crew_event_type", fixed.TRANSFER_EVENT)).select("crew_id").distinct())
    return joins.exclude_matching(df, moved.select(F.col("crew_id").alias(key)), key)


def company_services(t: Tables) -> DataFrame:
    """Services at sea that count: not cancelled, not earned elsewhere, not marked inactive."""
    s = t["service_records"].where(
        (F.col("service_cancelled") == 0)
        & (F.col("previous_experience") == 0)
        & F.col("status_id").isin(fixed.OFF_VESSEL_STATUSES)
    )
    return filters.not_equal_or_null(s, "service_active_status_id", 3)


def recent_joiners(t: Tables, as_of: dt.date) -> DataFrame:
    """Services begun in the last 30 days on a standard sign-on, with crew facts, not owner supplied."""
    started = filters.within_days(company_services(t), "start_date", as_of, before=30).where(_standard_sign_on())
    return shared(t, "recent_joiners", lambda: _with_crew(started, t, "nationality").where(_not_owner_supplied()))


def _with_crew(df: DataFrame, t: Tables, *more: str) -> DataFrame:
    facts = shared(t, "crew_facts", lambda: t["crew"].select("crew_id", "mobilisation_cell_id", "crew_contract_type_id", "nationality"))
    return df.join(facts.select("crew_id", "mobilisation_cell_id", "crew_contract_type_id", *more), "crew_id")


def _with_management(df: DataFrame, t: Tables, types: list[str], *more: str) -> DataFrame:
    records = shared(t, "managements", lambda: t["mgmt_records"].select("vessel_mgmt_id", "vessel_mgmt_type", "client_id"))
    managed = records.where(text.text_in("vessel_mgmt_type", types)).select("vessel_mgmt_id", *more)
    return df.join(managed, "vessel_mgmt_id")


def _on_vessels(df: DataFrame, t: Tables, cond: Column) -> DataFrame:
    """Rows whose vessel satisfies the condition; a vessel is listed once."""
    vessels = shared(t, "vessels", lambda: t["vessel"].select("vessel_id", "vessel_business"))
    return joins.keep_matching(df, vessels.where(cond).select("vessel_id"), "vessel_id")


def _business(*names: str) -> Column:
    return text.text_in("vessel_business", names)


def _canadian_exempt() -> Column:
    return text.same_text("nationality", "Canadian") & (F.col("mobilisation_cell_id") == fixed.CANADIAN_EXEMPT_CELL)


# --- indicator families --------------------------------------------------------------------------

def onboard_people(t: Tables) -> DataFrame:
    """Active people onboard managed cargo vessels, not owner supplied, outside closed cells."""
    s = t["crew_current_status"].where(
        text.same_text("crew_pool_status", "Active")
        & text.same_text("current_status", "ONBOARD")
        & text.text_in("management_type", fixed.SHIP_MANAGEMENT)
        & text.same_text("segment", "CARGO")
        & (F.col("supply_type").isNull() | ~text.same_text("supply_type", "Owner Supplied"))
        & ~text.text_in("mobilisation_cell", fixed.CELL_NAMES_NOT_ONBOARD)
    )
    return s.select("crew_id", "mobilisation_cell", "current_status_start_date", "current_status_end_date").distinct()


def training_needs(t: Tables) -> DataFrame:
    """Onboard people with their needs raised before the present contract, completed and pending.

    A person onboard in several rows has the needs counted once per row, and appears once per row.
    """
    onboard = shared(t, "onboard_people", lambda: onboard_people(t))
    needs = t["training_need"].where(
        ~text.same_text("status", "Cancelled") & (F.col("raised_on") >= F.lit(fixed.TRAINING_FLOOR))
    )
    during = F.to_date("raised_on") >= F.to_date("current_status_start_date")
    before = filters.exclude_when(onboard.join(needs, "crew_id"), during)
    done = text.same_text("status", "Completed")
    counted = aggregates.count_by_status(
        before, ["crew_id"], {"completed_tn": done, "pending_tn": ~done}, "training_need_id"
    )
    return without_transfers(onboard.join(counted, "crew_id"), t).withColumn(
        "all_tn", F.col("completed_tn") + F.col("pending_tn")
    )


def document_uploads(t: Tables, as_of: dt.date) -> DataFrame:
    """Documents uploaded in the run date's month on managed vessels, with their final scope."""
    d = filters.in_period(t["document_uploads"], "uploaded_on", as_of, "month").where(
        ~F.col("mobilisation_cell_id").isin(fixed.AGENCY_CELLS + fixed.RETIRED_INDIA_CELLS)
    )
    crew = t["crew"].where(
        F.col("crew_contract_type").isNull() | ~text.same_text("crew_contract_type", "Owner Supplied")
    ).select("crew_id", "nationality")
    d = without_transfers(filters.exclude_when(d.join(crew, "crew_id"), _canadian_exempt()), t)
    uploads = d
    d = shared(t, "uploads", lambda: uploads)
    open_end = F.coalesce(F.col("mgmt_end"), F.lit(dates.as_date(as_of)).cast("timestamp_ntz"))
    d = lookups.range_lookup(
        d, t["mgmt_records"], "vessel_id", "uploaded_on", F.col("mgmt_start"), open_end,
        F.coalesce("mgmt_start", "purchasing_start_date"), {"vessel_mgmt_type": "vessel_mgmt_type"}, tie="vessel_mgmt_id",
    ).where(text.text_in("vessel_mgmt_type", fixed.SHIP_MANAGEMENT))
    countries = t["country"].select(F.col("country_id").alias("issued_country_id"), "country_name")
    outside = (
        text.same_text("document_scope", "OUT OF SCOPE")
        | text.same_text("document_name", fixed.CREW_VISA)
        | text.text_in("country_name", fixed.FLAG_COUNTRIES)
    )
    return d.join(countries, "issued_country_id", "left").withColumn(
        "final_scope", F.when(outside, "OUT OF SCOPE").otherwise("IN SCOPE")
    )


def _mandatory_onboard(t: Tables) -> DataFrame:
    return shared(t, "mandatory_onboard", lambda: _mandatory_rows(t))


def _mandatory_rows(t: Tables) -> DataFrame:
    """Latest compliance rows of mandatory pre-joining documents of people onboard managed cargo vessels."""
    rows = filters.latest_snapshot(t["compliance_trends"], "record_inserted_on").where(
        text.same_text("vessel_in_scope", "Included")
        & text.same_text("default_template", "Yes")
        & text.same_text("template_requirement", "Mandatory")
        & text.same_text("crew_status", "Onboard")
        & text.same_text("course_color_category", "Red")
        & text.same_text("training_type", "Old Training")
        & _active_cell()
    )
    rows = _on_vessels(_with_management(rows, t, fixed.SHIP_MANAGEMENT), t, _business("Cargo"))
    return without_transfers(rows, t)


def pre_joining_compliance(t: Tables) -> DataFrame:
    return _mandatory_onboard(t).groupBy("record_inserted_on", "crew_id", "mobilisation_cell_id").agg(
        F.sum("statutory_non_compliant_documents").alias("statutory_failing"),
        F.sum("vms_non_compliant_documents").alias("vms_failing"),
    )


def flag_compliance(t: Tables) -> DataFrame:
    own = t["crew"].where(text.same_text("crew_contract_type", "Internal Supply")).select("crew_id")
    rows = _mandatory_onboard(t).where(text.same_text("is_flag_document", "YES"))
    return joins.keep_matching(rows, own, "crew_id").groupBy(
        "record_inserted_on", "crew_id", "mobilisation_cell_id"
    ).agg(
        aggregates.sum_of_sums("statutory_non_compliant_documents", "vms_non_compliant_documents").alias("failing")
    )


def checklist_usage(t: Tables, as_of: dt.date) -> DataFrame:
    """Recent joiners with their live checklist, if any."""
    joiners = filters.exclude_when(recent_joiners(t, as_of), _canadian_exempt()).where(
        ~F.col("mobilisation_cell_id").isin(fixed.AGENCY_CELLS + fixed.RETIRED_INDIA_CELLS)
    )
    joiners = _with_management(joiners, t, fixed.CREW_AND_SHIP_MANAGEMENT, "client_id")
    allowed = t["company"].where(~text.text_in("company_name", fixed.CLIENTS_WITHOUT_CHECKLIST))
    joiners = joins.keep_matching(joiners, allowed.select(F.col("company_id").alias("client_id")), "client_id")
    lists = t["mob_checklist"].withColumnRenamed("linked_service_record_id", "service_record_id")
    live = (F.col("mob_checklist_deleted") == 0) & F.col("mob_checklist_status_id").isin(fixed.CHECKLIST_STATUSES)
    return joins.join_filtered(without_transfers(joiners, t), lists, "service_record_id", live).select(
        "crew_id", "mobilisation_cell_id", "mob_checklist_id", "mob_checklist_status"
    )


def readiness(t: Tables, as_of: dt.date) -> DataFrame:
    """Recent joiners, compliant when set ready no later than their estimated readiness."""
    joiners = recent_joiners(t, as_of).where(
        ~F.col("vessel_id").isin(fixed.VESSELS_NOT_RELIABILITY)
        & ~F.col("mobilisation_cell_id").isin(fixed.LEISURE_CELLS)
    )
    joiners = _on_vessels(joiners, t, ~_business("Offshore"))
    joiners = without_transfers(_with_management(joiners, t, fixed.CREW_AND_SHIP_MANAGEMENT), t)
    ready = t["planning_history"].select("service_record_id", "planning_status_new", F.col("updated_on").alias("ready_on"))
    rows = joins.join_filtered(joiners, ready, "service_record_id", text.same_text("planning_status_new", "Ready"))
    on_time = F.to_date("ready_on") <= F.to_date("estimated_readiness_date")
    return rows.select(
        "crew_id", "mobilisation_cell_id", F.when(on_time, "Compliant").otherwise("Non Compliant").alias("compliance")
    )


def acceptance(t: Tables, as_of: dt.date) -> DataFrame:
    """Each person's latest approval of last month, unless it was released or cancelled afterwards."""
    plans = t["planning_history"]
    approved = filters.in_period(
        plans.where(text.same_text("planning_status_new", "Approved")), "updated_on", as_of, "previous_month"
    ).select("crew_id", "service_record_id", F.col("updated_on").alias("approved_on"))
    services = t["service_records"].where(
        F.col("status_id").isin(fixed.OFF_VESSEL_STATUSES)
        & (F.col("service_cancelled") == 0)
        & (F.col("previous_experience") == 0)
        & ~F.col("vessel_id").isin(fixed.VESSELS_NOT_RELIABILITY)
    )
    services = _on_vessels(
        _with_management(services, t, fixed.CREW_AND_SHIP_MANAGEMENT), t, _business(*fixed.ACCEPTANCE_BUSINESS)
    ).select("service_record_id", F.col("crew_id").alias("service_crew_id"), "mobilisation_accepted_on")
    services = without_transfers(services, t, "service_crew_id")
    rows = _with_crew(approved.join(services, "service_record_id"), t).where(_not_owner_supplied() & _active_cell())
    rows = rows.withColumn(
        "weekdays", dates.weekdays_between(F.col("mobilisation_accepted_on"), F.col("approved_on"))
    )
    approvals = rows
    rows = shared(t, "approvals", lambda: approvals)
    keys = ["crew_id", "service_record_id"]
    following = lookups.next_status_after(plans, rows, keys, "updated_on", "planning_status_new", "approved_on", "next_status")
    latest = ranks.latest_rows(rows, ["crew_id"], "approved_on").join(following, keys, "left")
    undone = text.text_in("next_status", ["Released", "Cancelled"])
    return filters.exclude_when(latest, undone).select(
        *keys, "mobilisation_cell_id", "approved_on", "weekdays", "next_status"
    )


def debriefings(t: Tables, as_of: dt.date) -> DataFrame:
    """Services ended 15 to 45 days ago and whether the person was contacted within 15 days."""
    day = dates.as_date(as_of)
    ended = company_services(t).where(
        filters.between_days("end_date", day - dt.timedelta(days=45), day - dt.timedelta(days=15))
        & (F.col("active_status") == 0)
        & (F.col("sign_off_reason").isNull() | ~text.text_in("sign_off_reason", fixed.SIGN_OFFS_NOT_DEBRIEFED))
        & (F.to_date("end_date") > F.to_date("start_date"))
    )
    ended = _with_crew(_with_management(ended, t, fixed.CREW_AND_SHIP_MANAGEMENT), t).where(_not_owner_supplied() & _active_cell())
    rows = joins.join_filtered(
        without_transfers(ended, t), t["debriefing"], "service_record_id", F.col("debriefing_status_id").isin(1, 3)
    )
    rows = filters.not_equal_or_null(rows, "debriefing_status_id", 1)
    target = dates.plus_days(F.col("end_date"), 15)
    on_time = dates.day_gap(target, F.col("seafarer_contacted_on")) <= 0
    return rows.select(
        "crew_id", "service_record_id", "mobilisation_cell_id", F.when(on_time, 1).otherwise(0).alias("compliance")
    )


def timely_relief(t: Tables, as_of: dt.date) -> DataFrame:
    """Ratings onboard, overdue more than 30 days after their contract end."""
    rows = t["crew_current_status"].where(
        text.same_text("current_status", "ONBOARD")
        & text.text_in("rank_category", fixed.RATINGS)
        & text.text_in("management_type", fixed.SHIP_MANAGEMENT)
    )
    days = dates.day_gap(F.col("contract_end_date"), F.lit(dates.as_date(as_of)))
    return without_transfers(rows, t).select(
        "crew_id", "planning_cell", F.when(days > 30, "Overdue").otherwise("Timely Relieved").alias("relief")
    )


def appraisals(t: Tables, as_of: dt.date) -> DataFrame:
    """Latest completed appraisal per rating and service ended since 1 January, with the days to review.

    The cell is the one in the person's profile on or before sign-off, from the change log; without an
    entry it is the present one.
    """
    done = t["appraisal"].where((F.col("is_deleted") == 0) & text.same_text("appraisal_status", "Completed")).select(
        "appraisal_id", F.col("crew_id_appraisee").alias("crew_id"),
        F.col("service_record_id_appraisee").alias("service_record_id"), "created_on", "reviewed_on",
    )
    ended = filters.in_period(t["service_records"].where("active_status = 0"), "end_date", as_of, "year_on")
    ended = joins.keep_matching(
        ended, t["ranks"].where(text.text_in("rank_category", fixed.RATINGS)).select("rank_id"), "rank_id"
    )
    ended = _on_vessels(_with_management(ended, t, fixed.SHIP_MANAGEMENT), t, _business("Cargo"))
    rows = done.join(ended.select("service_record_id", "end_date"), "service_record_id")
    rows = without_transfers(_with_crew(rows, t).where(_not_owner_supplied()), t)
    changes = t["details_change_log"].where(
        (F.col("event_id") == fixed.CELL_CHANGE_EVENT) & F.col("new_value").isNotNull()
    ).select(F.col("fk_matched_id").alias("crew_id"), "created_on", "new_value")
    rows = lookups.asof_lookup(
        rows, changes, "crew_id", "end_date", "created_on", {"logged_cell": "new_value"}, tie="created_on", by_day=True
    )
    pools = t["crew_pool"].select(F.lower("crew_pool").alias("_cell"), "crew_pool_id")
    rows = rows.withColumn("_cell", F.lower("logged_cell")).join(pools, "_cell", "left")
    rows = rows.withColumn("mobilisation_cell_id", F.coalesce("crew_pool_id", "mobilisation_cell_id")).where(_active_cell())
    found = rows
    latest = ranks.latest_rows(shared(t, "appraisals", lambda: found), ["crew_id", "service_record_id"], "created_on")
    return latest.select(
        "appraisal_id", "crew_id", "service_record_id", "mobilisation_cell_id",
        dates.day_gap(F.col("created_on"), F.col("reviewed_on")).alias("days_to_review"),
    )


def policy_status(t: Tables) -> DataFrame:
    """Declared-policy status of people on a standard sign-on, as the upstream view gives it."""
    standard = t["policy_check"].where(text.same_text("reason_for_sign_on", "Standard"))
    cells = t["crew"].select("crew_id", "mobilisation_cell_id")
    return without_transfers(standard.join(cells, "crew_id", "left"), t)


def time_to_mobilise(t: Tables, as_of: dt.date) -> DataFrame:
    """Recent joiners with the days from approval, or from the start of their last leave if later, to joining.

    `weight` tells how often a row counts in the mean: once, or for people with a leave once per pair of
    their joining rows and latest leave rows.
    """
    joiners = _with_management(recent_joiners(t, as_of), t, fixed.SHIP_MANAGEMENT).where(_active_cell())
    joiners = _on_vessels(joiners, t, ~_business("Offshore")).select(
        "crew_id", "service_record_id", "mobilisation_cell_id", F.to_date("start_date").alias("start_day")
    )
    approvals = t["planning_history"].where(text.same_text("planning_status_new", "Approved")).select(
        "service_record_id", F.to_date("updated_on").alias("approved_day")
    )
    joiners = lookups.latest_lookup(
        joiners, approvals, "service_record_id", F.col("approved_day"), {"approved_day": "approved_day"}
    )
    found = joiners
    joiners = shared(t, "approved_joiners", lambda: found)
    per_person = joiners.groupBy("crew_id").agg(F.count(F.lit(1)).alias("joinings"))
    leaves = t["service_records"].where(
        (F.col("service_cancelled") == 0) & (F.col("previous_experience") == 0) & (F.col("active_status") == 0)
        & (F.col("service_active_status_id").isNull() | F.col("service_active_status_id").isin(1, 2))
        & (F.col("status_id") == "LE")
    ).select("crew_id", "start_date")
    leaves = joins.keep_matching(leaves, per_person.select("crew_id"), "crew_id")
    last_leave = ranks.latest_rows(leaves, ["crew_id"], "start_date").groupBy("crew_id").agg(
        F.to_date(F.max("start_date")).alias("leave_day"), F.count(F.lit(1)).alias("leave_rows")
    )
    rows = without_transfers(joiners, t).join(last_leave, "crew_id", "left").join(per_person, "crew_id")
    counted_from = predicates.later_of(F.col("leave_day"), F.col("approved_day"))
    weight = F.coalesce(F.col("leave_rows") * F.col("joinings"), F.lit(1))
    return rows.select(
        "crew_id", "service_record_id", "mobilisation_cell_id",
        dates.day_gap(counted_from, F.col("start_day")).alias("days"), weight.alias("weight"),
    )


def berths_to_plan(t: Tables) -> DataFrame:
    """Budgeted rating berths on managed cargo vessels that need a reliever within 30 days, latest snapshot."""
    left = F.col("days_remaining")
    rows = filters.latest_snapshot(t["berths_snapshot"], "record_insert_date").where(
        (F.col("berth_type_id") == fixed.BUDGETED_BERTH)
        & (F.col("is_reliever_not_required") == 0)
        & (left.isNull() | left.between(0, 30))
        & ~F.col("planning_cell_id").isin(fixed.EUROPE_PLANNING_CELLS)
    )
    rows = joins.keep_matching(
        rows, t["ranks"].where(text.text_in("rank_category", fixed.RATINGS)).select("rank_id"), "rank_id"
    )
    rows = _on_vessels(_with_management(rows, t, fixed.SHIP_MANAGEMENT), t, _business("Cargo"))
    return rows.select("berth_id", "planning_cell_id", "planned_crew_id")


# --- scorecard -----------------------------------------------------------------------------------

def cells(t: Tables) -> DataFrame:
    pools = t["crew_pool"].where(
        (F.col("crew_pool_type_id") == fixed.MOBILISATION_POOL_TYPE)
        & (F.col("is_active") == 1)
        & ~F.col("crew_pool_id").isin(fixed.CELLS_NOT_SCORED)
    )
    return pools.select(
        F.col("crew_pool_id").alias("group_id"), F.col("crew_pool").alias("group_name"),
        F.lower("crew_pool").alias("name_key"),
    ).distinct()


def mobilisation_scorecard(t: Tables, as_of: dt.date, derive_policy: bool = False) -> DataFrame:
    """The scorecard. With `derive_policy` the declared-policy status is worked out from policies and
    services instead of read from the upstream view.

    Row sets that several indicators need are written once for the run; a caller that passes a RunScope can close it
    when the card has been read.
    """
    t = RunScope.of(t)
    trained = training_needs(t).where(~text.text_in("mobilisation_cell", fixed.CELL_NAMES_WITHOUT_TRAINING))
    trained = trained.withColumn("cell_key", F.lower("mobilisation_cell"))
    documents = document_uploads(t, as_of).where("final_scope = 'IN SCOPE'")
    compliance, flags = pre_joining_compliance(t), flag_compliance(t)
    checklists, ready, accepted = checklist_usage(t, as_of), readiness(t, as_of), acceptance(t, as_of)
    debriefed, relief, reviewed = debriefings(t, as_of), timely_relief(t, as_of), appraisals(t, as_of)
    policies = declared_policy(t, as_of) if derive_policy else policy_status(t)
    relief = relief.withColumn("cell_key", F.lower("planning_cell"))
    berths, waits = berths_to_plan(t), time_to_mobilise(t, as_of)

    def people(name, source, where=None, key="mobilisation_cell_id", group_key="group_id", value="crew_id"):
        return Kpi(name, source, key, value, where=where, group_key=group_key)

    by_name = {"key": "cell_key", "group_key": "name_key"}
    kpis = [
        Kpi("training_completed", trained, value="completed_tn", how=SUM, **by_name),
        Kpi("training_total", trained, value="all_tn", how=SUM, **by_name),
        people("checklist_signed", checklists, F.col("mob_checklist_id").isNotNull()),
        people("checklist_joiners", checklists),
        people("documents_by_seafarer", documents, text.same_text("uploaded_by_unit", "Seafarer"), value="document_id"),
        people("documents_total", documents, value="document_id"),
        people("ready_on_time", ready, F.col("compliance") == "Compliant"),
        people("reliability_joiners", ready),
        people("statutory_compliant", compliance, F.col("statutory_failing") == 0),
        people("statutory_onboard", compliance),
        people("vms_compliant", compliance, F.col("vms_failing") == 0),
        people("vms_onboard", compliance),
        people("declaration_signed", policies, text.same_text("policy_status", "Signed")),
        people("declaration_population", policies),
        people("accepted_on_time", accepted, F.col("weekdays") >= -2),
        people("approved_to_join", accepted),
        people("debriefed_on_time", debriefed, F.col("compliance") == 1),
        people("debriefing_off_signers", debriefed),
        people("timely_relieved", relief, F.col("relief") == "Timely Relieved", **by_name),
        people("ratings_onboard", relief, **by_name),
        people("appraisal_on_time", reviewed, F.col("days_to_review") <= 15),
        people("appraisal_off_signers", reviewed),
        people("relievers_planned", berths, F.col("planned_crew_id").isNotNull(), "planning_cell_id", value="berth_id"),
        people("berths_to_plan", berths, None, "planning_cell_id", value="berth_id"),
        Kpi("time_to_mobilise", waits, "mobilisation_cell_id", "days", INT_AVG, weight="weight"),
        people("flag_compliant", flags, F.col("failing") == 0),
        people("flag_onboard", flags),
    ]
    card = scorecard(cells(t), kpis).withColumnsRenamed(
        {"group_id": "mobilisation_cell_id", "group_name": "mobilisation_cell"}
    )
    return conform(card.withColumn("record_date", F.lit(dates.as_date(as_of))), contracts.MOBILISATION_SCORECARD)


def write_mobilisation_scorecard(t: Tables, as_of: dt.date, path: str) -> int:
    scope = RunScope.of(t)
    try:
        card = mobilisation_scorecard(scope, as_of).drop("record_date")
        return snapshots.replace_snapshot(card, path, "record_date", as_of)
    finally:
        scope.close()
