"""Recruitment scorecard: 19 indicators per recruitment cell, three of them reserved."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.functions import dates, text
from muster.operators import filters, joins
from muster.operators.scorecard import COUNT, Kpi, scorecard
from muster.plans import fixed_values as fixed
from muster.sources import contracts, snapshots
from muster.sources.tables import conform

Tables = Mapping[str, DataFrame]


def cells(t: Tables) -> DataFrame:
    pools = t["crew_pool"].where(
        (F.col("crew_pool_type_id") == fixed.RECRUITMENT_POOL_TYPE) & (F.col("is_active") == 1)
    )
    rows = pools.select(F.col("crew_pool_id").alias("group_id"), F.col("crew_pool").alias("group_name"))
    rows = joins.union_sentinel(rows, {"group_id": fixed.UNKNOWN_GROUP, "group_name": fixed.UNKNOWN_GROUP})
    return rows.withColumn("name_key", F.lower("group_name"))


def new_hires(t: Tables) -> DataFrame:
    """Hires known as crew, flagged when their service went through tracking to the end."""
    tracked = t["recruitment_tracking"].where(
        (F.col("is_deleted") == 0) & (F.col("status_id") == fixed.TRACKING_DONE) & F.col("tracking_id").isNotNull()
    ).select(F.col("crew_service_record_id").alias("service_record_id")).distinct()
    hires = joins.keep_matching(t["tracking_usage"], t["crew"].select("crew_id"), "crew_id")
    return hires.join(tracked.withColumn("tracked", F.lit(True)), "service_record_id", "left")


def recruitment_scorecard(t: Tables, as_of: dt.date) -> DataFrame:
    day = dates.as_date(as_of)
    approved, joined = t["endorsed_ratio"], t["joined_ratio"]
    assessed, hires, digital = t["assessment_compliance"], new_hires(t), t["digitization"]
    exams = filters.within_days(t["passed_assessments"], "created_on", day, before=30)
    by_cell = "recruitment_cell_id"
    included = text.same_text("for_exclusion", "Include")

    def value_is(value):
        return text.same_text("new_value", value)

    def requests(name, source, where=None):
        return Kpi(name, source, "cell_key", "request_id", where=where, group_key="name_key")

    urgent, other = (
        t[name].withColumn("cell_key", F.lower("recruitment_cell")) for name in ("urgent_requests", "non_urgent_requests")
    )
    on_time = text.same_text("compliance", "Compliant")
    kpis = [
        Kpi("endorsed_candidates", approved, by_cell, "crew_id", COUNT, value_is("Endorsed")),
        Kpi("approved_candidates", approved, by_cell, "crew_id", COUNT, value_is("Accepted")),
        Kpi("new_officers_compliant", assessed, by_cell, "crew_id",
            where=included & text.same_text("compliance", "COMPLIANT")),
        Kpi("new_officers", assessed, by_cell, "crew_id", where=included),
        Kpi("new_hires_through_tracking", hires, by_cell, "crew_id", where=F.col("tracked")),
        Kpi("new_hires", hires, by_cell, "crew_id"),
        requests("urgent_requests_on_time", urgent, on_time),
        requests("urgent_requests", urgent),
        requests("non_urgent_requests_on_time", other, on_time),
        requests("non_urgent_requests", other),
        Kpi("officers_passed_assessment", exams, by_cell, "crew_id", where=value_is("Assessment Passed")),
        Kpi("joined_seafarers", joined, by_cell, "crew_id", where=value_is("Joined")),
        Kpi("officers_took_assessment", exams, by_cell, "crew_id"),
        Kpi("endorsed_seafarers", joined, by_cell, "crew_id", COUNT, value_is("Endorsed")),
        Kpi("new_hires_digitised", digital, by_cell, "crew_id", where=F.col("uploads") > 0),
        Kpi("new_hires_for_digitisation", digital, by_cell, "crew_id"),
    ]
    reserved = ["officers_compliant_reserved", "officers_reserved", "approved_reserved"]
    card = scorecard(cells(t), kpis, reserved).select(
        F.lit(day).alias("record_date"), F.col("group_id").alias("recruitment_cell_id"),
        F.col("group_name").alias("recruitment_cell"), *[k.name for k in kpis], *reserved,
    )
    return conform(card, contracts.RECRUITMENT_SCORECARD)


def write_recruitment_scorecard(t: Tables, as_of: dt.date, path: str) -> int:
    card = recruitment_scorecard(t, as_of).drop("record_date")
    return snapshots.replace_snapshot(card, path, "record_date", as_of)
