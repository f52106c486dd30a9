"""The domain plans and their row sets, run over crew tables derived from the supplied tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from muster.gallery import domain_sql as check
from muster.gallery.registry import Registry
from muster.gallery.stand_in import Domain, with_tables
from muster.plans import declared_policy, group_switches, mobilisation, people, recruitment
from muster.sources import contracts, snapshots
from muster.sources.tables import Catalog, shared_folder

registry = Registry()

RUN_DATE = dt.date(2022, 1, 15)


def query(name: str, sql: str | None):
    full = with_tables(sql, check.FAMILIES) if sql else None
    register = registry.query(name, full)

    def wrap(fn):
        register(lambda given: fn(Domain(given)))
        return fn

    return wrap


@query("planned_joiners", check.PLANNED_JOINERS)
def planned_joiners(t: Catalog) -> DataFrame:
    return people.planned_joiners(t, RUN_DATE)


@query("planned_joiners_stored", check.PLANNED_JOINERS)
def planned_joiners_stored(t: Catalog) -> DataFrame:
    spark = t["orders"].sparkSession
    path = shared_folder(spark, "planned")
    for _ in range(2):
        people.write_planned_joiners(t, RUN_DATE, path)
    return spark.read.parquet(path)


@query("group_switches", check.GROUP_SWITCHES)
def switches(t: Catalog) -> DataFrame:
    return group_switches.group_switches(t, RUN_DATE)


@query("group_switches_stored", check.GROUP_SWITCHES)
def switches_stored(t: Catalog) -> DataFrame:
    """Appended for an earlier month, then for the run date: no following service comes in twice."""
    path = shared_folder(t["orders"].sparkSession, "switches")
    for _ in range(2):
        group_switches.append_group_switches(t, RUN_DATE, path)
    return t["orders"].sparkSession.read.parquet(path)


def _three_days(t: Catalog, view: str, write) -> DataFrame:
    spark = t["orders"].sparkSession
    path = shared_folder(spark, view)
    for day in (15, 16, 17):
        run = dt.date(2022, 1, day)
        rows = t[view].withColumn("date", F.lit(run)).withColumn("to_delete", snapshots.retention_flag("date"))
        write({view: rows}, run, path)
    return spark.read.parquet(path)


@query("active_people_snapshot", check.kept_snapshots(
    "active_snapshot", contracts.ACTIVE_SNAPSHOT.names, "lower(crew_pool_status) = 'active' AND row_number = 1"))
def active_people_snapshot(t: Catalog) -> DataFrame:
    return _three_days(t, "active_snapshot", people.write_active_people)


@query("contacts_snapshot_kept", check.kept_snapshots(
    "contacts_snapshot", contracts.CONTACTS_SNAPSHOT.names, "row_number = 1"))
def contacts_snapshot_kept(t: Catalog) -> DataFrame:
    return _three_days(t, "contacts_snapshot", people.write_contacts_made)


@query("recruitment_scorecard", check.recruitment_card())
def recruitment_card(t: Catalog) -> DataFrame:
    return recruitment.recruitment_scorecard(t, RUN_DATE)


@query("recruitment_scorecard_stored", check.recruitment_card())
def recruitment_card_stored(t: Catalog) -> DataFrame:
    spark = t["orders"].sparkSession
    path = shared_folder(spark, "recruitment")
    for _ in range(2):
        recruitment.write_recruitment_scorecard(t, RUN_DATE, path)
    return spark.read.parquet(path)


@query("mobilisation_scorecard", check.mobilisation_card())
def mobilisation_card(t: Domain) -> DataFrame:
    return mobilisation.mobilisation_scorecard(t.run(), RUN_DATE)


@query("mobilisation_scorecard_stored", check.mobilisation_card())
def mobilisation_card_stored(t: Domain) -> DataFrame:
    spark = t["orders"].sparkSession
    path = shared_folder(spark, "mobilisation")
    mobilisation.write_mobilisation_scorecard(t.run(), RUN_DATE, path)
    return spark.read.parquet(path)


@query("mobilisation_scorecard_derived_policy", check.mobilisation_card("f_declared"))
def mobilisation_card_derived(t: Domain) -> DataFrame:
    return mobilisation.mobilisation_scorecard(t.run(), RUN_DATE, derive_policy=True)


def _family(family: str, columns: str, fn) -> None:
    query(f"mobilisation_{family}", f"SELECT {columns} FROM f_{family}")(lambda t: fn(t).select(*columns.split(", ")))


@query("mobilisation_waits", "SELECT crew_id, service_record_id, mobilisation_cell_id, CAST(days AS INTEGER) AS days, count(*) AS weight FROM f_waits GROUP BY ALL")
def waits(t: Catalog) -> DataFrame:
    """Days to mobilise of every joining, with how often it counts in the mean."""
    rows = mobilisation.time_to_mobilise(t, RUN_DATE)
    return rows.groupBy("crew_id", "service_record_id", "mobilisation_cell_id", "days").agg(F.sum("weight").alias("weight"))


_family("training", "crew_id, mobilisation_cell, completed_tn, pending_tn", mobilisation.training_needs)
_family("documents", "document_id, crew_id, mobilisation_cell_id, uploaded_by_unit, vessel_mgmt_type, final_scope",
        lambda t: mobilisation.document_uploads(t, RUN_DATE))
_family("compliance", "crew_id, mobilisation_cell_id, statutory_failing, vms_failing", mobilisation.pre_joining_compliance)
_family("flags", "crew_id, mobilisation_cell_id, failing", mobilisation.flag_compliance)
_family("checklists", "crew_id, mobilisation_cell_id, mob_checklist_id, mob_checklist_status",
        lambda t: mobilisation.checklist_usage(t, RUN_DATE))
_family("readiness", "crew_id, mobilisation_cell_id, compliance", lambda t: mobilisation.readiness(t, RUN_DATE))
_family("acceptance", "crew_id, service_record_id, mobilisation_cell_id, approved_on, weekdays, next_status",
        lambda t: mobilisation.acceptance(t, RUN_DATE))
_family("debriefings", "crew_id, service_record_id, mobilisation_cell_id, compliance",
        lambda t: mobilisation.debriefings(t, RUN_DATE))
_family("relief", "crew_id, planning_cell, relief", lambda t: mobilisation.timely_relief(t, RUN_DATE))
_family("appraisals", "appraisal_id, crew_id, service_record_id, mobilisation_cell_id, days_to_review",
        lambda t: mobilisation.appraisals(t, RUN_DATE))
_family("policy", "crew_id, policy_status, mobilisation_cell_id", mobilisation.policy_status)
_family("declared", "policy_status, crew_id, mobilisation_cell_id", lambda t: declared_policy.declared_policy(t, RUN_DATE))
_family("berths", "berth_id, planning_cell_id, planned_crew_id", mobilisation.berths_to_plan)
