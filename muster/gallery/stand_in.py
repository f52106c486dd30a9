"""Crew-domain tables derived from the supplied star schema.

The domain tables themselves are not supplied, so each is a projection or join of given tables: customers
act as crew, orders as service records, line items as uploads, appraisals, training needs and plan
changes, events as log entries. Every table grows with its source. The text runs both on Spark and on
DuckDB; dates move 24 years forward, so that the run date 2022-01-15 lies inside them.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from muster.sources import contracts
from muster.sources.tables import Catalog, RunScope


def _text(expr: str) -> str:
    return f"CAST({expr} AS STRING)"


def _cell(n: str) -> str:
    """Cell id of a number 0..24; some numbers get ids that the plans treat specially."""
    return (
        f"CASE {n} WHEN 3 THEN 'VGRP00000105' WHEN 7 THEN 'VGRP00000130' WHEN 11 THEN 'VGRP00000117' "
        f"WHEN 12 THEN 'MIGI00000082' WHEN 13 THEN 'VGR400000193' ELSE 'CELL' || {_text(n)} END"
    )


def _cell_name(n: str) -> str:
    return f"CASE {n} WHEN 3 THEN 'IND_F3_Mobilise' WHEN 5 THEN 'TPA_DGS' ELSE 'Cell ' || {_text(n)} END"


def _client(n: str) -> str:
    """Client id of a number 0..24; two numbers are clients that the history merges into one."""
    return f"CASE {n} WHEN 3 THEN 'GLAS00067713' WHEN 8 THEN 'SING00000040' ELSE 'CL' || {_text(n)} END"


def _pick(n: str, *values: str | None) -> str:
    """The value at position n modulo the number of values; None is NULL."""
    arms = " ".join(
        f"WHEN {i} THEN {'NULL' if v is None else repr(v) if isinstance(v, str) else v}" for i, v in enumerate(values)
    )
    return f"CASE ({n}) % {len(values)} {arms} END"


_CREW_LINES = "{lineitem} JOIN {orders} o ON o_orderkey = l_orderkey"
_CREW_LINE_COLUMNS = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_shipdate o_orderkey o_custkey o_orderdate".split()
_LINE_ID = f"{_text('l_orderkey')} || '-' || {_text('l_linenumber')} || '-' || {_text('l_partkey')} || '-' || {_text('l_suppkey')}"
_LATER = "+ INTERVAL 24 YEAR"

TABLES = {
    "crew": f"""
        SELECT 'C' || {_text('c_custkey')} AS crew_id,
               {_pick('c_custkey', 'Canadian', 'Filipino', 'Indian', 'Polish', None)} AS nationality,
               {_pick('c_custkey', 'Internal Supply', 'Internal Supply', None, 'Owner Supplied', 'Third Party', 'Internal Supply')} AS crew_contract_type,
               {_pick('c_custkey', 'VSHP00000001', 'VSHP00000001', None, 'VSHP00000002', 'VSHP00000003', 'VSHP00000001')} AS crew_contract_type_id,
               {_cell('c_nationkey')} AS mobilisation_cell_id, {_cell_name('c_nationkey')} AS mobilisation_cell,
               {_pick('c_custkey', None, 'Office A', 'CSL Australia', 'Office B', 'Office C')} AS mobilisation_office,
               {_pick('c_custkey', None, 'VGR500006541', 'AG1', 'VGRP00071032')} AS third_party_agent_id,
               {_pick('c_custkey', 'EE1', 'VGRP00071032', None)} AS employment_entity_id,
               {_pick('c_custkey', 'VGR500000053', 'CP1', None)} AS crew_pool_list_id,
               'N' || {_text('c_custkey % 4')} AS nationality_id
        FROM {{customer}}""",
    "nationality": f"""
        SELECT DISTINCT 'N' || {_text('c_custkey % 4')} AS nationality_id,
               {_pick('c_custkey', 'Filipino', 'Indian', 'Polish', 'Canadian')} AS description
        FROM {{customer}}""",
    "crew_pool": f"""
        SELECT {_cell('n_nationkey')} AS crew_pool_id, {_cell_name('n_nationkey')} AS crew_pool,
               CASE WHEN n_nationkey % 3 = 2 THEN 6 ELSE 1 END AS crew_pool_type_id,
               CASE WHEN n_nationkey = 20 THEN 0 ELSE 1 END AS is_active
        FROM {{nation}}""",
    "crew_events": f"""
        SELECT 'C' || {_text('user_id')} AS crew_id,
               CASE WHEN event_type = 'signup' AND value > 120 THEN 'Management Transfer' ELSE event_type END AS crew_event_type
        FROM {{events}}""",
    "service_records": f"""
        SELECT 'SR' || {_text('o_orderkey')} AS service_record_id, 'C' || {_text('o_custkey')} AS crew_id,
               'V' || {_text('o_orderkey % 97')} AS vessel_id,
               'VM' || {_text('o_orderkey % 97')} || '-' || {_text('year(o_orderdate)')} AS vessel_mgmt_id,
               'R' || {_text('o_orderkey % 11')} AS rank_id,
               {_pick('o_orderkey', 'VSHP00000349', 'R1', None)} AS rank_id_budgeted,
               {_pick('o_orderkey', 'OB', 'OV', 'OB', 'LE', 'OB')} AS status_id,
               o_orderdate {_LATER} AS start_date,
               CASE o_orderkey % 4 WHEN 0 THEN o_orderdate {_LATER} + INTERVAL 30 DAY
                    WHEN 1 THEN o_orderdate {_LATER} + INTERVAL 120 DAY
                    WHEN 2 THEN o_orderdate {_LATER} + INTERVAL 400 DAY END AS end_date,
               CASE WHEN o_orderkey % 17 = 0 THEN 1 ELSE 0 END AS service_cancelled,
               CASE WHEN o_orderkey % 13 = 0 THEN 1 ELSE 0 END AS previous_experience,
               CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END AS active_status,
               {_pick('o_orderkey', None, 1, 2, 1, 3, 2, 1)} AS service_active_status_id,
               {_pick('o_orderkey', None, 'Standard', 'standard', 'Promotion', 'Standard')} AS sign_on_reason,
               {_pick('o_orderkey', None, 'End of contract', 'Transfer', 'Medical')} AS sign_off_reason,
               CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate {_LATER} + INTERVAL 5 DAY END AS estimated_readiness_date,
               CASE WHEN o_orderkey % 6 > 0 THEN o_orderdate {_LATER} + INTERVAL 2 DAY END AS mobilisation_accepted_on,
               CASE WHEN o_orderkey % 3 > 0 THEN {_client('o_orderkey % 25')} END AS service_vessel_client_id,
               'U' || {_text('o_orderkey % 7')} AS updated_by_id,
               CAST(o_orderkey % 200 AS INT) AS sea_days, 'LN' || {_text('o_orderkey % 50')} AS lineup_id_joiner
        FROM {{orders}}""",
    "vessel": f"""
        SELECT DISTINCT 'V' || {_text('o_orderkey % 97')} AS vessel_id,
               {_pick('o_orderkey % 97', 'Cargo', 'Cargo', 'Passenger/Ferry', 'cargo', 'Offshore', 'Leisure')} AS vessel_business,
               CASE WHEN o_orderkey % 97 % 2 = 0 THEN {_client('o_orderkey % 97 % 25')} END AS ship_owner_id
        FROM {{orders}}""",
    "mgmt_records": f"""
        SELECT 'VM' || {_text('v')} || '-' || {_text('y')} AS vessel_mgmt_id, 'V' || {_text('v')} AS vessel_id,
               {_pick('v + y', 'Full Management', 'Tech Mgmt', 'Crew Mgmt', 'Tech Mgmt', 'Commercial')} AS vessel_mgmt_type,
               {_client('(v + y) % 25')} AS client_id, first_day AS mgmt_start,
               CASE WHEN y % 3 > 0 THEN last_day + INTERVAL 150 DAY END AS mgmt_end, first_day AS purchasing_start_date
        FROM (SELECT o_orderkey % 97 AS v, year(o_orderdate) AS y, min(o_orderdate {_LATER}) AS first_day,
                     max(o_orderdate {_LATER}) AS last_day
              FROM {{orders}} GROUP BY o_orderkey % 97, year(o_orderdate)) periods""",
    "ranks": f"""
        SELECT DISTINCT 'R' || {_text('o_orderkey % 11')} AS rank_id,
               {_pick('o_orderkey % 11', 'Ratings', 'Officers', 'Offshore Ratings', 'Ratings')} AS rank_category
        FROM {{orders}}""",
    "company": f"""
        SELECT {_client('n_nationkey')} AS company_id,
               CASE n_nationkey WHEN 4 THEN 'ADNOC Logistics & Services' ELSE 'Client ' || n_name END AS company_name
        FROM {{nation}}
        UNION ALL SELECT DISTINCT 'VGRP00071032', 'Agency' FROM {{region}} WHERE r_regionkey = 0""",
    "country": f"""
        SELECT 'CT' || {_text('n_nationkey')} AS country_id,
               CASE n_nationkey WHEN 1 THEN 'Malta' WHEN 2 THEN 'PANAMA' ELSE n_name END AS country_name
        FROM {{nation}}""",
    "date_dimension": f"""
        SELECT DISTINCT CAST(l_shipdate {_LATER} AS DATE) AS date,
               CAST(year(l_shipdate {_LATER}) * 10000 + month(l_shipdate) * 100 + day(l_shipdate) AS INT) AS date_key
        FROM {{lineitem}}""",
    "crew_current_status": f"""
        SELECT 'C' || {_text('c_custkey')} AS crew_id, {_cell_name('c_nationkey')} AS mobilisation_cell,
               {_cell_name('c_custkey % 25')} AS planning_cell,
               {_pick('c_custkey', 'Active', 'ACTIVE', 'Inactive', 'Active')} AS crew_pool_status,
               {_pick('c_custkey', 'ONBOARD', 'Onboard', 'LEAVE')} AS current_status,
               {_pick('c_custkey', 'Full Management', 'Tech Mgmt', 'Crew Mgmt', 'Full Management', 'Tech Mgmt')} AS management_type,
               {_pick('c_custkey', 'CARGO', 'Cargo', 'LEISURE', 'CARGO', 'CARGO', 'CARGO', 'CARGO')} AS segment,
               {_pick('c_custkey', None, 'Internal', 'Owner Supplied', 'Internal')} AS supply_type,
               {_pick('c_custkey', 'Ratings', 'Officers', 'Offshore Ratings')} AS rank_category,
               last_day AS current_status_start_date, last_day + INTERVAL 90 DAY AS current_status_end_date,
               first_day + INTERVAL 900 DAY AS contract_end_date
        FROM {{customer}} LEFT JOIN (
            SELECT o_custkey, min(o_orderdate {_LATER}) AS first_day, max(o_orderdate {_LATER}) AS last_day
            FROM {{orders}} GROUP BY o_custkey) o ON o_custkey = c_custkey""",
    "training_need": f"""
        SELECT 'TN' || {_LINE_ID} AS training_need_id, 'C' || {_text('o_custkey')} AS crew_id,
               'Course ' || {_text('l_partkey')} AS course_description,
               {_pick('l_partkey', 'Completed', 'Open', 'Cancelled', 'completed', None)} AS status,
               l_shipdate {_LATER} AS raised_on
        FROM {_CREW_LINES}""",
    "document_uploads": f"""
        SELECT 'D' || {_text('l_partkey')} || '-' || {_text('l_orderkey % 7')} AS document_id, 'C' || {_text('o_custkey')} AS crew_id,
               'V' || {_text('l_orderkey % 97')} AS vessel_id, {_cell('l_partkey % 25')} AS mobilisation_cell_id,
               {_pick('l_partkey', 'Passport', 'Visa - MCV', 'Course', 'Medical')} AS document_name,
               {_pick('l_linenumber', 'IN SCOPE', 'Out of scope', None)} AS document_scope,
               {_pick('l_suppkey', 'Seafarer', 'Office', 'SEAFARER')} AS uploaded_by_unit,
               'CT' || {_text('l_suppkey % 30')} AS issued_country_id, l_shipdate {_LATER} AS uploaded_on
        FROM {_CREW_LINES}""",
    "compliance_trends": f"""
        SELECT CASE WHEN l_quantity > 10 THEN DATE '2022-01-14' ELSE DATE '2022-01-07' END AS record_inserted_on,
               'C' || {_text('o_custkey')} AS crew_id, 'V' || {_text('o_orderkey % 97')} AS vessel_id,
               'VM' || {_text('o_orderkey % 97')} || '-' || {_text('year(o_orderdate)')} AS vessel_mgmt_id,
               {_cell('o_custkey % 25')} AS mobilisation_cell_id, {_pick('l_partkey', 'Onboard', 'ONBOARD', 'Reliever')} AS crew_status,
               {_pick('l_suppkey', 'Included', 'Included', 'Excluded')} AS vessel_in_scope,
               {_pick('l_partkey', 'Yes', 'YES', 'No', 'yes')} AS default_template, 'Mandatory' AS template_requirement,
               {_pick('l_linenumber', 'Red', 'Orange')} AS course_color_category, 'Old Training' AS training_type,
               {_pick('l_suppkey', 'YES', 'No')} AS is_flag_document,
               {_pick('l_partkey', 0, 0, 1, 0, None)} AS statutory_non_compliant_documents,
               {_pick('l_suppkey', 0, 1, 0)} AS vms_non_compliant_documents
        FROM {_CREW_LINES}""",
    "mob_checklist": f"""
        SELECT 'MC' || {_text('o_orderkey')} AS mob_checklist_id, {_pick('o_orderkey', 'Signed', 'Open')} AS mob_checklist_status,
               {_pick('o_orderkey', 'GLAS00000002', 'GLAS00000003', 'GLAS00000001')} AS mob_checklist_status_id,
               'SR' || {_text('o_orderkey')} AS linked_service_record_id,
               CASE WHEN o_orderkey % 9 = 0 THEN 1 ELSE 0 END AS mob_checklist_deleted
        FROM {{orders}}""",
    "planning_history": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, 'SR' || {_text('l_orderkey')} AS service_record_id,
               {_pick('l_linenumber + l_partkey', 'Approved', 'Ready', 'Approved', 'Released', 'Cancelled', 'Ready')} AS planning_status_new,
               l_shipdate {_LATER} AS updated_on
        FROM {_CREW_LINES}""",
    "debriefing": f"""
        SELECT 'SR' || {_text('l_orderkey')} AS service_record_id, CAST({_pick('l_partkey', 1, 3, 2, 3)} AS INT) AS debriefing_status_id,
               CASE WHEN l_linenumber < 6 THEN o_orderdate {_LATER} + INTERVAL 130 DAY ELSE l_shipdate {_LATER} END AS seafarer_contacted_on
        FROM {_CREW_LINES} WHERE l_linenumber < 7""",
    "appraisal": f"""
        SELECT 'AP' || {_LINE_ID} AS appraisal_id, 'C' || {_text('o_custkey')} AS crew_id_appraisee,
               'SR' || {_text('l_orderkey')} AS service_record_id_appraisee,
               {_pick('l_partkey', 'Completed', 'completed', 'Draft')} AS appraisal_status,
               l_shipdate {_LATER} AS created_on, l_shipdate {_LATER} AS report_date,
               CASE l_linenumber % 3 WHEN 0 THEN l_shipdate {_LATER} + INTERVAL 10 DAY
                    WHEN 1 THEN l_shipdate {_LATER} + INTERVAL 20 DAY END AS reviewed_on,
               CASE WHEN l_partkey % 19 = 0 THEN 1 ELSE 0 END AS is_deleted
        FROM {_CREW_LINES}""",
    "details_change_log": f"""
        SELECT 'C' || {_text('user_id * 7')} AS fk_matched_id,
               CASE WHEN event_type IN ('click', 'view') THEN 'GLAS00000003' ELSE 'GLAS00000001' END AS event_id,
               CASE WHEN event_id % 10 > 0 THEN {_cell_name('event_id % 25')} END AS new_value, ts - INTERVAL 1 YEAR AS created_on
        FROM {{events}}""",
    "berths_snapshot": f"""
        SELECT 'B' || {_text('l_partkey')} || '-' || {_text('l_linenumber')} AS berth_id,
               {_pick('l_partkey', 'VSHP00000001', 'VSHP00000001', 'VSHP00000009')} AS berth_type_id,
               'R' || {_text('l_orderkey % 11')} AS rank_id, 'V' || {_text('o_orderkey % 97')} AS vessel_id,
               'VM' || {_text('o_orderkey % 97')} || '-' || {_text('year(o_orderdate)')} AS vessel_mgmt_id,
               {_cell('l_suppkey % 25')} AS planning_cell_id,
               CASE WHEN l_linenumber % 2 = 0 THEN 'C' || {_text('o_custkey')} END AS planned_crew_id,
               CASE WHEN l_linenumber = 5 THEN 1 ELSE 0 END AS is_reliever_not_required,
               CASE WHEN l_partkey % 4 > 0 THEN CAST(l_partkey % 60 - 10 AS INT) END AS days_remaining,
               CASE WHEN l_quantity > 10 THEN DATE '2022-01-14' ELSE DATE '2022-01-07' END AS record_insert_date
        FROM {_CREW_LINES}""",
    "policy_check": f"""
        SELECT 'C' || {_text('c_custkey')} AS crew_id, {_pick('c_custkey', 'Signed', 'Missing', 'SIGNED')} AS policy_status,
               {_pick('c_custkey', 'Standard', 'STANDARD', 'Promotion', 'Standard')} AS reason_for_sign_on
        FROM {{customer}}""",
    "policy": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, 'SR' || {_text('o_orderkey')} AS service_record_id,
               CASE WHEN o_orderkey % 4 = 0 THEN 1 ELSE 0 END AS is_policy_agreed,
               CASE WHEN o_orderkey % 3 > 0 THEN o_orderdate {_LATER} - INTERVAL 40 DAY END AS agreed_on
        FROM {{orders}} WHERE o_orderpriority = '1-URGENT'""",
    "policy_attachments": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, 'SR' || {_text('o_orderkey')} AS fk_document_id
        FROM {{orders}} WHERE o_orderpriority = '5-LOW'""",
    "vessel_metrics": f"""
        SELECT 'V' || {_text('v')} AS vessel_id, last_day AS date,
               {_pick('v', 'Full Management', 'Tech Mgmt', 'Crew Mgmt', 'Full Management')} AS mgmt_type,
               {_pick('v', 'Office A', 'Office B', 'Office A', 'CSL Australia', None)} AS technical_office
        FROM (SELECT DISTINCT o_orderkey % 97 AS v, DATE '2022-01-14' AS last_day FROM {{orders}}
              UNION ALL SELECT DISTINCT o_orderkey % 97, DATE '2022-01-13' FROM {{orders}}) days""",
    "endorsed_ratio": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, {_pick('o_orderkey', 'Endorsed', 'Accepted', 'ENDORSED', 'Other')} AS new_value,
               {_cell('o_orderkey % 25')} AS recruitment_cell_id FROM {{orders}}""",
    "joined_ratio": f"""
        SELECT CASE WHEN o_orderkey % 10 > 0 THEN 'C' || {_text('o_custkey')} END AS crew_id,
               {_pick('o_orderkey', 'Joined', 'Endorsed', 'JOINED')} AS new_value,
               CASE WHEN o_orderkey % 25 = 24 THEN 'UNKNOWN' ELSE {_cell('o_orderkey % 25')} END AS recruitment_cell_id FROM {{orders}}""",
    "assessment_compliance": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, {_pick('o_orderkey', 'COMPLIANT', 'Compliant', 'NOT COMPLIANT')} AS compliance,
               {_pick('o_orderkey', 'Include', 'Exclude', 'INCLUDE', 'Include', None)} AS for_exclusion,
               {_cell('o_custkey % 25')} AS recruitment_cell_id FROM {{orders}}""",
    "tracking_usage": f"""
        SELECT 'C' || {_text('o_custkey + o_orderkey % 3')} AS crew_id, 'SR' || {_text('o_orderkey')} AS service_record_id,
               {_cell('o_custkey % 25')} AS recruitment_cell_id FROM {{orders}}""",
    "recruitment_tracking": f"""
        SELECT 'T' || {_LINE_ID} AS tracking_id, 'SR' || {_text('l_orderkey')} AS crew_service_record_id,
               CASE WHEN l_linenumber = 7 THEN 1 ELSE 0 END AS is_deleted, CAST({_pick('l_partkey', 11, 10, 9)} AS INT) AS status_id
        FROM {{lineitem}}""",
    "urgent_requests": f"""
        SELECT 'RR' || {_text('l_orderkey')} AS request_id, {_cell_name('l_partkey % 25')} AS recruitment_cell,
               {_pick('l_suppkey', 'Compliant', 'COMPLIANT', 'Late')} AS compliance FROM {{lineitem}} WHERE l_returnflag = 'R'""",
    "non_urgent_requests": f"""
        SELECT 'RR' || {_text('l_orderkey')} AS request_id, {_cell_name('l_partkey % 25')} AS recruitment_cell,
               {_pick('l_suppkey', 'Compliant', 'Late')} AS compliance FROM {{lineitem}} WHERE l_returnflag <> 'R'""",
    "passed_assessments": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, {_pick('o_orderkey', 'Assessment Passed', 'Assessment Failed')} AS new_value,
               {_cell('o_custkey % 25')} AS recruitment_cell_id, o_orderdate {_LATER} + INTERVAL 11 HOUR AS created_on FROM {{orders}}""",
    "digitization": f"""
        SELECT 'C' || {_text('c_custkey')} AS crew_id, {_cell('c_custkey % 25')} AS recruitment_cell_id,
               CAST(c_custkey % 4 AS INT) AS uploads FROM {{customer}}""",
    "next_planned": f"""
        SELECT 'C' || {_text('o_custkey')} AS crew_id, 'SR' || {_text('o_orderkey')} AS service_record_id,
               {_pick('o_orderkey', 'Approved', 'Ready', None)} AS planning_status, 'R' || {_text('o_orderkey % 11')} AS rank_id,
               o_orderdate {_LATER} AS start_date, o_orderdate {_LATER} + INTERVAL 120 DAY AS end_date,
               'Rank ' || {_text('o_orderkey % 11')} AS rank, CAST(o_orderkey % 11 AS INT) AS rank_sequence,
               {_pick('o_orderkey', 'Ratings', 'Officers')} AS rank_category, 'Deck' AS rank_department,
               CAST(o_orderkey % 2 AS INT) AS is_outside_service, 'V' || {_text('o_orderkey % 97')} AS planned_vessel_id,
               'Vessel ' || {_text('o_orderkey % 97')} AS planned_vessel,
               'VM' || {_text('o_orderkey % 97')} || '-' || {_text('year(o_orderdate)')} AS planned_vessel_mgmt_id,
               'Fleet ' || {_text('o_orderkey % 5')} AS planned_vessel_fleet, 'CL' || {_text('o_orderkey % 25')} AS planned_vessel_client,
               'Full Management' AS planned_vessel_mgmt_type, 'CARGO' AS planned_vessel_segment, 'Tanker' AS planned_vessel_type,
               'Wet' AS planned_vessel_general_type_group, 'Office ' || {_text('o_orderkey % 3')} AS planned_vessel_technical_office,
               CAST(o_orderkey % 200 AS INT) AS sea_days, CAST(o_orderkey % 3 AS INT) AS order_of_future_services
        FROM {{orders}}""",
    "line_ups": f"""
        SELECT DISTINCT 'LN' || {_text('o_orderkey % 50')} AS line_up_id, 'Line-up ' || {_text('o_orderkey % 50')} AS line_up_description,
               DATE '2021-12-01' AS line_up_created_on
        FROM {{orders}} WHERE o_orderkey % 50 < 40""",
}


def _by_contract(contract: T.StructType, special: dict[str, str]) -> str:
    """A view over customers with every column of a contract: text, numbers and times made from the key."""
    make = {
        T.StringType: lambda i, n: f"'{n} ' || {_text(f'c_custkey % {i + 2}')}",
        T.IntegerType: lambda i, n: f"CAST(c_custkey % {i + 2} AS INT)",
        T.DateType: lambda i, n: "CAST(last_day AS DATE)",
        T.TimestampNTZType: lambda i, n: f"CASE WHEN c_custkey % {i + 2} > 0 THEN last_day + INTERVAL {i} DAY END",
    }
    columns = [
        f"{special.get(f.name) or make[type(f.dataType)](i, f.name)} AS {f.name}" for i, f in enumerate(contract.fields)
    ]
    return f"""
        SELECT {", ".join(columns)} FROM {{customer}}
        JOIN (SELECT o_custkey, max(o_orderdate {_LATER}) AS last_day FROM {{orders}} GROUP BY o_custkey) o ON o_custkey = c_custkey"""


_PERSON = {"crew_id": f"'C' || {_text('c_custkey')}", "row_number": "CAST(c_custkey % 5 + 1 AS INT) % 3", "date": "DATE '2022-01-15'"}
TABLES["active_snapshot"] = _by_contract(
    contracts.ACTIVE_SNAPSHOT, {**_PERSON, "crew_pool_status": _pick("c_custkey", "ACTIVE", "Active", "Inactive")}
)
TABLES["contacts_snapshot"] = _by_contract(contracts.CONTACTS_SNAPSHOT, _PERSON)


def table(t: Catalog, text: str) -> DataFrame:
    # The plans deal rows out where they need it; a dealing before the join of the sources would only add an exchange.
    text = re.sub(r"/\*\+.*?\*/", "", text)
    sources = {s: t[s] for s in _sources(text)}
    return next(iter(sources.values())).sparkSession.sql(text, **sources)


class Domain(Catalog):
    """Derived tables by name, each built on first use."""

    def __init__(self, given: Catalog, extra: Mapping[str, str] | None = None):
        super().__init__(given._spark, given._base)
        self._given = given
        self._texts = {**TABLES, **(extra or {})}

    def run(self) -> RunScope:
        """The tables for a run that reads many of them: lines are joined with orders once, and all tables made from both read that."""
        scope = RunScope(self)
        columns = ", ".join(_CREW_LINE_COLUMNS)
        joined = scope.shared("crew_lines", lambda: table(self._given, f"SELECT {columns} FROM {_CREW_LINES}"))
        self._given = Catalog(self._spark, self._base, **{**self._given, "crew_lines": joined})
        self._texts = {n: text.replace(_CREW_LINES, "{crew_lines}") for n, text in self._texts.items()}
        return scope

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._open:
            derived = name in self._texts
            self._open[name] = table(self._given, self._texts[name]) if derived else self._given[name]
        return self._open[name]


def with_tables(sql: str, extra: Mapping[str, str] | None = None) -> str:
    """The query preceded by the definitions of the derived tables it names, for DuckDB."""
    known = {**TABLES, **(extra or {})}
    needed: list[str] = []
    seen: set[str] = set()

    def visit(text: str) -> None:
        for name in known:
            if name not in seen and re.search(rf"\b{name}\b", text):
                seen.add(name)
                visit(known[name])
                needed.append(name)

    visit(sql)
    plain = {s: s for s in _sources(" ".join(TABLES.values()))}
    ctes = ",\n".join(f"{n} AS ({known[n].format(**plain)})" for n in needed)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"


def _sources(text: str) -> list[str]:
    return sorted(set(re.findall(r"\{(\w+)\}", text)))
