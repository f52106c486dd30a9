"""Check SQL for the domain plans: each row set written as set logic for DuckDB, over the derived tables."""

from __future__ import annotations

from muster.plans import fixed_values as fixed


def _in(values) -> str:
    return "(" + ", ".join("'" + str(v).replace("'", "''") + "'" for v in values) + ")"


def _lower_in(values) -> str:
    return _in([v.lower() for v in values])


DAY = "DATE '2022-01-15'"
SHIP, ALL_MGMT = _lower_in(fixed.SHIP_MANAGEMENT), _lower_in(fixed.CREW_AND_SHIP_MANAGEMENT)
RETIRED = _in(fixed.RETIRED_INDIA_CELLS)

FAMILIES = {
    "x_moved": f"SELECT DISTINCT crew_id FROM crew_events WHERE lower(crew_event_type) = lower('{fixed.TRANSFER_EVENT}')",
    "x_service": """
        SELECT s.*, m.vessel_mgmt_type, m.client_id, v.vessel_business, k.rank_category
        FROM service_records s LEFT JOIN mgmt_records m ON m.vessel_mgmt_id = s.vessel_mgmt_id
        LEFT JOIN vessel v ON v.vessel_id = s.vessel_id LEFT JOIN ranks k ON k.rank_id = s.rank_id""",
    "x_person": f"""
        SELECT * FROM crew WHERE coalesce(crew_contract_type_id, '-') <> '{fixed.OWNER_SUPPLIED_CONTRACT}'
          AND crew_id NOT IN (SELECT crew_id FROM x_moved)""",
    "x_sea": f"""
        SELECT * FROM x_service WHERE service_cancelled = 0 AND previous_experience = 0 AND status_id IN ('OB', 'OV')
          AND coalesce(service_active_status_id, 0) <> 3""",
    "x_joiner": f"""
        SELECT s.*, p.nationality, p.mobilisation_cell_id FROM x_sea s JOIN x_person p ON p.crew_id = s.crew_id
        WHERE CAST(start_date AS DATE) BETWEEN {DAY} - 30 AND {DAY}
          AND lower(coalesce(sign_on_reason, 'standard')) = 'standard'""",
    "f_training": f"""
        WITH ob AS (
          SELECT DISTINCT crew_id, mobilisation_cell, current_status_start_date, current_status_end_date FROM crew_current_status
          WHERE lower(crew_pool_status) = 'active' AND lower(current_status) = 'onboard' AND lower(management_type) IN {SHIP}
            AND lower(segment) = 'cargo' AND coalesce(lower(supply_type), '-') <> 'owner supplied'
            AND lower(mobilisation_cell) NOT IN {_lower_in(fixed.CELL_NAMES_NOT_ONBOARD)}),
        n AS (
          SELECT ob.crew_id, count(*) FILTER (lower(status) = 'completed') AS completed_tn,
                 count(*) FILTER (lower(status) <> 'completed') AS pending_tn
          FROM ob JOIN training_need t ON t.crew_id = ob.crew_id
          WHERE lower(status) <> 'cancelled' AND raised_on >= DATE '2023-01-01'
            AND NOT coalesce(CAST(raised_on AS DATE) >= CAST(current_status_start_date AS DATE), false)
          GROUP BY ob.crew_id)
        SELECT ob.*, completed_tn, pending_tn, completed_tn + pending_tn AS all_tn
        FROM ob JOIN n ON n.crew_id = ob.crew_id WHERE ob.crew_id NOT IN (SELECT crew_id FROM x_moved)""",
    "f_documents": f"""
        WITH d AS (
          SELECT row_number() OVER () AS id, u.*, c.nationality FROM document_uploads u JOIN crew c ON c.crew_id = u.crew_id
          WHERE strftime(uploaded_on, '%Y-%m') = '2022-01' AND coalesce(lower(crew_contract_type), '-') <> 'owner supplied'
            AND u.crew_id NOT IN (SELECT crew_id FROM x_moved)
            AND u.mobilisation_cell_id NOT IN {_in(fixed.AGENCY_CELLS + fixed.RETIRED_INDIA_CELLS)}
            AND NOT coalesce(nationality = 'Canadian' AND u.mobilisation_cell_id = '{fixed.CANADIAN_EXEMPT_CELL}', false)),
        m AS (
          SELECT d.id, arg_max(r.vessel_mgmt_type, (r.mgmt_start, r.vessel_mgmt_id)) AS vessel_mgmt_type
          FROM d JOIN mgmt_records r ON r.vessel_id = d.vessel_id
            AND CAST(d.uploaded_on AS DATE) BETWEEN r.mgmt_start AND coalesce(r.mgmt_end, {DAY})
          GROUP BY d.id)
        SELECT d.document_id, d.crew_id, d.mobilisation_cell_id, d.uploaded_by_unit, m.vessel_mgmt_type,
          CASE WHEN lower(document_scope) = 'out of scope' OR document_name = '{fixed.CREW_VISA}'
                 OR lower(country_name) IN {_lower_in(fixed.FLAG_COUNTRIES)} THEN 'OUT OF SCOPE' ELSE 'IN SCOPE' END AS final_scope
        FROM d JOIN m ON m.id = d.id LEFT JOIN country ON country_id = issued_country_id
        WHERE lower(vessel_mgmt_type) IN {SHIP}""",
    "x_mandatory": f"""
        SELECT a.* FROM compliance_trends a JOIN mgmt_records m ON m.vessel_mgmt_id = a.vessel_mgmt_id
        JOIN vessel v ON v.vessel_id = a.vessel_id
        WHERE record_inserted_on = (SELECT max(record_inserted_on) FROM compliance_trends)
          AND lower(vessel_in_scope) = 'included' AND lower(default_template) = 'yes' AND lower(crew_status) = 'onboard'
          AND lower(template_requirement) = 'mandatory' AND lower(course_color_category) = 'red'
          AND lower(training_type) = 'old training' AND lower(m.vessel_mgmt_type) IN {SHIP} AND lower(vessel_business) = 'cargo'
          AND a.mobilisation_cell_id NOT IN {RETIRED} AND a.crew_id NOT IN (SELECT crew_id FROM x_moved)""",
    "f_compliance": """
        SELECT record_inserted_on, crew_id, mobilisation_cell_id,
               CAST(sum(statutory_non_compliant_documents) AS BIGINT) AS statutory_failing,
               CAST(sum(vms_non_compliant_documents) AS BIGINT) AS vms_failing
        FROM x_mandatory GROUP BY ALL""",
    "f_flags": """
        SELECT record_inserted_on, crew_id, mobilisation_cell_id,
               CAST(sum(statutory_non_compliant_documents) + sum(vms_non_compliant_documents) AS BIGINT) AS failing
        FROM x_mandatory WHERE lower(is_flag_document) = 'yes'
          AND crew_id IN (SELECT crew_id FROM crew WHERE lower(crew_contract_type) = 'internal supply') GROUP BY ALL""",
    "f_checklists": f"""
        SELECT j.crew_id, j.mobilisation_cell_id, c.mob_checklist_id, c.mob_checklist_status
        FROM x_joiner j JOIN company ON company_id = j.client_id
        LEFT JOIN (SELECT * FROM mob_checklist WHERE mob_checklist_deleted = 0
                   AND mob_checklist_status_id IN {_in(fixed.CHECKLIST_STATUSES)}) c ON c.linked_service_record_id = j.service_record_id
        WHERE lower(vessel_mgmt_type) IN {ALL_MGMT} AND lower(company_name) NOT IN {_lower_in(fixed.CLIENTS_WITHOUT_CHECKLIST)}
          AND mobilisation_cell_id NOT IN {_in(fixed.AGENCY_CELLS + fixed.RETIRED_INDIA_CELLS)}
          AND NOT coalesce(nationality = 'Canadian' AND mobilisation_cell_id = '{fixed.CANADIAN_EXEMPT_CELL}', false)""",
    "f_readiness": f"""
        SELECT j.crew_id, j.mobilisation_cell_id,
          CASE WHEN CAST(h.updated_on AS DATE) <= CAST(estimated_readiness_date AS DATE) THEN 'Compliant' ELSE 'Non Compliant' END AS compliance
        FROM x_joiner j LEFT JOIN planning_history h ON h.service_record_id = j.service_record_id AND h.planning_status_new = 'Ready'
        WHERE vessel_id NOT IN {_in(fixed.VESSELS_NOT_RELIABILITY)} AND lower(vessel_business) <> 'offshore'
          AND lower(vessel_mgmt_type) IN {ALL_MGMT} AND mobilisation_cell_id NOT IN {_in(fixed.LEISURE_CELLS)}""",
    "f_acceptance": f"""
        WITH a AS (
          SELECT h.crew_id, h.service_record_id, h.updated_on AS approved_on, p.mobilisation_cell_id,
                 (date_diff('day', mobilisation_accepted_on, h.updated_on) + 1)
                   - 2 * (floor(date_diff('day', DATE '1899-12-31', h.updated_on) / 7.0)
                          - floor(date_diff('day', DATE '1899-12-31', mobilisation_accepted_on) / 7.0)) AS weekdays,
                 dense_rank() OVER (PARTITION BY h.crew_id ORDER BY h.updated_on DESC) AS rk
          FROM planning_history h JOIN x_service s ON s.service_record_id = h.service_record_id JOIN crew p ON p.crew_id = h.crew_id
          WHERE h.planning_status_new = 'Approved' AND strftime(h.updated_on, '%Y-%m') = '2021-12' AND status_id IN ('OB', 'OV')
            AND service_cancelled = 0 AND previous_experience = 0 AND vessel_id NOT IN {_in(fixed.VESSELS_NOT_RELIABILITY)}
            AND lower(vessel_mgmt_type) IN {ALL_MGMT} AND lower(vessel_business) IN {_lower_in(fixed.ACCEPTANCE_BUSINESS)}
            AND p.mobilisation_cell_id NOT IN {RETIRED}
            AND coalesce(crew_contract_type_id, '-') <> '{fixed.OWNER_SUPPLIED_CONTRACT}'
            AND s.crew_id NOT IN (SELECT crew_id FROM x_moved)),
        nxt AS (
          SELECT a.crew_id, a.service_record_id, h.planning_status_new,
                 dense_rank() OVER (PARTITION BY a.crew_id, a.service_record_id ORDER BY h.updated_on) AS rk
          FROM a JOIN planning_history h ON h.crew_id = a.crew_id AND h.service_record_id = a.service_record_id
          WHERE CAST(h.updated_on AS DATE) > CAST(a.approved_on AS DATE)),
        f AS (SELECT DISTINCT crew_id, service_record_id, planning_status_new AS next_status FROM nxt WHERE rk = 1)
        SELECT a.crew_id, a.service_record_id, mobilisation_cell_id, approved_on, CAST(weekdays AS INT) AS weekdays, next_status
        FROM a LEFT JOIN f ON f.crew_id = a.crew_id AND f.service_record_id = a.service_record_id
        WHERE a.rk = 1 AND coalesce(next_status, '-') NOT IN ('Released', 'Cancelled')""",
    "f_debriefings": f"""
        SELECT s.crew_id, s.service_record_id, p.mobilisation_cell_id,
          CASE WHEN date_diff('day', end_date + INTERVAL 15 DAY, seafarer_contacted_on) <= 0 THEN 1 ELSE 0 END AS compliance
        FROM x_sea s JOIN x_person p ON p.crew_id = s.crew_id
        LEFT JOIN (SELECT * FROM debriefing WHERE debriefing_status_id IN (1, 3)) b ON b.service_record_id = s.service_record_id
        WHERE active_status = 0 AND lower(vessel_mgmt_type) IN {ALL_MGMT} AND CAST(end_date AS DATE) > CAST(start_date AS DATE)
          AND (sign_off_reason IS NULL OR lower(sign_off_reason) NOT IN {_lower_in(fixed.SIGN_OFFS_NOT_DEBRIEFED)})
          AND mobilisation_cell_id NOT IN {RETIRED} AND coalesce(debriefing_status_id, 3) <> 1
          AND CAST(end_date + INTERVAL 15 DAY AS DATE) BETWEEN {DAY} - 30 AND {DAY}""",
    "f_relief": f"""
        SELECT crew_id, planning_cell,
          CASE WHEN date_diff('day', contract_end_date, {DAY}) > 30 THEN 'Overdue' ELSE 'Timely Relieved' END AS relief
        FROM crew_current_status WHERE lower(current_status) = 'onboard' AND lower(rank_category) IN {_lower_in(fixed.RATINGS)}
          AND lower(management_type) IN {SHIP} AND crew_id NOT IN (SELECT crew_id FROM x_moved)""",
    "f_appraisals": f"""
        WITH a AS (
          SELECT ap.appraisal_id, ap.crew_id_appraisee AS crew_id, s.service_record_id, ap.created_on, ap.reviewed_on, s.end_date,
                 p.mobilisation_cell_id AS present_cell
          FROM appraisal ap JOIN x_service s ON s.service_record_id = ap.service_record_id_appraisee
          JOIN x_person p ON p.crew_id = ap.crew_id_appraisee
          WHERE is_deleted = 0 AND active_status = 0 AND year(end_date) >= 2022 AND lower(appraisal_status) = 'completed'
            AND lower(rank_category) IN {_lower_in(fixed.RATINGS)} AND lower(vessel_mgmt_type) IN {SHIP}
            AND lower(vessel_business) = 'cargo'),
        l AS (
          SELECT a.appraisal_id, arg_max(g.new_value, (g.created_on, g.new_value)) AS cell
          FROM a JOIN details_change_log g ON g.fk_matched_id = a.crew_id AND CAST(g.created_on AS DATE) <= CAST(a.end_date AS DATE)
          WHERE g.event_id = '{fixed.CELL_CHANGE_EVENT}' AND g.new_value IS NOT NULL GROUP BY a.appraisal_id),
        b AS (
          SELECT a.*, coalesce(crew_pool_id, present_cell) AS mobilisation_cell_id
          FROM a LEFT JOIN l ON l.appraisal_id = a.appraisal_id LEFT JOIN crew_pool ON lower(crew_pool) = lower(l.cell)),
        c AS (
          SELECT *, dense_rank() OVER (PARTITION BY crew_id, service_record_id ORDER BY created_on DESC) AS rk
          FROM b WHERE mobilisation_cell_id NOT IN {RETIRED})
        SELECT appraisal_id, crew_id, service_record_id, mobilisation_cell_id,
               CAST(date_diff('day', created_on, reviewed_on) AS INT) AS days_to_review
        FROM c WHERE rk = 1""",
    "f_policy": """
        SELECT d.crew_id, policy_status, reason_for_sign_on, mobilisation_cell_id
        FROM policy_check d LEFT JOIN crew c ON c.crew_id = d.crew_id
        WHERE lower(reason_for_sign_on) = 'standard' AND d.crew_id NOT IN (SELECT crew_id FROM x_moved)""",
    "f_waits": f"""
        WITH j AS (
          SELECT s.crew_id, s.service_record_id, s.mobilisation_cell_id, CAST(s.start_date AS DATE) AS start_day,
                 (SELECT max(CAST(updated_on AS DATE)) FROM planning_history h
                  WHERE h.service_record_id = s.service_record_id AND planning_status_new = 'Approved') AS approved_day
          FROM (SELECT s.*, p.mobilisation_cell_id FROM x_sea s JOIN crew p ON p.crew_id = s.crew_id
                WHERE CAST(start_date AS DATE) BETWEEN {DAY} - 30 AND {DAY}
                  AND lower(coalesce(sign_on_reason, 'standard')) = 'standard'
                  AND coalesce(crew_contract_type_id, '-') <> '{fixed.OWNER_SUPPLIED_CONTRACT}') s
          WHERE lower(vessel_mgmt_type) IN {SHIP} AND lower(vessel_business) <> 'offshore' AND mobilisation_cell_id NOT IN {RETIRED}),
        v AS (
          SELECT j.crew_id, s.start_date, dense_rank() OVER (PARTITION BY j.crew_id ORDER BY s.start_date DESC NULLS LAST) AS rk
          FROM j JOIN service_records s ON s.crew_id = j.crew_id
          WHERE service_cancelled = 0 AND previous_experience = 0 AND active_status = 0
            AND coalesce(service_active_status_id, 1) IN (1, 2) AND status_id = 'LE')
        SELECT j.*, date_diff('day', CASE WHEN CAST(v.start_date AS DATE) > approved_day THEN CAST(v.start_date AS DATE)
                                          ELSE approved_day END, start_day) AS days
        FROM j LEFT JOIN v ON v.crew_id = j.crew_id AND v.rk = 1
        WHERE j.crew_id NOT IN (SELECT crew_id FROM x_moved)""",
    "f_berths": f"""
        SELECT berth_id, planning_cell_id, planned_crew_id FROM berths_snapshot b JOIN ranks k ON k.rank_id = b.rank_id
        JOIN mgmt_records m ON m.vessel_mgmt_id = b.vessel_mgmt_id JOIN vessel v ON v.vessel_id = b.vessel_id
        WHERE berth_type_id = '{fixed.BUDGETED_BERTH}' AND is_reliever_not_required = 0
          AND record_insert_date = (SELECT max(record_insert_date) FROM berths_snapshot)
          AND lower(rank_category) IN {_lower_in(fixed.RATINGS)} AND lower(vessel_mgmt_type) IN {SHIP}
          AND lower(vessel_business) = 'cargo' AND coalesce(days_remaining, 0) BETWEEN 0 AND 30
          AND planning_cell_id NOT IN {_in(fixed.EUROPE_PLANNING_CELLS)}""",
    "f_declared": f"""
        WITH ob AS (
          SELECT s.service_record_id, s.crew_id, c.mobilisation_cell_id, s.start_date AS sign_on
          FROM service_records s JOIN crew c ON c.crew_id = s.crew_id JOIN vessel_metrics m ON m.vessel_id = s.vessel_id
          WHERE m.date = (SELECT max(date) FROM vessel_metrics) AND lower(mgmt_type) IN {SHIP}
            AND technical_office <> '{fixed.POLICY_EXEMPT_OFFICE}' AND status_id = 'OB' AND active_status = 1
            AND service_cancelled = 0 AND s.vessel_id NOT IN {_in(fixed.POLICY_EXEMPT_VESSELS)}
            AND coalesce(mobilisation_office, '-') <> '{fixed.POLICY_EXEMPT_OFFICE}'
            AND coalesce(third_party_agent_id, '-') NOT IN {_in(fixed.POLICY_EXEMPT_AGENTS)}
            AND NOT (s.vessel_id IN {_in(fixed.POLICY_VESSEL_RANK_VESSELS)}
                     AND coalesce(rank_id_budgeted, '-') IN {_in(fixed.POLICY_VESSEL_RANK_RANKS)})),
        sv AS (
          SELECT *, row_number() OVER (PARTITION BY crew_id ORDER BY start_date DESC, service_record_id DESC) AS rn
          FROM service_records WHERE service_active_status_id IN (1, 2) AND service_cancelled = 0 AND status_id IN ('OB', 'OV')
            AND vessel_id IS NOT NULL AND end_date >= {DAY} - 365 AND previous_experience = 0
            AND crew_id IN (SELECT crew_id FROM ob)),
        mv AS (
          SELECT b.service_record_id, a.service_record_id AS earlier, a.start_date AS earlier_on
          FROM sv a JOIN sv b ON a.crew_id = b.crew_id AND a.rn = b.rn + 1 AND a.vessel_id = b.vessel_id
          WHERE date_diff('day', a.end_date, b.start_date) <= 2),
        s AS (SELECT ob.*, earlier, earlier_on FROM ob LEFT JOIN mv ON mv.service_record_id = ob.service_record_id),
        signed AS (
          SELECT s.crew_id FROM s JOIN policy p ON p.crew_id = s.crew_id AND is_policy_agreed = 1 AND agreed_on IS NOT NULL
          WHERE p.service_record_id IN (s.service_record_id, s.earlier)
            OR date_diff('day', agreed_on, sign_on) < {fixed.POLICY_DAYS} OR date_diff('day', agreed_on, earlier_on) < {fixed.POLICY_DAYS}
          UNION SELECT s.crew_id FROM s JOIN policy_attachments a ON a.crew_id = s.crew_id
          WHERE a.fk_document_id IN (s.service_record_id, s.earlier))
        SELECT DISTINCT CASE WHEN ob.crew_id IN (SELECT crew_id FROM signed) THEN 'Signed' ELSE 'Missing' END AS policy_status,
               crew_id, mobilisation_cell_id FROM ob""",
}


def _people(alias: str, where: str = "", key: str = "mobilisation_cell_id = group_id", value: str = "crew_id") -> str:
    return f"(SELECT count(DISTINCT {value}) FROM {alias} f WHERE f.{key}{' AND ' + where if where else ''})"


def mobilisation_card(policy_family: str = "f_policy") -> str:
    named = f"(SELECT CAST(sum({{}}) AS BIGINT) FROM f_training f WHERE lower(f.mobilisation_cell) = lower(group_name) AND lower(mobilisation_cell) NOT IN {_lower_in(fixed.CELL_NAMES_WITHOUT_TRAINING)})"
    relief = "(SELECT count(DISTINCT crew_id) FROM f_relief f WHERE lower(f.planning_cell) = lower(group_name){})"
    berth = "planning_cell_id = group_id"
    scoped = "f.final_scope = 'IN SCOPE'"
    columns = {
        "training_completed": named.format("completed_tn"),
        "training_total": named.format("all_tn"),
        "checklist_signed": _people("f_checklists", "mob_checklist_id IS NOT NULL"),
        "checklist_joiners": _people("f_checklists"),
        "documents_by_seafarer": _people("f_documents", f"{scoped} AND lower(uploaded_by_unit) = 'seafarer'", value="document_id"),
        "documents_total": _people("f_documents", scoped, value="document_id"),
        "ready_on_time": _people("f_readiness", "compliance = 'Compliant'"),
        "reliability_joiners": _people("f_readiness"),
        "statutory_compliant": _people("f_compliance", "statutory_failing = 0"),
        "statutory_onboard": _people("f_compliance"),
        "vms_compliant": _people("f_compliance", "vms_failing = 0"),
        "vms_onboard": _people("f_compliance"),
        "declaration_signed": _people(policy_family, "lower(policy_status) = 'signed'"),
        "declaration_population": _people(policy_family),
        "accepted_on_time": _people("f_acceptance", "weekdays >= -2"),
        "approved_to_join": _people("f_acceptance"),
        "debriefed_on_time": _people("f_debriefings", "compliance = 1"),
        "debriefing_off_signers": _people("f_debriefings"),
        "timely_relieved": relief.format(" AND relief = 'Timely Relieved'"),
        "ratings_onboard": relief.format(""),
        "appraisal_on_time": _people("f_appraisals", "days_to_review <= 15"),
        "appraisal_off_signers": _people("f_appraisals"),
        "relievers_planned": _people("f_berths", "planned_crew_id IS NOT NULL", berth, "berth_id"),
        "berths_to_plan": _people("f_berths", "", berth, "berth_id"),
        "time_to_mobilise": "(SELECT CAST(trunc(CAST(sum(days) AS DOUBLE) / count(days)) AS BIGINT) FROM f_waits f WHERE f.mobilisation_cell_id = group_id)",
        "flag_compliant": _people("f_flags", "failing = 0"),
        "flag_onboard": _people("f_flags"),
    }
    picked = ",\n".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"""
        SELECT {DAY} AS record_date, group_id AS mobilisation_cell_id, group_name AS mobilisation_cell, {picked}
        FROM (SELECT crew_pool_id AS group_id, crew_pool AS group_name FROM crew_pool
              WHERE crew_pool_type_id = 1 AND is_active = 1 AND crew_pool_id NOT IN {_in(fixed.CELLS_NOT_SCORED)}) g"""


def recruitment_card() -> str:
    by_id = "recruitment_cell_id = group_id"

    def plain(source, where):
        return f"(SELECT count(crew_id) FROM {source} f WHERE f.{by_id} AND lower(new_value) = '{where}')"

    def requests(source, where=""):
        return f"(SELECT count(DISTINCT request_id) FROM {source} f WHERE lower(f.recruitment_cell) = lower(group_name){where})"

    hires = (
        "(SELECT count(DISTINCT u.crew_id) FROM tracking_usage u JOIN crew c ON c.crew_id = u.crew_id "
        "WHERE u.recruitment_cell_id = group_id{})"
    )
    tracked = " AND EXISTS (SELECT 1 FROM recruitment_tracking r WHERE r.crew_service_record_id = u.service_record_id AND is_deleted = 0 AND status_id = 11)"
    recent = f"CAST(created_on AS DATE) BETWEEN {DAY} - 30 AND {DAY}"
    late = " AND lower(compliance) = 'compliant'"
    columns = {
        "endorsed_candidates": plain("endorsed_ratio", "endorsed"),
        "approved_candidates": plain("endorsed_ratio", "accepted"),
        "new_officers_compliant": _people("assessment_compliance", "lower(for_exclusion) = 'include'" + late, by_id),
        "new_officers": _people("assessment_compliance", "lower(for_exclusion) = 'include'", by_id),
        "new_hires_through_tracking": hires.format(tracked),
        "new_hires": hires.format(""),
        "urgent_requests_on_time": requests("urgent_requests", late),
        "urgent_requests": requests("urgent_requests"),
        "non_urgent_requests_on_time": requests("non_urgent_requests", late),
        "non_urgent_requests": requests("non_urgent_requests"),
        "officers_passed_assessment": _people("passed_assessments", recent + " AND new_value = 'Assessment Passed'", by_id),
        "officers_compliant_reserved": "CAST(NULL AS BIGINT)",
        "officers_reserved": "CAST(NULL AS BIGINT)",
        "approved_reserved": "CAST(NULL AS BIGINT)",
        "joined_seafarers": _people("joined_ratio", "lower(new_value) = 'joined'", by_id),
        "officers_took_assessment": _people("passed_assessments", recent, by_id),
        "endorsed_seafarers": plain("joined_ratio", "endorsed"),
        "new_hires_digitised": _people("digitization", "uploads > 0", by_id),
        "new_hires_for_digitisation": _people("digitization", "", by_id),
    }
    picked = ",\n".join(f"{sql} AS {name}" for name, sql in columns.items())
    return f"""
        SELECT {DAY} AS record_date, group_id AS recruitment_cell_id, group_name AS recruitment_cell, {picked}
        FROM (SELECT crew_pool_id AS group_id, crew_pool AS group_name FROM crew_pool WHERE crew_pool_type_id = 6 AND is_active = 1
              UNION SELECT 'UNKNOWN', 'UNKNOWN') g"""


GROUP_SWITCHES = f"""
    WITH h AS (
      SELECT s.service_record_id, s.crew_id, s.start_date AS event_date, s.end_date AS event_end,
             CASE WHEN company_id IN {_in(fixed.MERGED_CLIENTS)} THEN '{fixed.MERGED_CLIENT_ID}' ELSE company_id END AS client_id
      FROM service_records s JOIN crew c ON c.crew_id = s.crew_id JOIN ranks k ON k.rank_id = s.rank_id
      JOIN vessel v ON v.vessel_id = s.vessel_id JOIN mgmt_records m ON m.vessel_mgmt_id = s.vessel_mgmt_id
      JOIN company ON company_id = coalesce(service_vessel_client_id, ship_owner_id, m.client_id)
      WHERE service_cancelled = 0 AND status_id = 'OB' AND previous_experience = 0 AND coalesce(service_active_status_id, 0) <> 3
        AND s.start_date >= DATE '2017-01-01' AND s.start_date <= DATE '2021-12-01'),
    r AS (
      SELECT *, dense_rank() OVER (PARTITION BY crew_id, client_id ORDER BY event_date DESC) AS in_client,
             dense_rank() OVER (PARTITION BY crew_id ORDER BY event_date DESC) AS overall FROM h)
    SELECT DISTINCT b.service_record_id, a.crew_id, a.client_id AS client_impacted,
           CAST(date_diff('day', a.event_end, b.event_date) AS INT) AS gap_days, a.event_end AS end_date,
           b.client_id AS new_client, b.event_date AS new_client_start, date_key
    FROM r a JOIN r b ON b.crew_id = a.crew_id AND b.overall = a.overall - 1
    LEFT JOIN date_dimension ON date = CAST(a.event_end AS DATE)
    WHERE a.in_client = 1 AND a.crew_id IN (SELECT crew_id FROM h GROUP BY crew_id HAVING count(DISTINCT client_id) > 1)"""

PLANNED_JOINERS = f"""
    SELECT {DAY} AS date, p.crew_id, p.service_record_id, planning_status, p.rank_id, p.start_date, p.end_date, rank, rank_sequence,
           rank_category, rank_department, is_outside_service, planned_vessel_id, planned_vessel, planned_vessel_mgmt_id,
           planned_vessel_fleet, planned_vessel_client, planned_vessel_mgmt_type, planned_vessel_segment, planned_vessel_type,
           planned_vessel_general_type_group, planned_vessel_technical_office, p.sea_days, order_of_future_services,
           s.lineup_id_joiner, line_up_description, line_up_created_on
    FROM next_planned p LEFT JOIN service_records s ON s.service_record_id = p.service_record_id
    LEFT JOIN line_ups ON line_up_id = s.lineup_id_joiner
    WHERE p.start_date BETWEEN {DAY} AND {DAY} + 60"""


def kept_snapshots(view: str, columns: list[str], where: str) -> str:
    """Rows left after runs on Saturday 15, Sunday 16 and Monday 17: Sunday's and the last."""
    rest = ", ".join(c for c in columns if c not in ("date", "to_delete"))
    days = [("16", 0), ("17", 1)]
    return " UNION ALL ".join(
        f"SELECT DATE '2022-01-{d}' AS date, {flag} AS to_delete, {rest} FROM {view} WHERE {where}" for d, flag in days
    )
