"""Output contracts: column names, order and types of what the plans store."""

from __future__ import annotations

from pyspark.sql import types as T

TYPES = {
    "string": T.StringType(),
    "long": T.LongType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "stamp": T.TimestampNTZType(),
}


def contract(**groups: str) -> T.StructType:
    """Columns of each named type, in the order given; a type may come again as int_2, string_2, ..."""
    fields = []
    for kind, names in groups.items():
        fields += [T.StructField(n, TYPES[kind.split("_")[0]]) for n in names.split()]
    return T.StructType(fields)


PLANNED_COLUMNS = (
    "crew_id service_record_id planning_status rank_id start_date end_date rank rank_sequence rank_category "
    "rank_department is_outside_service planned_vessel_id planned_vessel planned_vessel_mgmt_id planned_vessel_fleet "
    "planned_vessel_client planned_vessel_mgmt_type planned_vessel_segment planned_vessel_type "
    "planned_vessel_general_type_group planned_vessel_technical_office sea_days order_of_future_services"
).split()
LINE_UP_COLUMNS = ["lineup_id_joiner", "line_up_description", "line_up_created_on"]

ACTIVE_SNAPSHOT = contract(
    date="date",
    string="crew_id current_service_record_id rank_id berth_id planning_service_record_id supply_type third_party_agent "
    "pool_status mobilisation_cell_id recruitment_cell_id planning_cell_id contact_cell_id",
    int="is_ready_for_promotion",
    string_2="current_status",
    stamp="current_status_start_date current_status_end_date availability",
    int_2="actual_service_days current_service_days contract_days",
    string_3="contract_unit",
    int_3="extension",
    string_4="extension_unit",
    stamp_2="contract_end_date",
    string_5="current_vessel_id planned_vessel_id plan_to_join planning_status",
    stamp_3="last_contact_date",
    string_6="last_vessel_id",
    stamp_4="last_vessel_sign_on_date last_vessel_sign_off_date",
    int_4="company_contracts",
    string_7="fleet vessel_mgmt_id vessel_id_final assessed_promotion_record_id approved_promotion_record_id "
    "crew_pool_status",
    int_5="row_number",
    string_8="recruiter_name recruiter_office",
    int_6="to_delete",
)

CONTACTS_SNAPSHOT = contract(
    date="date",
    string="crew_id person_code service_record_id crew_surname crew_forename crew_movement_status nationality "
    "country_of_nationality",
    stamp="activity_date start_date end_date",
    string_2="crew_rank load_port load_port_country vessel_id vessel_name mobilisation_cell planning_cell contact_cell "
    "sign_off_reason action rank rank_category rank_department vessel_mgmt_type technical_office sector client "
    "contract_type",
    int="contacts_made row_number to_delete",
)

RECRUITMENT_SCORECARD = contract(
    date="record_date",
    string="recruitment_cell_id recruitment_cell",
    long="endorsed_candidates approved_candidates new_officers_compliant new_officers new_hires_through_tracking "
    "new_hires urgent_requests_on_time urgent_requests non_urgent_requests_on_time non_urgent_requests "
    "officers_passed_assessment officers_compliant_reserved officers_reserved approved_reserved joined_seafarers "
    "officers_took_assessment endorsed_seafarers new_hires_digitised new_hires_for_digitisation",
)

MOBILISATION_SCORECARD = contract(
    date="record_date",
    string="mobilisation_cell_id mobilisation_cell",
    long="training_completed training_total checklist_signed checklist_joiners documents_by_seafarer documents_total "
    "ready_on_time reliability_joiners statutory_compliant statutory_onboard vms_compliant vms_onboard "
    "declaration_signed declaration_population accepted_on_time approved_to_join debriefed_on_time "
    "debriefing_off_signers timely_relieved ratings_onboard appraisal_on_time appraisal_off_signers "
    "relievers_planned berths_to_plan time_to_mobilise flag_compliant flag_onboard",
)
