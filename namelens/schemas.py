"""Table schemas, as DDL text. Ids and counts are bigint, probabilities decimal."""

from __future__ import annotations

from pyspark.sql import types as T

CLIENT_FILE = "record_id string, first_name string, last_name string, zip string"

LANDING = (
    CLIENT_FILE + ", storage_file_name string, file_record_row_number bigint, load_ts timestamp_ntz"
)

# Which landed files make up a batch.
LANDED_FILE = "app_organization_id string, app_batch_id string, storage_file_name string"

PERSON_INPUT = (
    "client_id bigint, batch_id bigint, record_id string, first_name string, last_name string, "
    "zip string, load_ts timestamp_ntz"
)

PERSON_CLEAN = (
    "client_id bigint, batch_id bigint, record_id string, first_name_raw string, "
    "last_name_raw string, zip_raw string, first_name_clean string, last_name_clean string, "
    "zip5 string, first_name_missing_flag int, last_name_missing_flag int, zip_unusable_flag int, "
    "first_name_length int, last_name_length int, load_ts timestamp_ntz"
)
_BASELINE = (
    "client_id bigint, batch_id bigint, record_id string, first_name_raw string, "
    "last_name_raw string, zip_raw string, first_name_clean string, last_name_clean string, "
    "zip5 string, first_name_missing_flag int, zip_unusable_flag int, first_name_length int, "
    "load_ts timestamp_ntz, "
)
GENDER_BASELINE = _BASELINE + (
    "ssa_lookup_match_flag int, ssa_male_qty bigint, ssa_female_qty bigint, ssa_total_qty bigint, "
    "ssa_male_probability decimal(10,6), ssa_female_probability decimal(10,6), "
    "ssa_max_probability decimal(10,6), ssa_probability_gap decimal(10,6), "
    "ssa_predicted_gender string, ssa_confidence_level string, ssa_is_rare_name int, "
    "ssa_reportable_gender string"
)
AGE_BASELINE = _BASELINE + (
    "ssa_age_lookup_match_flag int, ssa_age_total_qty bigint, "
    "ssa_age_max_probability decimal(10,6), ssa_predicted_age_bucket string, "
    "ssa_age_confidence_level string, ssa_age_is_rare_name int"
)

NAME_COUNTS = "first_name string, gender string, quantity decimal(32,0), year int"

# What a derived table that is stored as a whole was made from.
DERIVED_FROM = "name string, made_from string"

CLIENT = (
    "id bigint, abbreviation string, name string, notes string, created_ts timestamp_ntz, "
    "model_improvement_program_participant boolean, app_organization_id string"
)

BATCH = (
    "id bigint, client_id bigint, file_name string, file_type string, record_count bigint, "
    "notes string, created_ts timestamp_ntz, processed_ts timestamp_ntz, app_batch_id string, "
    "processed_record_count bigint, delivery_complete_ts timestamp_ntz, "
    "storage_file_name string, download_object_key string"
)

_APPROVAL_DETAILS = (
    "status string, requested_credits bigint, approved_credits bigint, denial_reason string, "
    "decision_ts timestamp_ntz, created_ts timestamp_ntz, updated_ts timestamp_ntz"
)
APPROVAL_QUEUE = "app_organization_id string, app_batch_id string, batch_id bigint, " + _APPROVAL_DETAILS
APPROVAL_RESULTS = "app_organization_id string, app_batch_id string, " + _APPROVAL_DETAILS

ENRICHMENT_STATUS = (
    "client_id bigint, batch_id bigint, app_batch_id string, enrichment_type string, "
    "enrichment_type_code string, enrichment_status string, enrichment_metrics_payload string, "
    "started_ts timestamp_ntz, completed_ts timestamp_ntz, error_message string, "
    "created_ts timestamp_ntz, updated_ts timestamp_ntz"
)

_QUEUE_STATE = (
    "queued_ts timestamp_ntz, processing_status string, processing_started_ts timestamp_ntz, "
    "processed_ts timestamp_ntz, error_message string, created_ts timestamp_ntz, "
    "updated_ts timestamp_ntz"
)
COMPLETION_QUEUE = "client_id bigint, batch_id bigint, " + _QUEUE_STATE
# What a completion run has counted.
COMPLETED_BATCH = "client_id bigint, batch_id bigint, processed_record_count bigint"
DOWNLOAD_QUEUE = "app_organization_id string, app_batch_id string, " + _QUEUE_STATE
DOWNLOAD_READY_QUEUE = (
    "app_organization_id string, app_batch_id string, download_object_key string, "
    "download_status string, " + _QUEUE_STATE
)

OUTBOX = (
    "id bigint, client_id bigint, batch_id bigint, app_batch_id string, "
    "app_organization_id string, payload string, event_type string, status string, "
    "attempt_count int, last_attempt_ts timestamp_ntz, last_error string, "
    "created_ts timestamp_ntz, processed_ts timestamp_ntz"
)

OUTPUT_CONFIGURATION = (
    "app_organization_id string, app_batch_id string, app_preset_id string, "
    "app_preset_label string, config_json string, created_ts timestamp_ntz, "
    "updated_ts timestamp_ntz"
)
CONFIG_JSON = (
    "attributes array<struct<code: string, label: string>>, "
    "output_fields array<struct<field_name: string, sort_order: int>>, "
    "retain_source_fields boolean"
)

ATTRIBUTE = "id string, code string, label string, sort_order bigint"
ATTRIBUTE_DETAIL = (
    "id string, attribute_id string, code string, label string, sort_order bigint, "
    "output_field_name string"
)

GENDER_RESULTS = (
    "client_id bigint, batch_id bigint, record_id string, predicted_gender string, "
    "reportable_gender string, confidence_level string, max_probability decimal(10,6), "
    "probability_gap decimal(10,6), model_version string, processed_ts timestamp_ntz, "
    "first_name_missing_flag int, is_rare_name_flag int, male_probability decimal(10,6), "
    "female_probability decimal(10,6), name_match_found_flag int"
)

AGE_RESULTS = (
    "client_id bigint, batch_id bigint, record_id string, predicted_age_bucket string, "
    "confidence_level string, max_probability decimal(10,6), model_version string, "
    "processed_ts timestamp_ntz, first_name_missing_flag int, is_rare_name_flag int, "
    "name_match_found_flag int"
)

METRICS = (
    "client_id bigint, batch_id bigint, model_version string, metric_name string, "
    "metric_type string, metric_label string, metric_value decimal(32,6), "
    "processed_ts timestamp_ntz, metric_display_type string, metric_label_sort string, "
    "metric_sort int"
)

IMPROVEMENT_STORE = (
    "client_id bigint, batch_id bigint, record_id string, first_name_raw string, "
    "first_name_clean string, last_name_raw string, last_name_clean string, zip_raw string, "
    "zip5 string, ssa_male_probability decimal(38,6), ssa_female_probability decimal(38,6), "
    "ssa_confidence_level string, ssa_lookup_match_flag int, ssa_predicted_gender string, "
    "ssa_reportable_gender string, model_version string, opted_in_data_loaded_ts timestamp_ntz"
)

# The 33 fields of the voter file, in file order, with their types.
VOTER_FIELDS = {
    "state_voter_id": "decimal(32,0)",
    "first_name": "string",
    "middle_name": "string",
    "last_name": "string",
    "name_suffix": "string",
    "birth_year": "int",
    "gender": "string",
    "registration_street_number": "string",
    "registration_street_fraction": "string",
    "registration_street_name": "string",
    "registration_street_type": "string",
    "registration_unit_type": "string",
    "registration_street_pre_direction": "string",
    "registration_street_post_direction": "string",
    "registration_unit_number": "string",
    "registration_city": "string",
    "registration_state": "string",
    "registration_zip_code": "string",
    "county_code": "string",
    "precinct_code": "string",
    "precinct_part": "string",
    "legislative_district": "string",
    "congressional_district": "string",
    "mailing_address_line_1": "string",
    "mailing_address_line_2": "string",
    "mailing_address_line_3": "string",
    "mailing_city": "string",
    "mailing_zip_code": "string",
    "mailing_state": "string",
    "mailing_country": "string",
    "registration_date": "date",
    "last_voted_date": "date",
    "status_code": "string",
}


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)
