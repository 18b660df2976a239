"""HL7 v2 messages as set-based Spark jobs: batches to messages, messages to segment tables.

Every message names its own separators. They are mapped to control characters once per line, so
all later cuts use constant patterns and decoded escape sequences cannot be taken for separators.
Single fields are decoded; repeated fields and plain text keep their escape sequences. Composites are
cut in Arrow batches, a component of all rows at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import partial
from typing import Iterator, Tuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from weirflow.functions.scalars import coerce_int, hl7_dtm_text, parse_hl7_dtm

# Batch envelope segments, and segments that occur once per message.
ENVELOPE = ("FHS", "BHS", "BTS", "FTS")
SINGLE_SEGMENTS = ("msh", "evn", "pid", "pd1", "pv1", "pv2", "mrg", "sch", "txa")
META = ("message_id", "message_timestamp", "hl7_version", "source_file", "send_time", "create_time")

# Components of the composite types in their order. ``-`` is a component that is not
# kept, ``a&b`` are sub-components, a leading ``+`` takes the whole component where the first
# sub-component is empty, ``@`` is a time, ``=EI`` an entity identifier out of sub-components.
_XCN = (
    "id family_name given_name middle_name suffix prefix degree source_table "
    "assigning_authority&assigning_authority_universal_id&assigning_authority_universal_id_type "
    "name_type_code check_digit check_digit_scheme identifier_type_code "
    "assigning_facility&assigning_facility_universal_id&assigning_facility_universal_id_type "
    "name_representation_code - - name_assembly_order effective_date expiration_date professional_suffix"
)
_CWE = "code text coding_system alt_code alt_text alt_coding_system coding_system_version alt_coding_system_version original_text"
COMPOSITES = {
    "XPN": "family_name given_name middle_name suffix prefix degree name_type_code name_representation_code name_context - "
           "name_assembly_order name_effective_date name_expiration_date professional_suffix called_by",
    "XCN": _XCN,
    "CWE": _CWE,
    "HD": "namespace_id universal_id universal_id_type",
    "EI": "entity_identifier namespace_id universal_id universal_id_type",
    "CP": "+price&currency price_type from_value to_value +range_units&range_units_text&range_units_coding_system range_type",
    "PT": "id mode",
    "VID": "id +internationalization&internationalization_text&internationalization_coding_system "
           "+international_version&international_version_text&international_version_coding_system",
    "AUI": "number date@ source",
    "SPS": "+code&text +additives& collection_method +body_site& +site_modifier& +collection_method_modifier& +role&",
    "DLN": "number issuing_state expiration_date@",
    "DLD": "+code& effective_date@",
    "FC": f"+{_CWE.replace(' ', '&')} effective_date@",
    "TQ": "+quantity&quantity_units interval_repeat_pattern&interval_explicit_time duration start_datetime@ end_datetime@ "
          "priority condition text conjunction order_sequencing +occurrence_duration& total_occurrences",
    "JCC": "+code&text&coding_system +class&class_text&class_coding_system description",
    "MOC": "+monetary_amount&monetary_amount_currency +charge_code&charge_code_text&charge_code_coding_system",
    "PRL": "+code&text&coding_system sub_id descriptor",
    "NDL": "id&family_name&given_name&middle_name&suffix&prefix&degree start_datetime@ end_datetime@ point_of_care room bed "
           "+facility& location_status patient_location_type building floor",
    "PL": "+point_of_care& +room& +bed& +facility& status type +building& +floor& description +comprehensive_id& +assigning_authority&",
    "CQ": "quantity +units&",
    "XTN": "number use_code equipment_type communication_address country_code area_code local_number extension any_text "
           "extension_prefix speed_dial_code unformatted_number effective_start_date expiration_date expiration_reason& "
           "protection_code& shared_telecom_id& preference_order",
    "XON": "name type_code id check_digit check_digit_scheme "
           "assigning_authority&assigning_authority_universal_id&assigning_authority_universal_id_type id_type_code "
           "assigning_facility&assigning_facility_universal_id&assigning_facility_universal_id_type name_rep_code identifier",
    "CX": "id check_digit check_digit_scheme "
          "assigning_authority&assigning_authority_universal_id&assigning_authority_universal_id_type type_code "
          "assigning_facility&assigning_facility_universal_id&assigning_facility_universal_id_type effective_date "
          "expiration_date assigning_jurisdiction assigning_agency security_check security_check_scheme",
    "XAD": "street other_designation city state zip country type other_geographic "
           "county_parish_code&county_parish_text&county_parish_coding_system census_tract&census_tract_text&census_tract_coding_system "
           "representation_code - effective_date expiration_date "
           "expiration_reason&expiration_reason_text&expiration_reason_coding_system temporary_indicator bad_address_indicator "
           "usage addressee comment preference_order protection_code&protection_code_text&protection_code_coding_system identifier&",
    "EIP": "placer_assigned_identifier=EI filler_assigned_identifier=EI",
    "MO": "amount currency",
    "OG": "sub_identifier group sequence identifier",
}

# The fields of each segment in their order, as ``name:type``. Types are the composites
# above, ST text, SI number, TS time, NO the set id (1 when absent); ``*`` keeps all repetitions,
# ``~`` the first one, DR is a start and end, HDF and MSG spread their components over columns.
SEGMENTS = {
    "msh": "field_separator:ST encoding_characters:ST sending_application:HDF sending_facility:HDF receiving_application:HDF "
           "receiving_facility:HDF message_datetime:TS security:ST message:MSG message_control_id:ST processing_id:PT "
           "version_id:VID sequence_number:SI continuation_pointer:ST accept_acknowledgment_type:ST "
           "application_acknowledgment_type:ST country_code:ST character_set:ID* principal_language:CWE "
           "alt_character_set_handling:ST message_profile_identifiers:EI* sending_responsible_org:XON "
           "receiving_responsible_org:XON sending_network_address:HD receiving_network_address:HD "
           "security_classification_tag:CWE security_handling_instructions:CWE* special_access_restriction:CWE*",
    "evn": "event_type_code:ST recorded_datetime:TS date_time_planned_event:TS event_reason:CWE operator:XCN* event_occurred:TS "
           "event_facility:HD",
    "pid": "set_id:SI patient_external_id:CX patient_id:CX* alternate_patient_id:CX patient_names:XPN* mothers_maiden_names:XPN* "
           "date_of_birth:TS administrative_sex:CWE patient_alias:ST~ race:CWE* address:XAD* county_code:ST home_phone:XTN* "
           "business_phone:XTN* primary_language:CWE marital_status:CWE religion:CWE patient_account_number:CX ssn:ST "
           "drivers_license:DLN mothers_identifier:CX* ethnic_group:CWE* birth_place:ST multiple_birth_indicator:ST birth_order:SI "
           "citizenship:CWE* veterans_military_status:CWE nationality:CWE patient_death_datetime:TS patient_death_indicator:ST "
           "identity_unknown_indicator:ST identity_reliability_code:CWE* last_update_datetime:TS last_update_facility:HD "
           "species_code:CWE breed_code:CWE strain:ST production_class_code:CWE tribal_citizenship:CWE* patient_telecom:XTN*",
    "pd1": "living_dependency:CWE* living_arrangement:CWE patient_primary_facility:XON* patient_primary_care_provider:XCN~ "
           "student_indicator:CWE handicap:CWE living_will_code:CWE organ_donor_code:CWE separate_bill:ST duplicate_patient:CX* "
           "publicity_code:CWE protection_indicator:ST protection_indicator_effective_date:TS place_of_worship:XON* "
           "advance_directive_code:CWE* immunization_registry_status:CWE immunization_registry_status_effective_date:TS "
           "publicity_code_effective_date:TS military_branch:CWE military_rank_grade:CWE military_status:CWE "
           "advance_directive_last_verified_date:TS retirement_date:TS",
    "pv1": "set_id:SI patient_class:CWE assigned_patient_location:PL admission_type:CWE preadmit_number:CX prior_patient_location:PL "
           "attending_doctor:XCN* referring_doctor:XCN* consulting_doctor:XCN* hospital_service:CWE temporary_location:PL "
           "preadmit_test_indicator:CWE readmission_indicator:CWE admit_source:CWE ambulatory_status:CWE* vip_indicator:CWE "
           "admitting_doctor:XCN* patient_type:CWE visit_number:CX financial_class:FC* charge_price_indicator:CWE courtesy_code:CWE "
           "credit_rating:CWE contract_code:CWE* contract_effective_date:TS* contract_amount:ST* contract_period:ST* "
           "interest_code:CWE transfer_to_bad_debt_code:CWE transfer_to_bad_debt_date:TS bad_debt_agency_code:CWE "
           "bad_debt_transfer_amount:ST bad_debt_recovery_amount:ST delete_account_indicator:CWE delete_account_date:TS "
           "discharge_disposition:CWE discharged_to_location:DLD diet_type:CWE servicing_facility:CWE bed_status:CWE "
           "account_status:CWE pending_location:PL prior_temporary_location:PL admit_datetime:TS~ discharge_datetime:TS~ "
           "current_patient_balance:ST total_charges:ST total_adjustments:ST total_payments:ST alternate_visit_id:CX* "
           "visit_indicator:CWE other_healthcare_provider:XCN* service_episode_description:ST service_episode_identifier:CX",
    "pv2": "prior_pending_location:PL accommodation_code:CWE admit_reason:CWE transfer_reason:CWE patient_valuables:ST* "
           "patient_valuables_location:ST visit_user_code:CWE* expected_admit_datetime:TS expected_discharge_datetime:TS "
           "estimated_length_of_inpatient_stay:SI actual_length_of_inpatient_stay:SI visit_description:ST referral_source:XCN* "
           "previous_service_date:TS employment_illness_related_indicator:ST purge_status_code:CWE purge_status_date:TS "
           "special_program_code:CWE retention_indicator:ST expected_number_of_insurance_plans:SI visit_publicity_code:CWE "
           "visit_protection_indicator:ST clinic_organization:XON* patient_status_code:CWE visit_priority_code:CWE "
           "previous_treatment_date:TS expected_discharge_disposition:CWE signature_on_file_date:TS first_similar_illness_date:TS "
           "patient_charge_adjustment_code:CWE recurring_service_code:CWE billing_media_code:ST expected_surgery_datetime:TS "
           "military_partnership_code:ST military_non_availability_code:ST newborn_baby_indicator:ST baby_detained_indicator:ST "
           "mode_of_arrival_code:CWE recreational_drug_use_code:CWE* admission_level_of_care_code:CWE precaution_code:CWE* "
           "patient_condition_code:CWE living_will_code:CWE organ_donor_code:CWE advance_directive_code:CWE* "
           "patient_status_effective_date:TS expected_loa_return_datetime:TS expected_preadmission_testing_datetime:TS "
           "notify_clergy_code:CWE* advance_directive_last_verified_date:TS",
    "nk1": "set_id:NO names:XPN* relationship:CWE address:XAD* phone_number:XTN* business_phone:XTN* contact_role:CWE start_date:TS "
           "end_date:TS job_title:ST job_code:JCC employee_number:CX organization_name:XON* marital_status:CWE "
           "administrative_sex:CWE date_of_birth:TS living_dependency:CWE* ambulatory_status:CWE* citizenship:CWE* "
           "primary_language:CWE living_arrangement:CWE publicity_code:CWE protection_indicator:ST student_indicator:CWE "
           "religion:CWE mothers_maiden_names:XPN* nationality:CWE ethnic_group:CWE* contact_reason:CWE* contact_persons:XPN* "
           "contact_person_telephone:XTN* contact_persons_address:XAD* associated_party_identifiers:CX* job_status:CWE race:CWE* "
           "handicap:CWE contact_ssn:ST birth_place:ST vip_indicator:CWE telecommunication_info:XTN~ "
           "contact_telecommunication_info:XTN~",
    "mrg": "prior_patient_id:CX* prior_alternate_patient_id:CX* prior_patient_account_number:CX prior_patient_id_external:CX "
           "prior_visit_number:CX prior_alternate_visit_id:CX prior_patient_names:XPN*",
    "al1": "set_id:NO allergen_type_code:CWE allergen_code:CWE allergy_severity_code:CWE allergy_reaction:CWE* identification_date:TS",
    "iam": "set_id:NO allergen_type_code:CWE allergen_code:CWE allergy_severity_code:CWE allergy_reaction:CWE* "
           "allergy_action_code:CWE allergy_unique_identifier:EI action_reason:ST sensitivity_to_causative_agent_code:CWE "
           "allergen_group_code:CWE onset_date:TS onset_date_text:ST reported_datetime:TS reported_by:XCN "
           "relationship_to_patient_code:CWE alert_device_code:CWE allergy_clinical_status_code:CWE statused_by_person:XCN "
           "statused_by_organization:XON statused_at_datetime:TS inactivated_by_person:XCN inactivated_datetime:TS "
           "initially_recorded_by_person:XCN initially_recorded_datetime:TS modified_by_person:XCN modified_datetime:TS "
           "clinician_identified_allergen_code:CWE initially_recorded_by_organization:XON modified_by_organization:XON "
           "inactivated_by_organization:XON",
    "dg1": "set_id:NO diagnosis_coding_method:ST diagnosis_code:CWE diagnosis_description:ST diagnosis_datetime:TS "
           "diagnosis_type:CWE major_diagnostic_category:CWE diagnostic_related_group:CWE drg_approval_indicator:ST "
           "drg_grouper_review_code:CWE outlier_type:CWE outlier_days:SI outlier_cost:CP grouper_version_and_type:ST "
           "diagnosis_priority:SI diagnosing_clinician:XCN* diagnosis_classification:CWE confidential_indicator:ST "
           "attestation_datetime:TS diagnosis_identifier:EI diagnosis_action_code:ST parent_diagnosis:EI drg_ccl_value_code:CWE "
           "drg_grouping_usage:ST drg_diagnosis_determination_status:CWE present_on_admission_indicator:CWE",
    "pr1": "set_id:NO procedure_coding_method:ST procedure_code:CWE procedure_description:ST procedure_datetime:TS "
           "procedure_functional_type:CWE procedure_minutes:SI anesthesiologist:XCN* anesthesia_code:CWE anesthesia_minutes:SI "
           "surgeon:XCN* procedure_practitioner:XCN* consent_code:CWE procedure_priority:ST associated_diagnosis_code:CWE "
           "procedure_code_modifier:CWE* procedure_drg_type:CWE tissue_type_code:CWE* procedure_identifier:EI "
           "procedure_action_code:ST drg_procedure_determination_status:CWE drg_procedure_relevance:CWE "
           "treating_organizational_unit:PL* respiratory_within_surgery:ST parent_procedure_id:EI",
    "orc": "order_control:ST placer_order_number:EI filler_order_number:EI placer_group_number:EI order_status:ST response_flag:ST "
           "quantity_timing:TQ* parent_order:EIP* datetime_of_transaction:TS entered_by:XCN* verified_by:XCN* ordering_provider:XCN* "
           "enterers_location:PL call_back_phone:XTN* order_effective_datetime:TS order_control_code_reason:CWE "
           "entering_organization:CWE entering_device:CWE action_by:XCN* advanced_beneficiary_notice_code:CWE "
           "ordering_facility_name:XON* ordering_facility_address:XAD* ordering_facility_phone:XTN* ordering_provider_address:XAD* "
           "order_status_modifier:CWE abn_override_reason:CWE fillers_expected_availability_datetime:TS confidentiality_code:CWE "
           "order_type:CWE enterer_authorization_mode:CWE parent_universal_service_id:CWE advanced_beneficiary_notice_date:TS "
           "alternate_placer_order_number:CX* order_workflow_profile:CWE* action_code:ST order_status_date_range:DR "
           "order_creation_datetime:TS filler_order_group_number:EI",
    "obr": "set_id:NO placer_order_number:EI filler_order_number:EI service:CWE priority:ST requested_datetime:TS "
           "observation_datetime:TS observation_end_datetime:TS collection_volume:CQ collector:XCN* specimen_action_code:ST "
           "danger_code:CWE relevant_clinical_information:CWE* specimen_received_datetime:TS specimen_source:SPS "
           "ordering_provider:XCN* order_callback_phone:XTN* placer_field_1:ST placer_field_2:ST filler_field_1:ST filler_field_2:ST "
           "results_rpt_status_chng_datetime:TS charge_to_practice:MOC diagnostic_service_section:ST result_status:ST "
           "parent_result:PRL quantity_timing:TQ* result_copies_to:XCN* parent_results_observation_identifier:EIP "
           "transportation_mode:ST reason_for_study:CWE* principal_result_interpreter:NDL assistant_result_interpreter:NDL* "
           "technician:NDL* transcriptionist:NDL* scheduled_datetime:TS number_of_sample_containers:SI transport_logistics:CWE* "
           "collectors_comment:CWE* transport_arrangement_responsibility:CWE transport_arranged:ST escort_required:ST "
           "planned_patient_transport_comment:CWE* procedure_code:CWE procedure_code_modifier:CWE* "
           "placer_supplemental_service_info:CWE* filler_supplemental_service_info:CWE* medically_necessary_dup_proc_reason:CWE "
           "result_handling:CWE parent_universal_service_id:CWE observation_group:EI parent_observation_group:EI "
           "alternate_placer_order:CX* parent_order:EIP* action_code:ST",
    "obx": "set_id:NO value_type:ST observation_id:CWE observation_sub_id:OG observation_value:ST* units:CWE references_range:ST "
           "interpretation_codes:CWE* probability:ST nature_of_abnormal_test:ID* observation_result_status:ST "
           "effective_date_of_ref_range:TS user_defined_access_checks:ST datetime_of_observation:TS producers_id:CWE "
           "responsible_observer:XCN* observation_method:CWE* equipment_instance_identifier:EI* datetime_of_analysis:TS "
           "observation_site:CWE* observation_instance_identifier:EI mood_code:CWE performing_organization:XON "
           "performing_org_address:XAD performing_org_medical_director:XCN~ patient_results_release_category:ST root_cause:CWE "
           "local_process_control:CWE* observation_type:ST observation_sub_type:ST action_code:ST "
           "observation_value_absent_reason:CWE* observation_related_specimen:EIP*",
    "nte": "set_id:NO source_of_comment:ST comment:ST* comment_type:CWE entered_by:XCN entered_datetime:TS effective_start_date:TS "
           "expiration_date:TS coded_comment:CWE*",
    "spm": "set_id:NO specimen_id:EIP specimen_parent_ids:EIP* specimen_type:CWE specimen_type_modifier:CWE* specimen_additives:CWE* "
           "specimen_collection_method:CWE specimen_source_site:CWE specimen_source_site_modifier:CWE* specimen_collection_site:CWE "
           "specimen_role:CWE* specimen_collection_amount:CQ grouped_specimen_count:SI specimen_description:ST* "
           "specimen_handling_code:CWE* specimen_risk_code:CWE* specimen_collection_datetime:DR specimen_received_datetime:TS "
           "specimen_expiration_datetime:TS specimen_availability:ST specimen_reject_reason:CWE* specimen_quality:CWE "
           "specimen_appropriateness:CWE specimen_condition:CWE* specimen_current_quantity:CQ number_of_specimen_containers:SI "
           "container_type:CWE container_condition:CWE specimen_child_role:CWE accession_id:CX* other_specimen_id:CX* shipment_id:EI "
           "culture_start_datetime:TS culture_final_datetime:TS action_code:ST",
    "in1": "set_id:NO insurance_plan:CWE insurance_company:CX* insurance_company_name:XON* insurance_company_address:XAD* "
           "insurance_co_contacts:XPN* insurance_co_phone_number:XTN* group_number:ST group_name:XON* insureds_group_emp:CX* "
           "insureds_group_emp_name:XON* plan_effective_date:TS plan_expiration_date:TS authorization_information:AUI plan_type:CWE "
           "insured_names:XPN* insureds_relationship_to_patient:CWE insureds_date_of_birth:TS insureds_address:XAD* "
           "assignment_of_benefits:CWE coordination_of_benefits:CWE coord_of_ben_priority:ST notice_of_admission_flag:ST "
           "notice_of_admission_date:TS report_of_eligibility_flag:ST report_of_eligibility_date:TS release_information_code:CWE "
           "pre_admit_cert:ST verification_datetime:TS verification_by:XCN* type_of_agreement_code:CWE billing_status:CWE "
           "lifetime_reserve_days:SI delay_before_lr_day:SI company_plan_code:CWE policy_number:ST policy_deductible:CP "
           "policy_limit_amount:CP policy_limit_days:SI room_rate_semi_private:CP room_rate_private:CP "
           "insureds_employment_status:CWE insureds_administrative_sex:CWE insureds_employers_address:XAD* verification_status:ST "
           "prior_insurance_plan_id:CWE coverage_type:CWE handicap:CWE insureds_id_number:CX* signature_code:CWE "
           "signature_code_date:TS insureds_birth_place:ST vip_indicator:CWE external_health_plan_identifiers:CWE* "
           "insurance_action_code:ST",
    "gt1": "set_id:NO guarantor_number:CX* guarantor_names:XPN* guarantor_spouse_names:XPN* guarantor_address:XAD* "
           "guarantor_ph_num_home:XTN* guarantor_ph_num_business:XTN* guarantor_date_of_birth:TS guarantor_administrative_sex:CWE "
           "guarantor_type:CWE guarantor_relationship:CWE guarantor_ssn:ST guarantor_date_begin:TS guarantor_date_end:TS "
           "guarantor_priority:SI guarantor_employer_names:XPN* guarantor_employer_address:XAD* guarantor_employer_phone_number:XTN* "
           "guarantor_employee_id_number:CX* guarantor_employment_status:CWE guarantor_organization_name:XON* "
           "guarantor_billing_hold_flag:ST guarantor_credit_rating_code:CWE guarantor_death_date_and_time:TS guarantor_death_flag:ST "
           "guarantor_charge_adjustment_code:CWE guarantor_household_annual_income:CP guarantor_household_size:SI "
           "guarantor_employer_id_number:CX* guarantor_marital_status_code:CWE guarantor_hire_effective_date:TS "
           "employment_stop_date:TS living_dependency:CWE ambulatory_status:CWE* citizenship:CWE* primary_language:CWE "
           "living_arrangement:CWE publicity_code:CWE protection_indicator:ST student_indicator:CWE religion:CWE "
           "mothers_maiden_names:XPN* nationality:CWE ethnic_group:CWE* contact_persons:XPN* contact_persons_telephone_number:XTN* "
           "contact_reason:CWE contact_relationship:CWE job_title:ST job_code_class:JCC guarantor_employers_org_name:XON* "
           "handicap:CWE job_status:CWE guarantor_financial_class:FC guarantor_race:CWE* guarantor_birth_place:ST vip_indicator:CWE",
    "ft1": "set_id:NO transaction_id:CX transaction_batch_id:ST transaction_date:DR transaction_posting_date:TS transaction_type:CWE "
           "transaction_code:CWE transaction_description:ST transaction_description_alt:ST transaction_quantity:SI "
           "transaction_amount_extended:CP transaction_amount_unit:CP department_code:CWE insurance_plan_id:CWE insurance_amount:CP "
           "assigned_patient_location:PL fee_schedule:CWE patient_type:CWE diagnosis_code:CWE* performed_by:XCN* ordered_by:XCN* "
           "unit_cost:CP filler_order_number:EI entered_by:XCN* procedure_code:CWE procedure_code_modifier:CWE* "
           "advanced_beneficiary_notice_code:CWE medically_necessary_dup_proc_reason:CWE ndc_code:CWE payment_reference_id:CX "
           "transaction_reference_key:ST* performing_facility:XON* ordering_facility:XON~ item_number:CWE model_number:ST "
           "special_processing_code:CWE* clinic_code:CWE referral_number:CX authorization_number:CX "
           "service_provider_taxonomy_code:CWE revenue_code:CWE prescription_number:ST ndc_qty_and_uom:CQ "
           "dme_certificate_of_medical_necessity_transmission_code:CWE dme_certification_type_code:CWE dme_duration_value:ST "
           "dme_certification_revision_date:ST dme_initial_certification_date:ST dme_last_certification_date:ST "
           "dme_length_of_medical_necessity_days:ST dme_rental_price:MO dme_purchase_price:MO dme_frequency_code:CWE "
           "dme_certification_condition_indicator:ST dme_condition_indicator_code:CWE* service_reason_code:CWE",
    "rxa": "set_id:NO administration_sub_id_counter:SI datetime_start_of_administration:TS datetime_end_of_administration:TS "
           "administered_code:CWE administered_amount:ST administered_units:CWE administered_dosage_form:CWE "
           "administration_notes:CWE* administering_provider:XCN* administered_at_location:ST administered_per_time_unit:ST "
           "administered_strength:ST administered_strength_units:CWE substance_lot_number:ST* substance_expiration_date:TS* "
           "substance_manufacturer_name:CWE* substance_treatment_refusal_reason:CWE* indication:CWE* completion_status:ST "
           "action_code_rxa:ST system_entry_datetime:TS administered_drug_strength_volume:ST "
           "administered_drug_strength_volume_units:CWE administered_barcode_identifier:CWE pharmacy_order_type:ST administer_at:PL "
           "administered_at_address:XAD administered_tag_identifier:EI*",
    "sch": "placer_appointment_id:EI filler_appointment_id:EI occurrence_number:SI placer_group_number:EI schedule_id:CWE "
           "event_reason:CWE appointment_reason:CWE appointment_type:CWE appointment_duration:SI appointment_duration_units:CWE "
           "appointment_timing_quantity:ST~ placer_contact_person:XCN* placer_contact_phone:XTN placer_contact_address:XAD* "
           "placer_contact_location:PL filler_contact_person:XCN* filler_contact_phone:XTN filler_contact_address:XAD* "
           "filler_contact_location:PL entered_by_person:XCN* entered_by_phone_number:XTN* entered_by_location:PL "
           "parent_placer_appointment_id:EI parent_filler_appointment_id:EI filler_status_code:CWE placer_order_number:EI* "
           "filler_order_number:EI* alternate_placer_order_group_number:EIP",
    "txa": "set_id:NO document_type:CWE document_content_presentation:ST activity_datetime:TS primary_activity_provider:XCN* "
           "origination_datetime:TS transcription_datetime:TS edit_datetime:TS* originator:XCN* assigned_document_authenticator:XCN* "
           "transcriptionist:XCN* unique_document_number:EI parent_document_number:EI placer_order_number:EI* filler_order_number:EI "
           "unique_document_file_name:ST document_completion_status:ST document_confidentiality_status:ST "
           "document_availability_status:ST document_storage_status:ST document_change_reason:ST "
           "authentication_person_time_stamp:XCN* distributed_copies:XCN* folder_assignment:CWE* document_title:ST* "
           "agreed_due_datetime:TS creating_facility:HD creating_specialty:CWE",
}

# Control characters that stand for the separators inside this module.
FIELD, COMP, REP, SUB = "\x01", "\x02", "\x03", "\x05"
MARKS = FIELD + COMP + REP + SUB

# Letters of the escape sequences: the field, component, sub-component and repetition separator, two
# for nothing, the escape character.
ESCAPES = "FSTRHNE"


def _some(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def _sep(i: int) -> Column:
    """A separator of the row's message: 1 field, 2 component, 3 repetition, 4 sub-component."""
    return F.substring("_seps", i, 1)


def _original(text: Column, marks: str = MARKS) -> Column:
    """Marks back to the message's own characters; a text without any is left alone."""
    own = text
    for mark in marks:
        own = F.replace(own, F.lit(mark), _sep(MARKS.index(mark) + 1))
    return F.when(text.rlike(f"[{marks}]"), own).otherwise(text)


def split_batch(df: DataFrame, col: str = "data") -> DataFrame:
    """One row ``message`` per message: line ends made equal, envelope lines left out, cut at each MSH."""
    text = F.regexp_replace(F.trim(F.col(col), F.lit(" \r\n\t")), "\r\n|\n", "\r")
    lines = F.filter(F.split(text, "\r"), lambda x: (F.trim(x) != "") & ~F.upper(F.substring(x, 1, 3)).isin(*ENVELOPE))
    messages = F.filter(F.split(F.array_join(lines, "\r"), "\r(?=(?i:MSH))"), lambda x: x != "")
    return df.select(*[c for c in df.columns if c != col], F.explode(messages).alias("message"))


def _marked(line: Column) -> Column:
    for i, mark in enumerate(MARKS, start=1):
        line = F.replace(line, _sep(i), F.lit(mark))
    return line


def parse_messages(df: DataFrame, col: str = "message") -> DataFrame:
    """Messages with their separators and the columns every segment row gets; no MSH, no row."""
    rest = [c for c in df.columns if c != col]
    text = F.col(col)
    rows = df.filter(text.rlike("(?i)(?:^|[\r\n])[ \t]*MSH."))
    plain = F.when(F.contains(text, F.lit("\n")), F.regexp_replace(text, "[\r\n]+", "\r")).otherwise(text)
    rows = rows.withColumn("message", plain)
    rows = rows.withColumn("_msh", F.regexp_extract("message", "(?i)(?:^|\r)[ \t]*(MSH[^\r]*)", 1))
    coding = F.when(F.length("_msh") >= 8, F.substring("_msh", 5, 4)).otherwise(F.lit("^~\\&"))
    rows = rows.withColumn("_coding", coding)
    part = lambda i: F.substring("_coding", i, 1)
    rows = rows.withColumns({"_seps": F.concat(F.substring("_msh", 4, 1), part(1), part(2), part(4)), "_esc": part(3)})
    rows = rows.withColumn("_head", F.split(_marked(F.col("_msh")), FIELD))
    head = lambda n: _some(_original(F.try_element_at("_head", F.lit(n))))
    blank = [c for c in ("source_file", "send_time", "create_time") if c not in df.columns]
    meta = {"message_id": head(10), "message_timestamp": head(7), "hl7_version": head(12)}
    rows = rows.withColumns(meta | {c: F.lit(None).cast("string") for c in blank})
    others = [c for c in rest if c not in META]
    # One-element explode: later filters on these columns stay above it, or Catalyst would put the
    # whole text work into the filter a second time.
    facts = F.struct(*META, "message", "_seps", "_esc")
    return rows.select(*others, F.explode(F.array(facts)).alias("_m")).select(*others, "_m.*")


def _lines(messages: DataFrame, kind: str) -> DataFrame:
    """The lines of one segment type and their ordinal in the message."""
    name = kind.upper()
    kind_of = lambda x: F.upper(F.trim(F.call_function("substring_index", x, _sep(1), F.lit(1))))
    starts = lambda x: F.upper(F.substring(F.ltrim(x), 1, len(name))) == name
    found = F.filter(F.split("message", "\r"), lambda x: starts(x) & (kind_of(x) == name))
    keep = [c for c in messages.columns if c != "message"]
    return messages.select(*keep, F.posexplode(found).alias("_no", "raw_segment"))


def segments(messages: DataFrame, kind: str) -> DataFrame:
    """The lines of one segment type: ordinal in the message, raw line, fields plain and decoded."""
    name = kind.upper()
    rows = _lines(messages, kind)
    rows = rows.withColumn("_line", _marked(F.col("raw_segment")))
    esc, line = F.col("_esc"), F.col("_line")
    if name == "MSH":
        # Field 1 of MSH is the separator itself, and the escape character in field 2 is none.
        fields = F.concat(F.array(F.lit("MSH"), _sep(1)), F.slice(F.split(line, FIELD), F.lit(2), F.size(F.split(line, FIELD))))
        return rows.withColumns({"_plain": fields, "_clear": fields})
    decoded = line
    for letter, value in zip(ESCAPES, (_sep(1), _sep(2), _sep(4), _sep(3), F.lit(""), F.lit(""), esc)):
        decoded = F.replace(decoded, F.concat(esc, F.lit(letter), esc), value)
    rows = rows.withColumn("_plain", F.split(line, FIELD))
    return rows.withColumn("_clear", F.when(F.contains(line, esc), F.split(decoded, FIELD)).otherwise(F.col("_plain")))


def _at(parts: Column, i: int) -> Column:
    return _some(F.try_element_at(parts, F.lit(i)))


def _part(text: Column, mark: str, k: int) -> Column:
    # Not ``split_part``, which compiles its separator for every value.
    return _some(F.try_element_at(F.split(text, mark), F.lit(k)))


def _cut(texts: pa.Array, mark: str) -> Callable[[int], pa.Array]:
    """The texts cut at a mark; a call gives the i-th part of each, null where it is absent or empty."""
    parts = pc.split_pattern(texts, mark)
    values, ends = parts.values, parts.offsets.to_numpy()
    empty = np.append(_lengths(values) == 0, True)

    def part(i: int) -> pa.Array:
        at = np.minimum(ends[:-1] + (i - 1), ends[1:])
        return values.take(pa.array(at, mask=empty[at] | (at == ends[1:])))

    return part


def _ends(texts: pa.Array) -> np.ndarray:
    return np.frombuffer(texts.buffers()[1], "int32", len(texts) + 1, texts.offset * 4) if len(texts) else np.zeros(1, "int32")


def _lengths(texts: pa.Array) -> np.ndarray:
    """Bytes of each text."""
    return np.diff(_ends(texts))


def _bytes(texts: pa.Array) -> np.ndarray:
    """The bytes of all texts, one after the other."""
    ends, data = _ends(texts), texts.buffers()[2]
    return np.empty(0, "uint8") if data is None else np.frombuffer(data, "uint8")[ends[0] : ends[-1]]


def _holds(texts: pa.Array, chars: str) -> bool:
    """Whether any of the characters is, or may be, in any text."""
    found = _bytes(texts)
    return any((found == char.encode()[0]).any() for char in chars)


def _by_message(texts: pa.Array, own: pa.Array, change: Callable[[pa.Array, str], pa.Array]) -> pa.Array:
    """``change`` of all texts whose messages have the same separators at a time."""
    codes = own.dictionary_encode()
    if len(codes.dictionary) < 2:
        return change(texts, codes.dictionary[0].as_py()) if len(codes.dictionary) else texts
    at = codes.indices.to_numpy()
    order = np.argsort(at, kind="stable")
    parts = np.split(order, np.cumsum(np.bincount(at))[:-1])
    done = pa.concat_arrays([change(texts.take(pa.array(rows)), code) for rows, code in zip(parts, codes.dictionary.to_pylist())])
    return done.take(pa.array(np.argsort(order, kind="stable")))


def _restored(texts: pa.Array, marks: str, seps: pa.Array) -> pa.Array:
    """Marks back to the characters of each text's message, as ``_original`` does it for columns."""
    if not _holds(texts, marks):
        return texts
    marked = pc.fill_null(pc.match_substring_regex(texts, f"[{marks}]"), False)

    def back(some: pa.Array, own: str) -> pa.Array:
        for mark in marks:
            some = pc.replace_substring(some, mark, own[MARKS.index(mark)])
        return some

    return pc.replace_with_mask(texts, marked, _by_message(texts.filter(marked), seps.filter(marked), back))


def _with_marks(lines: pa.Array, own: str) -> pa.Array:
    if not lines.null_count and own.isascii() and len(set(own + MARKS)) == 8:  # one pass over the bytes
        ends, marked = _ends(lines), _bytes(lines).tobytes().translate(bytes.maketrans(own.encode(), MARKS.encode()))
        return pa.StringArray.from_buffers(len(lines), pa.py_buffer(ends - ends[0]), pa.py_buffer(marked))
    for char, mark in zip(own, MARKS):
        lines = pc.replace_substring(lines, char, mark)
    return lines


def _decoded(lines: pa.Array, own: str) -> pa.Array:
    field, comp, rep, sub, esc = own
    for letter, value in zip(ESCAPES, (field, comp, sub, rep, "", "", esc)):
        lines = pc.replace_substring(lines, f"{esc}{letter}{esc}", value)
    return lines


def _leaves(kind: str, texts: pa.Array) -> dict[str, pa.Array]:
    """The named parts of a composite; times are left as they are written."""
    out, comp = {}, _cut(texts, COMP)
    for i, token in enumerate(COMPOSITES[kind].split(), start=1):
        if token == "-":
            continue
        whole = comp(i)
        if "=" in token:
            name, inner = token.split("=")
            sub, names = _cut(whole, SUB), COMPOSITES[inner].split()
            out[name] = pa.StructArray.from_arrays([sub(k) for k in range(1, len(names) + 1)], names, mask=pc.is_null(whole))
        elif "&" in token:
            sub = _cut(whole, SUB)
            for k, name in enumerate(token.lstrip("+").split("&"), start=1):
                if name:
                    out[name] = pc.coalesce(sub(k), whole) if k == 1 and token[0] == "+" else sub(k)
        else:
            out[token.rstrip("@")] = whole
    return out


def _struct_type(kind: str) -> T.StructType:
    out = T.StructType()
    for token in COMPOSITES[kind].split():
        if "=" in token:
            name, inner = token.split("=")
            out.add(name, _struct_type(inner))
        else:
            for name in token.lstrip("+").rstrip("@").split("&"):
                if name not in ("", "-"):
                    out.add(name, "string")
    return out


def _struct_array(kind: str, texts: pa.Array, absent: pa.Array | None = None) -> pa.StructArray:
    leaves = _leaves(kind, texts)
    return pa.StructArray.from_arrays([*leaves.values()], [*leaves], mask=absent)


#: Characters that JSON writes otherwise, as ``to_json`` has them.
JSON_ESCAPES = {chr(i): f"\\u{i:04X}" for i in range(32)} | {"\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r", '"': '\\"'}


def _escaped(texts: pa.Array) -> pa.Array:
    """Texts as they stand between the quotes of JSON."""
    found = _bytes(texts)
    if not ((found < 32) | (found == 34) | (found == 92)).any():
        return texts
    odd = pc.fill_null(pc.match_substring_regex(texts, '[\\x00-\\x1f"\\\\]'), False)
    some = pc.replace_substring(texts.filter(odd), "\\", "\\\\")
    for char, written in JSON_ESCAPES.items():
        some = pc.replace_substring(some, char, written)
    return pc.replace_with_mask(texts, odd, some)


def _places(ends: np.ndarray) -> np.ndarray:
    """The place of each part in its text, from 0."""
    return np.arange(ends[-1], dtype="int32") - np.repeat(ends[:-1], np.diff(ends))


def _json_parts(kind: str) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Of a composite: the name at each component and sub-component or -1, the names, and which components are cut, stand for an empty first part, and are times.

    One component and sub-component more stand for all further ones.
    """
    tokens = COMPOSITES[kind].split()
    names = [t.lstrip("+").rstrip("@").split("&") for t in tokens]
    at, all_names = np.full((len(tokens) + 1, max(map(len, names)) + 1), -1, "int16"), []
    for i, some in enumerate(names):
        for k, name in enumerate(some):
            if name not in ("", "-"):
                at[i, k] = len(all_names)
                all_names.append(name)
    return at, all_names, *(np.array([*map(test, [*tokens, "-"])]) for test in (lambda t: "&" in t, lambda t: t[0] == "+", lambda t: t[-1] == "@"))


def _quoted(texts: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise('"', _escaped(texts), '"', "")


def _times(texts: pa.Array) -> pa.Array:
    """Message times of any precision as ``parse_hl7_dtm`` reads them."""
    codes = texts.dictionary_encode()
    return pa.array([hl7_dtm_text(t) for t in codes.dictionary.to_pylist()], pa.string()).take(codes.indices)


def _json_object(parts: dict[str, pa.Array]) -> pa.Array:
    """Objects of JSON texts by name; a null is left out."""
    # An empty text before them, as Arrow drops rows where all that it joins is null.
    pieces = [pc.binary_join_element_wise(f',"{name}":', value, "") for name, value in parts.items()]
    none = pa.array(np.full(len(pieces[0]), ""), pa.string())
    return pc.binary_join_element_wise("{", pc.utf8_ltrim(pc.binary_join_element_wise(none, *pieces, "", null_handling="skip"), ","), "}", "")


def _json_by_leaf(kind: str, texts: pa.Array) -> pa.Array:
    """``_json`` out of ``_leaves``, for texts with separators where the composite has none."""
    times = [t[:-1] for t in COMPOSITES[kind].split() if t.endswith("@")]
    return _json_object({name: _quoted(_times(leaf) if name in times else leaf) for name, leaf in _leaves(kind, texts).items()})


def _json(kind: str, texts: pa.Array) -> pa.Array:
    """Composites as JSON, as ``to_json`` writes the structs of ``_struct_array`` with their times read; an absent text is ``{}``."""
    if "=" in COMPOSITES[kind]:
        comp, parts = _cut(texts, COMP), {}
        for i, token in enumerate(COMPOSITES[kind].split(), start=1):
            name, inner = token.split("=")
            whole = comp(i)
            parts[name] = pc.if_else(pc.is_valid(whole), _json(inner, pc.replace_substring(whole, SUB, COMP)), pa.scalar(None, pa.string()))
        return _json_object(parts)
    names, all_names, cut, whole_too, time = _json_parts(kind)
    last, most = names.shape[0] - 1, names.shape[1] - 1
    parts = pc.split_pattern(texts, COMP)
    values, ends = parts.values, parts.offsets.to_numpy()
    place = np.minimum(_places(ends), last)
    column = names[place, 0]
    if cut.any() and _holds(values, SUB):
        parts = pc.split_pattern(values, SUB)
        inner, starts = parts.values, parts.offsets.to_numpy()
        counts = np.diff(starts)
        first = _lengths(inner)[starts[:-1]] == 0
        if ((counts > 1) & (~cut[place] & (column >= 0) | whole_too[place] & first)).any():
            return _json_by_leaf(kind, texts)
        values, ends, place = inner, starts[ends], np.repeat(place, counts)
        column = names[place, np.minimum(_places(starts), most)]
    if time.any():
        at = pa.array(time[place])
        values = pc.replace_with_mask(values, at, pc.fill_null(_times(values.filter(at)), ""))
    kept = (_lengths(values) > 0) & (column >= 0)
    heads = pa.array([f'"{name}":"' for name in all_names]).take(pa.array(column[kept]))
    pieces = pc.binary_join_element_wise(heads, _escaped(values.filter(pa.array(kept))), '"', "")
    objects = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(kept))[ends].astype("int32")), pieces)
    return pc.binary_join_element_wise("{", pc.binary_join(objects, ","), "}", "")


def _json_list(values: pa.ListArray) -> pa.Array:
    """Lists of JSON texts as JSON."""
    return pc.binary_join_element_wise("[", pc.binary_join(values, ","), "]", "")


def _with_times(kind: str, item: Column) -> Column:
    """A composite with its times read."""
    for token in COMPOSITES[kind].split():
        if token.endswith("@"):
            item = item.withField(token[:-1], parse_hl7_dtm(item[token[:-1]]))
    return item


def _loose(kind: str) -> str:
    """Marks no rule of the composite cuts."""
    return REP if any(c in COMPOSITES[kind] for c in "&=") else REP + SUB


def _composite(kind: str, texts: pa.Array, seps: pa.Array, first: bool, json: bool) -> pa.Array:
    """A field as a struct, of its first repetition alone if ``first``; one of nothing but separators is null."""
    filled = pc.fill_null(pc.not_equal(pc.utf8_trim(texts, COMP + REP + SUB), ""), False)
    one = _restored(_cut(texts, REP)(1) if first else texts, _loose(kind), seps)
    return pc.if_else(filled, _json(kind, one), pa.scalar(None, pa.string())) if json else _struct_array(kind, one, pc.invert(filled))


def _repeated(texts: pa.Array, seps: pa.Array, item: Callable[[pa.Array, pa.Array], pa.Array]) -> pa.Array:
    """All non-empty repetitions; null when there is none, or ``item`` makes null of each."""
    parts = pc.split_pattern(texts, REP)
    kept = pc.not_equal(parts.values, "")
    row = np.repeat(np.arange(len(texts)), np.diff(parts.offsets.to_numpy()))[kept.to_numpy(zero_copy_only=False)]
    items = item(parts.values.filter(kept), seps.take(pa.array(row)))
    if items.null_count:
        row, items = row[pc.is_valid(items).to_numpy(zero_copy_only=False)], items.drop_null()
    counts = np.bincount(row, minlength=len(texts))
    ends = np.concatenate([[0], np.cumsum(counts)]).astype("int32")
    return pa.ListArray.from_arrays(pa.array(ends), items, mask=pa.array(counts == 0))


def _drop_nulls(items: Column) -> Column:
    kept = F.array_compact(items)
    return F.when(F.size(kept) > 0, kept)


#: Lines read at a time; each may take tens of thousands of bytes with all it gives.
BATCH = 2000

HDF_TAILS = ("", "_universal_id", "_universal_id_type")
MESSAGE_PARTS = ("message_code", "trigger_event", "message_structure")


def column_names(token: str) -> list[str]:
    """The columns a layout entry gives."""
    name, kind = token.split(":")
    if kind == "HDF":
        return [name + t for t in HDF_TAILS]
    if kind == "MSG":
        return list(MESSAGE_PARTS)
    return [f"{name}_start", f"{name}_end"] if kind == "DR" else [name]


def _repetition(kind: str, json: bool, texts: pa.Array, seps: pa.Array) -> pa.Array:
    """The repetitions of a field that is no composite."""
    if kind in ("ID", "ST"):
        texts = _restored(_cut(texts, COMP)(1) if kind == "ID" else texts, MARKS, seps)
    if not json:
        return texts
    return _quoted(_times(texts) if kind == "TS" else texts)


def _read(tokens: list[tuple[int, str]], header: bool, json: bool, lines: pa.Array, seps: pa.Array, esc: pa.Array) -> pa.Array:
    """The columns of lines of one type as they are written: texts, structs and lists; numbers and times stay texts.

    With ``json`` structs and lists are JSON, and times are read.
    """
    own = pc.binary_join_element_wise(seps, esc, "")
    marked = _by_message(lines, own, lambda some, o: _with_marks(some, o[:4]))
    plain = clear = _cut(marked, FIELD)
    if header:
        # Field 1 of MSH is the separator itself, and the escape character in field 2 is none.
        whole = plain
        plain = clear = lambda i: pc.utf8_slice_codeunits(seps, 0, 1) if i == 2 else whole(i - 1)
    else:
        if any(_holds(marked, o[4:]) for o in pc.unique(own).to_pylist()):
            escaped = _by_message(marked, own, lambda some, o: pc.match_substring(some, o[4]))
            clear = _cut(pc.replace_with_mask(marked, escaped, _by_message(marked.filter(escaped), own.filter(escaped), _decoded)), FIELD)
    out: list[pa.Array] = []
    for n, token in tokens:
        kind = token.split(":")[1]
        base = kind.rstrip("*~")
        if kind in ("HDF", "MSG", "DR"):
            part = _cut(_restored(clear(n + 1), REP + SUB, seps), COMP)
            parts = [part(i) for i in range(1, len(column_names(token)) + 1)]
            out += [*map(_times, parts)] if json and kind == "DR" else parts
        elif base in COMPOSITES and not kind.endswith("*"):
            out.append(_composite(base, clear(n + 1), seps, kind.endswith("~"), json))
        elif kind.endswith("*"):
            if base in COMPOSITES:
                # A composite without sub-components keeps their separator as text.
                loose, one = _loose(base).replace(REP, ""), _json if json else _struct_array
                item = lambda x, s: one(base, _restored(x, loose, s))
            else:
                item = partial(_repetition, base, json)
            items = _repeated(plain(n + 1), seps, item)
            out.append(_json_list(items) if json else items)
        else:
            field = _cut(plain(n + 1), REP)(1) if kind.endswith("~") else plain(n + 1)
            out.append(_restored(field, MARKS, seps) if base == "ST" else _times(field) if json and base == "TS" else field)
    return pa.StructArray.from_arrays(out, [c for _, t in tokens for c in column_names(t)])


def _type(kind: str, json: bool) -> T.DataType:
    """What ``_read`` gives for a field."""
    if json:
        return T.StringType()
    one = _struct_type(kind.rstrip("*~")) if kind.rstrip("*~") in COMPOSITES else T.StringType()
    return T.ArrayType(one) if kind.endswith("*") else one


def _typed(kind: str, value: Column, json: bool = False) -> Column:
    """A column of ``_read`` with its numbers and times read."""
    base = kind.rstrip("*~")
    if json and kind not in ("SI", "NO"):
        return value
    if base in COMPOSITES:
        if "@" not in COMPOSITES[base]:
            return value
        return F.transform(value, lambda x: _with_times(base, x)) if kind.endswith("*") else _with_times(base, value)
    if kind == "SI":
        return coerce_int(value)
    if kind == "NO":
        return F.coalesce(coerce_int(value), F.lit(1).cast("bigint"))
    if kind == "TS*":
        return _drop_nulls(F.transform(value, parse_hl7_dtm))
    return parse_hl7_dtm(value) if base in ("TS", "DR") else value


def segment_table(messages: DataFrame, kind: str, columns: Sequence[str] | None = None, json: bool = False) -> DataFrame:
    """One typed row per segment of a kind; unknown kinds give ``field_1`` to ``field_25`` as text.

    ``columns`` names the typed columns wanted, which keeps the plan of a wide segment small. With ``json`` structs and
    lists are given as their ``to_json`` text, which is written in the Arrow batches that read them: hundreds of nested
    values a line need not become rows of Spark first.
    """
    kind = kind.lower()
    others = [c for c in messages.columns if not c.startswith("_") and c != "message"]
    if kind not in SEGMENTS:
        plain = [_original(_at(F.col("_plain"), i + 1)).alias(f"field_{i}") for i in range(1, 26)]
        return segments(messages, kind).select(*others, F.lit(kind.upper()).alias("segment_type"), *plain, "raw_segment")
    tokens = [(n, t) for n, t in enumerate(SEGMENTS[kind].split(), 1) if columns is None or set(columns) & set(column_names(t))]
    given = [(c, t.split(":")[1]) for _, t in tokens for c in column_names(t)]

    @F.arrow_udf(T.StructType([T.StructField(c, _type(k, json)) for c, k in given]))
    def read(batches: Iterator[Tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        for lines, *own in batches:
            for at in range(0, len(lines), BATCH):
                yield _read(tokens, kind == "msh", json, *(x.slice(at, BATCH) for x in (lines, *own)))

    rows = _lines(messages, kind)
    if tokens:
        # Not deterministic to Catalyst, or it would read the lines once more for a filter on what was read.
        rows = rows.withColumn("_read", read.asNondeterministic()("raw_segment", "_seps", "_esc"))
    cols = [_typed(k, F.col("_read")[c], json).alias(c) for c, k in given]
    if kind not in SINGLE_SEGMENTS and "set_id:" not in SEGMENTS[kind]:
        cols.append((F.col("_no") + 1).cast("bigint").alias("set_id"))
    return rows.select(*others, *cols, "raw_segment")
