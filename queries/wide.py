"""The wide per-service table."""

from __future__ import annotations

from pyspark.sql import functions as F

from lossledger.operators.joins import join_role
from lossledger.plans import wide as W
from queries.registry import query
from queries.standins import Standins, ctes


def _latest(column: str) -> str:
    """Newest record's value; equal times are broken the same way on both sides only where times are unique."""
    return f"arg_max_null({column}, services_created_date) AS {column}"


def _clean(column: str) -> str:
    inner = f"NULLIF({column}, 'None')"
    return f"NULLIF({inner}, '') AS {column}" if column in W.EMPTY_COLUMNS else f"{inner} AS {column}"


_PLAIN = (
    "case_event_id, disease_case_id, services_related_service_id, services_health_plan_id, services_created_date, "
    "services_provided_by_content_type_id, services_provided_by_object_id"
)
_LATEST = [
    "case_event_id", "disease_case_id", "services_related_service_id", "caseevent_admission_source", "caseevent_category", "caseevent_class",
    "services_service_type_value", "services_provided_by_content_type_id", "services_provided_by_object_id", "doctor_specialization",
    "services_process_state", "services_diagnosis_icd", "caseeventfinalletterdata_cie_codes", "disease_origin_diagnosis_icd", "services_cpt",
    "caseeventfinalletterdata_cpt_codes", "diseasecase_description", "services_diagnosis_description",
]
# Note columns differ between the notes of one service, so the newest event's rows tie on them; they are left out of the check.
_WIDE = f"""WITH {ctes('medical_event', 'medical_note', 'service_payment', 'speciality_code', 'healthplan', 'application_item', 'application', 'coverage_ruling',
    'coverage_payout', 'payin_request', 'service_type', 'doctor', 'fare', 'medical_specialization', 'doctor_specialist_detail', 'doctor_friend', 'branch_office',
    'provider', 'provider_category', 'app_user', 'address', 'location', 'zipcode', 'billing_info', 'member')},
cleaned AS (SELECT DISTINCT member_id, service_id, {_PLAIN}, {', '.join(_clean(c) for c in W.SENTINEL_COLUMNS)}
            FROM medical_event LEFT JOIN medical_note USING (member_id, service_id)),
newest AS (SELECT member_id, service_id, services_health_plan_id AS healthplan_id, MAX(services_created_date) AS services_created_date, {', '.join(_latest(c) for c in _LATEST)},
           NULLIF(array_to_string(list_sort(list(DISTINCT interrogation_system)), ', '), '') AS med_note_system,
           NULLIF(array_to_string(list_sort(list(DISTINCT med_note_motive)), ', '), '') AS med_note_motive,
           NULLIF(array_to_string(list_sort(list(DISTINCT services_specification)), ', '), '') AS services_specification
           FROM cleaned GROUP BY 1, 2, 3),
paid AS (SELECT member_id, service_id, healthplan_id, MIN(transaction_date) AS first_day, MAX(transaction_date) AS last_day, SUM(subtotal) AS subtotal,
         array_to_string(list_sort(list(transaction_type)), ', ') AS types, ANY_VALUE(vertical) AS vertical, ANY_VALUE(age_at_subscription) AS age, ANY_VALUE(gender) AS gender
         FROM service_payment GROUP BY 1, 2, 3),
mode AS (SELECT r.service_id, r.id, r.state, r.updated_at, payout_mode AS o, method AS i FROM coverage_ruling r
         LEFT JOIN (SELECT * FROM coverage_payout WHERE deleted IS NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY service_coverage_ruling_id ORDER BY created_at DESC) = 1) p ON p.service_coverage_ruling_id = r.id
         LEFT JOIN (SELECT * FROM payin_request WHERE deleted IS NULL QUALIFY ROW_NUMBER() OVER (PARTITION BY service_coverage_ruling_id ORDER BY created_at DESC) = 1) q ON q.service_coverage_ruling_id = r.id),
modes AS (SELECT id, service_id, state, updated_at, CASE o WHEN 'DIRECT' THEN 'Pago directo' WHEN 'DIRECT_HOSPITAL' THEN 'Pago directo a hospital' WHEN 'REIMBURSEMENT' THEN 'Reembolso'
          WHEN 'COMPENSATION' THEN 'Compensación' ELSE o END AS payout_mode, CASE i WHEN 'CARD' THEN 'Pago con tarjeta' WHEN 'IN_SITU' THEN 'Pago in situ' END AS payin_mode FROM mode),
mode_1 AS (SELECT * FROM modes QUALIFY ROW_NUMBER() OVER (PARTITION BY service_id ORDER BY updated_at DESC NULLS LAST, id DESC) = 1),
addr_id AS (SELECT id, address1, address2, neighborhood, city, zipcode FROM address WHERE deleted IS NULL),
addr_doc AS (SELECT doctor_id, address1, address2, neighborhood, city, zipcode FROM address WHERE deleted IS NULL AND doctor_id IS NOT NULL
             QUALIFY ROW_NUMBER() OVER (PARTITION BY doctor_id ORDER BY updated_at DESC, id DESC) = 1),
loc AS (SELECT zipcode, municipality, state_name, city FROM location WHERE is_available QUALIFY ROW_NUMBER() OVER (PARTITION BY zipcode ORDER BY is_available_updated_at DESC) = 1),
zip AS (SELECT postal_code, longitude, latitude, admin_name1, admin_name2 FROM zipcode QUALIFY ROW_NUMBER() OVER (PARTITION BY postal_code ORDER BY admin_name1 DESC, admin_name2 DESC) = 1),
specs AS (SELECT doctor_id, NULLIF(array_to_string(list_sort(list(DISTINCT name)), ', '), '') AS doctor_specializations
          FROM doctor_specialist_detail LEFT JOIN medical_specialization m ON m.id = medical_specialization_id GROUP BY 1),
doc AS (SELECT *, first_name || ' ' || first_last_name || ' ' || second_last_name AS doctor_name FROM doctor),
mem AS (SELECT id, residence_address_id, occupation, height_cm, weight_kg, date_of_birth, nickname, birth_country, birth_country_code, nationality_country_code, rfc, first_name || ' ' || first_last_name || ' ' || second_last_name AS member_name,
        CASE WHEN user_id = represented_by_user_id OR user_id IS NULL THEN represented_by_user_id END AS represented FROM member WHERE deleted IS NULL),
wide AS (SELECT DISTINCT n.service_id, n.member_id, n.healthplan_id, n.case_event_id, n.services_service_type_value, st.descripcion, n.services_diagnosis_icd, n.caseeventfinalletterdata_cie_codes,
         n.services_cpt, n.med_note_system, n.med_note_motive, n.services_specification, n.services_provided_by_content_type_id AS tag,
         CASE h.relationship WHEN 'SL' THEN 'Titular' WHEN 'WF' THEN 'Esposa' WHEN 'HS' THEN 'Esposo' WHEN 'DG' THEN 'Hija' WHEN 'SN' THEN 'Hijo' ELSE CASE WHEN business_code IS NOT NULL THEN 'Empleado' END END AS relation,
         CASE WHEN business_code IS NOT NULL THEN 'Persona Moral' ELSE 'Persona Física' END AS owner_type, mo.payout_mode, mo.payin_mode, d.doctor_name, d.descriptor, fa.name AS fare_name,
         ms.name AS spec_name, specs.doctor_specializations, df.name AS doctorfriend_name, bo.name AS provider_name, pr.state AS provider_state, pc.name AS provider_category_name,
         ad.address1 AS doctor_address1, ap.address1 AS provider_address1, am.address1 AS member_address1, ld.municipality AS doctor_location_municipality,
         lp.state_name AS provider_location_state, lm.city AS member_location_city, zd.longitude AS doctor_longitude, zp.latitude AS provider_latitude, zm.admin_name2 AS member_admin_name2,
         mem.member_name, mem.occupation, mem.height_cm, mem.weight_kg, mem.represented, d.nickname AS doctor_nickname, d.is_primary_care_doctor, d.is_pediatrics_care_doctor, d.license_institution, d.available_on_demand, d.internal_notes,
         d.availability_hours, n.doctor_specialization, ms.description AS spec_description, ms.is_primary_care AS spec_primary, pr.contract_category, pr.website, pr.notes,
         ad.address2 AS doctor_address2, ap.address2 AS provider_address2, am.address2 AS member_address2, mem.nickname AS member_nickname, mem.birth_country, mem.birth_country_code,
         mem.nationality_country_code, mem.rfc, n.services_created_date, n.services_process_state, p.first_day, p.last_day, p.types, p.subtotal, p.vertical, p.age, p.gender
         FROM newest n JOIN paid p USING (member_id, service_id, healthplan_id)
         LEFT JOIN healthplan h ON h.id = n.healthplan_id LEFT JOIN application_item ai ON ai.id = h.health_plan_application_item_id LEFT JOIN application ac ON ac.id = ai.application_id
         LEFT JOIN mode_1 mo ON mo.service_id = n.service_id LEFT JOIN service_type st ON st.code = n.services_service_type_value
         LEFT JOIN doc d ON d.id = n.services_provided_by_object_id AND n.services_provided_by_content_type_id = 59 LEFT JOIN fare fa ON fa.id = d.specialization_fare_id
         LEFT JOIN medical_specialization ms ON ms.id = fa.medical_specialization_id LEFT JOIN specs ON specs.doctor_id = d.id
         LEFT JOIN doctor_friend df ON df.id = n.services_provided_by_object_id AND n.services_provided_by_content_type_id = 58
         LEFT JOIN branch_office bo ON bo.id = n.services_provided_by_object_id AND n.services_provided_by_content_type_id = 57
         LEFT JOIN provider pr ON pr.id = bo.provider_id LEFT JOIN provider_category pc ON pc.id = pr.category_id
         LEFT JOIN addr_doc ad ON ad.doctor_id = d.id LEFT JOIN app_user au ON au.id = bo.admin_user_id LEFT JOIN billing_info bi ON bi.user_id = au.id LEFT JOIN addr_id ap ON ap.id = bi.address_id
         LEFT JOIN mem ON mem.id = n.member_id LEFT JOIN addr_id am ON am.id = mem.residence_address_id
         LEFT JOIN loc ld ON ld.zipcode = ad.zipcode LEFT JOIN loc lp ON lp.zipcode = ap.zipcode LEFT JOIN loc lm ON lm.zipcode = am.zipcode
         LEFT JOIN zip zd ON zd.postal_code = ad.zipcode LEFT JOIN zip zp ON zp.postal_code = ap.zipcode LEFT JOIN zip zm ON zm.postal_code = am.zipcode)"""


@query(
    "collapse_latest",
    f"""{_WIDE} SELECT member_id, service_id, healthplan_id, CAST(services_created_date AS VARCHAR) AS services_created_date, case_event_id, disease_case_id,
        services_related_service_id AS related_service_id, caseevent_admission_source, caseevent_category, caseevent_class,
        CASE services_provided_by_content_type_id WHEN 57 THEN 'hospital-pharmacy-lab' WHEN 58 THEN 'doctor_out_of_network' ELSE 'doctor_in_network' END AS provider_network,
        services_provided_by_object_id AS provided_by_object_id, doctor_specialization, services_process_state AS services_state, services_diagnosis_description,
        med_note_system, med_note_motive, services_specification FROM newest""",
)
def collapse_latest(spark, sf):
    t = Standins(spark, sf)
    rows = W.collapse_records(W.clean_records(t["medical_event"], t["medical_note"]), t["speciality_code"])
    return rows.select(
        "member_id", "service_id", "healthplan_id", "services_created_date", "case_event_id", "disease_case_id", "related_service_id", "caseevent_admission_source",
        "caseevent_category", "caseevent_class", "provider_network", "provided_by_object_id", "doctor_specialization", "services_state", "services_diagnosis_description",
        "med_note_system", "med_note_motive", "services_specification",
    )


@query(
    "payment_summary",
    f"""{_WIDE} SELECT member_id, service_id, healthplan_id, CAST(first_day AS VARCHAR) AS transaction_date_min, CAST(last_day AS VARCHAR) AS transaction_date_max,
        types AS array_transaction_type, CAST(subtotal AS DOUBLE) AS subtotal, vertical FROM paid""",
)
def payment_summary(spark, sf):
    rows = W.payment_summary(Standins(spark, sf)["service_payment"])
    return rows.select(*W.KEYS, "transaction_date_min", "transaction_date_max", "array_transaction_type", "subtotal", "vertical")


@query(
    "dim_latest_address",
    f"""{_WIDE} SELECT doctor_id, a.address1, a.address2, a.neighborhood, a.zipcode, municipality, state_name, l.city, CAST(longitude AS DOUBLE) AS longitude, admin_name2
        FROM addr_doc a LEFT JOIN loc l USING (zipcode) LEFT JOIN zip ON postal_code = a.zipcode""",
)
def dim_latest_address(spark, sf):
    t = Standins(spark, sf)
    rows = W.newest_address(t["address"], ["doctor_id"]).drop("city")
    rows = join_role(rows, W.newest_location(t["location"]), "zipcode", "zipcode", {"municipality": "municipality", "state_name": "state_name", "city": "city"})
    return join_role(rows, W.zip_coordinates(t["zipcode"]), "zipcode", "postal_code", {"longitude": "longitude", "admin_name2": "admin_name2"})


@query("payment_mode_enrich", f"{_WIDE} SELECT id, service_id, state, payout_mode, payin_mode FROM modes")
def payment_mode_enrich(spark, sf):
    t = Standins(spark, sf)
    return W.payment_modes(t["coverage_ruling"], t["coverage_payout"], t["payin_request"]).drop("updated_at")


_CHECKED = {
    "service_id": "service_id", "member_id": "member_id", "healthplan_id": "healthplan_id", "case_event_id": "case_event_id",
    "service_type_from_description": "COALESCE(descripcion, 'Otro servicio')", "icd": "COALESCE(services_diagnosis_icd, caseeventfinalletterdata_cie_codes)", "cpt": "services_cpt",
    "med_note_system": "med_note_system", "med_note_motive": "med_note_motive", "services_specification": "services_specification",
    "provider_network": "CASE tag WHEN 57 THEN 'hospital-pharmacy-lab' WHEN 58 THEN 'doctor_out_of_network' ELSE 'doctor_in_network' END",
    "relationship_beneficiary_with_owner": "relation", "owner_type": "owner_type", "payout_mode": "payout_mode", "payin_mode": "payin_mode", "doctor_name": "doctor_name",
    "doctor_descriptor": "descriptor", "doctor_specializationfare_name": "fare_name", "doctor_specialization_name": "spec_name", "doctor_specializations": "doctor_specializations",
    "doctorfriend_name": "doctorfriend_name", "provider_name": "provider_name", "provider_state": "provider_state", "provider_category_name": "provider_category_name",
    "doctor_address1": "doctor_address1", "provider_address1": "provider_address1", "member_address1": "member_address1",
    "doctor_location_municipality": "doctor_location_municipality", "provider_location_state": "provider_location_state", "member_location_city": "member_location_city",
    "doctor_longitude": "CAST(doctor_longitude AS DOUBLE)", "provider_latitude": "CAST(provider_latitude AS DOUBLE)", "member_admin_name2": "member_admin_name2",
    "member_name": "member_name", "member_occupation": "occupation", "member_height_cm": "height_cm", "member_weight_kg": "weight_kg",
    "member_is_represented_by_user_id": "represented", "doctor_nickname": "doctor_nickname", "doctor_is_primary_care_doctor": "is_primary_care_doctor",
    "doctor_is_pediatrics_care_doctor": "is_pediatrics_care_doctor", "doctor_license_institution": "license_institution", "doctor_available_on_demand": "available_on_demand",
    "doctor_internal_notes": "internal_notes", "doctor_availability_hours": "availability_hours", "doctor_specialization": "doctor_specialization",
    "doctor_specialization_detail": "doctor_specialization", "doctor_specialization_description": "spec_description", "doctor_specialization_is_primary_care": "spec_primary",
    "provider_contract_category": "contract_category", "provider_website": "website", "provider_notes": "notes", "doctor_address2": "doctor_address2",
    "provider_address2": "provider_address2", "member_address2": "member_address2", "member_nickname": "member_nickname", "member_birth_country": "birth_country",
    "member_birth_country_code": "birth_country_code", "member_nationality_country_code": "nationality_country_code", "member_rfc": "rfc",
    "services_created_date": "CAST(services_created_date AS VARCHAR)", "services_state": "services_process_state", "transaction_date_min": "CAST(first_day AS VARCHAR)", "transaction_date_max": "CAST(last_day AS VARCHAR)",
    "array_transaction_type": "types", "subtotal": "CAST(subtotal AS DOUBLE)", "vertical": "vertical", "member_age_at_subscription": "age", "member_gender": "gender",
}


@query("wide_fact", f"{_WIDE} SELECT {', '.join(f'{v} AS {k}' for k, v in _CHECKED.items())} FROM wide")
def wide_fact(spark, sf):
    t = Standins(spark, sf)
    return W.wide_fact(t, t["service_payment"]).select(*_CHECKED)


@query(
    "join_preservation_audit",
    f"""{_WIDE}, one AS (SELECT COUNT(*) AS n_rows, CAST(SUM(p.subtotal) AS DOUBLE) AS total FROM newest JOIN paid p USING (member_id, service_id, healthplan_id))
        SELECT step, n_rows, total FROM one, (SELECT unnest(['0 paid services', '1 plan and rulings', '2 doctor', '3 provider', '4 addresses and member', '5 places']) AS step) s""",
)
def join_preservation_audit(spark, sf):
    """No join of the wide table repeats or loses a service or its money: every step has the counts of the first. All
    counts come from one run of the plan."""
    t, audit = Standins(spark, sf), W.JoinAudit("subtotal")
    W.wide_fact(t, t["service_payment"], audit=audit).write.format("noop").mode("overwrite").save()
    return audit.report(spark)
