"""Insurance-shaped tables derived from the driver tables.

Each is one SELECT that Spark and the checking engine both accept, so both sides of a check start from the same rows.
Orders stand for health plans, lineitem for instalments and their payments, events for services, customers for
members and businesses, suppliers for doctors, nations and regions for branch offices and providers.
"""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from lossledger.sources.tables import read_table

PLAN_AS_OF = dt.date(2001, 6, 30)
PLAN_START = dt.date(1995, 2, 1)
OWN_CLINIC = "ASIA"

_SIGNED = "o_orderdate + INTERVAL '1' HOUR * (o_orderkey % 24)"
_TOTAL = "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100 AS BIGINT)"
_SERVICE_TIME = "ts - INTERVAL '1' DAY * (8400 + (user_id % 70) * 30)"
_VALUE = "CAST(CAST(value AS DECIMAL(18,2)) * 100 AS BIGINT)"
_CLAIM_ID = "1000000000000 + event_id"
_VISIT = "user_id * 100 + CAST(EXTRACT(DAY FROM ts) AS BIGINT)"

STANDINS: dict[str, str] = {
    "healthplan": f"""
        SELECT o_orderkey AS id,
               CASE WHEN o_orderkey % 7 = 3 THEN o_orderkey - 3 END AS previous_health_plan_id,
               CASE WHEN o_custkey % 20 < 15 THEN o_custkey - o_custkey % 20 ELSE o_custkey - o_custkey % 5 END AS owner_user_id,
               o_custkey AS beneficiary_member_id,
               o_orderkey % 200 AS product_id,
               CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 97 END AS collective_health_plan_id,
               CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey END AS health_plan_application_item_id,
               'hp-' || CAST(o_orderkey AS STRING) AS uuid,
               CASE WHEN o_orderstatus = 'O' THEN 'AC' ELSE 'IN' END AS state,
               CASE WHEN o_orderstatus = 'P' AND o_orderkey % 3 = 0 THEN 'RN' END AS inactive_reason,
               CASE WHEN o_orderkey % 2 = 0 THEN 'MO' ELSE 'YE' END AS subscription_type,
               CASE o_orderkey % 7 WHEN 0 THEN 'SL' WHEN 1 THEN 'WF' WHEN 2 THEN 'HS' WHEN 3 THEN 'DG' WHEN 4 THEN 'SN' END AS relationship,
               o_orderpriority IN ('1-URGENT', '2-HIGH', '3-MEDIUM') AS is_owned_by_business,
               {_SIGNED} AS signed_at,
               {_SIGNED} + INTERVAL '1' DAY AS valid_since,
               {_SIGNED} + INTERVAL '365' DAY AS valid_through,
               CASE WHEN o_orderstatus = 'F' AND o_orderkey % 2 = 0 THEN {_SIGNED} + INTERVAL '1' DAY * (o_orderkey % 400) END AS cancelled_at,
               CASE WHEN o_orderkey % 29 = 0 THEN o_orderdate END AS deleted,
               '{{{{"discountPercent": ' || CAST((o_orderkey % 4) * 5 AS STRING) || ', "maximumCoverageCents": '
                   || CAST((1 + o_orderkey % 5) * 36000000 AS STRING) || '}}}}' AS product_parameters_values
        FROM {{orders}}""",
    "amendment": f"""
        SELECT o_orderkey * 10 AS id, o_orderkey AS health_plan_id, CAST(NULL AS BIGINT) AS cancelled_amendment_id,
               CASE o_orderkey % 3 WHEN 0 THEN 'SA' WHEN 1 THEN 'CS' ELSE 'AS' END AS amendment_category,
               CASE WHEN o_orderkey % 13 = 0 THEN 'RJ' ELSE 'AP' END AS review_result,
               {_SIGNED} AS signed_at, {_SIGNED} + INTERVAL '1' DAY AS valid_since, {_SIGNED} + INTERVAL '365' DAY AS valid_through,
               CASE WHEN o_orderkey % 31 = 0 THEN o_orderdate END AS deleted,
               {_TOTAL} AS premium_total_difference_cents,
               CAST(FLOOR({_TOTAL} * 0.8) AS BIGINT) AS premium_subtotal_difference_cents,
               CAST(FLOOR({_TOTAL} * 0.7) AS BIGINT) AS premium_net_premium_difference_cents,
               CAST(FLOOR({_TOTAL} * 0.02) AS BIGINT) AS premium_subscription_type_surcharge_difference_cents,
               CAST(NULL AS STRING) AS amendment_extras
        FROM {{orders}}
        UNION ALL
        SELECT o_orderkey * 10 + 1, o_orderkey, CAST(NULL AS BIGINT), CASE WHEN o_orderkey % 4 = 1 THEN 'MT' ELSE 'MDT' END, 'AP',
               {_SIGNED} + INTERVAL '10' DAY, {_SIGNED} + INTERVAL '11' DAY, {_SIGNED} + INTERVAL '365' DAY, CAST(NULL AS TIMESTAMP),
               CAST(FLOOR({_TOTAL} * 0.1) AS BIGINT), CAST(FLOOR({_TOTAL} * 0.08) AS BIGINT), CAST(FLOOR({_TOTAL} * 0.07) AS BIGINT), CAST(0 AS BIGINT),
               CAST(NULL AS STRING)
        FROM {{orders}} WHERE o_orderkey % 2 = 1
        UNION ALL
        SELECT o_orderkey * 10 + 2, o_orderkey, o_orderkey * 10,
               CASE o_orderkey % 5 WHEN 0 THEN 'CN' WHEN 1 THEN 'DB' WHEN 2 THEN 'FR' WHEN 3 THEN 'CN' ELSE 'ZZ' END,
               CASE WHEN o_orderkey % 11 = 0 THEN 'RJ' ELSE 'AP' END,
               {_SIGNED} + INTERVAL '1' DAY * (o_orderkey % 300), {_SIGNED} + INTERVAL '1' DAY * (o_orderkey % 300), CAST(NULL AS TIMESTAMP),
               CASE WHEN o_orderkey % 37 = 0 THEN o_orderdate END,
               -{_TOTAL}, -CAST(FLOOR({_TOTAL} * 0.8) AS BIGINT), -CAST(FLOOR({_TOTAL} * 0.7) AS BIGINT), CAST(0 AS BIGINT),
               '{{{{"cancel_reason": "R' || CAST(o_orderkey % 6 AS STRING) || '"}}}}'
        FROM {{orders}} WHERE o_orderstatus = 'F' AND o_orderkey % 3 <> 0""",
    "business_admin": """
        SELECT c_custkey AS business_id, c_custkey AS user_id, 'OW' AS role FROM {customer} WHERE c_custkey % 20 IN (0, 15)
        UNION ALL
        SELECT c_custkey - 1, c_custkey, 'AD' FROM {customer} WHERE c_custkey % 20 = 1""",
    "business": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN ' ' || c_name || ' ' END AS common_name, c_name || ' Inc' AS legal_name
        FROM {customer}""",
    "business_group": """
        SELECT c_custkey AS business_id, 'Group ' || CAST(c_custkey % 9 AS STRING) AS "group" FROM {customer} WHERE c_custkey % 3 = 0""",
    "internal_plan": """SELECT o_orderkey AS internal FROM {orders} WHERE o_orderkey % 45 = 1""",
    "cancel_reason": """
        SELECT DISTINCT 'R' || CAST(n_nationkey % 5 AS STRING) AS code, 'Reason ' || CAST(n_nationkey % 5 AS STRING) AS description FROM {nation}""",
    "amendment_code": """
        SELECT 'SA' AS code, 'Subscription Amendment' AS legend
        UNION ALL SELECT 'CS', 'Collective Subscription Amendment'
        UNION ALL SELECT 'MT', 'MATERNITY add-on'
        UNION ALL SELECT 'MDT', 'medical TRAVEL' """,
    "product": """
        SELECT p_partkey AS id, CASE WHEN p_size % 10 = 0 THEN 'mini' WHEN p_size % 2 = 0 THEN 'max' ELSE 'core' END AS product_family,
               CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 10 AS BIGINT) AS copay_in_person_consult_cents
        FROM {part}""",
    "member": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_custkey END AS user_id, c_custkey - c_custkey % 2 AS represented_by_user_id,
               c_custkey AS residence_address_id,
               CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CAST(DATE '1940-01-01' + CAST((c_custkey * 37) % 22000 AS INT) AS STRING) AS date_of_birth,
               c_mktsegment AS occupation, 'Name' || CAST(c_custkey AS STRING) AS first_name, 'Sur' || CAST(c_nationkey AS STRING) AS first_last_name,
               CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 'Last' END AS second_last_name,
               150 + c_custkey % 45 AS height_cm, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE 45 + c_custkey % 60 END AS weight_kg,
               CASE WHEN c_custkey % 61 = 0 THEN TIMESTAMP '2000-01-01 00:00:00' END AS deleted,
               CASE WHEN c_custkey % 4 = 0 THEN 'Nick' || CAST(c_custkey % 12 AS STRING) END AS nickname, 'Country ' || CAST(c_nationkey AS STRING) AS birth_country,
               'C' || CAST(c_nationkey AS STRING) AS birth_country_code, 'C' || CAST((c_nationkey + c_custkey % 2) % 25 AS STRING) AS nationality_country_code,
               CASE WHEN c_custkey % 5 <> 0 THEN 'RFC' || CAST(c_custkey AS STRING) END AS rfc
        FROM {customer}""",
    "non_ceded_plan": """SELECT 'hp-' || CAST(o_orderkey AS STRING) AS healthplan_uuid FROM {orders} WHERE o_orderkey % 50 = 7""",
    "non_ceded_service": """SELECT event_id AS service_id FROM {events} WHERE event_id % 70 = 9""",
    "content_type": """
        SELECT CAST(CASE r_regionkey WHEN 0 THEN 11 WHEN 1 THEN 21 WHEN 2 THEN 22 WHEN 3 THEN 31 ELSE 99 END AS BIGINT) AS id,
               CASE r_regionkey WHEN 0 THEN 'healthplan' WHEN 1 THEN 'claims' WHEN 2 THEN 'pharmacy' ELSE 'consult' END AS app_label,
               CASE r_regionkey WHEN 0 THEN 'healthplanamendment' WHEN 1 THEN 'claimitem' WHEN 2 THEN 'pharmacyitem' WHEN 3 THEN 'ondemandconsulttimelog' ELSE 'other' END AS model
        FROM {region}""",
    "invoice_item": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, CAST(CASE WHEN l_linenumber > 0 THEN 11 END AS BIGINT) AS content_type_id,
               l_orderkey * 10 + CASE WHEN l_linenumber % 3 = 0 THEN 1 ELSE 0 END AS object_id,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) * 100 AS BIGINT) AS subtotal_cents,
               CAST(FLOOR(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) * 90) AS BIGINT) AS net_premium_cents,
               CAST(FLOOR(CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) * 116) AS BIGINT) AS total_cents,
               l_linenumber AS installment_number, CASE WHEN MAX(l_linestatus) = 'O' THEN 'OUT' ELSE 'IN' END AS payment_flow,
               MIN(l_shipdate) AS valid_since, MIN(l_shipdate) + INTERVAL '29' DAY AS valid_through,
               CASE WHEN l_orderkey % 41 = 0 THEN MIN(l_shipdate) END AS deleted
        FROM {{lineitem}} GROUP BY l_orderkey, l_linenumber
        UNION ALL
        SELECT {_CLAIM_ID}, CAST(CASE WHEN event_type = 'view' THEN 31 WHEN event_type = 'error' THEN 22 ELSE 21 END AS BIGINT), event_id,
               {_VALUE}, {_VALUE}, {_VALUE}, CAST(NULL AS INT), CASE WHEN event_id % 7 = 0 THEN 'IN' ELSE 'OUT' END,
               {_SERVICE_TIME}, {_SERVICE_TIME}, CASE WHEN event_id % 59 = 0 THEN {_SERVICE_TIME} END
        FROM {{events}}""",
    "invoice_item_invoice": f"""
        SELECT DISTINCT l_orderkey * 10 + l_linenumber AS invoiceitem_id, l_orderkey * 10 + l_linenumber AS invoice_id FROM {{lineitem}}
        UNION ALL
        SELECT {_CLAIM_ID}, {_CLAIM_ID} FROM {{events}}""",
    "transaction": f"""
        SELECT l_orderkey * 10 + l_linenumber AS id, l_orderkey * 10 + l_linenumber AS invoice_id,
               CASE WHEN l_returnflag = 'R' THEN 'RF' WHEN l_returnflag = 'A' AND l_linenumber = 6 THEN 'XX' WHEN l_returnflag = 'A' THEN 'DB'
                    WHEN l_linenumber = 7 THEN 'FW' ELSE 'PY' END AS transaction_type,
               l_shipdate + INTERVAL '1' HOUR * (l_partkey % 24) AS confirmed_at,
               CASE WHEN l_suppkey % 11 = 0 THEN 'KO' ELSE 'OK' END AS payment_gateway_result,
               CASE WHEN l_partkey % 37 = 0 THEN l_shipdate END AS deleted
        FROM {{lineitem}}
        UNION ALL
        SELECT {_CLAIM_ID}, {_CLAIM_ID}, CASE event_id % 9 WHEN 0 THEN 'RF' WHEN 1 THEN 'FW' ELSE 'PY' END,
               {_SERVICE_TIME} + INTERVAL '5' DAY, 'OK', CASE WHEN event_id % 43 = 0 THEN ts END
        FROM {{events}}""",
    "service": f"""
        SELECT event_id AS id, event_id AS health_plan_id, user_id AS member_id,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id * 10 + event_id % 10 END AS disease_case_id,
               (event_id * 7) % 100 AS provided_by_object_id,
               CAST(CASE WHEN event_type = 'error' THEN 57 WHEN event_type = 'signup' THEN 58 ELSE 59 END AS BIGINT) AS provided_by_content_type_id,
               CASE event_type WHEN 'view' THEN 'ON_DEMAND_CONSULT' WHEN 'click' THEN 'IN_PERSON_CONSULT_BY_PROVIDER'
                    WHEN 'purchase' THEN 'IN_PERSON_CONSULT' WHEN 'signup' THEN 'LAB' ELSE 'PHARMACY' END AS service_type_value,
               CASE WHEN event_id % 17 = 0 THEN 'CANCELLED' ELSE 'DONE' END AS process_state,
               {_SERVICE_TIME} AS created_at, CASE WHEN event_id % 53 = 0 THEN ts END AS deleted
        FROM {{events}}""",
    "service_type": """
        SELECT 'IN_PERSON_CONSULT' AS code, 'In person consult' AS legend, 'Consulta presencial' AS descripcion
        UNION ALL SELECT 'IN_PERSON_CONSULT_BY_PROVIDER', 'In person consult by provider', 'Consulta en consultorio'
        UNION ALL SELECT 'LAB', 'Laboratory', 'Laboratorio' """,
    "on_demand_consult": """
        SELECT event_id AS consult_ptr_id, CASE event_id % 19 WHEN 0 THEN 'CA' WHEN 1 THEN 'HN' ELSE 'DO' END AS state,
               CASE event_id % 23 WHEN 0 THEN 'Test call' WHEN 1 THEN 'una PRUEBA' WHEN 2 THEN NULL ELSE 'checkup' END AS reason
        FROM {events} WHERE event_type = 'view' """,
    "doctor": """
        SELECT s_suppkey AS id, s_suppkey AS user_id, s_suppkey AS specialization_fare_id, CAST(s_nationkey AS BIGINT) AS provider_branch_office_id,
               'Doc' || CAST(s_suppkey AS STRING) AS first_name, 'A' || CAST(s_nationkey AS STRING) AS first_last_name,
               CASE WHEN s_suppkey % 9 = 0 THEN NULL ELSE 'B' END AS second_last_name, 'Descriptor ' || CAST(s_nationkey AS STRING) AS descriptor,
               s_acctbal > 0 AS is_active, CASE WHEN s_suppkey % 3 = 0 THEN 'Dr ' || CAST(s_suppkey AS STRING) END AS nickname, s_suppkey % 2 = 0 AS is_primary_care_doctor,
               s_suppkey % 5 = 0 AS is_pediatrics_care_doctor, 'School ' || CAST(s_nationkey % 6 AS STRING) AS license_institution, s_suppkey % 7 <> 0 AS available_on_demand,
               CASE WHEN s_suppkey % 11 = 0 THEN 'note ' || CAST(s_suppkey AS STRING) END AS internal_notes, CAST(8 + s_suppkey % 4 AS STRING) || '-18' AS availability_hours
        FROM {supplier}""",
    "doctor_friend": """SELECT s_suppkey AS id, s_suppkey AS user_id, s_name AS name, CASE WHEN s_suppkey % 2 = 0 THEN 'T1' ELSE 'T2' END AS tier FROM {supplier}""",
    "branch_office": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, n_name AS name, CAST(n_regionkey AS BIGINT) AS provider_id, CAST(n_nationkey AS BIGINT) AS admin_user_id
        FROM {nation}""",
    "provider": """
        SELECT CAST(r_regionkey AS BIGINT) AS id, r_name AS name, CAST(r_regionkey % 2 AS BIGINT) AS category_id, 'ON' AS state,
               'Contract ' || CAST(r_regionkey % 3 AS STRING) AS contract_category, CASE WHEN r_regionkey <> 2 THEN 'site' || CAST(r_regionkey AS STRING) END AS website,
               CASE WHEN r_regionkey = 1 THEN 'a note' END AS notes
        FROM {region}""",
    "app_user": "SELECT c_custkey AS id FROM {customer} WHERE c_custkey % 8 <> 0",
    "provider_category": """
        SELECT DISTINCT CAST(r_regionkey % 2 AS BIGINT) AS id, 'Category ' || CAST(r_regionkey % 2 AS STRING) AS name FROM {region}""",
    "payroll_doctor": """
        SELECT s_suppkey AS doctor_id, CASE WHEN s_suppkey % 2 = 0 THEN 'PRIMARY' ELSE 'SPECIALIST' END AS type,
               CAST(DATE '1995-03-15' + CAST(s_suppkey % 500 AS INT) AS DATE) AS start_date,
               CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(DATE '1995-03-15' + CAST(s_suppkey % 500 + 900 + s_suppkey % 700 AS INT) AS DATE) END AS end_date,
               CAST(CAST(s_acctbal AS DECIMAL(18,2)) + 20000 AS DECIMAL(18,2)) AS salary
        FROM {supplier} WHERE s_suppkey % 3 <> 0""",
    "monthly_cost": """
        SELECT CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS month, l_suppkey AS doctor_id,
               CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS subtotal
        FROM {lineitem} WHERE l_returnflag = 'A' GROUP BY 1, 2""",
    "monthly_consult_cost": """
        SELECT CAST(DATE_TRUNC('month', l_shipdate) AS DATE) AS month, CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS subtotal
        FROM {lineitem} WHERE l_returnflag = 'N' GROUP BY 1""",
    "coverage_ruling": f"""
        SELECT event_id * 10 AS id, event_id AS service_id, CASE WHEN event_id % 15 = 0 THEN 'CN' ELSE 'AP' END AS state,
               {_SERVICE_TIME} + INTERVAL '1' DAY AS updated_at
        FROM {{events}}
        UNION ALL
        SELECT event_id * 10 + 1, event_id, 'AP', {_SERVICE_TIME} + INTERVAL '2' DAY FROM {{events}} WHERE event_id % 20 = 0""",
    "coverage_payout": f"""
        SELECT event_id * 10 AS service_coverage_ruling_id,
               CASE WHEN event_id % 4 = 0 THEN NULL ELSE 30000 + CAST((event_id - event_id % 500) / 500 AS BIGINT) * 500 END AS covered_subtotal_cents,
               CAST(1000 AS BIGINT) AS coinsured_subtotal_cents,
               CASE event_id % 5 WHEN 0 THEN 'DIRECT' WHEN 1 THEN 'REIMBURSEMENT' WHEN 2 THEN 'OTHER' WHEN 3 THEN 'COMPENSATION' END AS payout_mode,
               {_SERVICE_TIME} + INTERVAL '1' DAY AS created_at, CASE WHEN event_id % 47 = 0 THEN ts END AS deleted
        FROM {{events}}
        UNION ALL
        SELECT event_id * 10, 45000 + (event_id % 3) * 700, CAST(0 AS BIGINT), 'DIRECT_HOSPITAL', {_SERVICE_TIME} + INTERVAL '3' DAY, CAST(NULL AS TIMESTAMP)
        FROM {{events}} WHERE event_id % 60 = 1""",
    "payin_request": f"""
        SELECT event_id * 10 AS service_coverage_ruling_id, CASE event_id % 3 WHEN 0 THEN 'CARD' WHEN 1 THEN 'IN_SITU' ELSE 'CASH' END AS method,
               {_SERVICE_TIME} AS created_at, CASE WHEN event_id % 8 = 0 THEN ts END AS deleted
        FROM {{events}}""",
    "fare": """
        SELECT s_suppkey AS id, 'Fare ' || CAST(s_suppkey % 10 AS STRING) AS name, CAST(s_nationkey AS BIGINT) AS medical_specialization_id,
               50000 + s_suppkey * 100 AS amount_cents
        FROM {supplier}""",
    "medical_specialization": """
        SELECT CAST(n_nationkey AS BIGINT) AS id, 'Spec ' || n_name AS name, CASE WHEN n_regionkey = 0 THEN 'SURGICAL' ELSE 'CLINICAL' END AS type,
               'About ' || n_name AS description, n_regionkey = 3 AS is_primary_care FROM {nation}""",
    "doctor_specialist_detail": """
        SELECT s_suppkey AS doctor_id, CAST(s_nationkey AS BIGINT) AS medical_specialization_id FROM {supplier}
        UNION ALL SELECT s_suppkey, CAST((s_nationkey + 7) % 30 AS BIGINT) FROM {supplier}""",
    "address": """
        SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN CAST(c_custkey / 5 AS BIGINT) % 60 END AS doctor_id,
               'Street ' || CAST(c_custkey AS STRING) AS address1, CASE WHEN c_custkey % 3 = 0 THEN 'Flat ' || CAST(c_custkey % 20 AS STRING) END AS address2, 'Hood ' || CAST(c_custkey % 30 AS STRING) AS neighborhood, 'City ' || CAST(c_nationkey AS STRING) AS city,
               CAST(10000 + c_custkey % 500 AS STRING) AS zipcode, TIMESTAMP '2020-01-01 00:00:00' + INTERVAL '1' HOUR * (c_custkey % 700) AS updated_at,
               CASE WHEN c_custkey % 25 = 10 THEN TIMESTAMP '2021-01-01 00:00:00' END AS deleted
        FROM {customer}""",
    "location": """
        SELECT CAST(10000 + c_custkey % 510 AS STRING) AS zipcode, 'Mun ' || CAST(c_custkey % 41 AS STRING) AS municipality,
               'State ' || CAST(c_nationkey AS STRING) AS state_name, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 'Town ' || CAST(c_custkey % 13 AS STRING) END AS city,
               c_custkey % 6 <> 0 AS is_available, TIMESTAMP '2020-01-01 00:00:00' + INTERVAL '1' SECOND * c_custkey AS is_available_updated_at
        FROM {customer}""",
    "zipcode": """
        SELECT CAST(10000 + c_custkey % 490 AS STRING) AS postal_code, 'Admin ' || CAST(c_nationkey AS STRING) AS admin_name1,
               'Sub ' || CAST(c_custkey AS STRING) AS admin_name2, c_custkey * 0.5 AS longitude, c_nationkey * 0.25 AS latitude
        FROM {customer}""",
    "billing_info": """SELECT c_custkey AS user_id, c_custkey AS address_id FROM {customer}""",
    "application_item": """SELECT o_orderkey AS id, o_orderkey AS application_id FROM {orders}""",
    "application": """SELECT o_orderkey AS id, CASE WHEN o_orderkey % 2 = 0 THEN 'BC' END AS business_code FROM {orders}""",
    "medical_event": f"""
        SELECT user_id AS member_id, {_VISIT} AS service_id, event_id AS case_event_id,
               CASE WHEN event_id % 3 = 0 THEN NULL ELSE user_id * 10 + event_id % 10 END AS disease_case_id,
               event_id % 50 AS services_related_service_id, user_id AS services_health_plan_id, ts AS services_created_date,
               CASE event_id % 4 WHEN 0 THEN 'None' WHEN 1 THEN 'ER' WHEN 2 THEN 'ROUTINE' ELSE 'REFERRAL' END AS caseevent_admission_source,
               CASE WHEN event_type = 'error' THEN 'None' ELSE event_type END AS caseevent_category,
               CASE WHEN event_id % 2 = 0 THEN 'None' ELSE 'AMB' END AS caseevent_class,
               CASE event_type WHEN 'view' THEN 'None' WHEN 'click' THEN 'IN_PERSON_CONSULT_BY_PROVIDER' WHEN 'purchase' THEN 'IN_PERSON_CONSULT' ELSE 'LAB' END AS services_service_type_value,
               57 + event_id % 3 AS services_provided_by_content_type_id, (event_id * 7) % 100 AS services_provided_by_object_id,
               'Spec ' || CAST(event_id % 12 AS STRING) AS doctor_specialization, 'DONE' AS services_process_state,
               CASE WHEN event_id % 6 = 0 THEN 'None' ELSE 'ICD' || CAST(event_id % 40 AS STRING) END AS services_diagnosis_icd,
               'CIE' || CAST(event_id % 9 AS STRING) AS caseeventfinalletterdata_cie_codes, 'None' AS disease_origin_diagnosis_icd,
               CASE WHEN event_id % 5 = 0 THEN 'None' ELSE 'CPT' || CAST(event_id % 25 AS STRING) END AS services_cpt,
               'None' AS caseeventfinalletterdata_cpt_codes,
               CASE WHEN event_id % 10 = 0 THEN 'None' ELSE 'Case ' || CAST(event_id % 33 AS STRING) END AS diseasecase_description,
               CASE event_id % 8 WHEN 0 THEN '' WHEN 1 THEN 'None' ELSE 'Desc ' || CAST(event_id % 21 AS STRING) END AS services_diagnosis_description,
               CASE WHEN event_id % 4 = 3 THEN 'None' ELSE 'Specification ' || CAST(event_id % 15 AS STRING) END AS services_specification
        FROM {{events}}""",
    "medical_note": f"""
        SELECT user_id AS member_id, {_VISIT} AS service_id, 'NOTE' AS med_note_type, 'EV' || CAST(event_id % 4 AS STRING) AS evaluation_cie_keys,
               CASE WHEN event_id % 9 = 0 THEN 'None' ELSE 'Diag ' || CAST(event_id % 11 AS STRING) END AS diagnosis,
               CASE event_id % 6 WHEN 0 THEN 'S0' WHEN 2 THEN 'S1' WHEN 4 THEN 'zz' ELSE 'None' END AS specialization,
               CASE WHEN event_id % 4 = 0 THEN 'None' ELSE 'System ' || CAST(event_id % 3 AS STRING) END AS interrogation_system,
               CASE event_id % 5 WHEN 0 THEN '' WHEN 1 THEN 'None' ELSE 'Motive ' || CAST(event_id % 6 AS STRING) END AS med_note_motive
        FROM {{events}} WHERE event_type IN ('view', 'purchase')""",
    "speciality_code": """SELECT DISTINCT 'S' || CAST(n_nationkey % 2 AS STRING) AS code, 'SPECIALITY ' || CAST(n_nationkey % 2 AS STRING) AS label FROM {nation}""",
    "service_payment": f"""
        SELECT user_id AS member_id, {_VISIT} + CASE WHEN event_type = 'error' AND event_id % 2 = 1 THEN 1000000000 ELSE 0 END AS service_id, user_id AS healthplan_id,
               CASE event_type WHEN 'click' THEN 'In person consult by provider' WHEN 'view' THEN 'Videoconsult' ELSE 'Other service' END AS service_type,
               CAST(20 + user_id % 60 AS BIGINT) AS age_at_subscription, CASE WHEN user_id % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
               CASE WHEN event_type = 'view' THEN 'Fee per hour' END AS vc_schema, CASE WHEN event_type = 'click' THEN 'Payroll based' END AS ipc_schema,
               CASE WHEN user_id % 3 = 0 THEN 'B2C' ELSE 'B2B' END AS vertical, user_id % 11 = 0 AS is_internal, user_id % 4 = 0 AS is_collective,
               user_id % 30 AS product_id, CASE user_id % 4 WHEN 0 THEN '1 - 9' WHEN 1 THEN '10 - 19' WHEN 2 THEN '20 - 49' ELSE '50 or more' END AS business_group_size,
               'Group ' || CAST(user_id % 9 AS STRING) AS business_group, 'Business ' || CAST(user_id % 40 AS STRING) AS business_name,
               CAST(ts AS DATE) AS transaction_date, CASE event_type WHEN 'error' THEN 'RF' WHEN 'click' THEN 'DB' WHEN 'signup' THEN NULL ELSE 'PY' END AS transaction_type,
               CAST(value AS DECIMAL(18,2)) AS subtotal
        FROM {{events}}""",
}


def _base_tables(text: str) -> set[str]:
    return set(re.findall(r"(?<!\{)\{(\w+)\}", text))


class Standins(Mapping[str, DataFrame]):
    """The stand-in tables, built on first use; each driver table is opened once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._spark, self._folder = spark, folder
        self._base: dict[str, DataFrame] = {}
        self._made: dict[str, DataFrame] = {}

    def _table(self, name: str) -> DataFrame:
        if name not in self._base:
            self._base[name] = read_table(self._spark, self._folder, name)
        return self._base[name]

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            text = STANDINS[name].replace('"group"', "`group`")
            self._made[name] = self._spark.sql(text, **{b: self._table(b) for b in _base_tables(text)})
        return self._made[name]

    def __iter__(self):
        return iter(STANDINS)

    def __len__(self) -> int:
        return len(STANDINS)


def ctes(*names: str) -> str:
    """The same tables for the checking SQL, as a comma list for a WITH clause."""
    return ",\n".join(f"{n} AS ({STANDINS[n].format(**{b: b for b in _base_tables(STANDINS[n])})})" for n in names)
