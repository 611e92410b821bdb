"""Checking SQL of the composite reports, as one chain of common table expressions over the stand-in tables.

Written in the plain join form (a date grid joined to facts by inequality, correlated head counts), which the Spark
side avoids, so the two sides share no method.
"""

from __future__ import annotations

from queries.registry import sql_local_date as local
from queries.registry import sql_ratio
from queries.scalars import SQL_SIZE_BAND
from queries.standins import OWN_CLINIC, PLAN_AS_OF, PLAN_START, ctes

AS_OF = f"DATE '{PLAN_AS_OF}'"
OPEN = "DATE '2100-01-01'"


def half_up(num: str, den: str) -> str:
    return f"CAST({sql_ratio(num, den, 0)} AS BIGINT)"


def band(x: str) -> str:
    return SQL_SIZE_BAND.format(x)


_MEMBERSHIP = f"""
base_am AS (SELECT id, health_plan_id, signed_at FROM amendment WHERE review_result = 'AP' AND deleted IS NULL AND amendment_category IN ('SA', 'CS', 'AS')),
ca_am AS (SELECT cancelled_amendment_id AS of_id, signed_at, json_extract_string(amendment_extras, '$.cancel_reason') AS code,
                 review_result = 'AP' AND deleted IS NULL AND amendment_category IN ('CN', 'DB', 'FR') AS effective FROM amendment WHERE cancelled_amendment_id IS NOT NULL),
base_ca AS (SELECT b.health_plan_id, b.signed_at AS base_signed, c.* FROM base_am b LEFT JOIN ca_am c ON c.of_id = b.id WHERE c.effective IS NOT FALSE),
canc AS (SELECT health_plan_id AS healthplan_id, MIN(CASE WHEN COALESCE(x.signed_at, h.cancelled_at) IS NOT NULL
                THEN LEAST(h.valid_through, COALESCE(x.signed_at, h.cancelled_at)) END) AS cancelled_at
         FROM base_ca x JOIN healthplan h ON h.id = x.health_plan_id AND h.deleted IS NULL GROUP BY 1),
reason AS (SELECT health_plan_id AS healthplan_id, COALESCE(description, 'Other / not specified') AS cancel_reason
           FROM base_ca LEFT JOIN cancel_reason USING (code) WHERE effective AND signed_at IS NOT NULL AND base_signed IS NOT NULL),
cancelled AS (SELECT c.*, COALESCE(cancel_reason, 'Other / not specified') AS cancel_reason FROM canc c LEFT JOIN reason USING (healthplan_id) WHERE cancelled_at IS NOT NULL),
live AS (SELECT h.*, r.id AS renewal_id FROM healthplan h LEFT JOIN healthplan r ON r.previous_health_plan_id = h.id WHERE h.deleted IS NULL AND r.deleted IS NULL),
owned AS (SELECT l.*, ba.business_id, TRIM(COALESCE(b.common_name, b.legal_name)) AS business_name FROM live l
          LEFT JOIN business_admin ba ON ba.role = 'OW' AND ba.user_id = l.owner_user_id AND l.is_owned_by_business LEFT JOIN business b ON b.id = ba.business_id),
members AS (SELECT DISTINCT o.id AS healthplan_id, business_id, business_name, beneficiary_member_id AS member_id, {local('signed_at')} AS subscription_date,
            COALESCE({local('c.cancelled_at')}, CASE WHEN {local('valid_through')} < {AS_OF} THEN {local('valid_through')} END) AS cancelation_date,
            internal IS NOT NULL AS is_internal, state AS healthplan_state
            FROM owned o LEFT JOIN canc c ON c.healthplan_id = o.id LEFT JOIN internal_plan ON internal = o.id WHERE is_owned_by_business),
bstate AS (SELECT business_id, CASE WHEN COUNT(DISTINCT member_id) FILTER (WHERE healthplan_state = 'AC') > 0 THEN 'AC' ELSE 'IN' END AS business_state,
                  MAX(cancelation_date) AS last_cancelation FROM members GROUP BY 1),
gm AS (SELECT m.*, business_state, CASE WHEN business_state = 'IN' THEN last_cancelation END AS business_cancelation_date, COALESCE(g."group", business_name) AS business_group
       FROM members m LEFT JOIN bstate USING (business_id) LEFT JOIN business_group g USING (business_id)),
gids AS (SELECT business_group, list_sort(list(DISTINCT business_id)) AS business_ids FROM gm GROUP BY 1),
gdates AS (SELECT business_group, MAX(business_cancelation_date) AS ended, MIN(subscription_date) AS started FROM gm GROUP BY 1),
gdays AS (SELECT business_group, subscription_date AS d FROM gm UNION SELECT business_group, cancelation_date FROM gm UNION SELECT business_group, {AS_OF} FROM gm),
peak AS (SELECT business_group, MAX(n) AS peak FROM (SELECT d.business_group, d.d, COUNT(DISTINCT member_id) AS n FROM gdays d
         LEFT JOIN gm ON gm.business_group = d.business_group AND subscription_date <= d.d AND (cancelation_date IS NULL OR cancelation_date > d.d)
         WHERE d.d IS NOT NULL GROUP BY 1, 2) GROUP BY 1),
after30 AS (SELECT g.business_group, (SELECT COUNT(DISTINCT member_id) FROM gm WHERE gm.business_group = g.business_group AND subscription_date <= g.started + 30
            AND (cancelation_date IS NULL OR cancelation_date > g.started + 30)) AS n30 FROM gdates g),
today AS (SELECT business_group, COUNT(DISTINCT member_id) AS n_today FROM gm WHERE healthplan_state = 'AC' GROUP BY 1),
group_size AS (SELECT business_group, business_ids, started AS business_group_incorporation_date, CASE WHEN COALESCE(n_today, 0) = 0 THEN ended END AS business_group_cancelation_date,
               COALESCE(n30, 0) AS members_30_days_after_incorporation, peak AS max_simultaneous_members, COALESCE(n_today, 0) AS members_as_of_today,
               {band('COALESCE(n30, 0)')} AS members_30_days_after_incorporation_range, {band('peak')} AS max_simultaneous_members_range,
               {band('COALESCE(n_today, 0)')} AS members_as_of_today_range
               FROM peak FULL JOIN today USING (business_group) FULL JOIN after30 USING (business_group)
               LEFT JOIN gdates USING (business_group) LEFT JOIN gids USING (business_group))"""

_PREMIUM = f"""
label AS (SELECT code, CASE WHEN legend LIKE '%Subscription Amendment' THEN 'Base Coverage'
          ELSE array_to_string(list_transform(regexp_extract_all(lower(legend), '[^-\\s]*[-\\s]?'), lambda w: upper(w[1]) || w[2:]), '') END AS title FROM amendment_code),
ca_fact AS (SELECT cancelled_amendment_id AS of_id, {local('signed_at')} AS amendment_cancelation_date FROM amendment
            WHERE amendment_category IN ('CN', 'DB', 'FR', 'AC') AND review_result = 'AP' AND deleted IS NULL),
fact AS (SELECT a.id AS amendment_id, a.health_plan_id AS healthplan_id, title AS amendment_category, {local('a.signed_at')} AS amendment_subscription_date,
         amendment_cancelation_date, {local('a.valid_since')} AS amendment_valid_since, {local('a.valid_through')} AS amendment_valid_through,
         CASE WHEN a.amendment_category = 'MDT' THEN premium_subtotal_difference_cents ELSE premium_net_premium_difference_cents END AS net_c,
         premium_subscription_type_surcharge_difference_cents AS sur_c, premium_subtotal_difference_cents AS sub_c, premium_total_difference_cents AS tot_c
         FROM amendment a LEFT JOIN label ON code = a.amendment_category LEFT JOIN ca_fact ON of_id = a.id
         WHERE premium_total_difference_cents > 0 AND deleted IS NULL AND review_result = 'AP'),
plan_row AS (SELECT DISTINCT o.id AS healthplan_id, CASE WHEN is_owned_by_business THEN 'B2B' ELSE 'B2C' END AS vertical, product_id, product_family, uuid,
       o.business_id, business_name, gs.business_group, gs.max_simultaneous_members_range AS business_group_size, collective_health_plan_id IS NOT NULL AS is_collective,
       beneficiary_member_id AS member_id,
       CASE WHEN product_family = 'mini' THEN '0.3M' ELSE regexp_replace(CAST({sql_ratio("CAST(json_extract_string(product_parameters_values, '$.maximumCoverageCents') AS BIGINT)", "100000000", 1)} AS VARCHAR), '\\.0$', '') || 'M' END AS insured_amount,
       {local('signed_at')} AS subscription_date, {local('valid_since')} AS since, {local('valid_through')} AS through, {local('c.cancelled_at')} AS cancelled,
       COALESCE(c.cancel_reason, CASE WHEN {AS_OF} > {local('valid_through')} AND renewal_id IS NULL AND state = 'IN' THEN 'Did not renew'
                WHEN inactive_reason = 'RN' OR renewal_id IS NOT NULL THEN 'Plan was renewed' END) AS cancel_reason,
       internal IS NOT NULL AS is_internal, CASE WHEN state = 'AC' AND {AS_OF} < {local('valid_through')} THEN 'Active' ELSE 'Inactive' END AS healthplan_state,
       subscription_type, EXTRACT(YEAR FROM {local('signed_at')}) - CAST(date_of_birth[1:4] AS BIGINT) AS age_at_subscription, gender,
       CAST(json_extract_string(product_parameters_values, '$.discountPercent') AS BIGINT) * 100 AS disc4
       FROM owned o LEFT JOIN cancelled c ON c.healthplan_id = o.id LEFT JOIN internal_plan ON internal = o.id LEFT JOIN member m ON m.id = beneficiary_member_id
       LEFT JOIN product p ON p.id = product_id LEFT JOIN group_size gs ON list_contains(gs.business_ids, o.business_id)),
plan_base AS (SELECT *, CASE WHEN {AS_OF} > through OR cancelled IS NOT NULL THEN COALESCE(cancelled, through) END AS cancelation_date,
       date_diff('day', since, LEAST({AS_OF}, through, cancelled)) + 1 AS days, date_diff('day', since, through) + 1 AS term FROM plan_row),
premium_0 AS (SELECT b.*, f.* EXCLUDE (healthplan_id, amendment_cancelation_date), COALESCE(f.amendment_cancelation_date, b.cancelation_date) AS amendment_cancelation_date,
       COALESCE(f.amendment_category IN ('Base Coverage', 'Maternity Add-On'), FALSE) AS in_scope,
       n.healthplan_uuid IS NOT NULL AND amendment_id IS NOT NULL AS listed
       FROM plan_base b LEFT JOIN fact f USING (healthplan_id) LEFT JOIN (SELECT DISTINCT healthplan_uuid FROM non_ceded_plan) n ON n.healthplan_uuid = b.uuid),
premium AS (SELECT *, CASE WHEN in_scope AND disc4 > 0 THEN {half_up('net_c * 10000', '10000 - disc4')} ELSE net_c END AS gross_c,
       date_diff('day', amendment_valid_since, LEAST({AS_OF}, amendment_valid_through, amendment_cancelation_date)) + 1 AS a_days,
       date_diff('day', amendment_valid_since, amendment_valid_through) + 1 AS a_term,
       NOT COALESCE(amendment_id IS NOT NULL AND (listed OR product_family = 'mini' OR amendment_category NOT IN ('Base Coverage', 'Maternity Add-On')), FALSE) AS participates FROM premium_0)"""

_COLLECTIONS = f"""
settled AS (SELECT id AS transaction_id, invoice_id, transaction_type, confirmed_at FROM transaction
            WHERE transaction_type IN ('DB', 'RF', 'FW', 'PY', 'PR') AND payment_gateway_result = 'OK' AND deleted IS NULL AND invoice_id IS NOT NULL),
inst AS (SELECT ii.* FROM invoice_item ii WHERE deleted IS NULL AND content_type_id IN (SELECT id FROM content_type WHERE model = 'healthplanamendment')),
collected AS (SELECT p.*, i.installment_number, i.valid_since AS i_since, i.valid_through AS i_through, s.transaction_id, s.transaction_type,
       {local('s.confirmed_at')} AS transaction_date, CASE WHEN s.transaction_type IN ('PR', 'RF', 'FW') THEN -1 ELSE 1 END AS sgn,
       i.subtotal_cents AS i_sub_c, i.net_premium_cents AS i_net_c, i.total_cents AS i_tot_c,
       {half_up('gross_c * CAST(i.net_premium_cents AS HUGEINT) * 10000', 'net_c')} AS i_gross_micro
       FROM premium p LEFT JOIN inst i ON i.object_id = p.amendment_id LEFT JOIN invoice_item_invoice l ON l.invoiceitem_id = i.id LEFT JOIN settled s ON s.invoice_id = l.invoice_id)"""

_ACCRUAL = f"""
cutoffs AS (SELECT CAST(DATE '{PLAN_START}' + to_months(CAST(i AS INTEGER)) - INTERVAL 1 DAY AS DATE) AS c FROM range(0, date_diff('month', DATE '{PLAN_START}', {AS_OF}) + 1) r(i)),
outside AS (SELECT DISTINCT healthplan_id FROM premium WHERE NOT is_internal),
classed AS (SELECT DISTINCT healthplan_id, CASE WHEN vertical = 'B2C' THEN 'B2C' ELSE vertical || ' (' || business_group_size || ')' END AS hp_class
            FROM premium WHERE healthplan_id IN (SELECT healthplan_id FROM outside)),
visible AS (SELECT c, amendment_id, installment_number, hp_class, MIN(CAST(i_since AS DATE)) AS s, MIN(CAST(i_through AS DATE)) AS t,
            LEAST(MIN(amendment_cancelation_date), MIN(CAST(i_through AS DATE)), {AS_OF}, MIN(cancelation_date), c) AS upto, SUM(sgn * i_gross_micro) AS micro
            FROM cutoffs JOIN collected ON transaction_date <= c AND amendment_subscription_date <= c AND subscription_date <= c JOIN classed USING (healthplan_id) GROUP BY 1, 2, 3, 4),
shared AS (SELECT *, CASE WHEN t <= upto THEN 10000000000 WHEN s > c THEN 0
           ELSE GREATEST(0, {half_up("(date_diff('day', s, upto) + 1) * 10000000000", "date_diff('day', s, t) + 1")}) END AS share FROM visible),
per_class AS (SELECT c, hp_class, SUM({half_up('micro * CAST(share AS HUGEINT)', '10000000000')}) AS micro FROM shared GROUP BY 1, 2),
accrued AS (SELECT c, hp_class, CASE WHEN c >= (SELECT MIN(c) FROM visible) THEN {half_up('COALESCE(micro, 0)', '10000')} END AS prem_c
            FROM cutoffs CROSS JOIN (SELECT DISTINCT hp_class FROM classed) LEFT JOIN per_class USING (c, hp_class))"""

_CLAIMS = f"""
clinic AS (SELECT d.id AS doctor_id, p.name AS clinic FROM doctor d LEFT JOIN branch_office o ON o.id = d.provider_branch_office_id LEFT JOIN provider p ON p.id = o.provider_id),
svc AS (SELECT s.*, {local('s.created_at')} AS day, c.clinic, c.doctor_id FROM service s LEFT JOIN clinic c ON c.doctor_id = s.provided_by_object_id AND s.provided_by_content_type_id = 59
        WHERE s.deleted IS NULL),
billed AS (SELECT s.health_plan_id AS healthplan_id, s.member_id, s.id AS service_id, s.disease_case_id, s.day AS service_created_at, COALESCE(legend, 'Other service') AS service_type,
        CAST(NULL AS VARCHAR) AS vc_schema, CASE WHEN service_type_value = 'IN_PERSON_CONSULT' THEN 'Fee per service' END AS ipc_schema, t.transaction_id, t.transaction_type,
        {local('t.confirmed_at')} AS transaction_date,
        i.subtotal_cents * CASE WHEN i.payment_flow = 'OUT' THEN 1 ELSE -1 END * CASE WHEN t.transaction_type IN ('DB', 'PY') THEN 1 ELSE -1 END AS sub_c
        FROM invoice_item i JOIN invoice_item_invoice l ON l.invoiceitem_id = i.id JOIN settled t ON t.invoice_id = l.invoice_id JOIN svc s ON s.id = i.object_id
        LEFT JOIN service_type st ON st.code = service_type_value
        WHERE i.deleted IS NULL AND i.content_type_id IN (21, 22) AND service_type_value <> 'ON_DEMAND_CONSULT'
          AND NOT (service_type_value = 'IN_PERSON_CONSULT_BY_PROVIDER' AND clinic = '{OWN_CLINIC}')),
consult AS (SELECT s.*, date_sub('minute', created_at, LEAD(created_at) OVER (PARTITION BY member_id ORDER BY created_at, s.id)) AS gap FROM svc s JOIN on_demand_consult o ON o.consult_ptr_id = s.id
        WHERE service_type_value = 'ON_DEMAND_CONSULT' AND process_state <> 'CANCELLED' AND o.state NOT IN ('CA', 'HN') AND NOT regexp_matches(lower(reason), 'prueba|test')),
vc AS (SELECT c.health_plan_id AS healthplan_id, c.member_id, c.id AS service_id, c.disease_case_id, c.day, CASE WHEN p.doctor_id IS NULL THEN 'Fee per hour' ELSE 'Payroll based' END AS scheme
        FROM consult c LEFT JOIN payroll_doctor p ON p.type = 'PRIMARY' AND p.doctor_id = c.provided_by_object_id AND c.day BETWEEN p.start_date AND COALESCE(p.end_date, {OPEN})
        WHERE gap IS NULL OR gap > 60),
days AS (SELECT CAST(unnest(generate_series(DATE '1995-01-01', {AS_OF}, INTERVAL 1 DAY)) AS DATE) AS day),
pay AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, p.type, p.doctor_id, COUNT(*) AS n_days, CAST(SUM(salary) * 100 AS BIGINT) AS pay_c
        FROM days JOIN payroll_doctor p ON p.start_date <= day AND COALESCE(p.end_date, {OPEN}) >= day GROUP BY 1, 2, 3),
vc_hours AS (SELECT month, SUM(c) AS cost_c FROM (
        SELECT CAST(date_trunc('month', CASE WHEN EXTRACT(DAY FROM d) <= 10 THEN d - INTERVAL 1 MONTH ELSE d END) AS DATE) AS month, SUM(c) AS c FROM (
          SELECT {local('t.confirmed_at')} AS d, i.subtotal_cents AS c FROM invoice_item i JOIN invoice_item_invoice l ON l.invoiceitem_id = i.id JOIN settled t ON t.invoice_id = l.invoice_id
          WHERE i.deleted IS NULL AND i.content_type_id = 31 AND t.transaction_type = 'PY') GROUP BY 1
        UNION ALL SELECT month, CAST(subtotal * 100 AS BIGINT) FROM monthly_consult_cost) GROUP BY 1),
vc_cost AS (SELECT month, 'Fee per hour' AS scheme, cost_c FROM vc_hours
        UNION ALL SELECT month, 'Payroll based', {half_up('SUM(pay_c)', "EXTRACT(DAY FROM last_day(month))")} FROM pay WHERE type = 'PRIMARY' GROUP BY month),
vc_n AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, scheme, COUNT(DISTINCT service_id) AS n FROM vc GROUP BY 1, 2),
vc_closed AS (SELECT month, scheme, n, cost_c FROM vc_n LEFT JOIN vc_cost USING (month, scheme) WHERE month < date_trunc('month', {AS_OF})),
vc_unit AS (SELECT month, scheme, n AS count_service, cost_c AS num, n AS den FROM vc_closed
        UNION ALL SELECT a.month, scheme, a.n, b.cost_c, b.n FROM vc_n a LEFT JOIN (SELECT * FROM vc_closed WHERE month = date_trunc('month', {AS_OF}) - INTERVAL 1 MONTH) b USING (scheme)
        WHERE a.month = date_trunc('month', {AS_OF})),
visit AS (SELECT s.health_plan_id AS healthplan_id, s.member_id, s.id AS service_id, s.disease_case_id, s.day, s.doctor_id, CASE WHEN p.doctor_id IS NULL THEN 'Fee per hour' ELSE 'Payroll based' END AS scheme,
        CAST({sql_ratio('pr.copay_in_person_consult_cents * 100', '116', 0)} AS BIGINT) AS copay_c
        FROM svc s LEFT JOIN payroll_doctor p ON p.type <> 'PRIMARY' AND p.doctor_id = s.doctor_id AND s.day BETWEEN p.start_date AND COALESCE(p.end_date, {OPEN})
        LEFT JOIN healthplan h ON h.id = s.health_plan_id LEFT JOIN product pr ON pr.id = h.product_id
        WHERE service_type_value = 'IN_PERSON_CONSULT_BY_PROVIDER' AND process_state <> 'CANCELLED' AND clinic = '{OWN_CLINIC}'
          AND s.id IN (SELECT service_id FROM coverage_ruling WHERE state <> 'CN')),
ipc_cost AS (SELECT month, doctor_id, 'Fee per hour' AS scheme, CAST(subtotal * 100 AS BIGINT) AS cost_c FROM monthly_cost
        UNION ALL SELECT month, doctor_id, 'Payroll based', {half_up('pay_c', "EXTRACT(DAY FROM last_day(month))")} FROM pay WHERE type <> 'PRIMARY'),
ipc_n AS (SELECT CAST(date_trunc('month', day) AS DATE) AS month, doctor_id, scheme, COUNT(DISTINCT service_id) AS n FROM visit GROUP BY 1, 2, 3),
ipc_lag AS (SELECT *, LAG(cost_c) OVER w AS prev_c, LAG(n) OVER w AS prev_n, month < date_trunc('month', {AS_OF}) AND cost_c IS NOT NULL AS known
        FROM ipc_n LEFT JOIN ipc_cost USING (month, doctor_id, scheme) WINDOW w AS (PARTITION BY scheme, doctor_id ORDER BY month)),
ipc_unit AS (SELECT month, doctor_id, scheme, n, CASE WHEN known THEN cost_c WHEN prev_c IS NOT NULL THEN prev_c WHEN scheme = 'Payroll based' THEN cost_c END AS num,
        CASE WHEN known THEN n WHEN prev_c IS NOT NULL THEN prev_n WHEN scheme = 'Payroll based' THEN n END AS den FROM ipc_lag),
paid_all AS (SELECT * EXCLUDE (sub_c), CAST(sub_c AS HUGEINT) * 100000000 AS sub_n FROM billed
        UNION ALL SELECT healthplan_id, member_id, service_id, disease_case_id, day, 'Videoconsult', v.scheme, NULL, NULL, 'PY', day, {half_up('num * CAST(100000000 AS HUGEINT)', 'den')}
        FROM vc v LEFT JOIN vc_unit u ON u.month = date_trunc('month', day) AND u.scheme = v.scheme
        UNION ALL SELECT healthplan_id, member_id, service_id, disease_case_id, day, 'In person consult by provider', NULL, v.scheme, NULL, 'PY', day, {half_up('num - copay_c * CAST(den AS HUGEINT)', 'den')} * CAST(100000000 AS HUGEINT)
        FROM visit v LEFT JOIN ipc_unit u ON u.month = date_trunc('month', day) AND u.scheme = v.scheme AND u.doctor_id = v.doctor_id),
payout AS (SELECT r.service_id, p.* FROM coverage_ruling r JOIN coverage_payout p ON p.service_coverage_ruling_id = r.id WHERE p.deleted IS NULL
        QUALIFY ROW_NUMBER() OVER (PARTITION BY r.service_id ORDER BY p.created_at DESC, p.service_coverage_ruling_id DESC, covered_subtotal_cents DESC) = 1),
gone AS (SELECT r.service_id FROM coverage_ruling r LEFT JOIN coverage_payout p ON p.service_coverage_ruling_id = r.id WHERE r.service_id IS NOT NULL
        GROUP BY 1 HAVING COUNT(*) = COUNT(p.deleted)),
vc_own AS (SELECT v.service_id, covered_subtotal_cents + coinsured_subtotal_cents AS own_c FROM vc v LEFT JOIN payout USING (service_id) WHERE v.service_id NOT IN (SELECT service_id FROM gone)),
vc_first AS (SELECT own_c, MIN(service_id) AS f FROM vc_own WHERE own_c IS NOT NULL GROUP BY 1),
vc_range AS (SELECT own_c, CASE WHEN ROW_NUMBER() OVER (ORDER BY f) = 1 THEN 1 ELSE f END AS f, COALESCE(LEAD(f) OVER (ORDER BY f) - 1, (SELECT MAX(service_id) FROM vc_own)) AS t FROM vc_first),
ipc_own AS (SELECT v.service_id, covered_subtotal_cents AS own_c, LAG(covered_subtotal_cents) OVER w AS p, LEAD(covered_subtotal_cents) OVER w AS n, f.amount_cents - v.copay_c AS dflt
        FROM visit v LEFT JOIN payout USING (service_id) LEFT JOIN doctor d ON d.id = v.doctor_id LEFT JOIN fare f ON f.id = d.specialization_fare_id
        WHERE v.service_id NOT IN (SELECT service_id FROM gone) WINDOW w AS (PARTITION BY v.doctor_id ORDER BY v.service_id)),
price AS (SELECT o.service_id, r.own_c AS price_c FROM vc_own o LEFT JOIN vc_range r ON o.service_id BETWEEN r.f AND r.t
        UNION ALL SELECT service_id, COALESCE(own_c, p, n, dflt) FROM ipc_own),
attr AS (SELECT * FROM premium QUALIFY ROW_NUMBER() OVER (PARTITION BY healthplan_id ORDER BY amendment_id NULLS FIRST) = 1),
claims AS (SELECT c.healthplan_id, c.member_id, a.vertical, a.business_group, a.business_group_size, a.age_at_subscription, a.product_family, c.service_id, c.service_created_at, c.service_type, c.vc_schema,
        CASE WHEN c.service_type IN ('In person consult', 'In person consult by provider') THEN COALESCE(ipc_schema, 'Fee per service') END AS ipc_schema,
        c.transaction_id, c.transaction_type, c.transaction_date, c.sub_n, price_c,
        NOT COALESCE(a.product_family = 'mini' OR c.service_id IN (SELECT service_id FROM non_ceded_service) OR h.uuid IN (SELECT healthplan_uuid FROM non_ceded_plan)
             OR (c.service_type = 'Videoconsult' AND a.product_id < 40), FALSE) AS participates
        FROM paid_all c LEFT JOIN attr a USING (healthplan_id) LEFT JOIN price USING (service_id) LEFT JOIN healthplan h ON h.id = c.healthplan_id)"""

_LOSS = f"""
paid_class AS (SELECT c, k.hp_class, COALESCE({half_up('SUM(sub_n)', '100000000')}, 0) AS paid_c FROM cutoffs CROSS JOIN (SELECT DISTINCT hp_class FROM classed) k
        LEFT JOIN (SELECT * FROM claims JOIN classed USING (healthplan_id) WHERE service_created_at <= (SELECT MAX(c) FROM cutoffs)) x ON x.hp_class = k.hp_class AND x.transaction_date <= c GROUP BY 1, 2),
finest AS (SELECT c, hp_class, 'All services' AS ss_class, CAST(paid_c AS BIGINT) AS paid_c, prem_c FROM paid_class JOIN accrued USING (c, hp_class))"""

_TABLES = (
    "healthplan amendment business_admin business business_group internal_plan cancel_reason amendment_code product member non_ceded_plan non_ceded_service "
    "content_type invoice_item invoice_item_invoice transaction service service_type on_demand_consult doctor branch_office provider payroll_doctor monthly_cost "
    "monthly_consult_cost coverage_ruling coverage_payout payin_request fare"
).split()

PLAN_CTES = ",\n".join([ctes(*_TABLES), _MEMBERSHIP, _PREMIUM, _COLLECTIONS, _ACCRUAL, _CLAIMS, _LOSS])


def plan_sql(select: str) -> str:
    """A SELECT over the chain; unused links are never run."""
    return f"WITH {PLAN_CTES}\n{select}"
