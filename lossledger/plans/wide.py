"""The wide per-service table: cleaned medical records, payments, and some twenty dimension lookups."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lossledger.functions.rules import joined, nonempty, sentinel_to_null
from lossledger.operators.aggregates import distinct_array, latest_by_key, repeated_text
from lossledger.operators.joins import join_role
from lossledger.operators.ordered import first_per_key
from lossledger.plans.membership import Tables

KEYS = ("member_id", "service_id", "healthplan_id")

# Content tags of a service's provider.
OFFICE_TAG, FRIEND_TAG, DOCTOR_TAG = 57, 58, 59
NETWORK_LABELS = {57: "hospital-pharmacy-lab", 58: "doctor_out_of_network", 59: "doctor_in_network"}

# Labels of payment modes and of the beneficiary's relation to the owner.
PAYOUT_LABELS = {
    "DIRECT": "Pago directo",
    "DIRECT_HOSPITAL": "Pago directo a hospital",
    "DIRECT_CONSULTING_ROOM": "Pago directo a consultorio",
    "REIMBURSEMENT": "Reembolso",
    "REIMBURSEMENT_CFDI_RECIPIENT_MEMBER": "Reembolso (CFDI Soci@)",
    "COMPENSATION": "Compensación",
}
PAYIN_LABELS = {"CARD": "Pago con tarjeta", "IN_SITU": "Pago in situ"}
RELATION_LABELS = {"SL": "Titular", "WF": "Esposa", "HS": "Esposo", "DG": "Hija", "SN": "Hijo"}
EMPLOYEE, LEGAL_PERSON, NATURAL_PERSON = "Empleado", "Persona Moral", "Persona Física"
OTHER_SERVICE = "Otro servicio"

# Source columns whose text 'None' means NULL; the last two may be '' as well.
SENTINEL_COLUMNS = (
    "caseevent_admission_source", "caseevent_category", "caseevent_class", "services_service_type_value", "med_note_type",
    "doctor_specialization", "services_process_state", "services_diagnosis_icd", "caseeventfinalletterdata_cie_codes",
    "disease_origin_diagnosis_icd", "evaluation_cie_keys", "services_cpt", "caseeventfinalletterdata_cpt_codes", "diagnosis",
    "diseasecase_description", "services_specification", "specialization", "interrogation_system",
    "services_diagnosis_description", "med_note_motive",
)
EMPTY_COLUMNS = ("services_diagnosis_description", "med_note_motive")
TEXT_LISTS = {"interrogation_system": "med_note_system", "med_note_motive": "med_note_motive", "services_specification": "services_specification"}


def code_label(code: Column, labels: Mapping, default: Column | None = None) -> Column:
    """A short fixed code table as a map lookup, else ``default``."""
    pairs = [F.lit(x) for kv in labels.items() for x in kv]
    found = F.try_element_at(F.create_map(*pairs), code)
    return found if default is None else F.coalesce(found, default)


def label_from_table(rows: DataFrame, code: str, labels: DataFrame, out: str) -> DataFrame:
    """A code table of any size as a lookup join; an unlisted code stays, in upper case."""
    side = labels.select(F.col("code").alias("_code"), F.col("label").alias("_label"))
    found = rows.join(side, F.col("_code") == F.col(code), "left")
    return found.withColumn(out, F.coalesce("_label", F.upper(code))).drop("_code", "_label")


def clean_records(events: DataFrame, notes: DataFrame) -> DataFrame:
    """Medical events beside their notes, sentinels turned into NULL. Exact repeats may stay: what follows ignores them."""
    rows = events.join(notes, ["member_id", "service_id"], "left")
    present = [c for c in SENTINEL_COLUMNS if c in rows.columns]
    return sentinel_to_null(rows, present, [c for c in EMPTY_COLUMNS if c in rows.columns])


def collapse_records(clean: DataFrame, specialities: DataFrame) -> DataFrame:
    """One row per (member, service, plan): every attribute from the newest record, three text fields as lists.

    The newest record is picked once as a whole row; the lists come from distinct values; one grouping does both.
    """
    rows = clean.withColumnRenamed("services_health_plan_id", "healthplan_id")
    attributes = [c for c in rows.columns if c not in KEYS and c not in TEXT_LISTS]
    tie = F.xxhash64(*[F.col(c) for c in sorted(attributes)])
    picked = F.max_by(F.struct(*attributes), F.struct(F.col("services_created_date"), tie)).alias("_row")
    texts = [nonempty(F.array_sort(F.collect_set(source))).alias(f"_{name}") for source, name in TEXT_LISTS.items()]
    grouped = rows.groupBy(*KEYS).agg(picked, *texts)
    newest = grouped.select(*KEYS, "_row.*", *[joined(F.col(f"_{name}")).alias(f"_{name}") for name in TEXT_LISTS.values()])
    newest = label_from_table(newest, "specialization", specialities, "consult_specialization")
    tag = F.col("services_provided_by_content_type_id")
    return newest.select(
        *KEYS,
        "case_event_id",
        "disease_case_id",
        "services_created_date",
        "caseevent_admission_source",
        "caseevent_category",
        "caseevent_class",
        F.col("services_related_service_id").alias("related_service_id"),
        "services_service_type_value",
        F.coalesce("services_service_type_value", "med_note_type").alias("service_type"),
        tag.alias("provided_by_content_type_id"),
        code_label(tag, NETWORK_LABELS, tag.cast("string")).alias("provider_network"),
        F.col("services_provided_by_object_id").alias("provided_by_object_id"),
        "doctor_specialization",
        "consult_specialization",
        F.col("services_process_state").alias("services_state"),
        F.coalesce(
            "services_diagnosis_icd", "caseeventfinalletterdata_cie_codes", "disease_origin_diagnosis_icd", "evaluation_cie_keys"
        ).alias("icd"),
        F.coalesce("services_cpt", "caseeventfinalletterdata_cpt_codes").alias("cpt"),
        F.coalesce("diseasecase_description", "diagnosis").alias("diagnosis"),
        "services_diagnosis_description",
        *[F.col(f"_{name}").alias(name) for name in TEXT_LISTS.values()],
    )


def _join_keys(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the three keys, NULL equal to NULL, since both sides were grouped by them."""
    cond = [left[k].eqNullSafe(right[k]) for k in KEYS]
    extra = [right[c] for c in right.columns if c not in KEYS]
    return left.join(right, cond, how).select(left["*"], *extra)


PAYMENT_COLUMNS = (
    "service_type", "age_at_subscription", "gender", "vc_schema", "ipc_schema", "vertical", "is_internal", "is_collective",
    "product_id", "business_group_size", "business_group", "business_name",
)


def payment_summary(payments: DataFrame, keys: Sequence[str] = KEYS, latest: Sequence[str] = PAYMENT_COLUMNS) -> DataFrame:
    """Per service: attributes of the newest payment, first and last date, all transaction types, total."""
    tie = F.xxhash64(*[F.col(c) for c in sorted(payments.columns)])
    newest = F.max_by(F.struct(*latest), F.struct("transaction_date", tie)) if latest else F.lit(None)
    totals = payments.groupBy(*keys).agg(
        newest.alias("_new"),
        F.min("transaction_date").alias("transaction_date_min"),
        F.max("transaction_date").alias("transaction_date_max"),
        F.sum("subtotal").cast("decimal(28,2)").alias("subtotal"),
    )
    totals = totals.select(
        *keys, *[F.col(f"_new.{c}").alias(c) for c in latest], "transaction_date_min", "transaction_date_max", "subtotal"
    )
    types = repeated_text(payments, keys, "transaction_type", "array_transaction_type")
    cond = [totals[k].eqNullSafe(types[k]) for k in keys]
    return totals.join(types, cond, "left").select(totals["*"], types["array_transaction_type"])


def full_name(*parts: str) -> Column:
    """Name parts joined by blanks; NULL when one is missing."""
    cols = []
    for p in parts:
        cols += [F.lit(" "), F.col(p)]
    return F.concat(*cols[1:])


ADDRESS_COLUMNS = ("address1", "address2", "neighborhood", "city", "zipcode")


def newest_address(addresses: DataFrame, keys: Sequence[str]) -> DataFrame:
    live = addresses.where(F.col("deleted").isNull() & F.col(keys[0]).isNotNull())
    return latest_by_key(live, keys, [F.col("updated_at"), F.col("id")], ADDRESS_COLUMNS)


def newest_location(locations: DataFrame) -> DataFrame:
    tie = F.struct("municipality", "state_name", "city")
    live = locations.where("is_available").withColumn("_tie", tie)
    return latest_by_key(live, ["zipcode"], [F.col("is_available_updated_at"), F.col("_tie")], ["municipality", "state_name", "city"])


def zip_coordinates(zipcodes: DataFrame) -> DataFrame:
    order = [F.col("admin_name1"), F.col("admin_name2"), F.col("longitude"), F.col("latitude")]
    return latest_by_key(zipcodes, ["postal_code"], order, ["longitude", "latitude", "admin_name1", "admin_name2"])


def payment_modes(rulings: DataFrame, payouts: DataFrame, payins: DataFrame) -> DataFrame:
    """Coverage rulings with the newest live payout's and pay-in's mode, labelled."""
    payout = _newest_mode(payouts, "payout_mode")
    payin = _newest_mode(payins, "method")
    rows = join_role(rulings, payout, "id", "service_coverage_ruling_id", {"payout_mode": "_out"})
    rows = join_role(rows, payin, "id", "service_coverage_ruling_id", {"method": "_in"})
    return rows.select(
        "id",
        "service_id",
        "state",
        "updated_at",
        code_label(F.col("_out"), PAYOUT_LABELS, F.col("_out")).alias("payout_mode"),
        code_label(F.col("_in"), PAYIN_LABELS).alias("payin_mode"),
    )


def _newest_mode(rows: DataFrame, mode: str) -> DataFrame:
    live = rows.where(F.col("deleted").isNull())
    return first_per_key(live, ["service_coverage_ruling_id"], [F.col("created_at").desc(), F.col(mode).asc_nulls_last()])


def plan_owners(plans: DataFrame, items: DataFrame, applications: DataFrame) -> DataFrame:
    """(id, relation of beneficiary to owner, kind of owner)."""
    rows = join_role(plans.select("id", "relationship", "health_plan_application_item_id"), items, "health_plan_application_item_id", "id", {"application_id": "_app"})
    rows = join_role(rows, applications, "_app", "id", {"business_code": "_code"})
    employer = F.col("_code").isNotNull()
    return rows.select(
        "id",
        code_label(F.col("relationship"), RELATION_LABELS, F.when(employer, EMPLOYEE)).alias("relationship_beneficiary_with_owner"),
        F.when(employer, LEGAL_PERSON).otherwise(NATURAL_PERSON).alias("owner_type"),
    )


def specialities_by_doctor(details: DataFrame, specialities: DataFrame) -> DataFrame:
    named = join_role(details, specialities, "medical_specialization_id", "id", {"name": "_name"})
    return distinct_array(named, ["doctor_id"], "_name", "_names").select("doctor_id", joined(F.col("_names")).alias("doctor_specializations"))


MEMBER_COLUMNS = ("occupation", "height_cm", "weight_kg", "date_of_birth", "nickname", "birth_country", "birth_country_code", "nationality_country_code", "rfc")


def members_dim(members: DataFrame) -> DataFrame:
    represented = F.when((F.col("user_id") == F.col("represented_by_user_id")) | F.col("user_id").isNull(), F.col("represented_by_user_id"))
    live = members.where(F.col("deleted").isNull())
    return live.select(
        "id",
        "residence_address_id",
        "occupation",
        full_name("first_name", "first_last_name", "second_last_name").alias("member_name"),
        "height_cm",
        "weight_kg",
        "date_of_birth",
        "nickname",
        "birth_country",
        "birth_country_code",
        "nationality_country_code",
        "rfc",
        represented.alias("member_is_represented_by_user_id"),
    ).distinct()


def _with_place(rows: DataFrame, role: str, zip_col: str, locations: DataFrame, zips: DataFrame) -> DataFrame:
    """Location and coordinates of one role's zip code."""
    rows = join_role(
        rows, locations, zip_col, "zipcode",
        {"municipality": f"{role}_location_municipality", "state_name": f"{role}_location_state", "city": f"{role}_location_city"},
    )
    return join_role(
        rows, zips, zip_col, "postal_code",
        {"longitude": f"{role}_longitude", "latitude": f"{role}_latitude", "admin_name1": f"{role}_admin_name1", "admin_name2": f"{role}_admin_name2"},
    )


def newest_ruling(modes: DataFrame) -> DataFrame:
    """One ruling per service: the one changed last."""
    return first_per_key(modes, ["service_id"], [F.col("updated_at").desc_nulls_last(), F.col("id").desc()])


class JoinAudit:
    """Counts rows and sums an amount at several places of one plan, while it runs once: left joins on one row per key
    must leave both as they are."""

    def __init__(self, amount: str):
        self._amount, self._seen, self._kind = amount, [], "double"

    def watch(self, rows: DataFrame, step: str) -> DataFrame:
        seen = Observation()
        self._seen.append((step, seen))
        kind = rows.schema[self._amount].dataType
        self._kind = "decimal(38,2)" if isinstance(kind, T.DecimalType) else "long" if isinstance(kind, T.IntegralType) else "double"
        return rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.sum(F.col(self._amount).cast(self._kind)).cast(self._kind).alias("total"))

    def report(self, spark: SparkSession) -> DataFrame:
        """(step, n_rows, total) of each place; waits until the watched plan has run."""
        found = [(step, seen.get["n_rows"], seen.get["total"]) for step, seen in self._seen]
        return spark.createDataFrame(found, f"step string, n_rows long, total {self._kind}")


def wide_fact(t: Tables, payments: DataFrame, all_rulings: bool = False, audit: JoinAudit | None = None) -> DataFrame:
    """One wide row per paid service with medical, provider, doctor, member, plan and payment attributes.

    A service with several rulings takes the payment modes of the newest one; ``all_rulings`` repeats the service for
    each of them instead, and only then can rows be alike. ``audit`` counts the rows after each group of joins.
    """
    watched = audit.watch if audit else lambda rows, step: rows
    medical = collapse_records(clean_records(t["medical_event"], t["medical_note"]), t["speciality_code"])
    paid = payment_summary(payments)
    paid = paid.withColumnRenamed("service_type", "_paid_type")
    # The inner join is on plain equality: a service without a plan has no premium side.
    rows = medical.join(paid, list(KEYS))
    rows = watched(rows, "0 paid services")

    rows = join_role(rows, plan_owners(t["healthplan"], t["application_item"], t["application"]), "healthplan_id", "id",
                     {"relationship_beneficiary_with_owner": "relationship_beneficiary_with_owner", "owner_type": "owner_type"})
    modes = payment_modes(t["coverage_ruling"], t["coverage_payout"], t["payin_request"])
    modes = modes if all_rulings else newest_ruling(modes)
    rows = join_role(rows, modes, "service_id", "service_id", {"payout_mode": "payout_mode", "payin_mode": "payin_mode"})
    rows = watched(rows, "1 plan and rulings")
    rows = join_role(rows, t["service_type"], "services_service_type_value", "code", {"descripcion": "_described"})

    tag = F.col("provided_by_content_type_id")
    # What hangs on a doctor or a member alone is put beside it first, so that the wide rows are shuffled once for each.
    by_id, by_doctor = newest_address(t["address"], ["id"]), newest_address(t["address"], ["doctor_id"])
    doctor_address = {"address1": "doctor_address1", "address2": "doctor_address2", "neighborhood": "doctor_neighborhood", "city": "doctor_city", "zipcode": "doctor_zipcode"}
    doctors = t["doctor"].select(
        F.col("id").alias("_doctor"), full_name("first_name", "first_last_name", "second_last_name").alias("doctor_name"), F.col("descriptor").alias("doctor_descriptor"),
        *[F.col(c).alias(f"doctor_{c}") for c in ("is_active", "nickname", "is_primary_care_doctor", "is_pediatrics_care_doctor", "license_institution")],
        *[F.col(c).alias(f"doctor_{c}") for c in ("available_on_demand", "internal_notes", "availability_hours")], F.col("specialization_fare_id").alias("_fare"),
    )
    doctors = join_role(doctors, t["fare"], "_fare", "id", {"name": "doctor_specializationfare_name", "medical_specialization_id": "_spec"})
    doctors = join_role(doctors, t["medical_specialization"], "_spec", "id", {"name": "doctor_specialization_name", "type": "doctor_specialization_type",
                        "description": "doctor_specialization_description", "is_primary_care": "doctor_specialization_is_primary_care"})
    doctors = join_role(doctors, specialities_by_doctor(t["doctor_specialist_detail"], t["medical_specialization"]), "_doctor", "doctor_id",
                        {"doctor_specializations": "doctor_specializations"})
    doctors = join_role(doctors, by_doctor, "_doctor", "doctor_id", doctor_address)
    rows = join_role(rows, doctors, "provided_by_object_id", "_doctor", {c: c for c in doctors.columns}, when=tag == DOCTOR_TAG)
    rows = watched(rows, "2 doctor")
    rows = join_role(rows, t["doctor_friend"], "provided_by_object_id", "id", {"name": "doctorfriend_name"}, when=tag == FRIEND_TAG)

    rows = join_role(rows, t["branch_office"], "provided_by_object_id", "id",
                     {"name": "provider_name", "provider_id": "_provider", "admin_user_id": "_admin"}, when=tag == OFFICE_TAG)
    rows = join_role(rows, t["provider"], "_provider", "id", {"state": "provider_state", "contract_category": "provider_contract_category",
                      "website": "provider_website", "notes": "provider_notes", "category_id": "_category"})
    rows = join_role(rows, t["provider_category"], "_category", "id", {"name": "provider_category_name"})
    rows = watched(rows, "3 provider")

    locations, zips = newest_location(t["location"]), zip_coordinates(t["zipcode"])
    rows = rows.select(*[c for c in rows.columns if c not in doctor_address.values()], *doctor_address.values())
    # A billing address counts only for an administrator that is a known user.
    rows = join_role(rows, t["app_user"].select("id").distinct(), "_admin", "id", {"id": "_user"})
    rows = join_role(rows, t["billing_info"].select("user_id", "address_id").distinct(), "_user", "user_id", {"address_id": "_billing"})
    rows = join_role(rows, by_id, "_billing", "id",
                     {"address1": "provider_address1", "address2": "provider_address2", "neighborhood": "provider_address_neighborhood", "city": "provider_address_city",
                      "zipcode": "provider_address_zipcode"})
    members = members_dim(t["member"]).withColumnsRenamed({c: f"member_{c}" for c in MEMBER_COLUMNS}).withColumnRenamed("residence_address_id", "_residence")
    members = join_role(members, by_id, "_residence", "id",
                        {"address1": "member_address1", "address2": "member_address2", "neighborhood": "member_address_neighborhood", "city": "member_address_city",
                         "zipcode": "member_address_zipcode"})
    found = ["member_occupation", "member_name", *[f"member_{c}" for c in MEMBER_COLUMNS[1:]], "_residence", "member_is_represented_by_user_id"]
    found += [c for c in members.columns if c.startswith("member_address")]
    rows = join_role(rows, members, "member_id", "id", {c: c for c in found})
    rows = watched(rows, "4 addresses and member")
    for role, zip_col in (("doctor", "doctor_zipcode"), ("provider", "provider_address_zipcode"), ("member", "member_address_zipcode")):
        rows = _with_place(rows, role, zip_col, locations, zips)
    rows = watched(rows, "5 places")

    hidden = [c for c in rows.columns if c.startswith("_")]
    rows = (
        rows.withColumn("service_type", F.coalesce("service_type", "_paid_type"))
        .withColumn("doctor_specialization_detail", F.col("doctor_specialization"))
        .withColumn("service_type_from_description", F.coalesce("_described", F.lit(OTHER_SERVICE)))
        .withColumnsRenamed({"age_at_subscription": "member_age_at_subscription", "gender": "member_gender"})
    )
    rows = rows.drop(*hidden, "provided_by_object_id", "provided_by_content_type_id", "services_service_type_value")
    return rows.distinct() if all_rulings else rows


def join_audit(steps: Sequence[tuple[str, DataFrame]], amount: str) -> DataFrame:
    """(step, rows, total) of tables that are there already; for places within one plan ``JoinAudit`` needs no second run."""
    out = None
    for name, df in steps:
        one = df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(amount).alias("total")).select(F.lit(name).alias("step"), "n_rows", "total")
        out = one if out is None else out.unionByName(one)
    return out
