"""Feature engineering, embeddings, clustering, regression."""

from __future__ import annotations

import uuid

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from lossledger.functions.rules import to_money
from lossledger.models import cluster as K
from lossledger.models import components as V
from lossledger.models import embed as E
from lossledger.models import features as X
from lossledger.models import graph as T
from lossledger.models import regress as G
from lossledger.models import stages as S
from lossledger.sources.tables import materialise, publish, published, work_folder
from queries.registry import Tables, query, sql_ratio
from queries.standins import Standins, ctes

# What the models are trained on here: payments of services, one row each.
SPEC = X.FeatureSpec(
    labels=("service_type", "gender", "business_group_size", "ipc_schema", "transaction_type", "business_name"),
    buckets=(("age_at_subscription", 8),),
    scaled=("age_at_subscription", "product_id"),
    crosses=(("gender", "vertical"), ("business_group", "vertical")),
)
SPEC_SMALL = X.FeatureSpec(labels=("service_type", "gender", "transaction_type"), buckets=(("age_at_subscription", 8),))


@query(
    "label_encode",
    """WITH r AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_name END AS name, c_mktsegment FROM customer),
            n AS (SELECT name, DENSE_RANK() OVER (ORDER BY name) AS code FROM (SELECT DISTINCT name FROM r WHERE name IS NOT NULL)),
            s AS (SELECT c_mktsegment, DENSE_RANK() OVER (ORDER BY c_mktsegment) AS code FROM (SELECT DISTINCT c_mktsegment FROM r))
       SELECT c_custkey, COALESCE(n.code, 0) AS name_code, COALESCE(s.code, 0) AS segment_code FROM r LEFT JOIN n USING (name) LEFT JOIN s USING (c_mktsegment)""",
)
def label_encode(spark, sf):
    c = Tables(spark, sf).customer
    c = c.select("c_custkey", F.when(F.col("c_custkey") % 9 != 0, F.col("c_name")).alias("name"), "c_mktsegment")
    out = X.encode_label(c, X.label_codes(c, "name"), "name", "name_code")
    return X.encode_label(out, X.label_codes(c, "c_mktsegment"), "c_mktsegment", "segment_code").select("c_custkey", "name_code", "segment_code")


@query(
    "quantile_bucketize",
    """WITH q AS (SELECT list_distinct(quantile_cont(o_totalprice, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) AS cuts FROM orders)
       SELECT o_orderkey, 'bin_' || (1 + len(list_filter(cuts, lambda c: c <= o_totalprice))) AS bin FROM orders, q""",
)
def quantile_bucketize(spark, sf):
    o = Tables(spark, sf).orders
    return o.select("o_orderkey", X.bucket_label(F.col("o_totalprice"), X.quantile_cuts(o, "o_totalprice", 8)).alias("bin"))


@query(
    "robust_scale",
    """WITH q AS (SELECT quantile_cont(o_totalprice, [0.25, 0.5, 0.75]) AS q FROM orders)
       SELECT o_orderkey, ROUND((o_totalprice - q[2]) / (q[3] - q[1]), 8) AS scaled FROM orders, q""",
)
def robust_scale(spark, sf):
    o = Tables(spark, sf).orders
    median, spread = X.robust_params(o, "o_totalprice")
    return o.select("o_orderkey", F.round(X.robust_scale(F.col("o_totalprice"), median, spread), 8).alias("scaled"))


@query("feature_cross", "SELECT p_partkey, p_brand || '_' || CASE WHEN p_size % 5 <> 0 THEN p_type END AS crossed FROM part")
def feature_cross(spark, sf):
    p = Tables(spark, sf).part
    return p.select("p_partkey", X.feature_cross(F.col("p_brand"), F.when(F.col("p_size") % 5 != 0, F.col("p_type"))).alias("crossed"))


_BMI = "(10000.0 * weight_kg / (height_cm * height_cm))"


@query(
    "ratio_band",
    f"""WITH {ctes('member')} SELECT id, CASE WHEN {_BMI} < 18.5 THEN 'Underweight' WHEN {_BMI} >= 18.5 AND {_BMI} <= 24.9 THEN 'Normal weight' WHEN {_BMI} >= 25 AND {_BMI} <= 29.9 THEN 'Overweight'
        WHEN {_BMI} >= 30 AND {_BMI} <= 34.9 THEN 'Obesity Class I (Moderate)' WHEN {_BMI} >= 35 AND {_BMI} <= 39.9 THEN 'Obesity Class II (Severe)'
        WHEN {_BMI} >= 40 THEN 'Obesity Class III (Very severe or morbid obesity)' ELSE 'Unknown' END AS band FROM member""",
)
def ratio_band(spark, sf):
    m = Standins(spark, sf)["member"]
    return m.select("id", X.body_mass_band(F.col("weight_kg"), F.col("height_cm")).alias("band"))


def _fitted(spark, sf, spec=SPEC):
    rows = Standins(spark, sf)["service_payment"].withColumn("subtotal", F.col("subtotal").cast("double"))
    return rows, X.FeatureModel.fit(rows, spec)


_LABELS = ", ".join(f"COALESCE(k_{c}.code, 0) AS {c}_code" for c in SPEC.labels)
_LABEL_CTES = ", ".join(
    f"k_{c} AS (SELECT {c}, DENSE_RANK() OVER (ORDER BY {c}) AS code FROM (SELECT DISTINCT {c} FROM service_payment WHERE {c} IS NOT NULL))" for c in SPEC.labels
)
_LABEL_JOINS = " ".join(f"LEFT JOIN k_{c} ON k_{c}.{c} = p.{c}" for c in SPEC.labels)


@query(
    "feature_transform",
    f"""WITH {ctes('service_payment')}, {_LABEL_CTES}, q AS (SELECT list_distinct(quantile_cont(age_at_subscription, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) AS cuts,
          quantile_cont(age_at_subscription, [0.25, 0.5, 0.75]) AS a, quantile_cont(product_id, [0.25, 0.5, 0.75]) AS b FROM service_payment)
        SELECT member_id, service_id, {_LABELS}, ROUND((age_at_subscription - a[2]) / (a[3] - a[1]), 8) AS age_at_subscription_scaled, ROUND((product_id - b[2]) / (b[3] - b[1]), 8) AS product_id_scaled,
          'bin_' || (1 + len(list_filter(cuts, lambda c: c <= age_at_subscription))) AS age_at_subscription_bucket, p.gender || '_' || vertical AS gender_x_vertical,
          business_group || '_' || vertical AS business_group_x_vertical FROM service_payment p {_LABEL_JOINS}, q""",
)
def feature_transform(spark, sf):
    rows, model = _fitted(spark, sf)
    out = model.transform(rows).select("member_id", "service_id", *model.numeric_columns(), *model.category_columns())
    return out.withColumns({f"{c}_scaled": F.round(f"{c}_scaled", 8) for c in SPEC.scaled})


@query(
    "transform_label_audit",
    f"""WITH {ctes('service_payment')}, c AS (SELECT business_group_size, DENSE_RANK() OVER (ORDER BY business_group_size) AS code FROM (SELECT DISTINCT business_group_size FROM service_payment))
        SELECT DISTINCT code AS business_group_size_coded, business_group_size FROM service_payment JOIN c USING (business_group_size)""",
)
def transform_label_audit(spark, sf):
    rows, model = _fitted(spark, sf, X.FeatureSpec(labels=("business_group_size",)))
    coded = model.transform(rows).select(F.col("business_group_size_code").alias("business_group_size_coded"), "business_group_size")
    return coded.distinct().orderBy("business_group_size_coded")


@query(
    "training_window",
    "SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1999-07-01' AND DATE '2000-06-30'",
)
def training_window(spark, sf):
    return X.training_window(Tables(spark, sf).orders, "o_orderdate", F.lit("2000-07-01").cast("date")).select("o_orderkey")


@query(
    "text_card",
    """SELECT doc_id, 'language: ' || COALESCE(lang, '') || ', source: ' || COALESCE(source, '') || ', quality: ' || COALESCE(quality, -1) || ', toxic?: '
              || CASE WHEN toxic IS NOT NULL THEN 'yes' ELSE 'no' END || ', text: ' || COALESCE(text, '') AS content FROM documents LEFT JOIN labels USING (doc_id)""",
)
def text_card(spark, sf):
    t = Tables(spark, sf)
    rows = t.documents.join(t.labels, "doc_id", "left")
    card = E.text_card(
        [
            ("language", E.text_or_empty("lang")),
            ("source", E.text_or_empty("source")),
            ("quality", E.number_or_minus_one("quality")),
            ("toxic?", F.when(F.col("toxic").isNotNull(), "yes").otherwise("no")),
            ("text", E.text_or_empty("text")),
        ]
    )
    return rows.select("doc_id", card.alias("content"))


@query(
    "text_embedding",
    r"""WITH t AS (SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS ws FROM documents WHERE text IS NOT NULL),
            s AS (SELECT doc_id, CAST('0x' || substr(md5(w), 1, 15) AS BIGINT) % 262144 AS slot, COUNT(*) AS tf FROM (SELECT doc_id, unnest(ws) AS w FROM t) GROUP BY 1, 2),
            f AS (SELECT slot, ln((SELECT COUNT(*) + 1 FROM t) / (COUNT(*) + 1)) AS idf FROM s GROUP BY 1),
            v AS (SELECT doc_id, COUNT(*) AS n_slots, CAST(SUM(slot) AS BIGINT) AS slot_sum, MAX(tf * idf) AS top, SQRT(SUM(tf * idf * tf * idf)) AS size FROM s JOIN f USING (slot) GROUP BY 1)
       SELECT t.doc_id, 262144 AS n_dims, COALESCE(n_slots, 0) AS n_slots, COALESCE(slot_sum, 0) AS slot_sum, CASE WHEN size > 0 THEN 1.0 ELSE 0.0 END::DOUBLE AS length,
              COALESCE(ROUND(CASE WHEN size > 0 THEN top / size ELSE 0 END, 6), 0) AS largest FROM t LEFT JOIN v USING (doc_id)""",
)
def text_embedding(spark, sf):
    docs = Tables(spark, sf).documents.select("doc_id", "text").where(F.col("text").isNotNull())
    rows = V.WordVectors(inputCol="text", outputCol="vector").fit(docs).transform(docs)
    values, slots = F.col("vector.values"), F.col("vector.indices")
    square = F.aggregate(F.transform(values, lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    total = F.aggregate(slots, F.lit(0).cast("long"), lambda a, b: a + b)
    return rows.select(
        "doc_id", F.lit(V.SLOTS).alias("n_dims"), F.size(slots).cast("long").alias("n_slots"), total.alias("slot_sum"), F.round(square, 6).alias("length"),
        F.round(F.coalesce(F.array_max(values), F.lit(0.0)), 6).alias("largest"),
    )


def _components(spark, sf, k):
    rows = Tables(spark, sf).embeddings.select("vec_id", "embedding")
    return rows, V.PrincipalComponents(inputCol="embedding", size=64, k=k).fit(rows)


_POSITIONS = "x AS (SELECT vec_id, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"


@query(
    "pca_fit",
    f"""WITH {_POSITIONS}, v AS (SELECT SUM(v) AS whole FROM (SELECT var_pop(x) AS v FROM x GROUP BY pos))
        SELECT component::INTEGER AS component, ROUND(whole, 9) AS whole_variance, TRUE AS unit_length, TRUE AS has_its_variance, TRUE AS uncorrelated, TRUE AS not_above_the_one_before
        FROM v, range(1, 33) t(component)""",
)
def pca_fit(spark, sf):
    """Unit directions whose coordinates have the stated variances and no covariance, largest first: the components."""
    rows, model = _components(spark, sf, 32)
    seen = model.transform(rows)
    names = model.columns()
    pairs = [F.covar_pop(a, b) for i, a in enumerate(names) for b in names[i:]]
    found = iter(seen.agg(*[p.alias(f"c{i}") for i, p in enumerate(pairs)]).first())
    cov = {(i, j): next(found) for i in range(len(names)) for j in range(i, len(names))}
    slack = 1e-9 * model.whole
    out = []
    for i, v in enumerate(model.variances):
        apart = all(abs(c) < slack for (a, b), c in cov.items() if a != b and i in (a, b))
        unit = abs(float(model.components[:, i] @ model.components[:, i]) - 1) < 1e-9
        out.append((i + 1, round(model.whole, 9), unit, abs(cov[i, i] - float(v)) < slack, apart, i == 0 or bool(v <= model.variances[i - 1])))
    return spark.createDataFrame(out, "component int, whole_variance double, unit_length boolean, has_its_variance boolean, uncorrelated boolean, not_above_the_one_before boolean")


@query(
    "pca_project",
    f"""WITH {_POSITIONS}, m AS (SELECT pos, AVG(x) AS m FROM x GROUP BY 1)
        SELECT vec_id, 64 AS n_components, ROUND(SUM((x - m) * (x - m)), 6) AS square FROM x JOIN m USING (pos) GROUP BY 1""",
)
def pca_project(spark, sf):
    """With all components the coordinates keep every vector's distance from the mean."""
    rows, model = _components(spark, sf, 64)
    seen = model.project(rows, "coordinates")
    square = F.aggregate(F.transform("coordinates", lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    return seen.select("vec_id", F.size("coordinates").alias("n_components"), F.round(square, 6).alias("square"))


@query(
    "embedding_join",
    f"""WITH {ctes('service')}, v AS (SELECT member_id, id, disease_case_id, label, list_sum(embedding::DOUBLE[]) AS s FROM embeddings JOIN service ON id = vec_id)
        SELECT s.id AS service_id, v.label, ROUND(v.s, 6) AS total FROM service s LEFT JOIN v ON v.member_id = s.member_id AND v.id = s.id AND v.disease_case_id = s.disease_case_id""",
)
def embedding_join(spark, sf):
    service = Standins(spark, sf)["service"].select("member_id", F.col("id").alias("service_id"), "disease_case_id")
    vectors = Tables(spark, sf).embeddings.select(F.col("vec_id").alias("service_id"), "embedding", "label")
    keyed = service.join(vectors, "service_id")
    joined = E.join_embeddings(service, keyed, ["member_id", "service_id", "disease_case_id"])
    total = F.aggregate(F.col("embedding").cast("array<double>"), F.lit(0.0), lambda a, b: a + b)
    return joined.select("service_id", "label", F.round(total, 6).alias("total"))


def _clustered(spark, sf):
    model, last = S.fit_staged(_payments(spark, sf), [S.FeatureEstimator(SPEC), K.CostClusters()])
    return model.stages[-1], last


@query(
    "kmeans_fit",
    f"""WITH {ctes('service_payment')} SELECT COUNT(*) AS n_rows, CAST(SUM(subtotal) AS DOUBLE) AS cost, TRUE AS centres_are_means, TRUE AS cost_never_rises, TRUE AS within_limits FROM service_payment""",
)
def kmeans_fit(spark, sf):
    """The centres are the means, here taken by a plain grouping, of the rows that the last round assigned to each."""
    model, last = _clustered(spark, sf)
    rows = model.assign(model.scaled(last, "place"), model.before, "centroid_id")
    cells = rows.select("centroid_id", F.posexplode("place").alias("pos", "x")).groupBy("centroid_id", "pos").agg(F.avg("x").alias("x"))
    centres = model.centre_table(spark).select("centroid_id", F.posexplode("centre").alias("pos", "c"))
    both = centres.join(cells, ["centroid_id", "pos"], "left")
    means = both.agg(F.bool_and(F.col("x").isNull() | (F.abs(F.col("x") - F.col("c")) < 1e-9)).alias("centres_are_means"))
    sums = model.transform(last).groupBy("centroid_id").agg(F.count("*").alias("n"), F.sum(to_money(F.col("subtotal"))).alias("cost"))
    sums = sums.agg(F.sum("n").alias("n_rows"), F.sum("cost").cast("double").alias("cost"), (F.max("centroid_id") <= 40).alias("few"))
    falls = all(b <= a * (1 + 1e-12) for a, b in zip(model.costs, model.costs[1:]))
    return sums.join(means).select("n_rows", "cost", "centres_are_means", F.lit(falls).alias("cost_never_rises"), (F.col("few") & F.lit(len(model.costs) <= 30)).alias("within_limits"))


def _is_nearest(spark, model, rows):
    """Rows with their cluster, and whether a plain comparison with all centres finds none nearer."""
    rows = model.scaled(model.transform(rows), "place")
    rows = K.nearest_centre(rows, "place", model.centre_table(spark), "centroid_id", "centre", "nearest_id", "nearest_gap")
    own = F.element_at(F.array(*[F.array(*[F.lit(float(x)) for x in c]) for c in model.centres]), F.col("centroid_id"))
    gap = F.aggregate(F.zip_with("place", own, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda s, x: s + x)
    return rows.withColumn("is_nearest", gap <= F.col("nearest_gap") + 1e-9)


@query(
    "kmeans_assign",
    f"WITH {ctes('service_payment')} SELECT member_id, service_id, CAST(transaction_date AS VARCHAR) AS transaction_date, CAST(subtotal AS DOUBLE) AS subtotal, TRUE AS is_nearest FROM service_payment",
)
def kmeans_assign(spark, sf):
    model, last = _clustered(spark, sf)
    return _is_nearest(spark, model, last).select("member_id", "service_id", "transaction_date", "subtotal", "is_nearest")


@query(
    "nearest_centroid",
    """WITH x AS (SELECT label, generate_subscripts(embedding, 1) AS pos, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
            m AS (SELECT label, pos, AVG(x) AS x FROM x GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY pos) AS c FROM m GROUP BY 1),
            d AS (SELECT vec_id, c.label, list_sum(list_transform(list_zip(embedding::DOUBLE[], c), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM embeddings CROSS JOIN c)
       SELECT vec_id, label AS centre, ROUND(d, 6) AS distance FROM d QUALIFY ROW_NUMBER() OVER (PARTITION BY vec_id ORDER BY d, label) = 1""",
)
def nearest_centroid(spark, sf):
    rows = Tables(spark, sf).embeddings.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("v"))
    means = rows.select("label", F.posexplode("v").alias("pos", "x")).groupBy("label", "pos").agg(F.avg("x").alias("x"))
    centres = means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "x"))), lambda s: s["x"]).alias("centre"))
    out = K.nearest_centre(rows, "v", centres, "label", "centre", "nearest", "distance")
    return out.select("vec_id", F.col("nearest").alias("centre"), F.round("distance", 6).alias("distance"))


@query(
    "cost_by_cluster",
    f"""WITH s AS (SELECT label, SUM({'CAST(o_totalprice AS DECIMAL(18,2))'}) AS total FROM embeddings JOIN orders ON o_custkey = vec_id GROUP BY 1)
        SELECT label, CAST(total AS DOUBLE) AS subtotal, format('{{:,}}', CAST({sql_ratio('CAST(total * 100 AS BIGINT)', '100', 0)} AS BIGINT)) AS subtotal_str FROM s""",
)
def cost_by_cluster(spark, sf):
    t = Tables(spark, sf)
    orders = t.orders.select(F.col("o_custkey").alias("vec_id"), to_money(F.col("o_totalprice")).alias("amount"))
    return K.cost_by_cluster(t.embeddings.select("vec_id", "label").join(orders, "vec_id"), "label", "amount")


def _profiled(spark, sf):
    t = Tables(spark, sf)
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
    return rows.withColumn("amount", to_money(F.col("o_totalprice"))).withColumn("year", F.year("o_orderdate"))


@query(
    "cluster_profile",
    """WITH r AS (SELECT *, CAST(EXTRACT(YEAR FROM o_orderdate) AS INTEGER) AS year FROM orders JOIN customer ON c_custkey = o_custkey)
       SELECT c_nationkey, COUNT(DISTINCT o_custkey) AS q_o_custkey, COUNT(DISTINCT o_orderkey) AS q_o_orderkey, COUNT(DISTINCT c_name) AS q_c_name, CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS subtotal,
         array_to_string(list_slice(list_sort(list(DISTINCT o_orderpriority)), 1, 10), '|') AS array_o_orderpriority, array_to_string(list_slice(list_sort(list(DISTINCT c_name)), 1, 10), '|') AS array_c_name,
         array_to_string(list_slice(list_sort(list(DISTINCT year)), 1, 10), '|') AS array_year FROM r GROUP BY 1""",
)
def cluster_profile(spark, sf):
    return K.cluster_profile(_profiled(spark, sf), "c_nationkey", ["o_orderpriority", "c_name", "year"], ["o_custkey", "o_orderkey", "c_name"], "amount")


@query(
    "cluster_purity",
    f"""WITH r AS (SELECT c_nationkey, o_orderpriority, c_name, CASE WHEN c_nationkey % 5 <> 0 THEN EXTRACT(YEAR FROM o_orderdate) END AS year FROM orders JOIN customer ON c_custkey = o_custkey),
            n AS (SELECT c_nationkey, NULLIF(COUNT(DISTINCT o_orderpriority), 0) AS a, NULLIF(COUNT(DISTINCT c_name), 0) AS b, NULLIF(COUNT(DISTINCT year), 0) AS c FROM r GROUP BY 1)
       SELECT {sql_ratio('SUM(a)', 'COUNT(a)', 1)} AS avg_len_array_o_orderpriority, {sql_ratio('SUM(b)', 'COUNT(b)', 1)} AS avg_len_array_c_name, {sql_ratio('SUM(c)', 'COUNT(c)', 1)} AS avg_len_array_year FROM n""",
)
def cluster_purity(spark, sf):
    rows = _profiled(spark, sf).withColumn("year", F.when(F.col("c_nationkey") % 5 != 0, F.col("year")))
    return K.cluster_purity(rows, "c_nationkey", ["o_orderpriority", "c_name", "year"])


def _payments(spark, sf):
    return Standins(spark, sf)["service_payment"].withColumn("subtotal", F.col("subtotal").cast("double"))


VARIANTS = {"v1": (SPEC, 1.0, 0.0), "v2": (SPEC_SMALL, 0.6, 0.4)}


def _regressed(spark, sf, variant="v1"):
    """(features, regression, rows with assembled features)"""
    spec, l1, l2 = VARIANTS[variant]
    model, last = S.fit_staged(_payments(spark, sf), [S.FeatureEstimator(spec), G.CostRegression(l1, l2)])
    return model.stages[0].model, model.stages[1], last


_BUCKETS = "b AS (SELECT list_distinct(quantile_cont(age_at_subscription, [0.125, 0.25, 0.375, 0.5, 0.625, 0.75, 0.875])) AS cuts FROM service_payment)"
_BUCKET_OF = "'bin_' || (1 + len(list_filter(cuts, lambda c: c <= age_at_subscription)))"
_PLACES = f"""{_BUCKETS}, c AS (SELECT DISTINCT unnest([('age_at_subscription_bucket', {_BUCKET_OF}), ('gender_x_vertical', gender || '_' || vertical), ('business_group_x_vertical', business_group || '_' || vertical)]) AS c
    FROM service_payment, b), places AS (SELECT c[1] AS processed_input, c[2] AS category FROM c WHERE c[2] IS NOT NULL
    UNION ALL SELECT unnest(['age_at_subscription_bucket', 'gender_x_vertical', 'business_group_x_vertical']), '(none)'
    UNION ALL SELECT unnest(['service_type_code', 'gender_code', 'business_group_size_code', 'ipc_schema_code', 'transaction_type_code', 'business_name_code', 'age_at_subscription_scaled', 'product_id_scaled']), NULL)"""


@query(
    "linreg_fit",
    f"""WITH {ctes('service_payment')}, {_PLACES}, n AS (SELECT COUNT(*) AS n, SUM(CASE WHEN processed_input IN ('age_at_subscription_bucket', 'service_type_code', 'gender_code', 'transaction_type_code') THEN 1 ELSE 0 END) AS few FROM places)
        SELECT model, n_places, COUNT(subtotal) AS n_rows, ROUND(AVG(CAST(subtotal AS DOUBLE)), 6) AS mean_prediction, 0::BIGINT AS n_not_optimal
        FROM service_payment, (SELECT 'v1' AS model, n::BIGINT AS n_places FROM n UNION ALL SELECT 'v2', few::BIGINT FROM n) GROUP BY 1, 2""",
)
def linreg_fit(spark, sf):
    """Both variants: no weight misses the condition of the penalised optimum, and the mean prediction is the mean."""
    out = []
    for name in VARIANTS:
        _, fitted, last = _regressed(spark, sf, name)
        seen = fitted.transform(last).agg(F.count("subtotal"), F.avg("predicted_subtotal")).first()
        missed = fitted.optimality(last).where(~F.col("holds")).count()
        out.append((name, len(fitted.weights), seen[0], round(seen[1], 6), missed))
    return spark.createDataFrame(out, "model string, n_places long, n_rows long, mean_prediction double, n_not_optimal long")


@query(
    "linreg_penalty",
    f"""WITH {ctes('service_payment')}, m AS (SELECT COUNT(*) AS n, stddev_pop(product_id) AS s, AVG(product_id) AS mx, AVG(CAST(subtotal AS DOUBLE)) AS my, COUNT(*) * covar_pop(product_id, CAST(subtotal AS DOUBLE)) / stddev_pop(product_id) AS c FROM service_payment),
            w AS (SELECT model, SIGN(c) * GREATEST(ABS(c) - l1, 0) / (n + l2) / s AS w, mx, my FROM m, (VALUES ('v1', 1.0, 0.0), ('v2', 0.6, 0.4), ('strong', 700.0, 5000.0), ('none left', 1000000.0, 0.0)) t(model, l1, l2))
        SELECT model, ROUND(w, 9) AS weight, ROUND(my - w * mx, 6) AS intercept FROM w""",
)
def linreg_penalty(spark, sf):
    """With one input the optimum has a closed form: the penalty means what it says, at every strength."""
    rows = VectorAssembler(inputCols=["product_id"], outputCol="features").transform(_payments(spark, sf).select("product_id", "subtotal"))
    out = []
    for name, l1, l2 in (("v1", 1.0, 0.0), ("v2", 0.6, 0.4), ("strong", 700.0, 5000.0), ("none left", 1e6, 0.0)):
        fitted = G.CostRegression(l1, l2).fit(rows)
        out.append((name, round(float(fitted.weights[0]), 9), round(float(fitted.regression.intercept), 6)))
    return spark.createDataFrame(out, "model string, weight double, intercept double")


@query(
    "linreg_predict",
    f"WITH {ctes('service_payment')} SELECT member_id, service_id, CAST(transaction_date AS VARCHAR) AS transaction_date, CAST(subtotal AS DOUBLE) AS subtotal, TRUE AS adds_up FROM service_payment",
)
def linreg_predict(spark, sf):
    """Every prediction is the baseline plus what the row's inputs add."""
    features, fitted, last = _regressed(spark, sf)
    rows = fitted.with_attributions(fitted.transform(last), features)
    total = F.aggregate("attributions", F.lit(fitted.baseline), lambda a, b: a + b)
    return rows.select("member_id", "service_id", "transaction_date", "subtotal", (F.abs(total - F.col("predicted_subtotal")) < 1e-9).alias("adds_up"))


@query("model_weights", f"WITH {ctes('service_payment')}, {_PLACES} SELECT processed_input, category, TRUE AS is_optimal FROM places")
def model_weights(spark, sf):
    """Every place of the vector, and whether its weight meets the condition of the penalised optimum."""
    features, fitted, last = _regressed(spark, sf)
    return features.feature_table(spark).join(fitted.optimality(last), "pos").select("processed_input", "category", F.col("holds").alias("is_optimal"))


@query(
    "weight_report_fitted",
    f"""WITH {ctes('service_payment')}, {_PLACES} SELECT processed_input, COUNT(category) AS n_categories, TRUE AS is_mean, TRUE AS top_is_largest FROM places GROUP BY 1""",
)
def weight_report_fitted(spark, sf):
    """The report on a fitted model's own weights, beside the weights it is made of."""
    features, fitted, _ = _regressed(spark, sf)
    weights = fitted.weight_table(features, spark)
    report = G.weight_report(G.category_weights(weights)).select("processed_input", F.col("weight").alias("_w"), "top_category")
    both = weights.join(report, "processed_input").groupBy("processed_input")
    largest = F.max(F.when(F.col("category") == F.col("top_category"), F.col("weight")))
    return both.agg(
        F.count("category").alias("n_categories"), (F.abs(F.avg("weight") - F.first("_w")) < 1e-9).alias("is_mean"),
        F.coalesce(largest == F.max("weight"), F.count("category") == 0).alias("top_is_largest"),
    )


EXPLAINED = X.FeatureSpec(crosses=(("service_type",),), passed=("age_at_subscription",))
#: Least squares on one number and one category: the slope is that within the categories, and each has its own level.
_EXPLAINED = f"""WITH {ctes('service_payment')}, p AS (SELECT member_id, service_id, transaction_date, service_type AS g, age_at_subscription AS x, CAST(subtotal AS DOUBLE) AS y FROM service_payment),
    c AS (SELECT g, COUNT(*) AS n, AVG(x) AS gx, AVG(y) AS gy, COUNT(*) * covar_pop(x, y) AS xy, COUNT(*) * var_pop(x) AS xx FROM p GROUP BY 1),
    s AS (SELECT SUM(xy) / SUM(xx) AS slope, SUM(n * gx) / SUM(n) AS mx, SUM(n * gy) / SUM(n) AS my FROM c),
    l AS (SELECT g, (gy - my) - slope * (gx - mx) AS of_g FROM c, s),
    a AS (SELECT p.*, my, slope * (x - mx) AS of_x, of_g FROM p JOIN l USING (g), s)"""


def _explained(spark, sf):
    model, last = S.fit_staged(_payments(spark, sf), [S.FeatureEstimator(EXPLAINED), G.CostRegression(0.0, 0.0)])
    return model.stages[0].model, model.stages[1], last


@query(
    "explain_fitted",
    f"""{_EXPLAINED} SELECT member_id, service_id, CAST(transaction_date AS VARCHAR) AS transaction_date, ROUND(my, 6) AS baseline, ROUND(my + of_x + of_g, 4) AS predicted,
        CASE WHEN ABS(of_x) > ABS(of_g) THEN 'age_at_subscription|service_type' ELSE 'service_type|age_at_subscription' END AS features,
        ROUND(CASE WHEN ABS(of_x) > ABS(of_g) THEN of_x ELSE of_g END, 4) AS largest, ROUND(CASE WHEN ABS(of_x) > ABS(of_g) THEN of_g ELSE of_x END, 4) AS second FROM a""",
)
def explain_fitted(spark, sf):
    features, fitted, last = _explained(spark, sf)
    top = F.col("top_feature_attributions")
    return fitted.explain(last, features).select(
        "member_id", "service_id", "transaction_date", F.round("baseline_prediction", 6).alias("baseline"), F.round("predicted_subtotal", 4).alias("predicted"),
        top["feature"].alias("features"), F.round(top["attribution"][0], 4).alias("largest"), F.round(top["attribution"][1], 4).alias("second"),
    )


@query(
    "global_attribution_fitted",
    f"{_EXPLAINED} SELECT 'age_at_subscription' AS feature, ROUND(AVG(ABS(of_x)), 6) AS attribution FROM a UNION ALL SELECT 'service_type', ROUND(AVG(ABS(of_g)), 6) FROM a",
)
def global_attribution_fitted(spark, sf):
    features, fitted, last = _explained(spark, sf)
    return fitted.global_attribution(last, features).withColumn("attribution", F.round("attribution", 6))


@query(
    "feature_pipeline",
    f"""WITH {ctes('service_payment')}, {_LABEL_CTES} SELECT member_id, service_id, CAST(transaction_date AS VARCHAR) AS transaction_date, {_LABELS}, TRUE AS predicts_alike FROM service_payment p {_LABEL_JOINS}""",
)
def feature_pipeline(spark, sf):
    """One artifact of features and regression, published, resolved, loaded, and put to all rows."""
    rows = _payments(spark, sf)
    model, last = S.fit_staged(rows, [S.FeatureEstimator(SPEC), G.CostRegression()])
    path = f"{work_folder(spark)}/model-{uuid.uuid4().hex}"
    publish(spark, path, lambda folder: model.write().save(folder))
    loaded = PipelineModel.load(published(spark, path))
    mine = model.stages[-1].transform(loaded.transform(rows).withColumnRenamed("predicted_subtotal", "_loaded"))
    alike = F.abs(F.col("predicted_subtotal") - F.col("_loaded")) < 1e-9
    return mine.select("member_id", "service_id", "transaction_date", *[f"{c}_code" for c in SPEC.labels], alike.alias("predicts_alike"))


_CARD_KEYS = ("member_id", "service_id")
CARD_SLOTS, CARD_COMPONENTS = 1 << 14, 8


def _cards(spark, sf):
    """One card for each service that has a medical record."""
    fields = ("caseevent_category", "caseevent_class", "doctor_specialization", "services_diagnosis_icd", "services_cpt", "services_specification")
    records = Standins(spark, sf)["medical_event"].groupBy(*_CARD_KEYS).agg(*[F.min(f).alias(f) for f in fields])
    return records.select(*_CARD_KEYS, E.text_card([(f.replace("_", " "), E.text_or_empty(f)) for f in fields]).alias("content"))


def _with_text(spark, sf, model):
    return T.fit_with_text(_payments(spark, sf), _cards(spark, sf), _CARD_KEYS, "content", SPEC, model, CARD_COMPONENTS, CARD_SLOTS)


_TEXT_ROWS = f"""WITH {ctes('service_payment', 'medical_event')}, k AS (SELECT DISTINCT member_id, service_id FROM medical_event)
    SELECT p.member_id, p.service_id, CAST(transaction_date AS VARCHAR) AS transaction_date, CAST(subtotal AS DOUBLE) AS subtotal, k.service_id IS NOT NULL AS has_vector"""
_TEXT_FROM = "FROM service_payment p LEFT JOIN k ON k.member_id = p.member_id AND k.service_id = p.service_id"


@query("linreg_embed_predict", f"{_TEXT_ROWS}, TRUE AS adds_up {_TEXT_FROM}")
def linreg_embed_predict(spark, sf):
    """Cards, vectors, components, features, regression: every row is predicted, those without a vector too."""
    models, last = _with_text(spark, sf, G.CostRegression())
    features, fitted = models.model.stages[0].model, models.model.stages[1]
    rows = fitted.with_attributions(fitted.transform(last), features)
    total = F.aggregate("attributions", F.lit(fitted.baseline), lambda a, b: a + b)
    alike = F.abs(total - F.col("predicted_subtotal")) < 1e-9
    return rows.select("member_id", "service_id", "transaction_date", "subtotal", F.col("principal_component_1").isNotNull().alias("has_vector"), alike.alias("adds_up"))


@query("kmeans_embed_assign", f"{_TEXT_ROWS}, TRUE AS is_nearest {_TEXT_FROM}")
def kmeans_embed_assign(spark, sf):
    models, last = _with_text(spark, sf, K.CostClusters())
    rows = _is_nearest(spark, models.model.stages[1], last)
    return rows.select("member_id", "service_id", "transaction_date", "subtotal", F.col("principal_component_1").isNotNull().alias("has_vector"), "is_nearest")


@query(
    "cluster_report_fitted",
    f"""WITH {ctes('service_payment')} SELECT CAST(SUM(subtotal) AS DOUBLE) AS cost, COUNT(*) AS n_rows, COUNT(DISTINCT service_type) AS n_types, TRUE AS types_are_known, TRUE AS clusters_agree, TRUE AS purity_is_mean FROM service_payment""",
)
def cluster_report_fitted(spark, sf):
    """Cost, profile and purity by the fitted clusters of the text variant, and what they must add up to."""
    models, last = _with_text(spark, sf, K.CostClusters())
    rows = materialise(models.model.stages[1].transform(last).withColumn("amount", to_money(F.col("subtotal"))), "clustered")
    costs = K.cost_by_cluster(rows, "centroid_id", "amount")
    profile = K.cluster_profile(rows, "centroid_id", ["service_type", "gender"], ["service_id"], "amount")
    purity = K.cluster_purity(rows, "centroid_id", ["service_type"]).first()[0]
    found = profile.select(F.explode("array_service_type").alias("t"))
    sums = costs.agg(F.sum("subtotal").cast("double").alias("cost"), F.count("*").alias("k"))
    sizes = profile.agg(F.avg(F.size("array_service_type")).alias("types"), F.bool_and(F.col("subtotal").isNotNull()).alias("known"), F.count("*").alias("k2"))
    one = sums.join(sizes).join(found.agg(F.count_distinct("t").alias("n_types"))).join(rows.agg(F.count("*").alias("n_rows")))
    return one.select("cost", "n_rows", "n_types", F.col("known").alias("types_are_known"), (F.col("k") == F.col("k2")).alias("clusters_agree"), (F.abs(F.col("types") - F.lit(purity)) < 0.051).alias("purity_is_mean"))


@query(
    "ols_simple",
    """SELECT ROUND(regr_slope(l_extendedprice, l_quantity), 3) AS slope, ROUND(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept, ROUND(regr_r2(l_extendedprice, l_quantity), 6) AS r2 FROM lineitem""",
)
def ols_simple(spark, sf):
    """The regression without a penalty and with one feature has a closed form to compare with."""
    rows = VectorAssembler(inputCols=["l_quantity"], outputCol="features").transform(Tables(spark, sf).lineitem.select("l_quantity", "l_extendedprice"))
    fitted = G.linear_regression(0.0, 0.0, label="l_extendedprice").fit(rows)
    found = [(round(float(fitted.coefficients[0]), 3), round(float(fitted.intercept), 2), round(float(fitted.summary.r2), 6))]
    return spark.createDataFrame(found, "slope double, intercept double, r2 double")


@query(
    "regression_metrics",
    """WITH r AS (SELECT l_quantity AS y, 20.0::DOUBLE + l_linenumber * 2 AS p FROM lineitem), e AS (SELECT y, p, y - p AS e, ln(1 + p) - ln(1 + y) AS g FROM r)
       SELECT ROUND(AVG(ABS(e)), 6) AS mean_absolute_error, ROUND(AVG(e * e), 6) AS mean_squared_error, ROUND(AVG(g * g), 6) AS mean_squared_log_error, median(ABS(e)) AS median_absolute_error,
              ROUND(1 - SUM(e * e) / (var_pop(y) * COUNT(*)), 6) AS r2_score, ROUND(1 - var_pop(e) / var_pop(y), 6) AS explained_variance FROM e""",
)
def regression_metrics(spark, sf):
    rows = Tables(spark, sf).lineitem.select(F.col("l_quantity").alias("y"), (20.0 + F.col("l_linenumber") * 2).alias("p"))
    found = G.regression_metrics(rows, "y", "p")
    return found.select(*[F.round(c, 6).alias(c) for c in found.columns])


@query(
    "weight_report",
    """WITH n AS (SELECT r_name, n_name, COUNT(*)::DOUBLE AS w FROM customer JOIN nation ON n_nationkey = c_nationkey JOIN region ON r_regionkey = n_regionkey GROUP BY 1, 2)
       SELECT r_name AS processed_input, CASE WHEN r_name = 'ASIA' THEN ROUND(SUM(w), 6) ELSE ROUND(AVG(w), 6) END AS weight,
              CASE WHEN r_name <> 'ASIA' THEN arg_max(n_name, (w, n_name)) END AS top_category FROM n GROUP BY 1, r_name""",
)
def weight_report(spark, sf):
    t = Tables(spark, sf)
    n = t.customer.groupBy("c_nationkey").agg(F.count("*").cast("double").alias("w")).join(t.nation, F.col("n_nationkey") == F.col("c_nationkey"))
    n = n.join(t.region, F.col("r_regionkey") == F.col("n_regionkey")).groupBy(F.col("r_name").alias("processed_input"))
    weights = n.agg(F.sum("w").alias("total"), F.collect_list(F.struct(F.col("n_name").alias("category"), F.col("w").alias("weight"))).alias("items"))
    whole = F.col("processed_input") == "ASIA"
    weights = weights.select("processed_input", F.when(whole, F.col("total")).alias("weight"), F.when(~whole, F.col("items")).alias("category_weights"))
    return G.weight_report(weights).withColumn("weight", F.round("weight", 6))


# Weights of an example model over lineitem columns.
WEIGHTS = {"l_quantity": 2.0, "l_discount": -310.0, "l_tax": 170.0, "l_linenumber": 5.0, "l_extendedprice": 0.001, "l_suppkey": 0.03}
_MEANS = ", ".join(f"AVG({c}) AS m_{c}" for c in WEIGHTS)
_ATTRIBUTED = ", ".join(f"struct_pack(feature := '{c}', a := {w} * ({c} - m_{c}))" for c, w in WEIGHTS.items())


@query(
    "explain_topk",
    f"""WITH m AS (SELECT {_MEANS} FROM lineitem), r AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, [{_ATTRIBUTED}] AS x FROM lineitem, m)
        SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
          array_to_string(list_transform(list_slice(list_sort(list_transform(x, lambda s: struct_pack(o := -ABS(s.a), f := s.feature))), 1, 5), lambda s: s.f), '|') AS features,
          ROUND(list_sum(list_transform(list_slice(list_sort(list_transform(x, lambda s: -ABS(s.a))), 1, 5), lambda v: -v)), 6) AS weight FROM r""",
)
def explain_topk(spark, sf):
    li = Tables(spark, sf).lineitem
    found = G.explain(li, WEIGHTS, "l_extendedprice", F.col("l_quantity") * 1500.0)
    top = F.col("top_feature_attributions")
    total = sum((F.abs(top["attribution"][i]) for i in range(5)), F.lit(0.0))
    return found.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", top["feature"].alias("features"), F.round(total, 6).alias("weight")
    )


@query(
    "global_attribution",
    f"""WITH m AS (SELECT {_MEANS} FROM lineitem), r AS (SELECT unnest([{_ATTRIBUTED}]) AS x FROM lineitem, m)
        SELECT x.feature AS feature, ROUND(AVG(ABS(x.a)), 6) AS attribution FROM r GROUP BY 1""",
)
def global_attribution(spark, sf):
    return G.global_attribution(Tables(spark, sf).lineitem, WEIGHTS).withColumn("attribution", F.round("attribution", 6))


