"""Models: fitted state, saving and loading, encoders, and reports."""

import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from lossledger.models import cluster as K
from lossledger.models import embed as E
from lossledger.models import features as X
from lossledger.models import regress as G


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(600).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("colour"),
        (F.col("id") % 50).cast("double").alias("age"),
        F.concat(F.lit("t"), (F.col("id") % 3).cast("string")).alias("town"),
        (F.col("id") % 50 * 3.0 + F.col("id") % 5 * 10.0 + 1).alias("subtotal"),
    )
    return df.cache()


SPEC = X.FeatureSpec(labels=("colour",), buckets=(("age", 4),), scaled=("age",), crosses=(("colour", "town"),))


def test_feature_model_round_trip(spark, rows, tmp_path):
    model = X.FeatureModel.fit(rows, SPEC)
    first = model.transform(rows)
    codes = {r.colour: r.colour_code for r in first.select("colour", "colour_code").distinct().collect()}
    assert codes == {None: 0, "c0": 1, "c1": 2, "c2": 3, "c3": 4, "c4": 5}
    assert model.cuts["age"] == [12.0, 24.5, 37.0] and model.scale["age"] == (24.5, 25.0)
    assert {r.age_bucket for r in first.collect()} == {"bin_1", "bin_2", "bin_3", "bin_4"}
    model.save(str(tmp_path / "m"))
    again = X.FeatureModel.load(spark, str(tmp_path / "m"))
    assert again.spec == SPEC
    unseen = spark.createDataFrame([(1, "new", 3.0, "t0", 1.0)], "id long, colour string, age double, town string, subtotal double")
    row = again.transform(unseen).first()
    assert (row.colour_code, row.age_bucket, row.colour_x_town) == (0, "bin_1", "new_t0")
    assert again.assemble(rows).count() == 600


def test_cluster_model_round_trip(rows, tmp_path):
    assembled = X.FeatureModel.fit(rows, SPEC).assemble(rows).cache()
    model = K.cluster_stages(k=6, iterations=10).fit(assembled)
    model.write().overwrite().save(str(tmp_path / "k"))
    a = K.assign_cluster(assembled, model)
    b = K.assign_cluster(assembled, PipelineModel.load(str(tmp_path / "k")))
    assert a.select("centroid_id").distinct().count() == 6 and a.agg(F.min("centroid_id"), F.max("centroid_id")).first() == (1, 6)
    assert a.join(b.select("id", F.col("centroid_id").alias("o")), "id").where("o <> centroid_id").count() == 0


def test_regression_recovers_a_linear_cost(spark, rows):
    model = X.FeatureModel.fit(rows, X.FeatureSpec(labels=("colour",), passed=("age",)))
    assembled = model.assemble(rows).cache()
    fitted = G.linear_regression(0.1, 0.0).fit(assembled)
    metrics = G.regression_metrics(fitted.transform(assembled), "subtotal", "predicted_subtotal").first()
    assert metrics.r2_score > 0.9 and metrics.mean_absolute_error < 15
    weights = {r.processed_input: r.weight for r in G.model_weights(fitted, model.feature_table(spark), assembled).collect()}
    assert set(weights) == {"colour_code", "age"} and weights["age"] > weights["colour_code"] > 0


def test_each_category_has_its_slot_and_a_missing_number_is_the_mean(spark, rows):
    spec = X.FeatureSpec(crosses=(("colour", "town"),), passed=("age",))
    model = X.FeatureModel.fit(rows, spec)
    names = {r.pos: (r.processed_input, r.category) for r in model.feature_table(spark).collect()}
    assert len(names) == 1 + 1 + 15 and names[0] == ("age", None) and names[1] == ("colour_x_town", "(none)")
    odd = spark.createDataFrame([(1, "c1", None, "t0", 1.0), (2, "new", 3.0, "t0", 1.0), (3, None, 3.0, "t0", 1.0)], "id long, colour string, age double, town string, subtotal double")
    got = {r.id: r.v for r in model.assemble(odd).select("id", vector_to_array("features").alias("v")).collect()}
    assert got[1][0] == pytest.approx(24.5) and [names[i] for i, x in enumerate(got[1]) if x and i] == [("colour_x_town", "c1_t0")]
    assert [i for i, x in enumerate(got[2]) if x] == [0, 1] and got[2] == got[3]


def test_weights_by_category_reach_the_report(spark, rows):
    model = X.FeatureModel.fit(rows, X.FeatureSpec(crosses=(("colour",),), passed=("age",)))
    assembled = model.assemble(rows).cache()
    fitted = G.linear_regression(0.01, 0.0).fit(assembled)
    report = {r.processed_input: r for r in G.weight_report(G.category_weights(G.model_weights(fitted, model.feature_table(spark), assembled))).collect()}
    assert set(report) == {"age", "colour"} and report["colour"].top_category == "c4" and report["age"].top_category is None


def test_pca_is_centred(spark):
    df = spark.createDataFrame([(i, [100.0 + i, 50.0 - i, 7.0]) for i in range(20)], "id int, v array<double>")
    vectors = E.as_vectors(df, "v")
    reduced = E.reduction_stages("vector", "reduced", 2).fit(vectors).transform(vectors)
    mean = reduced.select(vector_to_array("reduced").alias("r")).agg(F.avg(F.col("r")[0]), F.avg(F.col("r")[1])).first()
    assert abs(mean[0]) < 1e-9 and abs(mean[1]) < 1e-9
    assert E.component_columns(reduced, "reduced", 2).columns[-1] == "principal_component_2"


def test_plugged_encoder(spark):
    df = spark.createDataFrame([(1, "ab"), (2, "abcd")], "id int, text string")
    out = E.embed_with(df, ["id"], "text", "v", lambda texts: [[float(len(t)), 1.0] for t in texts])
    assert {r.id: r.v for r in out.collect()} == {1: [2.0, 1.0], 2: [4.0, 1.0]}


def test_text_vectors_have_unit_length_and_ignore_case(spark):
    df = spark.createDataFrame([(1, "Knee pain, knee"), (2, "knee KNEE pain"), (3, "other words here")], "id int, text string")
    rows = {r.id: r.v for r in E.embed(df, E.embedding_stages("text", "v", 64).fit(df), "v").collect()}
    assert rows[1] == rows[2] and abs(sum(x * x for x in rows[3]) - 1) < 1e-9


def test_purity_skips_clusters_without_values(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (3, "a")], "c int, f string")
    assert K.cluster_purity(df, "c", ["f"]).first()[0] == 1.5


def test_service_card_defaults(spark):
    cols = "service_type services_specification caseevent_category caseevent_class provider_category_name provider_network cpt diagnosis doctorfriend_name doctor_descriptor member_occupation member_gender".split()
    schema = ", ".join(f"{c} string" for c in cols) + ", member_weight_kg int, member_height_cm int, member_age_at_subscription int"
    df = spark.createDataFrame([tuple([None] * 12 + [None, 170, None])], schema)
    text = df.select(E.service_card().alias("t")).first().t
    assert "is a external doctor?: no" in text and "patient weight kg: -1" in text and "height cm: 170" in text and "None" not in text


def test_nearest_centre_compares_in_arrays(spark):
    """Ties, lengths, NULLs and NaN as a plain comparison has them, but no interpreted function for every row and centre."""
    nan = float("nan")
    centres = spark.createDataFrame([(2, [1.0, 0.0]), (1, [-1.0, 0.0]), (3, [0.0, 5.0])], "id int, c array<double>")
    data = [(1, [0.0, 0.0]), (2, [0.9, 0.1]), (3, [0.0, 4.0]), (4, None), (5, [1.0]), (6, [None, 1.0]), (7, [nan, 0.0]), (8, [])]
    df = spark.createDataFrame(data, "k int, v array<double>")
    out = K.nearest_centre(df, "v", centres, "id", "c", "best", "d")
    assert "lambda" not in out._jdf.queryExecution().executedPlan().toString()
    got = {r.k: (r.best, r.d) for r in out.collect()}
    assert got[1] == (1, 1.0) and got[2][0] == 2 and got[3] == (3, 1.0)
    assert [got[k] for k in (4, 5, 6, 8)] == [(1, None)] * 4
    assert got[7][0] == 1 and got[7][1] != got[7][1]
    mixed = centres.union(spark.createDataFrame([(4, [1.0])], "id int, c array<double>"))
    assert K.nearest_centre(df, "v", mixed, "id", "c", "best", "d").where("k = 1").first()[2:] == (4, None)
    none = K.nearest_centre(df, "v", centres.where("id > 9"), "id", "c", "best", "d").first()
    assert none.best is None and none.d is None
