"""Fitted stages: optimum, components, clusters and text vectors against plain numpy, and one artifact for all."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from lossledger.models import cluster as K
from lossledger.models import components as V
from lossledger.models import features as X
from lossledger.models import graph as T
from lossledger.models import regress as G
from lossledger.models import stages as S
from lossledger.models.linalg import Rows, sum_matrix
from lossledger.sources.tables import publish, published

RNG = np.random.default_rng(8)


def vectors(spark, matrix, column="v", extra=None):
    rows = [(i, r.tolist(), float(extra[i]) if extra is not None else 0.0) for i, r in enumerate(matrix)]
    return spark.createDataFrame(rows, f"id int, {column} array<double>, subtotal double").repartition(4)


@pytest.mark.parametrize("l1, l2", [(0.0, 0.0), (1.0, 0.0), (30.0, 0.0), (30.0, 200.0), (1e6, 0.0)])
def test_regression_is_at_the_optimum(spark, l1, l2):
    x = RNG.normal(size=(300, 6)) * [1, 5, 0.1, 1, 1, 0] + 2
    x[:, 4] = x[:, 0] + 0.03 * x[:, 3]  # much alike
    y = x @ [2, -1, 3, 0, 0, 0] + RNG.normal(size=300)
    rows = vectors(spark, x, extra=y).withColumn("features", array_to_vector("v"))
    model = G.CostRegression(l1, l2).fit(rows)
    w, s = model.weights, x.std(axis=0)
    gap = x @ w + model.regression.intercept - y
    assert abs(gap.sum()) < 1e-6 and w[5] == 0
    for j in range(5):
        pull = gap @ (x[:, j] - x[:, j].mean()) / s[j] + l2 * w[j] * s[j]
        assert abs(pull + l1 * np.sign(w[j])) < 1e-5 if w[j] else abs(pull) <= l1 + 1e-5
    assert model.optimality(rows).where("holds").count() == 6
    wrong = model.copy()
    wrong.regression = G.CostRegression(l1 + 5000.0, 0.0).fit(rows).regression
    if l1 < 1e6:
        assert wrong.optimality(rows).where("not holds").count() > 0


def test_spark_solver_takes_the_same_penalty(spark, monkeypatch):
    """Beyond MOMENTS places Spark's solver is used, with amounts mapped to its scale."""
    x = RNG.normal(size=(400, 4)) * [1, 5, 0.1, 2]
    y = 3 * x[:, 0] - x[:, 1] + 4 * x[:, 2] + RNG.normal(size=400)
    rows = vectors(spark, x, extra=y).withColumn("features", array_to_vector("v"))
    ours = G.CostRegression(40.0, 300.0).fit(rows).weights
    monkeypatch.setattr(G, "MOMENTS", 0)
    theirs = G.CostRegression(40.0, 300.0, iterations=200, tolerance=1e-10).fit(rows).weights
    assert np.allclose(ours, theirs, rtol=1e-4, atol=1e-4)


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.range(500).select(
        "id",
        F.when(F.col("id") % 7 != 0, F.concat(F.lit("c"), (F.col("id") % 5).cast("string"))).alias("colour"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 50).cast("double")).alias("age"),
        (F.col("id") % 50 * 3.0 + F.col("id") % 5 * 10.0 + 1).alias("subtotal"),
    )
    return df.cache()


SPEC = X.FeatureSpec(labels=("colour",), buckets=(("age", 4),), scaled=("age",), crosses=(("colour",),))


def test_attributions_fold_slots_and_add_up(spark, rows):
    model, last = S.fit_staged(rows, [S.FeatureEstimator(SPEC), G.CostRegression(0.5, 0.5)])
    features, fitted = model.stages[0].model, model.stages[1]
    found = fitted.explain(last, features, k=3).collect()
    names, owner = features.inputs()
    for r in found[:60]:
        x = r.features.toArray()
        want = np.bincount(owner, fitted.weights * (x - fitted.means), len(names))
        assert np.allclose(r.attributions, want, atol=1e-9) and math.isclose(sum(want) + r.baseline_prediction, r.predicted_subtotal, abs_tol=1e-9)
        assert [t.feature for t in r.top_feature_attributions] == [n for _, n in sorted(zip(-abs(want), names))][:3]
    gaps = [abs(r.predicted_subtotal - r.subtotal) for r in found]
    assert gaps == sorted(gaps)
    top = fitted.global_attribution(last, features).collect()
    assert {t.feature for t in top} == set(names) and [t.attribution for t in top] == sorted((t.attribution for t in top), reverse=True)


def test_one_artifact_saves_loads_and_predicts(spark, rows, tmp_path):
    path = str(tmp_path / "model")
    for l1 in (1.0, 5.0):  # the second replaces the first
        model, _ = S.fit_staged(rows, [S.FeatureEstimator(SPEC, "f"), G.CostRegression(l1, featuresCol="f")])
        publish(spark, path, lambda folder, model=model: model.write().save(folder))
    other = spark.newSession()
    loaded = PipelineModel.load(published(other, path))
    assert loaded.stages[1].getOrDefault("l1") == 5.0 and loaded.stages[0].model.spec == SPEC
    a = {r.id: r.predicted_subtotal for r in model.transform(rows).collect()}
    assert a == {r.id: r.predicted_subtotal for r in loaded.transform(rows).collect()}
    assert loaded.stages[1].baseline == pytest.approx(model.stages[1].baseline)


def test_large_vocabularies_are_joined(spark, rows, monkeypatch):
    few = X.FeatureModel.fit(rows, SPEC)
    want = sorted((r.id, r.colour_code, str(r.features)) for r in few.assemble(rows).collect())
    monkeypatch.setattr(X, "IN_PLAN", 2)
    many = X.FeatureModel.fit(rows, SPEC)
    assert many.codes.small == {} and few.codes.small["colour"][0] == ("c0", 1)
    assert sorted((r.id, r.colour_code, str(r.features)) for r in many.assemble(rows).collect()) == want


def test_components_of_wide_vectors(spark):
    x = RNG.normal(size=(900, 256)) * (0.9 ** np.arange(256)) + 3
    df = vectors(spark, x).cache()
    model = V.PrincipalComponents(inputCol="v", size=256, k=12).fit(df)
    exact = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert np.abs(model.variances - exact[:12]).max() < 1e-6 * exact.sum() and model.whole == pytest.approx(exact.sum())
    assert np.abs(model.components.T @ model.components - np.eye(12)).max() < 1e-10
    seen = np.array([r.p for r in model.project(df, "p").orderBy("id").collect()])
    assert np.allclose(seen, (x - x.mean(axis=0)) @ model.components, atol=1e-9)


def test_components_never_square_the_width(spark, monkeypatch):
    shapes = []

    def watched(rows, shape, add):
        shapes.append(shape)
        return sum_matrix(rows, shape, add)

    monkeypatch.setattr(V, "sum_matrix", watched)
    data = [(i, {"indices": [i % 40, 5000 + i % 300, 1 << 13], "values": [1.0, 2.0, float(i % 3)]}) for i in range(600)] + [(600, None)]
    df = spark.createDataFrame(data, "id int, words struct<indices:array<int>,values:array<double>>")
    model = V.PrincipalComponents(size=1 << 14, k=4).fit(df)
    assert len(model.variances) == 4 and max(b for _, b in shapes) <= 20 and max(a for a, _ in shapes) <= (1 << 14) + 1
    out = model.transform(df).collect()
    assert sum(r.principal_component_1 is None for r in out) == 1 and len(out) == 601


def test_components_of_few_places_take_one_pass(spark, monkeypatch):
    shapes = []

    def watched(rows, shape, add):
        shapes.append(shape)
        return sum_matrix(rows, shape, add)

    monkeypatch.setattr(V, "sum_matrix", watched)
    x = RNG.normal(size=(300, 60)) + 3  # variances close to each other, which passes separate slowly
    df = spark.createDataFrame([(i, {"indices": [1000 + 7 * j for j in range(60)], "values": v.tolist()}) for i, v in enumerate(x)], "id int, words struct<indices:array<int>,values:array<double>>")
    model = V.PrincipalComponents(size=1 << 14, k=4).fit(df)
    exact = np.sort(np.linalg.eigvalsh(np.cov(x.T, bias=True)))[::-1]
    assert shapes == [((1 << 14) + 1, 2), (60, 60)]
    assert np.allclose(model.variances, exact[:4], rtol=1e-10) and model.whole == pytest.approx(exact.sum())


def test_products_of_filled_in_rows():
    at, places, values = np.array([0, 2, 2, 5, 6]), np.array([0, 3, 1, 2, 3, 3]), np.array([1.0, -2.0, 3.0, 0.5, 4.0, 7.0])
    rows, matrix = Rows(at, places, values), RNG.normal(size=(4, 3))
    whole = np.zeros((4, 4))
    whole[rows.row, places] = values
    assert (rows.dense(4) == whole).all() and [len(b) for b in rows.blocks(1 << 15)] == [2, 2]
    assert np.allclose(rows.times(matrix), whole @ matrix)
    wide = np.r_[matrix, np.full((96, 3), 9.0)]  # few of these places have a value
    assert np.allclose(rows.times(wide), whole @ matrix)


def test_word_vectors_by_hand(spark, tmp_path):
    df = spark.createDataFrame([(1, "Knee pain, knee"), (2, "pain"), (3, ""), (4, None)], "id int, content string")
    model = V.WordVectors(slots=1 << 18).fit(df)
    path = str(tmp_path / "w")
    model.write().save(path)
    for m in (model, V.WordVectorModel.load(path)):
        got = {r.id: r.words for r in m.transform(df).collect()}
        slot = {w: int(hashlib.md5(w.encode()).hexdigest()[:15], 16) % (1 << 18) for w in ("knee", "pain")}
        values = {slot["knee"]: 2 * math.log(4 / 2), slot["pain"]: math.log(4 / 3)}
        size = math.hypot(*values.values())
        assert dict(zip(got[1].indices, got[1]["values"])) == pytest.approx({s: v / size for s, v in values.items()})
        assert got[2]["values"] == [1.0] and got[3].indices == [] and got[4] is None


def test_clusters_are_means_and_go_on_after_a_loss(spark, tmp_path):
    x = np.concatenate([RNG.normal(size=(80, 3)) + c for c in ([0, 0, 0], [9, 0, 0], [0, 9, 0], [0, 0, 9])])
    df = vectors(spark, x).withColumn("features", array_to_vector("v")).cache()
    whole = K.CostClusters(k=4, progress=0.0, iterations=9, folder=str(tmp_path / "a")).fit(df)
    assert all(b <= a for a, b in zip(whole.costs, whole.costs[1:]))
    seen = {r.id: r.centroid_id for r in whole.transform(df).collect()}
    scaled = x * whole.scale
    for i, c in enumerate(whole.centres):
        members = [j for j in seen if seen[j] == i + 1]
        assert np.allclose(scaled[members].mean(axis=0), c)
    first = K.CostClusters(k=4, progress=0.0, iterations=1, folder=str(tmp_path / "b")).fit(df)
    assert len(first.costs) == 1
    again = K.CostClusters(k=4, progress=0.0, iterations=9, folder=str(tmp_path / "b")).fit(df)  # finds round 1
    assert again.costs[: len(first.costs)] == first.costs and np.allclose(again.centres, whole.centres) and again.costs == pytest.approx(whole.costs)
    path = str(tmp_path / "m")
    whole.write().save(path)
    assert {r.id: r.centroid_id for r in K.ClusterModel.load(path).transform(df).collect()} == seen


def test_text_beside_other_features_keeps_rows_without_a_card(spark, rows):
    cards = rows.where("id % 3 = 0").select("id", F.concat_ws(" ", "colour", F.col("age").cast("int").cast("string"), F.lit("visit")).alias("content"))
    models, last = T.fit_with_text(rows, cards, ["id"], "content", X.FeatureSpec(labels=("colour",), passed=("age",)), G.CostRegression(), k=3, slots=1 << 12)
    assert last.count() == 500 and last.where("principal_component_1 IS NULL").count() == 500 - cards.count()
    a = {r.id: r.predicted_subtotal for r in models.model.stages[-1].transform(last).collect()}
    assert a == pytest.approx({r.id: r.predicted_subtotal for r in models.transform(rows, cards).collect()}) and None not in a.values()


def test_profile_keeps_types_and_null_clusters(spark):
    df = spark.createDataFrame([(1, 10, "b", 1), (1, 9, "a", 2), (1, 100, None, 2), (None, 3, "x", 5), (2, None, None, 7)], "c int, n int, t string, amount int")
    got = {r.c: r for r in K.cluster_profile(df, "c", ["n", "t"], ["amount"], "amount", cap=2).collect()}
    assert got[1].array_n == [9, 10] and got[1].array_t == ["a", "b"] and got[1].q_amount == 2 and got[2].array_n is None and got[None].array_t == ["x"]
