import numpy as np
import pytest

from quayside.operators import isolation
from quayside.operators.isolation import IsolationForest, Split, learned_outliers, mean_path
from quayside.plans.catalogue import Ctx
from quayside.plans.catalogue_assure import planted_events

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def cloud(spark):
    r = np.random.default_rng(1)
    rows = [(i, float(a), float(b), "x") for i, (a, b) in enumerate(r.normal(0, 1, (3000, 2)))] + [(10_000 + i, 9.0 + i, -9.0, "x") for i in range(15)]
    return spark.createDataFrame(rows, "id long, a double, b double, score string")


def test_spark_scores_equal_the_trees_walked_by_hand(spark, cloud):
    f = IsolationForest.fit(cloud, ["a", "b"], trees=20, id_columns=["id"])
    for r in f.score(cloud, "s", "flag").limit(50).collect():
        assert r.s == pytest.approx(f.score_row(np.array([r.a, r.b])), rel=1e-12)
        assert r.flag == (r.s >= f.threshold)


def test_rows_apart_are_found_and_the_forest_does_not_depend_on_partitions(spark, cloud):
    out = learned_outliers(cloud, ["a", "b"], id_columns=["id"]).withColumnRenamed("score", "s").where("is_anomaly").select("id").collect()
    found = {r.id for r in out}
    assert set(range(10_000, 10_015)) <= found and len(found) < 15 + 40
    one, two = (IsolationForest.fit(df, ["a", "b"], trees=10, id_columns=["id"]) for df in (cloud, cloud.repartition(7)))
    assert one.trees == two.trees and one.threshold == two.threshold


def test_planted_events_that_the_fit_has_not_seen(spark):
    rows = planted_events(Ctx(spark, SF))
    from quayside.plans.catalogue_assure import q_anomaly_learned

    held = [r for r in q_anomaly_learned(spark, SF).collect() if r.held_out]
    planted = [r for r in held if r.planted]
    clean = [r for r in held if not r.planted]
    assert planted and sum(r.is_anomaly for r in planted) >= 0.9 * len(planted)
    assert sum(r.is_anomaly for r in clean) <= 0.02 * len(clean)
    assert rows.count() == len(q_anomaly_learned(spark, SF).collect())


def test_the_sample_is_bounded(spark, cloud, monkeypatch):
    seen = []
    real = isolation.grow
    monkeypatch.setattr(isolation, "grow", lambda x, depth, *a: (seen.append(len(x)) if depth == 0 else None, real(x, depth, *a))[1])
    IsolationForest.fit(cloud, ["a"], trees=5, sample=32)
    assert seen == [32] * 5


def test_nulls_nan_infinities_constants_and_empty_frames(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(float(i % 10),) for i in range(500)] + [(None,), (nan,), (inf,), (-inf,)]
    df = spark.createDataFrame(rows, "a double")
    f = IsolationForest.fit(df, ["a"])
    got = {str(r.a): r.score for r in f.score(df).collect()}
    assert got["None"] == got["nan"] == got["-inf"] and all(0 < s < 1 for s in got.values())
    same = spark.createDataFrame([(1.0,)] * 50, "a double")
    assert not learned_outliers(same, ["a"]).where("is_anomaly").count()
    assert learned_outliers(same.limit(0), ["a"]).count() == 0
    assert learned_outliers(same.limit(1), ["a"]).first().is_anomaly is False


def test_a_split_by_hand():
    f = IsolationForest(["a"], [Split(0, 5.0, 1.0, Split(0, 8.0, 2.0, 3.0))], 4, 0.5)
    for x, path in ((1.0, 1.0), (5.0, 2.0), (9.0, 3.0), (float("nan"), 1.0)):
        assert f.score_row(np.array([x])) == pytest.approx(2 ** (-path / mean_path(4)))
