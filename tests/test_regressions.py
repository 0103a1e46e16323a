"""Silent losses and size switches: each case once gave a wrong answer without an error."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelab.functions import dist
from scorelab.operators import bootstrap, calibrate, drift, profile, significance
from scorelab.session import checkpoint_dir
from scorelab.sources import io


def test_correlation_does_not_depend_on_the_number_of_columns(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 9))
    rows = [tuple(None if (c == 8 or c == 1 and i % 3 == 0) and i % 2 else float(v) for c, v in enumerate(r)) for i, r in enumerate(x)]
    df = spark.createDataFrame(rows, ", ".join(f"x{i} double" for i in range(9))).repartition(3)
    pick = lambda d: {(r["a"], r["b"]): r["r"] for r in d.collect()}
    wide, narrow = pick(profile.corr_matrix(df, [f"x{i}" for i in range(9)])), pick(profile.corr_matrix(df, [f"x{i}" for i in range(8)]))
    for k, v in narrow.items():
        assert wide[k] == pytest.approx(v, abs=1e-12)
    full = {k: profile.corr_matrix(df.withColumn("g", F.lit(1)), list(k), by=["g"]).first()["r"] for k in [("x0", "x1"), ("x0", "x8"), ("x1", "x8")]}
    for k, v in full.items():
        assert wide[k] == pytest.approx(v, abs=1e-9)


def test_vif_of_dependent_columns_is_infinite(spark):
    rng = np.random.default_rng(1)
    df = spark.createDataFrame([(float(a), float(b), float(a + b)) for a, b in rng.normal(size=(100, 2))], "a double, b double, c double")
    assert all(math.isinf(r["vif"]) for r in profile.vif(df, ["a", "b", "c"]).collect())
    assert all(r["vif"] < 2 for r in profile.vif(df, ["a", "b"]).collect())


def test_banner_reader_keeps_short_rows(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a banner, with, many, commas\na,b,c\n1,2,3\n4,5\n,6,7\n8,9,10\n")
    (tmp_path / "y.csv").write_text("banner\na,b,c\n11,,13\n")
    got = sorted((tuple(r) for r in io.read_with_banner(spark, str(tmp_path), "a int, b int, c int").collect()), key=str)
    assert got == sorted([(1, 2, 3), (4, 5, None), (None, 6, 7), (8, 9, 10), (11, None, 13)], key=str)


def test_headers_that_do_not_fit(spark):
    from scorelab import schema as S

    raw = [" limit bal" if c == "LIMIT_BAL" else "Pay.1" if c == "PAY_0" else "default payment" if c == "DEFAULT" else c.lower() for c in S.ALL_COLUMNS]
    df = spark.createDataFrame([tuple(range(len(raw) + 1))], ", ".join(f"`{c}` int" for c in [*raw, "extra"]))
    assert io.normalise_schema(df).columns == S.ALL_COLUMNS
    with pytest.raises(ValueError):
        io.normalise_schema(df.drop("sex"))
    with pytest.raises(ValueError):
        io.normalise_schema(df.withColumn("DEFAULT2", F.lit(1)))


def test_pairs_need_the_same_rows(spark):
    rows = [("a", k, 1, 0.5, 1) for k in "xyz"] + [("b", k, 1, 0.5, 1) for k in "xy"]
    df = spark.createDataFrame(rows, "run string, row_id string, y_true int, y_prob double, y_pred int")
    with pytest.raises(Exception, match="only one of runs"):
        significance.pair(df, "a", "b").collect()
    assert significance.pair(df.where("row_id != 'z'"), "a", "b").count() == 2


def test_drift_sees_lost_columns_and_rows(spark):
    a = spark.createDataFrame([(1, 2.0, 3.0), (2, 2.0, 3.0)], "k int, x double, y double")
    r = {x["column"]: x["n_mismatch"] for x in drift.table_diff(a, a.select("k", "x"), ["k"]).collect()}
    assert r["<left_column>y"] == 2 and r["x"] == 0
    r = {x["column"]: x["n_mismatch"] for x in drift.table_diff(a, a.select("k", "y", "x"), ["k"]).collect()}
    assert r["<column_order>"] == 1
    s = spark.createDataFrame([(1, 0.1), (2, 0.5), (3, 0.9)], "row_id int, y_prob double")
    assert drift.score_drift(s, s).first()["passed"]
    lost = drift.score_drift(s, s.where("row_id < 3")).first()
    assert not lost["passed"] and lost["n_unmatched"] == 1
    f = drift.fingerprint(a.withColumn("g", F.lit(1)), ["g"], "x", ["x"])
    other = drift.fingerprint(a.withColumn("g", F.lit(1)).withColumnRenamed("y", "z"), ["g"], "x", ["x"])
    assert [x["check"] for x in drift.check_fingerprint(f, other, ["g"], ["x"]).where("not passed").collect()] == ["columns"]


def test_nested_documents_are_compared_in_full(spark):
    a = spark.createDataFrame([(1, '{"a": {"b": {"c": 1, "d": [1, 2]}}, "e": {}}')], "doc_id int, doc string")
    got = {r["path"]: r["value"] for r in drift.flatten_json(a).collect()}
    assert got == {"a.b.c": "1", "a.b.d": "[1,2]", "e": "{}"}


def test_distributions_far_out_and_at_large_dof(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(dist.chi2_sf(F.lit(200802.0), F.lit(200000))) == pytest.approx(0.1025, abs=2e-4)
    assert one(dist.chi2_sf(F.lit(200000.0), F.lit(200000))) == pytest.approx(0.49958, abs=1e-5)
    assert one(dist.norm_sf(F.lit(8.2))) == pytest.approx(1.2019e-16, rel=1e-4)
    for z in (0.3, 2.0, 5.0):
        assert one(dist.norm_sf(F.lit(z))) == pytest.approx(math.erfc(z / math.sqrt(2)) / 2, rel=1e-12)
    for n in (3, 200_000, 200_001, 10**8):
        # Student t approaches the normal: t(n) tail ~ normal tail + z(z^2+1) phi(z) / (2 n)
        p = one(dist.t_sf2(F.lit(1.96), F.lit(n)))
        at = math.atan(1.96 / math.sqrt(3))
        want = 1 - 2 / math.pi * (at + math.sin(at) * math.cos(at)) if n == 3 else math.erfc(1.96 / math.sqrt(2)) + 1.96 * (1.96**2 + 1) * math.exp(-(1.96**2) / 2) / math.sqrt(2 * math.pi) / (2 * n)
        assert p == pytest.approx(want, abs=1e-10)


@pytest.mark.parametrize("sd, a, b", [(3, 0.5, 0), (3, 0.4, -1.5), (4, 0.2, 0), (4, 0.05, 0), (6, 0.3, 0)])
def test_platt_settles_at_the_minimum(spark, sd, a, b):
    rng = np.random.default_rng(2)
    z = rng.normal(0, sd, 1500)
    y = (rng.random(1500) < 1 / (1 + np.exp(-(a * z + b)))).astype(int)
    df = spark.createDataFrame([("g", float(1 / (1 + np.exp(-x))), int(t)) for x, t in zip(z, y)], "run string, y_prob double, y_true int")
    fit = calibrate.fit_platt(df)
    g = calibrate.fit_gradient(df, fit).first()
    assert abs(g["gradient_a"]) < 1e-8 and abs(g["gradient_b"]) < 1e-8
    assert calibrate.nll(calibrate.apply_platt(df, fit), ["run"]).first()["nll"] <= calibrate.nll(df, ["run"]).first()["nll"] + 1e-12


def test_a_fit_that_does_not_settle_raises(spark):
    df = spark.createDataFrame([("g", 0.2, 1), ("g", 0.7, 0), ("g", 0.9, 1)], "run string, y_prob double, y_true int")
    with pytest.raises(RuntimeError, match="did not settle"):
        calibrate.fit_platt(df, max_iter=1)


def _keys(names, seed):
    import hashlib

    words = [hashlib.md5(f"{seed}|{n}".encode()).hexdigest() for n in names]
    return np.array([int(w[:8], 16) for w in words]), np.array([int(w[8:16], 16) for w in words])


def _check_metrics(got, rows, w):
    y = np.array([r[1] for r in rows])
    for run in (0, 1):
        s = np.array([r[2][run] for r in rows])
        for rep in (-1, 0, 3, 5):
            k = w[:, rep]
            pos, neg = k * y, k * (1 - y)
            u = sum(pos[i] * (neg[s < s[i]].sum() + neg[s == s[i]].sum() / 2) for i in range(len(s)))
            ap = sum(pos[i] * pos[s >= s[i]].sum() / (pos + neg)[s >= s[i]].sum() for i in range(len(s)) if pos[i])
            bins = np.searchsorted([b * 0.1 for b in range(1, 10)], s, "right")
            r = got[rep, run]
            assert (r["pos"], r["neg"]) == (pos.sum(), neg.sum())
            assert r["auc_roc"] == pytest.approx(u / pos.sum() / neg.sum()) and r["auc_pr"] == pytest.approx(ap / pos.sum())
            assert r["brier"] == pytest.approx((k * (s - y) ** 2).sum() / k.sum())
            assert r["accuracy"] == pytest.approx((k * ((s >= 0.5) == y)).sum() / k.sum())
            tp = pos[s >= 0.5].sum()
            assert r["f1"] == pytest.approx(2 * tp / (tp + k[s >= 0.5].sum() + pos.sum() - tp))
            assert r["ece"] == pytest.approx(sum(abs((k * (y - s))[bins == b].sum()) for b in range(10)) / k.sum())


def _runs_table(spark, n, seed=3):
    rng = np.random.default_rng(seed)
    rows = [(str(i), int(rng.random() < 0.4), [float(np.round(rng.random(), 1)), float(rng.random())]) for i in range(n)]
    return rows, spark.createDataFrame(rows, "row_id string, y_true int, p array<double>").repartition(3)


def test_poisson_metrics_equal_plain_metrics(spark):
    """Against direct sums over repeated rows, with ties that span blocks and parts."""
    rows, df = _runs_table(spark, 500)
    got = {(r["rep"], r["run"]): r for r in bootstrap.replicate_metrics(df, 2, 6, 9).collect()}
    w = bootstrap.row_weights(*_keys([r[0] for r in rows], 9), 6, bootstrap.poisson_limits())
    assert len(got) == 14 and 0.8 < w[:, :6].mean() < 1.2
    _check_metrics(got, rows, w)


@pytest.mark.parametrize("n", [20, 300])
def test_multinomial_weights_sum_to_n(spark, n):
    """20 rows: all draws are placed one by one; 300: most come from Poisson weights."""
    rows, df = _runs_table(spark, n)
    wide = bootstrap.keyed(df, 4).cache()
    limits = bootstrap.poisson_limits(max(0.0, 1 - bootstrap.SLACK / n**0.5))
    assert bool(limits) == (n == 300)
    extra = {r["row_id"]: r["extra"] for r in bootstrap.missing_draws(wide, 6, 4, n, limits).collect()}
    w = bootstrap.row_weights(*_keys([r[0] for r in rows], 4), 6, limits)
    for i, r in enumerate(rows):
        for rep in extra.get(r[0], []):
            w[i, rep] += 1
    assert (w.sum(0) == n).all() and w.max() > 1
    got = {(r["rep"], r["run"]): r for r in bootstrap.replicate_metrics(df, 2, 6, 4, "multinomial").collect()}
    if n == 300:
        _check_metrics(got, rows, w)
    assert all(r["pos"] + r["neg"] == n for r in got.values())


def test_multinomial_draws_are_even():
    """Means and variances of many replicates: 1 and 1 - 1/N for a row, and N for the sum."""
    k1, k2 = _keys(map(str, range(400)), 0)
    w = bootstrap.row_weights(k1, k2, 4000, bootstrap.poisson_limits(0.7))[:, :4000]
    assert w.mean() == pytest.approx(0.7, abs=0.003) and w.var() == pytest.approx(0.7, abs=0.006)
    assert np.abs(np.corrcoef(w[:40])[np.triu_indices(40, 1)]).max() < 0.08
    assert np.abs(np.corrcoef(w.T[:40])[np.triu_indices(40, 1)]).max() < 0.25


@pytest.mark.parametrize("weights", ["poisson", "multinomial"])
def test_bootstrap_equals_its_sql(spark, sf, weights):
    import duckdb

    from scorelab.plans import cases_uncertainty as cases
    from scorelab.plans import sqltext
    from scorelab.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.execute(sqltext.with_fixtures(cases.boot_sql(["a", "b", "c"], 40, weights=weights), "scores"))
    names = [c[0] for c in want.description]
    want = {r[:4]: r[4:] for r in want.fetchall()}
    got = significance.bootstrap_all(significance.aligned(cases.test_scores(spark, sf), ["a", "b", "c"]), ["a", "b", "c"], 40, weights=weights)
    assert got.columns == names and len(want) == 18
    for r in got.collect():
        assert tuple(r)[4:] == pytest.approx(want[tuple(r)[:4]], abs=1e-9)


def test_rows_that_do_not_align_raise(spark):
    rows = [("a", "1", 1, 0.2, 0), ("b", "1", 1, 0.3, 0), ("a", "2", 0, 0.2, 0), ("b", "2", 0, 0.1, 0)]
    schema = "run string, row_id string, y_true int, y_prob double, y_pred int"
    assert significance.aligned(spark.createDataFrame(rows, schema), ["a", "b"]).count() == 2
    for bad, words in (([("a", "3", 1, 0.5, 1)], "have row 3"), ([("a", "1", 1, 0.2, 0)], "repeats row 1"), ([("a", "3", 1, 0.5, 1), ("b", "3", 0, 0.5, 1)], "disagree")):
        with pytest.raises(Exception, match=words):
            significance.aligned(spark.createDataFrame(rows + bad, schema), ["a", "b"]).collect()


def test_checkpoint_folder_of_a_cluster_must_be_set(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_dir(Session())


def test_forest_queries_run_the_whole_job(spark, sf, monkeypatch):
    from scorelab.operators import baseline
    from scorelab.plans import cases_baseline

    assert {r["feature"] for r in cases_baseline.q_f7(spark, sf).collect()} == set(cases_baseline.COLS)
    asked = {}

    def search(df, cols, **kw):
        asked.update(kw)
        rows = [(t, k, 0.7 + t / 100, 0.9, *(str(p[x]) for x in sorted(p))) for t, p in enumerate(baseline.sample_grid(30)) for k in range(2)]
        return spark.createDataFrame(rows, "trial int, fold int, auc_roc double, auc_train double, " + ", ".join(f"{x} string" for x in sorted(baseline.FOREST_GRID)))

    monkeypatch.setattr(baseline, "search_forest", search)
    got = cases_baseline.q_f2(spark, sf).collect()
    assert asked["n_iter"] == 60 and asked["folds"] == 5 and asked.get("grid") is None
    assert {r["diagnostic"] for r in got} == {"by_trees_depth", "by_depth", "by_class_weight", "top"}
    assert [r["gap"] for r in got if r["diagnostic"] == "top" and r["trial"] == 12] == [pytest.approx(0.08)]


def test_forest_search_scores_train_and_held_out_rows(spark):
    from scorelab.operators import baseline

    df = spark.createDataFrame([(i, float(i % 7), i % 3 % 2) for i in range(90)], "row_id long, x double, `DEFAULT` int")
    grid = {**baseline.FOREST_GRID, "numTrees": [3], "maxDepth": [2]}
    got = baseline.search_forest(df, ["x"], n_iter=1, folds=2, grid=grid).collect()
    assert len(got) == 2 and all(0 <= r["auc_train"] <= 1 and 0 <= r["auc_roc"] <= 1 for r in got)


def test_bootstraps_are_registered_with_all_replicates(spark, sf, monkeypatch):
    from scorelab.plans import cases_uncertainty as cases

    asked = []
    monkeypatch.setattr(significance, "paired_bootstrap", lambda p, a, b, reps, seed, **kw: asked.append((a, b, reps, kw["weights"])))
    monkeypatch.setattr(significance, "all_pairs", lambda s, runs, reps, seed: asked.append((*runs, reps)))
    cases.q_k4(spark, sf), cases.q_k4p(spark, sf), cases.q_k7(spark, sf)
    assert asked == [("a", "b", 2000, "multinomial"), ("a", "c", 2000, "poisson"), ("a", "b", "c", 2000)]
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0] * 1000), pa.array([float(i % 3) for i in range(1000)]), pa.array([0, 1] * 500), pa.array(range(1000)), pa.array(range(1000)), pa.array([None] * 1000, pa.list_(pa.int32()))], names=["run", "s", "y", "k1", "k2", "extra"])
    blocks = list(bootstrap._walk(iter([batch]), 2000))
    assert sum(len(r[3]) for r in blocks) == 1000 and max(len(r[3]) for r in blocks) * 2001 <= bootstrap.CELLS


def plain_isotonic(xs, ys, ws):
    """Pool adjacent violators over distinct scores in ascending order: fitted value of each."""
    blocks = []
    for y, w in zip(ys, ws):
        blocks.append([y * w, w, 1])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            sy, w2, n = blocks.pop()
            blocks[-1] = [blocks[-1][0] + sy, blocks[-1][1] + w2, blocks[-1][2] + n]
    return [sy / w for sy, w, n in blocks for _ in range(n)]


def test_isotonic_equals_plain_pooling_on_many_groups(spark):
    """1,000 groups in one job, from no slope to steep ones, with ties."""
    rng = np.random.default_rng(1)
    rows, want = [], {}
    for g in range(1000):
        n, slope = int(rng.integers(1, 40)), rng.random() * 3 - 1
        p = np.round(rng.random(n), int(rng.integers(1, 5)))
        y = (rng.random(n) < np.clip(0.5 + slope * (p - 0.5), 0, 1)).astype(int)
        rows += [(f"g{g}", str(i), float(a), int(b)) for i, (a, b) in enumerate(zip(p, y))]
        x = np.unique(np.clip(p, 1e-7, 1 - 1e-7))
        at = np.clip(p, 1e-7, 1 - 1e-7)
        fit = plain_isotonic(x, [y[at == v].mean() for v in x], [int((at == v).sum()) for v in x])
        q = np.linspace(0, 1, 7)
        want[f"g{g}"] = np.clip(np.interp(np.clip(q, 1e-7, 1 - 1e-7), x, fit), 1e-7, 1 - 1e-7)
    df = spark.createDataFrame(rows, "run string, row_id string, y_prob double, y_true int").repartition(7)
    test = spark.createDataFrame([(g, float(v)) for g in want for v in np.linspace(0, 1, 7)], "run string, y_prob double").withColumn("at", F.col("y_prob"))
    got = {}
    for r in calibrate.apply_isotonic(test, calibrate.fit_isotonic(df)).orderBy("run", "at").collect():
        got.setdefault(r["run"], []).append(r["y_prob"])
    assert set(got) == set(want)
    for g, v in want.items():
        assert got[g] == pytest.approx(v.tolist(), abs=1e-12)


def test_parameters_of_a_group_that_is_missing_raise(spark):
    """Rows whose group has no fitted parameters once vanished."""
    df = spark.createDataFrame([(g, 0.2, 1) for g in "abc"], "run string, y_prob double, y_true int")
    only = spark.createDataFrame([("a", 2.0, 1.0, 0.0)], "run string, temperature double, a double, b double")
    knots = calibrate.fit_isotonic(df.where("run = 'a'"))
    for make in (lambda d: calibrate.apply_temperature(d, only.select("run", "temperature")), lambda d: calibrate.apply_platt(d, only.select("run", "a", "b")), lambda d: calibrate.apply_isotonic(d, knots)):
        assert make(df.where("run = 'a'")).count() == 1
        with pytest.raises(Exception, match="no fitted parameters for group [bc]"):
            make(df).collect()
    from scorelab.operators import uncertainty

    samples = spark.createDataFrame([(1, 0.5), (2, 0.5)], "row_id long, p double")
    labels = spark.createDataFrame([(1, 1)], "row_id long, y_true int")
    with pytest.raises(Exception, match="no label for row 2"):
        uncertainty.uncertainty(samples, labels).collect()
    assert uncertainty.uncertainty(samples.where("row_id = 1"), labels).columns[-1] == "y_true"


def test_nulls_are_no_values_of_a_distribution(spark):
    df = spark.createDataFrame([(0, None), (0, 1.0), (0, 3.0), (1, 2.0), (1, None), (1, 2.0)], "`DEFAULT` int, x double")
    assert {(r["cls"], r["value"]): r["ecdf"] for r in profile.ecdf(df, "x").collect()} == {(0, 1.0): 0.5, (0, 3.0): 1.0, (1, 2.0): 1.0}
    got = {(r["cls"], r["g"]): r["density"] for r in profile.kde(df, "x", [0.0, 2.0]).collect()}
    bw = 2**0.5 * 2**-0.2
    want = sum(math.exp(-0.5 * ((2.0 - v) / bw) ** 2) for v in (1.0, 3.0)) / (2 * bw * math.sqrt(2 * math.pi))
    assert got[0, 2.0] == pytest.approx(want, abs=1e-6) and got[1, 0.0] is None and len(got) == 4


def test_kde_of_many_values_equals_the_direct_sum(spark):
    rng = np.random.default_rng(5)
    v = np.concatenate([rng.normal(0, 1, 60_000), rng.exponential(3, 40_000), [500.0]])
    df = spark.createDataFrame(spark.sparkContext.parallelize([(1, float(x)) for x in v], 4), "`DEFAULT` int, x double")
    grid = [-2.0, 0.0, 0.37, 5.0, 120.0, 500.0]
    bw = v.std(ddof=1) * len(v) ** -0.2
    want = {g: np.exp(-0.5 * ((g - v) / bw) ** 2).sum() / (len(v) * bw * math.sqrt(2 * math.pi)) for g in grid}
    got = {r["g"]: r["density"] for r in profile.kde(df, "x", grid).collect()}
    assert got == {g: pytest.approx(w, abs=1e-6) for g, w in want.items()}


def test_vif_is_infinite_only_where_columns_depend(spark):
    rng = np.random.default_rng(6)
    a, b, c, d = rng.normal(size=(4, 300))
    c = c + 0.5 * d
    df = spark.createDataFrame([(float(x), float(y), float(x - 2 * y), float(z), float(w), 4.0) for x, y, z, w in zip(a, b, c, d)], "a double, b double, s double, c double, d double, k double")
    got = {r["feature"]: r["vif"] for r in profile.vif(df, ["a", "b", "s", "c", "d", "k"]).collect()}
    assert all(math.isinf(got[x]) for x in "absk")
    plain = np.linalg.inv(np.corrcoef(np.stack([a, b, c, d])))
    assert got["c"] == pytest.approx(plain[2, 2], rel=1e-6) and got["d"] == pytest.approx(plain[3, 3], rel=1e-6)


def _auc(s, y):
    s, y = np.asarray(s), np.asarray(y)
    d = s[y == 1][:, None] - s[y == 0][None]
    return ((d > 1e-12) + 0.5 * (np.abs(d) <= 1e-12)).mean()


def test_permutation_drops_equal_the_exploded_form(spark, monkeypatch):
    """Against Spark ML's own scores of permuted rows, over several chunks and a feature that no tree reads."""
    import hashlib

    from scorelab.operators import baseline, forest

    monkeypatch.setattr(forest, "CHUNK", 64)
    rng = np.random.default_rng(8)
    cols = ["u", "v", "w", "flat"]
    rows = [(i, float(a), float(b), float(c), 1.0, int(a + 0.5 * b + rng.normal() > 0)) for i, (a, b, c) in enumerate(rng.normal(size=(300, 3)).round(1))]
    df = spark.createDataFrame(rows, "row_id long, u double, v double, w double, flat double, `DEFAULT` int").repartition(3)
    model = baseline.fit_forest(df, cols, num_trees=12, max_depth=4, seed=1)
    got = {r["feature"]: r for r in baseline.permutation_importance(model, df, cols, repeats=3, seed=5).collect()}
    order = sorted(rows, key=lambda r: int(hashlib.md5(f"{r[0]}|src".encode()).hexdigest()[:15], 16))
    variants = []
    for f, name in [(0, ""), *enumerate(cols, 1)]:
        for rep in range(3):
            move = forest.shift(300, name, rep, 5) if name else 0
            for p, r in enumerate(order):
                put = list(r[1:5])
                if name:
                    put[f - 1] = order[(p + move) % 300][f]
                variants.append((name, rep, *put, r[5]))
    wide = spark.createDataFrame(variants, "feature string, repeat int, u double, v double, w double, flat double, `DEFAULT` int")
    from pyspark.ml.functions import vector_to_array

    p = model.transform(baseline.assemble(wide, cols)).select("feature", "repeat", "DEFAULT", vector_to_array("probability")[1].alias("s")).collect()
    auc = {(n, k): _auc([r["s"] for r in p if (r["feature"], r["repeat"]) == (n, k)], [r["DEFAULT"] for r in p if (r["feature"], r["repeat"]) == (n, k)]) for n in ["", *cols] for k in range(3)}
    for c in cols:
        drops = [auc["", 0] - auc[c, k] for k in range(3)]
        assert got[c]["importance_mean"] == pytest.approx(np.mean(drops), abs=1e-9) and got[c]["importance_std"] == pytest.approx(np.std(drops), abs=1e-9)
    assert got["flat"]["importance_mean"] == 0 and got["u"]["importance_mean"] > 0.02


def test_first_trees_answer_smaller_forests(spark):
    from scorelab.operators import baseline, forest

    rng = np.random.default_rng(9)
    rows = [(i, float(a), float(b), int(a + rng.normal() > 0)) for i, (a, b) in enumerate(rng.normal(size=(200, 2)))]
    df = spark.createDataFrame(rows, "row_id long, x double, z double, `DEFAULT` int")
    model = baseline.fit_forest(df, ["x", "z"], num_trees=6, max_depth=3)
    whole = {r["row_id"]: r["y_prob"] for r in baseline.score(model, df, ["x", "z"], "m").collect()}
    got = forest.prefix_scores(df, forest.trees_of(model, spark), ["x", "z"], [2, 6], "DEFAULT", ["row_id"]).collect()
    assert {str(r["row_id"]): r["y_prob"] for r in got if r["n_trees"] == 6} == {k: pytest.approx(v, abs=1e-12) for k, v in whole.items()}
    some = model.trees[:2]
    first = rows[3]
    assert next(r["y_prob"] for r in got if r["n_trees"] == 2 and r["row_id"] == 3) == pytest.approx(np.mean([t.predictProbability(__import__("pyspark").ml.linalg.Vectors.dense(first[1:3]))[1] for t in some]))
    grid = {**baseline.FOREST_GRID, "numTrees": [2, 3], "maxDepth": [2], "minInstancesPerNode": [1], "featureSubsetStrategy": ["sqrt"], "impurity": ["gini"], "class_weight": [None]}
    trials = baseline.search_forest(df, ["x", "z"], n_iter=4, folds=2, grid=grid).collect()
    assert len(trials) == 8 and {r["numTrees"] for r in trials} == {"2", "3"} and all(0.5 < r["auc_train"] <= 1 and 0 <= r["auc_roc"] <= 1 for r in trials)
    assert len({baseline.fit_key(p) for p in baseline.sample_grid(4, 42, grid)}) == 1


def test_candidates_that_fail_while_read_fall_through(spark, tmp_path):
    good, bad, ragged = (str(tmp_path / n) for n in ("good.parquet", "bad.parquet", "ragged.csv"))
    spark.range(100).write.parquet(good)
    import glob
    import shutil

    shutil.copytree(good, bad)
    for f in glob.glob(f"{bad}/part-*"):
        with open(f, "r+b") as h:
            h.truncate(40)
    with open(ragged, "w") as h:
        h.write("1,2\nx,3\n4,5,6\n")
    csv = ("csv", ragged, {"schema": "a int, b int"})
    df, prov = io.load_first_available(spark, [("parquet", bad, {}), csv, csv, ("parquet", good, {})])
    rows = prov.orderBy("attempt").collect()
    assert df.count() == 100 and [r["ok"] for r in rows] == [False, False, True] and "do not parse" in rows[1]["error"]
    with pytest.raises(FileNotFoundError):
        io.load_first_available(spark, [csv, ("parquet", good, {})], allow_fallback=False)
    with pytest.raises(TypeError):
        io.load_first_available(spark, [("parquet", good, 5)])
    (tmp_path / "whole.csv").write_text("1,x\n,y\n")
    assert io.load_first_available(spark, [("csv", str(tmp_path / "whole.csv"), {"schema": "a int, b string"})])[0].count() == 2


def test_first_existing_keeps_order_and_roots(spark, tmp_path):
    for name in ("x.csv", "sub/y.csv"):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_text("banner\na\n1\n")
    root = str(tmp_path)
    assert io.first_existing(spark, ["none.csv", "none.csv", "y.csv", f"{root}/x.csv"], (root, f"{root}/sub")) == f"{root}/sub/y.csv"
    assert [r["a"] for r in io.read_with_banner(spark, ["z.csv", "x.csv"], "a int", (root,)).collect()] == [1]
    for wrong in ([], ["z.csv"]):
        with pytest.raises((ValueError, FileNotFoundError)):
            io.first_existing(spark, wrong, (root,))


def test_tables_are_written_in_order_and_escaped(spark, tmp_path):
    df = spark.createDataFrame([("b|c", 2, 'say "x", y'), ("a_1", 1, None)], "name string, k int, note string")
    out = {}
    for fmt in ("markdown", "csv", "latex"):
        io.write_table(df, str(tmp_path / fmt), fmt, ["k"])
        out[fmt] = [r["value"] for r in spark.read.text(str(tmp_path / fmt)).collect()]
    assert out["markdown"] == ["| name | k | note |", "|---|---|---|", "| a_1 | 1 |  |", '| b\\|c | 2 | say "x", y |']
    assert out["csv"] == ["name,k,note", "a_1,1,", 'b|c,2,"say ""x"", y"']
    assert out["latex"] == [r"\begin{tabular}{lll}", r"\hline", r"name & k & note \\", r"\hline", r"a\_1 & 1 &  \\", r'b|c & 2 & say "x", y \\', r"\hline", r"\end{tabular}"]
    with pytest.raises(ValueError):
        io.table_lines(df, "html", ["k"])


def _psi(n):
    return -0.57721566490153286 + sum(1 / i for i in range(1, int(n)))


def _knn_information(x, y, k):
    """Row by row, over the classes of two rows or more."""
    x, y = np.asarray(x, float), np.asarray(y)
    keep = np.array([(y == c).sum() > 1 for c in y])
    x, y = x[keep], y[keep]
    total = 0.0
    for i in range(len(x)):
        same = np.sort(np.abs(np.delete(x, i)[np.delete(y, i) == y[i]] - x[i]))
        n = (y == y[i]).sum()
        kk = min(k, n - 1)
        d = same[kk - 1]
        m = (x == x[i]).sum() if d == 0 else ((x > x[i] - d) & (x < x[i] + d)).sum()
        total += _psi(kk) - _psi(n) - _psi(m)
    return max(0.0, _psi(len(x)) + total / len(x))


def test_nearest_neighbour_information_equals_brute_force(spark):
    """2,000 rows: smooth, rounded and mostly equal values, a small class, a class of one row, nulls."""
    from scorelab.operators.neighbours import mutual_information

    rng = np.random.default_rng(12)
    y = rng.choice([0, 1, 2], 2000, p=[0.6, 0.398, 0.002])
    y[7] = 9
    cols = {"smooth": rng.normal(size=2000) + y * 1.5, "rounded": np.round(rng.normal(size=2000) * 3 + (y == 1), 0), "flat": np.where(rng.random(2000) < 0.9, 4.0, rng.random(2000)), "noise": rng.random(2000)}
    rows = [(i, int(y[i]), *(None if n == "noise" and i % 50 == 0 else float(v[i]) for n, v in cols.items())) for i in range(2000)]
    df = spark.createDataFrame(rows, "row_id long, `DEFAULT` int, " + ", ".join(f"{n} double" for n in cols)).repartition(5)
    got = {r["feature"]: r["mi"] for r in mutual_information(df, list(cols)).collect()}
    for n, v in cols.items():
        seen = [i for i in range(2000) if not (n == "noise" and i % 50 == 0)]
        assert got[n] == pytest.approx(_knn_information(v[seen], y[seen], 5), abs=1e-9), n
    assert got["smooth"] > 0.2 > got["noise"]
    assert mutual_information(df.limit(0), ["smooth"]).count() == 0


def test_digamma(spark):
    got = spark.createDataFrame([(n,) for n in (1, 2, 3, 10, 1000)], "n long").select("n", dist.digamma("n").alias("v")).collect()
    assert all(r["v"] == pytest.approx(_psi(r["n"]), abs=1e-11) for r in got)


def test_crowded_scores_spread_over_slices(spark):
    """All scores in a hundredth of the domain: once one slice held them all."""
    from scorelab.functions import ranks
    from scorelab.operators import metrics

    rng = np.random.default_rng(13)
    p = rng.random(20_000) / 100
    y = (rng.random(20_000) < p * 60).astype(int)
    df = spark.createDataFrame([(float(a), int(b)) for a, b in zip(p, y)], "y_prob double, y_true int")
    sizes = sorted(r["count"] for r in df.groupBy(ranks.slice_of("y_prob", (0.0, 1.0), 200).alias("slice")).count().collect())
    assert len(sizes) > 200 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert metrics.auc_roc(df).first()["auc_roc"] == pytest.approx(_auc(p, y), abs=1e-9)
    assert ranks.MOST_SLICES >= len(sizes)


def test_content_hash_goes_on_from_task_to_task(spark, tmp_path):
    """no task holds a file's content or reads more than a piece of it; the hash is that of the whole file."""
    import hashlib

    rng = np.random.default_rng(15)
    sizes = {"empty": 0, "one": 1, "short": 4095, "even": 4096, "over": 4097, "sub/odd name #%25 é": 10_000, "b.x": 12_288}
    for name, n in sizes.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(rng.bytes(n))
    old = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(str(tmp_path)).selectExpr("path", "length", "sha2(content, 256) as sha256")
    want = sorted(old.collect())
    assert {r["sha256"] for r in want} >= {hashlib.sha256((tmp_path / n).read_bytes()).hexdigest() for n, size in sizes.items() if size}
    for piece in (4096, 1000, 1 << 20):
        got = io.content_hash(spark, str(tmp_path), piece=piece)
        assert got.schema == old.schema and sorted(got.collect()) == want
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (old, io.content_hash(spark, str(tmp_path)))]
    assert ["content:binary" in p for p in plans] == [True, False]
    assert [r["path"][-3:] for r in io.content_hash(spark, str(tmp_path), "*.x", piece=5000).collect()] == ["b.x"]
    assert io.content_hash(spark, str(tmp_path), "*.none").count() == 0


def test_content_hash_of_a_file_larger_than_a_row(spark, tmp_path):
    """the binaryFile source refuses files of 2 GB and more."""
    import hashlib

    with open(tmp_path / "large", "wb") as f:
        f.truncate((1 << 31) + 5)  # sparse: takes no disk
    want = hashlib.sha256()
    for _ in range(1 << 11):
        want.update(bytes(1 << 20))
    want.update(bytes(5))
    got = io.content_hash(spark, str(tmp_path)).first()
    assert (got["length"], got["sha256"]) == ((1 << 31) + 5, want.hexdigest())


def test_content_roots_do_not_depend_on_splits(spark, tmp_path):
    import hashlib

    rng = np.random.default_rng(14)
    files = {"a.bin": rng.bytes(300_000), "b.txt": b"line\r\n\n" * 5000 + b"no end", "empty": b"", "nl": b"\n", "sub/c": b"\x00" * 70_000}
    for name, data in files.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(data)

    def plain(data, leaf, fan):
        level, at = {}, 0
        pieces = data.split(b"\n") if data else []
        for piece in pieces[:-1] if data.endswith(b"\n") else pieces:
            level.setdefault(at // leaf, []).append((at, hashlib.sha256(piece).hexdigest()))
            at += len(piece) + 1
        while level:
            nodes = {k: hashlib.sha256("\n".join(f"{a}:{h}" for a, h in sorted(v)).encode()).hexdigest() for k, v in level.items()}
            if set(nodes) == {0}:
                return nodes[0]
            level = {}
            for k, h in nodes.items():
                level.setdefault(k // fan, []).append((k, h))
        return ""

    want = {n: hashlib.sha256(f"{len(d)}:{plain(d, 4096, 4)}".encode()).hexdigest() for n, d in files.items() if d}
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("128m", "10000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = {r["path"].split(str(tmp_path) + "/")[1]: r["root"] for r in io.content_roots(spark, str(tmp_path), leaf=4096, fan=4).collect()}
            assert got == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_distinct_scores_are_dealt_out_whatever_the_sessions_partitions(spark):
    """With a partition for each core, what a task reads of the distinct scores would grow with the table."""
    from scorelab.operators import metrics as M

    parts, least, size = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = {k: spark.conf.get(k, None) for k in (parts, least, size)}
    try:
        spark.conf.set(parts, "2")
        spark.conf.set(least, "false")
        scores = spark.range(5000).select(F.lit("a").alias("run"), (F.col("id") % 2).cast("int").alias("y_true"), (F.col("id") / 5000.0).alias("y_prob"))
        comp = M.kept(M.weighted(scores, ["run"]))
        assert comp.rdd.getNumPartitions() >= M.KEEP_PARTITIONS
        assert comp.count() == 5000
        assert spark.conf.get(parts) == "2" and spark.conf.get(size, None) == before[size]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def test_audit_melts_rows_where_they_lie(spark):
    """rows are shuffled with their attributes side by side, melted in place and read by no second branch."""
    from scorelab.operators import fairness as FA

    rows = [("a", i % 2, (i * 37 % 100) / 100.0, i % 3, ["x", "y", None][i % 7 % 3]) for i in range(300)] + [(None, 1, 0.5, 1, "x")]
    scores = spark.createDataFrame(rows, "run string, y_true int, y_prob double, SEX int, kind string")
    sub = FA.audit_attributes(scores, ["SEX", "kind"])
    plan = FA.disparity(sub)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Generate explode") == 1
    above = plan.split("Generate explode")[0]
    assert "SortMergeJoin" not in above and above.count("Exchange hashpartitioning") == 2  # sums of slices by group, subgroups by attribute

    got = {(r["run"], r["attribute"], r["code"]): r for r in sub.collect()}
    want = {("a", a, str(c)) for a, k in (("SEX", 3), ("kind", 4)) for c in {r[k] for r in rows} if c is not None}
    assert set(got) == want  # groups with a null key have no row
    for (run, attribute, code), r in got.items():
        own = [(y, p) for g, y, p, s, k in rows if g == run and str(s if attribute == "SEX" else k) == code]
        pos, neg = [p for y, p in own if y], [p for y, p in own if not y]
        auc = sum((p > q) + (p == q) / 2 for p in pos for q in neg) / (len(pos) * len(neg))
        assert r["n"] == len(own) and abs(r["auc_roc"] - auc) < 1e-12
        assert abs(r["brier"] - sum((y - p) ** 2 for y, p in own) / len(own)) < 1e-12
