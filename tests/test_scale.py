"""Plans that keep their cost in step with the rows: what is read once, what is not joined by a few keys, what is not broadcast."""

import numpy as np
from pyspark.sql import functions as F

from scorelab.operators import bootstrap as B
from scorelab.operators import calibrate as C
from scorelab.operators import encode as EN
from scorelab.operators import fairness as FA
from scorelab.operators import metrics as M
from scorelab.operators import uncertainty as U


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def _rows(spark, n=300, runs=("a", "b")):
    rng = np.random.default_rng(5)
    rows = [(r, str(i), int(i % 3 == 0), float(np.round(rng.random(), 2)), ["x", "y"][i % 2]) for i in range(n) for r in runs]
    return spark.createDataFrame(rows, "run string, row_id string, y_true int, y_prob double, kind string").withColumn("split", F.when(F.col("row_id") % 2 == 0, "val").otherwise("test"))


def test_ensembles_of_several_modes_share_one_shuffle(spark):
    s = _rows(spark)
    both = M.ensemble(s, ["a", "b"], ["arithmetic", "geometric"], ["ens", "geo"], round_dp=6)
    apart = M.ensemble(s, ["a", "b"], "arithmetic", "ens", round_dp=6).unionByName(M.ensemble(s, ["a", "b"], "geometric", "geo", round_dp=6))
    assert _plan(both).count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, apart.collect()))


def test_head_to_head_weights_stand_for_rows(spark):
    s, by, taus = _rows(spark), ["run", "split"], [0.2, 0.5, 0.7]
    w = M.weighted(s, by)
    assert sorted(map(str, M.optimise_threshold(w, taus, by, weight="w").collect())) == sorted(map(str, M.optimise_threshold(s, taus, by).collect()))


def test_multinomial_draws_are_not_broadcast(spark):
    rows = B.keyed(_rows(spark, 50, ("a",)), 3)
    draws = B.missing_draws(rows, 20, 3, 50, B.poisson_limits(0.2))
    assert "Broadcast" not in _plan(draws)


def test_tally_of_distinct_and_tied_scores_over_blocks():
    s, y = np.array([0.1, 0.1, 0.2, 0.3, 0.3, 0.3, 0.9]), np.array([1.0, 0, 0, 1, 0, 1, 1])
    w = np.random.default_rng(2).poisson(1, (7, 9)).astype(float)
    total = np.stack([y, 1 - y]) @ w
    t = B.Tally(np.zeros((2, 9)), total, 0.5, np.array([0.5]))
    for a, b in ((0, 1), (1, 4), (4, 5), (5, 7)):
        t.add(s[a:b], y[a:b], w[a:b])
    u = sum(w[i] * w[j] * ((s[j] < s[i]) + (s[j] == s[i]) / 2) for i in range(7) for j in range(7) if y[i] and not y[j])
    tp, n = (np.array([(w * keep[:, None])[s >= v].sum(0) for v in np.unique(s)]) for keep in (y, np.ones(7)))
    p = np.array([(w * y[:, None])[s == v].sum(0) for v in np.unique(s)])
    ap = np.divide(p * tp, n, out=np.zeros_like(p), where=n > 0).sum(0)
    out = t.done()
    assert np.allclose(out[0], u) and np.allclose(out[1], ap)


def test_parameters_are_not_joined_by_their_few_groups(spark):
    s = _rows(spark)
    params = spark.createDataFrame([("a", 1.5), ("b", 2.0)], "run string, temperature double")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "SortMergeJoin" not in _plan(C.apply_temperature(s, params))
        ab = spark.createDataFrame([("a", 1.0, 0.0), ("b", 1.0, 0.1)], "run string, a double, b double")
        assert "SortMergeJoin" not in _plan(C.fit_gradient(s, ab))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_weighted_fits_are_those_of_the_rows(spark):
    s = _rows(spark).where("split = 'val'")
    w = M.weighted(s, ["run"])
    for fit in (C.fit_platt, C.fit_temperature, C.fit_isotonic):
        a, b = (np.array(sorted(tuple(r)[1:] for r in got.collect())) for got in (fit(s, ["run"]), fit(w, ["run"], weight="w")))
        assert np.allclose(a, b, atol=1e-9)
    g, gw = C.fit_gradient(s, C.fit_platt(s)), C.fit_gradient(w, C.fit_platt(s), weight="w")
    assert np.allclose([r.gradient_a for r in g.collect()], 0, atol=1e-8) and np.allclose([r.gradient_a for r in gw.collect()], 0, atol=1e-8)


def test_rows_are_read_once_by_calibrators_and_subgroups(spark):
    s = _rows(spark).withColumn("y_prob", F.col("y_prob") + F.length(F.md5("row_id")) * 0.0)
    val, test = s.where("split = 'val'"), s.where("split = 'test'")
    assert "md5" not in _plan(C.calibrate_and_score(val, test, ("identity", "platt"), 10, ["run"]))
    assert "md5" not in _plan(FA.audit_attributes(test, ["kind"]))
    assert "md5" not in _plan(M.metric_bundle(test, 0.5, ["run"], 10))


def test_reliability_is_counted_by_bin_before_rows_are_melted(spark):
    s = _rows(spark)
    got = {(r.run, r.code, r.bin): (r.confidence, r.frequency, r["count"]) for r in FA.subgroup_reliability(s, ["kind"]).collect()}
    rows = s.collect()
    for (run, code, b), (conf, freq, n) in got.items():
        mine = [r for r in rows if r.run == run and r.kind == code and sum(r.y_prob >= e for e in [k * 0.1 for k in range(1, 10)]) == b]
        assert n == len(mine) and abs(conf - np.mean([r.y_prob for r in mine])) < 1e-12 and abs(freq - np.mean([r.y_true for r in mine])) < 1e-12
    assert sum(n for _, _, n in got.values()) == len(rows)
    plan = _plan(FA.subgroup_reliability(s, ["kind"]))
    assert plan.rindex("HashAggregate") > plan.rindex("Generate")  # the aggregate nearest the rows is below the melt


def test_masks_draw_for_few_tokens(spark):
    t = spark.createDataFrame([(i,) for i in range(40)], "row_id long")
    for lo, hi in ((1, 23), (5, 6), (0, 2)):
        for r in EN.mask_tokens(t, min_mask=lo, max_mask=hi).collect():
            assert max(lo, 0) <= sum(r.mask_positions) <= hi
            assert all((m >= 0) == on for m, on in zip(r.replace_mode, r.mask_positions))
    assert _optimized(EN.mask_tokens(t)).count("|mode") <= 3


def test_uncertainty_is_summed_once(spark):
    samples = spark.createDataFrame([(i, k, ((i * 7 + k * 3) % 10 + 0.5) / 11) for i in range(60) for k in range(3)], "row_id long, t int, p double")
    unc = U.uncertainty(samples, samples.select("row_id", (F.col("row_id") % 2).cast("int").alias("y_true")).distinct())
    assert "stddev" not in _plan(U.headline(unc)) and "stddev" not in _plan(U.refuse_curve(unc))


def test_counts_are_those_of_the_draws_one_by_one():
    def mix(x):
        for shift, factor in zip((16, 15), B.FACTORS):
            x = (x ^ x >> shift) * factor % B.TWO32
        return x ^ x >> 16

    rng = np.random.default_rng(6)
    k1, k2 = rng.integers(0, B.TWO32, 40), rng.integers(0, B.TWO32, 40)
    for limits in (B.poisson_limits(), B.poisson_limits(9.0), B.poisson_limits(0.01), []):
        got = B.row_counts(k1, k2, 50, limits)
        want = [[sum(mix(mix((int(a) + r * B.STEP) % B.TWO32) ^ int(b)) >= v for v in limits) for r in range(50)] + [1] for a, b in zip(k1, k2)]
        assert got.dtype == np.uint8 and (got == want).all()
    many = B.row_counts(k1, k2, 50, [], (np.zeros(700, int), np.full(700, 3)))
    assert many[0, 3] == 700 and many.sum() == 740 and (B.added(many) == many.sum(0)).all()


def test_ties_reach_the_tally_as_distinct_scores():
    rng = np.random.default_rng(7)
    s, y = rng.integers(0, 5, 3000) / 5, (rng.random(3000) < 0.4).astype(float)
    by = np.lexsort((y, s))
    s, y, counts = s[by], y[by], rng.poisson(1, (3000, 9)).astype(np.uint8)
    total = np.stack([y, 1 - y]) @ counts
    seen = []

    class Seen(B.Tally):
        def add(self, s, y, w):
            seen.append(len(s))
            super().add(s, y, w)

    plain, ties = B.Tally(np.zeros((2, 9)), total, 0.5, np.array([0.5])), B.Ties(Seen(np.zeros((2, 9)), total, 0.5, np.array([0.5])), 8)
    for a in range(0, 3000, 64):
        plain.add(s[a : a + 64], y[a : a + 64], counts[a : a + 64].astype(float))
        ties.add(s[a : a + 64], y[a : a + 64], counts[a : a + 64])
    assert np.allclose(plain.done(), ties.done(), rtol=1e-12)
    assert sum(seen) == 10  # 5 scores x 2 labels


def test_rows_in_order_travel_in_records(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays([pa.array([0] * 1000, pa.int32()), pa.array(np.arange(1000.0)), pa.array([None, 1] * 500, pa.int32()), pa.array(np.arange(1000) * -7)], names=["run", "s", "y", "k"])
    records = [*B._packed(iter([batch]))]
    assert [r.num_rows for r in records] == [-(-1000 // B.RECORD)]
    back = pa.Table.from_batches([*B._unpacked(iter(records))])
    assert back.column("s").to_pylist() == [*range(1000)] and back.column("y").null_count == 500
    assert [(a << 32 | b) - (1 << 64 if a >> 31 else 0) for a, b in zip(back.column("k1").to_pylist(), back.column("k2").to_pylist())] == [-7 * i for i in range(1000)]
