"""Cleaning, features, splits, encoding, and the driver contract."""

import pytest
from pyspark.sql import functions as F

from scorelab import schema as S
from scorelab.operators import clean, encode as EN, features, split as SP
from scorelab.sources import fixtures as fx


def test_clean_folds_codes(spark, sf):
    a = clean.clean_categoricals(fx.accounts(spark, sf))
    edu = {r[0] for r in a.select("EDUCATION").distinct().collect()}
    mar = {r[0] for r in a.select("MARRIAGE").distinct().collect()}
    assert edu <= {1, 2, 3, 4} and mar <= {1, 2, 3}


def test_engineered_columns(spark, sf):
    e = features.engineer_features(fx.accounts(spark, sf))
    assert all(c in e.columns for c in features.ENGINEERED) and len(features.ENGINEERED) == 24
    r = e.agg(F.max(F.abs("REPAY_RATIO_1")), F.min("N_MONTHS_DELAYED"), F.max("N_MONTHS_DELAYED")).first()
    assert r[0] <= 5.0 and 0 <= r[1] and r[2] <= 6


def test_split_exact_proportions(spark, sf):
    a = SP.stratified_split(fx.accounts(spark, sf))
    counts = {(r.DEFAULT, r.split): r["count"] for r in a.groupBy("DEFAULT", "split").count().collect()}
    for cls in (0, 1):
        n = sum(v for (c, _), v in counts.items() if c == cls)
        n_test = round(n * 0.15)
        assert counts.get((cls, "test"), 0) == n_test
    again = SP.stratified_split(fx.accounts(spark, sf)).select("row_id", "split")
    assert again.exceptAll(a.select("row_id", "split")).count() == 0


def test_batches_keep_rate(spark, sf):
    a = fx.accounts(spark, sf)
    b = SP.assign_batches(a, 32, drop_last=True).where(F.col("batch").isNotNull())
    sizes = {r[0] for r in b.groupBy("batch").count().select("count").collect()}
    assert sizes == {32}


def test_pay_encode_table(spark):
    df = spark.createDataFrame([(v,) for v in range(-2, 9)], "PAY_0 int")
    st, sev, raw = EN.encode_pay("PAY_0")
    got = df.select("PAY_0", st.alias("s"), sev.alias("v"), raw.alias("r")).orderBy("PAY_0").collect()
    assert [r.s for r in got] == [0, 1, 2] + [3] * 8
    assert [r.r for r in got] == list(range(0, 11))
    assert abs(got[-1].v - 1.0) < 1e-12
    bad = spark.createDataFrame([(9,)], "PAY_0 int")
    with pytest.raises(Exception):
        bad.select(EN.encode_pay("PAY_0")[0]).collect()


def test_tokenise_unseen_code_raises(spark, sf):
    a = clean.clean_categoricals(fx.accounts(spark, sf))
    vocab = EN.build_vocab(a.where(F.col("EDUCATION") != 4), S.CATEGORICAL)
    with pytest.raises(Exception):
        EN.tokenise(a, vocab).collect()


def test_mask_bounds_and_determinism(spark, sf):
    a = fx.accounts(spark, sf)
    m1 = EN.mask_tokens(a, p=0.15, min_mask=2, max_mask=5, seed=3)
    n = m1.select(F.size(F.filter("mask_positions", lambda x: x)).alias("k")).agg(F.min("k"), F.max("k")).first()
    assert n[0] >= 2 and n[1] <= 5
    m2 = EN.mask_tokens(a, p=0.15, min_mask=2, max_mask=5, seed=3)
    assert m1.exceptAll(m2).count() == 0


def test_entry_contract(spark):
    import __spark_entry__ as E

    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 100
    df = E.entry(spark)
    assert df.count() > 0 and "selection_rate_diff" in df.columns


def test_strict_validation_names_the_values(spark):
    from scorelab import schema as S
    from scorelab.operators import clean

    good = spark.createDataFrame([tuple(1 for _ in S.FEATURES)], ", ".join(f"{c} int" for c in S.FEATURES))
    assert clean.require_valid(good).count() == 1
    bad = good.withColumns({"PAY_2": F.lit(9), "SEX": F.lit(1.5)})
    with pytest.raises(ValueError, match=r"PAY_2.*9\.0"):
        clean.require_valid(bad)
    assert {(r["check"], r["column"], r["value"]) for r in clean.invalid_values(bad).collect()} == {("invalid_pay", "PAY_2", 9.0), ("non_integer", "SEX", 1.5)}
    with pytest.raises(ValueError, match="missing_column"):
        clean.require_valid(good.drop("AGE"))
