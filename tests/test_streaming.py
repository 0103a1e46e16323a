"""Apply-side operators run unchanged on a streaming DataFrame."""

import tempfile

from scorelab.sources import fixtures as fx
from scorelab.streaming import apply as ST


def test_prepare_stream_matches_batch(spark, sf):
    acc = fx.accounts(spark, sf)
    src = tempfile.mkdtemp(prefix="scorelab-stream-src-")
    acc.write.mode("overwrite").parquet(src)
    stream = ST.read_accounts_stream(spark, src, acc.schema)
    assert stream.isStreaming
    ST.run_to_table(ST.prepare_stream(stream), "prepared_accounts", tempfile.mkdtemp(prefix="scorelab-stream-ckpt-"))
    got = spark.sql("select count(*) as n, sum(N_MONTHS_DELAYED) as d from prepared_accounts").first()
    batch = ST.prepare_stream(acc).selectExpr("count(*) as n", "sum(N_MONTHS_DELAYED) as d").first()
    assert (got.n, got.d) == (batch.n, batch.d)
