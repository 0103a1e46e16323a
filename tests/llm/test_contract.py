import math
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F
from test_decontam import brute as brute_hits
from test_joins import brute_components

import corpus_pipeline
from scorelab.llm import mil_quality
from scorelab.llm.common import table
from scorelab.llm.queries import ORACLES, QUERIES
from scorelab.sources.tables import TABLES

SF = "/root/testdata/sf0.001"
COLUMNS = {
    "op1": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op3": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op4": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op6": {"doc_id": "bigint", "n_words": "bigint", "n_hit": "bigint", "n_items": "bigint", "items_sha256": "string", "contaminated": "boolean"},
    "op7": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint", "base_labels": "string", "labels": "string", "score": "double"},
    "op8": {"doc_id": "bigint", "n_tokens": "bigint", "ids_sha256": "string", "decoded_sha256": "string"},
    "op9": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op10": {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"},
    "op11": {"doc_id": "bigint", "n_lines": "bigint", "n_dropped": "bigint", "kept_sha256": "string"},
    "op12": {"doc_id": "bigint", "n": "bigint", "form": "string", "prefix_chars": "bigint", "middle_chars": "bigint", "output_sha256": "string", "restored_sha256": "string"},
    "op13": {"conv_id": "bigint", "gaps": "bigint", "blank": "bigint", "duplicate": "bigint", "truncated": "bigint", "illegal": "bigint", "cost": "bigint", "audit": "string", "repaired_sha256": "string"},
}


def test_one_query_for_each_operator():
    assert [n.split("_")[0] for n in sorted(QUERIES, key=lambda n: int(n[2:].split("_")[0]))] == [f"op{i}" for i in range(1, 14)]


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_columns_and_sql(spark, name):
    df = QUERIES[name](spark, SF)
    kinds = dict(df.dtypes)
    for column, kind in COLUMNS.get(name.split("_")[0], {}).items():
        assert kinds[column] == kind, (name, column)
    rows = df.collect()
    assert rows or name.startswith("op5")
    if name in ORACLES:
        con = duckdb.connect()
        for t in TABLES:
            con.execute(f"create view {t} as select * from read_parquet('{SF}/{t}.parquet')")
        want = con.execute(ORACLES[name])
        names = [c[0] for c in want.description]
        assert sorted(names) == sorted(df.columns)
        assert Counter(tuple(r[n] for n in names) for r in rows) == Counter(want.fetchall())


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    text = lambda df: [(r["doc_id"], r["text"]) for r in df.collect()]
    every = text(docs)
    good = corpus_pipeline.good_quality(spark, docs, SF).cache()
    model = mil_quality.fit(docs, table(spark, SF, "labels"))
    scores = {r["doc_id"]: r["score"] for r in mil_quality.score(docs, model).collect()}
    assert sorted(text(good)) == sorted((d, t) for d, t in every if scores[d] >= mil_quality.THRESHOLD)
    one = corpus_pipeline.one_of_each_group(spark, good, SF).cache()
    roots, _ = brute_components(text(good))
    assert sorted(text(one)) == sorted((d, t) for (d, t), r in roots.items() if r == d)
    clean = corpus_pipeline.decontaminated(spark, one, SF).cache()
    items = [(str(r["item_id"]), r["text"]) for r in table(spark, SF, "benchmark").collect()]
    hits = {d: brute_hits(t, items) for d, t in text(one)}
    assert {d for d, _ in text(clean)} == {d for d, (n, hit, _) in hits.items() if not (hit and 20 * len(hit) >= n)}
    assert all(r["n_chars"] == len(r["text"]) for r in clean.collect())
    tokens = corpus_pipeline.tokenised(spark, clean, SF)
    assert tokens.where(~F.col("round_trip")).count() == 0 and tokens.count() == clean.count()
    for df in (good, one, clean):
        assert df.dtypes == docs.dtypes


def test_stages_on_odd_tables(spark):
    rows = [(1, None, "en", None, None, 5, "x"), (2, "", None, "s", 0, 6, None), (2, "", None, "s", 0, 6, None), (None, "some words of a text here", None, None, None, None, None), (None, "other words that are not alike", None, None, None, None, None), (3, "long " * 30_000, "en", "s", math.inf and 1, 7, "y"), (2, "same id but other words in it", "fr", "s", 1, None, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, n_hit int, kept string")
    for df in (docs, docs.limit(0)):
        out = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, out, SF)
            assert out.columns == docs.columns
        last = corpus_pipeline.tokenised(spark, out, SF)
        assert last.where(~F.col("round_trip")).count() == 0
    named = docs.withColumnsRenamed({"n_hit": "kept__key", "kept": "decontam__n_hit"})
    for stage in (corpus_pipeline.one_of_each_group, corpus_pipeline.decontaminated):
        made = stage(spark, named, SF)
        assert made.dtypes == named.dtypes and made.where("kept__key in (5, 6, 7)").count() == made.where("kept__key is not null").count() > 0
    one = corpus_pipeline.one_of_each_group(spark, docs, SF)
    assert Counter((r["doc_id"], (r["text"] or "")[:9]) for r in one.collect()) == Counter([(1, ""), (2, ""), (None, "some word"), (None, "other wor"), (3, "long long"), (2, "same id b")])


def test_intermediate_tables_go_with_the_application(tmp_path):
    """A driver process of its own: its tables are there while it runs and gone when it has ended."""
    import subprocess
    import sys
    from pathlib import Path

    code = f"""
from scorelab.session import local_session
from scorelab.llm import common
spark = local_session(2, extra={{"spark.checkpoint.dir": "{tmp_path}", "spark.driver.memory": "1g"}})
df = common.materialise(spark.range(10), "some")
assert df.count() == 10
import glob
assert len(glob.glob("{tmp_path}/**/some-*", recursive=True)) == 1
"""
    root = str(Path(__file__).resolve().parents[2])
    done = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, timeout=120)
    assert done.returncode == 0, done.stderr[-2000:]
    assert "intermediate tables stay" not in done.stderr and not list(tmp_path.rglob("some-*"))
