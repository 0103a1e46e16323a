import random
import re

import pytest

from scorelab.llm import decontam

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


def words(t):
    return WORD.findall((t or "").translate(FOLD))


def brute(text, items, window=13):
    w, hit, found = words(text), set(), set()
    for name, t in items:
        x = words(t)
        n = min(window, len(x))
        for a in range(len(x) - n + 1) if n else ():
            for i in range(len(w) - n + 1):
                if w[i : i + n] == x[a : a + n]:
                    hit.update(range(i, i + n))
                    found.add(name)
    return len(w), hit, found


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(30)] + ["été", "ÉTÉ", "9"]
    line = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [("1", line(40)), ("2", line(13)), ("3", line(5)), ("4", "w1 W2"), ("5", "!!"), ("6", ""), ("7", None), ("10", line(30))]
    items.append(("11", items[0][1]))  # the same text under another id
    items.append(("12", items[0][1][20:150]))
    docs = [None, "", "?!", "w1", items[3][1].upper()]
    for _ in range(60):
        parts = [line(rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            t = rng.choice([t for _, t in items if t]).split(" ")
            a = rng.randint(0, max(0, len(t) - 1))
            parts += [", ".join(t[a : a + rng.randint(1, 40)]), line(rng.randint(0, 30))]
        docs.append(rng.choice([" ", "; "]).join(parts))
    docs += [docs[-1], line(40_000) + items[0][1]]
    return docs, items


@pytest.mark.parametrize("block_words", [100_000, 20])
def test_find_equals_brute_force(spark, case, block_words):
    docs, items = case
    df = spark.createDataFrame([(i, t, "own") for i, t in enumerate(docs)], "doc_id long, text string, spans string")
    bench = spark.createDataFrame([*items, items[0]], "item_id string, text string")
    got = {r["doc_id"]: r for r in decontam.find(df, bench, block_words=block_words).collect()}
    assert len(got) == len(docs)
    for i, t in enumerate(docs[:-1]):
        n, hit, found = brute(t, items)
        r = got[i]
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, len(hit), sorted(found))
        assert {k for s in r["spans"] for k in range(s["first_word"], s["end_word"])} == hit
        for s in r["spans"]:
            assert words(t.encode()[s["first_byte"] : s["end_byte"]].decode()) == words(t)[s["first_word"] : s["end_word"]]
    assert "1" in got[len(docs) - 1]["items"]


def test_remove_cuts_spans_and_drops_contaminated(spark, case):
    docs, items = case
    df = spark.createDataFrame([(i, t, i, "x") for i, t in enumerate(docs[:-1])], "doc_id long, text string, n_hit long, items string")
    bench = spark.createDataFrame(items, "item_id string, text string")
    out = decontam.remove(df, bench)
    assert out.columns == df.columns
    got = {r["doc_id"]: r for r in out.collect()}
    for i, t in enumerate(docs[:-1]):
        n, hit, _ = brute(t, items)
        assert (i in got) == (not (hit and 20 * len(hit) >= n))
        if i in got:
            assert got[i]["n_hit"] == i and got[i]["items"] == "x"
            assert words(got[i]["text"]) == [w for k, w in enumerate(words(t)) if k not in hit]
            assert hit or got[i]["text"] == t


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    bench = spark.createDataFrame([("1", "a b c")], "item_id string, text string")
    assert decontam.digests(none, bench).count() == 0
    r = decontam.digests(spark.createDataFrame([(1, "a b c")], none.schema), bench.limit(0)).first()
    assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (3, 0, 0, False)


def test_automaton_finds_every_window():
    rng = random.Random(9)
    for _ in range(200):
        items = [(str(i), [bytes([rng.choice(b"abc")]) for _ in range(rng.randint(1, 9))]) for i in range(rng.randint(1, 6))]
        text = [bytes([rng.choice(b"abcd")]) for _ in range(40)]
        got = {(e, n, x) for e, n, names in decontam.Automaton(items, 4).stream(text) for x in names}
        want = set()
        for name, w in items:
            n = min(4, len(w))
            for a in range(len(w) - n + 1):
                want |= {(i + n, n, name) for i in range(len(text) - n + 1) if text[i : i + n] == w[a : a + n]}
        assert got == want


@pytest.mark.parametrize("block_words", [100_000, 10])
def test_items_without_an_id_hit_and_are_not_named(spark, block_words):
    """Also against the query's SQL, whose joined ids leave nulls out."""
    import duckdb
    import pyarrow as pa

    from scorelab.llm.queries import ORACLES

    long, short, own = " ".join(f"a{i}" for i in range(20)), "just three words", " ".join(f"b{i}" for i in range(16))
    items = [(None, long), (None, short), (7, own), (8, short), (None, None)]
    docs = [(1, long), (2, f"x {short} y"), (3, f"{own} {long} {short}"), (4, "none of it"), (None, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    con = duckdb.connect()
    for name, key, rows in (("documents", "doc_id", docs), ("benchmark", "item_id", items)):
        con.register(name, pa.table({key: pa.array([r[0] for r in rows], pa.int64()), "text": pa.array([r[1] for r in rows], pa.string())}))
    want = {r[0]: r for r in con.execute(ORACLES["op6_decontaminate"]).fetchall()}
    found = {r["doc_id"]: r for r in decontam.find(df, bench, block_words=block_words).collect()}
    assert found[1]["n_hit"] == 20 and found[1]["items"] == [None] and found[3]["items"] == ["7", "8", None]
    got = {r["doc_id"]: tuple(r) for r in decontam.digests(df, bench).collect()}
    assert got.keys() == want.keys() and all(got[d] == want[d] for d in got if d is not None)
    assert decontam.remove(df, bench).where("doc_id in (1, 2, 3)").count() == 0


def test_many_blocks_use_one_worker_a_task(spark):
    """One pass after the other: no plan holds the Python nodes of several blocks."""
    items = [(str(i), " ".join(f"w{i}x{k}" for k in range(20))) for i in range(25)]
    docs = [(i, f"start {items[i][1]} end {items[(i + 1) % 25][1]}") for i in range(25)]
    bench, df = spark.createDataFrame(items, "item_id string, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    found = decontam.find(df, bench, block_words=20)
    assert found._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    got = {r["doc_id"]: r for r in found.collect()}
    for d, t in docs:
        n, hit, names = brute(t, items)
        assert (got[d]["n_words"], got[d]["n_hit"], got[d]["items"]) == (n, len(hit), sorted(names))
