import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scorelab.llm import fill_middle, line_dedup

BLANKS = " \t\n\x0b\f\r"
FOLD = {c: c + 32 for c in range(65, 91)}


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# line dedup


def brute_dedup(rows, least_chars=40, least_docs=5):
    key = lambda line: line.strip(BLANKS).translate(FOLD)
    order = lambda d: (d is not None, d)
    holders = defaultdict(set)
    for d, t in rows:
        for line in (t or "").split("\n"):
            if len(key(line)) >= least_chars:
                holders[key(line)].add(d)
    last = {k: max(ds, key=order) for k, ds in holders.items() if len(ds) >= least_docs}
    out = []
    for d, t in rows:
        lines = (t or "").split("\n")
        left = [x for x in lines if last.get(key(x), d) == d]
        out.append((d, len(lines), len(lines) - len(left), "\n".join(left)))
    return Counter(out)


def lines_corpus():
    rnd = random.Random(3)
    exact = "É" + "x" * 39
    common = ["This Footer line is repeated on pages of every kind", exact, "y" * 39, "  \t" + "Padded Line " * 5 + "\r", "z" * 41 + " ", "Q" * 60]
    rows = []
    for d in range(60):
        body = [rnd.choice(common) if rnd.random() < 0.5 else f"own line {rnd.random()} " + "w" * rnd.randint(0, 60) for _ in range(rnd.randint(0, 9))]
        rows.append((d if d % 13 else None, "\n".join(rnd.choice([x, x.upper(), " " + x]) for x in body)))
    return rows + [(7, rows[8][1]), rows[9], rows[9], (100, None), (101, ""), (102, "\n\n"), (103, "\n".join(["Q" * 60] * 5000)), (104, "k" * 300_000), (105, "\r\n".join(common)), (None, common[0])]


def test_line_dedup_equals_brute_force(spark):
    rows = lines_corpus()
    docs = spark.createDataFrame([(d, t, 1, "p", 2, [3]) for d, t in rows], "doc_id long, text string, pos int, h string, mark int, lines array<int>").repartition(7)
    got = line_dedup.dedup(docs)
    assert Counter(tuple(r) for r in got.collect()) == brute_dedup(rows)
    assert Counter(tuple(r) for r in line_dedup.dedup(docs, least_chars=10, least_docs=2).collect()) == brute_dedup(rows, 10, 2)
    assert Counter((r["doc_id"], r["kept_sha256"]) for r in line_dedup.digests(docs).collect()) == Counter((d, sha(t)) for d, _, _, t in brute_dedup(rows).elements())
    assert line_dedup.digests(docs.limit(0)).count() == 0


def test_line_dedup_is_native(spark):
    docs = spark.createDataFrame(lines_corpus(), "doc_id long, text string")
    plan = line_dedup.digests(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


# fill-in-middle


def brute_frame(d, t, seed=1, marks=fill_middle.SENTINELS):
    t = t or ""
    x = hashlib.sha256(f"{seed}:{'' if d is None else d}".encode()).hexdigest()
    h = [int(x[i * 8 : i * 8 + 8], 16) for i in range(4)]
    n = len(t)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in marks) or h[2] % 100 >= 90:
        return d, n, "plain", None, None, t
    p, m, s = t[:a], t[a:b], t[b:]
    spm = h[3] % 100 < 20
    return d, n, "spm" if spm else "psm", a, b - a, f"{marks[1]}{s}{marks[0]}{p}{marks[2]}{m}" if spm else f"{marks[0]}{p}{marks[1]}{s}{marks[2]}{m}"


def frame_rows():
    rnd = random.Random(5)
    letters = ["a", "B", " ", "\n", "<", "<P", "S>", ">", "é", "ß", "中", "́", "😀", "\x00", "𝒳"]
    rows = [(i, "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 30)))) for i in range(300)]
    return rows + [(None, "null key é"), (5, None), (5, ""), (6, "a<S>b"), (7, "<M>"), (8, "<P"), (9, "é中😀" * 200_000), (9, "plain ascii " * 100_000), (11, "same"), (11, "same")]


def test_frames_equal_brute_force(spark):
    rows = frame_rows()
    docs = spark.createDataFrame([(d, t, "x", 1, None) for d, t in rows], "doc_id long, text string, output string, n int, key string").repartition(3)
    want = Counter(brute_frame(*r) for r in rows)
    made = fill_middle.transform(docs)
    assert Counter(tuple(r) for r in made.collect()) == want
    assert {f for _, _, f, *_ in want} == {"plain", "psm", "spm"}
    assert Counter(tuple(r) for r in fill_middle.restored(made).collect()) == Counter((d, t or "") for d, t in rows)
    got = Counter((r["doc_id"], r["output_sha256"], r["restored_sha256"]) for r in fill_middle.digests(docs).collect())
    assert got == Counter((d, sha(brute_frame(d, t)[-1]), sha(t or "")) for d, t in rows)
    assert fill_middle.digests(docs.limit(0)).count() == 0


def test_index_converts_every_cut():
    for text in ("", "abc", "é", "aé中😀b" * 50, "😀" * 40):
        data = np.frombuffer(text.encode(), np.uint8)
        index = fill_middle.Exceptions(data)
        at = np.array([len(text[:i].encode()) for i in range(len(text) + 1)])
        assert index.bytes(np.arange(len(text) + 1)).tolist() == at.tolist()
        assert index.chars(at).tolist() == list(range(len(text) + 1))
        assert len(index.at_byte) == sum(ord(c) > 127 for c in text)


def test_other_seeds_and_sentinels(spark):
    docs = spark.createDataFrame([(i, "some text with é") for i in range(50)], "doc_id long, text string")
    marks = ("[pre]", "[suf]", "[mid]")
    got = fill_middle.transform(docs, seed=7, sentinels=marks)
    assert Counter(tuple(r) for r in got.collect()) == Counter(brute_frame(i, "some text with é", 7, marks) for i in range(50))
    assert fill_middle.restored(got, sentinels=marks).where(F.col("text") != "some text with é").count() == 0
    with pytest.raises(ValueError):
        fill_middle.transform(docs, sentinels=("ab", "bc", "x"))
