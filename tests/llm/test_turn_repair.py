import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa

from scorelab.llm import turn_repair
from scorelab.llm.queries import ORACLES

BLANKS = " \t\n\x0b\f\r"
SHAPE = re.compile(r"(s?(ua)+)?")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_edits(rows):
    """Least (cost, audit, repaired rows) over every way of editing (role, text, fault) rows, with at most two insertions in a place."""
    options = []
    for role, text, fault in rows:
        own = [("D", 3, [])]
        if fault not in ("blank", "duplicate"):
            more = fault == "truncated"
            own += [("K", more, [(role, text)])] + [("R", 2 + more, [(r, text)]) for r in ("user", "assistant")]
        options.append(own)
    fills = [("I" * len(f), 2 * len(f), [(r, "") for r in f]) for n in range(3) for f in itertools.product(("user", "assistant"), repeat=n)]
    best = None
    for parts in itertools.product(*[x for own in options for x in (fills, own)], fills):
        out = [r for _, _, made in parts for r in made]
        if SHAPE.fullmatch("".join(r[0][:1] or "?" for r in out)):
            now = sum(c for _, c, _ in parts), "".join(x for x, _, _ in parts), out
            best = now if best is None or now[:2] < best[:2] else best
    return best


def brute_report(rows):
    """The contract's columns of one conversation's (turn, role, text) rows in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        ink = text.rstrip(BLANKS)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    turns = {t for t, _, _ in rows if t is not None}
    cost, audit, out = brute_edits([(r, t, f) for (_, r, t), f in zip(rows, faults)])
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, out


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))


def conversations(seed, n, longest):
    rnd = random.Random(seed)
    texts = ["Fine.", "Fine.", "No end", "Ends! \t", "", " \n", "é?", "other one.", "x" * 30]
    out = {}
    for c in range(n):
        rows = [(rnd.choice([None, 0, 1, 2, 3, 5, 9]), rnd.choice(["user", "assistant", "system", "tool", "", " "]), rnd.choice(texts)) for _ in range(rnd.randint(1, longest))]
        out[c if c else None] = in_order(rows)
    return out


def test_repair_equals_every_way(spark):
    every = conversations(1, 60, 3)
    rows = [(c, t, r, x, "p", [1]) for c, rs in every.items() for t, r, x in rs]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, place string, h array<int>").repartition(5)
    want = {c: brute_report(rs) for c, rs in every.items()}
    got = {r[0]: tuple(r)[1:] for r in turn_repair.audits(df).collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    made = {}
    for r in sorted(turn_repair.repaired(df).collect(), key=lambda r: r["place"]):
        made.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    assert made == {c: w[-1] for c, w in want.items() if w[-1]}


def plain(symbols):
    """The row-by-row form: least (cost, audit) from each state, from the last row to the first."""
    best = [(0, ""), (4, "II"), (2, "I"), (0, "")]
    for symbol in reversed(symbols):
        own = [min((c + best[to][0], x + best[to][1]) for x, c, to in turn_repair.Repairer.options(symbol, s)) for s in range(4)]
        for _ in range(2):
            own = [min(own[s], (2 + own[turn_repair.FILLED[s]][0], "I" + own[turn_repair.FILLED[s]][1])) for s in range(4)]
        best = own
    return best[0]


def test_runs_equal_rows_one_by_one():
    rnd = random.Random(2)
    repairer = turn_repair.Repairer()
    for _ in range(400):
        symbols = [s for _ in range(rnd.randint(0, 6)) for s in [rnd.randrange(16)] * rnd.choice([1, 1, 2, 3, 5, 8, 21, 37])]
        runs = turn_repair.runs(np.array(symbols, np.int64), np.ones(len(symbols), np.int64))
        assert repairer.repair(*runs) == plain(symbols)
    cost, audit = repairer.repair(np.array([4 * turn_repair.USER, 4 * turn_repair.SYSTEM + turn_repair.BLANK]), np.array([3001, 10**6]))
    assert audit.endswith("D" * 10**6 + "I") or audit.endswith("D" * 10**6)
    assert (cost, audit) == (plain([4 * turn_repair.USER] * 3001 + [4 * turn_repair.SYSTEM + turn_repair.BLANK])[0] + 3 * (10**6 - 1), audit)


def brute_digest(conv, rows):
    name = lambda t: f"{' ' if conv is None else conv}:{' ' if t is None else t}"
    hurt = []
    for turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(name(turn).encode()) % 20
        if k:
            row = turn, "user" if k == 4 else role, "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
            hurt += [row] * (2 if k == 3 else 1)
    if not hurt:
        return conv, 0, 0, 0, 0, 0, 0, "", sha("")
    *report, out = brute_report(in_order(hurt))
    return conv, *report, sha("\n".join(f"{r}:{t}" for r, t in out))


def test_digests_equal_brute_force_and_sql(spark):
    rnd = random.Random(4)
    every = {c: [(rnd.choice([None, *range(6)]), rnd.choice(["user", "assistant", "system", None]), rnd.choice(["Yes.", "No!", "open", None, "", "a? b."])) for _ in range(rnd.randint(1, 3))] for c in [None, *range(1, 90)]}
    rows = [(c, t, r, x) for c, rs in every.items() for t, r, x in rs]
    df = spark.createDataFrame([(*r, 7) for r in rows], "conv_id long, turn long, role string, text string, kind int").repartition(6)
    want = Counter(brute_digest(c, rs) for c, rs in every.items())
    made = turn_repair.digests(df)
    assert Counter(tuple(r) for r in made.collect()) == want
    con = duckdb.connect()
    con.register("conversations", pa.table({k: pa.array([r[i] for r in rows], t) for i, (k, t) in enumerate({"conv_id": pa.int64(), "turn": pa.int64(), "role": pa.string(), "text": pa.string()}.items())}))
    assert Counter(con.execute(ORACLES["op13_turn_repair"]).fetchall()) == want
    assert turn_repair.digests(df.limit(0)).count() == 0 and turn_repair.repaired(df.drop("kind").limit(0)).count() == 0


def test_one_conversation_in_many_ranges(spark):
    rows = [(1, k, "user" if k % 3 else "assistant", f"text {k}." + "long " * (50_000 if k == 7 else 0)) for k in range(3000)] + [(1, 5000, "user", "again.")] * 2000 + [(2, 0, "user", "a.")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(9)
    got = {r["conv_id"]: r for r in turn_repair.audits(df).collect()}
    symbols = []
    seen = set()
    for _, t, r, x in sorted(rows[:-1], key=lambda r: r[1]):
        fault = turn_repair.DUPLICATE if (r, x) in seen else turn_repair.SOUND if x.rstrip()[-1] == "." else turn_repair.TRUNCATED
        seen.add((r, x))
        symbols.append(4 * {"user": turn_repair.USER, "assistant": turn_repair.ASSISTANT}[r] + fault)
    assert (got[1]["cost"], got[1]["audit"]) == plain(symbols)
    assert (got[1]["gaps"], got[1]["duplicate"], got[1]["truncated"]) == (2000, 1999, 1)
    assert got[2]["audit"] == "KI" and got[2]["cost"] == 2
