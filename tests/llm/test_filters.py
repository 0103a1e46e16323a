import random
import re

import numpy as np
import pyarrow as pa
import pytest

from scorelab.llm import license_scan, merkle_audit, mil_quality, url_filter
from scorelab.llm.bytewords import text_buffers

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
FOLD = {c: c + 32 for c in range(65, 91)}


# URLs

URLS = [
    None, "", "no scheme", "http://", "HTTP://Example.NET", "http://a.example.net/en/1", "http://example.net/en", "https://example.com/de/x?q=/fr/", "http://x.example.com/de/",
    "http://badexample.com/de/", "ftp://a.org/fr/://b", "http://org/fr/", "//x", "http://bluebird.example.com/news/page", "http://bluebird.example.com/news/page", "http://a.net#x", "http://é.net/É?x",
    "http://" + "a" * 5000 + ".com/" + "b/" * 2000, "http://a..com//", "http://x.net\n/en/", "http://ÀB.ORG/fr/",
]


def brute_url(u):
    host = path = ""
    if u and "://" in u:
        host, path = re.match(r"(?s)([^/?#]*)([^?#]*)", u.split("://", 1)[1]).groups()
        host = host.translate(FOLD)
    fits = [(len(r), r, v) for r, v in url_filter.RULES for h, p in [r.split("/", 1)] if (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    return host, path, *(max(fits)[1:] if fits else (None, None))


def pages(spark, urls, html="<p>blue bird blue bird news page</p><script>bluebird()</script>"):
    return spark.createDataFrame([(i, u, html if i % 3 else None, "w", 1) for i, u in enumerate(urls)], "page_id long, url string, html string, words string, host int")


def test_rules_equal_brute_force(spark):
    got = {r["page_id"]: r for r in url_filter.judge(pages(spark, URLS)).collect()}
    assert len(got) == len(URLS)
    for i, u in enumerate(URLS):
        host, path, rule, verdict = brute_url(u)
        r = got[i]
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == verdict if rule else r["verdict"] in ("allow", "block")
    assert got[13]["words"] == ["blue", "bird", "example", "com"] and got[13]["verdict"] == got[14]["verdict"]


def test_split_is_the_likeliest():
    known = {"blue": 10, "bird": 8, "bluebi": 1, "rd": 1, "a": 50}
    assert url_filter.split_label("bluebirda", known, 100) == ["blue", "bird", "a"]
    assert url_filter.split_label("zzz", known, 100) == ["zzz"]
    assert url_filter.split_label("", known, 100) == []


def test_split_equals_every_split():
    rng = random.Random(6)
    for _ in range(300):
        known = {"".join(rng.choice("abé") for _ in range(rng.randint(1, 5))): rng.randint(1, 50) for _ in range(6)}
        total = sum(known.values()) + 20
        label = "".join(rng.choice("abé") for _ in range(rng.randint(1, 9)))
        gain = lambda p: np.log(known[p] / total) if p in known else np.log(10 / total) - len(p) * np.log(10)
        every = []
        for cuts in range(1 << (len(label) - 1)):
            at = [0, *(i + 1 for i in range(len(label) - 1) if cuts >> i & 1), len(label)]
            every.append(sum(gain(label[a:b]) for a, b in zip(at, at[1:])))
        made = url_filter.split_label(label, known, total)
        assert "".join(made) == label and sum(map(gain, made)) == pytest.approx(max(every))


def test_labels_and_words_of_any_length_and_script(spark):
    """Once, labels over 63 characters stayed whole, and words over 24 or beyond ASCII were unknown."""
    long = "donaudampfschifffahrtsgesellschaft"
    hosts = ["nachrichtenheute" * 4, "nachrichtenheute", long + "heute", "новостисегодня", "heute" * 400, "q" * 3000]
    html = f"<p>nachrichten heute Nachrichten heute {long} новости Сегодня {'z' * 200}</p>"
    got = {r["host"]: r["words"] for r in url_filter.judge(pages(spark, [f"http://{h}.de/x" for h in hosts], html)).collect()}
    assert got[hosts[0] + ".de"] == ["nachrichten", "heute"] * 4 + ["de"] and got[hosts[1] + ".de"] == ["nachrichten", "heute", "de"]
    assert got[hosts[2] + ".de"] == [long, "heute", "de"] and got[hosts[3] + ".de"] == ["новости", "сегодня", "de"]
    assert got[hosts[4] + ".de"] == ["heute"] * 400 + ["de"] and got[hosts[5] + ".de"] == ["q" * 3000, "de"]


def test_bayes_equals_brute_force(spark):
    urls = [f"http://{w}.net/{p}" for w in ("aa", "bb") for p in ("x", "y")] + [f"http://{w}.org/fr/{p}" for w in ("cc", "aa") for p in ("x", "z")] + ["http://aa.com/x", "http://cc.com/z", "http://cc.com/new"]
    got = {r["page_id"]: r for r in url_filter.judge(pages(spark, urls)).collect()}
    tokens = {u: [f"host:{w}" for w in got[i]["words"]] + [f"path:{p}" for p in re.split(r"\W+", got[i]["path"]) if p] for i, u in enumerate(urls)}
    kinds = {u: brute_url(u)[3] for u in urls}
    count = {k: {} for k in ("block", "allow")}
    for u in urls:
        if kinds[u]:
            for t in tokens[u]:
                count[kinds[u]][t] = count[kinds[u]].get(t, 0) + 1
    v = len(set(count["block"]) | set(count["allow"]))
    n = {k: sum(c.values()) for k, c in count.items()}
    docs = {k: sum(x == k for x in kinds.values()) for k in count}
    for i, u in enumerate(urls):
        share = lambda k, t: np.log((count[k].get(t, 0) + 1) / (n[k] + v + 1))
        want = np.log(docs["block"] / docs["allow"]) + sum(share("block", t) - share("allow", t) for t in tokens[u])
        assert got[i]["log_odds"] == pytest.approx(want, abs=1e-5)
        assert got[i]["verdict"] == (kinds[u] or ("block" if want > 0 else "allow"))


def test_urls_without_learning_or_rows(spark):
    assert url_filter.judge(pages(spark, [])).count() == 0
    assert [r["verdict"] for r in url_filter.judge(pages(spark, ["http://a.com/x", None])).collect()] == ["allow", "allow"]


# licenses


def brute_base(t):
    w = WORD.findall((t or "").translate(FOLD))
    at, labels = [], set()
    for phrase, label in license_scan.PHRASES.items():
        p = phrase.split()
        here = [i for i in range(len(w) - len(p) + 1) if w[i : i + len(p)] == p]
        at += here
        labels |= {label} if here else set()
    return len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))


def test_license_base_equals_brute_force(spark):
    rng = random.Random(2)
    vocab = "mit license apache general public of the MIT License, gnu é 2.0".split()
    texts = [None, "", "license", "mit", "MIT license mit license", "general public public license", "mit\nlicense" * 3] + [" ".join(rng.choice(vocab) for _ in range(rng.randint(0, 60))) for _ in range(150)]
    texts += [texts[-1], "word " * 50_000 + "apache license"]
    df = spark.createDataFrame([(i // 2, t, "x", 3) for i, t in enumerate(texts)], "doc_id long, text string, label string, row int")
    got = sorted(tuple("~" if x is None else x for x in (r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"])) for r in license_scan.digests(df).collect())
    assert got == sorted(tuple("~" if x is None else x for x in (i // 2, *brute_base(t))) for i, t in enumerate(texts))


def test_notices_are_found_with_words_put_in_or_left_out(spark):
    notice = next(n for n, label in license_scan.NOTICES.items() if label == "bsd").split()
    whole = " ".join(notice)
    edited = " ".join([*notice[:6], "quite", *notice[6:14], *notice[15:]])
    half = " ".join(notice[:9])
    spread = " x y z q r s ".join(notice)
    df = spark.createDataFrame(list(enumerate([f"a b {whole} c", edited.upper(), half, spread, f"mit license. {whole}"])), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.digests(df).collect()}
    assert [got[i]["labels"] for i in range(5)] == ["bsd", "bsd", "", "", "bsd,mit"]
    assert [got[i]["base_labels"] for i in range(5)] == ["", "", "", "", "mit"]
    assert got[0]["score"] == 1 and got[4]["score"] == 1 and 0 < got[2]["score"] < license_scan.COVER and got[3]["score"] == 0
    spans = {r["doc_id"]: [(s["first_word"], s["last_word"]) for s in r["spans"]] for r in license_scan.scan(df).collect()}
    assert spans[0] == [(2, 1 + len(notice))]
    assert license_scan.digests(df.limit(0)).count() == 0


def test_repeated_notices_and_notices_beside_partial_ones_are_found(spark):
    texts, want = [], []
    for notice, label in license_scan.NOTICES.items():
        w = notice.split()
        some, tail = " ".join(w[: len(w) // 2 + 1]), " ".join(w[len(w) // 2 :])
        for made, copies in ((f"{notice} {notice}", 2), (f"{notice} x {notice}", 2), (f"{notice} " * 9, 9), (f"{notice} some {tail}", 1), (f"{some} {notice}", 1), (f"{notice} {some} x {notice}", 2)):
            texts.append(made)
            want.append((notice, label, copies))
    texts += ["all rights x rights reserved all x rights all rights", "filler " * 9 + "all rights reserved some rights reserved " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["doc_id"]: r for r in license_scan.digests(df).collect()}
    spans = {r["doc_id"]: r["spans"] for r in license_scan.scan(df).collect()}
    numbers = {n: i + license_scan.PHRASE_COUNT for i, n in enumerate(license_scan.NOTICES)}
    for i, (notice, label, copies) in enumerate(want):
        assert label in got[i]["labels"].split(",") and got[i]["score"] == 1, texts[i]
        here = [(s["first_word"], s["last_word"]) for s in spans[i] if s["template"] == numbers[notice]]
        words = texts[i].split()
        whole = [(k, k + len(notice.split()) - 1) for k in range(len(words)) if words[k : k + len(notice.split())] == notice.split()]
        assert len(whole) == copies and len(here) >= copies, texts[i]
        if len(notice.split()) < 5:
            assert set(whole) <= set(here), texts[i]
    assert got[len(want) + 1]["labels"] == "reserved" and len(spans[len(want) + 1]) == 3000


def test_templates_of_any_length(spark):
    """Whole license texts, and a template of 1,500 words, also edited, repeated and in pieces."""
    rng = random.Random(11)
    long = " ".join(rng.choice([f"w{i}" for i in range(400)]) for _ in range(1500))
    w = long.split()
    edited = " ".join([*w[:200], "put", "in", *w[200:700], *w[720:]])
    mit = next(t for t, label in license_scan.TEXTS.items() if label == "mit")
    texts = [f"a {long} b", edited, " ".join(w[:900]), f"{long} {long} {edited}", f"MIT License. Copyright (c) {mit.upper()}", " ".join(mit.split()[:100])]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(df, license_scan.PHRASES, license_scan.NOTICES | license_scan.TEXTS | {long: "own"}).collect()}
    number = license_scan.PHRASE_COUNT + len(license_scan.NOTICES | license_scan.TEXTS)
    own = {d: [(s["first_word"], s["last_word"]) for s in r["spans"] if s["template"] == number] for d, r in found.items()}
    assert own[0] == [(1, 1500)] and len(own[1]) == 1 and own[2] == [] and found[2]["best"] == pytest.approx(899 / 1499)
    assert len(own[3]) == 3 and own[3][0] == (0, 1499) and own[3][1] == (1500, 2999)
    labels = {d: {s["label"] for s in r["spans"]} for d, r in found.items()}
    assert labels[4] == {"mit"} and labels[5] == {"mit"} and max(s["last_word"] - s["first_word"] for s in found[4]["spans"]) > 150


def test_long_chains_split_in_linear_time():
    import time

    one = [(k * 3, 0, 1 << k % 3) for k in range(16_000)]
    began = time.perf_counter()
    license_scan.split_chain(one, 3)
    assert time.perf_counter() - began < 2


# archives


def replica(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, hash string, node int")


def test_audit_finds_exactly_the_damage(spark, monkeypatch):
    monkeypatch.setattr(merkle_audit, "RANGE", 1 << 13)
    rng = random.Random(1)
    rows = [(i, f"u{i}", "x" * rng.randint(0, 3000), "h", 1) for i in range(1500)]
    rows += [(None, None, None, None, None)] + [(7, None, "", None, None)] * 2 + [(2000, "long", "y" * 3_000_000, None, None)]
    bad = [list(r) for r in rows]
    hit = {3, 4, 700, 1499}
    for r in bad:
        if r[0] in hit and r[1]:
            r[2] = "z" + r[2][1:] if r[2] else r[2]
    changed = {a[0] for a, b in zip(rows, bad) if a[2] != b[2]}
    a, b = merkle_audit.archive(replica(spark, rows).repartition(3)), merkle_audit.archive(replica(spark, [tuple(r) for r in bad]).repartition(5))
    offsets = sorted((r["offset"], r["length"]) for r in a.collect())
    assert all(o + n == p for (o, n), (p, _) in zip(offsets, offsets[1:])) and offsets[0][0] == 0
    got = merkle_audit.audit(a, b).collect()
    assert {r["page_id"] for r in got} == changed and {r["status"] for r in got} == {"changed"}
    left = merkle_audit.ranged(a)
    right = merkle_audit.realigned(b, left)
    assert right.where("page_id is not null").join(left, ["page_id", "offset", "hash"]).where(left["node"] != right["node"]).count() == 0
    ranges, compared = merkle_audit.differing_ranges(merkle_audit.tree(left), merkle_audit.tree(right))
    nodes = merkle_audit.tree(left).count()
    assert ranges.count() <= len(changed) and compared < nodes
    lost = b.where("page_id is null or page_id != 3")
    assert {(r["page_id"], r["status"]) for r in merkle_audit.audit(a, lost).collect()} == {(p, "changed") for p in changed - {3}} | {(3, "missing")}
    assert ("extra", 3) in {(r["status"], r["page_id"]) for r in merkle_audit.audit(lost, a).collect()}


def test_a_lost_record_is_one_row(spark, monkeypatch):
    """Offsets of all later records move; once, thousands of rows were reported."""
    monkeypatch.setattr(merkle_audit, "RANGE", 1 << 13)
    rng = random.Random(9)
    rows = [(i, f"u{i}", "x" * rng.randint(0, 3000), None, None) for i in range(2000)] + [(50, "u50", "twice", None, None)] * 3
    a = merkle_audit.archive(replica(spark, rows).repartition(3))
    told = lambda b: sorted((r["page_id"], r["status"]) for r in merkle_audit.audit(a, b).collect())
    b = merkle_audit.archive(replica(spark, rows[:700] + rows[701:]).repartition(4))
    assert told(b) == [(700, "missing")]
    left = merkle_audit.ranged(a)
    ranges, compared = merkle_audit.differing_ranges(merkle_audit.tree(left), merkle_audit.tree(merkle_audit.realigned(b, left)))
    assert ranges.count() <= 2 and compared < 120
    more = rows[:300] + [(300, "u300", "changed to some other length", None, None), *rows[301:-1], (2500, "new", "n" * 90_000, None, None), (-4, "first", "", None, None)]
    assert told(merkle_audit.archive(replica(spark, more))) == [(-4, "extra"), (50, "missing"), (300, "changed"), (2500, "extra")]


def test_audit_of_equal_and_empty_archives(spark):
    a = merkle_audit.archive(replica(spark, [(1, "u", "x", None, None), (2, "v", None, None, None)]))
    empty = merkle_audit.archive(replica(spark, []))
    assert merkle_audit.audit(a, a).count() == 0 and merkle_audit.audit(empty, empty).count() == 0
    assert {r["status"] for r in merkle_audit.audit(a, empty).collect()} == {"missing"}
    assert merkle_audit.audit(empty, a).count() == 2


def test_record_bytes(spark):
    df = replica(spark, [(5, "http://é", "<p>ü</p>", None, None)])
    got = bytes(df.select(merkle_audit.warc_record(df["page_id"], df["url"], df["html"])).first()[0])
    assert got == "WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:5>\r\nWARC-Target-URI: http://é\r\nContent-Length: 9\r\n\r\n<p>ü</p>\r\n\r\n".encode()


# quality


def test_passage_inputs():
    data, offs = text_buffers(pa.array(["", "one TWO 3 " * 100, None, "x"]))
    x, begin = mil_quality.encode_passages(data, offs)
    assert begin.tolist() == [0, 1, 6, 7, 8] and not x[0].any() and not x[6].any()
    assert (x[1:6, mil_quality.GROUPS + 1] > 0.25).all()


def test_learns_which_passages_count():
    """Bags differ in one passage only; attention has to find it."""
    rng = np.random.default_rng(0)
    bags, labels = [], []
    for i in range(300):
        x = rng.normal(0, 0.2, (rng.integers(2, 9), mil_quality.INPUTS)).astype(np.float32)
        labels.append(i % 2)
        if i % 2:
            x[rng.integers(len(x)), :5] += 2
        bags.append(x)
    model = mil_quality.train(bags[:200], np.array(labels[:200], np.float32))
    begin = np.cumsum([0, *map(len, bags[200:])])
    found = model.score(np.concatenate(bags[200:]), begin)
    assert ((found > 0.5) == np.array(labels[200:])).mean() > 0.95


def test_forward_pass_and_gradient_equal_plain_ones():
    """Passage by passage, and by finite differences."""
    rng = np.random.default_rng(4)
    bags = [rng.normal(size=(k, mil_quality.INPUTS)) for k in (1, 3, 5)]
    labels = np.array([1.0, 0.0, 1.0])
    shapes = {"mean": (mil_quality.INPUTS,), "E": (mil_quality.INPUTS, 4), "e": (4,), "V": (4, 3), "U": (4, 3), "a": (3,), "c": (4,)}
    w = {k: rng.normal(size=s) * 0.4 for k, s in shapes.items()} | {"b": np.float64(0.2)}

    def plain(w):
        out = []
        for bag in bags:
            hs = [np.tanh(sum((x[i] - w["mean"][i]) * w["E"][i] for i in range(len(x))) + w["e"]) for x in bag]
            logits = [sum(w["a"][k] * np.tanh(h @ w["V"][:, k]) / (1 + np.exp(-(h @ w["U"][:, k]))) for k in range(3)) for h in hs]
            share = np.exp(logits) / np.exp(logits).sum()
            out.append(1 / (1 + np.exp(-(sum(s * h for s, h in zip(share, hs)) @ w["c"] + w["b"]))))
        return np.array(out)

    x, begin = np.concatenate(bags), np.array([0, 1, 4, 9])
    assert mil_quality.Model(w).score(x, begin) == pytest.approx(plain(w))
    loss = lambda w: -np.mean(labels * np.log(plain(w)) + (1 - labels) * np.log(1 - plain(w)))
    gradient = mil_quality.Model(w).gradient(x, begin, labels)
    for name in ("E", "e", "V", "U", "a", "c", "b"):
        for at in [tuple(rng.integers(n) for n in np.shape(w[name])) for _ in range(4)]:
            up, down = ({**w, name: np.array(w[name], float)} for _ in range(2))
            up[name][at] += 1e-6
            down[name][at] -= 1e-6
            assert np.asarray(gradient[name])[at] == pytest.approx((loss(up) - loss(down)) / 2e-6, abs=1e-7), name


def test_gradients_do_not_depend_on_missing_classes():
    one = [np.ones((2, mil_quality.INPUTS), np.float32)]
    assert mil_quality.train(one, np.ones(1, np.float32)).prior == 1.0
    assert mil_quality.train([], np.zeros(0, np.float32)).score(one[0], np.array([0, 2])).tolist() == [0.5]


def test_held_out_accuracy(spark):
    from scorelab.llm.common import table

    sf = "/root/testdata/sf0.01"
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    got = mil_quality.judged(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert len(got) > 50 and np.mean([r["quality"] == r["predicted"] for r in got]) > 0.95


def test_quality_of_odd_rows(spark):
    good, bad = "A plain line of words. ", "$$$ ### %%% "
    rows = [(i, (good if i % 2 else bad) * (1 + i % 5), "s", 1.0) for i in range(60)] + [(100, None, None, None), (101, "", "", 0.0), (None, good, None, None), (103, good * 20_000, None, None), (3, good, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, body string, score double")
    labels = spark.createDataFrame([(i, i % 2, None, "x") for i in range(60)] + [(0, 1, None, None), (5, None, None, None), (None, 1, None, None)], "doc_id long, quality int, toxic int, text string")
    got = mil_quality.judged(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[103]["predicted"] == 1 and by[2]["predicted"] == 0
    kept = mil_quality.keep_good(docs, labels)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {r["doc_id"] for r in got if r["predicted"]}
    none = labels.limit(0)
    assert {r["score"] for r in mil_quality.judged(docs, none).collect()} == {0.5}
    assert mil_quality.judged(docs.limit(0), labels).count() == 0
