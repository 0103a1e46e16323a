"""URL filter: host segmentation by unigram Viterbi, then multinomial naive Bayes (operator 1).

Host labels are concatenations of words. Word counts come from the pages' own
text, words of any letters and any length; every substring of a label that is a
word is looked up by a join (no vocabulary goes to a task): substrings of up to
``PIECE`` characters are words themselves or the beginnings of longer ones,
which are then compared with the label. A Viterbi pass over one label's words
picks the likeliest split; an unknown stretch of any length is one piece. Its
cost is a label's length times the number of word lengths, so that labels of
any length are split. Tokens of a URL are the words of its host and the parts of its
path. Naive Bayes learns token counts from the URLs that a rule decides and
judges the others; its log odds are summed as integers, so that the order of
summation can't matter.

Rules (host, path): a rule fits its host and all subdomains if the path starts
with the rule's; the longest rule wins.

Defined results: a null url, or one without ``://``, has an empty host and path
and no tokens (the prior decides); equal URLs are judged alike and count once
in learning; without rule-decided URLs of both kinds every other verdict is
``allow``; labels are split in lower case; columns other than page_id, url and html are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

#: Longest substring that is looked up, and characters of a label that are taken at a time.
PIECE, STRETCH = 24, 512
MICRO = 1_000_000

# The rules.
RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


def host_of(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(F.coalesce(rest, F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for text, kind in sorted(rules, key=lambda r: len(r[0])):
        h, p = text.split("/", 1)
        fits = ((host == h) | host.endswith("." + h)) & path.startswith("/" + p)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def word_counts(pages: DataFrame) -> DataFrame:
    """word, n: words of letters and digits in the pages' visible text, lower-case."""
    text = F.lower(F.regexp_replace(F.coalesce("html", F.lit("")), r"(?is)<(script|style)\b.*?</\1>|<[^>]*>", " "))
    words = pages.select(F.explode(F.split(text, r"[^\p{L}\p{N}]+")).alias("word"))
    return words.where("word != ''").groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split_label(label: str, known: dict[str, int], total: int) -> list[str]:
    """The likeliest words of a label; an unknown stretch costs more the longer it is."""
    start, step = np.log(10 / total), np.log(10)
    lengths = sorted({len(w) for w in known}, reverse=True)
    best, back = [0.0] + [-np.inf] * len(label), [0] * (len(label) + 1)
    unknown, since = -np.inf, 0  # the best that ends in an unknown stretch, and where that begins
    for i in range(1, len(label) + 1):
        if best[i - 1] + start > unknown:
            unknown, since = best[i - 1] + start, i - 1
        unknown -= step
        best[i], back[i] = unknown, since
        for n in lengths:
            if n <= i and (count := known.get(label[i - n : i])) and best[i - n] + np.log(count / total) > best[i]:
                best[i], back[i] = best[i - n] + np.log(count / total), i - n
    words, i = [], len(label)
    while i:
        words.append(label[back[i] : i])
        i = back[i]
    return words[::-1]


def segment(labels: DataFrame, counts: DataFrame) -> DataFrame:
    """label, words (in lower case) for every distinct label."""
    total = max(1, counts.agg(F.sum("n")).first()[0] or 1)
    distinct = labels.select("label").distinct().where("label != ''").select("label", F.lower("label").alias("low"), F.xxhash64("label").alias("id"))
    # stretches overlap, so that each holds the pieces that begin in it; an id stands for the label, and what two labels of one id share does no harm
    cut = F.transform(F.sequence(F.lit(1), F.length("low"), F.lit(STRETCH)), lambda b: F.substring("low", b, F.lit(STRETCH + PIECE - 1)))
    stretch = distinct.select("id", F.explode(cut).alias("part"))
    pieces = F.flatten(F.transform(F.sequence(F.lit(1), F.length("part")), lambda b: F.transform(F.sequence(F.lit(1), F.least(F.lit(PIECE), F.length("part") - b + 1)), lambda n: F.substring("part", b, n))))
    asked = stretch.select("id", F.explode(F.array_distinct(pieces)).alias("piece"))
    short = asked.join(counts.where(F.length("word") <= PIECE), F.col("piece") == F.col("word")).select("id", "word", "n")
    begun = counts.where(F.length("word") > PIECE).withColumn("head", F.substring("word", 1, PIECE))
    longer = asked.where(F.length("piece") == PIECE).join(begun, F.col("piece") == F.col("head")).select("id", "word", "n").join(distinct, "id").where(F.contains("low", "word")).select("id", "word", "n")
    held = short.unionByName(longer).distinct().groupBy("id").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [split_label(x, {k["word"]: k["n"] for k in known or ()}, total) for x, known in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.list_(pa.string()))], names=["label", "words"])

    return distinct.join(held, "id", "left").select("label", "low", "known").mapInArrow(run, "label string, words array<string>")


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """page_id, host, path, rule, verdict, words (of the host) and log_odds (of block, from the method)."""
    parsed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    urls = parsed.select("host", "path").distinct()
    labels = urls.select("host").distinct().select("host", F.posexplode(F.split("host", r"[.\-_]")).alias("at", "label"))
    split = segment(labels.select("label"), materialise(word_counts(pages), "words"))
    hosts = labels.join(split, "label").groupBy("host").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])).alias("words"))
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    words = F.transform(F.coalesce("words", F.array().cast("array<string>")), lambda w: F.concat(F.lit("host:"), w))
    parts = F.transform(F.filter(F.split("path", r"[^\p{L}\p{N}]+"), lambda w: w != ""), lambda w: F.concat(F.lit("path:"), w))
    known = materialise(urls.join(hosts, "host", "left").select("host", "path", "words", rule.alias("rule"), verdict.alias("ruled"), F.concat(words, parts).alias("tokens")), "urls")

    # counts of the two kinds, and the log odds of a token in millionths
    learnt = known.where("ruled is not null")
    size = learnt.agg(*(F.coalesce(F.sum(F.when(F.col("ruled") == k, 1)), F.lit(0)).alias(k) for k in ("block", "allow"))).first()
    counts = learnt.select("ruled", F.explode("tokens").alias("token")).groupBy("token").agg(*(F.count(F.when(F.col("ruled") == k, 1)).alias(k) for k in ("block", "allow")))
    if size["block"] and size["allow"]:
        all_of = counts.agg(F.count(F.lit(1)).alias("v"), *(F.coalesce(F.sum(k), F.lit(0)).alias(k) for k in ("block", "allow"))).first()
        share = lambda k: F.log((F.col(k) + 1) / (all_of[k] + all_of["v"] + 1))
        odds = materialise(counts.select("token", F.round((share("block") - share("allow")) * MICRO).cast("long").alias("odds")), "odds")
        unseen = round((np.log(1 / (all_of["block"] + all_of["v"] + 1)) - np.log(1 / (all_of["allow"] + all_of["v"] + 1))) * MICRO)
        prior = round(np.log(size["block"] / size["allow"]) * MICRO)
        tokens = known.select("host", "path", F.explode("tokens").alias("token"))
        sums = tokens.join(odds, "token", "left").groupBy("host", "path").agg(F.sum(F.coalesce("odds", F.lit(unseen))).alias("s"))
        judged = known.join(sums, ["host", "path"], "left").withColumn("log_odds", (F.coalesce("s", F.lit(0)) + F.lit(prior)) / MICRO)
    else:
        judged = known.withColumn("log_odds", F.lit(0.0))
    judged = judged.select("host", "path", "rule", F.coalesce("ruled", F.when(F.col("log_odds") > 0, "block").otherwise("allow")).alias("verdict"), F.coalesce("words", F.array().cast("array<string>")).alias("words"), "log_odds")
    return parsed.select("page_id", "host", "path").join(judged, ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "words", "log_odds")
