"""The registered queries of this package, and their DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return put


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op4_huffman_ids")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import huffman_ids

    return huffman_ids.digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


@query("op8_byte_bpe")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import bpe_codec

    return bpe_codec.digests(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


_ASCII = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), {az}), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(az=_ASCII)


@query("op6_decontaminate", rf"""
with d as (select doc_id, {_WORDS} w from documents),
b as (select cast(item_id as varchar) item, {_WORDS} w from benchmark),
win as (select item, least(13, len(w)) n, unnest(list_transform(range(1, len(w) - least(13, len(w)) + 2), lambda i: array_to_string(w[i:i + least(13, len(w)) - 1], ' '))) g from b where len(w) > 0),
sizes as (select distinct n from win),
grams as (select doc_id, n, unnest(range(1, len(w) - n + 2)) i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) g from d, sizes where len(w) >= n),
hits as (select grams.doc_id, grams.i, grams.n, win.item from grams join win on grams.n = win.n and grams.g = win.g),
words as (select doc_id, count(distinct p) n_hit from (select doc_id, unnest(range(i, i + n)) p from hits) group by doc_id),
found as (select doc_id, count(*) n_items, string_agg(item, ',' order by item collate "binary") s from (select distinct doc_id, item from hits) group by doc_id)
select d.doc_id, cast(len(w) as bigint) n_words, coalesce(n_hit, 0) n_hit, coalesce(n_items, 0) n_items, sha256(coalesce(s, '')) items_sha256,
  (coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w)) contaminated
from d left join words using (doc_id) left join found using (doc_id)
""".replace(' collate "binary"', ""))
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import decontam

    return decontam.digests(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query("op10_jaccard_join")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import jaccard_join

    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


@query("op3_mil_quality")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import mil_quality

    return mil_quality.judged(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op9_impact_topk", """
with v as (select vec_id, list_transform(embedding, lambda x: cast(floor(256.0 * cast(x as double)) as double)) v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id query_id, c.vec_id, cast(list_inner_product(q.v, c.v) as bigint) score from v q join v c on q.vec_id % 50 = 0 and c.vec_id <> q.vec_id),
r as (select *, cast(row_number() over (partition by query_id order by score desc, vec_id) as integer) as "rank" from s)
select query_id, "rank", vec_id, score from r where "rank" <= 5
""")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import impact_topk

    return impact_topk.top_k(table(spark, sf_dir, "embeddings"))


@query("op7_license_scan")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import license_scan

    return license_scan.digests(table(spark, sf_dir, "documents"))


@query("op1_url_filter")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import url_filter

    return url_filter.judge(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict", "log_odds")


@query("op2_length_histogram")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import length_histogram

    return length_histogram.histogram(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.tiktoken"))


@query("op5_merkle_audit", r"""
with p as (select page_id, coalesce(url, '') url, coalesce(html, '') html from pages),
n as (select page_id, html, strlen('WARC/1.1rnWARC-Type: responsernWARC-Record-ID: <urn:page:') + strlen(coalesce(cast(page_id as varchar), '')) + strlen('>rnWARC-Target-URI: ') + strlen(url)
  + strlen('rnContent-Length: ') + strlen(cast(strlen(html) as varchar)) + 4 + strlen(html) + 4 as n from p),
o as (select page_id, html, n, sum(n) over (order by page_id nulls first, n rows between unbounded preceding and current row) - n as o from n)
select cast(o as bigint) "offset", page_id, cast(n as bigint) "length", 'changed' status from o
where starts_with(md5(cast(page_id as varchar)), '00') and strlen(substring(html, 1, 1)) = 1
""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import merkle_audit

    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return merkle_audit.audit(merkle_audit.archive(pages), merkle_audit.archive(merkle_audit.damaged_copy(pages), "replica"))


_BLANKS = "concat(chr(32), chr(9), chr(10), chr(11), chr(12), chr(13))"


@query("op11_line_dedup", f"""
with d as (select doc_id, string_split(coalesce(text, ''), chr(10)) l from documents),
e as (select doc_id, unnest(l) line, generate_subscripts(l, 1) pos from d),
k as (select *, translate(trim(line, {_BLANKS}), {_ASCII}) k from e),
s as (select k, max(doc_id) last_doc from k where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
j as (select k.doc_id, k.pos, k.line, (s.k is not null and k.doc_id <> s.last_doc) gone from k left join s on k.k = s.k)
select doc_id, count(*) n_lines, count(*) filter (gone) n_dropped, sha256(coalesce(string_agg(line, chr(10) order by pos) filter (not gone), '')) kept_sha256 from j group by doc_id
""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import line_dedup

    return line_dedup.digests(table(spark, sf_dir, "documents"))


@query("op12_fill_middle", """
with d as (select doc_id, coalesce(text, '') t, length(coalesce(text, '')) n, sha256('1:' || coalesce(cast(doc_id as varchar), '')) x from documents),
h as (select *, cast('0x' || x[1:8] as bigint) h1, cast('0x' || x[9:16] as bigint) h2, cast('0x' || x[17:24] as bigint) h3, cast('0x' || x[25:32] as bigint) h4 from d),
c as (select *, least(h1 % (n + 1), h2 % (n + 1)) a, greatest(h1 % (n + 1), h2 % (n + 1)) b,
  case when n = 0 or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 90 then 'plain' when h4 % 100 < 20 then 'spm' else 'psm' end form from h),
p as (select *, substring(t, 1, a) pre, substring(t, a + 1, b - a) mid, substring(t, b + 1) suf from c)
select doc_id, n, form, case when form <> 'plain' then a end prefix_chars, case when form <> 'plain' then b - a end middle_chars,
  sha256(case form when 'plain' then t when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid else '<S>' || suf || '<P>' || pre || '<M>' || mid end) output_sha256, sha256(t) restored_sha256 from p
""")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import fill_middle

    return fill_middle.digests(table(spark, sf_dir, "documents"))


def _cheapest(own: bool) -> str:
    """The step of the repair's recursion for the four states: each value is (cost, audit) of what is left, compared in that order."""
    edit = lambda cost, letter, to: f"{{'c': {cost} + {to}.c, 's': '{letter}' || {to}.s}}"
    if not own:
        return ", ".join(f"least({x}) w{k}" for k, x in enumerate([
            f"o0, {edit(2, 'I', 'o2')}, {edit(4, 'II', 'o3')}", f"o1, {edit(2, 'I', 'o2')}, {edit(4, 'II', 'o3')}", f"o2, {edit(2, 'I', 'o3')}", f"o3, {edit(2, 'I', 'o2')}"]))
    more = "(case when fault = 'truncated' then 1 else 0 end)"
    free = "fault in ('', 'truncated')"
    to = lambda state, filled, kept: f"least({edit(3, 'D', f'w{state}')}, case when {free} then {edit(f'2 + {more}', 'R', filled)} end, " + ", ".join(f"case when {free} and initial = '{i}' then {edit(more, 'K', t)} end" for i, t in kept) + f") o{state}"
    return ", ".join([to(0, "w2", [("s", "w1"), ("u", "w2")]), to(1, "w2", [("u", "w2")]), to(2, "w3", [("a", "w3")]), to(3, "w2", [("u", "w2")])])


@query("op13_turn_repair", f"""
with recursive tab as (select list(list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, cast(i as bigint)) order by i) t from range(256) r(i)),
base as (select conv_id, turn, coalesce(role, ' ') role, coalesce(text, ' ') text,
  xor(list_reduce(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''), lambda x: cast(ord(x) as bigint)), lambda c, b: xor(c >> 8, t[cast((xor(c, b) & 255) + 1 as integer)]), cast(4294967295 as bigint)), 4294967295) % 20 kind
  from conversations, tab),
hurt as (select conv_id, turn, case when kind = 4 then 'user' else role end role, case when kind = 1 then '' when kind = 2 then replace(replace(replace(text, '.', ''), '!', ''), '?', '') else text end text
  from (select *, unnest(range(case kind when 0 then 0 when 3 then 2 else 1 end)) from base)),
numbered as (select *, row_number() over (partition by conv_id order by turn nulls first, role, sha256(text)) n, rtrim(text, {_BLANKS}) inked, role[1:1] initial from hurt),
r as (select *, lag(initial) over (partition by conv_id order by n) || initial pair,
  case when inked = '' then 'blank' when row_number() over (partition by conv_id, role, text order by n) > 1 then 'duplicate' when inked[-1:] not in ('.', '!', '?') then 'truncated' else '' end fault from numbered),
g as (select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) gaps, count(*) n_rows, count(*) filter (fault = 'blank') blank, count(*) filter (fault = 'duplicate') duplicate,
  count(*) filter (fault = 'truncated') truncated, count(*) filter (pair not in ('su', 'ua', 'au')) illegal from r group by conv_id),
dp as (select conv_id, n_rows n, {{'c': cast(0 as bigint), 's': ''}} w0, {{'c': cast(4 as bigint), 's': 'II'}} w1, {{'c': cast(2 as bigint), 's': 'I'}} w2, {{'c': cast(0 as bigint), 's': ''}} w3 from g
  union all select conv_id, n - 1, {_cheapest(False)} from (select dp.conv_id, dp.n, {_cheapest(True)} from dp join r on r.conv_id is not distinct from dp.conv_id and r.n = dp.n)),
best as (select conv_id, w0.c cost, w0.s audit from dp where n = 0),
edits as (select conv_id, j, letter, count(*) filter (letter <> 'I') over w n, count(*) filter (letter <> 'D') over w o from (select conv_id, unnest(string_split(audit, '')) letter, generate_subscripts(string_split(audit, ''), 1) j from best where audit <> '') window w as (partition by conv_id order by j)),
opening as (select e.conv_id from edits e join r on r.conv_id is not distinct from e.conv_id and r.n = e.n where e.letter = 'K' and e.o = 1 and r.initial = 's'),
made as (select e.conv_id, e.j, case when e.letter = 'K' then r.role when (e.o + (case when p.found then 1 else 0 end)) % 2 = 1 then 'user' else 'assistant' end || ':' || case when e.letter = 'I' then '' else r.text end line
  from edits e left join r on r.conv_id is not distinct from e.conv_id and r.n = e.n left join (select conv_id, true found from opening) p on p.conv_id is not distinct from e.conv_id where e.letter <> 'D'),
texts as (select conv_id, string_agg(line, chr(10) order by j) t from made group by conv_id)
select i.conv_id, coalesce(gaps, 0) gaps, coalesce(blank, 0) blank, coalesce(duplicate, 0) duplicate, coalesce(truncated, 0) truncated, coalesce(illegal, 0) illegal, coalesce(cost, 0) cost, coalesce(audit, '') audit, sha256(coalesce(t, '')) repaired_sha256
from (select distinct conv_id from conversations) i left join g on g.conv_id is not distinct from i.conv_id left join best on best.conv_id is not distinct from i.conv_id left join texts on texts.conv_id is not distinct from i.conv_id
""")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import turn_repair

    return turn_repair.digests(table(spark, sf_dir, "conversations"))
