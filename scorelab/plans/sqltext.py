"""DuckDB twins of the fixtures and distribution helpers (oracle text only).

These strings are what the correctness oracle runs next to the Spark
queries; they are never executed by the library itself.
"""

from __future__ import annotations

import math


def U(s: str) -> str:
    return f"(cast(('0x'||substr(md5({s}),1,8)) as bigint) / 4294967296.0)"


def erf(x: str) -> str:
    ax = f"abs({x})"
    series = f"exp(-{ax}*{ax})*list_sum([pow({ax},2*n+1)/gamma(n+1.5) for n in range(0,121)])"
    return f"(case when {x} is null then null when {ax} > 6.0 then sign({x}) else sign({x})*least(1.0, {series}) end)"


def digamma(x: str) -> str:
    x = f"cast({x} as double)"
    y = f"({x} + 6.0)"
    z = f"(1.0 / ({y} * {y}))"
    series = f"(ln({y}) - 0.5 / {y} - {z} * (1.0/12 - {z} * (1.0/120 - {z} * (1.0/252 - {z} * (1.0/240 - {z} * (1.0/132))))))"
    return f"({series} - (" + " + ".join(f"1.0 / ({x} + {i}.0)" for i in range(6)) + "))"


def norm_sf(z: str) -> str:
    return f"(0.5*(1.0 - {erf(f'(({z})/{math.sqrt(2.0)!r})')}))"


def chi2_sf(x: str, dof: str) -> str:
    a = f"(({dof})/2.0)"
    z = f"(({x})/2.0)"
    lower = f"list_sum([exp(-{z} + ({a}+n)*ln({z}) - lgamma({a}+n+1)) for n in range(0,1001)])"
    return (
        f"(case when ({x}) is null or ({dof}) is null then null when ({x}) <= 0 then 1.0 "
        f"when ({dof}) = 1 then 1.0 - {erf(f'sqrt({z})')} when ({dof}) = 2 then exp(-{z}) "
        f"when {z} > {a} + 400.0 then 0.0 else greatest(0.0, 1.0 - {lower}) end)"
    )


def binom_cdf_half(k: str, n: str) -> str:
    return (
        f"(case when ({k}) < 0 then 0.0 else list_sum([exp(lgamma(({n})+1)-lgamma(i+1)-lgamma(({n})-i+1)) "
        f"for i in range(0, cast({k} as bigint)+1)]) / pow(2.0, {n}) end)"
    )


def t_sf2(t: str, dof: str) -> str:
    th = f"atan(abs({t})/sqrt({dof}))"
    c2 = f"(cos({th})*cos({th}))"
    even = (
        f"list_sum([exp(lgamma(j+0.5)-lgamma(0.5)-lgamma(j+1))*pow({c2}, j) "
        f"for j in range(0, greatest(0, (cast({dof} as bigint)-2)//2)+1)])"
    )
    odd = (
        f"list_sum([exp(lgamma(j+1)-lgamma(1)+lgamma(1.5)-lgamma(j+1.5))*pow({c2}, j) "
        f"for j in range(0, greatest(0, (cast({dof} as bigint)-3)//2)+1)])"
    )
    a_even = f"(sin({th})*{even})"
    a_odd = f"(case when {dof} = 1 then {2.0 / math.pi!r}*{th} else {2.0 / math.pi!r}*({th} + sin({th})*cos({th})*{odd}) end)"
    exact = f"least(1.0, greatest(0.0, 1.0 - (case when cast({dof} as bigint) % 2 = 0 then {a_even} else {a_odd} end)))"
    return (
        f"(case when ({t}) is null or ({dof}) is null or ({dof}) < 1 then null "
        f"when ({dof}) > 200000 then 2.0*{norm_sf(f'abs({t})')} else {exact} end)"
    )


def ks_sf(lam: str) -> str:
    s = f"list_sum([pow(-1.0, k-1)*exp(-2.0*k*k*({lam})*({lam})) for k in range(1,101)])"
    return f"(case when ({lam}) is null then null when ({lam}) < 0.2 then 1.0 else least(1.0, greatest(0.0, 2.0*{s})) end)"


def _acc_year_cols() -> str:
    parts = []
    for i, yr in enumerate([2001, 2000, 1999, 1998, 1997, 1996], start=1):
        parts.append(
            f"sum(case when y={yr} then cast(o_totalprice as decimal(18,2)) else 0 end) as tot{i}, "
            f"sum(case when y={yr} and o_orderstatus='F' then cast(o_totalprice as decimal(18,2)) else 0 end) as paid{i}, "
            f"sum(case when y={yr} then 1 else 0 end) as cnt{i}"
        )
    return ",\n    ".join(parts)


def _accounts() -> str:
    key = "cast(c_custkey as varchar)"
    pays = ["PAY_0", "PAY_2", "PAY_3", "PAY_4", "PAY_5", "PAY_6"]
    cols = [
        "c_custkey as row_id",
        "cast(10000.0*(1+c_custkey%80) as double) as LIMIT_BAL",
        "cast(1+c_custkey%2 as int) as SEX",
        f"cast(floor({U(f'concat({key},{chr(39)}|edu{chr(39)})')}*7) as int) as EDUCATION",
        f"cast(floor({U(f'concat({key},{chr(39)}|mar{chr(39)})')}*4) as int) as MARRIAGE",
        "cast(21+c_custkey%55 as int) as AGE",
    ]
    cols += [f"cast(least(coalesce(cnt{i},0),10)-2 as int) as {p}" for i, p in enumerate(pays, start=1)]
    cols += [
        f"cast(round(coalesce(tot{i},0)*cast(0.1 as decimal(2,1)) + cast(case when c_acctbal<0 then c_acctbal else 0 end as decimal(18,2)),2) as double) as BILL_AMT{i}"
        for i in range(1, 7)
    ]
    cols += [f"cast(round(coalesce(paid{i},0)*cast(0.1 as decimal(2,1)),2) as double) as PAY_AMT{i}" for i in range(1, 7)]
    cols.append(
        f"cast(case when {U(f'concat({key},{chr(39)}|y{chr(39)})')} < 0.30+0.08*(least(coalesce(cnt1,0),10)-2) "
        f"then 1 else 0 end as int) as \"DEFAULT\""
    )
    m = (
        "(select o_custkey,\n    " + _acc_year_cols()
        + "\n  from (select *, year(o_orderdate) y from orders) o group by o_custkey)"
    )
    return "select " + ",\n  ".join(cols) + f"\nfrom customer left join {m} m on o_custkey=c_custkey"


ACCOUNTS = _accounts()

_ROW_ID = (
    "concat(l_orderkey,'|',l_partkey,'|',l_suppkey,'|',l_linenumber,'|',cast(l_quantity as int))"
)


def _scores(attributes: bool) -> str:
    base = (
        f"select {_ROW_ID} as row_id, cast(case when l_returnflag='R' then 1 else 0 end as int) as y_true, "
        "l_linestatus, l_linenumber" + (", o_orderpriority, o_custkey" if attributes else "")
        + " from lineitem" + (" join orders on l_orderkey = o_orderkey" if attributes else "")
    )
    runs = "(values ('a', 0.30), ('b', 0.25), ('c', 0.10)) r(run, k)"
    prob = f"least(0.99, greatest(0.01, round(0.25 + k*y_true + 0.5*({U(chr(39).join(['concat(row_id,', '|', ',run)']))} - 0.5), 6)))"
    split = f"case when {U(chr(39).join(['concat(row_id,', '|split', ')']))} < 0.5 then 'val' else 'test' end"
    rare = f"cast(case when {U(chr(39).join(['concat(row_id,', '|rare', ')']))} < 0.0005 then 1 else 0 end as int)"
    attr = ", l_linestatus, l_linenumber, o_orderpriority, o_custkey, " + rare + " as rare" if attributes else ""
    inner = f"select run, {split} as split, row_id, y_true, {prob} as y_prob{attr} from ({base}) b, {runs}"
    return f"select *, cast(case when y_prob >= 0.5 then 1 else 0 end as int) as y_pred from ({inner}) s"


SCORES = _scores(False)
SCORES_ATTR = _scores(True)

MC = (
    "select c_custkey as row_id, cast(t as int) as t, least(0.99, greatest(0.01, 0.5 + 0.4*("
    + U("concat(cast(c_custkey as varchar),'|m')")
    + "-0.5)*2 + 0.2*("
    + U("concat(cast(c_custkey as varchar),'|',cast(t as varchar),'|mc')")
    + "-0.5))) as p from customer, range(0,30) g(t)"
)

ATTENTION = (
    "select layer, row_id, head, i, j, x / sum(x) over (partition by layer, row_id, head, i) as w from ("
    "select cast(lh//2 as int) as layer, vec_id as row_id, cast(lh%2 as int) as head, cast(i as int) as i, cast(j as int) as j, "
    "exp(cast(embedding[((i*8 + j + 7*lh) % 64) + 1] as double)) as x "
    "from embeddings, range(0,4) a(lh), range(0,8) b(i), range(0,8) c(j)) q"
)

ATTENTION_LABELS = "select vec_id as row_id, cast(case when label >= 5 then 1 else 0 end as int) as y from embeddings"

FIXTURES = {
    "accounts": ACCOUNTS,
    "scores": SCORES,
    "scores_attr": SCORES_ATTR,
    "mc": MC,
    "attention": ATTENTION,
    "attention_labels": ATTENTION_LABELS,
}


def with_fixtures(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``with <fixtures>, <extra> <body>``."""
    ctes = [f"{n} as ({FIXTURES[n]})" for n in names]
    ctes += [f"{n} as ({q})" for n, q in (extra or [])]
    return ("with " + ",\n".join(ctes) + "\n" + body) if ctes else body


# ----------------------------------------------------------------- metric twins
def lit(x: float) -> str:
    """A double literal that parses to exactly the Python double."""
    return f"cast('{float(x)!r}' as double)"


def bin_index(p: str, edges: list[float]) -> str:
    if not edges:
        return "0"
    return "(" + " + ".join(f"(case when {p} >= {lit(e)} then 1 else 0 end)" for e in edges) + ")"


def linspace_inner(n: int) -> list[float]:
    step = 1.0 / n
    return [i * step for i in range(1, n)]


def _by(by: list[str]) -> tuple[str, str]:
    """(select prefix, group by clause)."""
    if not by:
        return "", ""
    return ", ".join(by) + ", ", " group by " + ", ".join(by)


def conf(src: str, by: list[str], tau: float = 0.5, w: str = "1.0", y: str = "y_true", p: str = "y_prob") -> str:
    s, g = _by(by)
    t = lit(tau)
    return (
        f"select {s}sum(case when {p} >= {t} and {y} = 1 then {w} else 0.0 end) as tp, "
        f"sum(case when {p} >= {t} and {y} <> 1 then {w} else 0.0 end) as fp, "
        f"sum(case when {p} < {t} and {y} <> 1 then {w} else 0.0 end) as tn, "
        f"sum(case when {p} < {t} and {y} = 1 then {w} else 0.0 end) as fn from {src}{g}"
    )


def rates(c: str) -> str:
    """Adds accuracy ... kappa to a confusion subquery."""
    n = "(tp + fp + tn + fn)"
    acc = f"case when {n} > 0 then (tp + tn) / {n} end"
    pe = f"((tp + fp) * (tp + fn) + (tn + fn) * (tn + fp)) / ({n} * {n})"
    return (
        f"select *, {n} as n, {acc} as accuracy, case when tp + fp > 0 then tp / (tp + fp) else 0.0 end as precision, "
        f"case when tp + fn > 0 then tp / (tp + fn) else 0.0 end as recall, "
        f"case when 2.0 * tp + fp + fn > 0 then 2.0 * tp / (2.0 * tp + fp + fn) else 0.0 end as f1, "
        f"case when tn + fp > 0 then tn / (tn + fp) else 0.0 end as specificity, "
        f"case when 1.0 - {pe} <> 0 then ({acc} - {pe}) / (1.0 - {pe}) else 0.0 end as kappa from ({c}) c0"
    )


def ranked(src: str, by: list[str], w: str = "1.0", y: str = "y_true", p: str = "y_prob") -> str:
    s, g = _by(by)
    part = f"partition by {', '.join(by)} " if by else ""
    comp = (
        f"select {s}cast({p} as double) as s, sum(case when {y} = 1 then {w} else 0.0 end) as pos, "
        f"sum(case when {y} = 1 then 0.0 else {w} end) as neg from {src} group by {s}cast({p} as double)"
    )
    return (
        f"select *, sum(pos) over ({part}order by s rows between unbounded preceding and current row) as cum_pos, "
        f"sum(neg) over ({part}order by s rows between unbounded preceding and current row) as cum_neg, "
        f"sum(pos) over ({part.strip()}) as tot_pos, sum(neg) over ({part.strip()}) as tot_neg from ({comp}) c1"
    )


def rank_metrics(src: str, by: list[str], w: str = "1.0", y: str = "y_true", p: str = "y_prob") -> str:
    s, g = _by(by)
    tp_ge = "(tot_pos - (cum_pos - pos))"
    fp_ge = "(tot_neg - (cum_neg - neg))"
    inner = (
        f"select {s}sum(pos * ((cum_neg - neg) + neg / 2.0)) as u, sum(case when pos > 0 then pos * {tp_ge} / ({tp_ge} + {fp_ge}) else 0.0 end) as ap, "
        f"max(tot_pos) as tp_, max(tot_neg) as tn_ from ({ranked(src, by, w, y, p)}) r{g}"
    )
    return (
        f"select {s}case when tp_ > 0 and tn_ > 0 then u / (tp_ * tn_) end as auc_roc, "
        f"case when tp_ > 0 then ap / tp_ end as auc_pr from ({inner}) r2"
    )


def brier(src: str, by: list[str], w: str = "1.0", y: str = "y_true", p: str = "y_prob") -> str:
    s, g = _by(by)
    return f"select {s}sum({w} * ({p} - {y}) * ({p} - {y})) / sum({w}) as brier from {src}{g}"


def ece(src: str, by: list[str], n_bins: int, w: str = "1.0", y: str = "y_true", p: str = "y_prob", name: str = "ece") -> str:
    s, g = _by(by)
    b = bin_index(p, linspace_inner(n_bins))
    inner = f"select {s}{b} as b_, sum({w}) as n_, sum({w} * {y}) as sy, sum({w} * {p}) as sp from {src} group by {s}{b}"
    return f"select {s}sum(abs(sy - sp)) / sum(n_) as {name} from ({inner}) e{g}"


def bundle(src: str, by: list[str], tau: float = 0.5, n_bins: int = 15, w: str = "1.0") -> str:
    on = " and ".join(f"a.{c} = {x}.{c}" for c in by for x in ["b"]) if by else "true"
    on_c = " and ".join(f"a.{c} = c.{c}" for c in by) if by else "true"
    on_d = " and ".join(f"a.{c} = d.{c}" for c in by) if by else "true"
    cols = ", ".join(f"a.{c}" for c in by) + (", " if by else "")
    return (
        f"select {cols}a.auc_roc, a.auc_pr, b.f1, b.accuracy, b.precision, b.recall, c.brier, d.ece "
        f"from ({rank_metrics(src, by, w)}) a join ({rates(conf(src, by, tau, w))}) b on {on} "
        f"join ({brier(src, by, w)}) c on {on_c} join ({ece(src, by, n_bins, w)}) d on {on_d}"
    )


def binned(src: str, by: list[str], n_bins: int, strategy: str = "equal_width", y: str = "y_true", p: str = "y_prob") -> str:
    """(by..., bin, n, sy, sp) like operators.calibrate.binned."""
    s, g = _by(by)
    if strategy == "equal_width":
        b = bin_index(p, linspace_inner(n_bins))
        return f"select {s}{b} as bin, sum(1.0) as n, sum(1.0 * {y}) as sy, sum({p}) as sp from {src} group by {s}{b}"
    qs = "[" + ", ".join(lit(i * (1.0 / n_bins)) for i in range(n_bins + 1)) + "]"
    edges = (
        f"select {s}list_sort(list_distinct([0.0::double] || list_slice(quantile_cont({p}, {qs}), 2, {n_bins}) || [1.0::double])) as edges "
        f"from {src}{g}"
    )
    on = " and ".join(f"x.{c} = e.{c}" for c in by)
    sx = "".join(f"x.{c}, " for c in by)
    bexpr = f"cast(least(len(list_filter(list_slice(e.edges, 2, len(e.edges) - 1), lambda v: v <= x.{p})), len(e.edges) - 2) as int)"
    return (
        f"select {sx}{bexpr} as bin, sum(1.0) as n, sum(1.0 * x.{y}) as sy, sum(x.{p}) as sp from {src} x join ({edges}) e on {on} "
        f"group by {sx}{bexpr}"
    )


def calib_error(src: str, by: list[str], n_bins: int, strategy: str, name: str = "ece") -> str:
    s, g = _by(by)
    return f"select {s}sum(abs(sy - sp)) / sum(n) as {name} from ({binned(src, by, n_bins, strategy)}) b{g}"


def mce(src: str, by: list[str], n_bins: int) -> str:
    s, g = _by(by)
    return f"select {s}max(abs(sy / n - sp / n)) as mce from ({binned(src, by, n_bins)}) b{g}"


def brier_decomp(src: str, by: list[str], n_bins: int) -> str:
    s, g = _by(by)
    part = f"partition by {', '.join(by)}"
    b = f"select *, sum(n) over ({part}) as N_, sum(sy) over ({part}) as Y_ from ({binned(src, by, n_bins)}) b0"
    d = (
        f"select {s}sum(n / N_ * (sp / n - sy / n) * (sp / n - sy / n)) as reliability, "
        f"sum(n / N_ * (sy / n - Y_ / N_) * (sy / n - Y_ / N_)) as resolution, max(Y_ / N_ * (1.0 - Y_ / N_)) as uncertainty from ({b}) b1{g}"
    )
    on = " and ".join(f"d.{c} = r.{c}" for c in by)
    return f"select d.*, r.brier from ({d}) d join ({brier(src, by)}) r on {on}"


def calib_bundle(src: str, by: list[str], n_bins: int = 10) -> str:
    cols = ", ".join(f"a.{c}" for c in by)
    on = lambda x: " and ".join(f"a.{c} = {x}.{c}" for c in by)
    return (
        f"select {cols}, a.auc_roc, b.ece as ece_equal_width, c.ece as ece_equal_mass, d.mce, e.brier, e.reliability, e.resolution, e.uncertainty, "
        f"case when e.uncertainty > 0 then (e.resolution - e.reliability) / e.uncertainty else cast('nan' as double) end as brier_skill_score "
        f"from ({rank_metrics(src, by)}) a join ({calib_error(src, by, n_bins, 'equal_width')}) b on {on('b')} "
        f"join ({calib_error(src, by, n_bins, 'equal_mass')}) c on {on('c')} join ({mce(src, by, n_bins)}) d on {on('d')} "
        f"join ({brier_decomp(src, by, n_bins)}) e on {on('e')}"
    )


def clip_sql(p: str, eps: float = 1e-7) -> str:
    return f"least(greatest({p}, {lit(eps)}), {lit(1.0 - eps)})"


def logit_sql(p: str, eps: float = 1e-7) -> str:
    c = clip_sql(p, eps)
    return f"ln({c} / (1.0 - {c}))"


def sigmoid_sql(x: str) -> str:
    return f"(case when ({x}) >= 0 then 1.0 / (1.0 + exp(-({x}))) else exp({x}) / (1.0 + exp({x})) end)"
