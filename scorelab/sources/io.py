"""File sources and sinks.

Readers use explicit schemas where the layout is known; writers partition
by the grouping keys downstream jobs filter on (run, split) so later reads
prune partitions.
"""

from __future__ import annotations

import re
import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schema as S

# Anonymous header -> semantic column name.
ANONYMOUS_MAP = {
    "X1": "LIMIT_BAL", "X2": "SEX", "X3": "EDUCATION", "X4": "MARRIAGE", "X5": "AGE",
    "X6": "PAY_0", "X7": "PAY_2", "X8": "PAY_3", "X9": "PAY_4", "X10": "PAY_5", "X11": "PAY_6",
    "X12": "BILL_AMT1", "X13": "BILL_AMT2", "X14": "BILL_AMT3", "X15": "BILL_AMT4", "X16": "BILL_AMT5",
    "X17": "BILL_AMT6", "X18": "PAY_AMT1", "X19": "PAY_AMT2", "X20": "PAY_AMT3", "X21": "PAY_AMT4",
    "X22": "PAY_AMT5", "X23": "PAY_AMT6", "Y": "DEFAULT",
}

RECOVERABLE = (PySparkException, Py4JJavaError, OSError, ValueError)
#: Formats whose readers can hand over rows that do not parse.
LINED, CORRUPT = ("csv", "json"), "_corrupt_record"


@dataclass
class Attempt:
    source: str
    origin: str
    ok: bool
    seconds: float
    error: str | None


def _probed(spark: SparkSession, fmt: str, path: str, opts: dict) -> DataFrame:
    """The candidate, once every value of it has been read; ValueError if rows do not parse.

    The probe is one aggregation over all columns. CSV and JSON rows that don't
    fit the schema (option ``schema``, else the inferred one) are captured."""
    opts = dict(opts or {})
    schema = opts.pop("schema", None)
    reader = spark.read.format(fmt).options(**opts)
    df = (reader.schema(schema) if schema else reader).load(path)
    checked = df
    if fmt in LINED:
        fields = [f for f in df.schema.fields if f.name != CORRUPT]
        caught = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        checked = spark.read.format(fmt).options(**opts).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).schema(caught).load(path)
    bad = F.col(CORRUPT).isNotNull() if CORRUPT in checked.columns else F.lit(False)
    values = F.xxhash64(*(F.col(f"`{c}`").cast("string") if isinstance(checked.schema[c].dataType, T.MapType) else F.col(f"`{c}`") for c in checked.columns))
    n = checked.agg(F.count(F.when(bad, 1)).alias("bad"), F.bit_xor(values)).first()["bad"]
    if n:
        raise ValueError(f"{n} rows of {path} do not parse")
    return df


def load_first_available(spark: SparkSession, candidates: list[tuple[str, str, dict]], allow_fallback: bool = True):
    """A1: try ``(format, path, options)`` candidates in order, each once. A candidate
    is accepted when all of it could be read (one aggregation over its columns);
    recoverable errors, those met while reading included, fall through to the next
    one, anything else aborts. Returns ``(DataFrame, provenance DataFrame)``; the
    provenance lists every attempt with its duration and error."""
    attempts: list[Attempt] = []
    result, tried = None, set()
    for fmt, path, opts in candidates:
        if (fmt, path) in tried:
            continue
        tried.add((fmt, path))
        t0 = time.time()
        try:
            df = _probed(spark, fmt, path, opts)
            attempts.append(Attempt(fmt, path, True, time.time() - t0, None))
            result = df
            break
        except RECOVERABLE as ex:
            attempts.append(Attempt(fmt, path, False, time.time() - t0, str(ex)))
            if not allow_fallback:
                break
    prov = spark.createDataFrame(
        [(i, a.source, a.origin, a.ok, float(a.seconds), a.error) for i, a in enumerate(attempts)],
        "attempt int, source string, origin string, ok boolean, seconds double, error string",
    )
    if result is None:
        raise FileNotFoundError(f"no candidate could be loaded: {[a.origin for a in attempts]}")
    return result, prov


def first_existing(spark: SparkSession, candidates: list[str], roots: tuple[str, ...] = ("",)) -> str:
    """A2: the first candidate that exists, each looked up once in its place, and relative ones under every root in turn."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    if not candidates:
        raise ValueError("at least one candidate path is needed")
    places = []
    for c in dict.fromkeys(candidates):
        whole = c.startswith("/") or re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*:", c)
        places += [c] if whole else [f"{r.rstrip('/')}/{c}" if r else c for r in roots]
    for p in places:
        at = hadoop.Path(p)
        if at.getFileSystem(conf).exists(at):
            return p
    raise FileNotFoundError(f"none of these exists: {places}")


def read_with_banner(spark: SparkSession, path: str | list[str], schema: T.StructType | str, roots: tuple[str, ...] = ("",)) -> DataFrame:
    """A2: CSV with a banner line above the header row, in every file.

    Of several paths the first that exists is read. The reader skips each file's first line, whatever it holds; the header
    below it is the row that repeats the column names. All other rows stay:
    missing fields are null, fields beyond the schema are ignored."""
    path = first_existing(spark, path, roots) if isinstance(path, list) else path
    last = path.rstrip("/").rsplit("/", 1)[-1]
    if "." in last and not last.lower().endswith((".csv", ".txt")):
        raise ValueError(f"unsupported extension: {path}")
    st = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
    as_text = ", ".join(f"`{f.name}` string" for f in st.fields)
    rows = spark.read.schema(as_text).option("header", True).option("enforceSchema", True).csv(path)
    is_header = reduce(lambda x, y: x & y, [F.col(f"`{f.name}`").eqNullSafe(F.lit(f.name)) for f in st.fields])
    body = rows.where(~is_header)
    return body.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in st.fields])


def rename_anonymous(df: DataFrame, mapping: dict[str, str] | None = None) -> DataFrame:
    """A3: rename anonymous headers only when the table is still anonymous."""
    mapping = ANONYMOUS_MAP if mapping is None else mapping
    if not mapping or "X1" not in df.columns:
        return df
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


#: Canonical column -> what a header must look like, compared in upper case
#: with runs of blanks and dots as one underscore.
HEADER_RULES = {c: re.compile(rf"{c}") for c in S.ALL_COLUMNS} | {"PAY_0": re.compile("PAY_[01]"), "DEFAULT": re.compile(".*DEFAULT.*")}


def normalise_schema(df: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """A4: the contract's columns under their canonical names and in its
    order, ``keep`` columns first. Every header is matched against the rule
    table; headers that no rule claims are dropped. A column that no header,
    or more than one, claims is an error."""
    keep = keep or []
    plain = {h: re.sub(r"[\s.]+", "_", h.strip()).upper() for h in df.columns if h not in keep}
    claims = {c: [h for h, name in plain.items() if rule.fullmatch(name)] for c, rule in HEADER_RULES.items()}
    unclear = {c: hs for c, hs in claims.items() if len(hs) > 1}
    absent = [c for c, hs in claims.items() if not hs]
    if unclear or absent:
        raise ValueError(f"headers do not fit the contract: nothing for {absent}, several for {unclear}")
    return df.select(*[F.col(f"`{k}`") for k in keep], *[F.col(f"`{claims[c][0]}`").alias(c) for c in S.ALL_COLUMNS])


def write_splits(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """A5: one dataset partitioned by ``split`` (readers prune on it)."""
    df.write.mode(mode).partitionBy("split").format(fmt).save(path)


def write_report(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON sink for report tables (metadata, validation)."""
    df.write.mode(mode).json(path)


def write_scores(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Score table partitioned by run and split."""
    df.write.mode(mode).partitionBy("run", "split").parquet(path)


SCORE_SCHEMA = "run string, split string, row_id string, y_true int, y_prob double, y_pred int"


def read_scores(spark: SparkSession, path: str, runs: list[str] | None = None, split: str | None = None, strict: bool = False) -> DataFrame:
    """Read score partitions; filters on the partition columns prune
    directories. ``strict`` fails when a requested run has no rows."""
    df = spark.read.parquet(path)
    if runs:
        df = df.where(F.col("run").isin(runs))
    if split:
        df = df.where(F.col("split") == split)
    if strict and runs:
        seen = {r["run"] for r in df.select("run").distinct().collect()}  # bounded by len(runs)
        missing = [r for r in runs if r not in seen]
        if missing:
            raise FileNotFoundError(f"missing runs: {missing}")
    return df


def read_baseline_metrics(df: DataFrame, names: tuple[str, ...] = ("baseline", "tuned")) -> DataFrame:
    """Keep the named rows and rename ``avg_precision`` -> ``auc_pr``."""
    out = df.where(F.col("model").isin(list(names)))
    return out.withColumnRenamed("avg_precision", "auc_pr") if "avg_precision" in out.columns else out


def training_curves(log: DataFrame) -> DataFrame:
    """Per-run loss and validation AUC by epoch."""
    return log.select("run", F.col("epoch").cast("int"), F.col("train_loss").cast("double"), F.col("val_auc_roc").cast("double"))


def read_training_logs(spark: SparkSession, path: str) -> DataFrame:
    """Training logs, CSV files with a header under ``run=<name>`` folders, as loss and AUC curves."""
    return training_curves(spark.read.option("header", True).option("basePath", path).csv(f"{path.rstrip('/')}/run=*"))


def read_attention(df: DataFrame, key: str = "key") -> DataFrame:
    """A10: long attention rows keyed ``layer_<n>``: layer parsed as an integer
    so that layer_10 sorts after layer_2."""
    return df.withColumn("layer", F.split(F.col(key), "_").getItem(1).cast("int")).drop(key)


def to_markdown(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """One markdown table line per row (header lines are added by the
    writer). The result stays distributed; write it with ``write.text``."""
    cols = cols or df.columns
    cells = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols]
    return df.select(F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |")).alias("line"))


def markdown_header(cols: list[str]) -> list[str]:
    return ["| " + " | ".join(cols) + " |", "|" + "|".join(["---"] * len(cols)) + "|"]


def table_lines(df: DataFrame, fmt: str, order: list[str], cols: list[str] | None = None) -> DataFrame:
    """(n, line): a result table as markdown, CSV or LaTeX, with its header lines, numbered in order of ``order``.

    For small result tables: the rows are numbered in one task. Null is empty."""
    cols = cols or df.columns
    text = [F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in cols]
    if fmt == "markdown":
        head, tail = markdown_header(cols), []
        line = F.concat(F.lit("| "), F.concat_ws(" | ", *(F.replace(c, F.lit("|"), F.lit("\\|")) for c in text)), F.lit(" |"))
    elif fmt == "csv":
        quoted = [F.when(c.rlike('[",\r\n]'), F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))).otherwise(c) for c in text]
        head, tail, line = [",".join(cols)], [], F.concat_ws(",", *quoted)
    elif fmt == "latex":
        safe = lambda c: F.regexp_replace(c, r"([&%$#_{}])", r"\\$1")
        head = ["\\begin{tabular}{" + "l" * len(cols) + "}", "\\hline", " & ".join(re.sub(r"([&%$#_{}])", r"\\\1", c) for c in cols) + r" \\", "\\hline"]
        tail, line = ["\\hline", "\\end{tabular}"], F.concat(F.concat_ws(" & ", *map(safe, text)), F.lit(r" \\"))
    else:
        raise ValueError(f"fmt must be markdown, csv or latex, got {fmt!r}")
    body = df.select(F.row_number().over(Window.orderBy(*order)).cast("long").alias("n"), line.alias("line"))
    spark = df.sparkSession
    top = spark.createDataFrame([(k - len(head) + 1, x) for k, x in enumerate(head)], "n long, line string")
    if not tail:
        return top.unionByName(body)
    last = body.agg(F.coalesce(F.max("n"), F.lit(0)).alias("m")).select(F.posexplode(F.array(*map(F.lit, tail))).alias("k", "line"), "m").select((F.col("m") + F.col("k") + 1).alias("n"), "line")
    return top.unionByName(body).unionByName(last)


def write_table(df: DataFrame, path: str, fmt: str, order: list[str], cols: list[str] | None = None, mode: str = "overwrite") -> None:
    """A result table as one text file in order."""
    table_lines(df, fmt, order, cols).coalesce(1).sortWithinPartitions("n").select("line").write.mode(mode).text(path)


def export_results(metrics: DataFrame, cv: DataFrame, importance: DataFrame, params: dict, threshold: float, grid: dict[str, list], path: str, score: str = "auc_roc") -> None:
    """The four result tables of a baseline under ``path``: metrics (a row for ``baseline`` and ``tuned``), cv and
    importance as CSV, and config as JSON, with parameters and grid as strings, the threshold to two places and both scores."""
    spark, at = metrics.sparkSession, path.rstrip("/")
    for name, table in (("metrics", metrics), ("cv", cv), ("importance", importance)):
        table.coalesce(1).write.mode("overwrite").option("header", True).csv(f"{at}/{name}")
    scores = metrics.groupBy().agg(*(F.max(F.when(F.col("model") == m, F.col(score))).alias(f"{m}_auc") for m in ("baseline", "tuned")))
    known = spark.createDataFrame([({k: str(v) for k, v in params.items()}, round(threshold, 2), {k: [str(x) for x in v] for k, v in grid.items()})],
                                  "best_params map<string, string>, best_threshold double, tuning_grid map<string, array<string>>")
    config = scores.withColumn("_k", F.lit(1)).join(F.broadcast(known.withColumn("_k", F.lit(1))), "_k").drop("_k")  # one row each
    config.coalesce(1).write.mode("overwrite").json(f"{at}/config")


def read_config(spark: SparkSession, path: str) -> DataFrame:
    """(param, value and its typed views) of an exported configuration."""
    schema = "best_params map<string, string>, best_threshold double, tuning_grid map<string, array<string>>, baseline_auc double, tuned_auc double"
    config = spark.read.schema(schema).json(f"{path.rstrip('/')}/config")
    return coerce_params(config.select(F.explode("best_params").alias("param", "value")))


def coerce_params(df: DataFrame, value: str = "value") -> DataFrame:
    """Typed view of string parameters: None -> NULL, booleans,
    integers, floats, otherwise the string itself."""
    v = F.trim(F.col(value))
    return df.withColumns(
        {
            "kind": F.when(v.isin("None", "null", ""), F.lit("none"))
            .when(v.isin("True", "False", "true", "false"), F.lit("bool"))
            .when(v.rlike("^-?[0-9]+$"), F.lit("int"))
            .when(v.rlike("^-?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][-+]?[0-9]+)?$"), F.lit("float"))
            .otherwise(F.lit("string")),
            "as_bool": F.when(v.isin("True", "true"), F.lit(True)).when(v.isin("False", "false"), F.lit(False)),
            "as_int": F.when(v.rlike("^-?[0-9]+$"), v.cast("long")),
            "as_double": F.when(v.rlike("^-?([0-9]+\\.[0-9]*|\\.[0-9]+|[0-9]+)([eE][-+]?[0-9]+)?$"), v.cast("double")),
        }
    )


#: Bytes of one file that a task hashes before the chain goes on in another.
PIECE = 256 << 20
_STATE_BYTES = 112  # OpenSSL's SHA256_CTX


def _sha256_parts():
    """OpenSSL's sha256 in steps, whose state is plain bytes (hashlib's can't leave its process); None without OpenSSL."""
    import ctypes

    try:
        import _hashlib

        lib = ctypes.CDLL(_hashlib.__file__)
        parts = lib.SHA256_Init, lib.SHA256_Update, lib.SHA256_Final
    except (ImportError, AttributeError, OSError):
        return None
    parts[0].argtypes = [ctypes.c_void_p]
    parts[1].argtypes = [ctypes.c_void_p, ctypes.c_void_p, ctypes.c_size_t]
    parts[2].argtypes = [ctypes.c_void_p, ctypes.c_void_p]
    return parts


def _hash_on(path: str, length: int, at: int, end: int, state: bytes | None) -> bytes:
    """The hash's state after the bytes ``at`` to ``end`` of a file, or its digest where they are the last."""
    import ctypes
    import hashlib

    whole = at == 0 and end == length
    if whole:
        made = hashlib.sha256()
    else:
        init, update, final = _sha256_parts()
        context = ctypes.create_string_buffer(state or b"", _STATE_BYTES)
        if state is None:
            init(context)
    buf = bytearray(1 << 20)
    view, raw = memoryview(buf), (ctypes.c_char * len(buf)).from_buffer(buf)
    with open("/" + path.removeprefix("file:").lstrip("/"), "rb", buffering=0) as f:
        f.seek(at)
        while at < end:
            n = f.readinto(view[: min(len(buf), end - at)])
            if not n:
                raise OSError(f"{path} ends at byte {at}, listed with {length}")
            if whole:
                made.update(view[:n])
            else:
                update(context, raw, n)
            at += n
    if whole:
        return made.digest()
    if end < length:
        return context.raw
    digest = ctypes.create_string_buffer(32)
    final(digest, context)
    return digest.raw


def content_hash(spark: SparkSession, path: str, glob: str | None = None, piece: int = PIECE) -> DataFrame:
    """M6: (path, length, sha256) of every file under ``path`` that the binaryFile source lists.

    A sha256 is a chain over a file's bytes, but its state can be handed on: a
    task hashes at most ``piece`` bytes of a file, a MB at a time, and the next
    round's task goes on from its state, so that files may be larger than a row
    or a task's share. All rounds but the last run while this is built: states
    are checkpointed. Bytes are read where the files lie, a folder that all
    executors share; on other file systems files are rows of the binaryFile
    source, of 2 GB at most."""
    from ..session import checkpoint_dir

    r = spark.read.format("binaryFile")
    if glob:
        r = r.option("pathGlobFilter", glob)
    files = r.option("recursiveFileLookup", True).load(path)
    seen = files.agg(F.max("length").alias("most"), F.bool_and(F.col("path").startswith("file:")).alias("local")).first()
    if not seen["local"]:
        return files.select("path", "length", F.sha2(F.col("content"), 256).alias("sha256"))
    if _sha256_parts() is None:  # each file in one task, still a MB at a time
        piece = max(seen["most"], 1)

    def from_byte(at: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = batch.to_pylist()
                for row in rows:
                    if at < row["length"] or at == 0:
                        row["state"] = _hash_on(row["path"], row["length"], at, min(at + piece, row["length"]), row["state"])
                yield pa.RecordBatch.from_pylist(rows, schema=pa.schema([("path", pa.string()), ("length", pa.int64()), ("state", pa.binary())]))

        return run

    hashed = files.select("path", "length", F.lit(None).cast("binary").alias("state"))
    for at in range(0, max(seen["most"], 1), piece):
        if at:
            checkpoint_dir(spark)
            hashed = hashed.checkpoint(eager=True)
        hashed = hashed.mapInArrow(from_byte(at), "path string, length long, state binary")
    return hashed.select("path", "length", F.lower(F.hex("state")).alias("sha256"))


#: Bytes of offsets under one leaf of a file's hash tree, and children of a node.
LEAF, FAN = 1 << 20, 64


def content_roots(spark: SparkSession, path: str, glob: str | None = None, leaf: int = LEAF, fan: int = FAN) -> DataFrame:
    """M6: (path, length, root): a Merkle root of every file's bytes, read in splits.

    The text source reads a file's bytes up to each line feed, in as many splits
    as it likes; a split's sizes give every stretch its offset in the file, so
    the tree over offsets, ``leaf`` bytes to a leaf and ``fan`` children to a
    node, and its root depend on the bytes alone. No row holds more than the
    bytes between two line feeds, so files may be larger than a row can be.
    Empty files, which Spark's readers pass over, have no row. A job for each
    level runs while this is built: levels are checkpointed."""
    from ..session import checkpoint_dir

    checkpoint_dir(spark)

    def reader(fmt: str):
        r = spark.read.format(fmt).option("recursiveFileLookup", True)
        return r.option("pathGlobFilter", glob) if glob else r

    files = reader("binaryFile").load(path).select(F.col("_metadata.file_path").alias("path"), "length")
    raw = F.col("value").cast("binary")
    lines = reader("text").option("lineSep", "\n").load(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("nth"),
        (F.octet_length(raw) + 1).cast("long").alias("n"), F.sha2(raw, 256).alias("hash"))
    before = Window.partitionBy("path", "split").orderBy("nth").rowsBetween(Window.unboundedPreceding, -1)  # one split's rows
    placed = lines.withColumn("rel", F.coalesce(F.sum("n").over(before), F.lit(0)))
    sizes = lines.groupBy("path", "split").agg(F.sum("n").alias("n"))
    base = Window.partitionBy("path").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)  # a row for each split
    bases = sizes.select("path", "split", F.coalesce(F.sum("n").over(base), F.lit(0)).alias("base"))
    level = placed.join(bases, ["path", "split"]).select("path", (F.col("base") + F.col("rel")).alias("at"), "hash")

    def up(below: DataFrame, width: int) -> DataFrame:
        children = F.array_sort(F.collect_list(F.struct("at", "hash")))
        text = F.array_join(F.transform(children, lambda c: F.concat(c["at"].cast("string"), F.lit(":"), c["hash"])), "\n")
        return below.groupBy("path", F.expr(f"at div {width}").alias("at_")).agg(F.sha2(text, 256).alias("hash")).withColumnRenamed("at_", "at").checkpoint(eager=True)

    level, roots = up(level, leaf), None
    while True:
        tall = level.groupBy("path").agg((F.max("at") > 0).alias("more"))
        marked = level.join(tall, "path")
        ready = marked.where("not more").select("path", "hash")  # a file's levels end at its own root
        roots = ready if roots is None else roots.unionByName(ready)
        if not tall.where("more").limit(1).count():
            break
        level = up(marked.where("more").drop("more"), fan)
    root = F.sha2(F.concat(F.col("length").cast("string"), F.lit(":"), F.col("hash")), 256)
    return files.join(roots, "path").select("path", "length", root.alias("root"))
