"""Projections, filters and scalar functions.

All are built-in Column expressions, so they stay inside whole-stage codegen
and filters push down to the parquet scan.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# P1
def normalize_names(df: DataFrame) -> DataFrame:
    """Column names stripped and lower-cased."""
    return df.toDF(*[c.strip().lower() for c in df.columns])


# P2
def to_number(c) -> Column:
    """Text or number to double; anything unparsable becomes null."""
    return F.trim(_c(c).cast("string")).try_cast("double")


# P3
def to_ts(c, fmt: str | None = None) -> Column:
    """Text to timestamp; bad values become null."""
    col = _c(c).cast("string")
    return F.try_to_timestamp(col, F.lit(fmt)) if fmt else F.try_to_timestamp(col)


# P4
def clean_id(c) -> Column:
    """Id as trimmed string; null stays null."""
    return F.trim(_c(c).cast("string"))


def clean_label(c) -> Column:
    """Label trimmed and upper-cased; null stays null."""
    return F.upper(F.trim(_c(c).cast("string")))


# P5
def parse_liters(c) -> Column:
    """First number in the text (comma as decimal mark) as litres."""
    num = F.regexp_extract(F.regexp_replace(_c(c).cast("string"), ",", "."), r"(\d*\.?\d+)", 1)
    return F.when(num == "", F.lit(None).cast("double")).otherwise(num.cast("double"))


# P6
def parse_liters_strict(c) -> Column:
    """Strip 'l', comma→dot; the whole remaining text must be numeric."""
    s = F.replace(F.replace(F.lower(_c(c).cast("string")), F.lit("l"), F.lit("")), F.lit(","), F.lit("."))
    return F.trim(s).try_cast("double")


# P7
def drop_null_keys(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.na.drop(subset=list(cols))


# P8
def positive_only(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col) > 0)


# P9
def null_if_negative(c) -> Column:
    col = _c(c)
    return F.when(col < 0, F.lit(None)).otherwise(col)


# P10
def week_start(c, anchor: str = "MON") -> Column:
    """Week start date; Monday weeks, or Tuesday-anchored weeks (Q1)."""
    d = F.to_date(_c(c))
    if anchor.upper().startswith("MON"):
        return F.date_trunc("week", d).cast("date")
    if anchor.upper().startswith("TUE"):
        return F.date_add(F.date_trunc("week", F.date_sub(d, 1)).cast("date"), 1)
    raise ValueError(f"unknown week anchor {anchor!r}")


# P11
def history_slice(df: DataFrame, date_col: str, ref_week: str, n_weeks: int) -> DataFrame:
    """Rows in ``[ref − n weeks, ref + 6 days]`` (inclusive); a range predicate
    on the raw column so it reaches the parquet scan."""
    ref = F.to_date(F.lit(ref_week))
    lo = F.date_sub(ref, 7 * n_weeks)
    hi = F.date_add(ref, 7)
    c = F.col(date_col)
    return df.filter((c >= lo.cast("timestamp_ntz")) & (c < hi.cast("timestamp_ntz")))


# P12
def line_total(q, p) -> Column:
    return _c(q) * _c(p)


# P13
def label_not_null(c) -> Column:
    return _c(c).isNotNull().cast("int")


# P14
def map_groups(df: DataFrame, col: str, mapping: Mapping[str, str], out: str = "group") -> DataFrame:
    """Map codes to groups and drop unmapped rows.  The mapping is a literal
    (parameter-sized) relation, so it is broadcast."""
    spark = df.sparkSession
    m = spark.createDataFrame(list(mapping.items()), f"{col} string, {out} string")
    return df.join(F.broadcast(m), col, "inner")


# P15
def apply_threshold(p, t: float) -> Column:
    return (_c(p) >= F.lit(t)).cast("int")


# P16
def decode_label(c, labels: Mapping[int, str], default: str | None = None) -> Column:
    col = _c(c)
    e = None
    for k, v in labels.items():
        e = F.when(col == k, F.lit(v)) if e is None else e.when(col == k, F.lit(v))
    return e.otherwise(F.lit(default))


# P17
def log1p(c) -> Column:
    return F.log1p(_c(c))


def clip_low(c, low: float) -> Column:
    return F.greatest(_c(c), F.lit(low))


# P18
def qcut(df: DataFrame, col: str, q: int, labels: Sequence[str] | None = None, out: str = "bin") -> DataFrame:
    """Quantile bins with right-closed edges at interpolated quantiles; the
    lowest edge is closed on the left (as pandas ``qcut``).  The edges are one
    aggregate row joined back by broadcast (size q+1 values)."""
    from cartwheel.functions.quantiles import quantile_row
    probs = [i / q for i in range(q + 1)]
    edges = quantile_row(df, [col], probs).select(F.col(f"_q_{col}").alias("_edges"))  # exact, one row
    j = df.crossJoin(F.broadcast(edges))
    x = F.col(col)
    idx = F.size(F.filter(F.slice(F.col("_edges"), 2, q - 1), lambda e: e < x))
    names = list(labels) if labels else [str(i) for i in range(q)]
    lab = F.element_at(F.array(*[F.lit(n) for n in names]), idx + 1)
    return j.withColumn(out, F.when(x.isNull(), F.lit(None)).otherwise(lab)).drop("_edges")


# P19
def align_schema(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Add missing expected columns as null, drop unknown ones, booleans to int;
    a string column becomes numeric when every non-null value parses.  The
    'parses fully' test is one aggregate over the input."""
    present = set(df.columns)
    str_cols = [f.name for f in df.schema.fields if f.name in expected and f.dataType.simpleString() == "string"]
    parses = {}
    if str_cols:
        row = df.agg(*[
            F.bool_and(F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()).alias(c)
            for c in str_cols
        ]).first()
        parses = {c: bool(row[c]) if row[c] is not None else False for c in str_cols}
    out = []
    for c in expected:
        if c not in present:
            out.append(F.lit(None).cast("string").alias(c))
            continue
        dt = df.schema[c].dataType.simpleString()
        if dt == "boolean":
            out.append(F.col(c).cast("int").alias(c))
        elif c in parses and parses[c]:
            out.append(F.col(c).try_cast("double").alias(c))
        else:
            out.append(F.col(c))
    return df.select(*out)


# P20
def sigmoid(c) -> Column:
    return 1.0 / (1.0 + F.exp(-_c(c)))


def logit_sum(base, contribs: Iterable) -> Column:
    total = _c(base) if not isinstance(base, (int, float)) else F.lit(float(base))
    for x in contribs:
        total = total + _c(x)
    return sigmoid(total)


# P21
# fixed value: the tokenizer's words (letters, Spanish accents, digits)
TOKEN_PATTERN = "[a-záéíóúüñ0-9]+"


def tokenize(c) -> Column:
    """Lower-case, other characters to space, split on whitespace, blanks dropped:
    the runs of the characters that are kept."""
    return F.regexp_extract_all(F.lower(_c(c)), F.lit(TOKEN_PATTERN), F.lit(0))


# P22
def route_text(c, rules: Sequence[tuple[str, Sequence[str]]], default: str) -> Column:
    """First rule whose keyword list hits (case-insensitive substring) wins."""
    low = F.lower(_c(c))
    e = None
    for name, words in rules:
        hit = None
        for w in words:
            h = low.contains(w.lower())
            hit = h if hit is None else (hit | h)
        e = F.when(hit, F.lit(name)) if e is None else e.when(hit, F.lit(name))
    return e.otherwise(F.lit(default)) if e is not None else F.lit(default)


# P23
def split_xy(df: DataFrame, features: Sequence[str], label: str, ids: Sequence[str]):
    """Named selections (X, y, ids) of one DataFrame; all share the same rows."""
    return df.select(*ids, *features), df.select(*ids, label), df.select(*ids)


def round_half_away(c, k: int) -> Column:
    """Round on the binary value: sign(x)·floor(|x|·10^k + 0.5)/10^k — half away
    from zero, the convention of most SQL engines for DOUBLE (Spark's
    ``round`` rounds the shortest decimal text instead)."""
    x = _c(c)
    m = float(10 ** k)
    return F.signum(x) * F.floor(F.abs(x) * m + 0.5) / m
