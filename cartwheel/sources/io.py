"""Sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


# S2
def read_csv(spark: SparkSession, path: str, schema: StructType | str, header: bool = True) -> DataFrame:
    """CSV with a header and an explicit schema (no inference pass)."""
    return spark.read.schema(schema).option("header", header).csv(path)


def _try_read(spark: SparkSession, path: str, fmt: str, schema=None) -> DataFrame | None:
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", True)
    try:
        return r.load(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise


# S3
def read_available(spark: SparkSession, paths: Sequence[str], fmt: str = "parquet", schema=None) -> DataFrame:
    """Stack whichever inputs exist (by column name, missing columns null);
    error when none does."""
    found = [d for d in (_try_read(spark, p, fmt, schema) for p in paths) if d is not None]
    if not found:
        raise FileNotFoundError(f"none of the inputs exist: {list(paths)}")
    out = found[0]
    for d in found[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


# S4
def gated_sources(df1: DataFrame, df2: DataFrame, run_date: str, cutoff: str) -> DataFrame:
    """Before the cutoff only the first input; from the cutoff on both."""
    if str(run_date) < str(cutoff):
        return df1
    return df1.unionByName(df2, allowMissingColumns=True)


# S5
PAIR_SCHEMA = "customer_id string, product_id string"


def read_pairs(spark: SparkSession, path: str) -> DataFrame:
    """Headerless (customer, product) CSV, de-duplicated."""
    return spark.read.schema(PAIR_SCHEMA).option("header", False).csv(path).dropDuplicates()


# S6
def read_truth(spark: SparkSession, path: str) -> DataFrame:
    """Truth pairs from parquet, else from the CSV sibling (same stem)."""
    df = _try_read(spark, path, "parquet")
    if df is None:
        stem = path[:-8] if path.endswith(".parquet") else path
        df = _try_read(spark, stem + ".csv", "csv", PAIR_SCHEMA)
    if df is None:
        raise FileNotFoundError(path)
    return df.select(F.col("customer_id").cast("string"), F.col("product_id").cast("string")).distinct()


# S7
def read_records(spark: SparkSession, path: str, schema: StructType | str, target: str | None = None) -> DataFrame:
    """JSON records with a fixed schema; the target column dropped if present."""
    df = spark.read.schema(schema).json(path)
    return df.drop(target) if target and target in df.columns else df


# S8
def assemble_documents(parts: DataFrame, key: str, order: str, text: str, out: str = "text") -> DataFrame:
    """Ordered parts joined by newline; blank parts dropped."""
    keep = parts.filter(F.col(text).isNotNull() & (F.length(F.trim(F.col(text))) > 0))
    g = keep.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(text).alias("t")))).alias("_p"))
    return g.select(key, F.array_join(F.transform("_p", lambda s: s["t"]), "\n").alias(out))


# S9
def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: Sequence[str] = (),
                fmt: str = "parquet") -> str:
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.save(path)
    return path


# S10
def require_inputs(tables: Mapping[str, DataFrame]) -> DataFrame:
    """(table, rows, ok) — one aggregated count per table, unioned."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table"), "rows")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("ok", F.col("rows") > 0)


# S11
def latest_run(df: DataFrame, col: str = "run_date") -> DataFrame:
    """Rows of the newest run (semi-join on the max)."""
    mx = df.agg(F.max(col).alias(col))
    return df.join(F.broadcast(mx), col, "left_semi")


# S12
def run_record(run_name, params: Mapping[str, object], metrics: Mapping[str, object], artifact=None):
    """Columns of one run-log row: params map<string,string>, metrics map<string,double>."""
    pm = F.create_map(*[x for k, v in params.items() for x in (F.lit(k), (v if not isinstance(v, (str, int, float)) else F.lit(v)).cast("string"))])
    mm = F.create_map(*[x for k, v in metrics.items() for x in (F.lit(k), (v if not isinstance(v, (str, int, float)) else F.lit(v)).cast("double"))])
    return [run_name.alias("run_name"), pm.alias("params"), mm.alias("metrics"),
            (artifact if artifact is not None else F.lit(None).cast("string")).alias("artifact")]


def log_run(runs: DataFrame, path: str) -> str:
    """Append run rows to the run table."""
    runs.write.mode("append").parquet(path)
    return path


# S13
def best_run(runs: DataFrame, metric: str, descending: bool = True) -> DataFrame:
    """The run with the best metric (descending by default), ties by run name."""
    m = F.col("metrics")[metric]
    o = [F.desc_nulls_last(m) if descending else F.asc_nulls_last(m), F.asc("run_name")]
    return runs.orderBy(*o).limit(1)


# S15
def materialize_matrix(df: DataFrame, path: str) -> DataFrame:
    """Write an assembled matrix once and read it back (cache on disk)."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)
