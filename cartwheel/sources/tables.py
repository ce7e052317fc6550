"""S1 loading plus the fixture views of FIXTURES.md over the driver tables.

Every view but CLF is a lazy DataFrame: filters and projections reach the parquet
scan, and nothing is materialised until an action.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import materialize

TABLE_NAMES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

TXD_WEEKS = 53  # weeks of history of the dense view, the last one included


class Tables:
    """Lazy accessor: ``t.lineitem`` reads ``<dir>/lineitem.parquet`` on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.dir = sf_dir.rstrip("/")
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in TABLE_NAMES:
            raise AttributeError(name)
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.dir}/{name}.parquet")
        return self._cache[name]


def load_tables(spark: SparkSession, sf_dir: str, names=TABLE_NAMES) -> dict[str, DataFrame]:
    """Load each table as a DataFrame (schema from the parquet footer)."""
    return {n: spark.read.parquet(f"{sf_dir.rstrip('/')}/{n}.parquet") for n in names}


def md5_bucket(key: Column, seed: int | str, n: int) -> Column:
    """Deterministic bucket ``conv(substr(md5(key|seed),1,8),16,10) % n``."""
    h = F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))
    return (F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint") % F.lit(n)).cast("bigint")


def md5_order(key: Column, seed: int | str) -> Column:
    """Deterministic pseudo-random order key ``md5(key|seed)``."""
    return F.md5(F.concat(key.cast("string"), F.lit(f"|{seed}")))


# ---------------------------------------------------------------- views

def tx(t: Tables) -> DataFrame:
    """TX: lineitem ⋈ orders ⋈ part as transactions."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    p = t.part.select("p_partkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("purchase_date"),
        F.col("l_quantity").alias("items"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment"),
    )


def txb(t: Tables, start: Column | None = None) -> DataFrame:
    """TXB: TX at brand grain (dense repeat purchases), all orders or those from ``start`` on."""
    li = t.lineitem.select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    if start is not None:
        o = o.filter(F.col("o_orderdate") >= start)
    p = t.part.select("p_partkey", "p_brand")
    j = li.join(o, li.l_orderkey == o.o_orderkey).join(p, li.l_partkey == p.p_partkey)
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("p_brand").alias("product_id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_orderdate").alias("purchase_date"),
        F.col("l_quantity").alias("items"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("payment"),
    )


def last_order(t: Tables) -> str:
    """The latest order date, as text."""
    return t.orders.agg(F.max("o_orderdate").cast("string").alias("d")).first().d


def txd(t: Tables, weeks: int = TXD_WEEKS) -> DataFrame:
    """TXD: TXB over the last ``weeks`` weeks, counted back from the latest
    order: the history window of the dense weekly grid."""
    start = F.date_trunc("week", F.lit(last_order(t)).cast("timestamp_ntz")) - F.expr(f"INTERVAL {7 * (weeks - 1)} DAYS")
    return txb(t, start.cast("timestamp_ntz"))


def ev_middle(t: Tables):
    """The day 15 days after the first event: drift and set queries compare the time before and from it."""
    return t.events.agg(F.date_add(F.min(F.to_date("ts")), 15).alias("d")).first().d


def ev(t: Tables) -> DataFrame:
    """EV: events as (customer, product, period) purchases."""
    return t.events.select(
        F.col("event_id"),
        F.col("user_id").alias("customer_id"),
        F.col("event_type").alias("product_id"),
        F.col("ts"),
        F.to_date("ts").alias("period"),
        F.col("value"),
        F.lit(1).alias("bought"),
    )


def cust(t: Tables) -> DataFrame:
    """CUST: customer ⋈ nation ⋈ region."""
    c = t.customer.select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
    n = t.nation.select("n_nationkey", "n_regionkey")
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("n_regionkey").alias("region_id"),
        F.col("c_nationkey").alias("zone_id"),
        F.col("c_mktsegment").alias("customer_type"),
        F.col("c_acctbal").alias("x"),
    )


def size_text(partkey: Column, size: Column) -> Column:
    """Size as text in three spellings, chosen by key % 3 (fixture rule)."""
    r = partkey % 3
    return (
        F.when(r == 0, F.concat(size.cast("string"), F.lit("L")))
        .when(r == 1, F.concat(size.cast("string"), F.lit(",5 l")))
        .otherwise(F.lit("n/a"))
    )


def prod(t: Tables) -> DataFrame:
    """PROD: part as products."""
    return t.part.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        size_text(F.col("p_partkey"), F.col("p_size")).alias("size"),
    )


def brand_dim(t: Tables) -> DataFrame:
    """Product dimension at brand grain (TXD): category = brand family (first digit)."""
    return (
        t.part.select(F.col("p_brand").alias("product_id"))
        .distinct()
        .withColumn("category", F.substring(F.col("product_id"), 7, 1))
    )


def ret(t: Tables) -> DataFrame:
    """RET: retail lines; returns carry negative quantity."""
    li = t.lineitem.select("l_orderkey", "l_quantity", "l_extendedprice", "l_returnflag")
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    q = F.when(F.col("l_returnflag") == "R", -F.col("l_quantity")).otherwise(F.col("l_quantity"))
    return j.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderkey").alias("invoice"),
        F.col("o_orderdate").alias("invoice_date"),
        q.alias("quantity"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
    )


def num(t: Tables) -> DataFrame:
    """NUM: numeric columns of lineitem."""
    return t.lineitem.select("l_quantity", "l_extendedprice", "l_discount", "l_tax")


def numn(t: Tables) -> DataFrame:
    """NUMN: NUM with rule-injected nulls and the keys kept for ordering."""
    li = t.lineitem
    return li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_partkey") % 7 == 0, F.lit(None).cast("double")).otherwise(F.col("l_quantity")).alias("l_quantity"),
        F.when(F.col("l_suppkey") % 11 == 0, F.lit(None).cast("double")).otherwise(F.col("l_extendedprice")).alias("l_extendedprice"),
        "l_discount", "l_tax",
    )


def clf(t: Tables) -> DataFrame:
    """CLF: document features ⋈ labels → quality (binary, imbalanced).  Written once
    for each ``Tables``: fits, splits and quantiles read it many times, and the
    features cost a pass over all texts."""
    if "clf" not in t._cache:
        words = F.regexp_extract_all(F.lower(F.col("text")), F.lit(r"\S+"), F.lit(0))
        d = t.documents.select("doc_id", "lang", "source", F.col("n_chars").cast("double").alias("n_chars"), words.alias("_w"))
        feats = d.select("doc_id", "lang", "source", "n_chars", F.size("_w").cast("double").alias("n_words"), "_w").select(
            "doc_id", "lang", "source", "n_chars", "n_words",
            F.when(F.col("n_words") > 0, F.length(F.array_join("_w", "")).cast("bigint") / F.col("n_words")).otherwise(F.lit(0.0)).alias("mean_word_len"),
            F.when(F.col("n_words") > 0, F.size(F.array_distinct("_w")) / F.col("n_words"))
            .otherwise(F.lit(0.0)).alias("distinct_share"),
        )
        t._cache["clf"] = materialize(feats.join(t.labels.select("doc_id", "quality"), "doc_id"))
    return t._cache["clf"]


def sc(t: Tables) -> DataFrame:
    """SC: CLF with a fixed score (md5 bucket blended with a feature), 3 dp so ties occur."""
    c = clf(t)
    b = md5_bucket(F.col("doc_id"), 7, 1000) / 1000.0
    score = F.round(0.5 * b + 0.5 * F.least(F.col("distinct_share"), F.lit(1.0)), 3)
    return c.select("doc_id", F.col("quality").alias("y"), score.alias("score"))


def emb(t: Tables) -> DataFrame:
    return t.embeddings.select("vec_id", "embedding", "label")


def emb_wide(t: Tables, *keep: str) -> tuple[DataFrame, list[str]]:
    """Every dimension of the vectors as a column e0, e1, …, and their names."""
    dims = t.embeddings.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    cols = [f"e{i}" for i in range(dims)]
    return t.embeddings.select(*keep, *[F.get("embedding", F.lit(i)).cast("double").alias(c) for i, c in enumerate(cols)]), cols


def plane(vector: Column) -> list[Column]:
    """A fixed projection of a vector to two numbers: the sums of its even and
    of its odd positions, each over the root of their number."""
    def half(r):
        own = F.filter(vector, lambda v, i: i % 2 == r)
        return F.aggregate(own, F.lit(0.0), lambda s, v: s + v.cast("double")) / F.sqrt(F.size(own))
    return [half(0), half(1)]


def plane_sql(vector: str) -> list[str]:
    """The same projection for the oracles."""
    out = []
    for r in (1, 0):  # list positions count from one
        own = f"list_transform(list_filter({vector}, lambda v, i: i % 2 = {r}), lambda v: CAST(v AS DOUBLE))"
        out.append(f"list_sum({own}) / sqrt(len({own}))")
    return out


def emb_plane(t: Tables) -> DataFrame:
    x, y = plane(F.col("embedding"))
    return t.embeddings.select(F.col("vec_id").alias("id"), x.alias("x"), y.alias("y"))


EMB_PLANE_SQL = "SELECT vec_id AS id, {} AS x, {} AS y FROM embeddings".format(*plane_sql("embedding"))


def grid(t: Tables) -> DataFrame:
    """GRID: each 64-float embedding as an 8×8 frame scaled to 0..255."""
    e = t.embeddings.select("vec_id", F.posexplode("embedding").alias("pos", "e"))
    v = F.round(F.lit(255.0) * (F.col("e") + 0.6) / 1.2)
    return e.select(
        F.col("vec_id").alias("frame"),
        (F.col("vec_id") % 3).cast("int").alias("channel"),
        (F.col("pos") / 8).cast("int").alias("y"),
        (F.col("pos") % 8).cast("int").alias("x"),
        F.least(F.greatest(v, F.lit(0.0)), F.lit(255.0)).cast("int").alias("v"),
    )
