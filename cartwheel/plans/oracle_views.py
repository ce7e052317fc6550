"""DuckDB twins of the fixture views (FIXTURES.md part B), composed into the
oracle SQL of each registered query with ``with_views``."""

from __future__ import annotations

VIEWS: dict[str, str] = {
    "tx": """
SELECT o.o_custkey AS customer_id, l.l_partkey AS product_id, o.o_orderkey AS order_id,
       o.o_orderdate AS purchase_date, l.l_quantity AS items,
       l.l_extendedprice * (1 - l.l_discount) AS payment
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    "txd": """
SELECT o.o_custkey AS customer_id, p.p_brand AS product_id, o.o_orderkey AS order_id,
       o.o_orderdate AS purchase_date, l.l_quantity AS items,
       l.l_extendedprice * (1 - l.l_discount) AS payment
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey
WHERE o.o_orderdate >= date_trunc('week', (SELECT max(o_orderdate) FROM orders)) - INTERVAL 364 DAY""",
    "txb": """
SELECT o.o_custkey AS customer_id, p.p_brand AS product_id, o.o_orderkey AS order_id,
       o.o_orderdate AS purchase_date, l.l_quantity AS items,
       l.l_extendedprice * (1 - l.l_discount) AS payment
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey JOIN part p ON l.l_partkey = p.p_partkey""",
    # C1 on TXB and on TXD: first row per (customer, product, date) by (order_id, items, payment)
    "txc": """
SELECT customer_id, product_id, order_id, purchase_date, items, payment FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, product_id, purchase_date
                               ORDER BY order_id, items, payment) AS _rn
  FROM txd WHERE customer_id IS NOT NULL AND product_id IS NOT NULL
             AND purchase_date IS NOT NULL AND payment > 0) WHERE _rn = 1""",
    "txbc": """
SELECT customer_id, product_id, order_id, purchase_date, items, payment FROM (
  SELECT *, row_number() OVER (PARTITION BY customer_id, product_id, purchase_date
                               ORDER BY order_id, items, payment) AS _rn
  FROM txb WHERE customer_id IS NOT NULL AND product_id IS NOT NULL
             AND purchase_date IS NOT NULL AND payment > 0) WHERE _rn = 1""",
    "ev": """
SELECT event_id, user_id AS customer_id, event_type AS product_id, ts, CAST(ts AS DATE) AS period,
       value, 1 AS bought FROM events""",
    "cust": """
SELECT c.c_custkey AS customer_id, n.n_regionkey AS region_id, c.c_nationkey AS zone_id,
       c.c_mktsegment AS customer_type, c.c_acctbal AS x
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "prod": """
SELECT p_partkey AS product_id, p_brand AS brand, p_type AS category,
       CASE p_partkey % 3 WHEN 0 THEN CAST(p_size AS VARCHAR) || 'L'
                          WHEN 1 THEN CAST(p_size AS VARCHAR) || ',5 l' ELSE 'n/a' END AS size
FROM part""",
    "brand_dim": """
SELECT product_id, substr(product_id, 7, 1) AS category FROM (SELECT DISTINCT p_brand AS product_id FROM part)""",
    "ret": """
SELECT o.o_custkey AS customer_id, o.o_orderkey AS invoice, o.o_orderdate AS invoice_date,
       CASE WHEN l.l_returnflag = 'R' THEN -l.l_quantity ELSE l.l_quantity END AS quantity,
       l.l_extendedprice / l.l_quantity AS price
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "num": "SELECT l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem",
    "numn": """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_partkey % 7 = 0 THEN NULL ELSE l_quantity END AS l_quantity,
       CASE WHEN l_suppkey % 11 = 0 THEN NULL ELSE l_extendedprice END AS l_extendedprice,
       l_discount, l_tax FROM lineitem""",
    "clf": """
SELECT d.doc_id, lang, source, n_chars, n_words,
       CASE WHEN n_words > 0 THEN CAST(list_sum(list_transform(w, lambda x: length(x))) AS DOUBLE) / n_words ELSE 0.0 END AS mean_word_len,
       CASE WHEN n_words > 0 THEN len(list_distinct(w)) / n_words ELSE 0.0 END AS distinct_share,
       lb.quality
FROM (SELECT doc_id, lang, source, CAST(n_chars AS DOUBLE) AS n_chars, w, CAST(len(w) AS DOUBLE) AS n_words
      FROM (SELECT *, list_filter(regexp_split_to_array(lower(text), '\\s+'), lambda x: length(x) > 0) AS w
            FROM documents)) d
JOIN labels lb ON d.doc_id = lb.doc_id""",
    "sc": """
SELECT doc_id, quality AS y,
       round(0.5 * ((('0x' || substr(md5(CAST(doc_id AS VARCHAR) || '|7'), 1, 8))::BIGINT % 1000) / 1000.0)
             + 0.5 * least(distinct_share, 1.0), 3) AS score
FROM clf""",
    "grid": """
SELECT vec_id AS frame, CAST(vec_id % 3 AS INTEGER) AS channel,
       CAST((pos - 1) // 8 AS INTEGER) AS y, CAST((pos - 1) % 8 AS INTEGER) AS x,
       CAST(least(greatest(round(255.0 * (CAST(e AS DOUBLE) + 0.6) / 1.2), 0.0), 255.0) AS INTEGER) AS v
FROM (SELECT vec_id, unnest(embedding) AS e, unnest(generate_series(1, len(embedding))) AS pos FROM embeddings)""",
}

# dependency order of the views (a view may use the ones before it)
ORDER = ["tx", "txb", "txbc", "txd", "txc", "ev", "cust", "prod", "brand_dim", "ret", "num", "numn", "clf", "sc", "grid"]
DEPS = {"txc": ["txd"], "txbc": ["txb"], "sc": ["clf"]}


def with_views(sql: str, *names: str) -> str:
    need: list[str] = []

    def add(n):
        for d in DEPS.get(n, []):
            add(d)
        if n not in need:
            need.append(n)

    for n in names:
        add(n)
    need.sort(key=ORDER.index)
    if not need:
        return sql
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in need)
    body = sql.lstrip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
