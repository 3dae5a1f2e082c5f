"""The registered queries as SQL for an independent engine."""

from __future__ import annotations

SCORE, SEASON, CONTROL, YEAR = 200107, 200007, 200105, 2000


def r(expr: str, name: str | None = None) -> str:
    return f"round({expr}, 6) + CAST(0 AS DOUBLE) AS {name or expr}"


def fine(*names: str) -> str:
    return ", ".join(f"round({n}, 9) + CAST(0 AS DOUBLE) AS {n}" for n in names)


def rr(*names: str) -> str:
    return ", ".join(r(n) for n in names)


def safe(num: str, den: str, eps: str = "1e-6") -> str:
    return f"({num}) / nullif(({den}) + CAST({eps} AS DOUBLE), 0)"


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    CTE[name] = (needs, body)


def with_(sql: str, *needs: str) -> str:
    """Prefix a query with the views it needs, in dependency order."""
    done: list[str] = []

    def visit(name: str) -> None:
        for n in CTE[name][0]:
            visit(n)
        if name not in done:
            done.append(name)

    for n in needs:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in done) + "\n" + sql


FACTS = """SELECT {customer} AS customer_id, {product} AS product_id,
  CAST(year(o_orderdate)*100 + month(o_orderdate) AS INTEGER) AS periodo,
  max(CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END) AS plan_flag,
  sum(l_quantity) AS request_tn,
  sum(CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END) AS tn
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey
GROUP BY 1, 2, 3"""
cte("sales", FACTS.format(customer="c_nationkey", product="l_suppkey"))
cte("sparse", FACTS.format(customer="o_custkey", product="l_suppkey % 10"))
cte(
    "sale_lines",
    """SELECT c_nationkey AS customer_id, l_suppkey AS product_id,
  CAST(year(o_orderdate)*100 + month(o_orderdate) AS INTEGER) AS periodo,
  CASE WHEN l_discount >= 0.09 THEN 1 ELSE 0 END AS plan_flag, l_quantity AS request_tn,
  CASE WHEN l_returnflag <> 'R' THEN l_quantity ELSE 0.0 END AS tn
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON c_custkey = o_custkey""",
)
cte(
    "products",
    """SELECT s_suppkey AS product_id, r_name AS cat1, s_nationkey AS cat2, n_name AS cat3, s_suppkey % 10 AS brand,
  s_acctbal AS sku_size
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
)
cte(
    "stocks",
    """SELECT * FROM (SELECT l_suppkey AS product_id, CAST(year(o_orderdate)*100 + month(o_orderdate) AS INTEGER) AS periodo,
  sum(CASE l_returnflag WHEN 'R' THEN l_quantity WHEN 'N' THEN -l_quantity ELSE 0 END) AS stock_final
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY 1, 2) x WHERE periodo >= 200007""",
)
cte("requested", "SELECT s_suppkey AS product_id FROM supplier WHERE s_suppkey % 10 <> 0 UNION ALL SELECT -1")
cte(
    "obs",
    """SELECT product_id, periodo, sum(tn) AS tn FROM sales
WHERE product_id IN (SELECT product_id FROM requested) GROUP BY 1, 2""",
    "sales", "requested",
)


def idx(p: str) -> str:
    return f"(({p}) // 100 * 12 + ({p}) % 100 - 1)"


def per(i: str) -> str:
    return f"CAST(({i}) // 12 * 100 + ({i}) % 12 + 1 AS INTEGER)"


def dense(source: str, keys: str) -> str:
    on = " AND ".join(f"g.{k.strip()} = x.{k.strip()}" for k in keys.split(","))
    cols = ", ".join(f"g.{k.strip()}" for k in keys.split(","))
    return f"""SELECT {cols}, {per('g.i')} AS periodo, coalesce(x.tn, 0.0) AS tn
FROM (SELECT {keys}, unnest(generate_series(min({idx('periodo')}), max({idx('periodo')}))) AS i FROM {source} GROUP BY {keys}) g
LEFT JOIN {source} x ON {on} AND {idx('x.periodo')} = g.i"""


cte("hist", dense("obs", "product_id"), "obs")


def filled(source: str) -> str:
    return f"""SELECT customer_id, product_id, periodo, plan_flag, request_tn, tn FROM {source} UNION ALL
SELECT cf.customer_id, pf.product_id, m.periodo,
  CASE WHEN m.periodo BETWEEN w.lo AND w.hi THEN 1 ELSE 0 END, 0.0, 0.0
FROM (SELECT product_id, min(periodo) a, max(periodo) b FROM {source} GROUP BY 1) pf
CROSS JOIN (SELECT customer_id, min(periodo) a FROM {source} GROUP BY 1) cf
CROSS JOIN (SELECT DISTINCT periodo FROM {source}) m
LEFT JOIN (SELECT product_id, min(periodo) lo, max(periodo) hi FROM {source} WHERE plan_flag = 1 GROUP BY 1) w
  ON w.product_id = pf.product_id
WHERE m.periodo BETWEEN pf.a AND pf.b AND m.periodo >= cf.a AND NOT EXISTS (
  SELECT 1 FROM {source} s WHERE s.customer_id = cf.customer_id AND s.product_id = pf.product_id AND s.periodo = m.periodo)"""


cte("panel", filled("sales"), "sales")
cte("sparse_panel", filled("sparse"), "sparse")
cte("req_panel", "SELECT * FROM panel WHERE product_id IN (SELECT product_id FROM requested)", "panel", "requested")

PAIR_W = "PARTITION BY customer_id, product_id ORDER BY periodo"
PROD_W = "PARTITION BY product_id ORDER BY periodo"


def over(expr: str, w: str, size: int | None = None) -> str:
    frame = "" if size is None else f" ROWS BETWEEN {size - 1} PRECEDING AND CURRENT ROW"
    return f"{expr} OVER ({w}{frame})"


SQL_ROLL = {"rmean": "avg", "rstd": "stddev_samp", "rmax": "max", "rmin": "min", "rmed": "median"}


def roll(kind: str, x: str, n: int, w: str) -> str:
    return f"CASE WHEN {over(f'count({x})', w, n)} = {n} THEN {over(f'{SQL_ROLL[kind]}({x})', w, n)} END"


def rolls(x: str, sizes, w: str, kinds) -> str:
    return ", ".join(r(roll(k, x, n, w), f"{k}_{n}") for n in sizes for k in kinds)


def lags(x: str, ns, w: str, prefix: str = "lag_") -> str:
    return ", ".join(f"{over(f'lag({x}, {n})', w)} AS {prefix}{n}" for n in ns)


G3 = "customer_id, product_id, periodo"
STOCK_LAGS = (1, 2, 3, 6, 12)
SQL: dict[str, str] = {}

# --- sources and panel -----------------------------------------------------

SQL["run_log_union"] = with_(
    """SELECT product_id, CAST(count(*) AS DOUBLE) AS meses, CAST(NULL AS INTEGER) AS ultimo FROM obs GROUP BY 1
UNION ALL SELECT product_id, sum(tn), max(periodo) FROM obs GROUP BY 1""",
    "obs",
)
SQL["anti_resume"] = with_(
    f"SELECT product_id FROM requested WHERE product_id NOT IN (SELECT product_id FROM obs WHERE periodo = {SCORE})",
    "obs",
)
SQL["one_row_per_month"] = with_(
    f"SELECT {G3}, plan_flag, request_tn, tn FROM sales", "sales"
)
SQL["densify_monthly"] = with_("SELECT product_id, periodo, tn FROM hist", "hist")
SQL["zero_fill_panel"] = with_(f"SELECT {G3}, plan_flag, request_tn, tn FROM panel", "panel")
SQL["pair_panel"] = SQL["zero_fill_panel"]
cte("line_panel", filled("sale_lines"), "sale_lines")
SQL["zero_fill_lines"] = with_(
    """SELECT periodo, product_id, count(*) AS filas, sum(tn) AS tn, CAST(sum(plan_flag) AS BIGINT) AS en_plan
FROM line_panel GROUP BY 1, 2""",
    "line_panel",
)
SQL["plan_flag_range"] = with_(
    f"SELECT {G3}, plan_flag FROM panel p WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.customer_id = p.customer_id "
    "AND s.product_id = p.product_id AND s.periodo = p.periodo)",
    "panel",
)
SQL["lives"] = with_(
    """SELECT 'producto' AS tipo, product_id AS id, min(periodo) AS desde, max(periodo) AS hasta,
  min(periodo) FILTER (plan_flag = 1) AS plan_from, max(periodo) FILTER (plan_flag = 1) AS plan_to FROM sales GROUP BY 2
UNION ALL SELECT 'cliente', customer_id, min(periodo), NULL, NULL, NULL FROM sales GROUP BY 2""",
    "sales",
)
SQL["period_functions"] = with_(
    f"""SELECT product_id, periodo, {per(idx('periodo') + ' + 2')} AS mas_2, {per(idx('periodo') + ' - 13')} AS menos_13,
  make_date(periodo // 100, periodo % 100, 1) AS ds, CAST(make_date(periodo // 100, periodo % 100, 1) AS TIMESTAMP) AS marca,
  periodo AS vuelta, CAST(periodo % 100 AS INTEGER) AS mes, CAST(periodo // 100 AS INTEGER) AS anio FROM obs""",
    "obs",
)
LAG_COLS = lags("tn", range(12), PAIR_W, "tn_")
SQL["lag_table_positional"] = with_(f"SELECT {G3}, {over('lead(tn, 2)', PAIR_W)} AS clase, {LAG_COLS} FROM sales", "sales")
cte("pair_hist", dense("sales", "customer_id, product_id"), "sales")
SQL["lag_table_calendar"] = with_(f"SELECT {G3}, {over('lead(tn, 2)', PAIR_W)} AS clase, {LAG_COLS} FROM pair_hist", "pair_hist")
SQL["last_observed"] = with_(
    f"SELECT {G3}, tn FROM sales QUALIFY row_number() OVER (PARTITION BY customer_id, product_id ORDER BY periodo DESC) = 1",
    "sales",
)
cte("target_rows", f"SELECT product_id, periodo, {over('lead(tn, 2)', PROD_W)} AS target, {over('lag(tn, 11)', PROD_W)} AS lag_11 FROM hist", "hist")
SQL["anchor_split"] = with_(
    f"""SELECT a AS anchor, count(*) FILTER (periodo <= cut AND target IS NOT NULL) AS train_rows,
  count(*) FILTER (periodo = a AND target IS NOT NULL) AS val_rows
FROM target_rows, (VALUES ({SEASON}, 200005), ({CONTROL}, 200103)) v(a, cut) GROUP BY a""",
    "target_rows",
)
SQL["complete_rows"] = with_(
    "SELECT product_id, periodo, target FROM target_rows WHERE target IS NOT NULL AND lag_11 IS NOT NULL", "target_rows"
)

# --- windows ---------------------------------------------------------------

SQL["rolling_full_window"] = with_(
    f"SELECT {G3}, {rolls('tn', (3, 6, 9, 12), PAIR_W, ('rmean', 'rstd', 'rmax', 'rmin'))} FROM panel", "panel"
)
SQL["rolling_median"] = with_(f"SELECT {G3}, {rolls('tn', (3, 6, 9, 12, 24), PAIR_W, ('rmed',))} FROM panel", "panel")
SQL["rolling_min1"] = with_(
    f"SELECT {G3}, {r(over('avg(tn)', PAIR_W, 12), 'media_12')}, "
    + ", ".join(f"{over('sum(tn)', PAIR_W, n)} AS suma_{n}" for n in (3, 6, 12))
    + " FROM panel",
    "panel",
)


def ewm_sql(x: str, span: int, source: str, name: str) -> str:
    """Recursive definition summed per row: weights fall by (1 - alpha) per row back."""
    keep = 1 - 2 / (span + 1)
    return f"""SELECT a.customer_id, a.product_id, a.periodo,
  sum(b.{x} * pow({keep!r}, a.i - b.i)) / sum(pow({keep!r}, a.i - b.i)) AS {name}
FROM {source} a JOIN {source} b ON a.customer_id = b.customer_id AND a.product_id = b.product_id AND b.i <= a.i
GROUP BY 1, 2, 3"""


cte("numbered", f"SELECT {G3}, tn, CAST({over('row_number()', PAIR_W)} - 1 AS INTEGER) AS i FROM panel", "panel")
cte("e3", ewm_sql("tn", 3, "numbered", "ewm_3"), "numbered")
cte("e6", ewm_sql("tn", 6, "numbered", "ewm_6"), "numbered")
SQL["ewm"] = with_(f"SELECT {G3}, {fine('ewm_3', 'ewm_6')} FROM e3 JOIN e6 USING ({G3})", "e3", "e6")
RUN = "PARTITION BY customer_id, product_id ORDER BY periodo ROWS UNBOUNDED PRECEDING"
SQL["months_since_event"] = with_(
    f"""SELECT {G3}, i - {over('max(CASE WHEN tn > 0 THEN i END)', RUN)} AS meses,
  {over('arg_max(tn, i) FILTER (tn > 0)', RUN)} AS ultima FROM numbered""",
    "numbered",
)
REGIME = "CASE WHEN {x} = 0 THEN 0 WHEN {x} <= 2 THEN 1 WHEN {x} <= 5 THEN 2 ELSE 3 END"
SQL["cumulative_buys"] = with_(
    f"""SELECT {G3}, compras, {REGIME.format(x='compras')} AS regimen FROM (
  SELECT {G3}, CAST(sum(CAST(tn > 0 AS INT)) OVER ({RUN}) AS BIGINT) AS compras FROM panel)""",
    "panel",
)

# --- product features ------------------------------------------------------

cte("uni", "SELECT periodo, sum(tn) AS u FROM hist GROUP BY 1", "hist")
cte("hist_cat", "SELECT h.*, p.cat1, p.cat2, p.cat3, p.brand, p.sku_size FROM hist h LEFT JOIN products p USING (product_id)", "hist", "products")
cte("cat", "SELECT cat3, periodo, sum(tn) AS c FROM hist_cat GROUP BY 1, 2", "hist_cat")
for column, code in (("cat1", "cat1"), ("cat2", "cat2"), ("cat3", "cat3_cat"), ("brand", "brand")):
    cte(f"code_{code}", f"SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS k FROM (SELECT DISTINCT CAST({column} AS VARCHAR) AS v FROM products)", "products")
cte(
    "wide",
    f"""SELECT h.product_id, h.periodo, h.tn, u.u, c.c, h.sku_size, k1.k AS cat1, k2.k AS cat2, k3.k AS cat3_cat, k4.k AS brand,
  CAST(s.stock_final IS NOT NULL AS INT) AS stock_disponible, CAST(coalesce(s.stock_final < 0, false) AS INT) AS stock_negativo,
  coalesce(s.stock_final, 0.0) AS stock_0
FROM hist_cat h JOIN uni u USING (periodo) LEFT JOIN cat c ON c.cat3 = h.cat3 AND c.periodo = h.periodo
LEFT JOIN code_cat1 k1 ON k1.v = h.cat1 LEFT JOIN code_cat2 k2 ON k2.v = CAST(h.cat2 AS VARCHAR)
LEFT JOIN code_cat3_cat k3 ON k3.v = h.cat3 LEFT JOIN code_brand k4 ON k4.v = CAST(h.brand AS VARCHAR)
LEFT JOIN stocks s ON s.product_id = h.product_id AND s.periodo = h.periodo""",
    "hist_cat", "uni", "cat", "stocks", "code_cat1", "code_cat2", "code_cat3_cat", "code_brand",
)
SIZES = (3, 6, 9, 12)
KINDS = ("rmean", "rstd", "rmax", "rmin")
cte(
    "fw",
    f"""SELECT *, {lags('tn', range(13), PROD_W)},
  {', '.join(roll(k, 'tn', n, PROD_W) + f' AS {k}_{n}' for n in SIZES for k in KINDS)},
  CASE WHEN {over('count(*)', PROD_W, 12)} = 12 THEN CAST({over('sum(CAST(tn = 0 AS INT))', PROD_W, 12)} AS BIGINT) END AS ceros_12,
  CAST({over('row_number()', PROD_W)} - 1 AS INTEGER) AS i, {lags('u', (12,), PROD_W, 'u_')}, {lags('c', (12,), PROD_W, 'c_')},
  {lags('stock_0', STOCK_LAGS, PROD_W, 'stock_lag_')}, {over('lead(tn, 2)', PROD_W)} AS target FROM wide""",
    "wide",
)
P_EXPR = {
    "delta_1": "tn - lag_1", "delta_12": "tn - lag_12", "ratio_1": safe("tn", "lag_1"), "ratio_12": safe("tn", "lag_12"),
    "tn_vs_rmean12": safe("tn", "rmean_12"), "momentum_3_12": safe("rmean_3", "rmean_12"),
    "share_universo": safe("tn", "u"), "share_cat3": safe("tn", "c"), "universo_yoy": safe("u", "u_12"),
    "cat3_yoy": safe("c", "c_12"), "stock_delta_1": "stock_0 - stock_lag_1", "stock_delta_12": "stock_0 - stock_lag_12",
    "stock_vs_tn": safe("stock_0", "abs(tn)", "1e-3"), "stock_cobertura_3": safe("stock_0", "abs(rmean_3)", "1e-3"),
    "stock_cobertura_12": safe("stock_0", "abs(rmean_12)", "1e-3"),
    "meses_desde_venta": f"i - max(CASE WHEN tn > 0 THEN i END) OVER ({PROD_W} ROWS UNBOUNDED PRECEDING)",
    "mes": "CAST(periodo % 100 AS INTEGER)",
}
P_WHOLE = {"meses_desde_venta", "mes", "ceros_12", "cat1", "cat2", "cat3_cat", "brand", "stock_disponible", "stock_negativo"}


def product_sql(names, extra: str = "") -> str:
    cols = ", ".join(
        f"{P_EXPR.get(n, n)} AS {n}" if n in P_WHOLE else r(P_EXPR.get(n, n), n) for n in names
    )
    return with_(f"SELECT product_id, periodo, {cols}{extra} FROM fw", "fw")


DELTAS = ["delta_1", "delta_12", "ratio_1", "ratio_12", "tn_vs_rmean12", "momentum_3_12"]
SHARES = ["share_universo", "share_cat3", "universo_yoy", "cat3_yoy"]
ATTRS = ["cat1", "cat2", "cat3_cat", "brand", "sku_size"]
STOCK = ["stock_disponible", "stock_negativo", "stock_0", *[f"stock_lag_{n}" for n in STOCK_LAGS],
         "stock_delta_1", "stock_delta_12", "stock_vs_tn", "stock_cobertura_3", "stock_cobertura_12"]
P_LAGS = [f"lag_{n}" for n in range(13)]
P_ROLLS = [f"{k}_{n}" for n in SIZES for k in KINDS]
SQL["product_lags"] = product_sql(["tn", *P_LAGS, "target"])
SQL["deltas_ratios"] = product_sql(DELTAS)
SQL["intermittency"] = product_sql(["ceros_12", "meses_desde_venta", "mes"])
SQL["category_share"] = product_sql(SHARES)
SQL["product_attributes"] = product_sql(ATTRS)
SQL["stock_features"] = product_sql(STOCK)
SQL["product_feature_table"] = product_sql(
    ["tn", *P_LAGS, *P_ROLLS, *DELTAS, "ceros_12", "meses_desde_venta", "mes", *SHARES, *ATTRS, *STOCK, "target"]
)
cte("obs_lags", f"SELECT product_id, periodo, {lags('tn', range(12), PROD_W)}, {over('lead(tn, 2)', PROD_W)} AS target FROM obs", "obs")
cte("stock_lags", f"SELECT product_id, periodo, stock_final, {lags('stock_final', (1, 2), PROD_W, 'stock_lag_')} FROM stocks", "stocks")
_MEAN12 = (
    "(" + " + ".join(f"coalesce(lag_{n}, 0)" for n in range(12)) + ") / ("
    + " + ".join(f"CAST(lag_{n} IS NOT NULL AS INT)" for n in range(12)) + ")"
)
SQL["stock_regression_table"] = with_(
    f"""SELECT product_id, periodo, {rr('mean12', 'stock_final', 'stock_lag_1', 'stock_lag_2')},
  {r('stock_final - stock_lag_1', 'stock_delta_1')}, {r(safe('stock_final', 'abs(mean12)', '1e-3'), 'stock_cobertura_12')},
  CAST(stock_final < 0 AS INT) AS stock_negativo, {r('target')}
FROM (SELECT *, {_MEAN12} AS mean12 FROM obs_lags) LEFT JOIN stock_lags USING (product_id, periodo)""",
    "obs_lags", "stock_lags",
)

# --- pair features ---------------------------------------------------------

cte("lev", f"SELECT *, greatest({over('avg(tn)', PAIR_W, 12)}, 1e-3) AS promedio_nivel, {over('lead(tn, 2)', PAIR_W)} AS target_tn, CAST({over('row_number()', PAIR_W)} - 1 AS INTEGER) AS i FROM panel", "panel")
cte("esc", "SELECT *, tn / promedio_nivel AS x FROM lev", "lev")
SQL["pair_scaling"] = with_(
    f"""SELECT {G3}, {r('promedio_nivel')}, {r('x', 'tn_esc')}, {r('target_tn')}, {r('target_tn / promedio_nivel', 'target')},
  CASE WHEN target_tn IS NOT NULL THEN CAST(target_tn > 0 AS INT) END AS target_buy FROM esc""",
    "esc",
)
PAIR_LAGS = (*range(13), 18, 24)
SQL["pair_lags"] = with_(
    f"SELECT {G3}, " + ", ".join(r(over(f"lag(x, {n})", PAIR_W), f"lag_{n}") for n in PAIR_LAGS) + " FROM esc", "esc"
)
SQL["pair_rolling"] = with_(
    f"SELECT {G3}, {rolls('x', (3, 6, 9, 12, 24), PAIR_W, ('rmean', 'rstd', 'rmin', 'rmax', 'rmed')) } FROM esc", "esc"
)
# the Spark query keeps means, medians, minima and maxima under their 'rm' prefix, and deviations
cte("esc_lags", f"SELECT {G3}, x, {lags('x', (1, 2, 3, 5, 12), PAIR_W, 'l')} FROM esc", "esc")
cte("esc_numbered", f"SELECT {G3}, x, i FROM esc", "esc")
cte("x3", ewm_sql("x", 3, "esc_numbered", "ewm_3"), "esc_numbered")
cte("x6", ewm_sql("x", 6, "esc_numbered", "ewm_6"), "esc_numbered")
SQL["pair_deltas"] = with_(
    f"""SELECT {G3}, {r('x - l1', 'delta_1')}, {r('x - l12', 'delta_12')}, {r('l1 - l2', 'dlag_1_2')}, {r('l1 - l3', 'dlag_1_3')},
  {r('(x - l5) / 5', 'slope_5')}, {r(safe('x', 'l1'), 'ratio_1')}, {r(safe('x', 'l12'), 'ratio_12')}, {fine('ewm_3', 'ewm_6')}
FROM esc_lags JOIN x3 USING ({G3}) JOIN x6 USING ({G3})""",
    "esc_lags", "x3", "x6",
)
cte("bought", f"SELECT {G3}, CAST(tn > 0 AS INT) AS b, CAST({over('row_number()', PAIR_W)} - 1 AS INTEGER) AS i FROM panel", "panel")
SQL["pair_purchases"] = with_(
    f"""SELECT {G3}, {lags('b', (0, 1, 2, 3, 6, 12), PAIR_W, 'buy_lag_')},
  {', '.join(f"CAST({over('sum(b)', PAIR_W, n)} AS BIGINT) AS buys_{n}" for n in (3, 6, 12))},
  i - {over('max(CASE WHEN b = 1 THEN i END)', RUN)} AS months_since_buy FROM bought""",
    "bought",
)
cte("tprod", "SELECT product_id, periodo, sum(tn) AS t FROM panel GROUP BY 1, 2", "panel")
cte("tprod_y", f"SELECT *, {safe('t', over('lag(t, 12)', PROD_W))} AS yoy FROM tprod", "tprod")
cte("tcli", "SELECT customer_id, periodo, sum(tn) AS t FROM panel GROUP BY 1, 2", "panel")
cte("tcli_y", f"SELECT *, {safe('t', 'lag(t, 12) OVER (PARTITION BY customer_id ORDER BY periodo)')} AS yoy FROM tcli", "tcli")
cte("tcat", "SELECT p.cat3, t.periodo, sum(t.t) AS t FROM tprod t JOIN products p USING (product_id) GROUP BY 1, 2", "tprod", "products")
cte("tuni", f"SELECT periodo, {safe('sum(tn)', 'lag(sum(tn), 12) OVER (ORDER BY periodo)')} AS yoy FROM panel GROUP BY 1", "panel")
cte(
    "sides",
    f"""SELECT n.customer_id, n.product_id, n.periodo, n.tn, a.t AS tot_prod, {safe('n.tn', 'a.t')} AS share_prod, {safe('n.tn', 'b.t')} AS share_cli,
  {safe('n.tn', 'c.t')} AS share_cat3, a.yoy AS yoy_prod, b.yoy AS yoy_cli, u.yoy AS yoy_uni
FROM panel n JOIN tprod_y a USING (product_id, periodo) JOIN tcli_y b ON b.customer_id = n.customer_id AND b.periodo = n.periodo
LEFT JOIN products p ON p.product_id = n.product_id LEFT JOIN tcat c ON c.cat3 = p.cat3 AND c.periodo = n.periodo
JOIN tuni u ON u.periodo = n.periodo""",
    "panel", "tprod_y", "tcli_y", "tcat", "tuni", "products",
)
SQL["pair_shares"] = with_(
    f"SELECT {G3}, {rr('share_prod', 'share_cli', 'share_cat3', 'yoy_prod', 'yoy_cli', 'yoy_uni')} FROM sides", "sides"
)
cte("fills", f"SELECT {G3}, plan_flag, {safe('tn', 'request_tn')} AS f FROM panel", "panel")
SQL["fill_rate_lags"] = with_(
    f"SELECT {G3}, plan_flag AS ppc, {r('f', 'fill_rate')}, "
    + ", ".join(r(over(f"lag(f, {n})", PAIR_W), f"fill_rate_lag{n}") for n in (1, 2, 3))
    + " FROM fills",
    "fills",
)
cte(
    "pstock",
    f"""SELECT s.*, stock_final, coalesce(stock_final, 0.0) AS stock_0 FROM sides s LEFT JOIN stocks k
  ON k.product_id = s.product_id AND k.periodo = s.periodo""",
    "sides", "stocks",
)
cte("pstock_l", f"SELECT *, {lags('stock_0', STOCK_LAGS, PAIR_W, 'stock_lag_')} FROM pstock", "pstock")
SQL["pair_stock"] = with_(
    f"""SELECT {G3}, CAST(stock_final IS NOT NULL AS INT) AS stock_available, {r('stock_0')},
  CAST(coalesce(stock_final < 0, false) AS INT) AS stock_negative, {rr(*[f'stock_lag_{n}' for n in STOCK_LAGS])},
  {r('stock_0 - stock_lag_1', 'stock_delta_1')}, {r('stock_0 - stock_lag_12', 'stock_delta_12')},
  {r(safe('stock_0', 'tot_prod'), 'stock_vs_prod')} FROM pstock_l""",
    "pstock_l",
)
SQL["collapse_to_products"] = with_(
    f"SELECT product_id, {r('sum(tn)', 'tn')}, {r('sum(target_tn)', 'tn_real')} FROM lev WHERE periodo = {CONTROL} GROUP BY 1", "lev"
)

# --- structure -------------------------------------------------------------

cte("life1", f"SELECT *, CAST(tn > 0 AS INT) AS buy FROM req_panel", "req_panel")
cte("life2", f"SELECT *, coalesce({over('lag(buy)', PAIR_W)}, 0) AS b1, sum(buy) OVER ({RUN}) AS cum FROM life1", "life1")
cte("life3", f"SELECT *, CAST({over('sum(b1)', PAIR_W, 12)} AS BIGINT) AS prior_12 FROM life2", "life2")
cte(
    "life",
    f"""SELECT *, CAST(buy = 1 AND prior_12 = 0 AS INT) AS is_new, CAST(buy = 1 AND prior_12 > 0 AS INT) AS is_repeat,
  CAST(buy = 0 AND b1 = 1 AS INT) AS is_churn, {REGIME.format(x='cum')} AS regime FROM life3""",
    "life3",
)
SQL["lifecycle_flags"] = with_(f"SELECT {G3}, buy, prior_12, is_new, is_repeat, is_churn, regime FROM life", "life")
cte(
    "struct",
    f"""SELECT product_id, periodo, count(*) AS cp_pairs, CAST(sum(buy) AS BIGINT) AS cp_buyers,
  sum(buy) / greatest(count(*), 1) AS cp_buyer_rate, sum(tn) / greatest(sum(buy), 1) AS cp_tn_per_buyer,
  sum(request_tn) AS cp_request_tn, {safe('sum(tn)', 'sum(request_tn)')} AS cp_fill_rate,
  {safe('sum(tn * tn)', 'sum(tn) * sum(tn)')} AS cp_hhi, {safe('max(tn)', 'sum(tn)')} AS cp_top_share,
  CAST(sum(is_new) AS BIGINT) AS cp_new_buyers, CAST(sum(is_repeat) AS BIGINT) AS cp_repeat_buyers,
  CAST(sum(is_churn) AS BIGINT) AS cp_churned,
  {', '.join(f'count(*) FILTER (regime = {n}) / greatest(count(*), 1) AS cp_regime{n}_share' for n in range(4))}
FROM life GROUP BY 1, 2""",
    "life",
)
CP_WHOLE = ["cp_pairs", "cp_buyers", "cp_new_buyers", "cp_repeat_buyers", "cp_churned"]
CORE = ["cp_pairs", "cp_buyers", "cp_buyer_rate", "cp_tn_per_buyer", "cp_request_tn", "cp_fill_rate", "cp_hhi", "cp_top_share"]
LIFE = ["cp_new_buyers", "cp_repeat_buyers", "cp_churned", *[f"cp_regime{n}_share" for n in range(4)]]
SQL["structure_agg"] = with_(
    "SELECT product_id, periodo, " + ", ".join(c if c in CP_WHOLE else r(c) for c in [*CORE, *LIFE]) + " FROM struct", "struct"
)


def cp_lag(c: str, n: int) -> str:
    e = over(f"lag({c}, {n})", PROD_W)
    return f"{e} AS {c}_lag{n}" if c in CP_WHOLE else r(e, f"{c}_lag{n}")


SQL["structure_lags"] = with_(
    "SELECT product_id, periodo, "
    + ", ".join([cp_lag(c, n) for c in CORE for n in (0, 1, 3, 12)] + [cp_lag(c, n) for c in LIFE for n in (0, 12)])
    + " FROM struct",
    "struct",
)

# --- baselines and evaluation ---------------------------------------------


def add(p: int, k: int) -> int:
    i = p // 100 * 12 + p % 100 - 1 + k
    return i // 12 * 100 + i % 12 + 1


def last_sql(a: int) -> str:
    return f"SELECT product_id, tn FROM obs WHERE periodo = {a}"


def mean_sql(a: int) -> str:
    return f"SELECT product_id, avg(tn) AS tn FROM obs WHERE periodo BETWEEN {add(a, -11)} AND {a} GROUP BY 1"


def same_sql(a: int) -> str:
    return f"""SELECT m.product_id, coalesce(f.tn, m.tn) AS tn FROM ({mean_sql(a)}) m
LEFT JOIN (SELECT product_id, tn FROM obs WHERE periodo = {add(a, -10)}) f USING (product_id)"""


def submit_sql(pred: str, a: int) -> str:
    return f"""SELECT q.product_id, greatest(coalesce(p.tn, m.tn, 0.0), 0.0) AS tn FROM requested q
LEFT JOIN ({pred}) p USING (product_id) LEFT JOIN ({mean_sql(a)}) m USING (product_id)"""


def error_sql(pred: str, a: int) -> str:
    return f"""SELECT sum(abs(t.tn - coalesce(p.tn, 0))) / sum(t.tn) AS wape FROM (SELECT product_id, tn FROM obs WHERE periodo = {add(a, 2)}) t
LEFT JOIN ({pred}) p USING (product_id)"""


SQL["naive_last"] = with_(last_sql(SCORE), "obs")
SQL["naive_mean12"] = with_(f"SELECT product_id, {r('tn')} FROM ({mean_sql(SCORE)})", "obs")
SQL["naive_same_month"] = with_(f"SELECT product_id, {r('tn')} FROM ({same_sql(SCORE)})", "obs")
SQL["forecast_fallback"] = with_(f"SELECT product_id, {r('tn')} FROM ({submit_sql(same_sql(SCORE), SCORE)})", "obs")
SQL["forecast_check"] = with_("SELECT count(*) AS filas, count(DISTINCT product_id) AS ids FROM requested", "requested")
SQL["wape_total"] = with_(f"SELECT {r('wape')} FROM ({error_sql(submit_sql(same_sql(CONTROL), CONTROL), CONTROL)})", "obs")
SQL["product_wape"] = with_(
    f"""SELECT {r('sum(abs(y - p)) / sum(y)', 'wape')} FROM (SELECT product_id, sum(tn) AS p, sum(target_tn) AS y FROM lev
  WHERE periodo = {CONTROL} AND target_tn IS NOT NULL GROUP BY 1)""",
    "lev",
)
SQL["pooled_wape"] = with_(
    f"""SELECT {r('sum(abs(s.tn - p.tn)) / sum(s.tn)', 'wape')}
FROM (SELECT product_id, {per(idx('periodo') + ' + 2')} AS t, sum(tn) AS tn FROM panel WHERE periodo IN ({add(CONTROL, -2)}, {add(CONTROL, -1)}, {CONTROL}) GROUP BY 1, 2) p
JOIN (SELECT product_id, periodo, sum(tn) AS tn FROM sales GROUP BY 1, 2) s ON s.product_id = p.product_id AND s.periodo = p.t""",
    "panel",
)


def grid_sql(a: int) -> str:
    return f"""SELECT scale, sum(abs(y - p * scale)) / sum(y) AS wape
FROM (SELECT t.tn AS y, coalesce(m.tn, 0) AS p FROM (SELECT product_id, tn FROM obs WHERE periodo = {add(a, 2)}) t LEFT JOIN ({mean_sql(a)}) m USING (product_id))
CROSS JOIN (SELECT CAST(0.3 AS DOUBLE) + i * CAST(0.01 AS DOUBLE) AS scale FROM range(101) g(i)) GROUP BY scale"""


def best_sql(a: int) -> str:
    return f"SELECT * FROM ({grid_sql(a)}) ORDER BY wape, scale LIMIT 1"


SQL["calibration_grid"] = with_(f"SELECT {rr('scale', 'wape')} FROM ({grid_sql(CONTROL)})", "obs")
SQL["calibration_best"] = with_(f"SELECT {rr('scale', 'wape')} FROM ({best_sql(CONTROL)})", "obs")
SQL["calibration_median"] = with_(
    f"SELECT 'mean_12' AS variant, {r('median(scale)', 'calibration')} FROM (SELECT * FROM ({best_sql(SEASON)}) UNION ALL SELECT * FROM ({best_sql(CONTROL)}))",
    "obs",
)
MODELS = {"last_month": last_sql, "mean_12": mean_sql, "same_month": same_sql}
cte(
    "runs",
    " UNION ALL ".join(
        f"SELECT '{m}' AS candidate, {a} AS anchor, wape FROM ({error_sql(f(a), a)})" for a in (SEASON, CONTROL) for m, f in MODELS.items()
    ),
    "obs",
)
cte(
    "runs_wide",
    f"SELECT candidate, max(wape) FILTER (anchor = {SEASON}) AS season, max(wape) FILTER (anchor = {CONTROL}) AS control FROM runs GROUP BY 1",
    "runs",
)
SQL["pivot_scores"] = with_(f"SELECT candidate, {rr('season', 'control')} FROM runs_wide", "runs_wide")
SQL["selection_score"] = with_(
    f"SELECT candidate, {rr('season', 'control')}, {r('season * 0.7 + control * 0.3', 'score_seleccion')} FROM runs_wide", "runs_wide"
)
SQL["pivot_months"] = with_(
    "SELECT product_id, " + ", ".join(f"sum(tn) FILTER (periodo = {add(SCORE, -n)}) AS tn_{add(SCORE, -n)}" for n in range(78, -1, -1)) + " FROM obs GROUP BY 1",
    "obs",
)
cte("two", f"SELECT a.product_id, a.tn AS x, b.tn AS y FROM ({mean_sql(SCORE)}) a JOIN ({same_sql(SCORE)}) b USING (product_id)", "obs")
cte("mixed", "SELECT w AS weight, product_id, (1 - w) * x + w * y AS v FROM two, (VALUES (CAST(0.1 AS DOUBLE)), (0.2), (0.3)) t(w)", "two")
SQL["blend_weights"] = with_(f"SELECT {r('weight')}, product_id, {r('greatest(v, 0)', 'tn')} FROM mixed", "mixed")
SQL["blend_totals"] = with_(f"SELECT {r('weight')}, {r('sum(v)', 'tn_total')} FROM mixed GROUP BY weight", "mixed")
SQL["blend_diagnostics"] = with_(f"SELECT {r('corr(x, y)', 'correlation')}, {r('sum(abs(x - y)) / sum(x)', 'disagreement')} FROM two", "two")

_windows = (add(CONTROL, -1), CONTROL)
cte(
    "back",
    " UNION ALL ".join(
        f"SELECT '{m}' AS model, t.tn AS y, coalesce(p.tn, 0) AS p FROM (SELECT product_id, tn FROM obs WHERE periodo = {add(a, 2)}) t LEFT JOIN ({f(a)}) p USING (product_id)"
        for a in _windows for m, f in MODELS.items()
    ),
    "obs",
)
SQL["leaderboard"] = with_(f"SELECT model, {r('sum(abs(y - p)) / sum(y)', 'score')} FROM back GROUP BY 1", "back")
SQL["leaderboard_rmse"] = with_(f"SELECT model, {r('sqrt(avg((y - p) * (y - p)))', 'score')} FROM back GROUP BY 1", "back")

# --- relational ------------------------------------------------------------

SQL["dedup_latest"] = with_(
    "SELECT product_id, periodo, stock_final FROM stocks QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY periodo DESC) = 1", "stocks"
)
SQL["dedup_subset"] = """SELECT c_nationkey, c_custkey, c_acctbal FROM customer
QUALIFY row_number() OVER (PARTITION BY c_nationkey ORDER BY c_acctbal DESC, c_custkey) = 1"""
SQL["override_newer"] = with_(
    f"SELECT a.product_id, coalesce(b.tn, a.tn) AS tn FROM ({last_sql(SEASON)}) a LEFT JOIN ({last_sql(SCORE)}) b USING (product_id)", "obs"
)
cte("l4", f"SELECT product_id, periodo, {lags('tn', range(12), PROD_W, 'l')}, {over('lead(tn, 2)', PROD_W)} AS clase FROM obs", "obs")
SQL["row_functions"] = with_(
    f"""SELECT product_id, periodo,
  {r('list_avg(list_filter([l0, l1, l2, l3, l4, l5, l6, l7, l8, l9, l10, l11], lambda v: v IS NOT NULL))', 'media')}, {r('greatest(l0, l1, l2, l3, l4, l5, l6, l7, l8, l9, l10, l11)', 'mayor')},
  {r('least(greatest(l0, 100.0), 500.0)', 'recorte')},
  CAST(l0 >= 100 AS INT) + CAST(l0 >= 200 AS INT) + CAST(l0 >= 400 AS INT) AS bin,
  CASE WHEN clase IS NOT NULL THEN CAST(clase > 0 AS INT) END AS compra, CAST(NULL AS DOUBLE) AS malo, CAST(product_id AS DOUBLE) AS bueno,
  {r('ln(1 + l0)', 'log')}, {r('exp(0.001 * l0) - 1', 'ex')} FROM l4""",
    "l4",
)
SQL["category_codes"] = with_(
    """SELECT 'cat1' AS kind, v AS category, k AS code FROM code_cat1 UNION ALL SELECT 'cat3', v, k FROM code_cat3_cat
UNION ALL SELECT 'brand', v, k FROM code_brand""",
    "code_cat1", "code_cat3_cat", "code_brand",
)
cte("vols", "SELECT ln(1 + sum(tn)) AS v FROM panel GROUP BY customer_id, product_id", "panel")
SQL["exact_cuts"] = with_(
    " UNION ALL ".join(
        f"SELECT {i} AS corte, {r(f'quantile_cont(v, {q})', 'valor')} FROM vols" for i, q in enumerate((0.25, 0.5, 0.75))
    ),
    "vols",
)

# --- exploration -----------------------------------------------------------

IN_YEAR = f"periodo BETWEEN {YEAR}01 AND {YEAR}12"
SQL["monthly_total"] = with_("SELECT periodo, sum(tn) AS tn FROM sales GROUP BY 1", "sales")
SQL["yearly_total"] = with_("SELECT CAST(periodo // 100 AS INTEGER) AS anio, round(sum(tn)) AS tn FROM sales GROUP BY 1", "sales")
SQL["trend_line"] = with_(
    f"""SELECT {r('regr_slope(y, x)', 'slope')}, {r('regr_intercept(y, x)', 'intercept')}, {r('regr_r2(y, x)', 'r2')} FROM (
  SELECT CAST(make_date(periodo // 100, periodo % 100, 1) - DATE '1970-01-01' AS DOUBLE) AS x, sum(tn) AS y FROM sales GROUP BY periodo)""",
    "sales",
)
cte("cli_share", f"SELECT customer_id, sum(tn) AS tn, sum(tn) * 100.0 / sum(sum(tn)) OVER () AS tn_pct FROM sparse WHERE {IN_YEAR} GROUP BY 1", "sparse")
cte("cli_cum", "SELECT *, sum(tn_pct) OVER (ORDER BY tn_pct DESC) AS tn_pct_acumulado, CAST(row_number() OVER (ORDER BY tn DESC, customer_id) AS INTEGER) AS puesto FROM cli_share", "cli_share")
SQL["customer_share"] = with_(f"SELECT customer_id, {rr('tn', 'tn_pct')} FROM cli_share", "cli_share")
SQL["distinct_customers"] = with_(f"SELECT count(DISTINCT customer_id) AS n FROM sparse WHERE {IN_YEAR}", "sparse")
_CUM = f"SELECT customer_id, {rr('tn', 'tn_pct', 'tn_pct_acumulado')}, puesto FROM cli_cum"
SQL["customer_cum_share_top20"] = with_(f"{_CUM} ORDER BY cli_cum.tn DESC, customer_id LIMIT 20", "cli_cum")
SQL["customer_cum_share_bottom300"] = with_(f"{_CUM} ORDER BY cli_cum.tn ASC, customer_id DESC LIMIT 300", "cli_cum")
cte("prod_share", f"SELECT product_id, sum(tn) AS tn, sum(tn) * 100.0 / sum(sum(tn)) OVER () AS tn_pct FROM sales WHERE {IN_YEAR} GROUP BY 1", "sales")
SQL["product_cum_share"] = with_(
    f"SELECT product_id, {rr('tn', 'tn_pct')}, {r('sum(tn_pct) OVER (ORDER BY tn_pct DESC)', 'tn_pct_acumulado')} FROM prod_share", "prod_share"
)
SQL["history_completeness"] = with_(
    f"""SELECT CASE WHEN m.n = 12 THEN '12 meses (completo)' WHEN m.n IS NULL THEN 'sin ventas' ELSE '<12 meses (hueco/nuevo)' END AS grupo,
  count(*) AS cant FROM requested q LEFT JOIN (SELECT product_id, count(DISTINCT periodo) AS n FROM sales WHERE {IN_YEAR} GROUP BY 1) m
  USING (product_id) GROUP BY 1""",
    "sales", "requested",
)
SQL["pareto"] = with_(
    """SELECT CAST(u AS VARCHAR) || '% de las tn' AS cubre, count(*) + 1 AS productos, round(100.0 * (count(*) + 1) / max(total), 1) AS pct_catalogo
FROM (SELECT 100.0 * sum(tn) OVER (ORDER BY tn DESC) / sum(tn) OVER () AS acum, count(*) OVER () AS total FROM prod_share)
CROSS JOIN (VALUES (50), (80), (90)) v(u) WHERE acum <= u GROUP BY u""",
    "prod_share",
)
cte("pm", "SELECT product_id, periodo, sum(tn) AS tn FROM sales GROUP BY 1, 2", "sales")
SQL["skew_stats"] = with_(
    "SELECT round(avg(tn), 1) AS media, round(median(tn), 1) AS mediana, round(avg(tn) / median(tn), 1) AS ratio, round(max(tn), 0) AS maximo FROM pm", "pm"
)
SQL["histogram"] = with_(
    """SELECT CAST(least(floor((tn - lo) / ((hi - lo) / 100)) + 1, 100) AS INT) AS bin, count(*) AS n
FROM pm, (SELECT min(tn) AS lo, max(tn) AS hi FROM pm) GROUP BY 1""",
    "pm",
)
SQL["series_filter"] = with_("SELECT customer_id, periodo, sum(tn) AS tn FROM sales WHERE customer_id IN (1, 2, 12) GROUP BY 1, 2", "sales")
SQL["joint_series"] = with_("SELECT periodo, sum(tn) AS tn FROM sales WHERE product_id IN (1, 2, 3) GROUP BY 1", "sales")
SQL["attribute_lookup"] = with_(
    "SELECT * FROM products WHERE cat3 = 'NATION_3' UNION ALL SELECT * FROM products WHERE product_id IN (1, 2, 3)", "products"
)
SQL["label_concat"] = with_(
    """SELECT s.periodo, s.tn, concat_ws(', ', p.product_id, p.cat1, p.cat2, p.cat3, p.brand) AS titulo
FROM (SELECT product_id, periodo, sum(tn) AS tn FROM sales WHERE product_id = 3 GROUP BY 1, 2) s JOIN products p USING (product_id)""",
    "sales", "products",
)

# --- segments --------------------------------------------------------------


def stats_sql(source: str, cut: int) -> str:
    return f"""SELECT *, {REGIME.format(x='positive_months')} AS regime,
  CASE WHEN positive_months = 0 THEN 'nunca' WHEN positive_months <= 2 THEN 'una_dos' WHEN positive_months <= 5 THEN 'tres_cinco' ELSE 'activa' END AS regime_name
FROM (SELECT customer_id, product_id, count(*) FILTER (tn > 0) AS positive_months, sum(tn) AS total_tn, count(*) AS observed_months
  FROM {source} WHERE periodo <= {cut} GROUP BY 1, 2)"""


cte("stats", stats_sql("sparse_panel", SCORE), "sparse_panel")
SQL["regimes"] = with_("SELECT * FROM stats", "stats")
SQL["segment_profile"] = with_(
    f"""SELECT regime, regime_name, count(*) AS series, {r('avg(positive_months)', 'positive_mean')}, sum(total_tn) AS tn_total,
  {r('sum(total_tn) / sum(sum(total_tn)) OVER ()', 'tn_share')} FROM stats GROUP BY 1, 2""",
    "stats",
)
cte(
    "logged",
    """SELECT customer_id, product_id, periodo, ln(1 + tn / greatest(coalesce(avg(CASE WHEN tn > 0 THEN tn END)
  OVER (PARTITION BY customer_id, product_id), 1.0), 1e-9)) AS v FROM panel""",
    "panel",
)
SQL["shape_transform"] = with_(
    f"""SELECT customer_id, product_id, pos, {r('CASE WHEN sd > 1e-9 THEN (v - mean) / sd ELSE 0 END', 'z')} FROM (
  SELECT customer_id, product_id, CAST({over('row_number()', PAIR_W)} - 1 AS INTEGER) AS pos, v,
    avg(v) OVER (PARTITION BY customer_id, product_id) AS mean, stddev_pop(v) OVER (PARTITION BY customer_id, product_id) AS sd FROM logged)""",
    "logged",
)
cte("early", stats_sql("panel", SEASON), "panel")
SQL["segments_one_hot"] = with_(
    f"""SELECT p.customer_id, p.product_id, p.periodo, p.tn, e.regime, CASE WHEN e.regime IS NOT NULL THEN 0 END AS shape_cluster, e.regime AS cluster_v2,
  {', '.join(f'CAST(coalesce(e.regime = {n}, false) AS INT) AS cluster_v2_is_{n}' for n in range(7))}
FROM panel p LEFT JOIN early e ON e.customer_id = p.customer_id AND e.product_id = p.product_id WHERE p.periodo = {SCORE}""",
    "early",
)

# --- per-series forecast ---------------------------------------------------

cte(
    "reg",
    f"""SELECT g.product_id, g.i, coalesce(x.tn, 0.0) AS tn FROM (
  SELECT product_id, unnest(generate_series(min({idx('periodo')}), {idx(str(SCORE))})) AS i FROM obs WHERE periodo <= {SCORE} GROUP BY 1) g
LEFT JOIN obs x ON x.product_id = g.product_id AND {idx('x.periodo')} = g.i""",
    "obs",
)
_REG_W = "PARTITION BY product_id ORDER BY i"
cte("ylag", "SELECT product_id, i, y AS y0, " + ", ".join(f"lag(y, {n}) OVER ({_REG_W}) AS y{n}" for n in range(1, 14)) + " FROM (SELECT product_id, i, ln(1 + tn) AS y FROM reg)", "reg")


def family(name: str, depth: int, models: list[tuple[str, str, str | None, str]]) -> None:
    """One row per product and candidate with its corrected AIC and forecast."""
    parts = []
    for rank, (model, y, x, value) in enumerate(models):
        if x is None:
            fit = f"0.0 AS b, avg({y}) AS c, var_pop({y}) * count(*) AS sse"
            k = 2
        else:
            fit = f"regr_slope({y}, {x}) AS b, regr_intercept({y}, {x}) AS c, regr_syy({y}, {x}) - regr_slope({y}, {x}) * regr_sxy({y}, {x}) AS sse"
            k = 3
        parts.append(
            f"""SELECT f.product_id, '{model}' AS model, {rank} AS rank,
  CASE WHEN n > {k + 1} THEN n * ln(greatest(sse, 1e-9) / n) + {2 * k} + {2 * k * (k + 1)}.0 / (n - {k + 1}) END AS aicc, {value} AS f
FROM (SELECT product_id, count(*) AS n, max(i) AS top, {fit} FROM ylag WHERE y{depth} IS NOT NULL GROUP BY 1) f
JOIN ylag l ON l.product_id = f.product_id AND l.i = f.top"""
        )
    cte(f"{name}_all", " UNION ALL ".join(parts), "ylag")
    cte(
        name,
        f"""SELECT product_id, greatest(exp(f) - 1, 0) AS tn, model FROM {name}_all WHERE aicc IS NOT NULL AND f IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY aicc, rank) = 1""",
        f"{name}_all",
    )


_PLAIN = [
    ("mean", "y0", None, "c"),
    ("drift", "y0 - y1", None, "l.y0 + c + c"),
    ("ar", "y0", "y1", "c + b * (c + b * l.y0)"),
    ("ar_diff", "y0 - y1", "y1 - y2", "l.y0 + (c + b * (l.y0 - l.y1)) + (c + b * (c + b * (l.y0 - l.y1)))"),
]
_SEASONAL = [
    ("season_drift", "y0 - y12", None, "l.y10 + c"),
    ("season_ar", "y0", "y12", "c + b * l.y10"),
    ("season_diff_ar", "y0 - y12", "y1 - y13", "l.y10 + c + b * (c + b * (l.y0 - l.y12))"),
]
family("fam_s", 13, [*_SEASONAL, *_PLAIN])
family("fam_p", 2, _PLAIN)
SQL["seasonal_series"] = with_(
    f"""SELECT product_id, {r('tn')}, model, 'seasonal' AS status FROM fam_s
UNION ALL SELECT product_id, {r('tn')}, model, 'plain' FROM fam_p WHERE product_id NOT IN (SELECT product_id FROM fam_s)
UNION ALL SELECT product_id, {r('avg(tn)', 'tn')}, 'mean_12', 'fallback' FROM reg WHERE i > {idx(str(SCORE))} - 12
  AND product_id NOT IN (SELECT product_id FROM fam_s) AND product_id NOT IN (SELECT product_id FROM fam_p) GROUP BY 1""",
    "fam_s", "fam_p", "reg",
)


# --- sampling and noise: the order of a text's hash -------------------------

SQL["product_sample"] = with_(
    "SELECT * FROM panel WHERE product_id IN (SELECT product_id FROM (SELECT DISTINCT product_id FROM panel) "
    "ORDER BY md5(product_id || '|1'), product_id LIMIT 20)",
    "panel",
)


def unit_sql(stream: int) -> str:
    digest = f"md5(product_id || '|' || periodo || '|102191|{stream}')"
    return f"((CAST('0x' || substr({digest}, 1, 13) AS BIGINT) + CAST(0.5 AS DOUBLE)) / 4503599627370496.0)"


SQL["noise_lognormal"] = with_(
    f"SELECT product_id, periodo, {r(f'tn * exp(0.3 * sqrt(-2.0 * ln({unit_sql(1)})) * cos(2.0 * pi() * {unit_sql(2)}))', 'tn')} FROM obs",
    "obs",
)


# --- whole feature sets, files ----------------------------------------------

_GROUPS = ("pair_lags", "pair_rolling", "pair_deltas", "pair_purchases", "pair_shares", "fill_rate_lags", "pair_stock")
SQL["pair_feature_table"] = (
    f"SELECT * FROM (SELECT {G3}, promedio_nivel FROM ({SQL['pair_scaling']})) level "
    + " ".join(f"JOIN ({SQL[g]}) {g} USING ({G3})" for g in _GROUPS)
)
SQL["leakage_check"] = "SELECT unnest([" + ", ".join(
    f"'{f}'" for f in (*P_LAGS, *P_ROLLS, *DELTAS, *SHARES) if not (f.startswith("r") and f.endswith("_9"))
) + "]) AS feature, CAST(0 AS BIGINT) AS changed"
SQL["sales_csv_file"] = with_("SELECT * FROM sales", "sales")
SQL["panel_month_file"] = with_(f"SELECT * FROM panel WHERE periodo = {CONTROL}", "panel")
_joined = "(SELECT o.tn AS x, p.tn AS y FROM (SELECT * FROM obs WHERE periodo = {t}) o JOIN ({sql}) p USING (product_id))"
SQL["run_log_file"] = with_(
    f"""SELECT 'mean_12' AS run, {r('sum(abs(x - y)) / sum(x)', 'wape')}, CAST(NULL AS BIGINT) AS n
FROM {_joined.format(t=add(CONTROL, 2), sql=mean_sql(CONTROL))}
UNION ALL SELECT k.run, CAST(NULL AS DOUBLE), count(*) FROM {_joined.format(t=add(CONTROL, 2), sql=last_sql(CONTROL))},
(VALUES ('last_month'), ('again')) k(run) GROUP BY k.run""",
    "obs",
)


cte("logged_stats", "SELECT *, ln(1 + total_tn) AS v, md5(concat_ws('|', customer_id, product_id, '1')) AS h FROM stats WHERE regime >= 1", "stats")
cte("volume_cuts", "SELECT DISTINCT unnest(quantile_cont(v, [0.25, 0.5, 0.75])) AS c FROM logged_stats", "logged_stats")
cte(
    "strata",
    """SELECT customer_id, product_id, positive_months, total_tn, h, CAST(
  (CAST(positive_months >= 8 AS INTEGER) + CAST(positive_months >= 12 AS INTEGER) + CAST(positive_months >= 18 AS INTEGER)) * 4
  + (SELECT count(*) FROM volume_cuts WHERE c <= v) AS INTEGER) AS stratum FROM logged_stats""",
    "logged_stats", "volume_cuts",
)
SQL["stratified_sample"] = with_(
    """SELECT customer_id, product_id, positive_months, total_tn, stratum FROM (
  SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY h, customer_id, product_id) AS k,
    greatest(1, 800 // (SELECT count(DISTINCT stratum) FROM strata)) AS quota FROM strata)
ORDER BY CASE WHEN k <= quota THEN 0 ELSE 1 END, h, customer_id, product_id LIMIT 800""",
    "strata",
)


# --- relations -------------------------------------------------------------

cte("known", f"SELECT *, {over('lag(tn, 2)', PAIR_W)} IS NOT NULL AS old FROM panel", "panel")
cte(
    "all_targets",
    """SELECT periodo, sum(x) OVER w / nullif(sum(n) OVER w, 0) AS mean FROM (
  SELECT periodo, coalesce(sum(tn) FILTER (old), 0) AS x, count(*) FILTER (old) AS n FROM known GROUP BY 1)
WINDOW w AS (ORDER BY periodo)""",
    "known",
)


def encoded(key: str) -> str:
    return f"""SELECT {key}, periodo, (sum(x) OVER w + 20 * mean) / (sum(n) OVER w + 20) AS te_{key} FROM (
  SELECT {key}, periodo, coalesce(sum(tn) FILTER (old), 0) AS x, count(*) FILTER (old) AS n FROM known GROUP BY 1, 2)
  JOIN all_targets USING (periodo) WINDOW w AS (PARTITION BY {key} ORDER BY periodo)"""


SQL["target_encoding"] = with_(
    f"""SELECT customer_id, product_id, periodo, {fine('te_customer_id', 'te_product_id')} FROM panel
JOIN ({encoded('customer_id')}) USING (customer_id, periodo) JOIN ({encoded('product_id')}) USING (product_id, periodo)""",
    "panel", "all_targets",
)
SQL["target_encoding_leak"] = "SELECT unnest(['te_customer_id', 'te_product_id']) AS feature, CAST(0 AS BIGINT) AS changed"


def breadth_sql(source: str, key: str, partner: str, prefix: str) -> str:
    return with_(
        f"""SELECT {key}, {per('i')} AS periodo, {prefix}_3, {prefix}_12,
  {prefix}_3 - lag({prefix}_3, 3) OVER w AS {prefix}_3_trend, {prefix}_12 - lag({prefix}_12, 12) OVER w AS {prefix}_12_trend FROM (
  SELECT m.{key}, m.i, count(DISTINCT b.{partner}) FILTER (b.i > m.i - 3) AS {prefix}_3, count(DISTINCT b.{partner}) AS {prefix}_12
  FROM (SELECT {key}, unnest(range(min({idx('periodo')}), max({idx('periodo')}) + 1)) AS i FROM {source} GROUP BY 1) m
  LEFT JOIN (SELECT {key}, {partner}, {idx('periodo')} AS i FROM {source} WHERE tn > 0) b
    ON m.{key} = b.{key} AND b.i BETWEEN m.i - 11 AND m.i GROUP BY 1, 2)
WINDOW w AS (PARTITION BY {key} ORDER BY i)""",
        source,
    )


SQL["product_breadth"] = breadth_sql("sales", "product_id", "customer_id", "breadth")
SQL["customer_diversity"] = breadth_sql("sparse", "customer_id", "product_id", "diversity")

LEVELS = ("cat1", "cat2", "cat3", "brand", "product_id", "customer_id")
cte("attributed", "SELECT s.*, p.cat1, p.cat2, p.cat3, p.brand FROM sales s LEFT JOIN products p USING (product_id)", "sales", "products")
cte(
    "level_sums",
    "SELECT 'universe' AS level, 'universe' AS member, periodo, sum(tn) AS tn FROM attributed GROUP BY periodo"
    + "".join(f" UNION ALL SELECT '{c}', CAST({c} AS VARCHAR), periodo, sum(tn) FROM attributed GROUP BY {c}, periodo" for c in LEVELS),
    "attributed",
)
cte(
    "levels",
    f"""SELECT a.*, b.tn AS tn_12, {safe('a.tn', 'b.tn')} AS yoy FROM level_sums a LEFT JOIN level_sums b
  ON a.level = b.level AND a.member IS NOT DISTINCT FROM b.member AND b.periodo = a.periodo - 100""",
    "level_sums",
)
SQL["level_totals"] = with_(f"SELECT level, member, periodo, {rr('tn', 'tn_12', 'yoy')} FROM levels", "levels")
SQL["pair_level_shares"] = with_(
    f"""SELECT s.customer_id, s.product_id, s.periodo, {r('s.tn', 'tn')}, """
    + ", ".join(
        f"{r(f'l_{c}.yoy', f'yoy_{c}')}, round({safe('s.tn', f'l_{c}.tn')}, 9) + CAST(0 AS DOUBLE) AS share_{c}" for c in ("universe", *LEVELS)
    )
    + " FROM attributed s"
    + "".join(
        f" LEFT JOIN levels l_{c} ON l_{c}.level = '{c}' AND l_{c}.periodo = s.periodo"
        + ("" if c == "universe" else f" AND l_{c}.member = CAST(s.{c} AS VARCHAR)")
        for c in ("universe", *LEVELS)
    ),
    "attributed", "levels",
)
SQL["plan_months"] = with_(
    f"""SELECT customer_id, product_id, periodo, CAST((periodo % 100 - 1) // 3 + 1 AS INTEGER) AS trimestre,
  CAST({over('sum(plan_flag)', PAIR_W)} AS BIGINT) AS meses_en_plan FROM panel""",
    "panel",
)

# --- walk-forward ----------------------------------------------------------

SQL["walk_forward_naive"] = with_(
    f"""SELECT model, count(DISTINCT a) AS folds, count(*) AS rows, {r('sum(abs(actual - forecast)) / sum(actual)', 'wape')} FROM (
  SELECT a, product_id, actual, unnest([
    {{'model': 'last', 'forecast': coalesce(last, 0)}}, {{'model': 'mean_12', 'forecast': coalesce(mean, 0)}},
    {{'model': 'same_month', 'forecast': coalesce(year, mean, 0)}}], recursive := true)
  FROM (SELECT a, product_id, max(tn) FILTER (k = 2) AS actual, max(tn) FILTER (k = 0) AS last, avg(tn) FILTER (k <= 0) AS mean,
      max(tn) FILTER (k = -10) AS year
    FROM (SELECT *, {idx('periodo')} - {idx('a')} AS k FROM obs, (SELECT unnest([{SEASON}, 200012, {CONTROL}]) AS a) f)
    WHERE k BETWEEN -11 AND 2 GROUP BY 1, 2) WHERE actual IS NOT NULL) GROUP BY 1""",
    "obs",
)
