"""Reference SQL for every registered query that SQL can express.

The SQL is written against the driver's raw tables and shares nothing with the Spark
code but the column names: a few common table expressions build the order star and the
demand panel, and each query selects from them. Results are cast to BIGINT, DOUBLE,
VARCHAR, DATE and BOOLEAN so that both engines report the same types.
"""

from __future__ import annotations

# --- shared table expressions ------------------------------------------------------

CTES = {
    "fact": """
        SELECT l.l_orderkey AS oid, CAST(o.o_orderdate AS DATE) AS odate, o.o_custkey AS cust,
               p.p_brand AS prod, n.n_regionkey AS reg, CAST(l.l_quantity AS BIGINT) AS qty,
               l.l_extendedprice / l.l_quantity AS price,
               CAST(l.l_extendedprice AS DECIMAL(18,2)) AS rev,
               abs(date_diff('day', CAST(o.o_orderdate AS DATE), CAST(l.l_shipdate AS DATE))) % 31 AS days
        FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
        JOIN part p ON p.p_partkey = l.l_partkey
        JOIN supplier s ON s.s_suppkey = l.l_suppkey
        JOIN nation n ON n.n_nationkey = s.s_nationkey""",
    "line": """
        SELECT *, CASE WHEN days <= 26 THEN 'Completed' ELSE 'Delayed' END AS status,
               year(odate) AS yr, CAST(date_trunc('month', odate) AS DATE) AS mon FROM fact""",
    "buyer": """
        SELECT c.c_custkey AS cust, c.c_name AS cname, c.c_mktsegment AS ctype, n.n_regionkey AS creg
        FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey""",
    "area": "SELECT r_regionkey AS reg, r_name AS rname FROM region",
    "item": """
        SELECT DISTINCT p_brand AS prod,
               'Category ' || (CAST(regexp_extract(p_brand, '[0-9]+$') AS INT) % 5) AS cat,
               'Line ' || (CAST(regexp_extract(p_brand, '[0-9]+$') AS INT) % 2) AS pline
        FROM part""",
    "cell": "SELECT mon, prod, reg, CAST(sum(qty) AS BIGINT) AS dem FROM line GROUP BY mon, prod, reg",
    "spine": """
        SELECT CAST(unnest(generate_series((SELECT min(mon) FROM cell), (SELECT max(mon) FROM cell),
               INTERVAL 1 MONTH)) AS DATE) AS mon""",
    "panel": """
        SELECT s.mon, p.prod, r.reg, coalesce(c.dem, 0) AS dem
        FROM spine s CROSS JOIN (SELECT DISTINCT prod FROM cell) p
        CROSS JOIN (SELECT DISTINCT reg FROM cell) r
        LEFT JOIN cell c ON c.mon = s.mon AND c.prod = p.prod AND c.reg = r.reg""",
    "feat": """
        SELECT *, lag(dem, 1) OVER w AS lag1, lag(dem, 2) OVER w AS lag2, lag(dem, 3) OVER w AS lag3,
               lag(dem, 6) OVER w AS lag6, lag(dem, 12) OVER w AS lag12,
               (lag(dem, 1) OVER w + lag(dem, 2) OVER w + lag(dem, 3) OVER w) / 3 AS roll3,
               (lag(dem, 1) OVER w + lag(dem, 2) OVER w + lag(dem, 3) OVER w
                + lag(dem, 4) OVER w + lag(dem, 5) OVER w + lag(dem, 6) OVER w) / 6 AS roll6,
               (year(mon) - (SELECT min(year(mon)) FROM panel)) * 12 + month(mon) AS tidx
        FROM panel WINDOW w AS (PARTITION BY prod, reg ORDER BY mon)""",
    "usable": "SELECT * FROM feat WHERE lag12 IS NOT NULL AND lag6 IS NOT NULL",
    "test": """
        SELECT * FROM usable WHERE mon >= (SELECT max(mon) - INTERVAL 5 MONTH FROM usable)""",
    # The shared forecast of both engines: last month, same month last year, moving average.
    "wide": """
        SELECT mon, prod, reg, dem, CAST(lag1 AS DECIMAL(18,2)) AS naive,
               CAST(lag12 AS DECIMAL(18,2)) AS seasonal, CAST(round(roll6, 2) AS DECIMAL(18,2)) AS fc
        FROM test""",
    "detail": """
        SELECT w.mon, w.prod, w.reg, w.dem, v.model, v.pred, i.cat, i.pline, a.rname,
               v.pred - w.dem AS err, abs(v.pred - w.dem) AS aerr,
               (v.pred - w.dem) * (v.pred - w.dem) AS serr
        FROM (SELECT mon, prod, reg, dem, unnest([
                 {'model': 'Moving Average 6', 'pred': fc},
                 {'model': 'Naive Forecast', 'pred': naive},
                 {'model': 'Seasonal Naive', 'pred': seasonal}]) AS v FROM wide) w
        JOIN item i ON i.prod = w.prod JOIN area a ON a.reg = w.reg""",
}

_USES = {
    "line": ["fact"], "cell": ["line"], "spine": ["cell"], "panel": ["spine", "cell"],
    "feat": ["panel"], "usable": ["feat"], "test": ["usable"], "wide": ["test"],
    "detail": ["wide", "item", "area"],
}


def _closure(names: list[str]) -> list[str]:
    ordered: list[str] = []

    def visit(name: str) -> None:
        for used in _USES.get(name, []):
            visit(used)
        if name not in ordered:
            ordered.append(name)

    for name in names:
        visit(name)
    return ordered


_TYPES = {"i": "BIGINT", "d": "DOUBLE", "s": "VARCHAR", "t": "DATE", "b": "BOOLEAN"}


def query(uses: str, columns: str, body: str) -> str:
    """SQL from the expressions used, `name:type` result columns and the final select."""
    ctes = [f"{n} AS MATERIALIZED ({CTES[n].strip()})" for n in _closure(uses.split())]
    ctes.append(f"result AS ({body.strip()})")
    picked = []
    for entry in columns.split(","):
        name, kind = entry.strip().rsplit(":", 1)
        picked.append(f'CAST("{name}" AS {_TYPES[kind]}) AS "{name}"')
    return f"WITH {', '.join(ctes)} SELECT {', '.join(picked)} FROM result"


def div(a: str, b: str) -> str:
    return f"(CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def pct(a: str, b: str) -> str:
    return f"(100.0::DOUBLE * CAST({a} AS DOUBLE) / nullif(CAST({b} AS DOUBLE), 0))"


def r2(x: str) -> str:
    return f"round({x}, 2)"


SQL: dict[str, str] = {}

# --- sales -------------------------------------------------------------------------

SQL["annual_sales_trend"] = query(
    "line",
    "sales_year:i,total_revenue:d,total_units_sold:i,total_orders:i,average_order_value:d,"
    "revenue_yoy_growth_pct:d,units_yoy_growth_pct:d",
    f"""
    SELECT y.yr AS sales_year, y.r AS total_revenue, y.u AS total_units_sold, y.n AS total_orders,
           {r2(div('y.r', 'y.n'))} AS average_order_value,
           {r2(pct('(y.r - p.r)', 'p.r'))} AS revenue_yoy_growth_pct,
           {r2(pct('(y.u - p.u)', 'p.u'))} AS units_yoy_growth_pct
    FROM (SELECT yr, sum(rev) r, sum(qty) u, count(DISTINCT oid) n, row_number() OVER (ORDER BY yr) k
          FROM line GROUP BY yr) y
    LEFT JOIN (SELECT sum(rev) r, sum(qty) u, row_number() OVER (ORDER BY yr) k
               FROM line GROUP BY yr) p ON p.k = y.k - 1""",
)

SQL["regional_sales_contribution"] = query(
    "line area",
    "Region_ID:i,Region:s,total_revenue:d,total_units_sold:i,total_orders:i,active_customers:i,"
    "average_order_value:d,revenue_contribution_pct:d,revenue_rank:i",
    f"""
    WITH g AS (SELECT reg, sum(rev) r, sum(qty) u, count(DISTINCT oid) n, count(DISTINCT cust) c
               FROM line GROUP BY reg)
    SELECT reg AS Region_ID, rname AS Region, r AS total_revenue, u AS total_units_sold,
           n AS total_orders, c AS active_customers, {r2(div('r', 'n'))} AS average_order_value,
           {r2(pct('r', '(SELECT sum(r) FROM g)'))} AS revenue_contribution_pct,
           (SELECT count(DISTINCT h.r) FROM g h WHERE h.r > g.r) + 1 AS revenue_rank
    FROM g JOIN area USING (reg)""",
)

SQL["product_revenue_contribution"] = query(
    "line item",
    "Product_ID:s,Product_Category:s,Product_Line:s,total_revenue:d,total_units_sold:i,"
    "total_orders:i,average_selling_price:d,revenue_contribution_pct:d,cumulative_revenue:d,"
    "cumulative_revenue_pct:d,revenue_rank:i",
    f"""
    WITH g AS (SELECT prod, sum(rev) r, sum(qty) u, count(DISTINCT oid) n FROM line GROUP BY prod),
    k AS (SELECT g.*, (SELECT sum(h.r) FROM g h WHERE h.r > g.r OR (h.r = g.r AND h.prod <= g.prod)) cum
          FROM g)
    SELECT prod AS Product_ID, cat AS Product_Category, pline AS Product_Line, r AS total_revenue,
           u AS total_units_sold, n AS total_orders, {r2(div('r', 'u'))} AS average_selling_price,
           {r2(pct('r', '(SELECT sum(r) FROM g)'))} AS revenue_contribution_pct,
           cum AS cumulative_revenue, {r2(pct('cum', '(SELECT sum(r) FROM g)'))} AS cumulative_revenue_pct,
           dense_rank() OVER (ORDER BY r DESC) AS revenue_rank
    FROM k JOIN item USING (prod)""",
)

# --- customers ---------------------------------------------------------------------

SQL["customer_value_ranking"] = query(
    "line buyer area",
    "Customer_ID:i,Customer_Name:s,Customer_Type:s,Region:s,total_revenue:d,total_units_sold:i,"
    "total_orders:i,average_order_value:d,last_order_date:t,revenue_contribution_pct:d,"
    "customer_revenue_rank:i",
    f"""
    WITH g AS (SELECT cust, sum(rev) r, sum(qty) u, count(DISTINCT oid) n, max(odate) d
               FROM line GROUP BY cust)
    SELECT cust AS Customer_ID, cname AS Customer_Name, ctype AS Customer_Type, rname AS Region,
           r AS total_revenue, u AS total_units_sold, n AS total_orders,
           {r2(div('r', 'n'))} AS average_order_value, d AS last_order_date,
           {r2(pct('r', '(SELECT sum(r) FROM g)'))} AS revenue_contribution_pct,
           dense_rank() OVER (ORDER BY r DESC) AS customer_revenue_rank
    FROM g JOIN buyer USING (cust) JOIN area ON area.reg = buyer.creg""",
)

SQL["customer_type_performance"] = query(
    "line buyer",
    "Customer_Type:s,active_customers:i,total_orders:i,total_units_sold:i,total_revenue:d,"
    "revenue_per_customer:d,average_order_value:d,revenue_contribution_pct:d,segment_revenue_rank:i",
    f"""
    WITH g AS (SELECT ctype, count(DISTINCT cust) c, count(DISTINCT oid) n, sum(qty) u, sum(rev) r
               FROM line JOIN buyer USING (cust) GROUP BY ctype)
    SELECT ctype AS Customer_Type, c AS active_customers, n AS total_orders, u AS total_units_sold,
           r AS total_revenue, {r2(div('r', 'c'))} AS revenue_per_customer,
           {r2(div('r', 'n'))} AS average_order_value,
           {r2(pct('r', '(SELECT sum(r) FROM g)'))} AS revenue_contribution_pct,
           dense_rank() OVER (ORDER BY r DESC) AS segment_revenue_rank
    FROM g""",
)

SQL["customer_growth_and_risk"] = query(
    "line buyer area",
    "Customer_ID:i,Customer_Name:s,Customer_Type:s,Region:s,previous_year:i,latest_year:i,"
    "previous_year_revenue:d,latest_year_revenue:d,revenue_yoy_growth_pct:d,customer_momentum:s",
    f"""
    WITH y AS (SELECT max(yr) AS y1 FROM line),
    g AS (SELECT b.*, y1, (SELECT sum(rev) FROM line l WHERE l.cust = b.cust AND l.yr = y1 - 1) p,
                 (SELECT sum(rev) FROM line l WHERE l.cust = b.cust AND l.yr = y1) q FROM buyer b, y),
    h AS (SELECT *, coalesce(p, 0) p0, coalesce(q, 0) q0,
                 {r2(pct('(coalesce(q, 0) - coalesce(p, 0))', 'p'))} gr FROM g)
    SELECT cust AS Customer_ID, cname AS Customer_Name, ctype AS Customer_Type, rname AS Region,
           y1 - 1 AS previous_year, y1 AS latest_year, p0 AS previous_year_revenue,
           q0 AS latest_year_revenue, gr AS revenue_yoy_growth_pct,
           CASE WHEN p0 = 0 AND q0 > 0 THEN 'New or Returning'
                WHEN q0 = 0 AND p0 > 0 THEN 'No Orders in Latest Year'
                WHEN gr >= 10 THEN 'High Growth' WHEN gr <= -10 THEN 'At Risk'
                ELSE 'Stable' END AS customer_momentum
    FROM h JOIN area ON area.reg = h.creg""",
)

SQL["regional_market_opportunity"] = query(
    "line buyer area",
    "Region:s,Customer_Type:s,previous_year:i,latest_year:i,active_customers:i,"
    "previous_year_revenue:d,latest_year_revenue:d,revenue_per_customer:d,revenue_yoy_growth_pct:d,"
    "company_revenue_per_customer:d,revenue_per_customer_gap:d,opportunity_segment:s",
    f"""
    WITH y AS (SELECT max(yr) AS y1 FROM line),
    g AS (SELECT a.rname, t.ctype, y.y1,
                 count(DISTINCT CASE WHEN l.yr = y.y1 THEN b.cust END) ac,
                 sum(CASE WHEN l.yr = y.y1 - 1 THEN l.rev END) p,
                 sum(CASE WHEN l.yr = y.y1 THEN l.rev END) q
          FROM area a CROSS JOIN (SELECT DISTINCT ctype FROM buyer) t CROSS JOIN y
          LEFT JOIN buyer b ON b.creg = a.reg AND b.ctype = t.ctype
          LEFT JOIN line l ON l.cust = b.cust GROUP BY a.rname, t.ctype, y.y1),
    h AS (SELECT *, coalesce(p, 0) p0, coalesce(q, 0) q0,
                 coalesce({r2(div('coalesce(q, 0)', 'ac'))}, 0) per,
                 {r2(pct('(coalesce(q, 0) - coalesce(p, 0))', 'p'))} gr,
                 {div('(SELECT sum(coalesce(q, 0)) FROM g)', '(SELECT sum(ac) FROM g)')} av FROM g)
    SELECT rname AS Region, ctype AS Customer_Type, y1 - 1 AS previous_year, y1 AS latest_year,
           ac AS active_customers, p0 AS previous_year_revenue, q0 AS latest_year_revenue,
           per AS revenue_per_customer, gr AS revenue_yoy_growth_pct,
           {r2('av')} AS company_revenue_per_customer, {r2('av - per')} AS revenue_per_customer_gap,
           CASE WHEN ac = 0 THEN 'No Active Customers' WHEN gr >= 5 THEN 'High Growth Market'
                WHEN gr <= 0 AND per < av THEN 'Expansion Opportunity'
                WHEN gr <= 0 THEN 'Defend and Grow' ELSE 'Stable Growth' END AS opportunity_segment
    FROM h""",
)

# --- delivery ----------------------------------------------------------------------

_LEVELS = """
    SELECT {key} AS k, count(DISTINCT oid) n,
           count(DISTINCT CASE WHEN status = 'Completed' THEN oid END) nc,
           count(DISTINCT CASE WHEN status = 'Delayed' THEN oid END) nd, sum(qty) u,
           sum(CASE WHEN status = 'Completed' THEN qty END) uc,
           sum(CASE WHEN status = 'Delayed' THEN qty END) ud, sum(rev) r,
           sum(CASE WHEN status = 'Delayed' THEN rev END) rd,
           round(CAST(sum(days) AS DOUBLE) / count(days), 2) dd
    FROM line GROUP BY {key}"""

SQL["annual_fulfillment_kpi"] = query(
    "line",
    "sales_year:i,total_orders:i,on_time_orders:i,delayed_orders:i,ordered_units:i,on_time_units:i,"
    "total_revenue:d,delayed_revenue:d,average_delivery_days:d,on_time_order_rate_pct:d,"
    "on_time_unit_rate_pct:d,delayed_revenue_exposure_pct:d",
    f"""
    SELECT k AS sales_year, n AS total_orders, nc AS on_time_orders, nd AS delayed_orders,
           u AS ordered_units, uc AS on_time_units, r AS total_revenue, rd AS delayed_revenue,
           dd AS average_delivery_days, {r2(pct('nc', 'n'))} AS on_time_order_rate_pct,
           {r2(pct('uc', 'u'))} AS on_time_unit_rate_pct,
           {r2(pct('rd', 'r'))} AS delayed_revenue_exposure_pct
    FROM ({_LEVELS.format(key='yr')})""",
)

SQL["regional_fulfillment_performance"] = query(
    "line area",
    "Region_ID:i,Region:s,total_orders:i,on_time_orders:i,delayed_orders:i,ordered_units:i,"
    "on_time_units:i,average_delivery_days:d,delayed_revenue:d,on_time_order_rate_pct:d,"
    "delayed_order_rate_pct:d,on_time_unit_rate_pct:d,fulfillment_risk_rank:i",
    f"""
    SELECT k AS Region_ID, rname AS Region, n AS total_orders, nc AS on_time_orders,
           nd AS delayed_orders, u AS ordered_units, uc AS on_time_units,
           dd AS average_delivery_days, rd AS delayed_revenue,
           {r2(pct('nc', 'n'))} AS on_time_order_rate_pct, {r2(pct('nd', 'n'))} AS delayed_order_rate_pct,
           {r2(pct('uc', 'u'))} AS on_time_unit_rate_pct,
           dense_rank() OVER (ORDER BY {r2(pct('nd', 'n'))} DESC) AS fulfillment_risk_rank
    FROM ({_LEVELS.format(key='reg')}) JOIN area ON area.reg = k""",
)

SQL["product_fulfillment_bottlenecks"] = query(
    "line item",
    "Product_ID:s,Product_Category:s,Product_Line:s,total_orders:i,delayed_orders:i,ordered_units:i,"
    "delayed_units:i,average_delivery_days:d,delayed_revenue:d,delayed_order_rate_pct:d,"
    "delayed_unit_rate_pct:d,bottleneck_rank:i",
    f"""
    SELECT k AS Product_ID, cat AS Product_Category, pline AS Product_Line, n AS total_orders,
           nd AS delayed_orders, u AS ordered_units, ud AS delayed_units,
           dd AS average_delivery_days, rd AS delayed_revenue,
           {r2(pct('nd', 'n'))} AS delayed_order_rate_pct, {r2(pct('ud', 'u'))} AS delayed_unit_rate_pct,
           dense_rank() OVER (ORDER BY {r2(pct('nd', 'n'))} DESC, rd DESC) AS bottleneck_rank
    FROM ({_LEVELS.format(key='prod')}) JOIN item ON item.prod = k""",
)

SQL["monthly_demand_fulfillment_reconciliation"] = query(
    "line detail",
    "forecast_month:t,evaluated_series:i,actual_demand:i,forecast_demand:d,total_orders:i,"
    "ordered_units:i,on_time_units:i,delayed_units:i,reconciliation_difference:i,"
    "absolute_reconciliation_difference:i,forecast_variance:d,on_time_unit_rate_pct:d",
    f"""
    WITH o AS (SELECT mon, prod, reg, count(*) n, sum(qty) u,
                      sum(CASE WHEN status = 'Completed' THEN qty ELSE 0 END) uc,
                      sum(CASE WHEN status = 'Delayed' THEN qty ELSE 0 END) ud
               FROM line GROUP BY mon, prod, reg),
    m AS (SELECT d.*, coalesce(n, 0) n, coalesce(u, 0) u, coalesce(uc, 0) uc, coalesce(ud, 0) ud
          FROM detail d LEFT JOIN o ON o.mon = d.mon AND o.prod = d.prod AND o.reg = d.reg
          WHERE d.model = 'Moving Average 6')
    SELECT mon AS forecast_month, count(*) AS evaluated_series, sum(dem) AS actual_demand,
           sum(pred) AS forecast_demand, sum(n) AS total_orders, sum(u) AS ordered_units,
           sum(uc) AS on_time_units, sum(ud) AS delayed_units, sum(u - dem) AS reconciliation_difference,
           sum(abs(u - dem)) AS absolute_reconciliation_difference, sum(err) AS forecast_variance,
           {pct('sum(uc)', 'sum(u)')} AS on_time_unit_rate_pct
    FROM m GROUP BY mon""",
)

# --- panel, features, split --------------------------------------------------------

SQL["monthly_observed_demand"] = query(
    "cell", "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i",
    "SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, dem AS Actual_Demand FROM cell",
)
SQL["monthly_spine"] = query("spine", "Month:t", "SELECT mon AS Month FROM spine")
_PANEL = """mon AS Month, prod AS Product_ID, reg AS Region_ID, dem AS Actual_Demand,
    year(mon) AS Year, month(mon) AS Month_Number, quarter(mon) AS Quarter, tidx AS Time_Index"""
_PANEL_TYPES = (
    "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Year:i,Month_Number:i,Quarter:i,Time_Index:i"
)
_FEATURES = _PANEL + """, lag1 AS Demand_Lag_1, lag2 AS Demand_Lag_2, lag3 AS Demand_Lag_3,
    lag6 AS Demand_Lag_6, lag12 AS Demand_Lag_12, roll3 AS Demand_Rolling_Mean_3,
    roll6 AS Demand_Rolling_Mean_6"""
_FEATURE_TYPES = _PANEL_TYPES + (
    ",Demand_Lag_1:i,Demand_Lag_2:i,Demand_Lag_3:i,Demand_Lag_6:i,Demand_Lag_12:i,"
    "Demand_Rolling_Mean_3:d,Demand_Rolling_Mean_6:d"
)
SQL["demand_panel"] = query("feat", _PANEL_TYPES, f"SELECT {_PANEL} FROM feat")
SQL["demand_features"] = query("feat", _FEATURE_TYPES, f"SELECT {_FEATURES} FROM feat")
SQL["demand_usable"] = query("usable", _FEATURE_TYPES, f"SELECT {_FEATURES} FROM usable")
SQL["demand_test"] = query("test", _FEATURE_TYPES, f"SELECT {_FEATURES} FROM test")
SQL["demand_development"] = query(
    "usable test", _FEATURE_TYPES,
    f"SELECT {_FEATURES} FROM usable WHERE mon < (SELECT min(mon) FROM test)",
)
SQL["month_folds"] = query(
    "usable test",
    "fold:i,train_start:t,train_end:t,train_rows:i,validation_start:t,validation_end:t,validation_rows:i",
    """
    WITH dev AS (SELECT mon, count(*) c, row_number() OVER (ORDER BY mon) k FROM usable
                 WHERE mon < (SELECT min(mon) FROM test) GROUP BY mon),
    s AS (SELECT count(*) m, count(*) // 4 z FROM dev),
    f AS (SELECT unnest([1, 2, 3]) AS fold)
    SELECT fold, min(mon) FILTER (k <= m - (4 - fold) * z) AS train_start,
           max(mon) FILTER (k <= m - (4 - fold) * z) AS train_end,
           sum(c) FILTER (k <= m - (4 - fold) * z) AS train_rows,
           min(mon) FILTER (k > m - (4 - fold) * z) AS validation_start,
           max(mon) FILTER (k > m - (4 - fold) * z) AS validation_end,
           sum(c) FILTER (k > m - (4 - fold) * z) AS validation_rows
    FROM f CROSS JOIN s CROSS JOIN dev WHERE k <= m - (3 - fold) * z GROUP BY fold""",
)

SQL["mean_baseline_cv"] = query(
    "usable test", "fold:i,mae:d,cv_mae:d",
    """
    WITH dev AS (SELECT mon, dem, dense_rank() OVER (ORDER BY mon) k FROM usable
                 WHERE mon < (SELECT min(mon) FROM test)),
    s AS (SELECT max(k) m, max(k) // 4 z FROM dev),
    f AS (SELECT unnest([1, 2, 3]) AS fold),
    t AS (SELECT fold, avg(dem) mean FROM f CROSS JOIN s CROSS JOIN dev WHERE k <= m - (4 - fold) * z GROUP BY fold),
    e AS (SELECT fold, avg(abs(dem - mean)) mae FROM t CROSS JOIN s CROSS JOIN dev
          WHERE k > m - (4 - fold) * z AND k <= m - (3 - fold) * z GROUP BY fold)
    SELECT fold, round(mae, 6) AS mae, round(avg(mae) OVER (), 6) AS cv_mae FROM e""",
)
SQL["panel_year_read_back"] = query(
    "feat", "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Year:i",
    "SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, dem AS Actual_Demand, year(mon) AS Year FROM feat WHERE year(mon) = 2000",
)

_DEVELOPMENT = "SELECT * FROM usable WHERE mon < (SELECT min(mon) FROM test)"
SQL["fold_guard"] = query(
    "usable test", "folds:i,allowed:b",
    f"""
    WITH s AS (SELECT count(DISTINCT mon) AS n FROM ({_DEVELOPMENT}))
    SELECT v AS folds, n > v AS allowed FROM (SELECT n, unnest([1, n // 2, n - 1, n, n + 1]) AS v FROM s)""",
)
_VECTOR = ["lag1", "lag2", "lag3", "lag6", "lag12", "roll3", "roll6", "month(mon)", "quarter(mon)", "tidx"]
SQL["feature_vectors"] = query(
    "test", "Month:t,Product_ID:s,Region_ID:i,label:d," + ",".join(f"x{i}:d" for i in range(len(_VECTOR))),
    "SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, dem AS label, "
    + ", ".join(f"{c} AS x{i}" for i, c in enumerate(_VECTOR)) + " FROM test",
)


def boosted_trees(trees: int, sizes: tuple[int, ...], rate: int = 10, least: int = 20, scale: int = 10_000) -> str:
    """Best-first boosted trees, one split per step: of all leaves the split of largest gain.

    A leaf's residual sums are cumulated over the bins of every feature; a step's only
    row holds the split that it makes.
    """
    features = ", ".join(f"{{'f': {i}, 'v': CAST({c} AS DOUBLE)}}" for i, c in enumerate(_VECTOR))

    def rounded(top: str, bottom: str) -> str:
        return f"(sign({top}) * ((2 * abs({top}) + {bottom}) // (2 * {bottom})))::BIGINT"

    steps = [
        f"dev AS ({_DEVELOPMENT})",
        "numbered AS (SELECT *, row_number() OVER (ORDER BY mon, prod, reg) AS rid FROM dev)",
        f"vals AS (SELECT rid, x.f, x.v FROM (SELECT rid, unnest([{features}]) AS x FROM numbered))",
        """counted AS (SELECT f, v, n, sum(n) OVER (PARTITION BY f ORDER BY v) - n AS below,
               sum(n) OVER (PARTITION BY f) AS whole, count(*) OVER (PARTITION BY f) AS many
               FROM (SELECT f, v, count(*) AS n FROM vals GROUP BY f, v))""",
        """cut AS (SELECT f, v, dense_rank() OVER (PARTITION BY f ORDER BY
               CASE WHEN many > 255 THEN CAST((below * 255) // whole AS DOUBLE) ELSE v END) - 1 AS bin FROM counted)""",
        "binned AS (SELECT rid, f, bin FROM vals JOIN cut USING (f, v))",
    ]
    out = []
    for size in sizes:
        score = f"s{size}_0"
        steps.append(f"{score} AS (SELECT rid, {rounded(f'(SELECT sum(dem)::BIGINT * {scale} FROM numbered)', '(SELECT count(*) FROM numbered)')} AS score FROM numbered)")
        for tree in range(1, trees + 1):
            name = f"a{size}_{tree}_"
            steps.append(f"{name}0 AS (SELECT rid, 1::BIGINT AS leaf, dem::BIGINT * {scale} - score AS res FROM numbered JOIN {score} USING (rid))")
            for k in range(1, size):
                split = f"b{size}_{tree}_{k}"
                gain = "ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) - ts * ts / tn"
                steps.append(f"""{split} AS (SELECT leaf AS at, f, bin AS edge FROM (
                    SELECT leaf, f, bin, {gain} AS gain FROM (
                        SELECT leaf, f, bin, CAST(sum(s) OVER w AS DOUBLE) AS ls, CAST(sum(n) OVER w AS DOUBLE) AS ln,
                               CAST(sum(s) OVER (PARTITION BY leaf, f) AS DOUBLE) AS ts,
                               CAST(sum(n) OVER (PARTITION BY leaf, f) AS DOUBLE) AS tn
                        FROM (SELECT leaf, f, bin, sum(res) AS s, count(*) AS n
                              FROM {name}{k - 1} JOIN binned USING (rid) GROUP BY leaf, f, bin)
                        WINDOW w AS (PARTITION BY leaf, f ORDER BY bin))
                    WHERE ln >= {least} AND tn - ln >= {least})
                    WHERE gain > 0 ORDER BY gain DESC, leaf, f, bin LIMIT 1)""")
                steps.append(f"""{name}{k} AS (SELECT a.rid, a.res, CASE WHEN x.at IS NULL THEN a.leaf
                    WHEN b.bin <= x.edge THEN 2 * a.leaf ELSE 2 * a.leaf + 1 END AS leaf
                    FROM {name}{k - 1} a LEFT JOIN {split} x ON x.at = a.leaf
                    LEFT JOIN binned b ON b.rid = a.rid AND b.f = x.f)""")
            last = f"{name}{size - 1}"
            steps.append(f"v{size}_{tree} AS (SELECT leaf, count(*) AS n, {rounded(f'({rate} * sum(res)::BIGINT)', '(100 * count(*))')} AS y FROM {last} GROUP BY leaf)")
            steps.append(f"s{size}_{tree} AS (SELECT rid, score + y AS score FROM {last} JOIN v{size}_{tree} USING (leaf) JOIN {score} USING (rid))")
            score = f"s{size}_{tree}"
            out.append(f"SELECT {size} AS max_leaf_nodes, {tree} AS tree, leaf AS node, n AS rows, y / {scale}::DOUBLE AS value FROM v{size}_{tree}")
    named = ", ".join(x.replace(" AS (", " AS MATERIALIZED (", 1) for x in steps)
    return f"WITH {named} {' UNION ALL '.join(out)}"


SQL["boosted_first_trees"] = query(
    "usable test", "max_leaf_nodes:i,tree:i,node:i,rows:i,value:d", boosted_trees(2, (15, 31))
)

# --- forecast accuracy -------------------------------------------------------------

_DETAIL = """mon AS forecast_month, prod AS Product_ID, reg AS Region_ID, dem AS Actual_Demand,
    model AS Model, pred AS forecast_demand, cat AS Product_Category, pline AS Product_Line,
    rname AS Region, 'Final test / rolling one-month-ahead' AS evaluation_scope,
    err AS forecast_error, aerr AS absolute_error, serr AS squared_error"""
_DETAIL_TYPES = (
    "forecast_month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Model:s,forecast_demand:d,"
    "Product_Category:s,Product_Line:s,Region:s,evaluation_scope:s,forecast_error:d,"
    "absolute_error:d,squared_error:d"
)
SQL["forecast_detail"] = query("detail", _DETAIL_TYPES, f"SELECT {_DETAIL} FROM detail")

_BLOCK = f"""min(mon) AS evaluation_start, max(mon) AS evaluation_end, count(*) AS observation_count,
    count(DISTINCT mon) AS evaluated_months, sum(dem) AS actual_demand, sum(pred) AS forecast_demand,
    sum(aerr) AS absolute_error_sum, sum(serr) AS squared_error_sum, sum(err) AS error_sum,
    {div('sum(aerr)', 'count(*)')} AS mae, sqrt({div('sum(serr)', 'count(*)')}) AS rmse,
    {pct('sum(aerr)', 'sum(dem)')} AS wape_pct, {div('sum(err)', 'count(*)')} AS mean_bias,
    {pct('sum(err)', 'sum(dem)')} AS forecast_bias_pct,
    count(CASE WHEN err > 0 THEN 1 END) AS overforecast_count,
    count(CASE WHEN err < 0 THEN 1 END) AS underforecast_count"""
_BLOCK_TYPES = (
    "evaluation_start:t,evaluation_end:t,observation_count:i,evaluated_months:i,actual_demand:i,"
    "forecast_demand:d,absolute_error_sum:d,squared_error_sum:d,error_sum:d,mae:d,rmse:d,wape_pct:d,"
    "mean_bias:d,forecast_bias_pct:d,overforecast_count:i,underforecast_count:i"
)


def _accuracy(keys: str, types: str, group: str) -> str:
    lead = f"{keys}, " if keys else ""
    by = f"{group}, model" if group else "model"
    return query(
        "detail", f"{types},Model:s,{_BLOCK_TYPES}".lstrip(","),
        f"SELECT {lead}model AS Model, {_BLOCK} FROM detail GROUP BY {by}",
    )


SQL["model_benchmark"] = _accuracy("", "", "")
SQL["annual_forecast_accuracy"] = _accuracy("year(mon) AS forecast_year", "forecast_year:i", "year(mon)")
SQL["product_forecast_accuracy"] = _accuracy(
    "prod AS Product_ID, cat AS Product_Category, pline AS Product_Line",
    "Product_ID:s,Product_Category:s,Product_Line:s", "prod, cat, pline",
)
SQL["regional_forecast_accuracy"] = _accuracy(
    "reg AS Region_ID, rname AS Region", "Region_ID:i,Region:s", "reg, rname"
)
SQL["product_market_forecast_accuracy"] = _accuracy(
    "prod AS Product_ID, cat AS Product_Category, pline AS Product_Line, reg AS Region_ID, rname AS Region",
    "Product_ID:s,Product_Category:s,Product_Line:s,Region_ID:i,Region:s", "prod, cat, pline, reg, rname",
)
SQL["monthly_forecast_trend"] = _accuracy("mon AS forecast_month", "forecast_month:t", "mon")

# MAE of the three models side by side, per series.
_SERIES = f"""
    SELECT prod, cat, reg, rname, count(CASE WHEN model = 'Moving Average 6' THEN 1 END) n,
           {div("sum(CASE WHEN model = 'Moving Average 6' THEN aerr END)", "count(CASE WHEN model = 'Moving Average 6' THEN 1 END)")} m,
           {div("sum(CASE WHEN model = 'Naive Forecast' THEN aerr END)", "count(CASE WHEN model = 'Naive Forecast' THEN 1 END)")} nv,
           {div("sum(CASE WHEN model = 'Seasonal Naive' THEN aerr END)", "count(CASE WHEN model = 'Seasonal Naive' THEN 1 END)")} sn,
           sum(CASE WHEN model = 'Moving Average 6' THEN aerr END) ae,
           sum(CASE WHEN model = 'Moving Average 6' THEN serr END) se,
           sum(CASE WHEN model = 'Moving Average 6' THEN err END) e,
           sum(CASE WHEN model = 'Moving Average 6' THEN dem END) a,
           count(CASE WHEN model = 'Moving Average 6' AND err > 0 THEN 1 END) o,
           count(CASE WHEN model = 'Moving Average 6' AND err < 0 THEN 1 END) u
    FROM detail GROUP BY prod, cat, reg, rname"""
CTES["series"] = _SERIES
_USES["series"] = ["detail"]

SQL["series_benchmark_comparison"] = query(
    "series",
    "Product_ID:s,Product_Category:s,Region_ID:i,Region:s,moving_average_6_mae:d,naive_mae:d,"
    "seasonal_naive_mae:d,beats_naive:b,beats_seasonal_naive:b,beats_both_baselines:b,"
    "mae_reduction_vs_naive_pct:d,mae_reduction_vs_seasonal_pct:d",
    f"""
    SELECT prod AS Product_ID, cat AS Product_Category, reg AS Region_ID, rname AS Region,
           m AS moving_average_6_mae, nv AS naive_mae, sn AS seasonal_naive_mae, m < nv AS beats_naive,
           m < sn AS beats_seasonal_naive, m < nv AND m < sn AS beats_both_baselines,
           {pct('(nv - m)', 'nv')} AS mae_reduction_vs_naive_pct,
           {pct('(sn - m)', 'sn')} AS mae_reduction_vs_seasonal_pct FROM series""",
)
SQL["repeated_forecast_bias"] = query(
    "series",
    "Product_ID:s,Product_Category:s,Region_ID:i,Region:s,observation_count:i,mae:d,wape_pct:d,"
    "mean_bias:d,overforecast_count:i,underforecast_count:i,review_reason:s",
    f"""
    SELECT prod AS Product_ID, cat AS Product_Category, reg AS Region_ID, rname AS Region,
           n AS observation_count, m AS mae, {pct('ae', 'a')} AS wape_pct, {div('e', 'n')} AS mean_bias,
           o AS overforecast_count, u AS underforecast_count,
           concat(if(o >= 5, 'Overforecast', 'Underforecast'), ' in at least 5 of 6 months') AS review_reason
    FROM series WHERE n = 6 AND greatest(o, u) >= 5""",
)
SQL["planning_exceptions"] = query(
    "detail",
    _DETAIL_TYPES + ",forecast_error_pct:d,forecast_direction:s,exception_priority:i",
    f"""
    SELECT {_DETAIL}, {pct('err', 'dem')} AS forecast_error_pct,
           CASE sign(err) WHEN 1 THEN 'Overforecast' WHEN -1 THEN 'Underforecast' ELSE 'Exact' END
               AS forecast_direction,
           dense_rank() OVER (ORDER BY aerr DESC) AS exception_priority
    FROM detail WHERE model = 'Moving Average 6'""",
)
SQL["forecast_results"] = query(
    "wide",
    "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Naive_Forecast:d,Seasonal_Naive_Forecast:d,"
    "Forecast_Demand:d,Forecast_Error:d,Absolute_Error:d,Squared_Error:d",
    """
    SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, dem AS Actual_Demand,
           naive AS Naive_Forecast, seasonal AS Seasonal_Naive_Forecast, fc AS Forecast_Demand,
           fc - dem AS Forecast_Error, abs(fc - dem) AS Absolute_Error,
           (fc - dem) * (fc - dem) AS Squared_Error FROM wide""",
)
SQL["benchmark_results"] = query(
    "detail", "Model:s,MAE:d,RMSE:d",
    f"""SELECT model AS Model, {div('sum(aerr)', 'count(*)')} AS MAE,
        sqrt({div('sum(serr)', 'count(*)')}) AS RMSE FROM detail GROUP BY model""",
)

# --- error review ------------------------------------------------------------------

_SEGMENT_TYPES = (
    "Model:s,Observations:i,Actual_Total:i,Absolute_Error_Total:d,MAE:d,RMSE:d,WAPE_pct:d,Bias:d,"
    "Overforecast_Count:i,Underforecast_Count:i"
)
_SEGMENT = f"""model AS Model, count(*) AS Observations, sum(dem) AS Actual_Total,
    sum(aerr) AS Absolute_Error_Total, {div('sum(aerr)', 'count(*)')} AS MAE,
    sqrt({div('sum(serr)', 'count(*)')}) AS RMSE, {pct('sum(aerr)', 'sum(dem)')} AS WAPE_pct,
    {div('sum(err)', 'count(*)')} AS Bias, sum(CAST(err > 0 AS INT)) AS Overforecast_Count,
    sum(CAST(err < 0 AS INT)) AS Underforecast_Count"""
for _name, _keys, _kinds, _by in (
    ("errors_by_product", "prod AS Product_ID", "Product_ID:s", "prod"),
    ("errors_by_region", "reg AS Region_ID", "Region_ID:i", "reg"),
    ("errors_by_month", "mon AS Month", "Month:t", "mon"),
    ("errors_by_series", "prod AS Product_ID, reg AS Region_ID", "Product_ID:s,Region_ID:i", "prod, reg"),
):
    SQL[_name] = query(
        "detail", f"{_kinds},{_SEGMENT_TYPES}",
        f"SELECT {_keys}, {_SEGMENT} FROM detail GROUP BY {_by}, model",
    )

_REVIEW = f"""prod AS Product_ID, reg AS Region_ID, 'Moving Average 6' AS Model, n AS Observations,
    a AS Actual_Total, ae AS Absolute_Error_Total, m AS MAE, sqrt({div('se', 'n')}) AS RMSE,
    {pct('ae', 'a')} AS WAPE_pct, {div('e', 'n')} AS Bias, o AS Overforecast_Count,
    u AS Underforecast_Count, nv AS "Naive Forecast", sn AS "Seasonal Naive",
    {pct('ae', '(SELECT sum(ae) FROM series)')} AS Absolute_Error_Share_pct,
    m < nv AND m < sn AS Beats_Both_Baselines"""
_REVIEW_TYPES = (
    f"Product_ID:s,Region_ID:i,{_SEGMENT_TYPES},Naive Forecast:d,Seasonal Naive:d,"
    "Absolute_Error_Share_pct:d,Beats_Both_Baselines:b"
)
SQL["series_errors"] = query("series", _REVIEW_TYPES, f"SELECT {_REVIEW} FROM series")
SQL["top_series"] = query(
    "series", _REVIEW_TYPES,
    f"SELECT {_REVIEW} FROM series ORDER BY MAE DESC, Product_ID, Region_ID LIMIT 10",
)
SQL["repeated_bias_series"] = query(
    "series", _REVIEW_TYPES, f"SELECT {_REVIEW} FROM series WHERE o >= 5 OR u >= 5"
)
SQL["not_beating_baselines"] = query(
    "series", _REVIEW_TYPES, f"SELECT {_REVIEW} FROM series WHERE m >= nv OR m >= sn"
)
SQL["largest_errors"] = query(
    "wide", "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Forecast_Demand:d,Forecast_Error:d",
    """SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, dem AS Actual_Demand,
              fc AS Forecast_Demand, fc - dem AS Forecast_Error
       FROM wide ORDER BY abs(fc - dem) DESC, mon, prod, reg LIMIT 5""",
)
SQL["overall_summary"] = query(
    "series",
    "Series:i,Beats_Naive:i,Beats_Seasonal_Naive:i,Beats_Both:i,Overall_WAPE_pct:d,Overall_Mean_Bias:d",
    f"""SELECT count(*) AS Series, sum(CAST(m < nv AS INT)) AS Beats_Naive,
               sum(CAST(m < sn AS INT)) AS Beats_Seasonal_Naive,
               sum(CAST(m < least(nv, sn) AS INT)) AS Beats_Both,
               {pct('sum(ae)', 'sum(a)')} AS Overall_WAPE_pct, {div('sum(e)', 'sum(n)')} AS Overall_Mean_Bias
        FROM series""",
)

# --- order diagnostics -------------------------------------------------------------

CTES["diag"] = f"""
    SELECT g.*, {div('d', 'n')} sz, q.top
    FROM (SELECT mon, prod, reg, sum(qty) d, count(*) n, max(qty) mx, count(DISTINCT cust) c, sum(rev) r
          FROM line GROUP BY mon, prod, reg) g
    JOIN (SELECT mon, prod, reg, max(t) top FROM
            (SELECT mon, prod, reg, cust, sum(qty) t FROM line GROUP BY mon, prod, reg, cust)
          GROUP BY mon, prod, reg) q USING (mon, prod, reg)"""
_USES["diag"] = ["line"]
_DIAG = f"""mon AS Month, prod AS Product_ID, reg AS Region_ID, d AS Actual_Demand, n AS Order_Count,
    sz AS Average_Order_Quantity, mx AS Largest_Order, c AS Active_Customers, r AS Revenue,
    {div('r', 'd')} AS Weighted_Unit_Price, {pct('mx', 'd')} AS Largest_Order_Share_pct,
    top AS Largest_Customer_Quantity, {pct('top', 'd')} AS Largest_Customer_Share_pct"""
_DIAG_TYPES = (
    "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Order_Count:i,Average_Order_Quantity:d,"
    "Largest_Order:i,Active_Customers:i,Revenue:d,Weighted_Unit_Price:d,Largest_Order_Share_pct:d,"
    "Largest_Customer_Quantity:i,Largest_Customer_Share_pct:d"
)
SQL["order_diagnostics"] = query("diag", _DIAG_TYPES, f"SELECT {_DIAG} FROM diag")
SQL["customer_concentration"] = query(
    "diag",
    "Month:t,Product_ID:s,Region_ID:i,Actual_Demand:i,Largest_Customer_Quantity:i,Largest_Customer_Share_pct:d",
    f"""SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, d AS Actual_Demand,
        top AS Largest_Customer_Quantity, {pct('top', 'd')} AS Largest_Customer_Share_pct FROM diag""",
)
CTES["change"] = """
    SELECT *, lag(d) OVER w d0, lag(n) OVER w n0, lag(sz) OVER w sz0 FROM diag
    WINDOW w AS (PARTITION BY prod, reg ORDER BY mon)"""
_USES["change"] = ["diag"]
_CHANGE = """, d - d0 AS Demand_Change, (n - n0) * (sz + sz0) / 2 AS Order_Count_Contribution,
    (sz - sz0) * (n + n0) / 2 AS Order_Size_Contribution"""
_CHANGE_TYPES = ",Demand_Change:i,Order_Count_Contribution:d,Order_Size_Contribution:d"
SQL["demand_decomposition"] = query(
    "change", _DIAG_TYPES + _CHANGE_TYPES, f"SELECT {_DIAG}{_CHANGE} FROM change"
)
# The focus of the drill-down: two products in one region.
_FOCUS = "prod IN ('Brand#3', 'Brand#4') AND reg = 3"
SQL["focus_orders"] = query(
    "line",
    "Order_ID:i,Order_Date:t,Customer_ID:i,Product_ID:s,Region_ID:i,Quantity:i,Unit_Price:d,Revenue:d,"
    "Order_Status:s,Month:t",
    f"""SELECT oid AS Order_ID, odate AS Order_Date, cust AS Customer_ID, prod AS Product_ID,
        reg AS Region_ID, qty AS Quantity, price AS Unit_Price, rev AS Revenue, status AS Order_Status,
        mon AS Month FROM line WHERE {_FOCUS}""",
)
SQL["focus_test"] = query(
    "change wide",
    _DIAG_TYPES + _CHANGE_TYPES + ",Naive_Forecast:d,Seasonal_Naive_Forecast:d,Forecast_Demand:d,"
    "Forecast_Error:d,Absolute_Error:d,Squared_Error:d",
    f"""SELECT {_DIAG.replace('mon AS', 'x.mon AS').replace('prod AS', 'x.prod AS').replace('reg AS', 'x.reg AS')}
        {_CHANGE}, naive AS Naive_Forecast, seasonal AS Seasonal_Naive_Forecast, fc AS Forecast_Demand,
        fc - dem AS Forecast_Error, abs(fc - dem) AS Absolute_Error,
        (fc - dem) * (fc - dem) AS Squared_Error
        FROM change x JOIN wide w ON w.mon = x.mon AND w.prod = x.prod AND w.reg = x.reg AND w.dem = x.d""",
)
SQL["customer_monthly"] = query(
    "line", "Month:t,Product_ID:s,Region_ID:i,Customer_ID:i,Customer_Quantity:i",
    """SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID, cust AS Customer_ID,
       sum(qty) AS Customer_Quantity FROM line GROUP BY mon, prod, reg, cust""",
)
SQL["customer_change"] = query(
    "line", "Customer_ID:i,First_Quantity:i,Second_Quantity:i,Quantity_Change:i",
    """SELECT cust AS Customer_ID, coalesce(sum(qty) FILTER (mon = DATE '2001-06-01'), 0) AS First_Quantity,
       coalesce(sum(qty) FILTER (mon = DATE '2001-07-01'), 0) AS Second_Quantity,
       sum(CASE WHEN mon = DATE '2001-07-01' THEN qty ELSE -qty END) AS Quantity_Change
       FROM line WHERE mon IN (DATE '2001-06-01', DATE '2001-07-01') GROUP BY cust""",
)
SQL["largest_orders"] = query(
    "line", "Order_ID:i,Order_Date:t,Customer_ID:i,Quantity:i,Unit_Price:d,Order_Status:s",
    """SELECT oid AS Order_ID, odate AS Order_Date, cust AS Customer_ID, qty AS Quantity,
       price AS Unit_Price, status AS Order_Status FROM line
       ORDER BY qty DESC, oid, cust, odate, price, status LIMIT 5""",
)
SQL["status_matrix"] = query(
    "line", "Product_ID:s,Month:t,Completed:i,Delayed:i",
    """SELECT prod AS Product_ID, mon AS Month, sum(if(status = 'Completed', qty, 0)) AS Completed,
       sum(if(status = 'Delayed', qty, 0)) AS Delayed FROM line GROUP BY prod, mon""",
)
SQL["size_quantiles"] = query(
    "line", "Product_ID:s,Median_Quantity:d,P95_Quantity:d,Max_Quantity:d",
    """SELECT prod AS Product_ID, quantile_cont(qty, 0.5) AS Median_Quantity,
       quantile_cont(qty, 0.95) AS P95_Quantity, max(qty) AS Max_Quantity
       FROM line WHERE mon < DATE '2001-03-01' GROUP BY prod""",
)
SQL["weighted_price"] = query(
    "diag", "Product_ID:s,Region_ID:i,Month:t,Weighted_Unit_Price:d",
    f"""SELECT prod AS Product_ID, reg AS Region_ID, mon AS Month,
        {div('r', 'd')} AS Weighted_Unit_Price FROM diag""",
)

# --- quality gates -----------------------------------------------------------------

SQL["quality_report"] = query(
    "line",
    "duplicate_order_ids:i,missing_required_values:i,invalid_dates:i,non_positive_quantity:i",
    """SELECT count(*) - count(DISTINCT oid) AS duplicate_order_ids,
       count(*) FILTER (oid IS NULL OR odate IS NULL OR prod IS NULL OR reg IS NULL OR qty IS NULL)
           AS missing_required_values,
       count(*) FILTER (odate IS NULL) AS invalid_dates,
       count(*) FILTER (qty <= 0) AS non_positive_quantity FROM line""",
)
SQL["duplicate_line_keys"] = query(
    "area", "l_orderkey:i,l_linenumber:i,rows:i",
    """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
SQL["duplicate_order_keys"] = query(
    "area", "o_orderkey:i,rows:i",
    "SELECT o_orderkey, count(*) AS rows FROM orders GROUP BY o_orderkey HAVING count(*) > 1",
)
_GATES = """
    SELECT 'order date' AS "check", count(*) FILTER (odate IS NULL) AS violations FROM line
    UNION ALL SELECT 'order numbers', count(*) FILTER (qty IS NULL OR rev IS NULL OR days IS NULL) FROM line
    UNION ALL SELECT 'order quantity', count(*) FILTER (qty <= 0) FROM line
    UNION ALL SELECT 'order status', count(*) FILTER (status NOT IN ('Completed', 'Delayed')) FROM line
    UNION ALL SELECT 'delivery rule', count(*) FILTER ((status = 'Completed') <> (days <= 26)) FROM line"""
SQL["order_rule_violations"] = query("line", "check:s,violations:i", _GATES)
SQL["reference_violations"] = query(
    "line item area buyer", "check:s,violations:i",
    """SELECT 'order products' AS "check",
              count(DISTINCT prod) FILTER (prod NOT IN (SELECT prod FROM item)) AS violations FROM line
       UNION ALL SELECT 'order regions', count(DISTINCT reg) FILTER (reg NOT IN (SELECT reg FROM area)) FROM line
       UNION ALL SELECT 'order customers',
              count(DISTINCT cust) FILTER (cust NOT IN (SELECT cust FROM buyer)) FROM line
       UNION ALL SELECT 'customer regions',
              count(DISTINCT creg) FILTER (creg NOT IN (SELECT reg FROM area)) FROM buyer""",
)
# Customers that never ordered: the same anti-join seen from the dimension.
SQL["customers_without_orders"] = query(
    "line buyer", "Customer_ID:i,rows:i",
    "SELECT cust AS Customer_ID, 1 AS rows FROM buyer WHERE cust NOT IN (SELECT cust FROM line)",
)
SQL["panel_report"] = query(
    "panel", "panel_rows:i,products:i,regions:i,repeated_cells:i,months:i,spine_months:i",
    """SELECT count(*) AS panel_rows, count(DISTINCT prod) AS products, count(DISTINCT reg) AS regions,
       count(*) - count(DISTINCT (mon, prod, reg)) AS repeated_cells, count(DISTINCT mon) AS months,
       date_diff('month', min(mon), max(mon)) + 1 AS spine_months FROM panel""",
)
SQL["split_report"] = query(
    "usable test", "side:s,rows:i,first_month:t,last_month:t,months:i,incomplete_rows:i",
    """SELECT if(mon >= (SELECT min(mon) FROM test), 'test', 'development') AS side, count(*) AS rows,
       min(mon) AS first_month, max(mon) AS last_month, count(DISTINCT mon) AS months,
       count(*) FILTER (lag12 IS NULL) AS incomplete_rows FROM usable GROUP BY 1""",
)
SQL["baseline_mismatches"] = query(
    "wide panel", "check:s,violations:i",
    """SELECT v.k AS "check", count(*) FILTER (coalesce(p.dem, 0) <> v.val) AS violations
       FROM (SELECT w.*, unnest([
                {'k': 'forecast actuals', 'back': 0, 'val': CAST(dem AS DECIMAL(18,2))},
                {'k': 'naive baseline', 'back': 1, 'val': naive},
                {'k': 'seasonal baseline', 'back': 12, 'val': seasonal}]) AS v FROM wide w) x
       LEFT JOIN panel p ON p.mon = x.mon - to_months(v.back) AND p.prod = x.prod AND p.reg = x.reg
       GROUP BY v.k""",
)
SQL["forecast_rule_violations"] = query(
    "wide", "check:s,violations:i",
    """SELECT 'forecast month' AS "check", count(*) FILTER (day(mon) <> 1) AS violations FROM wide
       UNION ALL SELECT 'forecast numbers',
           count(*) FILTER (dem IS NULL OR naive IS NULL OR seasonal IS NULL OR fc IS NULL) FROM wide
       UNION ALL SELECT 'forecast demand', count(*) FILTER (dem < 0) FROM wide
       UNION ALL SELECT 'stored errors', count(*) FILTER (fc - dem IS NULL) FROM wide""",
)
SQL["recomputed_metrics"] = query(
    "detail", "Model:s,mae:d,rmse:d,wape_pct:d,mean_bias:d",
    f"""SELECT model AS Model, {div('sum(aerr)', 'count(*)')} AS mae,
        sqrt({div('sum(serr)', 'count(*)')}) AS rmse, {pct('sum(aerr)', 'sum(dem)')} AS wape_pct,
        {div('sum(err)', 'count(*)')} AS mean_bias FROM detail GROUP BY model""",
)
SQL["grouped_totals"] = query(
    "detail", "view:s,Model:s,observations:i,absolute_error:d,squared_error:d",
    """SELECT v AS view, model AS Model, count(*) AS observations, sum(aerr) AS absolute_error,
       sum(serr) AS squared_error
       FROM detail CROSS JOIN (SELECT unnest(['annual', 'product', 'region', 'series', 'month']) AS v)
       GROUP BY v, model""",
)
SQL["result_gate"] = query(
    "detail wide cell", "check:s,violations:i",
    """SELECT 'detail rows' AS "check",
              CAST((SELECT count(*) FROM detail) <> 3 * (SELECT count(*) FROM wide) AS INT) AS violations
       UNION ALL SELECT 'model metrics', CAST((SELECT sum(aerr) FROM detail)
              <> (SELECT sum(abs(fc - dem) + abs(naive - dem) + abs(seasonal - dem)) FROM wide) AS INT)
       UNION ALL SELECT 'grouped totals', CAST((SELECT sum(a) FROM
              (SELECT sum(aerr) a FROM detail GROUP BY prod, reg)) <> (SELECT sum(aerr) FROM detail) AS INT)
       UNION ALL SELECT 'order reconciliation', count(DISTINCT w.mon) FROM wide w
              LEFT JOIN cell c ON c.mon = w.mon AND c.prod = w.prod AND c.reg = w.reg
              WHERE coalesce(c.dem, 0) <> w.dem""",
)
SQL["decomposition_violations"] = query(
    "change", "Month:t,Product_ID:s,Region_ID:i",
    """SELECT mon AS Month, prod AS Product_ID, reg AS Region_ID FROM change
       WHERE abs((d - d0) - (n - n0) * (sz + sz0) / 2 - (sz - sz0) * (n + n0) / 2) > 0.001""",
)

# Faults planted by key, as in the registered query, and what every gate must count.
CTES["porder"] = """
    SELECT oid, rev, CASE WHEN oid % 97 = 5 THEN NULL ELSE odate END AS odate,
           CASE WHEN oid % 97 = 5 THEN NULL ELSE mon END AS mon,
           CASE WHEN oid % 97 = 3 THEN -1 ELSE cust END AS cust,
           CASE WHEN oid % 97 = 1 THEN 'none' ELSE prod END AS prod,
           CASE WHEN oid % 97 = 2 THEN 99 ELSE reg END AS reg,
           CASE WHEN oid % 97 = 0 THEN 0 ELSE qty END AS qty,
           CASE WHEN oid % 97 = 6 THEN NULL ELSE days END AS days,
           CASE WHEN oid % 97 = 4 THEN 'Lost' ELSE status END AS status FROM line"""
CTES["pcell"] = "SELECT mon, prod, reg, sum(qty) AS dem FROM porder WHERE mon IS NOT NULL GROUP BY mon, prod, reg"
CTES["pfact"] = """
    WITH chosen AS (
        SELECT CASE WHEN prod = 'Brand#2' AND reg = 4 THEN mon + 1 ELSE mon END AS mon, prod, reg,
               CASE WHEN prod = 'Brand#2' AND reg = 0 THEN -5 ELSE dem END AS dem,
               CASE WHEN prod = 'Brand#2' AND reg = 1 THEN naive + 1 ELSE naive END AS naive,
               CASE WHEN prod = 'Brand#2' AND reg = 2 THEN NULL ELSE seasonal END AS seasonal, fc,
               fc - dem AS err, abs(fc - dem) AS aerr,
               (fc - dem) * (fc - dem) + CASE WHEN prod = 'Brand#2' AND reg = 3 THEN 2 ELSE 0 END AS serr
        FROM wide)
    SELECT * FROM chosen
    UNION ALL SELECT * REPLACE ('none' AS prod) FROM chosen WHERE prod = 'Brand#3' AND reg = 0
    UNION ALL SELECT * REPLACE (99 AS reg) FROM chosen WHERE prod = 'Brand#3' AND reg = 1
    UNION ALL SELECT * FROM chosen WHERE prod = 'Brand#3' AND reg = 2"""
_USES |= {"porder": ["line"], "pcell": ["porder"], "pfact": ["wide"]}


def _off(a: str, b: str) -> str:
    return f"NOT coalesce(abs(CAST({a} AS DOUBLE) - CAST({b} AS DOUBLE)) <= 1e-7 * abs(CAST({b} AS DOUBLE)), false)"


def _lookup(name: str, column: str, months: int) -> str:
    return f"""SELECT '{name}', count(*) FILTER ({_off('r.' + column, 'coalesce(c.dem, 0)')}) FROM pfact r
        LEFT JOIN pcell c ON CAST(c.mon + INTERVAL {months} MONTH AS DATE) = r.mon AND c.prod = r.prod AND c.reg = r.reg"""


def _stray(name: str, column: str, table: str, key: str, dimension: str) -> str:
    return f"SELECT '{name}', count(DISTINCT {column}) FROM {table} WHERE {column} NOT IN (SELECT {key} FROM {dimension})"


_PLANTED = [
    """SELECT 'order date' AS "check", count(*) FILTER (odate IS NULL) AS violations FROM porder""",
    "SELECT 'order numbers', count(*) FILTER (qty IS NULL OR rev IS NULL OR days IS NULL) FROM porder",
    "SELECT 'order quantity', count(*) FILTER (qty <= 0) FROM porder",
    "SELECT 'order status', count(*) FILTER (status NOT IN ('Completed', 'Delayed')) FROM porder",
    """SELECT 'delivery rule', count(*) FILTER (NOT coalesce((status = 'Completed' AND days <= 26)
           OR (status = 'Delayed' AND days > 26), false)) FROM porder""",
    "SELECT 'forecast month', count(*) FILTER (day(mon) <> 1) FROM pfact",
    "SELECT 'forecast numbers', count(*) FILTER (dem IS NULL OR naive IS NULL OR seasonal IS NULL OR fc IS NULL) FROM pfact",
    "SELECT 'forecast demand', count(*) FILTER (dem < 0) FROM pfact",
    f"""SELECT 'stored errors', count(*) FILTER ({_off('err', '(fc - dem)')} OR {_off('aerr', 'abs(fc - dem)')}
           OR {_off('serr', '((fc - dem) * (fc - dem))')}) FROM pfact""",
    "SELECT 'orders not empty', CAST(count(*) = 0 AS INT) FROM porder",
    "SELECT 'forecast not empty', CAST(count(*) = 0 AS INT) FROM pfact",
    "SELECT 'order key', count(*) FROM (SELECT oid FROM porder GROUP BY oid HAVING count(*) > 1)",
    "SELECT 'customer key', count(*) FROM buyer WHERE cust % 40 = 0",
    "SELECT 'product key', count(*) FROM item WHERE prod = 'Brand#4'",
    "SELECT 'region key', count(*) FROM area WHERE reg < 2",
    "SELECT 'forecast key', count(*) FROM (SELECT mon, prod, reg FROM pfact GROUP BY mon, prod, reg HAVING count(*) > 1)",
    _stray("order products", "prod", "porder", "prod", "item"),
    _stray("order regions", "reg", "porder", "reg", "area"),
    _stray("order customers", "cust", "porder", "cust", "buyer"),
    _stray("forecast products", "prod", "pfact", "prod", "item"),
    _stray("forecast regions", "reg", "pfact", "reg", "area"),
    "SELECT 'customer regions', CAST(count(*) > 0 AS INT) FROM buyer WHERE cust % 50 = 0",
    _lookup("forecast actuals", "dem", 0),
    _lookup("naive baseline", "naive", 1),
    _lookup("seasonal baseline", "seasonal", 12),
]
SQL["planted_input_gate"] = query("pfact pcell item area buyer", "check:s,violations:i", " UNION ALL ".join(_PLANTED))
SQL["panel_reconciliation"] = query(
    "panel cell",
    "Month:t,Product_ID:s,Region_ID:i,panel_demand:i,panel_rows:i,orders_demand:i,orders_rows:i",
    """
    WITH own AS (SELECT *, prod || '/' || reg || '/' || month(mon) AS place FROM panel),
    held AS (
        SELECT mon, prod, reg, dem + CASE WHEN place = 'Brand#6/2/7' THEN 3 ELSE 0 END AS dem FROM own WHERE place <> 'Brand#2/1/5'
        UNION ALL SELECT mon, prod, reg, dem FROM own WHERE place = 'Brand#9/0/2'),
    ordered AS (
        SELECT mon, prod, reg, dem FROM cell
        UNION ALL SELECT CAST(mon + INTERVAL 600 MONTH AS DATE), prod, reg, dem FROM cell
                  WHERE prod = 'Brand#1' AND reg = 4 AND month(mon) = 3),
    p AS (SELECT mon, prod, reg, sum(dem) AS d, count(*) AS n FROM held GROUP BY mon, prod, reg),
    o AS (SELECT mon, prod, reg, sum(dem) AS d, count(*) AS n FROM ordered GROUP BY mon, prod, reg)
    SELECT coalesce(p.mon, o.mon) AS Month, coalesce(p.prod, o.prod) AS Product_ID, coalesce(p.reg, o.reg) AS Region_ID,
           p.d AS panel_demand, coalesce(p.n, 0) AS panel_rows, o.d AS orders_demand, coalesce(o.n, 0) AS orders_rows
    FROM p FULL JOIN o ON o.mon = p.mon AND o.prod = p.prod AND o.reg = p.reg
    WHERE coalesce(p.n, 0) <> 1 OR coalesce(o.n, 0) > 1 OR coalesce(p.d, 0) <> coalesce(o.d, 0)""",
)

# --- measures ----------------------------------------------------------------------

# Order lines with the customer's (not the order's) region.
CTES["sale"] = """
    SELECT l.oid, l.odate, l.cust, l.prod, l.qty, l.rev, l.days, l.status, b.cname, b.ctype,
           a.rname, i.cat, i.pline
    FROM line l JOIN buyer b ON b.cust = l.cust JOIN area a ON a.reg = b.creg
    JOIN item i ON i.prod = l.prod"""
_USES["sale"] = ["line", "buyer", "area", "item"]

# Grouping columns: SQL expression over `sale`, result type, whether it describes customers.
_GROUPS = {
    "Region": ("rname", "s", True),
    "Customer_Type": ("ctype", "s", True),
    "Customer_ID": ("cust", "i", True),
    "Customer_Name": ("cname", "s", True),
    "Product_ID": ("prod", "s", False),
    "Product_Line": ("pline", "s", False),
    "Product_Category": ("cat", "s", False),
    "Month Start": ("CAST(date_trunc('month', odate) AS DATE)", "t", False),
    "Year": ("year(odate)", "i", False),
}
_CUSTOMER_FILTER = "rname IN ('ASIA', 'EUROPE') AND ctype IN ('BUILDING', 'MACHINERY')"
_OTHER_FILTER = "cat IN ('Category 1', 'Category 2', 'Category 3') AND year(odate) IN (1999, 2000)"


def _display(amount: str) -> str:
    def scaled(unit: int, suffix: str) -> str:
        h = f"((CAST({amount} * 100 AS BIGINT) + {unit // 2}) // {unit})"
        return f"(({h} // 100) || '.' || lpad(CAST({h} % 100 AS VARCHAR), 2, '0') || '{suffix}')"

    return f"""CASE WHEN {amount} >= 1000000000 THEN {scaled(1000000000, 'B')}
        WHEN {amount} >= 1000000 THEN {scaled(1000000, 'M')}
        WHEN {amount} >= 1000 THEN {scaled(1000, 'K')}
        ELSE CAST(CAST(round({amount}, 0) AS BIGINT) AS VARCHAR) END"""


_ORDER_MEASURES = {
    "Total Revenue": ("b.r", "d"), "Total Units Sold": ("b.u", "i"), "Ordered Units": ("b.u", "i"),
    "Total Orders": ("b.n", "i"), "Active Customers": ("b.c", "i"),
    "Average Delivery Days": (div("b.dd", "b.dc"), "d"), "Average Order Value": (div("b.r", "b.n"), "d"),
    "Revenue per Customer": (div("b.r", "b.c"), "d"), "Delayed Orders": ("b.nd", "i"),
    "Delayed Revenue": ("b.rd", "d"), "On-Time Orders": ("b.nc", "i"), "On-Time Units": ("b.uc", "i"),
    "Delayed Order Rate %": (div("b.nd", "b.n"), "d"), "On-Time Order Rate %": (div("b.nc", "b.n"), "d"),
    "On-Time Unit Rate %": (div("b.uc", "b.u"), "d"),
    "Revenue Contribution %": (div("b.r", "a.r"), "d"), "Revenue Previous Year": ("p.r", "d"),
    "Revenue YoY Growth %": (div("(CAST(b.r AS DOUBLE) - CAST(p.r AS DOUBLE))", "p.r"), "d"),
    "Top 10 Customer Revenue": ("t.r", "d"), "Top 10 Customer Revenue %": (div("t.r", "b.r"), "d"),
    "Revenue Display": (_display("b.r"), "s"), "Sum of Delivery Days": ("b.dd", "i"),
}


def order_measures(keys: list[str], measures: list[str] | None = None, filtered: bool = False) -> str:
    """Order measures per group: base sums, all-customer revenue, prior year and top customers."""
    chosen = {m: _ORDER_MEASURES[m] for m in measures or _ORDER_MEASURES}
    own = [f"{_GROUPS[k][0]} AS k{i}" for i, k in enumerate(keys)] or ["1 AS k0"]
    names = [f"k{i}" for i in range(len(own))]
    cut = ", ".join(names)
    contest = ", ".join(n for n, k in zip(names, keys or [None]) if k != "Customer_ID")
    contest = f"PARTITION BY {contest}" if contest else ""
    kept = [n for n, k in zip(names, keys) if not _GROUPS[k][2]]
    where = f"WHERE {_CUSTOMER_FILTER} AND {_OTHER_FILTER}" if filtered else ""
    other = f"WHERE {_OTHER_FILTER}" if filtered else ""

    def same(x: str, y: str, on: list[str]) -> str:
        return " AND ".join(f"{x}.{n} IS NOT DISTINCT FROM {y}.{n}" for n in on) or "true"

    body = f"""
    WITH later AS (SELECT * REPLACE (CAST(odate + INTERVAL 12 MONTH AS DATE) AS odate) FROM sale),
    b AS (SELECT {', '.join(own)}, sum(rev) r, sum(qty) u, count(DISTINCT oid) n, count(DISTINCT cust) c,
              sum(days) dd, count(days) dc,
              count(DISTINCT CASE WHEN status = 'Delayed' THEN oid END) nd,
              count(DISTINCT CASE WHEN status = 'Completed' THEN oid END) nc,
              sum(CASE WHEN status = 'Delayed' THEN rev END) rd,
              sum(CASE WHEN status = 'Completed' THEN qty END) uc
          FROM sale {where} GROUP BY {cut}),
    a AS (SELECT {', '.join([o for o in own if o.rsplit(' ', 1)[1] in kept] + ['sum(rev) AS r'])}
          FROM sale {other} {'GROUP BY ' + ', '.join(kept) if kept else ''}),
    p AS (SELECT {', '.join(own)}, sum(rev) r FROM
              (SELECT * FROM later WHERE odate <= (SELECT max(odate) FROM sale)) {where} GROUP BY {cut}),
    t AS (SELECT {cut}, sum(r) r FROM
              (SELECT *, rank() OVER ({contest} ORDER BY r DESC) AS place FROM
                  (SELECT {', '.join(own)}, cust, sum(rev) r FROM sale {where} GROUP BY {cut}, cust))
          WHERE place <= 10 GROUP BY {cut})
    SELECT {', '.join([f'coalesce(b.{n}, p.{n}) AS "{k}"' for n, k in zip(names, keys)]
                      + [f'CASE WHEN b.{names[0]} IS NULL AND {m == "Revenue Display"} THEN NULL ELSE {e} END AS "{m}"'
                         for m, (e, _) in chosen.items()])}
    FROM b {'FULL' if 'p.r' in str(chosen) else 'LEFT'} JOIN p ON {same('b', 'p', names)}
    LEFT JOIN a ON {same('a', 'b', kept)} LEFT JOIN t ON {same('t', 'b', names)}"""
    types = [f"{k}:{_GROUPS[k][1]}" for k in keys] + [f"{m}:{kind}" for m, (_, kind) in chosen.items()]
    return query("sale", ",".join(types), body)


for _name, _keys in {
    "total": [], "region": ["Region"], "month": ["Month Start"],
    "type_and_line": ["Customer_Type", "Product_Line"], "customer": ["Customer_ID"],
    "year_and_product": ["Year", "Product_ID"],
}.items():
    SQL[f"order_measures_by_{_name}"] = order_measures(_keys)
for _name, _keys in {"total": [], "type": ["Customer_Type"], "category": ["Product_Category"]}.items():
    SQL[f"filtered_order_measures_by_{_name}"] = order_measures(_keys, filtered=True)

CTES["miss"] = """
    SELECT w.*, i.cat, i.pline, a.rname, abs(fc - dem) ae, (fc - dem) * (fc - dem) se,
           abs(naive - dem) na, (naive - dem) * (naive - dem) ns, abs(seasonal - dem) sa,
           (seasonal - dem) * (seasonal - dem) ss
    FROM wide w JOIN item i ON i.prod = w.prod JOIN area a ON a.reg = w.reg"""
_USES["miss"] = ["wide", "item", "area"]


def _gain(baseline: str) -> str:
    theirs, ours = div(f"sum({baseline})", "count(*)"), div("sum(ae)", "count(*)")
    return div(f"({theirs} - {ours})", theirs)


_FORECAST_MEASURES = {
    "Total Actual Demand": ("sum(dem)", "i"), "Total Forecast Demand": ("sum(fc)", "d"),
    "Forecast Error": ("sum(fc - dem)", "d"), "Forecast Observations": ("count(*)", "i"),
    "Absolute Forecast Error": ("sum(ae)", "d"), "Absolute Forecast Error Impact": ("sum(ae)", "d"),
    "WAPE %": (div("sum(ae)", "sum(dem)"), "d"),
    "Forecast Accuracy": (f"1.0::DOUBLE - {div('sum(ae)', 'sum(dem)')}", "d"),
    "Forecast Bias %": (div("sum(fc - dem)", "sum(dem)"), "d"),
    "Mean Forecast Bias": (div("sum(fc - dem)", "count(*)"), "d"),
    "Forecast MAE": (div("sum(ae)", "count(*)"), "d"),
    "Forecast RMSE": (f"sqrt({div('sum(se)', 'count(*)')})", "d"),
    "Overforecast Observations": ("count(*) FILTER (fc > dem)", "i"),
    "Underforecast Observations": ("count(*) FILTER (fc < dem)", "i"),
    "Planning Exceptions": (f"count(*) FILTER (abs({div('(fc - dem)', 'dem')}) >= 0.05::DOUBLE)", "i"),
    "Forecast Evaluation Period": (
        "strftime(min(mon), '%b %Y') || ' - ' || strftime(max(mon), '%b %Y')", "s"),
    "Naive MAE": (div("sum(na)", "count(*)"), "d"),
    "Naive RMSE": (f"sqrt({div('sum(ns)', 'count(*)')})", "d"),
    "Naive WAPE %": (div("sum(na)", "sum(dem)"), "d"),
    "Seasonal Naive MAE": (div("sum(sa)", "count(*)"), "d"),
    "Seasonal Naive RMSE": (f"sqrt({div('sum(ss)', 'count(*)')})", "d"),
    "Seasonal Naive WAPE %": (div("sum(sa)", "sum(dem)"), "d"),
    "MAE Improvement vs Naive %": (_gain("na"), "d"), "MAE Improvement vs Seasonal %": (_gain("sa"), "d"),
}
_FORECAST_GROUPS = {
    "Region": ("rname", "s"), "Product_Category": ("cat", "s"), "Month Start": ("mon", "t"),
    "Product_ID": ("prod", "s"), "Region_ID": ("reg", "i"),
}


def forecast_measures(keys: list[str], measures: list[str] | None = None) -> str:
    chosen = {m: _FORECAST_MEASURES[m] for m in measures or _FORECAST_MEASURES}
    picked = [f'{_FORECAST_GROUPS[k][0]} AS "{k}"' for k in keys]
    picked += [f'{e} AS "{m}"' for m, (e, _) in chosen.items()]
    group = "GROUP BY " + ", ".join(_FORECAST_GROUPS[k][0] for k in keys) if keys else ""
    types = [f"{k}:{_FORECAST_GROUPS[k][1]}" for k in keys] + [f"{m}:{t}" for m, (_, t) in chosen.items()]
    return query("miss", ",".join(types), f"SELECT {', '.join(picked)} FROM miss {group}")


for _name, _keys in {
    "total": [], "region": ["Region"], "category": ["Product_Category"], "month": ["Month Start"],
    "series": ["Product_ID", "Region_ID"],
}.items():
    SQL[f"forecast_measures_by_{_name}"] = forecast_measures(_keys)

_BENCHMARK = f"""{div('sum(aerr)', 'count(*)')} AS "Benchmark MAE",
    sqrt({div('sum(serr)', 'count(*)')}) AS "Benchmark RMSE",
    {div('sum(aerr)', 'sum(dem)')} AS "Benchmark WAPE %\""""
SQL["benchmark_measures_by_model_and_region"] = query(
    "detail", "Model:s,Region:s,Benchmark MAE:d,Benchmark RMSE:d,Benchmark WAPE %:d",
    f"SELECT model AS Model, rname AS Region, {_BENCHMARK} FROM detail GROUP BY model, rname",
)
SQL["cross_fact_measures_by_month"] = query(
    "line miss", "Month Start:t,Total Revenue:d,Total Orders:i,Total Actual Demand:i,WAPE %:d",
    f"""SELECT coalesce(o.mon, f.mon) AS "Month Start", r AS "Total Revenue", n AS "Total Orders",
        a AS "Total Actual Demand", w AS "WAPE %"
        FROM (SELECT mon, sum(rev) r, count(DISTINCT oid) n FROM line GROUP BY mon) o
        FULL JOIN (SELECT mon, sum(dem) a, {div('sum(ae)', 'sum(dem)')} w FROM miss GROUP BY mon) f
        ON o.mon = f.mon""",
)
SQL["cross_fact_measures_by_type_and_region"] = query(
    "sale miss", "Customer_Type:s,Region:s,Total Revenue:d,Total Actual Demand:i,WAPE %:d",
    f"""SELECT ctype AS Customer_Type, o.rname AS Region, r AS "Total Revenue",
        a AS "Total Actual Demand", w AS "WAPE %"
        FROM (SELECT ctype, rname, sum(rev) r FROM sale GROUP BY ctype, rname) o
        LEFT JOIN (SELECT rname, sum(dem) a, {div('sum(ae)', 'sum(dem)')} w FROM miss GROUP BY rname) f
        ON o.rname = f.rname""",
)
SQL["calendar"] = query(
    "line",
    "Date:t,Year:i,Month Number:i,Month:s,Year Month:s,Quarter:s,Month Start:t",
    """SELECT d AS "Date", year(d) AS "Year", month(d) AS "Month Number", strftime(d, '%b') AS "Month",
       strftime(d, '%Y-%m') AS "Year Month", 'Q' || quarter(d) AS "Quarter",
       date_trunc('month', d) AS "Month Start"
       FROM (SELECT CAST(unnest(generate_series((SELECT min(odate) FROM line),
             (SELECT max(odate) FROM line), INTERVAL 1 DAY)) AS DATE) AS d)""",
)

# --- dashboard datasets --------------------------------------------------------------

for _name, _keys, _measures in (
    ("overview_cards", [], ["Total Orders", "Total Revenue", "Active Customers"]),
    ("revenue_by_region", ["Region"], ["Total Revenue"]),
    ("revenue_by_month", ["Month Start"], ["Total Revenue"]),
    ("revenue_by_product_line", ["Product_Line"], ["Total Revenue"]),
    ("sales_cards", [], ["Active Customers", "Top 10 Customer Revenue %", "Revenue per Customer",
                         "Average Order Value"]),
    ("revenue_by_customer_type", ["Customer_Type"], ["Total Revenue"]),
    ("month_type_revenue", ["Month Start", "Customer_Type"],
     ["Active Customers", "Total Orders", "Average Order Value", "Total Revenue"]),
    ("operations_cards", [], ["Delayed Revenue", "Total Orders", "Average Delivery Days", "On-Time Orders",
                              "Delayed Orders", "On-Time Order Rate %"]),
    ("on_time_by_region", ["Region"], ["Total Orders", "Delayed Orders", "Average Delivery Days",
                                       "Delayed Revenue", "On-Time Order Rate %"]),
    ("delays_by_category", ["Product_Category"], ["Delayed Orders", "Delayed Revenue",
     "Average Delivery Days", "On-Time Unit Rate %", "Delayed Order Rate %"]),
    ("service_by_month", ["Month Start"], ["Average Delivery Days", "Delayed Orders", "Delayed Revenue",
                                           "Total Orders", "On-Time Order Rate %"]),
):
    SQL[f"dataset_{_name}"] = order_measures(_keys, _measures)
SQL["dataset_top_customers"] = query(
    "sale", "Customer_Name:s,Total Revenue:d",
    """SELECT cname AS Customer_Name, sum(rev) AS "Total Revenue" FROM sale GROUP BY cname
       QUALIFY rank() OVER (ORDER BY sum(rev) DESC) <= 10""",
)
SQL["dataset_order_details"] = query(
    "sale",
    "Order_ID:i,Order_Date:t,Customer_Name:s,Product_Category:s,Region:s,Ordered Units:i,"
    "Total Revenue:d,Sum of Delivery Days:i",
    """SELECT oid AS Order_ID, odate AS Order_Date, cname AS Customer_Name, cat AS Product_Category,
       rname AS Region, sum(qty) AS "Ordered Units", sum(rev) AS "Total Revenue",
       sum(days) AS "Sum of Delivery Days" FROM sale GROUP BY oid, odate, cname, cat, rname""",
)
for _name, _keys, _measures in (
    ("forecast_cards", [], ["WAPE %", "Forecast MAE", "Forecast RMSE", "Total Actual Demand",
                            "Total Forecast Demand"]),
    ("actual_vs_forecast", ["Month Start"], ["Total Actual Demand", "Total Forecast Demand"]),
    ("bias_by_month", ["Month Start"], ["Forecast Bias %"]),
):
    SQL[f"dataset_{_name}"] = forecast_measures(_keys, _measures)
SQL["dataset_model_benchmark"] = query(
    "detail", "Model:s,Benchmark MAE:d,Benchmark RMSE:d,Benchmark WAPE %:d",
    f"SELECT model AS Model, {_BENCHMARK} FROM detail GROUP BY model",
)
_SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
_AREAS = ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]
SQL["dataset_region_type_matrix"] = query(
    "sale", "Region:s," + ",".join(f"{s}:s" for s in _SEGMENTS),
    f"""SELECT rname AS Region, {', '.join(f"max(txt) FILTER (ctype = '{s}') AS {s}" for s in _SEGMENTS)}
        FROM (SELECT rname, ctype, {_display('sum(rev)')} AS txt FROM sale GROUP BY rname, ctype)
        GROUP BY rname""",
)
SQL["dataset_category_region_wape"] = query(
    "miss", "Product_Category:s," + ",".join(f"{a}:d" for a in _AREAS),
    f"""SELECT cat AS Product_Category, {', '.join(f"max(w) FILTER (rname = '{a}') AS \"{a}\"" for a in _AREAS)}
        FROM (SELECT cat, rname, {div('sum(ae)', 'sum(dem)')} w FROM miss GROUP BY cat, rname)
        GROUP BY cat""",
)
for _name, _column, _uses, _sql in (
    ("customer_type", "Customer_Type:s", "buyer", "SELECT DISTINCT ctype AS Customer_Type FROM buyer"),
    ("region", "Region:s", "area", "SELECT DISTINCT rname AS Region FROM area"),
    ("product_category", "Product_Category:s", "item", "SELECT DISTINCT cat AS Product_Category FROM item"),
    ("product_line", "Product_Line:s", "item", "SELECT DISTINCT pline AS Product_Line FROM item"),
    ("year_month", "Year Month:s", "spine", "SELECT strftime(mon, '%Y-%m') AS \"Year Month\" FROM spine"),
    ("forecast_month", "forecast_month:t", "wide", "SELECT DISTINCT mon AS forecast_month FROM wide"),
):
    SQL[f"slicer_{_name}"] = query(_uses, _column, _sql)

# --- files ---------------------------------------------------------------------------

_ORDER_ROWS = """SELECT oid AS Order_ID, odate AS Order_Date, cust AS Customer_ID, prod AS Product_ID,
    reg AS Region_ID, qty AS Quantity, price AS Unit_Price, rev AS Revenue, days AS Delivery_Days,
    status AS Order_Status FROM line"""
_ORDER_TYPES = (
    "Order_ID:s,Order_Date:t,Customer_ID:s,Product_ID:s,Region_ID:s,Quantity:i,Unit_Price:d,Revenue:d,"
    "Delivery_Days:i,Order_Status:s"
)
SQL["csv_orders"] = query("line", _ORDER_TYPES, _ORDER_ROWS)
SQL["csv_orders_cleaned"] = SQL["csv_orders"]
SQL["csv_forecast"] = SQL["forecast_results"].replace('CAST("Region_ID" AS BIGINT)', 'CAST("Region_ID" AS VARCHAR)')
SQL["registered_tables"] = query(
    "line buyer", "Customer_Type:s,Order_Status:s,lines:i,units:i",
    """SELECT ctype AS Customer_Type, status AS Order_Status, count(*) AS lines, sum(qty) AS units
       FROM line JOIN buyer USING (cust) GROUP BY ctype, status""",
)
SQL["exported_reports"] = query(
    "line buyer item area detail series", "report:s,rows:i",
    """SELECT unnest(['annual_sales_trend', 'annual_fulfillment_kpi']) AS report, count(DISTINCT yr) AS rows
       FROM line
       UNION ALL SELECT unnest(['regional_sales_contribution', 'regional_fulfillment_performance']),
           count(DISTINCT reg) FROM line
       UNION ALL SELECT unnest(['product_revenue_contribution', 'product_fulfillment_bottlenecks']),
           count(DISTINCT prod) FROM line
       UNION ALL SELECT 'customer_value_ranking', count(DISTINCT cust) FROM line
       UNION ALL SELECT 'customer_type_performance', count(DISTINCT ctype) FROM line JOIN buyer USING (cust)
       UNION ALL SELECT 'customer_growth_and_risk', count(*) FROM buyer
       UNION ALL SELECT 'regional_market_opportunity',
           (SELECT count(*) FROM area) * count(DISTINCT ctype) FROM buyer
       UNION ALL SELECT 'forecast_detail', count(*) FROM detail
       UNION ALL SELECT 'planning_exceptions', count(*) FROM detail WHERE model = 'Moving Average 6'
       UNION ALL SELECT 'model_benchmark', count(DISTINCT model) FROM detail
       UNION ALL SELECT 'annual_forecast_accuracy', count(DISTINCT (year(mon), model)) FROM detail
       UNION ALL SELECT 'product_forecast_accuracy', count(DISTINCT (prod, model)) FROM detail
       UNION ALL SELECT 'regional_forecast_accuracy', count(DISTINCT (reg, model)) FROM detail
       UNION ALL SELECT 'product_market_forecast_accuracy', count(DISTINCT (prod, reg, model)) FROM detail
       UNION ALL SELECT 'monthly_forecast_trend', count(DISTINCT (mon, model)) FROM detail
       UNION ALL SELECT 'series_benchmark_comparison', count(*) FROM series
       UNION ALL SELECT 'repeated_forecast_bias', count(*) FROM series WHERE n = 6 AND greatest(o, u) >= 5
       UNION ALL SELECT 'monthly_demand_fulfillment_reconciliation', count(DISTINCT mon) FROM detail""",
)
SQL["one_to_one_join"] = query(
    "wide test",
    "Month:t,Product_ID:s,Region_ID:i,Demand_Lag_1:i,Demand_Lag_12:i,Actual_Demand:i,Naive_Forecast:d,"
    "Seasonal_Naive_Forecast:d,Forecast_Demand:d,Forecast_Error:d,Absolute_Error:d,Squared_Error:d",
    """SELECT t.mon AS Month, t.prod AS Product_ID, t.reg AS Region_ID, lag1 AS Demand_Lag_1,
       lag12 AS Demand_Lag_12, t.dem AS Actual_Demand, naive AS Naive_Forecast,
       seasonal AS Seasonal_Naive_Forecast, fc AS Forecast_Demand, fc - t.dem AS Forecast_Error,
       abs(fc - t.dem) AS Absolute_Error, (fc - t.dem) * (fc - t.dem) AS Squared_Error
       FROM test t JOIN wide w ON w.mon = t.mon AND w.prod = t.prod AND w.reg = t.reg""",
)
