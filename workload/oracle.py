"""The registered queries in SQL, written independently of the library.

Named subqueries build on each other in the order given; each query takes those it needs.
"""

from __future__ import annotations

import re

AS_OF = "TIMESTAMP '2001-07-01 00:00:00'"
EPOCH = "TIMESTAMP '1995-01-01 00:00:00'"


def money(cents: str) -> str:
    return f"CAST(CAST({cents} AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(12,2))"


def amount(quantity: str, price: str) -> str:
    return f"CAST({quantity} * {price} AS DECIMAL(18,4))"


def ratio(numerator: str, denominator: str) -> str:
    n, d = f"CAST({numerator} AS DOUBLE)", f"CAST({denominator} AS DOUBLE)"
    return f"CASE WHEN {d} <> 0 THEN {n} / {d} END"


def total(expression: str, precision: int, scale: int) -> str:
    return f"CAST(sum({expression}) AS DECIMAL({precision},{scale}))"


def total_or_zero(expression: str, precision: int, scale: int) -> str:
    return f"CAST(coalesce({expression}, 0) AS DECIMAL({precision},{scale}))"


def dense(metric: str) -> str:
    return f"CAST(dense_rank() OVER (ORDER BY {metric} DESC NULLS LAST) AS INTEGER)"


def date_key(value: str) -> str:
    return f"CAST(strftime({value}, '%Y%m%d') AS INTEGER)"


CENTS = "CAST(round(l_extendedprice * 100) AS BIGINT)"
PERCENT = "CAST(round(l_discount * 100) AS BIGINT)"

ITEM_COLUMNS = f"""
    l_orderkey * 10 + l_linenumber AS invoice_item_id,
    l_orderkey AS invoice_id,
    l_linenumber AS item_sequence,
    l_partkey AS product_id,
    CAST(l_quantity AS DECIMAL(12,2)) AS quantity,
    {money(f"{CENTS} // CAST(l_quantity AS BIGINT)")} AS unit_price,
    {money(f"{CENTS} * {PERCENT} // 100")} AS discount_value,
    l_shipdate AS updated_at,
    l_returnflag AS return_flag,
    l_linestatus AS line_status"""

HEADER_COLUMNS = f"""
    o_orderkey AS invoice_id,
    concat('N', o_orderkey) AS invoice_number,
    '1' AS invoice_series,
    o_custkey AS customer_id,
    s.salesperson_id,
    CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
    o_orderdate AS issue_date,
    CASE WHEN o_orderstatus = 'P' THEN 'cancelled' ELSE 'issued' END AS invoice_status,
    {money("CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey % 5000 ELSE 0 END")} AS discount_value"""

SALES_SUMS = f"""
    {total("gross_revenue", 28, 4)} AS gross_revenue,
    {total("net_revenue", 28, 6)} AS net_revenue,
    {total("margin_amount", 28, 6)} AS margin_amount,
    {total("quantity", 22, 2)} AS units_sold,
    count(DISTINCT invoice_id) AS invoice_count"""

SUBQUERIES = {
    # --- entities ---
    "regions": """SELECT r_regionkey AS region_id, concat('R', r_regionkey) AS region_code, r_name AS region_name,
        substring(r_name, 1, 2) AS state, 'World' AS country FROM region""",
    "payment_methods": """SELECT DISTINCT CAST(substring(o_orderpriority, 1, 1) AS INTEGER) AS payment_method_id,
        concat('PM', substring(o_orderpriority, 1, 1)) AS payment_method_code,
        substring(o_orderpriority, 3) AS payment_method_name,
        CASE WHEN substring(o_orderpriority, 1, 1) <= '2' THEN 'prepaid' ELSE 'credit' END AS payment_type
        FROM orders""",
    "customers": """SELECT c_custkey AS customer_id, concat('C', c_custkey) AS customer_code, c_name AS customer_name,
        concat('DOC', c_custkey) AS document, concat('c', c_custkey, '@example.com') AS email,
        concat('555-', c_custkey) AS phone, c_mktsegment AS customer_segment, n_regionkey AS region_id,
        c_acctbal >= 0 AS is_active
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "products": f"""SELECT p_partkey AS product_id, concat('P', p_partkey) AS product_code, p_name AS product_name,
        p_type AS category_name, 'UN' AS unit_of_measure,
        {money("CAST(round(p_retailprice * 100) AS BIGINT) * 60 // 100")} AS unit_cost,
        {money("CAST(round(p_retailprice * 100) AS BIGINT)")} AS unit_price,
        p_size <= 45 AS is_active FROM part""",
    "salespersons": """SELECT s_suppkey AS salesperson_id, concat('S', s_suppkey) AS salesperson_code,
        s_name AS salesperson_name, n_regionkey AS region_id,
        DATE '1990-01-01' + CAST(s_suppkey % 1000 AS INTEGER) AS hire_date, s_acctbal >= 0 AS is_active
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "sellers": "SELECT l_orderkey, min(l_suppkey) AS salesperson_id FROM lineitem GROUP BY l_orderkey",
    "header": f"""SELECT {HEADER_COLUMNS} FROM orders JOIN sellers s ON s.l_orderkey = o_orderkey
        WHERE o_orderdate <= {AS_OF}""",
    "invoices": f"SELECT {HEADER_COLUMNS} FROM orders LEFT JOIN sellers s ON s.l_orderkey = o_orderkey",
    "items": f"""SELECT {ITEM_COLUMNS} FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey, l_suppkey, l_extendedprice) AS nth FROM lineitem) WHERE nth = 1""",
    "returns": """SELECT invoice_item_id * 10 + part AS return_id, concat('D', invoice_item_id * 10 + part) AS return_number,
        invoice_id, invoice_item_id, product_id, customer_id, issue_date + to_days(item_sequence + part) AS return_date,
        CAST(greatest(1, CAST(quantity AS BIGINT) // 8) AS DECIMAL(12,2)) AS quantity, unit_price AS unit_value,
        CASE WHEN line_status = 'F' THEN 'defect' ELSE 'regret' END AS return_reason
        FROM (SELECT i.*, h.customer_id, h.issue_date,
                CAST(unnest(generate_series(1, 1 + i.item_sequence % 2)) AS INTEGER) AS part
              FROM items i JOIN header h ON h.invoice_id = i.invoice_id
              WHERE i.return_flag = 'R' AND h.invoice_status = 'issued')""",
    "targets": """SELECT salesperson_id * 100 + (m - 24007) AS target_id, salesperson_id, region_id,
        CAST((m - 1) // 12 AS INTEGER) AS target_year, CAST((m - 1) % 12 + 1 AS INTEGER) AS target_month,
        CAST(15000 + (salesperson_id * 37 + ((m - 1) % 12 + 1) * 101) % 10000 AS DECIMAL(14,2)) AS target_value
        FROM (SELECT *, unnest(generate_series(24007, 24018)) AS m FROM salespersons)""",
    # --- source tables ---
    "b_regions": f"""SELECT region_id AS RegionID, CASE WHEN region_id <> 4 THEN region_code END AS RegionCode,
        concat(region_name, CASE WHEN version = 1 THEN ' v1' ELSE '' END) AS RegionName, state AS State,
        country AS Country, {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN region_id % 2 = 0 THEN [0, 1] ELSE [0] END) AS version FROM regions)""",
    "b_payment_methods": f"""SELECT payment_method_id AS PaymentMethodID, payment_method_code AS PaymentMethodCode,
        concat(payment_method_name, CASE WHEN version = 1 THEN ' v1' ELSE '' END) AS PaymentMethodName,
        payment_type AS PaymentType, {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN payment_method_id % 3 = 0 THEN [0, 1] ELSE [0] END) AS version
              FROM payment_methods)""",
    "b_customers": f"""SELECT customer_id AS CustomerID, customer_code AS CustomerCode,
        CASE WHEN customer_id % 37 <> 0 THEN concat(customer_name, CASE WHEN version = 1 THEN ' v1' ELSE '' END) END
            AS CustomerName,
        document AS Document, email AS Email, phone AS Phone, customer_segment AS CustomerSegment,
        CASE WHEN customer_id % 31 = 0 THEN 99 WHEN customer_id % 29 <> 0 THEN region_id END AS RegionID,
        is_active AS IsActive, {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN customer_id % 7 = 0 THEN [0, 1] ELSE [0] END) AS version
              FROM customers)""",
    "b_products": f"""SELECT product_id AS ProductID, CASE WHEN product_id % 41 <> 0 THEN product_code END AS ProductCode,
        concat(product_name, CASE WHEN version = 1 THEN ' v1' ELSE '' END) AS ProductName,
        category_name AS CategoryName, unit_of_measure AS UnitOfMeasure,
        CAST(CASE WHEN product_id % 47 = 0 THEN -unit_cost ELSE unit_cost END AS DECIMAL(12,2)) AS UnitCost,
        CAST(CASE WHEN product_id % 43 = 0 THEN 0 ELSE unit_price END AS DECIMAL(12,2)) AS UnitPrice,
        is_active AS IsActive, {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN product_id % 11 = 0 THEN [0, 1] ELSE [0] END) AS version
              FROM products)""",
    "b_salespersons": f"""SELECT salesperson_id AS SalespersonID, salesperson_code AS SalespersonCode,
        CASE WHEN salesperson_id % 19 <> 3
            THEN concat(salesperson_name, CASE WHEN version = 1 THEN ' v1' ELSE '' END) END AS SalespersonName,
        CASE WHEN salesperson_id % 9 = 4 THEN 99 ELSE region_id END AS RegionID, hire_date AS HireDate,
        is_active AS IsActive, {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN salesperson_id % 5 = 0 THEN [0, 1] ELSE [0] END) AS version
              FROM salespersons)""",
    "b_header": f"""SELECT invoice_id AS InvoiceID, CASE WHEN invoice_id % 113 <> 0 THEN invoice_number END AS InvoiceNumber,
        invoice_series AS InvoiceSeries, CASE WHEN invoice_id % 109 = 0 THEN -customer_id - 1
            WHEN invoice_id % 127 <> 0 THEN customer_id END AS CustomerID,
        salesperson_id AS SalespersonID, payment_method_id AS PaymentMethodID,
        CASE WHEN invoice_id % 131 <> 0 THEN issue_date END AS IssueDate,
        CASE WHEN version = 1 THEN 'cancelled' ELSE invoice_status END AS InvoiceStatus,
        discount_value AS DiscountValue, {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN invoice_id % 13 = 0 THEN [0, 1] ELSE [0] END) AS version
              FROM (SELECT {HEADER_COLUMNS} FROM orders LEFT JOIN sellers s ON s.l_orderkey = o_orderkey))""",
    "b_items": f"""SELECT invoice_item_id AS InvoiceItemID,
        CASE WHEN invoice_id % 101 = 0 THEN -invoice_id - 1 ELSE invoice_id END AS InvoiceID,
        item_sequence AS ItemSequence, CASE WHEN invoice_id % 79 = 0 THEN -product_id - 1
            WHEN invoice_id % 83 <> 0 THEN product_id END AS ProductID,
        CAST(CASE WHEN invoice_id % 97 = 0 THEN -quantity WHEN invoice_id % 103 = 0 THEN 0 ELSE quantity END
            AS DECIMAL(12,2)) AS Quantity,
        CAST(CASE WHEN invoice_id % 89 = 0 THEN -unit_price ELSE unit_price END AS DECIMAL(12,2)) AS UnitPrice,
        discount_value AS DiscountValue, updated_at AS CreatedAt, updated_at AS UpdatedAt
        FROM (SELECT {ITEM_COLUMNS} FROM lineitem)""",
    "b_returns": f"""SELECT invoice_item_id * 10 + 1 AS ReturnID, concat('D', invoice_item_id * 10 + 1) AS ReturnNumber,
        invoice_id AS InvoiceID, CASE WHEN invoice_id % 61 = 0 THEN -invoice_item_id - 1 ELSE invoice_item_id END
            AS InvoiceItemID,
        CASE WHEN invoice_id % 67 = 0 THEN -product_id - 1 ELSE product_id END AS ProductID,
        CASE WHEN invoice_id % 71 = 0 THEN -o_custkey - 1 ELSE o_custkey END AS CustomerID,
        o_orderdate + to_days(item_sequence) AS ReturnDate,
        CAST(CASE WHEN invoice_id % 59 = 0 THEN 0 ELSE quantity END AS DECIMAL(12,2)) AS Quantity,
        unit_price AS UnitValue, CASE WHEN line_status = 'F' THEN 'defect' ELSE 'regret' END AS ReturnReason,
        updated_at AS CreatedAt, updated_at AS UpdatedAt
        FROM (SELECT {ITEM_COLUMNS} FROM lineitem WHERE l_returnflag = 'R') LEFT JOIN orders ON o_orderkey = invoice_id""",
    "b_targets": f"""SELECT target_id AS TargetID,
        CASE WHEN target_id % 17 = 3 THEN -1 ELSE salesperson_id END AS SalespersonID, region_id AS RegionID,
        target_year AS TargetYear, target_month AS TargetMonth,
        CAST(CASE WHEN target_id % 13 = 5 THEN 0 ELSE target_value + version END AS DECIMAL(14,2)) AS TargetValue,
        {EPOCH} AS CreatedAt, {EPOCH} + to_days(version) AS UpdatedAt
        FROM (SELECT *, unnest(CASE WHEN target_id % 10 = 0 THEN [0, 1] ELSE [0] END) AS version FROM targets)""",
    # --- gold ---
    "dim_region": "SELECT row_number() OVER (ORDER BY region_id) AS region_key, * FROM regions",
    "dim_payment_method": """SELECT row_number() OVER (ORDER BY payment_method_id) AS payment_method_key, *
        FROM payment_methods""",
    "dim_customer": """SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, c.*, r.region_name
        FROM customers c LEFT JOIN regions r USING (region_id)""",
    "dim_product": "SELECT row_number() OVER (ORDER BY product_id) AS product_key, * FROM products",
    "dim_salesperson": """SELECT row_number() OVER (ORDER BY salesperson_id) AS salesperson_key, s.*, r.region_name
        FROM salespersons s LEFT JOIN regions r USING (region_id)""",
    "bounds": """SELECT CAST(date_trunc('month', min(d)) AS DATE) AS first_day, last_day(max(d)) AS last_day FROM (
        SELECT CAST(issue_date AS DATE) AS d FROM header UNION ALL SELECT CAST(return_date AS DATE) FROM returns
        UNION ALL SELECT make_date(target_year, target_month, 1) FROM targets)""",
    "dim_date": f"""SELECT {date_key("full_date")} AS date_key, full_date, CAST(year(full_date) AS INTEGER) AS year,
        CAST(quarter(full_date) AS INTEGER) AS quarter, CAST(month(full_date) AS INTEGER) AS month,
        strftime(full_date, '%B') AS month_name, CAST(day(full_date) AS INTEGER) AS day,
        CAST(dayofweek(full_date) + 1 AS INTEGER) AS day_of_week, strftime(full_date, '%A') AS day_name,
        CAST(weekofyear(full_date) AS INTEGER) AS week_of_year, dayofweek(full_date) IN (0, 6) AS is_weekend,
        strftime(full_date, '%Y-%m') AS year_month
        FROM (SELECT CAST(unnest(generate_series(first_day, last_day, INTERVAL 1 DAY)) AS DATE) AS full_date
              FROM bounds)""",
    "invoice_totals": f"""SELECT invoice_id, {total(amount("quantity", "unit_price"), 28, 4)} AS invoice_gross
        FROM items GROUP BY invoice_id""",
    "allocated": f"""SELECT i.*, h.customer_id, h.salesperson_id, h.payment_method_id, h.invoice_number,
        h.invoice_series, h.issue_date, h.invoice_status, {amount("i.quantity", "i.unit_price")} AS gross_revenue,
        CAST(coalesce(CASE WHEN t.invoice_gross > 0 THEN round(CAST(h.discount_value AS DOUBLE)
            * (CAST({amount("i.quantity", "i.unit_price")} AS DOUBLE) / CAST(t.invoice_gross AS DOUBLE)), 6) END, 0)
            AS DECIMAL(18,6)) AS header_discount_allocated
        FROM items i LEFT JOIN invoice_totals t ON t.invoice_id = i.invoice_id
        LEFT JOIN header h ON h.invoice_id = i.invoice_id""",
    "item_returns": f"""SELECT invoice_item_id, {total(amount("quantity", "unit_value"), 28, 4)} AS returned_amount,
        {total("quantity", 22, 2)} AS returned_quantity FROM returns GROUP BY invoice_item_id""",
    "sold": f"""SELECT a.invoice_item_id, a.invoice_id, a.invoice_number, a.invoice_series, a.item_sequence,
        c.customer_key, p.product_key, s.salesperson_key, m.payment_method_key, g.region_key,
        {date_key("a.issue_date")} AS date_key, a.invoice_status, a.quantity, a.unit_price,
        a.discount_value AS item_discount, a.header_discount_allocated,
        CAST(a.discount_value + a.header_discount_allocated AS DECIMAL(18,6)) AS discount_amount,
        CAST(coalesce(r.returned_amount, 0) AS DECIMAL(18,4)) AS returned_amount,
        CAST(coalesce(r.returned_quantity, 0) AS DECIMAL(18,2)) AS returned_quantity,
        a.gross_revenue, {amount("a.quantity", "p.unit_cost")} AS total_cost
        FROM allocated a LEFT JOIN item_returns r ON r.invoice_item_id = a.invoice_item_id
        LEFT JOIN dim_product p ON p.product_id = a.product_id
        LEFT JOIN dim_customer c ON c.customer_id = a.customer_id
        LEFT JOIN dim_salesperson s ON s.salesperson_id = a.salesperson_id
        LEFT JOIN dim_payment_method m ON m.payment_method_id = a.payment_method_id
        LEFT JOIN dim_region g ON g.region_id = s.region_id""",
    "netted": """SELECT *, CAST(gross_revenue - discount_amount - returned_amount AS DECIMAL(18,6)) AS net_revenue
        FROM sold""",
    "with_margin": "SELECT *, CAST(net_revenue - total_cost AS DECIMAL(18,6)) AS margin_amount FROM netted",
    "lines": f"SELECT *, {ratio('margin_amount', 'net_revenue')} AS margin_pct FROM with_margin",
    "fact_returns": f"""SELECT row_number() OVER (ORDER BY return_id) AS return_key, return_id, return_number,
        r.invoice_id, invoice_item_id, customer_key, product_key, salesperson_key, payment_method_key, region_key,
        {date_key("return_date")} AS date_key, quantity, unit_value,
        {amount("quantity", "unit_value")} AS returned_amount, return_reason
        FROM returns r LEFT JOIN header h ON h.invoice_id = r.invoice_id
        LEFT JOIN dim_product p ON p.product_id = r.product_id
        LEFT JOIN dim_customer c ON c.customer_id = r.customer_id
        LEFT JOIN dim_salesperson s ON s.salesperson_id = h.salesperson_id
        LEFT JOIN dim_payment_method m ON m.payment_method_id = h.payment_method_id
        LEFT JOIN dim_region g ON g.region_id = s.region_id""",
    "fact_sales_targets": """SELECT row_number() OVER (ORDER BY target_id) AS target_key, target_id, salesperson_key,
        region_key, target_year, target_month, target_year * 10000 + target_month * 100 + 1 AS date_key, target_value
        FROM targets t LEFT JOIN dim_salesperson s ON s.salesperson_id = t.salesperson_id
        LEFT JOIN dim_region g ON g.region_id = t.region_id""",
    # --- diamond ---
    "base": "SELECT * FROM lines WHERE invoice_status = 'issued'",
    "monthly_sums": f"""SELECT year_month, year, month, month_name, region_key, {SALES_SUMS},
        {total("discount_amount", 28, 6)} AS discount_amount, {total("returned_amount", 28, 4)} AS returned_amount
        FROM base LEFT JOIN dim_date USING (date_key) GROUP BY year_month, year, month, month_name, region_key""",
    "monthly_sales": f"""SELECT m.*, region_code, region_name, {ratio("margin_amount", "net_revenue")} AS margin_pct,
        {ratio("net_revenue", "invoice_count")} AS avg_ticket
        FROM monthly_sums m LEFT JOIN dim_region r ON r.region_key = m.region_key""",
    **{
        f"{entity}_totals": f"""SELECT s.*, {total_or_zero("r.returned_amount", 28, 4)} AS returned_amount,
        {total_or_zero("r.returned_quantity", 22, 2)} AS returned_quantity
        FROM (SELECT {entity}_key, {SALES_SUMS} FROM base GROUP BY {entity}_key) s
        LEFT JOIN (SELECT {entity}_key, sum(returned_amount) AS returned_amount, sum(quantity) AS returned_quantity
                   FROM fact_returns GROUP BY {entity}_key) r ON r.{entity}_key = s.{entity}_key"""
        for entity in ("product", "customer", "salesperson")
    },
    "product_ranking": f"""SELECT t.*, d.product_id, product_code, product_name, category_name,
        {ratio("margin_amount", "net_revenue")} AS margin_pct, {ratio("returned_amount", "gross_revenue")} AS return_rate,
        {dense("net_revenue")} AS rank_net_revenue, {dense("margin_amount")} AS rank_margin_amount,
        {dense("units_sold")} AS rank_units_sold, {dense("returned_amount")} AS rank_returned_amount
        FROM product_totals t LEFT JOIN dim_product d ON d.product_key = t.product_key""",
    "customer_ranking": f"""SELECT t.*, customer_id, customer_code, customer_name, customer_segment, region_name,
        {ratio("net_revenue", "invoice_count")} AS avg_ticket, {ratio("returned_amount", "gross_revenue")} AS return_rate,
        {dense("net_revenue")} AS rank_net_revenue, {dense("returned_amount")} AS rank_returned_amount
        FROM customer_totals t LEFT JOIN dim_customer d ON d.customer_key = t.customer_key""",
    "salesperson_performance": f"""SELECT t.*, salesperson_id, salesperson_code, salesperson_name, region_name,
        {ratio("margin_amount", "net_revenue")} AS margin_pct, {ratio("net_revenue", "invoice_count")} AS avg_ticket,
        {ratio("returned_amount", "gross_revenue")} AS return_rate,
        {dense("net_revenue")} AS rank_net_revenue, {dense("returned_amount")} AS rank_returned_amount
        FROM salesperson_totals t LEFT JOIN dim_salesperson d ON d.salesperson_key = t.salesperson_key""",
    "actuals": f"""SELECT salesperson_key, region_key, year AS target_year, month AS target_month,
        {total("net_revenue", 28, 6)} AS actual_net_revenue, {total("margin_amount", 28, 6)} AS actual_margin
        FROM base LEFT JOIN dim_date USING (date_key) GROUP BY salesperson_key, region_key, year, month""",
    "target_vs_actual": f"""SELECT salesperson_key, salesperson_code, salesperson_name, region_key, region_code,
        j.region_name, target_year, target_month, target_value, actual_net_revenue, actual_margin,
        {ratio("actual_net_revenue", "target_value")} AS target_attainment, target_value IS NOT NULL AS has_target
        FROM (SELECT k.*, salesperson_code, salesperson_name, g.region_code, g.region_name
              FROM (SELECT salesperson_key, region_key, target_year, target_month, target_value,
                    {total_or_zero("actual_net_revenue", 28, 6)} AS actual_net_revenue,
                    {total_or_zero("actual_margin", 28, 6)} AS actual_margin
                    FROM fact_sales_targets FULL JOIN actuals
                    USING (salesperson_key, region_key, target_year, target_month)) k
              LEFT JOIN dim_salesperson s ON s.salesperson_key = k.salesperson_key
              LEFT JOIN dim_region g ON g.region_key = k.region_key) j""",
    "month_targets": f"""SELECT printf('%04d-%02d', target_year, target_month) AS year_month,
        {total("target_value", 24, 2)} AS target_total FROM target_vs_actual GROUP BY 1""",
    "commercial_kpis": f"""SELECT s.*, {ratio("margin_amount", "net_revenue")} AS margin_pct,
        {ratio("net_revenue", "invoice_count")} AS avg_ticket,
        {total_or_zero("r.returned_amount", 38, 4)} AS returned_amount,
        {ratio("coalesce(r.returned_amount, 0)", "gross_revenue")} AS return_rate,
        {total_or_zero("t.target_total", 24, 2)} AS target_total,
        {ratio("net_revenue", "t.target_total")} AS target_attainment
        FROM (SELECT year_month, year, month, month_name, {total("gross_revenue", 38, 4)} AS gross_revenue,
                {total("net_revenue", 38, 6)} AS net_revenue, {total("margin_amount", 38, 6)} AS margin_amount,
                {total("quantity", 32, 2)} AS units_sold, count(DISTINCT invoice_id) AS invoice_count,
                count(DISTINCT customer_key) AS active_customers,
                count(DISTINCT salesperson_key) AS active_salespersons
              FROM base LEFT JOIN dim_date USING (date_key) GROUP BY year_month, year, month, month_name) s
        LEFT JOIN (SELECT year_month, sum(returned_amount) AS returned_amount
                   FROM fact_returns LEFT JOIN dim_date USING (date_key) GROUP BY year_month) r
            ON r.year_month = s.year_month
        LEFT JOIN month_targets t ON t.year_month = s.year_month""",
    "kpi_mom": f"""SELECT k.year_month, k.year, k.month, k.net_revenue, p.net_revenue AS previous_net_revenue,
        {ratio("k.net_revenue - p.net_revenue", "p.net_revenue")} AS net_revenue_growth
        FROM commercial_kpis k LEFT JOIN commercial_kpis p ON k.year * 12 + k.month = p.year * 12 + p.month + 1""",
    "attained": f"""SELECT target_year, target_month, {total("actual_net_revenue", 38, 6)} AS actual_net_revenue,
        {total("target_value", 24, 2)} AS target_value,
        {ratio("sum(actual_net_revenue)", "sum(target_value)")} AS target_attainment
        FROM target_vs_actual GROUP BY target_year, target_month""",
}


def with_subqueries(select: str) -> str:
    """Put the subqueries that a statement needs, directly or not, in front of it."""
    needed: set[str] = set()
    todo = [select]
    while todo:
        words = set(re.findall(r"\w+", todo.pop()))
        for name in SUBQUERIES:
            if name in words and name not in needed:
                needed.add(name)
                todo.append(SUBQUERIES[name])
    if not needed:
        return select
    parts = ",\n".join(f"{name} AS ({text})" for name, text in SUBQUERIES.items() if name in needed)
    return f"WITH {parts}\n{select}"


# --- quality and silver ---


def not_found(column: str, table: str, key: str) -> str:
    return f"NOT coalesce({column} IN (SELECT {key} FROM {table} WHERE {key} IS NOT NULL), false)"


def reasons(checks: list[tuple[str, str]]) -> str:
    cases = ", ".join(f"CASE WHEN {condition} THEN '{reason}' END" for condition, reason in checks)
    return f"concat_ws(', ', {cases})"


def null_checks(*columns: str) -> list[tuple[str, str]]:
    return [(f"{c} IS NULL", f"{c}_is_null") for c in columns]


REGION = (not_found("RegionID", "b_regions", "RegionID"), "RegionID_not_found")
CUSTOMER = (not_found("CustomerID", "b_customers", "CustomerID"), "CustomerID_not_found")
SELLER = (not_found("SalespersonID", "b_salespersons", "SalespersonID"), "SalespersonID_not_found")
INVOICE = (not_found("InvoiceID", "b_header", "InvoiceID"), "InvoiceID_not_found")
PRODUCT = (not_found("ProductID", "b_products", "ProductID"), "ProductID_not_found")
UNITS = ("Quantity <= 0", "Quantity_zero_or_negative")
NEGATIVE_PRICE = ("UnitPrice < 0", "UnitPrice_negative")
FUTURE = (f"IssueDate > {AS_OF}", "IssueDate_in_future")
NO_ITEMS = (not_found("InvoiceID", "b_items", "InvoiceID"), "no_related_records_via_InvoiceID")

ITEM_CHECKS = [
    *null_checks("InvoiceItemID", "InvoiceID", "ProductID"),
    UNITS,
    NEGATIVE_PRICE,
    INVOICE,
    PRODUCT,
]

# table: (source, key, columns in order with their standard names, checks)
SILVER = {
    "regions": (
        "b_regions",
        "RegionID",
        "RegionID region_id, RegionCode region_code, RegionName region_name, State state, Country country, "
        "CreatedAt created_at",
        null_checks("RegionID", "RegionCode"),
    ),
    "payment_methods": (
        "b_payment_methods",
        "PaymentMethodID",
        "PaymentMethodID payment_method_id, PaymentMethodCode payment_method_code, "
        "PaymentMethodName payment_method_name, PaymentType payment_type, CreatedAt created_at",
        null_checks("PaymentMethodID", "PaymentMethodCode"),
    ),
    "customers": (
        "b_customers",
        "CustomerID",
        "CustomerID customer_id, CustomerCode customer_code, CustomerName customer_name, Document document, "
        "Email email, Phone phone, CustomerSegment customer_segment, RegionID region_id, IsActive is_active, "
        "CreatedAt created_at",
        [*null_checks("CustomerID", "CustomerCode", "CustomerName"), REGION],
    ),
    "products": (
        "b_products",
        "ProductID",
        "ProductID product_id, ProductCode product_code, ProductName product_name, CategoryName category_name, "
        "UnitOfMeasure unit_of_measure, UnitCost unit_cost, UnitPrice unit_price, IsActive is_active, "
        "CreatedAt created_at",
        [
            *null_checks("ProductID", "ProductCode", "ProductName"),
            ("UnitPrice <= 0", "UnitPrice_zero_or_negative"),
            ("UnitCost < 0", "UnitCost_negative"),
        ],
    ),
    "salespersons": (
        "b_salespersons",
        "SalespersonID",
        "SalespersonID salesperson_id, SalespersonCode salesperson_code, SalespersonName salesperson_name, "
        "RegionID region_id, HireDate hire_date, IsActive is_active, CreatedAt created_at",
        [*null_checks("SalespersonID", "SalespersonCode", "SalespersonName"), REGION],
    ),
    "sales_invoice_header": (
        "b_header",
        "InvoiceID",
        "InvoiceID invoice_id, InvoiceNumber invoice_number, InvoiceSeries invoice_series, CustomerID customer_id, "
        "SalespersonID salesperson_id, PaymentMethodID payment_method_id, IssueDate issue_date, "
        "InvoiceStatus invoice_status, DiscountValue discount_value, CreatedAt created_at",
        [
            *null_checks("InvoiceID", "InvoiceNumber", "CustomerID", "IssueDate"),
            FUTURE,
            CUSTOMER,
            SELLER,
            (not_found("PaymentMethodID", "b_payment_methods", "PaymentMethodID"), "PaymentMethodID_not_found"),
            NO_ITEMS,
        ],
    ),
    "sales_invoice_items": (
        "b_items",
        "InvoiceItemID",
        "InvoiceItemID invoice_item_id, InvoiceID invoice_id, ItemSequence item_sequence, ProductID product_id, "
        "Quantity quantity, UnitPrice unit_price, DiscountValue discount_value, CreatedAt created_at",
        ITEM_CHECKS,
    ),
    "sales_returns": (
        "b_returns",
        "ReturnID",
        "ReturnID return_id, ReturnNumber return_number, InvoiceID invoice_id, InvoiceItemID invoice_item_id, "
        "ProductID product_id, CustomerID customer_id, ReturnDate return_date, Quantity quantity, "
        "UnitValue unit_value, ReturnReason return_reason, CreatedAt created_at",
        [
            *null_checks("ReturnID", "InvoiceID", "InvoiceItemID", "ProductID", "CustomerID"),
            UNITS,
            INVOICE,
            (not_found("InvoiceItemID", "b_items", "InvoiceItemID"), "InvoiceItemID_not_found"),
            PRODUCT,
            CUSTOMER,
        ],
    ),
    "sales_targets": (
        "b_targets",
        "TargetID",
        "TargetID target_id, SalespersonID salesperson_id, RegionID region_id, TargetYear target_year, "
        "TargetMonth target_month, TargetValue target_value, CreatedAt created_at",
        [
            *null_checks("TargetID", "SalespersonID", "RegionID"),
            ("TargetValue <= 0", "TargetValue_zero_or_negative"),
            SELLER,
            REGION,
        ],
    ),
}


def silver(table: str) -> str:
    source, key, columns, checks = SILVER[table]
    named = ", ".join(f"{old} AS {new}" for old, new in (c.split() for c in columns.split(", ")))
    rest = [c.split()[0] for c in columns.split(", ") if c.split()[0] != key]
    order = ", ".join(f"{c} ASC NULLS FIRST" for c in rest)
    return f"""SELECT {named}, UpdatedAt AS updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY UpdatedAt DESC NULLS LAST, {order}) AS nth
        FROM {source} WHERE {reasons(checks)} = '') WHERE nth = 1"""


def quarantine() -> str:
    parts = [
        f"SELECT '{table}' AS table_name, '{reason}' AS reason, count(*) AS rejected_rows FROM {source}"
        f" WHERE {condition} HAVING count(*) > 0"
        for table, (source, _, _, checks) in SILVER.items()
        for condition, reason in checks
    ]
    return " UNION ALL ".join(parts)


CONTROL = (
    "TIMESTAMP '2001-07-01 05:15:00' AS ingestion_timestamp, 'erp' AS source_system, 'orders' AS source_table, "
    "'20010701051500-00000000' AS batch_id, 'full' AS load_type"
)
ITEM_KEYS = (
    "InvoiceItemID AS invoice_item_id, InvoiceID AS invoice_id, ProductID AS product_id, "
    "Quantity AS quantity, UnitPrice AS unit_price"
)


def orphan_row(name: str, table: str, keys: list[str], known: str = "false") -> str:
    missing = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"""SELECT '{name}' AS table_name, count(*) FILTER (WHERE {known}) AS known_orphans,
        count(*) FILTER (WHERE NOT ({known})) AS unexpected_orphans FROM {table} WHERE {missing}"""


def missing_date_row(name: str, table: str) -> str:
    return f"""SELECT '{name}' AS table_name, count(DISTINCT date_key) AS missing_dates FROM {table}
        WHERE date_key NOT IN (SELECT date_key FROM dim_date)"""


def count_row(name: str, silver_table: str, gold_table: str) -> str:
    return f"""SELECT '{name}' AS table_name, (SELECT count(*) FROM {silver_table}) AS silver_rows,
        (SELECT count(*) FROM {gold_table}) AS gold_rows,
        (SELECT count(*) FROM {silver_table}) = (SELECT count(*) FROM {gold_table}) AS ok"""


def revenue_row(table: str) -> str:
    return f"""SELECT '{table}' AS table_name, {total("net_revenue", 38, 6)} AS net_revenue,
        (SELECT {total("net_revenue", 38, 6)} FROM base) AS base_net_revenue,
        abs(sum(net_revenue) - (SELECT sum(net_revenue) FROM base)) <= 0.01 AS ok FROM {table}"""


def top(table: str, metric: str, key: str, label: str) -> str:
    return f"SELECT {key}, {label}, {metric} FROM {table} ORDER BY {metric} DESC NULLS LAST, {key} LIMIT 10"


def dynamic_rank(table: str, key: str, column: str, values: str) -> str:
    return f"""SELECT {key}, {column}, net_revenue, rank_net_revenue, {dense("net_revenue")} AS dynamic_rank
        FROM {table} WHERE {column} IN ({values})"""


def columns_of(table: str, columns: str) -> str:
    return f"SELECT {columns} FROM {table}"


SALES_KEYS = ["customer_key", "salesperson_key", "payment_method_key", "region_key", "date_key"]
RETURN_KEYS = ["customer_key", "product_key", *SALES_KEYS[1:]]
TARGET_KEYS = ["salesperson_key", "region_key", "date_key"]
FUTURE_ORDERS = f"invoice_id IN (SELECT o_orderkey FROM orders WHERE o_orderdate > {AS_OF})"

SELECTS = {
    "incremental_extract": """SELECT event_id, ts, user_id, event_type FROM events
        WHERE date_trunc('second', ts) > TIMESTAMP '2024-01-03 00:00:00'""",
    "incremental_extract_date": """SELECT event_id, CAST(ts AS DATE) AS day FROM events
        WHERE CAST(ts AS DATE) > DATE '2024-01-03'""",
    "last_watermark": """SELECT 'events' AS table_name, date_trunc('second', max(ts)) AS last_watermark FROM events
        UNION ALL SELECT 'lineitem', date_trunc('second', max(l_shipdate)) FROM lineitem
        UNION ALL SELECT 'orders', date_trunc('second', max(o_orderdate)) FROM orders""",
    "upsert_null_keys": """WITH keyed AS (SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey END AS o_orderkey,
            o_orderstatus, o_orderdate FROM orders)
        SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '2000-01-01 00:00:00' AND o_orderkey IS NOT NULL
            THEN 'amended' ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM keyed
        UNION ALL SELECT o_orderkey, 'amended', o_orderdate FROM keyed
            WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00' AND o_orderkey IS NULL""",
    "upsert_merge": """SELECT o_orderkey, CASE WHEN o_orderdate > TIMESTAMP '2000-01-01 00:00:00' THEN 'amended'
            ELSE o_orderstatus END AS o_orderstatus, o_orderdate FROM orders
        UNION ALL SELECT -o_orderkey - 1, 'amended', o_orderdate FROM orders
            WHERE o_orderdate > TIMESTAMP '2000-01-01 00:00:00'""",
    "add_control_columns": f"SELECT *, {CONTROL} FROM orders",
    "standardize_columns": f"""SELECT {ITEM_KEYS}, ItemSequence AS item_sequence, DiscountValue AS discount_value,
        CreatedAt AS created_at, UpdatedAt AS updated_at FROM b_items""",
    "drop_control_columns": "SELECT * FROM b_customers",
    "cast_columns": """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_custkey, o_orderstatus,
        CAST(o_totalprice AS DECIMAL(14,2)) AS o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate,
        TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM orders""",
    "null_fill": """SELECT CustomerID AS customer_id, coalesce(CustomerName, 'unknown') AS customer_name,
        coalesce(RegionID, 0) AS region_id, UpdatedAt AS updated_at FROM b_customers""",
    "safe_ratio": f"""SELECT *, {ratio("returned_units", "kept_units")} AS ratio FROM (
        SELECT invoice_id,
            {total("CASE WHEN return_flag = 'R' THEN quantity ELSE 0 END", 28, 2)} AS returned_units,
            {total("CASE WHEN return_flag = 'R' THEN 0 ELSE quantity END", 28, 2)} AS kept_units
        FROM items GROUP BY invoice_id)""",
    "repair_encoding": """SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, md5(text) AS text_md5
        FROM documents""",
    "sales_base": columns_of("base", "invoice_item_id, invoice_status, gross_revenue, net_revenue, margin_amount"),
    "dirty_items": f"SELECT {ITEM_KEYS} FROM b_items WHERE Quantity <= 0 OR UnitPrice < 0",
    "future_invoices": f"""SELECT InvoiceID AS invoice_id, InvoiceNumber AS invoice_number, IssueDate AS issue_date
        FROM b_header WHERE IssueDate > {AS_OF}""",
    "table_counts": " UNION ALL ".join(
        f"SELECT 'erp_{name}' AS table_name, count(*) AS record_count FROM {source}"
        for name, (source, *_) in SILVER.items()
    ),
    "invoices_per_month": """SELECT CAST(year(IssueDate) AS INTEGER) AS invoice_year,
        CAST(month(IssueDate) AS INTEGER) AS invoice_month, count(*) AS invoice_count,
        count(*) FILTER (WHERE InvoiceStatus = 'cancelled') AS cancelled_count FROM b_header GROUP BY 1, 2""",
    "invoices_without_items": """SELECT h.InvoiceID AS invoice_id, h.InvoiceNumber AS invoice_number
        FROM b_header h LEFT JOIN b_items i ON i.InvoiceID = h.InvoiceID WHERE i.InvoiceItemID IS NULL""",
    "returns_by_product": f"""SELECT product_name, count(*) AS return_count,
        {total("quantity", 32, 2)} AS total_quantity_returned,
        {total(amount("quantity", "unit_value"), 38, 4)} AS total_value_returned
        FROM returns JOIN products USING (product_id) GROUP BY product_name""",
    "check_not_null": f"""SELECT CustomerID AS customer_id, UpdatedAt AS updated_at,
        {reasons(null_checks("CustomerID", "CustomerName", "RegionID"))} AS reasons FROM b_customers""",
    "check_positive": f"""SELECT InvoiceItemID AS invoice_item_id, Quantity AS quantity, UnitPrice AS unit_price,
        {reasons([UNITS, NEGATIVE_PRICE])} AS reasons FROM b_items""",
    "check_not_future": f"""SELECT InvoiceID AS invoice_id, IssueDate AS issue_date, {reasons([FUTURE])} AS reasons
        FROM b_header""",
    "check_foreign_key": f"""SELECT InvoiceItemID AS invoice_item_id, ProductID AS product_id,
        {reasons([PRODUCT])} AS reasons FROM b_items""",
    "check_has_related": f"""SELECT InvoiceID AS invoice_id, UpdatedAt AS updated_at, {reasons([NO_ITEMS])} AS reasons
        FROM b_header""",
    "quality_chain": f"""SELECT InvoiceItemID AS invoice_item_id, ItemSequence AS item_sequence,
        UpdatedAt AS updated_at, {reasons(ITEM_CHECKS)} AS reasons FROM b_items""",
    "split_valid": f"SELECT {ITEM_KEYS} FROM b_items WHERE {reasons(ITEM_CHECKS)} = ''",
    "split_rejected": f"""SELECT {ITEM_KEYS}, {reasons(ITEM_CHECKS)} AS rejection_reason FROM b_items
        WHERE {reasons(ITEM_CHECKS)} <> ''""",
    "deduplicate_latest": f"""SELECT {ITEM_KEYS}, ItemSequence AS item_sequence, DiscountValue AS discount_value,
        CreatedAt AS created_at, UpdatedAt AS updated_at
        FROM (SELECT *, row_number() OVER (PARTITION BY InvoiceID, ItemSequence ORDER BY UpdatedAt DESC NULLS LAST,
                ProductID NULLS FIRST, Quantity NULLS FIRST, UnitPrice NULLS FIRST, DiscountValue NULLS FIRST) AS nth
              FROM b_items) WHERE nth = 1""",
    "silver_regions": silver("regions"),
    "silver_payment_methods": silver("payment_methods"),
    "silver_customers": silver("customers"),
    "silver_products": silver("products"),
    "silver_salespersons": silver("salespersons"),
    "silver_invoice_header": silver("sales_invoice_header"),
    "silver_invoice_items": silver("sales_invoice_items"),
    "silver_returns": silver("sales_returns"),
    "silver_targets": silver("sales_targets"),
    "quarantine_reasons": quarantine(),
    "join_left_dims": """SELECT i.invoice_item_id, p.product_name, c.customer_segment, s.salesperson_name, r.region_name
        FROM items i LEFT JOIN header h ON h.invoice_id = i.invoice_id
        LEFT JOIN products p ON p.product_id = i.product_id
        LEFT JOIN customers c ON c.customer_id = h.customer_id
        LEFT JOIN salespersons s ON s.salesperson_id = h.salesperson_id
        LEFT JOIN regions r ON r.region_id = s.region_id""",
    "revenue_by_key": f"""SELECT product_id, {total(amount("quantity", "unit_price"), 28, 4)} AS gross_revenue,
        {total("discount_value", 22, 2)} AS discount_value, {total("quantity", 22, 2)} AS units_sold
        FROM items GROUP BY product_id""",
    "distinct_activity": """SELECT strftime(issue_date, '%Y-%m') AS year_month, count(DISTINCT invoice_id) AS invoices,
        count(DISTINCT customer_id) AS customers, count(DISTINCT salesperson_id) AS salespersons
        FROM invoices GROUP BY 1""",
    "distinct_keys": "SELECT DISTINCT customer_id, salesperson_id FROM invoices",
    "calendar_bounds": "SELECT * FROM bounds",
    "targets_by_month": f"""SELECT printf('%04d-%02d', target_year, target_month) AS year_month,
        {total("target_value", 24, 2)} AS target_total FROM targets GROUP BY 1""",
    "scalar_dates": f"""SELECT invoice_id, CAST(issue_date AS DATE) AS issue_day, {date_key("issue_date")} AS date_key,
        strftime(issue_date, '%Y-%m') AS year_month, strftime(issue_date, '%B') AS month_name,
        strftime(issue_date, '%A') AS day_name, CAST(year(issue_date) AS INTEGER) AS year,
        CAST(month(issue_date) AS INTEGER) AS month,
        CAST(year(issue_date) * 12 + month(issue_date) AS INTEGER) AS month_index,
        strftime(issue_date, '%Y-%m') AS month_text, CAST(date_trunc('month', issue_date) AS DATE) AS month_start,
        date_diff('second', TIMESTAMP '2020-01-01 00:00:00', date_trunc('day', issue_date)) AS seconds_since_2020
        FROM invoices""",
    "surrogate_key": "SELECT row_number() OVER (ORDER BY invoice_id) AS invoice_key, invoice_id FROM invoices",
    "surrogate_key_text": """SELECT row_number() OVER (ORDER BY invoice_number) AS invoice_key, invoice_number
        FROM invoices""",
    "global_dense_rank": f"""SELECT *, {dense("units_sold")} AS rank_units_sold, {dense("top_price")} AS rank_top_price
        FROM (SELECT product_id, {total("quantity", 22, 2)} AS units_sold, max(unit_price) AS top_price
              FROM items GROUP BY product_id)""",
    "dense_rank_text": f"""SELECT customer_id, customer_segment, customer_name,
        {dense("customer_segment")} AS rank_segment, {dense("customer_name")} AS rank_name FROM customers""",
    "dense_rank_per_group": f"""SELECT *, CAST(dense_rank() OVER (PARTITION BY category_name ORDER BY units_sold DESC)
            AS INTEGER) AS rank_in_category
        FROM (SELECT product_id, category_name, {total("quantity", 22, 2)} AS units_sold
              FROM items LEFT JOIN products USING (product_id) GROUP BY product_id, category_name)""",
    "dim_region": "SELECT * FROM dim_region",
    "dim_payment_method": "SELECT * FROM dim_payment_method",
    "dim_customer": "SELECT * FROM dim_customer",
    "dim_product": "SELECT * FROM dim_product",
    "dim_salesperson": "SELECT * FROM dim_salesperson",
    "dim_date": "SELECT * FROM dim_date",
    "fact_sales": "SELECT row_number() OVER (ORDER BY invoice_item_id) AS sales_key, * FROM lines",
    "fact_returns": "SELECT * FROM fact_returns",
    "fact_sales_targets": "SELECT * FROM fact_sales_targets",
    "discount_allocation": columns_of("allocated", "invoice_item_id, invoice_id, header_discount_allocated"),
    "returns_per_item": "SELECT * FROM item_returns",
    "gold_count_check": " UNION ALL ".join(
        [
            count_row("dim_region", "regions", "dim_region"),
            count_row("dim_payment_method", "payment_methods", "dim_payment_method"),
            count_row("dim_customer", "customers", "dim_customer"),
            count_row("dim_product", "products", "dim_product"),
            count_row("dim_salesperson", "salespersons", "dim_salesperson"),
            count_row("fact_sales", "items", "lines"),
            count_row("fact_returns", "returns", "fact_returns"),
            count_row("fact_sales_targets", "targets", "fact_sales_targets"),
        ]
    ),
    "orphan_keys": " UNION ALL ".join(
        [
            orphan_row("fact_sales", "lines", SALES_KEYS, FUTURE_ORDERS),
            orphan_row("fact_returns", "fact_returns", RETURN_KEYS),
            orphan_row("fact_sales_targets", "fact_sales_targets", TARGET_KEYS),
        ]
    ),
    "date_key_coverage": " UNION ALL ".join(
        [
            missing_date_row("fact_sales", "lines"),
            missing_date_row("fact_returns", "fact_returns"),
            missing_date_row("fact_sales_targets", "fact_sales_targets"),
        ]
    ),
    "monthly_sales": "SELECT * FROM monthly_sales",
    "product_ranking": "SELECT * FROM product_ranking",
    "customer_ranking": "SELECT * FROM customer_ranking",
    "salesperson_performance": "SELECT * FROM salesperson_performance",
    "target_vs_actual": "SELECT * FROM target_vs_actual",
    "commercial_kpis": "SELECT * FROM commercial_kpis",
    "revenue_reconciliation": " UNION ALL ".join(
        revenue_row(t)
        for t in ("monthly_sales", "product_ranking", "customer_ranking", "salesperson_performance")
    ),
    "invoice_count_check": """SELECT *, base_invoices = monthly_invoices AS ok FROM (
        SELECT (SELECT count(DISTINCT invoice_id) FROM base) AS base_invoices,
            (SELECT CAST(coalesce(sum(invoice_count), 0) AS BIGINT) FROM monthly_sales) AS monthly_invoices)""",
    "kpi_vs_monthly_check": """SELECT count(*) AS months,
        count(*) FILTER (WHERE abs(k.net_revenue - m.net_revenue) > 0.01) AS mismatched_months
        FROM commercial_kpis k JOIN (SELECT year_month, sum(net_revenue) AS net_revenue FROM monthly_sales
            GROUP BY year_month) m ON m.year_month = k.year_month""",
    "attainment_check": """SELECT count(*) FILTER (WHERE has_target) AS rows_with_target,
        count(*) FILTER (WHERE has_target AND target_attainment IS NULL) AS without_attainment FROM target_vs_actual""",
    "kpi_month_over_month": "SELECT * FROM kpi_mom",
    "kpi_year_over_year": f"""SELECT k.year_month, k.year, k.month, k.net_revenue,
        p.net_revenue AS last_year_net_revenue,
        {ratio("k.net_revenue - p.net_revenue", "p.net_revenue")} AS net_revenue_growth
        FROM commercial_kpis k LEFT JOIN commercial_kpis p ON p.year = k.year - 1 AND p.month = k.month""",
    "region_month_over_month": f"""SELECT k.region_key, k.region_name, k.year_month, k.year, k.month, k.net_revenue,
        p.net_revenue AS previous_net_revenue,
        {ratio("k.net_revenue - p.net_revenue", "p.net_revenue")} AS net_revenue_growth
        FROM monthly_sales k LEFT JOIN monthly_sales p
            ON p.region_key = k.region_key AND k.year * 12 + k.month = p.year * 12 + p.month + 1""",
    "region_year_over_year": f"""SELECT k.region_key, k.region_name, k.year_month, k.year, k.month, k.net_revenue,
        y.net_revenue AS last_year_net_revenue, p.net_revenue AS previous_net_revenue,
        {ratio("k.net_revenue - y.net_revenue", "y.net_revenue")} AS net_revenue_growth
        FROM monthly_sales k
        LEFT JOIN monthly_sales y ON y.region_key = k.region_key AND y.year = k.year - 1 AND y.month = k.month
        LEFT JOIN monthly_sales p
            ON p.region_key = k.region_key AND k.year * 12 + k.month = p.year * 12 + p.month + 1""",
    "monthly_activity": f"""SELECT year, month, region_key, {total("net_revenue", 38, 6)} AS net_revenue,
        count(DISTINCT invoice_id) AS invoice_count, count(DISTINCT customer_key) AS active_customers,
        count(DISTINCT salesperson_key) AS active_salespersons, count(DISTINCT product_key) AS active_products
        FROM base LEFT JOIN dim_date USING (date_key) GROUP BY year, month, region_key""",
    "key_bounds": " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, min({key}) AS lowest, max({key}) AS highest, count(*) AS rows FROM {table}"
        for table, key in (
            ("customer", "c_custkey"),
            ("documents", "doc_id"),
            ("events", "event_id"),
            ("lineitem", "l_orderkey"),
            ("orders", "o_orderkey"),
            ("part", "p_partkey"),
            ("supplier", "s_suppkey"),
        )
    ),
    "attainment_weighted": f"""SELECT region_name, target_year, {total("actual_net_revenue", 38, 6)} AS actual_net_revenue,
        {total("target_value", 24, 2)} AS target_value,
        {ratio("sum(actual_net_revenue)", "sum(target_value)")} AS target_attainment
        FROM target_vs_actual GROUP BY region_name, target_year""",
    "attainment_change_pp": """SELECT k.*, p.target_attainment AS previous_attainment,
        k.target_attainment - p.target_attainment AS attainment_change_pp
        FROM attained k LEFT JOIN attained p
            ON k.target_year * 12 + k.target_month = p.target_year * 12 + p.target_month + 1""",
    "kpi_card_text": """SELECT year_month, concat('R$ ', format('{:,.2f}', CAST(round(net_revenue, 2) AS DOUBLE)), '  ',
        CASE WHEN net_revenue_growth < 0 THEN '▼' ELSE '▲' END, ' ',
        coalesce(CAST(round(CAST(net_revenue_growth * 100 AS DECIMAL(18,6)), 1) AS VARCHAR) || '%', '')) AS card
        FROM kpi_mom""",
    "dynamic_rank_product": dynamic_rank("product_ranking", "product_key", "category_name", "'PROMO', 'ECONOMY'"),
    "dynamic_rank_customer": dynamic_rank("customer_ranking", "customer_key", "customer_segment", "'FURNITURE'"),
    "dynamic_rank_salesperson": dynamic_rank(
        "salesperson_performance", "salesperson_key", "region_name", "'ASIA', 'EUROPE'"
    ),
    "top_products": top("product_ranking", "net_revenue", "product_key", "product_name"),
    "top_returned_products": top("product_ranking", "returned_amount", "product_key", "product_name"),
    "top_customers": top("customer_ranking", "net_revenue", "customer_key", "customer_name"),
    "top_returned_customers": top("customer_ranking", "returned_amount", "customer_key", "customer_name"),
    "top_salespersons": top("salesperson_performance", "net_revenue", "salesperson_key", "salesperson_name"),
    "top_returned_salespersons": top(
        "salesperson_performance", "returned_amount", "salesperson_key", "salesperson_name"
    ),
}

ORACLE = {name: with_subqueries(select) for name, select in SELECTS.items()}
