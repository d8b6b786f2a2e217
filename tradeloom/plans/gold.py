"""Gold: the star schema, six dimensions and three facts, from the silver tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradeloom.functions.amounts import FINE_AMOUNT, allocate, line_amount, safe_ratio
from tradeloom.functions.dates import date_key, month_start
from tradeloom.operators.joins import lookup_join
from tradeloom.operators.ranking import surrogate_key
from tradeloom.session import settled, unstage

# --- dimensions ---
# The columns of every table, their names and their order.


def dim_region(regions: DataFrame) -> DataFrame:
    return surrogate_key(regions, "region_key", "region_id").select(
        "region_key", "region_id", "region_code", "region_name", "state", "country"
    )


def dim_payment_method(payment_methods: DataFrame) -> DataFrame:
    return surrogate_key(payment_methods, "payment_method_key", "payment_method_id").select(
        "payment_method_key", "payment_method_id", "payment_method_code", "payment_method_name", "payment_type"
    )


def dim_customer(customers: DataFrame, regions: DataFrame) -> DataFrame:
    keyed = surrogate_key(customers, "customer_key", "customer_id")
    return lookup_join(keyed, _region_names(regions), "region_id").select(
        "customer_key",
        "customer_id",
        "customer_code",
        "customer_name",
        "document",
        "email",
        "phone",
        "customer_segment",
        "region_id",
        "region_name",
        "is_active",
    )


def dim_product(products: DataFrame) -> DataFrame:
    return surrogate_key(products, "product_key", "product_id").select(
        "product_key",
        "product_id",
        "product_code",
        "product_name",
        "category_name",
        "unit_of_measure",
        "unit_cost",
        "unit_price",
        "is_active",
    )


def dim_salesperson(salespersons: DataFrame, regions: DataFrame) -> DataFrame:
    keyed = surrogate_key(salespersons, "salesperson_key", "salesperson_id")
    return lookup_join(keyed, _region_names(regions), "region_id").select(
        "salesperson_key",
        "salesperson_id",
        "salesperson_code",
        "salesperson_name",
        "region_id",
        "region_name",
        "hire_date",
        "is_active",
    )


def calendar_bounds(header: DataFrame, returns: DataFrame, targets: DataFrame) -> DataFrame:
    """First day of the first month and last day of the last month of any sale, return or target."""
    days = (
        header.select(F.to_date("issue_date").alias("d"))
        .union(returns.select(F.to_date("return_date")))
        .union(targets.select(month_start("target_year", "target_month")))
    )
    return days.agg(
        F.trunc(F.min("d"), "month").alias("first_day"), F.last_day(F.max("d")).alias("last_day")
    )


def dim_date(header: DataFrame, returns: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per day between the calendar bounds, made inside the plan."""
    bounds = calendar_bounds(header, returns, targets)
    every_day = F.sequence("first_day", "last_day", F.expr("interval 1 day"))
    days = bounds.select(F.explode(every_day).alias("full_date"))
    return days.select(
        date_key("full_date").alias("date_key"),
        "full_date",
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        F.month("full_date").alias("month"),
        F.date_format("full_date", "MMMM").alias("month_name"),
        F.dayofmonth("full_date").alias("day"),
        F.dayofweek("full_date").alias("day_of_week"),
        F.date_format("full_date", "EEEE").alias("day_name"),
        F.weekofyear("full_date").alias("week_of_year"),
        F.dayofweek("full_date").isin(1, 7).alias("is_weekend"),
        F.date_format("full_date", "yyyy-MM").alias("year_month"),
    )


# --- facts ---


def returns_per_item(returns: DataFrame) -> DataFrame:
    return returns.groupBy("invoice_item_id").agg(
        F.sum(line_amount("quantity", "unit_value")).alias("returned_amount"),
        F.sum("quantity").alias("returned_quantity"),
    )


def invoice_gross(items: DataFrame) -> DataFrame:
    return items.groupBy("invoice_id").agg(F.sum(line_amount("quantity", "unit_price")).alias("invoice_gross"))


def allocate_discounts(items: DataFrame, header: DataFrame) -> DataFrame:
    """Give each item its share of its invoice's discount, by gross revenue.

    The shares of an invoice add up to its discount. The items present are the base, so a
    rejected item's share falls to the others. The invoice side is put together first,
    which leaves one join of the large side.
    """
    discounts = header.select("invoice_id", F.col("discount_value").alias("header_discount"))
    invoices = invoice_gross(items).join(discounts, "invoice_id", "left")
    shared = _with_allocation(items, invoices)
    return shared.select(*items.columns, "header_discount_allocated")


def _as_planned(df: DataFrame, label: str, before: DataFrame | None = None) -> DataFrame:
    return df


def _stored_step(df: DataFrame, label: str, before: DataFrame | None = None) -> DataFrame:
    """The stored frame; the stored one that it was made of is deleted."""
    stored = settled(df, label)
    unstage(before)
    return stored


def sales_lines(
    items: DataFrame,
    header: DataFrame,
    returns: DataFrame,
    dim_customer: DataFrame | None,
    dim_product: DataFrame,
    dim_salesperson: DataFrame | None,
    dim_payment_method: DataFrame | None,
    dim_region: DataFrame | None,
    *,
    numbered: DataFrame | None = None,
    step: Callable[..., DataFrame] = _as_planned,
) -> DataFrame:
    """`fact_sales` without its own surrogate key, for aggregates that do not need one.

    Everything known per invoice (status, date, customer, salesperson, payment, region of
    the salesperson) is looked up at invoice grain, before the one join to the items. That
    join comes last: returns and products meet the narrow items, and the many columns of an
    invoice are not shuffled again. Its lines then lie together, which leaves one row per
    invoice of a distinct count before it is shuffled.
    Left joins keep items whose invoice is missing, with NULL keys. A dimension that is
    None is left out, with its key. `numbered` is the items with a `sales_key`, which is
    then kept. `step(frame, label, before)` gives the frame that the next join reads.
    """
    rows = items if numbered is None else numbered
    attributes, keys = _invoice_attributes(
        header, dim_customer, dim_salesperson, dim_payment_method, dim_region
    )
    attributes = attributes.select(
        "invoice_id",
        "invoice_number",
        "invoice_series",
        *keys,
        date_key("issue_date").alias("date_key"),
        "invoice_status",
        F.col("discount_value").alias("header_discount"),
    )
    invoices = step(invoice_gross(items).join(attributes, "invoice_id", "left"), "invoices")
    returned = step(_with_returns(rows.withColumnRenamed("discount_value", "item_discount"), returns), "returned", rows)
    products = dim_product.select("product_id", "product_key", F.col("unit_cost").alias("product_cost"))
    rows = step(lookup_join(returned, products, "product_id").drop("product_id"), "priced", returned)
    lines = _with_allocation(rows, invoices)

    discount = F.col("item_discount") + F.col("header_discount_allocated")
    return (
        lines.withColumns(
            {
                "gross_revenue": line_amount("quantity", "unit_price"),
                "discount_amount": discount.cast(FINE_AMOUNT),
                "total_cost": line_amount("quantity", "product_cost"),
            }
        )
        .withColumn(
            "net_revenue",
            (F.col("gross_revenue") - F.col("discount_amount") - F.col("returned_amount")).cast(FINE_AMOUNT),
        )
        .withColumn("margin_amount", (F.col("net_revenue") - F.col("total_cost")).cast(FINE_AMOUNT))
        .withColumn("margin_pct", safe_ratio("margin_amount", "net_revenue"))
        .select(
            *([] if numbered is None else ["sales_key"]),
            "invoice_item_id",
            "invoice_id",
            "invoice_number",
            "invoice_series",
            "item_sequence",
            *[k for k in keys if k == "customer_key"],
            "product_key",
            *[k for k in keys if k != "customer_key"],
            "date_key",
            "invoice_status",
            "quantity",
            "unit_price",
            "item_discount",
            "header_discount_allocated",
            "discount_amount",
            "returned_amount",
            "returned_quantity",
            "gross_revenue",
            "net_revenue",
            "total_cost",
            "margin_amount",
            "margin_pct",
        )
    )


def fact_sales(items: DataFrame, *others: DataFrame, by_steps: bool = False) -> DataFrame:
    """One row per item; arguments as for `sales_lines`. Numbered before the joins, on the items alone.

    The items are shuffled by id range, id, product and invoice. In one plan the files of all four stay until its end; `by_steps` stores the
    rows after each, so that the disk holds one of these shuffles at a time.
    """
    step = _stored_step if by_steps else _as_planned
    numbered = step(surrogate_key(items, "sales_key", "invoice_item_id"), "numbered")
    return sales_lines(items, *others, numbered=numbered, step=step)


def return_lines(
    returns: DataFrame,
    header: DataFrame,
    dim_customer: DataFrame | None,
    dim_product: DataFrame | None,
    dim_salesperson: DataFrame | None,
    dim_payment_method: DataFrame | None,
    dim_region: DataFrame | None,
    *,
    numbered: DataFrame | None = None,
) -> DataFrame:
    """`fact_returns` without its own surrogate key.

    Customer and product are the return's own, the rest is the invoice's. A dimension
    that is None is left out, and the invoices with it if none of theirs is wanted. So is a
    number or reason that a narrow copy of the returns does not hold.
    """
    rows = returns if numbered is None else numbered
    invoices, invoice_keys = _invoice_attributes(
        header, None, dim_salesperson, dim_payment_method, dim_region
    )
    if invoice_keys:
        invoices = invoices.select("invoice_id", *invoice_keys)
        rows = lookup_join(rows, invoices, "invoice_id")
    own_keys = []
    for dimension, entity in ((dim_customer, "customer"), (dim_product, "product")):
        if dimension is not None:
            keyed = dimension.select(f"{entity}_id", f"{entity}_key")
            rows = lookup_join(rows, keyed, f"{entity}_id")
            own_keys.append(f"{entity}_key")
    return rows.select(
        *([] if numbered is None else ["return_key"]),
        "return_id",
        *[c for c in ("return_number",) if c in rows.columns],
        "invoice_id",
        "invoice_item_id",
        *own_keys,
        *invoice_keys,
        date_key("return_date").alias("date_key"),
        "quantity",
        "unit_value",
        line_amount("quantity", "unit_value").alias("returned_amount"),
        *[c for c in ("return_reason",) if c in rows.columns],
    )


def fact_returns(returns: DataFrame, header: DataFrame, *dims: DataFrame) -> DataFrame:
    """One row per return; arguments as for `return_lines`."""
    numbered = surrogate_key(returns, "return_key", "return_id")
    return return_lines(returns, header, *dims, numbered=numbered)


def fact_sales_targets(
    targets: DataFrame, dim_salesperson: DataFrame, dim_region: DataFrame
) -> DataFrame:
    """One row per target, dated on the first day of its month."""
    keyed = surrogate_key(targets, "target_key", "target_id")
    people = dim_salesperson.select("salesperson_id", "salesperson_key")
    rows = lookup_join(keyed, people, "salesperson_id")
    rows = lookup_join(rows, dim_region.select("region_id", "region_key"), "region_id")
    return rows.select(
        "target_key",
        "target_id",
        "salesperson_key",
        "region_key",
        "target_year",
        "target_month",
        date_key(month_start("target_year", "target_month")).alias("date_key"),
        "target_value",
    )


def _region_names(regions: DataFrame) -> DataFrame:
    return regions.select("region_id", "region_name")


def _with_returns(items: DataFrame, returns: DataFrame) -> DataFrame:
    """Add what came back of each item, 0 without a return; sums are narrowed here, before they travel."""
    zero = F.lit(0)
    return lookup_join(items, returns_per_item(returns), "invoice_item_id").withColumns(
        {
            "returned_amount": F.coalesce("returned_amount", zero).cast("decimal(18,4)"),
            "returned_quantity": F.coalesce("returned_quantity", zero).cast("decimal(18,2)"),
        }
    )


def _with_allocation(items: DataFrame, invoices: DataFrame) -> DataFrame:
    lines = lookup_join(items, invoices, "invoice_id")
    share = allocate("header_discount", line_amount("quantity", "unit_price"), "invoice_gross")
    return lines.withColumn("header_discount_allocated", share)


def _invoice_attributes(
    header: DataFrame,
    dim_customer: DataFrame | None,
    dim_salesperson: DataFrame | None,
    dim_payment_method: DataFrame | None,
    dim_region: DataFrame | None,
) -> tuple[DataFrame, list[str]]:
    """The header with the keys of the dimensions given; the region is where the salesperson works."""
    rows, keys = header, []
    if dim_customer is not None:
        customers = dim_customer.select("customer_id", "customer_key")
        rows = lookup_join(rows, customers, "customer_id")
        keys.append("customer_key")
    territory = []
    if dim_salesperson is not None:
        people = dim_salesperson.select("salesperson_id", "salesperson_key", "region_id")
        territory = ["salesperson_key"]
        if dim_region is not None:
            regions = dim_region.select("region_id", "region_key")
            people = lookup_join(people, regions, "region_id")
            territory.append("region_key")
        rows = lookup_join(rows, people.drop("region_id"), "salesperson_id")
    keys += territory[:1]
    if dim_payment_method is not None:
        payments = dim_payment_method.select("payment_method_id", "payment_method_key")
        rows = lookup_join(rows, payments, "payment_method_id")
        keys.append("payment_method_key")
    return rows, keys + territory[1:]


# --- checks of the star schema ---

# The dimension keys of each fact, any of which makes an orphan if it is missing.
SALES_KEYS = ["customer_key", "salesperson_key", "payment_method_key", "region_key", "date_key"]
RETURN_KEYS = ["customer_key", "product_key", *SALES_KEYS[1:]]
TARGET_KEYS = ["salesperson_key", "region_key", "date_key"]


def count_check(pairs: Mapping[str, tuple[DataFrame, DataFrame]]) -> DataFrame:
    """Per table: rows in silver, rows in gold, and whether they agree."""
    counts = None
    for table, (silver, gold) in pairs.items():
        sides = silver.select(F.lit(1).alias("s"), F.lit(0).alias("g")).unionAll(
            gold.select(F.lit(0), F.lit(1))
        )
        row = sides.agg(
            F.lit(table).alias("table_name"),
            F.coalesce(F.sum("s"), F.lit(0)).alias("silver_rows"),
            F.coalesce(F.sum("g"), F.lit(0)).alias("gold_rows"),
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts.withColumn("ok", F.col("silver_rows") == F.col("gold_rows"))


def orphan_counts(fact: DataFrame, name: str, keys: list[str], known: DataFrame | None = None) -> DataFrame:
    """Rows with a NULL dimension key, split by whether their invoice is known to be missing.

    `known` lists such invoices as `invoice_id`, for example the quarantined headers.
    """
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    orphans = fact.filter(missing)
    if known is None:
        orphans = orphans.withColumn("_known", F.lit(False))
    else:
        flags = known.select("invoice_id").distinct().withColumn("_known", F.lit(True))
        orphans = lookup_join(orphans.select("invoice_id"), flags, "invoice_id")
    expected = F.coalesce("_known", F.lit(False))
    return orphans.agg(
        F.lit(name).alias("table_name"),
        F.count_if(expected).alias("known_orphans"),
        F.count_if(~expected).alias("unexpected_orphans"),
    )


def missing_dates(facts: Mapping[str, DataFrame], dim_date: DataFrame) -> DataFrame:
    """Per fact: date keys in use that the calendar does not have."""
    counts = None
    for name, fact in facts.items():
        used = fact.select("date_key").filter(F.col("date_key").isNotNull()).distinct()
        row = used.join(dim_date.select("date_key"), "date_key", "left_anti").agg(
            F.lit(name).alias("table_name"), F.count("*").alias("missing_dates")
        )
        counts = row if counts is None else counts.unionByName(row)
    return counts
