"""Questions over a customers / products / orders / order_items star."""

from __future__ import annotations

from pyspark.errors import AnalysisException, ParseException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_LOGICAL = "org.apache.spark.sql.catalyst.plans.logical."
_LISTING = ("Show", "Describe", "Explain")


def register_star(tables: dict[str, DataFrame]) -> list[str]:
    """Register each table as a view; returns the names."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return sorted(tables)


def top_customers(customers: DataFrame, orders: DataFrame, n: int = 3) -> DataFrame:
    """Customers with the highest total spend; names are joined after the top-n cut."""
    spend = (
        orders.groupBy("customer_id")
        .agg(F.sum("total_amount").alias("total_spend"))
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(n)
    )
    return spend.join(customers.select(F.col("id").alias("customer_id"), "name"), "customer_id", "left")


def _units_by_product(order_items: DataFrame) -> DataFrame:
    return order_items.groupBy("product_id").agg(F.sum("quantity").alias("units"))


def best_category(products: DataFrame, order_items: DataFrame, n: int = 1) -> DataFrame:
    """Best-selling category by units; lines are summed per product before the join."""
    return (
        _units_by_product(order_items)
        .join(products.select(F.col("id").alias("product_id"), "category"), "product_id")
        .groupBy("category")
        .agg(F.sum("units").alias("units"))
        .orderBy(F.desc("units"), "category")
        .limit(n)
    )


def repeat_customers(orders: DataFrame) -> DataFrame:
    """Customers with more than one order."""
    return orders.groupBy("customer_id").agg(F.count("*").alias("n_orders")).filter("n_orders > 1")


def avg_order_by_country(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Average order value per country; orders are summed per customer before the join."""
    per_customer = orders.groupBy("customer_id").agg(
        F.sum("total_amount").alias("amount"), F.count("total_amount").alias("n")
    )
    return (
        per_customer.join(customers.select(F.col("id").alias("customer_id"), "country"), "customer_id")
        .groupBy("country")
        .agg((F.sum("amount") / F.sum("n")).alias("avg_order_value"))
    )


def order_status_counts(orders: DataFrame) -> DataFrame:
    return orders.groupBy("status").agg(F.count("*").alias("n_orders"))


def never_ordered(products: DataFrame, order_items: DataFrame) -> DataFrame:
    """Products without any order line."""
    sold = order_items.select(F.col("product_id").alias("id")).distinct()
    return products.join(sold, "id", "left_anti")


def _seq(values) -> list:
    return [values.apply(i) for i in range(values.size())]


def _kinds(java_class) -> set[str]:
    """Names of a JVM class, its parents and all their interfaces."""
    found = set()
    while java_class is not None:
        found.add(java_class.getName())
        for trait in java_class.getInterfaces():
            found |= _kinds(trait)
        java_class = java_class.getSuperclass()
    return found


def only_reads(spark: SparkSession, statement: str) -> bool:
    """Does the parsed statement, with its subqueries and common tables, hold no command, insert or script?

    The text is parsed and not run. Listing commands (SHOW, DESCRIBE, EXPLAIN) may stand at the top; nothing below one
    of them is run either.
    """
    refused = {_LOGICAL + name for name in ("Command", "ParsedStatement", "InsertIntoDir", "ScriptTransformation")}
    top = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
    if top.getClass().getSimpleName().startswith(_LISTING):
        return True
    waiting = [top]
    while waiting:
        node = waiting.pop()
        kind = node.getClass()
        if "catalyst.plans.logical" in kind.getName() or "execution" in kind.getName():
            if _kinds(kind) & refused:
                return False
        waiting += _seq(node.children()) + _seq(node.innerChildren())
        if hasattr(node, "subqueries"):
            waiting += _seq(node.subqueries())
    return True


_REFLECTION = {"CallMethodViaReflection", "TryReflect"}  # functions that call any JVM method
_LEAVES = {"LocalRelation", "OneRowRelation", "Range", "CTERelationRef"}  # leaves that read nothing stored


def foreign_reads(spark: SparkSession, plan) -> str | None:
    """What in an analysed plan goes beyond the registered temporary views: a stored table or path, or a call by
    reflection (``reflect``, ``java_method``, ``try_reflect``); None when nothing does. Views are not looked into."""
    views = {t.name for t in spark.catalog.listTables() if t.isTemporary}
    subquery = spark._jvm.java.lang.Class.forName("org.apache.spark.sql.catalyst.expressions.SubqueryExpression")
    plans = [plan]
    while plans:
        node = plans.pop()
        name = node.getClass().getSimpleName()
        if name == "View":
            ident = node.desc().identifier()
            if node.isTempView() and ident.table() in views:
                continue
            return f"reads {ident.unquotedString()}: only registered views are read"
        expressions = _seq(node.expressions())
        while expressions:
            e = expressions.pop()
            if e.getClass().getSimpleName() in _REFLECTION:
                return "calls by reflection are refused"
            if subquery.isInstance(e):
                plans.append(e.plan())
            expressions += _seq(e.children())
        children = _seq(node.children())
        if not children and name not in _LEAVES:
            return f"reads {name}: only registered views are read"
        plans += children + _seq(node.innerChildren())
    return None


def bounded_sql(spark: SparkSession, text: str, limit: int = 50) -> tuple[DataFrame | None, str | None]:
    """Run one read statement over the registered views: ``(first rows, None)`` or ``(None, error text)``.

    The parsed text must hold no command, insert or script (``only_reads``); then the analysed plan, before anything
    runs, may read only registered temporary views and call nothing by reflection (``foreign_reads``).
    """
    statement = text.strip().rstrip(";")
    try:
        if not only_reads(spark, statement):
            return None, "only read statements are run"
        top = spark._jsparkSession.sessionState().sqlParser().parsePlan(statement)
        if top.getClass().getSimpleName().startswith(_LISTING):
            return spark.sql(statement).limit(limit), None
        found = spark.sql(statement)
        refused = foreign_reads(spark, found._jdf.queryExecution().analyzed())
        if refused:
            return None, refused
        return found.limit(limit), None
    except (AnalysisException, ParseException) as error:
        return None, str(error)


def result_preview(result: DataFrame, order: list, n: int = 5) -> DataFrame:
    """First rows of a result in a stated order."""
    return result.orderBy(*order).limit(n)


def schema_card(tables: dict[str, DataFrame], keys: dict[str, list[str]]) -> DataFrame:
    """One row per table: columns, row count, nulls per column, the two rows with the lowest keys."""
    cards = []
    for name in sorted(tables):
        df = tables[name]
        counts = df.agg(
            F.count("*").alias("n_rows"),
            F.to_json(F.struct(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])).alias("null_counts"),
        )
        sample = df.orderBy(*keys[name]).limit(2).select(F.to_json(F.struct(*df.columns)).alias("row"))
        samples = sample.agg(F.array_join(F.array_sort(F.collect_list("row")), "\n")).scalar()
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)
        cards.append(
            counts.select(
                F.lit(name).alias("table_name"), F.lit(columns).alias("columns"), "n_rows", "null_counts",
                samples.alias("sample_rows"),
            )
        )
    out = cards[0]
    for card in cards[1:]:
        out = out.unionByName(card)
    return out
