"""Adapter: the five logical retail tables over the driver's star-schema tables.

The test data is TPC-H-like (customer, orders, lineitem, part, nation,
region).  Every operator reads only the logical columns produced here, so a
deployment with the documented CSV tables (``load_csv_tables``) runs the same
operators unchanged.

Mapping (ours, fixed so that the DuckDB oracle can repeat it exactly):

* orders: status F -> Delivered, P -> Cancelled, O -> Processing when
  ``o_orderpriority < '3'`` else Shipped; payment_method = o_orderpriority;
  order_total = o_totalprice as DECIMAL(18,2); coupon_used = o_orderkey % 2.
  channel (c_mktsegment) and country (region name) come from the customer,
  and are joined only by the operators that need them (``orders_geo``),
  from a lookup with one row per customer id.
* order_items: quantity = l_quantity, unit_price = extendedprice / quantity
  (NULL for a zero quantity),
  discount_pct = l_discount as DECIMAL(5,4),
  line_total = extendedprice as DECIMAL(18,2) * (1 - discount_pct);
  ship_date, which no documented line has, spares a second look at the lines.
* products: category = p_type, brand = p_brand, selling_price = p_retailprice,
  cost_price = 0.6 * selling_price, stock_quantity = (p_size - 1) * 2,
  rating = 3.0 + (p_size % 21) / 10, is_active = p_size % 4 <> 0.
* customers: email = name + '@example.com', city = nation, country = region,
  age_group = c_mktsegment, gender = custkey % 3, acquisition_channel =
  custkey % 6.
* returns: every line with l_returnflag = 'R'; reason =
  l_linenumber, return_date = l_shipdate, refund = line_total,
  return_status = l_linestatus.
* deliveries: delivery_date = max(l_shipdate) of the order, Delivered only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerlens.sources import schema as S


@dataclass(eq=False)
class Tables:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame
    returns: DataFrame
    # (customer_id, channel, country) when orders do not carry them.
    customer_geo: DataFrame | None = None
    # (order_id, max ship date) when orders do not carry delivery_date.
    deliveries: DataFrame | None = None

    @property
    def spark(self) -> SparkSession:
        return self.orders.sparkSession

    def register_views(self, prefix: str = "") -> None:
        """SRC2: expose the logical tables as temporary views for
        ``spark.sql`` users (``customers``, ``products``, ``orders``,
        ``order_items``, ``returns``)."""
        for name in ("customers", "products", "orders", "order_items", "returns"):
            getattr(self, name).createOrReplaceTempView(f"{prefix}{name}")

    def orders_geo(self) -> DataFrame:
        """Orders with channel and country (joined on demand)."""
        if "channel" in self.orders.columns and "country" in self.orders.columns:
            return self.orders
        return self.orders.join(self.customer_geo, "customer_id", "left")

    def orders_delivery(self) -> DataFrame:
        """Orders with delivery_date (set for Delivered orders only)."""
        if "delivery_date" in self.orders.columns:
            return self.orders
        return (self.orders.join(self.deliveries, "order_id", "left")
                .withColumn("delivery_date",
                            F.when(F.col("status") == "Delivered",
                                   F.col("ship_date")))
                .drop("ship_date"))


def order_status(status: Column, priority: Column) -> Column:
    return (F.when(status == "F", F.lit("Delivered"))
            .when(status == "P", F.lit("Cancelled"))
            .when(status == "O",
                  F.when(priority < "3", F.lit("Processing")).otherwise(F.lit("Shipped"))))


def line_total(extendedprice: Column, discount: Column) -> Column:
    return extendedprice.try_cast(S.MONEY) * (F.lit(1) - discount.try_cast("decimal(5,4)"))


def load_tables(spark: SparkSession, sf_dir: str) -> Tables:
    """Build the logical tables over ``{sf_dir}/{name}.parquet``.

    Numeric casts are ``try_cast``: a value with no decimal / integer form
    (NaN, overflow) becomes NULL, which the quality checks then report,
    instead of failing every query under ANSI mode."""

    def rd(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    # Nations are a handful, so they travel as one value, looked up only where a
    # query reads city or country; other queries on customers join nothing.
    nations = (rd("nation").join(rd("region"), F.col("n_regionkey") == F.col("r_regionkey"), "left")
               .filter(F.col("n_nationkey").isNotNull()).groupBy("n_nationkey").agg(F.min(F.struct("n_name", "r_name")).alias("n"))
               .agg(F.map_from_entries(F.collect_list(F.struct("n_nationkey", "n")))).scalar())

    def nation(field: str) -> Column:
        return F.try_element_at(nations, F.col("c_nationkey"))[field]

    c = rd("customer")
    customers = c.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("first_name"),
        F.col("c_mktsegment").alias("last_name"),
        F.concat(F.col("c_name"), F.lit("@example.com")).alias("email"),
        nation("n_name").alias("city"),
        nation("n_name").alias("state"),
        nation("r_name").alias("country"),
        (F.col("c_custkey") % 6).cast("string").alias("acquisition_channel"),
        F.col("c_mktsegment").alias("age_group"),
        (F.col("c_custkey") % 3).cast("string").alias("gender"),
    )
    # One row per customer id (deterministic min on a duplicated id), so
    # joining it never multiplies orders; hash-partitioned on customer_id,
    # which is what the join needs anyway.
    customer_geo = customers.groupBy("customer_id").agg(
        F.min("age_group").alias("channel"), F.min("country").alias("country"))

    o = rd("orders")
    orders = o.select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        order_status(F.col("o_orderstatus"), F.col("o_orderpriority")).alias("status"),
        F.col("o_orderpriority").alias("payment_method"),
        F.col("o_totalprice").try_cast(S.MONEY).alias("order_total"),
        (F.col("o_orderkey") % 2).cast("short").alias("coupon_used"),
    )

    li = rd("lineitem")
    order_items = li.select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_quantity").try_cast("int").alias("quantity"),
        F.try_divide(F.col("l_extendedprice"), F.col("l_quantity")).alias("unit_price"),
        F.col("l_discount").try_cast("decimal(5,4)").alias("discount_pct"),
        line_total(F.col("l_extendedprice"), F.col("l_discount")).alias("line_total"),
        F.to_date("l_shipdate").alias("ship_date"),
    )

    returns = li.filter(F.col("l_returnflag") == "R").select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("return_id"),
        F.col("l_orderkey").alias("order_id"),
        F.to_date("l_shipdate").alias("return_date"),
        F.col("l_linenumber").cast("string").alias("reason"),
        line_total(F.col("l_extendedprice"), F.col("l_discount")).alias("refund_amount"),
        F.col("l_linestatus").alias("return_status"),
    )

    deliveries = li.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.max(F.to_date("l_shipdate")).alias("ship_date"))

    p = rd("part")
    price = F.col("p_retailprice").try_cast(S.MONEY)
    products = p.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        F.col("p_brand").alias("brand"),
        price.alias("selling_price"),
        (price * F.lit(0.6).cast("decimal(2,1)")).alias("cost_price"),
        ((F.col("p_size") - 1) * 2).alias("stock_quantity"),
        (F.lit(3.0).cast("decimal(2,1)") + (F.col("p_size") % 21).cast("decimal(10,0)")
         / F.lit(10)).cast("decimal(3,1)").alias("rating"),
        F.when(F.col("p_size") % 4 != 0, 1).otherwise(0).cast("short").alias("is_active"),
    )

    return Tables(customers=customers, products=products, orders=orders,
                  order_items=order_items, returns=returns,
                  customer_geo=customer_geo, deliveries=deliveries)


#: The column of a line as it stood, on lines that do not fit their schema.
BAD_LINE = "_bad_line"


def _csv(spark: SparkSession, path: str, schema: StructType, check_header: bool = True) -> DataFrame:
    """A CSV file with a header row, malformed lines kept whole in BAD_LINE.

    Every column is parsed, whatever a query reads: otherwise it would depend on
    the query whether a line counts as malformed."""
    full = StructType([*schema.fields, StructField(BAD_LINE, StringType())])
    df = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
          .option("columnNameOfCorruptRecord", BAD_LINE).option("dateFormat", "yyyy-MM-dd")
          .option("escape", '"').option("enforceSchema", not check_header).csv(path))
    # Always true, and in need of every column.
    return df.filter(F.size(F.array(*[F.isnull(f"`{c}`") for c in schema.fieldNames()])) > 0)


def _sound(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def _rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(BAD_LINE).isNotNull())


def load_csv_tables(spark: SparkSession, data_dir: str) -> Tables:
    """SRC1: the documented CSV layout (header row, explicit schemas).

    Lines with too few or too many fields, or with a value that is not of its
    column's type, are no rows of the tables; ``csv_rejects`` lists them and
    ``csv_gate`` counts them.  A header that names other columns is an error."""
    frames = {name: _sound(_csv(spark, f"{data_dir}/{name}.csv", schema)) for name, schema in S.TABLE_SCHEMAS.items()}
    return Tables(**frames)


def csv_rejects(spark: SparkSession, data_dir: str) -> DataFrame:
    """The lines that ``load_csv_tables`` leaves out, whole: table_name, file, line."""
    out = None
    for name, schema in S.TABLE_SCHEMAS.items():
        bad = _rejected(_csv(spark, f"{data_dir}/{name}.csv", schema).withColumn("file", F.input_file_name()))
        bad = bad.select(F.lit(name).alias("table_name"), "file", F.col(BAD_LINE).alias("line"))
        out = bad if out is None else out.unionByName(bad)
    return out


def csv_gate(spark: SparkSession, data_dir: str, max_share: float = 0.0) -> DataFrame:
    """Per table the lines read, those rejected, and whether the share of
    rejected ones is at most ``max_share`` (none may be, by default): table_name,
    lines, rejected, passed."""
    out = None
    for name, schema in S.TABLE_SCHEMAS.items():
        row = _csv(spark, f"{data_dir}/{name}.csv", schema).agg(F.count(F.lit(1)).alias("lines"), F.count(BAD_LINE).alias("rejected"))
        row = row.select(F.lit(name).alias("table_name"), "lines", "rejected",
                         (F.col("rejected") <= F.lit(max_share) * F.col("lines")).alias("passed"))
        out = row if out is None else out.unionByName(row)
    return out.orderBy("table_name")


def read_csv(spark: SparkSession, path: str, schema: StructType | str, label_col: str | None = None,
             rejects: bool = False) -> DataFrame:
    """SRC1 / SRC4: one CSV file with a header row and an explicit schema.
    A written row label (pandas ``index_col=0``) is an ordinary first column;
    ``label_col`` names it.  Malformed lines are no rows; with ``rejects`` they
    are the result, as a column ``line``."""
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    if label_col is not None:  # the file's own name of that column is empty or another
        schema = StructType([StructField(label_col, schema.fields[0].dataType), *schema.fields[1:]])
    df = _csv(spark, path, schema, check_header=False)
    return _rejected(df).select(F.col(BAD_LINE).alias("line")) if rejects else _sound(df)


def read_metrics_json(spark: SparkSession, path: str) -> DataFrame:
    """SRC5: the churn-metrics JSON document (one multi-line object)."""
    return spark.read.schema(S.CHURN_METRICS).option("multiLine", True).json(path)
