"""Raw invoice lines built from the star-schema tables (lineitem, orders, part, customer, nation).

Mapping of one lineitem row to one source line:

* ``InvoiceNo``  = ``'C'`` for returned lines (``l_returnflag = 'R'``), then the order key
* ``StockCode``  = part key, ``Description`` = part name, ``UnitPrice`` = part retail price
* ``Quantity``   = line quantity, negated for returned lines
* ``InvoiceDate``= order date, ``CustomerID`` = customer key, ``Country`` = nation name
* ``arrival_ts`` = ship date (when the line reaches the lake), ``line_no`` = line number

Join order for scale: the dimension chain ``customer -> nation`` is joined to
``orders`` first (orders is a quarter of lineitem), lineitem is joined to
``part`` and then to that result on the order key. Nation is tiny and Spark
broadcasts it from its size estimate; customer and part are joined by shuffle
unless they are small by estimate or AQE finds them small at run time. Only the
needed columns are read (column pruning reaches the scan).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType, TimestampType

from orderlake.sources.schemas import SOURCE_LINE_COLUMNS

# Raw invoice-line export (e.g. a CSV copy of the source workbook). Ids are read as
# text so a missing customer never turns ``17850`` into ``17850.0``.
SOURCE_LINE_SCHEMA = StructType(
    [
        StructField("InvoiceNo", StringType()),
        StructField("StockCode", StringType()),
        StructField("Description", StringType()),
        StructField("Quantity", DoubleType()),
        StructField("InvoiceDate", TimestampType()),
        StructField("UnitPrice", DoubleType()),
        StructField("CustomerID", StringType()),
        StructField("Country", StringType()),
    ]
)

# Extra attributes carried next to each line; Catalyst prunes them when unused.
LINE_ATTRIBUTES = [
    "order_priority",
    "order_status_code",
    "market_segment",
    "part_size",
    "line_status",
    "discount",
    "tax",
]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_invoice_lines(
    spark: SparkSession,
    path: str,
    fmt: str = "csv",
    timestamp_format: str = "yyyy-MM-dd HH:mm:ss",
) -> DataFrame:
    """Raw invoice lines from files, with an explicit schema, projected to the 8 source columns.

    CSV needs a header; any other Spark file format (parquet, orc, json) works too.
    Unparseable numbers and dates become NULL and are then cleaned like any NULL.
    """
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = (
            reader.option("header", "true")
            .option("mode", "PERMISSIVE")
            .option("timestampFormat", timestamp_format)
            .schema(SOURCE_LINE_SCHEMA)
        )
    return reader.load(path).select(*SOURCE_LINE_COLUMNS)


def retail_lines(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """One source line per lineitem row (S7: 8 source columns plus lineage).

    ``spread`` is for a line table that is stored as one row group, whose scan is a single task: its rows
    are rebalanced over the cluster first. Tables of many files and row groups need no such shuffle.
    """
    lineitem = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_partkey",
        "l_linenumber",
        "l_quantity",
        "l_returnflag",
        "l_linestatus",
        "l_discount",
        "l_tax",
        "l_shipdate",
    )
    if spread:
        lineitem = lineitem.hint("rebalance")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority", "o_orderstatus"
    )
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice", "p_size")

    customers = customer.join(nation, customer.c_nationkey == nation.n_nationkey)
    placed = orders.join(customers, orders.o_custkey == customers.c_custkey)
    # lineitem meets part first: a small part table is broadcast by its size
    # estimate and lineitem streams through it; the big lineitem x orders join is a
    # shuffle join on the order key, which AQE turns into a broadcast at run time
    # only when the orders side turns out small.
    priced = lineitem.join(part, lineitem.l_partkey == part.p_partkey)
    joined = priced.join(placed, priced.l_orderkey == placed.o_orderkey)

    returned = F.col("l_returnflag") == F.lit("R")
    return joined.select(
        F.concat(F.when(returned, F.lit("C")).otherwise(F.lit("")), F.col("l_orderkey").cast("string")).alias(
            "InvoiceNo"
        ),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.when(returned, -F.col("l_quantity")).otherwise(F.col("l_quantity")).alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("p_retailprice").alias("UnitPrice"),
        F.col("o_custkey").cast("string").alias("CustomerID"),
        F.col("n_name").alias("Country"),
        F.col("l_shipdate").alias("arrival_ts"),
        F.col("l_linenumber").alias("line_no"),
        F.col("o_orderpriority").alias("order_priority"),
        F.col("o_orderstatus").alias("order_status_code"),
        F.col("c_mktsegment").alias("market_segment"),
        F.col("p_size").alias("part_size"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_discount").alias("discount"),
        F.col("l_tax").alias("tax"),
    )
