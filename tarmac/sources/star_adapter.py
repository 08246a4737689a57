"""Bronze delay records derived from the driver's star schema.

The driver data has no airline table, so monthly delay records are built
from shipping lines: the grain is (ship year, ship month, supplier nation
as carrier, customer nation as airport). Codes carry stray spaces and mixed
case on purpose so that staging has something to normalise.

Plan shape, chosen for very large ``lineitem``/``orders``:

* every scan is projected to the few columns used, so parquet reads only
  those (``ReadSchema``);
* ``orders`` is joined to ``customer`` first, reducing it to
  (order key, customer nation) before it meets ``lineitem``;
* the grain aggregation groups by integer nation keys and runs partial
  (map-side) aggregation, so a hot nation pair, a hot supplier or a hot
  month collapses inside each task before the shuffle; only the aggregate
  rows (months x nations^2) are shuffled for the final merge;
* nation names are attached after the aggregation, to at most
  months x 625 rows, by broadcasting the nation table once its row count
  is checked;
* join strategies are left to the planner: small sides are broadcast only
  when their measured size is under the broadcast threshold (statically
  from file statistics or at runtime by AQE); large sides shuffle, and AQE
  splits skewed join partitions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tarmac.operators.broadcast import bounded_broadcast
from tarmac.schemas import BRONZE_DECIMAL, CSV_COLUMNS
from tarmac.sources.tables import read_table

# Fixed values of the adapter (part of the data contract, see SURVEY §7.3).
DELAYED_FLAG = "R"
CANCELLED = ("A", "F")  # (returnflag, linestatus)
DIVERTED = ("A", "O")
CAUSE_LINES = {
    "carrier": (1, 2),
    "weather": (3,),
    "nas": (4, 5),
    "security": (6,),
    "late_aircraft": (7,),
}
RELOAD_YEAR = 1998
NATION_BROADCAST_ROWS = 10_000
RELOAD_SHIFT_DAYS = 4000


def _cents(c: Column) -> Column:
    """Exact hundredths as a long: the value rounded to decimal(10,2), unscaled.

    Sums of longs stay in primitive aggregation buffers; a sum over
    decimal(10,2) has type decimal(20,2), above the 18 digits Spark keeps in
    a long, and would add up arbitrary-precision objects row by row.
    """
    return (c.cast("decimal(10,2)") * 100).cast("long")


def _from_cents(c: Column) -> Column:
    return (c.cast("decimal(20,0)") / 100).cast(BRONZE_DECIMAL)


# Line status codes, derived before the big shuffle (see ``line_grain``).
OTHER, DELAYED, CANCELLED_LINE, DIVERTED_LINE = 0, 1, 2, 3


def _line_status() -> Column:
    flag, status = F.col("l_returnflag"), F.col("l_linestatus")
    return (
        F.when(flag == DELAYED_FLAG, DELAYED)
        .when((flag == CANCELLED[0]) & (status == CANCELLED[1]), CANCELLED_LINE)
        .when((flag == DIVERTED[0]) & (status == DIVERTED[1]), DIVERTED_LINE)
        .otherwise(OTHER)
        .cast("tinyint")
    )


def _delay_cause() -> Column:
    """Index of the delay cause of a delayed line (by line number), else NULL."""
    cause = None
    for i, line_numbers in enumerate(CAUSE_LINES.values()):
        hit = (F.col("l_returnflag") == DELAYED_FLAG) & F.col("l_linenumber").isin(*line_numbers)
        cause = F.when(hit, i) if cause is None else cause.when(hit, i)
    return cause.cast("tinyint")


def line_grain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregated grain keyed by (year, month, supplier nation, customer nation).

    Everything the aggregation needs from a line is reduced to fixed-width
    values (status and cause codes, exact cents) before the line meets
    ``orders``, so the largest shuffle carries no strings.
    """
    li = read_table(
        spark,
        sf_dir,
        "lineitem",
        ["l_orderkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate"],
    ).select(
        "l_orderkey",
        "l_suppkey",
        _line_status().alias("status"),
        _delay_cause().alias("cause"),
        _cents(F.col("l_quantity")).alias("qty_cents"),
        _cents(F.col("l_discount")).alias("disc_cents"),
        "l_shipdate",
    )
    orders = read_table(spark, sf_dir, "orders", ["o_orderkey", "o_custkey"])
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_nationkey"])
    supplier = read_table(spark, sf_dir, "supplier", ["s_suppkey", "s_nationkey"])

    order_nation = orders.join(customer, orders.o_custkey == customer.c_custkey).select(
        "o_orderkey", F.col("c_nationkey").alias("cust_nation")
    )
    lines = (
        li.join(order_nation, li.l_orderkey == order_nation.o_orderkey)
        .join(supplier, li.l_suppkey == supplier.s_suppkey)
        .select(
            F.year("l_shipdate").alias("year"),
            F.month("l_shipdate").alias("month"),
            F.col("s_nationkey").alias("supp_nation"),
            "cust_nation",
            "status",
            "cause",
            "qty_cents",
            "disc_cents",
            F.col("l_shipdate").cast("timestamp").alias("shipped_at"),
        )
    )

    status = F.col("status")
    measures = [
        F.count(F.lit(1)).alias("arr_flights"),
        F.count_if(status == DELAYED).alias("arr_del15"),
        F.count_if(status == CANCELLED_LINE).alias("arr_cancelled"),
        F.count_if(status == DIVERTED_LINE).alias("arr_diverted"),
        F.sum(F.when(status == DELAYED, F.col("qty_cents"))).alias("arr_delay"),
    ]
    cents = ["arr_delay"]
    for i, cause in enumerate(CAUSE_LINES):
        hit = F.col("cause") == i
        measures.append(F.sum(F.when(hit, F.col("disc_cents"))).alias(f"{cause}_ct"))
        measures.append(F.sum(F.when(hit, F.col("qty_cents"))).alias(f"{cause}_delay"))
        cents += [f"{cause}_ct", f"{cause}_delay"]
    measures.append(F.max("shipped_at").alias("_ingested_at"))
    grain = lines.groupBy("year", "month", "supp_nation", "cust_nation").agg(*measures)
    # back to exact decimals once per group (empty filtered sums stay NULL)
    return grain.select(*[_from_cents(F.col(c)).alias(c) if c in cents else F.col(c) for c in grain.columns])


def bronze_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load: one bronze record per grain row, bronze contract types."""
    grain = line_grain(spark, sf_dir)
    # Nation is a fixed lookup; broadcast it behind a row-count check.
    nation = bounded_broadcast(read_table(spark, sf_dir, "nation", ["n_nationkey", "n_name"]), NATION_BROADCAST_ROWS)
    supp_n = nation.select(F.col("n_nationkey").alias("supp_nation"), F.col("n_name").alias("supp_name"))
    cust_n = nation.select(F.col("n_nationkey").alias("cust_nation"), F.col("n_name").alias("cust_name"))
    named = grain.join(supp_n, "supp_nation").join(cust_n, "cust_nation")
    text = {
        "carrier": F.concat(F.lit(" "), F.lower("supp_name"), F.lit(" ")),
        "carrier_name": F.concat(F.col("supp_name"), F.lit(" ")),
        "airport": F.col("cust_name"),
        "airport_name": F.concat(F.lit(" "), F.col("cust_name")),
    }
    cols = []
    for c in CSV_COLUMNS:
        if c in text:
            cols.append(text[c].alias(c))
        elif c in ("year", "month"):
            cols.append(F.col(c).cast("int").alias(c))
        else:
            cols.append(F.col(c).cast(BRONZE_DECIMAL).alias(c))
    cols.append(F.col("_ingested_at").cast("timestamp").alias("_ingested_at"))
    return named.select(*cols)


def reload_batch(first: DataFrame, year: int = RELOAD_YEAR, shift_days: int = RELOAD_SHIFT_DAYS) -> DataFrame:
    """Re-delivery of one year: codes in another spelling, one more flight, later stamp."""
    return first.where(F.col("year") == year).select(
        "year",
        "month",
        F.upper(F.trim("carrier")).alias("carrier"),
        *CSV_COLUMNS[3:6],
        (F.col("arr_flights") + 1).cast(BRONZE_DECIMAL).alias("arr_flights"),
        *CSV_COLUMNS[7:],
        (F.col("_ingested_at") + F.expr(f"INTERVAL {shift_days} DAYS")).alias("_ingested_at"),
    )


def bronze_from_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze as it stands after the first load and one re-delivered year.

    The re-delivered copy is produced by exploding the aggregated first load
    (copy 0 for every row, copy 1 for rows of the reloaded year), so the
    star tables are scanned and aggregated once, not once per batch.
    """
    return with_redelivery(bronze_batch(spark, sf_dir))


def with_redelivery(first: DataFrame) -> DataFrame:
    """``first`` plus the re-delivered year (see ``reload_batch``), in one pass."""
    copies = first.withColumn(
        "_copy",
        F.explode(F.when(F.col("year") == RELOAD_YEAR, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    )
    again = F.col("_copy") == 1
    shift = F.expr(f"INTERVAL {RELOAD_SHIFT_DAYS} DAYS")
    return copies.select(
        "year",
        "month",
        F.when(again, F.upper(F.trim("carrier"))).otherwise(F.col("carrier")).alias("carrier"),
        *CSV_COLUMNS[3:6],
        F.when(again, F.col("arr_flights") + 1).otherwise(F.col("arr_flights")).cast(BRONZE_DECIMAL).alias("arr_flights"),
        *CSV_COLUMNS[7:],
        F.when(again, F.col("_ingested_at") + shift).otherwise(F.col("_ingested_at")).alias("_ingested_at"),
    )
