"""Landing-shaped sales and stores derived from the TPC-H-like tables.

Every ``orders`` row becomes one sale, every ``customer`` row one store
record, so the work grows with the input tables. A fixed share of rows
is made malformed (by ``o_orderkey % 140``) to exercise each rejection
reason; no row is dropped.
"""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.parse import md5_uuid
from ledgerline.sources.landing import BINARY_FILE, shared_listing

# --- fixed values: fixture recipe (also spelled out in FIXTURES.md §4) ---
N_STORES = 50
MALFORMED_MOD = 140
TIME_SUFFIX = "T101530.250"
#: Order keys of a month's file: a month has more files as the input grows.
ORDERS_PER_FILE = 1_000_000
#: Threads of the driver that give the landing files their names.
RENAMERS = 16
RUN_TS = "2024-01-31 06:00:00"
RUN_DATE = "2024-01-31"


def run_ts_lit(run_ts: str | dt.datetime = RUN_TS) -> Column:
    return F.lit(str(run_ts)).cast("timestamp_ntz")


def _d8(col: str) -> Column:
    return F.replace(F.col(col).cast("date").cast("string"), F.lit("-"), F.lit(""))


def store_token_of(custkey: Column) -> Column:
    return md5_uuid(F.concat(F.lit("s"), (custkey % N_STORES).cast("string")))


def sales_landing(orders: DataFrame, keep_key: bool = False) -> DataFrame:
    """The six landing text fields plus ``batch_date`` (month of the
    order date) and ``source_file``; malformed per ``o_orderkey % 140``."""
    m = F.col("o_orderkey") % MALFORMED_MOD
    d8 = _d8("o_orderdate")
    batch = F.concat(F.substring(d8, 1, 6), F.lit("01"))

    def bad(k: int, good: Column, broken: Column) -> Column:
        return F.when(m == k, broken).otherwise(good)

    return orders.select(
        bad(1, store_token_of(F.col("o_custkey")), F.lit("not-a-uuid")).alias("store_token"),
        bad(2, md5_uuid(F.concat(F.lit("t"), F.col("o_orderkey").cast("string"))),
            F.lit("ZZZ")).alias("transaction_id"),
        bad(3, F.concat(F.lit("R"), F.lpad(F.col("o_orderkey").cast("string"), 9, "0")),
            F.lit("ab")).alias("receipt_token"),
        bad(4, F.concat(d8, F.lit(TIME_SUFFIX)), F.lit("not-a-timestamp"))
        .alias("transaction_time"),
        F.when(m == 5, F.lit("€5")).when(m == 6, F.lit("$-5.00"))
        .otherwise(F.concat(F.lit("$"),
                            F.col("o_totalprice").cast("decimal(11,2)").cast("string")))
        .alias("amount"),
        bad(7, F.col("o_orderpriority"), F.repeat(F.lit("X"), 50)).alias("user_role"),
        batch.alias("batch_date"),
        F.concat(F.lit("sales_"), batch, F.lit("_"),
                 F.floor(F.col("o_orderkey") / ORDERS_PER_FILE).cast("string"), F.lit(".csv"))
        .alias("source_file"),
        *([F.col("o_orderkey")] if keep_key else []),
    )


def current_from_landing(landing: DataFrame, run_ts=RUN_TS) -> DataFrame:
    ts = run_ts_lit(run_ts)
    return landing.drop("o_orderkey").select(
        "*",
        ts.alias("ingested_at"),
        ts.alias("dbt_updated_at"),
        ts.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("dbt_valid_to"),
    )


def stores_landing(customer: DataFrame, keep_key: bool = False) -> DataFrame:
    """One store record per customer: store ``c_custkey % 50``, named after
    the customer, delivered in the daily file ``c_custkey div 50``. Some
    records carry a bad token (% 101 = 17), group (% 97 = 13), an
    over-long name (% 89 = 7) or a name with a comma and quotes (% 83 = 11)."""
    k = F.col("c_custkey")
    good_token = store_token_of(k)
    token = F.when(k % 101 == 17, F.lit("not-a-uuid")).otherwise(good_token)
    group = F.upper(F.substring(F.md5(good_token), 1, 8))
    day = F.date_add(F.lit("2024-01-01").cast("date"),
                     (F.col("c_custkey") / N_STORES).cast("int"))
    d8 = F.replace(day.cast("string"), F.lit("-"), F.lit(""))
    return customer.select(
        F.when(k % 97 == 13, F.lit("zzzzzzzz")).otherwise(group).alias("store_group"),
        token.alias("store_token"),
        F.when(k % 89 == 7, F.repeat(F.lit("N"), 201))
        .when(k % 83 == 11, F.concat(F.col("c_name"), F.lit(', Ltd "HQ"')))
        .otherwise(F.col("c_name")).alias("store_name"),
        d8.alias("batch_date"),
        F.concat(F.lit("stores_"), d8, F.lit(".csv")).alias("source_file"),
        *([F.col("c_custkey")] if keep_key else []),
    )


# --- fixed values: three snapshot runs for the SCD2 scenarios ---
RUN_STAMPS = {1: "2024-02-01 06:00:00", 2: "2024-02-02 06:00:00", 3: "2024-02-03 06:00:00"}


def sales_run_from(landing_k: DataFrame, run: int) -> DataFrame:
    """Landing sales of snapshot run 1, 2 or 3.

    Run 1 delivers every sale. Run 2 re-delivers only the batches before
    1998 (keys of later batches are absent and stay as they are), with a new
    ``user_role`` for ``o_orderkey % 5 = 1``. Run 3 re-delivers everything:
    ``% 5 = 1`` as in run 2 (no change for re-sent keys), ``% 5 = 2`` with a
    new ``receipt_token``.
    """
    land = landing_k
    m = F.col("o_orderkey") % 5
    if run >= 2:
        land = land.withColumn("user_role", F.when(m == 1, F.concat(F.lit("V2-"), "user_role"))
                               .otherwise(F.col("user_role")))
    if run == 2:
        land = land.where(F.col("batch_date") < "19980101")
    if run == 3:
        land = land.withColumn("receipt_token",
                               F.when(m == 2, F.concat("receipt_token", F.lit("b")))
                               .otherwise(F.col("receipt_token")))
    return land.drop("o_orderkey")


def stores_run_from(stores_k: DataFrame, run: int) -> DataFrame:
    """Landing stores of snapshot run 1 (file days 0-9), 2 (10-19) or
    3 (20 and later); every store record belongs to exactly one run."""
    land = stores_k
    day = (F.col("c_custkey") / N_STORES).cast("int")
    run_of = F.least(F.lit(3), (day / 10).cast("int") + 1)
    return land.where(run_of == run).drop("c_custkey")


# --- odd spellings of a time and of an amount (text, or the given column) ---

def TIME_FORMS(day) -> list[tuple]:
    return [(day, "T101530.250"), ("\t", day, "T101530.25"), (" ", day, "T101530.2 \n"), (day, "T10153.5"),
            (day, "T1015.5"), (day, "T101530"), (day, "t101530.250"), (day, "T241530.250"), (day, "T101560.250"),
            (day, "T101530.1234567"), (day, " T101530.250")]


def AMOUNT_FORMS(cents) -> list[tuple]:
    return [("$", cents), ("$1_", cents), ("1__", cents), ("_", cents), (cents, "_"), (" ", cents, "\t"),
            ("$-", cents), (cents, "e1"), ("+", cents), ("$,", cents), (cents, " 0"), ("--", cents), ("€", cents)]


def pick(k: Column, forms: list[Column]) -> Column:
    out = F.lit(None).cast("string")
    for i, form in enumerate(forms):
        out = F.when(k == i, form).otherwise(out)
    return out


# ------------------------------------------------------- landing CSV files ---

def csv_field(c: Column) -> Column:
    """RFC 4180 field: quoted (with doubled quotes) when it holds a comma,
    quote or line break; NULL becomes an empty field."""
    raw = F.coalesce(c, F.lit(""))
    needs = raw.rlike('[",\r\n]')
    quoted = F.concat(F.lit('"'), F.replace(raw, F.lit('"'), F.lit('""')), F.lit('"'))
    return F.when(needs, quoted).otherwise(raw)


def csv_line(cols: list[str]) -> Column:
    return F.concat_ws(",", *[csv_field(F.col(c)) for c in cols])


def landing_lines_from(sales: DataFrame, stores: DataFrame) -> DataFrame:
    """(file, line_no, line) for every landing file: one line per record,
    a header line in some files (sales: odd months; stores: even days) and
    malformed lines with a wrong field count (orders % 140 = 8 or 9,
    customers % 113 = 5), which a reader must skip."""
    from ledgerline import constants as C

    s_lines = sales.select(F.col("source_file").alias("file"),
                           F.col("o_orderkey").alias("line_no"),
                           csv_line(C.SALES_COLUMNS).alias("line"))
    s_bad = sales.where((F.col("o_orderkey") % MALFORMED_MOD).isin(8, 9)).select(
        F.col("source_file").alias("file"),
        (-F.col("o_orderkey") - 2).alias("line_no"),
        F.when(F.col("o_orderkey") % MALFORMED_MOD == 8, F.lit("only,two"))
        .otherwise(F.lit("a,b,c,d,e,f,g")).alias("line"))
    s_head = (sales.select(F.col("source_file").alias("file"), "batch_date").distinct()
              .where(F.substring("batch_date", 6, 1).cast("int") % 2 == 1)
              .select("file", F.lit(-1).cast("bigint").alias("line_no"),
                      F.lit(",".join(C.SALES_COLUMNS)).alias("line")))
    t_lines = stores.select(F.col("source_file").alias("file"),
                            F.col("c_custkey").alias("line_no"),
                            csv_line(C.STORE_COLUMNS).alias("line"))
    t_bad = stores.where(F.col("c_custkey") % 113 == 5).select(
        F.col("source_file").alias("file"), (-F.col("c_custkey") - 2).alias("line_no"),
        F.lit("w,x,y,z").alias("line"))
    t_head = (stores.select(F.col("source_file").alias("file"), "batch_date").distinct()
              .where(F.substring("batch_date", 8, 1).cast("int") % 2 == 0)
              .select("file", F.lit(-1).cast("bigint").alias("line_no"),
                      F.lit(",".join(C.STORE_COLUMNS)).alias("line")))
    return s_lines.unionByName(s_bad).unionByName(s_head).unionByName(t_lines) \
        .unionByName(t_bad).unionByName(t_head)


def write_landing(spark, orders: DataFrame, customer: DataFrame, root: str) -> str:
    return write_landing_from(spark, sales_landing(orders, keep_key=True),
                              stores_landing(customer, keep_key=True), root)


def write_landing_from(spark, sales_k: DataFrame, stores_k: DataFrame, root: str) -> str:
    """Write the landing files as ``root/<file name>`` (one CSV per name).

    Spark writes one part file per name (rows are hash-partitioned by
    name; a file has a bounded number of rows), which is then renamed to the
    flat landing name. Only file metadata passes through the driver. The
    parts are put into the staging folder by the tasks that wrote them
    (nobody reads it before the job is over), listed by tasks, and renamed
    by several threads.
    """
    lines = landing_lines_from(sales_k, stores_k)
    staging = root.rstrip("/") + "/_staging"
    (lines.repartition("file").sortWithinPartitions("file", "line_no").select("file", "line")
     .write.partitionBy("file").option("mapreduce.fileoutputcommitter.algorithm.version", "2").text(staging))
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def settle(part: str) -> None:
        name = part.rsplit("/", 2)[-2].split("=", 1)[1]
        if not fs.rename(path(part), path(f"{root.rstrip('/')}/{name}")):
            raise OSError(f"could not rename {part}")

    with shared_listing(spark):
        parts = spark.read.format("binaryFile").schema(BINARY_FILE).load(staging).select("path")
    with ThreadPoolExecutor(RENAMERS) as pool:
        list(pool.map(settle, [r[0] for r in parts.collect()]))
    fs.delete(path(staging), True)
    return root
