"""Scoring requests.

Request shape (JSON):
  {"request_id"?, "snapshot_date"?, "xdays"?,
   "customers": [{"CustomerID": .., "transactions":
       [{"Arrival Date": .., "Total Revenue USD": .., "Channel"?: ..}]}]}
or a bare list of customers.

``request_id`` is the key of a request inside the engine: where it came from
(file and byte offset, or what the caller of ``parse_requests`` names), so equal
bodies and reused ids stay apart. The id in the body is ``caller_id``, data.
What cannot be read is not dropped: ``error`` says why a request has no rows,
``rejected_visits`` lists unreadable visits. A request is one JSON record; its
size is bounded by what one record can hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import config as C

TXN_TYPE = T.StructType([
    T.StructField("Arrival Date", T.StringType(), True),
    T.StructField("Total Revenue USD", T.DoubleType(), True),
    T.StructField("Channel", T.StringType(), True),
])
CUSTOMER_TYPE = T.StructType([
    T.StructField("CustomerID", T.StringType(), True),
    T.StructField("transactions", T.ArrayType(TXN_TYPE), True),
])
CORRUPT = "_corrupt_record"
REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType(), True),
    T.StructField("snapshot_date", T.StringType(), True),
    T.StructField("xdays", T.LongType(), True),
    T.StructField("customers", T.ArrayType(CUSTOMER_TYPE), True),
    T.StructField(CORRUPT, T.StringType(), True),
])


def read_requests(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Request files, one JSON record per line or (``multiline``) one
    per file: requests or bare customer lists."""
    if multiline:
        lines = spark.read.text(path, wholetext=True).select("value", F.concat("_metadata.file_path", F.lit("#0")).alias("source_key"))
    else:
        lines = with_source_key(source_lines(spark.read.option("lineSep", "\n").text(path)))
    return parse_requests(lines, "value", "source_key")


def source_lines(text: DataFrame) -> DataFrame:
    """(value, file_path, file_range) of a frame read as text with a line feed
    as the separator; works on a stream."""
    return text.select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_range"))


def with_source_key(lines: DataFrame) -> DataFrame:
    """``source_lines`` with ``source_key``: the file and the byte at which the
    line starts. It depends on the file alone, not on how files are cut, packed
    into tasks or dealt into batches, so a replay gives a record the same key.
    Lines are placed in their range, and ranges by the bytes of those before."""
    placed = lines.withColumn("_place", F.monotonically_increasing_id()).withColumn("_size", F.octet_length("value") + F.lit(1).cast("long"))
    before = lambda w: F.coalesce(F.sum("_size").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    local = placed.withColumn("_at", before(Window.partitionBy("file_path", "file_range").orderBy("_place")))
    ranges = lines.groupBy("file_path", "file_range").agg(F.sum(F.octet_length("value") + F.lit(1).cast("long")).alias("_size"))
    starts = ranges.select("file_path", "file_range", before(Window.partitionBy("file_path").orderBy("file_range")).alias("_start"))
    offset = (F.col("_start") + F.col("_at")).cast("string")
    return (local.join(starts, ["file_path", "file_range"])
            .select(F.regexp_replace("value", "\r$", "").alias("value"), F.concat_ws("#", "file_path", offset).alias("source_key")))


def parse_requests(bodies: DataFrame, body_col: str = "body", key: str | None = None) -> DataFrame:
    """S4 on a column of JSON strings (e.g. a message stream). ``key``: a
    column that is unique per record (a message offset); without one a row
    number is used. Blank lines are left out."""
    body = F.col(body_col)
    bodies = bodies.where(F.length(F.trim(body)) > 0)
    is_list = F.ltrim(body).startswith("[")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    p = bodies.select(
        (F.col(key).cast("string") if key else F.monotonically_increasing_id().cast("string")).alias("request_id"),
        body.alias("body"), is_list.alias("_list"),
        F.when(~is_list, F.from_json(body, REQUEST_SCHEMA, options)).alias("r"),
        F.when(is_list, F.from_json(body, T.ArrayType(CUSTOMER_TYPE))).alias("l"))
    customers = F.when(F.col("_list"), F.col("l")).otherwise(F.col("r.customers"))
    broken = F.when(F.col("_list"), F.col("l").isNull()).otherwise(F.col("r").isNull() | F.col(f"r.{CORRUPT}").isNotNull())
    return p.select("request_id", F.col("r.request_id").alias("caller_id"), F.col("r.snapshot_date").alias("snapshot_date"),
                    F.col("r.xdays").alias("xdays"), F.when(~broken, customers).alias("customers"),
                    F.when(broken, F.lit("not a request")).alias("error"), "body")


def request_defaults(df: DataFrame, snapshot: str | None = None, xdays: int | None = None,
                     zero_is_missing: bool = True, config: dict | None = None) -> DataFrame:
    """Per-request snapshot and horizon, else the given ones, else those
    stored with the models (``config``), else the constants. The main handler
    treats xdays = 0 as 'not given' (T11); the lenient one keeps it. A snapshot
    that is given but unreadable is an error of the request."""
    config = config or {}
    snapshot = snapshot or config.get("snapshot_date") or C.DEFAULT_SNAPSHOT
    xdays = int(xdays or config.get("xdays") or C.DEFAULT_XDAYS)
    x = F.col("xdays")
    xd = F.when(x.isNull() | (x == 0), F.lit(xdays)) if zero_is_missing else F.when(x.isNull(), F.lit(xdays))
    given = F.expr("try_cast(snapshot_date as timestamp_ntz)")
    out = (df.withColumn("snapshot_ts", F.when(F.col("snapshot_date").isNull(), F.lit(snapshot).cast("timestamp_ntz")).otherwise(given))
           .withColumn("xdays", xd.otherwise(x).cast("long")))
    bad = F.col("snapshot_date").isNotNull() & F.col("snapshot_ts").isNull()
    error = F.when(bad, F.lit("unreadable snapshot_date"))
    return out.withColumn("error", F.coalesce("error", error) if "error" in df.columns else error)


def _visits(requests: DataFrame) -> DataFrame:
    ok = requests.where(F.col("error").isNull()) if "error" in requests.columns else requests
    caller = ["caller_id"] if "caller_id" in requests.columns else []
    c = ok.select("request_id", *caller, "snapshot_ts", "xdays", F.explode("customers").alias("c"))
    t = c.select("request_id", *caller, "snapshot_ts", "xdays", F.col("c.CustomerID").alias("customer_id"),
                 F.posexplode("c.transactions").alias("pos", "t"))
    return t.select(
        "request_id", *caller, "snapshot_ts", "xdays", "customer_id",
        F.xxhash64("request_id", "customer_id", "pos", F.to_json("t")).alias("txn_id"),
        F.expr("try_cast(t.`Arrival Date` as timestamp_ntz)").alias("arrival_ts"),
        F.col("t.`Arrival Date`").alias("arrival_text"),
        F.col("t.`Total Revenue USD`").cast("double").alias("revenue"),
        F.coalesce(F.col("t.Channel"), F.lit(C.UNKNOWN_GROUP)).alias("channel"),
    )


def flatten_requests(requests: DataFrame) -> DataFrame:
    """Customers x transactions -> one row per readable visit; a missing
    Channel becomes 'Unknown'. Works unchanged on a streaming frame."""
    return _visits(requests).where(F.col("arrival_ts").isNotNull()).drop("arrival_text")


def rejected_visits(requests: DataFrame) -> DataFrame:
    """The visits that ``flatten_requests`` leaves out: no readable date."""
    return (_visits(requests).where(F.col("arrival_ts").isNull())
            .select("request_id", "customer_id", "arrival_text", F.lit("unreadable Arrival Date").alias("error")))


def rejected_requests(requests: DataFrame) -> DataFrame:
    """Requests that have no rows because they cannot be read."""
    return requests.where(F.col("error").isNotNull()).select("request_id", "caller_id", "error", "body")
