"""The driver's TPC-H-like tables read as the pipeline's daily inputs.

``pollutant_daily``: lineitem ⋈ supplier ⋈ nation. The region (state) of a
reading is the supplier nation's region, the county is the nation.
``weather_daily``: orders ⋈ customer ⋈ nation, one variable per order priority.
``grid``: every key of the nation dimension × the 12 months of a year.

Join strategy: ``nation`` is a fixed 25-row dimension and is broadcast. The
supplier/customer side is left to Catalyst/AQE, which broadcast it only while
its measured size is under ``spark.sql.(adaptive.)autoBroadcastJoinThreshold``
and otherwise plan a sort-merge join with skew splitting. The fact tables are
pruned to the handful of columns used before the join.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import schema as S
from .functions.stats import in_units, lookup

PRICE_FACTOR = Decimal("0.00001")  # 1 / PRICE_SCALE, exact


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


BROADCAST_MAX_BYTES = 32 * 1024 * 1024


def source_bytes(df: DataFrame) -> int | None:
    """Total size of the files behind a file-source DataFrame (metadata only, no job)."""
    spark = df.sparkSession
    try:
        conf = spark._jsc.hadoopConfiguration()
        total = 0
        for f in df.inputFiles():
            p = spark._jvm.org.apache.hadoop.fs.Path(f)
            total += p.getFileSystem(conf).getFileStatus(p).getLen()
        return total
    except Exception:  # noqa: BLE001 - not a file source: size unknown
        return None


def bounded_broadcast(df: DataFrame, max_bytes: int = BROADCAST_MAX_BYTES) -> DataFrame:
    """Broadcast hint only when the source files are provably small; otherwise
    leave the strategy to Catalyst/AQE (sort-merge join with skew splitting)."""
    n = source_bytes(df)
    return F.broadcast(df) if n is not None and n <= max_bytes else df


def in_years(df: DataFrame, date_col: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows dated in the years ``first`` to ``last``: a half-open range of the raw column, which reaches the scan."""
    t = df.schema[date_col].dataType
    if first is not None:
        df = df.where(F.col(date_col) >= F.lit(f"{first:04d}-01-01").cast(t))
    if last is not None:
        df = df.where(F.col(date_col) < F.lit(f"{last + 1:04d}-01-01").cast(t))
    return df


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The place dimension (25 nations in the driver's tables): broadcast behind a size check.
    return bounded_broadcast(table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("county_code"), F.col("n_regionkey").alias("state_code")))


def _pollutant_readings(spark: SparkSession, sf_dir: str, first: int | None, last: int | None, measures) -> DataFrame:
    """Readings with the measures that ``measures(flag, cents, kept)`` makes of the raw flag, price in cents and percent kept."""
    firsts = sorted({f[0] for f in S.FLAG_TO_POLLUTANT})
    seconds = sorted({f[1:] for f in S.FLAG_TO_POLLUTANT})
    li = (in_years(table(spark, sf_dir, "lineitem"), "l_shipdate", first, last)
          .select("l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_linenumber",
                  "l_returnflag", "l_linestatus", "l_shipdate")
          .where(F.col("l_returnflag").isin(firsts) & F.col("l_linestatus").isin(seconds)))
    sup = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey"), F.col("s_nationkey").alias("county_code"))

    flag = F.concat(F.col("l_returnflag"), F.col("l_linestatus"))
    cents = F.rint(F.col("l_extendedprice") * F.lit(100.0)).cast("long")
    kept = F.lit(100) - F.rint(F.col("l_discount") * F.lit(100.0)).cast("int")
    percent, highest, mean = measures(flag, cents, kept)
    # fact ⋈ supplier first (the one join that may need a shuffle at scale), then
    # the 25-row place dimension as an independent broadcast probe.
    return (li.join(sup, li.l_suppkey == sup.s_suppkey).join(_places(spark, sf_dir), "county_code")
            .where(flag.isin(list(S.FLAG_TO_POLLUTANT)))
            .select(lookup(flag, S.FLAG_TO_POLLUTANT).alias("param"), "state_code", "county_code",
                    F.to_date("l_shipdate").alias("date_local"),
                    F.rint(F.col("l_quantity")).cast("int").alias("observation_count"),
                    percent, highest, F.col("l_linenumber").cast("int").alias("max_hour"), mean))


def pollutant_daily(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """One row per reading: param, state_code, county_code, date_local, five measures; ``first``/``last`` bound the years."""
    def measures(flag, cents, kept):
        # Exact decimal arithmetic from integers (cents, percent kept), never from a
        # double-to-decimal cast: max_value = cents * top / 10^7 and
        # arithmetic_mean = cents * kept% * top / 10^9, with exact per-pollutant factors.
        top = {f: Decimal(str(S.CONCENTRATION_LEVELS[p][-1])) for f, p in S.FLAG_TO_POLLUTANT.items()}
        f10 = lookup(flag, {f: t * PRICE_FACTOR / 100 for f, t in top.items()}).cast("decimal(10,10)")
        f12 = lookup(flag, {f: t * PRICE_FACTOR / 10000 for f, t in top.items()}).cast("decimal(12,12)")
        cents = cents.cast("decimal(10,0)")
        return (kept.cast(S.MEASURE_TYPES["observation_percent"]).alias("observation_percent"),
                (cents * f10).cast(S.MEASURE_TYPES["max_value"]).alias("max_value"),
                (cents * kept.cast("decimal(3,0)") * f12).cast(S.MEASURE_TYPES["arithmetic_mean"]).alias("arithmetic_mean"))

    return _pollutant_readings(spark, sf_dir, first, last, measures)


def pollutant_units(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``pollutant_daily`` with its decimals as long counts of units (``stats.in_units``): the form that is averaged."""
    def measures(flag, cents, kept):
        per_cent = lookup(flag, {f: int(Decimal(str(S.CONCENTRATION_LEVELS[p][-1])) * 1000) for f, p in S.FLAG_TO_POLLUTANT.items()})
        highest = cents * per_cent.cast("long")  # cents * top / 10^7, in units of 10^-10
        return (in_units(kept.cast("long"), 0, "observation_percent"), in_units(highest, 10, "max_value"),
                in_units(highest * kept, 12, "arithmetic_mean"))

    return _pollutant_readings(spark, sf_dir, first, last, measures)


def _weather_readings(spark: SparkSession, sf_dir: str, first: int | None, last: int | None, measure) -> DataFrame:
    orders = (in_years(table(spark, sf_dir, "orders"), "o_orderdate", first, last)
              .select("o_custkey", "o_totalprice", "o_orderdate", "o_orderpriority")
              .where(F.col("o_orderpriority").isin(list(S.PRIORITY_TO_VARIABLE))))
    cust = table(spark, sf_dir, "customer").select(
        F.col("c_custkey"), F.col("c_nationkey").alias("county_code"))
    variable = lookup(F.col("o_orderpriority"), S.PRIORITY_TO_VARIABLE)
    cents = F.rint(F.col("o_totalprice") * F.lit(100.0)).cast("long")
    # the priority filter on the scan already keeps mapped rows only
    return (orders.join(cust, orders.o_custkey == cust.c_custkey).join(_places(spark, sf_dir), "county_code")
            .select(variable.alias("variable"), "state_code", "county_code",
                    F.to_date("o_orderdate").alias("date_local"), measure(cents)))


def weather_daily(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """One row per reading: variable, state_code, county_code, date_local, arithmetic_mean; ``first``/``last`` bound the years."""
    return _weather_readings(spark, sf_dir, first, last, lambda cents: (
        cents.cast("decimal(12,0)") * F.lit(Decimal("0.01"))).cast(S.WEATHER_MEASURE_TYPE).alias("arithmetic_mean"))


def weather_units(spark: SparkSession, sf_dir: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``weather_daily`` with its decimal as a long count of units (``stats.in_units``): the form that is averaged."""
    return _weather_readings(spark, sf_dir, first, last, lambda cents: in_units(cents, 2, "arithmetic_mean"))


def region_keys(spark: SparkSession, sf_dir: str, keys=("state_code",)) -> DataFrame:
    """Distinct keys of the place dimension (bounded by the nation table)."""
    places = table(spark, sf_dir, "nation").select(
        F.col("n_regionkey").alias("state_code"), F.col("n_nationkey").alias("county_code"))
    return places.select(*keys).distinct()


def grid(spark: SparkSession, sf_dir: str, keys=("state_code",), year: int = S.GRID_YEAR) -> DataFrame:
    """Prediction grid: every key × months 1-12 of ``year`` (S3's generator)."""
    return (region_keys(spark, sf_dir, keys)
            .select(*keys, F.explode(F.sequence(F.lit(1), F.lit(12))).alias("month"))
            .withColumn("year", F.lit(year)))
