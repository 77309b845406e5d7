"""The adapter from the test tables to the logical ones, in Spark and, for the check, in SQL; and the registry of queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import period_label, share_of_total
from ..operators import cleaning, demand, pilot, shares
from ..operators.lineage import dealt

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}
DIGITS = 6


def query(sql: str | None = None, doubles: str = "", digits: int = DIGITS):
    """Registers a query and the SQL it is held against.

    Both round the named columns, after adding far less than the last digit, so that sums in another order agree even where
    the true value lies midway between two results.
    """
    cols, nudge, scale = doubles.split(), 3 * 10.0 ** -(digits + 3), 10.0**digits

    def wrap(f: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            # Spark's round() makes a decimal of every value; this is what the SQL's round() does.
            return f(spark, sf_dir).withColumns({c: F.rint((F.col(c) + nudge) * scale) / scale + F.lit(0.0) for c in cols})

        key = f.__name__
        QUERIES[key] = run
        if sql:
            replace = f" REPLACE ({', '.join(f'round({c} + {nudge:.10f}, {digits}) + 0.0 AS {c}' for c in cols)})" if cols else ""
            ORACLE_SQL[key] = f"{sql.split('--FROM--')[0]} SELECT *{replace} FROM ({sql.split('--FROM--')[1]}) q" if "--FROM--" in sql else f"SELECT *{replace} FROM ({sql}) q"
        return f

    return wrap


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sales(spark: SparkSession, d: str) -> DataFrame:
    """Sales facts with their dimensions; returned goods are left out. Dimensions are left to Spark's own broadcast check."""
    line = read(spark, d, "lineitem").where("l_returnflag <> 'R'").select(
        F.to_date("l_shipdate").alias("day"), F.col("l_partkey").alias("sku"), F.col("l_suppkey").alias("store"), F.col("l_quantity").alias("qty"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"), F.when(F.col("l_linestatus") == "O", "ONLINE").otherwise("OFFLINE").alias("channel")
    )
    part = read(spark, d, "part").select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("grp"), F.col("p_brand").alias("brand"), F.substring("p_name", 1, 3).alias("voltage"), F.when(F.col("p_size") % 2 == 0, "S").otherwise("N").alias("mandatory"))
    out = line.join(part, "sku").join(stores(spark, d), "store")
    return out.withColumns({"on_hand": (F.col("sku") * 3 + F.col("store") * 5 + F.unix_date("day")) % 11, "year_month": F.date_format("day", "yyyyMM").cast("int")})


def dealt_sales(spark: SparkSession, d: str, *keys: str) -> DataFrame:
    """sales() dealt out by keys, in as many partitions as there are lines for; lines are counted by the files' footers."""
    return dealt(sales(spark, d), line_count(spark, d), *keys)


def line_count(spark: SparkSession, d: str) -> int:
    return read(spark, d, "lineitem").count()


def stores(spark: SparkSession, d: str) -> DataFrame:
    nation = read(spark, d, "nation").join(read(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("dc"), F.col("r_name").alias("region"), F.col("n_name").alias("dc_name"))
    supplier = read(spark, d, "supplier").select(F.col("s_suppkey").alias("store"), F.col("s_nationkey").alias("dc"), F.concat(F.lit("PORTE "), (F.col("s_suppkey") % 6 + 1).cast("string")).alias("band"))
    return supplier.join(nation, "dc")


SALES = """sales AS (
  SELECT CAST(l_shipdate AS DATE) AS day, l_partkey AS sku, l_suppkey AS store, l_quantity AS qty, l_extendedprice * (1 - l_discount) AS revenue,
    CASE WHEN l_linestatus = 'O' THEN 'ONLINE' ELSE 'OFFLINE' END AS channel, p_type AS grp, p_brand AS brand, substr(p_name, 1, 3) AS voltage,
    CASE WHEN p_size % 2 = 0 THEN 'S' ELSE 'N' END AS mandatory, s_nationkey AS dc, r_name AS region, n_name AS dc_name, 'PORTE ' || CAST(s_suppkey % 6 + 1 AS VARCHAR) AS band,
    (l_partkey * 3 + l_suppkey * 5 + date_diff('day', DATE '1970-01-01', CAST(l_shipdate AS DATE))) % 11 AS on_hand,
    CAST(year(l_shipdate) * 100 + month(l_shipdate) AS INTEGER) AS year_month
  FROM lineitem JOIN part ON p_partkey = l_partkey JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey
  WHERE l_returnflag <> 'R')"""


def panel(spark: SparkSession, d: str) -> DataFrame:
    """One row per group, store and day."""
    missing = F.when((F.col("mandatory") == "S") & (F.col("on_hand") < F.col("qty")), F.col("qty") - F.col("on_hand"))
    return dealt_sales(spark, d, "grp", "store").groupBy("grp", "store", "day", "year_month").agg(F.sum("qty").alias("qty"), F.sum(missing).alias("delta"))


PANEL = f"""{SALES}, panel AS (
  SELECT grp, store, day, year_month, sum(qty) AS qty, sum(CASE WHEN mandatory = 'S' AND on_hand < qty THEN qty - on_hand END) AS delta FROM sales GROUP BY ALL)"""

#: Stores that sell wholesale and outlets, by number.
WHOLESALE, OUTLET = [3, 5], [7]
AS_OF, MONTH = "1998-06-30", 199806
MOVED = {"14": "1", "22": "2", "24": "0"}


def cleaned(spark: SparkSession, d: str) -> DataFrame:
    """The panel without atypical months, clipped."""
    p = panel(spark, d)
    kept = cleaning.filter_atypical_months(p, cleaning.atypical_months(p), MONTH)
    return cleaning.winsorise(kept, special=F.col("store").isin(WHOLESALE))


CLEANED = f"""{PANEL}, monthly AS (SELECT grp, year_month, sum(qty) AS total, count(*) AS n_rows FROM panel GROUP BY ALL),
stats AS (SELECT grp, avg(total) AS mean, stddev_samp(total) AS deviation FROM monthly GROUP BY grp),
atypical AS (SELECT m.grp, m.year_month, m.total, m.n_rows, mean, deviation FROM monthly m JOIN stats s ON s.grp = m.grp
  WHERE deviation IS NOT NULL AND (total < greatest(mean - 2 * deviation, 0.0) OR total > mean + 2 * deviation)),
kept AS (SELECT p.* FROM panel p WHERE NOT EXISTS (SELECT 1 FROM atypical a WHERE a.grp = p.grp AND a.year_month = p.year_month AND a.year_month <> {MONTH})),
bounds AS (SELECT *, avg(qty) OVER (PARTITION BY grp, store) AS m, stddev_samp(qty) OVER (PARTITION BY grp, store) AS sd, CASE WHEN store IN (3, 5) THEN 1.5 ELSE 3.0 END AS k FROM kept),
cleaned AS (SELECT grp, store, day, year_month, CASE WHEN sd IS NULL THEN qty ELSE greatest(least(qty, m + k * sd), greatest(m - k * sd, 0.0)) END AS qty, delta, qty AS qty_raw,
  CASE WHEN sd IS NOT NULL AND greatest(least(qty, m + k * sd), greatest(m - k * sd, 0.0)) <> qty THEN 1 ELSE 0 END AS clipped FROM bounds)"""


def demanded(spark: SparkSession, d: str) -> DataFrame:
    return demand.robust_demand(cleaned(spark, d), outlet=F.col("store").isin(OUTLET))


DEMANDED = f"""{CLEANED}, demanded AS (SELECT *, CASE WHEN delta IS NOT NULL THEN least(delta, 0.3 * qty) END AS suppressed,
  CASE WHEN store = 7 THEN 0.0 ELSE coalesce(qty + CASE WHEN delta IS NOT NULL THEN least(delta, 0.3 * qty) END, qty, 0.0) END AS demand FROM cleaned)"""

WINDOWS = (90, 180, 270, 360)


def measured(spark: SparkSession, d: str, windows: tuple[int, ...] = (90,)) -> DataFrame:
    return demand.rolling_trimmed_mean(demanded(spark, d), windows)


def _measured_sql(windows: tuple[int, ...]) -> str:
    frame = lambda n: f"(PARTITION BY grp, store ORDER BY day ROWS BETWEEN {n} PRECEDING AND CURRENT ROW)"
    bounds = ", ".join(f"quantile_disc(demand, 0.01) OVER {frame(n)} AS lo_{n}, quantile_disc(demand, 0.99) OVER {frame(n)} AS hi_{n}" for n in windows)
    means = ", ".join(f"coalesce(CASE WHEN count(demand) OVER {frame(n)} < 10 THEN avg(demand) OVER {frame(n)} ELSE avg(CASE WHEN demand BETWEEN lo_{n} AND hi_{n} THEN demand END) OVER {frame(n)} END, avg(demand) OVER {frame(n)}, avg(demand) OVER {frame(max(windows))}, 0.0) AS trimmed_{n}" for n in windows)
    return f"{DEMANDED}, banded AS (SELECT *, {bounds} FROM demanded), measured AS (SELECT grp, store, day, demand, {means} FROM banded)"


MEASURED, MEASURED_ALL = _measured_sql((90,)), _measured_sql(WINDOWS)


def centre_map(spark: SparkSession, d: str) -> DataFrame:
    return shares.dc_map(stores(spark, d), MOVED)


CENTRES = """centres AS (SELECT CAST(s_suppkey AS BIGINT) AS store, CASE CAST(s_nationkey AS VARCHAR) WHEN '14' THEN '1' WHEN '22' THEN '2' WHEN '24' THEN '0' ELSE CAST(s_nationkey AS VARCHAR) END AS dc FROM supplier WHERE s_nationkey NOT IN (0, 24))"""


def last_measures(spark: SparkSession, d: str, windows: tuple[int, ...] = (90,)) -> DataFrame:
    past = demanded(spark, d).where(F.col("day") <= F.lit(AS_OF).cast("date"))  # frames look back alone, so later rows need no means
    return shares.at_date(demand.rolling_trimmed_mean(past, windows).select("grp", "store", "day", *[f"trimmed_{n}" for n in windows]), AS_OF)


def _last_sql(base: str) -> str:
    return f"""{base}, {CENTRES}, last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY grp, store ORDER BY day DESC) AS rn FROM measured WHERE day <= DATE '{AS_OF}') WHERE rn = 1),
dcs AS (SELECT grp, dc, sum(trimmed_90) AS dc_total, coalesce(sum(trimmed_90) / nullif(sum(sum(trimmed_90)) OVER (PARTITION BY grp), 0), 0.0) AS dc_share FROM last JOIN centres USING (store) GROUP BY grp, dc)"""


LAST, LAST_ALL = _last_sql(MEASURED), _last_sql(MEASURED_ALL)


def matrix(spark: SparkSession, d: str) -> DataFrame:
    """New, incumbent and real share per group and store: of the sales of 1998, 1997 and 1999."""
    year = lambda y: F.sum(F.when(F.year("day") == y, F.col("qty")).otherwise(0.0))
    per = sales(spark, d).groupBy("grp", "store", "dc", "region", "band").agg(year(1998).alias("new_qty"), year(1997).alias("old_qty"), year(1999).alias("real_qty"))
    w = Window.partitionBy("grp")
    return per.select("grp", "store", "dc", "region", "band", "real_qty", *[F.coalesce(F.try_divide(F.col(f"{n}_qty"), F.sum(f"{n}_qty").over(w)), F.lit(0.0)).alias(n) for n in ("new", "old", "real")])


MATRIX = f"""{SALES}, years AS (SELECT grp, store, dc, region, band, sum(CASE WHEN year(day) = 1998 THEN qty ELSE 0.0 END) AS new_qty, sum(CASE WHEN year(day) = 1997 THEN qty ELSE 0.0 END) AS old_qty, sum(CASE WHEN year(day) = 1999 THEN qty ELSE 0.0 END) AS real_qty FROM sales GROUP BY ALL),
matrix AS (SELECT grp, store, dc, region, band, real_qty, coalesce(new_qty / nullif(sum(new_qty) OVER (PARTITION BY grp), 0), 0.0) AS new, coalesce(old_qty / nullif(sum(old_qty) OVER (PARTITION BY grp), 0), 0.0) AS old, coalesce(real_qty / nullif(sum(real_qty) OVER (PARTITION BY grp), 0), 0.0) AS real FROM years)"""


def channels(spark: SparkSession, d: str) -> DataFrame:
    """sku, grp, store, channel, share of the channel's sales of the sku. Lines meet by sku and store, their sums by sku."""
    per = dealt_sales(spark, d, "sku", "store").groupBy("sku", "grp", "store", "dc", "channel").agg(F.sum("qty").alias("qty"))
    per = dealt(per, line_count(spark, d), "sku")
    return per.withColumn("share", share_of_total(F.col("qty"), "sku", "channel"))


CHANNELS = f"""{SALES}, per_channel AS (SELECT sku, grp, store, dc, channel, sum(qty) AS qty FROM sales GROUP BY ALL),
channels AS (SELECT *, coalesce(qty / nullif(sum(qty) OVER (PARTITION BY sku, channel), 0), 0.0) AS share FROM per_channel)"""

TESTED = ["PROMO", "ECONOMY"]


def observed(spark: SparkSession, d: str) -> DataFrame:
    """Sales rows with period, arm, cover, stock-out flag and lost revenue."""
    s = sales(spark, d)
    tested = s.sparkSession.createDataFrame([(g,) for g in TESTED], "grp string")
    short = (F.col("mandatory") == "S") & (F.col("on_hand") < F.col("qty"))
    out = pilot.label_test(s, tested).withColumns({"period": period_label("day", "1999-01-01", "1998-01-01"), "cover": F.try_divide(60 * F.col("on_hand"), F.col("qty")), "stockout": short.cast("int")})
    return out.withColumn("lost_revenue", F.when(short, (F.col("qty") - F.col("on_hand")) * F.try_divide("revenue", "qty")).otherwise(0.0))


OBSERVED = f"""{SALES}, observed AS (SELECT *, CASE WHEN grp IN ('PROMO', 'ECONOMY') THEN 'test' ELSE 'control' END AS arm,
  CASE WHEN day >= DATE '1999-01-01' THEN 'pilot' WHEN day >= DATE '1998-01-01' THEN 'baseline' ELSE 'ignore' END AS period, 60 * on_hand / nullif(qty, 0) AS cover,
  CASE WHEN mandatory = 'S' AND on_hand < qty THEN 1 ELSE 0 END AS stockout, CASE WHEN mandatory = 'S' AND on_hand < qty THEN (qty - on_hand) * (revenue / nullif(qty, 0)) ELSE 0.0 END AS lost_revenue FROM sales)"""
