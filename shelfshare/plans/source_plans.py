"""Queries that read and write: scans over raw forms of the test tables, and files and tables written and read back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import period_norm, store_from_code, suffixed, twin_or_model
from ..operators import cleaning, panel, shares
from ..operators.lineage import scratch, stored
from ..operators.selection import with_exact_median
from ..sources import checked, layout, scans, sinks, versioned
from . import base as b
from .base import query


def _raw(spark: SparkSession, d: str, table: str, columns: list[str], where: str = "true") -> DataFrame:
    """A raw form of a table; Spark and the SQL use the same expressions."""
    return b.read(spark, d, table).where(where).selectExpr(*columns)


def _sql(table: str, columns: list[str], where: str = "true") -> str:
    return f"(SELECT {', '.join(columns)} FROM {table} WHERE {where})"


_STOCK = ["CAST(l_shipdate AS DATE) AS day", "CAST(l_partkey AS STRING) AS sku", "CAST(l_suppkey AS STRING) AS store", "CASE WHEN l_suppkey % 5 = 0 THEN 'D' WHEN l_suppkey % 7 = 0 THEN 'X' ELSE 'L' END AS place",
          "CASE WHEN (l_partkey + l_suppkey) % 6 = 0 THEN 'I' ELSE 'A' END AS status", "l_quantity * 2 AS stock_value", "CASE WHEN l_partkey % 13 = 0 THEN 0.0 ELSE l_quantity / 4 END AS sales_cost", "l_quantity AS stock_offline",
          "CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_linenumber AS DOUBLE) END AS stock_online", "CASE WHEN l_partkey % 2 = 0 THEN 'S' ELSE 'N' END AS mandatory", "CASE WHEN l_partkey % 3 = 0 THEN '220V' END AS voltage",
          "CASE WHEN l_suppkey % 4 = 0 THEN 'SEM_CD' ELSE CAST(l_suppkey % 25 AS STRING) END AS dc", "l_linenumber % 5 AS suggested"]


def _stock_sql(places: str, on_hand: str) -> str:
    return f"""SELECT day, sku, store, cover, on_hand, mandatory, voltage, dc FROM (SELECT *, row_number() OVER (PARTITION BY day, sku, store ORDER BY on_hand DESC NULLS LAST, cover DESC NULLS LAST, dc NULLS LAST, mandatory NULLS LAST, voltage NULLS LAST) AS rn
FROM (SELECT day, CAST(sku AS BIGINT) AS sku, CAST(store AS BIGINT) AS store, stock_value / nullif(sales_cost, 0) AS cover, {on_hand} AS on_hand, mandatory, voltage, TRY_CAST(dc AS BIGINT) AS dc FROM {_sql('lineitem', _STOCK)} WHERE place IN ({places}) AND status = 'A')) WHERE rn = 1"""


@query(_stock_sql("'L'", "stock_offline"), "cover")
def scan_stock(spark, d):
    return scans.stock(_raw(spark, d, "lineitem", _STOCK))


@query(_stock_sql("'L', 'D'", "stock_offline + coalesce(stock_online, 0.0)"), "cover")
def scan_stock_online(spark, d):
    return scans.stock(_raw(spark, d, "lineitem", _STOCK), ("L", "D"), online=True)


@query(f"SELECT DISTINCT CAST(sku AS BIGINT) AS sku FROM (SELECT *, max(day) OVER () AS last FROM {_sql('lineitem', _STOCK)}) WHERE day = last AND (mandatory = 'S' OR suggested = 1)")
def scan_managed_skus(spark, d):
    return scans.managed_skus(_raw(spark, d, "lineitem", _STOCK)).select(F.col("sku").cast("long").alias("sku"))


_PRODUCT = ["CAST(p_partkey AS STRING) AS sku", "CASE WHEN p_partkey % 5 = 0 THEN 'N' ELSE 'S' END AS latest", "p_type AS directorate", "substr(p_name, 1, 3) AS sector", "CASE WHEN p_size > 25 THEN 'large' END AS class", "p_name AS species", "p_brand AS brand"]
_OLD = [*_PRODUCT[:1], "'S' AS latest", *_PRODUCT[2:6], "concat(p_brand, ' old') AS brand"]


@query(f"""SELECT sku, directorate, sector, class, species, brand FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY directorate NULLS LAST, sector NULLS LAST, class NULLS LAST, species NULLS LAST, brand NULLS LAST) AS rn
FROM (SELECT CAST(sku AS BIGINT) AS sku, latest, directorate, sector, class, species, brand FROM (SELECT * FROM {_sql('part', _PRODUCT)} UNION ALL SELECT * FROM {_sql('part', _OLD, 'p_partkey % 3 = 0')}) WHERE latest = 'S' AND directorate IN ('PROMO', 'SMALL', 'ECONOMY'))) WHERE rn = 1""")
def scan_products(spark, d):
    """Two versions of some products; one row per sku stays."""
    raw = _raw(spark, d, "part", _PRODUCT).unionByName(_raw(spark, d, "part", _OLD, "p_partkey % 3 = 0"))
    return scans.products(raw, ["PROMO", "SMALL", "ECONOMY"])


_FACT = ["l_orderkey * 10 + l_linenumber AS fact", "CAST(l_shipdate AS DATE) AS day", "l_partkey AS sku", "l_suppkey AS store", "CASE WHEN l_returnflag = 'R' THEN 'saldo' ELSE 'new' END AS state", "CASE WHEN l_linestatus = 'O' THEN 'web' ELSE 'shop' END AS business", "l_extendedprice - 5000 AS revenue", "l_extendedprice - 4000 AS cost"]
_QUANTITY = "SELECT l_orderkey * 10 + l_linenumber AS fact, sum(l_quantity) - 3 AS qty FROM lineitem GROUP BY ALL"


def _quantities(spark: SparkSession, d: str) -> DataFrame:
    return b.read(spark, d, "lineitem").groupBy((F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("fact")).agg((F.sum("l_quantity") - 3).alias("qty"))


def _facts_sql(where: str, store: str = "store") -> str:
    return f"SELECT day, sku, {store} AS store, qty, revenue, cost FROM {_sql('lineitem', _FACT)} JOIN ({_QUANTITY}) USING (fact) WHERE day BETWEEN DATE '1998-01-01' AND DATE '1998-12-31' AND state <> 'saldo' AND {where}"


@query(_facts_sql("business = 'shop' AND revenue >= 0 AND cost >= 0"), "revenue cost")
def scan_sales(spark, d):
    return scans.sales(_raw(spark, d, "lineitem", _FACT), _quantities(spark, d), "1998-01-01", "1998-12-31")


@query(_facts_sql("business <> 'shop' AND qty > 0 AND store NOT IN (0, 8)", "CASE WHEN store = 3 THEN 4 ELSE store END"), "revenue cost")
def scan_sales_online(spark, d):
    return scans.sales(_raw(spark, d, "lineitem", _FACT), _quantities(spark, d), "1998-01-01", "1998-12-31", shop=False, moved={3: 4, 8: 0})


_CENTRE = ["CAST(n_nationkey AS STRING) AS store", "n_name AS name", "CASE WHEN n_nationkey % 4 <> 0 THEN concat('city ', CAST(n_regionkey AS STRING)) END AS city", "concat('R', CAST(n_regionkey AS STRING)) AS state", "'CD' AS kind"]
_CENTRES = f"SELECT DISTINCT CAST(store AS BIGINT) AS dc, name, concat_ws('/', city, state) AS place, kind FROM {_sql('nation', _CENTRE)}"


@query(_CENTRES)
def scan_centres(spark, d):
    raw = _raw(spark, d, "nation", _CENTRE)
    return scans.centres(raw.unionByName(raw.where("store < 9")))


_STORE = ["CAST(s_suppkey AS STRING) AS store", "s_name AS name", "concat('S', CAST(s_nationkey AS STRING)) AS state", "concat('PORTE ', CAST(s_suppkey % 6 + 1 AS STRING)) AS band", "'LOJA' AS kind", "CAST(s_nationkey % 5 AS STRING) AS region"]
_OTHER = [*_STORE[:3], "concat('PORTE ', CAST(s_suppkey % 6 AS STRING)) AS band", *_STORE[4:]]
_STORES = f"SELECT CAST(store AS BIGINT) AS store, name, state, min(band) AS band, kind, region FROM (SELECT * FROM {_sql('supplier', _STORE)} UNION ALL SELECT * FROM {_sql('supplier', _OTHER, 's_suppkey % 2 = 0')}) GROUP BY ALL"


def _stores(spark: SparkSession, d: str) -> DataFrame:
    return scans.stores(_raw(spark, d, "supplier", _STORE).unionByName(_raw(spark, d, "supplier", _OTHER, "s_suppkey % 2 = 0")))


@query(_STORES)
def scan_stores(spark, d):
    return _stores(spark, d)


_WEEK = ["monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday"]
_PLAN = ["CAST(s_suppkey AS STRING) AS store", "CAST(s_nationkey AS STRING) AS dc1", "CAST((s_nationkey + 1) % 30 AS STRING) AS dc2", "s_suppkey % 7 AS days", "s_suppkey % 3 AS loads", "CASE WHEN s_suppkey % 4 > 0 THEN concat('lorry ', CAST(s_suppkey % 4 AS STRING)) END AS lorry", "concat('hours ', CAST(s_suppkey % 5 AS STRING)) AS hours",
         *[f"CASE WHEN s_suppkey % 8 <> {i} THEN CAST((s_suppkey * {i + 3}) % 10 AS INT) END AS {day}" for i, day in enumerate(_WEEK)]]
_PLANNED = f"SELECT CAST(store AS BIGINT) AS store, CAST(dc1 AS BIGINT) AS dc1, CAST(dc2 AS BIGINT) AS dc2, days, loads, lorry, hours, {', '.join(_WEEK)} FROM {_sql('supplier', _PLAN, 's_suppkey % 9 <> 0')}"


@query(f"WITH st AS ({_STORES}), pl AS ({_PLANNED}), ce AS ({_CENTRES})--FROM--SELECT st.store, st.name, st.state, st.band, st.kind, st.region, pl.dc1, pl.dc2, days, loads, lorry, hours, {', '.join(_WEEK)}, a.name AS dc1_name, a.place AS dc1_place, c.name AS dc2_name, c.place AS dc2_place FROM st LEFT JOIN pl USING (store) LEFT JOIN ce a ON a.dc = pl.dc1 LEFT JOIN ce c ON c.dc = pl.dc2")
def scan_supply_map(spark, d):
    """Stores with the names of the centres that supply them; some have no plan, some a centre that isn't known."""
    raw = _raw(spark, d, "supplier", _PLAN, "s_suppkey % 9 <> 0")
    return scans.supply_map(_stores(spark, d), scans.supply_plan(raw.unionByName(raw)), scans.centres(_raw(spark, d, "nation", _CENTRE)))


@query(f"WITH {b.PANEL}--FROM--SELECT grp AS category, store, day, year_month, qty, coalesce(delta, 0.0) AS delta FROM panel WHERE grp = 'PROMO' AND day >= DATE '1998-01-01'")
def scan_base_panel(spark, d):
    raw = b.panel(spark, d).withColumnRenamed("grp", "category").drop("year_month")
    return scans.base_panel(raw, "PROMO", "1998-01-01", ["delta"]).select("category", "store", "day", "year_month", "qty", "delta")


@query(f"WITH {b.SALES}--FROM--SELECT sku, store, day, qty FROM sales WHERE day = (SELECT max(day) FROM sales)")
def newest_rows(spark, d):
    return shares.newest(b.sales(spark, d).select("sku", "store", "day", "qty"))


@query(f"WITH {b.SALES}--FROM--SELECT sku, store, day, qty FROM sales WHERE day = (SELECT max(day) FROM sales)")
def newest_rows_by_day(spark, d):
    """The newest day of a table that is laid out by day: one folder is scanned."""
    path = scratch(spark, "by-day")
    layout.write(b.sales(spark, d).select("sku", "store", "day", "qty"), path, ["sku"])
    return layout.newest(spark, path).select("sku", "store", "day", "qty")


@query(f"SELECT DISTINCT CAST(sku AS BIGINT) AS sku FROM (SELECT *, max(day) OVER () AS last FROM {_sql('lineitem', _STOCK)}) WHERE day = last AND (mandatory = 'S' OR suggested = 1)")
def managed_skus_by_day(spark, d):
    """The same from a table by month, of which the newest folder alone is looked through."""
    path = scratch(spark, "stock-by-day")
    layout.write(_raw(spark, d, "lineitem", _STOCK), path, ["sku"], by=layout.MONTH)
    return scans.managed(layout.newest(spark, path)).select(F.col("sku").cast("long").alias("sku"))


@query(f"WITH {b.PANEL}--FROM--SELECT grp AS category, store, day, year_month, qty, coalesce(delta, 0.0) AS delta FROM panel WHERE grp = 'PROMO' AND day >= DATE '1998-01-01'")
def base_panel_by_day(spark, d):
    """A category's rows from a day on: older folders aren't opened, other categories' row groups are passed over."""
    path = scratch(spark, "panel-by-day")
    layout.write(b.panel(spark, d).withColumnRenamed("grp", "category").drop("year_month"), path, ["category"], by=layout.MONTH)
    return scans.base_panel(layout.since(spark, path, "1998-01-01"), "PROMO", "1998-01-01", ["delta"]).select("category", "store", "day", "year_month", "qty", "delta")


_TWIN = "CASE WHEN p_size % 4 = 0 THEN '-' WHEN p_size % 4 = 1 THEN NULL ELSE concat('twin ', p_brand) END"


@query(f"SELECT p_partkey AS sku, p_type AS model, {_TWIN} AS twin FROM part WHERE p_size % 4 <> 1")
def read_twin_map(spark, d):
    """A mapping file with a header to normalise, rows without a twin, and rows that are there twice."""
    path = scratch(spark, "twins")
    rows = b.read(spark, d, "part").select(F.col("p_partkey").alias(" Sku Loja "), F.col("p_type").alias("Modelo"), F.expr(_TWIN).alias("Gêmeos!"))
    rows.unionByName(rows).write.csv(path, sep=";", header=True, encoding="ISO-8859-1")
    found = scans.mapping_csv(spark, path, "gêmeos")
    return found.select(F.col("sku_loja").cast("long").alias("sku"), F.col("modelo").alias("model"), F.col("gêmeos").alias("twin"))


@query(f"SELECT p_partkey AS sku, CASE WHEN t = '-' THEN p_type ELSE t END AS grp FROM (SELECT *, {_TWIN} AS t FROM part)")
def twin_fallback(spark, d):
    return b.read(spark, d, "part").withColumn("twin", F.expr(_TWIN)).select(F.col("p_partkey").alias("sku"), twin_or_model("twin", "p_type").alias("grp"))


@query("SELECT DISTINCT s_suppkey % 7 AS reference, s_suppkey AS mirrored FROM supplier WHERE s_suppkey % 5 <> 0")
def read_mirror_map(spark, d):
    path = scratch(spark, "mirrors")
    rows = b.read(spark, d, "supplier").select((F.col("s_suppkey") % 7).alias("reference"), F.when(F.col("s_suppkey") % 5 != 0, F.col("s_suppkey")).alias("mirrored"))
    rows.unionByName(rows).write.csv(path, sep=";", header=True)
    return scans.mirror_csv(spark, path).unionByName(scans.mirror_csv(spark, None))


#: An incumbent matrix as text: code of the store, percentage with a decimal comma, now and then no number.
_K = "((p_partkey * 7 + s_suppkey) % 800)"
_INCUMBENT = ["CAST(p_partkey AS STRING) AS CODIGO", "concat(CASE WHEN s_suppkey % 10 = 0 THEN '0099_' ELSE '0021_' END, lpad(CAST(s_suppkey AS STRING), 5, '0')) AS CODIGO_FILIAL",
              f"CASE WHEN {_K} = 5 THEN 'n/a' ELSE concat(CAST(CAST(floor({_K} / 8.0) AS BIGINT) AS STRING), ',', lpad(CAST(({_K} % 8) * 125 AS STRING), 3, '0')) END AS PERCENTUAL_MATRIZ",
              "CASE WHEN p_partkey % 3 = 0 THEN 'ONLINE' ELSE 'OFFLINE' END AS CANAL", "CASE WHEN s_suppkey % 10 = 0 THEN 'CD' ELSE 'LOJA' END AS TIPO_FILIAL"]
_PAIRS = "(SELECT DISTINCT l_partkey AS p_partkey, l_suppkey AS s_suppkey FROM lineitem)"
_SHARE = f"CASE WHEN {_K} <> 5 THEN {_K} / 8.0 END"


def _incumbent_csv(spark: SparkSession, d: str) -> str:
    path = scratch(spark, "incumbent")
    pairs = b.read(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")).distinct().selectExpr(*_INCUMBENT)
    pairs.unionByName(pairs.where("CODIGO < 50")).write.csv(path, sep=";", header=True)
    return path


@query(f"SELECT p_partkey AS sku, s_suppkey AS store, {_SHARE} AS share FROM {_PAIRS}", "share")
def read_incumbent(spark, d):
    return scans.incumbent_csv(spark, _incumbent_csv(spark, d))


@query(f"SELECT p_partkey AS sku, s_suppkey AS store, {_SHARE} AS share FROM {_PAIRS} WHERE p_partkey % 3 <> 0 AND s_suppkey % 10 <> 0", "share")
def read_incumbent_shops(spark, d):
    raw = spark.read.csv(_incumbent_csv(spark, d), sep=";", header=True)
    return scans.incumbent_shops(raw).distinct()


@query("SELECT store, avg(share) AS mean_share, median(share) AS median_share FROM (SELECT s_suppkey AS store, " + _SHARE + f" AS share FROM {_PAIRS}) GROUP BY store", "mean_share median_share")
def incumbent_mean_median(spark, d):
    found = scans.incumbent_csv(spark, _incumbent_csv(spark, d))
    return with_exact_median(found.groupBy("store").agg(F.avg("share").alias("mean_share")), found, ["store"], "share", "median_share")


#: The incumbent matrix with damaged lines: store codes without a number, no sku, half lines.
_HARM = "CASE WHEN p_partkey % 97 = 0 THEN 'short' WHEN p_partkey % 89 = 0 THEN 'sku' WHEN s_suppkey % 41 = 0 THEN 'store' END"
_FIELDS = [checked.Field("CODIGO", "sku", checked.whole_number, True), checked.Field("CODIGO_FILIAL", "store", lambda text: F.regexp_extract(text, r"(\d+)$", 1).try_cast("long"), True), checked.Field("PERCENTUAL_MATRIZ", "share", checked.comma_decimal), checked.Field("CANAL", "channel"), checked.Field("TIPO_FILIAL", "kind")]


def _damaged_csv(spark: SparkSession, d: str) -> str:
    """Files with a header each, and some without; as many as tasks write."""
    path = scratch(spark, "damaged")
    pairs = b.read(spark, d, "lineitem").select(F.col("l_partkey").alias("p_partkey"), F.col("l_suppkey").alias("s_suppkey")).distinct()
    rows = pairs.selectExpr(*_INCUMBENT, f"{_HARM} AS harm", "p_partkey % 3 AS third")
    rows = rows.withColumns({"CODIGO": F.when(F.col("harm") == "sku", "").otherwise(F.col("CODIGO")), "CODIGO_FILIAL": F.when(F.col("harm") == "store", "no code").otherwise(F.col("CODIGO_FILIAL"))})
    whole = F.concat_ws(";", "CODIGO", "CODIGO_FILIAL", "PERCENTUAL_MATRIZ", "CANAL", "TIPO_FILIAL")
    lines = stored(rows.select("third", F.when(F.col("harm") == "short", F.concat_ws(";", "CODIGO", "CODIGO_FILIAL")).otherwise(whole).alias("value")), "lines")
    header = ";".join(f.source for f in _FIELDS)
    # A table of one column, whose name is the header; no line has a tab.
    lines.where("third < 2").select(F.col("value").alias(header)).write.csv(path, sep="\t", quote="", header=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    lines.where("third = 2").select("value").write.mode("append").text(path)
    return path


_DAMAGED_LINES = f"(SELECT *, {_HARM} AS harm, p_partkey % 3 AS third FROM (SELECT DISTINCT l_partkey AS p_partkey, l_suppkey AS s_suppkey FROM lineitem))"


@query(f"SELECT p_partkey AS sku, s_suppkey AS store, {_SHARE} AS share, CASE WHEN p_partkey % 3 = 0 THEN 'ONLINE' ELSE 'OFFLINE' END AS channel, CASE WHEN s_suppkey % 10 = 0 THEN 'CD' ELSE 'LOJA' END AS kind FROM {_DAMAGED_LINES} WHERE harm IS NULL AND third < 2 AND {_K} <> 5", "share")
def read_damaged_good(spark, d):
    """The good rows of files with damaged lines."""
    return checked.split(spark, _damaged_csv(spark, d), _FIELDS)[0]


@query(f"SELECT reason, count(*) AS n FROM (SELECT CASE WHEN third = 2 THEN 'header' WHEN harm = 'short' THEN 'columns' WHEN harm = 'sku' THEN 'missing: CODIGO' WHEN harm = 'store' THEN 'value: CODIGO_FILIAL' ELSE 'value: PERCENTUAL_MATRIZ' END AS reason FROM {_DAMAGED_LINES} WHERE harm IS NOT NULL OR third = 2 OR {_K} = 5) GROUP BY reason")
def read_damaged_rejected(spark, d):
    """How many lines of the same files are rejected for each reason."""
    return checked.split(spark, _damaged_csv(spark, d), _FIELDS)[1].groupBy("reason").agg(F.count("*").alias("n"))


_SHIPPED = ["CASE WHEN l_linestatus = 'O' THEN 'TELAS' ELSE 'LEVES' END AS DIRETORIA", "concat('kind ', CAST(l_linenumber AS STRING)) AS TIPO_DE_PEDIDO", "concat(' ', CAST(CAST(l_quantity AS BIGINT) AS STRING), ' un.') AS QUANTIDADE_PEDIDA"]


@query("SELECT kind, pieces, 100.0 * pieces / sum(pieces) OVER () AS pct FROM (SELECT concat('kind ', CAST(l_linenumber AS STRING)) AS kind, CAST(sum(l_quantity) AS BIGINT) AS pieces FROM lineitem WHERE l_linestatus = 'O' GROUP BY ALL)", "pct")
def read_shipment_orders(spark, d):
    path = scratch(spark, "orders")
    _raw(spark, d, "lineitem", _SHIPPED).write.csv(path, sep=";", header=True)
    return scans.shipment_orders(spark.read.csv(path, sep=";", header=True), "TELAS")


@query("SELECT p_partkey AS sku, CAST(p_size AS DOUBLE) AS pieces, CASE WHEN p_size % 2 = 0 THEN p_type END AS grp FROM part WHERE p_size % 5 = 0")
def scan_extra_shipments(spark, d):
    part = b.read(spark, d, "part")
    listed = part.where("p_size % 5 = 0").selectExpr("CAST(p_partkey AS STRING) AS CdSku", "CAST(p_size AS STRING) AS Envio_Adicional")
    return scans.extra_shipments(listed, part.where("p_size % 2 = 0").select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("grp")))


# --- tables and exports


def _per(spark: SparkSession, d: str, by: str) -> DataFrame:
    return b.sales(spark, d).groupBy(by, "store").agg(F.sum("qty").alias("qty"))


@query(f"WITH {b.SALES}--FROM--SELECT 'a' AS category, grp, CAST(NULL AS VARCHAR) AS brand, store, sum(qty) AS qty FROM sales GROUP BY ALL UNION ALL SELECT 'b', NULL, brand, store, sum(qty) FROM sales GROUP BY ALL")
def scan_matrices(spark, d):
    """Tables of two categories, overwritten once, with different columns; that of a third doesn't exist."""
    name = lambda c: f"shelfshare_matrix_{c}"
    for category, by in (("a", "grp"), ("b", "brand")):
        path = scratch(spark, f"matrix-{category}")
        sinks.overwrite_table(_per(spark, d, by).limit(0), name(category), path)
        sinks.overwrite_table(_per(spark, d, by), name(category), path)
    return scans.matrices(spark, {c: name(c) for c in "abc"}).select("category", "grp", "brand", "store", "qty")


@query("SELECT p_partkey AS sku, p_type AS grp, n FROM part JOIN (SELECT p_type, count(*) AS n FROM part GROUP BY p_type) USING (p_type)")
def write_mapping_tables(spark, d):
    part = b.read(spark, d, "part").select(F.col("p_partkey").alias("sku"), F.col("p_type").alias("grp"))
    sinks.overwrite_table(part, "shelfshare_groups", scratch(spark, "groups"))
    sinks.overwrite_table(part.groupBy("grp").agg(F.count("*").alias("n")), "shelfshare_group_list", scratch(spark, "group-list"))
    return spark.table("shelfshare_groups").join(spark.table("shelfshare_group_list"), "grp").select("sku", "grp", "n")


def _whole_panel(spark: SparkSession, d: str) -> tuple[str, DataFrame]:
    """The panel as a table in versions, and its rows."""
    root, rows = scratch(spark, "panel"), b.panel(spark, d).select("grp", "store", "day", "qty", "year_month")
    days = rows.agg(F.min("day").alias("first"), F.max("day").alias("last")).first()
    versioned.replace_period(rows, root, str(days["first"]), str(days["last"]))
    return root, rows


_SPRING = "day BETWEEN DATE '1998-03-16' AND DATE '1998-04-15'"


@query(f"WITH {b.PANEL}--FROM--SELECT grp, store, day, CASE WHEN {_SPRING} THEN -qty ELSE qty END AS qty, year_month FROM panel")
def replace_period(spark, d):
    """The whole panel is written; then a month of days, across two calendar months, is written again with other values."""
    root, rows = _whole_panel(spark, d)
    versioned.replace_period(rows.where(_SPRING).withColumn("qty", -F.col("qty")), root, "1998-03-16", "1998-04-15")
    return versioned.read(spark, root)


@query(f"WITH {b.PANEL}--FROM--SELECT grp, store, day, qty, year_month FROM panel WHERE NOT ({_SPRING}) UNION ALL SELECT grp, store, day, 2 * qty, year_month FROM panel WHERE {_SPRING} AND store % 2 = 0")
def replace_period_failed(spark, d):
    """A period is replaced by fewer rows; a later write that fails half-way, and a dead writer's folders, change nothing."""
    root, rows = _whole_panel(spark, d)
    fewer = rows.where(_SPRING).where("store % 2 = 0").withColumn("qty", 2 * F.col("qty"))
    versioned.replace_period(fewer, root, "1998-03-16", "1998-04-15")
    try:
        versioned.replace_period(rows, root, "1998-03-01", "1998-03-31")  # rows outside the period are refused while they are written
    except Exception as e:  # noqa: BLE001
        if "outside 1998-03-01" not in str(e):
            raise
    versioned.vacuum(spark, root)
    return versioned.read(spark, root)


@query(f"WITH {b.SALES}, daily AS (SELECT sku, store, day, mandatory, on_hand, year_month, sum(qty) AS qty, sum(revenue) AS revenue FROM sales GROUP BY ALL), rolled AS (SELECT *, avg(CASE WHEN on_hand >= 1 THEN qty END) OVER w AS mean_qty FROM daily WINDOW w AS (PARTITION BY sku, store ORDER BY day RANGE BETWEEN INTERVAL 89 DAYS PRECEDING AND CURRENT ROW))--FROM--SELECT sku, store, day, year_month, qty, mean_qty, CASE WHEN mean_qty > on_hand AND mandatory = 'S' THEN mean_qty - on_hand END AS delta FROM rolled", "mean_qty delta")
def panel_backfill(spark, d):
    """All months there are, in batches of two years, of which one is done twice; the means look back over the batches' ends."""
    root, rows = scratch(spark, "backfill"), b.sales(spark, d)
    write = lambda part, start, end: versioned.replace_period(part, root, start, end)
    months = rows.agg(F.min("year_month").alias("first"), F.max("year_month").alias("last")).first()
    panel.backfill(rows, months["first"], months["last"], write, size=24)
    panel.backfill(rows, 199801, 199802, write, size=2)
    return versioned.read(spark, root).select("sku", "store", "day", "year_month", "qty", "mean_qty", "delta")


def _text(value: str) -> str:
    return f"replace(printf('%.3f', {value}), '.', ',')"


_WRITTEN = f"WITH {b.SALES}, per AS (SELECT sku, store, sum(qty) / 8 AS qty FROM sales GROUP BY ALL)--FROM--"


def _eighths(spark: SparkSession, d: str) -> DataFrame:
    return b.sales(spark, d).groupBy("sku", "store").agg((F.sum("qty") / 8).alias("qty"))


@query(_WRITTEN + f"SELECT CAST(sku AS VARCHAR) AS sku, CAST(store AS VARCHAR) AS store, {_text('qty')} AS qty FROM per")
def write_decimal_csv(spark, d):
    path = scratch(spark, "decimal")
    sinks.export_csv(_eighths(spark, d), path, ["qty"])
    return spark.read.csv(path, sep=";", header=True)


@query(_WRITTEN + f"SELECT CAST(sku AS VARCHAR) AS sku, CAST(store AS VARCHAR) AS store, {_text('qty')} AS qty, CAST(floor(coalesce(so_far, 0) / 1000) AS INTEGER) AS file_no FROM per JOIN (SELECT sku, sum(n) OVER (ORDER BY sku ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far FROM (SELECT sku, count(*) AS n FROM per GROUP BY sku)) USING (sku)")
def write_split_csv(spark, d):
    path = scratch(spark, "split")
    sinks.export_by_key(_eighths(spark, d), path, "sku", 1000, ["qty"])
    return spark.read.csv(path, sep=";", header=True)


@query(f"WITH {b.SALES}--FROM--SELECT grp, CAST(sum(qty) AS VARCHAR) AS qty FROM sales GROUP BY grp")
def write_report_csv(spark, d):
    path = scratch(spark, "report")
    sinks.single_csv(b.sales(spark, d).groupBy("grp").agg(F.sum("qty").alias("qty")), path)
    return spark.read.csv(path, header=True)


@query(_WRITTEN + f"SELECT CAST(sku AS VARCHAR) AS sku, CAST(store AS VARCHAR) AS store, {_text('qty')} AS qty, CAST((row_number() OVER (ORDER BY sku, store) - 1) // 700 AS INTEGER) AS part FROM per")
def write_forecast_parts(spark, d):
    path = scratch(spark, "parts")
    sinks.export_parts(_eighths(spark, d), path, ["sku", "store"], ["qty"], most=700)
    return spark.read.csv(path, sep=";", header=True)


# --- small rules


_KIND = ["p_partkey AS sku", "p_type AS grp", "CASE WHEN p_size % 3 = 0 THEN 'home' WHEN p_size % 3 = 1 THEN 'pick-up' END AS kind", "CASE WHEN p_size % 7 <> 0 THEN p_brand END AS brand"]


@query(f"SELECT sku, grp, kind, brand FROM {_sql('part', _KIND)} WHERE kind IN ('home') AND coalesce(brand NOT IN ('Brand#1', 'Brand#2'), true) AND grp NOT IN ('PROMO')")
def product_filters(spark, d):
    return cleaning.filter_products(_raw(spark, d, "part", _KIND), ["home"], ["Brand#1", "Brand#2"], ["PROMO"], drop_groups=True)


@query("SELECT s_suppkey AS store, CASE WHEN s_suppkey % 11 <> 0 THEN s_suppkey END AS found FROM supplier")
def store_of_code(spark, d):
    s = b.read(spark, d, "supplier").select(F.col("s_suppkey").alias("store"), F.expr("CASE WHEN s_suppkey % 11 = 0 THEN 'none' ELSE concat('0021_', lpad(CAST(s_suppkey AS STRING), 5, '0')) END").alias("code"))
    return s.select("store", store_from_code("code").alias("found"))


_LABEL = "CASE WHEN o_orderkey % 4 = 0 THEN ' Baseline 2 ' WHEN o_orderkey % 4 = 1 THEN 'PILOT' WHEN o_orderkey % 4 = 2 THEN 'after' END"


@query("SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'baseline' WHEN 1 THEN 'pilot' ELSE 'other' END AS period FROM orders")
def period_labels(spark, d):
    return b.read(spark, d, "orders").withColumn("label", F.expr(_LABEL)).select("o_orderkey", period_norm("label").alias("period"))


@query(f"WITH {b.MATRIX}--FROM--SELECT grp, store, new AS new_share, old AS old_share FROM matrix", "new_share old_share")
def suffixed_columns(spark, d):
    return suffixed(b.matrix(spark, d).select("grp", "store", "new", "old"), ["grp", "store"], "_share")
