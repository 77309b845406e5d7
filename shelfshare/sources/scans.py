"""Scans of the logical tables. Each takes the raw DataFrame, or a path to a text file, and returns typed, narrow columns."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from ..functions import number_from_comma
from ..operators.cleaning import one_row_per

WEEK = ("monday", "tuesday", "wednesday", "thursday", "friday", "saturday", "sunday")
MIRROR = StructType([StructField("reference", LongType()), StructField("mirrored", LongType())])


def stock(raw: DataFrame, places: tuple[str, ...] = ("L",), online: bool = False) -> DataFrame:
    """Active stock of shops (L), or of shops and depots (L, D) with both stocks added; cover is value over cost of sales."""
    on_hand = F.col("stock_offline") + F.coalesce("stock_online", F.lit(0.0)) if online else F.col("stock_offline")
    rows = raw.where(F.col("place").isin(*places) & (F.col("status") == "A")).select(F.col("day").cast("date").alias("day"), F.col("sku").cast("long").alias("sku"), F.col("store").cast("long").alias("store"), F.try_divide("stock_value", "sales_cost").alias("cover"), on_hand.alias("on_hand"), "mandatory", "voltage", F.col("dc").try_cast("long").alias("dc"))
    return one_row_per(rows, ["day", "sku", "store"], [F.desc_nulls_last("on_hand"), F.desc_nulls_last("cover"), F.asc_nulls_last("dc"), F.asc_nulls_last("mandatory"), F.asc_nulls_last("voltage")])


def products(raw: DataFrame, directorates: list[str]) -> DataFrame:
    """The latest version of each sku in some directorates, one row per sku."""
    rows = raw.where((F.col("latest") == "S") & F.col("directorate").isin(directorates)).select(F.col("sku").cast("long").alias("sku"), "directorate", "sector", "class", "species", "brand")
    return one_row_per(rows, ["sku"], [F.asc_nulls_last(c) for c in ("directorate", "sector", "class", "species", "brand")])


def sales(facts: DataFrame, quantities: DataFrame, start: str, end: str, shop: bool = True, moved: dict[int, int] | None = None) -> DataFrame:
    """Facts of a period with their quantities. Shop sales leave out resale goods and negatives; e-commerce sales count for the
    centre their store is moved to, and store 0 is dropped."""
    business = F.col("business") == "shop" if shop else F.col("business") != "shop"
    good = (F.col("revenue") >= 0) & (F.col("cost") >= 0) if shop else F.lit(True)
    rows = facts.where(F.col("day").between(start, end) & (F.col("state") != "saldo") & business & good).join(quantities, "fact")
    if not shop:
        table = F.create_map(*[F.lit(x) for pair in (moved or {}).items() for x in pair]).cast("map<bigint,bigint>") if moved else None
        rows = rows.where("qty > 0")
        if table is not None:
            rows = rows.withColumn("store", F.coalesce(F.try_element_at(table, F.col("store")), F.col("store")))
        rows = rows.where("store <> 0")
    return rows.select("day", "sku", "store", "qty", "revenue", "cost")


def centres(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("store").cast("long").alias("dc"), "name", F.concat_ws("/", "city", "state").alias("place"), "kind").distinct()


def stores(raw: DataFrame) -> DataFrame:
    rows = raw.select(F.col("store").cast("long").alias("store"), "name", "state", "band", "kind", "region")
    return one_row_per(rows, ["store"], [F.asc_nulls_last(c) for c in ("name", "state", "band", "kind", "region")])


def supply_plan(raw: DataFrame) -> DataFrame:
    """store, both centres, days of travel, loads a day, the lorry's size, the hour group and the loads of each weekday; one row per store."""
    more = ["days", "loads", "lorry", "hours", *WEEK]
    rows = raw.select(F.col("store").cast("long").alias("store"), F.col("dc1").cast("long").alias("dc1"), F.col("dc2").cast("long").alias("dc2"), *more)
    return one_row_per(rows, ["store"], [F.asc_nulls_last(c) for c in ("dc1", "dc2", *more)])


def supply_map(store: DataFrame, plan: DataFrame, centre: DataFrame) -> DataFrame:
    """Stores with the names and places of both their centres; dimensions are left to Spark's own size check."""
    side = lambda n: centre.select(F.col("dc").alias(f"dc{n}"), F.col("name").alias(f"dc{n}_name"), F.col("place").alias(f"dc{n}_place"))
    return store.join(plan, "store", "left").join(side(1), "dc1", "left").join(side(2), "dc2", "left")


def base_panel(raw: DataFrame, category: str, since: str, measures: list[str]) -> DataFrame:
    """The panel of one category from a day on, its month as yyyymm, null measures as 0."""
    out = raw.where((F.col("category") == category) & (F.col("day") >= F.lit(since).cast("date")))
    return out.withColumn("year_month", F.date_format("day", "yyyyMM").cast("int")).fillna(0.0, measures)


def header_name(text: str) -> str:
    return re.sub(r"\W+", "_", text.strip().lower()).strip("_")


def mapping_csv(spark: SparkSession, path: str, key: str, sep: str = ";", encoding: str = "ISO-8859-1") -> DataFrame:
    """A mapping file: normalised header, rows without key dropped, one row per full row."""
    raw = spark.read.csv(path, sep=sep, header=True, encoding=encoding)
    return raw.toDF(*map(header_name, raw.columns)).dropna(subset=[key]).dropDuplicates()


def mirror_csv(spark: SparkSession, path: str | None) -> DataFrame:
    """reference, mirrored; empty where there is no file."""
    if path is None:
        return spark.createDataFrame([], MIRROR)
    return spark.read.csv(path, sep=";", header=True, schema=MIRROR).dropna().dropDuplicates()


def incumbent_csv(spark: SparkSession, path: str) -> DataFrame:
    """sku, store, share of the incumbent matrix: store id after the last underscore, decimal commas."""
    fields = StructType([StructField(n, StringType()) for n in ("CODIGO", "CODIGO_FILIAL", "PERCENTUAL_MATRIZ", "CANAL", "TIPO_FILIAL")])
    raw = spark.read.csv(path, sep=";", header=True, schema=fields)
    return incumbent(raw)


def incumbent(raw: DataFrame) -> DataFrame:
    return raw.select(F.col("CODIGO").try_cast("long").alias("sku"), F.regexp_extract("CODIGO_FILIAL", r"(\d+)$", 1).try_cast("long").alias("store"), number_from_comma("PERCENTUAL_MATRIZ").alias("share")).dropDuplicates()


def incumbent_shops(raw: DataFrame) -> DataFrame:
    """The sheet form: shops of the OFFLINE channel, store id from the sixth character on."""
    return raw.where((F.col("TIPO_FILIAL") == "LOJA") & (F.col("CANAL") == "OFFLINE")).select(F.col("CODIGO").try_cast("long").alias("sku"), F.col("CODIGO_FILIAL").substr(6, 20).try_cast("long").alias("store"), number_from_comma("PERCENTUAL_MATRIZ").alias("share"))


def shipment_orders(raw: DataFrame, directorate: str) -> DataFrame:
    """Ordered pieces per kind of order, and their percentage; the quantity's text loses all but its digits."""
    rows = raw.where(F.col("DIRETORIA") == directorate).withColumn("pieces", F.regexp_replace("QUANTIDADE_PEDIDA", r"\D", "").try_cast("long"))
    per = rows.groupBy(F.col("TIPO_DE_PEDIDO").alias("kind")).agg(F.sum("pieces").alias("pieces"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("pieces").alias("all_")))).select("kind", "pieces", (100 * F.try_divide("pieces", "all_")).alias("pct"))


def extra_shipments(raw: DataFrame, groups: DataFrame) -> DataFrame:
    return raw.select(F.col("CdSku").cast("long").alias("sku"), F.col("Envio_Adicional").cast("double").alias("pieces")).join(groups, "sku", "left")


def managed_skus(raw: DataFrame) -> DataFrame:
    """Skus that are mandatory or suggested at the newest day."""
    return managed(raw.join(F.broadcast(raw.agg(F.max("day").alias("day"))), "day", "left_semi"))  # one row


def managed(last: DataFrame) -> DataFrame:
    """The same of rows that are those of the newest day already; a table laid out by day has them in one folder (layout.newest)."""
    return last.where((F.col("mandatory") == "S") | (F.col("suggested") == 1)).select("sku").distinct()


def matrices(spark: SparkSession, tables: dict[str, str]) -> DataFrame | None:
    """The matrices of several categories that exist, one below the other; None if none does."""
    found = [spark.table(t).withColumn("category", F.lit(c)) for c, t in tables.items() if spark.catalog.tableExists(t)]
    out = found[0] if found else None
    for df in found[1:]:
        out = out.unionByName(df, allowMissingColumns=True)
    return out
