"""The six raw feeds, derived from the TPC-H-like tables of a folder.

The tables are clean, so dirt is added by formula: missing and repeated ids,
padding, odd codes, impossible dates, measures that contradict each other. Every
row of the tables is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.schemas import BRONZE, conform

# Fixed values, by product family 0 to 6: prefixes of product keys, and the
# category each family gets. CO-PE has no category and CO_PD no product.
KEY_PREFIXES = ("AC-BR", "AC-HE", "BI-MB", "CL-CA", "CO-RF", "CO-PE", "CO-WH")
CATEGORY_COLUMNS = {
    "id": ("AC_BR", "AC_HE", "BI_MB", "CL_CA", "CO_RF", "CO_PD", "CO_WH"),
    "cat": ("Accessories", "Accessories", "Bikes", "Clothing", "Components", "Components", "Components"),
    "subcat": ("Bike Racks", "Helmets", "Mountain Bikes", "Caps", "Road Frames", "Pedals", "Wheels"),
    "maintenance": ("Yes", "Yes", "Yes", "No", "Yes", "No", "Yes"),
}

def _pick(number: Column, *values) -> Column:
    """``values[number]``; NULL past the end."""
    return F.get(F.array(*[v if isinstance(v, Column) else F.lit(v) for v in values]), number.cast("int"))


def _padded(number: Column, width: int) -> Column:
    """Zeros in front up to ``width``; longer numbers keep all digits."""
    digits = number.cast("string")
    return F.when(F.length(digits) < width, F.lpad(digits, width, "0")).otherwise(digits)


def _family(part: Column) -> Column:
    """Three parts in a row are versions of one product."""
    return F.call_function("div", part, F.lit(3))


def _date_key(moment: Column) -> Column:
    return F.year(moment) * 10000 + F.month(moment) * 100 + F.dayofmonth(moment)


class Feeds:
    """Raw feeds of one folder, each a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._sources: dict[str, DataFrame] = {}

    def source(self, name: str) -> DataFrame:
        if name not in self._sources:
            self._sources[name] = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        return self._sources[name]

    def feed(self, table: str) -> DataFrame:
        return conform(getattr(self, f"_{table}")(), BRONZE[table])

    def _crm_cust_info(self) -> DataFrame:
        key = F.col("c_custkey")
        versions = F.when(key % 10 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self.source("customer").withColumn("version", F.explode(versions)).select(
            F.when(key % 97 != 0, key).alias("cst_id"),
            F.concat(F.lit("AW"), _padded(key, 8)).alias("cst_key"),
            F.when(key % 7 == 0, F.concat(F.lit(" "), "c_name")).otherwise(F.col("c_name")).alias("cst_firstname"),
            F.when(key % 11 == 0, F.concat("c_mktsegment", F.lit(" "))).otherwise(F.col("c_mktsegment")).alias("cst_lastname"),
            _pick(key % 4, "S", "m ", None, "X").alias("cst_marital_status"),
            _pick(key % 5, " F", "M", "f", None, "").alias("cst_gndr"),
            F.date_add(F.lit("2025-10-06").cast("date"), (key % 100).cast("int") + F.col("version")).alias("cst_create_date"),
        )

    def _crm_prd_info(self) -> DataFrame:
        key = F.col("p_partkey")
        family = _family(key)
        start = F.date_add(F.lit("2011-07-01").cast("date"), ((key % 3) * 365).cast("int"))
        # some versions are delivered twice, the second time under the key of another category
        copies = F.when(key % 101 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self.source("part").withColumn("copy", F.explode(copies)).select(
            F.when(key % 83 != 0, key).alias("prd_id"),
            F.concat(_pick((family + F.col("copy")) % 7, *KEY_PREFIXES), F.lit("-P"), _padded(family, 6)).alias("prd_key"),
            F.col("p_name").alias("prd_nm"),
            F.when(key % 50 != 0, F.floor("p_retailprice")).alias("prd_cost"),
            _pick(key % 5, "M ", "r ", "S ", "T ", None).alias("prd_line"),
            start.alias("prd_start_dt"),
            F.when(key % 3 < 2, F.date_sub(start, 1000)).alias("prd_end_dt"),
        )

    def _crm_sales_details(self) -> DataFrame:
        order = F.col("o_orderkey")
        order_key = (
            F.when(order % 50 == 0, 0)
            .when(order % 53 == 0, 5489)
            .when(order % 59 == 0, 20130229)
            .otherwise(_date_key(F.col("o_orderdate")))
        )
        orders = self.source("orders").select(
            "o_orderkey", order_key.alias("sls_order_dt"), F.col("o_custkey").alias("sls_cust_id")
        )
        # what is read meets in the join: it is shorter than the texts made of it
        lines = self.source("lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_shipdate")
        return self._sales_lines(lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")))

    def _sales_lines(self, joined: DataFrame) -> DataFrame:
        kind = F.col("l_orderkey") % 20
        line = F.col("l_partkey") % 100
        whole = F.floor("l_extendedprice")
        quantity = F.col("l_quantity").cast("int")
        price = F.floor(F.col("l_extendedprice") / F.col("l_quantity"))
        shipped = _date_key(F.col("l_shipdate"))
        return joined.select(
            "sls_order_dt",
            "sls_cust_id",
            F.concat(F.lit("SO"), F.col("l_orderkey").cast("string")).alias("sls_ord_num"),
            F.when(line == 17, "P-UNKNOWN")
            .otherwise(F.concat(F.lit("P"), _padded(_family(F.col("l_partkey")), 6)))
            .alias("sls_prd_key"),
            F.when(line == 23, 0).when(line == 29, 20999).otherwise(shipped).alias("sls_ship_dt"),
            F.when(line == 31, 21001231)
            .when(line == 37, None)
            .otherwise(_date_key(F.date_add(F.to_date("l_shipdate"), (F.col("l_orderkey") % 15).cast("int") - 5)))
            .alias("sls_due_dt"),
            F.when(kind == 1, None)
            .when(kind == 2, 0)
            .when(kind.isin(3, 8), -whole)
            .when(kind == 4, whole + 1)
            .otherwise(quantity * price)
            .alias("sls_sales"),
            F.when(line == 41, 0).when(line == 43, None).otherwise(quantity).alias("sls_quantity"),
            F.when(kind == 5, None).when(kind == 6, 0).when(kind.isin(7, 8), -price).otherwise(price).alias("sls_price"),
        )

    def _erp_cust_az12(self) -> DataFrame:
        key = F.col("c_custkey")
        number = F.concat(F.lit("AW"), _padded(key, 8))
        copies = F.when(key % 79 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
        return self.source("customer").where(key % 13 != 0).withColumn("copy", F.explode(copies)).select(
            F.when(key % 3 == 0, F.concat(F.lit("NAS"), number)).otherwise(number).alias("cid"),
            F.date_add(F.lit("1920-01-01").cast("date"), (key * 527 % 40000).cast("int")).alias("bdate"),
            _pick(key % 6, "F", "Female", " male", "M", "", None).alias("gen"),
        )

    def _erp_loc_a101(self) -> DataFrame:
        nations = self.source("nation").select("n_nationkey", "n_name")
        customers = self.source("customer").select("c_custkey", "c_nationkey")
        nation = F.col("n_nationkey")
        spelled = (
            F.when(nation == 0, "DE")
            .when(nation == 1, "US ")
            .when(nation == 2, "USA")
            .when(nation == 3, "")
            .when(nation != 4, F.col("n_name"))
        )
        return customers.join(nations, F.col("c_nationkey") == nation).select(
            F.concat(F.lit("AW-"), _padded(F.col("c_custkey"), 8)).alias("cid"), spelled.alias("cntry")
        )

    def _erp_px_cat_g1v2(self) -> DataFrame:
        """The seven families, a group per brand and size that no product names, and one row without id."""
        part = self.source("part")
        families = part.select((_family(F.col("p_partkey")) % 7).alias("family")).distinct()
        named = families.select(*[_pick(F.col("family"), *values).alias(name) for name, values in CATEGORY_COLUMNS.items()])
        groups = part.select("p_brand", "p_size").distinct()
        size = F.col("p_size").cast("string")
        brand = F.replace("p_brand", F.lit("Brand#"), F.lit(""))
        extra = groups.select(
            F.when(F.col("p_size") % 50 != 7, F.concat(F.lit("X"), brand, F.lit("_"), size)).alias("id"),
            F.when(F.col("p_size") % 9 == 0, F.concat("p_brand", F.lit(" "))).otherwise(F.col("p_brand")).alias("cat"),
            F.concat(F.lit("Size "), size).alias("subcat"),
            F.when(F.col("p_size") % 2 == 0, "Yes").otherwise("No").alias("maintenance"),
        )
        return named.unionByName(extra)
