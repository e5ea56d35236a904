"""Stand-ins for the event collection and the lake files.

The given tables have neither events with blank fields nor wide quoted lines,
so Spark derives them here from whole tables. ``oracles`` derives the same
from the same tables in SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from lakemark.constants import (
    CLAIMANT_FIELD,
    COUNTRY_FIELD,
    DEFENSE_CODE,
    ENERGY_CODE,
    FIRST_SERIES_TOKEN,
    TOKENS_PER_LINE,
    YEAR_FIELD,
)
from lakemark.session import fresh_path
from lakemark.sources.events import typed_events

CELLS = TOKENS_PER_LINE - FIRST_SERIES_TOKEN

INDICATOR_HEADER = ",".join(
    ['"Country Name"', '"Country Code"', '"Indicator Name"', '"Indicator Code"']
    + [f'"Q{cell}"' for cell in range(CELLS)]
)

TOTALS_HEADER = "nation;country;suppliers;quantity"


# Schemas of the given tables, which never change: a file's footer is read once.
_schemas: dict[str, StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir}/{name}.parquet"
    if path not in _schemas:
        _schemas[path] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[path]).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order as an event at its customer's nation.

    Some events have no country; some claimants are null, blank or unknown.
    """
    placed = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    )
    priority = F.col("o_orderpriority")
    nowhere = (F.col("o_orderstatus") == "P") & (priority == "1-URGENT")
    return typed_events(
        placed.select(
            F.when(~nowhere, F.col("n_name")).alias(COUNTRY_FIELD),
            F.year("o_orderdate").alias(YEAR_FIELD),
            F.when(priority == "4-NOT SPECIFIED", "Unknown")
            .when(priority == "5-LOW", "")
            .when(priority != "2-HIGH", F.col("c_name"))
            .alias(CLAIMANT_FIELD),
            F.col("o_orderstatus").alias("outcome"),
        )
    )


def event_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as JSON lines, in two kinds that differ in the order and types of fields.

    Finished ones lack what is null; the others say null, have the year as a text and a
    nested field besides.
    """
    rows = events(spark, sf_dir)
    lacking = F.to_json(F.struct(COUNTRY_FIELD, YEAR_FIELD, CLAIMANT_FIELD, "outcome"))
    place = F.struct(F.col("outcome").alias("z"), F.array(YEAR_FIELD, F.lit(1)).alias("a"))
    stating = F.struct(
        "outcome", F.col(CLAIMANT_FIELD), place.alias("place of it"), F.col(COUNTRY_FIELD), F.col(YEAR_FIELD).cast("string").alias(YEAR_FIELD)
    )
    stated = F.to_json(stating, {"ignoreNullFields": "false"})
    return rows.select(F.when(F.col("outcome") == "F", lacking).otherwise(stated).alias("value"))


def prose_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of all documents, blank ones included, in the characters of Latin-1."""
    text = F.regexp_replace(F.replace("text", F.lit("\r"), F.lit("")), r"[^\x00-\xFF]", "?")
    return table(spark, sf_dir, "documents").select(F.explode(F.split(text, "\n")).alias("value"))


def encoded_file(spark: SparkSession, lines: DataFrame, charset: str, label: str) -> str:
    """Write lines as text files in a charset that keeps the line feed of ASCII."""
    path = fresh_path(spark, label)
    lines.select(F.encode("value", charset).cast("string").alias("value")).write.text(path)
    return path


def _quarters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shipped quantity and large returns per nation and quarter.

    Line items are summed per supplier before they meet the suppliers.
    """
    shipped = F.col("l_shipdate")
    quarter = (F.year(shipped) - 1995) * 4 + F.quarter(shipped) - 1
    large_return = (F.col("l_returnflag") == "R") & (F.col("l_quantity") == 50)
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey", quarter.alias("quarter"))
        .agg(
            F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"),
            F.sum(F.when(large_return, 1)).alias("returns"),
        )
    )
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    return (
        per_supplier.join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"))
        .groupBy("s_nationkey", "quarter")
        .agg(F.sum("quantity").alias("quantity"), F.sum("returns").alias("returns"))
    )


def _nations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )


def indicator_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide indicator lines of every nation, two indicators each, no header.

    By region, a nation's line has a qualified name, is there twice, or comes
    with a second line under a qualified name.
    """
    # At most one entry per cell of a line.
    series = (
        _quarters(spark, sf_dir)
        .groupBy("s_nationkey")
        .agg(
            F.map_from_entries(
                F.collect_list(F.struct("quarter", F.struct("quantity", "returns")))
            ).alias("cells")
        )
    )

    def quoted(cell: Column) -> Column:
        return F.concat(F.lit('"'), cell, F.lit('"'))

    def line(label: str, code: str, field: str) -> Column:
        labels = F.array(
            F.col("name"), F.concat(F.lit("N"), F.col("n_nationkey")), F.lit(label), F.lit(code)
        )
        values = F.transform(
            F.sequence(F.lit(0), F.lit(CELLS - 1)),
            lambda at: F.coalesce(
                F.try_element_at(F.col("cells"), at)[field].cast("string"), F.lit("")
            ),
        )
        return F.array_join(F.transform(F.concat(labels, values), quoted), ",")

    plain, region = F.col("n_name"), F.col("r_name")
    spellings = (
        F.when(region == "AFRICA", F.array(F.concat(plain, F.lit(", The"))))
        .when(region == "ASIA", F.array(plain, plain))
        .when(region == "EUROPE", F.array(plain, F.concat(plain, F.lit(", North"))))
        .otherwise(F.array(plain))
    )
    return (
        _nations(spark, sf_dir)
        .join(series, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .withColumn("name", F.explode(spellings))
        .select(
            F.explode(
                F.array(
                    line("Power from oil", ENERGY_CODE, "quantity"),
                    line("Defense spending", DEFENSE_CODE, "returns"),
                )
            ).alias("value")
        )
    )


def nation_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers and shipped quantity of every nation, as a typed table."""
    per_supplier = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_suppkey")
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )
    totals = (
        table(spark, sf_dir, "supplier")
        .join(per_supplier, F.col("s_suppkey") == F.col("l_suppkey"), "left")
        .groupBy("s_nationkey")
        .agg(F.count("*").alias("suppliers"), F.sum("quantity").alias("quantity"))
    )
    return (
        _nations(spark, sf_dir)
        .join(totals, F.col("n_nationkey") == F.col("s_nationkey"), "left")
        .select(
            F.col("n_nationkey").alias("nation"),
            F.when(F.col("r_name") == "AFRICA", F.concat(F.lit('"'), "n_name", F.lit('"')))
            .otherwise(F.col("n_name"))
            .alias("country"),
            F.coalesce("suppliers", F.lit(0)).alias("suppliers"),
            F.coalesce("quantity", F.lit(0)).alias("quantity"),
        )
    )


def total_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``nation_totals`` as semicolon lines, no header; some names are quoted."""
    totals = nation_totals(spark, sf_dir)
    return totals.select(F.concat_ws(";", *totals.columns).alias("value"))


def lake_file(spark: SparkSession, lines: DataFrame, header: str, label: str) -> str:
    """Write lines below a header to the shared folder, as the file a job is given.

    Two part files, each with the header first, as exports of large tables have it.
    """
    path = fresh_path(spark, label)
    files = 2
    top = spark.range(files).select(F.lit(header).alias("value"), F.lit(0).alias("place"), F.col("id").cast("int").alias("file"))
    file = F.pmod(F.xxhash64("value"), F.lit(files)).cast("int").alias("file")
    whole = top.unionByName(lines.select("value", F.lit(1).alias("place"), file))
    whole = whole.repartitionById(files, F.col("file"))
    whole.sortWithinPartitions("place").select("value").write.text(path)
    return path
