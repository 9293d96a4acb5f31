"""Readers with declared schemas: CSV and JSON documents to rows, and their rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import ohlc_consistent
from tidemark.operators.quality import check_rows

PRICES = "provider string, provider_symbol string, asset_type string, trade_date date, open decimal(28,10), high decimal(28,10), low decimal(28,10), close decimal(28,10), volume bigint, currency string, price_variant string, available_at string, available_precision string"
VINTAGES = "series_id string, unit string, frequency string, source_vintage_identity string, source_release_order int, available_at string, available_precision string, is_first_release boolean, period_start date, period_end date, value decimal(28,10), missing_reason string"
BARS = "symbol string, trade_date date, open double, high double, low double, close double, volume bigint"
MACRO = "family string, provider string, captured_at string, payload struct<series:array<struct<series_id:string,unit:string>>,releases:array<struct<source_vintage_identity:string,source_release_order:int>>,observations:array<struct<series_id:string,release_identity:string,period_start:date,period_end:date,value:string,missing_reason:string>>>"
CATALOG = "instruments array<struct<instrument_key:string,asset_type:string,identifiers:array<struct<provider:string,provider_symbol:string,valid_from:date,valid_through:date>>>>"
NEWS = "source_name string, items array<struct<source_item_id:string,item_state:string,content:struct<headline:string,body:string>,labels:struct<topics:array<struct<topic:string,confidence:double>>,symbols:array<struct<provider_symbol:string>>>>>"
COMPANY = "issuers array<struct<issuer_key:string,legal_name:string>>, filings array<struct<accession_number:string,form:string,issuer_keys:array<string>>>, facts array<struct<issuer_key:string,concept:string,unit:string,period_end:date,value:string>>"
OPTIONS = "capture struct<capture_id:string,underlying_key:string>, contracts array<struct<provider_contract_id:string,strike_price:double,option_type:string>>, surface array<struct<provider_contract_id:string,surface_state:string,quote:struct<bid_price:double,ask_price:double>,bars:array<struct<bar_start:string,close:double>>>>"

CORRUPT = "_corrupt"


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A CSV with exactly this header; a line that doesn't fit is kept in the corrupt column."""
    kinds = T.StructType.fromDDL(schema).add(CORRUPT, "string")
    return spark.read.csv(path, schema=kinds, header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, enforceSchema=False)


def read_document(spark: SparkSession, path: str, schema: str, lines: bool = False) -> DataFrame:
    """JSON documents, each file or each line one, with the file's path."""
    kinds = T.StructType.fromDDL(schema).add(CORRUPT, "string")
    return spark.read.json(path, schema=kinds, multiLine=not lines, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT).withColumn("file", F.col("_metadata.file_path"))


def price_rules(symbols: DataFrame | None = None) -> dict[str, Column]:
    """The rules of a daily bar."""
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    return {
        "parses": F.col(CORRUPT).isNull(),
        "asset_type": F.col("asset_type").isin("etf", "index", "stock"),
        "ohlc_consistent": ohlc_consistent(*prices),
        "positive": F.least(*prices) > 0,
        "volume": F.col("volume") >= 0,
        "precision": F.col("available_precision") == F.when(F.length("available_at") == 10, "date").otherwise("datetime"),
    }


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Daily bars of a CSV with the rules that each breaks."""
    return check_rows(read_csv(spark, path, PRICES), price_rules())


def vintage_rules() -> dict[str, Column]:
    return {"parses": F.col(CORRUPT).isNull(), "value_xor_reason": F.col("value").isNull() != F.col("missing_reason").isNull(), "period": F.col("period_start") <= F.col("period_end")}


def read_vintages(spark: SparkSession, path: str) -> DataFrame:
    """Observations of vintage files with their broken rules, one of them that a file has several contracts."""
    rows = read_csv(spark, path, VINTAGES).withColumn("file", F.col("_metadata.file_path"))
    contract = F.struct("series_id", "unit", "frequency", "source_vintage_identity", "source_release_order")
    mixed = rows.groupBy("file").agg(F.count_distinct(contract).alias("_contracts"))
    return check_rows(rows.join(mixed, "file"), vintage_rules() | {"one_contract": F.col("_contracts") == 1}).drop("_contracts")


def read_bar_arrays(spark: SparkSession, path: str, lines: bool = False) -> DataFrame:
    """Bars of JSON arrays (or lines) with their broken rules."""
    kinds = T.StructType.fromDDL(BARS).add(CORRUPT, "string")
    rows = spark.read.json(path, schema=kinds, multiLine=not lines, columnNameOfCorruptRecord=CORRUPT)
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    return check_rows(rows, {"parses": F.col(CORRUPT).isNull(), "ohlc_consistent": ohlc_consistent(*prices), "positive": F.least(*prices) > 0})


def macro_observations(documents: DataFrame) -> DataFrame:
    """A row for each observation with its series' unit and its release's order."""
    o = documents.select("file", "family", "payload", F.explode("payload.observations").alias("o"))
    one = lambda items, field, key: F.get(F.filter(items, lambda x: x[field] == key), F.lit(0))
    return o.select("file", "family", "o.*", one(F.col("payload.series"), "series_id", F.col("o.series_id"))["unit"].alias("unit"), one(F.col("payload.releases"), "source_vintage_identity", F.col("o.release_identity"))["source_release_order"].alias("release_order"))


def catalog_identifiers(documents: DataFrame) -> DataFrame:
    return documents.select(F.inline("instruments")).select("instrument_key", "asset_type", F.inline("identifiers"))


def news_labels(documents: DataFrame) -> DataFrame:
    """A row for each item and topic; an item without topics keeps one row."""
    items = documents.select("source_name", F.inline("items"))
    return items.select("source_name", "source_item_id", "item_state", "content.headline", F.inline_outer("labels.topics"))


def company_facts(documents: DataFrame) -> DataFrame:
    return documents.select("file", F.inline("facts"))


def company_filings(documents: DataFrame) -> DataFrame:
    """A row for each filing and issuer."""
    return documents.select(F.inline("filings")).select("accession_number", "form", F.explode("issuer_keys").alias("issuer_key"))


def option_quotes(documents: DataFrame) -> DataFrame:
    """A row for each surface entry with the terms of its document's first contract of that id.

    A document's contracts and entries meet by a grouping of both, so its size counts once; entries without an id are groups of their own.
    """
    fields = "struct<term:boolean,id:string,place:int,strike_price:double,surface_state:string,bid_price:double,ask_price:double,bars:int>"
    nulls = lambda kinds: [F.lit(None).cast(k) for k in kinds.split()]
    term = lambda c, i: F.struct(F.lit(True), c["provider_contract_id"], i, c["strike_price"], *nulls("string double double int")).cast(fields)
    shown = lambda s, i: F.struct(F.lit(False), s["provider_contract_id"], i, *nulls("double"), s["surface_state"], s["quote"]["bid_price"], s["quote"]["ask_price"], F.size(s["bars"])).cast(fields)
    none = F.array().cast(f"array<{fields}>")
    each = documents.select(F.monotonically_increasing_id().alias("_doc"), "capture.capture_id", F.concat(F.coalesce(F.transform("contracts", term), none), F.coalesce(F.transform("surface", shown), none)).alias("both"))
    both = each.select("_doc", "capture_id", F.explode("both").alias("x"))
    alone = F.when(F.col("x.id").isNull(), F.col("x.place"))
    met = both.groupBy("_doc", "capture_id", F.col("x.id").alias("provider_contract_id"), alone.alias("_alone")).agg(
        F.min_by("x.strike_price", F.when(F.col("x.term"), F.col("x.place"))).alias("strike_price"),
        F.collect_list(F.when(~F.col("x.term"), F.struct("x.surface_state", "x.bid_price", "x.ask_price", "x.bars"))).alias("_entries"),
    )
    out = met.select("capture_id", "provider_contract_id", F.when(F.col("provider_contract_id").isNotNull(), F.col("strike_price")).alias("strike_price"), F.explode("_entries").alias("s"))
    return out.select("capture_id", "provider_contract_id", "s.surface_state", "s.bid_price", "s.ask_price", "strike_price", "s.bars")
