"""Queries of sources, search, quality, nested results, paging, sets and streams (S, H, J, N, T, U, R, rest of C, F and G)."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.functions import scalars
from tidemark.operators import ledger as L
from tidemark.operators import nested as N
from tidemark.operators import paging as T
from tidemark.operators import quality as Q
from tidemark.operators import search as H
from tidemark.plans import bindings as B
from tidemark.plans.ledgers import DAY, NEWS_SPEC
from tidemark.plans.registry import query
from tidemark.sources import export as E
from tidemark.sources import readers as R
from tidemark.sources.scratch import shared_path
from tidemark.streaming import ingest

# Sources. The driver's tables are written as files of the declared shape, then read back.


@query("S1_scan_ledger", f"WITH {B.OBS} SELECT key, seq, value, available_date FROM obs WHERE key BETWEEN 100 AND 900 AND available_date BETWEEN DATE '1996-01-01' AND DATE '1998-12-31'")
def scan(spark, sf_dir):
    rows = B.obs_ledger(spark, sf_dir).filter(F.col("key").between(100, 900))
    return rows.filter(F.col("available_date").between("1996-01-01", "1998-12-31")).select("key", "seq", "value", "available_date")


@query("S2_read_prices_csv_validated", f"WITH {B.BARS}, w AS (SELECT *, CASE WHEN volume % 5 = 0 THEN high + 1 ELSE low END AS low2, CASE WHEN symbol % 10 = 3 THEN 'bond' ELSE 'etf' END AS kind FROM bars), r AS (SELECT unnest([CASE WHEN kind = 'bond' THEN 'asset_type' END, CASE WHEN NOT (low2 <= least(open, close) AND high >= greatest(open, close) AND low2 <= high) THEN 'ohlc_consistent' END, CASE WHEN least(open, high, low2, close) <= 0 THEN 'positive' END]) AS rule FROM w) SELECT rule, count(*) AS n FROM r WHERE rule IS NOT NULL GROUP BY 1")
def prices_csv(spark, sf_dir):
    """Bars written as CSV, some with a wrong low or asset type; the rejects by rule."""
    path = shared_path(spark, "prices-csv")
    bars = B.bars(spark, sf_dir)
    low = F.when(F.col("volume") % 5 == 0, F.col("high") + 1).otherwise(F.col("low"))
    kind = F.when(F.col("symbol") % 10 == 3, "bond").otherwise("etf")
    bars.select(
        F.lit("p").alias("provider"), F.col("symbol").cast("string").alias("provider_symbol"), kind.alias("asset_type"), "trade_date", "open", "high", low.alias("low"), "close", "volume",
        F.lit("USD").alias("currency"), F.lit("raw").alias("price_variant"), F.col("trade_date").cast("string").alias("available_at"), F.lit("date").alias("available_precision"),
    ).write.csv(path, header=True)
    return Q.rejects(R.read_prices(spark, path), ["provider_symbol", "trade_date"]).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@query("S3_read_vintage_csv_validated", f"WITH {B.SERIES} SELECT series_id, count(*) AS n, count(*) FILTER (WHERE value IS NOT NULL AND day(period_start) <> 7) AS accepted FROM series GROUP BY 1")
def vintage_csv(spark, sf_dir):
    """A vintage file for each series; the seventh of the month has both value and reason, and is refused."""
    path = shared_path(spark, "vintage-csv")
    rows = B.event_series(spark, sf_dir)
    reason = F.when(F.dayofmonth("period_start") == 7, "source_suppressed")
    rows.select(
        "series_id", F.lit("u").alias("unit"), F.lit("daily").alias("frequency"), F.concat(F.lit("v-"), "series_id").alias("source_vintage_identity"), F.lit(1).alias("source_release_order"), F.col("period_start").cast("string").alias("available_at"),
        F.lit("date").alias("available_precision"), F.lit(True).alias("is_first_release"), "period_start", "period_end", "value", reason.alias("missing_reason"), F.col("series_id").alias("_file"),
    ).repartition("_file").write.partitionBy("_file").csv(path, header=True)
    read = R.read_vintages(spark, path + "/*/*.csv")
    return read.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("rejected") == 0).alias("accepted"))


@query("S4_read_macro_json", f"WITH {B.SERIES} SELECT series_id, 'u-' || series_id AS unit, count(*) AS observations, round(sum(value), 2) AS total FROM series WHERE value IS NOT NULL GROUP BY 1")
def macro_json(spark, sf_dir):
    """One document for each series, flattened again."""
    path = shared_path(spark, "macro-json")
    o = F.struct("series_id", F.lit("r1").alias("release_identity"), "period_start", "period_end", F.col("value").cast("decimal(18,2)").cast("string").alias("value"), F.lit(None).cast("string").alias("missing_reason"))
    docs = B.event_series(spark, sf_dir).filter("value IS NOT NULL").groupBy("series_id").agg(F.collect_list(o).alias("observations"))
    payload = F.struct(F.array(F.struct("series_id", F.concat(F.lit("u-"), "series_id").alias("unit"))).alias("series"), F.array(F.struct(F.lit("r1").alias("source_vintage_identity"), F.lit(1).alias("source_release_order"))).alias("releases"), "observations")
    docs.select(F.lit("events").alias("family"), F.lit("p").alias("provider"), F.lit("2024-02-01T00:00:00Z").alias("captured_at"), payload.alias("payload")).write.json(path)
    rows = R.macro_observations(R.read_document(spark, path, R.MACRO, lines=True))
    return rows.groupBy("series_id", "unit").agg(F.count(F.lit(1)).alias("observations"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total"))


@query("S5_read_company_json", "SELECT p_brand AS issuer_key, p_type AS concept, count(*) AS facts, round(sum(p_retailprice), 2) AS total FROM part GROUP BY 1, 2")
def company_json(spark, sf_dir):
    path = shared_path(spark, "company-json")
    fact = F.struct(F.col("p_brand").alias("issuer_key"), F.col("p_type").alias("concept"), F.lit("USD").alias("unit"), F.lit("2024-01-01").alias("period_end"), F.col("p_retailprice").cast("string").alias("value"))
    B.read(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_list(fact).alias("facts")).select("facts").write.json(path)
    facts = R.company_facts(R.read_document(spark, path, R.COMPANY, lines=True))
    return facts.groupBy("issuer_key", "concept").agg(F.count(F.lit(1)).alias("facts"), F.round(F.sum(F.col("value").cast("double")), 2).alias("total"))


@query("S6_read_option_capture_json", "SELECT p_brand AS capture_id, CASE WHEN p_size % 4 = 0 THEN 'missing' ELSE 'present' END AS surface_state, count(*) AS quotes, round(sum(p_retailprice), 2) AS strikes, sum(p_size % 3)::BIGINT AS bars FROM part GROUP BY 1, 2")
def option_json(spark, sf_dir):
    path = shared_path(spark, "option-json")
    contract = F.struct(F.col("p_partkey").cast("string").alias("provider_contract_id"), F.col("p_retailprice").alias("strike_price"), F.lit("call").alias("option_type"))
    bars = F.transform(F.slice(F.array(F.lit(1), F.lit(2)), F.lit(1), F.col("p_size") % 3), lambda i: F.struct(i.cast("string").alias("bar_start"), F.lit(1.0).alias("close")))
    quote = F.struct(F.lit(1.0).alias("bid_price"), F.lit(2.0).alias("ask_price"))
    entry = F.struct(F.col("p_partkey").cast("string").alias("provider_contract_id"), F.when(F.col("p_size") % 4 == 0, "missing").otherwise("present").alias("surface_state"), quote.alias("quote"), bars.alias("bars"))
    # a brand's parts are documents of at most 2000, so that none grows with the table
    docs = B.read(spark, sf_dir, "part").groupBy("p_brand", F.expr("p_partkey div 2000").alias("bundle")).agg(F.collect_list(contract).alias("contracts"), F.collect_list(entry).alias("surface"))
    docs.select(F.struct(F.col("p_brand").alias("capture_id"), F.lit("u").alias("underlying_key")).alias("capture"), "contracts", "surface").write.json(path)
    quotes = R.option_quotes(R.read_document(spark, path, R.OPTIONS, lines=True))
    return quotes.groupBy("capture_id", "surface_state").agg(F.count(F.lit(1)).alias("quotes"), F.round(F.sum("strike_price"), 2).alias("strikes"), F.sum("bars").alias("bars"))


@query("S7_read_news_json", "SELECT CAST(doc_id AS VARCHAR) AS source_item_id, lang AS topic FROM documents")
def news_json(spark, sf_dir):
    path = shared_path(spark, "news-json")
    labels = F.struct(F.array(F.struct(F.col("lang").alias("topic"), F.lit(1.0).alias("confidence"))).alias("topics"))
    item = F.struct(F.col("doc_id").cast("string").alias("source_item_id"), F.lit("active").alias("item_state"), F.struct(F.col("text").alias("headline")).alias("content"), labels.alias("labels"))
    docs = B.read(spark, sf_dir, "documents").withColumn("bundle", F.col("doc_id") % 50).groupBy("source", "bundle").agg(F.collect_list(item).alias("items"))
    docs.select(F.col("source").alias("source_name"), "items").write.json(path)
    return R.news_labels(R.read_document(spark, path, R.NEWS, lines=True)).select("source_item_id", "topic")


@query("S8_read_catalog_json", f"WITH {B.INTERVALS} SELECT 'i' || symbol AS instrument_key, CAST(target AS VARCHAR) AS provider_symbol, valid_from, valid_through FROM intervals")
def catalog_json(spark, sf_dir):
    path = shared_path(spark, "catalog-json")
    identifier = F.struct(F.lit("p").alias("provider"), F.col("target").cast("string").alias("provider_symbol"), "valid_from", "valid_through")
    one = B.intervals(spark, sf_dir).groupBy("symbol").agg(F.collect_list(identifier).alias("identifiers"))
    instrument = F.struct(F.concat(F.lit("i"), "symbol").alias("instrument_key"), F.lit("etf").alias("asset_type"), "identifiers")
    one.groupBy((F.col("symbol") % 40).alias("document")).agg(F.collect_list(instrument).alias("instruments")).select("instruments").write.json(path)
    return R.catalog_identifiers(R.read_document(spark, path, R.CATALOG, lines=True)).select("instrument_key", "provider_symbol", "valid_from", "valid_through")


@query("S9_read_bars_json_array", f"WITH {B.BARS} SELECT CAST(symbol AS VARCHAR) AS symbol, count(*) AS bars, count(*) FILTER (WHERE low > 0 AND volume % 6 <> 0) AS accepted FROM bars GROUP BY 1")
def bars_json(spark, sf_dir):
    """Bars as JSON; those of a volume divisible by six have a high below the low."""
    path = shared_path(spark, "bars-json")
    high = F.when(F.col("volume") % 6 == 0, F.col("low") - 1).otherwise(F.col("high"))
    B.bars(spark, sf_dir).select(F.col("symbol").cast("string").alias("symbol"), "trade_date", "open", high.alias("high"), "low", "close", "volume").write.json(path)
    return R.read_bar_arrays(spark, path, lines=True).groupBy("symbol").agg(F.count(F.lit(1)).alias("bars"), F.count_if(F.size("rejected") == 0).alias("accepted"))


@query("S10_write_ledger_append", f"WITH {B.OBS} SELECT year(available_date) AS year, count(*) AS versions, round(sum(value), 2) AS total FROM obs GROUP BY 1")
def write_ledger(spark, sf_dir):
    """The ledger appended in two batches and read back."""
    path = shared_path(spark, "ledger")
    rows = B.obs_ledger(spark, sf_dir).withColumn("year", F.year("available_date"))
    for odd in (0, 1):
        E.append_ledger(rows.filter(F.col("seq") % 2 == odd).repartition("year"), path, ["year"])
    return spark.read.parquet(path).groupBy("year").agg(F.count(F.lit(1)).alias("versions"), F.round(F.sum("value"), 2).alias("total"))


_CHUNKED = "placed AS (SELECT *, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS position FROM orders), lined AS (SELECT *, o_orderkey || '|' || o_custkey || '|' || o_orderstatus AS line FROM placed), chunks AS (SELECT CAST(floor(position / 250) AS BIGINT) AS chunk_id, count(*) AS rows, sum(strlen(line) + 1)::BIGINT AS bytes, sha256(string_agg(line, chr(10) ORDER BY position)) AS sha256, arg_min(CAST(o_orderdate AS DATE) || '|' || o_orderkey, position) AS first_key, arg_max(CAST(o_orderdate AS DATE) || '|' || o_orderkey, position) AS last_key FROM lined GROUP BY 1)"


def _chunks(spark, sf_dir):
    rows = B.read(spark, sf_dir, "orders").select(F.col("o_orderdate").cast("date").alias("day"), "o_orderkey", F.concat_ws("|", "o_orderkey", "o_custkey", "o_orderstatus").alias("line"))
    return E.chunk_manifest(rows, ["day", "o_orderkey"], F.col("line"))


@query("S11_export_snapshot_chunks", f"WITH {_CHUNKED} SELECT *, bytes > 262144 AS over_bytes FROM chunks")
def export_chunks(spark, sf_dir):
    return _chunks(spark, sf_dir)


@query("S12_export_manifest", f"WITH {_CHUNKED}, t1 AS (SELECT chunk_id // 1000 AS n, sha256(string_agg(sha256, ',' ORDER BY chunk_id)) AS d FROM chunks GROUP BY 1), t2 AS (SELECT n // 1000 AS n, sha256(string_agg(d, ',' ORDER BY n)) AS d FROM t1 GROUP BY n // 1000), t3 AS (SELECT sha256(string_agg(d, ',' ORDER BY n)) AS d FROM t2) SELECT count(*) AS chunks, sum(rows)::BIGINT AS rows, arg_min(first_key, chunk_id) AS first_key, arg_max(last_key, chunk_id) AS last_key, (SELECT d FROM t3) AS revision FROM chunks")
def export_manifest(spark, sf_dir):
    return E.export_manifest(_chunks(spark, sf_dir))


# Digests and surfaces.


@query("G6_table_digest", r"SELECT o_orderstatus AS part, count(*) AS n, CAST(sum(CAST('0x' || substr(md5(length(o_orderkey::VARCHAR) || ':' || o_orderkey || length(o_custkey::VARCHAR) || ':' || o_custkey || coalesce(length(o_orderpriority) || ':' || o_orderpriority, 'N')), 1, 15) AS BIGINT)::HUGEINT) AS VARCHAR) AS digest FROM orders GROUP BY 1")
def table_digest(spark, sf_dir):
    rows = B.read(spark, sf_dir, "orders").withColumnRenamed("o_orderstatus", "part")
    return Q.table_digest(rows, [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderpriority")], ["part"])


@query("G7_semantic_identity", "WITH r AS (SELECT o_custkey AS batch, length(o_orderstatus) || ':' || o_orderstatus || length(o_orderpriority) || ':' || o_orderpriority AS line FROM orders) SELECT batch, sha256(string_agg(line, chr(10) ORDER BY line)) AS identity FROM r GROUP BY 1")
def identity(spark, sf_dir):
    return Q.semantic_identity(B.read(spark, sf_dir, "orders").withColumnRenamed("o_custkey", "batch"), ["batch"], [F.col("o_orderstatus"), F.col("o_orderpriority")])


_SURFACE = f"quotes AS (SELECT l_partkey AS contract, arg_max(l_extendedprice, (l_shipdate, l_orderkey, l_linenumber, l_extendedprice)) AS last_price FROM lineitem WHERE l_shipdate <= DATE '{DAY}' GROUP BY 1), interest AS (SELECT l_partkey AS contract, count(*) AS open_interest FROM lineitem WHERE l_returnflag = 'A' AND l_shipdate <= DATE '{DAY}' GROUP BY 1), closes AS (SELECT l_partkey AS contract, max(l_extendedprice) AS close FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1)"


def _surface_parts(spark, sf_dir):
    lines = B.read(spark, sf_dir, "lineitem").withColumnRenamed("l_partkey", "contract")
    seen = lines.filter(F.col("l_shipdate") <= F.lit(DAY).cast("date"))
    contracts = B.read(spark, sf_dir, "part").select(F.col("p_partkey").alias("contract"), F.col("p_retailprice").alias("strike"), F.col("p_type").alias("kind"), "p_size")
    quotes = seen.groupBy("contract").agg(F.max_by("l_extendedprice", F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice")).alias("last_price"))
    interest = seen.filter("l_returnflag = 'A'").groupBy("contract").agg(F.count(F.lit(1)).alias("open_interest"))
    closes = lines.filter("l_linestatus = 'F'").groupBy("contract").agg(F.max("l_extendedprice").alias("close"))
    bars = seen.select("contract", F.col("l_shipdate").cast("date").alias("bar_date"), F.col("l_extendedprice").alias("price"))
    return contracts, quotes, interest, closes, bars


@query("C8_surface_left_joins", f"WITH {_SURFACE}, b AS (SELECT l_partkey AS contract, count(*) AS n, min(CAST(l_shipdate AS DATE)) AS first_bar FROM lineitem WHERE l_shipdate <= DATE '{DAY}' GROUP BY 1) SELECT p_partkey AS contract, p_retailprice AS strike, last_price, open_interest, close, coalesce(b.n, 0)::INT AS bars, first_bar FROM part JOIN quotes q ON q.contract = p_partkey LEFT JOIN interest i ON i.contract = p_partkey LEFT JOIN closes c ON c.contract = p_partkey LEFT JOIN b ON b.contract = p_partkey")
def surface(spark, sf_dir):
    contracts, quotes, interest, closes, bars = _surface_parts(spark, sf_dir)
    out = N.surface(contracts, quotes, interest, closes, bars, ["contract"], ["bar_date", "price"])
    return out.select("contract", "strike", "last_price", "open_interest", "close", F.size("bars").alias("bars"), F.get("bars", F.lit(0))["bar_date"].alias("first_bar"))


@query("N1_option_surface_snapshot", f"WITH {_SURFACE}, cap AS (SELECT o_custkey AS underlying, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS capture FROM orders WHERE o_orderdate <= DATE '{DAY}' GROUP BY 1) SELECT underlying, capture, l_partkey AS contract, last_price, CASE WHEN l_partkey IS NULL THEN 'not_available' ELSE 'present' END AS surface_state FROM cap LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem) l ON l_orderkey = capture LEFT JOIN quotes q ON q.contract = l_partkey")
def surface_snapshot(spark, sf_dir):
    """The last capture of each underlying with a row for each contract; one row not_available where it has none."""
    captures = B.read(spark, sf_dir, "orders").filter(F.col("o_orderdate") <= F.lit(DAY).cast("date")).groupBy(F.col("o_custkey").alias("underlying")).agg(F.max_by("o_orderkey", F.struct("o_orderdate", "o_orderkey")).alias("capture"))
    held = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("capture"), F.col("l_partkey").alias("contract")).distinct()
    quotes = _surface_parts(spark, sf_dir)[1]
    state = F.when(F.col("contract").isNull(), "not_available").otherwise("present")
    return captures.join(held, "capture", "left").join(quotes, "contract", "left").select("underlying", "capture", "contract", "last_price", state.alias("surface_state"))


@query("N2_option_capture_nested", "SELECT o_orderkey AS capture, o_custkey AS underlying, coalesce(count(l_orderkey), 0)::INT AS points, string_agg(l_linenumber || ':' || l_partkey, ',' ORDER BY l_linenumber, l_partkey, l_suppkey) AS curve FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey GROUP BY 1, 2")
def capture_nested(spark, sf_dir):
    """Captures with their curve's points as a sorted array, here written as a text too."""
    lines = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("capture"), "l_linenumber", "l_partkey", "l_suppkey")
    captures = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("capture"), F.col("o_custkey").alias("underlying"))
    out = N.nest(captures, ["capture"], {"curve": (lines, ["l_linenumber", "l_partkey", "l_suppkey"])})
    text = F.array_join(F.transform("curve", lambda c: F.concat_ws(":", c["l_linenumber"], c["l_partkey"])), ",")
    return out.select("capture", "underlying", F.size("curve").alias("points"), F.when(F.size("curve") > 0, text).alias("curve"))


@query("N3_news_labels_nested", "SELECT d.doc_id, coalesce(string_agg(l.quality || '/' || l.toxic, ',' ORDER BY l.quality, l.toxic), '') AS labels, d.lang AS geography FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id GROUP BY 1, 3")
def labels_nested(spark, sf_dir):
    docs = B.read(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("geography"))
    out = N.nest(docs, ["doc_id"], {"labels": (B.read(spark, sf_dir, "labels"), ["quality", "toxic"])})
    return out.select("doc_id", F.array_join(F.transform("labels", lambda x: F.concat_ws("/", x["quality"], x["toxic"])), ",").alias("labels"), "geography")


_RECESSIONS = f"{B.ORDER_SERIES}, m AS (SELECT CAST(date_trunc('month', period_start) AS DATE) AS month, sum(value) AS v FROM orders_daily WHERE series_id = 'ALL' GROUP BY 1), f AS (SELECT month, v < lag(v) OVER (ORDER BY month) AS down FROM m), g AS (SELECT month, down, row_number() OVER (ORDER BY month) - row_number() OVER (PARTITION BY down ORDER BY month) AS run FROM f), recessions AS (SELECT min(month) AS peak, max(month) AS trough, count(*) AS months FROM g WHERE down GROUP BY run)"


def _recessions(spark, sf_dir):
    """Runs of falling months of the order totals stand for recessions."""
    monthly = B.order_series(spark, sf_dir).filter("series_id = 'ALL'").groupBy(F.trunc("period_start", "month").alias("month")).agg(F.sum("value").alias("v"))
    w = Window.orderBy("month")
    falling = monthly.withColumn("down", F.col("v") < F.lag("v").over(w)).withColumn("run", F.row_number().over(w) - F.row_number().over(Window.partitionBy("down").orderBy("month")))
    return falling.filter("down").groupBy("run").agg(F.min("month").alias("peak"), F.max("month").alias("trough"), F.count(F.lit(1)).alias("months")).drop("run")


@query("N4_recession_chronology", f"WITH {_RECESSIONS} SELECT * FROM recessions")
def recessions(spark, sf_dir):
    return _recessions(spark, sf_dir).orderBy("peak")


# Search.

_FOLD = f"translate(lower(text), '{H.ACCENTS[0]}', '{H.ACCENTS[1]}')"


def _bm25_sql(terms, source="documents", key="doc_id", after=""):
    tf = ", ".join(f"CAST(len(list_filter(t, lambda w: w = '{x}')) AS DOUBLE) AS tf{i}" for i, x in enumerate(terms))
    df = ", ".join(f"count(*) FILTER (WHERE tf{i} > 0) AS df{i}" for i in range(len(terms)))
    score = " + ".join(f"ln((docs - df{i} + 0.5) / (df{i} + 0.5) + 1) * tf{i} * 2.2 / (tf{i} + 1.2 * (0.25 + 0.75 * n / mean))" for i in range(len(terms)))
    return f"tok AS (SELECT {key}, list_filter(regexp_split_to_array({_FOLD}, '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> '') AS t FROM {source} WHERE text IS NOT NULL), hits AS (SELECT {key}, len(t) AS n, {tf} FROM tok), st AS (SELECT count(*) AS docs, avg(n) AS mean, {df} FROM hits) SELECT {key}, round({score}, 6) AS score FROM hits, st WHERE {' AND '.join(f'tf{i} > 0' for i in range(len(terms)))}{after}"


@query("H1_news_search_bm25", "WITH " + _bm25_sql(["the", "of"]))
def search(spark, sf_dir):
    docs = B.read(spark, sf_dir, "documents").select("doc_id", "text")
    return H.bm25(docs, ["doc_id"], F.col("text"), "The of").select("doc_id", F.round("score", 6).alias("score"))


@query("H1_news_search_of_latest", f"WITH {B.NEWS}, v AS (SELECT item * 1000 + version AS id, body AS text FROM news), last AS (SELECT item * 1000 + version AS id FROM (SELECT *, row_number() OVER (PARTITION BY item ORDER BY version DESC) AS rn FROM news) t WHERE rn = 1 AND state = 'active'), " + _bm25_sql(["and"], "v", "id", " AND id IN (SELECT id FROM last)"))
def search_latest(spark, sf_dir):
    """Frequencies are taken over all versions, hits are the latest active ones."""
    news = B.news(spark, sf_dir).withColumn("id", F.col("item") * 1000 + F.col("version"))
    last = L.ledger_select(news, NEWS_SPEC).select("id")
    return H.bm25(news, ["id"], F.col("body"), "and").join(last, "id", "left_semi").select("id", F.round("score", 6).alias("score"))


@query("H2_issuer_lookup", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (7, 42)")
def lookup(spark, sf_dir):
    """Exact ten-digit identifiers only."""
    cik = F.format_string("%010d", "c_custkey")
    return B.read(spark, sf_dir, "customer").filter(cik.isin("0000000007", "0000000042")).select("c_custkey", "c_name")


@query("F7_safe_terms", "SELECT p_partkey FROM part WHERE contains(lower(p_name), 'red') AND contains(lower(p_name), 'ring')")
def terms(spark, sf_dir):
    """Every safe term of a search must be in the name."""
    rows = B.read(spark, sf_dir, "part")
    for term in scalars.safe_terms("Red ring"):
        rows = rows.filter(scalars.contains_literal(term, F.col("p_name")))
    return rows.select("p_partkey")


@query("F13_like_escape", "SELECT count(*) AS n FROM (SELECT p_name || CASE WHEN p_partkey % 4 = 0 THEN ' 100%_x' ELSE '' END AS t FROM part) WHERE contains(lower(t), '100%_')")
def like_escape(spark, sf_dir):
    """Wildcards in a search text are ordinary characters."""
    text = F.concat("p_name", F.when(F.col("p_partkey") % 4 == 0, F.lit(" 100%_x")).otherwise(F.lit("")))
    return B.read(spark, sf_dir, "part").filter(scalars.contains_literal("100%_", text)).agg(F.count(F.lit(1)).alias("n"))


# Quality.

_RULES = {"quantity": "l_quantity < 50", "discount": "l_discount <= 0.09", "shipped_in_scope": "l_shipdate < DATE '2001-01-01'"}


def _checked(spark, sf_dir):
    rules = {"quantity": F.col("l_quantity") < 50, "discount": F.col("l_discount") <= 0.09, "shipped_in_scope": F.col("l_shipdate") < F.lit("2001-01-01").cast("date")}
    return Q.check_rows(B.read(spark, sf_dir, "lineitem"), rules)


@query("J1_validate_rows", " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, l_partkey, '{n}' AS rule FROM lineitem WHERE NOT ({r})" for n, r in _RULES.items()))
def validate(spark, sf_dir):
    return Q.rejects(_checked(spark, sf_dir), ["l_orderkey", "l_linenumber", "l_partkey"])


@query("J2_batch_duplicates", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicates(spark, sf_dir):
    return Q.duplicates(B.read(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("J3_coverage_reconcile", f"WITH {B.BARS}, e AS (SELECT symbol, d FROM (SELECT DISTINCT symbol FROM bars), (SELECT unnest(generate_series(DATE '2024-01-01', DATE '2024-01-25', INTERVAL 1 DAY))::DATE AS d)), o AS (SELECT symbol, trade_date AS d, count(*) AS n FROM (SELECT symbol, trade_date FROM bars UNION ALL SELECT symbol, trade_date FROM bars WHERE volume % 4 = 0) GROUP BY 1, 2) SELECT coalesce(e.symbol, o.symbol) AS symbol, coalesce(e.d, o.d) AS trade_date, CASE WHEN o.n IS NULL THEN 'missing' WHEN e.d IS NULL THEN 'extra' ELSE 'duplicate' END AS status FROM e FULL OUTER JOIN o ON e.symbol = o.symbol AND e.d = o.d WHERE o.n IS NULL OR e.d IS NULL OR o.n > 1")
def coverage(spark, sf_dir):
    """Each symbol's expected days against its bars; some bars come twice."""
    bars = B.bars(spark, sf_dir).select("symbol", "trade_date", "volume")
    days = F.explode(F.sequence(F.lit("2024-01-01").cast("date"), F.lit("2024-01-25").cast("date")))
    expected = bars.select("symbol").distinct().withColumn("trade_date", days)
    return Q.coverage(expected, bars.union(bars.filter("volume % 4 = 0")), ["symbol", "trade_date"])


@query("J4_ledger_audit", f"WITH {B.OBS}, v AS (SELECT key, seq, CASE WHEN partkey % 13 = 0 THEN NULL ELSE value END AS value, CASE WHEN partkey % 17 = 0 THEN 'r' END AS reason, state, CASE WHEN state = 'tombstone' AND suppkey % 2 = 0 THEN 'omitted' END AS state_reason FROM obs) SELECT key, seq, 'value_xor_reason' AS rule FROM v WHERE (value IS NULL) = (reason IS NULL) UNION ALL SELECT key, seq, 'tombstone_has_reason' FROM v WHERE state = 'tombstone' AND state_reason IS NULL")
def ledger_audit(spark, sf_dir):
    rows = B.obs_ledger(spark, sf_dir)
    v = rows.select("key", "seq", F.when(F.col("partkey") % 13 != 0, F.col("value")).alias("value"), F.when(F.col("partkey") % 17 == 0, "r").alias("reason"), "state", F.when((F.col("state") == "tombstone") & (F.col("suppkey") % 2 == 0), "omitted").alias("state_reason"))
    rules = {"value_xor_reason": F.col("value").isNull() != F.col("reason").isNull(), "tombstone_has_reason": (F.col("state") != "tombstone") | F.col("state_reason").isNotNull()}
    return Q.rejects(Q.check_rows(v, rules), ["key", "seq"])


@query("J5_referential_audit", "SELECT o_orderkey AS id, 'order_customer' AS rule FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey <> 3) UNION ALL SELECT c_custkey, 'customer_nation' FROM customer WHERE c_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey <> 2)")
def referential(spark, sf_dir):
    orders, customers = B.read(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "id"), B.read(spark, sf_dir, "customer")
    a = Q.dangling(orders, ["id"], customers.filter("c_nationkey <> 3"), {"o_custkey": "c_custkey"}, "order_customer")
    b = Q.dangling(customers.withColumnRenamed("c_custkey", "id"), ["id"], B.read(spark, sf_dir, "nation").filter("n_regionkey <> 2"), {"c_nationkey": "n_nationkey"}, "customer_nation")
    return a.unionByName(b)


@query("J6_event_ambiguity", "SELECT o_custkey AS issuer, CAST(o_orderdate AS DATE) AS event_date, count(*) AS events, list_sort(list(DISTINCT o_orderkey)) AS candidates FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def ambiguity(spark, sf_dir):
    slots = B.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("issuer"), F.col("o_orderdate").cast("date").alias("event_date"))
    return slots.agg(F.count(F.lit(1)).alias("events"), F.array_sort(F.collect_set("o_orderkey")).alias("candidates")).filter("events > 1")


@query("J7_page_completeness", "SELECT l_orderkey AS batch, sum(l_quantity)::BIGINT AS rows, min(l_linenumber) = 1 AND max(l_linenumber) = count(*) AND count(*) = count(DISTINCT l_linenumber) AS complete FROM lineitem GROUP BY 1")
def pages(spark, sf_dir):
    rows = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("batch"), F.col("l_linenumber").alias("page"), F.col("l_quantity").cast("long").alias("row_count"))
    return Q.page_faults(rows, ["batch"])


@query("J8_surface_coverage", "WITH s AS (SELECT l_partkey AS contract, count(*) AS n FROM lineitem GROUP BY 1) SELECT coalesce(p_partkey, contract) AS contract, CASE WHEN n IS NULL THEN 'missing' WHEN p_partkey IS NULL THEN 'extra' ELSE 'duplicate' END AS status FROM (SELECT p_partkey FROM part WHERE p_size > 10) p FULL OUTER JOIN s ON contract = p_partkey WHERE n IS NULL OR p_partkey IS NULL OR n > 1")
def surface_coverage(spark, sf_dir):
    """Each declared contract has exactly one surface row."""
    contracts = B.read(spark, sf_dir, "part").filter("p_size > 10").select(F.col("p_partkey").alias("contract"))
    rows = B.read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("contract"))
    return Q.coverage(contracts, rows, ["contract"])


@query("J9_expiry_input_sync", "WITH r AS (SELECT l_orderkey AS capture, list(DISTINCT l_tax) AS rates FROM lineitem GROUP BY 1) SELECT l_orderkey AS capture, l_linenumber AS expiry, count(*) AS n FROM lineitem JOIN r ON capture = l_orderkey WHERE NOT list_contains(rates, l_discount) GROUP BY 1, 2")
def expiry_inputs(spark, sf_dir):
    """Inputs whose rate isn't a point of the same capture's curve."""
    lines = B.read(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("capture"), F.col("l_linenumber").alias("expiry"), "l_tax", "l_discount")
    curve = lines.groupBy("capture").agg(F.collect_set("l_tax").alias("rates"))
    return lines.join(curve, "capture").filter(~F.array_contains("rates", F.col("l_discount"))).groupBy("capture", "expiry").agg(F.count(F.lit(1)).alias("n"))


@query("J10_cohort_context", "SELECT l_orderkey AS capture, l_linenumber AS line, l_partkey AS contract FROM lineitem JOIN orders ON o_orderkey = l_orderkey WHERE NOT CAST(l_shipdate AS DATE) <= CAST(o_orderdate AS DATE) + 30")
def cohort_context(spark, sf_dir):
    """Rows that became available later than their capture, here more than thirty days after the order."""
    captures = B.read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.date_add(F.col("o_orderdate").cast("date"), 30).alias("limit"))
    lines = B.read(spark, sf_dir, "lineitem").join(captures, "l_orderkey")
    return lines.filter(F.col("l_shipdate").cast("date") > F.col("limit")).select(F.col("l_orderkey").alias("capture"), F.col("l_linenumber").alias("line"), F.col("l_partkey").alias("contract"))


@query("J11_quality_result_rows", "WITH r AS (" + " UNION ALL ".join(f"SELECT '{n}' AS rule_id, count(*) FILTER (WHERE NOT ({r})) AS observed, count(*) AS subjects FROM lineitem" for n, r in _RULES.items()) + ") SELECT rule_id, 'error' AS severity, CASE WHEN observed = 0 THEN 'pass' ELSE 'fail' END AS outcome, observed, subjects FROM r")
def quality_results(spark, sf_dir):
    checked = _checked(spark, sf_dir)
    return Q.result_rows(Q.rejects(checked, ["l_orderkey"]), checked, list(_RULES))


@query("J12_batch_state_gate", "SELECT o_custkey AS dataset, arg_max(o_orderkey, (o_orderdate, o_orderkey)) FILTER (WHERE o_orderstatus = 'F') AS last_complete, count(*) FILTER (WHERE o_orderstatus <> 'F') AS ignored FROM orders GROUP BY 1")
def state_gate(spark, sf_dir):
    """Only complete captures count as a dataset's state."""
    done = F.col("o_orderstatus") == "F"
    return B.read(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("dataset")).agg(F.max_by(F.when(done, F.col("o_orderkey")), F.when(done, F.struct("o_orderdate", "o_orderkey"))).alias("last_complete"), F.count_if(~done).alias("ignored"))


# Orders, pages, sets.


@query("T1_total_order", "SELECT o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS place FROM orders")
def total_order(spark, sf_dir):
    w = Window.partitionBy("o_custkey").orderBy(F.col("o_orderdate").desc(), "o_orderkey")
    return B.read(spark, sf_dir, "orders").select("o_orderkey", F.row_number().over(w).alias("place"))


@query("T2_limit_with_truncation", "SELECT o_orderkey, (SELECT count(*) FROM orders) > 100 AS truncated FROM orders ORDER BY o_orderdate, o_orderkey LIMIT 100")
def limit(spark, sf_dir):
    first, more = T.limited(B.read(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], 100)
    return first.select("o_orderkey", F.lit(more).alias("truncated"))


@query("T3_table_page", "SELECT c_custkey, c_name, c_acctbal FROM customer WHERE contains(lower(c_name), '00') ORDER BY c_acctbal DESC, c_custkey LIMIT 25 OFFSET 50")
def table_page(spark, sf_dir):
    found = B.read(spark, sf_dir, "customer").filter(scalars.contains_literal("00", F.col("c_name")))
    return T.page(found, "c_acctbal", ["c_acctbal", "c_name"], ["c_custkey"], 25, 3, descending=True).select("c_custkey", "c_name", "c_acctbal")


@query("G5_count_total_pages", "SELECT count(*) AS total_rows, CAST(ceil(count(*) / 25) AS BIGINT) AS page_count, ceil(count(*) / 25) < 1000 AS out_of_range FROM customer")
def total_pages(spark, sf_dir):
    return T.pages_of(B.read(spark, sf_dir, "customer"), 25, 1000)


@query("T4_order_uniqueness", "SELECT o_custkey, o_orderdate, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def order_uniqueness(spark, sf_dir):
    return T.order_ties(B.read(spark, sf_dir, "orders"), ["o_custkey", "o_orderdate"])


@query("T5_deterministic_sample", "SELECT o_custkey, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS i, count(*) OVER (PARTITION BY o_custkey) AS n FROM orders) t WHERE i IN (1, n // 2 + 1, n)")
def sample(spark, sf_dir):
    return T.first_middle_last(B.read(spark, sf_dir, "orders"), ["o_custkey"], ["o_orderkey"]).select("o_custkey", "o_orderkey")


_KEYS = {"U1_key_intersection": "INTERSECT", "U2_key_union": "UNION", "U3_key_difference": "EXCEPT"}

for _name, _op in _KEYS.items():

    @query(_name, f"SELECT CAST(o_orderdate AS DATE) AS day FROM orders WHERE o_orderpriority = '1-URGENT' {_op} SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '2-HIGH'")
    def _keys(spark, sf_dir, op=_op):
        days = lambda p: B.read(spark, sf_dir, "orders").filter(F.col("o_orderpriority") == p).select(F.col("o_orderdate").cast("date").alias("day"))
        a, b = days("1-URGENT"), days("2-HIGH")
        return {"INTERSECT": lambda: a.intersect(b), "UNION": lambda: a.union(b).distinct(), "EXCEPT": lambda: a.subtract(b)}[op]()


@query("U4_distinct_bridge", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def distinct(spark, sf_dir):
    return B.read(spark, sf_dir, "lineitem").select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("U5_capture_diff", f"WITH {B.BARS}, a AS (SELECT symbol, trade_date, close FROM bars WHERE symbol % 9 <> 0), b AS (SELECT symbol, trade_date, CASE WHEN volume % 3 = 0 THEN close + 1 ELSE close END AS close FROM bars WHERE symbol % 8 <> 0) SELECT coalesce(a.symbol, b.symbol) AS symbol, coalesce(a.trade_date, b.trade_date) AS trade_date, CASE WHEN a.symbol IS NULL THEN 'added' WHEN b.symbol IS NULL THEN 'removed' ELSE 'changed' END AS change FROM a FULL OUTER JOIN b ON a.symbol = b.symbol AND a.trade_date = b.trade_date WHERE a.close IS DISTINCT FROM b.close")
def capture_diff(spark, sf_dir):
    bars = B.bars(spark, sf_dir)
    later = bars.filter("symbol % 8 <> 0").withColumn("close", F.when(F.col("volume") % 3 == 0, F.col("close") + 1).otherwise(F.col("close")))
    return Q.capture_diff(bars.filter("symbol % 9 <> 0"), later, ["symbol", "trade_date"], ["close"])


# Streams: the tables as streams of files, run to their end.


@query("R1_stream_replay_dedupe", "SELECT user_id, event_type, count(*) AS n FROM (SELECT DISTINCT user_id, event_type, CAST(date_trunc('hour', ts) AS TIMESTAMP) AS h FROM events) t GROUP BY 1, 2")
def stream_dedupe(spark, sf_dir):
    """Events' identities once in the stream of them, counted afterwards."""
    path, done = shared_path(spark, "deduped"), shared_path(spark, "deduped-offsets")
    source = shared_path(spark, "events-stream")
    B.read(spark, sf_dir, "events").select("user_id", "event_type", F.date_trunc("hour", "ts").cast("timestamp").alias("h")).write.parquet(source)
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 4).parquet(source)
    once = ingest.replay_dedupe(stream, ["user_id", "event_type", "h"], "h", "60 days")
    once.writeStream.format("parquet").option("path", path).option("checkpointLocation", done).trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(path).groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("R2_stream_ledger_append", f"WITH {B.OBS}, o AS (SELECT suppkey AS subject, available_date AS known_on, key, seq, CAST(quantity / 25 AS INTEGER) AS band FROM obs), m AS (SELECT *, lag(band) OVER w IS NOT DISTINCT FROM band AND lag(seq) OVER w IS NOT NULL AS same FROM o WINDOW w AS (PARTITION BY subject ORDER BY known_on, key, seq)) SELECT subject, count(*) AS versions, arg_max(band, (known_on, key, seq)) AS current_band FROM m WHERE NOT same GROUP BY 1")
def stream_append(spark, sf_dir):
    """Observations year by year as micro-batches; the ledger that they leave is the batch twin's."""
    source, path, done = (shared_path(spark, n) for n in ("observed-stream", "stream-ledger", "stream-ledger-offsets"))
    rows = B.obs_ledger(spark, sf_dir).select(F.col("suppkey").alias("subject"), F.col("available_date").alias("known_on"), "key", "seq", F.round(F.col("quantity") / 25).cast("int").alias("band"))
    spec = L.LedgerSpec(key=("subject",), rank=("known_on", "key", "seq"), payload=("band",))
    cuts = ["1900-01-01", "1996-01-01", "1999-01-01", "9999-12-31"]
    for a, b in zip(cuts, cuts[1:]):  # what was written since is the next micro-batch
        rows.filter((F.col("known_on") >= F.lit(a).cast("date")) & (F.col("known_on") < F.lit(b).cast("date"))).write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).parquet(source)
        ingest.run_ledger_stream(stream, spec, path, spec.rank, done).awaitTermination()
    ledger = spark.read.parquet(path)
    return ledger.groupBy("subject").agg(F.count(F.lit(1)).alias("versions"), F.max_by("band", F.struct("known_on", "key", "seq")).alias("current_band"))
