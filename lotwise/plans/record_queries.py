"""Queries on records: projections of two sources, merges, lookups, scalar functions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, dates, geo, numbers, texts
from ..operators import dedupe, load, merge, normalize, records
from .registry import query, read


@query("""SELECT c_custkey AS id, c_name AS url, CAST(round_even(c_acctbal, 0) AS INT) AS aluguel, 0 AS venda, n_name AS bairro, 'customer' AS fonte FROM customer JOIN nation ON c_nationkey = n_nationkey
UNION ALL SELECT s_suppkey, s_name, 0, CAST(round_even(s_acctbal, 0) AS INT), n_name, 'supplier' FROM supplier JOIN nation ON s_nationkey = n_nationkey""")
def f03_two_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("nation"), F.col("n_name").alias("bairro"))
    one = read(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("url"), F.bround("c_acctbal").cast("int").alias("aluguel"), F.col("c_nationkey").alias("nation"), F.lit("customer").alias("fonte"))
    two = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("url"), F.bround("s_acctbal").cast("int").alias("venda"), F.col("s_nationkey").alias("nation"), F.lit("supplier").alias("fonte"))
    both = one.unionByName(two, allowMissingColumns=True).join(nation, "nation").drop("nation")
    return records.fill_defaults(both)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CASE o_orderstatus WHEN 'F' THEN 0 ELSE 1 END, o_orderdate DESC, o_orderkey DESC) AS n FROM orders WHERE o_orderstatus IN ('F', 'O'))
SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice FROM r WHERE n = 1""")
def f09_sale_over_rent(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    sale, rent = o.where("o_orderstatus = 'F'"), o.where("o_orderstatus = 'O'")
    return dedupe.with_priority([sale, rent], "o_custkey", ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_orderstatus", "o_totalprice")


@query("""WITH o AS (SELECT o_custkey, max_by(o_orderkey, (o_orderdate, o_orderkey)) AS o_orderkey FROM orders GROUP BY 1)
SELECT CAST(coalesce(s_suppkey, o_custkey) AS VARCHAR) AS id, s_name AS listing, o_orderkey AS point, s_suppkey IS NULL AS stub FROM supplier FULL JOIN o ON s_suppkey = o_custkey""")
def f10_listings_and_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    listings = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").cast("string").alias("id"), F.col("s_name").alias("raw"), F.current_timestamp().alias("o_orderdate"), F.lit(0).alias("o_orderkey"))
    points = read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("string").alias("id"), F.col("o_orderkey").alias("raw"), "o_orderdate", "o_orderkey")
    return merge.listings_and_points(listings, points, ["o_orderdate", "o_orderkey"])


F11 = """SELECT d.doc_id AS id, {area} AS area, {rooms} AS rooms, coalesce(d.lang, l.lang) AS lang FROM
(SELECT doc_id, CAST(n_chars % 3 AS INT) AS area, CAST(NULL AS INT) AS rooms, nullif(lang, 'en') AS lang FROM documents) d LEFT JOIN
(SELECT doc_id, quality + 10 AS area, toxic AS rooms, 'label' AS lang FROM labels) l ON d.doc_id = l.doc_id"""


def _documents_and_labels(spark: SparkSession, sf_dir: str, mode: str) -> DataFrame:
    d = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), (F.col("n_chars") % 3).cast("int").alias("area"), F.lit(None).cast("int").alias("rooms"), F.nullif(F.col("lang"), F.lit("en")).alias("lang"))
    labels = read(spark, sf_dir, "labels").select(F.col("doc_id").alias("id"), (F.col("quality") + 10).alias("area"), F.col("toxic").alias("rooms"), F.lit("label").alias("lang"))
    return merge.detail_and_list(d, labels, mode)


@query(F11.format(area="coalesce(d.area, l.area)", rooms="coalesce(d.rooms, l.rooms)"))
def f11_merge_faithful(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents_and_labels(spark, sf_dir, "faithful")


@query(F11.format(area="coalesce(nullif(d.area, 0), l.area, d.area)", rooms="coalesce(nullif(d.rooms, 0), l.rooms, d.rooms)"))
def f11_merge_fill_zero(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents_and_labels(spark, sf_dir, "fill_zero")


@query("""SELECT p_partkey, p_type, CASE p_type WHEN 'SMALL' THEN 'Pequeno' WHEN 'LARGE' THEN 'Grande' ELSE upper(p_type[1]) || lower(p_type[2:]) END AS label, count(*) OVER (PARTITION BY p_type) AS same FROM part""")
def f12_code_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = read(spark, sf_dir, "part").select("p_partkey", "p_type")
    labels = part.select(F.col("p_type").alias("code")).distinct().select("code", F.when(F.col("code") == "SMALL", "Pequeno").when(F.col("code") == "LARGE", "Grande").alias("label")).where("label IS NOT NULL")
    same = part.groupBy("p_type").agg(F.count("*").alias("same"))
    return merge.with_label(part, "p_type", labels, "label").join(same, "p_type").select("p_partkey", "p_type", "label", "same")


@query("""WITH t AS (SELECT l_orderkey, l_linenumber, printf('%.2f', l_extendedprice) AS s FROM lineitem)
SELECT l_orderkey, l_linenumber, CAST(replace(replace(s, '.', ''), ',', '') AS BIGINT) AS parsed, CAST(trunc(CAST(s AS DOUBLE)) AS BIGINT) AS whole,
 CAST(replace(regexp_extract('R$ ' || s, '(\\d{1,3}(?:\\.\\d{3})*|\\d+)', 1), '.', '') AS BIGINT) AS first, CAST(regexp_replace(s, '[^0-9]', '', 'g') AS BIGINT) AS digits,
 CAST(replace(s, '.', ',') AS VARCHAR) AS comma, CAST(s AS DOUBLE) AS float FROM t""")
def f15_number_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", F.format_string("%.2f", "l_extendedprice").alias("s"))
    s = F.col("s")
    comma = F.replace(s, F.lit("."), F.lit(","))
    return t.select(
        "l_orderkey", "l_linenumber", numbers.parse_int(s).alias("parsed"), numbers.to_int(s).alias("whole"), numbers.parse_first_int(F.concat(F.lit("R$ "), s)).alias("first"),
        numbers.parse_int_digits(s).alias("digits"), comma.alias("comma"), numbers.parse_float(comma).alias("float"),
    )


@query("""SELECT o_orderkey, CAST(trunc(o_totalprice / 12) AS BIGINT) AS truncated, CAST(round_even(o_totalprice / 12, 0) AS BIGINT) AS rounded, CAST(round_even(o_orderkey / 12.0::DOUBLE, 0) AS BIGINT) AS halves,
 CASE WHEN o_orderstatus = 'F' THEN 0 WHEN o_orderpriority = '2-HIGH' THEN o_orderkey ELSE CAST(round_even(o_totalprice / 12, 0) AS BIGINT) END AS tax FROM orders""")
def f16_monthly_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    total, key = F.col("o_totalprice"), F.col("o_orderkey")
    tax = numbers.monthly_tax(F.lit(None).cast("boolean"), F.when(F.col("o_orderstatus") == "F", "Isento"), F.when(F.col("o_orderpriority") == "2-HIGH", key.cast("string")), F.lit(None).cast("string"), total)
    return read(spark, sf_dir, "orders").select("o_orderkey", numbers.monthly_truncated(total).alias("truncated"), numbers.monthly_rounded(total).alias("rounded"), numbers.monthly_rounded(key).alias("halves"), tax.alias("tax"))


@query("""SELECT p_partkey, p_name, CASE WHEN split_part(p_name, ' ', 1) IN ('red', 'hot') THEN 'Casa' WHEN split_part(p_name, ' ', 1) IN ('blue', 'small') THEN 'Apartamento'
 WHEN split_part(p_name, ' ', 2) IN ('bolt') THEN 'Apartamento' WHEN split_part(p_name, ' ', 2) IN ('ring') THEN 'Casa' ELSE 'Outro' END AS kind FROM part""")
def f17_vocabulary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").select("p_partkey", "p_name", texts.normalize_type(F.upper("p_name"), ["red", "hot", "ring"], ["blue", "small", "bolt"]).alias("kind"))


@query("""SELECT c_custkey, concat_ws(', ', c_name, nullif(c_mktsegment, 'BUILDING'), n_name) AS line, c_name || ', ' || c_nationkey || ' - ' || c_mktsegment || ' - ' || n_name || ' - BR' AS full_line,
 translate(lower(c_mktsegment), 'áé', 'ae') AS plain FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def f18_addresses(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    c = read(spark, sf_dir, "customer").join(nation, "c_nationkey")
    segment = F.when(F.col("c_mktsegment") == "BUILDING", "").otherwise(F.col("c_mktsegment"))
    full = texts.full_address(F.concat(F.lit(" "), F.col("c_name")), F.col("c_nationkey").cast("string"), F.col("c_mktsegment"), F.col("n_name"), F.lit("BR"))
    return c.select("c_custkey", texts.address_line(F.col("c_name"), segment, F.col("n_name")).alias("line"), full.alias("full_line"), texts.strip_accents_lower(F.col("c_mktsegment")).alias("plain"))


@query("""SELECT page_id, split_part(url, '?', 1) AS bare, 'https://h/imovel/' || page_id || CASE WHEN page_id % 2 = 0 THEN '/alugar/' ELSE '/comprar/' END AS public_url FROM pages""")
def f19_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "pages").select("page_id", texts.strip_query(F.col("url")).alias("bare"), texts.listing_url("https://h", F.col("page_id"), F.col("page_id") % 2 == 0).alias("public_url"))


@query("""SELECT o_orderkey, CAST(TIMESTAMP '2026-06-01 12:00:00' - (o_orderkey % 40) * INTERVAL 1 DAY AS DATE) AS days, CAST(TIMESTAMP '2026-06-01 12:00:00' - (o_orderkey % 9) * 30 * INTERVAL 1 DAY AS DATE) AS months,
 CAST(TIMESTAMP '2026-06-01 12:00:00' - (o_orderkey % 50) * INTERVAL 1 HOUR AS DATE) AS hours FROM orders""")
def f21_relative_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, as_of = F.col("o_orderkey"), F.lit("2026-06-01 12:00:00")
    days, months, hours = (F.concat(F.lit(a), (key % m).cast("string"), F.lit(u)) for a, m, u in (("Publicado há ", 40, " dias"), ("x PUBLICADO HÁ ", 9, " meses"), ("atualizado há ", 50, " horas")))
    return read(spark, sf_dir, "orders").select("o_orderkey", dates.relative_date(days, "publicado", as_of).alias("days"), dates.relative_date(months, "publicado", as_of).alias("months"), dates.relative_date(hours, "atualizado", as_of).alias("hours"))


@query("""SELECT event_id, CAST(ts + INTERVAL 3 HOUR AS DATE) AS utc_day, strftime(ts, '%Y-%m-%d') AS prefix_day, CAST(ts AS DATE) AS calendar_day, strftime(ts, '%Y-%m-%d_%H-%M') AS stamp FROM events""")
def f22_iso_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    iso = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-03:00"))
    return read(spark, sf_dir, "events").select(
        "event_id", dates.iso_to_utc_date(iso).alias("utc_day"), dates.prefix_date(iso).alias("prefix_day"), dates.calendar_date(iso, "publicado", F.lit("2026-06-01")).alias("calendar_day"), dates.timestamp_to_stamp(F.col("ts")).alias("stamp")
    )


@query("""SELECT vec_id, embedding[1] AS first, embedding[-1] AS last, embedding[1000] AS outside, list_slice(embedding, 1, 3)[2] AS second FROM embeddings""")
def f23_array_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return read(spark, sf_dir, "embeddings").select("vec_id", arrays.first_value(e).alias("first"), arrays.element(e, -1).alias("last"), arrays.element(e, 999).alias("outside"), arrays.element(e, 1).alias("second"))


@query("""SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders""")
def f29_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows exported as JSON texts and read again."""
    rows = load.json_rows(read(spark, sf_dir, "orders"))
    return rows.select(F.from_json("value", "o_orderkey bigint, o_orderstatus string, o_totalprice double, o_orderpriority string").alias("r")).select("r.*")


@query("""SELECT o_orderkey, c_custkey, coalesce(c_name, 'none') AS name FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_mktsegment = 'MACHINERY') c ON o_custkey = c_custkey""")
def f35_geocode_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Looked-up places: distinct names of a supplied table, joined to every row."""
    kind = F.when(F.col("c_mktsegment") == "MACHINERY", "Place ").otherwise("Old place ")
    lookup = read(spark, sf_dir, "customer").select(F.concat(kind, F.col("c_custkey"), F.lit(", Brazil")).alias("address"), F.col("c_custkey").alias("lat"), F.col("c_name").alias("lon"))
    o = read(spark, sf_dir, "orders").withColumn("place", F.concat(F.lit(" Place "), F.col("o_custkey"), F.lit(" ")))
    return merge.geocoded(o, "place", lookup).select("o_orderkey", F.col("lat").alias("c_custkey"), F.coalesce("lon", F.lit("none")).alias("name"))


@query("""SELECT event_id AS id, 'https://www.quintoandar.com.br/imovel/' || event_id || '/alugar/' AS url, CAST(trunc(value) AS INT) AS aluguel, CAST(user_id + 5 AS INT) AS condominio,
 CASE event_type WHEN 'view' THEN 'Casa' WHEN 'click' THEN 'Apartamento' ELSE 'Outro' END AS tipo_imovel, 'MG, BH, ' || event_type AS endereco, CAST(user_id % 90 AS DOUBLE) AS lat FROM events WHERE event_id > 0""")
def f36_normalize_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events dressed as one source's response rows, normalised to listing records."""
    kind = F.when(F.col("event_type") == "view", "Casa nova").when(F.col("event_type") == "click", "um STUDIO").otherwise("Lote")
    source = F.struct(
        F.col("event_id").alias("id"), F.floor("value").alias("rent"), (F.floor("value") + F.col("user_id") + 5).alias("totalCost"), kind.alias("type"), F.lit("MG").alias("regionName"), F.lit("BH").alias("city"),
        F.col("event_type").alias("neighbourhood"), F.lit("").alias("address"), F.struct((F.col("user_id") % 90).cast("double").alias("lat"), F.lit(0.0).alias("lon")).alias("location"),
    )
    hits = read(spark, sf_dir, "events").where("event_id > 0").select(F.try_parse_json(F.to_json(F.struct(source.alias("_source")))).alias("raw"))
    return normalize.records(hits, normalize.quintoandar).select("id", "url", "aluguel", "condominio", "tipo_imovel", "endereco", "lat")


@query("""SELECT vec_id, CASE WHEN abs(embedding[1]::DOUBLE * 200) <= 90 THEN embedding[1]::DOUBLE * 200 END AS lat FROM embeddings""")
def f37_valid_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = F.get("embedding", F.lit(0)).cast("double") * 200
    return read(spark, sf_dir, "embeddings").select("vec_id", geo.point(x, F.lit(0.0))["lat"].alias("lat"))
