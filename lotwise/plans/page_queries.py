"""Queries on raw pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import extract
from ..operators.tables import spread
from ..sources import envelopes
from ..sources.pages import cards, points, read_pages
from .registry import query


def _pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_pages(spark, f"{sf_dir}/pages.parquet")


@query("""SELECT page_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(html, '(?is)<script[^>]*>.*?</script>', ' ', 'g'), '(?is)<style[^>]*>.*?</style>', ' ', 'g'), '<[^>]+>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages""")
def f27_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _pages(spark, sf_dir).select("page_id", extract.plain_text(F.col("html")).alias("text"))


@query("""SELECT page_id, nullif(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '') AS title, len(regexp_extract_all(html, '(?i)<a\\s[^>]*href=')) AS links FROM pages""")
def f28_patterns(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return _pages(spark, sf_dir).select("page_id", extract.found(html, r"(?is)<title[^>]*>(.*?)</title>").alias("title"), F.regexp_count(html, F.lit(r"(?i)<a\s[^>]*href=")).cast("long").alias("links"))


@query()
def f28_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title, heading, links and the listing fields of every page, each page parsed once."""
    return extract.element_fields(_pages(spark, sf_dir))


@query()
def f39_property_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.property_data(_pages(spark, sf_dir))


@query()
def f40_detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.detail_records(_pages(spark, sf_dir), F.lit("2026-06-01"))


@query("""SELECT page_id, CAST(nullif(regexp_extract(html, '(?is)track\\((\\d+)\\)', 1), '') AS BIGINT) AS track, length(html) AS chars FROM pages""")
def f41_script_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return _pages(spark, sf_dir).select("page_id", extract.found_int(html, r"(?is)track\((\d+)\)").alias("track"), F.length(html).cast("long").alias("chars"))


@query()
def f42_monthly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rent, fee, tax and total of every page: listing JSON, fragments, elements and texts in turn."""
    rows = extract.monthly_prices(extract.element_fields(_pages(spark, sf_dir), ("html",), extract.PRICE_FIELDS))
    return rows.select("page_id", "rent", "fee", "tax", "total")


@query("""SELECT page_id, nullif(split_part(split_part(url, '?', 2), '#', 1), '') AS query, CAST(NULL AS DOUBLE) AS lat FROM pages""")
def f43_links_and_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Query part of every page's link, and the point its map link, listing or JSON gives: these pages have none."""
    none = F.lit(None).cast("struct<lat:double,lon:double>")
    return _pages(spark, sf_dir).select("page_id", F.try_parse_url(F.col("url"), F.lit("QUERY")).alias("query"), extract.page_point(F.col("html"), none)["lat"].alias("lat"))


# Pages dressed with the markup and JSON of listings, from rows of customers.


def text(*parts: str | Column) -> Column:
    return F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))


def script_text(body: Column) -> Column:
    """JSON as a string literal of a script."""
    return F.replace(F.replace(F.to_json(body), F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))


def obj(**fields: Column) -> Column:
    return F.struct(*(v.alias(k) for k, v in fields.items()))


def detail_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, url, html: prices and places stand now in the page's JSON, now in its elements, now in its text."""
    k, name = F.col("c_custkey"), F.col("c_name")
    address = obj(
        street=F.when(k % 2 == 0, text("Rua ", name)), streetNumber=(k % 99).cast("string"), neighborhood=F.col("c_mktsegment"), city=F.lit("BH"), stateAcronym=F.lit("MG"), locationId=text("L", k),
        point=F.when(k % 3 == 0, obj(lat=(k % 80).cast("double"), lon=-(k % 170).cast("double"))),
    )
    listing = obj(
        address=address, prices=F.when(k % 4 == 0, obj(rent=(k + 1).cast("string"))), amenities=obj(values=F.array(F.lit("POOL"), F.lit("SALA_12H"))), externalId=text("E", k),
        imageList=F.array(obj(dangerousSrc=text(" p", k))),
    )
    tracking = obj(rentalPrices=F.when(k % 4 == 2, F.array((k + 3).cast("string"))), bedrooms=F.array((k % 5).cast("string")), unitTypes=F.array(F.lit("HOME")))
    rows = F.when(k % 4 == 1, F.array(obj(business=F.lit("SALE"), price=F.lit("1")), obj(business=F.lit("RENTAL"), price=(k + 2).cast("string"))))
    page = obj(listingId=k.cast("string"), createdAt=F.lit("2026-01-02T23:00:00-03:00"), updatedAt=F.when(k % 2 == 0, "2026-02-02T10:00:00Z"), listing=listing, prices=rows, listingTrackingData=tracking)
    flight = script_text(obj(baseData=obj(pageData=page)))
    best = obj(
        a=obj(address=obj(street=text("B ", name)), prices=obj(rent=k + 9)), b=F.array(obj(address=obj(street=text("C ", name), lat=(k % 80).cast("double"), lon=F.lit(-43.5)), prices=obj(rent=k + 10), amenities=F.array(F.lit("x"), F.lit("y")))),
        c=obj(address=obj(city=F.lit("no street"))),
    )
    html = text(
        "<html><head><title>T ", k, ' &amp; U</title><script>push("', flight, '")</script><script type="application/ld+json">{"price": ', k + 5, '}</script><style>p{}</style></head><body><h1> Casa <b>', name, "</b></h1>",
        '<a href="/x">x</a><a name="n">y</a><p data-testid="location-address">Rua ', name, " - Centro</p>", '<div><span class="t value-item__tooltip-wrapper">Condomínio</span><b class="value-item__value">R$ ', k % 700 + 1, "</b></div>",
        '<div><span class="value-item__tooltip-wrapper">o IPTU</span><i><b class="value-item__value">', F.when(k % 2 == 0, F.lit("Isento")).otherwise(text("R$ ", k % 90 + 1)), "</b></i></div>",
        F.when(k % 2 == 0, text('<span itemprop="floorSize">', k % 300, " m²</span>")).otherwise(text("<p>com ", k % 300, " m² e ")), "2 banheiros, 1 vaga</p><p>Publicado há 2 meses</p>", '<script id="__NEXT_DATA__" type="application/json">', F.to_json(best), "</script></body></html>",
    )
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet").select(k, name, "c_mktsegment")
    return spread(customers).select(k.alias("page_id"), text("http://p/", k).alias("url"), html.alias("html"))


@query("""SELECT c_custkey AS page_id, 'T ' || c_custkey || ' & U' AS title, 'Casa ' || c_name AS heading, 1 AS links, CASE WHEN length('Rua ' || c_name || ' - Centro') > 12 THEN 'Rua ' || c_name || ' - Centro' END AS address,
 CASE WHEN c_custkey % 2 = 0 THEN c_custkey % 300 || ' m²' END AS area, 'R$ ' || (c_custkey % 700 + 1) AS fee_tooltip, CASE WHEN c_custkey % 2 = 0 THEN 'Isento' ELSE 'R$ ' || (c_custkey % 90 + 1) END AS tax_tooltip,
 CAST(c_custkey + 5 AS VARCHAR) AS ld_price, 'Publicado há 2 meses' AS published_phrase FROM customer""")
def f70_page_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = ("title", "heading", "links", "address", "area", "fee_tooltip", "tax_tooltip", "ld_price", "published_phrase")
    return extract.element_fields(detail_pages(spark, sf_dir), fields=fields).withColumn("links", F.col("links").cast("int"))


@query("""SELECT c_custkey AS page_id, 'C ' || c_name AS street, c_custkey + 10 AS rent, CASE WHEN c_custkey % 80 > 0 THEN (c_custkey % 80)::DOUBLE END AS json_lat, CASE WHEN c_custkey % 80 > 0 THEN -43.5::DOUBLE END AS json_lon FROM customer""")
def f71_best_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The weightiest object that looks like a listing, and the first point anywhere in a page's JSON, where a zero is no coordinate."""
    e = extract.element_fields(detail_pages(spark, sf_dir), fields=("best_listing", "json_lat", "json_lon")).withColumn("best", F.try_parse_json("best_listing"))
    return e.select("page_id", F.try_variant_get("best", "$.address.street", "string").alias("street"), F.try_variant_get("best", "$.prices.rent", "bigint").alias("rent"), "json_lat", "json_lon")


@query("""SELECT c_custkey AS page_id, c_custkey % 300 AS area, 2 AS banheiros, 1 AS vagas, c_custkey + 5 AS aluguel, c_custkey % 700 + 1 AS condominio, CASE WHEN c_custkey % 2 = 0 THEN 0 ELSE c_custkey % 90 + 1 END AS iptu FROM customer""")
def f72_property_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = extract.property_data(detail_pages(spark, sf_dir))
    return p.select("page_id", "area", F.col("banheiros").cast("int").alias("banheiros"), F.col("vagas").cast("int").alias("vagas"), "aluguel", "condominio", "iptu")


@query("""WITH c AS (SELECT *, c_custkey AS k FROM customer)
SELECT k AS page_id, k AS id, 'http://p/' || k AS url, 'p' || k AS thumb, CAST(CASE k % 4 WHEN 0 THEN k + 1 WHEN 1 THEN k + 2 WHEN 2 THEN k + 3 ELSE k + 5 END AS INT) AS aluguel, CAST(k % 700 + 1 AS INT) AS condominio,
 CAST(CASE WHEN k % 2 = 0 THEN 0 ELSE k % 90 + 1 END AS INT) AS iptu, CAST(k % 300 AS INT) AS area, 2 AS banheiros, 1 AS vagas, CAST(k % 5 AS INT) AS quartos, CASE WHEN k % 2 = 0 THEN 'Rua ' ELSE 'C ' END || c_name AS "enderecoRua",
 CAST(k % 99 AS VARCHAR) AS "enderecoNumero", c_mktsegment AS bairro, 'BH' AS cidade, 'MG' AS estado, CASE WHEN k % 2 = 0 THEN 'Rua ' ELSE 'C ' END || c_name || ', ' || k % 99 || ', ' || c_mktsegment || ', BH, MG' AS endereco,
 CASE WHEN k % 3 = 0 OR k % 80 > 0 THEN (k % 80)::DOUBLE ELSE 0 END AS lat, CASE WHEN k % 3 = 0 THEN -(k % 170)::DOUBLE WHEN k % 80 > 0 THEN -43.5 ELSE 0 END + 0.0 AS long, CASE WHEN k % 3 = 0 THEN 'page_json' WHEN k % 80 > 0 THEN '__NEXT_DATA__' END AS "geoSource", 'E' || k AS "externalId", ['Piscina', 'Sala 12H'] AS amenidades, 'HOME' AS tipo_imovel, DATE '2026-01-03' AS "publicadoHa", CASE WHEN k % 2 = 0 THEN DATE '2026-02-02' END AS "atualizadoHa" FROM c""")
def f73_detail_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rich records: the page's JSON first, then listings anywhere in it, elements and texts, field by field."""
    d = extract.detail_records(detail_pages(spark, sf_dir), F.lit("2026-06-01"))
    return d.select(
        "page_id", "id", "url", "thumb", "aluguel", "condominio", "iptu", "area", "banheiros", "vagas", "quartos", "enderecoRua", "enderecoNumero", "bairro", "cidade", "estado", "endereco",
        "lat", (F.col("long") + 0.0).alias("long"), "geoSource", "externalId", "amenidades", "tipo_imovel", "publicadoHa", "atualizadoHa",
    )


def priced_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages whose monthly prices stand in the listing's JSON, in fragments of it, in elements, or in the text, by turns."""
    k = F.col("o_orderkey")
    entry = obj(businessType=F.lit("RENTAL"), price=k.cast("string"), monthlyCondoFee=(k % 50).cast("string"), yearlyIptu=(k % 100 * 12).cast("string"), monthlyTotal=(k + 9).cast("string"))
    listing = obj(props=obj(pageProps=obj(listing=obj(address=obj(street=F.lit("R")), pricingInfos=F.array(entry)))))
    parts = obj(props=obj(pageProps=obj(listing=obj(address=obj(street=F.lit("R")), prices=obj(rent=k.cast("string"), condominium=(k % 50).cast("string"), iptu=(k % 100 * 12).cast("string"), monthlyRentalTotalPrice=(k + 9).cast("string"))))))
    fragment = text('<p>"iptuPeriod":"YEARLY","x":{"monthlyRentalTotalPrice":"', k + 9, '"},"yearlyIptu":"', k % 100 * 12, '","price":"', k, '","monthlyCondoFee":"', k % 50, '"</p>')
    elements = text('<p data-testid="condoFee">R$ ', k % 50, '</p><p data-testid="iptu">R$ ', k % 100, "</p><p>Aluguel R$ ", k, " / mês Valor total previsto R$ ", k + 9, "</p>")
    written = text("<p>Aluguel R$ ", k, " / mês</p><p>Condomínio R$ ", k % 50, " / mês</p><p>IPTU R$ ", k % 100, "</p><p>Valor total previsto R$ ", k + 9, "</p>")

    def script(body: Column) -> Column:
        return text('<script id="__NEXT_DATA__">', F.to_json(body), "</script>")

    html = F.when(k % 5 == 0, script(listing)).when(k % 5 == 1, script(parts)).when(k % 5 == 2, fragment).when(k % 5 == 3, elements).otherwise(written)
    return spark.read.parquet(f"{sf_dir}/orders.parquet").select(k.alias("page_id"), html.alias("html"))


@query("""WITH o AS (SELECT o_orderkey AS k, o_orderkey % 5 > 2 AS written FROM orders)
SELECT k AS page_id, CASE WHEN written THEN CAST(left(k::VARCHAR, 3) AS BIGINT) ELSE k END AS rent, k % 50 AS fee, k % 100 AS tax, CASE WHEN written THEN CAST(left((k + 9)::VARCHAR, 3) AS BIGINT) ELSE k + 9 END AS total FROM o""")
def f74_monthly_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rent, fee, tax and total wherever a page has them; a number in a text without dots counts by its first three digits."""
    rows = extract.monthly_prices(extract.element_fields(priced_pages(spark, sf_dir), ("html",), extract.PRICE_FIELDS))
    return rows.select("page_id", "rent", "fee", "tax", "total")


def list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    cards = F.format_string('{"numberOfItems":2,"itemListElement":[{"item":{"@id":"%d"}},{"item":{"@id":"%d"}}]}', k, k + 1)
    flight = F.format_string('{"children":[[0,0,0,{"content":{"listings":[{"id":%d,"lat":1.5},{"id":%d,"lat":2.5}],"totalCount":%d}}]]}', k, k + 7, k % 5)
    html = text('<script type="application/ld+json">', cards, '</script><script>self.push("', F.replace(flight, F.lit('"'), F.lit('\\"')), '")</script>')
    return spark.read.parquet(f"{sf_dir}/supplier.parquet").select(k.alias("page_id"), html.alias("html"))


@query("""SELECT s_suppkey AS page_id, CAST(pos AS INT) AS pos, s_suppkey + pos AS card, s_suppkey + 7 * pos AS point, 1.5::DOUBLE + pos AS lat, CASE WHEN s_suppkey % 5 > 0 THEN s_suppkey % 5 END AS total FROM supplier, (SELECT unnest([0, 1]) AS pos)""")
def f75_list_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cards, map points and the reported total of list pages."""
    pages = list_pages(spark, sf_dir)
    one = cards(pages).select("page_id", "pos", F.try_variant_get("raw", "$.@id", "string").cast("bigint").alias("card"))
    two = points(pages).select("page_id", "pos", F.try_variant_get("raw", "$.id", "bigint").alias("point"), F.try_variant_get("raw", "$.lat", "double").alias("lat"))
    total = pages.select("page_id", envelopes.page_total(extract.embedded_json(F.col("html"), r'\\"totalCount')).alias("total"))
    return one.join(two, ["page_id", "pos"]).join(total, "page_id").select("page_id", "pos", "card", "point", "lat", "total")


@query("""WITH o AS (SELECT o_orderkey AS k, o_custkey AS c FROM orders)
SELECT k AS page_id, 'Rua é ' || k AS street, -(k % 80)::DOUBLE AS lat, CASE WHEN k % 3 = 0 THEN 'rsc_listing_point_lat_lon' ELSE 'rsc_approximateLatLon' END AS source, (c % 80)::DOUBLE AS about_lat, -(c % 170)::DOUBLE AS about_lon,
 'A ' || c AS address, ['Piscina', 'X Y'] AS amenities, DATE '2026-05-01' + CAST(k % 28 AS INT) AS published, 'publicado em ' || strftime(DATE '2026-05-01' + CAST(k % 28 AS INT), '%Y-%m-%d') || ', atualizado em 2026-06-02.' AS sentence, c AS next FROM o""")
def f76_page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that stand as fragments of JSON in a page's text, in either order, near the listing or anywhere."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    point = F.when(k % 3 == 0, text('"address":{"point":{"lat":-', k % 80, ',"lon":-3.5}},')).otherwise("")
    about = F.when(k % 2 == 0, text('"approximateLat":', c % 80, ',"approximateLon":-', c % 170)).otherwise(text('"approximateLon":-', c % 170, ' , "approximateLat":', c % 80))
    day = F.date_format(F.date_add(F.lit("2026-05-01").cast("date"), (k % 28).cast("int")), "yyyy-MM-dd")
    html = text(
        'x "listing" : {"street":"Rua \\u00e9 ', k, '",', point, '"createdAt":"', day, 'T01:00:00Z","amenities":{"values":["POOL","X_Y"]}} ', about, ' "formattedAddress":"A ', c, '" "updatedAt":"2026-06-02T00:00:00Z"',
        '<script id="__NEXT_DATA__" type="application/json">{"n":', c, "}</script>",
    )
    rows = spread(spark.read.parquet(f"{sf_dir}/orders.parquet").select(k, c)).select(k.alias("page_id"), html.alias("html"))
    h, n = F.col("html"), F.col("page_id")
    s, point, about = extract.snippets(h), extract.page_point(h, F.lit(None).cast("struct<lat:double,lon:double>")), extract.approximate_point(h)
    rows = rows.withColumns({"point": point, "about": about, "published": s["published"]})  # each named more than once below
    return rows.select(
        n, extract.quoted_field(extract.listing_chunk(h), "street").alias("street"), F.when(n % 3 == 0, F.col("point.lat")).otherwise(-(n % 80).cast("double")).alias("lat"), F.col("point.source").alias("source"),
        F.col("about.lat").alias("about_lat"), F.col("about.lon").alias("about_lon"), s["address"].alias("address"), s["amenities"].alias("amenities"), F.col("published"),
        extract.dated_sentence(F.col("published"), s["updated"]).alias("sentence"), F.try_variant_get(extract.next_data(h), "$.n", "bigint").alias("next"),
    )


@query("""WITH o AS (SELECT o_orderkey AS page_id, o_orderkey % 8 AS kind, CAST(o_custkey % 80 AS DOUBLE) AS lat, CAST(-(o_custkey % 170) - 1 AS DOUBLE) AS lon, o_custkey, o_custkey % 3 <> 0 AS known,
  o_orderkey % 8 IN (6, 7) OR (o_orderkey % 8 = 5 AND o_custkey % 80 = 0) AS none FROM orders)  -- a zero in a page's JSON is no coordinate
SELECT page_id, CASE WHEN kind = 2 AND NOT known THEN 1.5 WHEN none THEN NULL ELSE lat END AS lat, CASE WHEN kind = 2 AND NOT known THEN 2.5 WHEN none THEN NULL ELSE lon END AS lon,
 CASE kind WHEN 0 THEN 'maps_embed_center' WHEN 1 THEN 'maps_embed_q' WHEN 2 THEN CASE WHEN NOT known THEN 'rsc_listing_point_lat_lon' WHEN o_custkey % 2 = 0 THEN 'maps_embed_q_geocoded_google' ELSE 'maps_embed_q_geocoded_nominatim' END
 WHEN 3 THEN 'rsc_listing_point_lat_lon' WHEN 4 THEN 'rsc_approximateLatLon' WHEN 5 THEN CASE WHEN NOT none THEN '__NEXT_DATA__' END END AS source FROM o""")
def f86_resolved_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of pages made of orders: each source decides some, addresses come from a table of customers' places, a few links are no valid ones."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    lat, lon = (c % 80).cast("string"), F.concat(F.lit("-"), (c % 170 + 1).cast("string"))

    def listing(x: Column, y: Column) -> Column:
        return F.concat(F.lit('{"listing":{"address":{"point":{"lat":'), x, F.lit(',"lon":'), y, F.lit("}}}}"))

    key = F.when(c % 2 == 0, F.lit("key=k&amp;")).otherwise("")
    html = (
        F.when(k % 8 == 0, F.concat(F.lit('<iframe src="//www.google.com/maps/embed/v1/place?q=Street|1&#38;center='), lat, F.lit("%2C"), lon, F.lit('"></iframe>'), listing(F.lit("1"), F.lit("1"))))
        .when(k % 8 == 1, F.concat(F.lit('<iframe src="HTTPS://google.com/maps/embed/v1/place?'), key, F.lit("center=%20&amp;q="), lat, F.lit("%252C"), lon, F.lit("#x\"></iframe>")))
        .when(k % 8 == 2, F.concat(F.lit('<a href="https://www.google.com/maps/embed/x"></a><iframe src="https://www.google.com/maps/embed/v1/place?'), key, F.lit("q=+Rua+A|B+%C3%A9+"), c.cast("string"), F.lit('+"></iframe>'), listing(F.lit("1.5"), F.lit("2.5"))))
        .when(k % 8 == 3, F.concat(F.lit('<a href="https://www.google.com/maps/embed/v1/place?q=ab">'), listing(lat, lon), F.lit('"approximateLat":3,"approximateLon":4')))
        .when(k % 8 == 4, F.concat(F.lit('"approximateLon":'), lon, F.lit(',"approximateLat":'), lat))
        .when(k % 8 == 5, F.concat(F.lit('<script id="__NEXT_DATA__" type="application/json">{"props":{"at":{"lat":'), lat, F.lit(',"lon":'), lon, F.lit("}}}</script>")))
        .when(k % 8 == 6, F.lit('<iframe src="https://www.google.com/maps/embed?pb=%"></iframe>')).otherwise("<p>no map</p>")
    )
    pages = spark.read.parquet(f"{sf_dir}/orders.parquet").select(k.alias("page_id"), F.lit("").alias("url"), html.alias("html"))
    places = spark.read.parquet(f"{sf_dir}/customer.parquet").where("c_custkey % 3 <> 0")
    p = F.col("c_custkey")
    lookup = places.select(F.concat(F.lit("Rua A|B é "), p, F.lit(", Brazil")).alias("address"), (p % 80).cast("double").alias("lat"), (-(p % 170) - 1).cast("double").alias("lon"))
    return extract.resolved_points(pages, lookup)
