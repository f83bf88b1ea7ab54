"""Queries on the sources' JSON: rows of the tables dressed as each source's responses, then normalised, chosen from, loaded."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import arrays, geo, numbers, texts
from ..operators import filters, load, merge, normalize, records
from ..operators.tables import fresh_folder
from ..sources import envelopes, snapshots
from .registry import query, read


def present(*items: Column) -> Column:
    """Array of the items that are there."""
    return F.filter(F.array(*items), lambda x: x.isNotNull())


def dressed(df: DataFrame, *keep: str, **fields: Column) -> DataFrame:
    """The kept columns and raw, a JSON object of the fields; null fields are left out."""
    body = F.struct(*(v.alias(k) for k, v in fields.items()))
    return df.select(*keep, F.try_parse_json(F.to_json(body)).alias("raw"))


def obj(**fields: Column) -> Column:
    return F.struct(*(v.alias(k) for k, v in fields.items()))


@query("""WITH o AS (SELECT *, o_orderkey AS k, o_custkey AS c, o_orderstatus <> 'F' AS rental, o_orderstatus <> 'O' AS sale FROM orders)
SELECT k AS id, 'https://www.vivareal.com.br/p/' || k AS url, 'i' || k AS thumb, CAST(CASE WHEN rental THEN c * 10 + 5 ELSE 0 END AS INT) AS aluguel, CAST(CASE WHEN sale THEN c ELSE 0 END AS INT) AS venda,
 CAST(CASE WHEN rental THEN trunc(k / 12.0) ELSE 0 END AS INT) AS iptu, CAST(CASE WHEN rental THEN c + 1 ELSE 0 END AS INT) AS condominio, CAST(k % 5 AS INT) AS banheiros, 0 AS quartos,
 CAST(CASE WHEN k % 2 = 0 THEN k % 100 + 1 ELSE c % 100 END AS INT) AS area, o_orderpriority AS bairro, CASE k % 3 WHEN 0 THEN 'Casa' WHEN 1 THEN 'Apartamento' ELSE 'Outro' END AS tipo_imovel,
 concat_ws(', ', 'MG', 'BH', o_orderpriority, CASE WHEN k % 3 > 0 THEN 'Rua ' || c END, '5') AS endereco, CASE WHEN k % 2 = 0 THEN (k % 80 + 1)::DOUBLE ELSE (c % 80 + 1)::DOUBLE END AS lat, -(c % 180)::DOUBLE AS long,
 CAST(rental AS INT) AS tem_locacao, CAST(sale AS INT) AS tem_venda FROM o""")
def f44_vivareal_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    rental = F.when(status != "F", obj(businessType=F.lit("RENTAL"), price=F.concat(c, F.lit(",5")), yearlyIptu=k, monthlyCondoFee=(c + 1).cast("string")))
    sale = F.when(status != "O", obj(businessType=F.lit("SALE"), price=c.cast("string"), yearlyIptu=F.lit(None).cast("bigint"), monthlyCondoFee=F.lit(None).cast("string")))
    point = obj(lat=F.when(k % 2 == 0, (k % 80 + 1).cast("double")).otherwise(F.lit(0.0)), approximateLat=(c % 80 + 1).cast("double"))
    address = obj(stateAcronym=F.lit("MG"), city=F.lit("BH"), neighborhood=F.col("o_orderpriority"), street=F.when(k % 3 > 0, F.concat(F.lit("Rua "), c)), point=point)
    kind = F.when(k % 3 == 0, "HOME").when(k % 3 == 1, "FLAT").otherwise("LOT")
    listing = obj(
        id=k.cast("string"), address=address, pricingInfos=present(sale, rental), bathrooms=F.array(k % 5), bedrooms=F.array().cast("array<int>"),
        usableAreas=F.array(F.when(k % 2 == 0, k % 100 + 1).otherwise(F.lit(0))), totalAreas=F.array(c % 100), unitTypes=F.array(kind),
    )
    medias = F.array(obj(type=F.lit("VIDEO"), url=F.lit("v")), obj(type=F.lit("IMAGE"), url=F.concat(F.lit("i"), k)))
    link = obj(href=F.concat(F.lit("/p/"), k), data=obj(streetNumber=F.lit("5")))
    rows = dressed(read(spark, sf_dir, "orders"), listing=listing, medias=medias, link=link, map=obj(point=obj(lon=-(c % 180).cast("double"))))
    out = normalize.records(rows, normalize.vivareal)
    return out.select("id", "url", "thumb", "aluguel", "venda", "iptu", "condominio", "banheiros", "quartos", "area", "bairro", "tipo_imovel", "endereco", "lat", "long", "tem_locacao", "tem_venda")


@query("""WITH r AS (SELECT *, c_custkey AS k FROM customer)
SELECT k AS id, CASE WHEN k % 4 = 0 THEN '' ELSE 'https://www.netimoveis.com/venda/' || CASE WHEN k % 4 = 1 THEN 'd' ELSE 'u' END || k END AS url, c_name AS thumb, CAST(k * 100 + 50 AS INT) AS aluguel, CAST(k + 7 AS INT) AS venda,
 CAST(k % 9 AS INT) AS iptu, 0 AS condominio, CAST(k % 4 + k % 3 AS INT) AS banheiros, CAST(k % 5 + 1 AS INT) AS quartos, CAST(CASE WHEN k % 2 = 0 THEN k % 6 ELSE 1 END AS INT) AS vagas, CAST(k % 300 AS INT) AS area,
 c_mktsegment AS bairro, CASE WHEN k % 2 = 0 THEN 'Casa' ELSE 'Outro' END AS tipo_imovel, concat_ws(', ', 'MG', nullif(CASE WHEN k % 3 = 0 THEN '' ELSE 'BH' END, ''), c_mktsegment, 'Rua', c_name) AS endereco,
 (k % 80)::DOUBLE AS lat, -((k % 80) + 0.5)::DOUBLE AS long, CAST(k % 2 = 0 AS INT) AS tem_locacao, CAST(k % 2 = 1 AS INT) AS tem_venda FROM r""")
def f45_netimoveis_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = dressed(
        read(spark, sf_dir, "customer"), imovelSan_Id=k, urlDetalheImovel=F.when(k % 4 == 1, F.concat(F.lit("d"), k)), url=F.when(k % 4 > 1, F.concat(F.lit("u"), k)), nomeArquivoThumb=F.col("c_name"),
        valorLocacao=F.concat(k, F.lit(".50")), valorImovel=k + 7, valorIptu=(k % 9).cast("double") + 0.75, valorCondominio=F.lit("a combinar"), banho=k % 4, suites=k % 3, quartos=k % 5, dce=F.lit(1),
        vagaGaragem=F.when(k % 2 == 0, 0).otherwise(1), vagasGaragem=k % 6, areaRealPrivativa=(k % 300).cast("string"), nomeBairro=F.col("c_mktsegment"), tipoImovel1=F.when(k % 2 == 0, "Casa em rua").otherwise("Galpão"),
        siglaEstado=F.lit("MG"), nomeCidade=F.when(k % 3 == 0, "").otherwise("BH"), tipoLogradouro=F.lit("Rua"), logradouroPublico=F.col("c_name"), latitude2=(k % 80).cast("double"), longitude2=-(k % 80).cast("double") - 0.5,
        exibeLocacao=k % 2 == 0, exibeVenda=k % 2 == 1,
    )
    out = normalize.records(rows, normalize.netimoveis)
    return out.select("id", "url", "thumb", "aluguel", "venda", "iptu", "condominio", "banheiros", "quartos", "vagas", "area", "bairro", "tipo_imovel", "endereco", "lat", "long", "tem_locacao", "tem_venda")


@query("""WITH r AS (SELECT *, p_partkey AS k FROM part)
SELECT k AS id, 'https://www.casamineira.com.br/' || k || '.html' AS url, CASE k % 3 WHEN 0 THEN 'a' || k WHEN 1 THEN 'b' || k ELSE '' END AS thumb, CAST(CASE WHEN k % 2 = 0 THEN k + 1 ELSE 0 END AS INT) AS aluguel, CAST(k * 3 AS INT) AS venda,
 CAST(CASE WHEN k % 2 = 0 THEN k % 11 ELSE k % 13 END AS INT) AS iptu, CAST(k % 17 AS INT) AS condominio, CAST(p_size AS INT) AS banheiros, 0 AS quartos, CAST(k % 4 AS INT) AS vagas,
 CAST(CASE WHEN p_size % 2 = 0 THEN p_size + 10 ELSE p_size END AS INT) AS area, p_brand AS bairro, 'Casa' AS tipo_imovel, p_name AS endereco, (k % 80)::DOUBLE AS lat, (k % 170)::DOUBLE AS long FROM r""")
def f46_casamineira_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, size = F.col("p_partkey"), F.col("p_size")

    def price(amount: Column, currency: Column) -> Column:
        return obj(amount=amount.cast("string"), currencyId=currency)

    no_currency = F.lit(None).cast("string")
    sale = obj(operationType=obj(operationTypeId=F.lit("1")), prices=F.array(price(k * 5, F.lit("1")), price(F.lit("x"), no_currency), price(k * 3, no_currency), price(k * 9, F.lit("3"))))
    rent = F.when(k % 2 == 0, obj(operationType=obj(operationTypeId=F.lit("2")), prices=F.array(price(k + 1, F.lit("3")))))
    picture = obj(url730x532=F.when(k % 3 == 0, F.concat(F.lit("a"), k)), url360x266=F.when(k % 3 == 1, F.concat(F.lit("b"), k)), url130x70=F.lit(""))
    features = obj(CFT3=obj(value=size.cast("string")), CFT7=obj(value=k % 4), CFT100=obj(value=size), CFT101=obj(value=F.when(size % 2 == 0, size + 10).otherwise(F.lit(0))))
    place = obj(location=obj(name=F.col("p_brand")), address=obj(name=F.col("p_name")), postingGeolocation=obj(geolocation=obj(latitude=(k % 80).cast("double"), longitude=(k % 170).cast("double"))))
    part = read(spark, sf_dir, "part")
    common = {
        "postingId": k.cast("string"), "url": F.concat(F.lit("//"), k, F.lit(".html")), "priceOperationTypes": present(sale, rent), "expenses": obj(amount=k % 17), "mainFeatures": features,
        "postingLocation": place, "visiblePictures": obj(pictures=F.array(picture)), "realEstateType": obj(name=F.lit("Casas")),
    }
    # The tax is an amount in some postings and an object with one in others.
    rows = dressed(part.where(k % 2 == 0), **common, iptu=obj(amount=k % 11)).unionByName(dressed(part.where(k % 2 == 1), **common, iptu=k % 13))
    out = normalize.records(rows, normalize.casamineira)
    return out.select("id", "url", "thumb", "aluguel", "venda", "iptu", "condominio", "banheiros", "quartos", "vagas", "area", "bairro", "tipo_imovel", "endereco", "lat", "long")


@query("""WITH o AS (SELECT *, o_orderkey AS k, o_custkey AS c FROM orders)
SELECT k AS id, CASE WHEN k % 2 = 0 THEN 'https://www.zapimoveis.com.br/z/' || k ELSE '' END AS url, 'http://t/?action=fit-in&dimension=614x297&n=' || k AS thumb, 'http://t/?action={action}&dimension={width}x{height}&n=' || k AS photo,
 CAST(CASE WHEN k % 3 > 0 THEN c ELSE 0 END AS INT) AS aluguel, CAST(CASE WHEN k % 7 = 0 THEN 0 ELSE k END AS INT) AS venda,
 CAST(CASE WHEN k % 3 > 0 THEN trunc(c / 12.0) ELSE 0 END AS INT) AS iptu, CAST(CASE WHEN k % 3 > 0 THEN c % 50 ELSE k % 50 END AS INT) AS condominio, CAST(k % 3 + 1 AS BIGINT) AS andares, CAST(k % 5 AS INT) AS quartos,
 'Rua ' || c || ', ' || k % 99 || ', ' || o_orderpriority || ', BH, MG' AS endereco,
 (k % 2)::DOUBLE AS lat, 0.0::DOUBLE AS long, CASE WHEN k % 4 > 0 THEN ['POOL', '', 'SALA_12H'] END AS amenidades, CASE WHEN c % 3 > 0 THEN 'GOOGLE' END AS "geoSource", CASE WHEN k % 2 = 1 THEN c % 2 = 0 END AS "isAbsoluteLocation",
 CAST(CAST(o_orderdate AS TIMESTAMP) + INTERVAL 3 HOUR + INTERVAL 23 HOUR AS DATE) AS "publicadoHa" FROM o""")
def f47_zap_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listings of the list API: a sale's price with a decimal part or a tax as text counts as none, bare values stand for lists."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    price = F.when(k % 7 == 0, F.concat(k.cast("string"), F.lit(".50"))).otherwise(k.cast("string"))
    sale = obj(businessType=F.lit("SALE"), price=price, yearlyIptu=F.parse_json(F.concat(F.lit('"'), k, F.lit('"'))), monthlyCondoFee=(k % 50).cast("string"))
    rental = F.when(k % 3 > 0, obj(businessType=F.lit("RENTAL"), price=c.cast("string"), yearlyIptu=F.parse_json(c.cast("string")), monthlyCondoFee=(c % 50).cast("string")))
    point = obj(lat=(k % 2).cast("double"), lon=F.lit(0.0), source=F.when(c % 3 > 0, F.lit("GOOGLE")))
    address = obj(street=F.concat(F.lit("Rua "), c), streetNumber=(k % 99).cast("string"), neighborhood=F.col("o_orderpriority"), city=F.lit("BH"), stateAcronym=F.lit("MG"), point=point, approximateLocation=c % 2 == 1)
    medias = F.array(obj(type=F.lit("VIDEO"), url=F.lit("v")), obj(type=F.lit("IMAGE"), url=F.concat(F.lit("http://t/?action={action}&dimension={width}x{height}&n="), k)))
    created = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("T23:00:00-03:00"))
    codes = F.when(k % 4 > 0, F.array(F.lit("POOL"), F.lit(""), F.lit("SALA_12H"))).otherwise(F.array().cast("array<string>"))
    listing = obj(id=k.cast("string"), pricingInfos=present(sale, rental), address=address, amenities=codes, floors=F.array(k % 3 + 1), bedrooms=k % 5, createdAt=created)
    rows = dressed(read(spark, sf_dir, "orders"), listing=listing, medias=medias, link=obj(href=F.when(k % 2 == 0, F.concat(F.lit("/z/"), k))))
    out = normalize.records(rows, normalize.zap).withColumn("photo", F.get("fotos", F.lit(0)))
    return out.select("id", "url", "thumb", "photo", "aluguel", "venda", "iptu", "condominio", "andares", "quartos", "endereco", "lat", "long", "amenidades", "geoSource", "isAbsoluteLocation", "publicadoHa")


@query("""WITH r AS (SELECT *, c_custkey AS k FROM customer)
SELECT k AS id, 'http://z/' || k AS url, 'p' || k AS thumb, CAST(k + 1 AS INT) AS aluguel, CAST(CASE WHEN k % 2 = 0 THEN k * 7 ELSE 0 END AS INT) AS venda, CAST(k % 40 AS INT) AS condominio, CAST(k % 3 AS INT) AS banheiros,
 CAST(CASE WHEN k % 4 = 0 THEN 9 ELSE k % 4 END AS INT) AS quartos, CAST(k % 200 AS INT) AS area, concat_ws(', ', c_name, CASE WHEN k % 5 > 0 THEN c_mktsegment END) AS endereco, ['x', c_name] AS amenidades, len(CASE WHEN k % 2 = 0 THEN [1, 2] ELSE [1] END) AS photos FROM r""")
def f48_zap_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    action = F.when(k % 2 == 0, obj(**{"@type": F.lit("BuyAction"), "priceSpecification": obj(price=k * 7)}))
    offers = obj(price=(k + 1).cast("string"), url=F.concat(F.lit("http://z/"), k, F.lit("?a=1")), potentialAction=action, propertyValue=obj(value=k % 40))
    common = {
        "@id": k.cast("string"), "offers": offers, "amenityFeature": F.array(obj(value=F.lit("x")), obj(value=F.lit("")), obj(value=F.col("c_name"))), "floorSize": obj(value=(k % 200).cast("string")),
        "address": obj(streetAddress=F.concat(F.lit(" "), F.col("c_name")), addressLocality=F.when(k % 5 > 0, F.col("c_mktsegment")).otherwise("$undefined")), "numberOfBathroomsTotal": k % 3, "numberOfBedrooms": k % 4, "numberOfRooms": F.lit(9),
    }
    c, photo = read(spark, sf_dir, "customer"), F.concat(F.lit("p"), k)
    rows = dressed(c.where(k % 2 == 0), **common, image=F.array(photo, F.lit("q"))).unionByName(dressed(c.where(k % 2 == 1), **common, image=photo))
    out = normalize.records(rows, normalize.zap_card)
    return out.select("id", "url", "thumb", "aluguel", "venda", "condominio", "banheiros", "quartos", "area", "endereco", "amenidades", F.size("fotos").cast("long").alias("photos"))


@query("""WITH r AS (SELECT *, s_suppkey AS k FROM supplier)
SELECT k AS id, 'http://z/' || k AS url, s_name AS thumb, CAST(k % 7 AS INT) AS aluguel, CAST(CASE WHEN k % 2 = 0 THEN k * 9 ELSE 0 END AS INT) AS venda, CAST(k % 5 AS INT) AS iptu, CAST(k % 4 AS INT) AS banheiros, s_name || ', ' || s_nationkey AS endereco,
 CASE WHEN k % 3 = 0 THEN 0.0 ELSE (k % 80)::DOUBLE END AS lat, CASE WHEN k % 3 = 0 THEN 0.0 ELSE -(k % 80)::DOUBLE END AS long, ['A', s_name] AS amenidades, CASE WHEN k % 3 <> 0 THEN 'listing_page' END AS "geoSource" FROM r""")
def f49_zap_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey")
    address = obj(street=F.col("s_name"), streetNumber=F.lit("$undefined"), neighborhood=F.col("s_nationkey").cast("string"), city=F.lit("null"), point=obj(lat=F.when(k % 3 == 0, 95.0).otherwise((k % 80).cast("double")), lon=-(k % 80).cast("double")))
    rows = dressed(
        read(spark, sf_dir, "supplier"), id=k, href=F.concat(F.lit("http://z/"), k, F.lit("?q")), business=F.when(k % 2 == 0, "SALE").otherwise("RENTAL"), prices=obj(mainValue=k * 9, rent=k % 7, iptu=k % 5),
        address=address, amenities=obj(values=F.array(F.lit("A"), F.col("s_name")), bathrooms=F.array(k % 4)), imageList=F.array(obj(dangerousSrc=F.lit(" ")), obj(dangerousSrc=F.concat(F.lit(" "), F.col("s_name")))),
    )
    return normalize.records(rows, normalize.zap_point).select("id", "url", "thumb", "aluguel", "venda", "iptu", "banheiros", "endereco", "lat", "long", "amenidades", "geoSource")


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a response of one of four sources: some refused, some no JSON, some with an error inside."""
    e, n = read(spark, sf_dir, "events"), F.col("event_id")
    source = F.when(n % 4 == 0, "vivareal").when(n % 4 == 1, "netimoveis").when(n % 4 == 2, "quintoandar").otherwise("casamineira")
    item = F.format_string('{"id":%d},%d', n, n)
    bodies = {
        0: F.format_string('{"search":{"result":{"totalCount":%d,"listings":[%s]}}}', n, item), 1: F.format_string('{"erro":%s,"lista":[%s]}', F.when(n % 3 == 0, "true").otherwise("false"), item),
        2: F.format_string('{"hits":{"total":{"value":%d},"hits":[%s]}}', n, item), 3: F.format_string('{"paging":{"totalPages":%d},"listPostings":[%s]}', n % 9, item),
    }
    body = None
    for k, text in bodies.items():
        body = F.when(n % 4 == k, text) if body is None else body.when(n % 4 == k, text)
    return e.select(n.alias("n"), source.alias("source"), n.cast("string").alias("url"), F.when(n % 7 == 0, 404).otherwise(200).alias("status"), F.when(n % 5 == 0, "<html>").otherwise(body).alias("body"))


@query("""WITH r AS (SELECT event_id AS n, CASE event_id % 4 WHEN 0 THEN 'vivareal' WHEN 1 THEN 'netimoveis' WHEN 2 THEN 'quintoandar' ELSE 'casamineira' END AS source FROM events)
SELECT source, CASE WHEN n % 7 = 0 THEN 'status' WHEN n % 5 = 0 THEN 'not_json' WHEN source = 'netimoveis' AND n % 3 = 0 THEN 'source_error' ELSE 'usable' END AS code, count(*) AS n FROM r GROUP BY 1, 2""")
def f50_usable_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, bad = filters.usable_responses(responses(spark, sf_dir))
    return good.select("source", F.lit("usable").alias("code")).unionByName(bad.select("source", "code")).groupBy("source", "code").agg(F.count("*").alias("n"))


@query("""WITH r AS (SELECT event_id AS n, CASE event_id % 4 WHEN 0 THEN 'vivareal' WHEN 1 THEN 'netimoveis' WHEN 2 THEN 'quintoandar' ELSE 'casamineira' END AS source FROM events)
SELECT source, n AS id, 0 AS pos, CASE source WHEN 'netimoveis' THEN NULL WHEN 'casamineira' THEN n % 9 ELSE n END AS total FROM r WHERE n % 7 <> 0 AND n % 5 <> 0 AND NOT (source = 'netimoveis' AND n % 3 = 0)""")
def f51_envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing rows and reported totals of the usable responses of every source."""
    good, _ = filters.usable_responses(responses(spark, sf_dir))
    out = None
    for source in ("vivareal", "netimoveis", "quintoandar", "casamineira"):
        total = envelopes.total(F.col("json"), source) if source in envelopes.TOTALS else F.lit(None).cast("bigint")
        rows = envelopes.unwrap(good.where(F.col("source") == source).withColumn("total", total), source)
        rows = rows.select("source", F.try_variant_get("raw", "$.id", "bigint").alias("id"), "pos", "total")
        out = rows if out is None else out.unionByName(rows)
    return out


@query("""SELECT o_orderkey AS k, CASE o_orderstatus WHEN 'F' THEN 'b' WHEN 'O' THEN 'a' ELSE 'c' END AS entry, CAST(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey ELSE 0 END AS BIGINT) AS amount,
 CAST(o_custkey % 9 AS BIGINT) AS feature, CAST(-1 AS BIGINT) AS missing, 'm' || o_custkey AS thumb FROM orders""")
def f52_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which of several entries of a listing's JSON count: rental rows, amounts by operation, features, pictures."""
    k, c, status = F.col("o_orderkey"), F.col("o_custkey"), F.col("o_orderstatus")
    rental = F.when(status == "F", obj(business=F.lit("RENTAL"), id=F.lit("b")))
    named = F.when(status == "O", obj(business=F.lit("x"), id=F.lit("a")))
    operation = obj(operationType=obj(operationTypeId=F.when(k % 2 == 0, "2").otherwise("1")), prices=F.array(obj(amount=c)))
    other = obj(business=F.lit("y"), id=F.lit("c"))
    rows = dressed(
        read(spark, sf_dir, "orders"), "o_orderkey", prices=present(named, other, rental), operations=F.array(operation), mainFeatures=obj(CFT2=obj(value=(c % 9).cast("string"))),
        visiblePictures=obj(pictures=F.array(obj(url360x266=F.concat(F.lit("m"), c), url130x70=F.lit("s")))),
    )
    raw = F.col("raw")

    def array(name: str) -> Column:
        return F.try_variant_get(raw, f"$.{name}", "array<variant>")

    return rows.select(
        F.col("o_orderkey").alias("k"), filters.text_at(filters.rental_row(array("prices")), "$.id").alias("entry"), filters.amount_of(array("operations"), "2").alias("amount"),
        filters.feature_value(raw, "CFT2").alias("feature"), filters.feature_value(raw, "CFT9", -1).alias("missing"), filters.thumb_of(raw).alias("thumb"),
    )


@query("""WITH p AS (SELECT o_custkey AS id, max(o_orderkey) AS k FROM orders GROUP BY 1)
SELECT id, 'u' || id AS url, coalesce(CASE WHEN k % 2 = 0 THEN 'point' || k END, CASE WHEN c_custkey IS NOT NULL AND id % 3 > 0 THEN c_name END) AS cidade FROM p LEFT JOIN customer ON c_custkey = id WHERE id % 5 > 0""")
def f53_points_and_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Map points (orders, many of one id) completed by cards (customers, each twice); points without a link go."""
    o, c = read(spark, sf_dir, "orders"), read(spark, sf_dir, "customer")
    url = F.when(F.col("o_custkey") % 5 > 0, F.concat(F.lit("u"), F.col("o_custkey"))).otherwise("")
    city = F.when(F.col("o_orderkey") % 2 == 0, F.concat(F.lit("point"), F.col("o_orderkey")))
    points = o.select(F.col("o_custkey").alias("id"), url.alias("url"), city.alias("cidade"), F.col("o_orderkey").alias("seq"))
    name = F.when(F.col("c_custkey") % 3 > 0, F.col("c_name"))
    cards = c.select(F.col("c_custkey").alias("id"), F.lit("card").alias("url"), name.alias("cidade"), F.lit(2).alias("seq"))
    cards = cards.unionByName(c.select(F.col("c_custkey").alias("id"), F.lit("old").alias("url"), F.lit("old").alias("cidade"), F.lit(1).alias("seq")))
    return merge.points_and_cards(points, cards, ["seq"]).select("id", "url", "cidade")


SITES_SQL = """CASE o_orderstatus WHEN 'F' THEN 'vivareal' WHEN 'O' THEN 'zapimoveis' ELSE 'netimoveis' END"""


def order_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as listings of two snapshots of three sites: site, stamp, id, aluguel, o_orderkey."""
    status = F.col("o_orderstatus")
    site = F.when(status == "F", "vivareal").when(status == "O", "zapimoveis").otherwise("netimoveis")
    stamp = F.when(F.col("o_orderkey") % 2 == 0, "2026-06-01_02-25").otherwise("2026-06-02_02-25")
    return read(spark, sf_dir, "orders").select(site.alias("site"), stamp.alias("stamp"), F.col("o_custkey").alias("id"), F.col("o_orderkey").cast("int").alias("aluguel"), "o_orderkey")


@query(f"""SELECT {SITES_SQL} AS site, CASE WHEN o_orderkey % 2 = 0 THEN '2026-06-01_02-25' ELSE '2026-06-02_02-25' END AS stamp, o_custkey AS id, CAST(max(o_orderkey) AS INT) AS aluguel FROM orders GROUP BY 1, 2, 3""")
def f54_snapshot_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshots written site by site, the last row of each id, none deleting another; read again."""
    rows, path = order_snapshots(spark, sf_dir), fresh_folder(spark, "snapshots")
    for site in ("vivareal", "zapimoveis", "netimoveis"):
        load.write_snapshot(rows.where(F.col("site") == site), path, "id", ["o_orderkey"], "parquet")
    return spark.read.option("partitionColumnTypeInference", "false").parquet(path).select("site", "stamp", "id", "aluguel")


@query("""SELECT o_orderkey AS id, 'é ' || o_orderpriority AS note, o_totalprice AS price FROM orders""")
def f55_exports_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unified export: compact JSON rows, non-ASCII text as it is, read again."""
    path = fresh_folder(spark, "unified")
    load.write_unified(read(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.concat(F.lit("é "), F.col("o_orderpriority")).alias("note"), F.col("o_totalprice").alias("price")), path)
    return spark.read.schema("id bigint, note string, price double").json(path)


@query("""SELECT step, status, (SELECT count(*) FROM customer) AS rows FROM (VALUES (1, 'created'), (2, 'skipped_exists'), (3, 'reloaded'), (4, 'ok'), (5, 'error'), (6, 'kept'), (7, 'emptied')) AS t(step, status)""")
def f56_loads_and_destinations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table per snapshot, loaded once, skipped, reloaded; one good and one bad destination of an export; a table made, kept with its rows, emptied."""
    c, path = read(spark, sf_dir, "customer"), fresh_folder(spark, "published")
    table = f"snapshot_{path.rsplit('-', 1)[1]}"
    facts = f"{table}_facts"
    load.ensure_table(spark, facts, "id long", truncate=True)
    c.select(F.col("c_custkey").alias("id")).write.insertInto(facts)
    steps = [load.load_snapshot_table(c, table, reload) for reload in (False, False, True)]
    steps += [r["status"] for r in load.publish(c, f"{path}/a; nofs://there/b").collect()]
    for truncate, status in ((False, "kept"), (True, "emptied")):
        load.ensure_table(spark, facts, "id long", truncate)
        steps.append(status if spark.table(facts).count() == (0 if truncate else c.count()) else "wrong")
    rows = spark.read.json(f"{path}/a").agg(F.count("*").alias("published")).crossJoin(spark.table(table).agg(F.count("*").alias("rows"))).where("published = rows")
    return spark.createDataFrame(list(enumerate(steps, 1)), "step int, status string").crossJoin(rows.select("rows"))


@query("""SELECT c_custkey AS id, c_custkey || '_' || CASE WHEN c_custkey % 2 = 0 THEN 'own' ELSE 'vivareal' END AS uid, 36 AS width, CAST(c_nationkey AS INT) AS quartos FROM customer""")
def f57_snapshot_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    rows = dressed(read(spark, sf_dir, "customer"), id=k, quartos=F.col("c_nationkey"), fonte=F.when(k % 2 == 0, "own").otherwise("")).withColumn("site", F.lit("vivareal"))
    return records.snapshot_rows(records.unified_from_raw(rows)).select("id", "uid", F.length("internal_id").alias("width"), "quartos")


@query("""SELECT c_custkey AS id, c_name AS url, strftime(DATE '2026-01-01' + CAST(c_custkey % 300 AS INT), '%Y-%m-%d') AS bairro FROM customer WHERE c_custkey % 4 > 0""")
def f58_base_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base columns of records with a link, days as texts; columns of an extension are left out."""
    k = F.col("c_custkey")
    day = F.date_add(F.lit("2026-01-01").cast("date"), (k % 300).cast("int"))
    rows = read(spark, sf_dir, "customer").select(k.alias("id"), F.when(k % 4 > 0, F.col("c_name")).alias("url"), day.alias("bairro"), F.lit(1).alias("andares"))
    return records.base_columns(filters.with_url(rows))


@query("""SELECT c_custkey AS k, CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN c_name WHEN 2 THEN NULL ELSE c_name END AS cleaned, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_name END AS valid,
 CASE c_custkey % 4 WHEN 1 THEN c_name WHEN 3 THEN c_name ELSE '' END AS number, 'a/b é ' || c_custkey AS decoded, 'praca ' || lower(c_name) AS plain, 'Apto ' || c_custkey || 'B' AS title FROM customer""")
def f59_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, name = F.col("c_custkey"), F.col("c_name")
    text = F.when(k % 4 == 0, " $undefined ").when(k % 4 == 1, F.concat(F.lit("  "), name, F.lit(" "))).when(k % 4 == 3, name)
    return read(spark, sf_dir, "customer").select(
        k.alias("k"), texts.clean_str(text).alias("cleaned"), texts.remove_invalid(F.when(k % 3 == 0, "NonE").otherwise(name)).alias("valid"), texts.street_number(text).alias("number"),
        texts.decode_fragment(F.concat(F.lit(r"a\/b é "), k)).alias("decoded"), texts.strip_accents_lower(F.concat(F.lit(" Praça "), name)).alias("plain"), texts.title_case(F.concat(F.lit("APTO "), k, F.lit("b"))).alias("title"),
    )


@query("""SELECT o_orderkey AS k, CAST(o_orderkey || '234.5' AS DOUBLE) AS float, CAST(o_orderkey || '234' AS BIGINT) AS whole, CAST(o_custkey AS VARCHAR) AS second, NULL::VARCHAR AS third, len([1, 2]) AS n,
 CASE o_orderkey % 3 WHEN 0 THEN 0 WHEN 1 THEN NULL ELSE o_custkey END AS price, CAST(o_orderkey + 1 AS BIGINT) AS fee FROM orders""")
def f60_price_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    amount, list_ = F.concat(k, F.lit(".234,5")), F.concat(k, F.lit(" quartos e "), c, F.lit(" vagas"))
    price = F.when(k % 3 == 0, " ISENTO ").when(k % 3 == 1, "Não  informado").otherwise(F.concat(F.lit("R$ "), c))
    fee = numbers.combined_fee(F.lit(0).cast("bigint"), k + c + 1, c)
    return read(spark, sf_dir, "orders").select(
        k.alias("k"), numbers.text_to_float(amount).alias("float"), numbers.text_to_int(amount).alias("whole"), numbers.get_number(list_, 1).alias("second"), numbers.get_number(list_, 2).alias("third"),
        F.size(numbers.get_numbers(list_)).cast("long").alias("n"), numbers.parse_price_text(price).alias("price"), fee.alias("fee"),
    )


@query("""SELECT o_orderkey AS k, (o_custkey % 80)::DOUBLE AS lat, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE -(o_custkey % 170)::DOUBLE END AS lon, (o_orderkey % 80)::DOUBLE AS widget_lat, o_custkey % 80 || ',-' || o_custkey % 170 AS center, 'q' || o_orderkey AS q,
 'maps_embed_center' AS source FROM orders""")
def f61_points_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of texts, of map widgets' JSON in each of their forms, and of embedded maps' links."""
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    pair = F.concat((c % 80).cast("string"), F.lit(","), F.when(k % 3 == 0, F.lit("x")).otherwise(F.concat(F.lit("-"), c % 170)))
    widget = F.when(k % 3 == 0, F.format_string('{"lat":%d,"lng":2}', k % 80)).when(k % 3 == 1, F.format_string('{"coordinates":[2,%d]}', k % 80)).otherwise(F.format_string('{"location":{"latitude":%d,"longitude":2}}', k % 80))
    html = F.format_string('<a href="https://www.google.com/maps/embed/x"></a><iframe src="https://www.google.com/maps/embed/v1/place?key=k&amp;q=q%d&amp;center=%d%%2C-%d"></iframe>', k, c % 80, c % 170)
    rows = read(spark, sf_dir, "orders").select(k.alias("k"), geo.point_of_text(pair)["lon"].alias("lon"), (c % 80).cast("double").alias("lat"), F.try_parse_json(widget).alias("w"), html.alias("html"))
    from ..operators import extract

    params, none = geo.map_link_params(F.col("html")), F.lit(None).cast("struct<lat:double,lon:double>")
    return rows.select("k", "lat", "lon", geo.widget_point(F.col("w"))["lat"].alias("widget_lat"), params["center"].alias("center"), params["q"].alias("q"), extract.page_point(F.col("html"), none)["source"].alias("source"))


@query("""SELECT p_partkey AS k, [p_name] AS links, CASE p_partkey % 3 WHEN 0 THEN p_name WHEN 1 THEN p_brand ELSE NULL END AS label, CASE WHEN p_partkey % 2 = 0 THEN ['Piscina', 'Pool Table'] END AS labels, ['Piscina', p_name, 'Sauna'] AS amenities FROM part""")
def f62_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image links, labels of amenity items, labels of codes, and the ordered distinct amenities of a listing's lists."""
    k, name = F.col("p_partkey"), F.col("p_name")
    images = F.array(obj(dangerousSrc=F.concat(F.lit(" "), name)), obj(dangerousSrc=F.lit("")), obj(dangerousSrc=F.lit(None).cast("string")))
    own = obj(name=F.when(k % 3 == 0, name), label=F.when(k % 3 == 0, F.lit("second")).when(k % 3 == 1, F.col("p_brand")))
    codes = F.when(k % 2 == 0, F.array(F.lit("POOL"), F.lit(""), F.lit("POOL_TABLE"))).otherwise(F.array(F.lit(" ")))
    rows = dressed(
        read(spark, sf_dir, "part"), "p_partkey", images=images, item=own, codes=codes, amenities=obj(values=F.array(F.lit("POOL"))), features=F.array(F.lit("Piscina"), F.lit(None).cast("string")),
        comforts=F.array(obj(name=name)), lazerItems=F.array(F.lit("Sauna")), other=F.array(F.lit("no")),
    )
    from ..operators import extract

    raw = F.col("raw")
    return rows.select(
        F.col("p_partkey").alias("k"), arrays.image_urls(F.try_variant_get(raw, "$.images", "array<variant>")).alias("links"), arrays.amenity_item_label(F.try_variant_get(raw, "$.item", "variant")).alias("label"),
        arrays.amenity_labels(F.try_variant_get(raw, "$.codes", "array<string>")).alias("labels"), extract.listing_amenities(raw).alias("amenities"),
    )


@query("""WITH s AS (SELECT s_suppkey AS k, 'zapimoveis' AS site FROM supplier UNION ALL SELECT s_suppkey, 'vivareal' FROM supplier UNION ALL SELECT s_suppkey, 'casamineira' FROM supplier)
SELECT site, count(*) AS listings FROM s WHERE site IN ('vivareal', 'zapimoveis') GROUP BY 1 ORDER BY site""")
def f63_chosen_sites_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The summary of a run restricted to named sources, in the order of their names."""
    s = read(spark, sf_dir, "supplier").select("s_suppkey", F.explode(F.array(*map(F.lit, ("zapimoveis", "vivareal", "casamineira")))).alias("site"))
    chosen = s.where(F.col("site").isin(snapshots.select_sites("ZapImoveis; vivareal,vivareal")))
    return snapshots.in_order(chosen.groupBy("site").agg(F.count("*").alias("listings")))


@query("""SELECT s_suppkey, s_nationkey + 10 || '.5,' || s_nationkey + 5 || '.5|-' || s_nationkey || '.5,' || s_nationkey || '.5' AS text, CASE WHEN s_suppkey % 4 = 0 THEN 'fewer_than_one_cell' END AS code FROM supplier""")
def f64_rectangle_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rectangles read from texts and rendered again; those that cannot be split are told apart."""
    from ..operators import spatial

    k = F.col("s_nationkey")
    text = F.format_string("%d.5 ; %d.5 | -%d.5,%d.5", k + 10, k + 5, k, k)
    r = read(spark, sf_dir, "supplier").select("s_suppkey", spatial.parse_rectangle(text).alias("r"), F.when(F.col("s_suppkey") % 4 == 0, 0.5).otherwise(2.0).alias("cells"))
    bad = spatial.unsplittable(r.select("s_suppkey", "cells"), F.col("cells")).select("s_suppkey", "code")
    return r.join(bad, "s_suppkey", "left").select("s_suppkey", spatial.render_rectangle(F.col("r")).alias("text"), "code")
