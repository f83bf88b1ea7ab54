"""Source rows (a variant column) to listing records: one set of column expressions per source."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, geo, numbers, texts
from .filters import amount_field, amount_of, feature_value, image_links, price_of, text_at, thumb_of
from .records import BASE, fill_defaults

Fields = dict[str, Column]
VARIANTS = "array<variant>"
# Hosts and link prefixes of the sources.
VIVAREAL, NETIMOVEIS, QUINTOANDAR, CASAMINEIRA, ZAP = (
    "https://www.vivareal.com.br", "https://www.netimoveis.com/", "https://www.quintoandar.com.br", "https://www.casamineira.com.br/", "https://www.zapimoveis.com.br",
)
THUMBS = f"{QUINTOANDAR}/img/sml/"


def at(value: Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(value, f"$.{path}", kind)


def whole(value: Column, path: str) -> Column:
    return numbers.parse_int_variant(at(value, path, "variant"))


def whole_first(value: Column, *paths: str) -> Column:
    """parse_int of the first element of the first path with a truthy one; values that are no lists count as missing."""
    firsts = [numbers.parse_int_variant(at(value, f"{p}[0]", "variant"), None) for p in paths]
    return F.coalesce(*(F.nullif(x, F.lit(0)) for x in firsts), F.lit(0).cast("bigint"))


def strict_int(value: Column) -> Column:
    """Number truncated, or text of digits alone; 0 without one."""
    text = F.try_variant_get(value, "$", "string")
    digits = F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), F.trim(text).try_cast("bigint"))
    return F.coalesce(F.when(F.schema_of_variant(value) == "STRING", digits).otherwise(numbers.parse_int_variant(value, None)), F.lit(0).cast("bigint"))


def strict_first(value: Column, path: str) -> Column:
    """strict_int of a list's first element or of a bare value."""
    return strict_int(arrays.first_of_variant(at(value, path, "variant")))


def flag(value: Column) -> Column:
    return value.isNotNull().cast("int")


def vivareal(v: Column) -> Fields:
    listing, prices = at(v, "listing", "variant"), at(v, "listing.pricingInfos", VARIANTS)
    rental, sale = price_of(prices, "RENTAL"), price_of(prices, "SALE")
    medias = F.coalesce(at(listing, "medias", VARIANTS), at(v, "medias", VARIANTS))

    def coordinate(name: str, approximate: str) -> Column:
        paths = (f"listing.address.point.{name}", f"listing.address.point.{approximate}", f"map.point.{name}", f"map.point.{approximate}")
        return geo.truthy_coordinate(*(at(v, p, "double") for p in paths))

    return {
        "id": whole(listing, "id"), "url": F.concat(F.lit(VIVAREAL), F.coalesce(at(v, "link.href"), F.lit(""))), "thumb": F.get(image_links(medias), F.lit(0)),
        "aluguel": numbers.parse_int_variant(at(rental, "price", "variant")), "venda": numbers.parse_int_variant(at(sale, "price", "variant")),
        "iptu": numbers.monthly_truncated(geo.number_of(rental, "$.yearlyIptu")), "condominio": numbers.parse_int_variant(at(rental, "monthlyCondoFee", "variant")),
        "banheiros": whole_first(listing, "bathrooms"), "quartos": whole_first(listing, "bedrooms"), "vagas": whole_first(listing, "parkingSpaces"),
        "area": whole_first(listing, "usableAreas", "totalAreas"), "bairro": at(listing, "address.neighborhood"), "tipo_imovel": texts.normalize_type(at(listing, "unitTypes[0]")),
        "endereco": texts.address_line(*(at(listing, f"address.{k}") for k in ("stateAcronym", "city", "neighborhood", "street")), at(v, "link.data.streetNumber")),
        "lat": coordinate("lat", "approximateLat"), "long": coordinate("lon", "approximateLon"),
        "titulo": F.coalesce(at(listing, "title"), F.lit("")), "descricao": F.coalesce(at(listing, "description"), F.lit("")),
        "atualizado": texts.first_truthy(at(listing, "updatedAt"), at(listing, "createdAt")), "tem_locacao": flag(rental), "tem_venda": flag(sale),
    }


def netimoveis(v: Column) -> Fields:
    path = texts.first_truthy(at(v, "urlDetalheImovel"), at(v, "url"))
    parking = F.coalesce(F.nullif(whole(v, "vagaGaragem"), F.lit(0)), whole(v, "vagasGaragem"))
    return {
        "id": whole(v, "imovelSan_Id"), "url": texts.prefixed_url(f"{NETIMOVEIS}venda/", path), "thumb": at(v, "nomeArquivoThumb"),
        "aluguel": whole(v, "valorLocacao"), "venda": whole(v, "valorImovel"), "iptu": whole(v, "valorIptu"), "condominio": whole(v, "valorCondominio"),
        "banheiros": F.try_add(whole(v, "banho"), whole(v, "suites")), "quartos": F.try_add(whole(v, "quartos"), whole(v, "dce")), "vagas": parking, "area": whole(v, "areaRealPrivativa"),
        "bairro": at(v, "nomeBairro"), "tipo_imovel": texts.normalize_type(at(v, "tipoImovel1")),
        "endereco": texts.address_line(*(at(v, k) for k in ("siglaEstado", "nomeCidade", "nomeBairro", "tipoLogradouro", "logradouroPublico"))),
        "lat": geo.truthy_coordinate(at(v, "latitude2", "double")), "long": geo.truthy_coordinate(at(v, "longitude2", "double")),
        "atualizado": at(v, "dataHora"), "tem_locacao": at(v, "exibeLocacao", "boolean").cast("int"), "tem_venda": at(v, "exibeVenda", "boolean").cast("int"),
    }


def quintoandar(v: Column, rent: Column | None = None) -> Fields:
    s = at(v, "_source", "variant")
    listing_id = F.coalesce(F.nullif(numbers.parse_int_variant(at(s, "id", "variant"), None), F.lit(0)), whole(v, "id"))
    picture = texts.first_truthy(at(s, "coverImage"), at(s, "orderedImageList[0]"), at(s, "imageList[0]"))
    return {
        "id": listing_id, "url": texts.listing_url(QUINTOANDAR, listing_id, F.lit(True) if rent is None else rent), "thumb": texts.prefixed_url(THUMBS, picture),
        "aluguel": whole(s, "rent"), "venda": whole(s, "salePrice"), "iptu": F.lit(0).cast("bigint"),
        "condominio": numbers.combined_fee(whole(s, "iptuPlusCondominium"), whole(s, "totalCost"), whole(s, "rent")),
        "banheiros": whole(s, "bathrooms"), "quartos": whole(s, "bedrooms"), "vagas": whole(s, "parkingSpaces"), "area": whole(s, "area"),
        "bairro": at(s, "neighbourhood"), "tipo_imovel": texts.normalize_type(at(s, "type")),
        "endereco": texts.address_line(*(at(s, k) for k in ("regionName", "city", "neighbourhood", "address"))),
        "lat": geo.truthy_coordinate(at(s, "location.lat", "double")), "long": geo.truthy_coordinate(at(s, "location.lon", "double")),
        "titulo": F.coalesce(texts.first_truthy(at(s, "shortRentDescription"), at(s, "shortSaleDescription")), F.lit("")), "cidade": at(s, "city"), "estado": at(s, "regionName"),
    }


def casamineira(v: Column) -> Fields:
    operations, place = at(v, "priceOperationTypes", VARIANTS), at(v, "postingLocation", "variant")
    return {
        "id": whole(v, "postingId"), "url": F.concat(F.lit(CASAMINEIRA), F.regexp_replace(F.coalesce(at(v, "url"), F.lit("")), "^/+", "")), "thumb": thumb_of(v),
        "aluguel": amount_of(operations, "2"), "venda": amount_of(operations, "1"), "iptu": amount_field(v, "iptu"), "condominio": whole(v, "expenses.amount"),
        "banheiros": feature_value(v, "CFT3"), "quartos": feature_value(v, "CFT2"), "vagas": feature_value(v, "CFT7"),
        "area": F.coalesce(F.nullif(feature_value(v, "CFT101"), F.lit(0)), feature_value(v, "CFT100")),
        "bairro": at(place, "location.name"), "tipo_imovel": texts.normalize_type(at(v, "realEstateType.name")), "endereco": at(place, "address.name"),
        "lat": geo.truthy_coordinate(at(place, "postingGeolocation.geolocation.latitude", "double")), "long": geo.truthy_coordinate(at(place, "postingGeolocation.geolocation.longitude", "double")),
    }


def zap_address(address: Column, number: str = "streetNumber", district: str = "neighborhood", city: str = "city", state: str = "stateAcronym") -> Column:
    return texts.address_line(at(address, "street"), at(address, number), at(address, district), at(address, city), at(address, state))


def zap(v: Column) -> Fields:
    listing, prices = at(v, "listing", "variant"), at(v, "listing.pricingInfos", VARIANTS)
    rental, sale, address = price_of(prices, "RENTAL"), price_of(prices, "SALE"), at(v, "listing.address", "variant")
    either = F.coalesce(rental, sale)
    photos = image_links(at(v, "medias", VARIANTS))
    codes = at(listing, "amenities", "array<string>")
    lat = geo.given_coordinate(at(address, "point.lat", "double"), at(address, "point.approximateLat", "double"))
    lon = geo.given_coordinate(at(address, "point.lon", "double"), at(address, "point.approximateLon", "double"))
    return {
        "id": strict_int(at(listing, "id", "variant")), "url": texts.prefixed_url(ZAP, at(v, "link.href")), "thumb": texts.fill_thumb(F.get(photos, F.lit(0))),
        "aluguel": strict_int(at(rental, "price", "variant")), "venda": strict_int(at(sale, "price", "variant")),
        "iptu": numbers.monthly_truncated(geo.number_of(either, "$.yearlyIptu")), "condominio": strict_int(at(either, "monthlyCondoFee", "variant")),
        "banheiros": strict_first(listing, "bathrooms"), "quartos": strict_first(listing, "bedrooms"), "vagas": strict_first(listing, "parkingSpaces"), "area": strict_first(listing, "usableAreas"),
        "bairro": at(address, "neighborhood"), "tipo_imovel": texts.normalize_type(F.try_variant_get(arrays.first_of_variant(at(listing, "unitTypes", "variant")), "$", "string")), "endereco": zap_address(address), "lat": lat, "long": lon,
        "amenidades": F.when(F.size(codes) > 0, codes), "andares": strict_first(listing, "floors"), "cidade": at(address, "city"), "estado": at(address, "stateAcronym"),
        "enderecoRua": texts.clean_str(at(address, "street")), "enderecoNumero": texts.clean_str(at(address, "streetNumber")), "fotos": F.when(F.size(photos) > 0, photos), "externalId": at(listing, "externalId"), "locationId": at(address, "locationId"),
        "geoSource": F.nullif(at(address, "point.source"), F.lit("")), "isAbsoluteLocation": F.when((lat != 0) | (lon != 0), ~F.coalesce(at(address, "approximateLocation", "boolean"), F.lit(False))),
        "publicadoHa": at(listing, "createdAt").try_cast("timestamp").cast("date"), "atualizadoHa": at(listing, "updatedAt").try_cast("timestamp").cast("date"),
    }


def zap_card(v: Column) -> Fields:
    """Structured-data card of a list page."""
    sale = F.when(at(v, "offers.potentialAction.@type") == "BuyAction", whole(v, "offers.potentialAction.priceSpecification.price"))
    one = F.nullif(F.trim(F.when(F.schema_of_variant(at(v, "image", "variant")) == "STRING", at(v, "image"))), F.lit(""))
    photos = F.coalesce(F.when(one.isNotNull(), F.array(one)), F.filter(at(v, "image", "array<string>"), lambda x: F.coalesce(x != "", F.lit(False))))
    street, city, state = (texts.clean_str(at(v, f"address.{k}")) for k in ("streetAddress", "addressLocality", "addressRegion"))
    values = F.filter(F.transform(at(v, "amenityFeature", VARIANTS), lambda a: at(a, "value")), lambda x: F.coalesce(x != "", F.lit(False)))

    def truthy(*paths: str) -> Column:
        return F.coalesce(*(F.nullif(numbers.to_int(at(v, p)), F.lit(0)) for p in paths), F.lit(0).cast("bigint"))

    return {
        "id": F.coalesce(at(v, "@id").try_cast("bigint"), F.lit(0).cast("bigint")), "url": texts.strip_query(texts.first_truthy(at(v, "offers.url"), at(v, "offers.potentialAction.target"))),
        "thumb": F.get(photos, F.lit(0)), "aluguel": truthy("offers.price", "offers.potentialAction.priceSpecification.price"), "venda": F.coalesce(sale, F.lit(0).cast("bigint")),
        "iptu": F.lit(0).cast("bigint"), "condominio": truthy("offers.propertyValue.value"), "banheiros": truthy("numberOfBathroomsTotal"), "quartos": truthy("numberOfBedrooms", "numberOfRooms"),
        "vagas": F.lit(0).cast("bigint"), "area": truthy("floorSize.value"), "bairro": F.lit(""), "tipo_imovel": F.lit(""), "endereco": texts.address_line(street, city, state),
        "lat": F.lit(0.0), "long": F.lit(0.0), "amenidades": F.when(F.size(values) > 0, values), "cidade": at(v, "address.addressLocality"), "estado": state, "enderecoRua": street,
        "fotos": photos, "isAbsoluteLocation": F.lit(False),
    }


def zap_point(v: Column) -> Fields:
    """Map point of a list page."""
    photos = arrays.image_urls(at(v, "imageList", VARIANTS))
    point = geo.point(geo.number_of(v, "$.address.point.lat"), geo.number_of(v, "$.address.point.lon"))

    def price(name: str) -> Column:
        return F.coalesce(numbers.to_int(at(v, f"prices.{name}")), F.lit(0).cast("bigint"))

    def field(path: str) -> Column:
        return F.when(~texts.is_absent(at(v, path)), at(v, path))

    labels = F.coalesce(at(v, "amenities.values", "array<string>"), F.when(at(v, "amenities.values").isNotNull(), F.array(at(v, "amenities.values"))))
    labels = F.filter(labels, lambda x: x.isNotNull())
    return {
        "id": whole(v, "id"), "url": texts.strip_query(field("href")), "thumb": F.get(photos, F.lit(0)), "aluguel": price("rent"),
        "venda": F.when(at(v, "business") == "SALE", price("mainValue")).otherwise(F.lit(0).cast("bigint")), "iptu": price("iptu"), "condominio": price("condominium"),
        "banheiros": whole_first(v, "amenities.bathrooms"), "quartos": whole_first(v, "amenities.bedrooms"), "vagas": whole_first(v, "amenities.parkingSpaces"), "area": whole_first(v, "amenities.usableAreas"),
        "bairro": field("address.neighborhood"), "tipo_imovel": field("unitType"), "endereco": texts.address_line(*(field(f"address.{k}") for k in ("street", "streetNumber", "neighborhood", "city", "stateAcronym"))),
        "lat": F.coalesce(point["lat"], F.lit(0.0)), "long": F.coalesce(point["lon"], F.lit(0.0)), "amenidades": F.when(F.size(labels) > 0, labels), "andares": whole_first(v, "amenities.floors"),
        "cidade": field("address.city"), "estado": field("address.stateAcronym"), "enderecoRua": field("address.street"), "enderecoNumero": field("address.streetNumber"),
        "externalId": field("externalId"), "fotos": F.when(F.size(photos) > 0, photos), "geoSource": F.when(point.isNotNull(), "listing_page"), "isAbsoluteLocation": at(v, "address.approximateLocation", "boolean"),
        "locationId": field("address.locationId"),
    }


SOURCES: dict[str, Callable[[Column], Fields]] = {"vivareal": vivareal, "netimoveis": netimoveis, "quintoandar": quintoandar, "casamineira": casamineira, "zapimoveis": zap}


def records(df: DataFrame, fields: Callable[[Column], Fields], raw: str = "raw", keep: tuple[str, ...] = ()) -> DataFrame:
    """Listing records of a source's rows: base columns filled with defaults, then the source's own columns, then payload."""
    made = fields(F.col(raw))
    kinds = {"lat": "double", "long": "double", "id": "bigint"} | {c: "int" for c in ("aluguel", "venda", "iptu", "condominio", "banheiros", "quartos", "vagas", "area")}
    columns = [made[c].try_cast(kinds[c]).alias(c) if c in kinds else made[c].alias(c) for c in BASE]
    extra = [v.alias(c) for c, v in made.items() if c not in BASE]
    return fill_defaults(df.select(*keep, *columns, *extra, F.col(raw).alias("payload")))


__all__ = ["SOURCES", "records", "text_at", "zap_card", "zap_point"]
