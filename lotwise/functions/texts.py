"""Texts of listings: absent values, vocabularies, addresses, links, identifiers. Column expressions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .once import bound, unless

# Texts that mean "absent".
SENTINELS = ["", "$undefined", "undefined", "null", "None"]
# Texts of invalid fields.
INVALID = ["undefined", "null", "none", ""]
# Words of property types.
HOUSE = ["triplex", "casa", "two_story_house", "casacondominio", "home", "casas", "single_storey_house", "village_house", "farm", "allotment_land", "residential_allotment_land"]
APARTMENT = ["apartamento", "apartment", "condominium", "flat", "studio", "apartamentos", "studiooukitchenette", "kitnet", "loft", "duplex", "penthouse"]
# Labels of amenity codes.
AMENITIES = {
    "INTERNET_ACCESS": "Internet", "GRASS": "Gramado", "CABLE_TV": "TV a cabo", "GATED_COMMUNITY": "Condomínio fechado",
    "HEATING": "Aquecimento", "KITCHEN": "Cozinha", "SERVICE_AREA": "Área de serviço", "ELEVATOR": "Elevador",
    "WATCHMAN": "Vigia", "GARAGE": "Garagem", "GARDEN": "Jardim", "FURNISHED": "Mobiliado",
    "SAFETY_CIRCUIT": "Circuito de segurança", "PETS_ALLOWED": "Aceita pets", "CONCIERGE_24H": "Portaria 24h", "INTERCOM": "Interfone",
    "POOL": "Piscina", "GYM": "Academia", "LAUNDRY": "Lavanderia", "ELECTRONIC_GATE": "Portão eletrônico",
    "DISABLED_ACCESS": "Acesso para deficientes", "SAUNA": "Sauna", "BALCONY": "Varanda", "CLOSET": "Closet",
    "AMERICAN_KITCHEN": "Cozinha americana", "SUITE": "Suíte", "PLAYGROUND": "Playground", "SPORTS_COURT": "Quadra poliesportiva",
    "BARBECUE_GRILL": "Churrasqueira", "PARTY_ROOM": "Salão de festas", "AIR_CONDITIONING": "Ar-condicionado",
}
ACCENTED = "áàâãäåéèêëíìîïóòôõöúùûüçñýÿ"
PLAIN = "aaaaaaeeeeiiiiooooouuuucnyy"
# The template of a thumbnail link, and the size it is asked for in.
THUMB_TEMPLATE = "action={action}&dimension={width}x{height}"
THUMB_SIZE = "action=fit-in&dimension=614x297"


def first_truthy(*columns: Column, zero="") -> Column:
    """The first value that is neither null nor the zero of its type."""
    return F.coalesce(*(F.nullif(c, F.lit(zero)) for c in columns))


def is_absent(text: Column) -> Column:
    return text.isNull() | F.trim(text).isin(SENTINELS)


def is_absent_list(values: Column) -> Column:
    """A list is absent if it is null, empty or starts with an absent value."""
    return values.isNull() | (F.size(values) == 0) | is_absent(F.get(values, F.lit(0)))


def is_absent_variant(value: Column) -> Column:
    """Absent JSON value: null, an absent text, an empty list or one that starts so. Numbers and booleans never are."""
    kind = F.schema_of_variant(value)
    first = F.try_variant_get(value, "$[0]", "variant")
    text = F.try_variant_get(value, "$", "string")

    def scalar(k, t):
        return (k == "VOID") | ((k == "STRING") & F.coalesce(F.trim(t).isin(SENTINELS), F.lit(True)))

    head = F.when(first.isNull(), True).otherwise(scalar(F.schema_of_variant(first), F.try_variant_get(value, "$[0]", "string")))
    return F.when(value.isNull(), True).when(kind.startswith("ARRAY"), head).otherwise(scalar(kind, text))


def clean_str(text: Column) -> Column:
    return F.when(~is_absent(text), F.trim(text))


def strip_accents_lower(text: Column) -> Column:
    return F.translate(F.lower(F.trim(text)), ACCENTED, PLAIN)


def remove_invalid(text: Column) -> Column:
    return F.when(~F.lower(text).isin(INVALID), text)


def normalize_type(text: Column, house: list[str] = HOUSE, apartment: list[str] = APARTMENT) -> Column:
    """'Casa' or 'Apartamento' by the first word of either vocabulary, else 'Outro'."""
    words = F.split(F.lower(F.trim(text)), r"\s+")
    kinds = F.transform(words, lambda w: F.when(w.isin(house), "Casa").when(w.isin(apartment), "Apartamento"))
    return F.coalesce(F.get(F.filter(kinds, lambda k: k.isNotNull()), F.lit(0)), F.lit("Outro"))


def street_number(text: Column) -> Column:
    return F.coalesce(clean_str(text), F.lit(""))


def address_line(*parts: Column) -> Column:
    """The parts that hold a text, joined by commas."""
    return F.concat_ws(", ", *(unless(p, "") for p in parts))


def full_address(street: Column, number: Column, district: Column, city: Column, state: Column) -> Column:
    """'street, number - district - city - state' of the parts that hold a text; null without any."""
    street, number, district, city, state = (F.nullif(F.trim(p), F.lit("")) for p in (street, number, district, city, state))
    line = F.concat_ws(", ", street, number)
    # A district is set off by its dash even where nothing stands before it.
    line = F.when(district.isNotNull(), F.concat(line, F.lit(" - "), district)).otherwise(line)
    return F.nullif(F.concat_ws(" - ", F.nullif(line, F.lit("")), city, state), F.lit(""))


def strip_query(url: Column) -> Column:
    return F.split_part(url, F.lit("?"), F.lit(1))


def fill_thumb(url: Column) -> Column:
    return F.replace(url, F.lit(THUMB_TEMPLATE), F.lit(THUMB_SIZE))


def prefixed_url(prefix: str, path: Column) -> Column:
    """Prefix and path, or an empty text without a path."""
    return F.when(F.coalesce(path, F.lit("")) == "", "").otherwise(F.concat(F.lit(prefix), path))


def listing_url(host: str, listing_id: Column, rent: Column) -> Column:
    """Public page of a listing: its segment tells rent from sale."""
    return F.concat(F.lit(f"{host}/imovel/"), listing_id.cast("string"), F.when(rent, "/alugar/").otherwise("/comprar/"))


def sanitize_identifier(text: Column) -> Column:
    """Lower-case letters, digits and single underscores, at most 63; null where nothing is left."""
    low = F.regexp_replace(F.lower(F.replace(F.trim(text), F.lit("-"), F.lit("_"))), "[^a-z0-9_]+", "_")
    return F.nullif(F.left(F.regexp_replace(F.regexp_replace(low, "_+", "_"), "^_|_$", ""), F.lit(63)), F.lit(""))


def table_name(file_name: Column) -> Column:
    """Snapshot file name to table name: site_YYYY_MM_DD_HH_MM; null for other names."""
    parts = r"^(\d{4})-(\d{2})-(\d{2})_(\d{2})-(\d{2})_([a-zA-Z0-9_]+)\.json$"
    return F.when(file_name.rlike(parts), F.lower(F.regexp_replace(file_name, parts, r"$6_$1_$2_$3_$4_$5")))


def file_name(table: Column) -> Column:
    """Table name to snapshot file name; null for other names."""
    parts = r"^([a-z0-9_]+)_(\d{4})_(\d{2})_(\d{2})_(\d{2})_(\d{2})$"
    return F.when(table.rlike(parts), F.regexp_replace(table, parts, r"$2-$3-$4_$5-$6_$1.json"))


def base_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def qualified_table_name(path: Column, schema: str) -> Column:
    return F.concat(F.lit(f'"{schema}"."'), table_name(base_name(path)), F.lit('"'))


def legacy_table_name(base: str, file_name: Column) -> Column:
    """base_YYYY_MM_DD_HH_MM of a snapshot file."""
    return F.concat(F.lit(f"{base}_"), F.replace(F.regexp_extract(file_name, r"^(\d{4}-\d{2}-\d{2}_\d{2}-\d{2})_", 1), F.lit("-"), F.lit("_")))


def decode_fragment(text: Column) -> Column:
    """The inside of a JSON string literal, decoded; where that fails, only its slashes."""

    def decoded(t: Column) -> Column:
        literal = F.get(F.from_json(F.concat(F.lit('["'), t, F.lit('"]')), "array<string>"), F.lit(0))
        return F.coalesce(literal, F.replace(t, F.lit("\\/"), F.lit("/")), F.lit(""))

    return bound(text, decoded)


def source_label(stamp: Column, site: Column) -> Column:
    return F.concat_ws(" / ", stamp, site)


def title_case(text: Column) -> Column:
    """Each run of letters with a capital and small letters: a letter after a digit or a mark starts a word."""
    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(r"\p{L}+|\P{L}+"), F.lit(0)), F.initcap), "")


def amenity_label(code: Column) -> Column:
    """Label of a code; other codes in words with capitals; blank stays blank."""
    known = F.create_map(*(F.lit(x) for pair in AMENITIES.items() for x in pair))
    c = F.trim(F.coalesce(code, F.lit("")))
    return F.coalesce(F.try_element_at(known, c), title_case(F.replace(c, F.lit("_"), F.lit(" "))))


def any_contains(text: Column, parts: list[str]) -> Column:
    return reduce(lambda a, b: a | b, (text.contains(p) for p in parts))
