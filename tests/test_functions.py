"""Scalar functions on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lotwise.functions import arrays, dates, geo, numbers, texts
from lotwise.operators import filters

DAY = dt.date


@pytest.fixture(scope="module")
def over(spark):
    def run(values, f, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}").coalesce(1)
        return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]

    return run


def json(f):
    return lambda v: f(F.try_parse_json(v))


def test_numbers(over):
    assert over(["1.234,56", "1200.50", None, "x", "1d", "", " 7 ", "-3", "1_000", "nan", "1e3"], numbers.parse_int) == [123456, 120050, 0, 0, 0, 0, 7, -3, 0, 0, 1000]
    assert over(['"1.234,56"', "1200.9", "null", '"x"', "true", "[1]", '{"a":1}', "-2.7"], json(numbers.parse_int_variant)) == [123456, 1200, 0, 0, 1, 0, 0, -2]
    assert over(["1,5", "x", None, "2."], numbers.parse_float) == [1.5, None, None, 2.0]
    assert over(["12.9", "x", "-12.9", None], numbers.to_int) == [12, None, -12, None]
    assert over(["R$ 1.234", "R$ 1234", "none", "7"], numbers.parse_first_int) == [1234, 123, None, 7]
    assert over(["R$ 1.234,50", "none", None], numbers.parse_int_digits) == [123450, None, None]
    assert over(["1.234,56", "x"], numbers.text_to_float) == [1234.56, None]
    assert over(["1.234,56"], numbers.text_to_int) == [1234]
    assert over(["3 quartos 1,5 ab 2"], numbers.get_numbers) == [["3", "1,5", "2"]]
    assert over(["3 quartos 2"], lambda v: numbers.get_number(v, 1)) == ["2"]
    assert over(["3 quartos 2"], lambda v: numbers.get_number(v, 5)) == [None]
    assert over([30.0, 18.0, None], numbers.monthly_truncated, "double") == [2, 1, 0]
    assert over([30.0, 18.0, None], numbers.monthly_rounded, "double") == [2, 2, None]
    assert over(["Isento", "Não informado", "R$ 350", "nao  informado", None], numbers.parse_price_text) == [0, None, 350, None, None]


def test_monthly_tax(spark):
    rows = [(True, None, "5", None, 30.0), (None, "valor ISENTO", "5", None, 30.0), (None, None, "5.9", "7", 30.0), (None, None, None, "7", 30.0), (False, None, None, None, 30.0), (None, None, None, None, None)]
    df = spark.createDataFrame(rows, "a boolean, b string, c string, d string, e double").coalesce(1)
    assert [r[0] for r in df.select(numbers.monthly_tax(*(F.col(c) for c in "abcde"))).collect()] == [0, 0, 5, 7, 2, None]
    assert [r[0] for r in spark.createDataFrame([(0, 9, 4), (3, 9, 4)], "a int, b int, c int").coalesce(1).select(numbers.combined_fee(F.col("a"), F.col("b"), F.col("c"))).collect()] == [5, 3]


def test_absence(over):
    assert over([None, " ", "$undefined", "None", "null", "0", "x"], texts.is_absent) == [True, True, True, True, True, False, False]
    assert over([None, [], [""], ["a", ""]], texts.is_absent_list, "array<string>") == [True, True, True, False]
    assert over(["null", '""', '" null "', "0", "false", "[]", '["undefined"]', '["a"]', "{}"], json(texts.is_absent_variant)) == [True, True, True, False, False, True, True, False, False]
    assert over([" a ", "undefined"], texts.clean_str) == ["a", None]
    assert over(["NULL", "x"], texts.remove_invalid) == [None, "x"]


def test_texts(over, spark):
    assert over(["TWO_STORY_HOUSE", "Studio x", "Lote", None, "um flat casa", ""], texts.normalize_type) == ["Casa", "Apartamento", "Outro", "Outro", "Apartamento", "Outro"]
    assert over([" Praça São João "], texts.strip_accents_lower) == ["praca sao joao"]
    assert over(["AIR_CONDITIONING", "ROOF_TOP", "", None], texts.amenity_label) == ["Ar-condicionado", "Roof Top", "", ""]
    assert over(["CONCIERGE_12H", "SALA_D'AGUA", "A-B"], texts.amenity_label) == ["Concierge 12H", "Sala D'Agua", "A-B"]
    assert over([None, " 5 ", "undefined"], texts.street_number) == ["", "5", ""]
    assert over(["http://a/b?c=1#d", "http://a/b#c"], texts.strip_query) == ["http://a/b", "http://a/b#c"]
    assert over(["http://t/?" + texts.THUMB_TEMPLATE, None], texts.fill_thumb) == ["http://t/?action=fit-in&dimension=614x297", None]
    assert over(["Zap-Imóveis 2026!", "__", "A" * 80], texts.sanitize_identifier) == ["zap_im_veis_2026", None, "a" * 63]
    assert over(["2026-06-01_02-25_quintoandar.json", "x.json"], texts.table_name) == ["quintoandar_2026_06_01_02_25", None]
    assert over(["quintoandar_2026_06_01_02_25", "x"], texts.file_name) == ["2026-06-01_02-25_quintoandar.json", None]
    assert over(["/d/2026-06-21_07-05_zapimoveis.json"], lambda v: texts.qualified_table_name(v, "public")) == ['"public"."zapimoveis_2026_06_21_07_05"']
    assert over(["2026-05-04_01-01_vivareal.json"], lambda v: texts.legacy_table_name("old", v)) == ["old_2026_05_04_01_01"]
    assert over([r"a\/b é", r"bad \x\/", None], texts.decode_fragment) == ["a/b é", r"bad \x/", ""]
    rows = [("R. X", "5", "Centro", "BH", "MG"), ("R. X", None, None, "BH", None), (None, None, None, None, "MG"), (None, None, None, None, None), (None, None, "Centro", "BH", None)]
    df = spark.createDataFrame(rows, "a string, b string, c string, d string, e string").coalesce(1)
    assert [r[0] for r in df.select(texts.full_address(*(F.col(c) for c in "abcde"))).collect()] == ["R. X, 5 - Centro - BH - MG", "R. X - BH", "MG", None, " - Centro - BH"]
    assert df.select(texts.address_line(*(F.col(c) for c in "abcde"))).first()[0] == "R. X, 5, Centro, BH, MG"


def test_dates(over):
    assert over(["2026-06-01_02-25", "2026-13-01_02-25", None], dates.stamp_to_timestamp) == [dt.datetime(2026, 6, 1, 2, 25), None, None]
    assert over(["2026-01-02T23:00:00-03:00", "2026-01-02T23:00:00", "x", "2026-01-02T01:00:00Z"], dates.iso_to_utc_date) == [DAY(2026, 1, 3), DAY(2026, 1, 2), None, DAY(2026, 1, 2)]
    assert over(["2026-01-02T23:00:00-03:00", "2026-01-", "2026-01-02"], dates.prefix_date) == ["2026-01-02", None, "2026-01-02"]
    as_of = F.lit("2026-06-01")
    phrases = ["publicado há 2 meses", "PUBLICADO HÁ 1 dia", "publicado há 1 mês", "há 3 dias", "publicado há 3 semanas", None]
    assert over(phrases, lambda v: dates.relative_date(v, "publicado", as_of)) == [DAY(2026, 4, 2), DAY(2026, 5, 31), DAY(2026, 5, 2), None, DAY(2026, 5, 11), None]
    assert over(["publicado há 999999999999999 anos", "publicado há 9000 anos", "publicado há 99999999999999999999 dias"], lambda v: dates.relative_date(v, "publicado", as_of)) == [None, None, None]
    mixed = ["2026-01-02T23:00:00-03:00", "publicado há 1 ano", "", "x"]
    assert over(mixed, lambda v: dates.calendar_date(v, "publicado", as_of)) == [DAY(2026, 1, 2), DAY(2025, 6, 1), None, None]


def test_arrays(over):
    assert over([[1, 2], [], None], arrays.first_value, "array<int>") == [1, None, None]
    assert over([[1, 2], [5]], lambda v: arrays.element(v, -1), "array<int>") == [2, 5]
    images = '[{"dangerousSrc":" a "},{"dangerousSrc":""},{"x":1}]'
    assert over([images], lambda v: arrays.image_urls(F.try_variant_get(F.try_parse_json(v), "$", "array<variant>"))) == [["a"]]
    assert over(['"x"', '{"label":"b","name":""}', "3"], json(arrays.amenity_item_label)) == ["x", "b", None]
    assert over([["POOL", ""], [""], None], arrays.amenity_labels, "array<string>") == [["Piscina"], None, None]


def test_geo(over, spark):
    assert [p and tuple(p) for p in over(["-19.9,-43.9", "95,0", "1", "a,b", None], geo.point_of_text)] == [(-19.9, -43.9), None, None, None, None]
    df = spark.createDataFrame([(0.0, 2.0), (None, 2.0), (None, None)], "a double, b double").coalesce(1)
    assert [tuple(r) for r in df.select(geo.truthy_coordinate(F.col("a"), F.col("b")), geo.given_coordinate(F.col("a"), F.col("b"))).collect()] == [(2.0, 0.0), (2.0, 2.0), (0.0, 0.0)]
    widgets = ['{"lat":1,"lng":2}', '{"coordinates":[2,1]}', '{"location":{"latitude":1,"longitude":2}}', "{}"]
    assert [p and tuple(p) for p in over(widgets, json(geo.widget_point))] == [(1.0, 2.0), (1.0, 2.0), (1.0, 2.0), None]
    html = '<iframe src="https://www.google.com/maps/embed/v1/place?key=k&amp;q=-19.9%2C-43.9&amp;center=1%2C2"></iframe>'
    assert tuple(over([html], geo.map_link_params)[0]) == ("1,2", "-19.9,-43.9", "k")
    assert over([" ab", "Rua X, BH", "Rua X, Brasil"], geo.geocoding_text) == [None, "Rua X, BH, Brazil", "Rua X, Brasil"]


def test_entries(over):
    infos = '[{"businessType":"SALE","price":"1"},{"businessType":"RENTAL","price":"2"},{"businessType":"RENTAL","price":"3"}]'
    array = lambda v: F.try_variant_get(F.try_parse_json(v), "$", "array<variant>")
    assert over([infos, "[]"], lambda v: filters.text_at(filters.price_of(array(v), "RENTAL"), "$.price")) == ["2", None]
    assert over(['[1,{"price":1},{"business":"RENTAL","price":2}]', '[1,{"price":1}]'], lambda v: filters.text_at(filters.rental_row(array(v)), "$.price")) == ["2", "1"]
    operations = '[{"operationType":{"operationTypeId":"2"},"prices":[{"currencyId":"1","amount":5},{"amount":"x"},{"currencyId":"3","amount":900.5}]}]'
    assert over([operations, operations], lambda v: filters.amount_of(array(v), "2")) == [900, 900]
    assert over(['[{"type":"VIDEO","url":"v"},{"type":"IMAGE","url":"i"},{"type":"IMAGE"}]'], lambda v: filters.image_links(array(v))) == [["i"]]
    assert over(['{"iptu":{"amount":5}}', '{"iptu":7}', "{}"], json(lambda v: filters.amount_field(v, "iptu"))) == [5, 7, 0]
