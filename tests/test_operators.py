"""Sources, records, merges, cells, loads and streams on small fixtures."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from lotwise.operators import dedupe, extract, filters, load, merge, normalize, records, spatial
from lotwise.sources import envelopes, pages, snapshots
from lotwise.operators.facts import FactTable, whole
from lotwise.streaming import ingest


@pytest.fixture(scope="module")
def variants(spark):
    return lambda *values: spark.createDataFrame([(i, v if isinstance(v, str) else json.dumps(v)) for i, v in enumerate(values)], "i int, j string").coalesce(1).select("i", F.try_parse_json("j").alias("raw"))


def files(spark, names):
    return spark.createDataFrame([(n,) for n in names], "file_name string")


def test_catalogue(spark):
    names = ["2026-06-01_02-25_quintoandar.json", "2026-06-02_02-25_QuintoAndar.json", "2026-06-02_02-25_quintoandar.json", "2026-13-02_02-25_vivareal.json", "2026-06-01_00-00_imoveis_unificados.json", "2026-06-01_00-00_other.json", "readme.txt"]
    newest = {r["site"]: r["file_name"] for r in snapshots.newest_per_site(files(spark, names)).collect()}
    assert newest == {"quintoandar": "2026-06-02_02-25_QuintoAndar.json", "other": "2026-06-01_00-00_other.json"}
    assert {r["file_name"] for r in snapshots.loadable(files(spark, names)).collect()} == {*names[:3]}
    assert [(r["file_name"], r["code"]) for r in snapshots.impossible(files(spark, names)).collect()] == [(names[3], "impossible_stamp")]
    assert [r["site"] for r in snapshots.in_order(snapshots.newest_per_site(files(spark, names))).collect()] == ["other", "quintoandar"]
    assert snapshots.select_sites("zapimoveis; VivaReal,vivareal") == ["vivareal", "zapimoveis"]
    assert snapshots.select_sites("none") == [] and snapshots.select_sites(None) == snapshots.SITES
    with pytest.raises(ValueError):
        snapshots.select_sites("nowhere")


def test_provider(spark):
    old = ["2026-01-01_00-00_zapimoveis_aluguel.json", "2026-01-02_00-00_zapimoveis_venda.json", "2025-01-02_00-00_zapimoveis_venda.json"]
    got = snapshots.latest_for_provider(files(spark, old), "zapimoveis").orderBy("priority").collect()
    assert [r["file_name"] for r in got] == [old[1], old[0]]
    other = [n.replace("zapimoveis", "vivareal") for n in old]
    assert snapshots.latest_for_provider(files(spark, other), "vivareal").count() == 0
    new = "2025-01-01_00-00_zapimoveis.json"
    assert [r["file_name"] for r in snapshots.latest_for_provider(files(spark, [*old, new]), "zapimoveis").collect()] == [new]
    rent = spark.createDataFrame([("1", "rent"), ("2", "rent")], "key string, v string")
    sale = spark.createDataFrame([("1", "sale")], "key string, v string")
    assert sorted(map(tuple, snapshots.combine_legacy(rent, sale).collect())) == [("1", "sale"), ("2", "rent")]


def test_bodies(spark):
    bodies = ['{"a":{"id":1},"a":{"id":2}}', '[{"id":1},{"id":null},5]', "7", "", "not json"]
    rows = spark.createDataFrame([(f"f{i}", b) for i, b in enumerate(bodies)], "file_name string, body string")
    got = snapshots.listings(snapshots.explode_body(rows)).select("file_name", F.try_variant_get("raw", "$.id", "int").alias("id")).collect()
    assert sorted(map(tuple, got)) == [("f0", 2), ("f1", 1)]


def test_unified_and_stamped_rows(variants):
    rows = variants({"id": 895366613, "thumb": "x", "long": 2.5, "aluguel": 3}, {"id": 5, "lon": 1.0, "long": 2.0, "fonte": "zapimoveis"}, {"id": 0})
    rows = rows.withColumns({"site": F.lit("quintoandar"), "stamp": F.lit("2026-06-01_02-25")})
    unified = records.unified_from_raw(rows)
    valid, rest = records.split_valid(unified)
    got = {r["id"]: r for r in valid.collect()}
    assert (got[895366613]["lon"], got[5]["lon"], got[5]["fonte"], got[5]["thumb"]) == (2.5, 1.0, "zapimoveis", None)
    assert [r["code"] for r in rest.collect()] == ["missing_id"]
    assert records.unified_from_raw(rows, strict_lon=True).where("id = 895366613").first()["lon"] is None
    stamped = {r["id"]: r for r in records.stamped_rows(valid).collect()}
    assert stamped[895366613]["uid"] == "895366613_quintoandar_2026-06-01_02-25" and stamped[895366613]["scrapy_date"] == dt.datetime(2026, 6, 1, 2, 25)
    assert records.snapshot_rows(valid).where("id = 895366613").first()["uid"] == "895366613_quintoandar"


def test_dedupe(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3)], "k string, seq int")
    assert sorted(map(tuple, dedupe.first_wins(df, ["k"], ["seq"]).collect())) == [("a", 1), ("b", 3)]
    assert sorted(map(tuple, dedupe.last_wins(df, ["k"], ["seq"]).collect())) == [("a", 2), ("b", 3)]
    other = spark.createDataFrame([("a", 9), ("c", 8)], "k string, seq int")
    assert sorted(map(tuple, dedupe.with_priority([other, df], "k", ["seq"]).collect())) == [("a", 9), ("b", 3), ("c", 8)]
    page = spark.createDataFrame([(1, 1), (2, 1), (1, 2), (3, 2), (3, 3)], "id int, page int")
    assert sorted(map(tuple, dedupe.new_per_page(page, "id", "page").collect())) == [(1, 2, 2, False), (2, 2, 1, False), (3, 1, 0, True)]
    scored = spark.createDataFrame([(1, 5, 0), (1, 7, 2), (1, 7, 1)], "p int, score int, pos int")
    assert dedupe.best_candidate(scored, ["p"], "score", "pos").first()["pos"] == 1


def test_merges(spark):
    a = spark.createDataFrame([(1, 0, None), (2, 5, "x")], "id int, area int, cidade string")
    b = spark.createDataFrame([(1, 7, "y"), (3, 8, "z")], "id int, area int, cidade string")
    assert sorted(map(tuple, merge.detail_and_list(a, b).collect())) == [(1, 0, "y"), (2, 5, "x")]
    assert sorted(map(tuple, merge.detail_and_list(a, b, "fill_zero").collect())) == [(1, 7, "y"), (2, 5, "x")]
    listings = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("", "no", 3)], "id string, raw string, seq int")
    points = spark.createDataFrame([("1", "p", 1), ("2", "q", 1)], "id string, raw string, seq int")
    assert sorted(map(tuple, merge.listings_and_points(listings, points, ["seq"]).collect())) == [("1", "new", "p", False), ("2", None, "q", True)]
    pts = spark.createDataFrame([(1, "u", None, 1), (2, "", "c", 2), (4, "u", "d", 3)], "id int, url string, cidade string, seq int")
    cards = spark.createDataFrame([(1, "v", "e", 1), (0, "u", "f", 2)], "id int, url string, cidade string, seq int")
    assert [(r["id"], r["cidade"]) for r in merge.points_and_cards(pts, cards, ["seq"]).collect()] == [(4, "d")]
    twice = merge.coalesced(pts.unionByName(pts), cards, "id", pts.columns)
    assert twice.count() == 6 and merge.points_and_cards(pts.unionByName(pts), cards.unionByName(cards), ["seq"]).count() == 1


def test_responses(spark):
    rows = [("netimoveis", "u1", 200, '{"lista":[{"id":1},5]}'), ("netimoveis", "u2", 200, '{"erro":true}'), ("vivareal", "u3", 404, "{}"), ("vivareal", "u4", 200, "<html>"), ("vivareal", "u5", 200, '{"search":{"result":{"totalCount":7,"listings":[{}]}}}')]
    good, bad = filters.usable_responses(spark.createDataFrame(rows, "source string, url string, status int, body string"))
    assert {r["url"]: r["code"] for r in bad.collect()} == {"u2": "source_error", "u3": "status", "u4": "not_json"}
    assert envelopes.unwrap(good.where("source = 'netimoveis'"), "netimoveis").count() == 1
    assert good.where("url = 'u5'").select(envelopes.total(F.col("json"), "vivareal")).first()[0] == 7


def test_vivareal(variants):
    row = {
        "listing": {
            "id": "12", "address": {"stateAcronym": "MG", "city": "BH", "neighborhood": "Centro", "street": "Rua X", "point": {"lat": 0, "approximateLat": -19.5}},
            "pricingInfos": [{"businessType": "RENTAL", "price": "1.200", "yearlyIptu": 30, "monthlyCondoFee": "300"}], "bathrooms": [2], "bedrooms": [], "usableAreas": [0], "totalAreas": [80], "unitTypes": ["HOME"], "createdAt": "2026",
        }, "medias": [{"type": "VIDEO", "url": "v"}, {"type": "IMAGE", "url": "i"}], "link": {"href": "/p", "data": {"streetNumber": "5"}}, "map": {"point": {"lon": -43.5}},
    }
    r = normalize.records(variants(row), normalize.vivareal).first()
    assert (r["id"], r["url"], r["thumb"], r["aluguel"], r["venda"], r["iptu"], r["condominio"]) == (12, "https://www.vivareal.com.br/p", "i", 1200, 0, 2, 300)
    assert (r["banheiros"], r["quartos"], r["area"], r["tipo_imovel"], r["endereco"]) == (2, 0, 80, "Casa", "MG, BH, Centro, Rua X, 5")
    assert (r["lat"], r["long"], r["tem_locacao"], r["tem_venda"], r["atualizado"]) == (-19.5, -43.5, 1, 0, "2026")


def test_other_sources(variants):
    n = normalize.records(variants({"imovelSan_Id": 3, "url": "x", "banho": 1, "suites": 2, "vagaGaragem": 0, "vagasGaragem": 2, "siglaEstado": "MG", "nomeCidade": "", "nomeBairro": "B", "tipoImovel1": "Casa", "latitude2": 1.5, "exibeVenda": True}), normalize.netimoveis).first()
    assert (n["id"], n["url"], n["banheiros"], n["vagas"], n["endereco"], n["lat"], n["tem_venda"], n["bairro"]) == (3, "https://www.netimoveis.com/venda/x", 3, 2, "MG, B", 1.5, 1, "B")
    q = normalize.records(variants({"id": "9", "_source": {"rent": 100, "totalCost": 150, "coverImage": "c.jpg", "type": "Apartamento", "city": "BH"}}), normalize.quintoandar).first()
    assert (q["id"], q["condominio"], q["thumb"], q["tipo_imovel"], q["cidade"]) == (9, 50, "https://www.quintoandar.com.br/img/sml/c.jpg", "Apartamento", "BH")
    posting = {
        "postingId": "7", "url": "/imovel.html", "priceOperationTypes": [{"operationType": {"operationTypeId": 2}, "prices": [{"amount": 10}]}], "iptu": {"amount": 4}, "expenses": {"amount": 6},
        "mainFeatures": {"CFT3": {"value": "2"}, "CFT100": {"value": 70}}, "postingLocation": {"location": {"name": "L"}, "address": {"name": "A"}, "postingGeolocation": {"geolocation": {"latitude": 1.0, "longitude": 2.0}}},
        "visiblePictures": {"pictures": [{"url360x266": "p"}]}, "realEstateType": {"name": "Casas"},
    }
    c = normalize.records(variants(posting), normalize.casamineira).first()
    assert (c["id"], c["url"], c["aluguel"], c["venda"], c["iptu"], c["condominio"], c["banheiros"], c["area"], c["bairro"], c["endereco"], c["thumb"], c["tipo_imovel"], c["long"]) == (7, "https://www.casamineira.com.br/imovel.html", 10, 0, 4, 6, 2, 70, "L", "A", "p", "Casa", 2.0)
    z = normalize.records(variants({"listing": {"id": "5", "pricingInfos": [{"businessType": "SALE", "price": "9", "yearlyIptu": "24", "monthlyCondoFee": "8"}], "address": {"street": "R", "point": {"lat": 1.0, "lon": 2.0}}, "amenities": ["POOL"], "createdAt": "2026-01-02T23:00:00-03:00"}, "link": {"href": ""}}), normalize.zap).first()
    assert (z["id"], z["url"], z["venda"], z["iptu"], z["condominio"], z["amenidades"], z["publicadoHa"], z["geoSource"], z["isAbsoluteLocation"]) == (5, "", 9, 0, 8, ["POOL"], dt.date(2026, 1, 3), None, True)
    bare = {"listing": {"bedrooms": 3, "bathrooms": ["2"], "floors": [], "amenities": [], "pricingInfos": [{"businessType": "SALE", "price": "1.200", "yearlyIptu": 30}], "address": {"approximateLocation": True, "point": {"approximateLat": 1.0, "source": "G"}}}}
    z, v = (normalize.records(variants(bare), f).first() for f in (normalize.zap, normalize.vivareal))
    assert (z["quartos"], z["banheiros"], z["andares"], z["venda"], z["iptu"], z["amenidades"], z["geoSource"], z["isAbsoluteLocation"], z["lat"]) == (3, 2, 0, 0, 2, None, "G", False, 1.0)
    assert (v["quartos"], v["banheiros"]) == (0, 2)  # a bare value is no list


def test_card_and_point(variants):
    card = {"@id": "44", "offers": {"price": 1500, "url": "http://z/x?y=1"}, "amenityFeature": [{"value": "Piscina"}, {}], "address": {"streetAddress": "Rua A", "addressLocality": "BH"}, "floorSize": {"value": "70"}, "numberOfBathroomsTotal": 2, "numberOfBedrooms": 3, "image": ["i1", "i2"]}
    r = normalize.records(variants(card), normalize.zap_card).first()
    assert (r["id"], r["url"], r["aluguel"], r["venda"], r["area"], r["quartos"], r["thumb"], r["amenidades"], r["endereco"]) == (44, "http://z/x", 1500, 0, 70, 3, "i1", ["Piscina"], "Rua A, BH")
    point = {"id": 8, "href": "http://z/8?q", "business": "SALE", "prices": {"mainValue": 900, "rent": None, "iptu": 5}, "address": {"street": "R", "streetNumber": "$undefined", "point": {"lat": -19.0, "lon": -43.0}}, "amenities": {"values": ["A"], "bathrooms": [2]}, "imageList": [{"dangerousSrc": "d"}]}
    p = normalize.records(variants(point), normalize.zap_point).first()
    assert (p["id"], p["url"], p["venda"], p["aluguel"], p["lat"], p["banheiros"], p["endereco"], p["thumb"], p["geoSource"]) == (8, "http://z/8", 900, 0, -19.0, 2, "R", "d", "listing_page")


def test_rectangles(spark):
    text = "-43.820222649902334,-19.770017419143223|-44.05711535009765,-20.067946236292432"
    df = spark.createDataFrame([(text,), ("1,2,3",), ("1,2|x,4",)], "t string").coalesce(1).select(spatial.parse_rectangle(F.col("t")).alias("r"))
    got = [r["r"] for r in df.collect()]
    assert got[0]["min_y"] == -20.067946236292432 and got[1:] == [None, None]
    assert df.select(spatial.render_rectangle(F.col("r"))).first()[0] == text
    box = spark.createDataFrame([(10.0, 10.0, 0.0, 0.0)], ", ".join(f"{b} double" for b in spatial.BOUNDS))
    for n, shape in ((4, (2, 2)), (3, (1, 3)), (6, (2, 3)), (1, (1, 1))):
        assert tuple(spatial.grid_shape(box, F.lit(n)).select("nx", "ny").first()) == shape
    assert spatial.split_grid(box, F.lit(2.5)).count() == 3
    for n in (0.5, None):
        assert spatial.split_grid(box, F.lit(n).cast("double")).count() == 0 and spatial.unsplittable(box, F.lit(n).cast("double")).first()["code"] == "fewer_than_one_cell"
    assert spatial.unsplittable(box, F.lit(1.0)).count() == 0


def test_adaptive_cells(spark):
    points = spark.range(5000).select((F.col("id") % 71).cast("double").alias("x"), (F.col("id") % 53).cast("double").alias("y")).unionByName(spark.range(300).select(F.lit(7.0).alias("x"), F.lit(7.0).alias("y")))
    cells = spatial.adaptive_cells(points, 100).collect()
    assert sum(c["n"] for c in cells) == 5300
    assert all(c["n"] <= 100 or c["depth"] == spatial.MAX_DEPTH or (c["min_x"] <= 7 <= c["max_x"]) for c in cells)
    assert len({c["cell"] for c in cells}) == len(cells)
    empty = spatial.adaptive_cells(spark.createDataFrame([], "x double, y double"), 10)
    assert empty.count() == 0
    plan = spatial.page_plan(spark.createDataFrame([(0,), (61,), (9999,)], "n int"), 30).groupBy("n").agg(F.max("page").alias("p"), F.max("offset").alias("o")).collect()
    assert {r["n"]: (r["p"], r["o"]) for r in plan} == {0: (1, 0), 61: (3, 60), 9999: (50, 1470)}


NEXT = {"props": {"pageProps": {"other": {"address": {"street": "Rua Y", "streetNumber": "9", "point": {"lat": -19.5, "lon": -43.5}}, "prices": {"rent": 700}, "amenities": ["A"]}}}}
PAGE = """<html><head><title>T &amp; U</title><script>var x = "{\\"baseData\\":{\\"pageData\\":{\\"listingId\\":\\"77\\",\\"createdAt\\":\\"2026-01-02T23:00:00-03:00\\",\\"listing\\":{\\"address\\":{\\"street\\":\\"Rua X\\",\\"locationId\\":\\"L\\",\\"point\\":{\\"lat\\":-19.0,\\"lon\\":-43.0}},\\"prices\\":{\\"rent\\":1200},\\"amenities\\":{\\"values\\":[\\"POOL\\"]},\\"imageList\\":[{\\"dangerousSrc\\":\\"i\\"}]}}}}";</script>
<script type="application/ld+json">{"price": 1500}</script><style>p{}</style></head><body><h1>Casa</h1><a href="/x">x</a><p data-testid="location-address">Rua X, 5 - Centro</p>
<div><span class="value-item__tooltip-wrapper">Condomínio</span><b class="value-item__value">R$ 350</b></div><span itemprop="floorSize">80 m²</span><p>2 banheiros e 1 vaga. IPTU R$ 99</p><p>Publicado há 2 meses</p>
<script id="__NEXT_DATA__" type="application/json">%s</script></body></html>""" % json.dumps(NEXT)


def test_pages(spark):
    df = spark.createDataFrame([(1, "http://p", PAGE), (2, "http://q", None), (3, None, "<p>unclosed <b>text"), (4, "u", "")], "page_id long, url string, html string")
    e = {r["page_id"]: r for r in extract.element_fields(df).collect()}
    assert (e[1]["title"], e[1]["heading"], e[1]["links"], e[1]["address"], e[1]["area"], e[1]["fee_tooltip"], e[1]["ld_price"]) == ("T & U", "Casa", 1, "Rua X, 5 - Centro", "80 m²", "R$ 350", "1500")
    assert json.loads(e[1]["best_listing"])["prices"]["rent"] == 700 and (e[1]["json_lat"], e[1]["json_lon"]) == (-19.5, -43.5)
    assert e[2]["links"] == 0 and e[3]["title"] is None
    p = {r["page_id"]: r for r in extract.property_data(df).collect()}
    assert (p[1]["area"], p[1]["banheiros"], p[1]["vagas"], p[1]["aluguel"], p[1]["condominio"], p[1]["iptu"]) == (80, 2, 1, 1500, 350, 99)
    d = {r["page_id"]: r for r in extract.detail_records(df, F.lit("2026-06-01")).collect()}
    assert (d[1]["id"], d[1]["aluguel"], d[1]["lat"], d[1]["enderecoRua"], d[1]["enderecoNumero"], d[1]["amenidades"], d[1]["thumb"], d[1]["locationId"]) == (77, 1200, -19.0, "Rua X", "9", ["Piscina"], "i", None)
    assert d[1]["publicadoHa"] == dt.date(2026, 1, 3) and d[3]["lat"] == 0.0
    m = extract.monthly_prices(extract.element_fields(df, ("html",))).where("page_id = 1").first()
    assert (m["rent"], m["tax"]) == (700, 99)


def test_page_text_fields(spark):
    html = 'x "listing":{"street":"Rua \\u00e9","address":{"point":{"lat":-19.1,"lon":-43.1}},"createdAt":"2026-05-01T00:00:00Z"} "approximateLon":-44.0,"approximateLat":-20.0 "iptuPeriod":"YEARLY" "yearlyIptu":"30" Aluguel R$ 1.500 / mês'
    df = spark.createDataFrame([(html,)], "html string")
    h, s = F.col("html"), extract.snippets(F.col("html"))
    r = df.select(extract.quoted_field(extract.listing_chunk(h), "street"), extract.listing_point(h), extract.approximate_point(h), s["tax"], s["published"], extract.price_patterns(h)["rent"], extract.page_point(h, F.lit(None).cast("struct<lat:double,lon:double>"))["source"]).first()
    assert r[0] == "Rua é" and tuple(r[1]) == (-19.1, -43.1) and tuple(r[2]) == (-20.0, -44.0)
    assert tuple(r[3:]) == (2, dt.date(2026, 5, 1), 1500, "rsc_listing_point_lat_lon")
    assert extract.dated_sentence and df.select(extract.dated_sentence(F.lit(None).cast("date"), F.lit("2026-01-02").cast("date"))).first()[0] == "atualizado em 2026-01-02."


def test_list_page(spark):
    page = '<script type="application/ld+json">{"numberOfItems":1,"itemListElement":[{"item":{"@id":"5"}}]}</script><script>self.push("{\\"children\\":[[0,0,0,{\\"content\\":{\\"listings\\":[{\\"id\\":5,\\"lat\\":1}],\\"totalCount\\":3}}]]}")</script>'
    df = spark.createDataFrame([(1, page)], "page_id long, html string")
    assert pages.cards(df).select(F.try_variant_get("raw", "$.@id", "string")).first()[0] == "5"
    assert pages.points(df).select(F.try_variant_get("raw", "$.id", "int")).first()[0] == 5
    assert df.select(envelopes.page_total(extract.embedded_json(F.col("html"), r'\\"totalCount'))).first()[0] == 3


def test_json_lines(spark, tmp_path):
    (tmp_path / "x.json").write_text('{"id":1}\nnot json\n{"id":null}\n5\n{"id":2}\n')
    got = snapshots.json_lines(spark, str(tmp_path)).select("file_name", F.try_variant_get("raw", "$.id", "int").alias("id")).collect()
    assert sorted(map(tuple, got)) == [("x.json", 1), ("x.json", 2)]


def test_one_bad_row_ends_no_job(spark, variants):
    long = "x" * 500_000 + "\\\\" * 250_000
    pages_ = spark.createDataFrame([(f'"listing":{{"street":"{long}","formattedAddress":"{long}"',), ('"listing":{"street":"short',)], "html string").coalesce(1)
    rows = pages_.select(F.length(extract.quoted_field(F.col("html"), "street")), F.length(extract.snippets(F.col("html"))["address"])).collect()
    assert [tuple(r) for r in rows] == [(750_000, 750_000), (0, 0)]
    page = spark.createDataFrame([(1, "u", "<p>Publicado há 999999999999999 anos</p>" + "<script>" + "é😀" * 300_000 + "locationId</script>")], "page_id long, url string, html string")
    assert extract.detail_records(page, F.lit("2026-06-01")).first()["publicadoHa"] is None
    many = "9" * 18
    n = normalize.records(variants({"imovelSan_Id": 1, "banho": many + "9", "suites": many + "9", "quartos": 9223372036854775807, "dce": 9223372036854775807}), normalize.netimoveis).first()
    assert (n["id"], n["banheiros"], n["quartos"]) == (1, 0, 0)
    q = normalize.records(variants({"id": 1, "_source": {"totalCost": -9223372036854775807, "rent": 9223372036854775807}}), normalize.quintoandar).first()
    assert (q["id"], q["condominio"]) == (1, 0)


def test_next_data(spark):
    df = spark.createDataFrame([('<script id="__NEXT_DATA__" type="application/json">{"a":1}</script>',), ("<p>",)], "html string").coalesce(1)
    assert [r[0] for r in df.select(F.try_variant_get(extract.next_data(F.col("html")), "$.a", "int")).collect()] == [1, None]


def test_amenities(variants):
    listing = {"amenities": {"values": ["POOL"]}, "features": ["POOL_TABLE", "Piscina", {"name": "Lareira"}], "lazerItems": ["Sauna"], "other": ["no"]}
    assert variants(listing).select(extract.listing_amenities(F.col("raw"))).first()[0] == ["Piscina", "Pool Table", "Lareira", "Sauna"]


def test_loads(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a", "2026-06-01_00-00", 1), (1, "a", "2026-06-01_00-00", 2)], "id int, site string, stamp string, seq int")
    load.write_snapshot(rows, str(tmp_path / "s"), "id", ["seq"], "parquet")
    assert spark.read.parquet(str(tmp_path / "s")).first()["seq"] == 2
    load.write_snapshot(rows.withColumn("site", F.lit("b")), str(tmp_path / "s"), "id", ["seq"], "parquet")
    assert spark.read.parquet(str(tmp_path / "s")).count() == 2  # the other site's snapshot is still there
    assert load.load_snapshot_table(rows, "snap") == "created" and load.load_snapshot_table(rows, "snap") == "skipped_exists" and load.load_snapshot_table(rows, "snap", True) == "reloaded"
    load.ensure_table(spark, "facts_db.t", "id int", truncate=True)
    assert spark.table("facts_db.t").count() == 0
    load.export_json(rows, str(tmp_path / "j"))
    assert json.loads(spark.read.text(str(tmp_path / "j")).orderBy("value").first()[0]) == {"id": 1, "site": "a", "stamp": "2026-06-01_00-00", "seq": 1}
    load.write_unified(rows, str(tmp_path / "u"))
    assert spark.read.json(str(tmp_path / "u")).count() == 2
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    load.write_jdbc(rows, url, "facts")
    assert spark.read.jdbc(url, "facts").count() == 2
    listed = snapshots.list_files(spark, f"{tmp_path}/u")
    assert {r["file_name"].rsplit(".", 1)[1] for r in listed.collect()} == {"json"}
    assert snapshots.id_keyed(rows, "id", ["seq"]).first()["seq"] == 2
    report = {r["dest"]: r["status"] for r in load.publish(rows, f"{tmp_path}/p1 | nofs://x/y").collect()}
    assert report == {f"{tmp_path}/p1": "ok", "nofs://x/y": "error"}


def test_stream_loads_each_file_once(spark, tmp_path):
    source, facts, state = tmp_path / "in", str(tmp_path / "facts"), str(tmp_path / "state")
    source.mkdir()

    def put(name, rows):
        (source / name).write_text(json.dumps(rows))

    put("2026-06-01_02-25_vivareal.json", {"1": {"id": 1, "aluguel": 5}, "2": {"id": 2}, "x": {"id": 0}})
    put("2026-06-02_00-00_zapimoveis.json", [{"id": 9}])
    put("2026-06-02_00-00_unknown.json", [{"id": 9}])
    put("2026-13-02_00-00_vivareal.json", [{"id": 9}])
    ingest.ingest(spark, str(source), facts, state, files_at_once=2).awaitTermination()
    table = FactTable(spark, facts)
    kept_out = {(r["file_name"], r["code"], r["listing_id"]) for r in table.quarantine().collect()}
    assert kept_out == {("2026-13-02_00-00_vivareal.json", "impossible_stamp", None), ("2026-06-02_00-00_unknown.json", "unknown_site", None), ("2026-06-01_02-25_vivareal.json", "missing_id", "0")}
    assert table.facts().count() == 3
    put("2026-05-01_00-00_vivareal.json", [{"id": 3}])  # comes late, is not the newest
    ingest.ingest(spark, str(source), facts, state).awaitTermination()
    assert table.facts().count() == 4 and load.duplicate_uids(table.facts()).count() == 0
    assert {r["id"] for r in table.newest().collect()} == {r["id"] for r in ingest.newest_facts(table.facts()).collect()} == {1, 2, 9}
    again = table.load(whole(snapshots.read_files(spark, str(source))))  # a second load changes nothing
    assert again["inserted"] == 0 and again["skipped_files"] == 3 and table.facts().count() == 4
