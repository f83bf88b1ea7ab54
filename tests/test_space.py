"""Range joins and adaptive cells against plain loops, map links and page texts against plain rules."""

import random
import re
import time

from pyspark.sql import functions as F

from lotwise.functions import geo
from lotwise.operators import extract, spatial


def test_points_in_rectangles_of_mixed_sizes(spark):
    rng = random.Random(4)
    points = [(k, rng.choice([rng.uniform(-100, 100), float(rng.randint(-4, 4)), 1e6 * rng.random()]), rng.choice([rng.uniform(-100, 100), float(rng.randint(-4, 4))])) for k in range(400)]
    points += [(900, None, 1.0), (901, 0.0, None), (902, 0.0, 0.0), (903, 0.0, 0.0), (904, -1e300, 1e300)]
    boxes = []
    for k in range(120):
        x, y, w, h = rng.uniform(-100, 100), rng.randint(-4, 4), 10 ** rng.uniform(-6, 4), 10 ** rng.uniform(-6, 4)
        boxes.append((k, x + w, y + h, x, float(y)))
    boxes += [(200, 0.0, 0.0, 0.0, 0.0), (201, 1.0, 1.0, 2.0, 2.0), (202, None, 1.0, 0.0, 0.0), (203, 1e301, 1e301, -1e301, -1e301), (204, 4.0, 4.0, -4.0, -4.0), (204, 4.0, 4.0, -4.0, -4.0)]
    p, r = spark.createDataFrame(points, "p int, x double, y double"), spark.createDataFrame(boxes, "r int, max_x double, max_y double, min_x double, min_y double")
    out = spatial.in_rectangles(p, r)
    want = sorted((a, b) for a, x, y in points if None not in (x, y) for b, x1, y1, x0, y0 in boxes if x1 is not None and x0 <= x <= x1 and y0 <= y <= y1)
    assert sorted((row["p"], row["r"]) for row in out.collect()) == want
    plan = out._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert spatial.in_rectangles(p.limit(0), r).count() == spatial.in_rectangles(p, r.limit(0)).count() == 0


def test_adaptive_cells_hold_a_hot_place_once(spark):
    rng = random.Random(5)
    points = [(1.0, 1.0)] * 3000 + [(rng.uniform(0, 8), rng.uniform(0, 8)) for _ in range(500)] + [(None, 1.0), (8.0, 8.0), (0.0, 0.0)]
    cells = spatial.adaptive_cells(spark.createDataFrame(points, "x double, y double"), 100).collect()
    assert sum(c["n"] for c in cells) == 3502 and len({c["cell"] for c in cells}) == len(cells)
    for c in cells:
        inside = sum(1 for x, y in points if x is not None and c["min_x"] <= x <= c["max_x"] and c["min_y"] <= y <= c["max_y"])
        no_wider = c["max_x"] <= c["min_x"] and c["max_y"] <= c["min_y"]  # halved until no number lies between
        assert c["n"] <= inside and (c["n"] <= 100 or c["depth"] == spatial.MAX_DEPTH or no_wider)
    assert sum(c["n"] >= 3000 for c in cells) == 1


def test_map_links_of_any_form(spark):
    link = "www.google.com/maps/embed/v1/place?key=1&"
    pages = {
        f'<iframe src="https://{link}q=A|B">': (None, "A|B", "1"), f'<iframe src="//{link}q=1.5,2.5">': (None, "1.5,2.5", "1"), f'<iframe src="HTTP://{link.upper()}&#38;q=x&amp;center=+1%2C2">': ("1,2", "x", None),
        '<a href="//google.com/maps/embed?x"><a href="//google.com/maps/embed?pb=">': (None, None, None), '<a href="//google.com/maps/embed"><a href="//google.com/maps/embed?q=%zz&q=b">': (None, "%zz", None),
        '<a href="//google.com/maps/embed?q=a%2Bb+c%252Bd#center=1">': (None, "a+b c+d", None), "//example.com/maps/embed?q=1": (None, None, None), "": (None, None, None),
    }
    df = spark.createDataFrame([(h,) for h in pages], "html string").select("html", geo.map_link_params(F.col("html")).alias("p"))
    for r in df.collect():
        assert (r["p"]["center"], r["p"]["q"], r["p"]["key"]) == pages[r["html"]], r["html"]
    assert spark.createDataFrame([(None,)], "html string").select(geo.map_link_params(F.col("html"))["q"]).first()[0] is None


def plain(html):
    for pattern in (r"<script[^>]*>.*?</script>", r"<style[^>]*>.*?</style>", r"<[^>]+>"):
        html = re.sub(pattern, " ", html, flags=re.I | re.S)
    return re.sub(r"[ \t\n\r\f\v]+", " ", html).strip(" ")


def test_plain_text_is_linear_and_the_same(spark):
    rng = random.Random(6)
    parts = ["<script>", "<script", "<SCRIPT a='<b'>", "</script>", "</Script>", "<style>", "<style", "</style>", "<", ">", "<>", "<p>", "x", " ", "\n", "é", "</script", "script>", "<scripting>"]
    pages = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    df = spark.createDataFrame([(p,) for p in pages], "html string").select("html", extract.plain_text(F.col("html")).alias("text"))
    assert all(r["text"] == plain(r["html"]) for r in df.collect())
    for unit in ("<script>", "<script", "<style><script>", "<", "</script>"):
        page = spark.createDataFrame([(unit * (1_000_000 // len(unit)),)], "html string")
        began = time.time()
        page.select(F.length(extract.plain_text(F.col("html")))).collect()
        assert time.time() - began < 10, unit


def test_points_are_looked_up_only_where_needed(spark):
    def page(q):
        return f'<iframe src="//google.com/maps/embed?q={q}">"approximateLat":7,"approximateLon":8'

    html = [page("Rua A"), page("Rua A"), page("1,2"), page("ab"), page("Rua B"), page("Rua C, Brasil"), "", None]
    pages = spark.createDataFrame([(k, "", h) for k, h in enumerate(html)], "page_id long, url string, html string")
    lookup = spark.createDataFrame([("Rua A, Brazil", 5.0, 6.0), ("Rua A, Brazil", 5.0, 7.0), ("Rua B, Brazil", 95.0, 6.0), ("Rua C, Brasil", 3.0, 4.0), (None, 1.0, 1.0)], "address string, lat double, lon double")
    found = {r["page_id"]: (r["lat"], r["lon"], r["source"]) for r in extract.resolved_points(pages, lookup).collect()}
    near, looked = (7.0, 8.0, "rsc_approximateLatLon"), "maps_embed_q_geocoded_nominatim"
    assert found == {0: (5.0, 6.0, looked), 1: (5.0, 6.0, looked), 2: (1.0, 2.0, "maps_embed_q"), 3: near, 4: near, 5: (3.0, 4.0, looked), 6: (None, None, None), 7: (None, None, None)}
