"""Costs that must not depend on how few files or groups the rows come in."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lotwise.operators import extract, rectangle_sums, spatial
from lotwise.plans import registry, snapshot_queries
from lotwise.sources import bodies

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", ["f70_page_elements", "f71_best_listings", "f72_property_data", "f73_detail_records", "f76_page_texts"])
def test_pages_of_a_small_file_are_worked_on_by_all_tasks(spark, name):
    assert registry.queries()[name](spark, SF).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


@pytest.mark.parametrize(("name", "most"), [("f73_detail_records", 100), ("f76_page_texts", 40)])
def test_patterns_are_searched_once(spark, name, most):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract(") + plan.count("regexp_instr(") <= most


ODD_PAGES = [
    "<p>a<b x=1 y='2' z>c</p>d</b>e", "<a href=/x/>t</a><br/>u<i x='&amp;'>&lt;v</i>", "<div/>a<DIV Class=\"q\">b</div>", "<script>var t='</p>';</script><p>a", "<script>a</SCRIPT>b", "<script src=a/>b</script>c", "<script>open",
    "a < b <p x =1>c", "<b x=\"1\"y=\"2\">d", "<a x=1\xa0y>e</a>", "<!-- a --><!DOCTYPE html><!--a-b-->f", "<p/ >g</p x>h</>", "&am", "<p>a&", "<", "",
]


@pytest.mark.parametrize("html", ODD_PAGES)
def test_plain_elements_are_those_of_the_html_parser(html):
    def shape(nodes):
        at = {id(n): k for k, n in enumerate(nodes)}
        return [(n.tag, n.attrs, at.get(id(n.parent)), [c if isinstance(c, str) else at[id(c)] for c in n.children]) for n in nodes]

    found = extract.plain_elements(html, {})
    assert found is None or shape(found) == shape(extract.parsed(html))


def test_plain_pages_are_split_by_one_pattern(monkeypatch):
    """HTMLParser took most of the time of every page; only pages with other than plain forms need it."""
    html = '<!DOCTYPE html><html><title>T &amp; U</title><script>x("</p>")</script><p data-testid="location-address">Rua Longa, 1 - B</p><script id="__NEXT_DATA__" type=\'a\'>{"lat": 1, "lon": 2}</script>'
    monkeypatch.setattr(extract, "parsed", lambda html: pytest.fail("parsed"))
    made = extract.pass_over(html)
    assert (made["title"], made["address"], made["json_lat"], made["json_lon"], made["links"]) == ("T & U", "Rua Longa, 1 - B", 1.0, 2.0, 0)


@pytest.mark.parametrize(("name", "fields"), [
    ("f70_page_elements", {"title", "heading", "links", "address", "area", "fee_tooltip", "tax_tooltip", "ld_price", "published_phrase"}),
    ("f71_best_listings", {"best_listing", "json_lat", "json_lon"}),
    ("f72_property_data", set(extract.PROPERTY_FIELDS)),
])
def test_pages_are_asked_for_the_fields_of_a_query_alone(spark, name, fields):
    plan = registry.queries()[name](spark, SF)._jdf.queryExecution().analyzed().toString()
    asked = re.search(r"MapInArrow run\(.*?\)#\d+, \[(.*?)\]", plan)[1]
    assert {f.split("#")[0] for f in asked.split(", ")} - {"page_id", "html"} == fields


def test_flat_rectangles_meet_few_points_that_they_do_not_hold(spark):
    """Rectangles of 1,024 by 1 that lie above each other: a cell as high as they are wide would hold all points."""
    r = spark.range(64).selectExpr("id AS r", "0D AS min_x", "1000D AS max_x", "CAST(id * 8 AS DOUBLE) AS min_y", "CAST(id * 8 + 1 AS DOUBLE) AS max_y")
    p = spark.range(5_000).selectExpr("CAST(id % 1000 AS DOUBLE) AS x", "CAST(id % 512 AS DOUBLE) AS y")
    out = spatial.in_rectangles(p, r)
    assert out.count() == sum(k % 512 % 8 < 2 for k in range(5_000))
    met = spatial.in_rectangles(p, r, "x", "y")._jdf.queryExecution().optimizedPlan().toString()
    assert "_ly" in met


def test_equal_points_meet_rectangles_once(spark, tmp_path):
    """A table repeated under other keys has as many different points, so no more rows go to the join."""
    line = spark.read.parquet(f"{SF}/lineitem.parquet")
    spark.read.parquet(f"{SF}/supplier.parquet").write.parquet(f"{tmp_path}/supplier.parquet")
    for _ in range(5):
        line.write.mode("append").parquet(f"{tmp_path}/lineitem.parquet")
    one, five = ({r["s_suppkey"]: r for r in registry.queries()["f85_points_in_rectangles"](spark, d).collect()} for d in (SF, str(tmp_path)))
    assert {k: (5 * r["points"], r["low"], 5 * r["parts"]) for k, r in one.items()} == {k: (r["points"], r["low"], r["parts"]) for k, r in five.items()}
    plan = registry.queries()["f85_points_in_rectangles"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.rindex("Aggregate [l_extendedprice")


@pytest.mark.parametrize("strips", [2, 8, 512])
def test_sums_in_rectangles_agree_with_pairs(spark, monkeypatch, strips):
    rng = random.Random(strips)
    monkeypatch.setattr(rectangle_sums, "WORTH", 1)
    points = [(rng.choice([rng.uniform(-9, 99), float(rng.randint(0, 90)), 7.0]), rng.choice([rng.uniform(0, 9), 3.0, float(rng.randint(0, 9))]), rng.choice([None, rng.randint(-5, 50)])) for _ in range(3_000)]
    points += [(None, 1.0, 1), (1.0, None, 1), (math.nan, 1.0, 1), (math.inf, 3.0, 1), (-math.inf, 3.0, 1), (-0.0, -0.0, 2), (0.0, 0.0, 3), *points[:500]]
    boxes = [(k % 60, x, y, x + rng.choice([0.0, 0.5, 3.0, 20.0, 200.0]), y + rng.choice([0.0, 0.25, 2.0, 30.0])) for k in range(90) for x in [float(rng.randint(-10, 90))] for y in [rng.choice([-1.0, 0.0, 2.5, 3.0, 7.7])]]
    boxes += [(100, 0.0, 0.0, 0.0, 0.0), (101, 5.0, 0.0, 4.0, 9.0), (102, None, 0.0, 4.0, 9.0), (103, 200.0, 0.0, 300.0, 9.0), (None, -9.0, 0.0, 100.0, 9.0), (104, -math.inf, -math.inf, math.inf, math.inf)]
    want = {}
    for key, x0, y0, x1, y1 in boxes:
        for x, y, value in points:
            if None not in (x0, x, y) and x0 <= x <= x1 and y0 <= y <= y1:
                n, low, total = want.get(key, (0, math.inf, None))
                want[key] = n + 1, min(low, x), total if value is None else (total or 0) + value
    p = spark.createDataFrame(points, "x double, y double, value long")
    r = spark.createDataFrame(boxes, "key long, min_x double, min_y double, max_x double, max_y double")
    found = {k: tuple(rest) for k, *rest in rectangle_sums.sums_in_rectangles(p, r, "key", "x", "y", "value", strips).collect()}
    assert found == want
    assert rectangle_sums.sums_in_rectangles(p.limit(0), r, "key", "x", "y", "value", strips).count() == 0


@pytest.mark.parametrize("huge", [False, True])
def test_points_of_a_strip_meet_pieces_by_blocks(huge):
    """Runs of whole blocks, sums that pass 2^63 before they are subtracted, and as many pieces at one place as are compared at once."""
    rng, n = np.random.default_rng(3), 5_000
    u, v, value = rng.integers(0, 900, n) / 2, rng.integers(0, 40, n) * 1.0, rng.integers(0, 99, n)
    value[u == 0] = 2**62 if huge else 5
    points = pa.table({"u": u, "v": v, "low": u - v, "number": np.ones(n, int), "total": value, "known": np.ones(n, int)})
    first_u, first_v = rng.integers(1, 450, 3_000) * 1.0, rng.integers(0, 40, 3_000) * 1.0
    first_u[:2_500] = 7.0
    pieces = pa.table({"key": np.arange(3_000), "first_u": first_u, "last_u": first_u + rng.integers(0, 400, 3_000), "first_v": first_v, "last_v": first_v + rng.integers(0, 9, 3_000)})
    found = {r["key"]: (r["number"], r["low"], r["total"], r["known"]) for r in rectangle_sums.meet(points, pieces).to_pylist()}
    for r in pieces.slice(2_300).to_pylist():
        inside = (u >= r["first_u"]) & (u <= r["last_u"]) & (v >= r["first_v"]) & (v <= r["last_v"])
        assert found.get(r["key"]) == ((inside.sum(), (u - v)[inside].min(), value[inside].sum(), inside.sum()) if inside.any() else None)


def test_points_and_rectangles_are_not_paired(spark):
    """Pairs of different points and rectangles grow with the product of both tables: no join may compare them."""
    plan = registry.queries()["f85_points_in_rectangles"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Join" in line and ("l_extendedprice" in line or "min_x" in line)]


def test_bodies_grow_in_number_and_not_in_length(spark, tmp_path):
    """Twice the orders make twice the files, each whole; a longer file would be sorted and written by one task."""
    keys = spark.read.parquet(f"{SF}/lineitem.parquet").select("l_orderkey").distinct().count()
    snapshot_queries.body_lines(spark, SF, f"{tmp_path}/many", 8)
    snapshot_queries.body_lines(spark, SF, f"{tmp_path}/one")
    many, one = (spark.read.text(f"{tmp_path}/{n}/*/*/*.txt").groupBy(F.input_file_name()).count().collect() for n in ("many", "one"))
    assert len(one) == 3 and len(many) >= 3 * (keys // 256)
    assert max(r["count"] for r in many) < max(r["count"] for r in one) / 3
    pieces = bodies.cut_bodies(spark, f"{tmp_path}/many/*/*/*.txt", 1 << 14, 1 << 10)
    assert {r["code"] for r in pieces.where("path LIKE '%returnflag=R%'").select("code").collect()} == {"cut_off"}
    got = bodies.values(pieces).select(F.try_variant_get("raw", "$.id", "bigint").alias("id")).where("id IS NOT NULL").count()
    assert got == spark.read.parquet(f"{SF}/lineitem.parquet").where("l_returnflag <> 'R'").select("l_returnflag", "l_orderkey").distinct().count()


def test_texts_between_braces_are_no_rows_of_a_table(spark, tmp_path, monkeypatch):
    """Each was shuffled, sorted and written, three for a line item; now a byte range's texts become chunks in the pass that reads them."""
    n, rows, written = 4_000, {}, bodies.written

    def counted(df, name):
        out = written(df, name)
        rows[name] = out.count()
        return out

    (tmp_path / "large.json").write_text("[" + ",".join(f'{{"id":{k},"t":"a \\"}}{{ \\\\","by":{{"id":-1}}}}' for k in range(n)) + "]")
    monkeypatch.setattr(bodies, "written", counted)
    pieces = bodies.cut_bodies(spark, str(tmp_path), 32 << 10, 4 << 10)
    assert 20 < max(rows.values()) < n / 10
    found = bodies.values(pieces).select(F.try_variant_get("raw", "$.id", "bigint").alias("id"), F.try_variant_get("raw", "$.t", "string").alias("t"))
    assert found.agg(F.count("*"), F.sum("id"), F.min("t"), F.max("t")).first()[:] == (n, n * (n - 1) // 2, 'a "}{ \\', 'a "}{ \\')
