"""Fields of raw listing pages: patterns as column expressions, and one pass over each page's elements."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Collection, Iterator
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import arrays, dates, geo, numbers, texts
from ..functions.once import bound, unless
from .filters import price_of, rental_row, text_at
from .tables import written

MAX_TEXT = 2_000_000
#: A length that takes the rest of any text.
REST = 2**31 - 1
NUMBER = r"(-?\d+\.?\d*)"
# Patterns of the JSON and the texts of pages. QUOTED is possessive, so a long text takes no stack.
QUOTED = r'"([^"\\]*+(?:\\.[^"\\]*+)*+)"'
LISTING = r'"listing"\s*:\s*\{'
YEARLY = r'"iptuPeriod"\s*:\s*"YEARLY"'
YEARLY_TAX = r'"yearlyIptu"\s*:\s*"(\d+)"'
TOTAL = r'"monthlyRentalTotalPrice"\s*:\s*"(\d+)"'
TOTAL_AND_PRICE = r'"monthlyRentalTotalPrice"\s*:\s*"\d+"\}\s*,\s*"yearlyIptu"\s*:\s*"\d+"\s*,\s*"price"\s*:\s*"(\d+)"'
RENT = r'"prices"\s*:\s*\{[^}]*?"rent"\s*:\s*(\d+)'
FEE = r'"monthlyCondoFee"\s*:\s*"(\d+)"'
AMENITY_VALUES = r'(?s)"amenities"\s*:\s*\{[^}]{0,4000}?"values"\s*:\s*\[([^\]]*)\]'
AMENITY_CODE = r'"([A-Z][A-Z0-9_]*)"'
PRICE_TEXTS = {
    "rent": r"(?isu)Aluguel\s+R\$\s*([\d.]+)\s*/\s*mês",
    "fee": r"(?isu)Condomínio\s+R\$\s*([\d.]+)\s*/\s*mês",
    "tax": r"(?isu)IPTU\s+R\$\s*([\d.]+)",
    "total": r"(?isu)Valor total previsto\s+R\$\s*([\d.]+)",
}
# Widths of the texts looked at after the listing's start.
LISTING_TEXT, DATES_TEXT, PRICES_TEXT = 200_000, 65_000, 35_000
VARIANTS = "array<variant>"


def found(text: Column, pattern: str, group: int = 1) -> Column:
    """A pattern's group, or null without a match."""
    return unless(F.regexp_extract(text, pattern, group), "")


def found_int(text: Column, pattern: str) -> Column:
    return found(text, pattern).try_cast("bigint")


def without_element(html: Column, name: str) -> Column:
    """Text with every <name ...> ... </name> replaced by a space, in time proportional to its length.

    A start is closed only if a > and then a closing tag follow, so those behind the last such > cannot be and are left out of
    the search; every other one is. What lies between that > and the last closing tag goes with an element open there.
    """
    close = f"</{name}>"

    def replaced(t: Column) -> Column:
        h, end, head = t["html"], t["end"], t["head"]
        search = F.regexp_replace(F.concat(F.substring(h, F.lit(1), head), F.lit(close)), rf"(?is)<{name}[^>]*>.*?</{name}>", " ")
        between = F.substring(h, head + 1, end - head)
        whole = bound(search, lambda r: F.when(r.endswith(close), F.concat(F.left(r, F.length(r) - len(close)), between)).otherwise(r))
        return F.when(end == 0, h).otherwise(F.concat(whole, F.substring(h, end + 1, F.lit(REST))))

    end, head = F.length(F.regexp_extract(html, rf"(?is)^.*</{name}>", 0)), F.length(F.regexp_extract(html, rf"(?is)^(.*>)[^>]*</{name}>", 1))
    return bound(F.struct(html.alias("html"), end.alias("end"), head.alias("head")), replaced)


def plain_text(html: Column, limit: int | None = None) -> Column:
    """Text of a page: scripts, styles and tags out, spaces squeezed. A limit (MAX_TEXT is the usual one) bounds the characters read."""

    def untagged(t: Column) -> Column:  # a tag ends at a >, so nothing behind the last one is searched
        return bound(F.regexp_extract(t, r"(?s)^.*>", 0), lambda h: F.concat(F.regexp_replace(h, r"<[^>]+>", " "), F.substring(t, F.length(h) + 1, F.lit(REST))))

    scripts = bound(F.left(html, F.lit(limit)) if limit else html, lambda t: without_element(t, "script"))
    text = bound(bound(scripts, lambda t: without_element(t, "style")), untagged)
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def embedded_json(html: Column, marker: str) -> Column:
    """JSON object inside the string literal of the script that holds a marker."""
    script = found(html, r"(?is)<script[^>]*>((?:(?!</script>).)*?" + marker + r"(?:(?!</script>).)*)</script>")
    literal = found(script, r'(?s)"(.*)"')
    return F.try_parse_json(found(texts.decode_fragment(literal), r"(?s)(\{.*\})"))


def next_data(html: Column) -> Column:
    return F.try_parse_json(found(html, r'(?is)<script[^>]*id="__NEXT_DATA__"[^>]*>(.*?)</script>'))


def text_from(text: Column, pattern: str, size: int) -> Column:
    """So many characters from a pattern's start on, or null without a match."""
    return F.substring(text, unless(F.regexp_instr(text, F.lit(pattern)), 0), F.lit(size))


def listing_chunk(html: Column, size: int = LISTING_TEXT) -> Column:
    """Text from the listing's start on, or an empty one."""
    return F.coalesce(text_from(html, LISTING, size), F.lit(""))


def quoted_field(chunk: Column, name: str) -> Column:
    """A JSON text field of a chunk, decoded; empty without it."""
    return F.trim(texts.decode_fragment(found(chunk, f'"{re.escape(name)}"\\s*:\\s*{QUOTED}')))


def approximate_point(html: Column) -> Column:
    """approximateLat and approximateLon in either order."""
    lat, lon = f'"approximateLat"\\s*:\\s*{NUMBER}', f'"approximateLon"\\s*:\\s*{NUMBER}'
    one, two = f"{lat}\\s*,\\s*{lon}", f"{lon}\\s*,\\s*{lat}"

    def point(text: Column, pattern: str, lat_group: int) -> Column:
        return geo.point(found(text, pattern, lat_group).try_cast("double"), found(text, pattern, 3 - lat_group).try_cast("double"))

    other = bound(F.regexp_extract(html, two, 0), lambda t: point(t, two, 2))
    return bound(found(html, one, 0), lambda t: F.when(t.isNotNull(), point(t, one, 1)).otherwise(other))


def listing_point(html: Column) -> Column:
    """Point of the listing's address: the text is narrowed step by step, so no pattern can run away."""
    address = bound(text_from(html, LISTING, 60_000), lambda chunk: text_from(chunk, r'"address"\s*:\s*\{', 20_000))
    pattern = f'"point"\\s*:\\s*\\{{\\s*"lat"\\s*:\\s*{NUMBER}\\s*,\\s*"lon"\\s*:\\s*{NUMBER}'
    return bound(F.regexp_extract(address, pattern, 0), lambda t: geo.point(found(t, pattern).try_cast("double"), found(t, pattern, 2).try_cast("double")))


def page_points(html: Column, params: Column, json_point: Column) -> list[tuple[Column, str]]:
    """The points a page may give with their source labels, first choice first, without those that have to be looked up; params of its map link."""
    return [
        (geo.point_of_text(params["center"]), "maps_embed_center"), (geo.point_of_text(params["q"]), "maps_embed_q"),
        (listing_point(html), "rsc_listing_point_lat_lon"), (approximate_point(html), "rsc_approximateLatLon"), (json_point, "__NEXT_DATA__"),
    ]


def first_point(tries: list[tuple[Column, Column | str]]) -> Column:
    """struct(lat, lon, source) of the first point that is there; later ones are worked out only without one."""

    def labelled(point: Column, source: Column) -> Column:
        return bound(point, lambda p: F.when(p.isNotNull(), F.struct(p["lat"].alias("lat"), p["lon"].alias("lon"), source.alias("source"))))

    return F.coalesce(*(labelled(p, F.lit(s) if isinstance(s, str) else s) for p, s in tries))


def page_point(html: Column, json_point: Column, skip_maps: bool = False) -> Column:
    """struct(lat, lon, source): the map link's center, then its q, the listing's point, the approximate one, any in the JSON."""
    if skip_maps:
        return first_point(page_points(html, F.lit(None).cast("struct<center:string,q:string>"), json_point)[2:])
    return bound(geo.map_link_params(html), lambda params: first_point(page_points(html, params, json_point)))


def resolved_points(pages: DataFrame, lookup: DataFrame) -> DataFrame:
    """page_id, lat, lon, source of every page, as page_point, with addresses of map links looked up after the link's own points.

    lookup (address, lat, lon) holds addresses as geocoding_text writes them. Only texts of pages whose link gives no point are
    looked up, each once; those pages alone are joined with what was found, all others stay where they are.
    """
    found = element_fields(pages, ("html",), ("json_lat", "json_lon")).withColumn("params", geo.map_link_params(F.col("html")))
    tries = page_points(F.col("html"), F.col("params"), geo.point(F.col("json_lat"), F.col("json_lon")))
    link, later = first_point(tries[:2]), tries[2:]
    label = F.when(F.col("params.key").isNotNull(), "maps_embed_q_geocoded_google").otherwise("maps_embed_q_geocoded_nominatim")
    found = found.select("page_id", link.alias("link"), first_point(later).alias("later"), F.when(link.isNull(), geo.geocoding_text(F.col("params.q"))).alias("address"), label.alias("label"))
    found = written(found, "page-points")
    asked = found.where("address IS NOT NULL")
    known = lookup.select("address", geo.point(F.col("lat"), F.col("lon")).alias("place")).where("place IS NOT NULL")
    known = known.join(asked.select("address").distinct(), "address").groupBy("address").agg(F.min("place").alias("place"))
    point = F.coalesce("link", first_point([(F.col("place"), F.col("label"))]), "later")
    none = F.lit(None).cast("struct<lat:double,lon:double>").alias("place")
    rows = asked.join(known, "address", "left").select("page_id", "link", "later", "label", "place").unionByName(found.where("address IS NULL").select("page_id", "link", "later", "label", none))
    return rows.select("page_id", point.alias("point")).select("page_id", "point.lat", "point.lon", "point.source")


def snippets(html: Column) -> dict[str, Column]:
    """Fields that stand as JSON fragments anywhere in a page."""
    yearly = F.when(html.rlike(YEARLY), found_int(html, YEARLY_TAX))
    rent = F.coalesce(found_int(html, TOTAL_AND_PRICE), found_int(listing_chunk(html, PRICES_TEXT), RENT))
    codes = F.regexp_extract_all(F.coalesce(found(html, AMENITY_VALUES), F.lit("")), F.lit(AMENITY_CODE), F.lit(1))

    def day(name: str) -> Column:
        pattern = f'"{name}"\\s*:\\s*"([^"]+)"'
        return F.coalesce(dates.iso_to_utc_date(found(listing_chunk(html, DATES_TEXT), pattern)), dates.iso_to_utc_date(found(html, pattern)))

    return {
        "address": F.trim(texts.decode_fragment(found(html, f'"formattedAddress"\\s*:\\s*{QUOTED}'))), "total": found_int(html, TOTAL),
        "tax": numbers.monthly_rounded(yearly), "fee": found_int(html, FEE), "rent": rent,
        "amenities": arrays.amenity_labels(codes), "published": day("createdAt"), "updated": day("updatedAt"),
    }


def price_patterns(html: Column) -> dict[str, Column]:
    """Prices as the page's text names them."""
    return {k: numbers.parse_first_int(found(html, p)) for k, p in PRICE_TEXTS.items()}


def dated_sentence(published: Column, updated: Column) -> Column:
    """'publicado em D, atualizado em D.' of the days that are there."""
    parts = F.concat_ws(", ", F.concat(F.lit("publicado em "), published.cast("string")), F.concat(F.lit("atualizado em "), updated.cast("string")))
    return F.concat(unless(parts, ""), F.lit("."))


# The pass over a page's elements. It needs nesting, so it is the library's one Python step.

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
PASS_FIELDS = [
    "title", "heading", "links", "address", "area", "bathrooms", "parking", "fee_text", "tax_text", "fee_tooltip", "tax_tooltip",
    "ld_price", "price_section", "published_phrase", "best_listing", "json_lat", "json_lon",
]
JSON_FIELDS = {"best_listing", "json_lat", "json_lon"}
PRICE_FIELDS = ["fee_text", "tax_text", "best_listing"]
PROPERTY_FIELDS = ["area", "bathrooms", "parking", "fee_text", "tax_text", "fee_tooltip", "tax_tooltip", "ld_price", "price_section"]
# Attributes and tags in the plain forms that leave no doubt; all others are left to HTMLParser.
BLANK, NAME, VALUE, TAG = r"[ \t\n\r\f]", r"[a-zA-Z_:@][-a-zA-Z0-9_:.@]*+", r""""[^"]*+"|'[^']*+'|[^\s"'<>=`]++""", r"[a-zA-Z][-a-zA-Z0-9:]*+"
ATTRIBUTES = f"(?:{BLANK}+{NAME}(?:=(?:{VALUE}))?+)*+{BLANK}*+"
#: A text and what follows it: an end tag, a script or style with its body, a start tag, a comment or a document type.
PIECE = re.compile(
    rf"([^<]*+)<(?:/({TAG})>|((script|style){ATTRIBUTES}>)([^<]*+(?:<(?!/\s*+(?i:script|style))[^<]*+)*+)</\4>"
    rf"|((?!(?i:script|style)[\s/>]){TAG}{ATTRIBUTES}/?>)|!(?:--[^<>-]*+--|(?i:doctype) [a-zA-Z]++)>)"
)
ATTRIBUTE_OF, TAG_OF = re.compile(f"{BLANK}+({NAME})(?:=({VALUE}))?+"), re.compile(TAG)
#: Start tags a worker keeps, and the longest of them; they bound its memory.
KEPT_TAGS, KEPT_TAG = 10_000, 500


class Node:
    __slots__ = ("tag", "attrs", "parent", "children")

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None):
        self.tag, self.attrs, self.parent, self.children = tag, attrs, parent, []

    def text(self) -> str:
        """Texts below, each trimmed, joined by spaces; scripts and styles left out."""
        if len(self.children) == 1 and isinstance(self.children[0], str):
            return " ".join(self.children[0].split())
        parts, stack = [], [self]
        while stack:
            x = stack.pop()
            if isinstance(x, str):
                if x.strip():
                    parts.append(" ".join(x.split()))
            elif x is self or x.tag not in ("script", "style"):
                stack.extend(reversed(x.children))
        return " ".join(parts)


class Tree(HTMLParser):
    """Elements of a page in document order."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.now = Node("", {}, None)
        self.nodes: list[Node] = []

    def updatepos(self, i, j):  # lines are counted for messages only
        return j

    def handle_starttag(self, tag, attrs):
        node = Node(tag, {k: v or "" for k, v in attrs}, self.now)
        self.now.children.append(node)
        self.nodes.append(node)
        if tag not in VOID:
            self.now = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        node = self.now
        while node.parent and node.tag != tag:
            node = node.parent
        if node.parent:  # an end tag without its start is passed over
            self.now = node.parent

    def handle_data(self, data):
        self.now.children.append(data)


def parsed(html: str) -> list[Node]:
    """Elements of a page as HTMLParser finds them."""
    tree = Tree()
    tree.feed(html)
    tree.close()
    return tree.nodes


def start_tag(source: str, kept: dict[str, tuple]) -> tuple[str, dict[str, str], bool] | None:
    """Name, attributes and whether it holds what follows, of a plain start tag without its <; kept holds tags met before."""
    if made := kept.get(source):
        return made
    if "&" in source:
        nodes = parsed(f"<{source}")
        if len(nodes) != 1 or nodes[0].children:
            return None
        tag, attrs = nodes[0].tag, nodes[0].attrs
    else:
        tag, attrs = TAG_OF.match(source)[0], {}
        for name, value in ATTRIBUTE_OF.findall(source, len(tag)):
            attrs[name.lower()] = value[1:-1] if value[:1] in ("'", '"') else value
        tag = tag.lower()
    made = tag, attrs, tag not in VOID and not (source.endswith("/>") and self_closing(source))
    if len(source) <= KEPT_TAG:
        if len(kept) >= KEPT_TAGS:
            kept.clear()
        kept[source] = made
    return made


def self_closing(source: str) -> bool:
    """Whether a plain start tag's last slash is not the end of a value without quotes."""
    last = None
    for last in ATTRIBUTE_OF.finditer(source):
        pass
    return last is None or last.end() < len(source) - 1


def plain_elements(html: str, kept: dict[str, tuple]) -> list[Node] | None:
    """Elements of a page in document order, the same as parsed() gives in a fraction of its time; None if the page has other than plain forms."""
    nodes, now, at, match = [], Node("", {}, None), 0, PIECE.match
    while m := match(html, at):
        at = m.end()
        text, end, raw, _, body, start = m.groups()
        if text:
            now.children.append(unescape(text) if "&" in text else text)
        if end:
            end, node = end.lower(), now
            while node.parent and node.tag != end:
                node = node.parent
            now = node.parent or now
        elif source := start or raw:
            made = start_tag(source, kept)
            if made is None:
                return None
            node = Node(made[0], made[1], now)
            now.children.append(node)
            nodes.append(node)
            if raw:
                if body:
                    node.children.append(body)
            elif made[2]:
                now = node
    if html.find("<", at) >= 0:
        return None
    if at < len(html):
        now.children.append(unescape(html[at:]))
    return nodes


def walk_json(value: object, limit: int) -> Iterator[dict]:
    """All objects of a JSON value down to a depth, outer ones first, in order."""
    stack = [(value, 0)]
    while stack:
        x, depth = stack.pop()
        if depth > limit:
            continue
        if isinstance(x, dict):
            yield x
            x = list(x.values())
        if isinstance(x, list):
            stack.extend((y, depth + 1) for y in reversed(x) if isinstance(y, (dict, list)))


def is_listing(x: dict) -> bool:
    address, prices = x.get("address"), x.get("prices")
    priced = x.get("pricingInfos") or (isinstance(prices, dict) and not (prices.get("rent") is None and prices.get("mainValue") is None))
    return isinstance(address, dict) and bool(address.get("street")) and bool(priced)


COMPACT, WRITTEN = json.JSONEncoder(ensure_ascii=False, separators=(",", ":")), json.JSONEncoder(ensure_ascii=False)


def weight(x: dict) -> int:
    """Length of the object's compact JSON, and 50 for each amenity up to 500."""
    listed = x.get("amenities") or x.get("features") or x.get("conveniences") or []
    values = listed.get("values") if isinstance(listed, dict) else listed
    return len(COMPACT.encode(x)) + min(500, 50 * len(values) if isinstance(values, list) else 0)


def best_listing(data: object) -> dict | None:
    """The page's own listing if it has a street, else the weightiest object that looks like one."""
    own = data
    for key in ("props", "pageProps", "listing"):
        own = own.get(key) if isinstance(own, dict) else None
    if isinstance(own, dict) and isinstance(own.get("address"), dict) and own["address"].get("street"):
        return own
    return max(filter(is_listing, walk_json(data, 42)), key=weight, default=None)


def any_point(data: object) -> tuple[float, float] | None:
    """The first valid pair of coordinates of any object."""
    for x in walk_json(data, 30):
        lat, lon = x.get("lat") or x.get("approximateLat"), x.get("lon") or x.get("approximateLon")
        if all(isinstance(v, (int, float)) and not isinstance(v, bool) for v in (lat, lon)) and abs(lat) <= 90 and abs(lon) <= 180:
            return float(lat), float(lon)
    return None


def tooltip_price(tooltips: list[Node], label: str, any_case: bool) -> str | None:
    """Value text beside the first tooltip with a label whose value reads as a price."""
    for node in tooltips:
        title = node.text()
        if label not in (title.lower() if any_case else title) or node.parent is None:
            continue
        stack = [node.parent]
        while stack:
            x = stack.pop()
            if "value-item__value" in x.attrs.get("class", "").split():
                text = x.text()
                if re.fullmatch("(?i)isento", text.strip()) or re.search(r"\d", text):
                    return text
                break
            stack.extend(c for c in reversed(x.children) if isinstance(c, Node))
    return None


def json_fields(nodes: list[Node]) -> dict:
    """The fields of the page's JSON element; a page without one has none."""
    data = next((n for n in nodes if n.attrs.get("id") == "__NEXT_DATA__"), None)
    if data is None:
        return {}
    try:
        read = json.loads(data.text())
    except ValueError:
        read = None
    listing, point = best_listing(read), any_point(read) or (None, None)
    return {"best_listing": WRITTEN.encode(listing) if listing else None, "json_lat": point[0], "json_lon": point[1]}


def element_texts(nodes: list[Node]) -> dict:
    """The fields of a page's elements."""
    tags: dict[str, Node] = {}
    marked: dict[tuple[str, str], Node] = {}
    links, other, phrase, tooltips, priced = 0, None, None, [], []
    for n in nodes:
        tags.setdefault(n.tag, n)
        if n.attrs:
            for pair in n.attrs.items():
                marked.setdefault(pair, n)
            links += n.tag == "a" and "href" in n.attrs
            cy = n.attrs.get("data-cy")
            if cy and other is None and "Address" in cy and "property" in cy:
                other = n
            if "value-item__tooltip-wrapper" in n.attrs.get("class", "").split():
                tooltips.append(n)
            if n.tag == "script" and n.attrs.get("type") == "application/ld+json":
                priced.append(n)
        if phrase is None and any(isinstance(c, str) and "publicado" in c.lower() for c in n.children):
            phrase = n

    def text_of(node: Node | None) -> str | None:
        return node.text() if node else None

    def by(name: str, value: str) -> Node | None:
        return marked.get((name, value))

    out = {"title": text_of(tags.get("title")), "heading": text_of(tags.get("h1")), "links": links}
    for node in (by("data-testid", "location-address"), by("data-cy", "ldp-overview-address"), by("data-cy", "property-address"), other):
        t = text_of(node)
        if t and len(t) > 12 and ("," in t or "-" in t):
            out["address"] = t
            break
    out["area"], out["bathrooms"], out["parking"] = (text_of(by("itemprop", p)) for p in ("floorSize", "numberOfBathroomsTotal", "numberOfParkingSpaces"))
    out["fee_text"], out["tax_text"] = text_of(by("data-testid", "condoFee")), text_of(by("data-testid", "iptu"))
    out["fee_tooltip"], out["tax_tooltip"] = tooltip_price(tooltips, "Condomínio", False), tooltip_price(tooltips, "iptu", True)
    ld = (re.search(r'"price"\s*:\s*(\d+)', n.text()) for n in priced)
    out["ld_price"] = next((m[1] for m in ld if m), None)
    out["price_section"] = text_of(by("id", "price-section"))
    out["published_phrase"] = text_of(phrase)
    return out


def pass_over(html: str | None, fields: Collection[str] = PASS_FIELDS, kept: dict[str, tuple] | None = None) -> dict:
    """The element fields of one page, or some of them. A page that is not HTML has none. kept: start tags met before."""
    nodes = plain_elements(html or "", {} if kept is None else kept)
    if nodes is None:
        nodes = parsed(html)
    found = {} if JSON_FIELDS.isdisjoint(fields) else json_fields(nodes)
    if not JSON_FIELDS.issuperset(fields):
        found |= element_texts(nodes)
    return {f: found.get(f) for f in fields}


def element_fields(pages: DataFrame, keep: tuple[str, ...] = (), fields: Collection[str] = PASS_FIELDS) -> DataFrame:
    """page_id and the fields of every page, each parsed once; keep names text columns that go along (no join brings them back)."""
    kinds = {f: ("long", pa.int64()) if f == "links" else ("double", pa.float64()) if f.startswith("json_") else ("string", pa.string()) for f in fields}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[str, tuple] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, 100):
                b = whole.slice(at, 100)
                rows = [pass_over(h, fields, kept) for h in b.column("html").to_pylist()]
                made = [pa.array([r[f] for r in rows], kind) for f, (_, kind) in kinds.items()]
                yield pa.RecordBatch.from_arrays([b.column("page_id"), *made, *(b.column(c) for c in keep)], ["page_id", *kinds, *keep])

    columns = dict.fromkeys(["html", *keep])
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), *(F.col(c).cast("string").alias(c) for c in columns))
    return rows.mapInArrow(run, ", ".join(["page_id long", *(f"{f} {name}" for f, (name, _) in kinds.items()), *(f"{c} string" for c in keep)]))


def property_columns() -> dict[str, Column]:
    """Area, bathrooms, parking, rent, condominium fee and tax of rows with the element fields, html and text."""
    t, html = F.col("text"), F.col("html")

    def counted(field: str, pattern: str) -> Column:
        return F.when(F.col(field).isNotNull(), numbers.parse_int_digits(F.col(field))).otherwise(found_int(t, pattern))

    def priced(tooltip: str, own: str, pattern: str, script: str) -> Column:
        return F.coalesce(numbers.parse_price_text(F.col(tooltip)), numbers.parse_price_text(F.col(own)), numbers.parse_int_digits(found(t, pattern)), found_int(html, script))

    return {
        "area": counted("area", r"(?iu)(\d+)\s*m²"), "banheiros": counted("bathrooms", r"(?iu)(\d+)\s*banheiros?"), "vagas": counted("parking", r"(?iu)(\d+)\s*vagas?"),
        "aluguel": F.coalesce(F.col("ld_price").try_cast("bigint"), numbers.parse_int_digits(found(F.col("price_section"), r"(?iu)Aluguel\s*R\$\s*([\d.,]+)"))),
        "condominio": priced("fee_tooltip", "fee_text", r"(?iu)Condom[ií]nio\s*R\$\s*([\d.,]+)", r'"condoFees"\s*:\s*\[(\d+)\]'),
        "iptu": priced("tax_tooltip", "tax_text", r"(?iu)IPTU\s*R\$\s*([\d.,]+)", r'"iptuPrices"\s*:\s*\[(\d+)\]'),
    }


def property_data(pages: DataFrame) -> DataFrame:
    """page_id and the property columns: a page's elements first, then its text, then its scripts."""
    rows = element_fields(pages, ("html",), PROPERTY_FIELDS).withColumn("text", plain_text(F.col("html")))
    return rows.select("page_id", *(v.alias(k) for k, v in property_columns().items()))


# Fields of a detail page's JSON.


def page_node(data: Column) -> Column:
    """The node that describes the page: pageData, baseData.pageData, or the root if it names a listing."""
    root = F.when(F.try_variant_get(data, "$.listingId", "string").isNotNull(), data)
    return F.coalesce(F.try_variant_get(data, "$.pageData", "variant"), F.try_variant_get(data, "$.baseData.pageData", "variant"), root)


def truthy_text(value: Column, *paths: str) -> Column:
    return F.coalesce(*(unless(F.trim(F.try_variant_get(value, p, "string")), "") for p in paths))


def with_page_parts(rows: DataFrame) -> DataFrame:
    """Adds node, node_listing, node_price and node_address to rows with data: the parts of its JSON that many fields stand in, each looked up once."""
    rows = rows.withColumn("node", page_node(F.col("data")))
    rows = rows.withColumns({"node_listing": F.try_variant_get("node", "$.listing", "variant"), "node_price": rental_row(F.try_variant_get("node", "$.prices", VARIANTS))})
    return rows.withColumn("node_address", F.coalesce(F.try_variant_get("node_listing", "$.address", "variant"), F.try_variant_get("node", "$.address", "variant")))


def page_fields() -> dict[str, Column]:
    """Fields of the page node of rows with_page_parts; a few stand only below baseData.pageData of the whole JSON."""
    page, data, listing, address, price = (F.col(c) for c in ("node", "data", "node_listing", "node_address", "node_price"))
    number = truthy_text(address, "$.streetNumber")
    base = "$.baseData.pageData"

    def whole(value: Column, *paths: str) -> list[Column]:
        return [numbers.to_int(F.try_variant_get(value, p, "string")) for p in paths]

    def tracked(name: str) -> Column:
        return numbers.to_int(F.try_variant_get(page, f"$.listingTrackingData.{name}[0]", "string"))

    codes = F.coalesce(F.try_variant_get(listing, "$.amenities.values", "array<string>"), F.try_variant_get(page, "$.amenities", "array<string>"))
    point = geo.point(geo.number_of(address, "$.point.lat"), geo.number_of(address, "$.point.lon"))
    photos = bound(arrays.image_urls(F.try_variant_get(data, f"{base}.listing.imageList", VARIANTS)), lambda links: F.when(F.size(links) > 0, links))
    return {
        "id": F.coalesce(F.try_variant_get(data, f"{base}.listingId", "string").try_cast("bigint"), F.lit(0).cast("bigint")),
        "aluguel": F.coalesce(*whole(listing, "$.prices.rent", "$.prices.mainValue"), *whole(price, "$.price", "$.rentalInfo.monthlyRentalTotalPrice"), tracked("rentalPrices")),
        "condominio": F.coalesce(*whole(listing, "$.prices.condominium"), *whole(price, "$.monthlyCondoFee"), tracked("condoFees")),
        "iptu": F.coalesce(*whole(listing, "$.prices.iptu"), *whole(price, "$.iptu", "$.yearlyIptu"), tracked("iptuPrices")),
        "area": F.coalesce(tracked("usableAreas"), *whole(listing, "$.amenities.usableAreas[0]")), "banheiros": F.coalesce(tracked("bathrooms"), *whole(listing, "$.amenities.bathrooms[0]")),
        "vagas": F.coalesce(tracked("parkingSpaces"), *whole(listing, "$.amenities.parkingSpaces[0]")), "quartos": tracked("bedrooms"),
        "enderecoRua": truthy_text(address, "$.street"), "enderecoNumero": bound(number, lambda n: F.when(~F.lower(n).contains("undefined"), n)), "bairro": truthy_text(address, "$.neighborhood"),
        "cidade": truthy_text(address, "$.city"), "estado": truthy_text(address, "$.stateAcronym", "$.state"), "endereco": F.coalesce(truthy_text(address, "$.fullAddress"), truthy_text(page, "$.formattedAddress")),
        "locationId": truthy_text(data, f"{base}.address.locationId"), "externalId": truthy_text(data, f"{base}.listing.externalId"), "fotos": photos,
        "amenidades": arrays.amenity_labels(codes), "tipo_imovel": F.trim(F.try_variant_get(data, f"{base}.listingTrackingData.unitTypes[0]", "string")), "point": point,
        "publicadoHa": dates.iso_to_utc_date(truthy_text(page, "$.createdAt")), "atualizadoHa": dates.iso_to_utc_date(truthy_text(page, "$.updatedAt")),
    }


def rental_pricing(listing: Column) -> dict[str, Column]:
    """Price, fee, yearly tax and monthly total of the RENTAL entry, or else of the listing's prices."""
    entry = price_of(F.try_variant_get(listing, "$.pricingInfos", VARIANTS), "RENTAL")

    def field(name: str, *other: str) -> Column:
        fallback = F.coalesce(*(text_at(listing, f"$.prices.{o}") for o in other))
        return F.when(entry.isNotNull(), text_at(entry, f"$.{name}")).otherwise(fallback)

    return {
        "price": field("price", "rent", "mainValue"), "fee": field("monthlyCondoFee", "condominium"), "yearly": field("yearlyIptu", "iptu"),
        "total": F.coalesce(*(F.when(entry.isNotNull(), text_at(entry, f"$.{n}")) for n in ("chargingMonthlyTotal", "monthlyTotal", "totalPrice", "value", "fullRentPrice")), text_at(listing, "$.prices.monthlyRentalTotalPrice")),
        "monthly_tax": numbers.monthly_tax(
            F.coalesce(*(F.try_variant_get(entry, f"$.{n}", "boolean") for n in ("iptuExempt", "iptuIsExempt", "exemptIptu"))), text_at(entry, "$.iptuInformation"),
            text_at(entry, "$.monthlyIptu"), text_at(entry, "$.iptu"), field("yearlyIptu", "iptu"),
        ),
    }


# Keys that list amenities, and parts of names of other keys that do.
AMENITY_KEYS = [
    "amenities", "features", "conveniences", "nonFunctionalAmenities", "propertyAmenities", "comforts", "characteristics", "tags",
    "listingTagFeatures", "highlights", "differentials", "infrastructure", "buildingAmenities", "condominiumFeatures", "leisure", "propertyFeatures",
]
AMENITY_PARTS = ["amenit", "comfort", "feature", "tag", "highlight", "differential", "infra", "lazer", "condomin", "leisure"]


def listing_amenities(listing: Column) -> Column:
    """Distinct amenity labels in order: the code list, the known keys, then keys whose names tell."""
    none = F.array().cast("array<string>")

    def label(item: Column) -> Column:
        t = F.when(F.schema_of_variant(item) == "STRING", F.try_variant_get(item, "$", "string"))
        return F.when((F.upper(t) == t) & t.contains("_"), texts.amenity_label(t)).otherwise(arrays.amenity_item_label(item))

    def labels(items: Column) -> Column:
        return F.coalesce(F.transform(items, label), none)

    codes = F.coalesce(F.transform(F.try_variant_get(listing, "$.amenities.values", "array<string>"), texts.amenity_label), none)
    keys = [labels(F.try_variant_get(listing, f"$.{k}", VARIANTS)) for k in AMENITY_KEYS]
    entries = F.map_entries(F.from_json(F.to_json(listing), "map<string,variant>"))
    other = F.filter(entries, lambda e: ~e["key"].isin(AMENITY_KEYS) & texts.any_contains(F.lower(e["key"]), AMENITY_PARTS))
    rest = F.flatten(F.transform(other, lambda e: labels(F.try_variant_get(e["value"], "$", VARIANTS))))
    return F.array_distinct(F.filter(F.concat(codes, *keys, F.coalesce(rest, none)), lambda x: F.coalesce(x != "", F.lit(False))))


def detail_records(pages: DataFrame, as_of: Column) -> DataFrame:
    """A rich record of every detail page: the page's JSON first, then its elements and texts, field by field."""
    rows = element_fields(pages, ("url", "html"), [*PROPERTY_FIELDS, "published_phrase", *sorted(JSON_FIELDS)]).withColumn("text", plain_text(F.col("html")))
    rows = rows.withColumns({f"d_{k}": v for k, v in property_columns().items()}).drop("text")
    rows = rows.withColumns({"data": embedded_json(F.col("html"), "locationId"), "chunk": listing_chunk(F.col("html")), "best": F.try_parse_json("best_listing")})
    rows = with_page_parts(rows)
    f, html, best, chunk = page_fields(), F.col("html"), F.col("best"), F.col("chunk")
    json_point = geo.point(F.col("json_lat"), F.col("json_lon"))
    point = F.coalesce(first_point([(f["point"], "page_json")]), page_point(html, json_point))

    def text(name: str, *json_names: str) -> Column:
        """A text of the page JSON, the best listing's address, or the listing's text."""
        other = truthy_text(best, *(f"$.address.{n}" for n in json_names))
        return F.coalesce(f[name], other, *(unless(quoted_field(chunk, n), "") for n in json_names))

    def number(name: str) -> Column:
        return F.coalesce(unless(f[name], 0), unless(F.col(f"d_{name}"), 0), F.lit(0).cast("bigint")).try_cast("int")

    updated = F.coalesce(f["atualizadoHa"], dates.relative_date(html, "atualizado", as_of), dates.iso_to_utc_date(text_at(best, "$.updatedAt")), snippets(html)["updated"])
    places = {"street": text("enderecoRua", "street"), "no": text("enderecoNumero", "streetNumber"), "district": text("bairro", "neighborhood"), "city": text("cidade", "city"), "state": text("estado", "stateAcronym", "state")}
    rows = rows.withColumns({"found_point": point, "photos": f["fotos"], **{f"found_{k}": v for k, v in places.items()}})
    point, photos, street, no, district, city, state = (F.col(c) for c in ("found_point", "photos", *(f"found_{k}" for k in places)))
    return rows.select(
        "page_id", f["id"].alias("id"), "url", F.coalesce(F.get(photos, F.lit(0)), F.lit("")).alias("thumb"), *(number(c).alias(c) for c in ("aluguel", "iptu", "condominio", "banheiros", "vagas", "area")),
        F.lit(0).alias("venda"), F.coalesce(f["quartos"], F.lit(0).cast("bigint")).try_cast("int").alias("quartos"), district.alias("bairro"), F.coalesce(f["tipo_imovel"], F.lit("")).alias("tipo_imovel"),
        texts.address_line(street, no, district, city, state).alias("endereco"), F.coalesce(point["lat"], F.lit(0.0)).alias("lat"), F.coalesce(point["lon"], F.lit(0.0)).alias("long"), point["source"].alias("geoSource"),
        f["amenidades"].alias("amenidades"), city.alias("cidade"), state.alias("estado"), street.alias("enderecoRua"), no.alias("enderecoNumero"), photos.alias("fotos"), f["externalId"].alias("externalId"), f["locationId"].alias("locationId"),
        F.coalesce(f["publicadoHa"], dates.relative_date(F.col("published_phrase"), "publicado", as_of)).alias("publicadoHa"), updated.alias("atualizadoHa"), F.lit(True).alias("isAbsoluteLocation"),
    )


def monthly_prices(rows: DataFrame) -> DataFrame:
    """Adds rent, fee, tax and total to rows of html, best_listing, fee_text and tax_text: listing JSON, fragments, elements, texts in turn."""
    html, rental = F.col("html"), rental_pricing(F.try_parse_json("best_listing"))
    s, p, text = snippets(html), price_patterns(html), plain_text(html)
    tax_text = F.lower(F.col("tax_text"))
    told_none = tax_text.contains("isento") | tax_text.rlike("n[aã]o informado")
    said_none = text.rlike(r"(?iu)\bIPTU\b.*?\bIsento\b") | text.rlike(r"(?iu)IPTU\s+n[aã]o\s+informado")
    zero = F.lit(0).cast("bigint")
    tax = (rental["monthly_tax"], s["tax"], F.when(told_none, zero).otherwise(numbers.parse_first_int(F.col("tax_text"))), p["tax"], F.when(said_none, zero))
    return rows.withColumns({
        "rent": F.coalesce(numbers.to_int(rental["price"]), s["rent"], p["rent"]),
        "fee": F.coalesce(numbers.to_int(rental["fee"]), s["fee"], numbers.parse_first_int(F.col("fee_text")), p["fee"]),
        "tax": F.coalesce(*tax),
        "total": F.coalesce(numbers.to_int(rental["total"]), s["total"], p["total"]),
    })
