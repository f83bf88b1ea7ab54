"""Queries over events as snapshots: site = event type, snapshot = site and day, listing = user, price = value."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import texts
from ..operators import dedupe, load, merge, records
from ..operators.facts import FactTable, whole
from ..operators.tables import fresh_folder
from ..sources import bodies, snapshots
from ..streaming import ingest
from .registry import query, read

SITES = ["view", "click", "purchase", "signup", "error"]
NAMED = """
e AS (SELECT *, event_type AS site, strftime(ts, '%Y-%m-%d') || '_00-00' AS stamp,
             strftime(ts, '%Y-%m-%d') || '_00-00_' || event_type || '.json' AS file_name FROM events)"""


def rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with the file name they would have come in."""
    stamp = F.concat(F.date_format("ts", "yyyy-MM-dd"), F.lit("_00-00"))
    return read(spark, sf_dir, "events").withColumns({"stamp": stamp, "site": F.col("event_type"), "file_name": F.concat(stamp, F.lit("_"), F.col("event_type"), F.lit(".json"))})


@query(f"""WITH {NAMED},
n AS (SELECT site, max(stamp) AS stamp FROM e GROUP BY site),
r AS (SELECT e.site, e.value, row_number() OVER (PARTITION BY e.site, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e JOIN n ON e.site = n.site AND e.stamp = n.stamp)
SELECT site, count(*) AS listings, round(sum(value), 2) AS total FROM r WHERE rn = 1 GROUP BY site""")
def f01_latest_per_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rows(spark, sf_dir)
    newest = snapshots.newest_per_site(e.select("file_name").distinct()).select("file_name")
    current = dedupe.last_wins(e.join(newest, "file_name"), ["site", "user_id"], ["ts", "event_id"])
    return current.groupBy("site").agg(F.count("*").alias("listings"), F.round(F.sum("value"), 2).alias("total"))


@query(f"""WITH {NAMED}
SELECT DISTINCT file_name, stamp, site, CAST(strptime(stamp, '%Y-%m-%d_%H-%M') AS TIMESTAMP) AS snapshot_ts,
       site || '_' || replace(stamp, '-', '_') AS table_name
FROM e WHERE site IN ('view', 'click', 'purchase')""")
def f02_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.loadable(rows(spark, sf_dir).select("file_name").distinct(), ["view", "click", "purchase"]).orderBy("file_name")


@query(f"""WITH {NAMED}
SELECT event_id, user_id || '_' || site || '_' || stamp AS uid, CAST(strptime(stamp, '%Y-%m-%d_%H-%M') AS TIMESTAMP) AS scrapy_date, site || ' ' || user_id AS label FROM e""")
def f04_stamped_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = snapshots.with_names(rows(spark, sf_dir).select("event_id", "user_id", "site", "file_name"))
    return e.select("event_id", records.stamped_uid(F.col("user_id"), F.col("site"), F.col("stamp")).alias("uid"), F.col("snapshot_ts").alias("scrapy_date"), F.concat_ws(" ", "site", "user_id").alias("label"))


@query("""WITH e AS (SELECT user_id % 7 AS id, CASE WHEN event_type = 'error' THEN '' ELSE event_type END AS fonte FROM events)
SELECT CASE WHEN id = 0 THEN 'missing_id' WHEN fonte = '' THEN 'missing_source' ELSE 'valid' END AS code, count(*) AS n FROM e GROUP BY 1""")
def f05_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select((F.col("user_id") % 7).alias("id"), F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("fonte"))
    valid, rest = records.split_valid(e)
    both = valid.select(F.lit("valid").alias("code")).unionByName(rest.select("code"))
    return both.groupBy("code").agg(F.count("*").alias("n"))


@query(f"""WITH {NAMED}, l AS (SELECT DISTINCT stamp, site FROM e WHERE ts < TIMESTAMP '2024-01-16' AND site <> 'view')
SELECT DISTINCT file_name, stamp, site FROM e WHERE NOT EXISTS (SELECT 1 FROM l WHERE l.stamp = e.stamp AND l.site = e.site)""")
def f06_not_loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rows(spark, sf_dir)
    facts = e.where("ts < TIMESTAMP '2024-01-16' AND site <> 'view'").select(F.to_timestamp("stamp", "yyyy-MM-dd_HH-mm").alias("scrapy_date"), F.col("site").alias("source_site"))
    return merge.not_loaded(e.select("file_name", "stamp", "site").distinct(), merge.loaded_keys(facts))


@query(f"""WITH {NAMED}, f AS (SELECT file_name, site, min(ts) AS ts, count(*) AS n FROM e GROUP BY 1, 2),
s AS (SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-10' THEN 'skipped' WHEN site = 'error' THEN 'error' ELSE 'inserted' END AS status FROM f)
SELECT count(*) FILTER (status = 'inserted') AS loaded, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'error') AS errors,
       CAST(coalesce(sum(n) FILTER (status = 'inserted'), 0) AS BIGINT) AS rows FROM s""")
def f07_load_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rows(spark, sf_dir)
    files = e.select("file_name", "stamp", "site").distinct()
    loaded = e.where("ts < TIMESTAMP '2024-01-10'").select("stamp", "site").distinct()
    failed = files.where("site = 'error'").withColumn("error", F.lit("unreadable"))
    return load.report_totals(load.file_report(files, loaded, e, failed))


@query("""WITH r AS (SELECT event_type, user_id, CAST(ts AS DATE) AS day, event_id, value,
  row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts, event_id) AS a,
  row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY ts DESC, event_id DESC) AS z FROM events)
SELECT f.user_id, f.event_type, f.day, f.event_id AS first_event, l.event_id AS last_event FROM r f JOIN r l
ON f.user_id = l.user_id AND f.event_type = l.event_type AND f.day = l.day AND f.a = 1 AND l.z = 1""")
def f08_first_and_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").withColumn("day", F.to_date("ts"))
    return dedupe.first_and_last(e, ["user_id", "event_type", "day"], ["ts", "event_id"], "event_id", "first_event", "last_event")


@query("""WITH f AS (SELECT user_id, min(CAST(ts AS DATE)) AS day FROM events GROUP BY 1),
n AS (SELECT day, count(*) AS new_ids FROM f GROUP BY 1),
p AS (SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events GROUP BY 1),
j AS (SELECT p.day, rows, coalesce(new_ids, 0) AS new_ids FROM p LEFT JOIN n ON p.day = n.day)
SELECT day, rows, new_ids, coalesce(day = (SELECT min(day) FROM j WHERE new_ids = 0), FALSE) AS saturated FROM j""")
def f13_new_ids_per_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    return dedupe.new_per_page(e, "user_id", "day")


@query("""SELECT event_id, CAST(props ->> '$.k' AS BIGINT) AS k, coalesce(props ->> '$.missing', 'absent') AS missing,
 CASE WHEN CAST(props ->> '$.k' AS BIGINT) = 0 THEN -1 ELSE CAST(props ->> '$.k' AS BIGINT) END AS truthy FROM events""")
def f14_json_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events").select("event_id", F.try_parse_json("props").alias("j"))
    k, missing = F.try_variant_get("j", "$.k", "bigint"), F.try_variant_get("j", "$.missing", "variant")
    text = F.when(texts.is_absent_variant(missing), "absent").otherwise(F.try_variant_get("j", "$.missing", "string"))
    return e.select("event_id", k.alias("k"), text.alias("missing"), texts.first_truthy(k, F.lit(-1).cast("bigint"), zero=0).alias("truthy"))


@query(f"""WITH {NAMED}
SELECT DISTINCT file_name, site || '_' || replace(stamp, '-', '_') AS table_name, file_name AS back, '"p"."' || site || '_' || replace(stamp, '-', '_') || '"' AS qualified,
 'old_' || replace(stamp, '-', '_') AS legacy, regexp_replace(regexp_replace(lower(replace(file_name, '-', '_')), '[^a-z0-9_]+', '_', 'g'), '_+', '_', 'g') AS identifier, stamp || ' / ' || site AS label FROM e""")
def f20_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    f, table = F.col("file_name"), texts.table_name(F.col("file_name"))
    return rows(spark, sf_dir).select("file_name", "stamp", "site").distinct().select(
        f, table.alias("table_name"), texts.file_name(table).alias("back"), texts.qualified_table_name(F.concat(F.lit("/data/"), f), "p").alias("qualified"),
        texts.legacy_table_name("old", f).alias("legacy"), texts.sanitize_identifier(f).alias("identifier"), texts.source_label(F.col("stamp"), F.col("site")).alias("label"),
    )


UNIFIED_SQL = """
WITH e AS (SELECT event_type AS site, user_id, ts, event_id, value, CAST(ts AS DATE) AS day, CAST(props ->> '$.k' AS BIGINT) AS k FROM events),
n AS (SELECT site, max(day) AS day FROM e GROUP BY site),
r AS (SELECT e.*, row_number() OVER (PARTITION BY e.site, user_id ORDER BY ts DESC, event_id DESC) AS rn FROM e JOIN n ON e.site = n.site AND e.day = n.day)
SELECT user_id AS id, CASE WHEN k % 10 = 0 THEN 'other' ELSE site END AS fonte, CAST(trunc(value) AS INT) AS aluguel, CAST(k AS DOUBLE) AS lon,
       'http://t/?action=fit-in&dimension=614x297&n=' || user_id AS thumb, list_position(['view', 'click', 'purchase', 'signup', 'error'], site) AS source_rank
FROM r WHERE rn = 1 AND user_id <> 0"""


def raw_listings(e: DataFrame) -> DataFrame:
    """Events as raw listings: site, file_name, seq columns and raw, a JSON object."""
    e = e.withColumn("_props", F.try_parse_json("props"))
    other = F.when(F.try_variant_get("_props", "$.k", "bigint") % 10 == 0, "other")
    body = F.struct(
        F.col("user_id").alias("id"), F.expr("CAST(floor(value) AS INT)").alias("aluguel"), F.try_variant_get("_props", "$.k", "double").alias("long"),
        F.concat(F.lit("http://t/?" + texts.THUMB_TEMPLATE + "&n="), F.col("user_id")).alias("thumb"), other.alias("fonte"),
    )
    return e.select("file_name", "stamp", "site", "ts", "event_id", F.try_parse_json(F.to_json(body)).alias("raw"))


@query(UNIFIED_SQL)
def f31_unified_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = rows(spark, sf_dir)
    newest = snapshots.newest_per_site(e.select("file_name").distinct()).select("file_name")
    unified = records.unified_from_raw(snapshots.listings(raw_listings(e.join(newest, "file_name"))))
    valid, _ = records.split_valid(dedupe.last_wins(unified, ["site", "id"], ["ts", "event_id"]))
    return snapshots.unified(valid, SITES).select("id", "fonte", "aluguel", "lon", "thumb", F.col("source_rank").cast("long").alias("source_rank"))


@query("""WITH e AS (SELECT event_type AS site, strftime(ts, '%Y-%m-%d') || '_00-00' AS stamp, count(DISTINCT user_id) AS listings, count(DISTINCT user_id) AS uids FROM events WHERE user_id <> 0 GROUP BY 1, 2)
SELECT site, CAST(strptime(stamp, '%Y-%m-%d_%H-%M') AS TIMESTAMP) AS scrapy_date, listings, uids FROM e""")
def f32_fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads every snapshot into a fact table, replays a third of them, and counts what is there."""
    e = rows(spark, sf_dir).where("user_id <> 0")
    current = dedupe.last_wins(raw_listings(e).withColumn("id", F.try_variant_get("raw", "$.id", "bigint")), ["file_name", "id"], ["ts", "event_id"]).drop("id")
    stamped = records.stamped_rows(records.unified_from_raw(current))
    path = fresh_folder(spark, "facts")
    load.append_facts(stamped, path)
    load.append_facts(stamped.where(F.dayofmonth("scrapy_date") % 3 == 0), path)
    facts = load.read_facts(spark, path)
    return facts.groupBy(F.col("source_site").alias("site"), F.col("scrapy_date").cast("timestamp_ntz").alias("scrapy_date")).agg(F.count("*").alias("listings"), F.count_distinct("uid").alias("uids"))


@query("""WITH e AS (SELECT event_type AS site, CAST(ts AS DATE) AS day, CAST(trunc(value) AS BIGINT) AS v FROM events WHERE user_id <> 0),
n AS (SELECT site, max(day) AS day, count(*) AS loaded FROM e GROUP BY 1)
SELECT e.site, count(*) AS listings, CAST(sum(v) AS BIGINT) AS total, any_value(loaded) AS loaded FROM e JOIN n ON e.site = n.site AND e.day = n.day GROUP BY 1""")
def f30_stream_equals_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshot files, loaded by the stream in three runs: half of the files, the others, and nothing new."""
    files, facts, state = (fresh_folder(spark, n) for n in ("snapshot-files", "stream", "stream-state"))
    e = rows(spark, sf_dir)
    body = F.to_json(F.collect_list(F.struct(F.col("user_id").alias("id"), F.floor("value").alias("aluguel"))))
    bodies = e.groupBy("file_name", F.dayofmonth("ts").alias("day")).agg(body.alias("value"))
    for half in (0, 1, None):
        if half is not None:
            bodies.where(F.col("day") % 2 == half).drop("day").write.mode("append").partitionBy("file_name").text(files)
        come = spark.readStream.format("text").option("wholetext", True).option("maxFilesPerTrigger", 100).load(files)
        ingest.ingest_files(come.select("file_name", F.col("value").alias("body")), facts, state, SITES).awaitTermination()
    table = FactTable(spark, facts)
    every = table.facts().groupBy(F.col("source_site").alias("site")).agg(F.count("*").alias("loaded"))
    current = table.newest().groupBy(F.col("source_site").alias("site")).agg(F.count("*").alias("listings"), F.sum("aluguel").alias("total"))
    return current.join(every, "site").select("site", "listings", "total", "loaded")


@query("""SELECT user_id AS id, CASE WHEN bool_or(event_type IN ('purchase', 'signup')) THEN 'sale' ELSE 'rent' END AS fonte FROM events GROUP BY 1""")
def f33_combine_legacy(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read(spark, sf_dir, "events")
    sale = e.where("event_type IN ('purchase', 'signup')").select(F.col("user_id").alias("id"), F.lit("sale").alias("fonte"))
    rent = e.where("event_type NOT IN ('purchase', 'signup')").select(F.col("user_id").alias("id"), F.lit("rent").alias("fonte"))
    return snapshots.combine_legacy(rent, sale, "id")


@query("""SELECT event_type AS key, max(user_id) AS id, count(*) AS copies FROM events GROUP BY 1""")
def f34_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-listing snapshot bodies with a repeated key: the last value stays."""
    e = read(spark, sf_dir, "events").select("event_type", "user_id", "event_id")
    body = F.format_string('{"%s":{"id":-1},"%s":{"id":%d}}', "event_type", "event_type", "user_id")
    files = e.select(F.col("event_id").cast("string").alias("file_name"), body.alias("body"))
    out = snapshots.listings(snapshots.explode_body(files))
    return out.groupBy("key").agg(F.max(F.try_variant_get("raw", "$.id", "bigint")).alias("id"), F.count("*").alias("copies"))


#: Order keys of one body, as a power of two: a file is written by one task, so more orders make more files and not longer ones.
BODY_ORDERS = 20


def body_lines(spark: SparkSession, sf_dir: str, path: str, orders: int = BODY_ORDERS) -> None:
    """Line items as one root object for each return flag and range of order keys, every order a key that comes once a line; bodies of flag R lack their end."""
    item = F.struct(F.col("l_partkey").alias("id"), F.col("l_quantity").alias("n"), F.lit('a "quoted} {text\\').alias("t"), F.struct(F.col("l_linestatus").alias("status")).alias("by"))
    body = [F.col("l_returnflag"), F.shiftright(F.col("l_orderkey"), orders).alias("part")]
    rows = read(spark, sf_dir, "lineitem").select(*body, F.col("l_orderkey").alias("o"), F.struct("l_linenumber", "l_partkey", "l_suppkey").alias("l"), F.concat(F.lit(',"'), "l_orderkey", F.lit('":'), F.to_json(item)).alias("value"))
    bodies = rows.select("l_returnflag", "part").distinct()
    first = bodies.select("l_returnflag", "part", F.lit(-(2**62)).alias("o"), F.lit(None).alias("l"), F.lit('{"-1":null').alias("value"))
    last = bodies.where("l_returnflag <> 'R'").select("l_returnflag", "part", F.lit(2**62).alias("o"), F.lit(None).alias("l"), F.lit("}").alias("value"))
    tasks = max(2 * bodies.count(), int(spark.conf.get("spark.sql.shuffle.partitions")))  # so a task's share does not grow with the table
    lines = rows.unionByName(first).unionByName(last).repartition(tasks, "l_returnflag", "part").sortWithinPartitions("l_returnflag", "part", "o", "l")
    lines.select("l_returnflag", "part", "value").write.partitionBy("l_returnflag", "part").text(path)


@query("""WITH r AS (SELECT *, row_number() OVER (PARTITION BY l_returnflag, l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC) AS rn FROM lineitem)
SELECT l_returnflag AS flag, CASE WHEN l_returnflag = 'R' THEN 'cut_off' ELSE 'inserted' END AS status, CASE WHEN l_returnflag = 'R' THEN 0 ELSE count(*) END AS listings,
 CASE WHEN l_returnflag <> 'R' THEN CAST(sum(l_partkey) AS BIGINT) END AS ids, l_returnflag <> 'R' AS many_pieces FROM r WHERE rn = 1 GROUP BY 1""")
def f80_large_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bodies of one root object each, read in blocks by many tasks: of equal keys the last stays, a cut-off body gives an error."""
    path = fresh_folder(spark, "large-bodies")
    body_lines(spark, sf_dir, path)
    pieces = bodies.cut_bodies(spark, f"{path}/*/*/*.txt", 1 << 20, 1 << 16)
    flag = F.regexp_extract("path", "l_returnflag=([A-Z])", 1).alias("flag")
    found = bodies.values(pieces).withColumn("id", F.try_variant_get("raw", "$.id", "bigint")).where("id IS NOT NULL").groupBy(flag).agg(F.count("*").alias("listings"), F.sum("id").alias("ids"))
    files = pieces.groupBy(flag).agg(F.coalesce(F.max("code"), F.lit("inserted")).alias("status"), (F.max("piece") > 1).alias("many_pieces"))
    return files.join(found, "flag", "left").select("flag", "status", F.coalesce("listings", F.lit(0).cast("bigint")).alias("listings"), "ids", "many_pieces")


def event_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as snapshot files (path, file_name, day, body): every fiftieth value is no object, bodies of errors end too early."""
    e = rows(spark, sf_dir)
    value = F.when(F.col("event_id") % 50 == 0, '"text"').otherwise(F.to_json(F.struct(F.col("user_id").alias("id"), F.floor("value").alias("aluguel"))))
    body = F.concat(F.lit("["), F.array_join(F.collect_list(value), ","), F.when(F.col("site") == "error", "").otherwise("]"))
    return e.groupBy("file_name", "site", F.to_date("ts").alias("day")).agg(body.alias("body")).select(F.concat(F.lit("/in/"), "file_name").alias("path"), "file_name", "day", "body")


ACCOUNTS = """
e AS (SELECT event_type AS site, CAST(ts AS DATE) AS day, event_type = 'error' AS cut, event_id % 50 = 0 AS text, user_id = 0 AS zero FROM events),
a AS (SELECT site, count(DISTINCT day) AS files, count(DISTINCT day) FILTER (cut) AS errors, count(*) FILTER (NOT cut) AS read, count(*) FILTER (NOT cut AND NOT text AND NOT zero) AS inserted, count(*) FILTER (NOT cut AND (text OR zero)) AS quarantined FROM e GROUP BY 1)"""


@query(f"""WITH {ACCOUNTS} SELECT mode, a.*, read = inserted + quarantined AS whole, inserted AS in_table, quarantined + errors AS kept_out FROM a, (SELECT unnest(['batch', 'stream']) AS mode)""")
def f81_load_accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of every row and file, loaded at once and by a stream in two runs: ledger, facts and quarantine agree."""
    batch, stream, files, state = (fresh_folder(spark, n) for n in ("fact-table", "stream-table", "snapshot-files", "stream-state"))
    made = event_bodies(spark, sf_dir)
    FactTable(spark, batch).load(whole(made), sites=SITES)
    for half in (0, 1):
        made.where(F.dayofmonth("day") % 2 == half).select("file_name", F.col("body").alias("value")).write.mode("append").partitionBy("file_name").text(files)
        come = spark.readStream.format("text").option("wholetext", True).load(files)
        ingest.ingest_files(come.select("file_name", F.col("value").alias("body")), stream, state, SITES).awaitTermination()
    out = None
    for mode, path in (("batch", batch), ("stream", stream)):
        table = FactTable(spark, path)
        ledger = table.ledger().groupBy("site").agg(F.count("*").alias("files"), F.count_if(F.col("status") == "error").alias("errors"), F.sum("read").alias("read"), F.sum("rows").alias("inserted"), F.sum("quarantined").alias("quarantined"))
        held = table.facts().groupBy(F.col("source_site").alias("site")).agg(F.count("*").alias("in_table"))
        kept_out = table.quarantine().groupBy("site").agg(F.count("*").alias("kept_out"))
        one = ledger.join(held, "site", "left").join(kept_out, "site", "left").select(
            F.lit(mode).alias("mode"), "*", (F.col("read") == F.col("inserted") + F.col("quarantined")).alias("whole")).fillna(0, ["in_table", "kept_out"])
        out = one if out is None else out.unionByName(one)
    return out


@query(f"""WITH {ACCOUNTS.split("a AS (SELECT site, count")[0].rstrip().rstrip(",")}, f AS (SELECT site, day, count(*) FILTER (NOT text AND NOT zero) AS n, any_value(cut) AS cut FROM e GROUP BY 1, 2),
b AS (SELECT batch, f.*, CASE WHEN cut THEN 'error' WHEN batch = 'b' AND day(day) % 2 = 0 THEN 'skipped_source_loaded' ELSE 'inserted' END AS status FROM f, (SELECT unnest(['a', 'b']) AS batch) WHERE batch = 'b' OR day(day) % 2 = 0)
SELECT batch, site, status, count(*) AS files, CAST(sum(CASE WHEN status = 'inserted' THEN n ELSE 0 END) AS BIGINT) AS rows FROM b GROUP BY ALL""")
def f82_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch, one that brings its files a second time from another folder beside new ones, and the second batch again: every file of each is accounted for once."""
    table, made = FactTable(spark, fresh_folder(spark, "fact-table")), event_bodies(spark, sf_dir)
    table.load(whole(made.where(F.dayofmonth("day") % 2 == 0)), "a", SITES)
    for _ in range(2):
        table.load(whole(made.withColumn("path", F.concat(F.lit("/copy"), "path"))), "b", SITES)
    return table.ledger().groupBy("batch", "site", "status").agg(F.count("*").alias("files"), F.sum("rows").alias("rows"))


@query(f"""WITH {ACCOUNTS.split("a AS (SELECT site, count")[0].rstrip().rstrip(",")}
SELECT site, count(DISTINCT day) AS snapshots, count(*) AS listings, CAST(max(day) AS VARCHAR) AS newest FROM e WHERE NOT cut AND NOT text AND NOT zero AND day(day) % 3 <> 0 GROUP BY 1""")
def f83_stopped_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A load that fails at one of its files leaves the table as it was."""
    table, made = FactTable(spark, fresh_folder(spark, "fact-table")), event_bodies(spark, sf_dir)
    table.load(whole(made.where(F.dayofmonth("day") % 3 != 0)), "good", SITES)
    broken = F.when(F.col("file_name").contains("_click"), F.raise_error(F.lit("a file is gone")).cast("string")).otherwise(F.col("body"))
    try:
        table.load(whole(made.where(F.dayofmonth("day") % 3 == 0).withColumn("body", broken)), "bad", SITES)
    except Exception as e:  # noqa: BLE001  whatever ends the job, the table must stay
        if "a file is gone" not in str(e):
            raise
    every = table.facts().groupBy(F.col("source_site").alias("site")).agg(F.count_distinct("scrapy_date").alias("snapshots"), F.count("*").alias("listings"))
    newest = table.newest().groupBy(F.col("source_site").alias("site")).agg(F.date_format(F.max("scrapy_date"), "yyyy-MM-dd").alias("newest"))
    return every.join(newest, "site")


@query("""WITH u AS (SELECT event_id, user_id || '_' || event_type || '_' || strftime(ts, '%Y-%m-%d') || '_00-00' AS uid FROM events),
h AS (SELECT event_id, uid, sha1(unhex('NAMESPACE') || encode(uid)) AS h FROM u)
SELECT event_id, uid, left(h, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-' || CASE WHEN substr(h, 17, 1) IN ('0', '4', '8', 'c') THEN '8' WHEN substr(h, 17, 1) IN ('1', '5', '9', 'd') THEN '9'
 WHEN substr(h, 17, 1) IN ('2', '6', 'a', 'e') THEN 'a' ELSE 'b' END || substr(h, 18, 3) || '-' || substr(h, 21, 12) AS internal_id FROM h""".replace("NAMESPACE", records.NAMESPACE.hex))
def f84_stable_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of fact rows, the same in every run: name-based from the uid."""
    e = rows(spark, sf_dir).select("event_id", F.col("user_id").alias("id"), F.col("site").alias("fonte"), "stamp")
    uid = records.stamped_uid(F.col("id"), F.col("fonte"), F.col("stamp"))
    return e.select("event_id", uid.alias("uid"), records.named_uuid(uid).alias("internal_id"))


@query("""SELECT o_orderstatus AS folder, '2024-01-01_00-00_vivareal.json' AS file_name, count(*) AS listings, CAST(sum(o_custkey) AS BIGINT) AS total FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1""")
def f87_explicit_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two files of one name in two folders, given one by one, beside a third that is not: rows of equal keys stay apart."""
    path, name = fresh_folder(spark, "given"), "2024-01-01_00-00_vivareal.json"
    o, where = read(spark, sf_dir, "orders"), spark._jvm.org.apache.hadoop.fs.Path
    fs, found = where(path).getFileSystem(spark._jsc.hadoopConfiguration()), {}
    for status in ("F", "O", "P"):
        rows = o.where(F.col("o_orderstatus") == status).select(F.col("o_orderkey").alias("k"), F.concat(F.lit(',"k'), F.row_number().over(Window.orderBy("o_orderkey")), F.lit('":'), F.to_json(F.struct(F.col("o_custkey").alias("id")))).alias("value"))
        ends = spark.createDataFrame([(-1, '{"first":0'), (2**62, "}")], "k long, value string")
        rows.unionByName(ends).repartition(1).sortWithinPartitions("k").select("value").write.text(f"{path}/{status}")
        part = next(s.getPath() for s in fs.listStatus(where(f"{path}/{status}")) if s.getPath().getName().startswith("part-"))
        found[status] = f"{path}/{status}/{name}"
        fs.rename(part, where(found[status]))
    rows = snapshots.listings(snapshots.explode_body(snapshots.read_files(spark, [found["F"], found["O"]])))
    folder = F.element_at(F.split("path", "/"), -2)
    return rows.groupBy(folder.alias("folder"), "file_name").agg(F.count("*").alias("listings"), F.sum(F.try_variant_get("raw", "$.id", "bigint")).alias("total"))
