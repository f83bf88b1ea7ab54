"""The fact table with all-or-nothing loads: versioned folders, and a manifest that one rename puts in force.

A load tags every row and file of its bodies once and writes that; facts, quarantine and ledger are written from it below a
folder of the load's own, and nothing reads them before the manifest names them. The manifest has a line for each loaded
snapshot (stamp, site, folder, rows, batch), so readers find the newest snapshot of a site without reading facts, and
a load that ends midway leaves the table as it was. Writers that commit at once meet at the rename: the later one starts
again from the other's manifest. The folder lies on a file system whose rename is atomic and fails where the target exists.

Every row is accounted for: inserted, or in quarantine with a reason; every file is inserted, skipped_source_loaded, or error
with its reason. The ledger keeps a line for each file and batch. A batch that comes again after its commit changes nothing.
The driver holds one manifest line for each snapshot and each batch, never a listing.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..sources import bodies, snapshots
from . import records
from .tables import written

MESSAGES = bodies.MESSAGES | {
    "not_a_snapshot": "the name is not that of a snapshot", "impossible_stamp": "the stamp is no minute of any day", "unknown_site": "the site is not one of those that are loaded",
    "not_a_listing": "the value is no object", "missing_id": "id is missing or 0", "missing_source": "source is missing",
}
LEDGER = "batch string, path string, file_name string, site string, stamp string, status string, read long, rows long, quarantined long, code string"
LOADED = "stamp string, site string, loaded_by string"


@dataclass
class Snapshot:
    """A line of the manifest."""

    stamp: str
    site: str
    folder: str
    rows: int
    batch: str


def message(code: Column) -> Column:
    return F.element_at(F.create_map(*(F.lit(x) for kv in MESSAGES.items() for x in kv)), code)


def tagged(pieces: DataFrame, sites: list[str] | None = None) -> DataFrame:
    """Every value of the pieces (path, file_name, piece, body, code) with its record columns and code, and a row without raw for every file that has none to read."""
    named = snapshots.with_names(pieces)
    name = (
        F.when(F.col("stamp").isNull() | snapshots.is_output(F.col("site")), "not_a_snapshot").when(F.col("snapshot_ts").isNull(), "impossible_stamp")
        .when(~F.col("site").isin(sites or snapshots.SITES), "unknown_site")
    )
    named = named.withColumn("code", F.coalesce(name, F.col("code")))
    keep = ["path", "file_name", "stamp", "site"]
    files = named.where("piece = 0").select(*keep, F.lit(None).cast("long").alias("piece"), F.lit(None).cast("int").alias("pos"), F.lit(None).cast("variant").alias("raw"), "code")
    rows = snapshots.with_names(bodies.values(named)).select(*keep, "piece", "pos", "raw")
    rows = records.unified_from_raw(rows.withColumn("code", F.when(~F.schema_of_variant("raw").startswith("OBJECT"), "not_a_listing")))
    bad = F.when(F.coalesce(F.col("id") == 0, F.lit(True)), "missing_id").when(F.coalesce(F.col("fonte") == "", F.lit(True)), "missing_source")
    return rows.withColumn("code", F.coalesce("code", bad)).unionByName(files, allowMissingColumns=True)


def whole(files: DataFrame) -> DataFrame:
    """Files (file_name, body, perhaps path) as one piece each, with the error code of those that cannot be read."""
    body = F.col("body")
    root = F.left(F.regexp_replace(body, r"^\s+", ""), F.lit(1))
    end = F.right(F.regexp_replace(body, r"\s+$", ""), F.lit(1))
    read = F.when(root == "{", (end == "}") & F.from_json(body, "map<string,variant>").isNotNull()).otherwise((end == "]") & F.from_json(body, "array<variant>").isNotNull())
    code = F.when(F.coalesce(root, F.lit("")) == "", "empty").when(~root.isin("{", "["), "no_object_or_array").when(~read, "unreadable")
    path = F.col("path") if "path" in files.columns else F.col("file_name")
    return files.select(path.alias("path"), "file_name", F.lit(0).cast("long").alias("piece"), "body", code.alias("code"))


class FactTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        uri = spark._jvm.java.net.URI(self.root)
        conf = spark._jsc.hadoopConfiguration()
        self.path = spark._jvm.org.apache.hadoop.fs.Path
        self.files = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(uri, conf) if uri.getScheme() else spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(conf)
        self.fs = self.path(self.root).getFileSystem(conf)

    def _newest(self) -> int:
        """Number of the manifest in force, 0 before the first load."""
        where = self.path(f"{self.root}/manifests")
        if not self.fs.exists(where):
            return 0
        names = [s.getPath().getName() for s in self.fs.listStatus(where)]
        return max((int(n) for n in names if n.isdigit()), default=0)

    def _read(self, number: int) -> dict:
        if not number:
            return {"snapshots": [], "batches": {}, "schema": None}
        text = self.spark.read.text(f"{self.root}/manifests/{number:012d}", wholetext=True).first()["value"]
        held = json.loads(text)
        return held | {"snapshots": [Snapshot(**s) for s in held["snapshots"]]}

    def manifest(self) -> dict:
        return self._read(self._newest())

    def _commit(self, number: int, state: dict) -> bool:
        """Puts a manifest in force; False if another writer was first."""
        text = json.dumps(state | {"snapshots": [asdict(s) for s in state["snapshots"]]})
        made = self.path(f"{self.root}/manifests/making-{uuid.uuid4().hex}")
        out = self.fs.create(made)
        out.write(bytearray(text.encode()))
        out.close()
        none = self.spark._sc._gateway.new_array(getattr(self.spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
        try:
            self.files.rename(self.files.makeQualified(made), self.files.makeQualified(self.path(f"{self.root}/manifests/{number:012d}")), none)
        except Exception as e:  # noqa: BLE001  py4j wraps all of Hadoop's
            self.fs.delete(made, False)
            if "FileAlreadyExists" in str(e):
                return False
            raise
        return True

    def load(self, pieces: DataFrame, batch: str | None = None, sites: list[str] | None = None, skip_loaded: bool = True) -> dict[str, int]:
        """Loads bodies (path, file_name, piece, body, code) as one transaction and returns what became of them in numbers.

        Files whose snapshot is loaded already are skipped, of several files of one snapshot all but the first readable one
        by path; with skip_loaded=False they replace it.
        """
        batch = batch or uuid.uuid4().hex
        while True:
            number = self._newest()
            state = self._read(number)
            if batch in state["batches"]:
                return state["batches"][batch]
            folder = f"v={uuid.uuid4().hex}"
            counts, made, schema = self._write(pieces, batch, folder, state, sites, skip_loaded)
            new = {(s.stamp, s.site): s for s in [*state["snapshots"], *made]}
            after = {"snapshots": [new[k] for k in sorted(new)], "batches": state["batches"] | {batch: counts | {"folder": folder}}, "schema": schema}
            if self._commit(number + 1, after):
                return after["batches"][batch]
            for part in ("facts", "quarantine", "ledger"):
                self.fs.delete(self.path(f"{self.root}/{part}/{folder}"), True)

    def _write(self, pieces: DataFrame, batch: str, folder: str, state: dict, sites: list[str] | None, skip_loaded: bool) -> tuple[dict, list[Snapshot], str]:
        row, bad = F.col("raw").isNotNull(), F.col("code").isNotNull()
        seen = Observation()
        marked = tagged(pieces, sites).observe(seen, F.count_if(row).alias("rows"), F.count_if(row & bad).alias("bad_rows"), F.count_if(~row).alias("files"), F.count_if(~row & bad).alias("errors"))
        marked = written(marked, "tagged")
        loaded = self.spark.createDataFrame([(s.stamp, s.site, s.batch) for s in state["snapshots"]] if skip_loaded else [], LOADED)
        files = marked.where("raw IS NULL").select("path", "file_name", "stamp", "site", "code").join(loaded, ["stamp", "site"], "left")
        first = F.row_number().over(Window.partitionBy("stamp", "site", F.col("code").isNull()).orderBy("path")) == 1
        status = F.when(bad, "error").when(F.col("loaded_by").isNotNull() | ~first, "skipped_source_loaded").otherwise("inserted")
        files = files.withColumn("status", status)
        rows = marked.where("raw IS NOT NULL").groupBy("path").agg(F.count_if(~bad).alias("good"), F.count_if(bad).alias("bad"))
        inserted = F.col("status") == "inserted"
        ledger = files.join(rows, "path", "left").select(
            F.lit(batch).alias("batch"), "path", "file_name", "site", "stamp", "status", F.coalesce(F.col("good") + F.col("bad"), F.lit(0)).cast("long").alias("read"), F.when(inserted, F.coalesce("good", F.lit(0))).otherwise(0).cast("long").alias("rows"),
            F.when(inserted, F.coalesce("bad", F.lit(0))).otherwise(0).cast("long").alias("quarantined"), "code",
        )
        ledger.write.parquet(f"{self.root}/ledger/{folder}")
        ledger = self.spark.read.schema(LEDGER).parquet(f"{self.root}/ledger/{folder}")
        chosen = ledger.where("status = 'inserted'").select("path")
        rows = marked.where("raw IS NOT NULL").join(chosen, "path", "left_semi")
        facts = records.stamped_rows(rows.where("code IS NULL")).withColumn("scrapy_date", F.date_format("scrapy_date", "yyyy-MM-dd_HH-mm"))
        facts.hint("rebalance", "scrapy_date", "source_site").write.partitionBy("scrapy_date", "source_site").parquet(f"{self.root}/facts/{folder}")
        failed = marked.where("raw IS NULL AND code IS NOT NULL")
        rest = rows.where("code IS NOT NULL").unionByName(failed)
        rest = rest.select("path", "file_name", "site", "stamp", "piece", "pos", "code", message(F.col("code")).alias("message"), F.try_variant_get("raw", "$.id", "string").alias("listing_id"), "url", F.to_json("raw").alias("raw"))
        rest.write.parquet(f"{self.root}/quarantine/{folder}")
        made = [Snapshot(r["stamp"], r["site"], folder, r["rows"], batch) for r in ledger.where("status = 'inserted'").select("stamp", "site", "rows").collect()]
        totals = ledger.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("inserted"), F.coalesce(F.sum("quarantined"), F.lit(0)).alias("quarantined"), F.count_if(F.col("status") == "skipped_source_loaded").alias("skipped_files")).first()
        return seen.get | totals.asDict(), made, facts.schema.json()

    def _facts(self, chosen: list[Snapshot], schema: str | None) -> DataFrame:
        kinds = StructType.fromJson(json.loads(schema)) if schema else records.stamped_rows(tagged(self.spark.createDataFrame([], "path string, file_name string, piece long, body string, code string"))).schema
        paths = [f"{self.root}/facts/{s.folder}/scrapy_date={s.stamp}/source_site={s.site}" for s in chosen if s.rows]
        if paths:
            rows = self.spark.read.schema(kinds).option("basePath", f"{self.root}/facts").parquet(*paths).select(*kinds.names)
        else:
            rows = self.spark.createDataFrame([], kinds)
        return rows.withColumn("scrapy_date", F.try_to_timestamp(F.col("scrapy_date").cast("string"), F.lit("yyyy-MM-dd_HH-mm")))

    def facts(self) -> DataFrame:
        """All rows in force."""
        held = self.manifest()
        return self._facts(held["snapshots"], held["schema"])

    def newest(self) -> DataFrame:
        """Rows of each site's newest snapshot by its stamp, whenever it came; no other folder is read."""
        held = self.manifest()
        latest = {s.site: s for s in sorted(held["snapshots"], key=lambda s: s.stamp)}
        return self._facts(list(latest.values()), held["schema"])

    def _batches(self, part: str, schema: str) -> DataFrame:
        folders = [f"{self.root}/{part}/{b['folder']}" for b in self.manifest()["batches"].values()]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def ledger(self) -> DataFrame:
        """One row for each file of each batch: its status, rows and reason."""
        return self._batches("ledger", LEDGER)

    def quarantine(self) -> DataFrame:
        """Rows and files kept out, with the reason."""
        return self._batches("quarantine", "path string, file_name string, site string, stamp string, piece long, pos int, code string, message string, listing_id string, url string, raw string")

    def clean(self) -> int:
        """Removes folders that no manifest in force names, what failed or replaced loads left; run it while nothing loads. Returns their number."""
        held = self.manifest()
        used = {"facts": {s.folder for s in held["snapshots"]}, "quarantine": {b["folder"] for b in held["batches"].values()}}
        used["ledger"], gone = used["quarantine"], 0
        for part, names in used.items():
            where = self.path(f"{self.root}/{part}")
            for found in self.fs.listStatus(where) if self.fs.exists(where) else []:
                if found.getPath().getName() not in names:
                    gone += self.fs.delete(found.getPath(), True)
        return gone
