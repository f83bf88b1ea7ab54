"""The fact table: every row accounted for, loads that are whole or nothing, replays, conflicts, the newest snapshot's plan."""

import json
import uuid

import pytest
from pyspark.sql import functions as F

from lotwise.operators import facts, records
from lotwise.operators.facts import FactTable, whole
from lotwise.sources import bodies, snapshots


def body_rows(spark, named):
    return spark.createDataFrame([(f"/{k}/{n}", n, b) for k, (n, b) in enumerate(named)], "path string, file_name string, body string")


FIRST = [
    ("2026-06-01_02-25_vivareal.json", json.dumps({"1": {"id": 1, "aluguel": 5}, "2": {"id": 2, "fonte": "x"}, "z": {"id": 0}, "n": {"id": None}, "l": [1], "t": "text", "s": {"id": "7"}})),
    ("2026-06-02_00-00_zapimoveis.json", '[{"id": 9}, {"id": 10'), ("2026-06-02_00-00_vivareal.json", '"only a text"'), ("2026-06-03_00-00_vivareal.json", " "), ("2026-13-02_00-00_vivareal.json", "[]"),
    ("2026-06-02_00-00_elsewhere.json", "[]"), ("notes.json", "[]"), ("2026-06-02_00-00_netimoveis.json", '[{"id": 4}]'), ("2026-06-02_00-00_netimoveis.json", '[{"id": 5}, {"id": 6}]'), ("2026-06-04_00-00_zapimoveis.json", "{}"),
]


def test_every_row_and_file_is_accounted_for(spark, tmp_path):
    table = FactTable(spark, str(tmp_path / "t"))
    counts = table.load(whole(body_rows(spark, FIRST)), "b1")
    assert {k: counts[k] for k in ("rows", "files", "errors", "inserted", "quarantined", "skipped_files")} == {"rows": 10, "files": 10, "errors": 6, "inserted": 4, "quarantined": 4, "skipped_files": 1}
    ledger = {r["path"]: r for r in table.ledger().collect()}
    assert [ledger[f"/{k}/{n}"]["status"] for k, (n, _) in enumerate(FIRST)] == ["inserted", *["error"] * 6, "inserted", "skipped_source_loaded", "inserted"]
    assert [ledger[f"/{k}/{FIRST[k][0]}"]["code"] for k in range(1, 7)] == ["unreadable", "no_object_or_array", "empty", "impossible_stamp", "unknown_site", "not_a_snapshot"]
    assert sum(r["read"] for r in ledger.values()) == counts["rows"]
    kept_out = [(r["code"], r["listing_id"]) for r in table.quarantine().where("raw IS NOT NULL").collect()]
    assert sorted(kept_out, key=str) == [("missing_id", "0"), ("missing_id", None), ("not_a_listing", None), ("not_a_listing", None)]
    assert table.quarantine().where("message IS NULL").count() == 0 and table.quarantine().where("raw IS NULL").count() == 6
    assert {(r["uid"], r["source_site"]) for r in table.facts().collect()} == {("1_vivareal_2026-06-01_02-25", "vivareal"), ("2_x_2026-06-01_02-25", "vivareal"), ("7_vivareal_2026-06-01_02-25", "vivareal"), ("4_netimoveis_2026-06-02_00-00", "netimoveis")}
    assert table.load(whole(body_rows(spark, FIRST)), "b1") == counts  # a batch that comes again
    # The pair of a loaded file comes in another batch: it is skipped, and the ledger has both.
    table.load(whole(body_rows(spark, [FIRST[8], ("2026-06-02_00-00_zapimoveis.json", '[{"id": 9}]')])), "b2")
    pair = table.ledger().where("site = 'netimoveis'").select("batch", "status").collect()
    assert sorted(map(tuple, pair)) == [("b1", "inserted"), ("b1", "skipped_source_loaded"), ("b2", "skipped_source_loaded")]
    assert table.ledger().where("site = 'zapimoveis' AND stamp = '2026-06-02_00-00'").count() == 2 and table.facts().where("id = 9").count() == 1


def test_a_replay_is_equal_in_every_column(spark, tmp_path):
    tables = [FactTable(spark, str(tmp_path / n)) for n in ("a", "b")]
    for t in tables:
        t.load(whole(body_rows(spark, FIRST).repartition(3)), "b1")
    rows = [sorted(map(str, t.facts().withColumn("full_item_json", F.to_json("full_item_json")).collect())) for t in tables]
    assert rows[0] == rows[1] and len(rows[0]) == 4
    names = spark.createDataFrame([("1_x",), ("é",), ("",), (None,)], "n string").select("n", records.named_uuid(F.col("n")).alias("u")).collect()
    assert [r["u"] for r in names] == [None if r["n"] is None else str(uuid.uuid5(records.NAMESPACE, r["n"])) for r in names]


def test_a_load_that_stops_leaves_the_old_state(spark, tmp_path, monkeypatch):
    table = FactTable(spark, str(tmp_path / "t"))
    table.load(whole(body_rows(spark, FIRST)), "b1")
    before = sorted(r["uid"] for r in table.facts().collect())
    more = [("2026-07-01_00-00_vivareal.json", '[{"id": 1}]'), ("2026-07-01_00-00_zapimoveis.json", '[{"id": 2}]'), FIRST[0]]

    def stop(rows):  # after the first snapshot's rows are written
        raise RuntimeError("executor lost")

    monkeypatch.setattr(facts, "message", stop)
    with pytest.raises(RuntimeError):
        table.load(whole(body_rows(spark, more)), "b2", skip_loaded=False)
    monkeypatch.undo()
    assert sorted(r["uid"] for r in table.facts().collect()) == before and table.ledger().where("batch = 'b2'").count() == 0
    assert table.clean() > 0 and sorted(r["uid"] for r in table.facts().collect()) == before
    counts = table.load(whole(body_rows(spark, more)), "b2", skip_loaded=False)
    assert counts["inserted"] == 5 and table.facts().count() == 6
    assert {r["id"] for r in table.newest().where("source_site <> 'netimoveis'").collect()} == {1, 2}
    assert table.clean() == 0 and table.facts().count() == 6  # b1's folder still holds a snapshot in force


def test_writers_that_meet_keep_both_loads(spark, tmp_path, monkeypatch):
    table, other = (FactTable(spark, str(tmp_path / "t")) for _ in range(2))
    write = FactTable._write

    def slow(self, *args):
        out = write(self, *args)
        if self is table and not slow.met:
            slow.met = True
            other.load(whole(body_rows(spark, [FIRST[7]])), "theirs")
        return out

    slow.met = False
    monkeypatch.setattr(FactTable, "_write", slow)
    table.load(whole(body_rows(spark, [("2026-07-01_00-00_vivareal.json", '[{"id": 1}]')])), "mine")
    assert {r["id"] for r in table.facts().collect()} == {1, 4} and set(table.manifest()["batches"]) == {"mine", "theirs"}


def test_newest_reads_only_the_newest_folders(spark, tmp_path):
    table = FactTable(spark, str(tmp_path / "t"))
    assert table.facts().count() == table.newest().count() == table.ledger().count() == table.quarantine().count() == 0
    days = [(f"2026-06-{d:02}_00-00_{s}.json", json.dumps([{"id": d * 10 + k} for k in range(3)])) for d in (5, 2, 9) for s in ("vivareal", "zapimoveis")]
    table.load(whole(body_rows(spark, days)))
    read = lambda df: {p.split("scrapy_date=")[1].split("/part")[0] for p in df.inputFiles()}
    assert read(table.newest()) == {"2026-06-09_00-00/source_site=vivareal", "2026-06-09_00-00/source_site=zapimoveis"}
    assert sorted(r["id"] for r in table.newest().collect()) == sorted([90, 91, 92] * 2)
    table.load(whole(body_rows(spark, [("2026-06-03_00-00_vivareal.json", '[{"id": 33}]')])))  # late
    assert sorted(r["id"] for r in table.newest().collect()) == sorted([90, 91, 92] * 2) and table.facts().count() == 19


def test_large_files_load_from_pieces(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "2026-06-05_00-00_vivareal.json").write_text(json.dumps({str(k): {"id": k + 1, "endereco": "x" * 50} for k in range(3000)}))
    (tmp_path / "in" / "2026-06-06_00-00_vivareal.json").write_text('[{"id": 1}, {"id": 2}')
    table = FactTable(spark, str(tmp_path / "t"))
    counts = table.load(bodies.cut_bodies(spark, str(tmp_path / "in"), 32 << 10, 16 << 10))
    assert (counts["inserted"], counts["errors"]) == (3000, 1) and table.facts().count() == 3000
    assert table.ledger().where("code = 'cut_off'").count() == 1
    assert snapshots.read_files(spark, str(tmp_path / "in")).count() == 2
