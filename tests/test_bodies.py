"""Bodies cut over many tasks against json.load, whole and broken."""

import json
import random

import pytest
from pyspark.sql import functions as F

from lotwise.sources import bodies


def ordered(text):
    """(key, value) pairs of a body, the last of equal keys only, or None if it is no object or array."""
    try:
        root = json.loads(text, object_pairs_hook=lambda pairs: ("object", pairs))
    except ValueError:
        return None
    if isinstance(root, tuple):
        last = {k: i for i, (k, _) in enumerate(root[1])}
        return [(k, v) for i, (k, v) in enumerate(root[1]) if last[k] == i]
    return [(None, v) for v in root] if isinstance(root, list) else None


def plain(value):
    if isinstance(value, tuple):
        return {k: plain(v) for k, v in value[1]}
    return [plain(v) for v in value] if isinstance(value, list) else value


def made(rng, depth=0):
    kind = rng.randint(0, 7 if depth < 3 else 4)
    texts = ["", "}", "a}b{", 'q"}"', "\\", "\\\\}", "é}", "{[", "]", "\n", "x" * 40]
    if kind == 0:
        return rng.choice([None, True, 0, -1.5])
    if kind < 5:
        return rng.choice(texts)
    if kind == 5:
        return [made(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    return {rng.choice(texts) + str(k): made(rng, depth + 1) for k in range(rng.randint(0, 3))}


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    path, rng, files = tmp_path_factory.mktemp("bodies"), random.Random(2), {}
    for k in range(12):
        items = [made(rng) for _ in range(rng.randint(0, 60))]
        text = json.dumps(items, ensure_ascii=False) if k % 2 else "{" + ",\n ".join(f"{json.dumps(f'k}}{rng.randint(0, 50)}')}: {json.dumps(v, indent=1)}" for v in items) + "}"
        files[f"good{k:02}.json"] = rng.choice(["", " \n"]) + text + rng.choice(["", "\n", "  \n"])
    whole = files["good02.json"].strip()
    files |= {
        "cut1.json": whole[:-1], "cut2.json": whole[: len(whole) // 2], "cut3.json": '{"a": {"id": 1}, "b": {"t": "never closed}', "cut4.json": '{"a":{"id":1}', "cut5.json": "[1, [2", "bad1.json": '{"a": {"id": }}',
        "bad2.json": '[{"id": 1} {"id": 2}]', "bad3.json": '[{"id":1},]', "bad4.json": '{"a":{"id":1}} tail', "bad5.json": '{"a":{"id":1}]', "text.json": '"only a text"', "null.json": "null", "none.json": "", "blank.json": " \n ",
        "two.json": '{"a":{"id":1}}{"b":{"id":2}}', "emptyobject.json": "{}", "emptylist.json": " [ ] ", "plain.json": '[1, "x", [2, 3], null]', "brace.json": '{"a":{"id":1}}',
    }
    for name, text in files.items():
        (path / name).write_bytes(text.encode())
    return str(path), files


@pytest.mark.parametrize("block,chunk", [(None, 1 << 20), (64, 1 << 20), (200, 50), (4096, 16)])
def test_bodies_agree_with_whole_parsing(spark, folder, block, chunk):
    path, files = folder
    pieces = bodies.cut_bodies(spark, path, block, chunk)
    rows = bodies.values(pieces).select("file_name", "key", "piece", "pos", F.to_json("raw").alias("raw")).collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r["file_name"], r["piece"], r["pos"])):
        found.setdefault(r["file_name"], []).append((r["key"], json.loads(r["raw"])))
    errors = {r["file_name"]: r["code"] for r in bodies.errors(pieces).collect()}
    for name, text in files.items():
        want = ordered(text)
        if want is None:
            assert name in errors and name not in found, name
        else:
            assert name not in errors, (name, errors[name])
            assert found.get(name, []) == [(k, plain(v)) for k, v in want], name
    assert {errors[k] for k in errors if k.startswith("cut")} == {"cut_off"}
    assert errors["none.json"] == errors["blank.json"] == "empty" and errors["text.json"] == errors["null.json"] == "no_object_or_array"
    assert bodies.errors(pieces).where("message IS NULL").count() == 0


def test_a_large_body_is_read_by_many_tasks(spark, tmp_path):
    n = 30_000
    (tmp_path / "large.json").write_text("{" + ",".join(f'"k{k}":{{"id":{k},"text":"{"x" * 60}"}}' for k in range(n)) + "}")
    pieces = bodies.cut_bodies(spark, str(tmp_path), 256 << 10, 64 << 10)
    sizes = pieces.select(F.octet_length("body").alias("n")).collect()
    assert len(sizes) > 20 and max(r["n"] for r in sizes) < 200_000
    rows = bodies.values(pieces)
    assert rows.select(F.spark_partition_id()).distinct().count() > 1
    got = rows.agg(F.count("*").alias("n"), F.sum(F.try_variant_get("raw", "$.id", "long")).alias("ids")).first()
    assert (got["n"], got["ids"]) == (n, n * (n - 1) // 2)
