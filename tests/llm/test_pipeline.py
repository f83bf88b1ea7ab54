"""The pipeline, stage by stage, against brute force on each stage's own input."""

import random
from collections import Counter

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
pytest.importorskip("public_tokenizers")

from lotwise.llm import packing, toxicity  # noqa: E402
from lotwise.llm.queries import tokenizer_path  # noqa: E402

from .conftest import corpus  # noqa: E402
from .test_exact import near_brute, words  # noqa: E402
from .test_models import labelled  # noqa: E402

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def keyed(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def without_repeats(rows):
    held = {}
    for d, t, _ in rows:
        for line in (t or "").split("\n"):
            if len(keyed(line)) >= 40:
                held.setdefault(keyed(line), set()).add(d if d is not None else -(1 << 63))
    keep = {k: max(v) for k, v in held.items() if len(v) >= 5}
    return sorted((str(d), "\n".join(x for x in (t or "").split("\n") if keep.get(keyed(x), d) == d), str(s)) for d, t, s in rows)


def triples_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_stages(spark, tmp_path):
    train = labelled(random.Random(3), 300)
    rows = [*corpus(), *((1000 + d, t, f"s{d % 3}") for d, t, _ in train)]
    docs = spark.createDataFrame([(d, t, "en", s, len(t or "")) for d, t, s in rows], COLUMNS)
    labels = spark.createDataFrame([(1000 + d, 1, v) for d, _, v in train], "doc_id long, quality int, toxic int")
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    kept = {"documents": spark.read.parquet(f"{tmp_path}/documents.parquet")}
    now = kept["documents"]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        before, now = now, spark.read.parquet(f"{tmp_path}/{k}")
        if name != "packing":
            assert now.schema.names == docs.schema.names
        if name == "toxicity":
            predicted = {r["doc_id"]: r["predicted"] for r in toxicity.toxicity(before, labels).collect()}
            assert sorted(map(str, triples_of(now))) == sorted(str(t) for t in triples_of(before) if not predicted[t[0]])
            toxic = {1000 + d for d, _, v in train if v}
            assert len(toxic & {r["doc_id"] for r in now.collect()}) <= 0.1 * len(toxic)
        elif name == "line dedup":
            assert sorted((str(d), t or "", str(s)) for d, t, s in triples_of(now)) == without_repeats(triples_of(before))
            assert all(r["n_chars"] == len(r["text"] or "") for r in now.collect() if r["text"] is not None)
        elif name == "near dedup":
            sets, root = near_brute(triples_of(before), 5, 80)
            assert sorted(str(t) for t in triples_of(now)) == sorted(str(t) for t in triples_of(before) if t[0] == root(t[0]))
        elif name == "mixing":
            have, got = Counter(map(str, triples_of(before))), Counter(map(str, triples_of(now)))
            assert set(got) <= set(have) and all(got[t] <= 2 * have[t] for t in got)
            size, taken = (sum(len(words(t)) for _, t, _ in triples_of(x)) for x in (before, now))
            assert abs(taken - 1.5 * size) < 0.03 * size
        else:
            pieces = packing.cut_pieces(before, tokenizer_path())
            assert now.count() == pieces.count()
            assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in now.collect()) == Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in pieces.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_stages_on_nothing_and_on_extra_columns(spark, tmp_path):
    train = labelled(random.Random(3), 60)
    extra = ", _copy string, _gone long, n_lines int, kept int, _id string, score double"
    rows = [(d, t, "en", "s", len(t), "c", 1, 2, 3, "i", 0.5) for d, t, _ in train] + [(None, None, None, None, None, "c", 1, 2, 3, "i", 0.5)]
    for name, some in (("nothing", []), ("extra", rows)):
        folder = str(tmp_path / name)
        spark.createDataFrame(some, COLUMNS + extra).write.parquet(f"{folder}/documents.parquet")
        spark.createDataFrame([(d, 1, v) for d, _, v in train] if some else [], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
        now = spark.read.parquet(f"{folder}/documents.parquet")
        columns = now.columns
        for k, (stage_name, stage) in enumerate(corpus_pipeline.STAGES):
            stage(spark, now, folder).write.parquet(f"{folder}/{k}")
            now = spark.read.parquet(f"{folder}/{k}")
            if stage_name != "packing":
                assert now.columns == columns
                assert {tuple(r)[5:] for r in now.collect()} == ({("c", 1, 2, 3, "i", 0.5)} if some else set())
        assert (now.count() > 0) == bool(some)
