"""The corpus pipeline: each stage against a plain version of its decision, and the whole run."""

import os
import zlib

import corpus_pipeline
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from test_groups import brute_groups, brute_held
from tokenizers import Tokenizer

from hourgrid import session
from hourgrid.llm import queries, secret_scan, ship

STAGES = dict(corpus_pipeline.STAGES)
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark, sf_dir, tmp_path_factory):
    """What each stage gets and returns, written and read as the pipeline does."""
    docs, out = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = str(tmp_path_factory.mktemp("stage") / str(i))
        stage(spark, docs, sf_dir).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = (docs, after)
        docs = after
    return out


def texts(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_the_stages():
    assert list(STAGES) == ["quality classifier", "n-gram Jaccard join", "benchmark decontamination", "secret scans", "packing"]


def test_columns_stay(steps):
    for name, (before, after) in steps.items():
        if name != "packing":
            assert after.columns == before.columns == COLUMNS and after.dtypes == before.dtypes


def test_quality_goes_by_the_score(spark, sf_dir, steps):
    before, after = steps["quality classifier"]
    good = queries.queries()["op7_quality_classifier"](spark, sf_dir).where("predicted = 1")
    assert sorted(texts(after)) == sorted(texts(before.join(good, "doc_id")))
    assert 0.7 * before.count() < after.count() < before.count()


def test_one_document_of_each_group_stays(steps):
    before, after = steps["n-gram Jaccard join"]
    rows = texts(before)
    kept = {i for i, _, component in brute_groups(rows, 5, 80, 100) if component in (i, None)}
    assert sorted(texts(after)) == sorted(r for r in rows if r[0] in kept)


def test_no_document_with_an_item_stays(sf_dir, spark, steps):
    before, after = steps["benchmark decontamination"]
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    held = {d for d, _ in brute_held(texts(before), items)}
    assert sorted(texts(after)) == sorted(r for r in texts(before) if r[0] not in held)


def test_secrets_are_marked(steps):
    before, after = steps["secret scans"]
    old, new = dict(texts(before)), dict(texts(after))
    assert old.keys() == new.keys()
    for i, text in old.items():
        if new[i] != text:
            assert secret_scan.MARK in new[i] and len(list(secret_scan.candidates(text))) >= new[i].count(secret_scan.MARK)
        assert not any(secret_scan.known_label(new[i], a, b) == 1 for a, b in secret_scan.candidates(new[i]))


def test_pieces_hold_the_documents(steps):
    before, after = steps["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = {}
    for r in after.collect():
        pieces.setdefault(r["doc_id"], []).append(r)
    for i, text in texts(before):
        ids, at = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 1], "<u4"), 0
        for r in sorted(pieces[i], key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[at : at + r["length"]].tobytes())
            at += r["length"]
        assert at == len(ids)


def test_run_is_all_stages(spark, sf_dir, steps):
    got = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "length", "ids_crc32")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, steps["packing"][1].select(got.columns).collect()))


def test_rows_are_told_apart_without_ids(spark, sf_dir, documents):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, item), (None, item), (2, clean), (None, clean), (2, clean), (7, clean + " and some more words of its own " * 4), (3, None), (None, "")]
    left = STAGES["benchmark decontamination"](spark, documents(rows), sf_dir)
    assert sorted(texts(left), key=repr) == sorted([r for r in rows if r[1] != item], key=repr)
    left = STAGES["n-gram Jaccard join"](spark, documents(rows), sf_dir)
    assert sorted(texts(left), key=repr) == sorted([rows[0], rows[2], *rows[5:]], key=repr)


def test_odd_documents_pass_all_stages(spark, sf_dir, documents, clashing):
    long = " ".join(f"w{i}" for i in range(60_000))
    odd = [(1, None), (1, None), (2, ""), (None, None), (None, "plain words and more of them"), (3, "x" * 50000), (4, "a\n" * 3000), (5, long)]
    docs = clashing(documents(odd), "component_id", "item_id", "length", "row", "group", "place")
    empty = {1: 2, 2: 1}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, sf_dir)
        assert stage(spark, docs.limit(0), sf_dir).count() == 0
        if name == "packing":
            found = after.groupBy("doc_id").agg({"length": "sum"}).collect()
            assert {r["doc_id"] for r in found} == {r[0] for r in odd} and {r["doc_id"]: r[1] for r in found if r["doc_id"] in empty} == empty
            continue
        assert after.columns == docs.columns
        if name != "quality classifier":  # which may reject any of them; no other stage has cause to
            assert sorted(texts(after), key=repr) == sorted(odd, key=repr), name


def test_python_workers_get_bounded_batches(spark, sf_dir, documents):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["size"])

    rows = spark.range(0, 3000, 1, 1).selectExpr("id", "repeat('x', 4000) text")
    for name in set(STAGES) - {"benchmark decontamination"}:  # which has no Python
        spark.conf.unset(ship.BATCH_KEY)
        STAGES[name](spark, documents([(1, "a b c")]), sf_dir)
        assert max(r["size"] for r in rows.mapInArrow(sizes, "size long").collect()) < 5_000_000, name
    spark.conf.set(ship.BATCH_KEY, "2m")
    ship.bound_batches(spark)
    assert spark.conf.get(ship.BATCH_KEY) == "2m"
    spark.conf.unset(ship.BATCH_KEY)


def test_the_run_deletes_what_it_stored(spark, sf_dir):
    below = f"{session.shared_folder(spark).removeprefix('file:')}/hourgrid/{spark.sparkContext.applicationId}"
    before = set(os.listdir(below)) if os.path.isdir(below) else set()
    corpus_pipeline.run(spark, sf_dir)
    (left,) = set(os.listdir(below)) - before
    assert left.startswith("secret-scans")
