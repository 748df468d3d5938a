"""The pipeline's stages against the operators' brute forces, stage by stage."""

import hashlib
import os

import numpy as np
import tiktoken
from pyspark.sql import Row

import corpus_pipeline as cp
from saasmart.llm import language_id, secret_scan, storage
from saasmart.llm.queries import tokenizer
from tests.conftest import SF001
from tests.llm.test_decontaminate import brute as leaks
from tests.llm.test_simhash import fingerprint, smallest_reachable


def test_stages_follow_from_each_other(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    columns = docs.columns
    before = {r.doc_id: r for r in docs.collect()}

    one = cp.known_language(spark, docs, SF001)
    assert one.columns == columns
    got = {r.doc_id: r for r in one.collect()}
    model = language_id.fit(docs, key="doc_id")
    judged = docs.select("doc_id", language_id.predict(model, docs.text).alias("x")).collect()
    assert set(got) == {r.doc_id for r in judged if r.x.accepted} and len(got) > 0.98 * len(before)

    one = spark.createDataFrame(list(got.values()), docs.schema)
    two = cp.one_of_each(spark, one, SF001)
    assert two.columns == columns
    reach = smallest_reachable([(i, fingerprint(r.text)) for i, r in got.items()], 4)
    kept = {r.doc_id: r for r in two.collect()}
    assert set(kept) == {i for i, first in reach.items() if i == first} and len(kept) < len(got)

    two = spark.createDataFrame(list(kept.values()), docs.schema)
    three = cp.no_benchmark(spark, two, SF001)
    assert three.columns == columns
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    bad = {d for d, *_ in leaks([(i, r.text) for i, r in kept.items()], items)}
    clean = {r.doc_id: r for r in three.collect()}
    assert set(clean) == set(kept) - bad and bad

    some = min(clean)  # the smallest tables hold no secret
    clean[some] = Row(**clean[some].asDict() | {"text": clean[some].text + ' token = "f33e61083db5dbdf4bd2369d2f80176e"'})
    three = spark.createDataFrame(list(clean.values()), docs.schema)
    four = cp.no_secrets(spark, three, SF001)
    assert four.columns == columns
    redacted = {r.doc_id: r for r in four.collect()}
    assert set(redacted) == set(clean)
    changed = 0
    for i, r in redacted.items():
        want = secret_scan.redact(clean[i].text, secret_scan.find_secrets(clean[i].text))
        assert r.text == want and r.n_chars == len(want)
        changed += want != clean[i].text
    assert changed

    vocabulary, pattern = tokenizer()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks={t: i for i, t in enumerate(vocabulary)}, special_tokens={})
    five = {r.doc_id: r for r in cp.tokens(spark, four, SF001).collect()}
    assert set(five) == set(redacted)
    for i, r in five.items():
        assert np.frombuffer(bytes(r.ids), "<u4").tolist() == library.encode_ordinary(redacted[i].text)
        assert r.decoded_sha256 == hashlib.sha256(redacted[i].text.encode()).hexdigest()

    whole = {r.doc_id: r.ids_sha256 for r in cp.run(spark, SF001).collect()}
    assert set(whole) == set(five)
    assert {i for i in whole if whole[i] != five[i].ids_sha256} == {some}


def test_odd_rows_extra_columns_and_empty_table(spark, tmp_path):
    text = "the and of to in that " * 12
    rows = [(1, text, "en", "s", 5, "x"), (1, text, "en", "s", 5, "x"), (None, text + "with", "en", "s", 5, "x"), (2, None, None, None, None, None),
            (3, "", "en", None, 0, "x"), (4, text + ' token = "f33e61083db5dbdf4bd2369d2f80176e"' + " of it is" * 30, "en", "s", 5, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, _found string")
    spark.createDataFrame([(1, "nothing like these words at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = cp.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id for r in got), key=str) == [1, 4, None]
    empty = docs.limit(0)
    for _, stage in cp.STAGES:
        empty = stage(spark, empty, str(tmp_path))
        assert empty.count() == 0


def test_rows_of_one_id_with_texts_far_apart_stay(spark):
    far = ["one two three four five six seven eight nine ten", "red green blue white black brown grey pink teal gold"]
    rows = [(1, far[0], "a"), (1, far[1], "b"), (1, far[1], "c"), (2, far[0], "d"), (3, far[1].upper(), "e"), (None, far[0], "f"), (4, None, "g"), (5, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _mark string")
    got = [tuple(r) for r in cp.one_of_each(spark, docs, SF001).collect()]
    assert sorted((str(i), str(t)) for i, t, _ in got) == sorted((str(i), str(t)) for i, t, _ in [rows[0], rows[1], rows[5], rows[6]])
    again = [tuple(r) for r in cp.one_of_each(spark, docs.repartition(5), SF001).collect()]
    assert sorted(got, key=str) == sorted(again, key=str)


def test_tables_of_a_stage_go_with_it(spark):
    with storage.scratch(spark):
        table = storage.cut(spark.range(5), "some")
        files, kept = table.inputFiles(), storage.write(table, "some")
        assert all(os.path.exists(f.removeprefix("file://")) for f in files)
    assert not any(os.path.exists(f.removeprefix("file://")) for f in files)
    assert spark.read.parquet(kept).count() == 5
    assert spark.read.parquet(storage.write(storage.cut(spark.range(3), "some"), "some")).count() == 3
