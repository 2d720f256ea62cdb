from aerocast.llm import lang_id
from helpers import ODD, documents, with_clashes
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = lang_id.fit(docs.where(~held))
    out = lang_id.predict(docs.where(held), model).join(docs, "doc_id").where("length(text) > 100")
    n = out.count()
    assert n > 100 and out.where("lang = lang_pred").count() >= 0.97 * n
    assert out.where("score < 0 or score > 1").count() == 0


def test_edge_cases(spark):
    train = documents(spark, [(i, "the cat and the dog are in the house " * 3, "en") for i in range(5)]
                      + [(9 + i, "die katze und der hund sind im haus " * 3, "de") for i in range(5)])
    model = lang_id.fit(train)
    out = lang_id.predict(with_clashes(documents(spark, [*ODD, (7, "12 34 !?"), (8, "der hund und die katze")])), model)
    rows = [(r.doc_id, r.lang_pred, r.score) for r in out.collect()]
    assert len(rows) == len(ODD) + 2
    assert {(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (7, "und", 0.0)} <= set(rows)
    assert [r[1] for r in rows if r[0] == 8] == ["de"]
    assert lang_id.predict(documents(spark, []), model).count() == 0
    empty = lang_id.fit(documents(spark, []))
    assert [r.lang_pred for r in lang_id.predict(documents(spark, [(1, "abc")]), empty).collect()] == ["und"]


def test_a_filter_answers_for_all_languages_at_once(spark):
    rows = [(i, f"{chr(0x61 + i % 26)}{chr(0x61 + i // 26)}q" * 20, f"l{i:03}") for i in range(70)]
    model = lang_id.fit(documents(spark, rows), min_count=1)
    assert len(model.languages) == 70 and model.masks.shape[0] == 2
    got = {r.doc_id: r.lang_pred for r in lang_id.predict(documents(spark, rows), model).collect()}
    assert sum(got[i] == f"l{i:03}" for i in got) >= 68


def test_three_hundred_labels_and_damaged_ones(spark):
    rows = [(i, f"{chr(0x61 + i % 26)}{chr(0x61 + i // 26)}q" * 20, f"l{i:03}") for i in range(300)]
    model = lang_id.fit(documents(spark, rows), min_count=1)
    assert len(model.languages) == 300 and model.masks.shape[0] == 5
    got = {r.doc_id: r.lang_pred for r in lang_id.predict(documents(spark, rows), model).collect()}
    assert len(got) == 300 and sum(got[i] == f"l{i:03}" for i in got) >= 295
    dirty = [(i, "the cat and the dog are in the house", "en") for i in range(1500)] + [(2000 + i, "zq xv wj kk", f"http://{i}") for i in range(2)]
    model = lang_id.fit(documents(spark, dirty))
    assert model.languages == ["en"]
    assert [r.lang_pred for r in lang_id.predict(documents(spark, dirty[-2:]), model).collect()] == ["en", "en"]


def test_ties_go_to_the_first_name(spark):
    same = "the cat and the dog are in the house " * 3
    model = lang_id.fit(documents(spark, [(i, same, "bb") for i in range(5)] + [(9 + i, same, "aa") for i in range(5)]))
    out = lang_id.predict(documents(spark, [(1, same), (1, same), (2, "the dog")]), model).collect()
    assert [r.lang_pred for r in out] == ["aa"] * 3
