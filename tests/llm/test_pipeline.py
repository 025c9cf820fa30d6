import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from crosswalk.llm import language, toxicity

from . import test_secrets, test_simhash
from .test_packing import check_laws


@pytest.fixture(scope="module")
def folder(data_dir):
    return data_dir.replace("sf0.001", "sf0.01")


def staged(spark, docs, folder):
    """Output of every stage as lists of rows."""
    out = []
    for _, stage in pipeline.STAGES:
        found = stage(spark, docs, folder)
        docs = spark.createDataFrame(found.collect(), found.schema)
        out.append(docs)
    return out


def test_stages_equal_plain_python(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    tox, lang, dedup, clean, packed = staged(spark, docs, folder)
    rows = docs.collect()
    chain = toxicity.fit_chain(docs, labels)
    want = [r for r in rows if not (r.text and toxicity.WORD.search(r.text) and chain.predict(chain.values(r.text))[-1] >= 0.5)]
    assert Counter(tox.collect()) == Counter(want) and 0 < len(want) < len(rows)
    model = language.fit(tox)
    want = [r for r in want if model.predict(r.text)[0] != "und" and model.predict(r.text)[1] >= pipeline.MIN_LANGUAGE_SCORE]
    assert Counter(lang.collect()) == Counter(want)
    groups = test_simhash.plain_result([(r.doc_id, r.text) for r in want])
    first = {g for _, _, g in groups}
    want = [r for r in want if r.doc_id in first]
    assert Counter(dedup.collect()) == Counter(want) and len(want) < lang.count()
    found = test_secrets.plain([r.text for r in want])
    hit = {r.doc_id for r, f in zip(want, found) if f[4]}
    after = {r.doc_id: r for r in clean.collect()}
    for r in want:
        assert (after[r.doc_id] == r) == (r.doc_id not in hit)
    assert hit and all("[SECRET]" in after[i].text and after[i].n_chars == len(after[i].text) for i in hit)
    assert not any(test_secrets.base_spans(r.text) for r in after.values())
    check_laws(packed.collect(), [(r.doc_id, r.text) for r in after.values()], 2048)
    assert len(after) == len(want)


def test_odd_rows_pass_every_stage(spark, odd_docs, no_docs, folder):
    out = staged(spark, odd_docs, folder)
    for df in out[:-1]:
        assert df.columns == odd_docs.columns
    assert {r.doc_id for r in out[1].collect()} == {None, 4, 5, 6, 8, 9}
    kept = out[2].collect()
    assert Counter(r.doc_id for r in kept) == Counter([None, 4, 5, 8, 9])
    check_laws(out[-1].collect(), [(r.doc_id, r.text) for r in kept], 2048)
    for _, stage in pipeline.STAGES:
        assert stage(spark, no_docs, folder).count() == 0


def test_group_without_ids_keeps_one_row(spark, folder):
    docs = spark.createDataFrame([(None, "a b c d e f"), (None, "a b c d e f"), (3, "x y z"), (3, "x y z"), (3, "p q r"), (1, "p q r")], "doc_id long, text string")
    kept = pipeline.drop_near_duplicates(spark, docs, folder).collect()
    assert Counter(map(tuple, kept)) == Counter([(None, "a b c d e f"), (3, "x y z"), (1, "p q r")])


def test_query_runs_all_stages(spark, data_dir):
    from __spark_entry__ import oracle_sql, queries

    rows = queries()["pipeline"](spark, data_dir)
    assert rows.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert rows.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 2048").count() == 0
    assert "pipeline" not in oracle_sql()


@pytest.mark.parametrize("learned", [("de", "en"), ("de", "en", "es", "fr")])
def test_texts_in_no_learned_language_go(spark, folder, learned):
    rnd = random.Random(3)
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang")
    docs = docs.withColumn("true", F.col("lang")).withColumn("lang", F.when(F.col("lang").isin(*learned), F.col("lang")))
    noise = [" ".join("".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 9))) for _ in range(60)) for _ in range(20)]
    polish = "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw są oni obdarzeni rozumem i sumieniem"
    finnish = "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan heille on annettu järki ja omatunto"
    other = [(10**6 + i, text, None, "none") for i, text in enumerate([*noise, polish, finnish])]
    both = docs.unionByName(spark.createDataFrame(other, docs.schema))
    kept = Counter(r.true for r in pipeline.drop_unknown_language(spark, both, folder).collect())
    n = Counter(r.true for r in both.collect())
    assert kept["none"] == 0
    for lang in ("de", "en", "es", "fr"):
        assert kept[lang] >= 0.98 * n[lang] if lang in learned else kept[lang] <= 0.1 * n[lang]
