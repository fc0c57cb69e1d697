"""Every operator on nulls, empty and long texts, ties, repeated rows, empty tables and clashing column names."""

import pytest
from pyspark.sql import functions as F

from stratum.llm import (ads_ann, boosted_toxicity, forest_secrets, icws_dedup, label_prop_shard, line_crf, offset_tokens,
                         qgram_decontam, vector_pack, zstd_langid)

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.tiktoken"))

LONG = "some words go round and round again " * 6000
TEXTS = [None, "", " \n\n ", "!!! ???", "\U0001F642 漢字", "plain words stand here in a row", "plain words stand here in a row",
         LONG, "password=ab12cd34ef56ab78 x", "a" * 5000]
# names that operators use themselves
CLASH = "score long, row string, key string, text_crc32 long, size long, p string, c0 string, samples string, n long"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {CLASH}"


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en" if i % 2 else None, None if i == 3 else "src", None if t is None else len(t)) + (None,) * 9
            for i, t in enumerate(TEXTS)]
    rows += [rows[5], rows[5], (None, "no id here at all", None, None, None) + (None,) * 9]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(5, 1, 0), (3, 0, 1), (None, 1, 1), (7, None, None), (5, 1, 0)], "doc_id long, quality int, toxic int")


def test_quality(docs, nothing, labels):
    model = line_crf.train(docs, labels)
    got = line_crf.classify(docs, model, ["doc_id"]).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 for r in got)
    assert all(r["score"] == 0 for r in got if r["doc_id"] in (0, 1, 2))
    assert len({r["score"] for r in got if r["doc_id"] == 5}) == 1
    assert line_crf.classify(nothing, model, ["doc_id"]).count() == 0
    assert line_crf.train(nothing, labels) is None
    assert {r["score"] for r in line_crf.classify(docs, None, ["doc_id"]).collect()} == {0.0, 0.5}


def test_language(docs, nothing):
    learned = zstd_langid.train_dictionaries(docs, F.lit(True))
    got = {r["doc_id"]: r for r in zstd_langid.identify(docs, learned, ["doc_id"]).collect()}
    assert all(got[i]["lang_pred"] == "und" and got[i]["score"] == 0 and got[i]["rejected"] for i in (0, 1, 2, 3))
    assert got[7]["lang_pred"] == "en"
    assert zstd_langid.identify(docs, {}, ["doc_id"]).where("lang_pred <> 'und'").count() == 0
    assert zstd_langid.train_dictionaries(nothing, F.lit(True)) == {}
    kept = zstd_langid.keep_identified(docs, learned)
    assert kept.columns == docs.columns and kept.where("doc_id < 4").count() == 0 and kept.where("doc_id = 5").count() == 3
    assert zstd_langid.keep_identified(nothing, learned).count() == 0


def test_packing(docs, nothing):
    got = vector_pack.pack(docs, WORD).collect()
    assert sum(r["length"] for r in got if r["doc_id"] == 0) == 1  # the end id alone
    whole = {}
    for r in got:
        whole[r["doc_id"]] = whole.get(r["doc_id"], 0) + r["length"]
    assert whole[5] == 3 * next(r["doc_tokens"] for r in got if r["doc_id"] == 5) and whole[7] > 40000
    assert vector_pack.pack(nothing, WORD).count() == 0
    with pytest.raises(ValueError):
        vector_pack.Packer(vector_pack.Limits(tokens=0), print)


def test_decontamination(spark, docs, nothing):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "short"), (4, LONG[:300]), (4, LONG[:300])], "item_id long, text string")
    got = qgram_decontam.find(docs, bench, ["doc_id"])
    assert {r["doc_id"] for r in got.collect()} == {7} and {r["item_id"] for r in got.collect()} == {4}
    none = bench.where("item_id < 3")
    assert qgram_decontam.find(docs, none, ["doc_id"]).count() == 0 and qgram_decontam.find(nothing, bench, ["doc_id"]).count() == 0
    clean = qgram_decontam.drop_contaminated(docs, bench)
    assert clean.columns == docs.columns and clean.count() == 12
    assert qgram_decontam.drop_contaminated(docs, none).count() == 13


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [float(i % 5 + 1), 1.0, float(i % 3)]) for i in range(1, 60)] + [
        (100, None), (101, [0.0, 0.0, 0.0]), (102, [nan, 1.0, 1.0]), (103, [inf, 1.0, 1.0]), (104, [None, 1.0, 1.0]), (105, [1.0]),
        (None, [1.0, 1.0, 1.0]), (20, [1.0, 1.0, 2.0])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("list", F.lit(1)).withColumn("v", F.lit("x"))
    got = ads_ann.search(v, F.col("vec_id") % 20 == 0).collect()
    assert {r["query_id"] for r in got} == {20, 40} and not {r["vec_id"] for r in got} & set(range(100, 106))
    assert all(r["vec_id"] != r["query_id"] for r in got) and len(got) == 40
    for q in (20, 40):
        mine = sorted((r["rank"], -r["score"], r["vec_id"]) for r in got if r["query_id"] == q)
        assert [m[0] for m in mine] == list(range(1, 21)) and mine == sorted(mine, key=lambda m: m[1:])
    few = ads_ann.search(v.where("vec_id in (20, 1, 2)"), F.col("vec_id") % 20 == 0)
    assert few.count() == 2
    assert ads_ann.search(v.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def test_sharding(docs, nothing):
    got = label_prop_shard.shard(docs, 4).collect()
    assert len(got) == 13 and {r["law"] for r in got} == {"bytes"} and all(0 <= r["shard"] < 4 for r in got)
    assert next(r["size"] for r in got if r["doc_id"] == 0) == 1
    for s in range(4):
        mine = sorted(r["slot"] for r in got if r["shard"] == s)
        assert mine == list(range(len(mine)))
    assert label_prop_shard.shard(nothing).count() == 0


@pytest.mark.parametrize("rule", offset_tokens.RULES)
def test_token_counts(docs, nothing, rule):
    got = offset_tokens.attribute(docs, BYTE, public_tokenizers.PATTERN, ["doc_id"], rule=rule).collect()
    for i in range(len(TEXTS)):
        mine = [r for r in got if r["doc_id"] == i]
        copies = 3 if i == 5 else 1
        assert abs(sum(r["tokens"] for r in mine) - copies * mine[0]["doc_tokens"]) < 1e-6
    assert [r["tokens"] for r in got if r["doc_id"] == 0] == [0]
    assert offset_tokens.attribute(nothing, BYTE, public_tokenizers.PATTERN, ["doc_id"], rule=rule).count() == 0
    fields = offset_tokens.attribute_fields(docs, BYTE, public_tokenizers.PATTERN, ["doc_id"], ["text", "lang"], rule=rule)
    assert {r["field"] for r in fields.collect()} == {"text", "lang"}


def test_near_duplicates(docs, nothing):
    rows, _ = icws_dedup.near_duplicates(docs)
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in rows.collect()}
    assert rows.count() == 13 and got[0] == got[1] == (0, 2)  # null counts as empty
    assert got[5] == got[6] == (5, 4) and got[7] == (7, 1) and got[2] == (2, 1)
    kept = icws_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect()) == [0, 2, 3, 4, 5, 7, 8, 9]
    assert kept.where("doc_id is null").count() == 1
    assert icws_dedup.near_duplicates(nothing)[0].count() == 0 and icws_dedup.keep_one(nothing).count() == 0


def test_secrets(docs, nothing):
    model = forest_secrets.train(docs)
    got = forest_secrets.scan(docs, model, ["doc_id"], path=F.col("source"))
    assert {r["doc_id"] for r in got.collect()} == {8}
    clean = forest_secrets.redact(docs, model, path=F.col("source"))
    assert clean.columns == docs.columns and clean.count() == 13 and clean.where("text is null").count() == 1
    blank = forest_secrets.train(nothing)
    assert blank.forest is None and forest_secrets.scan(docs, blank, ["doc_id"]).where("is_secret").count() == 0
    assert forest_secrets.scan(nothing, model, ["doc_id"]).count() == 0 and forest_secrets.redact(nothing, model).count() == 0


def test_toxicity(docs, nothing, labels):
    model = boosted_toxicity.train(docs, labels)
    got = boosted_toxicity.classify(docs, model, ["doc_id"]).collect()
    assert len(got) == 13 and all(0 <= r["score"] <= 1 for r in got)
    assert boosted_toxicity.classify(nothing, model, ["doc_id"]).count() == 0
    assert boosted_toxicity.train(nothing, labels).trees is None


def test_pipeline_on_odd_rows(spark, docs, nothing, tmp_path):
    import corpus_pipeline

    folder = str(tmp_path)
    docs.select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, LONG[:200])], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert {r["doc_id"] for r in corpus_pipeline.run(spark, folder).collect()} >= {5, 8}
    at = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        at = stage(spark, at, folder)
        assert at.columns == docs.columns
    at = nothing
    for _, stage in corpus_pipeline.STAGES:
        at = stage(spark, at, folder)
        assert at.count() == 0
