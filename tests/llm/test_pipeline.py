import pytest

import corpus_pipeline
from txguard import workspace
from txguard.llm import catalog, decontaminate, jaccard_forest, language, quality

FOLDER = "/root/testdata/sf0.001"


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in catalog.QUERIES) == list(range(1, 14))
    assert set(catalog.ORACLES) <= set(catalog.QUERIES)


def test_stages_and_their_rules(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, outs = docs.columns, [docs]
    for _, stage in corpus_pipeline.STAGES:
        outs.append(workspace.write_table(stage(spark, outs[-1], FOLDER), workspace.new_path(spark, "test")))
    ids = [sorted(r["doc_id"] for r in o.select("doc_id").collect()) for o in outs]
    assert all(o.columns == columns for o in outs[:-1])
    assert all(set(b) <= set(a) for a, b in zip(ids, ids[1:]))

    good = quality.classify(docs, spark.read.parquet(f"{FOLDER}/labels.parquet")).where("predicted = 1")
    assert ids[1] == sorted(r["doc_id"] for r in good.collect())
    known = language.identify(outs[1]).where(f"lang_pred <> 'und' AND score >= {language.MIN_SCORE}")
    assert ids[2] == sorted(r["doc_id"] for r in known.collect())
    assert ids[3] == sorted(r["doc_id"] for r in jaccard_forest.near_duplicates(outs[2]).where("kept").collect())
    clean = decontaminate.scan(outs[3], spark.read.parquet(f"{FOLDER}/benchmark.parquet")).where("NOT contaminated")
    assert ids[4] == sorted(r["doc_id"] for r in clean.collect()) and ids[5] == ids[4]
    assert sorted(r["doc_id"] for r in corpus_pipeline.run(spark, FOLDER).collect()) == ids[5]


@pytest.mark.parametrize("name,stage", corpus_pipeline.STAGES)
def test_stages_take_odd_rows(spark, documents, clashing, name, stage):
    odd = [(1, None), (2, ""), (3, "same text here for both"), (3, "same text here for both"), (None, "a b c"), (5, "x" * 100_000)]
    assert stage(spark, clashing(documents(*odd)), FOLDER).count() <= len(odd)
    assert stage(spark, documents(), FOLDER).count() == 0


def test_the_last_stage_decodes_what_it_encodes(spark, documents):
    import public_tokenizers

    from txguard.llm import bpe

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as file:
        model = bpe.WordBpe(file.read())
    name, stage = corpus_pipeline.STAGES[-1]
    rows = stage(spark, documents((1, "One text, it's 12 words or so."), (2, None), (3, "Größe <|endoftext|> x")), FOLDER).collect()
    assert "decoding" in name and len(rows) == 3
    assert all(r["decoded"] == " ".join(model.text[i] for i in r["ids"]) and r["n_tokens"] == len(r["ids"]) for r in rows)
    assert {r["doc_id"]: r["decoded"] for r in rows}[1].replace("</w>", "").replace(" ", "") == "onetext,it's12wordsorso."


def test_texts_stay_if_no_language_is_learnt(spark):
    docs = spark.createDataFrame([(1, None, "some text"), (2, None, "12."), (3, None, None), (4, None, "слово")], "doc_id long, lang string, text string")
    assert sorted(r["doc_id"] for r in language.keep_known(docs).collect()) == [1, 4]


def test_many_related_languages_lose_no_documents(spark):
    # Twenty languages in five families: the words of a family's four languages are the same.
    words = ["lorem ipsum dolor sit amet", "kaze umi yama kawa sora", "brod hleb voda zemlja nebo", "maji moto nyumba samaki ndege", "tlen xochitl calli cuauhtli"]
    rows = [(n * 20 + k, f"l{k}", " ".join([words[k // 4]] * 3)) for n in range(12) for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    assert language.keep_known(docs).count() == len(rows)
