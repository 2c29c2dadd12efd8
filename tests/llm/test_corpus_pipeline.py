import corpus_pipeline
from awkward import documents
from tokenizers import Tokenizer

from barlake.llm.queries import vocabulary

FOLDER = "/root/testdata/sf0.001"


def test_stages_in_order_keep_the_columns_and_their_decisions_hold(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "substring_dedup", "mix_sources", "bpe"]
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        from barlake.llm import workers
        out = workers.keep(stage(spark, docs, FOLDER), name)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)
        if name in ("quality_classifier", "simhash_near_dedup"):
            assert out.exceptAll(docs).count() == 0 and 0 < out.count() < before
        if name == "substring_dedup":
            assert out.count() == docs.count()
        docs, before = out, out.count()
    tok = Tokenizer.from_file(vocabulary())
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    texts = sorted(tuple(tok.encode(r.text or "", add_special_tokens=False).ids) for r in docs.collect())
    assert sorted(tuple(r.ids) for r in rows) == texts and all(r.n_tokens == len(r.ids) for r in rows)
    assert sorted(tuple(r.ids) for r in corpus_pipeline.run(spark, FOLDER).collect()) == texts


def test_stages_take_awkward_and_empty_tables(spark):
    for docs in (documents(spark), documents(spark, [])):
        for name, stage in corpus_pipeline.STAGES[1:]:
            out = stage(spark, docs, FOLDER)
            assert out.columns == docs.columns if name != "bpe" else "ids" in out.columns
            out.count()
