from test_ngram_join import brute_components, brute_links
from test_substring import brute

import corpus_pipeline
from boxframe.llm import ngram_join, quality

FOLDER = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").cache()
    good = corpus_pipeline.keep_good(spark, docs, FOLDER).cache()
    kept = {r.row.doc_id for r in quality.quality_rules(docs).filter("kept").collect()}
    assert {r.doc_id for r in good.collect()} == kept and good.columns == docs.columns
    single = corpus_pipeline.drop_similar(spark, good, FOLDER).cache()
    rows = [(r.doc_id, r.text) for r in good.collect()]
    of = brute_components([i for i, _ in rows], brute_links(rows))
    assert {r.doc_id for r in single.collect()} == {i for i, c in of.items() if i == c} and single.columns == docs.columns
    cut = corpus_pipeline.cut_repeats(spark, single, FOLDER).cache()
    rows = sorted((r.doc_id, r.text) for r in single.collect())
    wanted = {i: w[2] for (i, _), w in zip(rows, brute(rows, 50).values(), strict=True)}
    assert {r.doc_id: " ".join(x.decode() for x in r.text.encode().split()) for r in cut.collect()} == wanted
    mixed = corpus_pipeline.mix_sources(spark, cut, FOLDER).cache()
    assert {r.doc_id for r in mixed.collect()} == set(wanted) and mixed.columns == docs.columns
    out = corpus_pipeline.encode(spark, mixed, FOLDER).collect()
    assert len(out) == mixed.count() and all(r.n_pieces == len(r.piece_ids) for r in out)


def test_run_is_its_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "similar", "repeats", "mixing", "pieces"]
    assert corpus_pipeline.run(spark, FOLDER).columns == ["doc_id", "source", "n_pieces", "piece_ids"]
    assert ngram_join.PERCENT == 80 and ngram_join.SHINGLE == 5


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"w{i}" for i in range(60))
    near, other, third = text + " more", " ".join(f"x{i}" for i in range(60)), " ".join(f"y{i}" for i in range(60))
    rows = [(None, text), (7, near), (9, text), (None, text), (3, other), (3, other), (None, third), (None, third), (4, None), (4, "alone")]
    docs = spark.createDataFrame([(i, t, "en", "web", 1) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = corpus_pipeline.drop_similar(spark, docs, FOLDER)
    wanted = [(7, near), (3, other), (None, third), (4, None), (4, "alone")]
    assert got.columns == docs.columns and sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted(wanted, key=str)
