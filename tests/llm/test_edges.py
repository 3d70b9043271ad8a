"""Nulls, empty and very long texts, ties, repeats, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from candlewick.llm import bpe, langid, lm, mixing, quality_rules, simhash, toxicity, wordpiece
from candlewick.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, copies int, n_words int, kept string, size int, fp string, component_id int, n int, lang_pred string"
LONG = "the quick brown fox and it is here " * 20_000
REPEAT = "one two three four five six seven eight nine ten eleven twelve " * 3
ROWS = [
    (1, None, "en", "a"), (2, "", "en", "a"), (3, " \t\n ", None, None), (4, LONG, "en", "b"), (5, REPEAT, "de", "b"),
    (5, REPEAT, "de", "b"), (None, REPEAT, None, None), (6, "123 !!", "en", "a"), (7, "Ünï cödé 你好 <|endoftext|>", None, "c"),
]


def frame(spark, rows):
    return spark.createDataFrame([(*r, None, 0.5, 7, 3, "k", 9, "f", 4, 2, "xx") for r in rows], SCHEMA)


def each(df):
    return df.collect()


@pytest.fixture(params=["rows", "none"])
def docs(spark, request):
    return frame(spark, ROWS if request.param == "rows" else [])


def test_text_operators_return_every_row(docs):
    n = docs.count()
    assert len(each(bpe.with_bpe(docs, tokenizer_path()))) == n
    assert len(each(wordpiece.with_piece_counts(docs, tokenizer_path()))) == n
    assert len(each(quality_rules.judge_quality(docs))) == n
    assert len(each(mixing.mix_sources(docs))) == n
    assert len(each(simhash.simhash_components(docs))) == n
    assert len(each(lm.score_texts(docs, F.coalesce(F.col("doc_id"), F.lit(0)) != 1))) == n
    assert len(each(langid.with_language(docs, langid.learn_profiles(docs)))) == n


def test_bpe_decodes_to_the_text(spark):
    for r in bpe.with_bpe(frame(spark, ROWS), tokenizer_path()).select("text", "__cw_bpe.*").collect():
        assert r.decoded == (r.text or "")
        assert r.n_tokens == (len(r.ids.split(b",")) if r.ids else 0)


def test_quality_of_odd_texts(spark):
    got = {r.doc_id: r for r in quality_rules.judge_quality(frame(spark, ROWS)).collect()}
    assert (got[1].n_words, got[2].n_words, got[3].n_words, got[3].n_lines) == (0, 0, 0, 0)
    assert got[5].n_repeat_words == 36 and got[5].base_failed and not got[5].kept
    assert got[4].n_words == 160_000 and got[4].n_repeat_words == 160_000


def test_language_of_odd_texts(spark):
    docs = frame(spark, ROWS)
    got = {r.doc_id: r["__cw_lang"] for r in langid.with_language(docs, langid.learn_profiles(docs)).collect()}
    assert [got[k].lang_pred for k in (1, 2, 3, 6)] == ["und"] * 4 and got[1].score == 0
    assert got[4].lang_pred == "en" and got[5].lang_pred == "de"


def test_mix_hits_its_targets_and_reruns_agree(spark):
    rows = [(k, "w " * (1 + k % 50), None, f"s{k % 5}" if k % 7 else "s0") for k in range(4000)] + [(None, "w w", None, None)]
    docs = frame(spark, rows)
    first, second = (sorted(map(tuple, mixing.mix_sources(docs).collect()), key=str) for _ in range(2))
    assert first == second
    per = mixing.mix_sources(docs).groupBy("source", "source_size", "target").agg(F.sum(F.col("copies") * F.col("size")).alias("taken"), F.max("copies").alias("most")).collect()
    assert abs(sum(r.target for r in per) - 1.5 * sum(r.source_size for r in per)) < 1e-6
    for r in per:
        assert abs(r.taken - r.target) <= 60 and r.most <= 2
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns
    assert taken.count() == sum(r[-1] for r in first)


def test_larger_weights_only_add_documents(spark):
    docs = frame(spark, [(k, "w " * (k % 9), None, f"s{k % 3}") for k in range(900)])
    small, large = ({r.doc_id: r.copies for r in mixing.mix_sources(docs, budget=b).collect()} for b in (0.6, 0.9))
    assert all(large[k] >= n for k, n in small.items())


def test_pipeline_stages_keep_the_columns(spark, tmp_path):
    rows = ROWS + [(100 + k, f"the number {k} of it and the {'stupid idiot' if k % 4 == 0 else 'good thing'} is here with word{k} again", "en", "a") for k in range(40)]
    docs = spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    for name, data in (("full", docs), ("empty", docs.limit(0))):
        d = str(tmp_path / name)
        data.write.parquet(f"{d}/documents.parquet")
        data.selectExpr("doc_id", "1 as quality", "int(text like '%idiot%') as toxic").where("doc_id >= 100").write.parquet(f"{d}/labels.parquet")
        now = spark.read.parquet(f"{d}/documents.parquet")
        for stage, f in corpus_pipeline.STAGES[:-1]:
            after = f(spark, now, d)
            assert after.columns == now.columns, stage
            now = after
        out = corpus_pipeline.run(spark, d)
        assert out.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        ids = {r.doc_id for r in out.collect()}
        assert not ids & {1, 2, 3, 6}  # no letter
        assert (name == "empty") == (not ids)


def test_toxicity_of_odd_texts(spark):
    docs = frame(spark, ROWS)
    labels = spark.createDataFrame([(4, 0), (5, 1), (99, 1), (None, 1), (6, None)], "doc_id long, toxic int")
    scored = toxicity.with_toxicity(docs, toxicity.learn_toxicity(docs, labels)).collect()
    assert len(scored) == len(ROWS) and all(0 <= r["__cw_toxic"] <= 1 for r in scored)
    nothing = toxicity.learn_toxicity(docs.limit(0), labels)
    assert toxicity.with_toxicity(docs, nothing).where("`__cw_toxic` > 0.5").count() == 0


def test_columns_of_any_name_can_hold_the_text(spark):
    docs = frame(spark, ROWS).withColumnRenamed("text", "my text")
    assert [r["__cw_n_words"] for r in quality_rules.quality_counts(docs.where("doc_id = 5").limit(1), "my text").select("__cw_n_words").collect()] == [36]


def test_url_rules_on_an_empty_table_and_clashing_names(spark):
    from candlewick.llm.url_filter import judge_urls

    schema = "page_id long, url string, html string, n int, bits int, subject string"
    assert judge_urls(spark.createDataFrame([], schema)).count() == 0
    urls = ["http://a.net/x", None, "nothing", "http://a.net/x", "http://x.org/" + "y" * 200_000]
    got = judge_urls(spark.createDataFrame([(k, u, "h", 1, 2, "s") for k, u in enumerate(urls)], schema)).collect()
    assert [r.verdict for r in sorted(got, key=lambda r: r.page_id)] == ["block", "allow", "allow", "block", "allow"]


def test_very_long_texts_and_empty_tables_of_scores(spark):
    long = "stupid things and good words are here " * 30_000
    docs = spark.createDataFrame([(1, long), (2, "x" * 1_000_000), (3, "good day"), (3, "good day")], "doc_id long, text string")
    model = toxicity.learn_toxicity(docs, spark.createDataFrame([(1, 1), (3, 0)], "doc_id long, toxic int"))
    scored = toxicity.with_toxicity(docs, model)
    assert len({r["__cw_toxic"] for r in scored.where("doc_id = 3").collect()}) == 1
    assert toxicity.with_toxicity(docs.limit(0), model).count() == 0
    assert len({r.component_id for r in simhash.simhash_components(docs).collect()}) == 3
    assert {r.doc_id: r["__cw_pieces"].n_words for r in wordpiece.with_piece_counts(docs, tokenizer_path()).collect()} == {1: 210_000, 2: 1, 3: 2}
    assert [r["__cw_bpe"].decoded == r.text for r in bpe.with_bpe(docs, tokenizer_path()).collect()] == [True] * 4
