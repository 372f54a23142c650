import numpy as np
from cases import crc, documents, no_documents
from pyspark.sql import functions as F

from tidegauge.llm import language_id as lid
from tidegauge.llm.queries import op6_language_id
from tidegauge.llm.tables import fold


def test_held_out_accuracy(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = op6_language_id(spark, sf_dir).join(docs, "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (crc(r.doc_id) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.98


def test_only_text_and_learning_labels_count(spark, sf_dir):
    """Other labels of held-out rows, other sources and ids of the same folds: the same answers."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    learning = fold("doc_id", 4) != 2
    changed = docs.withColumn("lang", F.when(learning, F.col("lang")).otherwise("xx")).withColumn("source", F.lit("?"))
    key = lambda rows: {r.doc_id: (r.lang_pred, r.score) for r in rows}
    assert key(lid.identify_documents(docs, learning).collect()) == key(lid.identify_documents(changed, learning).collect())


def test_awkward_rows(spark, sf_dir):
    learning = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = lid.learn(learning)
    df = documents(spark)
    rows = df.withColumn("guess", lid.identify(F.col("text"), model)).select("doc_id", "text", "guess.*").collect()
    for r in rows:
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not letters)
        assert r.score == 0 if not letters else 0 < r.score <= 1
    by_id = {r.doc_id: r.lang_pred for r in rows}
    assert (by_id[7], by_id[8], by_id[9]) == ("de", "es", "fr")


def test_stage_keeps_whole_rows_with_letters(spark):
    df = documents(spark)
    kept = lid.known_language(df, F.lit(True))
    assert kept.columns == df.columns
    assert sorted(r.doc_id or 0 for r in kept.collect()) == [-13, 0, 1, 2, 2, 6, 7, 8, 9, 11, 12]


def test_nothing_to_learn(spark):
    empty = lid.identify_documents(no_documents(spark), F.lit(True))
    assert empty.collect() == []
    rows = lid.identify_documents(documents(spark), F.lit(False)).collect()
    assert {(r.lang_pred, r.score) for r in rows} == {("und", 0.0)}


def test_one_language_and_lone_families(spark):
    one = lid.learn(documents(spark, [(1, "some words", "en", "a")]))
    assert lid.predict(one, "other words") == ("en", 1.0)
    rows = [(1, "аб вг деж", "ru", "a"), (2, "some plain words", "en", "a"), (3, "et des mots", "fr", "a"), (4, "x y z", "zz", "a")]
    model = lid.learn(documents(spark, rows))
    assert {m.yes for m in model.families} == {"Slavic", "Germanic", "Romance", "zz"} and not model.pairs
    assert [lid.predict(model, t)[0] for _, t, _, _ in rows] == ["ru", "en", "fr", "zz"]


def test_sample_is_bounded_and_stable(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    a, b = (lid.learn(d, sample=20) for d in (docs, docs.repartition(17)))
    assert [(m.yes, m.no) for m in a.families + a.pairs] == [(m.yes, m.no) for m in b.families + b.pairs]
    assert all((x.weights == y.weights).all() for x, y in zip(a.families, b.families))


def test_copies_neither_thin_the_sample_nor_fill_it(spark, monkeypatch):
    """A language of 300 texts and very many copies of one, beside one without copies."""
    monkeypatch.setattr(lid, "fit", lambda x, langs: ([langs.count(code) for code in ("de", "en")], len(np.unique(x, axis=0))))
    number = F.col("id")
    docs = spark.range(500_000).select(
        F.when(number < 300, "de").otherwise("en").alias("lang"),
        F.when(number < 600, F.concat(F.lit("text "), F.translate(number.cast("string"), "0123456789", "abcdefghij"))).otherwise("hot").alias("text"),
    )
    assert lid.learn(docs) == ([300, 301], 601)
    assert lid.learn(docs, sample=50) == ([50, 50], 100)


def test_texts_without_letters_take_no_place_in_the_sample(spark, monkeypatch):
    """Very many different letterless texts of a language beside 400 good ones: all good ones are used."""
    monkeypatch.setattr(lid, "fit", lambda x, langs: len(langs))
    number = F.col("id")
    digits = F.concat(F.lit("12 "), number.cast("string"), F.lit(" ?!"))
    letters = F.concat(F.lit("è "), F.translate(number.cast("string"), "0123456789", "abcdefghij"))
    docs = spark.range(20_000).select(F.lit("it").alias("lang"), F.when(number < 400, letters).otherwise(digits).alias("text"))
    assert lid.learn(docs) == 400


def test_both_engines_agree_on_letters(spark):
    """One script each of the languages that have a family, marks and digits of other scripts, and none."""
    texts = ["a", "ß", "д", "ლ", "ש", "ع", "क", "த", "ไ", "中", "あ", "한", "ʰ", "ª", "٣", "²", "Ⅷ", "ा", "_", "1", "", " ", "😀", "\u0301", "𐐷"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", F.col("t").rlike(lid.LETTER).alias("has")).collect()
    assert all(r.has == lid.has_letter(r.t) for r in rows)


def test_long_texts_are_read_whole(monkeypatch):
    text = "ab cd " * 5000 + "zzz " * 9000
    whole = lid.features(text)
    monkeypatch.setattr(lid, "BYTES_AT_ONCE", 1000)
    assert (lid.features(text) == whole).all()
