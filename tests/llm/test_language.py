"""Language identification on planted tables."""

from __future__ import annotations

import random
import zlib

from rostrum.llm import language

WORDS = {
    "en": "the house and with from where they stand over there while river morning thought being right".split(),
    "de": "das haus und mit von wo sie stehen über dort während fluss morgen gedanke sein recht nicht".split(),
}


def text(lang: str, seed: int, n: int = 40) -> str:
    pick = random.Random(f"{lang}{seed}")
    return " ".join(pick.choice(WORDS[lang]) for _ in range(n))


def test_a_language_of_copies_keeps_its_sample(spark):
    rows = [(text("en", i), "en") for i in range(500)]
    rows += [(text("de", 0), "de")] * 9990 + [(text("de", i), "de") for i in range(1, 11)]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    assert model["langs"].count("de") == 4 and model["langs"].count("en") == 4


FOREIGN = (
    "Сегодня утром мы пошли на рынок и купили свежие овощи", "今日は天気がいいので公園に散歩に行きました",
    "xkq zzvw qqjx wvkz xxjq kqzv bbxq jjzk", "zażółć gęślą jaźń pchnąć łódź jeża")


def test_odd_texts_in_the_sample_do_not_open_the_floor(spark):
    rows = [(text(lang, i), lang) for lang in WORDS for i in range(390)]
    rows += [(odd * 2, lang) for lang in WORDS for odd in ("щ", "ß", "q", "λ", "木", "ж")]
    model = language.fit(spark.createDataFrame(rows, "text string, lang string"))
    asked = [*FOREIGN, text("en", 1000), text("de", 1000)]
    docs = spark.createDataFrame([(i, t, None) for i, t in enumerate(asked)], "doc_id long, text string, lang string")
    got = {r["doc_id"]: (r["lang_pred"], r["rejected"]) for r in language.predict(docs, model).collect()}
    assert [got[i][1] for i in range(len(FOREIGN))] == [True] * len(FOREIGN)
    assert [got[i] for i in (len(FOREIGN), len(FOREIGN) + 1)] == [("en", False), ("de", False)]


def test_a_language_without_letters_teaches_nothing(spark):
    docs = spark.createDataFrame([(0, "", "de"), (2, "123", "de"), (3, "the cat sat on the mat", "en"), (5, None, "fr")],
                                 "doc_id long, text string, lang string")
    model = language.fit(docs.select("text", "lang"))
    assert model["langs"] == ["en"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert got == {0: "und", 2: "und", 3: "en", 5: "und"}


def test_cases_of_the_stage(spark):
    rows = [(i, text("en" if i % 2 else "de", i), "en" if i % 2 else "de", "x", 0.5) for i in range(60)]
    rows += [(None, text("en", 1), None, "x", None), (100, None, "en", "x", 1.0), (101, "", "de", None, 1.0), (102, "12 34", None, "x", 1.0),
             (0, text("de", 0), "de", "x", 0.5), (103, text("en", 7, 40_000), "en", "x", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, lang_pred string, score double")
    kept = language.keep_known(docs)
    assert kept.columns == docs.columns
    assert sorted(map(str, (tuple(r) for r in kept.collect()))) == sorted(map(str, (r for r in rows if r[0] not in (100, 101, 102))))
    assert language.keep_known(docs.limit(0)).collect() == []
    # Nothing to learn from: all is rejected.
    assert language.keep_known(docs.withColumn("lang", docs["lang"].substr(100, 1)).where("false")).collect() == []


def test_query_against_held_out_languages(spark, tmp_path):
    rows = [(i, text("en" if i % 2 else "de", i), "en" if i % 2 else "de") for i in range(200)] + [(None, text("en", 3), "en"), (500, "?", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(str(tmp_path / "documents.parquet"))
    got = language.op7_language_id(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for r in got:
        want = "und" if r["doc_id"] == 500 else "en" if r["doc_id"] is None or r["doc_id"] % 2 else "de"
        assert r["lang_pred"] == want and 0 <= r["score"] <= 1
        assert r["held_out"] == (r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
