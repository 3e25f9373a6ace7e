"""The pipeline's stages on planted tables, each and together."""

import random

import pytest

import corpus_pipeline

WORDS = {
    "en": "the house and with from where they stand over there while river morning thought being right water light".split(),
    "de": "das haus und mit von wo sie stehen über dort während fluss morgen gedanke sein recht nicht wasser licht".split(),
}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, lang="en", n=80):
    rng = random.Random(seed)
    words = [f"{rng.choice(WORDS[lang])}{rng.choice(WORDS[lang])}" for _ in range(n)]
    return " ".join(w + ("." if i % 9 == 8 else "") for i, w in enumerate(words))


def planted():
    texts = {i: prose(i, "en" if i % 2 else "de") for i in range(120)}
    item = prose("bench", n=30)
    passage = prose("passage", n=70) + "."
    texts[200] = "7 8 9 --- 10"  # no letter
    texts[201] = None
    texts[202] = "Сегодня утром мы пошли на рынок и купили свежие овощи и фрукты для всей семьи"
    texts[203] = texts[3]  # a copy
    texts[204] = texts[5] + " ende"  # a near copy
    texts[205] = prose("h205") + ". " + passage + " " + prose("t205")
    texts[206] = prose("h206") + ". " + passage + " " + prose("t206")
    texts[207] = prose("h207") + ". " + item + " " + prose("t207")
    words = item.split()
    words[4], words[20] = "other", "changed"
    texts[208] = prose("h208") + ". " + " ".join(words) + " " + prose("t208")
    # Foreign and letterless texts have no language to learn from.
    rows = [(i, t, None if i in (200, 201, 202) else "en" if i % 2 else "de", f"src{i % 3}", len(t or "")) for i, t in texts.items()]
    return rows, [(1, item), (2, None)], passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("planted")
    rows, bench, _ = planted()
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(root / "documents.parquet"))
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(str(root / "benchmark.parquet"))
    return str(root)


def test_stages_take_effect(spark, folder):
    docs, kept = spark.read.parquet(f"{folder}/documents.parquet"), {}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns == columns
        docs = spark.createDataFrame(docs.collect(), SCHEMA)
        kept[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    original = {r[0]: r[1] for r in planted()[0]}
    clean = set(range(120))
    assert clean <= set(kept["language"]) and not {200, 201, 202} & set(kept["language"])
    assert set(kept["language"]) - set(kept["near_duplicates"]) == {203, 204}
    passage = planted()[2]
    cut = kept["substrings"]
    assert set(cut) == set(kept["near_duplicates"])
    assert passage in cut[205] and passage not in cut[206] and cut[206].startswith(prose("h206").rsplit(".", 1)[0])
    assert all(cut[i] == original[i] for i in clean)
    assert set(cut) - set(kept["decontamination"]) == {207, 208}
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert {r["doc_id"] for r in packed} == set(kept["decontamination"])


def test_run_equals_its_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = spark.createDataFrame(rows, docs.schema) if (rows := (docs := stage(spark, docs, folder)).collect()) else docs
    want = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in docs.collect())
    got = sorted((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in corpus_pipeline.run(spark, folder).collect())
    assert sum(g[2] for g in got) == sum(w[2] for w in want) and {g[0] for g in got} == {w[0] for w in want}


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []
