import random
import zlib

from tessera.llm.langid import _quotas, draw, op3_language_id, predict, train
from tessera.llm.common import Scratch
from tests.llm.helpers import documents, saved

SYLLABLES = {"aa": "ka lo mi ta ru", "bb": "sch ung eit ver tz", "cc": "ção nh lh ões ei"}


def sentence(lang, seed, n=30):
    r = random.Random(f"{lang}{seed}")
    return " ".join("".join(r.choice(SYLLABLES[lang].split()) for _ in range(r.randint(1, 4))) for _ in range(n))


def texts():
    out, langs = [], {}
    for k in range(240):
        lang = sorted(SYLLABLES)[k % 3]
        out.append((k, sentence(lang, k)))
        langs[k] = lang if k % 7 else None
    return out, langs


def test_held_out_accuracy(spark, tmp_path):
    rows, langs = texts()
    odd = [(900, None), (901, ""), (902, "123 ... 45"), (903, "²"), (904, sentence("aa", 5, 50_000)), (905, "x"), (906, "漢字"), (7, rows[7][1]), (None, rows[1][1])]
    sf = saved(spark, tmp_path, documents=documents(spark, rows + odd, langs))
    out = op3_language_id(spark, sf).collect()
    assert len(out) == len(rows) + len(odd)
    got = {r["doc_id"]: r for r in out if r["doc_id"] is not None}
    assert all(r["held_out"] == (zlib.crc32(str(k).encode()) % 3 == 1) for k, r in got.items())
    assert all(0 <= r["score"] <= 1 for r in out)
    held = [k for k, _ in rows if got[k]["held_out"]]
    assert len(held) > 50
    assert sum(got[k]["lang_pred"] == sorted(SYLLABLES)[k % 3] for k in held) >= 0.98 * len(held)
    assert [got[k]["lang_pred"] for k in (900, 901, 902, 903, 904)] == ["und"] * 4 + ["aa"]
    assert got[905]["lang_pred"] in SYLLABLES and got[906]["lang_pred"] in SYLLABLES


def test_unseen_words_back_off_to_grams(spark):
    rows, langs = texts()
    model = train(documents(spark, rows, langs), max_words=5)
    assert model.langs == sorted(SYLLABLES) and len(model.words) <= 15
    for lang in SYLLABLES:
        word = model.word(SYLLABLES[lang].replace(" ", "") + SYLLABLES[lang].split()[1])
        assert model.langs[word.argmax()] == lang


def test_nothing_to_learn_from(spark, tmp_path):
    sf = saved(spark, tmp_path, documents=documents(spark, [(1, "some words"), (2, None)]))
    assert {r["lang_pred"] for r in op3_language_id(spark, sf).collect()} == {"und"}
    assert op3_language_id(spark, saved(spark, tmp_path / "none", documents=documents(spark, []))).count() == 0


def test_columns_with_the_same_names_are_replaced(spark):
    rows, langs = texts()
    df = documents(spark, rows, langs)
    out = predict(df.withColumnRenamed("holder", "score"), train(df, max_docs=50))
    assert out.columns.count("score") == 1 and {r["score"] for r in out.collect()} != {"x"}


def test_draw_keeps_rare_languages_and_takes_equal_texts_once(spark):
    rows = [("aa", sentence("aa", k)) for k in range(400)] + [("bb", sentence("bb", 1))] * 300 + [("bb", sentence("bb", k)) for k in range(100)]
    rows += [("cc", sentence("cc", k)) for k in range(2)] + [("d", sentence("cc", k)) for k in range(1)]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    assert train(df, max_docs=60).langs == ["aa", "bb", "cc", "d"]
    got = [tuple(r) for r in draw(df, Scratch(spark, "t"), 60).collect()]
    assert len(got) == len(set(got)) == 60 and set(got) <= set(rows)
    assert [sum(x == lang for x, _ in got) for lang in ("aa", "bb", "cc", "d")] == [29, 28, 2, 1]
    assert sorted(got) == sorted(tuple(r) for r in draw(df.repartition(3), Scratch(spark, "t"), 60).collect())
    assert _quotas({"a": 5, "b": 9, "c": 9}, 2) == {"a": 1, "b": 1, "c": 1}


def test_the_most_frequent_words_without_sorting_them(spark):
    from tessera.llm.langid import frequent

    rows = [("a", 0, f"w{k}", n) for k, n in enumerate([9, 9, 7, 5, 5, 5, 5, 1, 1, 1])] + [("b", 1, "x", 1)]
    counts = spark.createDataFrame(rows, "lang string, k int, word string, n long")
    assert sorted(r["n"] for r in frequent(counts, {0: 3}, 5).filter("k = 0").collect()) == [7, 9, 9]
    some = frequent(counts, {0: 5}, 5)
    assert sorted(r["n"] for r in some.filter("k = 0").collect())[-3:] == [7, 9, 9] and {r["n"] for r in some.filter("k = 0").collect()} <= {5, 7, 9}
    assert frequent(counts, {0: 50}, 5).count() == 11
    assert "Window" not in some._jdf.queryExecution().executedPlan().toString()


def test_ties_go_to_the_first_language_and_equal_texts_are_equal(spark):
    rows = [(k, "one two three", lang) for k, lang in enumerate(["zz", "aa"] * 20)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert {(r["lang_pred"], round(r["score"], 6)) for r in predict(df, train(df)).collect()} == {("aa", 0.5)}


def test_results_go_back_in_small_pieces_and_whole(spark):
    import numpy as np

    from tessera.llm.langid import LangModel

    model = LangModel(["aa", "bb"], {"one": np.log([0.75, 0.25])}, [{}, {"wo": np.log([0.2, 0.8])}, {"^un": np.log([0.5, 0.25]), "uno": np.log([0.25, 0.25])}, {}, {}])
    assert np.allclose(np.exp(model.word("one")), [0.75, 0.25]) and np.allclose(np.exp(model.word("two")), [0.2, 0.8])
    assert np.allclose(np.exp(model.word("uno")), [2**0.5 / (1 + 2**0.5), 1 / (1 + 2**0.5)]) and np.allclose(np.exp(model.word("x")), 0.5)
    out = predict(spark.range(0, 2_500, 1, 1).selectExpr("id AS doc_id", "'one two' AS text"), model).collect()
    assert sorted(r["doc_id"] for r in out) == list(range(2_500)) and {(r["text"], r["lang_pred"]) for r in out} == {("one two", "bb")}


def test_the_model_is_small_in_each_worker(spark):
    """Executors hold one for every core: the numbers are in one array, and few rows that go along need no Python worker."""
    import pickle
    import tracemalloc

    import numpy as np

    from tessera.llm.langid import LangModel, _small

    words, grams = ({f"{x}{k}": np.log([0.75, 0.25]) for k in range(20_000)} for x in ("word", "gram"))
    sent = pickle.dumps(LangModel(["aa", "bb"], words, [grams] + [{}] * 4))
    tracemalloc.start()
    try:
        model = pickle.loads(sent)
        assert tracemalloc.get_traced_memory()[0] < 160 * 40_000  # bytes a key: 118; an array for each took 208
    finally:
        tracemalloc.stop()
    assert len(model.words) == 20_000 and np.allclose(np.exp(model.word("word7")), [0.75, 0.25])
    few = _small(spark, [("aa", 3)], lang="string", n="int64")
    assert [tuple(r) for r in few.collect()] == [("aa", 3)] and "LocalTableScan" in few._jdf.queryExecution().executedPlan().toString()
    assert _small(spark, [], lang="string").count() == 0
