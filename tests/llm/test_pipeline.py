import corpus_pipeline as cp
from tests.llm.helpers import documents, saved, words
from tests.llm.test_decontam import brute as leaks
from tests.llm.test_linededup import brute as lines_brute
from tests.llm.test_neardup import brute as near_brute


def tables(spark, path, texts, items=(), labels=()):
    langs = {k: "en" for k, _ in texts}
    return saved(spark, path, documents=documents(spark, texts, langs).withColumnRenamed("holder", "score").withColumnRenamed("raw", "n_lines"), benchmark=spark.createDataFrame(list(items), "item_id long, text string"), labels=spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int"))


def test_stages_against_brute_force(spark, tmp_path):
    item = words(900, 30)
    boiler = words(901, 12)
    copy = words(902, 80)
    texts = [(k, words(k, 60) + "\n" + (boiler if k < 8 else "")) for k in range(30)]
    texts += [(50, copy), (51, copy), (52, copy + " tail"), (60, words(61, 20) + " " + item + " end"), (70, None), (71, "12 34"), (72, boiler), (73, "")]
    sf = tables(spark, tmp_path, texts, [(1, item)], [(k, 1, 0) for k in range(30)])
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in cp.STAGES] == ["language", "lines", "near", "decontaminate", "mixing"]
    want = {k: t for k, t in texts}
    for name, stage in cp.STAGES:
        out = stage(spark, docs, sf)
        if name == "mixing":
            assert {"rate", "copies", "domain", "n_tokens"} < set(out.columns)
            assert {r["doc_id"] for r in out.collect()} == set(want)
            break
        assert out.columns == docs.columns
        if name == "language":
            want = {k: t for k, t in want.items() if k not in (70, 71, 73)}
        elif name == "lines":
            dropped = {r[0]: r[2] for r in lines_brute(list(want.items()))}
            assert sum(dropped.values()) == 8
            want = {k: "\n".join(x for x in t.split("\n") if x != boiler) if dropped[k] else t for k, t in want.items()}
        elif name == "near":
            want = {k: want[k] for k, _, _, kept in near_brute(list(want.items())) if kept}
        elif name == "decontaminate":
            want = {k: want[k] for k, *_, hit in leaks(list(want.items()), [(1, item)]) if not hit}
        rows = out.collect()
        assert {r["doc_id"]: r["text"] for r in rows} == want and {r["score"] for r in rows} == {"x"} and {r["n_lines"] for r in rows} == {"r"}
        docs = cp.Scratch(spark, "t").write(out)
    assert {r["doc_id"] for r in cp.run(spark, sf).collect()} == set(want)


def test_no_documents(spark, tmp_path):
    assert cp.run(spark, tables(spark, tmp_path, [])).count() == 0


def test_near_keeps_one_row_of_each_group_whatever_its_id(spark, tmp_path):
    a, b, c, d = (words(k, 80) for k in (1, 2, 3, 4))
    rows = [(None, a), (7, a), (5, a + " tail"), (None, a + " end")]  # copies with and without id
    rows += [(None, b)] * 20 + [(None, b + " tail")]  # none has an id
    rows += [(9, c), (9, c), (9, c + " tail"), (9, d)]  # one id for copies and for another text
    rows += [(11, words(5, 80)), (None, words(6, 80)), (12, None), (None, ""), (12, None)]
    docs = spark.read.parquet(f"{tables(spark, tmp_path, rows)}/documents.parquet")
    out = cp.near(spark, docs, str(tmp_path))
    assert out.columns == docs.columns
    got = sorted((repr(r["doc_id"]), r["text"] or "") for r in out.collect())
    assert [x for x in got if x[1].startswith(a)] == [("5", a + " tail")]
    assert [x[0] for x in got if x[1].startswith(b)] == ["None"] and [x[0] for x in got if x[1].startswith(c)] == ["9"]
    assert ("9", d) in got and len(got) == 3 + 1 + 2 + 3


def test_odd_rows_at_every_stage(spark, tmp_path):
    """Null ids, repeated rows and ids, long texts, empty texts and clashing names: no stage fails, drops or joins rows that it
    should not."""
    item, long = words(900, 30), words(903, 30_000)
    rows = [(None, words(1, 50)), (None, words(2, 50)), (3, words(3, 50)), (3, words(4, 50)), (5, long), (6, "12 34"), (7, None), (8, ""), (9, "a\n" * 2000), (None, words(5, 20) + " " + item), (3, words(3, 50))]
    sf = tables(spark, tmp_path, rows, [(1, item), (1, item), (None, "x"), (2, None)], [(3, 1, 0), (3, 0, 0), (None, 1, 1)])
    docs = spark.read.parquet(f"{sf}/documents.parquet").selectExpr("*", "hits AS row", "lang AS items", "n_chars AS posterior", "source AS __row")
    sizes = []
    for name, stage in cp.STAGES:
        out = cp.Scratch(spark, "t").write(stage(spark, docs, sf))
        assert set(docs.columns) - {"posterior"} <= set(out.columns), name
        sizes.append(out.count())
        docs = out
    assert sizes[:4] == [8, 8, 7, 6]
    assert {r["row"] for r in docs.collect()} == {7}
