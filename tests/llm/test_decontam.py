import hashlib
import re

from pyspark.sql import functions as F

from tessera.llm.decontam import mark_benchmark, op7_benchmark_decontamination
from tests.llm.helpers import documents, saved, words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def fold(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(texts, items):
    known = {}
    for name, t in items:
        w = fold(t)
        for k in range(max(1, len(w) - 9) if w else 0):
            known.setdefault(tuple(w[k : k + 10]), set()).update([] if name is None else [str(name)])
    out = []
    for k, t in texts:
        w, hit, named = fold(t), set(), set()
        for n in {len(x) for x in known}:
            for i in range(len(w) - n + 1):
                if (key := tuple(w[i : i + n])) in known:
                    hit.update(range(i, i + n))
                    named |= known[key]
        out.append((k or 0, len(w), len(hit), len(named), hashlib.sha256(",".join(sorted(named)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


ITEMS = [(k, words(k, 10 + 7 * k)) for k in range(12)] + [(20, "very short"), (21, "One"), (22, None), (23, "..."), (24, words(3, 31)), (3, "repeated id with some words"), (None, "item without any id at all but words"), (25, "a a a a a a a a a a a a"), (26, "Ünïcode wörter " * 5)]


def cases():
    out = [(k, words(50 + k, 40)) for k in range(20)]
    for k, (_, t) in enumerate(ITEMS):
        w = (t or "").split(" ")
        out.append((100 + k, words(k, 9) + " " + " ".join(w[: len(w) // 2 + 5]).upper() + "!! " + words(k + 5, 9)))
        out.append((200 + k, ", ".join(w)))
    return out + [(300, None), (301, ""), (302, "a " * 15), (303, words(9, 50_000) + " " + words(9, 73)), (304, "very-short"), (200, words(0, 10)), (None, words(0, 10)), (305, words(0, 9))]


def rows_of(df):
    return sorted((r["doc_id"] or 0, r["n_words"], r["n_hit"], r["n_items"], r["items_sha256"], r["contaminated"]) for r in df.collect())


def test_query_equals_brute_force(spark, tmp_path):
    bench = spark.createDataFrame(ITEMS, "item_id long, text string")
    sf = saved(spark, tmp_path, documents=documents(spark, cases()), benchmark=bench)
    assert rows_of(op7_benchmark_decontamination(spark, sf)) == brute(cases(), ITEMS)


def test_blocks_do_not_change_the_result(spark):
    df, bench = documents(spark, cases()), spark.createDataFrame(ITEMS, "item_id long, text string")
    one, many = (sorted(((r["doc_id"] or 0, r["n_words"], str(r["hits"]), r["items"], r["raw"]) for r in mark_benchmark(df, bench, block_words=n).collect()), key=str) for n in (500_000, 60))
    assert one == many


def test_empty_tables_and_clashing_columns(spark, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    sf = saved(spark, tmp_path, documents=documents(spark, []), benchmark=none)
    assert op7_benchmark_decontamination(spark, sf).count() == 0
    out = mark_benchmark(documents(spark, [(1, "x y")]), none)
    assert out.select("n_words", F.size("hits").alias("h"), "holder").collect()[0] == (2, 0, "x")
