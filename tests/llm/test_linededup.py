import hashlib
from collections import defaultdict

from pyspark.sql import functions as F

from tessera.llm.linededup import LineRuns, dedup_lines, op6_line_dedup
from tests.llm.helpers import documents, saved, words

BLANK = " \t\n\x0b\x0c\r"


def fold(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(BLANK))


def brute(texts):
    held = defaultdict(list)
    for k, t in texts:
        for key in {fold(x) for x in (t or "").split("\n")}:
            if len(key) >= 40:
                held[key].append(k)
    gone = {key: max(ks) for key, ks in held.items() if len(ks) >= 5}
    out = []
    for k, t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if gone.get(fold(x), k) == k]
        out.append((k, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(out)


def cases():
    often = [words(s, 12) for s in range(4)]
    texts = [(k, "\n".join([words(100 + k, 20), often[k % 4].upper() + " \t", often[0], "short", "", often[0]])) for k in range(40)]
    return texts + [(100, None), (101, ""), (102, "\n\n"), (103, "é" * 40), *[(110 + k, "É" * 40 + "\n" + "é" * 40) for k in range(6)], (200, (words(7, 10) + "\n") * 3000), (201, "a\r\n" * 50)]


def test_query_equals_brute_force(spark, tmp_path):
    sf = saved(spark, tmp_path, documents=documents(spark, cases()))
    got = sorted((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_sha256"]) for r in op6_line_dedup(spark, sf).collect())
    assert got == brute(cases())


def test_other_columns_stay_and_rows_may_repeat(spark):
    line = words(1, 12)
    texts = [(k, line) for k in range(5)] + [(4, line), (None, line), (9, "other"), (9, "other")]
    df = documents(spark, texts).withColumnRenamed("raw", "n_lines")
    out = dedup_lines(df, batches=2)
    assert set(df.columns) < set(out.columns)
    rows = sorted(((r["doc_id"] is not None, r["doc_id"]), r["text"], r["n_dropped"], r["holder"]) for r in out.collect())
    assert len(rows) == len(texts)
    assert [r[1] for r in rows if r[0] == (True, 4)] == [line, line]  # both rows hold the largest doc_id
    assert all(r[1] == "" and r[2] == 1 for r in rows if r[0] in ((False, None), (True, 0), (True, 3)))
    assert {r[3] for r in rows} == {"x"}


def test_no_documents(spark, tmp_path):
    assert op6_line_dedup(spark, saved(spark, tmp_path, documents=documents(spark, []))).count() == 0


def test_batches_do_not_change_the_result(spark):
    df = documents(spark, cases())
    one, many = (sorted(tuple(r) for r in dedup_lines(df, batches=b).select("doc_id", "n_dropped", "text").collect()) for b in (1, 5))
    assert one == many


def test_the_anti_join_decides(spark, monkeypatch):
    """Totals are a start and what raised it; if every batch started its lines anew, lines would not add up."""
    rows = [(k, words(k % 3, 12)) for k in range(12)] + [(20, words(50, 12))]
    df = documents(spark, rows)
    right = sorted((r["doc_id"], r["n_dropped"]) for r in dedup_lines(df, batches=4, min_docs=4).collect())
    assert sum(n for _, n in right) == 9
    monkeypatch.setattr(LineRuns, "_told_apart", lambda self, own: own.withColumn("fresh", F.lit(True)))
    monkeypatch.setattr(LineRuns, "_push", lambda self, run, level: self.levels.append([run]))
    assert sorted((r["doc_id"], r["n_dropped"]) for r in dedup_lines(df, batches=4, min_docs=4).collect()) != right


def test_each_hash_is_started_once(spark):
    runs = LineRuns(spark, fanout=3)
    lines = spark.createDataFrame([(k, [(k % 5, 0), (k % 7, 1)]) for k in range(40)], "id long, h array<struct<a:long,b:long>>")
    for k in range(8):
        runs.add(lines.filter(F.col("id") % 8 == k), "id", "h")
    assert len(runs.levels) > 1
    every = runs._all()
    assert every.filter("fresh").groupBy("a", "b").count().filter("count > 1").count() == 0 and every.filter("fresh").count() == 12
    got = {(r["a"], r["b"]): (r["n_docs"], r["holder"]) for r in runs.totals().collect()}
    assert got == {**{(a, 0): (8, 35 + a) for a in range(5)}, **{(a, 1): (len(range(a, 40, 7)), max(range(a, 40, 7))) for a in range(7)}}


def test_any_names_of_columns(spark):
    df = documents(spark, [(k, words(1, 12)) for k in range(6)]).selectExpr("doc_id", "text", "holder AS __id", "hits AS __of", "raw AS row", "lang AS id", "source AS `a.b`", "n_chars AS gone")
    out = dedup_lines(df)
    assert out.columns == [*df.columns, "n_lines", "n_dropped"] and {(r["__id"], r["__of"], r["row"]) for r in out.collect()} == {("x", 7, "r")}
    assert sorted(r["n_dropped"] for r in out.collect()) == [0, 1, 1, 1, 1, 1]
