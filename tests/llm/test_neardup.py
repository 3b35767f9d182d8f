import random

from pyspark.sql import functions as F

from tessera.llm.common import Scratch
from tessera.llm.neardup import components, op2_minhash_near_dedup
from tests.llm.helpers import documents, saved, words


def shingle_set(text):
    w = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").translate(str.maketrans("\t\n\x0b\x0c\r", "     ")).split(" ")
    w = [x for x in w if x]
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts):
    sets = [(k, shingle_set(t)) for k, t in texts]
    top = {k: k for k, _ in texts}

    def find(k):
        while top[k] != k:
            k = top[k]
        return k

    for n, (a, x) in enumerate(sets):
        for b, y in sets[:n]:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                p, q = find(a), find(b)
                top[max(p, q)] = min(p, q)
    return sorted((k, len(s), find(k), find(k) == k) for k, s in sets)


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join("zz%d" % r.randrange(10**6) if r.random() < share else w for w in text.split(" "))


def test_query_equals_brute_force(spark, tmp_path):
    texts, k = [], 0
    for base in range(12):
        t = words(base, 120 + 20 * base)
        for share in (0, 0, 0.01, 0.02, 0.03, 0.05, 0.1):
            texts.append((k, edited(t, share, k)))
            k += 1
    long = words(77, 20_000)
    texts += [(500, None), (501, ""), (502, " \t\n"), (503, "one two"), (504, "One\ttwo"), (505, "one two three"), (506, "a b c d e"), (507, "A b c d e f"), (510, long), (511, long + " end")]
    texts += [(600 + n, "same words in all of these rows here") for n in range(30)] + [(700, "a b c d e f g"), (701, "a b c d e f g")]
    sf = saved(spark, tmp_path, documents=documents(spark, texts))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in op2_minhash_near_dedup(spark, sf).collect())
    assert got == brute(texts)


def test_repeated_rows_and_rows_without_id(spark, tmp_path):
    t = words(1, 60)
    sf = saved(spark, tmp_path, documents=documents(spark, [(3, t), (3, t), (5, t), (None, t), (None, "alone in the world it is")]))
    rows = op2_minhash_near_dedup(spark, sf).collect()
    got = sorted((str(r["doc_id"]), str(r["component_id"]), r["kept"]) for r in rows)
    assert got == [("3", "3", True), ("3", "3", True), ("5", "3", False), ("None", "3", False), ("None", "None", True)]


def test_no_documents(spark, tmp_path):
    assert op2_minhash_near_dedup(spark, saved(spark, tmp_path, documents=documents(spark, []))).count() == 0


def test_components_of_paths_and_stars(spark):
    pairs = [(k, k + 1) for k in range(10, 40)] + [(99, k) for k in range(50, 60)] + [(7, 7), (60, 61), (61, 60)]
    label = components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark, "t"))
    got = {r["node"]: r["comp"] for r in label.collect()}
    assert {got[k] for k in range(10, 41)} == {10} and {got[k] for k in [*range(50, 60), 99]} == {50} and got[61] == 60
    assert label.groupBy("node").count().filter(F.col("count") > 1).count() == 0


def template(k, share=0.82, n=120):
    """Pages of one template: most words are the same in all, in runs, and each page has its own ones between."""
    r, body = random.Random(k), words(1, n, 5000).split(" ")
    own = [f"own{k}x{j}" for j in range(round(n * (1 - share)))]
    at = n // 2
    return " ".join(body[:at] + own + body[at:]) + (f" end{k % 3}" if r.random() < 0.5 else "")


def test_pages_of_a_template_and_copies_among_them(spark, tmp_path):
    texts = [(k, template(k)) for k in range(150)]
    texts += [(200 + k, edited(template(k), 0.01, k)) for k in range(0, 60, 3)] + [(300 + k, template(400 + k, 0.9)) for k in range(40)]
    sf = saved(spark, tmp_path, documents=documents(spark, texts))
    got = sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in op2_minhash_near_dedup(spark, sf).collect())
    assert got == brute(texts) and len({c for _, _, c, _ in got}) > 100


def test_pairs_left_over_are_found_whatever_is_common(spark):
    """All similar pairs of one bucket without any leader, with few and with many common shingles."""
    from tessera.llm.neardup import _left, sketch

    import numpy as np

    r = random.Random(2)
    core = [r.getrandbits(62) for _ in range(400)]
    sets = []
    for k in range(120):
        own = r.sample(core, r.choice([40, 120, 200])) if k % 2 else core[: r.choice([100, 110, 130])]
        sets.append(np.unique(np.array([*own, *[r.getrandbits(62) for _ in range(r.choice([0, 10, 30]))]], np.uint64)))
    sets += [np.unique(np.append(sets[k][2:], np.uint64(k))) for k in range(0, 40, 2)]
    rows = [(7, k, len(s), k, 0, sketch(s)) for k, s in enumerate(sets)]
    mixed = spark.createDataFrame(rows, "key long, rep long, n int, comp long, main long, odd array<long>")
    stored = spark.createDataFrame([(k, bytearray(s.tobytes())) for k, s in enumerate(sets)], "rep long, s binary")
    similar = {(a, b) for b, y in enumerate(sets) for a, x in enumerate(sets[:b]) if 100 * len(np.intersect1d(x, y)) >= 75 * len(np.union1d(x, y))}
    for common in (1, 8, 64, 1000):
        got = {tuple(x) for x in _left(mixed, stored, Scratch(spark, "t"), 75, common).collect()}
        assert similar <= got, common
