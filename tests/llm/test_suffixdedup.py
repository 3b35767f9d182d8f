import hashlib
import random
from collections import Counter

import pytest

from tessera.llm import suffixdedup
from tessera.llm.suffixdedup import COVERS, op4_suffix_dedup, remove_repeats
from tests.llm.helpers import documents, saved, words


def brute(texts, length):
    raws = [(k, (t or "").encode()) for k, t in texts]
    seen = Counter(b[i : i + length] for _, b in raws for i in range(len(b) - length + 1))
    out = []
    for k, b in raws:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((k or 0, len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("period, cover", COVERS)
def test_the_covers_are_perfect_difference_sets(period, cover):
    assert sorted((a - b) % period for a in cover for b in cover if a != b) == list(range(1, period))


def cases(length):
    r, texts = random.Random(3), []
    shared = [words(k, 200)[: length + d] for k, d in enumerate((-1, 0, 1, 7, 40, 150))]
    for k in range(60):
        parts = [words(1000 + k * 10 + n, r.randint(1, 40)) for n in range(3)] + r.sample(shared, 2)
        r.shuffle(parts)
        texts.append((k, "é".join(parts)))
    copy = words(5, 300)
    texts += [(100, copy), (101, copy), (102, "x" + copy), (103, copy[: length]), (104, copy[3 : length + 2]), (110, "ab" * length), (111, None), (112, ""), (113, "z" * (length + 1)), (None, words(9, 30))]
    return texts


def digest(rows):
    return sorted((r["doc_id"] or 0, r["n_bytes"], sum(s["to"] - s["from"] for s in r["removed"]), len(r["removed"]), hashlib.sha256(bytes(r["kept"])).hexdigest()) for r in rows)


@pytest.mark.parametrize("length", [1, 5, 40, 400])
def test_equals_brute_force(spark, tmp_path, length):
    texts = cases(length)
    df = documents(spark, texts)
    if length == 400:
        rows = op4_suffix_dedup(spark, saved(spark, tmp_path, documents=df)).collect()
        got = sorted((r["doc_id"] or 0, r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows)
    else:
        got = digest(remove_repeats(df, length=length).collect())
    assert got == brute(texts, length)


def test_many_buckets_and_blocks(spark, monkeypatch):
    """The blocks' rows come from the buckets that they have keys of, never from all buckets."""
    texts = cases(100) + [(200 + k, t) for k, (_, t) in enumerate(cases(100))]
    expected = brute(texts, 100)
    monkeypatch.setattr(suffixdedup, "BLOCK", 3000)
    monkeypatch.setattr(suffixdedup, "BUCKET", 2000)
    assert digest(remove_repeats(documents(spark, texts).repartition(5), length=100).collect()) == expected


def test_the_work_of_a_block_does_not_grow_with_the_number_of_buckets():
    data = words(3, 3000).encode()
    few, many = (suffixdedup.Block([len(data)], data, {}, {}, 400, bits).deal(1) for bits in (4, 40))
    assert len(list(many.rows())) <= len(many.high) == len(few.high)
    assert [k for b, sent, _ in many.rows() for k in [b]] == sorted(set((many.high >> 24).tolist()))


def test_shared_tells_of_shorter_passages(spark):
    passage, short = words(50, 300)[:267], words(51, 300)[:134]
    texts = [(k, words(60 + k, 100) + (passage if k < 3 else short if k < 6 else "")) for k in range(9)]
    texts.append((9, "ab" * 300))
    rows = {r["doc_id"]: r for r in remove_repeats(documents(spark, texts).repartition(3)).collect()}
    assert [rows[k]["shared"] > 0 for k in range(10)] == [True] * 3 + [False] * 7
    assert [len(rows[k]["removed"]) for k in range(10)] == [0] * 9 + [1]
    assert not [f for f in spark.catalog.listTables() if f.name.startswith("tessera_blocks")]


def test_a_long_text_and_its_part(spark):
    long = words(1, 400_000)
    part = long[700_123:900_456]
    rows = {r["doc_id"]: r for r in remove_repeats(documents(spark, [(1, long), (2, "q" + part + "q")])).collect()}
    assert [(s["from"], s["to"]) for s in rows[2]["removed"]] == [(1, len(part) + 1)] and bytes(rows[2]["kept"]) == b"qq"
    assert [(s["from"], s["to"]) for s in rows[1]["removed"]] == [(700_123, 900_456)]


def test_no_documents(spark, tmp_path):
    assert op4_suffix_dedup(spark, saved(spark, tmp_path, documents=documents(spark, []))).count() == 0
