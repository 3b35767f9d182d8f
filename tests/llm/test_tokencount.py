import base64
import math
import os
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import tokencount as t
from tests.llm.helpers import documents, saved, words


def best(raw, scores):
    """(score, fewest tokens of that score) of a pre-token by itself."""
    out = [(0.0, 0)]
    for end in range(1, len(raw) + 1):
        out.append(max((out[b][0] + scores[raw[b:end]], -(out[b][1] + 1)) for b in range(end) if raw[b:end] in scores))
        out[-1] = (out[-1][0], -out[-1][1])
    return out[-1]


@pytest.fixture(scope="module")
def vocabulary(tmp_path_factory):
    r, pieces = random.Random(1), {bytes([k]) for k in range(200)}
    while len(pieces) < 700:
        pieces.add("".join(r.choice("abcé ") for _ in range(r.randint(2, 5))).encode())
    path = tmp_path_factory.mktemp("v") / "ranks"
    path.write_bytes(b"".join(base64.b64encode(p) + b" %d\n" % k for k, p in enumerate(sorted(pieces))))
    return str(path)


def test_counts_equal_a_search_of_each_pretoken(vocabulary):
    scores = t.load(vocabulary)
    counter = t.TrieCounter(scores, limit=50)

    @settings(max_examples=300, deadline=None)
    @given(st.lists(st.text(alphabet="abcé 1.", max_size=30), max_size=5))
    def check(texts):
        for text, (pre, n) in zip(texts, counter.count(texts), strict=True):
            cut = counter.cut(text)
            assert pre == len(cut) and "".join(cut) == text
            assert n == sum(best(w.encode(), scores)[1] for w in cut)

    check()


def test_query_and_clashing_columns(spark, tmp_path, vocabulary):
    texts = [(1, None), (2, ""), (3, "abc abc"), (3, "abc abc"), (None, "é" * 50), (4, "a" * 5000), (5, words(1, 40_000)), (6, " \n \t")]
    df = documents(spark, texts).withColumnRenamed("holder", "n_tokens")
    out = t.count_tokens(df, vocabulary=vocabulary)
    assert out.columns.count("n_tokens") == 1
    scores = t.load(vocabulary)
    cut = t.TrieCounter(scores).cut
    got = sorted((r["doc_id"] or 0, r["n_pretokens"], r["n_tokens"]) for r in out.collect())
    assert got == sorted((k or 0, len(cut(x or "")), sum(best(w.encode(), scores)[1] for w in cut(x or ""))) for k, x in texts)
    assert t.count_tokens(documents(spark, []), vocabulary=vocabulary).count() == 0


def test_query_with_the_public_vocabulary(spark, tmp_path):
    if not os.path.exists(t.VOCABULARY):
        pytest.skip("no vocabulary here")
    sf = saved(spark, tmp_path, documents=documents(spark, [(1, "hello world"), (2, None)]))
    rows = {r["doc_id"]: (r["n_bytes"], r["n_pretokens"], r["n_tokens"]) for r in t.op10_token_counts(spark, sf).collect()}
    assert rows == {1: (11, 2, 2), 2: (0, 0, 0)}


def test_vocabularies_have_a_bound(tmp_path, monkeypatch):
    monkeypatch.setattr(t, "MOST_PIECES", 1)
    p = tmp_path / "v"
    p.write_bytes(b"YQ== 0\nYg== 1\n")
    with pytest.raises(ValueError):
        t.load(str(p))
    assert math.isfinite(min(t.load(os.devnull).values()))
