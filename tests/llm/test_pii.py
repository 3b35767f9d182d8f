import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import pii
from tests.llm.helpers import documents, saved, words

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": all(int(p) <= 255 for p in m[0].split(".")) if kind == "ip" else False, "card": 14 <= len(digits) <= 19 and pii.luhn(digits), "phone": 10 <= len(digits) <= 15}[kind]
            if ok:
                out.append((m.start(), m.end(), kind))
    return sorted(out, key=lambda s: (s[0], list(PATTERNS).index(s[2])))


@settings(max_examples=1500, deadline=None)
@given(st.text(alphabet="a.@-+ 0123(é", max_size=60))
def test_base_spans_are_the_patterns_matches(text):
    assert pii.base_spans(text) == plain(text)


def test_long_runs_stay_linear():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1" * 100_000, "a@b" * 60_000):
        pii.base_spans(text)


def test_the_field_finds_what_patterns_miss_and_no_more():
    field = pii.default_field()
    texts = ["please write to eva (at) firm (dot) org about it", "ring (212) 555-8841 at noon", "the host 172[.]16[.]9[.]3 was down", "his card 4012/8888/8888/1881 is lost", words(1, 200), "born 1999-01-02, id 6223346007190433, 3 of 4", "a@b.com and +1 (743) 555-3824 and 10.0.0.1", ""]
    base = [pii.base_spans(t) for t in texts]
    got = pii.added_spans(texts, base, field)
    found = [[(k, t[a:b]) for a, b, k in g] for t, g in zip(texts, got, strict=True)]
    assert found[:4] == [[("email", "eva (at) firm (dot) org")], [("phone", "(212) 555-8841")], [("ip", "172[.]16[.]9[.]3")], [("card", "4012/8888/8888/1881")]]
    assert found[4:] == [[], [], [], []]


def test_viterbi_equals_trying_all_paths():
    import itertools

    field = pii.train(pii.labelled_table(100), steps=5)
    for chain in (["call", "555-201-4432", "now"], ["x"], ["(743)", "555-3824"]):
        e = field.emissions(chain)
        score = lambda p: field.begin[p[0]] + sum(e[t, k] for t, k in enumerate(p)) + sum(field.trans[a, b] for a, b in zip(p, p[1:], strict=False))  # noqa: E731, B023
        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(chain)), key=score)
        assert abs(score(best) - score(field.decode([chain, ["y"] * 5])[0])) < 1e-9


def test_query(spark, tmp_path):
    r = random.Random(1)
    parts = ["a.b@c.de", "10.2.3.4", "300.1.1.1", "4111 1111 1111 1111", "4111 1111 1111 1112", "+1 (743) 555-3824", "+12", "é", "x", "(743) 555-3824"]
    texts = [(k, " ".join(r.choice(parts) for _ in range(8))) for k in range(50)] + [(100, None), (101, ""), (102, words(1, 50_000) + " z@y.xx"), (1, "again a@b.cc"), (None, "a@b.cc")]
    sf = saved(spark, tmp_path, documents=documents(spark, texts))
    joined = lambda spans: ",".join(f"{k}:{a}:{b}" for a, b, k in spans)
    want, got = [], []
    for k, t in texts:
        spans = plain(t or "")
        want.append((k or -1, *[sum(s[2] == x for s in spans) for x in PATTERNS], hashlib.sha256(joined(spans).encode()).hexdigest()))
    for row in pii.op5_pii(spark, sf).collect():
        got.append((row["doc_id"] or -1, row["n_email"], row["n_ip"], row["n_card"], row["n_phone"], row["base_sha256"]))
        assert row["base_sha256"] != hashlib.sha256(b"").hexdigest() or row["n_email"] + row["n_ip"] + row["n_card"] + row["n_phone"] == 0
    assert sorted(got) == sorted(want)
    assert any("phone" in row["spans"] for row in pii.op5_pii(spark, sf).collect())


def test_no_documents(spark, tmp_path):
    assert pii.op5_pii(spark, saved(spark, tmp_path, documents=documents(spark, []))).count() == 0


def test_spelled_out_addresses_are_whole_however_many_dots():
    field = pii.default_field()
    for labels in (2, 3, 5, 12, 60):
        for at, dot in (("(at)", "(dot)"), ("[at]", "[dot]")):
            address = f"anna {at} mail" + "".join(f" {dot} {'example' if k % 2 else 'dept'}" for k in range(labels - 1)) + f" {dot} com"
            for text in (f"write to {address} today", address, f"und der {address}. Die"):
                at_ = text.index(address)
                assert pii.added_spans([text], [pii.base_spans(text)], field)[0] == [(at_, at_ + len(address), "email")], text


def test_neighbours_and_secrets():
    field = pii.default_field()
    found = lambda x: [(k, x[a:b]) for a, b, k in pii.added_spans([x], [pii.base_spans(x)], field)[0]]
    assert found("(212) 555-8841, (718) 555-1234") == [("phone", "(212) 555-8841"), ("phone", "(718) 555-1234")]
    assert found("call 2125558841 now") == [("phone", "2125558841")]
    assert found("order 2125558841 was sent") == []
    key = "9f14a7029c8514dfe98aba92898d2233aabbccdd"
    for text in (f'er token = "{key}" nicht', f'er token = "{key}"### nicht', f'ER!! TOKEN = "{key.upper()}"!! NICHT'):
        assert [(k, s.lower()) for k, s in found(text)] == [("secret", key)]
    assert found(f"commit {key} by me") == []


def test_held_out_carriers():
    """Trained on every second carrier and plain sentence, measured on the others; the figures in the README."""
    field, table = pii.train(pii.labelled_table(part=0)), pii.labelled_table(seed=2, part=1)

    def spans(labels):
        out, k = set(), 0
        while k < len(labels):
            stop = k + 1
            while labels[k][0] == "B" and stop < len(labels) and labels[stop] == "I-" + labels[k][2:]:
                stop += 1
            out |= {(k, stop, labels[k][2:])} if labels[k][0] == "B" else set()
            k = stop
        return out

    right = said = there = 0
    for (_, labels), got in zip(table, field.decode([tokens for tokens, _ in table]), strict=True):
        want, have = spans(labels), spans([pii.LABELS[k] for k in got])
        right, said, there = right + len(want & have), said + len(have), there + len(want)
    print(right / said, right / there)
    assert right / said > 0.85 and right / there > 0.8


def test_a_long_chain_is_decoded_as_any_other(monkeypatch):
    field = pii.train(pii.labelled_table(200), steps=20)
    r = random.Random(4)
    chain = [r.choice(["call", "(212)", "555-8841", "or", "7", "a", "(at)", "b", "(dot)", "com", "10[.]1[.]2[.]3"]) for _ in range(3000)]
    assert field._long(chain, 64).tolist() == field._together([chain])[0].tolist()


def test_a_long_text_of_numbers_needs_little_memory():
    import resource

    r = random.Random(1)
    text = " ".join(str(r.randint(0, 10 ** r.randint(1, 9))) for _ in range(180_000))
    field = pii.default_field()
    before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
    pii.added_spans([text, *["5 apples"] * 511], [[] for _ in range(512)], field)
    assert len(text) > 1_000_000 and resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before < 500 * 1024


def test_clashing_columns_and_repeated_rows(spark):
    rows = spark.createDataFrame([(1, "mail a@b.cc", "x", 2)] * 3 + [(None, None, None, None)], "doc_id long, text string, base string, spans int")
    got = pii.find_pii(rows).collect()
    assert sorted((r["doc_id"] or 0, len(r["base"]), len(r["spans"])) for r in got) == [(0, 0, 0), (1, 1, 1), (1, 1, 1), (1, 1, 1)]
