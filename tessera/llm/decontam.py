"""Benchmark decontamination as a prefix-filtered containment join.

Item windows are sets of word shingles that a document must contain whole and in order. With containment of 1 the
necessary prefix of a window is a single shingle, and the rarest one makes the fewest candidates. So a first pass over
all documents counts the benchmark's shingles there; a window whose rarest shingle occurs nowhere is done with. A
second pass joins documents on the rarest shingles, puts the window where the shingle's position says it must start, drops
it if it would stick out of the document (length and position bounds), and compares the words themselves.

The benchmark is taken in blocks of at most `block_words` words, which is what is sent to the executors at a time; the
documents never move. Memory: a batch of documents and one block.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordIds, shingle_hashes, spread, table, unused

WINDOW, WIDTH = 10, 5
#: Maps A-Z to a-z and all bytes that are in no word to blanks.
FOLD = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
HITS = "array<struct<from:int,to:int>>"


def words_of(raw: bytes | None) -> list[bytes]:
    return (raw or b"").translate(FOLD).split()


class Windows:
    """The windows of one block of items. window[k]: words; items[k]: ids as text; widths: shingle widths in use."""

    def __init__(self, items: list[tuple[str | None, bytes | None]], size: int = WINDOW):
        known: dict[tuple, set] = {}
        for name, raw in items:
            w = words_of(raw)
            for k in range(max(1, len(w) - size + 1) if w else 0):
                known.setdefault(tuple(w[k : k + size]), set()).update([] if name is None else [name])
        self.window = [list(k) for k in known]
        self.items = [sorted(v) for v in known.values()]
        self.widths = sorted({min(WIDTH, len(w)) for w in self.window})
        ids = WordIds()
        self.tokens = [shingle_hashes(ids.array(w), min(WIDTH, len(w))) for w in self.window]
        self.all = {k: np.unique(np.concatenate([t for t, w in zip(self.tokens, self.window, strict=True) if min(WIDTH, len(w)) == k])) for k in self.widths}

    def prefixes(self, counts: dict[int, int]) -> dict[int, tuple[np.ndarray, list]]:
        """By shingle width: the sorted rarest tokens, and of each the windows and offsets it stands for."""
        out: dict[int, dict[int, list]] = {k: {} for k in self.widths}
        for n, (t, w) in enumerate(zip(self.tokens, self.window, strict=True)):
            often = [counts.get(int(x), 0) for x in t.view(np.int64)]
            if min(often):
                at = int(np.argmin(often))
                out[min(WIDTH, len(w))].setdefault(int(t[at]), []).append((n, at))
        return {k: (np.array(sorted(v), np.uint64), [v[x] for x in sorted(v)]) for k, v in out.items() if v}


def _found(tokens: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in hashes that have one of the sorted tokens, and which."""
    if not len(tokens) or not len(hashes):
        return np.zeros(0, int), np.zeros(0, int)
    k = np.minimum(np.searchsorted(tokens, hashes), len(tokens) - 1)
    at = np.flatnonzero(tokens[k] == hashes)
    return at, k[at]


def _rarity(docs: DataFrame, text: str, block: Windows) -> dict[int, int]:
    """How often all documents have each shingle of the block."""
    every = block.all

    def run(batches):
        import pyarrow as pa

        ids, sums = WordIds(), {k: np.zeros(len(t), np.int64) for k, t in every.items()}
        for batch in batches:
            for cell in batch.column(0):
                w = ids.array(words_of(cell.as_py()))
                for k, t in every.items():
                    at, which = _found(t, shingle_hashes(w, k))
                    np.add.at(sums[k], which, 1)
        for k, t in every.items():
            some = np.flatnonzero(sums[k])
            yield pa.RecordBatch.from_arrays([pa.array(t[some].view(np.int64)), pa.array(sums[k][some])], names=["t", "c"])

    rows = docs.select(F.col(text).cast("binary")).mapInArrow(run, "t long, c long").groupBy("t").agg(F.sum("c").alias("c")).collect()  # as many as a block has shingles, at most
    return {r["t"]: r["c"] for r in rows}


def _marked(docs: DataFrame, text: str, block: Windows, counts: dict[int, int], names: list[str]) -> DataFrame:
    """docs with the number of words, the hits and the items, under three names."""
    prefixes, window, items = block.prefixes(counts), block.window, block.items
    at_text = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        ids = WordIds()
        for batch in batches:
            n_words, hits, named = [], [], []
            for cell in batch.column(at_text):
                raw = cell.as_py()
                words = words_of(raw.encode() if isinstance(raw, str) else raw)
                spans, got = [], set()
                hashed = ids.array(words)
                for k, (tokens, stands_for) in prefixes.items():
                    for at, which in zip(*_found(tokens, shingle_hashes(hashed, k)), strict=True):
                        for n, offset in stands_for[which]:
                            start = int(at) - offset
                            if 0 <= start <= len(words) - len(window[n]) and words[start : start + len(window[n])] == window[n]:
                                spans.append((start, start + len(window[n])))
                                got.update(items[n])
                merged: list[dict] = []
                for a, b in sorted(spans):
                    if merged and a <= merged[-1]["to"]:
                        merged[-1]["to"] = max(b, merged[-1]["to"])
                    else:
                        merged.append({"from": a, "to": b})
                n_words.append(len(words))
                hits.append(merged)
                named.append(sorted(got))
            span = pa.list_(pa.struct([("from", pa.int32()), ("to", pa.int32())]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_words, pa.int64()), pa.array(hits, span), pa.array(named, pa.list_(pa.string()))], names=[*batch.schema.names, *names])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], f"{names[0]} long", f"{names[1]} {HITS}", f"{names[2]} array<string>"])
    return docs.mapInArrow(run, schema)


def mark_benchmark(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_words: int = 500_000) -> DataFrame:
    """docs with n_words, hits (maximal runs of hit words) and items (ids, as sorted text, of items with a window in it).

    A window is `window` consecutive words of an item, or all words of a shorter one; an item without words has none.
    Words are runs of a-z, 0-9 and everything that is not ASCII, after A-Z became a-z. A null text has no words; an item
    without id is searched but not named; rows that repeat an id are one item. Columns of docs with these three names are
    replaced, others stay as they are. An empty benchmark hits nothing.
    """
    scratch = Scratch(docs.sparkSession, "decontam")
    docs = docs.drop("n_words", "hits", "items")
    few = benchmark.select(F.col(item_id).cast("string").alias("name"), F.col(item_text).cast("binary").alias("raw")).distinct()
    total = few.agg(F.sum(F.octet_length("raw"))).first()[0] or 0
    blocks = max(1, -(-int(total) // (6 * block_words)))
    names, out = unused(docs, "n_", "hits_", "items_"), None
    for k in range(blocks):
        part = few.filter(F.pmod(F.xxhash64("name", "raw"), F.lit(blocks)) == k) if blocks > 1 else few
        block = Windows([(r["name"], bytes(r["raw"]) if r["raw"] is not None else None) for r in part.collect()], window)
        counts = _rarity(docs, text, block) if block.window else {}
        one = _marked(docs if out is None else out, text, block, counts, names)
        if out is not None:
            both = F.array_sort(F.concat("hits", names[1]))
            one = one.withColumns({"hits": _united(both), "items": F.array_sort(F.array_union("items", names[2]))}).drop(*names)
        else:
            one = one.withColumnsRenamed(dict(zip(names, ("n_words", "hits", "items"), strict=True)))
        out = scratch.write(one) if k < blocks - 1 else one
    return out


def _united(spans):
    """Sorted spans with those that touch made one."""
    empty = F.array().cast("array<struct<from:int,to:int>>")

    def step(acc, s):
        last = F.element_at(acc, -1)
        joined = F.concat(F.slice(acc, 1, F.size(acc) - 1), F.array(F.struct(last["from"].alias("from"), F.greatest(last["to"], s["to"]).alias("to"))))
        return F.when((F.size(acc) > 0) & (F.try_element_at(acc, F.lit(-1))["to"] >= s["from"]), joined).otherwise(F.concat(acc, F.array(s)))

    return F.aggregate(spans, empty, step)


def n_hit(hits: str = "hits"):
    return F.aggregate(hits, F.lit(0).cast("long"), lambda acc, s: acc + s["to"] - s["from"])


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every row of documents against every item of benchmark."""
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    out = mark_benchmark(docs, table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", n_hit().alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


OP7_SQL = r"""
WITH doc AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n, array_to_string(w[i:i + 9], ' ') AS s
  FROM (SELECT item_id, w, unnest(generate_series(1, greatest(least(len(w), 1), len(w) - 9))) AS i FROM item)),
sizes AS (SELECT DISTINCT n FROM win),
place AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM doc, sizes)),
hit AS (SELECT doc_id, i, place.n, item_id FROM place JOIN win USING (n, s)),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
named AS (SELECT doc_id, count(*) AS n_items, string_agg(t, ',' ORDER BY t) AS t FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS t FROM hit) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(t, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""
