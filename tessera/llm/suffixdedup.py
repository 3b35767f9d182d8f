"""Exact repeated-substring removal with a difference cover.

A perfect difference set modulo a period P says which positions of a document are sampled: for any two positions i and j
some shift d < P puts both i + d and j + d into the sample. Two equal strings of `length` bytes thus contain two
equal, sampled anchors (ANCHOR bytes), P apart, at the same shift. Four rounds follow, each of the same form: every
block of documents deals its distinct suffix keys to suffix buckets, one bucket is sorted at a time, equal neighbours are
ties, and a bit comes back for each key.

1. Anchors of the cover sample: which occur twice. Only where two of them lie P apart can anything be removed.
2. Sampled suffixes there, by their first `length` bytes: ties settle the inside of long repeats, however long, so that no
   other suffix inside is sorted.
3. Anchors again: has any occurrence a start near it whose string has bytes that are not settled yet?
4. The remaining suffixes near such anchors: the edges of repeats, and what they are equal to.

Where this leaves the classic construction: a bucket is a range of a fingerprint and not of the suffixes' bytes, and
suffixes are sorted by 96 bits of two independent fingerprints of their first `length` bytes, since only equality counts here. So
the cover's ranks serve to rule suffixes out and to settle them, not to compare them pairwise. Bytes are not
compared: of n strings that are sent n**2 / 2**97 pairs are expected to collide. Anchors have 48 bits besides those of
their bucket; a false one costs time only (and may add 1 to `shared`).

Scale: blocks are written once, bucketed by id, in the shared folder, so that texts are never shuffled; a block sends a key
once, so that a passage that a third of all documents share is one entry from each block; a block only makes rows for
buckets that it has keys of. What a round learns is kept as one bit a position, so no round is run twice. Memory is
a bucket (keys of about BUCKET bytes of text), or a block, or the longest document.
"""

from __future__ import annotations

import uuid
from functools import cached_property

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, mix64, spread, table

LENGTH = 400
#: Perfect difference sets by period.
COVERS = (
    (133, (0, 1, 3, 12, 20, 34, 38, 81, 88, 94, 104, 109)),
    (57, (0, 1, 3, 13, 32, 36, 43, 52)),
    (31, (0, 1, 3, 8, 12, 18)),
    (13, (0, 1, 3, 9)),
    (7, (0, 1, 3)),
)
BLOCK, BUCKET, CHUNK = 4 << 20, 8 << 20, 1 << 18
NARROW, WIDE = 6, 12  # bytes of a key that are sent


def cover_for(length: int) -> tuple[int, tuple[int, ...], int]:
    """The period, the cover and the anchors' length for strings of a length: the largest period of which the string has
    room for two and an anchor as long; for very short strings every position, with the string as its own anchor."""
    for period, cover in COVERS:
        if length >= 3 * period:
            return period, cover, length - 2 * period + 1
    return 1, (0,), length


class Prints:
    """Fingerprints of all strings of a length, from prefix sums of byte weights times powers modulo 2**64."""

    def __init__(self, seed: int):
        k = mix64(np.arange(seed * 1000, seed * 1000 + 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        base = (int(k[256]) | 1) & 0xFFFFFFFFFFFFFFF9 | 5
        self.weight = k[:256]
        n = CHUNK + 4096
        with np.errstate(over="ignore"):
            self.up = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, base, np.uint64))])
            self.down = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))])

    def at(self, data: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
        """starts: sorted; every start + length is within data."""
        out, step = np.empty(len(starts), np.uint64), max(1, min(CHUNK, len(self.up) - length - 1))
        cuts = np.searchsorted(starts, np.arange(0, len(data) + step, step))
        with np.errstate(over="ignore"):
            for k in range(len(cuts) - 1):
                lo, hi = cuts[k], cuts[k + 1]
                if lo < hi:
                    begin, stop = int(starts[lo]), int(starts[hi - 1]) + length
                    seg = data[begin:stop]
                    sums = np.zeros(len(seg) + 1, np.uint64)
                    np.cumsum(self.weight[seg] * self.up[: len(seg)], out=sums[1:])
                    s = starts[lo:hi] - begin
                    out[lo:hi] = (sums[s + length] - sums[s]) * self.down[s]
        return mix64(out)


_prints: list[Prints] = []


def _sorted(high: np.ndarray, low: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """The order of keys, and in that order which are the first of their kind."""
    order = np.argsort(high, kind="stable") if low is None else np.lexsort((low, high))
    first = np.ones(len(order), bool)
    h = high[order]
    first[1:] = h[1:] != h[:-1]
    if low is not None:
        v = low[order]
        first[1:] |= v[1:] != v[:-1]
    return order, first


class Dealt:
    """Keys of one block in one round: distinct ones in order, and which of them each start has."""

    def __init__(self, high: np.ndarray, low: np.ndarray | None, bits: int, marked: np.ndarray | None = None, doc: np.ndarray | None = None):
        """bits: of the number of buckets. marked: what to look for instead of a second occurrence: any that is marked.
        doc: the document of each start; then also what occurs in two documents is looked for."""
        order, first = _sorted(high, low)
        at = np.flatnonzero(first)
        kind = np.cumsum(first) - 1
        self.inverse = np.empty(len(order), np.int64)
        self.inverse[order] = kind
        self.high, self.low, self.bits = high[order[at]], None if low is None else low[order[at]], bits
        if marked is None:
            twice = np.diff(np.append(at, len(order))) > 1
        else:
            twice = np.bincount(kind, marked[order], len(at)) > 0
        self.flags = [twice]
        if doc is not None:  # the order is stable: first and last of a kind are its first and last document
            self.flags.append(doc[order[at]] != doc[order[np.append(at[1:], len(order)) - 1]] if len(at) else twice)
        self.bucket = self.high >> np.uint64(64 - bits) if bits else np.zeros(len(at), np.uint64)
        self.cuts = np.concatenate([[0], np.flatnonzero(np.diff(self.bucket)) + 1, [len(at)]]) if len(at) else np.zeros(1, int)

    def rows(self):
        """(bucket, keys, flags) of each bucket that there are keys of."""
        narrow = None if self.low is not None else np.ascontiguousarray((self.high << np.uint64(self.bits)).astype(">u8")).view(np.uint8).reshape(-1, 8)[:, :NARROW]
        for lo, hi in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist(), strict=True):
            sent = self.high[lo:hi].tobytes() + self.low[lo:hi].tobytes() if narrow is None else narrow[lo:hi].tobytes()
            yield int(self.bucket[lo]), sent, b"".join(np.packbits(f[lo:hi]).tobytes() for f in self.flags)

    def told(self, masks: dict[int, bytes]) -> list[np.ndarray]:
        """Of each start, what the buckets say of its key."""
        out = [np.zeros(len(self.high), bool) for _ in self.flags]
        for lo, hi in zip(self.cuts[:-1].tolist(), self.cuts[1:].tolist(), strict=True):
            if mask := masks.get(int(self.bucket[lo])):
                for f, bits in zip(out, _unpacked(mask, hi - lo, len(out)), strict=True):
                    f[lo:hi] = bits
        return [f[self.inverse] if len(f) else f for f in out]


def _unpacked(raw, n: int, kinds: int) -> list[np.ndarray]:
    """The arrays of n bits that were packed one after the other."""
    size = (n + 7) // 8
    got = np.frombuffer(raw, np.uint8)
    return [np.unpackbits(got[k * size : (k + 1) * size], count=n).astype(bool) for k in range(kinds)]


def _joined(starts: np.ndarray, stops: np.ndarray, size: int) -> np.ndarray:
    """True for the bytes of all ranges; starts and stops both ascend, but for empty ranges."""
    some = stops > starts
    starts, stops = starts[some], np.maximum.accumulate(stops[some])
    d = np.zeros(size + 1, np.int8)
    if len(starts):
        new = np.ones(len(starts), bool)
        new[1:] = starts[1:] > stops[:-1]
        d[starts[new]] = 1
        d[stops[np.append(np.flatnonzero(new)[1:] - 1, len(starts) - 1)]] -= 1
    return np.cumsum(d, dtype=np.int8)[:size].astype(bool)


class Block:
    """The documents of a block, back to back, with what earlier rounds told: masks of the last one by bucket, and bits of
    positions of those before."""

    def __init__(self, sizes: list[int], data, masks: dict[int, dict[int, bytes]], states: dict[int, bytes], length: int, bits: int):
        self.data, self.length, self.buckets, self.masks, self.states = np.frombuffer(data, np.uint8), length, bits, masks, states
        self.ends = np.cumsum(np.array(sizes, np.int64))
        self.begins = self.ends - np.array(sizes, np.int64)
        self.period, self.cover, self.anchor = cover_for(length)
        self.learnt: dict[int, bytes] = {}
        if not _prints:
            _prints.extend((Prints(1), Prints(2)))
        p = [np.zeros(0, np.int64)]
        cover = np.array(self.cover, np.int64)
        for a, b in zip(self.begins.tolist(), self.ends.tolist(), strict=True):
            if b - a >= self.anchor:
                x = (np.arange(0, b - a, self.period)[:, None] + cover).reshape(-1)
                p.append(x[: np.searchsorted(x, b - a - self.anchor, side="right")] + a)
        self.sample = np.concatenate(p)
        self.doc = np.searchsorted(self.ends, self.sample, side="right")

    def _wide(self, starts: np.ndarray) -> Dealt:
        high, low = (x.at(self.data, starts, self.length) for x in _prints)
        return Dealt(high, (low >> np.uint64(32)).astype(np.uint32), self.buckets)

    def _told(self, number: int, n: int) -> list[np.ndarray]:
        """Bits of the n positions of a round: kept ones, or from its masks; these are then to be kept."""
        if number in self.states:
            return _unpacked(self.states[number], n, 2 if number == 1 else 1)
        got = self.deal(number).told(self.masks.get(number, {}))
        self.learnt[number] = b"".join(np.packbits(x).tobytes() for x in got)
        return got

    def deal(self, number: int) -> Dealt:
        if number == 1:
            return Dealt(_prints[0].at(self.data, self.sample, self.anchor), None, self.buckets, doc=self.doc)
        if number == 2:
            return self._wide(self.near[2])
        if number == 3:
            return Dealt(_prints[0].at(self.data, self.near[0], self.anchor), None, self.buckets, marked=self.open)
        return self._wide(self.starts)

    @cached_property
    def near(self) -> tuple[np.ndarray, ...]:
        """After round 1: anchors, the range of starts near each (from, to), sampled suffixes to settle, shared anchors."""
        again, shared = self._told(1, len(self.sample))
        if self.period > 1 and len(again):  # what equals in `length` bytes has two equal anchors a period apart
            step, next_ = len(self.cover), np.zeros(len(again), bool)
            next_[:-step] = again[step:] & (self.doc[step:] == self.doc[:-step])
            again = again & next_
        anchors, doc = self.sample[again], self.doc[again]
        begins, last = self.begins[doc], self.ends[doc] - self.length
        first = np.maximum(anchors - self.period + 1, begins)
        # The last string of a document is taken in, so that the end of a whole copy needs no search.
        inner = np.union1d(anchors[anchors <= last], last[last >= begins])
        return anchors, (first, np.maximum(np.minimum(anchors, last) + 1, first)), inner, shared

    @cached_property
    def settled(self) -> np.ndarray:
        """After round 2: the bytes that are known to go."""
        inner = self.near[2]
        sure = inner[self._told(2, len(inner))[0]]
        return _joined(sure, sure + self.length, len(self.data))

    @property
    def open(self) -> np.ndarray:
        """Of each anchor: is there a start near it whose string has bytes that are not settled?"""
        first, stop = self.near[1]
        left = np.concatenate([[0], np.cumsum(~self.settled, dtype=np.int32)])
        starts = np.flatnonzero(_joined(first, stop, len(self.data)))
        some = np.zeros(len(self.data) + 1, np.int32)
        some[starts + 1] = left[starts + self.length] > left[starts]
        some = np.cumsum(some, dtype=np.int32)
        return some[stop] > some[first]

    @cached_property
    def starts(self) -> np.ndarray:
        """After round 3: the other suffixes that must be sorted."""
        first, stop = self.near[1]
        some = self._told(3, len(first))[0]
        return np.flatnonzero(_joined(first[some], stop[some], len(self.data)))

    def removed(self) -> np.ndarray:
        more = self.starts[self._told(4, len(self.starts))[0]]
        return self.settled | _joined(more, more + self.length, len(self.data))

    def shared(self) -> np.ndarray:
        """The number of shared anchors of each document."""
        return np.bincount(self.doc, self.near[3], len(self.ends)).astype(np.int64)


def _blocks(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(block_id, ids, sizes, data): documents back to back in blocks of about BLOCK bytes."""

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        k = (TaskContext.get().partitionId() << 33) if TaskContext.get() else 0
        ids, parts, size = [], [], 0

        def out():
            return pa.RecordBatch.from_arrays([pa.array([k]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(x) for x in parts]], pa.list_(pa.int64())), pa.array([b"".join(parts)], pa.large_binary() if size > 1 << 30 else pa.binary())], names=["block_id", "ids", "sizes", "data"])

        for batch in batches:
            for name, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                raw = cell.as_py() or b""
                if parts and size + len(raw) > BLOCK:
                    yield out()
                    ids, parts, size, k = [], [], 0, k + 1
                ids.append(name)
                parts.append(raw)
                size += len(raw)
        if parts:
            yield out()

    return docs.select(F.col(doc_id).cast("long"), F.col(text).cast("binary")).mapInArrow(run, "block_id long, ids array<long>, sizes array<long>, data binary")


def _loaded(batch, at: int, length: int, bits: int) -> Block:
    masks: dict[int, dict[int, bytes]] = {}
    states: dict[int, bytes] = {}
    if "masks" in batch.schema.names:
        for m in batch.column("masks")[at].as_py() or []:
            if m["bucket"] < 0:
                states[m["round"]] = m["mask"]
            else:
                masks.setdefault(m["round"], {})[m["bucket"]] = m["mask"]
    return Block(batch.column("sizes")[at].as_py(), batch.column("data")[at].as_buffer(), masks, states, length, bits)


def _settle(number: int, keys: list[bytes], flags: list[bytes]) -> list[bytes | None]:
    """Sorts the suffix keys of one bucket; for the keys of each block, which have a tie, as flags are laid out; None where
    none has. The second flag of round 1 tells ties between documents: what two blocks have is in two documents."""
    size = NARROW if number in (1, 3) else WIDE
    n = [len(x) // size for x in keys]
    if size == NARROW:
        wide = np.zeros((sum(n), 8), np.uint8)
        wide[:, :NARROW] = np.frombuffer(b"".join(keys), np.uint8).reshape(-1, NARROW)
        high, low = wide.view(">u8").reshape(-1).astype(np.uint64), None
    else:
        high = np.concatenate([np.frombuffer(x, np.uint64, k) for x, k in zip(keys, n, strict=True)])
        low = np.concatenate([np.frombuffer(x, np.uint32, k, 8 * k) for x, k in zip(keys, n, strict=True)])
    order, first = _sorted(high, low)
    kind = np.cumsum(first) - 1
    kinds = 2 if number == 1 else 1
    had = [np.concatenate(x) for x in zip(*[_unpacked(f, k, kinds) for f, k in zip(flags, n, strict=True)], strict=True)]
    out = []
    for f in had:
        tied = np.bincount(kind, f[order]) > 0
        if number != 3:
            tied |= np.bincount(kind) > 1
        back = np.empty(len(order), bool)
        back[order] = tied[kind]
        out.append(back)
    cuts = np.cumsum([0, *n])
    return [b"".join(np.packbits(f[a:b]).tobytes() for f in out) if any(f[a:b].any() for f in out) else None for a, b in zip(cuts, cuts[1:], strict=False)]


def _round(blocks: DataFrame, number: int, length: int, bits: int) -> DataFrame:
    """(block_id, round, bucket, mask): the masks of one round, and as bucket -1 the bits of the round before."""

    def deal(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                name, block = batch.column("block_id")[at].as_py(), _loaded(batch, at, length, bits)
                rows = list(block.deal(number).rows()) + [(-1 - name, bits_, None) for bits_ in block.learnt.values()]
                for k in range(0, len(rows), 4096):
                    some = rows[k : k + 4096]
                    yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), pa.array([name] * len(some), pa.int64()), pa.array([r[1] for r in some], pa.binary()), pa.array([r[2] for r in some], pa.binary())], names=["bucket", "block_id", "keys", "flags"])

    def settle(key, group):
        import pyarrow as pa

        if key[0].as_py() < 0:
            return pa.table([group.column("block_id"), pa.array([number - 1], pa.int32()), pa.array([-1], pa.int64()), group.column("keys")], names=["block_id", "round", "bucket", "mask"])
        masks = _settle(number, group.column("keys").to_pylist(), group.column("flags").to_pylist())
        n = group.num_rows
        out = pa.table([group.column("block_id"), pa.array([number] * n, pa.int32()), group.column("bucket"), pa.array(masks, pa.binary())], names=["block_id", "round", "bucket", "mask"])
        return out.filter(pa.array([m is not None for m in masks], pa.bool_()))

    dealt = blocks.mapInArrow(deal, "bucket long, block_id long, keys binary, flags binary")
    return dealt.groupBy("bucket").applyInArrow(settle, "block_id long, round int, bucket long, mask binary")


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH) -> DataFrame:
    """One row for each row of docs: doc_id (as long), n_bytes, kept (binary: what remains of the UTF-8 text),
    removed (array of maximal runs of removed bytes, from and to), shared (the number of sampled anchors that another
    row has too).

    A byte goes if a string of `length` bytes over it also starts anywhere else, in another row or in the same, overlaps
    included; all occurrences go, as judged on the input. Null counts as empty; a text shorter than `length` keeps all.
    Rows that repeat an id or a text are documents of their own. Strings never cross from one document to another.
    Other columns of docs, whatever their names, are not returned.

    `shared` tells of shorter passages, which stay: it is above 0 wherever a string of length - period bytes (267 of 400)
    is also in another row, and 0 where no string of an anchor's length (135) is.
    """
    spark = docs.sparkSession
    scratch, name = Scratch(spark, "suffix"), f"tessera_blocks_{uuid.uuid4().hex}"
    total = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    bits = (max(tasks, -(-total // BUCKET)) - 1).bit_length()
    # A table only so that it can be bucketed: its files are in the shared folder, and its name goes at once.
    slots = max(tasks, -(-total // (4 * BLOCK)))
    _blocks(docs, doc_id, text).write.bucketBy(slots, "block_id").option("path", f"{scratch.root}/blocks").saveAsTable(name)
    blocks, masks, told = spark.table(name), None, []
    spark.sql(f"DROP TABLE {name}")
    for number in (1, 2, 3, 4):
        masks = scratch.write(_round(_with(blocks, masks), number, length, bits))
        told.append(masks)
        for before in told[:-1]:
            masks = masks.unionByName(before.filter("bucket < 0"))

    def finish(batches):
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                b = _loaded(batch, at, length, bits)
                gone = b.removed()
                out = {"n": [], "kept": [], "runs": []}
                for lo, hi in zip(b.begins, b.ends, strict=True):
                    mask, data = gone[lo:hi], b.data[lo:hi]
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.view(np.int8), [0]])))
                    out["n"].append(int(hi - lo))
                    out["kept"].append(data[~mask].tobytes() if len(edge) else data.tobytes())
                    out["runs"].append([{"from": int(x), "to": int(y)} for x, y in edge.reshape(-1, 2)])
                span = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
                yield pa.RecordBatch.from_arrays([pa.array(batch.column("ids")[at].as_py(), pa.int64()), pa.array(out["n"], pa.int64()), pa.array(out["kept"], pa.binary()), pa.array(out["runs"], span), pa.array(b.shared())], names=["doc_id", "n_bytes", "kept", "removed", "shared"])

    return _with(blocks, masks).mapInArrow(finish, "doc_id long, n_bytes long, kept binary, removed array<struct<from:long,to:long>>, shared long")


def _with(blocks: DataFrame, masks: DataFrame | None) -> DataFrame:
    """blocks with the masks of their rounds; the blocks stay where they are."""
    if masks is None:
        return blocks
    each = masks.groupBy("block_id").agg(F.collect_list(F.struct("round", "bucket", "mask")).alias("masks"))
    return blocks.join(each.hint("shuffle_hash"), "block_id", "left").select("block_id", "ids", "sizes", "data", "masks")


def op4_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, null texts as empty. n_shared is above 0 for passages of 267 bytes or more (about 45 words)
    that another document has too; such as have less than 400 bytes stay."""
    out = remove_repeats(spread(table(spark, sf_dir, "documents")).select("doc_id", "text"))
    n_removed = F.aggregate("removed", F.lit(0).cast("long"), lambda acc, s: acc + s["to"] - s["from"])
    return out.select("doc_id", "n_bytes", n_removed.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), F.col("shared").alias("n_shared"))
