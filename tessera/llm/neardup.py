"""MinHash near-dedup with tensored banding.

Two small collections of `sides` values each are computed for a document, each value made of two minhashes (4 * sides
minhashes in all). The table keys are all pairs of a left and a right value: sides**2 tables of four minhashes each for
the price of the square root of that many. Two documents of similarity J meet in some table with probability
(1 - (1 - J**2)**sides)**2: 0.9999 at J = 0.75 and 0.99999 at 0.8 for 12 sides. Every candidate is confirmed on the full
sets of 5-word shingles before it becomes a link.

How it scales: documents with equal sets are one representative from the start. A left or right value that only one
representative has can meet nobody, so it is dropped before pairs of values are made. In a bucket each member is
first held against one leader only, and links are contracted to components; then those outside the bucket's largest component
against further members of that. What remains are pairs across components, found by their full sets (`_left`): with
shingles ordered by rarity, two similar sets share one in their prefixes, and if none of these is held by COMMON members or fewer,
all that they share is common shingles, of which both must have enough. So many documents that share a large part but
not enough of it, as pages of one template do, are not compared with each other. A sketch of each set (the parities of its shingles in 1024
classes) bounds from below how far two sets differ, and rules out most pairs before sets are read. So a group of n near
copies costs about n comparisons, and nothing is capped or dropped. Intermediate tables live in the shared folder;
components are found by repeated contraction on the executors.
"""

from __future__ import annotations

from functools import cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, WordIds, mix64, shingle_hashes, spread, table

WIDTH, SIMILAR, SIDES = 5, 75, 12
#: Further leaders of a bucket before all pairs across its components are compared, and bits of a set's sketch.
LEADERS, ODD = 2, 1024
#: Shingles of more members than this are common ones.
COMMON = 64
SIGNATURE = "doc_id long, n_shingles long, s1 long, s2 long, left array<long>, right array<long>, odd array<long>"


def shingles(raw: bytes | None, ids: WordIds) -> np.ndarray:
    """The set of a document as sorted distinct 64-bit hashes: of its 5-word shingles, of all its words together if
    it has fewer, of nothing if it has none. Words are separated by ASCII white space; A-Z count as a-z."""
    words = (raw or b"").lower().split()
    hashed = ids.array(words)
    return np.unique(shingle_hashes(hashed, min(WIDTH, len(words))))


@cache
def _seeds(sides: int) -> tuple[np.ndarray, np.ndarray]:
    k = mix64(np.arange(1, 8 * sides + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return k[: 4 * sides, None], k[4 * sides :, None] | np.uint64(1)


def minhashes(hashes: np.ndarray, sides: int) -> np.ndarray:
    """2 * sides values of two minhashes each; the first half is the left collection."""
    add, times = _seeds(sides)
    low = np.full(4 * sides, np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(hashes), 1024):  # small enough for a core's cache
            x = hashes[None, k : k + 1024] ^ add
            x *= times
            np.minimum(low, x.min(1), out=low)
        return mix64(mix64(low[0::2]) + low[1::2])


def sketch(hashes: np.ndarray) -> list[int]:
    """The parity of the number of hashes in each of ODD classes, packed into longs."""
    odd = np.bincount((hashes >> np.uint64(7)) % np.uint64(ODD), minlength=ODD) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def signatures(docs: DataFrame, doc_id: str, text: str, sides: int = SIDES) -> DataFrame:
    def run(batches):
        import pyarrow as pa
        import xxhash

        ids = WordIds()
        signed = lambda x: int(np.uint64(x).view(np.int64))
        for batch in batches:
            rows = {k: [] for k in ("n", "s1", "s2", "left", "right", "odd")}
            for cell in batch.column(1):
                s = shingles(cell.as_py(), ids)
                whole = xxhash.xxh3_128_intdigest(s.tobytes())
                both = minhashes(s, sides).view(np.int64).tolist() if len(s) else []
                for k, v in (("n", len(s)), ("s1", signed(whole >> 64)), ("s2", signed(whole & (1 << 64) - 1)), ("left", both[:sides]), ("right", both[sides:]), ("odd", sketch(s))):
                    rows[k].append(v)
            long, longs = pa.int64(), pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(v, longs if k in ("left", "right", "odd") else long) for k, v in rows.items()]], names=["doc_id", "n_shingles", "s1", "s2", "left", "right", "odd"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("raw")).mapInArrow(run, SIGNATURE)


def _sizes_fit(n, m, similar: int):
    return F.least(n, m) * 100 >= F.greatest(n, m) * similar


def components(links: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, comp) for every node of links (a, b): the smallest node that it reaches. Each round hooks every node to
    its smallest neighbour, follows one more step, and contracts; the driver only learns whether links are left."""
    edges = scratch.write(links.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    label = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("up"))
        up = up.join(up.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", "top")
        up = scratch.write(up)
        to = up.select(F.col("node").alias("comp"), "top")
        label = up.withColumnRenamed("top", "comp") if label is None else label.join(to, "comp", "left").select("node", F.coalesce("top", "comp").alias("comp"))
        label = scratch.write(label)
        a, b = up.select(F.col("node").alias("a"), F.col("top").alias("ta")), up.select(F.col("node").alias("b"), F.col("top").alias("tb"))
        next_ = edges.join(a, "a").join(b, "b").filter("ta <> tb").select(F.least("ta", "tb").alias("a"), F.greatest("ta", "tb").alias("b")).distinct()
        edges = scratch.write(next_)
        if edges.isEmpty():
            return label


def _confirm(pairs: DataFrame, sets: DataFrame, similar: int) -> DataFrame:
    """Those pairs (a, b) whose full sets are similar enough."""
    one, two = sets.select(F.col("rep").alias("a"), F.col("s").alias("sa")), sets.select(F.col("rep").alias("b"), F.col("s").alias("sb"))

    def run(batches):
        import pyarrow as pa

        last, held = None, None
        for batch in batches:
            keep = []
            for a, x, y in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if a != last:
                    last, held = a, np.frombuffer(x.as_buffer(), np.uint64)
                other = np.frombuffer(y.as_buffer(), np.uint64)
                small, large = (held, other) if len(held) <= len(other) else (other, held)
                at = np.searchsorted(large, small)
                common = int((large[np.minimum(at, len(large) - 1)] == small).sum()) if len(large) else 0
                keep.append(100 * common >= similar * (len(held) + len(other) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return pairs.join(two, "b").join(one, "a").select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def _sets(docs: DataFrame, doc_id: str, text: str, wanted: DataFrame) -> DataFrame:
    """(rep, s) with the full set, as little-endian bytes, of each wanted document."""

    def run(batches):
        import pyarrow as pa

        ids = WordIds()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([shingles(x.as_py(), ids).tobytes() for x in batch.column(1)], pa.binary())], names=["rep", "s"])

    have = docs.select(F.col(doc_id).cast("long").alias("rep"), F.col(text).cast("binary").alias("raw"))
    return have.join(wanted, "rep").mapInArrow(run, "rep long, s binary")


def _apart(x, y, n, m, similar: int):
    """True where the sketches prove that two sets are not similar: each shingle that only one set has flips one bit."""
    bits = F.lit(0)
    for k in range(ODD // 64):
        bits = bits + F.bit_count(F.get(x, F.lit(k)).bitwiseXOR(F.get(y, F.lit(k))))
    return bits * (100 + similar) > (n + m) * (100 - similar)


def _main(placed: DataFrame) -> DataFrame:
    """Of buckets with several components: the one with the most members (then the largest)."""
    each = placed.groupBy("key", "comp").agg(F.count("*").alias("c")).groupBy("key").agg(F.max(F.struct("c", "comp")).alias("m"), F.count("*").alias("k"))
    return each.filter("k > 1").select("key", F.col("m.comp").alias("main"))


def _minor(mixed: DataFrame) -> DataFrame:
    return mixed.filter("comp <> main").select("key", F.col("rep").alias("rep2"), F.col("n").alias("n2"), F.col("comp").alias("comp2"), F.col("odd").alias("odd2"))


def _met(mixed: DataFrame, others: DataFrame, similar: int, also=True) -> DataFrame:
    """Pairs of different components in a bucket that their sizes, their sketches and a further condition let be similar."""
    may = F.lit(True) & also & (F.col("comp") != F.col("comp2")) & _sizes_fit(F.col("n"), F.col("n2"), similar) & ~_apart(F.col("odd"), F.col("odd2"), F.col("n"), F.col("n2"), similar)
    return mixed.join(others, "key").filter(may).select(F.least("rep", "rep2").alias("a"), F.greatest("rep", "rep2").alias("b")).distinct()


def _shingles_of(members: DataFrame, sets: DataFrame) -> DataFrame:
    """(rep, t): the shingles of each member, one in a row."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            for rep, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                t = np.frombuffer(cell.as_buffer(), np.int64)
                for k in range(0, len(t), 1 << 16):
                    some = t[k : k + (1 << 16)]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), rep, np.int64)), pa.array(some)], names=["rep", "t"])

    return sets.join(members.select("rep"), "rep").select("rep", "s").mapInArrow(run, "rep long, t long")


def _left(mixed: DataFrame, sets: DataFrame, scratch: Scratch, similar: int, common: int = COMMON) -> DataFrame:
    """Pairs (a, b) of different components that may be similar: all such pairs of a bucket, and maybe others.

    Shingles are ordered by the number c of members that hold them. A set of n shingles shares one of its first
    n - ceil(similar * n / 100) + 1 with every similar set; those that nobody else holds come first and pair with nobody. If the
    first that two sets share has c <= common, the join over such prefix shingles finds the pair. Else all that they share
    is common; then both must hold as many common shingles as the similarity asks for.
    """
    members = scratch.write(mixed.select("rep", "n", "comp", "odd").dropDuplicates(["rep"]))
    held = scratch.write(_shingles_of(members, sets))
    often = held.groupBy("t").agg(F.count("*").alias("c")).filter("c > 1")
    each = held.join(often, "t").groupBy("rep").agg(F.array_sort(F.collect_list(F.struct("c", "t"))).alias("ts"))
    free = F.floor(F.col("n") * (100 - similar) / 100) + 1 - (F.col("n") - F.size("ts"))  # places of the prefix after those of own shingles
    known = members.join(each, "rep").select("rep", "n", "comp", "odd", F.size(F.filter("ts", lambda x: x.c > common)).alias("many"), F.filter(F.slice("ts", F.lit(1), F.greatest(F.lit(0), free).cast("int")), lambda x: x.c <= common).alias("rare"))
    known = scratch.write(known)
    one = known.select("rep", "n", "comp", "odd", F.explode("rare.t").alias("t"))
    two = one.select("t", *[F.col(c).alias(f"{c}2") for c in ("rep", "n", "comp", "odd")])
    may = (F.col("rep") < F.col("rep2")) & (F.col("comp") != F.col("comp2")) & _sizes_fit(F.col("n"), F.col("n2"), similar) & ~_apart(F.col("odd"), F.col("odd2"), F.col("n"), F.col("n2"), similar)
    rare = one.join(two, "t").filter(may).select(F.col("rep").alias("a"), F.col("rep2").alias("b"))

    # One of a pair is outside its bucket's largest component: such members first, then what has enough common shingles for the
    # smallest of them in its bucket.
    enough = lambda m, n, other: m * (100 + similar) >= (n + other) * similar
    rich = known.filter(enough(F.col("many"), F.col("n"), F.col("n") * similar / 100)).select("rep", "many")
    minor = scratch.write(_minor(mixed).join(rich.select(F.col("rep").alias("rep2"), F.col("many").alias("many2")), "rep2"))
    near = mixed.join(minor.groupBy("key").agg(F.min("n2").alias("least")), "key").join(rich, "rep")
    near = scratch.write(near.filter(enough(F.col("many"), F.col("n"), F.greatest(F.col("least"), F.col("n") * similar / 100))))
    both = enough(F.col("many"), F.col("n"), F.col("n2")) & enough(F.col("many2"), F.col("n2"), F.col("n"))
    return rare.unionByName(_met(near, minor, similar, both)).distinct()


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", similar: int = SIMILAR, sides: int = SIDES) -> DataFrame:
    """One row for each row of docs: doc_id (as long), n_shingles, component_id, kept.

    component_id is the smallest doc_id reachable over links, of documents with 100 * intersection >= similar * union of
    their shingle sets; kept tells whether that is the row's own doc_id. Null and empty texts, and texts of white space,
    have the empty set and no links. Rows that repeat a doc_id are one document with all their links. A row without
    doc_id links nothing; it is in the component of an equal set if there is one (then not kept), else in none (kept).
    """
    scratch = Scratch(docs.sparkSession, "near")
    sig = scratch.write(signatures(docs, doc_id, text, sides))
    some = sig.filter("n_shingles > 0 and doc_id is not null")
    reps = scratch.write(some.groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n"), F.first("left").alias("left"), F.first("right").alias("right"), F.first("odd").alias("odd")))

    # Values that at least two representatives have, then pairs of a left and a right one.
    single = reps.select("rep", "n", F.posexplode(F.concat("left", "right")).alias("k", "v"))
    shared = single.groupBy("k", "v").agg(F.count("*").alias("c")).filter("c > 1").drop("c")
    live = single.join(shared, ["k", "v"]).groupBy("rep", "n").agg(F.collect_list(F.struct("k", "v")).alias("vs"))
    left, right = F.filter("vs", lambda x: x.k < sides), F.filter("vs", lambda x: x.k >= sides)
    pairs = F.flatten(F.transform(left, lambda x: F.transform(right, lambda y: F.xxhash64(x.k, x.v, y.k, y.v))))
    keys = scratch.write(live.select("rep", "n", F.explode(pairs).alias("key")))
    bucket = keys.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct("rep", "n")).alias("lead")).filter("size > 1").drop("size")
    members = scratch.write(keys.join(bucket, "key").select("key", "rep", "n", F.col("lead.rep").alias("leader"), F.col("lead.n").alias("ln")))

    wanted = members.select("rep").distinct()
    sets = scratch.write(_sets(docs, doc_id, text, wanted))
    star = scratch.write(members.filter(F.col("rep") != F.col("leader")).filter(_sizes_fit(F.col("n"), F.col("ln"), similar)).select(F.col("leader").alias("a"), F.col("rep").alias("b")).distinct())
    links = scratch.write(_confirm(star, sets, similar))
    label = components(links, scratch)

    # What a leader cannot tell: pairs across components. First a few further leaders for each bucket, then all that may be.
    seen = star
    for k in range(LEADERS + 1):
        placed = members.select("key", "rep", "n").join(label.select(F.col("node").alias("rep"), "comp"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
        mixed = scratch.write(placed.join(_main(placed), "key").join(reps.select("rep", "odd"), "rep"))
        if k < LEADERS:
            order = F.struct(F.xxhash64(F.lit(k), "key", "rep"), F.struct("rep", "n", "comp", "odd").alias("x"))
            lead = mixed.filter("comp = main").groupBy("key").agg(F.max(order).alias("m")).select("key", F.col("m.x.rep").alias("rep2"), F.col("m.x.n").alias("n2"), F.col("m.x.comp").alias("comp2"), F.col("m.x.odd").alias("odd2"))
            met = _met(mixed.filter("comp <> main"), lead, similar)
        else:
            met = _left(mixed, sets, scratch, similar)
        met = scratch.write(met.join(seen, ["a", "b"], "left_anti"))
        if not met.isEmpty():
            links = scratch.write(links.unionByName(_confirm(met, sets, similar)))
            label = components(links, scratch)
            seen = seen.unionByName(met)

    of_set = reps.select("s1", "s2", "rep").join(label.withColumnRenamed("node", "rep"), "rep", "left").select("s1", "s2", F.coalesce("comp", "rep").alias("component_id"))
    out = sig.select("doc_id", "n_shingles", "s1", "s2").join(of_set, ["s1", "s2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    out = out.withColumn("component_id", component)
    kept = F.when(F.col("doc_id").isNull(), F.col("component_id").isNull()).otherwise(F.col("doc_id") == F.col("component_id"))
    return out.select("doc_id", "n_shingles", "component_id", kept.alias("kept"))


def op2_minhash_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, with five words and a similarity of 0.75."""
    return near_duplicates(spread(table(spark, sf_dir, "documents")).select("doc_id", "text"))


OP2_SQL = r"""
WITH RECURSIVE word AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS s
  FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(least(len(w), 1), len(w) - 4))) AS i FROM word)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
met AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2),
link AS (
  SELECT a, b FROM met JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach(node, other) AS (
  SELECT doc_id, doc_id FROM word
  UNION
  SELECT reach.node, link.b FROM reach JOIN link ON link.a = reach.other),
least_of AS (SELECT node AS doc_id, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept
FROM least_of LEFT JOIN size USING (doc_id)
"""
