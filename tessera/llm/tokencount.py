"""Token counts by dynamic programming over a trie of pre-tokens.

A text is cut into pre-tokens; the distinct ones of a batch are put into a trie by their UTF-8 bytes, and the forward score
of the best unigram segmentation is computed once for each node, so pre-tokens share the work of their common prefixes. The
token count at a pre-token's last node is kept for the batches to come; a text's count is the sum over its pre-tokens.

The vocabulary is a rank file of a public tokenizer (a path; read on the driver and broadcast, its size checked). It has ranks and no
probabilities, so a piece of rank r scores -log(r + 2) - log(log(size)), the probability that Zipf's law gives it. Of
segmentations with equal scores the one with fewer tokens counts.

One Arrow pass, no shuffle; the trie holds one batch's new pre-tokens and the kept counts are emptied when full.
"""

from __future__ import annotations

import base64
import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spread, table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Fixed value: the pattern that cuts text for such vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
MOST_PIECES = 1_000_000


def load(path: str) -> dict[bytes, float]:
    """Piece -> score. Single bytes that the file lacks get the lowest score, so that every text can be cut."""
    ranks = {}
    with open(path, "rb") as lines:
        for line in lines:
            if line.strip():
                piece, rank = line.split()
                ranks[base64.b64decode(piece)] = int(rank)
    if len(ranks) > MOST_PIECES:
        raise ValueError(f"a vocabulary of {len(ranks)} pieces is more than {MOST_PIECES}")
    size = max(ranks.values(), default=0) + 2
    shift = math.log(math.log(size + 2))
    out = {p: -math.log(r + 2) - shift for p, r in ranks.items()}
    for k in range(256):
        out.setdefault(bytes([k]), -math.log(size + 2) - shift)
    return out


class TrieCounter:
    def __init__(self, scores: dict[bytes, float], limit: int = 400_000):
        import regex

        self.scores, self.longest, self.limit = scores, max(map(len, scores)), limit
        self.cut = regex.compile(PATTERN).findall
        self.known: dict[str, int] = {}
        self.held = 0  # characters of known

    def insert(self, words: set[str]) -> None:
        """Counts for new pre-tokens. In byte order a walk visits the trie depth first: what a pre-token shares with
        the one before is the path that both have, whose forward scores stay."""
        best, used, last, get = [0.0], [0], b"", self.scores.get
        for raw, word in sorted((w.encode("utf-8", "surrogatepass"), w) for w in words):
            n, most = 0, min(len(raw), len(last))
            while n < most and raw[n] == last[n]:
                n += 1
            del best[n + 1 :], used[n + 1 :]
            for end in range(n + 1, len(raw) + 1):
                top, count = -math.inf, 0
                for begin in range(end - 1, max(-1, end - self.longest - 1), -1):
                    s = get(raw[begin:end])
                    if s is not None:
                        s += best[begin]
                        if s > top or s == top and used[begin] + 1 < count:
                            top, count = s, used[begin] + 1
                best.append(top)
                used.append(count)
            last = raw
            self.known[word] = used[-1]

    def count(self, texts: list[str]) -> list[tuple[int, int]]:
        """(pre-tokens, tokens) of each text."""
        cut = [self.cut(t) for t in texts]
        new = set().union(*cut) - self.known.keys() if cut else set()
        size = sum(map(len, new))
        if len(self.known) + len(new) > self.limit or self.held + size > 16 * self.limit:
            self.known.clear()
            new = set().union(*cut)
            self.held = size = sum(map(len, new))
        else:
            self.held += size
        self.insert(new)
        get = self.known.__getitem__
        return [(len(c), sum(map(get, c))) for c in cut]


def count_tokens(docs: DataFrame, text: str = "text", vocabulary: str = VOCABULARY) -> DataFrame:
    """docs with n_pretokens and n_tokens. Null and empty texts have none. Columns of docs with these names are
    replaced."""
    docs = docs.drop("n_pretokens", "n_tokens")
    sent = docs.sparkSession.sparkContext.broadcast(load(vocabulary))
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        counter = TrieCounter(sent.value)
        for batch in batches:
            found, some, size = [], [], 0
            for x in batch.column(at):
                some.append(x.as_py() or "")
                size += len(some[-1])
                if size > 4 << 20:
                    found += counter.count(some)
                    some, size = [], 0
            found += counter.count(some)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([n for n, _ in found], pa.int64()), pa.array([n for _, n in found], pa.int64())], names=[*batch.schema.names, "n_pretokens", "n_tokens"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], "n_pretokens long, n_tokens long"])
    return docs.mapInArrow(run, schema)


def op10_token_counts(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, null texts as empty."""
    docs = spread(table(spark, sf_dir, "documents")).select("doc_id", "text")
    return count_tokens(docs).select("doc_id", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("n_bytes"), "n_pretokens", "n_tokens")
