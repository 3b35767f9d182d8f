"""Language ID, word first with n-gram backoff.

A known word scores by its log frequency in each language. A word that training did not see backs off to its character
n-grams (with word ends), from length 5 down to 1: the longest length at which any of its n-grams is known decides. A
word's scores are normalized over the languages, so that each word votes with what it tells apart.

Training counts words of labelled texts on the executors, from at most `max_docs` of them (a parameter): of a larger table
equal texts of a language are drawn once and languages have equal quotas, so that a rare one has all its texts in. It keeps the most frequent words and n-grams of each language: the model's size is bounded by
parameters and the number of languages, and it alone is broadcast. Prediction is one pass without a shuffle.
"""

from __future__ import annotations

import math
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch, spread, table

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5
UNKNOWN = "und"
#: The evidence of so many words is as much as a score expresses.
VOTES = 10


class Rows(dict):
    """key -> number of its row in one array: a fraction of the memory that an array for each key takes."""

    def __init__(self, keys: list[str], rows: np.ndarray):
        super().__init__(zip(keys, range(len(keys)), strict=True))
        self.rows = rows


class LangModel:
    """langs, and log frequencies by word and by n-gram length; all languages have a floor for what they lack. Each executor
    has a copy for every core, so that its size counts."""

    def __init__(self, langs: list[str], words: dict[str, np.ndarray], grams: list[dict[str, np.ndarray]]):
        self.langs = langs
        self.words, *self.grams = [t if isinstance(t, Rows) else Rows(list(t), np.array(list(t.values())).reshape(len(t), len(langs))) for t in (words, *grams)]

    def word(self, word: str) -> np.ndarray:
        """Log posterior of each language given one word."""
        at = self.words.get(word)
        if at is not None:
            v = self.words.rows[at]
        else:
            w = f"^{word}$"
            for n in range(LONGEST, 0, -1):
                get, rows = self.grams[n - 1].get, self.grams[n - 1].rows
                known = [g for k in range(len(w) - n + 1) if (g := get(w[k : k + n])) is not None]
                if known:
                    v = rows[known[0]] if len(known) == 1 else np.add.reduce(rows[known]) / len(known)
                    break
            else:
                v = np.zeros(len(self.langs))
        plain = v.tolist()  # for so few numbers faster than arrays
        top = max(plain)
        return v - (top + math.log(sum([math.exp(x - top) for x in plain])))


class Scorer(dict):
    """Scores texts; remembers the words of this worker, as word -> row of a table that is emptied when full."""

    def __init__(self, model: LangModel, limit: int = 200_000):
        super().__init__()
        self.model, self.limit = model, limit
        self.rows = np.zeros((limit, max(1, len(model.langs))))

    def __missing__(self, word: str) -> int:
        self[word] = k = len(self)
        self.rows[k] = self.model.word(word)
        return k

    def score(self, text: str | None) -> tuple[str, float]:
        if not text or not self.model.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        words, total = WORD.findall(text.lower()), np.zeros(len(self.model.langs))
        for k in range(0, len(words), 50_000):
            piece = words[k : k + 50_000]
            if len(self) + len(piece) > self.limit:
                self.clear()
            total += self.rows[np.fromiter(map(self.__getitem__, piece), np.intp, len(piece))].sum(0)
        total = total * min(1.0, VOTES / max(1, len(words)))
        p = np.exp(total - total.max())
        best = int(np.argmax(p))
        return self.model.langs[best], float(p[best] / p.sum())


def _counted(df: DataFrame, lang: str, text: str) -> DataFrame:
    """(lang, word, n) over all rows; counts are added up in each task first, in pieces."""

    def run(batches):
        from collections import Counter

        import pyarrow as pa

        def out(sums):
            keys = list(sums)
            return pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()), pa.array([sums[k] for k in keys], pa.int64())], names=["lang", "word", "n"])

        sums: Counter = Counter()
        for batch in batches:
            for name, cell in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for w, n in Counter(WORD.findall((cell.as_py() or "").lower())).items():
                    sums[name, w] += n
                if len(sums) > 200_000:
                    yield out(sums)
                    sums.clear()
        yield out(sums)

    return df.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _quotas(sizes: dict[str, int], bound: int) -> dict[str, int]:
    """How many texts of each language to draw: what small languages leave of their share goes to larger ones. One at least."""
    out, left = {}, bound
    for k, lang in enumerate(sorted(sizes, key=lambda x: (sizes[x], x))):
        out[lang] = min(sizes[lang], max(1, left // (len(sizes) - k)))
        left -= out[lang]
    return out


def _small(spark, rows: list[tuple], **kinds: str) -> DataFrame:
    """A few rows as a table that the driver alone makes; createDataFrame of a list keeps Python workers busy on the executors."""
    import pyarrow as pa

    return spark.createDataFrame(pa.table({c: pa.array([r[k] for r in rows], t) for k, (c, t) in enumerate(kinds.items())}))


def draw(have: DataFrame, scratch: Scratch, bound: int) -> DataFrame:
    """(lang, text): at most bound distinct ones of have (or one for each language), of every language those with the
    smallest hashes. Only about as many hashes as are asked for are sorted."""
    keys = ["lang", "h1", "h2"]
    hashed = have.select("lang", "text", F.xxhash64(F.lit(3), "text").alias("h1"), F.xxhash64(F.lit(4), "text").alias("h2"))
    each = scratch.write(hashed.select(*keys).distinct())
    sizes = {r["lang"]: r["n"] for r in each.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    wanted = [(lang, q, min(1.0, (1.2 * q + 30) / sizes[lang])) for lang, q in _quotas(sizes, bound).items()]
    few = each.join(F.broadcast(_small(have.sparkSession, wanted, lang="string", quota="int64", share="double")), "lang")
    few = few.filter(F.pmod("h1", F.lit(1 << 40)) <= F.col("share") * (1 << 40))
    first = F.row_number().over(Window.partitionBy("lang").orderBy(F.pmod("h1", F.lit(1 << 40)), "h1", "h2"))
    few = scratch.write(few.withColumn("r", first).filter(F.col("r") <= F.col("quota")).select(*keys))
    return hashed.join(F.broadcast(few), keys, "left_semi").dropDuplicates(keys).select("lang", "text")


def frequent(counts: DataFrame, most: dict[int, int], default: int) -> DataFrame:
    """counts (lang, k, word, n) with the most frequent words of each lang and k, about most[k] of them; of those that the last
    frequency n has, a share by hash. Found from the numbers of words by n, which each task adds up first: no group of words is
    ever sorted or put into one task."""
    sizes: dict[tuple, dict[int, int]] = {}
    for r in counts.groupBy("lang", "k", "n").agg(F.count("*").alias("c")).collect():  # few: words share their counts
        sizes.setdefault((r["lang"], r["k"]), {})[r["n"]] = r["c"]
    cuts = []
    for (lang, k), by_n in sizes.items():
        left, cut, share = most.get(k, default), 0, 0.0
        for n in sorted(by_n, reverse=True):
            if by_n[n] > left:
                cut, share = n, left / by_n[n]
                break
            left -= by_n[n]
        cuts.append((lang, k, cut, share))
    few = _small(counts.sparkSession, cuts, lang="string", k="int32", cut="int64", share="double")
    lucky = (F.col("n") == F.col("cut")) & (F.pmod(F.xxhash64(F.lit(9), "word"), F.lit(1 << 40)) < F.col("share") * (1 << 40))
    return counts.join(F.broadcast(few), ["lang", "k"]).filter((F.col("n") > F.col("cut")) | lucky).select("lang", "k", "word", "n")


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", max_docs: int = 20_000, max_words: int = 20_000, max_grams: int = 5_000) -> LangModel:
    """Rows without text or lang teach nothing; without any rows the model knows no language and answers "und". Repeated rows
    count as often as they occur, in a drawn sample once."""
    import pyarrow as pa
    import pyarrow.compute as pc

    have = labelled.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    scratch = Scratch(labelled.sparkSession, "langid")
    if have.count() > max_docs:
        have = draw(have, scratch, max_docs)
    counts = scratch.write(_counted(have, "lang", "text"))
    marked = F.concat(F.lit("^"), F.col("word"), F.lit("$"))
    grams = counts.select("lang", "n", marked.alias("m")).select("lang", "n", "m", F.explode(F.array(*[F.lit(k) for k in range(1, LONGEST + 1)])).alias("k"))
    grams = grams.filter(F.length("m") >= F.col("k")).select("lang", "k", "n", F.explode(F.expr("transform(sequence(1, length(m) - k + 1), i -> substring(m, i, k))")).alias("word"))
    both = counts.select("lang", F.lit(0).alias("k"), "word", "n").unionByName(grams.groupBy("lang", "k", "word").agg(F.sum("n").alias("n")).select("lang", "k", "word", "n"))
    both = scratch.write(both)
    kept = frequent(both, {0: max_words}, max_grams).toArrow()  # a bounded number for each language
    langs = sorted(pc.unique(kept["lang"]).to_pylist())
    tables = []
    for k in range(LONGEST + 1):
        part = kept.filter(pc.equal(kept["k"], k))
        keys = part["word"].combine_chunks().dictionary_encode()
        rows = np.zeros((len(keys.dictionary), len(langs)))
        rows[keys.indices.to_numpy(), pc.index_in(part["lang"], pa.array(langs, pa.string())).to_numpy()] = part["n"].to_numpy()
        total = rows.sum(0) + 0.5 * len(rows)
        tables.append(Rows(keys.dictionary.to_pylist(), np.log((rows + 0.5) / np.maximum(total, 1e-9))))
    return LangModel(langs, tables[0], tables[1:])


def predict(docs: DataFrame, model: LangModel, text: str = "text") -> DataFrame:
    """docs with lang_pred and score (0 to 1): a learned language, or "und" with score 0 if the text is null or has no
    letter, or if nothing was learned. Columns of docs with these names are replaced. Equal texts, equal results: ties
    go to the first language by name."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop("lang_pred", "score")
    at = docs.columns.index(text)

    def run(batches):
        import pyarrow as pa

        scorer = Scorer(sent.value)
        for batch in (b.slice(k, 1_000) for b in batches for k in range(0, b.num_rows, 1_000)):  # all columns go back: in small pieces
            got = [scorer.score(x.as_py()) for x in batch.column(at)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x[0] for x in got], pa.string()), pa.array([x[1] for x in got], pa.float64())], names=[*batch.schema.names, "lang_pred", "score"])

    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields], "lang_pred string", "score double"])
    return docs.mapInArrow(run, schema)


def held_out(doc_id: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def op3_language_id(spark, sf_dir: str) -> DataFrame:
    """Every row of documents, null and empty texts as "und"."""
    docs = spread(table(spark, sf_dir, "documents"))
    model = train(docs.filter(~held_out()).select("lang", "text"))
    return predict(docs.select("doc_id", held_out().alias("held_out"), "text"), model).select("doc_id", "held_out", "lang_pred", "score")
