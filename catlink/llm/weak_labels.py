"""Quality classifier from weak labels (operator 3).

Overlapping heuristic labellers vote on every document: shouting, runs of symbols, table debris,
repeated words, and words of a lexicon of abuse.  Expectation-maximisation over the counts of vote
patterns of *all* documents estimates how often each labeller fires in each latent class (clean, or
one kind of fault), which are the labellers' accuracies, and gives each pattern the posterior
probability that the document is faulty.  Posteriors label a bounded training sample, on which a
linear scorer over hashed words, hashed word beginnings and the labellers' rates is fitted.  The
scorer then decides every whole document.

The lexicon is mined from the labelled rows (``toxic``): words and beginnings of words far more
frequent in toxic documents than chance allows (z >= ``LEXICON_Z``, precision >= 0.9, in
``LEXICON_SHARE`` of the toxic documents at least).

Documented bounds (parameters ``labelled_rows``, ``train_rows``, ``train_entries``), all samples by a hash of
the id and so the same at every run: ``LABELLED_ROWS`` labelled rows are used for the lexicon, ``TRAIN_ROWS``
documents for the fit, or as many of their hash ranges as hold ``TRAIN_ENTRIES`` hashed features; a range
holds a ``TRAIN_RANGES``-th of them, and a document has ``BUCKETS`` features at most.  All entries that pass the
lexicon's rule are used; each is in ``LEXICON_SHARE`` of the sample's toxic documents, so there are no more than
the mean number of their distinct words and beginnings over ``LEXICON_SHARE``.  Vote counts, lexicon look-up
and scores cover all documents and whole texts.

Cases: ids are integers, or text that reads as one; null and empty texts and texts of spaces have no votes and are kept; null labels and labels
without a document are ignored; without labels the lexicon is empty; labels repeated for an id
count once, toxic if any is; repeated documents are decided each; a very long text is a block of its
own, held whole by one task; an empty table gives an empty result; other columns are ignored by
``classify`` and carried by ``drop_rejected``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, ship
from catlink.llm.textbytes import LOWER, Rolling, blocks, fmix, text_buffer, words

LABELLED_ROWS, TRAIN_ROWS, TRAIN_ENTRIES, TRAIN_RANGES = 8000, 5000, 4_000_000, 64
LEXICON_Z, LEXICON_SHARE = 6.0, 0.02
#: Documents that the given accuracies of the labellers count for in the estimate, in each class.
PRIOR_DOCUMENTS = 25.0
BEGINNINGS = (4, 5, 6)
BUCKETS = 1 << 18
CLASSES = ["clean", "shouting", "symbols", "table", "repeats", "abuse"]
#: labeller -> (threshold on its rate, classes that it speaks of)
LABELLERS = {
    "capitals": (0.30, ("shouting",)), "exclamation": (0.20, ("shouting",)),
    "symbol_runs": (0.20, ("symbols",)), "punctuation": (0.20, ("symbols", "shouting")),
    "bars": (0.15, ("table",)), "repeated": (0.30, ("repeats",)), "long_run": (0.10, ("repeats",)),
    "abuse_word": (1e-9, ("abuse",)), "abuse_beginning": (1e-9, ("abuse",)), "abuse_rate": (0.005, ("abuse",)),
}

_PUNCT = np.zeros(256, bool)
_PUNCT[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True
_TRAIL = np.zeros(256, bool)
_TRAIL[list(b".,;:!?")] = True


class Bytes:
    """Words of a block of documents and their hashes."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.n = len(offsets) - 1
        self.raw = data
        self.start, self.end, self.row = words(data, offsets)
        self.count = np.bincount(self.row, minlength=self.n)
        self.rolling = Rolling(LOWER[data], 13)
        bare = self.end - _TRAIL[data[self.end - 1]] if len(self.end) else self.end
        self.bare = np.maximum(bare, self.start + 1)

    def word_hash(self) -> np.ndarray:
        return self.rolling.of(self.start, self.bare)

    def beginnings(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(word numbers, hashes) of the beginnings of each length."""
        size = self.bare - self.start
        for k in BEGINNINGS:
            some = np.flatnonzero(size >= k)
            yield some, self.rolling.of(self.start[some], self.start[some] + k)

    def rates(self, lexicon: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
        """A row for each document with the rate of each labeller, in the order of LABELLERS."""
        by = lambda flags: np.bincount(self.row, weights=flags, minlength=self.n)
        total = np.maximum(self.count, 1)
        if not len(self.start):
            return np.zeros((self.n, len(LABELLERS)))
        up = np.concatenate([[0], np.cumsum((self.raw >= 65) & (self.raw <= 90))])
        low = np.concatenate([[0], np.cumsum((self.raw >= 97) & (self.raw <= 122))])
        mark = np.concatenate([[0], np.cumsum(_PUNCT[self.raw])])
        span = lambda sums: sums[self.end] - sums[self.start]
        last, before = self.raw[self.end - 1], self.raw[np.maximum(self.end - 2, self.start)]
        double = (self.end - self.start >= 2) & (last == before)
        word = self.word_hash()
        same = np.zeros(len(word), bool)
        same[1:] = (word[1:] == word[:-1]) & (self.row[1:] == self.row[:-1])
        fourth = np.zeros(len(word), bool)  # the fourth or later of equal neighbours
        if len(word) > 3:
            fourth[3:] = same[3:] & same[2:-1] & same[1:-2]
        whole, begin = lexicon
        abusive = _among(word, whole)
        begins = np.zeros(len(word), bool)
        for some, mark_ in self.beginnings():
            begins[some] |= _among(mark_, begin)
        size = np.maximum(by((self.end - self.start).astype(float)), 1)
        columns = [
            by((span(up) >= 2) & (span(low) == 0)) / total, by(double & (last == 33)) / total, by(double & _PUNCT[last] & (last != 33) & (last != 46)) / total,
            by(span(mark).astype(float)) / size, by((self.end - self.start == 1) & (last == 124)) / total, by(same) / total, by(fourth) / total,
            by(abusive) / total, by(begins) / total, by(abusive | begins) / total,
        ]
        return np.stack(columns, axis=1)

    def buckets(self) -> tuple[np.ndarray, np.ndarray]:
        """(document, bucket) of each hashed feature: words, and their beginnings of five bytes."""
        some = np.flatnonzero(self.bare - self.start >= 5)
        begin = self.rolling.of(self.start[some], self.start[some] + 5)
        mask = np.uint64(BUCKETS - 1)
        return np.concatenate([self.row, self.row[some]]), np.concatenate([self.word_hash() & mask, (begin ^ (begin >> np.uint64(29))) & mask]).astype(np.int64)


def _among(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    if not len(table):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(table, values), len(table) - 1)
    return table[at] == values


def votes(rates: np.ndarray) -> np.ndarray:
    """Bit pattern of the labellers that fire."""
    fired = rates >= np.array([t for t, _ in LABELLERS.values()])
    return (fired * (1 << np.arange(len(LABELLERS)))).sum(axis=1)


def fit_labellers(patterns: dict[int, int], rounds: int = 100) -> tuple[np.ndarray, np.ndarray, dict[int, float]]:
    """(class shares, firing rates by class and labeller, posterior of a fault by pattern)."""
    keys = np.array(sorted(patterns), np.int64)
    n = np.array([patterns[int(k)] for k in keys], float)
    fired = (keys[:, None] >> np.arange(len(LABELLERS)) & 1).astype(float)
    share = np.full(len(CLASSES), 0.04)
    share[0] = 1 - share[1:].sum()
    rate = np.full((len(CLASSES), len(LABELLERS)), 0.01)
    for j, (_, about) in enumerate(LABELLERS.values()):
        for c in about:
            rate[CLASSES.index(c), j] = 0.7
    prior, strength = rate.copy(), PRIOR_DOCUMENTS
    post = np.zeros((len(keys), len(CLASSES)))
    for _ in range(rounds):
        log = np.log(share) + fired @ np.log(rate).T + (1 - fired) @ np.log(1 - rate).T
        post = np.exp(log - log.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        mass = n @ post
        share = (mass + 0.5) / (mass.sum() + 0.5 * len(CLASSES))
        rate = np.clip(((post * n[:, None]).T @ fired + strength * prior) / (mass[:, None] + strength), 1e-4, 1 - 1e-4)
    return share, rate, {int(k): float(1 - p[0]) for k, p in zip(keys, post, strict=True)}


class Scorer:
    """A logistic model over hashed counts for each hundred words and the labellers' rates."""

    def __init__(self, hashed: np.ndarray, dense: np.ndarray, bias: float):
        self.hashed, self.dense, self.bias = hashed, dense, bias

    @staticmethod
    def dense_features(rates: np.ndarray) -> np.ndarray:
        fired = rates >= np.array([t for t, _ in LABELLERS.values()])
        return np.concatenate([fired.astype(float), np.minimum(rates * np.array([2.0] * 7 + [20.0] * 3), 1.0)], axis=1)

    def score(self, block: Bytes, rates: np.ndarray) -> np.ndarray:
        row, bucket = block.buckets()
        sums = np.bincount(row, weights=self.hashed[bucket], minlength=block.n)
        z = sums * 100.0 / np.maximum(block.count, 20) + self.dense_features(rates) @ self.dense + self.bias
        return 1.0 / (1.0 + np.exp(-np.clip(z, -40, 40)))

    @classmethod
    def fit(cls, row: np.ndarray, bucket: np.ndarray, value: np.ndarray, dense: np.ndarray, target: np.ndarray, rounds: int = 300) -> Scorer:
        """Full-batch gradient steps with per-weight scaling (Adam); bucket values are counts for each hundred words."""
        used, column = np.unique(bucket, return_inverse=True)
        w = np.zeros(len(used) + dense.shape[1] + 1)
        m, v = np.zeros_like(w), np.zeros_like(w)
        k, n = len(used), len(target)
        # word counts are noisy evidence and labellers' rates are not: the former get more shrinkage
        shrink = np.concatenate([np.full(k, 3e-3), np.full(dense.shape[1], 1e-4), [0.0]])
        for t in range(1, rounds + 1):
            z = np.bincount(row, weights=w[column] * value, minlength=n) + dense @ w[k:-1] + w[-1]
            e = (1.0 / (1.0 + np.exp(-np.clip(z, -40, 40))) - target) / n
            g = np.concatenate([np.bincount(column, weights=e[row] * value, minlength=k), dense.T @ e, [e.sum()]]) + shrink * w
            m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
            step = np.concatenate([np.full(k, 0.01), np.full(dense.shape[1] + 1, 0.15)])
            w -= step * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        hashed = np.zeros(BUCKETS)
        hashed[used] = w[:k]
        return cls(hashed, w[k:-1], float(w[-1]))


def _each(column: int, work):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(column))
            for a, b in blocks(offsets):
                out = work(Bytes(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]), batch.slice(a, b - a))
                if out is not None:
                    yield out

    return run


def _lexicon_counts(block: Bytes, batch: pa.RecordBatch) -> pa.RecordBatch:
    """Documents, toxic or not, that hold each word (kind 0) or beginning (kind 1)."""
    toxic = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
    parts = [(np.zeros(len(block.row), np.int64), block.row, block.word_hash())]
    parts += [(np.ones(len(some), np.int64), block.row[some], mark) for some, mark in block.beginnings()]
    kind, row, mark = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((row, mark, kind))
    kind, row, mark = kind[order], row[order], mark[order]
    new = np.ones(len(row), bool)
    new[1:] = (kind[1:] != kind[:-1]) | (mark[1:] != mark[:-1]) | (row[1:] != row[:-1])
    kind, row, mark = kind[new], row[new], mark[new]
    edge = np.flatnonzero(np.append(True, (kind[1:] != kind[:-1]) | (mark[1:] != mark[:-1]))) if len(row) else np.zeros(0, np.int64)
    docs = np.diff(np.append(edge, len(row)))
    bad = np.add.reduceat(toxic[row], edge) if len(row) else docs
    return pa.RecordBatch.from_arrays([pa.array(kind[edge]), pa.array(mark[edge].view(np.int64)), pa.array(docs.astype(np.int64)), pa.array(bad.astype(np.int64))], names=["kind", "h", "docs", "bad"])


def _smallest_shingle(block: Bytes, batch: pa.RecordBatch) -> pa.RecordBatch:
    """The smallest fingerprint of four-word shingles of each document."""
    word, key = block.word_hash(), np.zeros(block.n, np.uint64)
    if len(word):
        with_next = word.copy()
        for k in (1, 2, 3):
            near = block.row[k:] == block.row[:-k]
            with_next[:-k][near] ^= fmix(word[k:][near] + np.uint64(k))
        edge = np.flatnonzero(np.append(True, block.row[1:] != block.row[:-1]))
        key[block.row[edge]] = np.minimum.reduceat(fmix(with_next), edge)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(key.view(np.int64))], names=["_i", "_key"])


def mine_lexicon(docs: DataFrame, labels: DataFrame, labelled_rows: int = LABELLED_ROWS) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of words, hashes of beginnings) of the lexicon."""
    ship(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("long").alias("_i"), (F.coalesce("toxic", F.lit(0)) > 0).cast("int").alias("_bad")).filter("_i is not null")
    known = known.groupBy("_i").agg(F.max("_bad").alias("_bad"))
    total = known.count()
    keep = min(1.0, labelled_rows / max(total, 1))
    sample = known.filter(F.pmod(F.xxhash64("_i"), F.lit(1_000_000)) < int(keep * 1_000_000))  # labelled_rows rows of 12 bytes
    rows = docs.join(F.broadcast(sample), "_i").select("_i", "_t")
    # copies of one document are one witness: of those with one smallest shingle, the smallest id speaks
    keyed = rows.mapInArrow(_each(1, _smallest_shingle), "_i long, _key long")
    sample = sample.join(keyed.groupBy("_key").agg(F.min("_i").alias("_i")).select("_i").distinct(), "_i")
    sample = checkpoint(sample)
    rows = docs.join(F.broadcast(sample), "_i").select("_t", "_bad")
    both = sample.agg(F.count("*").alias("n"), F.sum("_bad").alias("bad")).first()
    rate = (both["bad"] or 0) / max(both["n"], 1)
    if not 0 < rate < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    counts = rows.mapInArrow(_each(0, _lexicon_counts), "kind long, h long, docs long, bad long").groupBy("kind", "h").agg(F.sum("docs").alias("docs"), F.sum("bad").alias("bad"))
    z = (F.col("bad") - F.col("docs") * rate) / F.sqrt(F.col("docs") * rate * (1 - rate))
    found = counts.filter((z >= LEXICON_Z) & (F.col("bad") >= 0.9 * F.col("docs")) & (F.col("bad") >= LEXICON_SHARE * both["bad"])).collect()
    made = [np.sort(np.array([r["h"] for r in found if r["kind"] == k], np.int64).view(np.uint64)) for k in (0, 1)]
    return made[0], made[1]


def _fit(own: DataFrame, labels: DataFrame, labelled_rows: int, train_rows: int, train_entries: int):
    """(lexicon, posterior by pattern, scorer) as broadcasts, from (_i, _t) rows; None for an empty table."""
    send = own.sparkSession.sparkContext.broadcast
    lexicon = send(mine_lexicon(own, labels, labelled_rows))
    seed = F.pmod(F.xxhash64("_i", F.length("_t")), F.lit(1_000_000))

    def vote(block, batch):
        found, n = np.unique(votes(block.rates(lexicon.value)), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(found), pa.array(n.astype(np.int64))], names=["pattern", "n"])

    counted = own.select("_t").mapInArrow(_each(0, vote), "pattern long, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    if not counted:
        return None
    patterns = {r["pattern"]: r["n"] for r in counted}
    _, _, posterior = fit_labellers(patterns)

    def features(block, batch):
        rates = block.rates(lexicon.value)
        row, bucket = block.buckets()
        pair, n = np.unique(row * np.int64(BUCKETS) + bucket, return_counts=True)
        who, what = np.divmod(pair, np.int64(BUCKETS))
        value = (n * 100.0 / np.maximum(block.count, 20)[who]).astype(np.float32)
        ends = np.searchsorted(who, np.arange(block.n + 1)).astype(np.int32)
        lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (what.astype(np.int32), value)]
        dense = pa.ListArray.from_arrays(pa.array(np.arange(block.n + 1, dtype=np.int32) * rates.shape[1]), pa.array(rates.ravel()))
        return pa.RecordBatch.from_arrays([batch.column(1), *lists, dense], names=["_range", "bucket", "value", "rates"])

    keep = int(min(1.0, train_rows / max(sum(patterns.values()), 1)) * 1_000_000) + 1
    sample = own.filter(seed < keep).select("_t", F.floor(seed * TRAIN_RANGES / keep).cast("int").alias("_range"))
    train = checkpoint(sample.mapInArrow(_each(0, features), "_range int, bucket array<int>, value array<float>, rates array<double>"))
    last, entries = 0, 0
    for r in train.groupBy("_range").agg(F.sum(F.size("bucket")).alias("n")).orderBy("_range").collect():  # TRAIN_RANGES rows
        if entries and entries + r["n"] > train_entries:
            break
        last, entries = r["_range"], entries + r["n"]
    train = train.filter(F.col("_range") <= last).toArrow()
    rates = np.array(train["rates"].to_pylist(), float).reshape(-1, len(LABELLERS))
    size = np.array([len(x) for x in train["bucket"]], np.int64)
    flat = lambda name: np.concatenate([np.zeros(0), *[c.flatten().to_numpy() for c in train[name].chunks]])
    target = np.array([posterior.get(int(p), 0.0) for p in votes(rates)])
    model = send(Scorer.fit(np.repeat(np.arange(len(size)), size), flat("bucket").astype(np.int64), flat("value"), Scorer.dense_features(rates), target))
    return lexicon, send(posterior), model


def _judge(block: Bytes, fitted) -> tuple[np.ndarray, np.ndarray]:
    """(posterior, score) of each document."""
    lexicon, posterior, model = (x.value for x in fitted)
    rates = block.rates(lexicon)
    given = np.array([posterior.get(int(p), 0.0) for p in votes(rates)], float)
    return given, np.where(block.count > 0, model.score(block, rates), 0.0)


def classify(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, labelled_rows: int = LABELLED_ROWS, train_rows: int = TRAIN_ROWS, train_entries: int = TRAIN_ENTRIES
) -> DataFrame:
    """Returns (id, posterior, score, rejected), one row for each input row; rejected: score >= 0.5."""
    own = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t"))
    fitted, schema = _fit(own, labels, labelled_rows, train_rows, train_entries), "_i long, posterior double, score double"
    if fitted is None:
        out = docs.sparkSession.createDataFrame([], schema)
    else:

        def score(block, batch):
            given, value = _judge(block, fitted)
            return pa.RecordBatch.from_arrays([batch.column(0), pa.array(given), pa.array(value)], names=["_i", "posterior", "score"])

        out = own.mapInArrow(_each(1, score), schema)
    return out.select(F.col("_i").alias(id_col), "posterior", "score", (F.col("score") >= 0.5).alias("rejected"))


def drop_rejected(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, labelled_rows: int = LABELLED_ROWS, train_rows: int = TRAIN_ROWS, train_entries: int = TRAIN_ENTRIES
) -> DataFrame:
    """The rows of ``docs`` that the classifier keeps; texts aren't moved."""
    fitted = _fit(docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t")), labels, labelled_rows, train_rows, train_entries)
    if fitted is None:
        return docs

    def keep(block, batch):
        return batch.filter(pa.array(_judge(block, fitted)[1] < 0.5))

    return docs.mapInArrow(_each(docs.columns.index(text_col), keep), docs.schema)
