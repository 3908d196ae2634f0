"""Unigram subword lattice language model (operator 9).

A text is its words (runs of bytes other than space and 0x09-0x0D, A-Z lower-cased) and one end.
The model draws one token after the other: with c(w) the count of a word in T training tokens, V
distinct ones,

    P(w) = (c(w) + (V + 1) L(w)) / (T + V + 2),    P(end) = (ends + 1) / (T + V + 2),

where L(w) is the subword lattice's likelihood: the sum over *all* segmentations of the word into pieces
of an existing vocabulary, each drawn independently.  In other words, a lattice has an edge for each
piece and one for the whole word, if training texts hold it.  These probabilities sum to one over all words and
the end.

Piece weights come from the scores of a vocabulary file and from the corpus.  The order of scores (those of
this kind of file are ranks, no logarithms) gives a prior, the r-th best piece in proportion to
1 / (r + RANK_SHIFT).  ``rounds`` steps of expectation-maximisation add the prior, as ``PRIOR_COUNT``
observations, to the expected piece counts of all distinct training words, each counted once, since
the lattice speaks for words not seen before.

* Lattices are run for distinct words only, many at a time: pieces are found by fingerprints of all
  byte ranges that begin some piece, and forward and backward sums run in log space, column by
  column, over words sorted by length.
* Word counts are a distributed table that grows with the corpus.  Its most frequent words
  (``hot_words`` at most, a fixed bound) are broadcast; all others are looked up by a join, so no
  word is dropped or approximated.
* A document's sums are additive, so a very long document needs no task of its own.

Cases: ids are integers, or text that reads as one; a null text is an empty one (just the end); bytes of characters that no piece holds use the
vocabulary's byte pieces; an empty table gives an empty result; rows with repeated ids count as
documents of their own; a null id counts as the empty string in the fold rule; without training
texts the prior alone scores; other columns of the input are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, ship
from catlink.llm.textbytes import LOWER, SPACE, Rolling, blocks, text_buffer, words

HOT_WORDS = 200_000
RANK_SHIFT = 10.0
PRIOR_COUNT = 1000.0
CELLS = 1 << 18
LOG10 = float(np.log(10.0))


class Pieces:
    """The vocabulary as byte strings with log weights; a space stands for the word start."""

    def __init__(self, strings: list[bytes], byte_piece: list[int], weights: np.ndarray):
        self.strings, self.byte_piece, self.log = strings, np.array(byte_piece), weights
        prefixes: dict[bytes, int] = {}
        for i, s in enumerate(strings):
            for n in range(1, len(s)):
                prefixes.setdefault(s[:n], -1)
        prefixes |= {s: i for i, s in enumerate(strings) if s}
        keys = list(prefixes)
        flat = np.frombuffer(b"".join(keys), np.uint8)
        ends = np.cumsum([len(k) for k in keys])
        starts = ends - [len(k) for k in keys]
        mark = Rolling(flat, 9).of(starts, ends)
        order = np.argsort(mark)
        self.mark, self.piece = mark[order], np.array([prefixes[k] for k in keys])[order]
        self.longest = max(map(len, strings))

    def edges(self, flat: np.ndarray, left: np.ndarray) -> np.ndarray:
        """piece[length - 1, position]: the piece of that length there, or -1.  left: bytes left in the word."""
        rolling = Rolling(flat, 9)
        out = []
        at = np.arange(len(flat))
        for n in range(1, self.longest + 1):
            at = at[left[at] >= n]
            if len(at) == 0:
                break
            mark = rolling.of(at, at + n)
            where = np.minimum(np.searchsorted(self.mark, mark), len(self.mark) - 1)
            hit = self.mark[where] == mark
            at, where = at[hit], where[hit]
            row = np.full(len(flat), -1, np.int32)
            row[at] = self.piece[where]
            out.append(row)
        while len(out) < 4:
            out.append(np.full(len(flat), -1, np.int32))
        found = np.stack(out)
        # bytes of characters without a piece of their own take byte pieces
        lead = np.flatnonzero((flat & 0xC0) != 0x80)
        size = np.diff(np.append(lead, len(flat)))
        known = found[np.minimum(size, 4) - 1, lead] >= 0
        bare = np.repeat(~known | (size > 4), size)
        whole = np.arange(lead[0] if len(lead) else 0, len(flat))[bare]
        found[0, whole] = self.byte_piece[flat[whole]]
        return found


def _columns(flat: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Words by falling length, as many together as CELLS allows: (word numbers, longest)."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    at = 0
    while at < len(order):
        width = max(1, int(size[order[at]]))
        yield order[at : at + max(1, CELLS // (width + 1))], width
        at += max(1, CELLS // (width + 1))


def _sum_log(rows: list[np.ndarray]) -> np.ndarray:
    grid = np.stack(rows)
    top = grid.max(axis=0)
    safe = np.where(np.isfinite(top), top, 0.0)
    with np.errstate(divide="ignore"):
        return np.log(np.exp(grid - safe).sum(axis=0)) + safe


def run_lattices(flat: np.ndarray, offsets: np.ndarray, pieces: Pieces, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(log probability of each word, expected count of each piece); the latter only when counts are given."""
    n = len(offsets) - 1
    total, expected = np.zeros(n), np.zeros(len(pieces.strings))
    if n == 0:
        return total, expected
    size = np.diff(offsets)
    found = pieces.edges(flat, np.repeat(offsets[1:], size) - np.arange(len(flat)))
    weight = np.where(found >= 0, pieces.log[np.maximum(found, 0)], -np.inf)
    depth = len(found)
    for chosen, width in _columns(flat, offsets):
        start, length = offsets[:-1][chosen], size[chosen]
        longer = np.searchsorted(-length, -np.arange(width + 1), side="right")  # words of at least j bytes
        forward = np.full((width + 1, len(chosen)), -np.inf)
        forward[0] = 0.0
        for j in range(1, width + 1):
            m = longer[j]
            forward[j, :m] = _sum_log([forward[j - k, :m] + weight[k - 1, start[:m] + j - k] for k in range(1, min(j, depth) + 1)])
        mine = np.arange(len(chosen))
        total[chosen] = forward[length, mine]
        if counts is None:
            continue
        backward = np.full((width + 1, len(chosen)), -np.inf)
        backward[length, mine] = 0.0
        for j in range(width - 1, -1, -1):
            m = longer[j + 1]
            terms = []
            for k in range(1, min(width - j, depth) + 1):
                q = longer[j + k]
                row = np.full(m, -np.inf)
                row[:q] = backward[j + k, :q] + weight[k - 1, start[:q] + j]
                share = np.exp(forward[j, :q] + row[:q] - total[chosen[:q]]) * counts[chosen[:q]]
                some = np.flatnonzero(share > 0)
                expected += np.bincount(found[k - 1, start[some] + j], weights=share[some], minlength=len(expected))
                terms.append(row)
            ended = length[:m] == j
            backward[j, :m] = np.where(ended, backward[j, :m], _sum_log(terms))
    return total, expected


def fold(doc_id) -> int:
    """crc32 of the id as text, modulo 7."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 7


def _word_array(data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    start, end, row = words(data, offsets)
    flat = LOWER[data[~SPACE[data]]]
    ends = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(start), [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(flat.tobytes())]), row


def _count_words(held_out: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            train = np.array([fold(x) != held_out for x in batch.column(0).to_pylist()], bool)
            for a, b in blocks(offsets, 4 << 20):
                array, row = _word_array(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                coded = array.dictionary_encode()
                code = coded.indices.to_numpy()
                n = np.bincount(code[train[a:b][row]], minlength=len(coded.dictionary))
                yield pa.RecordBatch.from_arrays([coded.dictionary, pa.array(n.astype(np.int64))], names=["word", "n"])

    return run


def _on_words(pieces, weights, expect: bool):
    """Over (word, n): expected piece counts of the words, each once, or each word with its lattice's log10 likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        strings, byte_piece = pieces.value
        model = Pieces(strings, byte_piece, weights.value)
        sums = np.zeros(len(strings))
        for batch in batches:
            data, offsets = text_buffer(batch.column("word"))
            for a, b in blocks(offsets, 1 << 17):
                x, local = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                flat = np.insert(x, local[:-1], 0x20)  # the word start
                n = batch.column("n").slice(a, b - a).to_numpy()
                total, expected = run_lattices(flat, local + np.arange(len(local)), model, np.ones(b - a) if expect else None)
                sums += expected
                if not expect:
                    yield pa.RecordBatch.from_arrays([batch.column("word").slice(a, b - a), pa.array(n), pa.array(total / LOG10)], names=["word", "n", "lp"])
        if expect:
            some = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(sums[some])], names=["piece", "e"])

    return run


def _score_rows(hot):
    """A row for each document with its hot words' sums, and one for each of its other words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, lps = hot.value
        keys = pa.array(keys, pa.string())
        known = np.append(counts > 0, False)
        base, lp = np.append(np.log10(counts + 1.0), 0.0), np.append(lps, 0.0)
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            rid = batch.column("_r").to_numpy(zero_copy_only=False)
            for a, b in blocks(offsets, 4 << 20):
                array, row = _word_array(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                coded = array.dictionary_encode()
                code = coded.indices.to_numpy()
                slot = pc.index_in(coded.dictionary, value_set=keys).fill_null(len(keys)).to_numpy()
                at = slot[code]
                size = b - a
                by = lambda w: np.bincount(row, weights=w[at], minlength=size)
                ids = rid[a:b]
                spread = pa.array([f"\0{x}" for x in ids.tolist()])  # keys that no word has, dealt evenly
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), spread, pa.array(np.ones(size, np.int64)), pa.array(np.bincount(row, minlength=size)), pa.array(by(known.astype(float)).astype(np.int64)), pa.array(by(base)), pa.array(by(lp))],
                    names=["_r", "word", "m", "n_tokens", "n_known", "base", "lp"],
                )
                cold = at == len(keys)
                pair, m = np.unique(row[cold] * np.int64(len(slot) + 1) + code[cold], return_counts=True)
                who, what = np.divmod(pair, np.int64(len(slot) + 1))
                none = np.zeros(len(pair), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[who]), coded.dictionary.take(pa.array(what)), pa.array(m.astype(np.int64)), pa.array(none), pa.array(none), pa.array(none.astype(float)), pa.array(none.astype(float))],
                    names=["_r", "word", "m", "n_tokens", "n_known", "base", "lp"],
                )

    return run


def read_pieces(path: str) -> tuple[list[bytes], list[int], np.ndarray]:
    """(pieces, byte -> byte piece, prior log weights) of a vocabulary file, without control pieces; read on the driver."""
    import sentencepiece

    with open(path, "rb") as file:
        model = sentencepiece.SentencePieceProcessor(model_proto=file.read())
    strings, byte_piece, score = [], [-1] * 256, []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            continue
        text = model.id_to_piece(i)
        if model.is_byte(i):
            byte_piece[int(text[3:5], 16)] = len(strings)
            strings.append(b"")
        else:
            strings.append(text.replace("▁", " ").encode())
        score.append(model.get_score(i))
    rank = np.empty(len(strings))
    rank[np.argsort(-np.array(score), kind="stable")] = np.arange(len(strings))
    weight = 1.0 / (rank + RANK_SHIFT)
    return strings, byte_piece, np.log(weight / weight.sum())


def lattice_score(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", *, held_out: int = 2, rounds: int = 3, hot_words: int = HOT_WORDS) -> DataFrame:
    """Returns (id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row for each input row.

    base_score: log10 of the add-one word unigram estimate, in which one share stands for any unseen
    word; score: the model's log10 probability of the text itself, so an unseen word costs its spelling.
    """
    spark = docs.sparkSession
    ship(spark)
    send = spark.sparkContext.broadcast
    own = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t"))
    held = F.coalesce(F.crc32(F.col("_i").cast("string").cast("binary")), F.lit(0)) % 7 == held_out
    counts = checkpoint(own.mapInArrow(_count_words(held_out), "word string, n long").groupBy("word").agg(F.sum("n").alias("n")))
    seen = counts.agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("v")).first()
    ends = own.agg(F.count_if(~held)).first()[0]
    tokens, distinct = (seen["n"] or 0) + ends, seen["v"] + (ends > 0)

    strings, byte_piece, prior = read_pieces(vocabulary)
    shared, log = send((strings, byte_piece)), prior
    for _ in range(rounds):
        parts = counts.filter("n > 0").mapInArrow(_on_words(shared, send(log), True), "piece long, e double").groupBy("piece").agg(F.sum("e").alias("e"))
        gathered = PRIOR_COUNT * np.exp(prior)  # as many rows as the vocabulary has pieces
        for r in parts.toLocalIterator():
            gathered[r["piece"]] += r["e"]
        log = np.log(gathered / gathered.sum())
    novel, all_mass = float(seen["v"] + 1), float(tokens + seen["v"] + 2)
    end = float(np.log10((ends + 1) / all_mass))
    n, lattice = F.col("n").cast("double"), F.col("lp") + float(np.log10(novel))
    known = F.log10(n + F.pow(F.lit(10.0), lattice))
    scored = counts.mapInArrow(_on_words(shared, send(log), False), "word string, n long, lp double")
    scored = checkpoint(scored.withColumn("lp", F.when(n > 0, known).otherwise(lattice) - float(np.log10(all_mass))))

    # the bound holds whatever the counts are: buckets of counts from the top, as long as they fit
    bucket = F.floor(F.log2(F.col("n") + 1) * 16).cast("int")
    least, sum_so_far = None, 0
    for b, n in sorted(((r[0], r[1]) for r in scored.filter("n > 0").groupBy(bucket.alias("b")).count().collect()), reverse=True):
        sum_so_far += n
        if sum_so_far > hot_words:
            break
        least = b
    top = scored.filter(bucket >= (least if least is not None else 1 << 20)).toArrow()
    hot = send((top["word"].to_pylist(), top["n"].to_numpy(), top["lp"].to_numpy()))

    scale = float(np.log10(tokens + distinct + 1.0))
    rows = own.withColumn("_r", F.monotonically_increasing_id())
    rows = rows.select("_r", "_t", "_i").mapInArrow(_with_ids(_score_rows(hot)), "_r long, word string, m long, n_tokens long, n_known long, base double, lp double, _i long")
    cold = rows.join(scored.withColumnsRenamed({"n": "c", "lp": "wlp"}), "word", "left")
    c = F.col("m") * F.coalesce(F.col("c"), F.lit(0)).cast("double")
    total = cold.groupBy("_r").agg(
        F.max("_i").alias("_i"),
        F.sum("n_tokens").alias("n"),
        F.sum(F.col("n_known") + F.when(F.col("c") > 0, F.col("m")).otherwise(0)).alias("known"),
        F.sum(F.col("base") + F.when(c > 0, F.col("m") * F.log10(F.col("c") + 1)).otherwise(0)).alias("base"),
        F.sum(F.col("lp") + F.coalesce(F.col("m") * F.col("wlp"), F.lit(0.0))).alias("lp"),
    )
    i = F.col("_i")
    return total.select(
        i.alias(id_col),
        (F.coalesce(F.crc32(i.cast("string").cast("binary")), F.lit(0)) % 7 == held_out).alias("held_out"),
        (F.col("n") + 1).alias("n_tokens"),
        (F.col("known") + int(ends > 0)).alias("n_known"),
        F.lit(int(tokens)).cast("long").alias("train_tokens"),
        (F.col("base") + float(np.log10(ends + 1.0)) - (F.col("n") + 1) * scale).alias("base_score"),
        (F.col("lp") + end).alias("score"),
    )


def _with_ids(inner):
    """Adds the document's id to each of its rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, ids = batch.column("_r"), batch.column("_i")
            for out in inner(iter([batch])):
                yield out.append_column("_i", ids.take(pc.index_in(out.column("_r"), value_set=key)))

    return run
