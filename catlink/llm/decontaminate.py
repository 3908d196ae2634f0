"""Benchmark decontamination: block-max WAND over a BM25 inverted index, and exact verification (operator 7).

Every passage of every document queries an inverted index of the benchmark items.  With M words in
the longest item, passages are all windows of 2 M words at steps of M, so each run of M words
lies in one of them.  An item's BM25 weights are divided by the least score that a passage which
passes the verification can have (the weights of its words without the heaviest fifth), so one
threshold, 1, retrieves without loss for all items.

* *Index.*  Each term has postings (segment of an item, weight) in the order of segments, the largest
  weight of all, and the largest weight in each block of ``BLOCK_SEGMENTS`` segments that it occurs in.
  Segments are numbered by length, so blocks hold items of similar length.  Nothing is stored for a
  term and a segment without it.
* *Bounds for a batch.*  A passage whose terms' largest weights do not reach the threshold has no
  pivot.  For the others the block maxima of their terms are summed, from half windows that neighbours
  share; blocks below the threshold are closed to the passage.
* *WAND.*  In each passage with open blocks, cursors over its terms' postings stand in the order of
  their segments; the pivot is the first segment where the largest weights of the cursors up to it
  reach the threshold.  A closed block, or one whose maxima for these cursors are too small, is
  skipped to its end; else lagging cursors jump to the pivot, and a pivot that all of them reach is
  scored.  All segments at the threshold are retrieved, never a top k.
* *Words* are the runs between whitespace and punctuation, so a quote, bracket or full stop that
  touches a passage's edge changes none of its words.
* *Verification.*  Question (an item without its last sentence) and answer (the last sentence; an
  item of one sentence is halved) must each have ``similarity`` of their ``shingle``-word
  shingles in the passage; a part of fewer words is one shingle.

Document frequencies and lengths are aggregates over all items.  The index is built and broadcast in
shards, one at a time, of ``SHARD_SEGMENTS`` segments of ``SEGMENT_WORDS`` words and ``SHARD_BYTES`` of text at
most; an item that is larger alone is a shard of its own.  Longer items are retrieved by any of
their segments and verified whole.  Documents are never shuffled, so a hot source or group of copies
needs no care; each shard is one pass over them.

Cases: ids are integers, or text that reads as one; null and empty texts match nothing, nor do items
without words (punctuation only) or without an id; items of equal text are found each; repeated
documents are reported each; a very long text is a block of its own, held whole by one task; empty
tables give an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, ship
from catlink.llm.textbytes import LOWER, Rolling, blocks, text_buffer, words

K1, B = 1.2, 0.75
BLOCK_SEGMENTS = 8
SEGMENT_WORDS = 512
SHARD_SEGMENTS, SHARD_BYTES = 8192, 8 << 20
SLACK = 1e-3
_SENTENCE = re.compile(r"(?<=[.!?])[ \t]+|[\r\n]+")
#: Lower-cases A-Z; ASCII other than letters and digits becomes a space.
_PLAIN = LOWER.copy()
_PLAIN[[i for i in range(128) if not chr(i).isalnum()]] = 0x20


def plain(data: np.ndarray) -> np.ndarray:
    """A copy of UTF-8 bytes with letters up to U+00DE lower-cased and punctuation as spaces, of the same length."""
    out = _PLAIN[data]
    lead = np.flatnonzero(data[:-1] >= 0xC2)
    second = data[lead + 1]
    capital = lead[(data[lead] == 0xC3) & (second <= 0x9E) & (second != 0x97)] + 1
    out[capital] += 0x20
    # U+00A0 to U+00BF but for ordinals, micro, superscripts and fractions
    at = lead[(data[lead] == 0xC2) & np.isin(second, [*range(0xA0, 0xAA), *range(0xAB, 0xB2), 0xB4, *range(0xB6, 0xB9), 0xBB, 0xBF])]
    out[at] = out[at + 1] = 0x20
    # U+2000 to U+206F, and full stops, commas and brackets of CJK text
    three = lead[(lead + 2 < len(data)) & (data[lead] >= 0xE2)]
    a, b, c = data[three], data[three + 1], data[three + 2]
    general = (a == 0xE2) & ((b == 0x80) | ((b == 0x81) & (c < 0xB0)))
    cjk = (a == 0xE3) & (b == 0x80) & ((c <= 0x83) | ((c >= 0x88) & (c <= 0xA0) & (c != 0x92) & (c != 0x93)))
    full = (a == 0xEF) & (((b == 0xBC) & (((c >= 0x81) & (c <= 0x8F)) | ((c >= 0x9A) & (c <= 0xA0)) | (c >= 0xBB))) | ((b == 0xBD) & (((c >= 0x9B) & (c <= 0xA4)) | (c == 0x80))))
    at = three[general | cjk | full]
    out[at] = out[at + 1] = out[at + 2] = 0x20
    return out


def split_words(text: str | bytes) -> list[bytes]:
    """Words in lower case (``plain``), without punctuation."""
    raw = text.encode() if isinstance(text, str) else text
    return plain(np.frombuffer(raw, np.uint8)).tobytes().split()


def question_answer(text: str) -> tuple[list[bytes], list[bytes]]:
    """(question, answer) words of an item."""
    parts = [w for w in map(split_words, _SENTENCE.split(text)) if w]
    if len(parts) > 1:
        return [w for p in parts[:-1] for w in p], parts[-1]
    only = parts[0] if parts else []
    return only[: (len(only) + 1) // 2], only[(len(only) + 1) // 2 :]


def shingles(tokens: list[bytes], n: int) -> set[tuple[bytes, ...]]:
    if not tokens:
        return set()
    return {tuple(tokens[i : i + n]) for i in range(max(1, len(tokens) - n + 1))}


def overlap(part: list[bytes], passage: set[tuple[bytes, ...]], tokens: list[bytes], n: int) -> float:
    """Share of a part's shingles that a passage has; parts of fewer than n words are looked for as one run."""
    own = shingles(part, n)
    if not own:
        return 1.0
    if len(part) < n:
        m = len(part)
        return float(any(tokens[i : i + m] == part for i in range(len(tokens) - m + 1)))
    return len(own & passage) / len(own)


class BlockMaxIndex:
    """Postings by term with block maxima; picklable, built on the driver from a bounded shard.

    ``items``: (id, text, {word: items that hold it}) of the shard; ``total`` and ``mean``: number and mean
    length of all items.
    """

    def __init__(self, items: list[tuple[int, str, dict[bytes, int]]], total: int, mean: float, width: int, shingle: int, similarity: float):
        self.width, self.shingle, self.similarity = width, shingle, similarity
        self.items = [(i, *question_answer(t)) for i, t, _ in items]
        segments = []
        for k, (_, q, a) in enumerate(self.items):
            w = q + a
            segments += [(len(w[at : at + SEGMENT_WORDS]), k, at) for at in range(0, len(w), SEGMENT_WORDS)]
        segments.sort()
        self.item = np.array([k for _, k, _ in segments], np.int64)
        self.blocks = -(-len(segments) // BLOCK_SEGMENTS)
        number: dict[bytes, int] = {}
        term, segment, weight = [], [], []
        for j, (n, k, at) in enumerate(segments):
            w, frequency, made = (self.items[k][1] + self.items[k][2])[at : at + SEGMENT_WORDS], items[k][2], {}
            for t, tf in Counter(w).items():
                df = frequency[t]
                made[t] = np.log(1 + (total - df + 0.5) / (df + 0.5)) * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n / mean))
            lost = self._lost(w)
            heavy = sorted(made.values(), reverse=True)
            least = sum(heavy[lost:]) or min(heavy)
            for t, x in made.items():
                term.append(number.setdefault(t, len(number)))
                segment.append(j)
                weight.append(x / least)
        by_term = np.argsort(np.array(term, np.int32), kind="stable")  # segments of a term stay in order
        term = np.array(term, np.int64)[by_term]
        self.segment, self.weight = np.array(segment, np.int32)[by_term], np.array(weight, np.float32)[by_term]
        self.start = np.searchsorted(term, np.arange(len(number) + 1))
        self.top = np.maximum.reduceat(self.weight, self.start[:-1]) if len(number) else self.weight
        edge = np.flatnonzero(np.append(True, (term[1:] != term[:-1]) | (self.segment[1:] // BLOCK_SEGMENTS != self.segment[:-1] // BLOCK_SEGMENTS))) if len(term) else np.zeros(0, np.int64)
        self.block, self.block_max = self.segment[edge] // BLOCK_SEGMENTS, np.maximum.reduceat(self.weight, edge) if len(edge) else self.weight
        self.block_start = np.searchsorted(term[edge], np.arange(len(number) + 1))
        flat = np.frombuffer(b"".join(number), np.uint8)
        size = np.array([len(w) for w in number], np.int64)
        ends = np.cumsum(size)
        mark = Rolling(flat, 11).of(ends - size, ends) if number else np.zeros(0, np.uint64)
        self.order = np.argsort(mark).astype(np.int32)
        self.mark = mark[self.order]

    def _lost(self, w: list[bytes]) -> int:
        """Distinct words that a verified passage can miss, at most."""
        positions = max(1, len(w) - self.shingle + 1)
        free = int((1 - self.similarity) * len(w) + 1e-9)
        return free if len(shingles(w, self.shingle)) == positions else min(2 * free, len(w) - 1)

    def terms(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Term number of each word, or -1 for others."""
        mark = Rolling(data, 11).of(start, end)
        at = np.minimum(np.searchsorted(self.mark, mark), len(self.mark) - 1)
        return np.where(self.mark[at] == mark, self.order[at], -1)

    def _open_blocks(self, half: np.ndarray, term: np.ndarray, owner: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(window, open blocks) of the windows that have any; a window is a half and the next one of its document.

        half, term: each half's distinct terms, by half.
        """
        n = len(owner)
        follows = np.append(owner[1:] == owner[:-1], False)
        most = np.bincount(half, weights=self.top[term], minlength=n)
        reached = most + np.where(follows, np.append(most[1:], 0.0), 0.0) >= 1.0 - SLACK
        wanted = reached.copy()
        wanted[1:] |= reached[:-1] & follows[:-1]
        some = wanted[half]
        half, term = half[some], term[some]
        step = max(2, (1 << 21) // self.blocks)
        for a in range(0, n, step):
            b = min(n, a + step + 1)  # one more, for the last window
            low, high = np.searchsorted(half, [a, b])
            if low == high or not reached[a:b].any():
                continue
            h, t = half[low:high] - a, term[low:high]
            bound = np.zeros((b - a) * self.blocks)
            size = self.block_start[t + 1] - self.block_start[t]
            ends = np.cumsum(size)
            at = 0
            while at < len(t):  # as many terms as their postings allow
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + (1 << 20), side="right")))
                n_each = size[at:to]
                where = np.repeat(self.block_start[t[at:to]] - np.cumsum(n_each) + n_each, n_each) + np.arange(int(n_each.sum()))
                bound += np.bincount(np.repeat(h[at:to], n_each) * self.blocks + self.block[where], weights=self.block_max[where], minlength=len(bound))
                at = to
            bound = bound.reshape(b - a, self.blocks)
            window = bound[: min(step, n - a)].copy()
            next_too = np.flatnonzero(follows[a : a + len(window)])
            window[next_too] += bound[next_too + 1]
            near = window >= 1.0 - SLACK
            for w in np.flatnonzero(near.any(axis=1)).tolist():
                yield a + w, np.flatnonzero(near[w])

    def wand(self, terms: np.ndarray, blocks: np.ndarray) -> list[tuple[int, float]]:
        """(segment, score) of all segments at the threshold in the open blocks, for a passage's distinct terms."""
        theta = 1.0 - SLACK
        # a cursor: [segment it stands at, term's largest weight, segments, weights, place, term]
        cursors = []
        for t in terms.tolist():
            segments = self.segment[self.start[t] : self.start[t + 1]].tolist()
            cursors.append([segments[0], float(self.top[t]), segments, self.start[t], 0, t])
        opened = blocks.tolist()
        end = self.blocks * BLOCK_SEGMENTS  # stands behind all segments
        found = []

        def move(cursor: list, to: int) -> None:
            place = bisect_left(cursor[2], to, cursor[4])
            cursor[4] = place
            cursor[0] = cursor[2][place] if place < len(cursor[2]) else end

        while True:
            cursors.sort(key=lambda c: c[0])
            most, p = 0.0, 0
            while p < len(cursors) and cursors[p][0] < end:
                most += cursors[p][1]
                if most >= theta:
                    break
                p += 1
            else:
                return found
            pivot = cursors[p][0]
            while p + 1 < len(cursors) and cursors[p + 1][0] == pivot:
                p += 1
            block = pivot // BLOCK_SEGMENTS
            place = bisect_left(opened, block)
            if place == len(opened):
                return found
            if opened[place] != block:  # closed up to there
                for c in cursors[: p + 1]:
                    move(c, opened[place] * BLOCK_SEGMENTS)
                continue
            if sum(self._block_max(c[5], block) for c in cursors[: p + 1]) < theta:
                # nothing before the block's end or the next cursor can reach the threshold
                after = min((block + 1) * BLOCK_SEGMENTS, cursors[p + 1][0] if p + 1 < len(cursors) else end)
                for c in cursors[: p + 1]:
                    move(c, after)
                continue
            if cursors[0][0] == pivot:
                score = 0.0
                for c in cursors[: p + 1]:
                    score += float(self.weight[c[3] + c[4]])
                    move(c, pivot + 1)
                if score >= theta:
                    found.append((pivot, score))
            else:
                for c in cursors[: p + 1]:
                    move(c, pivot)

    def _block_max(self, term: int, block: int) -> float:
        low, high = self.block_start[term], self.block_start[term + 1]
        at = low + int(self.block[low:high].searchsorted(block))
        return float(self.block_max[at]) if at < high and self.block[at] == block else 0.0

    def find(self, data: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, int, float, float, float]]:
        """(row, item, first word, score, question overlap, answer overlap) of verified matches, one for each row and item."""
        if not len(self.mark):
            return []
        lowered = plain(data)
        start, end, row = words(lowered, offsets)
        if not len(start):
            return []
        n = len(offsets) - 1
        count = np.bincount(row, minlength=n)
        base = np.cumsum(count) - count
        halves = np.maximum(1, -(-count // self.width))
        half_base = np.cumsum(halves) - halves
        nth = np.arange(len(start)) - base[row]
        half = half_base[row] + nth // self.width
        term = self.terms(lowered, start, end)
        some = np.flatnonzero(term >= 0)
        if not len(some):
            return []
        size = len(self.mark)
        own_half, own_term = np.divmod(np.unique(half[some] * np.int64(size) + term[some]), np.int64(size))
        owner = np.repeat(np.arange(n), halves)
        found: dict[tuple[int, int], tuple] = {}
        for w, blocks in self._open_blocks(own_half, own_term, owner):
            r = int(owner[w])
            first = int(base[r] + (w - half_base[r]) * self.width)
            last = int(min(first + 2 * self.width, base[r] + count[r]))
            distinct = np.unique(own_term[np.searchsorted(own_half, w) : np.searchsorted(own_half, w + 2 if w + 1 < len(owner) and owner[w + 1] == r else w + 1)])
            for j, score in self.wand(distinct, blocks):
                k = int(self.item[j])
                if (r, k) in found:
                    continue
                item, q, a = self.items[k]
                more = max(0, len(q) + len(a) - self.width)
                x, y = max(int(base[r]), first - more), min(int(base[r] + count[r]), last + more)
                tokens = split_words(lowered[start[x] : end[y - 1]].tobytes())
                have = shingles(tokens, self.shingle)
                oq, oa = overlap(q, have, tokens, self.shingle), overlap(a, have, tokens, self.shingle)
                if oq >= self.similarity and oa >= self.similarity:
                    found[r, k] = (r, item, x - int(base[r]), score, oq, oa)
        return sorted(found.values())


def _search(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(1))
            ids = batch.column(0)
            for a, b in blocks(offsets):
                rows = own.find(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])
                if rows:
                    r, *rest = zip(*rows, strict=True)
                    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64()]
                    yield pa.RecordBatch.from_arrays([ids.take(pa.array(np.array(r) + a)), *[pa.array(x, k) for x, k in zip(rest, kinds, strict=True)]], names=["_i", "item_id", "first_word", "score", "question_overlap", "answer_overlap"])

    return run


def _clean_rows(index, text_col: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = index.value
        for batch in batches:
            data, offsets = text_buffer(batch.column(text_col))
            clean = np.ones(batch.num_rows, bool)
            for a, b in blocks(offsets):
                clean[[a + r[0] for r in own.find(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a])]] = False
            yield batch.filter(pa.array(clean))

    return run


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items with their number of words and the distinct ones."""
    for batch in batches:
        made = [split_words(t) for t in batch.column("text").to_pylist()]
        distinct = pa.array([sorted(set(w)) for w in made], pa.list_(pa.binary()))
        yield pa.RecordBatch.from_arrays([batch.column("item_id"), batch.column("text"), pa.array([len(w) for w in made], pa.int64()), distinct], names=["item_id", "text", "n", "words"])


def _indexes(benchmark: DataFrame, shingle: int, similarity: float):
    """Broadcast indexes of the benchmark, one for each shard of bounded size; one is held at a time."""
    ship(benchmark.sparkSession)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).filter("item_id is not null and text is not null")
    items = items.mapInArrow(_item_words, "item_id long, text string, n long, words array<binary>").filter("n > 0")
    items = checkpoint(items.withColumn("_k", F.monotonically_increasing_id()))
    size = items.agg(F.count("*").alias("items"), F.sum("n").alias("words"), F.max("n").alias("longest")).first()
    each = items.select("_k", F.explode("words").alias("w"))
    frequency = each.join(each.groupBy("w").agg(F.count("*").alias("df")), "w").groupBy("_k").agg(F.collect_list(F.struct("w", "df")).alias("frequency"))
    send = benchmark.sparkSession.sparkContext.broadcast
    out, shard, segments, text = [], [], 0, 0

    def close() -> None:
        out.append(send(BlockMaxIndex(shard, size["items"], size["words"] / size["items"], min(size["longest"], SEGMENT_WORDS), shingle, similarity)))

    for r in items.drop("words").join(frequency, "_k").orderBy("item_id", "text", "_k").toLocalIterator():
        n, b = -(-r["n"] // SEGMENT_WORDS), len(r["text"].encode())
        if shard and (segments + n > SHARD_SEGMENTS or text + b > SHARD_BYTES):
            close()
            shard, segments, text = [], 0, 0
        shard.append((r["item_id"], r["text"], {bytes(x["w"]): x["df"] for x in r["frequency"]}))
        segments, text = segments + n, text + b
    if shard:
        close()
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Returns (id, item_id, first_word, score, question_overlap, answer_overlap) for each document and item it holds.

    score: the passage's BM25 score over the least that a verified passage can have.
    """
    schema = "_i long, item_id long, first_word long, score double, question_overlap double, answer_overlap double"
    own = docs.select(F.col(id_col).cast("long").alias("_i"), F.col(text_col).alias("_t"))
    found = [own.mapInArrow(_search(x), schema) for x in _indexes(benchmark, shingle, similarity)]
    out = docs.sparkSession.createDataFrame([], schema) if not found else found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("_i", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", *, shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item; no exchange."""
    for index in _indexes(benchmark, shingle, similarity):
        docs = docs.mapInArrow(_clean_rows(index, text_col), docs.schema)
    return docs
