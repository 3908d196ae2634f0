"""Suffix-order deduplication: longest-previous-factor decisions at byte level (operator 5).

A byte goes when it lies in a string of ``min_bytes`` bytes that also starts somewhere else
(``keep="none"``) or that also starts earlier (``keep="first"``; earlier: smaller id, a null
id first, then smaller offset).  Texts are UTF-8 bytes, matches never cross documents, and strings are judged
on the input.

How the suffix order is spread over a cluster
---------------------------------------------
1. *Shards.*  Each window of ``min_bytes`` bytes is owned by the anchor with the smallest
   fingerprint among its ``ANCHOR_BYTES``-grams.  The choice depends on the window's bytes alone,
   so equal windows have equal anchors: the anchor is the shard key, and no match crosses shards.
   Consecutive windows with one anchor form a *stretch*, which is what gets counted and moved:
   about one for each 150 bytes of text, carrying hashes, no text.  Anchors are counted before; one that
   occurs once in all texts has no repeated window, and its stretch is left out.  Which do repeat is told to
   the tasks by a bitmap of at most ``FILTER_BITS`` bits; an anchor that shares its bit with a repeated one passes and
   is settled by the next step, so the bitmap's size bears on work, not on results.
2. *Whole stretches.*  Counting (anchor, digest of the stretch) with map-side partial sums
   settles exact repeats, however many copies there are, with one row per task and key.  Anchor and
   digest are two 64-bit polynomial fingerprints of different byte ranges; two different stretches
   are taken for equal only if both collide, about n * n / 2 ** 129 for n stretches of unrelated
   bytes.  (Polynomials modulo 2 ** 64 have colliding texts that can be constructed; random odd values
   for the bytes and the finaliser keep such texts from being the same for every table, not for an
   adversary who knows the seed.)
3. *Suffix order.*  Where one anchor has several different stretches, one representative of each
   is sent to the anchor's shard with its bytes.  There the windows' suffixes are put in suffix
   order to depth ``min_bytes`` (so suffixes that share a prefix of that length are neighbours,
   which neighbouring bytes then confirm), and previous and next smaller positions within a run
   of neighbours say whether the longest previous factor reaches ``min_bytes``.
4. *Removal.*  Verdicts go back to their documents, whose windows are found again by the same
   deterministic rule.

A second rule of another length (``also``) runs through the same steps beside the first: its anchors and digests are
salted, so no stretch of one meets one of the other, and the texts are moved once for both.

Cases: ids are integers, or text that reads as one; a null text is an empty one; texts shorter than ``min_bytes`` are kept whole; a very
long text is a block of its own, moved and held whole by one task; an empty
table gives an empty result; rows repeated with the same id and text count as further copies
under ``keep="none"`` and as one document under ``keep="first"``; other columns of the input are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import checkpoint, lookup, ship
from catlink.llm.textbytes import Rolling, blocks, fmix, sliding_argmin, text_buffer

ANCHOR_BYTES = 48
SHARD_BYTES = 1 << 20
NEED, FULL, OWNER = 1, 2, 4
#: Bits, as a power of two, of the bitmap of repeated anchors at most (32 MB), and the parts in which it is made.
FILTER_BITS, FILTER_PARTS = 28, 64
#: Sets the keys of each further rule apart.
SALT = 0x9E3779B97F4A7C15
#: Stands for a null id, which is the earliest.
NO_ID = -(2**63)


def stretches(data: np.ndarray, offsets: np.ndarray, *lengths: int):
    """(row, first window, windows, anchor key, digest, rule) of each stretch of windows that share an anchor, by rule."""
    none, bare = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    found = [(none, none, none, bare, bare, none)]
    rolling = Rolling(data, 5) if len(data) >= min(lengths) else None
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(len(data))
    grams = {g: rolling.grams(g) for g in {min(ANCHOR_BYTES, x) for x in lengths if x <= len(data)}}
    for rule, length in enumerate(lengths):
        if len(data) < length:
            continue
        gram = min(ANCHOR_BYTES, length)
        anchor = sliding_argmin(grams[gram], length - gram + 1)
        total = len(anchor)
        inside = room[:total] >= length
        change = np.ones(total, bool)
        change[1:] = (anchor[1:] != anchor[:-1]) | ~inside[:-1]
        cuts = offsets[:-1]
        change[cuts[cuts < total]] = True
        first = np.flatnonzero(change & inside)
        edges = np.append(np.flatnonzero(change | ~inside), total)
        end = edges[np.searchsorted(edges, first, side="right")]
        salt = np.uint64(rule * SALT % 2**64)
        digest = rolling.of(first, end - 1 + length) ^ salt
        row = np.searchsorted(offsets, first, side="right") - 1
        found.append((row, first, end - first, grams[gram][anchor[first]] ^ salt, digest, np.full(len(row), rule)))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def lpf_reaches(data: np.ndarray, starts: np.ndarray, position: np.ndarray, length: int, rolling: Rolling):
    """(repeated, earlier): does the suffix at each start share ``length`` bytes with another, and with an earlier one.

    Suffixes are sorted by their first eight bytes and then by the fingerprint of their first
    ``length`` bytes, so equal prefixes are neighbours.  A suffix's longest previous factor reaches
    ``length`` just when a smaller position stands before it (previous smaller) or after it (next
    smaller) in its run of neighbours with at least that common prefix.
    """
    n = len(starts)
    if n == 0:
        return np.zeros(0, bool), np.zeros(0, bool)
    mark = rolling.of(starts, starts + length)
    # only suffixes whose prefix occurs twice can have a neighbour at that depth
    order = np.argsort(mark, kind="stable")
    same = mark[order][1:] == mark[order][:-1]
    tied = np.zeros(n, bool)
    tied[order[1:][same]] = True
    tied[order[:-1][same]] = True
    repeated, earlier = np.zeros(n, bool), np.zeros(n, bool)
    some = np.flatnonzero(tied)
    if len(some) == 0:
        return repeated, earlier
    view = np.lib.stride_tricks.sliding_window_view(data, length)
    head = np.zeros(len(some), np.uint64)
    for i in range(8):
        head = (head << np.uint64(8)) | data[starts[some] + i].astype(np.uint64)
    some = some[np.lexsort((position[some], mark[some], head))]
    at, pos = starts[some], position[some]
    joined = np.zeros(len(some), bool)  # shares `length` bytes with the neighbour before
    for a in range(1, len(some), 4096):
        b = min(a + 4096, len(some))
        hit = np.flatnonzero(mark[some[a:b]] == mark[some[a - 1 : b - 1]]) + a
        joined[hit] = (view[at[hit]] == view[at[hit - 1]]).all(axis=1)
    run = np.cumsum(~joined)
    span = int(pos.max()) + 1
    before = np.minimum.accumulate(pos - run * span)
    psv = np.zeros(len(some), bool)
    psv[1:] = joined[1:] & (before[:-1] + run[1:] * span < pos[1:])
    back = np.minimum.accumulate((pos + run * span)[::-1])[::-1]
    nsv = np.zeros(len(some), bool)
    nsv[:-1] = joined[1:] & (back[1:] - run[:-1] * span < pos[:-1])
    repeated[some] = joined
    repeated[some[:-1][joined[1:]]] = True
    earlier[some] = psv | nsv
    return repeated, earlier


def _anchors(*lengths: int):
    """(anchor key, stretches) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            for a, b in blocks(offsets):
                key, count = np.unique(stretches(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], *lengths)[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(count.astype(np.int64))], names=["_k", "_c"])

    return run


def _bitmap_parts(bits: int):
    """(part, its bits) of each part of the bitmap; a partition holds all keys of its parts."""
    size = (1 << bits) // FILTER_PARTS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: dict[int, np.ndarray] = {}
        for batch in batches:
            at = batch.column("_at").to_numpy()
            for part in np.unique(at // size).tolist():
                mine = at[at // size == part] - part * size
                np.bitwise_or.at(parts.setdefault(part, np.zeros(size // 8, np.uint8)), mine >> 3, (1 << (mine & 7)).astype(np.uint8))
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(list(parts), pa.int64()), pa.array([x.tobytes() for x in parts.values()], pa.binary())], names=["_part", "_bits"])

    return run


def _repeated_anchors(own: DataFrame, *lengths: int) -> np.ndarray:
    """The bitmap of the anchors that occur twice at least, by the lower bits of their keys."""
    spark = own.sparkSession
    keys = own.select("_t").mapInArrow(_anchors(*lengths), "_k long, _c long").groupBy("_k").agg(F.sum("_c").alias("_c"))
    keys = checkpoint(keys.filter("_c >= 2").select("_k"))
    bits = min(max(13, (8 * keys.count()).bit_length()), FILTER_BITS)
    at = keys.select(F.col("_k").bitwiseAND((1 << bits) - 1).alias("_at"))
    dealt = at.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), F.shiftright("_at", bits - FILTER_PARTS.bit_length() + 1))
    bitmap = np.zeros((FILTER_PARTS, (1 << bits) // FILTER_PARTS // 8), np.uint8)
    for part in dealt.mapInArrow(_bitmap_parts(bits), "_part long, _bits binary").collect():
        bitmap[part["_part"]] = np.frombuffer(part["_bits"], np.uint8)
    return bitmap.ravel()


def _passes(bitmap: np.ndarray, key: np.ndarray) -> np.ndarray:
    at = key & np.uint64(8 * len(bitmap) - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _count_stretches(*lengths: int, repeated=None):
    """``repeated``: a broadcast bitmap; anchors that it does not hold are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            rid = batch.column("_r").to_numpy(zero_copy_only=False)
            ids = batch.column("_i").to_numpy(zero_copy_only=False)
            for a, b in blocks(offsets):
                row, _, _, key, digest, _ = stretches(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], *lengths)
                if repeated is not None:
                    some = _passes(repeated.value, key)
                    row, key, digest = row[some], key[some], digest[some]
                if len(row) == 0:
                    continue
                order = np.lexsort((digest, key, row))
                row, key, digest = row[order], key[order], digest[order]
                new = np.ones(len(row), bool)
                new[1:] = (row[1:] != row[:-1]) | (key[1:] != key[:-1]) | (digest[1:] != digest[:-1])
                at = np.flatnonzero(new)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[row[at] + a]), pa.array(ids[row[at] + a]), pa.array(key[at].view(np.int64)), pa.array(digest[at].view(np.int64)), pa.array(np.diff(np.append(at, len(row))).astype(np.int64))],
                    names=["_r", "_i", "_k", "_d", "_c"],
                )

    return run


def _combined(row: np.ndarray, digest: np.ndarray) -> np.ndarray:
    return fmix(digest ^ fmix(row.astype(np.uint64) + np.uint64(1)))


def _list_items(column) -> tuple[np.ndarray, pa.Array]:
    """(row, flattened values) of a list column; null lists are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(pc.list_parent_indices(column)), column.flatten()


def _send_bytes(*lengths: int):
    """The bytes of the stretches that a document is to send to its anchors' shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            rid, ids = batch.column("_r").to_numpy(zero_copy_only=False), batch.column("_i")
            owner, wanted = _list_items(batch.column("_w"))
            wanted = wanted.to_numpy(zero_copy_only=False).view(np.uint64)
            for a, b in blocks(offsets):
                x = data[offsets[a] : offsets[b]]
                row, first, count, key, digest, rule = stretches(x, offsets[a : b + 1] - offsets[a], *lengths)
                if len(row) == 0:
                    continue
                mine = (owner >= a) & (owner < b)
                asked = np.sort(_combined(owner[mine], wanted[mine]))
                if len(asked) == 0:
                    continue
                have = _combined(row + a, digest)
                at = np.minimum(np.searchsorted(asked, have), len(asked) - 1)
                hit = np.flatnonzero(asked[at] == have)
                _, once = np.unique(have[hit], return_index=True)  # the first of equal stretches of a document
                hit = np.sort(hit[once])
                local = offsets[a : b + 1] - offsets[a]
                end = first + count - 1 + np.array(lengths)[rule]
                pieces = [x[s:e].tobytes() for s, e in zip(first[hit].tolist(), end[hit].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(key[hit].view(np.int64)),
                        pa.array(digest[hit].view(np.int64)),
                        pa.array(rid[row[hit] + a]),
                        ids.take(pa.array(row[hit] + a)),
                        pa.array(first[hit] - local[row[hit]]),
                        pa.array(pieces, pa.binary()),
                        pa.array(rule[hit]),
                    ],
                    names=["_k", "_d", "_r", "_i", "_p", "_b", "_l"],
                )

    return run


def _judge(table: pa.Table, length: int) -> pa.RecordBatch | None:
    data, offsets = text_buffer(table["_b"])
    sizes = np.diff(offsets)
    count = sizes - length + 1
    ids = table["_i"].to_numpy()
    rid, at = table["_r"].to_numpy(), table["_p"].to_numpy()
    rank = np.empty(len(ids), np.int64)
    rank[np.lexsort((at, rid, ids))] = np.arange(len(ids))
    base = np.repeat(offsets[:-1], count)
    shift = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    rolling = Rolling(data, 5)
    repeated, earlier = lpf_reaches(data, base + shift, np.repeat(rank, count) * (length + 1) + shift, length, rolling)
    ends = np.cumsum(count)
    some = np.flatnonzero(np.add.reduceat(repeated, ends - count)) if len(count) else np.zeros(0, np.int64)
    if len(some) == 0:
        return None
    bits = lambda flags: pa.array([np.packbits(flags[ends[j] - count[j] : ends[j]]).tobytes() for j in some.tolist()], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(rid[some]), pa.array(table["_d"].to_numpy()[some]), bits(repeated), bits(earlier)], names=["_r", "_d", "_any", "_early"]
    )


def _judge_shards(*lengths: int):
    """Streams a partition sorted by anchor; holds whole anchors, about SHARD_BYTES at a time."""

    def judged(held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        table = pa.concat_tables(held)
        for rule, length in enumerate(lengths):
            part = table.filter(pc.equal(table["_l"], rule))
            if part.num_rows and (out := _judge(part, length)) is not None:
                yield out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []
        size = 0
        for batch in batches:
            table = pa.Table.from_batches([batch])
            while table.num_rows:
                room = np.searchsorted(text_buffer(table["_b"])[1], SHARD_BYTES)
                part, table = table.slice(0, int(max(1, room))), table.slice(int(max(1, room)))
                if size > SHARD_BYTES:
                    last = held[-1]["_k"][-1].as_py()
                    keys = part["_k"].to_numpy()
                    cut = int(np.argmax(keys != last)) if (keys != last).any() else len(keys)
                    held.append(part.slice(0, cut))
                    size += part.slice(0, cut).nbytes
                    part = part.slice(cut)
                    if part.num_rows == 0:
                        continue
                    yield from judged(held)
                    held, size = [], 0
                held.append(part)
                size += part.nbytes
        if held:
            yield from judged(held)

    return run


def _remove(*rules: tuple[int, str, bool]):
    """``rules``: (length, keep, whole characters) of each."""
    names = ["_i", "n_bytes", "carried", *(f"{n}{j or ''}" for j in range(len(rules)) for n in ("n_removed", "n_spans", "kept"))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("_t"))
            owner, said = _list_items(batch.column("_v"))
            fields = {n: said.field(n) for n in ("_d", "_f", "_any", "_early")}
            digests = fields["_d"].to_numpy(zero_copy_only=False).view(np.uint64)
            flags = fields["_f"].to_numpy(zero_copy_only=False)
            for a, b in blocks(offsets):
                x, local = data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
                deltas = [np.zeros(len(x) + 1, np.int32) for _ in rules]
                mine = np.flatnonzero((owner >= a) & (owner < b))
                if len(mine):
                    row, first, count, _, digest, rule = _stretches_of(x, local, np.unique(owner[mine] - a), *(r[0] for r in rules))
                    verdict = _combined(owner[mine], digests[mine])
                    order = np.argsort(verdict, kind="stable")
                    verdict, mine = verdict[order], mine[order]
                    have = _combined(row + a, digest)
                    at = np.minimum(np.searchsorted(verdict, have), len(verdict) - 1)
                    hit = np.flatnonzero(verdict[at] == have)
                    at = at[hit]
                    opening = np.zeros(len(hit), bool)
                    opening[np.unique(at, return_index=True)[1]] = True
                    for r, ((length, keep, _), delta) in enumerate(zip(rules, deltas, strict=True)):
                        f = flags[mine[at]]
                        own = rule[hit] == r
                        full = own & (f & FULL > 0) & ((keep == "none") | (f & OWNER == 0) | ~opening)
                        s, c = first[hit[full]], count[hit[full]]
                        np.add.at(delta, s, 1)
                        np.add.at(delta, s + c - 1 + length, -1)
                        said_bits = fields["_any" if keep == "none" else "_early"]
                        for j in np.flatnonzero(own & ~full).tolist():
                            bits = said_bits[int(mine[at[j]])].as_py()
                            if bits:
                                start = int(first[hit[j]]) + np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), count=int(count[hit[j]])))
                                delta[start] += 1
                                delta[start + length] -= 1
                columns = [batch.column("_i").slice(a, b - a), pa.array(np.diff(local)), batch.column("carried").slice(a, b - a)]
                for (_, _, whole_chars), delta in zip(rules, deltas, strict=True):
                    gone = np.cumsum(delta[:-1]) > 0
                    columns += _left(x, local, _whole_characters(x, gone) if whole_chars else gone)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _stretches_of(x: np.ndarray, local: np.ndarray, rows: np.ndarray, *lengths: int):
    """The stretches of some rows only, which are in ascending order."""
    sizes = np.diff(local)
    asked = np.zeros(len(sizes), bool)
    asked[rows] = True
    short = np.concatenate([[0], np.cumsum(sizes[rows])])
    row, first, *others = stretches(x[np.repeat(asked, sizes)], short, *lengths)
    return rows[row], first - short[row] + local[rows[row]], *others


def _left(x: np.ndarray, local: np.ndarray, gone: np.ndarray) -> list[pa.Array]:
    """Bytes removed, spans and the bytes that are left, for each text."""
    edge = gone.copy()
    edge[1:] &= ~gone[:-1]
    cuts = local[:-1][local[:-1] < len(x)]
    edge[cuts] = gone[cuts]
    sums = np.concatenate([[0], np.cumsum(gone)])
    starts = np.concatenate([[0], np.cumsum(edge)])
    removed = sums[local[1:]] - sums[local[:-1]]
    kept_ends = (local - sums[local]).astype(np.int32)
    kept = pa.Array.from_buffers(pa.binary(), len(local) - 1, [None, pa.py_buffer(kept_ends.tobytes()), pa.py_buffer(x[~gone].tobytes())])
    return [pa.array(removed.astype(np.int64)), pa.array((starts[local[1:]] - starts[local[:-1]]).astype(np.int64)), kept]


def _whole_characters(x: np.ndarray, gone: np.ndarray) -> np.ndarray:
    """Shrinks removals to whole characters: one that is only partly covered stays."""
    lead = (x & 0xC0) != 0x80
    char = np.cumsum(lead)
    partly = np.zeros(int(char[-1]) + 1 if len(char) else 1, bool)
    partly[char[~gone]] = True
    return gone & ~partly[char]


def suffix_dedup(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *, min_bytes: int = 400, keep: str = "none", whole_chars: bool = False, carry: tuple[str, ...] = (), also: tuple[int, str, bool] | None = None
) -> DataFrame:
    """Returns (id, n_bytes, n_removed, n_spans, kept binary, carried), one row for each input row.

    ``whole_chars``: never cut inside a UTF-8 character.  ``carry``: columns to keep, in the struct
    ``carried`` (left out without any).  ``also``: (min_bytes, keep, whole_chars) of a second rule, judged on the
    input too; its n_removed1, n_spans1 and kept1 follow.
    """
    rules = [(min_bytes, keep, whole_chars), *([also] if also else [])]
    lengths = [r[0] for r in rules]
    if not all(r[1] in ("none", "first") for r in rules):
        raise ValueError("keep: none or first")
    if min(lengths) < 16:
        raise ValueError("min_bytes: 16 at least")
    ship(docs.sparkSession)
    own_id = F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))
    own = docs.select(own_id.alias("_i"), F.col(text_col).alias("_t")).withColumn("_r", F.xxhash64("_i", "_t"))
    repeated = docs.sparkSession.sparkContext.broadcast(_repeated_anchors(own, *lengths))
    counted = checkpoint(own.mapInArrow(_count_stretches(*lengths, repeated=repeated), "_r long, _i long, _k long, _d long, _c long"))
    repeated.unpersist()
    order = F.min(F.struct(F.col("_i"), F.col("_r")))
    by_stretch = counted.groupBy("_k", "_d").agg(F.sum("_c").alias("_n"), order.alias("_first"))
    # kinds of an anchor are counted by partial sums, and a hot anchor's stretches aren't gathered to learn the count
    kinds = by_stretch.groupBy("_k").agg(F.count("*").alias("_kinds"))
    kinds = kinds.withColumn("_rows", F.col("_kinds"))
    # there are no more stretches than counted rows, so the bound on hot anchors holds
    status = lookup(by_stretch, kinds, "_k", counted.count(), "_rows").filter("_n >= 2 or _kinds >= 2")
    status = status.select("_k", "_d", F.col("_first._r").alias("_owner"), (F.when(F.col("_kinds") >= 2, NEED).otherwise(0) + F.when(F.col("_n") >= 2, FULL).otherwise(0)).alias("_s"))
    told = counted.select("_r", "_k", "_d").distinct().join(status, ["_k", "_d"]).withColumn("_f", F.col("_s") + F.when(F.col("_r") == F.col("_owner"), OWNER).otherwise(0)).select("_r", "_d", "_f")
    told = checkpoint(told)
    sender = (F.col("_f").bitwiseAND(NEED) > 0) & (F.col("_f").bitwiseAND(OWNER) > 0)
    asked = told.filter(sender).groupBy("_r").agg(F.collect_list("_d").alias("_w"))
    sent = own.join(asked, "_r").select("_r", "_i", "_t", "_w").mapInArrow(_send_bytes(*lengths), "_k long, _d long, _r long, _i long, _p long, _b binary, _l long")
    sent = sent.repartition("_k").sortWithinPartitions("_k", "_d", "_r")
    judged = sent.mapInArrow(_judge_shards(*lengths), "_r long, _d long, _any binary, _early binary")
    verdicts = told.join(judged, ["_r", "_d"], "left").filter((F.col("_f").bitwiseAND(FULL) > 0) | F.col("_any").isNotNull())
    verdicts = verdicts.groupBy("_r").agg(F.collect_list(F.struct("_d", "_f", "_any", "_early")).alias("_v"))
    whole = docs.select(own_id.alias("_i"), F.col(text_col).alias("_t"), (F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.struct(F.lit(0).alias("none"))).alias("carried")).withColumn("_r", F.xxhash64("_i", "_t"))
    final = whole.join(verdicts, "_r", "left").select("_i", "_t", "_v", "carried")
    kind = final.schema["carried"].dataType.simpleString()
    own_columns = [(f"{n}{j or ''}", t) for j in range(len(rules)) for n, t in (("n_removed", "long"), ("n_spans", "long"), ("kept", "binary"))]
    out = final.mapInArrow(_remove(*rules), f"_i long, n_bytes long, carried {kind}, " + ", ".join(f"{n} {t}" for n, t in own_columns))
    out = out.select(F.when(F.col("_i") != NO_ID, F.col("_i")).alias(id_col), "n_bytes", *[n for n, _ in own_columns], "carried")
    return out if carry else out.drop("carried")
