"""BPE encoding and decoding of whole texts with an existing vocabulary file (operator 10).

Reads the public JSON format of word-end BPE tokenizers (normalise: NFC, white space runs to one
space, lower case; split by the file's pattern; bytes as printable characters; word-end suffix).
Each short word is merged in a *contiguous rank array*: one list of part ids, whose gaps are the
boundaries, and one list with the rank of each adjacent pair.  The smallest rank is scanned for,
its boundary deleted, and the two neighbouring ranks refreshed.  Words of more than
``SHORT_WORD`` bytes take a heap over linked parts instead, so that a run of a million letters
costs n log n.  Words are cached per task, in a bounded cache.

Cases: a null text is an empty one (no ids, empty decoded text); strings of special tokens in a
text become their ids, as in the library; letters and numbers that the installed ``regex`` knows
from a later Unicode version than the library (1,862 code points of Unicode 17) may split otherwise; rows are independent, so repeated ids, other columns
and empty tables need nothing more.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catlink.functions.runtime import ship

SHORT_WORD = 256
CACHE_WORDS = 200_000
OUT_BYTES = 8 << 20
NO_PAIR = 1 << 60
#: White space as the format's regular expressions take it (the Unicode property).
WHITE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def printable_bytes() -> list[str]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for U+0100 onwards."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """The tokenizer of one vocabulary file, given as its JSON text."""

    def __init__(self, text: str):
        spec = json.loads(text)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.specials = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.tokens = {i: t for t, i in self.vocab.items()} | {i: t for t, i in self.specials.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        #: (left id, right id) -> rank, and rank -> merged id
        self.rank = {(self.vocab[a], self.vocab[b]): r for r, (a, b) in enumerate(pairs)}
        self.merged = [self.vocab[a + b] for a, b in pairs]
        self.alphabet = printable_bytes()
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"]
        self.words = regex.compile(split).findall
        self.white = regex.compile(f"[{WHITE}]+").sub
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.cache = _Cache(self)

    def normalise(self, text: str) -> str:
        if not text.isascii():
            if not unicodedata.is_normalized("NFC", text):
                text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # each character is lowered alone: no final sigma
        return self.white(" ", text).lower()

    def merge(self, word: str) -> list[int]:
        letters = [self.alphabet[b] for b in word.encode()]
        letters[-1] += self.suffix
        ids = [self.vocab[x] for x in letters]
        return self._short(ids) if len(ids) <= SHORT_WORD else self._long(ids)

    def _short(self, ids: list[int]) -> list[int]:
        find = self.rank.get
        ranks = [find(pair, NO_PAIR) for pair in zip(ids, ids[1:], strict=False)]
        while ranks:
            least = min(ranks)
            if least == NO_PAIR:
                break
            at = ranks.index(least)
            ids[at] = self.merged[least]
            del ids[at + 1], ranks[at]
            if at:
                ranks[at - 1] = find((ids[at - 1], ids[at]), NO_PAIR)
            if at < len(ranks):
                ranks[at] = find((ids[at], ids[at + 1]), NO_PAIR)
        return ids

    def _long(self, ids: list[int]) -> list[int]:
        n, find = len(ids), self.rank.get
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = [(r, i) for i in range(n - 1) if (r := find((ids[i], ids[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if ids[i] < 0 or j < 0 or find((ids[i], ids[j])) != r:
                continue
            ids[i], ids[j] = self.merged[r], -1
            right[i] = right[j]
            if right[j] >= 0:
                left[right[j]] = i
            for a, b in ((left[i], i), (i, right[i])):
                if a >= 0 and b >= 0 and (q := find((ids[a], ids[b]))) is not None:
                    heapq.heappush(heap, (q, a))
        return [x for x in ids if x >= 0]

    def split(self, text: str) -> list[str]:
        return self.words(self.normalise(text))

    def encode(self, text: str) -> tuple[str, str]:
        """(ids in decimal, their tokens), each joined by one space."""
        if self.special is None or "<" not in text or not self.special.search(text):
            found = [self.cache[w] for w in self.split(text)]
        else:
            found = []
            for part in self.special.split(text):
                if part in self.specials:
                    found.append((str(self.specials[part]), part))
                else:
                    found += [self.cache[w] for w in self.split(part)]
        return " ".join([x[0] for x in found]), " ".join([x[1] for x in found])

    def decode(self, ids: list[int]) -> str:
        """Tokens joined by one space, as the format defines for files without a decoder."""
        return " ".join([self.tokens[i] for i in ids])


class _Cache(dict):
    """Word -> (ids, tokens).  When full it takes no more, and starts anew once misses pile up."""

    def __init__(self, owner: WordBpe):
        super().__init__()
        self.owner, self.missed = owner, 0

    def __missing__(self, word: str) -> tuple[str, str]:
        ids = self.owner.merge(word)
        made = " ".join(map(str, ids)), " ".join([self.owner.tokens[i] for i in ids])
        if len(self) >= CACHE_WORDS:
            self.missed += 1
            if self.missed > 4 * CACHE_WORDS:
                self.clear()
                self.missed = 0
        elif len(word) <= SHORT_WORD:
            self[word] = made
        return made


def _encoder(spec):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = WordBpe(spec.value)
        for batch in batches:
            ids = batch.column(0)
            texts = batch.column(1)
            at, held, size = 0, [], 0
            for row in range(batch.num_rows):
                held.append(bpe.encode(texts[row].as_py() or ""))
                size += len(held[-1][0]) + len(held[-1][1])
                if size >= OUT_BYTES or row == batch.num_rows - 1:
                    encoded, tokens = zip(*held, strict=True)
                    counts = [x.count(" ") + 1 if x else 0 for x in encoded]
                    yield pa.RecordBatch.from_arrays([ids.slice(at, row + 1 - at), pa.array(counts, pa.int64()), pa.array(encoded, pa.string()), pa.array(tokens, pa.string())], names=["_i", "n_tokens", "ids", "decoded"])
                    at, held, size = row + 1, [], 0

    return run


def bpe_encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Returns (id, n_tokens, ids, decoded); ids: decimal, joined by one space (``split`` gives an array).

    ``vocabulary``: path of the vocabulary file, read on the driver; its text is broadcast (a file of
    fixed size, a few MB).
    """
    with open(vocabulary, encoding="utf-8") as file:
        spec = docs.sparkSession.sparkContext.broadcast(file.read())
    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    out = docs.select(F.col(id_col).alias("_i"), F.col(text_col).alias("_t")).mapInArrow(_encoder(spec), f"_i {kind}, n_tokens long, ids string, decoded string")
    return out.withColumnRenamed("_i", id_col)
