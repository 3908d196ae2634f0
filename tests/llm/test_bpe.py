import pytest
from tokenizers import Tokenizer

public_tokenizers = pytest.importorskip("public_tokenizers")
from catlink.llm.bpe import WordBpe, bpe_encode  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", "  ", "Hello world's don't I'LL", "ΑΣ Σ ΟΔΟΣ", "İstanbul ǅ", "a<|endoftext|>b <|StartOfText|> <|startoftext|>",
    "é x̧́ 가", "a b c\x1cd\x1fe\x85f　g", "½²٣४Ⅷ 12345", "😀👨‍👩 ok", "a" * 3000, "abc" * 5000, "\x01", "日本語",
    "a\nb\r\n\tc", "same", "same",
]


def test_matches_library(spark):
    lib = Tokenizer.from_file(PATH)
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(0, "again", "y")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    want = []
    for i, t, _ in rows:
        e = lib.encode(t or "", add_special_tokens=False)
        want.append((i, len(e.ids), " ".join(map(str, e.ids)), lib.decode(e.ids, skip_special_tokens=False)))
    got = [tuple(r) for r in bpe_encode(df, PATH).collect()]
    assert sorted(got) == sorted(want)
    assert bpe_encode(df.limit(0), PATH).count() == 0


def test_round_trip_of_ids():
    bpe = WordBpe(open(PATH).read())
    ids, tokens = bpe.encode("The quick brown fox, again.")
    assert bpe.decode([int(x) for x in ids.split()]) == tokens
