import base64
import json
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from tokenizers import Tokenizer

from tidewire.llm import memo
from tidewire.llm.bpe import TwoTierBpe, load_ranks
from tidewire.llm.mph import PerfectHash

ODD = [
    "", " ", "\n", "a", " a", "a ", "a  b", "a\n\nb", "a \n b", "\ta\tb", "x\x1cy \x1c z", "a\xa0b", "a  b c", "don't we'll I'M", "3.14 1,000 ½ Ⅷ",
    "Éan ñandú ßen, œuvre. Ünï", "日本語 テキスト", "é café", "İstanbul ΟΔΟΣ", "<|endoftext|> <|startoftext|>", "end <|endoftext|> of", "a  <|endoftext|>  b<|startoftext|>c\n<|endoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "x <|endof" "text|>", "!!! ### word!! a.b,c", "a" * 3000, "ab " * 500, "🙂👍🏽 x", "a\x00b", "foo.\nBar, baz",
]


def texts():
    draw = random.Random(5)
    letters = "aAbé ñ\n\n  .,!'3\t\x1c\xa0日s"
    return ODD + ["".join(draw.choices(letters, k=draw.randrange(60))) for _ in range(3000)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_units_equal_the_library(monkeypatch, name):
    library = Tokenizer.from_file(P.path(name))
    encoder = memo.library_encoder(P.path(name), 4)
    expected = [library.encode(text, add_special_tokens=False).ids for text in texts()]
    for text, ids in zip(texts(), expected, strict=True):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == ids, repr(text)
    assert memo.rank_order_suffices(P.path(name))
    for at_once, by_rank in ((1, False), (1, True), (500, True), (1 << 22, False), (1 << 22, True)):
        monkeypatch.setattr(memo, "AT_ONCE", at_once)
        fresh = memo.library_encoder(P.path(name), 2, by_rank)
        assert [np.frombuffer(ids, "<u2").tolist() for ids in fresh.encode_all(texts(), 2)] == expected
    assert list(encoder.encode_all([], 4)) == [] and list(encoder.encode_all(["", "a", ""], 4)) == [b"", encoder.encode("a"), b""]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_words_by_rank_equal_the_library(name):
    """Random words of any letters, and every word that is a token itself or two tokens."""
    library, own, draw = Tokenizer.from_file(P.path(name)), memo.library_encoder(P.path(name), 4, True), random.Random(8)
    tokens = [t.removesuffix("</w>").removeprefix("Ġ") for t in library.get_vocab()]
    tokens = [t for t in tokens if t.isascii() and t.isalpha()]
    some = ["".join(draw.choices("abcdeinorstzEéñßÜœ", k=draw.randrange(1, 20))) for _ in range(20_000)]
    words = [*tokens, *(a + b for a, b in zip(draw.choices(tokens, k=20_000), draw.choices(tokens, k=20_000), strict=True)), *some]
    text = " ".join(w + draw.choice(["", "", ",", "."]) for w in words)
    (ids,) = own.encode_all([text], 4)
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_rank_order_may_not_suffice(tmp_path):
    """A vocabulary whose listed merge of a token is not the one that ranks give, and one without a token for a byte."""
    letters = memo._byte_letters()
    merges = [["b", "c"], ["a", "b"], ["ab", "c"]]
    vocabulary = {t: k for k, t in enumerate([*letters, *("".join(m) for m in merges)])}
    for lacks, rows, good in (([], merges, False), ([], merges[1:] and [["a", "b"], ["ab", "c"]], True), (["z"], [["a", "b"]], False)):
        parts = {"added_tokens": [], "normalizer": None, "pre_tokenizer": None, "model": {"vocab": {t: k for t, k in vocabulary.items() if t not in lacks}, "merges": rows}}
        path = tmp_path / f"{len(rows)}{len(lacks)}.json"
        path.write_text(json.dumps(parts))
        assert memo.rank_order_suffices(str(path)) is good


def test_memory_is_bounded():
    encoder = memo.UnitEncoder(lambda u: u.encode(), held=10)
    words = [f"w{k}" for k in range(500)]
    assert encoder.encode(" ".join(words)) == " ".join(words).encode()
    assert len(encoder._spaced) <= 10 and len(encoder._spaced.old) <= 10


def test_two_tier_equals_tiktoken():
    path = P.path("byte_bpe_50k.tiktoken")
    ranks = load_ranks(path)
    assert ranks == {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    library, own = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={}), TwoTierBpe(ranks, P.PATTERN)
    for text in texts():
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text)
        assert own.decode(ids) == text.encode()


def test_first_tier_resolves_the_vocabulary():
    own = TwoTierBpe({bytes([b]): b for b in range(256)} | {b"ab": 256, b"abc": 257}, P.PATTERN)
    assert own.merged(b"abcab") == [257, 256]
    assert np.frombuffer(own.unit("abc"), "<u4").tolist() == [257]


@pytest.mark.parametrize("n", [0, 1, 2, 100, 30_000])
def test_perfect_hash(n):
    hashes = np.unique(np.random.default_rng(n).integers(0, 2**64, n, dtype=np.uint64))
    table = PerfectHash.build(hashes)
    slots = table.slots(hashes)
    assert sorted(slots.tolist()) == list(range(len(hashes))) and table.size == len(hashes)
    again = PerfectHash.from_bytes(table.to_bytes())
    assert (again.slots(hashes) == slots).all()
    one = table.one()
    assert [one(int(h)) for h in hashes[:200]] == slots[:200].tolist()
