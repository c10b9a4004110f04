import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models

from headwater.llm import counts
from tests.llm.conftest import key

PATH = public_tokenizers.path("piece_bpe_32k.model")


def library(pieces):
    """The unigram model of the tokenizers library over the same pieces, with bytes for unknown characters."""
    bytes_ = [(f"<0x{b:02X}>", -1e12) for b in range(256)]
    return Tokenizer(models.Unigram([("<unk>", 0.0), *bytes_, *pieces], 0, byte_fallback=True))


def test_counts_equal_the_library():
    own = counts.counter(PATH)
    theirs = library(counts.read_pieces(PATH))
    rng = random.Random(4)
    for _ in range(3000):
        word = "".join(rng.choice("theaingorst éß漢😀1\n") for _ in range(rng.randint(1, 14)))
        units = "▁" + word.replace(" ", "▁")
        assert own.count(word)[0] == len(theirs.encode(units).ids), repr(word)


def test_ties_take_the_longest_last_piece():
    """a+bc and ab+c score alike: the piece that ends last and is longest wins, with fewer or more pieces."""
    pieces = [("▁", -1.0), ("a", -2.0), ("b", -2.0), ("c", -2.0), ("ab", -3.0), ("bc", -3.0), ("abc", -6.0), ("▁a", -3.0)]
    own = counts.UnigramCounter(pieces)
    theirs = library(pieces)
    rng = random.Random(9)
    for _ in range(2000):
        word = "▁" + "".join(rng.choice("abcx") for _ in range(rng.randint(1, 9)))
        assert own.best(word)[0] == len(theirs.encode(word).ids), word


def test_best_score_by_brute_force():
    own = counts.UnigramCounter([("▁", -1.0), ("a", -2.5), ("aa", -3.0), ("▁aa", -4.5), ("aaa", -9.0)])

    def best(word):
        if not word:
            return 0.0
        found = [best(word[n:]) + score for piece, score in PIECES if word.startswith(piece) for n in [len(piece)]]
        return max(found)

    PIECES = [("▁", -1.0), ("a", -2.5), ("aa", -3.0), ("▁aa", -4.5), ("aaa", -9.0)]
    for n in range(1, 12):
        assert own.best("▁" + "a" * n)[1] == best("▁" + "a" * n)


def test_a_piece_that_joins_words_is_refused():
    with pytest.raises(ValueError):
        counts.UnigramCounter([("a▁b", -1.0)])


def test_all_documents(docs, edge_rows, no_docs):
    found = counts.count_tokens(docs, PATH).collect()
    own = counts.UnigramCounter(counts.read_pieces(PATH))
    want = [(r[0], *own.count(r[1] or "")) for r in edge_rows]
    assert sorted(map(key, found)) == sorted(map(key, want))
    empty = [r for r in found if r.doc_id in (100, 101)]
    assert [(r.n_tokens, r.best_score) for r in empty] == [(0, 0.0)] * 2
    assert counts.count_tokens(no_docs, PATH).collect() == []
