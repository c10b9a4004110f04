import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from headwater.llm import bpe
from tests.llm.conftest import key

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def ids_of(library, text):
    return np.array(library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_all_documents_equal_the_library(docs, edge_rows, library):
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    want = [(r[0], ids_of(library, r[1] or ""), r[1] or "") for r in edge_rows]
    assert sorted(map(key, ((r.doc_id, bytes(r.ids), r.text) for r in found))) == sorted(map(key, want))
    for r in found[:5]:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.text == library.decode(ids, skip_special_tokens=False)


def test_random_texts_equal_the_library(library):
    rng = random.Random(11)
    own = bpe.tokenizer(PATH)
    alphabet = "  \n\t'sreaéß漢😀12.,!_-=\x1c\x85　​"
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
        text += rng.choice(["", "<|endoftext|>", "word" * 30])
        assert own.encode(text) == ids_of(library, text), repr(text)


def test_gadgets_on_a_small_vocabulary():
    """Against merging step by step, on all short words, with merges of equal parts and dead ones."""
    labels = {0: b"a", 1: b"b", 2: b"aa", 3: b"ab", 4: b"aab", 5: b"ba", 6: b"aaa", 7: b"abab"}
    merges = [(0, 0, 2), (0, 1, 3), (2, 1, 4), (1, 0, 5), (2, 0, 6), (3, 3, 7)]
    automaton = bpe.MergeAutomaton(labels, merges)
    rank = {(u, v): k for k, (u, v, _) in enumerate(merges)}

    def merged(word):
        tokens = [0 if c == 97 else 1 for c in word]
        while True:
            pairs = [(rank[p], i) for i, p in enumerate(zip(tokens, tokens[1:])) if p in rank]
            if not pairs:
                return tokens
            best = min(pairs)[0]
            u, v, w = merges[best]
            i, out = 0, []
            while i < len(tokens):
                if tokens[i : i + 2] == [u, v]:
                    out.append(w)
                    i += 2
                else:
                    out.append(tokens[i])
                    i += 1
            tokens = out

    for length in range(1, 11):
        for bits in range(1 << length):
            word = bytes(97 + (bits >> k & 1) for k in range(length))
            assert automaton.encode(word) == merged(word), word


def test_bounds_on_what_is_kept(monkeypatch, library):
    monkeypatch.setattr(bpe, "KEPT_TEXTS", 3)
    monkeypatch.setattr(bpe, "KEPT_ARCS", 5)
    own = bpe.Tokenizer(bpe._read(PATH))
    text = "many different words that cannot all be kept at once"
    assert own.encode(text) == ids_of(library, text)
    assert len(own.words) <= 3 and len(own.automaton.arcs) <= 5


def test_no_documents(no_docs):
    assert bpe.decode(bpe.encode(no_docs, PATH), PATH).collect() == []
