"""New words are tokenised in slices, with the ids they always had."""

from __future__ import annotations

from types import SimpleNamespace

import pyarrow as pa
import public_tokenizers

from matchloom.llm import word_tokens


def test_new_words_come_in_slices(monkeypatch):
    asked = []

    def encode(words, add_special_tokens):
        asked.append(len(words))
        return [SimpleNamespace(ids=[len(w), ord(w[0])] if w else []) for w in words]

    words = word_tokens._Words(SimpleNamespace(encode_batch_fast=encode))
    names = ["", *[f"w{i}" for i in range(10_000)]]
    assert words.places(names).tolist() == list(range(10_001))
    assert max(asked) <= 4096 and sum(asked) == 10_001
    assert words.sizes[:3].tolist() == [0, 2, 2] and words.ids[:4].tolist() == [2, ord("w"), 2, ord("w")]
    assert words.starts[10_000] == 2 * 9999


def test_ids_of_texts():
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path("word_bpe_49k.json"))
    plain = Tokenizer.from_file(path)
    texts = ["", "one", " two  words\tand,more... ", "", "Ärger im Büro don't 12.5%", ""]
    ids, ends = word_tokens.encoder(path)(pa.array(texts), 1)
    want = [[*plain.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    assert ids.tolist() == [i for w in want for i in w]
    assert ends.tolist() == [sum(map(len, want[: n + 1])) for n in range(len(want))]
    assert [len(a) for a in word_tokens.encoder(path)(pa.array([], pa.string()), 1)] == [0, 0]
