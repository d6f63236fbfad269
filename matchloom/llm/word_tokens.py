"""Token ids of whole texts, with each distinct word tokenised once.

For vocabularies whose pre-tokeniser never joins text across white space, so that the ids of a text are those of its
words, one after the other. That holds for the word-level BPE file; tests compare whole texts.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# A word and the marks after it are separate pre-tokens, so a space between them changes nothing; it saves many
# distinct words. Apostrophes start pre-tokens of their own kind and stay.
MARKS = r"(\pL)([.,!?;:%$#&*|()\-\"]+)"
# Words remembered by a worker; a bound on its memory that doesn't change results.
REMEMBERED = 1_000_000
# New words tokenised at once: what the tokenizer returns for a word takes many times the room of its ids.
ENCODED = 4096


class _Words:
    """Ids of words seen so far, end to end, in arrays that grow in place."""

    def __init__(self, tokenizer) -> None:
        self.tokenizer = tokenizer
        self.forget()

    def forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids, self.starts, self.sizes = np.zeros(1 << 16, np.uint32), np.zeros(1 << 14, np.int64), np.zeros(1 << 14, np.int64)
        self.used = 0

    def places(self, words: list[str]) -> np.ndarray:
        new = [w for w in words if w not in self.place]
        if len(self.place) + len(new) > REMEMBERED and self.place:
            self.forget()
            new = words
        if new:
            for at in range(0, len(new), ENCODED):
                self.add(new[at : at + ENCODED])
        return np.fromiter(map(self.place.__getitem__, words), np.int64, len(words))

    def add(self, new: list[str]) -> None:
        found = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        ids = np.fromiter(chain.from_iterable(found), np.uint32, int(sizes.sum()))
        known = len(self.place)
        self.ids = _put(self.ids, self.used, ids)
        self.sizes = _put(self.sizes, known, sizes)
        self.starts = _put(self.starts, known, self.used + np.cumsum(sizes) - sizes)
        self.used += len(ids)
        self.place.update(zip(new, range(known, known + len(new))))


def _put(held: np.ndarray, at: int, more: np.ndarray) -> np.ndarray:
    """``more`` written from place ``at`` on; the array doubles when it is full."""
    if at + len(more) > len(held):
        grown = np.zeros(max(2 * len(held), at + len(more)), held.dtype)
        grown[:at] = held[:at]
        held = grown
    held[at : at + len(more)] = more
    return held


Encode = Callable[[pa.Array, int], tuple[np.ndarray, np.ndarray]]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encode:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    known = _Words(tokenizer)
    # The literals of added tokens are single ids wherever they stand, also inside words: such texts are encoded whole.
    added = "|".join(re.escape(t.content) for t in tokenizer.get_added_tokens_decoder().values())

    def encode(texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids, end to end, and where each text ends; each has the end id after it."""
        whole = np.flatnonzero(pc.match_substring_regex(texts, f"(?i){added}").to_numpy(zero_copy_only=False)) if added else []
        if not len(whole):
            return by_words(texts, end_id)
        blank = np.zeros(len(texts), bool)
        blank[whole] = True
        ids, ends = by_words(pc.if_else(pa.array(blank), "", texts), end_id)
        pieces, at = [], 0
        for row in whole.tolist():
            upto = int(ends[row]) - 1  # the blank text's end id
            pieces += [ids[at:upto], np.array(tokenizer.encode(texts[row].as_py(), add_special_tokens=False).ids, np.uint32)]
            at = upto
        sizes = np.diff(ends, prepend=0)
        sizes[whole] += [len(p) for p in pieces[1::2]]
        return np.concatenate([*pieces, ids[at:]]), np.cumsum(sizes)

    def by_words(texts: pa.Array, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        spaced = pc.replace_substring_regex(pc.replace_substring_regex(texts, r"[\t-\r]", " "), MARKS, r"\1 \2")
        words = pc.split_pattern(pc.ascii_lower(spaced), " ")
        counts = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
        flat = pc.dictionary_encode(words.flatten())
        place = known.places(flat.dictionary.to_pylist())
        index = place[flat.indices.to_numpy(zero_copy_only=False)]
        lengths, last = known.sizes[index], np.cumsum(counts)
        # Of each word the place of its first id in the output: ids of all words before it, and an end id a text.
        upto = np.concatenate([[0], np.cumsum(lengths)])
        ends = upto[last] + np.arange(1, len(counts) + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, end_id, np.uint32)
        total = int(upto[-1])
        # There is one of these for each id: they are the largest arrays here.
        narrow = np.int32 if max(known.used, total) < 1 << 31 else np.int64
        source = np.repeat((known.starts[index] - upto[:-1]).astype(narrow), lengths)
        source += np.arange(total, dtype=narrow)
        inner = np.ones(len(out), bool)
        inner[ends - 1] = False
        out[inner] = known.ids[source]
        return out, ends

    return encode
