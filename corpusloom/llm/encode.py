"""Token ids of whole texts by a public tokenizer, one call for each word that is new."""

from __future__ import annotations

import re
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from corpusloom.llm.words import split_words
from corpusloom.llm.workers import at_end_of_task

# Letters that stand alone in composed form and have a one-letter lower case.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIMPLE = re.compile(f"[{_LETTERS}]+")
KNOWN_WORDS = 300_000


class WordEncoder:
    """Ids of texts by a lower-casing tokenizer that never merges across white space, nor a
    letter with a punctuation mark.

    A text's ids are then those of its words in order, so a word is encoded when it is first
    met and looked up afterwards. Marks after letters are words of their own. Plain words of Latin
    letters go straight to the tokenizer's model, all others through its whole pipeline. At most
    ``KNOWN_WORDS`` words are remembered, about; then the memory starts anew.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self._forget()
        self.direct = self._model_agrees()
        self.plain = self.direct is not None and self._full("Ab, Cd!") == [
            i for w in ("ab", ",", "cd", "!") for i in self._full(w)
        ]

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(1 << 16, dtype=np.int32)
        self.starts = np.zeros(1 << 14, dtype=np.int64)

    def _full(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def _model_agrees(self) -> dict[int, str] | None:
        """The letters as the model wants them, if lower case and byte letters are all it needs."""
        from tokenizers.pre_tokenizers import ByteLevel

        byte_level = ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0x41, 0x100) if _SIMPLE.fullmatch(chr(c))]
        table = {ord(c): byte_level.pre_tokenize_str(c.lower())[0][0] for c in letters}
        probes = ["".join(letters[i : i + 7]) for i in range(0, len(letters), 5)] + ["The", "zeit", "señor"]
        for probe in probes:
            if [t.id for t in self.tokenizer.model.tokenize(probe.translate(table))] != self._full(probe):
                return None
        return table

    def _learn(self, words: list[str]) -> None:
        simple, table, tokenize = _SIMPLE.fullmatch, self.direct, self.tokenizer.model.tokenize
        flat: list[int] = []
        ends: list[int] = []
        for word in words:
            if not word:
                pass
            elif table is not None and simple(word):
                flat += [t.id for t in tokenize(word if word.isascii() and word.islower() else word.translate(table))]
            else:
                flat += self._full(word)
            ends.append(len(flat))
        n, used = len(self.known), int(self.starts[len(self.known)])
        self.starts = _room(self.starts, n + len(words) + 1)
        self.ids = _room(self.ids, used + len(flat))
        self.ids[used : used + len(flat)] = flat
        self.starts[n + 1 : n + len(words) + 1] = np.array(ends, dtype=np.int64) + used
        self.known.update(zip(words, range(n, n + len(words))))

    def _normal(self, texts: pa.Array) -> pa.Array:
        """Fewer distinct words for the same ids: lower-case ASCII, marks set apart from letters.

        Not where a special token's string might appear only once the text is lower case."""
        if not self.plain or pc.any(pc.match_substring(texts, "<|")).as_py():
            return texts
        return pc.replace_substring_regex(pc.ascii_lower(texts), f"([{_LETTERS}])([.,!?])", r"\1 \2")

    def encode(self, texts: pa.Array, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(start of each text in the ids and the end of the last, all ids); ``end_id`` closes each."""
        counts, index, distinct = split_words(self._normal(texts))
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        words = distinct.to_pylist()
        new = [w for w in words if w not in self.known]
        if new:
            self._learn(new)
        place = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        row_ends = np.cumsum(counts)
        starts, sizes = self.starts[place], self.starts[place + 1] - self.starts[place]
        flat = self.ids
        if end_id is not None:
            # The end is one more word of every row.
            index = np.insert(index, row_ends, len(words))
            row_ends = row_ends + np.arange(1, len(counts) + 1)
            used = int(self.starts[len(self.known)])
            starts, sizes = np.append(starts, used), np.append(sizes, 1)
            self.ids = flat = _room(flat, used + 1)
            flat[used] = end_id
        word_sizes = sizes[index]
        word_ends = np.concatenate(([0], np.cumsum(word_sizes)))
        source = np.repeat(starts[index] - word_ends[:-1], word_sizes)
        source += np.arange(len(source))
        return np.concatenate(([0], word_ends[row_ends])), flat[source]


def _room(values: np.ndarray, size: int) -> np.ndarray:
    if size < len(values):
        return values
    grown = np.zeros(max(size + 1, 2 * len(values)), dtype=values.dtype)
    grown[: len(values)] = values
    return grown


@cache
def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process and tokenizer file; at the end of a task it forgets its words."""
    made = WordEncoder(path)
    at_end_of_task(made._forget)
    return made
