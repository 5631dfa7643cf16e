"""Token ids of whole texts by a public tokenizer file, with a memo of words."""

from __future__ import annotations

import json
import os
import re
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from paylane.llm.common import split_words

WORD_BPE = "word_bpe_49k.json"
# Entries of the memo; a full memo is emptied. About 0.2 kB each.
MEMO = 250_000
WORDS_AT_ONCE = 500_000

# The text steps of tokenizer files whose ids depend on each white-space separated word alone.
WORDWISE = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
                "behavior": "Removed",
                "invert": True,
            },
            {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
        ],
    },
    "post_processor": None,
}
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
# Letters of Latin-1 that have one lower-case letter each and no other normal form, then ASCII marks.
PLAIN_WORD = rf"^(?P<letters>[{LETTERS}]*)(?P<marks>[!-/:-@\[-`{{-~]*)$"


def tokenizer_path(name: str) -> str:
    """A path as given; a bare file name is one of the public tokenizers installed on the machine that asks."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def as_list(column: pa.Array) -> list:
    """Much faster than to_pylist() for texts."""
    return column.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Encodes texts to ids exactly as the tokenizers library does for whole texts without special tokens.

    Where the file's text steps are the word-wise ones above, white space ends every token and no step looks across it,
    so a text's ids are those of its words one after another; the library encodes each distinct word once while the memo
    holds it. Other tokenizer files get whole texts.
    """

    def __init__(self, name: str, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer, pre_tokenizers

        path = tokenizer_path(name)
        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            steps = json.load(f)
        self.wordwise = all(steps.get(k) == v for k, v in WORDWISE.items())
        self.memo = memo
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        letters = [chr(c) for c in range(0xC0, 0x100) if re.match(f"[{LETTERS}]", chr(c))]
        self.bytes_of = str.maketrans({c: mapped.pre_tokenize_str(c)[0][0] for c in letters})
        self.model = self.tokenizer.model
        self.clear()

    def clear(self, least: int = 0) -> None:
        self.slot: dict[str, int] = {}
        self.arena, self.used = np.zeros(1 << 20, np.int32), 0
        room = max(self.memo, least)
        self.first, self.size = np.zeros(room, np.int64), np.zeros(room, np.int64)

    def part(self, text: str) -> list[int]:
        """Ids of lower-case letters or of marks."""
        return [t.id for t in self.model.tokenize(text if text.isascii() else text.translate(self.bytes_of))]

    def add(self, words: pa.Array) -> None:
        """Put distinct words that the memo lacks into it."""
        plain = pc.extract_regex(words, PLAIN_WORD)
        letters = pc.utf8_lower(pc.struct_field(plain, "letters")).dictionary_encode()
        marks = pc.struct_field(plain, "marks").dictionary_encode()
        of_letters, of_marks = ([self.part(x) for x in as_list(side.dictionary)] for side in (letters, marks))
        texts, ids, sizes = as_list(words), [], []
        for text, x, y in zip(texts, *(as_list(pc.fill_null(side.indices, -1)) for side in (letters, marks))):
            got = self.tokenizer.encode(text, add_special_tokens=False).ids if x < 0 else of_letters[x] + of_marks[y]
            ids += got
            sizes.append(len(got))
        slot, end = len(self.slot), self.used + len(ids)
        if end > len(self.arena):
            self.arena = np.concatenate([self.arena, np.zeros(max(len(self.arena), len(ids)), np.int32)])
        self.arena[self.used : end] = ids
        self.first[slot : slot + len(texts)] = self.used + np.cumsum(sizes) - sizes
        self.size[slot : slot + len(texts)] = sizes
        self.slot.update(zip(texts, range(slot, slot + len(texts))))
        self.used = end

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text. A null text has none."""
        if not self.wordwise:
            given = texts.to_pylist()
            got = [e.ids for e in self.tokenizer.encode_batch([x or "" for x in given], add_special_tokens=False)]
            return np.array([i for ids in got for i in ids], np.int32), np.array([len(x) for x in got], np.int64)
        words, n_words = split_words(texts)
        parts, sizes = [], []
        for at in range(0, max(len(words), 1), WORDS_AT_ONCE):
            ids, size = self._ids(words.slice(at, WORDS_AT_ONCE))
            parts.append(ids)
            sizes.append(size)
        ends = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
        last = np.cumsum(n_words)
        return np.concatenate(parts), ends[last] - ends[last - n_words]

    def _ids(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        seen = words.dictionary_encode()
        distinct = seen.dictionary
        if len(self.slot) + len(distinct) > len(self.first):
            self.clear(len(distinct))
        slots = np.fromiter(map(self.slot.get, as_list(distinct), repeat(-1)), np.int64, len(distinct))
        missing = np.flatnonzero(slots < 0)
        if len(missing):
            slots[missing] = np.arange(len(self.slot), len(self.slot) + len(missing))
            self.add(distinct.take(pa.array(missing)))
        slots = slots[seen.indices.to_numpy()]
        size = self.size[slots]
        ends = np.cumsum(size)
        total = int(ends[-1]) if len(ends) else 0
        return self.arena[np.repeat(self.first[slots] - ends + size, size) + np.arange(total)], size


@lru_cache(maxsize=2)
def encoder(name: str = WORD_BPE) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(name)
