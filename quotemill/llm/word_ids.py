"""Token ids of many texts at once, under a tokenizer that merges words alone.

The tokenizer meant lowers letters, cuts at blanks and drops them, cuts words
into pieces, and ends a piece's last token with a mark. A batch of texts is cut
into words by Arrow; each different word is cut into pieces and each different
piece goes to the library's model, once per batch. Texts are put together from
their words' ids by place, without a step per word.

That holds for texts in Latin-1, where composing characters changes nothing and
lowering is one character each. Other texts, and those that may name a special
token, go to the library whole; ids are equal either way.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

# Characters of Latin-1 that words and signs are made of, and the blanks between them.
PLAIN = re.compile(r"[\x09-\x0D\x20-\x7E\xA1-\xFF]*")
LETTERS = r"a-z\xAA\xB5\xBA\xDF-\xF6\xF8-\xFF"
NUMBERS = r"0-9\xB2\xB3\xB9\xBC-\xBE"
# Pieces of a lowered text as the tokenizer's own pattern cuts them (fixed value), and ends of words.
PIECE = re.compile(
    rf"\n|'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\x09-\x0D\x20{LETTERS}{NUMBERS}]+")
# What a special token's name begins with.
SPECIAL = "<|"


def library(spelled: str) -> Tokenizer:
    """The tokenizer of a file's text, without truncation and padding."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    made = Tokenizer.from_str(spelled)
    made.no_truncation()
    made.no_padding()
    return made


def width_of(vocabulary: int) -> str:
    """Kind of integer that holds every id."""
    return "<u2" if vocabulary <= 1 << 16 else "<u4"


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself where it prints, else the next from 256 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = [byte for byte in range(256) if byte not in prints]
    return {byte: chr(256 + others.index(byte)) for byte in others if byte != 32}


def joined(values: np.ndarray, bounds: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chosen runs of ``values`` one after another, and their bounds."""
    sizes = np.diff(bounds)[chosen]
    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    places = np.arange(total) + np.repeat(bounds[:-1][chosen] - (ends - sizes), sizes)
    return values[places], np.append(0, ends)


class WholeTexts:
    """Ids of texts under any tokenizer, text by text."""

    def __init__(self, tokenizer: Tokenizer, width: str):
        self.tokenizer, self.width = tokenizer, width

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(code.ids, dtype=self.width).tobytes() for code in coded]


class Words:
    """Ids of texts under a tokenizer as the module describes."""

    def __init__(self, tokenizer: Tokenizer, width: str):
        self.width = width
        self.whole = WholeTexts(tokenizer, width)
        self.spelling = byte_letters()
        # The model alone, on pieces parted by blanks.
        self.model = Tokenizer(tokenizer.model)
        self.model.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        mark = tokenizer.model.end_of_word_suffix
        if not mark:
            raise ValueError("the tokenizer does not mark the ends of words")
        vocabulary = tokenizer.get_vocab(with_added_tokens=False)
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith(mark)]] = True

    def __call__(self, texts: Sequence[str]) -> list[bytes]:
        plain = [k for k, text in enumerate(texts) if PLAIN.fullmatch(text) and SPECIAL not in text]
        out = [b""] * len(texts)
        for k, ids in zip(plain, self.plain([texts[k] for k in plain])):
            out[k] = ids
        others = sorted(set(range(len(texts))) - set(plain))
        for k, ids in zip(others, self.whole([texts[k] for k in others])):
            out[k] = ids
        return out

    def plain(self, texts: list[str]) -> list[bytes]:
        if not texts:
            return []
        # Lowering here, as Arrow and Python agree on Latin-1 but only one is the library's rule.
        words = pc.ascii_split_whitespace(pa.array([text.lower() for text in texts], pa.string()))
        coded = words.values.dictionary_encode()
        ids, bounds = self.words(coded.dictionary)
        bounds_of = words.offsets.to_numpy()
        flat, ends = joined(ids, bounds, coded.indices.to_numpy())
        data, size = flat.tobytes(), flat.itemsize
        places = ends[bounds_of - bounds_of[0]] * size
        return [data[start:end] for start, end in zip(places[:-1].tolist(), places[1:].tolist())]

    def words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different words, one after another, and their bounds."""
        one = pa.ListArray.from_arrays([0, len(words)], words)
        pieces = PIECE.findall(pc.binary_join(one, "\n")[0].as_py() + "\n")
        # The end of a word is a piece without ids, and the first of the kinds.
        kinds = {"\n": 0}
        index = np.array([kinds.setdefault(piece, len(kinds)) for piece in pieces])
        ids, bounds = self.pieces(list(kinds)[1:])
        flat, ends = joined(ids, np.append(0, bounds), index)
        return flat, np.append(0, ends[1:][index == 0])

    def pieces(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of different pieces, one after another, and their bounds."""
        spelled = [piece if piece.isascii() else piece.encode().decode("latin-1").translate(self.spelling)
                   for piece in pieces]
        (code,) = self.model.encode_batch_fast([" ".join(spelled)], add_special_tokens=False)
        ids = np.array(code.ids, dtype=self.width)
        ends = np.flatnonzero(self.ends[ids]) + 1
        if len(ends) != len(pieces):
            raise ValueError("a piece has no encoding of its own under this vocabulary")
        return ids, np.append(0, ends)
