"""Token ids of whole texts, encoded word by word.

A text is cut before every space or line feed that does not follow white space. Neither vocabulary has a token
over such a cut: the splitter of the byte-level vocabulary cuts there as well, and no piece of the other one has
a space behind something else, or a line feed (looked up when the file is opened). So the distinct parts of many
texts are encoded once, remembered, and the ids of a text are gathered by index. A text with white space beyond
ASCII, or with a special token that counts as one, is encoded whole.
"""

from __future__ import annotations

import os
import re

import numpy as np
import pyarrow as pa

#: Parts a worker remembers before it starts anew.
MEMO = 500_000
#: Parts encoded in one call.
CALL = 200_000
WHITE = " \t\n\x0b\x0c\r"
#: White space that only some splitters know.
ODD_SPACE = re.compile(r"[^\S \t-\r]")
#: Characters of blocks that no later version of Unicode changed: Latin to Cyrillic, kana, common Han, Hangul.
UNSETTLED = re.compile("[^\x00-ԯぁ-ゖァ-ヺ一-龥가-힣]")

_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE.encode())] = True


class ByteVocabulary:
    """A byte-level vocabulary file; ``plain_specials``: a special token's spelling in a text is ordinary text."""

    def __init__(self, path: str, plain_specials: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain_specials
        # The vocabulary writes a byte as a printable character: itself, or else one above 255, in order.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        byte_of = {chr(b): b for b in plain} | {
            chr(c): b for c, b in zip(range(256, 512), [b for b in range(256) if b not in plain], strict=False)
        }
        added = {number: t.content for number, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.special = [] if plain_specials else list(added.values())
        names = {n: t for t, n in self.tokenizer.get_vocab().items()}
        self.bytes = [b""] * (max(names) + 1)
        for number, token in names.items():
            self.bytes[number] = token.encode() if number in added else bytes(byte_of[c] for c in token)
        self.width = np.array([len(b) for b in self.bytes], np.int64)
        ranks = {data: n for n, data in enumerate(self.bytes) if data and n not in added}
        self.fast = self.ranked(path, ranks)

    @staticmethod
    def ranked(path: str, ranks: dict[bytes, int]):
        """The same vocabulary by ranks, where its merges stand in the order of their ids; None elsewhere."""
        import json

        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as handle:
            read = json.load(handle)
        vocabulary = read["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in read["model"]["merges"]]
        made = [vocabulary[a + b] for a, b in merges]
        splitter = read.get("pre_tokenizer") or {}
        usual = splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space")
        if read.get("normalizer") or not usual or any(a >= b for a, b in zip(made, made[1:], strict=False)):
            return None
        return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def odd(self, parts: list[str]) -> np.ndarray:
        """Which parts make their text one to be encoded whole."""
        joined, none = "\n".join(parts), np.zeros(len(parts), bool)
        if not ODD_SPACE.search(joined) and not any(s in joined for s in self.special):
            return none
        return np.array([bool(ODD_SPACE.search(p)) or any(s in p for s in self.special) for p in parts], bool)

    def whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all parts one after another, and how many each part has."""
        settled = self.fast is not None and not UNSETTLED.search("".join(parts))
        row = [
            self.fast is not None and p[0] in " \n" and p[-1] not in WHITE and (settled or not UNSETTLED.search(p)) for p in parts
        ]
        ids, counts = self.in_a_row([p for p, yes in zip(parts, row, strict=True) if yes])
        if all(row):
            return ids, counts
        others = iter(self.tokenizer.encode_batch([p for p, yes in zip(parts, row, strict=True) if not yes], add_special_tokens=False))
        ends, k, out = np.cumsum(counts).tolist(), 0, []
        for yes in row:
            out.append(ids[ends[k] - counts[k] : ends[k]] if yes else np.array(next(others).ids, np.int32))
            k += yes
        return np.concatenate(out), np.array([len(x) for x in out], np.int64)

    def in_a_row(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Parts that may stand one behind another: the splitter cuts between them; by ranks, in one call."""
        if not parts:
            return np.empty(0, np.int32), np.empty(0, np.int64)
        ids = np.array(self.fast.encode_ordinary("".join(parts)), np.int32)
        sizes = np.array([len(p) if p.isascii() else len(p.encode()) for p in parts])
        ends = np.searchsorted(np.cumsum(self.width[ids]), np.cumsum(sizes), side="right")
        return ids, np.diff(ends, prepend=0)

    def true(self, parts: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Every byte has a token here, so the bytes of a part's tokens are always the part."""
        return np.ones(len(parts), bool)


class PieceVocabulary:
    """A sentence-piece vocabulary that puts a space before a text; its texts here carry that space already."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        numbers = range(self.model.get_piece_size())
        names = [self.model.id_to_piece(i) for i in numbers]
        self.bytes = [
            bytes([int(name[3:5], 16)]) if self.model.is_byte(i) else name.replace("▁", " ").encode()
            for i, name in zip(numbers, names, strict=True)
        ]
        plain = [n for i, n in zip(numbers, names, strict=True) if not self.model.is_byte(i)]
        if any("▁" in n.lstrip("▁") or "\n" in n for n in plain):
            raise ValueError(f"{path} has pieces over word ends; such a vocabulary can't be encoded by words")
        self.space = self.model.piece_to_id("▁")

    def odd(self, parts: list[str]) -> np.ndarray:
        return np.zeros(len(parts), bool)

    def parts(self, parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = self.model.encode([p[1:] if p[0] == " " else p for p in parts], num_threads=1)
        # A part of one space is that piece; the space put before a line feed is none of the text.
        for k, p in enumerate(parts):
            if p == " ":
                found[k] = [self.space]
            elif p[0] != " ":
                found[k] = found[k][1:]
        return np.array([i for x in found for i in x], np.int32), np.array([len(x) for x in found], np.int64)

    def true(self, parts: list[str], ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Whether the bytes of a part's tokens are the part."""
        names, listed, ends = self.bytes, ids.tolist(), np.cumsum(counts).tolist()
        return np.array(
            [b"".join([names[i] for i in listed[e - n : e]]) == p.encode() for p, e, n in zip(parts, ends, counts.tolist(), strict=True)],
            bool,
        )


class Encoded:
    """Ids of texts one after another, where each text's begin (``at``), whether the tokens' bytes are the text
    (``same``), and the tokens at which the texts' parts begin (``words``)."""

    def __init__(self, ids: np.ndarray, at: np.ndarray, same: np.ndarray, words: np.ndarray):
        self.ids, self.at, self.same, self.words = ids, at, same, words


class Wordwise:
    """Encodes many texts at a time with one vocabulary and remembers their parts."""

    def __init__(self, vocabulary: ByteVocabulary | PieceVocabulary):
        self.vocabulary, self.memo = vocabulary, MEMO
        self.width = np.array([len(b) for b in vocabulary.bytes], np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids, self.begin, self.size = np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
        self.whole, self.true = np.empty(0, bool), np.empty(0, bool)

    def add(self, parts: list[str]) -> np.ndarray:
        """Numbers of new entries."""
        first, vocabulary = len(self.size), self.vocabulary
        for a in range(0, len(parts), CALL):
            some = parts[a : a + CALL]
            ids, size = vocabulary.parts(some)
            self.keep(ids, size, vocabulary.true(some, ids, size), vocabulary.odd(some))
        return np.arange(first, len(self.size))

    def add_whole(self, texts: list[str]) -> np.ndarray:
        """Numbers of entries of whole texts, which are not remembered by their spelling."""
        first = len(self.size)
        for text in texts:
            ids = np.array(self.vocabulary.whole(text), np.int32)
            size = np.array([len(ids)], np.int64)
            self.keep(ids, size, self.vocabulary.true([text], ids, size), np.zeros(1, bool))
        return np.arange(first, len(self.size))

    def keep(self, ids: np.ndarray, size: np.ndarray, true: np.ndarray, whole: np.ndarray) -> None:
        self.begin = np.concatenate((self.begin, len(self.ids) + np.cumsum(size) - size))
        self.ids, self.size = np.concatenate((self.ids, ids)), np.concatenate((self.size, size))
        self.true, self.whole = np.concatenate((self.true, true)), np.concatenate((self.whole, whole))

    def numbers(self, parts: list[str]) -> np.ndarray:
        new = [p for p in parts if p not in self.known]
        if len(self.known) + len(new) > self.memo:
            self.forget()
            new = parts
        self.known.update(zip(new, self.add(new).tolist(), strict=True))
        return np.fromiter(map(self.known.__getitem__, parts), np.int64, len(parts))

    def encode(self, split: Split) -> Encoded:
        entry = self.numbers(split.parts)[split.index]
        at, n = split.at, len(split.at) - 1
        odd = np.unique(np.searchsorted(at, np.nonzero(self.whole[entry])[0], side="right") - 1)
        if len(odd):
            texts = ["".join(split.parts[j] for j in split.index[at[k] : at[k + 1]]) for k in odd.tolist()]
            remembered, kept = (self.ids, self.begin, self.size, self.whole, self.true), np.ones(len(entry), bool)
            for k, number in zip(odd.tolist(), self.add_whole(texts).tolist(), strict=True):
                kept[at[k] + 1 : at[k + 1]] = False
                entry[at[k]] = number
            entry = entry[kept]
            at = np.concatenate(([0], np.cumsum(kept)))[at]
        size = self.size[entry]
        cuts = np.concatenate(([0], np.cumsum(size)))
        place = np.arange(cuts[-1]) + np.repeat(self.begin[entry] - cuts[:-1], size)
        wrong = np.concatenate(([0], np.cumsum(~self.true[entry])))
        same = wrong[at[1:]] == wrong[at[:-1]] if n else np.empty(0, bool)
        out = Encoded(self.ids[place], cuts[at], same, cuts[:-1])
        if len(odd):
            self.ids, self.begin, self.size, self.whole, self.true = remembered
        return out


class Split:
    """The parts of texts: the distinct ones, the number of every part in order, and where each text's begin."""

    def __init__(self, texts: list[str], lead: str = ""):
        data = [(lead + t).encode() if t else b"" for t in texts]
        starts = np.concatenate(([0], np.cumsum([len(d) for d in data]))).astype(np.int64)
        joined = b"".join(data)
        values = np.frombuffer(joined, np.uint8)
        cut = (values == 0x20) | (values == 0x0A)
        cut[1:] &= ~_SPACE[values[:-1]]
        cut[starts[:-1][np.diff(starts) > 0]] = True
        begin = np.nonzero(cut)[0]
        offsets = np.append(begin, len(values)).astype(np.int64)
        array = pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        coded = array.dictionary_encode()
        self.parts: list[str] = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.index = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        self.at = np.searchsorted(begin, starts)


_OPEN: dict[tuple, Wordwise] = {}


def byte_encoder(path: str | None = None, plain_specials: bool = False) -> Wordwise:
    """The worker's encoder; without a path that of the public 50k byte-level vocabulary."""
    return _opened("byte", path or _public("byte_bpe_50k.json"), plain_specials)


def piece_encoder(path: str | None = None) -> Wordwise:
    return _opened("piece", path or _public("piece_bpe_32k.model"))


def _public(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _opened(kind: str, path: str, *more: bool) -> Wordwise:
    key = (kind, str(path), *more)
    if key not in _OPEN:
        _OPEN[key] = Wordwise(ByteVocabulary(str(path), *more) if kind == "byte" else PieceVocabulary(str(path)))
    return _OPEN[key]
