"""Token ids of whole texts from a public ``tokenizers`` file, by units.

For vocabularies whose tokens end with their word (``end_of_word_suffix``)
and never cross white space, the ids of a text are those of its words
(split at ASCII white space) in a row. Where the file cuts and folds texts
in the known way (``_CUTS``, ``_FOLDS``), a word is also cut between a letter
and punctuation behind it, and ASCII letters are lower-cased beforehand, so
that words that differ in these share their units.

Units are found for many texts at once; Arrow numbers the distinct ones, each
of which is looked up once in a bounded cache (or encoded and kept), and the
ids of all texts are gathered from one array.
"""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterable

import numpy as np
import pyarrow as pa

from ledgerlens.llm.caches import kept
from ledgerlens.llm.words import LOWER, SPACE

CACHE_WORDS = 250_000
_JOINED = 256  # letter words encoded in one call
_BLOCK = 1 << 18  # units looked up at once

# Steps of a file under which no token crosses from a letter to punctuation,
# and ASCII case makes no difference.
_FOLDS = {"NFC", "Replace", "Lowercase"}
_SPACES = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
_CUTS = [
    {
        "type": "Split",
        "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
        "behavior": "Removed",
        "invert": True,
    },
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
]


def _table(*members: Iterable[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for m in members:
        table[list(m)] = True
    return table


_UPPER = _table(range(0x41, 0x5B))
_LETTER = _table(range(0x41, 0x5B), range(0x61, 0x7B))
_PUNCTUATION = _table(string.punctuation.encode())
# Two-byte letters from U+00C0 to U+017F: first byte, and second byte (left
# out are those of the multiplication and division signs, and of the dotted
# capital I, which ends with a combining mark when lower-cased).
_LEAD = _table(range(0xC3, 0xC6))
_SECOND = _table(set(range(0x80, 0xC0)) - {0x97, 0xB7, 0xB0})


def _steps(part: object, inner: str) -> list[dict]:
    """The JSON form of a normalizer or pre-tokenizer, as a list of steps."""
    if part is None:
        return []
    spec = json.loads(part.__getstate__())  # type: ignore[attr-defined]
    return spec[inner] if spec["type"] == "Sequence" else [spec]


class WordEncoder:
    """Little-endian ids (``dtype`` wide) of texts given as UTF-8 bytes.
    With ``special`` False the strings of special tokens are ordinary text."""

    def __init__(self, path: str, dtype: str = "<u4", special: bool = True, limit: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark gives out the cores
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not special
        self.dtype, self.limit = np.dtype(dtype), limit
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None) or ""
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            self.ends[[i for t, i in vocabulary.items() if t.endswith(suffix)]] = True
        folds = _steps(self.tokenizer.normalizer, "normalizers")
        added = [list(t.content.encode()) for t in self.tokenizer.get_added_tokens_decoder().values()]
        # Special tokens are neither cut nor folded: what they hold beside
        # letters is no tail, and leaves its unit as it is.
        self.tail = _PUNCTUATION & ~_table(*added)
        # Units of these bytes only hold no combining marks either.
        self.simple = _LETTER | self.tail | _LEAD | _table(range(0x80, 0xC0))
        self.known = (
            _steps(self.tokenizer.pre_tokenizer, "pretokenizers") == _CUTS
            and {f["type"] for f in folds} <= _FOLDS
            and {"type": "Lowercase"} in folds
            and all(f == _SPACES for f in folds if f["type"] == "Replace")
            and not any(self.simple[t].all() for t in added)
        )
        # Lower-case ASCII words need none of the file's steps but the model.
        self.letters = Tokenizer(self.tokenizer.model)
        self.letters.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.ids = np.zeros(1 << 12, dtype=self.dtype)
        self.bounds = np.zeros(1 << 12, dtype=np.int64)  # of each unit's ids

    def _units(self, data: np.ndarray, offsets: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The units of all texts in a row, and each text's bounds in them."""
        keep = ~SPACE[data]
        first = keep.copy()
        first[1:] &= ~keep[:-1]
        rows = offsets[:-1][offsets[:-1] < len(data)]
        if self.known:
            tail = np.flatnonzero(self.tail[data])
            stray = rows[(data[rows] & 0xC0) == 0x80]  # no UTF-8: the text before is not looked at
            tail = tail[(tail > 1) & ~np.isin(tail - 1, stray)] if len(stray) else tail[tail > 1]
            before, second = data[tail - 2], data[tail - 1]
            first[tail[_LETTER[second] | (_LEAD[before] & _SECOND[second])]] = True
        first[rows] = keep[rows]
        at = np.searchsorted(np.flatnonzero(first), offsets)
        body, start = data[keep], np.flatnonzero(first[keep])
        if self.known:
            upper = np.flatnonzero(_UPPER[body])
            other = ~self.simple[body]
            if len(upper) and other.any():
                odd = np.logical_or.reduceat(other, start)
                upper = upper[~odd[np.searchsorted(start, upper, side="right") - 1]]
            body[upper] = LOWER[body[upper]]
        edges = np.append(start, len(body)).astype(np.int32)
        units = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(edges), pa.py_buffer(body)])
        return units, at

    def _keep(self, units: list[bytes], ids: np.ndarray, lengths: np.ndarray) -> None:
        have = len(self.numbers)
        held = int(self.bounds[have])
        if held + len(ids) > len(self.ids):
            self.ids = np.resize(self.ids, 2 * (held + len(ids)))
        if have + len(units) >= len(self.bounds):
            self.bounds = np.resize(self.bounds, 2 * (have + len(units)))
        self.ids[held : held + len(ids)] = ids
        self.bounds[have + 1 : have + 1 + len(units)] = held + np.cumsum(lengths)
        self.numbers.update(zip(units, range(have, have + len(units))))

    def _learn_singly(self, units: list[bytes]) -> None:
        found = self.tokenizer.encode_batch_fast([u.decode("utf-8", "replace") for u in units], add_special_tokens=False)
        ids = [e.ids for e in found]
        self._keep(units, np.array([i for own in ids for i in own], dtype=self.dtype), np.array([len(x) for x in ids], int))

    def _learn_joined(self, tokenizer: object, units: list[bytes]) -> None:
        """Ids of single words, many to a call; the ends of the words are the
        tokens that carry the suffix. If their number differs, a word was
        not one unit, and the words of that call are encoded one by one."""
        groups = [units[k : k + _JOINED] for k in range(0, len(units), _JOINED)]
        texts = [b" ".join(g).decode("utf-8", "replace") for g in groups]
        for group, e in zip(groups, tokenizer.encode_batch_fast(texts, add_special_tokens=False)):  # type: ignore[attr-defined]
            ids = np.array(e.ids, dtype=self.dtype)
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(group):
                self._keep(group, ids, np.diff(stop, prepend=0))
            else:
                self._learn_singly(group)

    def _learn(self, units: list[bytes]) -> None:
        plain, letters, other = [], [], []
        for u in units:
            if not self.known:
                other.append(u)
            elif u.isalpha():  # ASCII, and so lower-cased
                plain.append(u)
            elif u.decode("utf-8", "replace").isalpha():
                letters.append(u)
            else:
                other.append(u)
        self._learn_joined(self.letters, plain)
        self._learn_joined(self.tokenizer, letters)
        self._learn_singly(other)

    def _gather(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of units in a row, and where each unit's ids end."""
        if len(self.numbers) > self.limit:
            self._forget()
        coded = units.dictionary_encode()
        names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = list(map(self.numbers.get, names))
        unknown = [k for k, n in enumerate(found) if n is None]
        if unknown:
            self._learn([names[k] for k in unknown])
            for k in unknown:
                found[k] = self.numbers[names[k]]
        number, code = np.array(found, dtype=np.int64), coded.indices.to_numpy()
        lengths = (self.bounds[number + 1] - self.bounds[number])[code]
        ends = np.cumsum(lengths)
        place = np.repeat(self.bounds[number][code] - (ends - lengths), lengths)
        place += np.arange(len(place))
        return self.ids[place], ends

    def encode_rows(self, data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
        """The ids of each text of a byte buffer, as bytes."""
        units, at = self._units(data, offsets)
        parts, ends = [b""], [np.zeros(1, dtype=np.int64)]
        for k in range(0, len(units), _BLOCK):
            ids, stop = self._gather(units.slice(k, _BLOCK))
            parts.append(ids.tobytes())
            ends.append(stop + ends[-1][-1])
        body = b"".join(parts)
        bounds = (np.concatenate(ends)[at] * self.dtype.itemsize).tolist()
        return [body[a:b] for a, b in zip(bounds, bounds[1:])]

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """The ids of each text, as bytes."""
        offsets = np.cumsum([0, *map(len, texts)])
        return self.encode_rows(np.frombuffer(b"".join(texts), dtype=np.uint8), offsets)


def word_encoder(
    path: str, dtype: str = "<u4", special: bool = True, limit: int = CACHE_WORDS
) -> WordEncoder:
    """The encoder of this Python worker, kept between tasks."""
    return kept(("words", path, dtype, special, limit), lambda: WordEncoder(path, dtype, special, limit))


def utf8_rows(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    body = data.tobytes()
    at = offsets.tolist()
    return [body[a:b] for a, b in zip(at, at[1:])]
