"""Ids of whole texts, with the ids of recurring units remembered.

A unit is a run of white space with the run of other characters after it. The splitting patterns of the
byte-level and of the word vocabularies never look across the start of a unit, so the ids of a text are
the ids of its units, one after the other. Many texts are taken together and their units numbered, so that each different
unit is looked up once, and is encoded once while it is remembered; the memory is bounded. Units go to the tokenizers library,
but plain words of a vocabulary whose merges provably follow from the ranks of its tokens, which are merged by rank. A text that holds one of the vocabulary's special tokens literally goes to
the library whole, which gives that token's id.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import sys
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space as the tokenizers see it: Python's own class without the four separators U+001C to U+001F.
_UNIT = re.compile(r"[^\S\x1c-\x1f]*(?:\S|[\x1c-\x1f])+|[^\S\x1c-\x1f]+")
#: White space other than blanks and line feeds, and what Python takes for such.
_OTHER = re.compile("[\t\x0b-\r\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A word of Latin letters, which no splitting pattern divides, and a mark that every one of them parts from it.
_WORD = re.compile("( ?)([A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([.,]?)")

#: Stands for the end of a word; plain words have none.
_END = b"\0"

#: Characters of texts whose units are numbered at once.
AT_ONCE = 1 << 22

#: Longest unit that is remembered, and how many units each of the two generations holds.
LONGEST, HELD = 48, 300_000


def _uneven(text: str) -> bool:
    """Whether white space stands at an end, or two of them together, or any other than blanks and line feeds at all."""
    return (
        text[0] in " \n" or text[-1] in " \n" or "  " in text or " \n" in text or "\n " in text or "\n\n" in text
        or _OTHER.search(text) is not None
    )


class _Memo(dict):
    """Two generations: when the young one is full it becomes the old one, and the old one goes."""

    def __init__(self, make: Callable[[str], bytes], held: int):
        super().__init__()
        self.make, self.held, self.old = make, held, {}

    def __missing__(self, unit: str) -> bytes:
        ids = self.old.get(unit)
        if ids is None:
            ids = self.make(unit)
        if len(unit) <= LONGEST:
            if len(self) >= self.held:
                self.old = dict(self)
                self.clear()
            self[unit] = ids
        return ids


    def many(self, units: list[str], make_all: Callable[[list[str]], list[bytes]]) -> list[bytes]:
        """The ids of many different units; those that are not remembered are made together."""
        found = list(map(self.get, units))
        missing = [k for k, ids in enumerate(found) if ids is None]
        fresh = []
        for k in missing:
            ids = found[k] = self.old.get(units[k])
            if ids is None:
                fresh.append(k)
        for k, ids in zip(fresh, make_all([units[k] for k in fresh]), strict=True):
            found[k] = ids
        for k in missing:
            if len(units[k]) <= LONGEST:
                if len(self) >= self.held:
                    self.old = dict(self)
                    self.clear()
                self[units[k]] = found[k]
        return found


class UnitEncoder:
    """Encodes texts unit by unit through ``make``, which gives a unit's ids as little-endian bytes; a text with one of the
    literals ``added`` goes through ``whole``."""

    def __init__(self, make: Callable[[str], bytes], held: int = HELD, added: Sequence[str] = (), whole: Callable[[str], bytes] | None = None, make_all: Callable[[list[str]], list[bytes]] | None = None):
        self._added, self._whole = tuple(added), whole
        self._make_all = make_all or (lambda units: [*map(make, units)])
        self._units = _Memo(make, held)
        self._spaced = _Memo(lambda part: make(part if part[:1] == "\n" else " " + part), held)

    def encode(self, text: str) -> bytes:
        found = self._odd(text)
        if found is not None:
            return found
        first, *rest = text.replace("\n", " \n").split(" ")
        return self._units[first] + b"".join(map(self._spaced.__getitem__, rest))

    def _odd(self, text: str) -> bytes | None:
        """The ids of a text that is not just units with one blank or line feed between them."""
        if not text:
            return b""
        for literal in self._added:
            if literal in text:
                return self._whole(text)
        if _uneven(text):
            return b"".join(map(self._units.__getitem__, _UNIT.findall(text)))
        return None

    def encode_all(self, texts: Iterable[str], width: int, at_once: int | None = None) -> Iterator[bytes]:
        """The ids of each text, ``width`` bytes an id. Texts are taken together until they have ``at_once`` characters; their units
        are numbered at once, each different one is looked up once, and the ids are put together by those numbers."""
        held: list[tuple[bytes | None, str, int]] = []
        size, at_once = 0, at_once or AT_ONCE
        for text in texts:
            found = self._odd(text)
            if found is None:
                first, _, rest = text.replace("\n", " \n").partition(" ")
                if len(rest) > at_once:
                    yield from self._together(held, width)
                    held, size = [], 0
                    yield self._units[first] + b"".join(self._cut(rest, width, at_once))
                    continue
                held.append((self._units[first], rest, rest.count(" ") + 1 if rest else 0))
                size += len(rest)
            else:
                held.append((found, "", 0))
            if size >= at_once:
                yield from self._together(held, width)
                held, size = [], 0
        yield from self._together(held, width)

    def _cut(self, rest: str, width: int, at_once: int) -> Iterator[bytes]:
        """A long text, so many characters and the unit that they end in at a time."""
        at = 0
        while at < len(rest):
            stop = rest.find(" ", at + at_once)
            part = rest[at:] if stop < 0 else rest[at:stop]
            yield from self._together([(b"", part, part.count(" ") + 1)], width)
            at += len(part) + 1

    def _together(self, held: list[tuple[bytes | None, str, int]], width: int) -> Iterator[bytes]:
        rest = " ".join([r for _, r, n in held if n])
        if not rest:
            yield from (head for head, *_ in held)
            return
        units = pc.split_pattern(pa.array([rest], pa.large_string()), " ").values.dictionary_encode()
        which = units.indices.to_numpy()
        ids = self._spaced.many(units.dictionary.to_pylist(), lambda parts: self._make_all([p if p[:1] == "\n" else " " + p for p in parts]))
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // width
        flat = np.frombuffer(b"".join(ids), f"<u{width}")
        of_unit = sizes[which]
        ends = np.cumsum(of_unit)
        places = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - of_unit), of_unit)
        places += np.arange(len(places))
        out, unit, at = flat[places], 0, 0
        for head, _, n in held:
            if n:
                unit += n
                stop = int(ends[unit - 1])
                yield head + out[at:stop].tobytes()
                at = stop
            else:
                yield head


def _byte_letters() -> list[str]:
    """The letter that stands for each byte in a byte-level vocabulary: itself where it prints, else one from U+0100 on."""
    prints = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in prints else chr(next(others)) for b in range(256)]


def _merged_ranks(parts: dict) -> tuple[dict[bytes, int], list[tuple[bytes, bytes]], np.ndarray] | None:
    """A vocabulary's tokens as bytes with their ranks (bytes, ends of words, then merges in their order), the merges, and the id
    of each rank. A zero byte stands for the end of a word. None where a byte has no token, or a token not just one rank."""
    vocabulary, suffix = parts["model"]["vocab"], parts["model"].get("end_of_word_suffix") or ""
    letters = _byte_letters()
    byte_of = {c: bytes([b]) for b, c in enumerate(letters)}

    def plain(token: str) -> bytes:
        ends = suffix and token.endswith(suffix)
        return b"".join([byte_of[c] for c in (token[: -len(suffix)] if ends else token)]) + (_END if ends else b"")

    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in parts["model"]["merges"]]
    tokens = [*letters, *([c + suffix for c in letters] if suffix else []), *(a + b for a, b in pairs)]
    try:
        ranks = {plain(t): k for k, t in enumerate(tokens)}
        return (ranks, [(plain(a), plain(b)) for a, b in pairs], np.array([vocabulary[t] for t in tokens])) if len(ranks) == len(tokens) else None
    except KeyError:
        return None


@functools.cache
def rank_order_suffices(path: str) -> bool:
    """Whether merging by the ranks of tokens gives what merging by the listed pairs gives, for every text.

    That is so if each token, merged by the ranks below its own, ends as the two parts that its merge lists: when two
    neighbours are about to become a token, what lies between its ends was merged by lower ranks alone and within those ends,
    so they are those two parts. It takes a second or less, on the driver; tasks are told the answer.
    """
    with open(path, encoding="utf-8") as file:
        found = _merged_ranks(json.load(file))
    if found is None:
        return False
    ranks, merges, _ = found
    for pair in merges:
        token = b"".join(pair)
        own = ranks[token]
        held = [token[k : k + 1] for k in range(len(token))]
        while True:
            best, at = min(((ranks.get(a + b, own), k) for k, (a, b) in enumerate(itertools.pairwise(held))), default=(own, 0))
            if best >= own:
                break
            held[at : at + 2] = [held[at] + held[at + 1]]
        if tuple(held) != pair:
            return False
    return True


def library_encoder(path: str, width: int, by_rank: bool = False) -> UnitEncoder:
    """A ``UnitEncoder`` over a vocabulary file of the tokenizers library; ``width`` bytes for each id.

    Plain words go past the library's normaliser and splitter, which leave them whole: to its model, or, where
    ``rank_order_suffices``, many at once to a merger by ranks.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        parts = json.load(file)
    added = parts["added_tokens"] or []
    if any(a["normalized"] for a in added):
        raise ValueError(f"added tokens that are looked for in normalised text are not handled: {path}")
    splitter = parts["pre_tokenizer"] or {}
    blank_stays = splitter.get("type") == "ByteLevel" and splitter["use_regex"] and not splitter["add_prefix_space"]
    steps = (parts["normalizer"] or {}).get("normalizers", [])
    lower = any(s["type"] == "Lowercase" for s in steps)
    plain = blank_stays and not steps or lower and splitter.get("type") == "Sequence"
    letters = _byte_letters()

    pack = {2: "H", 4: "I"}[width]
    if array(pack).itemsize != width:
        raise ValueError(f"no array of {width} bytes an id on this machine")
    little = sys.byteorder == "little"

    def packed(ids: list[int]) -> bytes:
        held = array(pack, ids)
        if not little:
            held.byteswap()
        return held.tobytes()

    def whole(unit: str) -> bytes:
        return packed(tokenizer.encode(unit, add_special_tokens=False).ids)

    marks = {m: whole(m) for m in ("", ".", ",")}

    def word_of(unit: str) -> tuple[str, str] | None:
        """What the model merges of a unit that is a plain word, and the mark behind it."""
        text, mark = (unit[1:], "") if unit[0] == " " else (unit, "")
        if text[-1:] in (",", "."):
            text, mark = text[:-1], text[-1]
        if text.isascii() and text.isalpha():
            blank = " " if unit[0] == " " else ""
        elif word := _WORD.fullmatch(unit):
            blank, text, mark = word.groups()
        else:
            return None
        return (blank if blank_stays else "") + (text.lower() if lower else text), mark

    def make(unit: str) -> bytes:
        if not plain or (word := word_of(unit)) is None:
            return whole(unit)
        return words[word[0]] + marks[word[1]]

    tokenize, letter_of_blank = tokenizer.model.tokenize, letters[32]

    def model_ids(text: str) -> bytes:
        if not text.isascii():
            text = "".join([letters[b] for b in text.encode()])
        elif text[0] == " ":  # an ASCII letter stands for itself
            text = letter_of_blank + text[1:]
        return packed([t.id for t in tokenize(text)])

    words = _Memo(model_ids, HELD)
    make_all = None
    if by_rank and plain and (found := _merged_ranks(parts)) is not None:
        import tiktoken

        ranks, _, id_of = found
        merger = tiktoken.Encoding("words", pat_str="[^\n]+|\n", mergeable_ranks=ranks, special_tokens={})
        between, end = ranks[b"\n"], _END.decode() if parts["model"].get("end_of_word_suffix") else ""
        id_of = id_of.astype(f"<u{width}")

        def make_all(units: list[str]) -> list[bytes]:
            """Words are merged in one call, parted by line feeds, which no plain word has."""
            told = [word_of(u) for u in units]
            asked = [w[0] + end for w in told if w is not None]
            merged = np.array(merger.encode_ordinary("\n".join(asked)), np.int64)
            stops = np.append(np.flatnonzero(merged == between), len(merged)).tolist()
            ids, at, out, nth = id_of[merged].tobytes(), 0, [], 0
            for unit, word in zip(units, told, strict=True):
                if word is None:
                    out.append(whole(unit))
                    continue
                stop = stops[nth]
                out.append(ids[width * at : width * stop] + marks[word[1]])
                at, nth = stop + 1, nth + 1
            return out

    return UnitEncoder(make, added=[a["content"] for a in added], whole=whole, make_all=make_all)


_ENCODERS: dict[tuple[str, int, bool], UnitEncoder] = {}


def encoder(path: str, width: int = 4, by_rank: bool = False) -> UnitEncoder:
    """This process's encoder for a vocabulary; a Python worker keeps it from task to task."""
    key = (path, width, by_rank)
    if key not in _ENCODERS:
        _ENCODERS[key] = library_encoder(path, width, by_rank)
    return _ENCODERS[key]


def vocabulary_size(path: str) -> int:
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path).get_vocab_size()


def texts_of(batch, name: str = "text") -> Iterable[str]:
    """The texts of an Arrow batch, one at a time; null counts as empty."""
    for value in batch.column(batch.schema.get_field_index(name)):
        yield value.as_py() or ""
