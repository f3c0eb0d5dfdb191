"""Token ids of whole texts, by the public tokenizers' own libraries."""

from __future__ import annotations

import gc
import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from struct import pack

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism

#: Characters of text whose unknown pieces are encoded together.
TOGETHER = 1 << 21
#: Pieces whose ids a worker keeps: those used lately, and as many from before.
PARTS_KEPT, STEMS_KEPT = 300_000, 300_000
#: Pieces that are encoded as one text, and the character that stands between them there.
JOINED, BETWEEN = 512, "\x01"
#: What stands between plain words, which hold no sign.
BETWEEN_WORDS = "!"
#: Signs that a word is parted from: all of ASCII but the apostrophe, which may belong to both.
SIGNS = "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")

# The steps before the model of a tokenizer that treats runs of letters, single
# digits and runs of signs one by one.
RUNS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
RUN_NORMALIZERS = {"NFC", "Replace", "Lowercase"}


class _Kept:
    """Values by piece; of what has not been used for a while, pieces are forgotten."""

    def __init__(self, limit: int):
        self.limit, self.now, self.before = limit, {}, {}

    def unknown(self, pieces: set[str]) -> list[str]:
        """Those without a value. All others can be looked up in `now` until the next call."""
        if len(self.now) > self.limit:
            self.now, self.before = {}, self.now
        missing = pieces.difference(self.now)
        before = self.before
        again = [piece for piece in missing if piece in before]  # not all that was kept is gone through
        self.now.update((piece, before[piece]) for piece in again)
        return list(missing.difference(again))


class SpaceSplitIds:
    """Ids of a tokenizer (a tokenizers .json file) that never joins text across a space.

    The ids of a text are then those of its parts, one after the other, so each different
    part is encoded once, as a whole; parts in ASCII are taken in lower case where the
    tokenizer does so, too. Many parts are encoded as one text, with a character between
    them that no other text shares a token with; parts that hold it themselves, or one of
    the tokenizer's added tokens, are encoded one by one. Ids are little-endian unsigned
    32-bit integers.

    Where the tokenizer parts runs of letters from runs of signs, signs of ASCII behind a
    letter of ASCII are taken off and both sides are looked up: nothing there composes or
    changes with its neighbour. Lower-case words of ASCII letters stay as they are in all
    steps before the model, so they are given to the model without these steps.
    """

    def __init__(self, path: str):
        import numpy as np
        from tokenizers import Tokenizer

        self.numpy = np
        self.tokenizer = Tokenizer.from_file(path)
        ids = lambda text: self.tokenizer.encode(text, add_special_tokens=False).ids
        between = ids(BETWEEN)
        if ids("Ab c") != ids("Ab") + ids("c") or ids(f"a. {BETWEEN} b") != ids("a.") + between + ids("b"):
            raise ValueError(f"this tokenizer does not split text at spaces: {path}")
        if len(between) != 1:
            raise ValueError(f"this tokenizer has no token for U+0001: {path}")
        added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.alone = re.compile("|".join(map(re.escape, [BETWEEN, *added])))
        self.folds = ids("ABC") == ids("abc")
        self.parts, self.stems = _Kept(PARTS_KEPT), _Kept(STEMS_KEPT)
        self.words = self._plain_words() if self._takes_runs() else None

    def _takes_runs(self) -> bool:
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            return False
        before = json.loads(self.tokenizer.normalizer.__getstate__())
        if not {step["type"] for step in before.get("normalizers", [before])} <= RUN_NORMALIZERS:
            return False
        steps = json.loads(self.tokenizer.pre_tokenizer.__getstate__()).get("pretokenizers", [])
        if [step["type"] for step in steps] != ["Split", "ByteLevel"]:
            return False
        split, octets = steps
        alone = split["pattern"] == {"Regex": RUNS} and split["behavior"] == "Removed" and split["invert"]
        return alone and not octets["add_prefix_space"] and not octets["use_regex"]

    def _plain_words(self):
        """The same model behind a cut at spaces and nothing else."""
        from tokenizers import Tokenizer, pre_tokenizers

        words = Tokenizer(self.tokenizer.model)
        words.pre_tokenizer = pre_tokenizers.Split(" ", "removed")
        return words

    def _together(self, tokenizer, pieces: list[str], between: str) -> list[bytes]:
        """The ids of each piece, in order; many are encoded as one text, with `between` in between."""
        np = self.numpy
        (sign,) = tokenizer.encode(between, add_special_tokens=False).ids
        out = []
        for first in range(0, len(pieces), JOINED):
            some = pieces[first : first + JOINED]
            (e,) = tokenizer.encode_batch_fast([f" {between} ".join(some)], add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            data, signs = ids.tobytes(), 4 * np.flatnonzero(ids == sign)
            starts, ends = [0, *(signs + 4).tolist()], [*signs.tolist(), len(data)]
            if len(ends) != len(some):
                raise ValueError("a piece has the id of the sign between pieces")
            out += [data[start:end] for start, end in zip(starts, ends)]
        return out

    def _add(self, known: dict[str, bytes], pieces: list[str]) -> None:
        """Add the ids of different pieces."""
        if self.alone.search(" ".join(pieces)):
            single = [piece for piece in pieces if self.alone.search(piece)]
            for piece, e in zip(single, self.tokenizer.encode_batch_fast(single, add_special_tokens=False), strict=True):
                known[piece] = pack(f"<{len(e.ids)}I", *e.ids)
            pieces = list(set(pieces).difference(single))
        if self.words is not None:
            plain = [p for p in pieces if p.islower() and p.isascii() and p.isalpha()]
            known.update(zip(plain, self._together(self.words, plain, BETWEEN_WORDS), strict=True))
            pieces = list(set(pieces).difference(plain))
        known.update(zip(pieces, self._together(self.tokenizer, pieces, BETWEEN), strict=True))

    def _learn(self, parts: set[str]) -> None:
        unknown = self.parts.unknown(parts)
        if not unknown:
            return
        whole = set()  # no part may become an added token, or lose one, by what follows
        together = " ".join(unknown)
        if self.alone.search(together) or self.alone.search(together.lower()):
            whole = {p for p in unknown if self.alone.search(p) or self.alone.search(p.lower())}
        cut, stems, tails, uncut = [], [], [], unknown
        if self.words is not None:
            for part, stem in zip(unknown, [part.rstrip(SIGNS) for part in unknown]):
                if len(stem) != len(part) and stem and stem[-1] in LETTERS and part not in whole:
                    cut.append(part)
                    stems.append(stem)
                    tails.append(part[len(stem) :])
            uncut = list(set(unknown).difference(cut))
        forms = uncut
        if self.folds:
            stems = [s.lower() if s.isascii() else s for s in stems]  # none of these is in whole
            forms = [p.lower() if p.isascii() and p not in whole else p for p in uncut]
        new = self.stems.unknown({*stems, *tails, *forms})
        known, now = self.stems.now, self.parts.now
        self._add(known, new)
        now.update(zip(uncut, map(known.__getitem__, forms), strict=True))
        both = map(bytes.__add__, map(known.__getitem__, stems), map(known.__getitem__, tails))
        now.update(zip(cut, both, strict=True))

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """The ids of each text, in order. Unknown parts of many texts are encoded together."""
        held, size = [], 0
        for text in texts:
            held.append((text or "").replace("\n", " ").split(" "))
            size += len(text or "")
            if size >= TOGETHER:
                yield from self._encoded(held)
                held, size = [], 0
        yield from self._encoded(held)

    def _encoded(self, held: list[list[str]]) -> Iterator[bytes]:
        # Strings and bytes refer to nothing, so there is nothing for the collector to find;
        # its passes over millions of them took a fifth of the time.
        collects = gc.isenabled()
        gc.disable()
        try:
            self._learn(set().union(*held))
            ids = [b"".join(map(self.parts.now.__getitem__, parts)) for parts in held]
        finally:
            if collects:
                gc.enable()
        yield from ids


@lru_cache
def space_split_ids(path: str) -> SpaceSplitIds:
    """One for each worker and file."""
    return SpaceSplitIds(path)


@lru_cache
def counter(path: str):
    """A function from a list of texts to their numbers of tokens, without special tokens."""
    if path.endswith(".model"):
        import sentencepiece

        pieces = sentencepiece.SentencePieceProcessor(model_file=path)
        return lambda texts: [len(ids) for ids in pieces.encode(texts, num_threads=1)]
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    return lambda texts: [len(e.ids) for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
