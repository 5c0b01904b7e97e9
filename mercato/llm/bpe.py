"""Token ids of whole texts, with the tokenizers library.

The tokenizer drops white space and never merges across the pieces of its
split pattern, so a text's ids are those of its pieces.  A text of ``PLAIN``
characters is cut into words and pieces here, by Arrow; each new piece is encoded
once and kept.
Other texts, and those that hold a special string, are cut at ASCII white
space (no piece goes over it), and their words that are not plain take the
tokenizer's whole pipeline.  The ids equal those of the whole text (tests
compare the two).  The cache has a bound in bytes and starts anew beyond it, so
a task's memory does not grow with its texts."""

from __future__ import annotations

import json
import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

from mercato.llm.common import Payload, per_worker

WORD_BPE = "word_bpe_49k.json"
#: Bytes of cached pieces (with ENTRY for each one's objects and ids) after
#: which the cache starts anew, between two slices.
CACHE_BYTES = 72 << 20
ENTRY = 200
#: Pieces that go to the tokenizer as one text.
TOGETHER = 200

#: Characters whose normal form, lower case and category no version of Unicode
#: has changed: ASCII, Latin-1 and Latin Extended-A but for U+0130; of them,
#: letters and numbers.  The rest of the split pattern is the tokenizer's own.
_PLAIN = r"\t-\r -~\u00A1-\u012F\u0131-\u017F"
_LETTERS = r"A-Za-z\u00AA\u00B5\u00BA\u00C0-\u00D6\u00D8-\u00F6\u00F8-\u017F"
_NUMBERS = r"0-9\u00B2\u00B3\u00B9\u00BC-\u00BE"
PLAIN = re.compile(f"[{_PLAIN}]*")


def plain_pattern(split: str) -> re.Pattern:
    """The split pattern for plain text, with its classes spelt out."""
    classes = {r"[\p{L}]+": f"[{_LETTERS}]+", r"[\p{N}]": f"[{_NUMBERS}]", r"[^\s\p{L}\p{N}]+": rf"[^\s{_LETTERS}{_NUMBERS}]+"}
    parts = [classes.get(p, p) for p in split.split("|")]
    if not set(classes) <= set(split.split("|")) or any("\\p" in p for p in parts):
        raise ValueError("the tokenizer splits by another pattern")
    return re.compile("|".join(parts))


def tokenizer_path(name: str = WORD_BPE) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def sent(spark: SparkSession, path: str | None = None) -> Payload:
    """The tokenizer's file (a fixed size), broadcast: only the driver reads it."""
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        return Payload(spark, f.read())


def encoder(definition: str) -> Encoder:
    """The worker's encoder of a tokenizer; it keeps its caches over tasks."""
    return per_worker(("encoder", hash(definition)), lambda: Encoder(definition))


class Encoder:
    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(definition)
        d = json.loads(definition)
        steps = d["pre_tokenizer"]["pretokenizers"]
        self.pattern = plain_pattern(next(s for s in steps if s["type"] == "Split")["pattern"]["Regex"])
        self.special = [t["content"] for t in d["added_tokens"]]
        # the same model behind a split at spaces, for pieces found here
        d["normalizer"], d["added_tokens"] = None, []
        d["pre_tokenizer"]["pretokenizers"] = [
            {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False},
            *[s for s in steps if s["type"] != "Split"]]
        self.pieces = Tokenizer.from_str(json.dumps(d))
        suffix = d["model"]["end_of_word_suffix"]
        self.ends = np.zeros(max(d["model"]["vocab"].values()) + 1, dtype=bool)
        for token, i in d["model"]["vocab"].items():
            self.ends[i] = token.endswith(suffix)
        # the same for Arrow, which writes characters otherwise
        self.spaced = re.sub(r"\\u([0-9A-F]{4})", r"\\x{\1}", f"({self.pattern.pattern})")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, int] = {}  # piece: its number
        self.held = 0
        self.pool = np.zeros(0, dtype="<u4")  # the pieces' ids, by number
        self.first = self.size = np.zeros(0, dtype=np.int64)

    def _learn(self, pieces: list[str]) -> None:
        groups = [pieces[a:a + TOGETHER] for a in range(0, len(pieces), TOGETHER)]
        ids, size = [], []
        for group, e in zip(groups, self.pieces.encode_batch_fast([" ".join(g) for g in groups], add_special_tokens=False)):
            ids.append(np.array(e.ids, dtype="<u4"))
            last = np.flatnonzero(self.ends[ids[-1]]) + 1
            if len(last) != len(group):
                raise ValueError("the tokenizer left a piece without its end")
            size.append(np.diff(last, prepend=0))
        if not pieces:
            return
        new = np.concatenate(size)
        self.known.update(zip(pieces, range(len(self.size), len(self.size) + len(pieces))))
        self.first = np.r_[self.first, len(self.pool) + np.cumsum(new) - new]
        self.size = np.r_[self.size, new]
        self.pool = np.concatenate([self.pool, *ids])
        self.held += sum(map(len, pieces)) + ENTRY * len(pieces)

    def _numbers(self, pieces) -> np.ndarray:
        """The numbers of pieces; new ones are encoded first."""
        out = np.fromiter(map(self.known.get, pieces, repeat(-1)), dtype=np.int64, count=len(pieces))
        new = np.flatnonzero(out < 0)
        if len(new):
            words = [pieces[i] for i in new.tolist()]
            self._learn(list(dict.fromkeys(words)))
            out[new] = np.fromiter(map(self.known.__getitem__, words), dtype=np.int64, count=len(words))
        return out

    def _is_plain(self, text: str) -> bool:
        return PLAIN.fullmatch(text) is not None and not any(s in text for s in self.special)

    def _ids_of_other(self, text: str) -> np.ndarray:
        """A text that is not plain, word by word."""
        out = [np.zeros(0, dtype="<u4")]
        for w in text.encode().split():
            t = w.decode()
            if self._is_plain(t):
                n = self._numbers(self.pattern.findall(t.lower()))
                out.append(_gathered(self.pool, self.first[n], self.size[n])[0])
            else:
                out.append(np.array(self.whole.encode(t, add_special_tokens=False).ids, dtype="<u4"))
        return np.concatenate(out)

    def _ids_of_plain(self, texts: list[str]) -> list[np.ndarray]:
        """Each distinct word of the texts is cut into pieces once, and each
        distinct piece looked up once; the texts are put together from their
        words' ids by place."""
        split = pc.ascii_split_whitespace(pa.array([t.lower() for t in texts], pa.large_string()))
        words = split.flatten().dictionary_encode()
        cut = pc.ascii_split_whitespace(pc.replace_substring_regex(words.dictionary, pattern=self.spaced, replacement=r"\1 "))
        pieces = cut.flatten().dictionary_encode()
        strings = pieces.dictionary.to_numpy(zero_copy_only=False)
        n = np.where(strings != "", 0, -1)  # a cut ends with an empty string
        n[n == 0] = self._numbers(strings[n == 0])
        n = n[pieces.indices.to_numpy()]
        real = n >= 0
        of_words, ends = _gathered(self.pool, self.first[n[real]], self.size[n[real]])
        # the words' ids lie in a row: where each begins, and how many it has
        bounds = np.r_[0, ends][np.r_[0, np.cumsum(real)][cut.offsets.to_numpy()]]
        at = words.indices.to_numpy()
        ids, ends = _gathered(of_words, bounds[:-1][at], np.diff(bounds)[at])
        cuts = np.r_[0, ends][split.offsets.to_numpy()].tolist()
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:])]

    def encode(self, texts: list[str | None]) -> list[np.ndarray]:
        """uint32 ids of each text (null: none)."""
        if self.held > CACHE_BYTES:
            self._forget()
        plain = [t is None or self._is_plain(t) for t in texts]
        done = iter(self._ids_of_plain([t or "" for t, p in zip(texts, plain) if p]))
        return [next(done) if p else self._ids_of_other(t) for t, p in zip(texts, plain)]


def _gathered(pool: np.ndarray, first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """pool[first:first + size] of each, in a row, and where each ends."""
    ends = np.cumsum(size)
    return pool[np.repeat(first - ends + size, size) + np.arange(int(ends[-1]) if len(ends) else 0)], ends
