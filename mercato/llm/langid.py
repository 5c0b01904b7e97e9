"""Language identification of whole texts, with spans of mixed-language text.

* *Script ranges* narrow the candidates: a word's script is that of its first
  letter, and a language is a candidate for a script that makes up at least
  ``MIN_SCRIPT`` of its training letters.
* *Word scores*: the log-probability of a word's byte n-grams (orders
  ``ORDERS``, with word edges) under each candidate language, from hashed
  counts of ``FEATURES`` entries a language.
* *Viterbi* over the words of a document, with a penalty for each switch,
  labels spans; the document's language is that of most letters, its score
  their share of all letters.

The model is fitted on a bounded sample of labelled rows: about
``SAMPLE_PER_LANG`` documents of each language, chosen by a hash of id and
text, whole texts.  It has FEATURES x languages numbers whatever the corpus,
so it is collected and broadcast.  Prediction is one map, without a shuffle;
a step of Viterbi handles all documents of a slice at once.

Defined results: a null text, or one without a letter, is ``und`` with score
0 and no spans; so is every text if no labelled row was found.  Words whose
script no language has lie in a neighbour's span, but their letters count for
no language, only in the total: a text of such words alone has the first
language with score 0.  Ties go to the first language in sorted order.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import Payload, append_columns, slices

FEATURES = 1 << 16
ORDERS = (2, 3, 4)
SAMPLE_PER_LANG = 3000
MIN_SCRIPT = 0.01
SWITCH_PENALTY = 15.0
SMOOTH = 0.5

#: First and last code points of scripts (fixed by Unicode).
SCRIPTS = {
    "Latin": [(0x41, 0x5A), (0x61, 0x7A), (0xAA, 0x24F), (0x1E00, 0x1EFF)],
    "Greek": [(0x370, 0x3FF), (0x1F00, 0x1FFF)],
    "Cyrillic": [(0x400, 0x52F)],
    "Armenian": [(0x530, 0x58F)],
    "Hebrew": [(0x590, 0x5FF)],
    "Arabic": [(0x600, 0x6FF), (0x750, 0x77F)],
    "Devanagari": [(0x900, 0x97F)],
    "Bengali": [(0x980, 0x9FF)],
    "Tamil": [(0xB80, 0xBFF)],
    "Thai": [(0xE00, 0xE7F)],
    "Georgian": [(0x10A0, 0x10FF)],
    "Hangul": [(0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF)],
    "Kana": [(0x3040, 0x30FF)],
    "Han": [(0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x20000, 0x2FFFF)],
}
SCRIPT_NAMES = ["Other", *SCRIPTS]
_RANGES = sorted((a, b, i) for i, name in enumerate(SCRIPTS, 1) for a, b in SCRIPTS[name])
_FIRST = np.array([r[0] for r in _RANGES])
_LAST = np.array([r[1] for r in _RANGES])
_OF = np.array([r[2] for r in _RANGES])

_WORD = re.compile(r"[^\W\d_]+")
_LETTER = regex.compile(r"\p{L}")

FIELDS = [
    T.StructField("lang_pred", T.StringType(), False),
    T.StructField("score", T.DoubleType(), False),
    T.StructField("spans", T.ArrayType(T.StructType([
        T.StructField("lang", T.StringType(), False),
        T.StructField("start", T.IntegerType(), False),
        T.StructField("end", T.IntegerType(), False)]), False), False),
]


def script_of(words: list[str]) -> np.ndarray:
    c = np.array([ord(w[0]) for w in words], dtype=np.int64)
    k = np.maximum(np.searchsorted(_FIRST, c, side="right") - 1, 0)
    return np.where((c >= _FIRST[k]) & (c <= _LAST[k]), _OF[k], 0)


def grams(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(word number, feature) of every n-gram of the words."""
    raw = " " + "  ".join(words) + " "  # each word between its own edges
    b = np.frombuffer(raw.encode(), dtype=np.uint8)
    size = np.array([len(w.encode()) + 2 for w in words], dtype=np.int64)
    owner = np.repeat(np.arange(len(words)), size)
    whose, feature = [], []
    h = np.zeros(len(b), dtype=np.uint64)
    for n in range(1, max(ORDERS) + 1):
        m = len(b) - n + 1
        if m <= 0:
            break
        h = (h[:m] * np.uint64(257) + b[n - 1:].astype(np.uint64) + np.uint64(1))
        if n in ORDERS:
            inside = owner[:m] == owner[n - 1:]
            whose.append(owner[:m][inside])
            mixed = (h[inside] + np.uint64(n)) * np.uint64(0x9E3779B97F4A7C15)
            feature.append((mixed >> np.uint64(48)).astype(np.int64) % FEATURES)
    return np.concatenate(whose), np.concatenate(feature)


def _train(batches: Iterator[pa.RecordBatch], langs: dict[str, int]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            by: dict[int, Counter] = {}
            for t, lang in zip(part.column("text").to_pylist(), part.column("lang").to_pylist()):
                by.setdefault(langs[lang], Counter()).update(_WORD.findall(t.lower()))
            for lang, words in by.items():
                if not words:
                    continue
                w, n = list(words), np.fromiter(words.values(), np.int64, len(words))
                whose, feature = grams(w)
                c = np.bincount(feature, weights=n[whose], minlength=FEATURES).astype(np.int64)
                s = np.bincount(script_of(w), weights=n * np.array([len(x) for x in w]), minlength=len(SCRIPT_NAMES)).astype(np.int64)
                f, k = np.flatnonzero(c), np.flatnonzero(s)
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array(np.full(len(f) + len(k), lang)),
                    "feature": pa.array(np.r_[f, -1 - k]),
                    "n": pa.array(np.r_[c[f], s[k]])})


class Model:
    """Log-probabilities [language, feature] and script candidates."""

    def __init__(self, langs: list[str], counts: np.ndarray, scripts: np.ndarray):
        self.langs = langs
        total = counts.sum(axis=1, keepdims=True) + SMOOTH * FEATURES
        self.logp = np.log((counts + SMOOTH) / total).astype(np.float32)
        self.may = scripts >= MIN_SCRIPT * np.maximum(scripts.sum(axis=1, keepdims=True), 1)

    def known(self, words: list[str]) -> np.ndarray:
        """Whether any language is a candidate for the word."""
        return self.may[:, script_of(words)].any(axis=0)

    def scores(self, words: list[str]) -> np.ndarray:
        """[word, language]: log-probability, 0 for words no language may have."""
        whose, feature = grams(words)
        out = np.empty((len(words), len(self.langs)), dtype=np.float32)
        for k in range(len(self.langs)):
            out[:, k] = np.bincount(whose, weights=self.logp[k][feature], minlength=len(words))
        may = self.may[:, script_of(words)].T
        some = may.any(axis=1)
        out -= out.max(axis=1, keepdims=True)
        out[~may] = -1e4
        out -= out.max(axis=1, keepdims=True)
        out[~some] = 0
        return out


def fit(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Model from the rows of ``docs`` (columns doc_id, text, lang) with a lang."""
    rows = docs.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    sizes = {r["lang"]: r["n"] for r in docs.where("lang is not null").groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = sorted(sizes)
    langs = {x: i for i, x in enumerate(names)}
    counts = np.zeros((len(names), FEATURES), dtype=np.int64)
    scripts = np.zeros((len(names), len(SCRIPT_NAMES)), dtype=np.int64)
    if names:
        share = F.create_map(*[F.lit(v) for x in names for v in (x, min(1.0, per_lang / sizes[x]))])
        u = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / F.lit(float(1 << 30))
        sample = rows.where(u < share[F.col("lang")]).select("text", "lang")
        got = (sample.mapInArrow(lambda b: _train(b, langs), "lang long, feature long, n long")
               .groupBy("lang", "feature").agg(F.sum("n").alias("n")))
        for lang, feature, n in got.toPandas().itertuples(index=False):
            if feature >= 0:
                counts[lang, feature] = n
            else:
                scripts[lang, -1 - feature] = n
    return Model(names, counts, scripts)


def viterbi(emit: np.ndarray, start: np.ndarray, length: np.ndarray, penalty: float) -> np.ndarray:
    """Best label of every row of ``emit`` [rows, labels], for the sequences
    start[i] .. start[i] + length[i] - 1 (none empty), all at once."""
    n, k = emit.shape
    order = np.argsort(-length, kind="stable")
    pos, size = start[order], length[order]
    live = np.searchsorted(-size, -np.arange(int(size[0]) + 1), side="left")  # sequences longer than t
    back = np.empty((n, k), dtype=np.int16)
    own = np.arange(k, dtype=np.int16)
    v = emit[pos].copy()
    for t in range(1, int(size[0])):
        a = live[t]
        at, x = pos[:a] + t, v[:a]
        best = x.argmax(axis=1)
        jump = x[np.arange(a), best][:, None] - penalty
        moved = jump > x
        back[at] = np.where(moved, best[:, None].astype(np.int16), own)
        v[:a] = np.where(moved, jump, x) + emit[at]
    path = np.empty(n, dtype=np.int64)
    now = v.argmax(axis=1)
    path[pos + size - 1] = now
    for t in range(int(size[0]) - 1, 0, -1):
        a = live[t]
        now[:a] = back[pos[:a] + t, now[:a]]
        path[pos[:a] + t - 1] = now[:a]
    return path


def _spans(text: str, labels: np.ndarray, langs: list[str]) -> list[dict]:
    cut = np.flatnonzero(np.diff(labels)) + 1
    at = [0]
    if len(cut):
        begin = [m.start() for m in _WORD.finditer(text)]
        at += [begin[i] for i in cut]
    ends = [*at[1:], len(text)]
    return [{"lang": langs[labels[i]], "start": a, "end": b} for i, a, b in zip([0, *cut.tolist()], at, ends)]


def label(texts: list[str | None], model: Model, penalty: float = SWITCH_PENALTY) -> list[tuple[str, float, list[dict]]]:
    """(language, score, spans) of each text."""
    out: list[tuple[str, float, list[dict]]] = [("und", 0.0, [])] * len(texts)
    if not model.langs:
        return out
    number: dict[str, int] = {}
    which, rows = [], []
    for i, t in enumerate(texts):
        if t and _LETTER.search(t):
            # one word for each match in the text as it stands, so that spans fit it
            w = [x.lower() for x in _WORD.findall(t)]
            rows.append(np.array([number.setdefault(x, len(number)) for x in w], dtype=np.int64))
            which.append(i)
    if not which:
        return out
    words = list(number)
    emit = model.scores(words)
    letters = np.array([len(w) for w in words])
    counted = letters * model.known(words)
    ids = np.concatenate(rows)
    length = np.array([len(r) for r in rows])
    start = np.cumsum(length) - length
    path = viterbi(emit[ids], start, length, penalty)
    k = len(model.langs)
    share = np.bincount(np.repeat(np.arange(len(rows)), length) * k + path, weights=counted[ids], minlength=len(rows) * k).reshape(-1, k)
    best = share.argmax(axis=1)
    total = np.add.reduceat(letters[ids], start)
    for j, i in enumerate(which):
        out[i] = (model.langs[best[j]], float(share[j, best[j]] / total[j]),
                  _spans(texts[i], path[start[j]:start[j] + length[j]], model.langs))
    return out


def identify(docs: DataFrame, model: Model, keep: list[str] | None = None, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """``docs`` with lang_pred, score and spans (language, first character,
    character after the last; together they cover the text)."""
    sent = Payload(docs.sparkSession, model)

    def make():
        m = sent.get()

        def fn(texts):
            got = label(texts, m, penalty)
            return [pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64()),
                    pa.array([g[2] for g in got], T_SPANS)]
        return fn

    return append_columns(docs, make, FIELDS, keep=keep)


T_SPANS = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
