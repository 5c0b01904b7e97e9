"""Spelling variants by a variable-length gram index.

Two words are near if one inserted, deleted or replaced code point makes one
of the other; a word's form is its near word of largest count, if that is at
least twice its own, and its root is the end of the chain of forms.

Near words are found by grams of two to ``QMAX`` code points (words get a mark
at each end, so grams know where a word begins and ends):

* **Dictionary.**  Grams are counted over the distinct words and those of a
  length that are not at least one in ``GRAMS`` of all are pruned, so a gram is
  longer where its beginning is common; two code points are always a gram.
* **Decomposition.**  The longest dictionary gram at each position; one that lies
  within an earlier one is left out.
* **Affected grams.**  For each word, the most grams that one edit can take away:
  those over the edited place, those before it whose beginning some dictionary
  gram continues over it, and those behind it that a gram from before could
  swallow.  (Both are runs next to the place, so they are counted by bisection.)
* **Lists.**  All grams but the affected ones stay, at the same place before the
  edit and moved by the difference in length behind it.  So, in one order of all
  grams (rarest first), near words share one of their first ``affected + 1``
  grams; only these are listed, under (gram, place, length of the word), and a
  list meets exactly three others: same place and length, or one code point
  longer with the same place or one on.
* **Verification.**  The merge's join condition is the edit distance itself, so no
  pair leaves a list that is not near.  Words that one edit could rob of all
  grams are listed a second time by grams of two alone, where at most two are
  affected, and meet each other there.

Scale.  Words are counted in the tasks before the shuffle.  Lists are an equi-join:
places, lengths and the rarest-first order keep them short, sort-merge buffers
spill and AQE splits skewed ones.  The broadcast dictionary has at most
``GRAMS`` entries a gram length.  Roots are found by doubling; counts double
along a chain, so it takes few rounds, each written.

Defined cases.  A null text has no words, a null doc_id counts as the empty
text.  Repeated rows count each.  Equal counts go to the smaller word in
code-point order.  An empty table gives no rows.  Words and texts may be of any
length; other columns are not read."""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.llm.common import Payload, slices, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
#: A run is damaged if this divides its crc32.
DAMAGED = 97
LEAST_LENGTH, LEAST_COUNT = 5, 3

#: Longest gram; a gram of more than two code points is in the dictionary if it
#: is at least one in GRAMS of all grams of its length.
QMAX = 4
GRAMS = 50_000
#: Entries of a task's counter before it hands them on.
HELD = 400_000

_COUNTED = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])


def _counted(counter: Counter) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(counter.keys(), pa.string()), pa.array(counter.values(), pa.int64())],
                                      names=_COUNTED.names)


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("word").agg(F.sum("n").alias("n"))


def damaged(run: str, prefix_crc: int) -> str:
    """A run without one code point, if the crc32 of document and run says so."""
    h = zlib.crc32(run.encode(), prefix_crc)
    if h % DAMAGED:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def word_counts(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT) -> DataFrame:
    """(word, n) of the words of (doc_id, text)."""
    src = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for part in slices(batch, "text"):
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    own = zlib.crc32(f"{doc}:".encode())
                    runs = Counter(m.group() for m in RUN.finditer(text)) if len(text) > 1 << 20 else Counter(RUN.findall(text))
                    for word, n in runs.items():
                        if len(word) < least_length:
                            continue  # damage only shortens
                        if not word.islower():
                            word = word.lower() if word.isascii() else word.translate(LOWER)
                        word = damaged(word, own)
                        if len(word) >= least_length:
                            held[word] += n
                    if len(held) > HELD:
                        yield _counted(held)
                        held.clear()
        if held:
            yield _counted(held)

    return written(_summed(src.mapInArrow(run, _COUNTED)).where(F.col("n") >= least_count), "words")


class Dictionary:
    """Variable-length grams: ``counts`` has the frequent grams of 2 to ``qmax``
    code points."""

    def __init__(self, counts: dict[str, int], qmax: int = QMAX):
        self.qmax = qmax
        self.long = {g for g in counts if len(g) > 2}
        self.begins = {g[:k] for g in self.long for k in range(2, len(g))}
        self.inner = {g[a:b] for g in self.long for a in range(1, len(g) - 1) for b in range(a + 2, len(g) + 1)}
        #: Occurrences under a gram itself: those that no longer gram continues.
        self.listed = Counter(counts)
        for g in self.long:
            self.listed[g[:-1]] -= counts[g]

    def decompose(self, s: str) -> list[tuple[int, int]]:
        """(start, end) of a marked word's grams; both ascend."""
        out, reached = [], 0
        for p in range(len(s) - 1):
            end = p + 2
            for q in range(min(self.qmax, len(s) - p), 2, -1):
                if s[p:p + q] in self.long:
                    end = p + q
                    break
            if end > reached:
                out.append((p, end))
                reached = end
        return out

    def affected(self, s: str, grams: list[tuple[int, int]]) -> int:
        """The most grams of a marked word that one edit between its marks can
        take away (never less than it does)."""
        starts, ends = [p for p, _ in grams], [e for _, e in grams]
        last, most = len(s) - 1, 0
        first = [0] * (last + 1)  # the first gram that an edit at or before i can reach from the left
        after = [0] * (last + 1)  # the grams that a gram from before i could swallow end here at most
        for i in range(1, last + 1):
            at = i
            for p in range(max(0, i - self.qmax + 1), i - 1):
                if s[p:i] in self.begins:
                    at = p
                    break
            # grams that end behind i, or start where a beginning of i is continued
            first[i] = min(bisect_right(ends, i), bisect_left(starts, at))
            reach = i
            for e in range(i + 2, min(len(s), i + self.qmax - 1) + 1):
                if s[i:e] not in self.inner:
                    break
                reach = e
            after[i] = reach
        for i in range(1, last + 1):
            # an insert before i: grams that start before i, or end within reach of i
            most = max(most, max(bisect_left(starts, i), bisect_right(ends, after[i])) - first[i])
            if i < last:  # code point i replaced or deleted
                most = max(most, max(bisect_right(starts, i), bisect_right(ends, after[i + 1])) - first[i])
        return most


def marked(word: str) -> str:
    return f"^{word}$"


def postings(word: str, grams: Dictionary, pairs: Dictionary) -> list[tuple[int, int]]:
    """(gram, place) under which a word is listed; the gram is a number of 30
    bits, plus one bit for the second listing.  (Grams that share a number by
    chance cost a comparison; the join condition decides.)"""
    s = marked(word)

    def listed(of: Dictionary, second: int) -> tuple[list, bool]:
        cut = of.decompose(s)
        n = of.affected(s, cut)
        ranked = sorted(cut, key=lambda g: (of.listed[s[g[0]:g[1]]], s[g[0]:g[1]], g[0]))[:n + 1]
        return [(second << 30 | zlib.crc32(s[p:e].encode()) & 0x3FFFFFFF, p) for p, e in ranked], n >= len(cut)

    out, bare = listed(grams, 0)
    return out + listed(pairs, 1)[0] if bare else out


def gram_counts(words: DataFrame, qmax: int = QMAX, grams: int = GRAMS) -> dict[str, int]:
    """Occurrences of the grams of 2 to ``qmax`` code points that are at least
    one in ``grams`` of all of their length: at most ``grams`` a length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()
        for batch in batches:
            for word in batch.column("word").to_pylist():
                s = marked(word)
                for q in range(2, qmax + 1):
                    held.update(s[p:p + q] for p in range(len(s) - q + 1))
                if len(held) > HELD:
                    yield _counted(held)
                    held.clear()
        if held:
            yield _counted(held)

    size = F.length("word") + 2
    totals = words.agg(*[F.sum(F.greatest(size - q + 1, F.lit(0)).cast("long")) for q in range(2, qmax + 1)]).first()
    least = F.lit(None).cast("long")
    for q, total in zip(range(2, qmax + 1), totals):
        least = F.when(F.length("word") == q, -(-(total or 0) // grams)).otherwise(least)
    counts = _summed(words.select("word").mapInArrow(run, _COUNTED))
    return {r["word"]: r["n"] for r in counts.where(F.col("n") >= least).collect()}


def near_pairs(words: DataFrame, qmax: int = QMAX, grams: int = GRAMS) -> DataFrame:
    """(a, an, b, bn): every pair of near words of (word, n), once."""
    spark = words.sparkSession
    sent = Payload(spark, gram_counts(words, qmax, grams))
    schema = T.StructType([*_COUNTED, T.StructField("gram", T.LongType()), T.StructField("place", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = sent.get()
        dictionary = Dictionary(counts, qmax)
        pairs = Dictionary({g: n for g, n in counts.items() if len(g) == 2}, 2)
        for batch in batches:
            at, keys = [], [(0, 0)]
            for i, word in enumerate(batch.column("word").to_pylist()):
                own = postings(word, dictionary, pairs)
                at += [i] * len(own)
                keys += own
            take = pa.array(at, pa.int32())
            gram, place = (pa.array(c[1:], pa.int64()) for c in zip(*keys))
            yield pa.RecordBatch.from_arrays([batch.column("word").take(take), batch.column("n").take(take), gram, place],
                                             names=schema.names)

    # words are few bytes and much work a row: enough tasks for all cores
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    lists = written(words.select("word", "n").repartition(parts).mapInArrow(run, schema), "postings")
    size = F.length("word").cast("long")
    # one edit leaves one half of the shorter word as it is: hashes of the
    # halves spare most comparisons of whole words
    halves = lambda n: [F.hash(F.expr(f"left(word, ({n}) div 2)")), F.hash(F.expr(f"right(word, ({n}) - ({n}) div 2)"))]
    own, less = halves("length(word)"), halves("length(word) - 1")
    met = [F.struct((F.col("place") + moved).alias("place"), (size + longer).alias("size"), F.lit(bool(longer)).alias("longer"))
           for moved, longer in ((0, 0), (0, 1), (1, 1))]
    probes = (lists.select(F.col("word").alias("a"), F.col("n").alias("an"), "gram", own[0].alias("a1"), own[1].alias("a2"),
                           F.explode(F.array(*met)).alias("at"))
              .select("a", "an", "gram", "a1", "a2", "at.*"))
    listed = lists.select(F.col("word").alias("b"), F.col("n").alias("bn"), F.col("gram").alias("bgram"),
                          F.col("place").alias("bplace"), size.alias("bsize"), own[0].alias("b1"), own[1].alias("b2"),
                          less[0].alias("c1"), less[1].alias("c2"))
    near = F.expr("gram = bgram AND place = bplace AND size = bsize AND if(longer, a1 = c1 OR a2 = c2, (a1 = b1 OR a2 = b2) AND a < b)"
                  " AND levenshtein(a, b, 1) = 1")
    return probes.join(listed, near).select("a", "an", "b", "bn").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) for words (word, form) that have one, by doubling."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        step = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if now.join(step, "root", "left_semi").isEmpty():
            return now
        now = written(now.join(step, "root", "left").select("word", F.coalesce("further", "root").alias("root")), "roots")


def variants(words: DataFrame, qmax: int = QMAX, grams: int = GRAMS) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for distinct words (word, n)."""
    pairs = near_pairs(words, qmax, grams)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("bn").alias("m"), F.col("b").alias("other")),
        F.struct(F.col("b").alias("word"), F.col("an").alias("m"), F.col("a").alias("other")))).alias("x")).select("x.*")
    best = both.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                    F.min(F.struct((-F.col("m")).alias("less"), "other")).alias("best"))
    named = F.when(-F.col("best.less") >= 2 * F.col("n"), F.col("best"))
    found = written(words.select("word", "n").join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), named["other"].alias("form"),
        (-named["less"]).alias("form_n")), "forms")
    roots = _roots(found.where("form is not null"))
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
