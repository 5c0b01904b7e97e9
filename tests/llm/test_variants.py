"""Spelling variants: the gram bounds and the whole query against plain Python."""

import random
import zlib
from collections import Counter

import pytest
from conftest import SF001

from mercato.llm import variants as v


def words_of(seed, n, letters="abé", low=5, high=9):
    rng = random.Random(seed)
    return sorted({"".join(rng.choice(letters) for _ in range(rng.randrange(low, high + 1))) for _ in range(n)})


def frequent(words, least, qmax=v.QMAX):
    counts = Counter(s[p:p + q] for w in words for s in [v.marked(w)] for q in range(2, qmax + 1) for p in range(len(s) - q + 1))
    return {g: n for g, n in counts.items() if n >= least}


def edits(word, letters="abéz"):
    """(edited word, place, characters taken out, characters put in)"""
    for i in range(len(word) + 1):
        for c in letters:
            yield word[:i] + c + word[i:], i, 0, 1
            if i < len(word) and c != word[i]:
                yield word[:i] + c + word[i + 1:], i, 1, 1
        if i < len(word):
            yield word[:i] + word[i + 1:], i, 1, 0


@pytest.mark.parametrize("least", [1, 5, 40, 10**6])
def test_no_edit_takes_more_grams_than_the_bound(least):
    words = words_of(1, 120)
    d = v.Dictionary(frequent(words, least))
    for word in words:
        s = v.marked(word)
        cut = d.decompose(s)
        bound = d.affected(s, cut)
        for other, i, out, put in edits(word):
            t, at = v.marked(other), i + 1
            have = {(p, t[p:e]) for p, e in d.decompose(t)}
            # grams before the place stay where they are, grams behind it move
            kept = sum((p, s[p:e]) in have if e <= at else p >= at + out and (p + put - out, s[p:e]) in have for p, e in cut)
            assert len(cut) - kept <= bound, (word, other, cut, bound)


def test_decomposition_takes_the_longest_and_leaves_out_what_lies_within():
    d = v.Dictionary({"ab": 9, "abc": 5, "bc": 7, "abcd": 2}, 4)
    assert [("^abcdx$"[p:e]) for p, e in d.decompose("^abcdx$")] == ["^a", "abcd", "dx", "x$"]
    assert d.listed["ab"] == 4 and d.listed["abc"] == 3


def near(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@pytest.mark.parametrize("qmax,grams", [(4, 50_000), (4, 30), (3, 3), (6, 200)])
def test_all_near_pairs_are_found(spark, qmax, grams):
    words = words_of(2, 250) + words_of(3, 150, "abcdefghij", 5, 14) + ["x" * 3000, "x" * 2999, "x" * 1500 + "y" + "x" * 1499]
    words = sorted(set(words))
    df = spark.createDataFrame([(w, 3 + i) for i, w in enumerate(words)], "word string, n long")
    got = v.near_pairs(df, qmax, grams).collect()
    found = [tuple(sorted((r["a"], r["b"]))) for r in got]
    assert len(found) == len(set(found))
    assert set(found) == {(a, b) for i, a in enumerate(words) for b in words[i + 1:] if near(a, b)}


def plain(docs):
    counts = Counter()
    for doc, text in docs:
        for run in v.RUN.findall(text or ""):
            run = run.translate(v.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    out = {}
    for w, n in words.items():
        by = sorted((-m, o) for o, m in words.items() if near(w, o))
        form = by[0][1] if by and -by[0][0] >= 2 * n else None
        out[w] = [form, None, n, len(by), words[form] if form else None]
    for w, row in out.items():
        at = w
        while out[at][0]:
            at = out[at][0]
        row[1] = at
    return {w: tuple(r) for w, r in out.items()}


def check(df, docs):
    got = df.collect()
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    assert {r["word"]: tuple(r)[1:] for r in got} == plain(docs) and len(got) == len({r["word"] for r in got})


def test_documents_with_odd_rows(spark):
    rng = random.Random(4)
    base = words_of(5, 12, "abcdeÀÿ×")
    text = lambda: " ".join(rng.choice(list(edits(w := rng.choice(base))))[0] if rng.random() < .3 else rng.choice(base)
                            for _ in range(80))
    docs = [(i, text()) for i in range(60)] + [(None, text()), (None, None), (61, None), (62, ""), (63, "ABCDEFGH" * 40_000), (63, "1-2")]
    docs += docs[:15]
    rows = [(d, t, "x", 1) for d, t in docs]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int").repartition(4)
    check(v.variants(v.word_counts(df)), docs)


def test_empty_table_and_no_words(spark):
    for rows in ([], [(1, "a b c")]):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        assert v.variants(v.word_counts(df)).collect() == []


def test_query_on_the_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text").collect()]
    from mercato.llm import catalog

    got = catalog.queries()["op12_gram_index_variants"](spark, SF001).collect()
    want = plain_by_index(docs)
    assert {r["word"]: tuple(r)[1:] for r in got} == want


def plain_by_index(docs):
    """``plain`` with candidate pairs from words with one code point left out."""
    counts = Counter()
    for doc, text in docs:
        for run in v.RUN.findall(text or ""):
            run = run.translate(v.LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 97 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    cut = {}
    for w in words:
        for i in range(len(w)):
            cut.setdefault((i, w[:i] + w[i + 1:]), set()).add(w)
    links = {w: set() for w in words}
    for (_, rest), group in cut.items():
        for w in group:
            links[w] |= group - {w}
            if rest in words:
                links[w].add(rest)
                links[rest].add(w)
    out = {}
    for w, n in words.items():
        by = sorted((-words[o], o) for o in links[w])
        form = by[0][1] if by and -by[0][0] >= 2 * n else None
        out[w] = [form, None, n, len(by), words[form] if form else None]
    for w, row in out.items():
        at = w
        while out[at][0]:
            at = out[at][0]
        row[1] = at
    return {w: tuple(r) for w, r in out.items()}
