"""Operators on document texts against brute force, with nulls, empty and very
long texts, ties and repeats, empty tables and clashing column names."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from conftest import SF001
from pyspark.sql import functions as F

from mercato.llm import bpe, common, ctw, decontamination, langid, minhash, packing, repair, simhash, tokencount

SCHEMA = "doc_id long, text string"
ODD = [(1, None), (2, ""), (3, " \n"), (4, "The the"), (5, "é Z zz"), (5, "é Z zz"), (None, "one two three four five six seven"),
       (7, "12!? 34 ▁ <|endoftext|> <s>"), (8, "word " * 60_000), (9, "x" * 30_000), (10, "a\tb\r\nc d　e")]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF001}/documents.parquet").where("doc_id < 80").cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# --- token ids, packing, counts ---------------------------------------------

@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(bpe.tokenizer_path())


def ids_of(tokenizer, text):
    return tokenizer.encode(text, add_special_tokens=False).ids if text else []


def test_encoder_equals_whole_texts(tokenizer, docs):
    with open(bpe.tokenizer_path()) as f:
        e = bpe.Encoder(f.read())
    texts = [t for _, t in ODD] + [t for _, t in pairs(docs)] + [
        "İstanbul ŉ x", "it's Don't WE'LL 12 3.5", "<|startoftext|>a <|endoftext|>", "a b", "é ́x", "Straße ÀÉ ½²",
        "日本語 text", "a\x1cb", "<|start", "x‍b", "Σας ΟΔΟΣ"]
    for t, got in zip(texts, e.encode(texts)):
        assert got.tolist() == ids_of(tokenizer, t)


def test_token_file(spark, odd, none, tokenizer, tmp_path):
    path = str(tmp_path / "file")
    repair.write(odd, path, end_id=2, shard_bytes=50_000, block_tokens=1000)
    rows = repair.read_documents(spark, path).collect()
    got = sorted((r["start"], r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in rows)
    order = sorted(pairs(odd), key=lambda p: (p[0] is not None, p[0] or 0, p[1] is not None, p[1] or ""))
    at = 0
    for (start, doc_id, n, crc), (want_id, text) in zip(got, order, strict=True):
        ids = np.array([*ids_of(tokenizer, text), 2], dtype="<u4")
        assert (start, doc_id, n, crc) == (at, want_id, len(ids), zlib.crc32(ids.tobytes()))
        at += n
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] for r in rows)
    assert repair.token_file(none).count() == 0


def test_repair_round_trip():
    rng = np.random.default_rng(0)
    for t in range(60):
        n, k = int(rng.integers(0, 3000)), int(rng.choice([1, 2, 5, 50, 1000]))
        x = rng.integers(0, k, size=n).astype("<u4")
        if t % 3 == 0 and n:
            x = np.tile(x[:max(1, n // 7)], 7)
        b = repair.encode_block(x)
        assert np.array_equal(repair.decode_block(b), x)
        a, c = sorted(rng.integers(0, len(x) + 1, size=2).tolist())
        assert np.array_equal(repair.decode_range(b, a, c), x[a:c])
        assert b["size"] <= len(x)
    b = repair.encode_block(np.tile(np.arange(64), 500))
    assert b["size"] < 500 * 64 / 10


def test_repair_leaves_no_frequent_pair():
    rng = np.random.default_rng(1)
    for x in (np.zeros(1 << 14, dtype="<u4"), np.tile(rng.integers(0, 50, size=3000), 40).astype("<u4"), rng.integers(0, 20, size=20_000).astype("<u4")):
        g = repair.compress(x)
        assert max(Counter(zip(g["seq"][:-1].tolist(), g["seq"][1:].tolist())).values(), default=0) < repair.MIN_COUNT
        assert np.array_equal(repair.decode_block(repair.encode_block(x)), x)


def check_plan(ranges, used, histogram, limit):
    bins, cover = defaultdict(list), defaultdict(list)
    for length, rank, n, first, each, off in ranges.tolist():
        cover[length].append((rank, n))
        for k in range(n):
            bins[first + k // each].append((off + k % each * length, length))
    for length, count in histogram.items():
        at = 0
        for rank, n in sorted(cover[length]):
            assert rank == at
            at += n
        assert at == count
    assert set(bins) == set(range(used))
    for places in bins.values():
        at = 0
        for off, length in sorted(places):
            assert off == at
            at += length
        assert at <= limit


def test_packing_plan():
    rng = np.random.default_rng(0)
    for t in range(25):
        limit = int(rng.choice([16, 64, 2048]))
        h = Counter()
        for n in rng.integers(1, limit + 1, size=rng.integers(0, 300)).tolist():
            h[n] += int(rng.integers(1, 5 if t % 2 else 40))
        small, groups = int(rng.choice([2, 3, 4, 8])), int(rng.choice([4, 32]))
        check_plan(*packing.grouped(h, limit, small, groups), h, limit)
    h = Counter(rng.integers(300, 900, size=20_000).tolist())
    ranges, used = packing.plan(h)
    check_plan(ranges, used, h, 2048)
    assert used <= 1.02 * -(-sum(a * b for a, b in h.items()) // 2048)  # best fit alone needs 3 % more


def test_pack(odd, none, tokenizer):
    rows = packing.pack(odd, limit=512).collect()
    seen = Counter()
    for doc_id, text in pairs(odd):
        ids = np.array([*ids_of(tokenizer, text), 0], dtype="<u4")
        for k, a in enumerate(range(0, len(ids), 512)):
            seen[doc_id, k, a, len(ids[a:a + 512]), zlib.crc32(ids[a:a + 512].tobytes())] += 1
    assert seen == Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows)
    by = defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for off, n in sorted(places):
            assert off == at
            at += n
        assert at <= 512
    assert packing.pack(none).count() == 0


def test_token_counts(spark, odd, docs, none):
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=tokencount.model_path())
    for df in (odd, docs.select("doc_id", "text")):
        got = tokencount.count_tokens(df.withColumn("n_tokens", F.lit("x")).withColumn("word", F.lit(1)), chunk_bytes=20_000).collect()
        want = [(d, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for d, t in pairs(df)]
        assert Counter((r["doc_id"], r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == Counter(want)
    assert tokencount.count_tokens(none).count() == 0


def test_pre_tokens_are_exact():
    import random

    random.seed(1)
    with open(tokencount.model_path(), "rb") as f:
        raw = f.read()
    tokencount.check_model(raw)
    counter = tokencount.Counter_(raw)
    parts = ["a", "b", " ", "  ", "\n", "▁", "the ", "é", "日", "\t", "<0x0A>", "ing", "<unk>", "</s>"]
    for _ in range(1500):
        t = "".join(random.choice(parts) for _ in range(random.randint(0, 12)))
        p = tokencount.pre_tokens(t)
        assert (int(counter.count(p).sum()) if p else 0) == len(counter.model.encode(t))


# --- fingerprints -----------------------------------------------------------

def shingle_set(text, k=5):
    w = text.encode().lower().split()
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def like(a, b):
    return len(a & b) / len(a | b) if a | b else 1.0


def test_minhash(spark, odd, docs, none):
    for df in (odd, docs.select("doc_id", "text")):
        rows = minhash.with_next(df, range_bytes=20_000).collect()
        order = sorted(pairs(df), key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
        texts = [t or "" for _, t in order]
        want, near = Counter(), {}
        for i, t in enumerate(texts):
            after = texts[(i + 1) % len(texts)]
            new = minhash.edited(t, after)
            assert len(new) == len(t) - len(t) // 2 + min(len(t) // 2, len(after))
            key = (order[i][0], len(t), hashlib.sha256(new.encode()).hexdigest())
            want[key] += 1
            near[key] = like(shingle_set(t), shingle_set(new)), like(shingle_set(t), shingle_set(after))
        got = [(r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in rows]
        assert Counter(got) == want
        off = [(r["near_edited"] - near[k][0], r["near_next"] - near[k][1]) for k, r in zip(got, rows)]
        assert np.abs(off).max() < 0.15 and np.sqrt(np.mean(np.square(off))) < 0.05
        for r in rows:
            (a, ha), (b, hb) = minhash.from_hex([r["fingerprint"]]), minhash.from_hex([r["edited_fingerprint"]])
            if ha[0] and hb[0]:
                assert minhash.likeness(a, b)[0] == pytest.approx(r["near_edited"])
    assert len({r["fingerprint"] for r in minhash.with_next(odd).where("doc_id = 5").collect()}) == 1
    assert minhash.with_next(none).count() == 0
    one = minhash.with_next(spark.createDataFrame([(1, "a b c d e f")], SCHEMA)).first()
    assert one["near_next"] == 1.0


def test_densification_fills_all_bins_and_is_unbiased():
    rng = np.random.default_rng(3)
    h = minhash.Hasher()
    off = []
    for _ in range(60):
        common_, a, b = (" ".join(f"w{x}" for x in rng.integers(0, 10 ** 9, size=n)) for n in rng.integers(6, 60, size=3))
        x, y = f"{common_} {a}", f"{common_} {b}"
        low, has = h.fingerprints([x, y])
        assert has.all()
        off.append(minhash.likeness(low[:1], low[1:])[0] - like(shingle_set(x), shingle_set(y)))
    assert abs(np.mean(off)) < 0.02


# --- SimHash ----------------------------------------------------------------

def components_of(values, bits=2):
    up = {v: v for v in values}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(values):
        for b in values[:i]:
            if bin((a ^ b) & (1 << 64) - 1).count("1") <= bits:
                x, y = find(a), find(b)
                up[max(x, y)] = min(x, y)
    return {v: find(v) for v in values}


def near_values(rng, n, centres, spread):
    base = rng.integers(0, 1 << 62, size=centres)
    out = set()
    while len(out) < n:
        x = int(rng.choice(base))
        for b in rng.integers(0, 62, size=rng.integers(0, spread)):
            x ^= 1 << int(b)
        out.add(x)
    return sorted(out)


def test_trie_join():
    rng = np.random.default_rng(1)
    for _ in range(15):
        v = near_values(rng, int(rng.integers(1, 200)), int(rng.integers(1, 5)), 5)
        u, r = simhash.trie_join(np.zeros(len(v), int), np.zeros(len(v), int), np.array(v, dtype=np.uint64))
        found = dict(zip(u.tolist(), r.tolist()))
        assert {x: found.get(x, x) for x in v} == components_of(v)


def test_links_split_hot_nodes(spark):
    from mercato.llm.components import components

    v = near_values(np.random.default_rng(3), 250, 1, 4)
    fps = spark.createDataFrame([(x,) for x in v], "fp long")
    want = components_of(v)
    for limit in (40, 10 ** 6):
        got = {r["u"]: r["root"] for r in components(simhash.links(fps, limit=limit)).collect()}
        assert {x: got.get(x, x) for x in v} == want


def test_near_duplicates(odd, docs, none):
    text = "one two three four five six seven eight nine ten " * 30
    near = [(100 + i, text + "tail " * (i % 2)) for i in range(6)]
    both = docs.select("doc_id", "text").unionByName(odd.where("doc_id is null or doc_id <> 8")).unionByName(odd.sparkSession.createDataFrame(near, SCHEMA))
    rows = simhash.near_duplicates(both.withColumn("root", F.lit("x")), keep=["doc_id", "text"]).collect()
    assert len(rows) == both.count()
    fps = sorted({simhash.fingerprint(t) for _, t in pairs(both)})
    root = components_of(fps)
    first = {}
    for d, t in pairs(both):
        c = root[simhash.fingerprint(t)]
        first[c] = min((x for x in (first.get(c), d) if x is not None), default=None)
    for r in rows:
        assert r["fp"] == simhash.fingerprint(r["text"]) and r["component_id"] == first[root[r["fp"]]]
    kept = simhash.dedup(both.withColumn("fp", F.lit("own"))).collect()
    assert len(kept) == len(set(root.values())) and kept[0].asDict().keys() == {"doc_id", "text", "fp"} and kept[0]["fp"] == "own"
    assert {r["doc_id"] for r in kept} == set(first.values())
    assert simhash.dedup(none).count() == 0


def test_fingerprint_bits():
    import xxhash

    for t in ("a b c d", "A b", "x", "a b c a b c a b c"):
        w = t.lower().split()
        grams = [" ".join(w[i:i + 3]) for i in range(len(w) - 2)] or [" ".join(w)]
        h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
        want = sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))
        assert simhash.fingerprint(t) & (1 << 64) - 1 == want
    assert simhash.fingerprint(None) == simhash.fingerprint(" ") == 0


# --- language model and language ---------------------------------------------

def brute_ctw(rows, held):
    d = ctw.DEPTH
    count = defaultdict(lambda: [0, 0])

    def events(text):
        s = ctw.stream(text)
        return [(s[i - d:i], s[i]) for i in range(d, len(s))]

    def bits(b):
        return [((1 << k) | (b >> (8 - k)), b >> (7 - k) & 1) for k in range(8)]

    for i, t in rows:
        if not held(i):
            for c, b in events(t):
                for place, bit in bits(b):
                    for k in range(d + 1):
                        count[place, c[d - k:]][bit] += 1
    below = defaultdict(list)
    for place, c in list(count):
        if c:
            below[place, c[1:]].append((place, c))
    memo = {}

    def kt(a, b):
        return math.lgamma(a + .5) + math.lgamma(b + .5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def weighted(node):
        if node not in memo:
            own = kt(*count[node])
            memo[node] = own if len(node[1]) == d else np.logaddexp(math.log(.5) + own, math.log(.5) + sum(map(weighted, below[node])))
        return memo[node]

    def predict(place, c, bit):
        p = None
        for k in range(d, -1, -1):
            node = place, c[d - k:]
            n = count[node] if node in count else [0, 0]
            own = (n[bit] + .5) / (sum(n) + 1)
            share = .5 if node not in count else math.exp(math.log(.5) + kt(*n) - weighted(node))
            p = own if p is None else share * own + (1 - share) * p
        return p

    return {i: sum(math.log10(predict(place, c, bit)) for c, b in events(t) for place, bit in bits(b)) for i, t in rows}


def test_context_tree_weighting(docs, odd, none):
    df = docs.select("doc_id", "text").where("doc_id < 30 and length(text) < 700").unionByName(
        odd.where("doc_id in (1, 2, 4, 5) or doc_id is null").withColumn("doc_id", F.col("doc_id") + 1000))
    rows = pairs(df)
    got = ctw.score(df, ctw.held_out_rule(F.col("doc_id")), chunk_bytes=3000).collect()
    assert len(got) == len(rows)

    def held(i):
        return zlib.crc32(b"" if i is None else str(i).encode()) % 10 == 0

    want = brute_ctw(rows, held)
    train = Counter()
    for i, t in rows:
        if not held(i):
            train.update([*(t or "").encode().lower().split(), "end"])
    n, v = sum(train.values()), len(train)
    texts = dict(rows)
    for r in got:
        tokens = [*(texts[r["doc_id"]] or "").encode().lower().split(), "end"]
        assert r["score"] == pytest.approx(want[r["doc_id"]], rel=1e-5, abs=1e-4)
        assert r["base_score"] == pytest.approx(sum(math.log10((train[x] + .1) / (n + .1 * (v + 1))) for x in tokens))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held(r["doc_id"]), len(tokens), sum(train[x] > 0 for x in tokens), n)
    assert ctw.score(none, F.lit(False)).count() == 0
    untrained = ctw.score(odd.where("doc_id = 4"), F.lit(True)).first()
    assert untrained["train_tokens"] == 0 and untrained["base_score"] == 0
    assert untrained["score"] == pytest.approx(-9 * 8 * math.log10(2), rel=1e-5)


def test_ctw_bucket_memory_and_steps():
    """Whatever the step, the same predictions; a gram takes a few times its
    predictions (over 1,000 bytes a gram before)."""
    import tracemalloc

    rng = np.random.default_rng(3)
    found = ctw.Sums(at_once=1000)
    for _ in range(100):
        found.add(*ctw.counted(rng.integers(0, 1 << 48, 4000, dtype=np.uint64) & np.uint64(0x0101070707FF)))
    keys, n = found.get()
    assert (np.diff(keys) > 0).all() and n.sum() == 400_000 and len(keys) > 90_000
    p, sums = ctw.subtrees(keys, n, step=len(keys))
    tracemalloc.start()
    try:
        p2, sums2 = ctw.subtrees(keys, n, step=5000)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert (p == p2).all() and (sums == sums2).all()
    assert peak < 400 * len(keys)


def test_ctw_is_a_probability():
    """The predictions of all bytes after a context sum to 1."""
    s = ctw.stream("the cat and the hat and the bat " * 20)
    keys, n = ctw.counted(np.concatenate([k for k, _ in ctw.windows(s)]))
    context = keys[len(keys) // 2] >> np.uint64(8)
    every = (context << np.uint64(8)) | np.arange(256, dtype=np.uint64)
    allkeys, counts = ctw.summed(np.concatenate([keys, every]), np.concatenate([n, np.zeros(256, np.int64)]))
    p, sums = ctw.subtrees(allkeys, counts)
    where, to = np.unique(sums[:, 0].astype(np.int64), return_inverse=True)
    top = ctw.Top(where, *(np.bincount(to, weights=sums[:, i]) for i in (1, 2, 3)))
    logs = top.log10(allkeys, p)
    assert np.power(10, logs[np.searchsorted(allkeys, every)]).sum() == pytest.approx(1)


def test_language(docs, odd, none):
    import itertools

    rng = np.random.default_rng(5)
    length = rng.integers(1, 8, size=6)
    start = np.cumsum(length) - length
    emit = rng.normal(size=(length.sum(), 3)).astype(np.float32) * 3
    path = langid.viterbi(emit, start, length, 2.0)
    for s, n in zip(start, length):
        best = max(itertools.product(range(3), repeat=int(n)),
                   key=lambda q: sum(emit[s + i, q[i]] for i in range(n)) - 2 * sum(q[i] != q[i - 1] for i in range(1, n)))
        assert path[s:s + n].tolist() == list(best)
    whole = docs.sparkSession.read.parquet(f"{SF001}/documents.parquet")
    rule = common.crc32_of_id(F.col("doc_id")) % 5 == 0
    model = langid.fit(whole.where(~rule))
    got = langid.identify(whole.where(rule), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in got]) > 0.95
    for r in got:
        assert r["spans"][0]["start"] == 0 and r["spans"][-1]["end"] == len(r["text"]) and 0 < r["score"] <= 1
    de, en = (whole.where(f"lang = '{x}' and n_chars > 600").orderBy("doc_id").first()["text"][:500] for x in ("de", "en"))
    mixed = langid.label([de + "\n" + en], model)[0]
    assert [s["lang"] for s in mixed[2]] == ["de", "en"] and abs(mixed[2][1]["start"] - len(de)) < 40
    by = {r["doc_id"]: r for r in langid.identify(odd.withColumn("score", F.lit("x")), model).collect()}
    assert by[1]["lang_pred"] == by[2]["lang_pred"] == by[3]["lang_pred"] == "und" and by[1]["score"] == 0
    assert langid.label(["12 34"], model)[0][0] == "und" and langid.label(["日本"], model)[0][0] != "und"
    assert langid.identify(none, model).count() == 0
    empty = langid.fit(none.withColumn("lang", F.lit(None).cast("string")))
    assert {r["lang_pred"] for r in langid.identify(odd, empty).collect()} == {"und"}


def test_letters_of_unlearned_scripts_count_for_no_language(docs):
    model = langid.fit(docs.sparkSession.read.parquet(f"{SF001}/documents.parquet"))
    en = "the house and the garden of the old man "
    n, m = len(en.replace(" ", "")), len("日本語")
    cases = ["日本語 日本語", "ไทย", en, en + "日本語 " * n, "日本語 " * 3 + en * 20]
    assert model.known(["日本語", "ไทย", "the"]).tolist() == [False, False, True]
    got = langid.label(cases, model)
    assert [g[0] for g in got[2:]] == ["en"] * 3 and all(g[0] in model.langs for g in got)
    assert [g[1] for g in got] == pytest.approx([0, 0, 1, n / (n + m * n), 20 * n / (20 * n + 3 * m)])


# --- decontamination ----------------------------------------------------------

def test_decontamination(spark, docs, odd, none):
    w = [f"w{i}" for i in range(40)]
    items = [(1, " ".join(w[:20])), (2, "Short, item!"), (3, None), (None, "q r s"), (4, "a a a a a a a a a a a a a a"), (2, "Short item"), (5, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    texts = ["x " * 30 + " ".join(w[3:18]) + " y" * 50, " ".join(w[:12]), "SHORT-item short", "a " * 40, "b " + "a " * 13 + "b", None, "", "q r s",
             " ".join(w[:20]) * 300, "z " * 9000 + " ".join(w[5:18])]
    df = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    clean = [(str(i), t) for i, t in items if i is not None and t is not None]
    want = {i: x for i, x in enumerate(decontamination.brute_force(texts, clean))}
    for block in (1 << 20, 8):
        for r in decontamination.decontaminate(df.withColumn("items", F.lit(0)), bench, block_bytes=block).collect():
            n, hit, found = want[r["doc_id"]]
            assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, found)
            assert r["contaminated"] == (hit > 0 and 20 * hit >= n)
    sample = [(d, t) for d, t in pairs(docs)]
    real = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    got = {r["doc_id"]: r for r in decontamination.decontaminate(docs, spark.read.parquet(f"{SF001}/benchmark.parquet")).collect()}
    for (d, _), (n, hit, found) in zip(sample, decontamination.brute_force([t for _, t in sample], real)):
        assert (got[d]["n_words"], got[d]["n_hit"], got[d]["items"]) == (n, hit, found)
    assert decontamination.decontaminate(odd, bench.limit(0)).where("n_hit > 0").count() == 0
    assert decontamination.decontaminate(none, bench).count() == 0
