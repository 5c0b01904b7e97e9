"""The pipeline: its stages' decisions against plain Python, its contract,
and the registered queries over a whole table."""

import re
from collections import Counter

import corpus_pipeline
import pytest
from conftest import SF001
from pyspark.sql import functions as F

import __spark_entry__ as entry
from mercato.llm import common, decontamination, simhash


@pytest.fixture(scope="module")
def stages(spark):
    """What each stage got and made; odd rows join the documents."""
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    bench = spark.read.parquet(f"{SF001}/benchmark.parquet").first()["text"]
    first = base.orderBy("doc_id").first()["text"]
    odd = [(None, None, None, None, None), (9001, "", "en", "s", 0), (9002, "12 34 !!", None, None, 8), (9003, first, "en", None, 5),
           (9003, first, "en", None, 5), (9004, bench, "en", "s", 10), (9005, "the and of " * 30_000, "en", "s", 1)]
    docs = base.unionByName(spark.createDataFrame(odd, base.schema)).withColumn("score", F.lit("own")).withColumn("n_values", F.lit(7))
    out, now = [], docs
    for name, stage in corpus_pipeline.STAGES:
        made = common.written(stage(spark, now, SF001), name)
        out.append((name, now, made))
        now = made
    return out


def rows(df):
    return [r.asDict() for r in df.collect()]


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["language", "near_duplicates", "decontamination", "personal_data", "packing"]
    for _, before, after in stages[:-1]:
        assert after.columns == before.columns
        assert {r["score"] for r in rows(after)} == {"own"} and {r["n_values"] for r in rows(after)} == {7}


def test_language_drops_only_texts_without_one(stages):
    before, after = rows(stages[0][1]), rows(stages[0][2])
    kept = {r["doc_id"] for r in after}
    assert not {None, 9001, 9002} & kept
    gone = [r for r in before if r["doc_id"] not in kept and r["text"] and re.search(r"[^\W\d_]{3}", r["text"])]
    assert not gone


def test_language_drops_texts_mostly_in_a_script_not_learned(spark):
    base = spark.read.parquet(f"{SF001}/documents.parquet")
    en = "the house and the garden of the old man "
    new = [(9101, "日本語 日本語"), (9102, en + "日本語 " * 30), (9103, en * 20 + "日本語")]
    docs = base.unionByName(spark.createDataFrame([(i, t, None, "s", len(t)) for i, t in new], base.schema))
    kept = {r["doc_id"] for r in corpus_pipeline.language(spark, docs, SF001).where("doc_id > 9100").collect()}
    assert kept == {9103}


def test_one_document_of_each_component_stays(stages):
    before, after = rows(stages[1][1]), rows(stages[1][2])
    fps = [simhash.fingerprint(r["text"]) for r in before]
    root = list(range(len(before)))
    for i, a in enumerate(fps):
        for j in range(i):
            if bin((a ^ fps[j]) & (1 << 64) - 1).count("1") <= 2:
                x, y = root[i], root[j]
                root = [y if r == x else r for r in root]
    groups = {}
    for r, k in zip(before, root):
        groups.setdefault(k, []).append(r["doc_id"])
    assert Counter(r["doc_id"] for r in after) == Counter(min(g) for g in groups.values())
    assert len(after) < len(before)


def test_contaminated_documents_go(spark, stages):
    before, after = rows(stages[2][1]), rows(stages[2][2])
    items = [(str(r["item_id"]), r["text"]) for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    found = decontamination.brute_force([r["text"] if len(r["text"]) < 20_000 else r["text"][:2000] for r in before], items)
    want = Counter(r["doc_id"] for r, (n, hit, _) in zip(before, found) if not (hit and 20 * hit >= n))
    assert Counter(r["doc_id"] for r in after) == want and 9004 not in want


def test_contaminated_documents_go_by_their_whole_texts(spark, stages):
    texts = [r["text"] for r in spark.read.parquet(f"{SF001}/benchmark.parquet").collect()]
    windows = set()
    for w in map(decontamination.words, texts):
        n = min(13, len(w))
        windows |= {tuple(w[i:i + n]) for i in range(len(w) - n + 1 if n else 0)}
    sizes = {len(x) for x in windows}

    def stays(text):
        w, hit = decontamination.words(text), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
        return not hit or 20 * len(hit) < len(w)

    before, after = rows(stages[2][1]), rows(stages[2][2])
    assert Counter(r["doc_id"] for r in after) == Counter(r["doc_id"] for r in before if stays(r["text"]))
    passage = next(t for t in texts if len(decontamination.words(t)) >= 13)
    far = "z " * 10_000
    long = [far + passage * 200, far * 20 + passage, passage + far * 20]
    docs = spark.createDataFrame([(9201 + i, t, "en", "s", len(t)) for i, t in enumerate(long)], stages[2][1].select(
        "doc_id", "text", "lang", "source", "n_chars").schema)
    kept = {r["doc_id"] for r in corpus_pipeline.decontaminate(spark, docs, SF001).collect()}
    assert kept == {9201 + i for i, t in enumerate(long) if stays(t)} == {9202, 9203}


def test_personal_data_goes_and_lengths_follow(stages):
    before = {r["doc_id"]: r for r in rows(stages[3][1])}
    after = {r["doc_id"]: r for r in rows(stages[3][2])}
    assert before.keys() == after.keys()
    changed = [k for k in after if after[k]["text"] != before[k]["text"]]
    assert changed and all(after[k]["n_chars"] == len(after[k]["text"]) for k in changed)
    assert all(after[k] == before[k] for k in after if k not in changed)
    for k in after:
        assert not set(re.findall(r"\S+@\S+\.com|\+1 \(\d{3}\) 555-\d{4}", before[k]["text"])) & set(
            re.findall(r"\S+@\S+\.com|\+1 \(\d{3}\) 555-\d{4}", after[k]["text"]))


def test_packing_holds_every_document(stages):
    before, after = rows(stages[4][1]), rows(stages[4][2])
    assert {r["doc_id"] for r in after} == {r["doc_id"] for r in before}
    use = Counter()
    for r in after:
        use[r["sequence_id"]] += r["length"]
    assert max(use.values()) <= 2048


def test_run_and_registration(spark):
    queries = entry.queries()
    names = [n for n in queries if re.match(r"op\d+_", n)]
    assert sorted(int(re.match(r"op(\d+)", n).group(1)) for n in names) == list(range(1, 14))
    assert queries["pipeline"](spark, SF001).count() > 100
    empty = spark.read.parquet(f"{SF001}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF001)
        assert empty.count() == 0


@pytest.mark.parametrize("name,columns", [
    ("op1_repair_token_file", ["doc_id", "start", "n_tokens", "ids_crc32"]),
    ("op2_one_permutation_minhash", ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]),
    ("op3_context_tree_weighting", ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]),
    ("op4_script_viterbi_langid", ["doc_id", "held_out", "lang_pred", "score"]),
    ("op5_wu_manber_decontamination", ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]),
    ("op6_feistel_pseudonyms", ["doc_id", "text", "n_values"]),
    ("op7_linear_grouping_packing", ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]),
    ("op8_simhash_trie_join", ["doc_id", "fingerprint", "component_id"]),
    ("op9_pretoken_counts", ["doc_id", "n_bytes", "n_tokens", "over_limit"]),
])
def test_queries_return_every_document(spark, name, columns):
    df = entry.queries()[name](spark, SF001)
    assert df.columns[:len(columns)] == columns
    ids = {r["doc_id"] for r in df.select("doc_id").collect()}
    assert ids == {r["doc_id"] for r in spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id").collect()}
