"""Pair operators, search, repeats and the pipeline against brute force."""

import re
import sys

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from platewise.llm import jaccard, neardup, substrings, topk

WORDS = [f"w{i}" for i in range(400)]


def _components(ids, links):
    low = {i: i for i in ids}
    while True:
        new = {i: min([low[i]] + [low[j] for j in links.get(i, ())]) for i in ids}
        if new == low:
            return low
        low = new


def _texts(seed, n):
    rng = np.random.default_rng(seed)
    base = [list(rng.choice(WORDS, rng.integers(1, 80))) for _ in range(n // 3)]
    common = list(rng.choice(WORDS, 20))
    out = {}
    for i in range(n):
        words = list(base[rng.integers(len(base))]) if i % 3 else list(base[0]) + common[:i % 5]
        for _ in range(rng.integers(0, 3)):
            words[rng.integers(len(words))] = str(rng.choice(WORDS))
        if i % 4 == 0:
            words += common
        out[i] = " ".join(words)
    out.update({n: None, n + 1: "", n + 2: " \t\n", n + 3: "two words", n + 4: "TWO\u000bwords", n + 5: "long " * 3000})
    return out


def _frame(spark, texts):
    return spark.createDataFrame([(i, t, "clash", 1) for i, t in texts.items()], "doc_id long, text string, node string, n long")


@pytest.mark.parametrize("k,percent", [(3, 90), (5, 80)])
def test_jaccard_classes_equal_brute_force(spark, monkeypatch, k, percent):
    monkeypatch.setattr(jaccard, "HEAVY", 4)
    monkeypatch.setattr(jaccard, "LEAF", 3)
    monkeypatch.setattr(jaccard, "FIRST", k)
    texts = _texts(k, 90)

    def shingles(text):
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return {tuple(words)} if 0 < len(words) < k else set(zip(*[words[i:] for i in range(k)]))

    sets = {i: shingles(t) for i, t in texts.items()}
    links = {i: [j for j in sets if j != i and sets[i] and sets[j] and
                 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])] for i in sets}
    low = _components(sets, links)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_classes(_frame(spark, texts), k, percent).collect()}
    assert got == {i: (len(sets[i]), low[i]) for i in sets}


def test_one_document_of_a_class_stays(spark):
    rows = [(1, "a b c d e f"), (2, "a b c d e f"), (1, "a b c d e f"), (3, None), (None, "no id here at all ok"), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("component_id", F.lit("clash"))
    kept = jaccard.keep_one(docs)
    assert sorted((r["doc_id"] or 0 for r in kept.collect())) == [0, 1, 3, 4] and kept.columns == docs.columns
    assert jaccard.keep_one(docs.limit(0)).count() == 0


def test_repeats_equal_brute_force(spark, monkeypatch):
    texts = _texts(9, 60)
    window = 5
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", t or "") for i, t in texts.items()}
    first = {}
    for i in sorted(words):
        for p in range(len(words[i]) - window + 1):
            first.setdefault(tuple(words[i][p:p + window]), i)
    want = {}
    for i, w in words.items():
        gone = {p + d for p in range(len(w) - window + 1) if first[tuple(w[p:p + window])] < i for d in range(window)}
        want[i] = (len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone))
    for hot in (1000, 0):
        monkeypatch.setattr(substrings, "HOT", hot)
        rows = substrings.remove_repeats(_frame(spark, texts), window).collect()
        assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept"]) for r in rows} == want
        assert all(sum(s["end"] - s["start"] for s in r["spans"]) == r["n_removed"] for r in rows)
    docs = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f")], "doc_id long, text string")
    assert [r["n_removed"] for r in substrings.remove_repeats(docs, window).collect()] == [0, 0, 0]
    assert substrings.remove_repeats(docs.limit(0), window).count() == 0


def test_automaton_finds_every_factor():
    rng = np.random.default_rng(2)
    passages = [rng.integers(0, 3, rng.integers(1, 15)).tolist() for _ in range(30)]
    automaton = substrings.SuffixAutomaton()
    for i, p in enumerate(passages):
        automaton.add(p, i)
    automaton.settle()
    for p in passages + [rng.integers(0, 3, 20).tolist() for _ in range(20)]:
        for at, found in enumerate(automaton.stream(p, 4)):
            owners = [i for i, x in enumerate(passages) if any(x[j:j + 4] == p[at:at + 4] for j in range(len(x)))]
            assert found == (min(owners) if owners else substrings.NOWHERE)


def _vectors(seed):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, 16))
    rows = [(i, (centres[i % 30] + rng.normal(size=16) * (0.03 if i % 2 else 0.5)).astype(float).tolist(), i % 3) for i in range(300)]
    same = rows[7][1]
    rows += [(300 + i, same, 1) for i in range(40)]
    return rows + [(900, None, 1), (901, [0.0] * 16, 1), (902, [None] * 16, 1), (903, [float("nan")] * 16, 1),
                   (904, rows[7][1], None), (905, [1.0, 2.0], 1), (906, [], 1), (907, [float("inf")] + [1.0] * 15, 1)]


def test_near_vectors_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(neardup, "BLOCK", 8)
    rows = _vectors(4)
    good = {i: (np.array(v) / np.linalg.norm(v), label) for i, v, label in rows
            if v and label is not None and None not in v and np.isfinite(v).all() and np.linalg.norm(v) > 0}
    links = {i: [j for j, (b, m) in good.items() if j != i and m == label and len(a) == len(b) and a @ b >= 0.98]
             for i, (a, label) in good.items()}
    low = _components([i for i, _, _ in rows], links)
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("node", F.lit("clash"))
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(frame).collect()}
    want = {i: (len(links.get(i, ())), low[i], low[i] == i) for i, _, _ in rows}
    assert sum(got[i] != want[i] for i in want) == 0
    assert neardup.near_duplicates(frame.limit(0)).count() == 0


@pytest.mark.parametrize("blocks", [(4096, 256), (16, 2)])
def test_top_k_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(topk, "VECTORS", blocks[0])
    monkeypatch.setattr(topk, "QUERIES", blocks[1])
    rows = [(i, v) for i, v, _ in _vectors(5)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    whole = topk.integer_vectors(frame, "embedding")
    got = topk.top_k(whole, whole.where("vec_id % 50 = 0"), 10).collect()
    good = {i: np.floor(np.array(v) * 1024).astype(int) for i, v in rows if v and None not in v and np.isfinite(v).all()}
    want = []
    for q in [i for i in good if i % 50 == 0]:
        best = sorted((-int(good[q] @ x), i) for i, x in good.items() if i != q and len(x) == len(good[q]))[:10]
        want += [(q, n, i, -s) for n, (s, i) in enumerate(best, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.top_k(whole.limit(0), whole.limit(0)).count() == 0


def test_pipeline_stages(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "near_duplicates", "secret_scan", "source_mix", "bpe_tokens"]
    rows = corpus_pipeline.run(spark, folder).collect()
    assert rows and all(r["exact"] and r["n_tokens"] == len(r["ids"]) for r in rows)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(0), folder).columns == docs.columns, name


def test_top_k_searches_few_large_blocks(spark, monkeypatch, tmp_path):
    """The walk over a block's segments costs a query about the same for 4,000 vectors and for 16,000."""
    search = topk._search_blocks

    def counted(k):
        inner, folder = search(k), str(tmp_path)

        def run(group):
            open(f"{folder}/{group.column('block')[0].as_py()}-{group.column('of')[0].as_py()}", "w").close()
            return inner(group)
        return run

    monkeypatch.setattr(topk, "_search_blocks", counted)
    rng = np.random.default_rng(6)
    x = rng.integers(-500, 500, size=(12_000, 4))
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<long>")
    got = {(r["query_id"], r["rank"]): (r["vec_id"], r["score"]) for r in topk.top_k(rows, rows.where("vec_id % 3000 = 0")).collect()}
    assert len(list(tmp_path.iterdir())) == 1
    for q in range(0, 12_000, 3000):
        scores = x @ x[q]
        best = [i for i in np.lexsort((np.arange(len(x)), -scores)) if i != q][:10]
        assert [got[q, n] for n in range(1, 11)] == [(i, scores[i]) for i in best]


def test_open_leaves_list_few_pairs_of_two_classes():
    """32 sets of one class and 32 of another are 1,024 pairs that may link; a few stand for all, and are marked."""
    def leaf(first, of_class):
        bitmap = [0xFF] + [0] * (jaccard.PARTS - 1)
        roots = [[1000 * first + i * 50 + j for j in range(jaccard.FIRST)] for i in range(32)]
        return [list(range(first, first + 32)), [8] * 32, [0] * 32, of_class, bitmap * 32, sum(roots, [])]

    names = [f"{side}_{part}" for side in "xy" for part in ("node", "n", "place", "class", "bitmap", "first")]
    values = leaf(0, [0] * 32) + leaf(100, [100] * 16 + [116] * 16)
    batch = pa.RecordBatch.from_arrays([pa.array([7], pa.int64()), *[pa.array([v], pa.list_(pa.int64())) for v in values]], ["token", *names])
    found = pa.Table.from_batches(list(jaccard._open_sets(80, 4)([batch]))).to_pylist()
    assert len(found) == 8 and all(r["more"] and r["low"] == 0 for r in found)
    assert sorted(r["high"] for r in found) == [100] * 4 + [116] * 4
    every = pa.Table.from_batches(list(jaccard._open_sets(80, 1024)([batch]))).to_pylist()
    assert len(every) == 1024 and not any(r["more"] for r in every)


def test_jaccard_classes_after_several_rounds_of_open_pairs(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "TRIES", 1)
    monkeypatch.setattr(jaccard, "STARS", 1)
    test_jaccard_classes_equal_brute_force(spark, monkeypatch, 3, 80)


def test_jaccard_classes_of_plain_texts_need_one_round(spark, monkeypatch):
    """Few pairs below tall roots: no centres are drawn, and all pairs that may link are verified in one step."""
    rng = np.random.default_rng(5)
    texts = {}
    for i in range(0, 60, 2):
        words = [f"c{j}" for j in range(20)] + [f"v{i}-{j}" for j in range(20)]
        texts[i], texts[i + 1] = " ".join(words), " ".join(words[:-1])
    monkeypatch.setattr(jaccard, "HEAVY", 1000)
    verified, labelled, held, verify, label, counts = [], [], [], jaccard._verified, jaccard.connected_components, jaccard._root_counts
    rows = lambda: spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    monkeypatch.setattr(jaccard, "_verified", lambda *a: verified.append(a) or verify(*a))
    monkeypatch.setattr(jaccard, "connected_components", lambda *a: labelled.append(a) or label(*a))
    monkeypatch.setattr(jaccard, "_root_counts", lambda *a: held.append(rows()) or counts(*a))
    before = rows()
    seeds, stars = [], jaccard._stars
    monkeypatch.setattr(jaccard, "_stars", lambda *a: seeds.append(a[-1]) or stars(*a))
    ids = rng.permutation(list(texts))
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_classes(_frame(spark, {int(i): texts[i] for i in ids}), 3, 90).collect()}
    assert got == {i: i - i % 2 for i in texts}
    assert seeds == [None] and len(verified) <= 2 and len(labelled) <= 2
    assert held == [str(jaccard.BATCH)] and rows() == before


def test_workers_give_back_what_earlier_jobs_left(spark):
    from platewise.llm.common import release, shared
    held = shared(spark, list(range(1000)))

    def run(batches):
        import sys
        for batch in batches:
            held()
            release()
            yield pa.RecordBatch.from_arrays([pa.array([len(sys.modules["_shared_values"].__dict__.get("values", {}))])], ["n"])

    assert [r["n"] for r in spark.range(0, 1, 1, 1).mapInArrow(run, "n long").collect()] == [0]


def test_workers_keep_no_free_memory_between_tasks(spark):
    """100 MB of small arrays are freed below one that stays: the C library would keep the pages."""
    from platewise.llm.common import released

    def resident():
        with open("/proc/self/statm") as file:
            return int(file.read().split()[1]) * 4096 >> 20

    def run(batches):
        kept = None
        for batch in batches:
            arrays = [np.ones(4096) for _ in range(3200)]
            kept = arrays[-1]
            del arrays
            yield pa.RecordBatch.from_arrays([pa.array([resident()])], ["mb"])
        sys.modules["_kept_by_test"] = kept

    def look(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([resident()])], ["mb"])

    def both(batches):
        own = list(released(run)(batches))
        yield from own
        yield from look(own)

    during, after = [r["mb"] for r in spark.range(0, 1, 1, 1).mapInArrow(both, "mb long").collect()]
    assert after < during - 50


def test_few_pairs_of_leaves_reach_a_worker_at_once(spark, monkeypatch):
    held, stored = {}, jaccard.materialize
    rows = lambda: int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch"))
    monkeypatch.setattr(jaccard, "materialize", lambda df, label: held.update({label: rows()}) or stored(df, label))
    before = rows()
    jaccard.jaccard_classes(_frame(spark, {1: "a b c d", 2: "a b c d e"}), 3, 60)
    assert held["tried"] == jaccard.LEAVES and held["signatures"] == jaccard.BATCH and rows() == before
