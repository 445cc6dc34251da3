"""Stages of the corpus pipeline against brute-force versions."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tesselorn.llm import common, linededup, mixing, nearsets, pieces, quality, simhash
from tesselorn.llm.queries import TARGETS, label_domains


def near_texts(seed=5):
    """Texts of 30 to 300 words with edited copies, at and around the limit."""
    rng = random.Random(seed)
    rows = []
    for n in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(rng.randint(30, 300))]
        rows.append(words)
        for edits in (1, 2, 4, 8)[: n % 5]:
            copy = list(words)
            for at in rng.sample(range(len(copy)), min(edits, len(copy) // 8)):
                copy[at] = "edited"
            rows.append(copy)
    texts = [" ".join(x) for x in rows] + ["", None, "one two", "ONE  two", "a b c d e f g h", "a b c d e f g h i"]
    return list(enumerate(texts, start=10)) + [(3, texts[7]), (None, texts[0]), (None, "of no id " * 9), (None, "of no id " * 10)]


def kept_by_hand(rows):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(len(w) - 4, 1))} if w else set())
    root = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a == sets[j] or len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                x, y = root[i], root[j]
                root = [y if r == x else r for r in root]
    best = {}
    for (i, _), r in zip(rows, root):
        i = corpus_pipeline.LAST if i is None else i
        best[r] = min(best.get(r, i), i)
    return sorted(best.values())


def test_near_dedup_finds_edited_copies(spark, docs_of, monkeypatch):
    rows = near_texts()
    want = kept_by_hand(rows)
    assert len(want) < len(rows) - 40
    docs = docs_of(rows).repartition(3)
    for block in ((2048, 1 << 15), (8, 8)):
        monkeypatch.setattr(nearsets, "BLOCK", block)
        got = corpus_pipeline.near_dedup(spark, docs, "")
        assert got.columns == corpus_pipeline.COLUMNS
        assert sorted(corpus_pipeline.LAST if r.doc_id is None else r.doc_id for r in got.collect()) == want
    assert corpus_pipeline.near_dedup(spark, docs.limit(0), "").count() == 0


def test_near_dedup_searches_the_gray_index(monkeypatch):
    """Candidates come from the index of the other block, and are all there are."""
    rng = np.random.default_rng(3)
    made = []

    class Seen(simhash.GrayIndex):
        def __init__(self, codes):
            super().__init__(codes)
            made.append(self)

    def block(n, sizes):
        code = rng.integers(0, 2**64, 9, dtype=np.uint64)[rng.integers(0, 9, n)]
        for _ in range(9):
            code ^= np.uint64(1) << rng.integers(0, 64, n, dtype=np.uint64)
        return {"code": code, "sketch": rng.integers(0, 4, (n, 8)).astype(np.uint8).view(np.uint64).ravel(), "size": rng.integers(*sizes, n)}

    monkeypatch.setattr(nearsets, "GrayIndex", Seen)
    for sizes, radius in (((80, 101), nearsets.RADIUS), ((12, 20), nearsets.RADIUS_FEW)):
        for n, m in ((300, 300), (1, 257), (40, 1)):
            x = block(n, sizes)
            y = x if n == m else block(m, sizes)
            want = set()
            for i in range(n):
                for j in range(m):
                    a, b = sorted((int(x["size"][i]), int(y["size"][j])))
                    bytes_alike = sum(p == q for p, q in zip(x["sketch"][i].tobytes(), y["sketch"][j].tobytes()))
                    if (y is not x or i < j) and (x["code"][i] ^ y["code"][j]).item().bit_count() <= radius and a >= nearsets.LEAST * b and bytes_alike >= nearsets.SAME:
                        want.add((i, j))
            got = [(int(i), int(j)) for q, at in nearsets._candidates(x, y, y is x) for i, j in zip(q, at)]
            assert len(got) == len(set(got)) and set(got) == want
            assert made.pop().met > 0 and not made
    assert list(simhash.GrayIndex(np.zeros(0, np.uint64)).search_runs(x["code"], 16)) == []
    # far clusters are left as groups, for runs that lie in another one
    far = np.concatenate([np.arange(4096, dtype=np.uint64), ~np.arange(4096, dtype=np.uint64)])
    index = simhash.GrayIndex(far)
    monkeypatch.setattr(simhash, "FRONTIER", 1 << 14)
    assert sum(len(q) for q, _ in index.search_runs(far, 16)) == 2 * 4096**2 and index.met < 0.6 * len(far) ** 2


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES])
def test_stages_of_an_empty_table(spark, docs_of, stage):
    docs = docs_of([(1, "x")]).limit(0)
    got = stage(spark, docs, "/root/testdata/sf0.001")
    assert got.count() == 0
    assert stage is corpus_pipeline.encode or got.columns == corpus_pipeline.COLUMNS


PASSAGE = "\n".join(" ".join(f"p{i}w{j}" for j in range(15)) for i in range(5))


def some_documents(seed=2):
    """Good, poor and toxic texts, with nulls, empties, ties, repeated rows, a
    shared passage, copies and a long text."""
    rng = random.Random(seed)
    words = {0: ["clear", "calm", "the", "river", "and", "stone", "old"], 1: ["buy", "now", "$$$", "click", "the"], 2: ["vile", "hate", "the", "scum", "and"]}
    rows, labels = [], []
    for i in range(240):
        kind = 0 if i % 10 < 7 else 1 if i % 10 < 9 else 2
        text = " ".join(rng.choices(words[kind], k=rng.randint(20, 80)))
        rows.append((i, f"{text}\n{PASSAGE}" if i % 12 == 0 else text))
        if i % 2:
            labels.append((i, int(kind != 1), int(kind == 2)))
    rows += [(300, None), (301, ""), (302, " \n\t"), (None, "clear calm river"), (None, None), (303, "river " * 20_000), (304, rows[20][1]), rows[20], rows[20], (31, "another text of a labelled id")]
    return rows, labels


@pytest.fixture(scope="module")
def small(spark, docs_of, tmp_path_factory):
    """(rows, documents with clashing further columns, a folder of tables)."""
    at = str(tmp_path_factory.mktemp("sf"))
    rows, labels = some_documents()
    docs_of(rows).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{at}/labels.parquet")
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for name in ("_id", "_hash", "_key", "_row", "_copy", "copies", "_label", "_n_chars", "_text", "root", "removed_lines"):
        docs = docs.withColumn(name, F.lit("mine"))
    return rows, docs.repartition(5), at


def counted(rows):
    return Counter((r.doc_id, r.text) for r in rows)


def test_quality_stage_by_hand(spark, small):
    rows, docs, at = small
    got = corpus_pipeline.quality_classifier(spark, docs, at)
    assert got.columns == corpus_pipeline.COLUMNS
    labels = spark.read.parquet(f"{at}/labels.parquet")
    machine = quality.train(docs, labels.where(common.remainder(F.col("doc_id")) != 0))
    want = Counter((i, t) for i, t in rows if machine.score((t or "").encode(), None if t is None else len(t)) >= 0.3)
    assert counted(got.collect()) == want and len(rows) * 0.6 < sum(want.values()) < len(rows)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{at}/none/labels.parquet")
    assert counted(corpus_pipeline.quality_classifier(spark, docs, f"{at}/none").collect()) == Counter(rows)  # no label: all stay


def test_line_stage_by_hand(spark, small):
    rows, docs, at = small
    got = corpus_pipeline.line_dedup(spark, docs, at)
    assert got.columns == corpus_pipeline.COLUMNS
    seen, want = set(), {}
    for i, t in sorted({(linededup.LAST if i is None else i, t or "") for i, t in rows}):
        if PASSAGE in t and PASSAGE in seen:
            want[i] = t.removesuffix("\n" + PASSAGE)
        seen |= {PASSAGE} if PASSAGE in t else set()
        if (key := t.strip()) in seen and len(key.split()) >= 50:
            want[i] = ""
        seen.add(key)
    rows_of = {}
    for r in got.collect():
        rows_of.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        for r in rows_of[i]:
            assert r.n_chars == (None if r.text is None else len(r.text))
        assert want.get(i, t) in [r.text for r in rows_of[i]]
    assert sum(map(len, rows_of.values())) == len(rows) and len(want) > 15


def test_mixing_stage_by_hand(spark, small):
    rows, docs, at = small
    got = counted(corpus_pipeline.mix_sources(spark, docs, at).collect())
    labels = label_domains(spark.read.parquet(f"{at}/labels.parquet"))
    copies = {(r.doc_id, r.text_hash): r.copies for r in mixing.mix(docs, labels, TARGETS).collect()}
    hashes = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    want = Counter()
    for i, t in rows:
        want[i, t] += copies[i, hashes[t]]
    assert got == +want


def test_pipeline_runs_all_stages(spark, small):
    """run() gives what the stages give one after the other; the last one's ids
    are those of the sentencepiece library."""
    import sentencepiece

    _, _, at = small
    docs = spark.read.parquet(f"{at}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, at).collect(), docs.schema)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=pieces.read_model())
    want = Counter((r.doc_id, tuple(theirs.encode(r.text or ""))) for r in docs.collect())
    assert Counter((r.doc_id, tuple(r.ids)) for r in corpus_pipeline.run(spark, at).collect()) == want
    assert len(want) > 50
