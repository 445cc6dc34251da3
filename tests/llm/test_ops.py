"""Each operator against a brute-force version on small, awkward tables."""

import hashlib
import math
import random
import re
import struct
import time
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from tesselorn.llm import interpolation, linededup, mixing, pieces, quality, search, simhash, spotsigs, urlfilter, viterbi
from tesselorn.llm import common
from tesselorn.llm.queries import RULES


def corpus(n=60, seed=1):
    """Texts with copies, near copies, shared passages, junk, empties and nulls."""
    rng = random.Random(seed)
    vocabulary = ["the", "of", "and", "is", "to"] + ["w" + "".join(rng.choices("abcdé", k=rng.randint(1, 5))) for _ in range(150)]
    line = lambda k: " ".join(rng.choices(vocabulary, k=k))
    passage = "\n".join(line(14) for _ in range(5))
    single = line(60)
    rows = []
    for i in range(n):
        text = "\n".join(line(rng.randint(1, 30)) for _ in range(rng.randint(1, 8)))
        if i % 7 == 3:
            text = rows[rng.randrange(len(rows))][1]
        elif i % 7 == 4:
            text = f"{text}\n{passage}\n{line(5)}"
        elif i % 7 == 5:
            text = f"{line(4)}\n{single}\n{text}"
        elif i % 11 == 6:
            old = (rows[rng.randrange(len(rows))][1] or "x").split(" ")
            old[rng.randrange(len(old))] = "changed"
            text = " ".join(old)
        rows.append((i, text))
    rows += [(n, None), (n + 1, ""), (n + 2, " \t\n "), (n + 3, "one"), (n + 4, "one two"), (None, "null id text here"), (n + 5, "\x0b\x1c odd\u00a0space \U0001f600"), (n + 6, "A\n" * 200), (n + 7, "long " * 5000)]
    rows.append(rows[0])
    return rows


def words(text):
    return (text or "").encode().lower().split()


@pytest.fixture(scope="module")
def docs(docs_of):
    return docs_of(corpus()).repartition(3).cache()


def test_words_of_slices():
    column = pa.array([t for _, t in corpus()])
    for at in range(0, len(column), 7):
        part = column.slice(at, 7)
        found, sizes = common.words_of(part)
        want = [words(t) for t in part.to_pylist()]
        assert sizes.tolist() == [len(w) for w in want]
        assert found.cast(pa.large_binary()).to_pylist() == [w for ws in want for w in ws]


def test_pieces_of_long_texts():
    """Words and shingles of a text are the same in pieces of any size."""
    rng = random.Random(3)
    for _ in range(200):
        data = "".join(rng.choices(["a", "bc", "\u00e9", " ", "\n", "\t \x0b", "\u00a0"], k=rng.randint(0, 40))).encode()
        for size in (1, 2, 7, 100):
            assert [w for p in common.word_pieces(data, size) for w in p] == data.split()
    data = b"one two  three\nfour " * 100_000
    words_ = data.split()
    for n in (1, 3, 5):
        want = [xxhash.xxh64_intdigest(b" ".join(words_[i : i + n]), 42) for i in range(len(words_) - n + 1)]
        assert np.concatenate(list(simhash.gram_hashes(data, n))).tolist() == want


def test_pack_round_trip():
    for a in ([], [0], [2**64 - 1, 0, 7], list(range(1000))):
        a = np.array(a, np.uint64)
        assert (common.unpack(common.pack(a)) == a).all()
        assert (common.unpack_sorted(common.pack_sorted(np.sort(a))) == np.sort(a)).all()
    assert common.parted(common.joined([b"", b"ab", b"c"])) == [b"", b"ab", b"c"]


# op1


def judged(url):
    if url is None or "://" not in url:
        host = path = ""
    else:
        rest = url.split("://", 1)[1]
        host = re.match(r"[^/?#]*", rest)[0]
        path = re.match(r"[^?#]*", rest[len(host) :])[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    _, rule, verdict = max(fit, default=(0, None, "allow"))
    return host, path, rule, verdict


def test_url_filter(spark):
    urls = [None, "", "no scheme", "://", "http://net", "http://NET/", "http://a.net/x", "http://anet/x", "http://x.example.net/en/1?q", "http://example.net/en", "http://example.net/de/", "https://www.example.com/de/a#b", "http://Éx.org/fr/", "http://org/fr/x", "http://a.org?/fr/", "ftp://example.com/de/x://net/", "http://example.com:80/de/", "http://a..net/", "http://x\ny.net/\n"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls + urls)], "page_id long, url string, rule string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urlfilter.judge(pages, RULES).collect()}
    assert got == {i: judged(u) for i, u in enumerate(urls + urls)}
    assert urlfilter.judge(pages.limit(0), RULES).count() == 0
    assert {r.verdict for r in urlfilter.judge(pages, []).collect()} == {"allow"}


def test_url_filter_long_hosts_ties_and_clashes(spark):
    rules = [("block", "x.net", "/"), ("allow", "net", "/ab"), ("block", "a.b.c", "/")]
    host = ".".join("x" * 1 for _ in range(50_000)) + ".net"
    urls = ["http://x.net/abc", "http://y.x.net/abc", "http://net/abc", f"http://{host}/ab", "http://" + "a." * 50_000 + "b.c/"]
    pages = spark.createDataFrame([(i, u, 1, 2, 3) for i, u in enumerate(urls)], "page_id long, url string, _keys int, _states int, _hit int")
    began = time.time()
    got = {r.page_id: r for r in urlfilter.judge(pages, rules).collect()}
    assert time.time() - began < 30
    assert [got[i].rule for i in range(5)] == ["x.net/", "x.net/", "net/ab", "x.net/", "a.b.c/"]
    assert [got[i].verdict for i in range(5)] == ["block", "block", "allow", "block", "block"]
    assert all((r._keys, r._states, r._hit) == (1, 2, 3) for r in got.values())


def test_cascade_is_exact(spark):
    listed = [f"key{i}" for i in range(0, 3000, 10)]
    universe = spark.createDataFrame([(f"key{i}",) for i in range(3000)] + [(None,)], "key string")
    cascade = urlfilter.build(spark.createDataFrame([(k,) for k in listed], "key string"), universe, 3000)
    assert len(cascade.levels) > 1
    rows = universe.where("key is not null").select("key", *urlfilter._hashes(F.col("key"))).toPandas()
    found = cascade.listed(urlfilter._pair(rows))
    assert set(rows["key"][found]) == set(listed)


# op2


def test_interpolation(docs):
    rows = corpus()
    tokens = [(i, [*words(t), None]) for i, t in rows]
    of = lambda i: zlib.crc32(str(i).encode() if i is not None else b"")
    train = [t for i, t in tokens if of(i) % 5 != 1]
    c = Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    for order in (2, 3):
        got = interpolation.score(docs, order=order).collect()
        assert len(got) == len(rows)
        want = Counter((i, len(t), sum(c[w] > 0 for w in t), round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in t), 6)) for i, t in tokens)
        assert Counter((r.doc_id, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in got) == want
        assert all(r.train_tokens == n and r.held_out == (of(r.doc_id) % 5 == 1) and r.score < 0 for r in got)
    assert interpolation.score(docs.limit(0)).count() == 0


def scores_by_hand(rows, order):
    """The model written out: counts, buckets, expectation-maximisation, scores."""
    def grams(texts):
        c = [Counter() for _ in range(order + 1)]
        for t in texts:
            for p in range(len(t)):
                for k in range(1, order + 1):
                    c[k][tuple(t[p - k + 1 + j] if p - k + 1 + j >= 0 else "start" for j in range(k))] += 1
        return c

    def of(t, p, k, c, n):
        """Counts of the k-gram that ends at p, and of its history."""
        gram = tuple(t[p - k + 1 + j] if p - k + 1 + j >= 0 else "start" for j in range(k))
        before = tuple(t[p - k + 1 + j] if p - k + 1 + j >= 0 else "start" for j in range(k - 1))
        return c[k][gram], (n if p == 0 else c[k - 1][before])

    def facts(t, p, c, n):
        total, kinds = sum(c[1].values()), len(c[1])
        found = [of(t, p, k, c, n) for k in range(2, order + 1)]
        ps = [1 / (kinds + 1), c[1][t[p],] / max(total, 1), *(x / h if h else 0 for x, h in found)]
        return tuple(int(math.log2(h + 1)) for _, h in found), ps

    texts = [(i, [*words(t), None]) for i, t in rows]
    crc = lambda i: zlib.crc32(str(i).encode() if i is not None else b"")
    train = [(i, t) for i, t in texts if crc(i) % 5 != 1]
    held = [t for i, t in train if crc(i) // 5 % interpolation.HELD == 0]
    kept = [t for i, t in train if crc(i) // 5 % interpolation.HELD]
    c = grams(kept)
    seen = {}
    for t in held:
        for p in range(len(t)):
            b, ps = facts(t, p, c, len(kept))
            seen.setdefault(b, []).append(ps)
    weights = {}
    for b, all_ps in seen.items():
        can = [k < 2 or max(ps[k] for ps in all_ps) > 0 for k in range(order + 1)]
        weights[b] = [x / sum(can) for x in can]
    while weights:
        moved = 0
        for b, all_ps in seen.items():
            e = [0.5 * (k < 2) for k in range(order + 1)]
            for ps in all_ps:
                total = sum(w * p for w, p in zip(weights[b], ps))
                e = [x + w * p / total for x, w, p in zip(e, weights[b], ps)]
            new = [x / sum(e) for x in e]
            moved = max(moved, *(abs(x - y) for x, y in zip(new, weights[b])))
            weights[b] = new
        if moved < interpolation.MOVED:
            break
    number = lambda b: sum(x * 64**i for i, x in enumerate(b))
    c = grams([t for _, t in train])
    out = []
    for i, t in texts:
        score = 0.0
        for p in range(len(t)):
            b, ps = facts(t, p, c, len(train))
            near = [x for x in weights if [y > 0 for y in x] == [y > 0 for y in b]]
            w = weights.get(b) or (weights[min(near, key=lambda x: (abs(number(x) - number(b)), number(x)))] if near else [0.5, 0.5] + [0] * (order - 1))
            score += math.log10(sum(x * y for x, y in zip(w, ps)))
        out.append((i, len(t), score))
    return out


@pytest.mark.parametrize("order", [2, 3])
def test_interpolation_scores_by_hand(docs_of, order):
    rows = corpus(150)
    got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in interpolation.score(docs_of(rows).repartition(3), order=order).collect())
    want = sorted((str(i), n, s) for i, n, s in scores_by_hand(rows, order))
    assert [x[:2] for x in got] == [x[:2] for x in want]
    assert [x[2] for x in got] == pytest.approx([x[2] for x in want], rel=1e-6)


def test_interpolation_small_corpora(docs_of):
    """Null texts alone, one document, a very long text, at order 3."""
    for rows in ([(1, None), (2, None), (None, None)], [(7, "one two three")], [(i, "a b " * 100_000) for i in range(3)]):
        got = interpolation.score(docs_of(rows).withColumn("order", F.lit(1)), order=3).collect()
        assert len(got) == len(rows) and all(r.score < 0 and r.n_tokens == len(words(dict(rows)[r.doc_id])) + 1 for r in got)


def test_interpolation_probabilities_sum_to_one(docs):
    """Over the whole vocabulary and one unknown word, after any history."""
    got = interpolation.blocks(docs, "doc_id", "text")
    table = common.written(got)
    answered = common.written(interpolation.counts.replies(interpolation._requests(table, 2, 3), 3))
    (n, kept), (v, kept_v) = interpolation.counts.totals(answered, 2)
    tokens = [[*words(t), None] for i, t in corpus() if interpolation.trains(common.NO_ID if i is None else i)]
    c1 = Counter(w for t in tokens for w in t)
    c2 = Counter(p for t in tokens for p in zip([0, *t], t))
    assert (n, v) == (sum(c1.values()), len(c1))
    held = sum(interpolation.holds(common.NO_ID if i is None else i) for i, _ in corpus())
    weights = interpolation._fit(interpolation._held_counts(table, answered, 2, len(tokens) - held), 2, kept, kept_v)
    of = interpolation._all_weights(weights, 2)
    for history, h in [(0, len(tokens)), (b"the", c1[b"the"]), (b"unseen", 0)]:
        w = of(int(interpolation.bucket([np.array([h])], 1)[0]))
        total = w[0] + w[1] + (w[2] * sum(k for (a, _), k in c2.items() if a == history) / h if h else 0)
        assert total == pytest.approx(1, abs=1e-9)


# op3


def line_facts(rows, least):
    """All windows of each document in order, as (document, start, end, lines)."""
    out = []
    for i, text in sorted({(linededup.LAST if i is None else i, t) for i, t in rows if t is not None}):
        lines = [x.strip() for x in text.encode().split(b"\n")]
        n = [len(x.split()) for x in lines]
        for start in range(len(lines)):
            for end in range(start + 1, len(lines) + 1):
                if n[start] and sum(n[start:end]) >= least:
                    out.append((i, start, end, tuple(x for x in lines[start:end] if x)))
                    break
    return out


def test_line_dedup(docs):
    rows = corpus()
    ranges = {(r.order_id): {n for x in r.ranges for n in range(x.start, x.end)} for r in linededup.repeated_lines(docs).collect()}
    seen, must, may = set(), {}, {}
    facts = line_facts(rows, linededup.MIN_WORDS)
    for i, start, end, lines in facts:
        if lines in seen:
            must.setdefault(i, set()).update(range(start, end))
        seen.add(lines)
    assert must
    for i, lines in must.items():
        assert lines <= ranges.get(i, set())
    got = linededup.dedup(docs)
    assert got.columns == [*docs.columns, "removed_lines"] and got.count() == len(rows)
    texts = {i: t for i, t in rows}
    for r in got.collect():
        old, gone = texts[r.doc_id], ranges.get(linededup.LAST if r.doc_id is None else r.doc_id, set())
        want = None if old is None else "\n".join(x for n, x in enumerate(old.split("\n")) if n not in gone)
        assert (r.text, r.removed_lines) == (want, len(gone))
    # what is deleted stands earlier: no window is lost from the corpus
    kept = {w[3] for w in line_facts([(r.doc_id, r.text) for r in got.collect()], linededup.MIN_WORDS)}
    first = {}
    for i, start, end, lines in facts:
        first.setdefault(lines, (i, start, end))
    for i, gone in ranges.items():
        for line in gone - must.get(i, set()):  # by extension only
            text = [x.strip() for x in texts[None if i == linededup.LAST else i].encode().split(b"\n")]
            assert not text[line] or sum(text[line] in [x.strip() for x in (t or "").encode().split(b"\n")] for _, t in rows) > 1
    assert kept
    assert linededup.dedup(docs.limit(0)).count() == 0


def test_line_dedup_needs_the_second_round(docs_of):
    """A gram whose first place has other lines around it than later ones."""
    gram = " ".join(f"g{i}" for i in range(30))
    a, b = " ".join(f"a{i}" for i in range(15)), " ".join(f"b{i}" for i in range(15))
    rows = [(1, f"x\n{gram}\ny"), (2, f"{a}\n{gram}\n{b}"), (3, f"q\n{a}\n{gram}\n{b}\nz"), (4, f"{gram}\n{gram}\n{gram}\n{gram}")]
    got = {r.doc_id: r.text for r in linededup.dedup(docs_of(rows)).collect()}
    assert got == {1: rows[0][1], 2: rows[1][1], 3: "q\nz", 4: got[4]}
    assert gram in got[4] and got[4].count("g0 ") < 4


def test_line_dedup_runs_hidden_by_others(docs_of):
    """A run at another place of the same earlier document; blank lines between."""
    a, b, c, d = (" ".join(f"{x}{i}" for i in range(n)) for x, n in (("a", 40), ("b", 15), ("c", 20), ("d", 20)))
    rows = [(1, f"{a}\n{b}\nx\n{b}\n{c}\n{d}\ny"), (2, f"{a}\n{b}\n{c}\n{d}"), (3, f"{a}\n\n \t\n{b}\n\nkept\n\n{b}\n\n{c}\n{d}\n\nend")]
    got = {r.doc_id: r.text for r in linededup.dedup(docs_of(rows)).collect()}
    assert got == {1: rows[0][1], 2: "", 3: "\nkept\n\n\nend"}


def test_line_dedup_random_runs(docs_of):
    """Documents of few different lines, so that runs overlap in many ways: every
    window that stands earlier goes, and nothing but lines that stand earlier."""
    rng = random.Random(11)
    lines = [" ".join(f"{x}{i}" for i in range(rng.randint(8, 40))) for x in "abcdefgh"]
    for _ in range(3):
        rows = [(i, "\n".join(rng.choices([*lines, ""], k=rng.randint(3, 12)))) for i in range(60)]
        ranges = {r.order_id: {n for x in r.ranges for n in range(x.start, x.end)} for r in linededup.repeated_lines(docs_of(rows).repartition(3)).collect()}
        seen = set()
        for i, start, end, run in line_facts(rows, linededup.MIN_WORDS):
            if run in seen:
                text = rows[i][1].split("\n")
                assert {n for n in range(start, end) if text[n]} <= ranges.get(i, set())
            seen.add(run)
        assert 0 not in ranges or rows[0][1]


def test_line_dedup_hot_keys_and_clashing_columns(spark, docs_of, monkeypatch):
    """A passage in every document, copies of one, and columns of all our names."""
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "SALTS", 3)
    monkeypatch.setattr(linededup, "HOT_COPIES", 4)
    passage = "\n".join(" ".join(f"p{i}w{j}" for j in range(20)) for i in range(4))
    rows = [(i, f"head {i}\n{passage}\ntail {i}") for i in range(40)] + [(i, f"{passage}\n" * 2) for i in range(40, 60)]
    docs = docs_of(rows)
    for name in ("_id", "_hash", "_ranges", "_kept", "__id", "removed_lines"):
        docs = docs.withColumn(name, F.lit("mine"))
    got = {r.doc_id: r for r in linededup.dedup(docs.repartition(5)).collect()}
    assert got[0].text == rows[0][1] and all(got[i].text == f"head {i}\ntail {i}" for i in range(1, 40))
    assert all(got[i].text == "" and got[i]._id == got[i]._hash == got[i]._ranges == got[i]._kept == got[i]["__id"] == "mine" for i in range(40, 60))


def test_line_dedup_very_long_texts(docs_of):
    blank, one = "\n" * 1_000_000, "word\n" * 200_000
    rows = [(1, " ".join(["x"] * 60) + blank), (2, blank + " ".join(["x"] * 60)), (3, one), (4, one + "end")]
    began = time.time()
    got = {r.doc_id: (r.text, r.removed_lines) for r in linededup.dedup(docs_of(rows)).collect()}
    assert time.time() - began < 60
    assert got[1] == (rows[0][1], 0) and got[2] == (blank[1:], 1) or got[2][1] == 1
    assert got[3][0].strip("\n") == "word" and got[4][0] == "end"


# op4


def rates_by_hand(p, t, want, steps=40_000):
    """Plain projected gradient, a step at a time, over all rates."""
    rate = np.ones(len(t))
    size = 1 / (np.linalg.eigvalsh((p * t[:, None]).T @ p)[-1] + mixing.RIDGE)
    for _ in range(steps):
        gradient = p @ ((t * rate) @ p - want) + mixing.RIDGE * (rate - 1)
        rate = np.maximum(0, rate - size * gradient)
    return rate, 0.5 * (((t * rate) @ p - want) ** 2).sum() + 0.5 * mixing.RIDGE * (t * (rate - 1) ** 2).sum()


def mixing_rows():
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choices(["red", "blue", "the"] if i % 3 else ["bad", "worse", "the"], k=rng.randint(5, 60)))) for i in range(150)]
    return rows + [(200, None), (201, ""), (None, "red blue"), (202, "red " * 3000), rows[4], rows[4]]


@pytest.mark.parametrize("want", [{"x": 0.9, "y": 0.1}, {"x": 1.0, "y": 0.0}, {"x": 0.3, "y": 0.7}])
def test_mixing(spark, docs_of, want):
    """Reachable and unreachable targets; nulls, a long text and repeated rows."""
    rows = mixing_rows()
    labels = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(0, 150, 2)] + [(None, "x"), (3, None)], "doc_id long, domain string")
    got = mixing.mix(docs_of(rows).repartition(3), labels, want).collect()
    assert len(got) == len(rows) and all(r.rate >= 0 and abs(r.copies - r.rate) < 1 for r in got)
    p, t = np.array([[r.p_x, r.p_y] for r in got]), np.array([r.n_tokens for r in got], float)
    t /= t.sum()
    rate, best = rates_by_hand(p, t, np.array([want["x"], want["y"]]))
    own = np.array([r.rate for r in got])
    found = 0.5 * (((t * own) @ p - [want["x"], want["y"]]) ** 2).sum() + 0.5 * mixing.RIDGE * (t * (own - 1) ** 2).sum()
    assert found <= best * 1.001 + 1e-9
    assert own == pytest.approx(rate, abs=0.02)
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(words(t)) for i, t in rows}


def test_mixing_without_labels_or_documents(spark, docs_of):
    rows = mixing_rows()
    labels = spark.createDataFrame([(i, "x" if i % 3 else "y") for i in range(0, 150, 2)], "doc_id long, domain string")
    with pytest.raises(ValueError):
        mixing.mix(docs_of(rows), labels, {"z": 1.0})
    with pytest.raises(ValueError):
        mixing.mix(docs_of(rows), labels.union(labels.selectExpr("doc_id + 1", "upper(domain)")), {"x": 1.0})
    assert mixing.mix(docs_of([]), labels, {"x": 0.5, "y": 0.5}).count() == 0


def test_labelled_ids_that_repeat(spark, docs_of):
    """Of several texts of a labelled id one is learnt, always the same."""
    rows = [(i, f"good {i}" if i % 2 else f"bad {i}") for i in range(40)] + [(3, "other text"), (3, "and another"), (4, None)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    one, two = (quality.train(docs_of(r).repartition(n), labels) for r, n in ((rows, 1), (rows[::-1], 5)))
    assert (one.linear == two.linear).all() and (one.vectors == two.vectors).all()
    assert quality.classify(docs_of([]), labels).count() == 0


# op5


def likeness(a, b):
    return 1.0 if a == b else len(a & b) / len(a | b)


def test_spotsigs_pairs(spark, docs):
    got = sorted(spotsigs.edited_pairs(docs).collect(), key=str)
    order = lambda r: (r[0] is not None, r[0] or 0)
    rows = sorted([(i, t or "") for i, t in corpus()], key=order, reverse=True)
    want = []
    for at, (i, text) in enumerate(rows):
        other = rows[(at + 1) % len(rows)][1]
        k = len(text) // 3
        want.append((i, len(text), text, text[: len(text) - k] + other[:k], other))
    # the sets themselves are held to a version by hand below
    texts = sorted({t for x in want for t in x[2:]})
    sets = {r.t: frozenset(r.s) for r in spark.createDataFrame([(t,) for t in texts], "t string").select("t", spotsigs.signatures(F.col("t")).alias("s")).collect()}
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    printed = lambda t: "".join(f"{x:08x}" for x in sorted(sets[t]))
    by_hand = Counter((i, n, sha(e), printed(t), printed(e), round(likeness(sets[t], sets[e]), 12), round(likeness(sets[t], sets[o]), 12)) for i, n, t, e, o in want)
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, round(r.near_edited, 12), round(r.near_next, 12)) for r in got) == by_hand
    assert spotsigs.edited_pairs(docs.limit(0)).count() == 0


def test_spotsigs_ids_that_repeat_or_are_null(docs_of, monkeypatch):
    """Many rows of one id and of none, in many ranges: each has one next row."""
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 7)
    rows = [(5, f"the text {i} of one id") for i in range(60)] + [(None, f"a text {i} without an id") for i in range(60)] + [(i, "same text") for i in range(10)] * 3
    got = spotsigs.with_next(docs_of(rows).repartition(4), "doc_id", "text", ["doc_id", "text"]).collect()
    assert Counter((r.doc_id, r.text) for r in got) == Counter((r.next_doc_id, r.next_text) for r in got) == Counter(rows)
    ids = lambda x: -1 if x is None else x
    assert sum(ids(r.next_doc_id) > ids(r.doc_id) for r in got) == 1  # only after the last


def test_spotsigs_very_long_texts(docs_of):
    """A megabyte of one common word, of one word, and of anchors and words."""
    rows = [(1, "the " * 250_000), (2, "x" * 1_000_000), (3, "the cat " * 120_000), (4, "the\n" * 250_000 + "big old cat")]
    began = time.time()
    got = {r.doc_id: r for r in spotsigs.edited_pairs(docs_of(rows)).collect()}
    assert time.time() - began < 60
    assert len(got[1].fingerprint) == len(got[2].fingerprint) == len(got[3].fingerprint) == len(got[4].fingerprint) == 8


def sigs_by_hand(text):
    common_words = set(spotsigs.COMMON)
    tokens = re.sub(r"[^\w]+|_", " ", text.lower()).split()
    out = set()
    for i, w in enumerate(tokens):
        chain = [x for x in tokens[i + 1 :] if x not in common_words][: spotsigs.CHAIN]
        if w in common_words and len(chain) == spotsigs.CHAIN:
            out.add(xxhash.xxh64_intdigest("".join(" " + x for x in chain), 42) & 0xFFFFFFFF)
    return out


def test_spotsigs_signatures_and_ranges(spark, docs, monkeypatch):
    monkeypatch.setattr(spotsigs, "RANGE_ROWS", 10)
    plain = spark.createDataFrame([(i, t) for i, t in corpus()], "doc_id long, text string")
    got = plain.select("text", spotsigs.signatures(F.col("text")).alias("s")).collect()
    for r in got:
        if r.text and "\u00a0" not in r.text and (want := sigs_by_hand(r.text)):
            assert set(r.s) == want
    test_spotsigs_pairs(spark, docs)


def test_spotsigs_near_duplicates(docs):
    members, pairs = spotsigs.near_duplicates(docs)
    sets = {}
    for r in docs.where("doc_id is not null").select("doc_id", spotsigs.signatures(F.col("text")).alias("s")).collect():
        sets[r.doc_id] = frozenset(r.s)
    reps = {}
    for i, s in sorted(sets.items()):
        reps.setdefault(s, i)
    assert {r.doc_id: r.class_id for r in members.collect()} == {i: reps[s] for i, s in sets.items()}
    want = {(reps[a], reps[b]) for a in reps for b in reps if a and b and reps[a] < reps[b] and len(a & b) / len(a | b) >= 0.8}
    assert {(r.a, r.b) for r in pairs.collect()} == want


# op6


def test_factorisation_machine(spark, docs_of):
    rng = random.Random(5)
    rows = [(i, " ".join(rng.choices(["fine", "good", "the", "text"] if i % 4 else ["junk$$", "spam!!", "the"], k=30))) for i in range(300)] + [(900, None), (901, ""), (None, "fine")]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(300)] + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(docs_of(rows), labels).collect()
    assert len(got) == len(rows)
    held = [r for r in got if r.held_out and r.doc_id is not None and r.doc_id < 300]
    assert held and all(r.predicted == int(r.doc_id % 4 > 0) for r in held)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    none = quality.classify(docs_of(rows[:3]), labels.limit(0)).collect()
    assert [r.score for r in none] == pytest.approx([0.5] * 3, abs=0.1)


def test_factorisation_machine_identity():
    m = quality.fit([], rank=3)
    at, x = quality.inputs(b"some words are here, some", 20)
    m.vectors[:] = np.random.default_rng(0).normal(size=m.vectors.shape)
    pairs = sum(m.vectors[a] @ m.vectors[b] * p * q for i, (a, p) in enumerate(zip(at, x)) for b, q in zip(at[:i], x[:i]))
    assert m.raw(at, x) == pytest.approx(m.bias + float(m.linear[at] @ x) + pairs, rel=1e-4)


def test_quality_on_held_out_labels(spark):
    """Labels that were not learnt from, on the supplied tables."""
    at = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in quality.classify(docs, labels).collect()}
    held = [(got[r.doc_id].score, r.quality) for r in labels.collect() if r.doc_id in got and got[r.doc_id].held_out]
    good, poor = ([s for s, q in held if q == x] for x in (1, 0))
    assert len(good) > 30 and len(poor) > 3
    assert sum((a > b) + (a == b) / 2 for a in good for b in poor) / (len(good) * len(poor)) > 0.95


# op7


def bm25(rows, queries, k):
    bags = [Counter(words(t)) for _, t in rows]
    df = Counter(w for b in bags for w in b)
    n, mean = len(rows), sum(sum(b.values()) for b in bags) / len(rows)
    out = {}
    for q, text in queries:
        scores = []
        for (i, _), b in zip(rows, bags):
            size = sum(b.values())
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * b[w] * 2.2 / (b[w] + 1.2 * (0.25 + 0.75 * size / mean)) for w in set(words(text)) & set(b))
            if s > 0 or set(words(text)) & set(b):
                scores.append((-round(s, 6), i if i is not None else math.inf))
        out[q] = sorted(scores)[:k]
    return out


@pytest.mark.parametrize(("shard", "bits", "queries_a_group"), [(4, 1, 5), (8, 2, 1000), (8192, 3, 7)])
def test_search(docs, docs_of, monkeypatch, shard, bits, queries_a_group):
    """Many shards and rounds, blocks of few documents, many groups of queries;
    with ties, repeated rows, near copies, empty and long texts."""
    monkeypatch.setattr(search, "SHARD_DOCS", shard)
    monkeypatch.setattr(search, "BLOCK_BITS", bits)
    monkeypatch.setattr(search, "GROUP_QUERIES", queries_a_group)
    monkeypatch.setattr(search, "QUERY_BLOCK", 3)
    monkeypatch.setattr(search, "_rounds", lambda *_: [0.1, 0.4, 1.0])
    rows = corpus()
    queries = [(i, t) for i, t in rows if i is not None and i % 5 == 0][:-1] + [(1000, "the zzz"), (1001, "zzz")]
    got = {}
    for r in search.search(docs, docs_of(queries), k=7).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((-round(r.score, 6), r.doc_id if r.doc_id is not None else math.inf))
    assert got == {q: s for q, s in bm25(rows, queries, 7).items() if s}
    assert search.search(docs.limit(0), docs).count() == 0
    assert search.search(docs, docs.limit(0)).count() == 0


def shard_of(texts, bits):
    bags = [Counter(words(t)) for t in texts]
    vocabulary = {w: xxhash.xxh64_intdigest(w) for b in bags for w in b}
    terms = sorted(vocabulary, key=vocabulary.get)
    posts = [(n, d, b[w]) for n, w in enumerate(terms) for d, b in enumerate(bags) if w in b]
    df = np.array([sum(w in b for b in bags) for w in terms], np.int64)
    sizes = np.array([sum(b.values()) for b in bags])
    u = lambda x: common.pack(np.array(x, np.uint64))
    row = {"ids": u(range(len(texts))), "sizes": u(sizes), "terms": common.pack_sorted(np.array([vocabulary[w] for w in terms], np.uint64)), "starts": u(df), "docs": u([d for _, d, _ in posts]), "tfs": u([f for *_, f in posts])}
    return search.Shard(row, df.astype(float), len(texts), float(sizes.mean()), bits), vocabulary


def test_pruning_skips_shards_blocks_and_postings():
    rng = random.Random(5)
    topics = [[f"t{j}w{i}" for i in range(300)] for j in range(8)]
    texts = [" ".join(rng.choices(topics[d // 64], k=40) + rng.choices(["the", "of", "and"], k=20)) for d in range(512)]
    shard, vocabulary = shard_of(texts, 5)
    for query in texts[::37]:
        which = shard.places(np.unique(np.array([vocabulary[w] for w in set(words(query))], np.uint64)))
        shard.opened = shard.all = 0
        ids, score = shard.top(which, 10)  # no threshold yet: everything is opened
        assert shard.opened == shard.all
        shard.opened = shard.all = 0
        again, same = shard.top(which, 10, float(score[-1]))
        assert again.tolist() == ids.tolist() and same.tolist() == score.tolist()
        assert shard.opened < 0.8 * shard.all  # blocks of other topics stay closed
        shard.opened = shard.all = 0
        none, _ = shard.top(which, 10, 1e6)
        assert not len(none) and shard.opened == shard.all == 0  # the whole shard is skipped


def test_many_long_queries_meet_a_shard_together():
    """The best of each query as by a plain scan, in less than half the time that
    the queries take one by one."""
    rng = np.random.default_rng(3)
    share = 1 / np.arange(1, 5001) ** 0.9
    texts = [" ".join(f"w{w}" for w in rng.choice(5000, 120, p=share / share.sum())) for _ in range(1100)]
    texts[7::100] = [texts[1]] * len(texts[7::100])  # ties
    shard, vocabulary = shard_of(texts, search.BLOCK_BITS)
    asked = [shard.places(np.unique(np.array([vocabulary[w] for w in set(words(t))], np.uint64))) for t in texts[1::6]]
    ends = np.concatenate([[0], np.cumsum([len(a) for a in asked])])
    best, low = {}, np.zeros(len(asked))
    began = time.process_time()
    shard.search(np.concatenate(asked), ends, 10, low, best, np.arange(len(asked))[::-1])
    took, began = time.process_time() - began, time.process_time()
    alone = [shard.top(which, 10) for which in asked]
    assert took < (time.process_time() - began) / 2
    again = {}
    shard.search(np.concatenate(asked), ends, 10, low.copy(), again, np.arange(len(asked)))  # with thresholds
    by_term = np.argsort(shard.own_term, kind="stable")
    docs, impact = np.repeat(np.arange(len(texts)), np.diff(shard.own_start))[by_term], shard.own_impact[by_term]
    starts = np.concatenate([[0], np.cumsum(np.bincount(shard.own_term))])
    for q, which in enumerate(asked):
        at = search.runs(starts, which)
        score = np.round(np.bincount(docs[at], impact[at], len(texts)), search.DECIMALS)
        want = np.lexsort((np.arange(len(texts)), -score))[:10]
        for ids, found in (best[q], again[q], alone[q]):
            assert ids.tolist() == want.tolist() and found == pytest.approx(score[want], abs=1e-8)
        assert low[q] == best[q][1][-1]


# op8, op9


@pytest.fixture(scope="module")
def model():
    return pieces.read_model()


def test_viterbi_equals_the_tokenizer(model):
    m = pieces.parse(model)
    m.kind = pieces.UNIGRAM
    theirs, ours = pieces.backend(m), viterbi.Automaton(m)
    texts = [t or "" for _, t in corpus()] + ["\u65e5\u672c\u8a9e \u2713\u2713 x", "a\x00b  c\x01", "\u2581x\u2581\u2581", "  lead", "trail  "]
    found, sizes = viterbi.segments(pa.array(texts), m)
    count = ours.counts([w.encode() for w in found.to_pylist()])
    ends = np.cumsum(sizes)
    got = [int(count[e - s : e].sum()) for e, s in zip(ends, sizes)]
    assert got == [len(ids) for ids in pieces.encoder(theirs, m)(texts)]


def test_viterbi_ties_and_unknown_runs():
    """Against a plain dynamic programme, without byte fallback and with ties."""
    m = pieces.Model(["<unk>", "a", "b", "ab", "ba", "aba", "bb"], [0, -1, -1, -2, -2, -3, -1.5], [2, 1, 1, 1, 1, 1, 1])
    a, rng = viterbi.Automaton(m), random.Random(2)
    score = dict(zip(m.pieces, m.scores))

    def by_hand(w):
        best = [(0.0, 0, False)] + [None] * len(w)
        for start in range(len(w)):
            s, n, lone = best[start]
            single = False
            for end in range(start + 1, len(w) + 1):
                if w[start:end] in score:
                    single |= end == start + 1
                    if best[end] is None or s + score[w[start:end]] > best[end][0]:
                        best[end] = (s + score[w[start:end]], n + 1, False)
            if not single and (best[start + 1] is None or s + a.unknown > best[start + 1][0]):
                best[start + 1] = (s + a.unknown, n + (not lone), True)
        return best[-1][1]

    some = ["".join(rng.choices("abc\u00e9", k=rng.randint(1, 12))) for _ in range(300)]
    assert a.counts([w.encode() for w in some]).tolist() == [by_hand(w) for w in some]


def proto(number, value):
    """A field of a protobuf message."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])

    if isinstance(value, int):
        return varint(number << 3) + varint(value)
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    return varint(number << 3 | 2) + varint(len(value)) + value


def unigram_model(fallback, charsmap=b"", extra_spaces=False):
    """A small true unigram model, with many ways to cut a word and ties."""
    some = ["\u2581", "a", "b", "c", "d", "e", "ab", "ba", "abc", "cd", "de", "cde", "\u2581a", "\u2581ab", "\u2581th", "th", "he", "the", "\u2581the", "\u00e9", "1", "2", "12", "t", "h", "o", "f"]
    rng = random.Random(4)
    pieces_ = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)]
    pieces_ += [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)] * fallback
    pieces_ += [(p, -2.0 * len(p) if len(p) > 1 and i % 2 else -rng.choice([2, 3, 4.5, 5.25]), 1) for i, p in enumerate(some)]
    body = b"".join(proto(1, proto(1, p.encode()) + proto(2, float(s)) + proto(3, t)) for p, s, t in pieces_)
    trainer = proto(3, 1) + proto(35, int(fallback)) + proto(40, 0) + proto(41, 1) + proto(42, 2) + proto(43, (1 << 64) - 1)
    normal = proto(2, charsmap) + proto(3, 1) + proto(4, int(extra_spaces)) + proto(5, 1)
    return body + proto(2, trainer) + proto(3, normal)


def charsmap():
    import sentencepiece

    n = sentencepiece.SentencePieceNormalizer(rule_name="nfkc")
    return next(v for k, v in pieces._fields(dict(pieces._fields(n.serialized_model_proto()))[3]) if k == 2)


@pytest.mark.parametrize("fallback", [True, False])
@pytest.mark.parametrize(("mapped", "extra"), [(False, False), (True, True)])
def test_true_unigram_models(docs_of, fallback, mapped, extra):
    """Counts and ids against the sentencepiece library itself."""
    import sentencepiece

    data = unigram_model(fallback, charsmap() if mapped else b"", extra)
    theirs = sentencepiece.SentencePieceProcessor(model_proto=data)
    rng = random.Random(6)
    texts = ["".join(rng.choices(["a", "b", "c", "d", "e", "the", " ", "  ", "\u00e9", "z", "q", "12", "\u65e5"], k=rng.randint(0, 30))) for _ in range(300)]
    texts += ["", " ", "the the", "abcde" * 200, "\ufb01 \u2460", "zzzz", " z z ", "a" * 3000]
    rows = list(enumerate(texts)) + [(9999, None)]
    want = {i: theirs.encode(t or "") for i, t in rows}
    assert {r.doc_id: r.ids for r in pieces.encode(docs_of(rows), data).collect()} == want
    assert {r.doc_id: r.n_tokens for r in viterbi.token_counts(docs_of(rows), data).collect()} == {i: len(x) for i, x in want.items()}


def test_viterbi_one_by_one_and_together():
    """The same counts from arrays and word by word; bounded arrays."""
    m = pieces.parse(unigram_model(True))
    a, rng = viterbi.Automaton(m), random.Random(9)
    some = ["".join(rng.choices("abcde\u00e9zth", k=rng.randint(1, 40))).encode() for _ in range(200)]
    assert a.counts(some).tolist() == [a._one(w) for w in some]
    began = time.time()
    a.counts([*some, b"abcde" * 200_000, "\u65e5".encode() * 100_000])
    assert time.time() - began < 40


def test_token_counts_query(docs):
    got = viterbi.token_counts(docs)
    assert got.count() == len(corpus())
    assert {r.n_tokens for r in got.collect() if r.doc_id in (60, 61)} == {0}
    assert viterbi.token_counts(docs.limit(0)).count() == 0


def test_sentencepiece_parity_and_round_trip(docs, model):
    import sentencepiece

    theirs = sentencepiece.SentencePieceProcessor(model_proto=model)
    got = pieces.encode(docs)
    texts = {i: t or "" for i, t in corpus()}
    rows = got.collect()
    assert len(rows) == len(corpus())
    for r in rows:
        assert r.ids == theirs.encode(texts[r.doc_id]) and r.n_tokens == len(r.ids) and r.restored
    assert {(r.doc_id, r.text) for r in pieces.decode(got).collect()} == set(texts.items())
    assert pieces.encode(docs.limit(0)).count() == 0


def test_model_parser(model):
    m = pieces.parse(model)
    assert (len(m.pieces), m.kind, m.byte_fallback, m.dummy_prefix, m.extra_spaces) == (32000, pieces.BPE, True, True, False)
    with pytest.raises(ValueError):
        pieces.parse(b"\x0f")


# op10


def test_simhash(docs, monkeypatch):
    rows = corpus()

    def by_hand(text):
        w = words(text)
        grams = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] if len(w) > 2 else [b" ".join(w)] if w else []
        hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
        return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs)) if hs else 0

    codes = [(i, by_hand(t)) for i, t in rows]
    group = {c: c for _, c in codes}
    for _ in group:
        for a in group:
            for b in group:
                if (a ^ b).bit_count() <= 2:
                    group[a] = group[b] = min(group[a], group[b])
    least = {}
    for i, c in codes:
        least.setdefault(group[c], []).append(math.inf if i is None else i)
    want = Counter((i, format(c, "016x"), min(least[group[c]])) for i, c in codes)
    for size in (1 << 16, 4):
        monkeypatch.setattr(simhash, "RANGE_CODES", size)
        got = simhash.near_duplicates(simhash.fingerprints(docs)).withColumn("hex", simhash.as_hex(F.col("code"))).collect()
        assert Counter((r.doc_id, r.hex, math.inf if r.component_id is None else r.component_id) for r in got) == want
    assert simhash.near_duplicates(simhash.fingerprints(docs.limit(0))).count() == 0


def test_gray_index_finds_all():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40).astype(np.uint64)
    codes = np.unique(np.concatenate([base, base ^ np.uint64(5), base ^ np.uint64(1 << 63), rng.integers(0, 2**63, 500).astype(np.uint64)]))
    found = {(int(a), int(b)) for q, at in simhash.GrayIndex(codes).search(codes, 2) for a, b in zip(q, at)}
    want = {(i, j) for i in range(len(codes)) for j in range(len(codes)) if int(codes[i] ^ codes[j]).bit_count() <= 2}
    assert found == want


def test_hot_codes_and_hubs(spark, docs_of, monkeypatch):
    """Groups of copies and near copies, with every join split for hot keys."""
    monkeypatch.setattr(common, "HOT_ROWS", 5)
    monkeypatch.setattr(common, "SALTS", 4)
    monkeypatch.setattr(simhash, "RANGE_CODES", 40)
    rng = random.Random(8)
    base = [rng.choice("abcdefgh") * 2 + str(rng.randrange(99)) for _ in range(300)]
    rows = [(i, " ".join(base)) for i in range(120)]
    for i in range(120, 320):
        text = list(base)
        text[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(rng.choices(base, k=30))) for i in range(320, 360)]
    spark.conf.set("spark.sql.shuffle.partitions", "31")
    try:
        got = {r.doc_id: r.component_id for r in simhash.near_duplicates(simhash.fingerprints(docs_of(rows)).repartition(7)).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    codes = [simhash.simhash((t or "").encode()) for _, t in rows]
    label = {i: i for i, _ in rows}
    for _ in range(20):
        for i, a in enumerate(codes):
            label[i] = min(label[j] for j, b in enumerate(codes) if (a ^ b).bit_count() <= 2)
    assert got == label and len(set(label[i] for i in range(120))) == 1


def test_connected(spark):
    rng = random.Random(4)
    links = [(rng.randrange(200), rng.randrange(200)) for _ in range(120)] + [(i, i + 1) for i in range(300, 340)] + [(-5, 300)]
    got = {r.node: r.root for r in simhash.connected(spark.createDataFrame(links, "a long, b long")).collect()}
    root = {x: x for pair in links for x in pair}
    for _ in root:
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(x, x) == root[x] for x in root)
