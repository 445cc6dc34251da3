"""The corpus on disk: scan, parse, package, guard and stream."""

import hashlib
import http.server
import json
import tarfile
import threading
import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo

from tesselorn import __main__ as cli
from tesselorn.functions import lenient, paths
from tesselorn.operators import delivery, features, ingest, layout, parse, release, stats, unseal
from tesselorn.plans import registry, synth
from tesselorn.sources import corpus as corpus_source
from tesselorn.streaming import ingest as streams

ONE = b'<?xml version="1.0"?>\n<flame name="electricsheep.244.7" nick="n" estimator_radius="nan"><xform weight="0.5" linear="1" coefs="1 0 0 1 0 -6"/><xform weight="nan" spherical="1" blur="1"/><finalxform julia="1" coefs="1 0 0 1 0 0"/></flame>'
TWO = b'<flame name="electricsheep.244.7"><xform linear="1"/></flame><flame name="electricsheep.244.9"><xform tan="1"/></flame>'


def put(root, gen, sid, data):
    f = root / str(gen) / "00000" / f"electricsheep.{gen}.{sid:05d}.flam3"
    f.parent.mkdir(parents=True, exist_ok=True)
    f.write_bytes(data)


@pytest.fixture
def corpus(tmp_path):
    root = tmp_path / "corpus"
    put(root, 244, 7, ONE)
    put(root, 244, 8, TWO)
    put(root, 244, 10, b"")
    put(root, 247, 3, b"<flame><xform tan='1'/></flame> junk")
    (root / "244" / "missing.txt").write_text("11\n\n12\n")
    with zipfile.ZipFile(root / "244" / "00000-09999.zip", "w") as z:
        z.writestr("electricsheep.244.00007.flam3", b"<flame/>")
        z.writestr("electricsheep.244.00020.flam3", b"<flame/>")
    return root


@pytest.mark.parametrize(
    "raw, kind, error",
    [
        (ONE, "genome", None), (TWO, "animation", None), (b"", "corrupt", "zero-byte"), (b'<?xml version="1.0"?> ', "corrupt", "empty-after-decl"),
        (b"<flame/> tail", "corrupt", "junk-after-document"), (b"<a/>", "corrupt", "no-flame-in-a"), (b"x", "corrupt", "no-flame-elements"),
        (b"<get><flame/></get>", "genome", None), (b'<!DOCTYPE f [<!ENTITY a "b">]><flame name="&a;"/>', "corrupt", "parse"),
    ],
)
def test_classify(raw, kind, error):
    found = parse.classify(raw)
    assert found[0] == kind and (found[1] is None if error is None else found[1].startswith(error))


def test_shape_needs_no_features(spark, monkeypatch):
    """The shape of a corpus without an index makes none, and is the index's."""
    raw = [ONE, TWO, b"", None, b"<flame/> tail", b"<a/>", b"x", b"<get><flame/><flame/></get>", b"<get><flame/></get>", b"<x><flame></x>", b'<!DOCTYPE f [<!ENTITY a "b">]><flame name="&a;"/>', b'<flame xmlns="u"/>', b'<a:flame xmlns:a="u"/>', b"<a><a:flame/></a>", b"<flame><flame/></flame>", b"<flame/>" * 3 + b"\xff"]
    docs = spark.createDataFrame([(240 + i % 2, i, r, False) for i, r in enumerate(raw)], "gen int, sheep_id long, content binary, sealed boolean")
    for x in raw:
        assert parse.classify(x or b"", parse.outline)[:3] == parse.classify(x or b"")[:3]
        assert (parse.manifest_flames(x or b"", parse.outline) is None) == (parse.manifest_flames(x or b"") is None)
    want = sorted(tuple(r) for r in features.records(parse.parsed(docs)).select("gen", "byte_size", "kind").collect())
    assert sorted(tuple(r) for r in parse.kinds(docs).collect()) == want
    assert "genome" not in parse.parsed(docs, genome=False).columns and "wrapped" not in parse.parsed(docs, wrapped=False).columns

    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(synth, "_key", lambda *_: "no index of this name")
    monkeypatch.setattr(features, "records", lambda _: pytest.fail("makes all features"))
    got = sorted(map(str, registry.corpus_shape(spark, sf).collect()))
    monkeypatch.undo()
    assert got == sorted(map(str, stats.corpus_shape(synth.stored_records(spark, sf)).collect()))


def test_made_documents_are_dealt_once(spark):
    """Texts are made after the tables are dealt by key: no text is sent again, or broadcast."""
    sent = synth.documents(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" not in sent
    lines = [x for x in sent.splitlines() if "Exchange hashpartitioning" in x]
    assert len(lines) == 2 and all("orderkey" in x for x in lines)
    under = sent.splitlines()[sent.splitlines().index(lines[-1]) + 1 :]
    assert not any("<xform" in x for x in under)


def test_line_ends(spark):
    docs = spark.createDataFrame([(1, b"a\r\nb\rc\nd"), (2, b"a\nb"), (3, b"\xff\r"), (4, None)], "sheep_id long, content binary")
    assert {r.sheep_id: r.xml for r in delivery.readable(docs).collect() if r.xml is not None} == {1: "a\nb\nc\nd", 2: "a\nb"}


def test_windows_are_dealt_in_many_tasks(spark):
    """However few their bytes: Spark would merge these in a task or two."""
    texts = spark.range(400).selectExpr("int(240) as gen", "id * 256 as sheep_id", "string(id) as xml")
    packed = delivery.windows(texts).select("lo", "body", F.spark_partition_id().alias("task")).collect()
    assert sorted(r.lo for r in packed) == [i * 256 for i in range(400)]
    assert len({r.task for r in packed}) > 2 * spark.sparkContext.defaultParallelism
    assert all(delivery.from_body(bytes(r.body)) == {r.lo: str(r.lo // 256)} for r in packed)


def test_small_bodies_of_much_text(spark):
    """A batch of bodies whose texts are more than one array of texts can hold."""
    n, text = 2_200, "x" * 1_000_000
    bodies = spark.createDataFrame([(240, bytearray(delivery.body({7: text})))], "gen int, body binary").withColumn("n", F.explode(F.sequence(F.lit(1), F.lit(n)))).coalesce(1)
    got = delivery.unpacked(bodies.select("gen", "body")).agg(F.count("*").alias("rows"), F.sum(F.length("xml")).alias("chars"), F.min("sheep_id").alias("id")).first()
    assert (got.rows, got.chars, got.id) == (n, n * len(text), 7)


def test_numbers(spark):
    rows = spark.createDataFrame([("1_0",), ("1.5f",), (" 2 ",), ("nan",), (None,), ("1e3",), ("3.0",)], "t string")
    found = rows.select(lenient.to_float(F.col("t")).alias("f"), lenient.to_int(F.col("t")).alias("i")).collect()
    assert [str(r["f"]) for r in found] == ["10.0", "0.0", "2.0", "nan", "0.0", "1000.0", "3.0"]
    assert [r["i"] for r in found] == [10, 0, 2, 0, 0, 0, 0]


def test_scan_and_records(spark, corpus):
    raw = corpus_source.scanned(spark, str(corpus))
    assert sorted((r["gen"], r["sheep_id"], r["sealed"]) for r in raw.collect()) == [(244, 7, False), (244, 8, False), (244, 10, False), (244, 20, True), (247, 3, False)]
    r = {x["sheep_id"]: x for x in features.records(parse.parsed(raw)).collect()}
    assert r[7]["kind"] == "genome" and r[7]["xform_var_counts"] == [1, 2] and r[7]["variations"] == ["blur", "julia", "linear", "spherical"]
    assert r[7]["max_abs_affine_coef"] == 6.0 and r[7]["max_xform_weight"] == 0.5 and r[7]["has_nan_in_xforms"] and not r[7]["has_density_estimator"]
    assert r[8]["kind"] == "animation" and r[8]["frame_count"] == 2 and r[8]["nick"] is None
    assert r[10]["error"] == "zero-byte" and r[20]["xform_count"] == 0 and r[20]["mean_var_per_xform"] == 0.0


def test_varints_and_bodies():
    ids = [0, 1, 127, 128, 300, 100_000]
    assert delivery.unpack_ids(delivery.pack_ids([*ids, 300])) == ids
    assert delivery.unpack_ids(delivery.pack_ids([])) == []
    assert delivery.from_body(delivery.body({2: "é", 1: ""})) == {1: "", 2: "é"}
    with pytest.raises(ValueError):
        delivery.varints([-1])
    with pytest.raises(ValueError):
        delivery.from_varints(b"\x80")


def test_release(spark, corpus, tmp_path):
    out = tmp_path / "out"
    assert cli.main(["release-build", str(corpus), "--out", str(out), "--date", "2026-01-02"]) == 0
    index = json.loads((out / "index.json").read_text())
    assert [g["id"] for g in index["genomes"]] == ["244/00007", "244/00008", "244/00010", "244/00020", "247/00003"]
    with zipfile.ZipFile(out / "gen-244-2026-01-02.zip") as z:
        names = z.namelist()
        assert names[:2] == ["MANIFEST.csv", "missing.txt"] and len(names) == 6
        assert z.read("missing.txt") == b"11\n12\n" and z.read("MANIFEST.csv").count(b"\r\n") == 5
    assert (corpus / "_index" / "index.json").read_bytes() == (out / "index.json").read_bytes()
    with tarfile.open(out / "corpus-chunks-2026-01-02.tar") as t:
        assert t.getnames() == ["244/00000.flam3chunk", "244/avail.flam3idx", "247/00000.flam3chunk", "247/avail.flam3idx", "gens.json"]
        assert delivery.unpack_ids(t.extractfile("244/avail.flam3idx").read()) == [7, 8, 10]  # loose ones alone
        assert t.extractfile("gens.json").read().decode() == '{"schema": 2, "build_date": "2026-01-02", "chunk_size": 256, "kind": "all", "gens": [{"gen": 244, "count": 3, "min_id": 7, "max_id": 10}, {"gen": 247, "count": 1, "min_id": 3, "max_id": 3}]}'
        assert sorted(delivery.from_body(t.extractfile("244/00000.flam3chunk").read())) == [7, 8, 10]
        assert all(m.mtime == 0 for m in t.getmembers())
    with tarfile.open(out / "corpus-all-2026-01-02.tar.xz") as t, zipfile.ZipFile(out / "gen-244-2026-01-02.zip") as z:
        names = t.getnames()
        assert names[:7] == [f"244/{n}" for n in z.namelist()] + ["247/MANIFEST.csv"] and names[-2:] == ["_index/index.json", "_index/INDEX.md"]
        assert t.extractfile("244/MANIFEST.csv").read() == z.read("MANIFEST.csv")
        assert t.extractfile("_index/index.json").read() == (out / "index.json").read_bytes()
    report = (out / "INDEX.md").read_text()
    assert "## Variations" in report and "## Look-ups" in report and "| variation | genomes | variation | genomes |" in report
    (corpus / "ATTRIBUTION.md").write_text("who")
    made = release.build(spark, str(corpus), str(out / "again"), "2026-01-02", "http://l", "http://a", regen_index=False, skip_mega=True, skip_chunks=True)
    assert [p.rsplit("/", 1)[1] for p in made] == ["gen-244-2026-01-02.zip", "gen-247-2026-01-02.zip", "INDEX.md", "index.json", "ATTRIBUTION.md"]
    assert len(release.build(spark, str(corpus), str(out / "one"), "2026-01-02", "http://l", "http://a", only_gen=247)) == 1
    with pytest.raises(FileNotFoundError):
        release.build(spark, str(corpus), str(out), "2026-01-02", "http://l", "http://a", only_gen=9)


def test_chunk_input_and_genome_only_from_an_index_file(spark, corpus, tmp_path):
    """Two folders deep, ids of any width, the generation by the file's name; the
    index file says what is a genome, whatever the documents say."""
    (corpus / "244" / "x").mkdir()
    (corpus / "244" / "x" / "electricsheep.999.5.flam3").write_bytes(b"<flame/>")
    (corpus / "244" / "x" / "electricsheep.244.77.flam3").write_bytes(b"\xff\xfe")
    (corpus / "244" / "electricsheep.244.00078.flam3").write_bytes(b"<flame/>")  # one folder deep
    rows = corpus_source.scanned(spark, str(corpus), layout="delivery")
    assert sorted((r["gen"], r["sheep_id"]) for r in rows.collect()) == [(244, 7), (244, 8), (244, 10), (244, 77), (247, 3), (999, 5)]
    assert sorted(r["sheep_id"] for r in delivery.readable(rows).collect()) == [3, 5, 7, 8, 10]  # 77 is no UTF-8
    index = tmp_path / "index.json"
    index.write_text(json.dumps({"_schema_version": 6, "genomes": [{"gen": 244, "sheep_id": 8, "kind": "animation"}, {"gen": 247, "sheep_id": 3, "kind": "genome"}, {"gen": 244, "sheep_id": 10, "kind": "corrupt"}]}))
    assert cli.main(["chunk", str(corpus), "--out", str(tmp_path), "--date", "2026-01-02", "--genome-only", "--index", str(index)]) == 0
    with tarfile.open(tmp_path / "corpus-chunks-2026-01-02.tar") as t:
        assert json.loads(t.extractfile("gens.json").read())["kind"] == "genome"
        assert sorted(delivery.from_body(t.extractfile("244/00000.flam3chunk").read())) == [7, 9]  # both frames are orphans here
        assert sorted(delivery.from_body(t.extractfile("247/00000.flam3chunk").read())) == [3]
    with pytest.raises(FileNotFoundError):
        cli.main(["chunk", str(corpus), "--out", str(tmp_path), "--genome-only"])
    assert cli.main(["index", str(corpus), "--date", "2026-01-02"]) == 0
    assert cli.main(["chunk", str(corpus), "--out", str(tmp_path), "--date", "2026-01-03", "--genome-only"]) == 0
    with tarfile.open(tmp_path / "corpus-chunks-2026-01-03.tar") as t:
        assert sorted(delivery.from_body(t.extractfile("244/00000.flam3chunk").read())) == [7, 9]


def test_gather_takes_the_last_copy_and_warns(spark, corpus, caplog):
    (corpus / "244" / "00001").mkdir()
    (corpus / "244" / "00001" / "electricsheep.244.00007.flam3").write_bytes(b"<last/>")
    of = lambda layout: {r["sheep_id"]: bytes(r["content"]) for r in corpus_source.scanned(spark, str(corpus), **layout).where("gen = 244").collect()}
    assert of({})[7] == ONE and of({"layout": "gather"})[7] == b"<last/>" and of({"layout": "gather"})[20] == b"<flame/>"
    corpus_source.listing(str(corpus), 244, last=True)
    assert "loose files" in caplog.text


def test_filters_on_gen_reach_the_listing(spark, corpus):
    reader = corpus_source.CorpusReader({"path": str(corpus)})
    rest = list(reader.pushFilters([EqualTo(("gen",), 247), EqualTo(("sheep_id",), 3)]))
    assert len(rest) == 1 and reader.gen == 247 and [len(p.rows) for p in reader.partitions()] == [1]


def test_orphan_keyframes(spark, corpus):
    raw = corpus_source.scanned(spark, str(corpus))
    served = {r["sheep_id"]: r["xml"] for r in delivery.served(raw, features.records(parse.parsed(raw))).collect()}
    assert sorted(served) == [7, 9, 20] and "tan" in served[9] and "estimator_radius" in served[7]


def test_guards(spark, corpus):
    assert cli.main(["verify", str(corpus)]) == 0  # no baseline, no drift
    cli.main(["baseline", str(corpus)])
    assert cli.main(["verify", str(corpus)]) == 0
    text = (corpus / "_chunked-verified.json").read_text()
    assert json.loads(text) == {"schema": "v0.4", "gens": [{"bucket_count": 1, "gen": 244, "loose_count": 4, "missing_count": 2}, {"bucket_count": 1, "gen": 247, "loose_count": 1, "missing_count": 0}]}
    assert text.index("bucket_count") < text.index("gen\"") < text.index("loose_count") and text.index("gens") < text.index("schema") and text.endswith("}\n")
    (corpus / "247" / "00000" / "electricsheep.247.00003.flam3").unlink()
    assert cli.main(["verify", str(corpus)]) == 1
    for bad in ("5..5", "a..b", "3"):
        with pytest.raises(ValueError):
            ingest.parse_range(bad)
    with pytest.raises(ValueError):
        ingest.require_live(244)


def test_flat_files_and_lost_lists_are_faults(spark, corpus, capsys):
    flat = corpus / "244" / "electricsheep.244.00007.flam3"
    flat.write_bytes(b"<flame/>")  # a copy of one in its bucket: no count shrinks
    assert cli.main(["verify", str(corpus)]) == 1  # without a baseline
    assert "generation 244: flat_files was 0, is 1" in capsys.readouterr().out
    cli.main(["baseline", str(corpus)])
    assert cli.main(["verify", str(corpus)]) == 1
    flat.unlink()
    assert cli.main(["verify", str(corpus)]) == 0
    (corpus / "244" / "missing.txt").unlink()
    assert cli.main(["verify", str(corpus)]) == 1
    assert "generation 244: missing_count was 2, is 0" in capsys.readouterr().out
    files = ["244/electricsheep.244.00001.flam3", "244/electricsheep.245.00001.flam3", "244/00000/electricsheep.244.00002.flam3", "x/electricsheep.244.00003.flam3"]
    got = ingest.flat_residue(spark.createDataFrame([(f,) for f in files], "path string")).collect()
    assert [tuple(r) for r in got] == [(244, "flat_files", 0, 1)]


def sealed(root, gen, faulty=False):
    """A sealed generation with a true manifest, but for one hash if faulty."""
    folder = root / str(gen)
    folder.mkdir(parents=True)
    rows = {i: f"<flame name='{i}'/>".encode() for i in (1, 2, 10_003)}
    with zipfile.ZipFile(folder / "00000-19999.zip", "w") as z:
        lines = [f"{i},{hashlib.sha256(d if not (faulty and i == 2) else b'x').hexdigest()},{len(d)}" for i, d in rows.items()]
        z.writestr("MANIFEST.csv", "id,sha256,file_size_bytes\r\n" + "\r\n".join(lines) + "\r\n")
        z.writestr("notes.txt", "passed over")
        for i, d in rows.items():
            z.writestr(f"electricsheep.{gen}.{i:05d}.flam3", d)
    (folder / "missing.txt").write_text("5\n6\n")
    return rows


def test_unseal(spark, tmp_path, capsys):
    root = tmp_path / "corpus"
    rows = sealed(root, 244)
    (root / "245").mkdir()
    (root / "244" / "electricsheep.244.00002.flam3").write_bytes(b"newer")  # never clobbered
    assert cli.main(["unseal", str(root)]) == 0
    folder = root / "244"
    assert sorted(p.name for p in folder.iterdir()) == ["MANIFEST.csv", *[f"electricsheep.244.{i:05d}.flam3" for i in rows], "missing.txt"]
    assert (folder / "electricsheep.244.00002.flam3").read_bytes() == b"newer"
    (log,) = json.loads((root / "_unseal-verified.json").read_text())
    assert (log["gen"], log["loose_count"], log["missing_count"]) == (244, 3, 2) and log["snapshot_path"] == str(tmp_path / "build" / "v0.2-snapshot" / "gen-244.zip")
    assert unseal.Unsealing(spark, str(root), 244).run()["skipped"] and unseal.Unsealing(spark, str(root), 245).run()["loose_count"] == 0
    assert [tuple(r)[:2] for r in ingest.manifest(spark, str(folder / "MANIFEST.csv")).select("id", "file_size_bytes").orderBy("id").collect()] == [(i, len(d)) for i, d in rows.items()]
    assert cli.main(["verify-unseal", str(root)]) == 0
    (folder / "missing.txt").unlink()
    assert cli.main(["verify-unseal", str(root)]) == 1
    assert "generation 244: total was 5, is 3" in capsys.readouterr().out


@pytest.mark.parametrize("killed_in", ["extracted", "verified", "committed", "log"])
def test_unseal_goes_on_after_a_kill(spark, tmp_path, monkeypatch, killed_in):
    root = tmp_path / "corpus"
    rows = sealed(root, 244)
    with monkeypatch.context() as m:
        def killed(*_):
            raise KeyboardInterrupt

        m.setattr(unseal if killed_in == "log" else unseal.Unsealing, killed_in, killed)
        with pytest.raises(KeyboardInterrupt):
            unseal.Unsealing(spark, str(root), 244).run()
    if killed_in == "verified":  # a part of the members only: they are taken out again
        next((root / "244" / ".unseal-tmp").glob("*.flam3")).unlink()
    assert not unseal.Unsealing(spark, str(root), 244).run()["skipped"]
    assert {int(p.name.split(".")[2]): p.read_bytes() for p in (root / "244").glob("*.flam3")} == rows
    assert not (root / "244" / ".unseal-tmp").exists() and not (root / "244" / ".unseal-state").exists() and not list((root / "244").glob("*.zip"))


def test_unseal_faults(spark, tmp_path):
    root = tmp_path / "corpus"
    sealed(root, 244, faulty=True)
    with pytest.raises(RuntimeError, match="disagree"):
        unseal.Unsealing(spark, str(root), 244).run()
    assert (root / "244" / "00000-19999.zip").exists() and (root / "244" / ".unseal-tmp").exists()
    (root / "244" / "20000-29999.zip").write_bytes(b"")
    with pytest.raises(RuntimeError, match="several"):
        unseal.Unsealing(spark, str(root), 244)
    with pytest.raises(FileNotFoundError):
        unseal.Unsealing(spark, str(root), 9)
    (root / "244" / "20000-29999.zip").unlink()
    snapshot = tmp_path / "build" / "v0.2-snapshot" / "gen-244.zip"
    snapshot.write_bytes(b"another")
    with pytest.raises(RuntimeError, match="another archive"):
        unseal.Unsealing(spark, str(root), 244).run()
    (root / "244" / "00000-19999.zip").unlink()
    with pytest.raises(RuntimeError, match="without its archive"):
        unseal.Unsealing(spark, str(root), 244).run()


def test_absences(tmp_path):
    own = ingest.Absences(tmp_path / "247" / "missing.txt").load()
    assert len(own) == 0 and 3 not in own
    own.add(30)
    own.add(3)
    own.save()
    assert (tmp_path / "247" / "missing.txt").read_text() == "3\n30\n" and 3 in ingest.Absences(own.path).load()


def test_fetch_commands(spark, tmp_path, capsys):
    """Against a server on this machine."""
    answers = {"/gen/247/1/electricsheep.247.00001.flam3": b"<flame/>", "/gen/247/3/electricsheep.247.00003.flam3": b"<html/>"}

    class Handler(http.server.BaseHTTPRequestHandler):
        def do_GET(self):
            data = answers.get(self.path)
            self.send_response(404 if data is None else 200)
            self.end_headers()
            self.wfile.write(data or b"")

        def log_message(self, *_):
            pass

    with http.server.ThreadingHTTPServer(("127.0.0.1", 0), Handler) as server:
        threading.Thread(target=server.serve_forever, daemon=True).start()
        root = tmp_path / "corpus"
        more = ["--range", "1..4", "--delay", "0", "--jitter", "0", "--live-base", f"http://127.0.0.1:{server.server_port}"]
        assert cli.main(["fetch", str(root), "--gen", "247", *more]) == 0
        assert "'fetched': 1, 'missing': 1, 'transient': 1" in capsys.readouterr().out
        assert cli.main(["fetch-all", str(root), *more]) == 0
        said = capsys.readouterr().out
        assert "247 {'local': 1, 'known_missing': 1, 'fetched': 0" in said and "248 {'local': 0, 'known_missing': 0, 'fetched': 0, 'missing': 3" in said
        server.shutdown()
    assert (root / "ATTRIBUTION.md").exists() and (root / "247" / "missing.txt").read_text() == "2\n"
    assert (root / "247" / "00000" / "electricsheep.247.00001.flam3").read_bytes() == b"<flame/>"
    (root / "247" / "electricsheep.247.00009.flam3").write_bytes(b"<flame/>")
    assert cli.main(["fetch-all", str(root), *more]) == 1  # the guard comes first
    with pytest.raises(ValueError):
        cli.main(["fetch", str(root), "--gen", "244", *more])


def test_fetch(spark):
    present, gone = (spark.createDataFrame([(247, i)], "gen int, sheep_id long") for i in (1, 2))
    answers = {0: (200, b"<flame/>"), 3: (404, b""), 4: (200, b"<html/>"), 5: (503, b"")}
    kept, lost, naps = {}, [], []

    def get(i):
        if i == 6:
            raise OSError
        return answers[i]

    stats = ingest.fetch(ingest.plan(spark, 247, 0, 7, present, gone), get, kept.__setitem__, lost.append, sleep=naps.append)
    assert stats == {"local": 1, "known_missing": 1, "fetched": 1, "missing": 1, "transient": 3}
    assert list(kept) == [0] and lost == [3] and len(naps) == 5 and all(20 <= n <= 25 for n in naps)


def test_import_and_migrate(spark, corpus, tmp_path):
    source = tmp_path / "source"
    put(source, 244, 7, b"<flame/>")
    put(source, 244, 30, b"<flame/>")
    assert cli.bring_in(spark, str(corpus), str(source), None) == {"imported": 1, "skipped": 1, "remembered": 0}
    folder = corpus / "244" / "00000"
    assert (folder / "electricsheep.244.00030.flam3").exists() and (folder / "electricsheep.244.00007.flam3").read_bytes() == ONE
    flat = corpus / "244" / "electricsheep.244.12345.flam3"
    flat.write_bytes(b"<flame/>")
    again = corpus / "244" / "electricsheep.244.00007.flam3"
    again.write_bytes(b"<other/>")  # the copy in its bucket wins
    for legacy, more in (("00xxx", ".DS_Store"), ("01xxx", "keep.txt")):
        (corpus / "244" / legacy).mkdir()
        (corpus / "244" / legacy / more).write_text("")
    (corpus / "244" / "00xxx" / "electricsheep.244.00040.flam3").write_bytes(b"<flame/>")
    (corpus / "244" / "01xxx" / "electricsheep.244.01040.flam3").write_bytes(b"<flame/>")
    counts = {r["gen"]: r for r in layout.migrate(spark, str(corpus)).collect()}
    assert (counts[244]["moved"], counts[244]["already_chunked"], counts[244]["superseded"], counts[244]["bucket_count"]) == (3, 4, 1, 2)
    assert not flat.exists() and not again.exists() and (corpus / "244" / "10000" / flat.name).exists() and (folder / again.name).read_bytes() == ONE
    assert not (corpus / "244" / "00xxx").exists() and (corpus / "244" / "01xxx" / "keep.txt").exists()
    cli.main(["migrate", str(corpus)])
    assert (corpus / "_chunked-verified.json").exists() and cli.main(["verify", str(corpus)]) == 0
    assert {r["moved"] for r in layout.migrate(spark, str(corpus)).collect()} == {0}


def test_import_of_a_flat_source_with_a_side_file(spark, corpus, tmp_path):
    source = tmp_path / "flat"
    (source / "deep" / "9").mkdir(parents=True)
    for name in ("electricsheep.244.00007.flam3", "deep/9/electricsheep.244.00031.flam3", "electricsheep.244.32.flam3"):
        (source / name).write_bytes(b"<flame/>")
    (source / "_missing_404.txt").write_text("12\n 15 \n# note\n--5\n\n9\n")
    assert cli.main(["import", str(corpus), "--source", str(source)]) == 0
    folder = corpus / "244" / "00000"
    assert (folder / "electricsheep.244.00031.flam3").exists() and (folder / "electricsheep.244.00007.flam3").read_bytes() == ONE
    assert not list(corpus.rglob("electricsheep.244.32.flam3")) and not list(corpus.rglob("*00032*"))
    assert (corpus / "244" / "missing.txt").read_text() == "9\n11\n12\n15\n"
    with pytest.raises(FileNotFoundError):
        cli.main(["import", str(corpus), "--source", str(tmp_path / "nowhere")])


def test_unsealed(spark):
    sealed = spark.createDataFrame([(244, 1, b"a"), (244, 2, b"b")], "gen int, sheep_id long, content binary")
    manifest = sealed.select(F.col("sheep_id").alias("id"), F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("file_size_bytes"))
    loose = sealed.where("sheep_id = 1")
    assert [r["sheep_id"] for r in layout.unsealed(sealed, loose, manifest).collect()] == [2]
    with pytest.raises(ValueError):
        layout.unsealed(sealed, loose, manifest.where("id = 1"))


def test_names(spark):
    rows = spark.createDataFrame([("electricsheep.244.00007.flam3",), ("electricsheep.244.7.flam3",), ("electricsheep.244.123456.flam3",)], "n string")
    gen, sid = paths.parsed_name(F.col("n"))
    assert [tuple(r) for r in rows.select(gen, sid).collect()] == [(244, 7), (None, None), (244, 123456)]


def test_stream(spark, corpus, tmp_path):
    out = str(tmp_path / "records")
    for _ in range(2):  # a second run finds nothing new
        streams.run_once(spark, str(corpus), out, str(tmp_path / "state"))
    assert sorted(r["sheep_id"] for r in spark.read.parquet(out).collect()) == [3, 7, 8]
