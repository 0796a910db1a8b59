"""Files to manifest, previews and labels, end to end on a small folder."""

import pandas as pd
import pytest
from pyspark.sql import functions as F
from quern.plans import pipelines
from quern.sources import sinks, tables
from quern.sources.files import build_manifest, plain_manifest, scan_files
from quern.sources.readers import Readers


def folder(tmp_path):
    root = tmp_path / "data"
    for path, body in {
        "mail/a.txt": b"hello world, this is a text of more than fifty characters\r\nindeed",
        "mail/copy.TXT": b"hello world, this is a text of more than fifty characters\r\nindeed",
        "mail/latin.md": b"caf\xe9",
        "mail/._x.txt": b"no", "__MACOSX/y.txt": b"no", "mail/.DS_Store": b"no", "mail/z.xyz": b"no",
        "scan/p.pdf": b"%PDF", "img/i.png": b"no image", "top.docx": b"zip",
    }.items():
        (root / path).parent.mkdir(parents=True, exist_ok=True)
        (root / path).write_bytes(body)
    return str(root)


def test_manifest(spark, tmp_path):
    manifest = build_manifest(scan_files(spark, folder(tmp_path))).cache()
    got = {r.rel_path: r for r in manifest.collect()}
    assert set(got) == {"mail/a.txt", "mail/copy.TXT", "mail/latin.md", "scan/p.pdf", "img/i.png", "top.docx"}
    a = got["mail/a.txt"]
    assert (a.doc_family, a.encoding, a.extraction_method, a.n_lines, a.text_usable_now) == ("text", "utf-8", "textlike", 2, True)
    assert a.doc_id == a.sha256[:24] == got["mail/copy.TXT"].doc_id and "\\r\n" in a.preview
    odd = got["mail/latin.md"]
    try:  # the detector's best guess where there is one
        from charset_normalizer import from_bytes

        best = from_bytes(b"caf\xe9").best()
        assert (odd.preview, odd.encoding) == (str(best), f"cn:{best.encoding}")
    except ImportError:
        assert (odd.preview, odd.encoding) == ("café", "latin-1")
    assert got["scan/p.pdf"].extraction_method == "pdf_no_text" and got["scan/p.pdf"].ocr_error and got["scan/p.pdf"].text_missing
    assert got["img/i.png"].extraction_method == "image_meta_only" and got["top.docx"].source_root == "top.docx"

    tables.write_manifest(manifest, str(tmp_path / "m"))
    tables.write_previews(manifest, str(tmp_path / "p"))
    previews = tables.read_previews(spark, str(tmp_path / "p"))
    assert previews.count() == 5 and tables.missing_previews(manifest, previews) == 0
    assert tables.with_previews(manifest.drop("preview"), previews).count() == 6
    found = pd.concat(pd.read_csv(f) for f in sorted((tmp_path / "m").glob("*.csv.gz")))
    assert found.rel_path.tolist() == sorted(got, key=lambda p: (p.split("/")[0], p))


def test_near_dedup_pipeline(spark):
    data = [(f"d{i}", f"s{i}", "root", f"root/{i:03}", "text", kind, text) for i, (kind, text) in enumerate([("x", "alpha beta gamma delta " * 5), ("x", "alpha beta gamma delta " * 5), (None, ""), (None, ""), ("y", "another text " * 9)])]
    manifest = spark.createDataFrame(data, "doc_id string, sha256 string, source_root string, rel_path string, doc_family string, human_doc_type string, preview string")
    groups, stats, every, corpus = pipelines.near_dedup(manifest)
    assert sorted((r.doc_id, r.near_dup_group) for r in groups.collect()) == [("d0", "g000000"), ("d1", "g000000"), ("d2", "g000001"), ("d3", "g000002"), ("d4", "g000003")]
    assert {r.near_dup_group: (r.group_size, r.doc_type) for r in stats.collect()}["g000000"] == (2, "x")
    assert every.count() == 5 and sorted(r.doc_id for r in corpus.collect()) == ["d0", "d2", "d3", "d4"]
    again = pipelines.near_dedup(corpus.drop("near_dup_group", "canonical_doc_id"))[3]
    assert again.count() == 4


def test_larger_groups_are_clustered_whole(spark):
    from quern.config import ClusterConfig
    from quern.operators.cluster import cluster_vectors

    one = spark.range(300).select(F.lit("g").alias("g"), F.col("id"), F.array(F.struct(F.when(F.col("id") % 2 == 0, "even").otherwise("odd").alias("term"), F.lit(1.0).alias("weight")), F.struct(F.concat(F.lit("t"), F.col("id") % 7).alias("term"), F.lit(0.2).alias("weight"))).alias("vector"))
    found = cluster_vectors(one, "g", "id", ClusterConfig(svd_components=None, umap_dim=2, fit_rows=120)).collect()
    assert sorted(r.id for r in found) == list(range(300))


def test_large_null_group_is_whole(spark):
    """Rows beyond the fitted ones come back for a null group as for any other."""
    from quern.config import ClusterConfig
    from quern.operators.cluster import cluster_vectors, svd_vectors

    data = [(g, i + 100 * k, [(f"t{i % 4}", 0.8), (f"u{i % 7}", 0.6)]) for k, g in enumerate((None, "en", "")) for i in range(50)]
    vecs = spark.createDataFrame(data, "g string, id long, vector array<struct<term:string,weight:double>>")
    want = sorted((r[0], r[1]) for r in [(g or str(g), i) for g, i, _ in data])
    for found in (svd_vectors(vecs, "g", "id", 3, fit_rows=20), cluster_vectors(vecs, "g", "id", ClusterConfig(svd_components=None, umap_dim=2, fit_rows=20))):
        assert sorted((r.group or str(r.group), r.id) for r in found.collect()) == want


def test_row_without_common_terms_is_noise():
    import numpy as np
    import pyarrow as pa
    from quern.config import ClusterConfig
    from quern.operators.cluster import _assign

    class Shared:
        value = {"g": {"vector": [[{"term": "a", "weight": 1.0}]], "label": np.array([0]), "prob": np.array([1.0]), "coords": np.zeros((1, 2))}}

    vectors = [[{"term": "a", "weight": 1.0}], [{"term": "b", "weight": 1.0}], []]
    batch = pa.RecordBatch.from_arrays([pa.array(["g"] * 3), pa.array([1, 2, 3]), pa.array(vectors, pa.list_(pa.struct([("term", pa.string()), ("weight", pa.float64())])))], names=["group", "id", "vector"])
    (out,) = _assign(Shared, ClusterConfig())(iter([batch]))
    assert out["label"].to_pylist() == [0, -1, -1] and out["prob"].to_pylist() == [1.0, 0.0, 0.0]


def test_embedding_queries_use_the_production_settings(spark, sf_dir, monkeypatch):
    from quern.config import ClusterConfig
    from quern.plans import queries

    asked = []

    def stop(*args):
        asked.append(args[3])
        raise InterruptedError

    for name, query in (("svd_vectors", queries.svd_embed), ("cluster_vectors", queries.umap_embed)):
        monkeypatch.setattr(queries.C, name, stop)
        with pytest.raises(InterruptedError):
            query(spark, sf_dir)
    assert asked == [ClusterConfig().svd_components, ClusterConfig()]


def _readers(calls):
    """Stand-ins of the optional libraries; made in here, so that workers need not import this file."""

    class Broken(Exception):
        pass

    def pdf(pages, chars):
        def read(raw):
            if raw.startswith(b"bad"):
                raise Broken("no pdf")
            return {"text": raw.decode(), "pages": pages, "error": ""}

        return read

    def ocr(dpi):
        def read(raw):
            with open(calls, "ab") as f:
                f.write(b"x")
            if raw.startswith(b"bad"):
                raise Broken("no picture")
            return {"text": f"seen {dpi} " + raw.decode(), "error": ""}

        return read

    def image(raw):
        if raw.startswith(b"bad"):
            raise Broken("no image")
        return {"width": len(raw), "height": None, "format": "F", "mode": "RGB"}

    return {"pdf": pdf, "ocr": ocr, "image": image}


def test_broken_files_and_the_cache_of_ocr(spark, tmp_path):
    """A file that cannot be read is an error in its own row; no text of the cache is read again."""
    root, calls = tmp_path / "data", tmp_path / "calls"
    root.mkdir()
    for name, body in {"bad.pdf": b"bad", "short.pdf": b"short", "copy.pdf": b"short", "long.pdf": b"long enough to need no look at its picture", "i.png": b"1234", "j.png": b"bad!"}.items():
        (root / name).write_bytes(body)
    readers = Readers(**_readers(str(calls)), ocr_missing=lambda: "")
    files = scan_files(spark, str(root))
    for _ in range(2):
        got = {r.rel_path: r for r in build_manifest(files, ocr_cache=str(tmp_path / "cache"), readers=readers).collect()}
        assert got["short.pdf"].preview == "short\n\nseen 200 short" == got["copy.pdf"].preview and got["short.pdf"].ocr_error == ""
        assert got["short.pdf"].extraction_method == "pdf_text+pdf_ocr_first_page" and got["short.pdf"].pdf_page_count == 2
        assert got["long.pdf"].extraction_method == "pdf_text_only"
        assert (got["bad.pdf"].preview, got["bad.pdf"].ocr_error, got["bad.pdf"].pdf_page_count) == ("", "ocr_pdf_failed:Broken:no picture", 0)
        assert (got["i.png"].img_width, got["i.png"].img_height, got["i.png"].img_format) == (4, None, "F") and got["j.png"].img_width is None
    assert calls.stat().st_size == 3  # both files once, the broken one again: only texts are kept
    none = Readers(**_readers(str(calls)), ocr_missing=lambda: "tesseract_binary_not_found")
    got = {r.rel_path: r.ocr_error for r in build_manifest(files, readers=none).collect()}
    assert got["short.pdf"] == "tesseract_binary_not_found" and got["long.pdf"] == ""


def test_readers_use_their_libraries(monkeypatch):
    import sys
    import types

    from quern.sources import readers as R

    class Page:
        def __init__(self, text):
            self.text = text

        def get_text(self, kind):
            return self.text

        def get_pixmap(self, dpi):
            return types.SimpleNamespace(tobytes=lambda kind: f"{self.text}@{dpi}".encode())

    class Doc(list):
        def __enter__(self):
            return self

        def __exit__(self, *_):
            self.clear()

    texts = {b"two": ["a ", "b", "c"], b"none": []}
    monkeypatch.setitem(sys.modules, "fitz", types.SimpleNamespace(open=lambda stream, filetype: Doc(map(Page, texts[stream]))))
    picture = types.SimpleNamespace(open=lambda file: file.read().decode())
    monkeypatch.setitem(sys.modules, "PIL", types.SimpleNamespace(Image=picture))
    monkeypatch.setitem(sys.modules, "pytesseract", types.SimpleNamespace(image_to_string=lambda image: f" {image} \n"))
    assert R.pdf_text(2, 100)(b"two") == {"text": "a \nb", "pages": 3, "error": ""}
    assert R.pdf_text(3, 2)(b"two")["text"] == "a" and R.pdf_text(2, 9)(b"none") == {"text": "", "pages": 0, "error": ""}
    assert R.first_page_ocr(150)(b"two") == {"text": "a @150", "error": ""} and R.first_page_ocr(150)(b"none")["error"] == "pdf_no_pages"
    assert R.no_pdf(b"", KeyError("x"))["error"] == "pdf_text_failed:KeyError"
    assert R.no_ocr(b"", ImportError(name="fitz"))["error"] == "pymupdf_missing" and R.no_ocr(b"", ImportError(name="PIL"))["error"] == "pytesseract_or_pillow_missing"


def test_plain_manifest(spark, tmp_path):
    import hashlib

    odd = {"a/x.txt": b"caf\xe9 \xff\xfe end", "mac/y.pdf": b"%PDF 1", "a/._z.txt": b"no", "w.docx": b"no", "b.md": ("\u00e9" * 60).encode()}
    for path, body in odd.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_bytes(body)
    got = {r.rel_path: r for r in plain_manifest(spark, str(tmp_path)).collect()}
    assert set(got) == {"a/x.txt", "mac/y.pdf", "b.md"}
    for path, r in got.items():
        text = odd[path].decode("utf-8", errors="replace")
        sha = hashlib.sha256(odd[path]).hexdigest()
        assert (r.preview, r.decode_replacements, r.n_chars, r.bytes_read_for_preview) == (text, text.count("\ufffd"), len(text), len(odd[path]))
        assert r.doc_id == hashlib.sha256(f"{path}|{sha}".encode()).hexdigest()[:24] and r.is_emptyish == (len(text) < 50)


def test_counters_and_timings(spark, tmp_path):
    from quern.operators.manifest import counted, distinct_values, timed

    timings = {}
    with timed(timings, "scan"):
        rows, told = counted(build_manifest(scan_files(spark, folder(tmp_path))))
        rows.write.parquet(str(tmp_path / "out"))
    assert told.get == {"rows": 6, "text_rows": 2, "empty_rows": 3, "ocr_errors": 1, "bytes": sum(f.stat().st_size for f in (tmp_path / "data").rglob("*") if f.is_file()) - 8}
    assert timings["scan"] > 0
    assert distinct_values(spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "g string"), "g").first().n_distinct == 2


def test_sinks(spark, tmp_path):
    """Each written table comes back in its order, arrays as JSON, commas and line breaks whole."""
    files = spark.createDataFrame([("b", None, 'x,"y"\nz', ["p"]), ("a", "r2", "t", []), ("a", "r1", None, None)], "source_root string, rel_path string, preview string, paths array<string>")
    means = spark.createDataFrame([("c0000", 3, 0.5), ("noise", 9, 1.5)], "docform_cluster string, n_docs long, n_chars double")
    samples = spark.createDataFrame([("c0001", 2, "tab\tin"), ("c0001", 1, "x")], "docform_cluster string, place int, preview_snip string")
    forms = spark.createDataFrame([("d1", [1.0, 2.0]), ("d0", None)], "doc_id string, form_coords array<float>")
    groups = spark.createDataFrame([("g000001", 2, "x"), ("g000000", 7, "y")], "near_dup_group string, group_size long, doc_type string")
    given = {name: files for name, sink in sinks.SINKS.items() if sink.order == ("source_root", "rel_path")}
    given |= {"docform_cluster_feature_means": means, "docform_cluster_samples": samples, "near_dup_group_stats": groups, "umap_embedding": sinks.coordinates(forms, "form_coords", "umap_", 2, ("doc_id",))}
    paths = sinks.write_tables(given, str(tmp_path))
    assert {p.split("/")[-1] for p in paths.values()} == set(given)
    read = lambda name, **k: pd.concat(pd.read_csv(f, **k) for f in sorted((tmp_path / name).glob("part-*")))
    for name in ("manifest_dedup", "corpus_canonical", "manifest_with_doc_types"):
        found = read(name)
        assert found.source_root.tolist() == ["a", "a", "b"] and found.rel_path.tolist()[:2] == ["r1", "r2"]
        assert found.preview.tolist()[2] == 'x,"y"\nz' and found.paths.tolist()[1:] == ["[]", '["p"]']
    assert read("docform_cluster_feature_means").docform_cluster.tolist() == ["noise", "c0000"]
    assert read("docform_cluster_samples", sep="\t").preview_snip.tolist() == ["x", "tab\tin"]
    assert read("near_dup_group_stats").group_size.tolist() == [7, 2]
    assert read("umap_embedding").values.tolist() == [["d1", 1.0, 2.0]]
    with pytest.raises(KeyError):
        sinks.write_tables({"unknown": files}, str(tmp_path))


def test_tables_by_type_and_tsv(spark, tmp_path):
    df = spark.createDataFrame([("x", 1), ("y", 2), ("x", 3)], "human_doc_type string, n long")
    tables.write_by_type(df, str(tmp_path / "t"))
    assert sorted(map(tuple, tables.read_by_type(spark, str(tmp_path / "t")).select("human_doc_type", "n").collect())) == [("x", 1), ("x", 3), ("y", 2)]
    (tmp_path / "a.tsv").write_text('a\tb\n1\t"two\nlines"\n2\t\n')
    assert [tuple(r) for r in tables.read_csv(spark, str(tmp_path / "a.tsv"), "a long, b string", "\t").collect()] == [(1, "two\nlines"), (2, None)]


def test_wordlist(tmp_path):
    from quern.functions.wordlists import load_wordlist

    (tmp_path / "w.txt").write_text(" One \n# no\n\ntwo\n")
    assert load_wordlist(str(tmp_path / "w.txt")) == ["one", "two"] and load_wordlist(str(tmp_path / "w.txt"), lower=False) == ["One", "two"] and load_wordlist(None) == []
    with pytest.raises(FileNotFoundError):
        load_wordlist(str(tmp_path / "none.txt"))
