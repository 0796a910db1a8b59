"""The pipeline against its stages' brute force, and the driver's contract."""

import importlib

import corpus_pipeline
from llm_cases import rows, table


def test_stages_keep_the_columns(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near_dedup", "decontaminate", "mix_sources", "shard"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, sf_dir).columns == docs.columns, name


def test_run_equals_brute_force(spark, sf_dir):
    import test_decontaminate as d
    import test_minhash as m
    import test_mixing as x
    import test_quality as q
    import test_sharding as s
    from quern.llm.quality import judge

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    data = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id: r.good for r in judge(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")).collect()}
    kept = [i for i, r in data.items() if (b := q.brute(r.text))[0] >= 10 and 100 * b[4] <= 20 * b[0] and good[i] >= 0.25]
    groups = m.brute([(i, data[i].text) for i in kept], 5, 80)
    kept = [i for i in kept if groups[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    kept = [i for i, _, hit, _ in d.brute([(i, data[i].text) for i in kept], items) if not hit]

    got = corpus_pipeline.run(spark, sf_dir).collect()
    copies = {}
    for r in got:
        copies[r.doc_id] = copies.get(r.doc_id, 0) + 1
        assert r.text == data[r.doc_id].text
    assert set(copies) <= set(kept)
    sizes = {}
    for i in kept:
        sizes[data[i].source] = sizes.get(data[i].source, 0) + x.n_words(data[i].text)
    want = x.brute_targets(sizes)
    for source in sizes:
        own = [i for i in kept if data[i].source == source]
        taken = sum(copies.get(i, 0) * x.n_words(data[i].text) for i in own)
        assert abs(taken - float(want[source])) <= max(x.n_words(data[i].text) for i in own)
    s.check(got, len(got), 40)


def test_stages_on_odd_rows(spark, tmp_path):
    """Nulls, blanks, repeated rows and columns of clashing names go through all stages."""
    table(spark, rows()).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, "nothing of this occurs")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_registered_in_the_entry():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert "pipeline" in names
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 11)}
    assert set(entry.oracle_sql()) <= names
