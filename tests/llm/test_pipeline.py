import corpus_pipeline
from quarry.llm import decontaminate, packing, secret_scan, simhash, toxicity

SF = "/root/testdata/sf0.001"


def test_stages_filter_as_their_operators_say(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    first = docs.collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash", "decontamination", "secrets", "packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        if name != "packing":
            assert docs.columns == columns
        kept[name] = (before, docs)
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}

    before, after = kept["toxicity"]
    scores = toxicity.toxicity(before, spark.read.parquet(f"{SF}/labels.parquet")).collect()
    assert ids(after) == {r.doc_id for r in scores if r.predicted == 0}

    before, after = kept["simhash"]
    groups = {}
    for r in before.collect():
        groups.setdefault(simhash.simhash(r.text), []).append(r.doc_id)
    keys, parent = sorted(groups), {}
    find = lambda v: v if parent.get(v, v) == v else find(parent[v])
    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= 4 and find(a) != find(b):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    classes = {}
    for k, members in groups.items():
        classes.setdefault(find(k), []).extend(members)
    assert ids(after) == {min(m) for m in classes.values()} and after.count() == len(classes)

    before, after = kept["decontamination"]
    hit = {r.doc_id for r in decontaminate.find_overlaps(before, spark.read.parquet(f"{SF}/benchmark.parquet")).collect()}
    assert ids(after) == ids(before) - hit

    before, after = kept["secrets"]
    texts = {r.doc_id: r for r in before.collect()}
    for r in after.collect():
        assert r.text == secret_scan.redact(texts[r.doc_id].text) and r.n_chars == len(r.text)
        assert not [k for k, _, _ in secret_scan.find_spans(r.text) if k in ("access", "hex")]
    assert ids(after) == ids(before)

    before, after = kept["packing"]
    assert ids(after) == ids(before) and {r.offset for r in after.collect()} >= {0}
    total = corpus_pipeline.run(spark, SF)
    assert total.columns == after.columns and total.count() == after.count()
    assert len(first) >= after.select("doc_id").distinct().count()


def test_stages_bear_odd_rows(spark, tmp_path):
    rows = [(1, None, "en", "s", None, 0), (1, "", "en", "s", 0, 0), (None, "idiot text", None, None, 5, 1),
            (2, "the same words in a row", "en", "s", 23, 1), (2, "the same words in a row", "en", "s", 23, 1),
            (3, "the same words in a row", "en", "s", 23, 1), (None, "password=abcdefghijkl and so on", "en", "s", 1, 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, fp long")
    for docs, most in ((df, 4), (df.limit(0), 0)):
        for name, stage in corpus_pipeline.STAGES:
            path = f"{tmp_path}/{most}{name}"
            stage(spark, docs, SF).write.parquet(path)
            before, docs = docs, spark.read.parquet(path)
            if name != "packing":
                assert docs.columns == df.columns
            if name == "simhash":
                assert docs.count() <= most
                assert docs.where("text like 'the same%'").count() == min(most, 1)
