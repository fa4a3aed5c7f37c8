from collections import defaultdict

import corpus_pipeline
from sheetloom.llm import decontamination, simhash_dedup, toxicity

SF_DIR = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "decontamination", "packing"]
    documents = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = {r.doc_id: r for r in documents.collect()}
    # a plain version of the filters
    predicted = {r.doc_id: r.predicted for r in toxicity.toxicity(
        documents, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()}
    kept = {i: r for i, r in rows.items() if not predicted[i]}
    marks = {i: simhash_dedup.fingerprint(r.text) for i, r in kept.items()}
    root = {i: i for i in kept}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(kept)
    for a in ids:
        for b in ids:
            if a < b and ((marks[a] ^ marks[b]) & 2**64 - 1).bit_count() <= 3:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    kept = {i: r for i, r in kept.items() if find(i) == i}
    leaks = {r.doc_id for r in decontamination.contaminated(
        spark.createDataFrame(list(kept.values()), documents.schema),
        spark.read.parquet(f"{SF_DIR}/benchmark.parquet")).collect()}
    kept = {i for i in kept if i not in leaks}

    docs = documents
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        assert docs.columns == documents.columns
    packed = corpus_pipeline.run(spark, SF_DIR).collect()
    assert {r.doc_id for r in docs.collect()} == {r.doc_id for r in packed} == kept
    pieces = defaultdict(int)
    for r in packed:
        pieces[r.sequence_id] += r.length
    assert max(pieces.values()) <= 2048


def test_registered():
    import __spark_entry__ as entry
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
