"""The corpus pipeline end to end on the smallest tables, each stage against plain Python."""

import corpus_pipeline as cp
from test_near_dedup import brute_groups
from test_search_and_passages import brute_leaks

SF = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, out = docs.columns, {}
    kept = {None: {r["doc_id"]: r["text"] for r in docs.collect()}}
    for name, stage in cp.STAGES:
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        out[name] = docs.collect()
        kept[name] = {r["doc_id"]: r["text"] for r in out[name]}
        assert len(out[name]) == len(kept[name]) and docs.columns[:5] == columns
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    gone = set(kept[None]) - set(kept["toxicity"])
    assert len([d for d in gone if labels.get(d) == 0]) <= 2  # learned from 70 texts
    groups = brute_groups(sorted(kept["toxicity"].items()), k=5)
    assert set(kept["near_duplicates"]) == {d for d, (_, c) in groups.items() if d == c}
    before, after = kept["near_duplicates"], kept["repeated_passages"]
    assert set(before) == set(after) and all(len(after[d]) <= len(before[d]) for d in before)
    assert all(r["n_chars"] == len(r["text"]) for r in out["repeated_passages"] if after[r["doc_id"]] != before[r["doc_id"]])
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    leaks = {x[0] for x in brute_leaks(list(after.items()), items)}
    assert set(kept["decontamination"]) == set(after) - leaks
    assert kept["sentencepiece"] == kept["decontamination"] and all(r["exact"] for r in out["sentencepiece"])


def test_run_and_empty(spark, tmp_path):
    assert cp.run(spark, SF).count() > 100
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(str(tmp_path / f"{t}.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0
