"""The corpus pipeline, stage by stage, against what each operator decides on its input."""

import corpus_pipeline
from podium.llm import decontamination, jaccard, language_id, toxicity
from podium.llm.common import written
from tests.conftest import SMOKE
from tests.llm.test_jaccard import brute
from tests.llm.test_tokens import check_pieces


def test_stages(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        rows = before.collect()
        docs = written(stage(spark, before, SMOKE), name)
        ids = {r["doc_id"] for r in docs.select("doc_id").collect()}
        if name == "toxicity":
            labels = spark.read.parquet(f"{SMOKE}/labels.parquet")
            scored = toxicity.score(before, toxicity.train(before, labels)).collect()
            assert ids == {r["doc_id"] for r in scored if not r["predicted"]}
        elif name == "language_id":
            found = language_id.identify(before, language_id.train(before)).collect()
            assert ids == {r["doc_id"] for r in found if not r["rejected"]}
        elif name == "ngram_jaccard_join":
            classes = brute([(r["doc_id"], r["text"]) for r in rows])
            assert ids == {d for d, c in classes.items() if c[0] == d}
            assert jaccard.clean(docs).count() == len(ids)
        elif name == "benchmark_decontamination":
            items = spark.read.parquet(f"{SMOKE}/benchmark.parquet")
            texts = [r["text"] for r in items.collect()]
            leaked = {r["doc_id"] for r in rows if any(t in r["text"] for t in texts)}
            assert ids == {r["doc_id"] for r in rows} - leaked
            assert decontamination.leaks(docs, items).count() == 0
        else:
            check_pieces(docs.collect(), [tuple(r[c] for c in ("doc_id", "text", "lang", "source")) for r in rows], 0)
            continue
        assert docs.columns == columns


def test_run_of_an_empty_table(spark, tmp_path):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet").limit(0)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{SMOKE}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
