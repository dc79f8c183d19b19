"""The pipeline stage by stage against the operators' brute-force rules on a small table."""

from collections import Counter

import corpus_pipeline
from tests.llm.rows import frame, prose
from tests.llm.test_lines_and_quality import brute_counts, brute_lines
from tests.llm.test_text_matches import brute_components, contamination


def test_stages_keep_what_the_brute_force_rules_keep(spark, tmp_path):
    shared = "One line that many documents have in common"
    rows = [(i, prose(i, 7) + "\n" + shared) for i in range(60)] + [(100 + i, prose(1, 7)) for i in range(5)]
    rows += [(200, prose(500, 4)), (201, "too short"), (202, None), (203, "a b c " * 80)]
    items = [(1, prose(500, 4))]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(items, "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs, ids = frame(spark, rows), lambda d: {r[0] for r in d.select("doc_id").collect()}
    names = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        before = [(r["doc_id"], r["text"]) for r in docs.collect()] if "text" in docs.columns else []
        docs = stage(spark, docs, str(tmp_path))
        seen.append(name)
        if len(seen) < len(corpus_pipeline.STAGES):
            assert docs.columns == names
        if len(seen) == 1:
            assert ids(docs) == {d for d, t in before if not brute_counts(t)[5]}
        if len(seen) == 2:
            assert Counter(r["doc_id"] for r in docs.collect()) == Counter(k[0] for k in brute_lines(before).elements())
            assert sum((r["text"] or "").count(shared) for r in docs.collect()) == 1
        if len(seen) == 3:
            assert ids(docs) == {d for (d, _, c), _ in brute_components(before).items() if d == c}
        if len(seen) == 4:
            assert ids(docs) == {k[0] for k in contamination(before, items) if not k[5]}
    assert ids(docs) == ids(corpus_pipeline.run(spark, str(tmp_path)))
