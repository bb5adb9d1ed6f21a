"""The pipeline on the smallest data against one written with plain Python loops, stage by stage."""

import re
from collections import Counter

import corpus_pipeline
import __spark_entry__ as entry_module
from test_decontamination import expected as contaminated

from vintara.llm.common import table, written


def test_stages(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    texts = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in table(spark, sf_dir, "benchmark").collect()]
    labels = {r.doc_id: r.quality for r in table(spark, sf_dir, "labels").collect()}
    names, kept = [], [set(texts)]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, sf_dir), "test")
        names.append(name)
        if len(names) < 5:
            assert docs.columns == table(spark, sf_dir, "documents").columns
            kept.append({r.doc_id for r in docs.select("doc_id").collect()})
            assert kept[-1] <= kept[-2]
    after_quality, after_exact, after_near, after_leaks = kept[1:]
    right = sum((labels[i] == 1) == (i in after_quality) for i in labels)
    assert right / len(labels) > 0.95
    normal = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    groups = {}
    for i in after_quality:
        groups.setdefault(normal(texts[i]), []).append((-len(texts[i] or ""), i))
    assert after_exact == {min(g)[1] for g in groups.values()}
    assert len(after_near) < len(after_exact) and len(after_near) > 0.9 * len(after_exact)
    hit = {r[0] for r in contaminated([(i, texts[i]) for i in after_near], items) if r[4]}
    assert hit and after_leaks == after_near - hit
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == after_leaks
    used = Counter()
    for r in pieces:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 4096


def test_run_and_registration(spark, sf_dir):
    assert entry_module.queries()["pipeline"] is corpus_pipeline.run
    assert corpus_pipeline.run(spark, sf_dir).columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    for n in range(1, 11):
        assert sum(name.startswith(f"op{n}_") for name in entry_module.queries()) == 1
