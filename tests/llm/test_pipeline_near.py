"""The pipeline's near-duplicate stage against fingerprints compared pair by pair."""

import random

import corpus_pipeline
from docs import awkward, documents
from test_simhash import fingerprint, smallest_reachable


def test_stage_links_fingerprints(spark):
    draw = random.Random(3)
    text = lambda n: " ".join(draw.choice("abcdefghijklmnop") + str(draw.randrange(900)) for _ in range(n))
    base = text(300)
    # one line many times: the fingerprints are equal, the sets of shingles are not similar
    line = text(11)
    rows = awkward() + [(500, base), (501, base + " end"), (502, base.upper()), (503, " ".join([line] * 60) + " " + text(20)),
                        (504, " ".join([line] * 60) + " " + text(20)), (505, text(300))]
    prints = {i: fingerprint(t, 4) for i, t in rows}
    name = smallest_reachable(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 4)
    kept = corpus_pipeline.simhash_near_dedup(spark, documents(spark, rows), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i in prints if name[i] == i)
    assert name[504] == 503 and name[502] == 500
