import numpy as np

import cases
import corpus_pipeline
import test_decontaminate
import test_mixing
import test_quality
import test_simhash
from leakwatch.llm import packing


def test_stages_equal_their_brute_force_twins(spark, tmp_path):
    item = cases.prose(40, 500)
    data = cases.rows() + [(400, item + "\n" + cases.prose(60, 401), "en", "s1", 1, 2, "c", 0.2, "n")]
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    cases.frame(spark, data).write.parquet(f"{tmp_path}/documents.parquet")
    held = [r for r in data if test_quality.brute(r[1])[-1]]
    group = test_simhash.components({test_simhash.fingerprint(r[1]) for r in held})
    first = {}
    for i, r in enumerate(held):
        place = (r[0] is None, r[0] or 0, i)
        g = group[test_simhash.fingerprint(r[1])]
        first[g] = min(first.get(g, place), place)
    held = [held[i] for *_, i in sorted(first.values())]
    bad = test_decontaminate.brute([(r[0], r[1]) for r in held], [(1, item)])
    assert [r[0] for r in bad if r[-1]] == [400]
    held = [r for r, b in zip(held, bad) if not b[-1]]
    words = sum(r[-1] for r in test_mixing.brute(held))

    frame = spark.read.parquet(f"{tmp_path}/documents.parquet")
    ids = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        frame = stage(spark, frame, str(tmp_path))
        frame.write.parquet(f"{tmp_path}/out{k}")
        frame = spark.read.parquet(f"{tmp_path}/out{k}")
        if k < 4:
            assert frame.columns == cases.frame(spark, []).columns
            ids.append(sorted(r.doc_id for r in frame.select("doc_id").distinct().collect() if r.doc_id is not None))
    assert ids[2] == sorted(r[0] for r in held)
    mixed = spark.read.parquet(f"{tmp_path}/out3").collect()
    assert sum(len(cases.words(r.text)) for r in mixed) == words
    encode = packing.Encoder()
    assert sum(r.n_tokens for r in frame.collect()) == sum(len(encode(r.text)) + 1 for r in mixed)
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sum(np.frombuffer(r.input_ids, "<i4").size for r in rows) == len(rows) * packing.LENGTH
