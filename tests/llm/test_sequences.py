"""The pipeline ends with the training sequences themselves."""

import zlib
from collections import Counter, defaultdict

import numpy as np

import corpus_pipeline
from marquee.llm import packing

SF = "/root/testdata/sf0.001"


def test_sequences_hold_the_texts_tokens(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF).localCheckpoint()
    words, end = packing.WordIds(), np.array([packing.END_ID], "<u4").tobytes()
    want = Counter((r.doc_id, words.text((r.text or "").encode()) + end) for r in docs.collect())

    got = corpus_pipeline.run(spark, SF).collect()
    assert all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in got)
    pieces, sequences = defaultdict(Counter), defaultdict(dict)
    for r in got:
        pieces[r.doc_id, r.start][bytes(r.ids)] += 1
        sequences[r.sequence_id][r.offset] = bytes(r.ids)
    for (i, ids), n in want.items():
        for at in range(0, len(ids), 4 * packing.CAPACITY):
            assert pieces[i, at // 4][ids[at:at + 4 * packing.CAPACITY]] == n
    whole = [b"".join(p[k] for k in sorted(p)) for p in sequences.values()]
    assert max(map(len, whole)) <= 4 * packing.CAPACITY
    assert sum(map(len, whole)) == sum(len(ids) * n for (_, ids), n in want.items())
