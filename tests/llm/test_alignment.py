"""Alignment against whole texts, one at a time, with plain dictionaries."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marquee.llm import alignment, common
from marquee.llm.packing import byte_letters
from marquee.llm.registry import QUERIES
from rows import SCHEMA, documents, edge_rows

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
LETTERS = {c: b for b, c in byte_letters().items()}
ODD = ["<|endoftext|> <s> </s> <unk> <0x0A>", "a▁b", "tab\there\r\nand  there ", "\n\n x", " ", "  ", "ﬁ ＡＢ 　x",
       "日本 語テキスト", "a\x00b \x1c c\x85d", "naïve café'll 've I'VE", "x" * 300, "é" * 200, "\t", "\na\n", "a \n b", "퟿",
       "👩‍👩‍👧 🇫🇷", "$$$ ;\r ;\r\n", "1 000 000,5"]


def whole(text):
    """(A ids, B ids, groups, pairs) of a text, or None without tokens."""
    if not text:
        return None
    want = (" " + text).encode()
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    ab = [bytes(LETTERS[c] for c in A.id_to_token(i)) for i in a]
    bb = [bytes([int(B.id_to_piece(i)[3:5], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()
          for i in b]
    if b"".join(ab) != want or b"".join(bb) != want:
        return None
    ae, be = np.cumsum([len(x) for x in ab]).tolist(), np.cumsum([len(x) for x in bb]).tolist()
    groups, pairs, i, j = [], [], 0, 0
    for end in sorted(set(ae) & set(be)):
        p, q = ae.index(end, i) + 1, be.index(end, j) + 1
        groups.append(",".join(map(str, a[i:p])) + "|" + ",".join(map(str, b[j:q])))
        pairs.append((a[p - 1], b[q - 1]))
        i, j = p, q
    return a, b, groups, pairs


def brute(rows):
    known = {i: whole(t) for i, t in enumerate(rows)}
    count = Counter(p for w in known.values() if w for p in w[3])
    top = {}
    for (_, b), n in count.items():
        top[b] = max(n, top.get(b, 0))
    for i in range(len(rows)):
        if not known[i]:
            yield 0, 0, 0, 0, 0, 0, ""
        else:
            a, b, g, p = known[i]
            yield (len(a), len(b), len(g), len(p), sum(count[x] == top[x[1]] for x in p), sum(count[x] for x in p),
                   hashlib.sha256(";".join(g).encode()).hexdigest())


@pytest.mark.parametrize("broadcast_pairs", [alignment.BROADCAST_PAIRS, 10])
def test_same_as_whole_texts(spark, broadcast_pairs):
    rows = [r for r in edge_rows() if r[0] != 17]
    rows.append((17, edge_rows()[16][1][:20000], "en", "a", 1))
    rows += [(100 + i, t, "en", "s", 1) for i, t in enumerate(ODD)]
    docs = documents(spark, rows, extra=True).repartition(5)
    got = alignment.align(docs, ["doc_id", "n_chars"], with_groups=True, broadcast_pairs=broadcast_pairs).collect()
    want = list(brute([r[1] for r in rows]))
    assert sorted((str(r.doc_id), r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got) \
        == sorted((str(r[0]), *w) for r, w in zip(rows, want))
    assert all(hashlib.sha256(r.groups.encode()).hexdigest() == r.groups_sha256 for r in got if r.n_a)
    assert sum(r.n_a == 0 for r in got) == 4                         # null, null, empty, U+2581


def test_query_on_the_table(spark):
    t = pq.read_table("/root/testdata/sf0.01/documents.parquet")
    got = QUERIES["op11_cross_tokenizer_alignment"](spark, "/root/testdata/sf0.01").collect()
    assert sorted(map(tuple, got)) == sorted((i, *w) for i, w in zip(t["doc_id"].to_pylist(), brute(t["text"].to_pylist())))


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], SCHEMA)).collect() == []
    assert [r.n_a for r in alignment.align(documents(spark, [(1, None, None, None, None)])).collect()] == [0]


ALIGNER = alignment.Aligner()


@settings(max_examples=300, deadline=None)
@given(st.text(st.sampled_from(list(" \n\r\t\x0b ▁ab'é.$1日\x00\x1c\U0001F600")), max_size=12))
def test_segments_are_independent(text):
    place, start = ALIGNER.read(pa.array([text]))
    want = whole(text)
    assert len(start) == 2 and (len(place) == 0) == (want is None)
    if want:
        [groups], _ = alignment.digests(ALIGNER, place, start)
        assert groups == ";".join(want[2])
        assert ALIGNER.sums(ALIGNER.figures, place, start).tolist() == [[len(want[0]), len(want[1]), len(want[2]), 0]]
        pairs = [p for k in place for p in ALIGNER.pairs[ALIGNER.first[k]:ALIGNER.first[k + 1]].tolist()]
        assert [(p >> alignment.B_BITS, p % (1 << alignment.B_BITS)) for p in pairs] == want[3]


def test_hash_is_minimal_and_perfect():
    rng = np.random.default_rng(1)
    pairs = np.unique(rng.integers(0, 50_000, 200_000) << alignment.B_BITS | rng.integers(0, 1000, 200_000))
    buckets, rows = 7, []
    of = alignment.spots(pairs) * buckets >> alignment.SPOT_BITS
    for k in range(buckets):
        t = alignment.build_bucket(pa.table({"bucket": np.full((of == k).sum(), k), "pair": pairs[of == k]}))
        rows.append(type("Row", (), {c: t.column(c)[0].as_py() for c in t.column_names}))
    index = alignment.PairIndex(buckets, rows[::-1])
    assert sorted(index(pairs).tolist()) == list(range(len(pairs)))
    keys = np.concatenate([np.frombuffer(r.keys, "<i8") for r in rows])
    assert (keys[index(pairs)] == pairs).all()
    assert 8 * sum(len(r.bits) for r in rows) < 4 * len(pairs)
    stored = [type("R", (), {"bucket": r.bucket, "keys": r.keys, "counts": r.keys}) for r in rows]
    counts = alignment.PairCounts(index, stored, {999: 1})
    assert (counts(pairs)[0] == pairs).all()
    with pytest.raises(KeyError):                        # a key that the hash was not built for
        counts(np.array([60_000 << alignment.B_BITS]))


def test_vectors_sum_in_a_tree(spark):
    rows = [(k, p, np.full(3, p + k, "<i8").tobytes()) for k in range(2) for p in range(9)]
    vectors = spark.createDataFrame(rows, "key long, part long, vector binary")
    got = common.tree_sum(vectors, 9, "<i8", fan=2).collect()
    assert sorted((r.key, np.frombuffer(r.vector, "<i8").tolist()) for r in got) == [(0, [36] * 3), (1, [45] * 3)]
