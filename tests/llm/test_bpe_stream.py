"""Streaming BPE against the tokenizers library: ids, stable emission, decoding."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from catalogspark.llm import bpe_stream as B
from catalogspark.llm.words import text_bytes

PATH = B.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
ids_of = lambda t: LIBRARY.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def merges():
    return B.Merges(PATH)


def hard_texts():
    rng = random.Random(3)
    alphabet = "aabcdest'' \t\n  rvlmREé漢ß1234٣½.,!?-_#😀  ́\u0085\x1c\x00ǅﷺ\u0378\u1c89"
    out = ["", "a", " ", "  ", "\n", " 's", "'s", "''s", "  's're'll 'x'd's't", "a   ", "\n\n x", "we're don't'll've<|endoftext|>  x<|endoftext|>", "<|endoftext|>", None]
    out += ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    out += ["".join(rng.choice(" aeiothns") for _ in range(rng.randint(0, 300))) for _ in range(300)]
    out += ["a" * n for n in (47, 48, 49, 100, 9000)] + [" " * n + "x" for n in (47, 100, 5000)]
    return out + ["".join(rng.choice("etaoinshrdlu") for _ in range(12000)), "=-" * 4000, "é" * 3000, "\n" * 5000, "'re" + "a" * 500, "\n" + "b" * 500]


def encoded(encoder, texts):
    data, bounds = text_bytes(pa.array(texts, pa.string()))
    out = [[] for _ in texts]
    for k, ids in encoder.rows(data, bounds):
        out[k] += ids.tolist()
    return out


@pytest.mark.parametrize("limit", [64, 97, 1000, B.SLICE])
def test_ids_are_those_of_the_library(limit):
    texts = hard_texts()
    assert encoded(B.Encoder(PATH, limit=limit), texts) == [ids_of(t) for t in texts]


def test_character_classes_follow_the_pre_tokenizer():
    encoder = B.Encoder(PATH)
    points = [*range(0, 0x3100, 7), *range(0x3100, 0xD800, 211), *range(0xE000, 0x110000, 997), 0x85, 0xA0, 0x2028, 0x3000, 0x1C, 0x1F]
    kinds = encoder._kinds(np.array(points, np.uint32))
    assert [int(k) for k in kinds] == [B.Encoder._asked(chr(c)) for c in points]


def test_long_pieces_are_emitted_early_and_held_in_bounded_memory(merges):
    rng = random.Random(4)
    data = "".join(rng.choice("etaoinshrdlu") for _ in range(60000)).encode()
    machine, out = B.PieceTransducer(merges), []
    for at in range(0, len(data), 1000):
        out += machine.feed(data[at : at + 1000])
        assert len(machine.held) <= machine.window + 1000
        assert sum(len(merges.token_bytes[i]) for i in out) >= at + 1000 - machine.window - merges.lookahead - 128
    assert out + machine.finish() == ids_of(data.decode())


def test_tokens_before_the_lookahead_never_change(merges):
    rng = random.Random(6)
    whole = "".join(rng.choice("aeinrst") for _ in range(1500)).encode()
    full = merges.merge_window(whole)
    for n in range(330, 1500, 7):
        safe, size = [], 0
        for i in merges.merge_window(whole[:n]):
            size += len(merges.token_bytes[i])
            if size > n - merges.lookahead:
                break
            safe.append(i)
        assert full[: len(safe)] == safe


def test_lookahead_of_a_small_list():
    # bc comes before ab: "ab" is one token until a "c" follows, which takes the b away
    assert B.sufficient_lookahead([(b"b", b"c"), (b"a", b"b")]) == 2
    assert B.sufficient_lookahead([(b"a", b"b"), (b"b", b"c")]) == 1
    assert B.sufficient_lookahead([(b"a", b"b")]) == 1
    assert B.sufficient_lookahead([]) == 0


def test_decoder_is_incremental_and_lossless(merges):
    rng = random.Random(5)
    machine = B.ByteToText(merges)
    for _ in range(2000):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert "".join(machine.feed([i]) for i in ids) + machine.finish() == LIBRARY.decode(ids, skip_special_tokens=False)


def test_digests_and_round_trip(spark, docs, texts, nothing):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = lambda i, t: (i, len(ids_of(t)), sha(",".join(map(str, ids_of(t)))), sha(t or ""))
    source = [(r["doc_id"], r["text"]) for r in docs.collect()]
    got = [tuple(r) for r in B.digests(docs).collect()]
    assert sorted(got, key=repr) == sorted((want(i, t) for i, t in source), key=repr)
    assert B.digests(nothing).count() == 0
    kept = B.decode(B.encode(docs, into="my ids"), ids="my ids", into="back")
    assert kept.columns == [*docs.columns, "my ids", "back"]
    for r in kept.collect():
        assert r["my ids"] == ids_of(r["text"]) and r["back"] == (r["text"] or "")
    odd = spark.createDataFrame([(1, None), (2, []), (3, [0, None, 99999999, -1])], "k int, ids array<int>")
    assert [r["decoded"] for r in B.decode(odd).orderBy("k").collect()] == ["", "", LIBRARY.decode([0])]


def test_bytes_that_are_no_text(spark):
    rows = spark.sql("select 1L doc_id, cast(unhex('61ff62') as string) text")
    assert B.digests(rows).first()["decoded_sha256"] == hashlib.sha256("a\ufffdb".encode()).hexdigest()


def test_query_over_the_whole_table(spark):
    from catalogspark.llm.queries import QUERIES

    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    got = {r["doc_id"]: r for r in QUERIES["op12_streaming_bpe"](spark, "/root/testdata/sf0.001").collect()}
    assert got.keys() == docs.keys()
    for i, r in got.items():
        ids = ids_of(docs[i])
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
