import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peakwise.llm import piece_codec, queries

SF_DIR = "/root/testdata/sf0.01"
PATH = queries.tokenizer_path(queries.PIECES)
EDGES = [
    None, "", " ", "   ", "▁", "▁▁a▁ b", "\x00a", "  a  b ﬁ x\t\ny ", "é ½ ™😀😀 日本語", " a ",
    "aaaa" * 50, " " * 133 + "x", "<s></s><unk><0x0A>", "é​﻿", "ab" * 20_000,
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def codec():
    return piece_codec.PieceCodec(PATH)


def differences(codec, library, texts):
    """Texts whose ids or decoded text are not the library's."""
    ids, counts = codec.encode(pa.array(texts, pa.string()), (2,))
    again = codec.decode(ids, counts).to_pylist()
    ends = np.cumsum(counts)
    wanted = [[*library.encode(t or ""), 2] for t in texts]
    return [t for t, a, b, d, w in zip(texts, [0, *ends], ends, again, wanted)
            if ids[a:b].tolist() != w or d != library.decode(w)]


def test_edges(codec, library):
    assert differences(codec, library, EDGES) == []
    assert differences(codec, library, EDGES[1:2]) == []
    assert codec.encode(pa.array([], pa.string()))[0].tolist() == []


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.one_of(st.sampled_from("aeinrst  ▁.1\n"), st.characters(codec="utf-8")),
                        max_size=60), max_size=8))
def test_any_text(codec, library, texts):
    assert differences(codec, library, texts) == []


def test_texts_of_pieces(codec, library):
    """Pieces side by side, where merges make pairs that are better than themselves."""
    rng = random.Random(5)
    pieces = [library.id_to_piece(i).replace("▁", " ") for i in range(259, library.vocab_size())]
    texts = ["".join(rng.choices(pieces, k=rng.randrange(30))) for _ in range(3000)]
    assert not codec.orderly
    assert differences(codec, library, texts) == []


def test_decoding_of_any_ids(codec, library):
    rng = random.Random(6)
    rows = [[rng.choice([rng.randrange(300), rng.randrange(32000)]) for _ in range(rng.randrange(9))]
            for _ in range(2000)]
    flat = np.array([i for r in rows for i in r], np.int32)
    texts = codec.decode(flat, np.array([len(r) for r in rows])).to_pylist()
    assert texts == [library.decode(r) for r in rows]
    with pytest.raises(ValueError):
        codec.decode(np.array([32000]), np.array([1]))


def test_remembered_words_change_nothing(library, monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBERED", 20)
    codec = piece_codec.PieceCodec(PATH)
    rng = random.Random(7)
    for _ in range(20):
        texts = [" ".join(rng.choices(["one", "two" * 40, "zwei", "x", "é😀", "y" * 70], k=9))
                 + str(rng.random()) for _ in range(5)]
        assert differences(codec, library, texts) == []
    assert len(codec.known) <= 20


def test_frames_nulls_and_clashing_columns(spark, library):
    rows = [(i // 2, t, "x", 7, "d") for i, t in enumerate(EDGES)]
    docs = spark.createDataFrame(
        rows, "doc_id bigint, text string, ids string, `a.b` int, decoded string")
    coded = piece_codec.encoded(docs, PATH)
    assert coded.columns == ["doc_id", "a.b", "decoded", "ids"]
    got = piece_codec.decoded(coded, PATH)
    assert got.columns == ["doc_id", "a.b", "ids", "decoded"]
    wanted = [[*library.encode(t or ""), 2] for t in EDGES]
    assert sorted((r.doc_id, r.ids, r.decoded) for r in got.collect()) == sorted(
        (i // 2, w, library.decode(w)) for i, w in enumerate(wanted))
    assert piece_codec.decoded(piece_codec.encoded(docs.limit(0), PATH), PATH).count() == 0
    none = coded.limit(1).select(F.lit(None).cast("array<int>").alias("ids"))
    assert piece_codec.decoded(none, PATH).first().decoded is None
    bare = piece_codec.encoded(docs.select("text"), PATH, end_id=None)
    assert sorted(r.ids for r in bare.collect()) == sorted(w[:-1] for w in wanted)


def test_query_against_the_library(spark, library):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    digest = lambda text: hashlib.sha256(text.encode()).hexdigest()
    wanted = []
    for d in docs:
        ids = [*library.encode(d.text or ""), 2]
        wanted.append((d.doc_id, len(ids), digest(" ".join(map(str, ids))),
                       digest(library.decode(ids))))
    got = queries.op12_piece_codec(spark, SF_DIR).collect()
    assert sorted(map(tuple, got)) == sorted(wanted)
