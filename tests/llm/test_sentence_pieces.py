"""Encoding and decoding with pieces against the library itself."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from frameml.llm.sentence_pieces import (Decoder, Encoder, decode_pieces, encode_pieces, op11_sentence_pieces, piece_report,
                                         read_model)

tokenizers = pytest.importorskip("public_tokenizers")
ODD = ["", None, " ", "  ", "   x  ", " " * 1000, "\t\n a", "▁▁a ▁", "\0a", "日本語 😀 <s> </s> <0x41> ", "a" * 5000, "ab" * 700,
       "stadtstadtadtadt" * 20, "1234 5678", "ﬁ é é", "<unk>", "�", "\U0010ffff", "same", "same"]


@pytest.fixture(scope="module")
def model():
    return read_model(tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=tokenizers.path("piece_bpe_32k.model"))


def texts(model, n):
    rng = random.Random(7)
    alphabet = "abcdefgh stadteinr  ▁\nñé日本😀1230<>/s"
    pieces = [p for p, normal in zip(model.pieces, model.normal) if normal]
    out = list(ODD)
    for _ in range(n):
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randint(1, 300))))
        out.append("".join(rng.choice("adst") for _ in range(rng.randint(1, 200))))
        out.append("".join(rng.choice(pieces) for _ in range(rng.randint(1, 60))))
    return out


@pytest.mark.parametrize("window, n", [(2_000_000, 500), (64, 30)])
def test_ids_equal_the_library(model, library, window, n):
    """Small windows cut texts between words; words longer than a window and than LONG stay whole."""
    given = texts(model, n)
    found = dict(Encoder(model, window).column(pa.array(given, pa.string())))
    assert [found[i].tolist() for i in range(len(given))] == [library.encode(t or "") for t in given]


def test_any_ids_decode_like_the_library(model, library):
    rng, decoder = np.random.default_rng(3), Decoder(model)
    for k in range(1000):
        ids = rng.integers(0, 32000 if k % 2 else 400, rng.integers(0, 30))
        assert decoder.text(ids) == library.decode(ids.tolist())
    with pytest.raises(ValueError):
        decoder.text(np.array([32000]))


def test_tables(spark, model, library):
    given = texts(model, 20)
    rows = [(i if i else None, t, "x", [1], "y") for i, t in enumerate(given)] + [(1, given[-1], "z", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, decoded string, ids array<int>, id string").repartition(3)
    encoded = encode_pieces(docs, model, ending=False)
    assert encoded.columns == ["doc_id", "ids"]
    assert (sorted((r[0] or -1, r[1]) for r in encoded.collect())
            == sorted((r[0] or -1, library.encode(r[1] or "")) for r in rows))
    back = decode_pieces(encoded.selectExpr("doc_id", "ids", "1 as decoded", "2 as id"), model)
    assert back.columns == ["doc_id", "ids", "id", "decoded"]
    assert sorted(r["decoded"] for r in back.collect()) == sorted((r[1] or "").replace("▁", " ") for r in rows)
    nulls = spark.createDataFrame([(1, None), (2, [])], "k int, ids array<int>")
    assert [r["decoded"] for r in decode_pieces(nulls, model).collect()] == ["", ""]
    assert piece_report(docs.limit(0), model).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_eos=True)
        want.append((r["doc_id"], len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    assert sorted(map(tuple, op11_sentence_pieces(spark, folder).collect())) == sorted(want)
