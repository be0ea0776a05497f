import array
import random

import public_tokenizers
import pytest
import sentencepiece

from mailspark.llm.pieces import Pieces, decode, encode, encode_and_decode
from tests.llm.helpers import EDGE, empty, table

PATH = public_tokenizers.path("piece_bpe_32k.model")
MODEL = sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    return Pieces(PATH)


def test_ids_and_texts_are_those_of_the_library(pieces):
    rng = random.Random(1)
    texts = [
        "a  b", " lead", "x\ny\t z ", "\xa0nb", "ﬁ ½ Ａ", "", "   ", "a▁b", "日本語😀", "a\0b",
        "<s> <0x0A> </s>", "      x" * 5, " " * 100, "a" * 40, "ab" * 30,
    ]
    letters = " ab the er in\n,.éß日😀"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(2000)]
    for text, ids in zip(texts, pieces.encode(texts)):
        assert list(array.array("I", ids)) == MODEL.encode(text), text
        assert pieces.decode(ids) == MODEL.decode(MODEL.encode(text)) == text.replace("▁", " ")


def test_documents(spark, pieces):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(150).collect()
    texts = [r.text or "" for r in rows]
    for text, ids in zip(texts, pieces.encode(texts)):
        assert list(array.array("I", ids)) == MODEL.encode(text)


def test_edge_rows(spark):
    found = encode_and_decode(table(spark, EDGE), PATH).collect()
    expected = sorted((repr(i), t or "", MODEL.encode(t or "")) for i, t in EDGE)
    got = sorted((repr(r.doc_id), r.decoded, list(array.array("I", r.ids))) for r in found)
    assert got == expected


def test_encoding_and_decoding_apart(spark):
    found = decode(encode(table(spark, EDGE), PATH), PATH).collect()
    assert sorted(r.decoded for r in found) == sorted(t or "" for _, t in EDGE)


def test_empty_table(spark):
    assert encode_and_decode(empty(spark), PATH).collect() == []
