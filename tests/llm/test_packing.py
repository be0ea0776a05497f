import random
import struct
from collections import defaultdict

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from mailspark.llm.packing import TIERS, WordTokens, pack
from mailspark.llm.queries import packing
from tests.llm.helpers import EDGE, empty, table

PATH = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def tokenizer():
    found = Tokenizer.from_file(PATH)
    found.encode_special_tokens = True
    return found


def check_pieces(rows, documents):
    """Every id lies in one piece, and sequences are gapless and at most the longest tier."""
    known = tokenizer()
    expected = sorted(
        ((-1 if i is None else i), tuple([*known.encode(t or "", add_special_tokens=False).ids, 0]))
        for i, t in documents
    )
    texts = defaultdict(list)
    for r in rows:
        texts[-1 if r.doc_id is None else r.doc_id, r.doc_tokens].append(r)
    for (doc_id, n), pieces in texts.items():
        same = [ids for i, ids in expected if i == doc_id and len(ids) == n]
        assert sum(p.length for p in pieces) == n * len(same)
        for p in pieces:
            ids = struct.unpack(f"<{p.length}I", p.ids)
            assert any(ids == s[p.start : p.start + p.length] for s in same)
    assert sum(r.length for r in rows) == sum(len(ids) for _, ids in expected)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append(r)
    padding = 0
    for pieces in sequences.values():
        at = 0
        for p in sorted(pieces, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= TIERS[-1]
        assert len({p.step_group for p in pieces}) == 1
        padding += 0 if at & (at - 1) == 0 else TIERS[-1] - at
    return padding


def test_edge_rows(spark):
    rows = pack(table(spark, EDGE), PATH, PATTERN).collect()
    assert check_pieces(rows, EDGE) == 0


def test_empty_table(spark):
    assert pack(empty(spark), PATH, PATTERN).collect() == []


def test_random_documents_fill_their_windows(spark):
    rng = random.Random(3)
    documents = [
        (i, " ".join(rng.choice(["the", "of", "and,", "xylo"]) for _ in range(rng.randint(0, 900))))
        for i in range(300)
    ]
    rows = pack(table(spark, documents).repartition(3), PATH, PATTERN).collect()
    assert check_pieces(rows, documents) == 0
    groups = defaultdict(int)
    for r in rows:
        groups[r.step_group] += r.length
    by_task = defaultdict(list)
    for g, n in groups.items():
        by_task[g >> 32].append(n)
    for sizes in by_task.values():
        assert max(sizes) - min(sizes) <= 3 * TIERS[-1]


def test_words_are_encoded_as_the_library_does():
    rng, ours, known = random.Random(5), WordTokens(PATH, PATTERN), tokenizer()
    parts = [
        "a", "the", " ", "  ", "\n", "\t", "'s", "don't", ".", ",", "1", "é", "日本", "\xa0",
        "<|endoftext|>", "😀", "\r\n", "_", "²", "\x1c", "​",
    ]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        ids = known.encode(text, add_special_tokens=False).ids
        assert ours.encode_text(text) == struct.pack(f"<{len(ids)}I", *ids)


def test_queries_find_special_tokens_as_the_library_does(spark, tmp_path):
    known = Tokenizer.from_file(PATH)
    documents = [
        (1, "end <|endoftext|> next"),
        (2, "<|endoftext|>"),
        (3, "a<|endoftext|><|endoftext|>b <|endoftext |> c"),
        (4, "nothing of the kind"),
    ]
    table(spark, documents).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    expected = {i: [*known.encode(t, add_special_tokens=False).ids, 0] for i, t in documents}
    assert expected[1] == [437, 220, 50256, 1306, 0]
    query = {r.doc_id: r.doc_tokens for r in packing(spark, str(tmp_path)).collect()}
    assert query == {i: len(ids) for i, ids in expected.items()}
    found = defaultdict(list)
    for r in sorted(corpus_pipeline.packing(spark, docs, "").collect(), key=lambda r: (r.doc_id, r.start)):
        found[r.doc_id] += struct.unpack(f"<{r.length}I", r.ids)
    assert found == expected
