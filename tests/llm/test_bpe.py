import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from avionyx.llm import bpe, latent

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def check(text):
    ids, decoded = bpe.codec(PATH).encode(text)
    want = LIBRARY.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(ids, "<u4").tolist() == want
    assert decoded == LIBRARY.decode(want, skip_special_tokens=False)


@given(st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=300))
@settings(max_examples=300, deadline=None)
def test_any_text(text):
    check(text)


PIECES = ["<|endoftext|>", "<|startoftext|>", "a<|endoftext|>b", "don't", "ΣΑΣ", "İi", "é", "́", "x y", "\x1c", " ", "naïve", "ß", "ǅ", "12'34", "漢字", "🙂", "<", "|>", "\x85", "Ÿ", "µ", "ª", "\x00"]


@given(st.lists(st.sampled_from([*PIECES, " ", "\n", "word", "Thing.", "#$%"]), max_size=400))
@settings(max_examples=150, deadline=None)
def test_joined_pieces(parts):
    check("".join(parts))


def test_long_texts_without_blanks():
    rng = random.Random(0)
    check("".join(rng.choice("abcé1.") for _ in range(30_000)))
    check("ab" * 20_000 + " " + "c" * 9000)


def test_chunks_are_content_defined():
    rng = random.Random(1)
    shared = " ".join(f"w{rng.randrange(10**6)}" for _ in range(2000))
    a, b = set(bpe.chunks("one start " + shared)), set(bpe.chunks("quite another beginning here " + shared))
    assert "".join(bpe.chunks(shared)) == shared
    assert len(a & b) > 0.9 * len(a)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json"])
def test_other_tokenizer_files(name):
    library = Tokenizer.from_file(public_tokenizers.path(name))
    codec = bpe.ChunkCodec(public_tokenizers.path(name))
    assert codec.splits_at_blanks is False
    for text in ("", "Hello  world, don't\n\n stop <|endoftext|> é", "a" * 5000):
        ids, decoded = codec.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded == library.decode(want, skip_special_tokens=False)


def test_query_columns(spark):
    texts = [None, "", " ", "a b", "a b", "<|endoftext|>", "word " * 5000, "x" * 10_000]
    rows = [(i, t, "clash") for i, t in enumerate(texts)] + [(None, "a b", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(map(tuple, bpe.encode_digests(docs, PATH).collect()), key=str)
    want = []
    for d, t, _ in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want, key=str)
    assert bpe.encode_digests(docs.limit(0), PATH).count() == 0
    full = bpe.encode_documents(docs.select("doc_id", "text"), PATH)
    assert full.columns == ["doc_id", "text", "ids", "decoded"] and full.count() == len(rows)


def test_workers_keep_no_cache(spark):
    """A reused Python worker goes on to other operators without the texts of the last task."""
    codec = bpe.ChunkCodec(PATH)
    first = codec.encode("two words, don't\u2026 " * 500)
    assert codec.parts and codec.pieces and codec.chunks
    codec.forget()
    assert not any(len(c) + len(c.old) + c.held for c in (codec.parts, codec.pieces, codec.chunks))
    assert codec.encode("two words, don't\u2026 " * 500) == first

    rng = random.Random(2)
    rows = [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(200))) for i in range(64)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)

    def held(batches):
        from avionyx.llm import bpe, latent

        for batch in batches:
            n = sum(len(c) + len(c.old) for k in bpe._CODECS.values() for c in (k.parts, k.pieces, k.chunks))
            yield pa.RecordBatch.from_arrays([pa.array([n + len(latent._CODES)])], names=["n"])

    for frame in (bpe.encode_digests(docs, PATH), bpe.encode_documents(docs, PATH), latent._coded(docs, "long")):
        assert len(frame.collect()) == 64
        assert {r["n"] for r in spark.range(0, 64, 1, 16).mapInArrow(held, "n long").collect()} == {0}
