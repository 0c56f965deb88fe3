"""BPE through a table of distinct words: equal to the library, text by text, and back."""

import hashlib
import random

import pyarrow as pa
import pytest
import zstandard

from sheafline.llm import bpe

pytest.importorskip("public_tokenizers")
import public_tokenizers  # noqa: E402

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def expected(text):
    tokenizer = bpe.tokenizer(VOCABULARY)
    ids = tokenizer.encode(text or "", add_special_tokens=False).ids
    decoded = tokenizer.decode(ids, skip_special_tokens=False)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(" ".join(map(str, ids))), sha(decoded), ids, decoded


def rows():
    rng = random.Random(9)
    parts = ["Hello", "world's", " ", "\n", "\t", " ", "\x85", "\x1c", "é", "É", "ΑΣ", "İ", "字", "😀", "12", "!?", "<|endoftext|>", "<|startoftext|>x", "a<b", " ", "ﬁ"]
    texts = [None, "", " \n", " ", "x" * 20_000] + ["".join(rng.choices(parts, k=rng.randint(0, 30))) for _ in range(300)]
    return [(i, t, "c") for i, t in enumerate(texts)] + [(5, texts[5], "c"), (None, "null id", None)]


@pytest.mark.parametrize("chunk", [bpe.CHUNK_CHARS, 200])
def test_equal_to_the_library(spark, monkeypatch, chunk, tmp_path):
    data = rows()
    # Read from files, as the second pass over the input has to see the same chunks.
    spark.createDataFrame(data, "doc_id long, text string, chunk string").repartition(3).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    monkeypatch.setattr(bpe, "CHUNK_CHARS", chunk)
    got = bpe.encode_decode(docs, VOCABULARY, stable=True, full=True).collect()
    assert len(got) == len(data)
    texts = {d: t for d, t, _ in data}
    for r in got:
        n, ids_sha, decoded_sha, ids, decoded = expected(texts[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (n, ids_sha, decoded_sha), repr(texts[r["doc_id"]])[:80]
        assert r["ids"] == ids and r["decoded"] == decoded


def test_unstable_input_is_written_first(spark):
    docs = spark.createDataFrame([(1, "a b", "x"), (2, "b", "x")], "doc_id long, text string, n_tokens string").orderBy("text")
    assert {(r["doc_id"], r["n_tokens"]) for r in bpe.encode_decode(docs, VOCABULARY).collect()} == {(1, 2), (2, 1)}
    assert bpe.encode_decode(docs.limit(0), VOCABULARY).count() == 0


def test_few_known_words_and_many_buckets(spark, monkeypatch):
    """Neither what a task remembers nor the number of buckets changes the ids."""
    monkeypatch.setattr(bpe, "PART_BYTES", 64)
    docs = spark.createDataFrame([(i, " ".join(f"word{j % 37} x{i}" for j in range(i))) for i in range(60)], "doc_id long, text string")
    told = lambda: sorted(tuple(r) for r in bpe.encode_decode(docs, VOCABULARY).collect())
    many = told()
    monkeypatch.setattr(bpe, "PART_BYTES", 1 << 30)
    assert told() == many
    encode = bpe._encode_words(VOCABULARY)
    batch = pa.RecordBatch.from_pydict(
        {
            "chunk": [0, 1, 0], "bucket": [0, 0, 0], "check": [5, 6, 5], "numbers": [b"n"] * 3,
            "words": [zstandard.ZstdCompressor().compress(w) for w in (b"one\ntwo", b"two\nthree", b"one")],
        }
    )
    whole = [b.to_pylist() for b in encode(iter([batch]))]
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 0)
    assert [b.to_pylist() for b in encode(iter([batch]))] == whole
