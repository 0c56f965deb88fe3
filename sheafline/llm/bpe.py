"""BPE encoding and decoding through a table of distinct words.

White space never takes part in a token of this kind of vocabulary, so a text is its words between
ASCII white space. A chunk is a bounded run of documents in a task. Three steps, two shuffles:

1. Each chunk sends each of its distinct words once, packed by a hash of the word into one row a
   bucket.
2. A bucket's task gathers the words of all chunks, so each distinct word of the corpus is encoded
   once, and answers every chunk's row with the ids in the row's order.
3. The chunk's documents, as word numbers in their order, meet the answers: the ids are joined back
   by position, and decoded by joining each id to its piece.

What moves is the distinct words of chunks and a compressed number for each word, never the text or a
row for each word. The number of buckets follows the size of the input; a hot word is one word in each
chunk. A task holds a chunk, or a bucket's latest KNOWN_WORDS words, however large the corpus.
"""

from __future__ import annotations

import hashlib
import os
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sheafline.llm.common import Scratch, runs

#: Text in a chunk, in code units, unless a single document is longer.
CHUNK_CHARS = 24 << 20
#: Stored input for each task of a shuffle, and the most buckets: a chunk sends a row to each.
PART_BYTES, MOST_BUCKETS = 16 << 20, 32_768
#: Encoded words that a task remembers; beyond, it starts anew and a word may be encoded again.
KNOWN_WORDS = 1 << 20


@lru_cache(2)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.no_truncation()
    found.no_padding()
    return found


@lru_cache(2)
def pieces_by_id(path: str) -> list[str]:
    """The id-to-piece table: as long as the vocabulary, whatever the corpus."""
    vocab = tokenizer(path).get_vocab(with_added_tokens=True)
    found = [""] * (max(vocab.values()) + 1)
    for piece, i in vocab.items():
        found[i] = piece
    return found


def _squeeze(numbers: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers, the four planes of bytes one after another, compressed."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unsqueeze(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


class _Chunk:
    def __init__(self, chunk: int):
        self.chunk, self.chars = chunk, 0
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.docs: list[tuple[int | None, np.ndarray]] = []

    def add(self, doc_id: int | None, text: str | None) -> None:
        words = (text or "").encode("utf-8", "surrogatepass").split()
        self.chars += len(text or "") + 64
        self.docs.append((doc_id, np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words))))

    def check(self) -> int:
        """Of the words in their order: both passes over the input must see the same chunk."""
        return zlib.crc32(b"\n".join(self.number))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Chunk]:
    held = _Chunk(-1)
    for batch in batches:
        for part, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = text.as_py()
            if held.chunk < 0:
                held = _Chunk(part << 32)
            if held.docs and held.chars + len(text or "") > CHUNK_CHARS:
                yield held
                held = _Chunk(held.chunk + 1)
            held.add(doc_id, text)
    if held.docs:
        yield held


_SENT = "chunk long, bucket int, check long, numbers binary, words binary"
_MET = "chunk long, kind int, doc_id long, number long, numbers binary, counts binary, ids binary"


def _met(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    names = [c.split()[0] for c in _MET.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*rows)) or [[]] * 7, kinds)], names)


def _send_words(buckets: int):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for held in _chunks(batches):
            packed: list[list[tuple[int, bytes]]] = [[] for _ in range(buckets)]
            for word, number in held.number.items():
                packed[zlib.crc32(word) % buckets].append((number, word))
            rows, check = [], held.check()
            for bucket, words in enumerate(packed):
                if words:
                    numbers = np.diff(np.array([n for n, _ in words], np.int64), prepend=0)
                    text = zstandard.ZstdCompressor(level=3).compress(b"\n".join(w for _, w in words))
                    rows.append((held.chunk, bucket, check, _squeeze(numbers), text))
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
                yield pa.RecordBatch.from_arrays(columns, ["chunk", "bucket", "check", "numbers", "words"])

    return scan


def _encode_words(path: str):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, known = tokenizer(path), {}
        for batch in batches:
            for chunk, _, check, numbers, words in zip(*(c.to_pylist() for c in batch.columns)):
                found = zstandard.ZstdDecompressor().decompress(words).split(b"\n")
                if len(known) > KNOWN_WORDS:
                    known.clear()
                new = [w for w in found if w not in known]
                for at in range(0, len(new), 20_000):
                    part = new[at : at + 20_000]
                    texts = [w.decode("utf-8", "surrogatepass") for w in part]
                    for word, code in zip(part, encoder.encode_batch(texts, add_special_tokens=False)):
                        known[word] = np.array(code.ids, "<u4").tobytes()
                ids = [known[w] for w in found]
                counts = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                joined = np.frombuffer(b"".join(ids), "<u4")
                yield _met([(chunk, 0, None, check, numbers, _squeeze(counts), _squeeze(joined))])

    return scan


def _send_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for held in _chunks(batches):
        yield _met([(held.chunk, 1, None, held.check(), None, None, None)])
        for at in range(0, len(held.docs), 2000):
            part = held.docs[at : at + 2000]
            yield _met([(held.chunk, 2, d, at + i, _squeeze(words), None, None) for i, (d, words) in enumerate(part)])


def _join_back(path: str, full: bool):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        piece = pieces_by_id(path)
        for run in runs(batches, ["chunk"]):
            coded: dict[int, np.ndarray] = {}
            checks: set[int] = set()
            out: list[tuple] = []
            text_ids: list[bytes] = []
            for part in run.to_batches():
                for kind, doc_id, number, numbers, counts, ids in zip(
                    *(part.column(c).to_pylist() for c in ("kind", "doc_id", "number", "numbers", "counts", "ids"))
                ):
                    if kind == 0:
                        ends = np.cumsum(_unsqueeze(counts))
                        split = np.split(_unsqueeze(ids), ends[:-1])
                        checks.add(number)
                        coded.update(zip(np.cumsum(_unsqueeze(numbers).astype(np.uint32)).tolist(), split))
                    elif kind == 1:
                        if checks - {number} or zlib.crc32(b"") != number and not checks:
                            raise ValueError("the two passes over the input did not see the same chunks")
                        lists = [coded[n].tolist() for n in range(len(coded))]
                        many = np.fromiter(map(len, lists), np.int64, len(lists))
                        text_ids = [" ".join(map(str, x)).encode() for x in lists]
                        text_pieces = [" ".join([piece[i] for i in x]) for x in lists]
                    else:
                        words = _unsqueeze(numbers)
                        words = words[many[words] > 0].tolist()
                        joined = b" ".join([text_ids[w] for w in words])
                        decoded = " ".join([text_pieces[w] for w in words])
                        out.append(
                            (
                                doc_id,
                                int(sum(many[words])) if words else 0,
                                hashlib.sha256(joined).hexdigest(),
                                hashlib.sha256(decoded.encode()).hexdigest(),
                                *([np.array([i for w in words for i in lists[w]], np.int64), decoded] if full else []),
                            )
                        )
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(pa.int64()), pa.string()][: 6 if full else 4]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids", "decoded"]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names[: len(kinds)])

    return scan


def encode_decode(docs: DataFrame, vocabulary: str, stable: bool = False, full: bool = False) -> DataFrame:
    """doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string: a row for each row of docs.

    ids are those of the tokenizers library for the whole text without special tokens added (null:
    empty text, no ids); ids_sha256 is of the decimal ids joined by one space, decoded_sha256 of the
    decoded text in UTF-8. full adds the ids (array of long) and the decoded text. Repeated rows and
    rows with a null doc_id return each; other columns are not read; an empty table gives no rows.
    stable says that docs is a plain scan of stored tables, which Spark deals out alike each time;
    any other docs are written to the shared folder first.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "bpe")
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    if not stable:
        source = scratch.table(source)
    stored = str((docs if stable else source)._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    parts = max(spark.sparkContext.defaultParallelism, -(-int(stored) // PART_BYTES))
    buckets = min(parts, MOST_BUCKETS)
    source = source.select(F.spark_partition_id().cast("long").alias("part"), "doc_id", "text")
    sent = source.mapInArrow(_send_words(buckets), _SENT)
    answers = sent.repartition(buckets, "bucket").mapInArrow(_encode_words(vocabulary), _MET)
    met = answers.union(source.mapInArrow(_send_docs, _MET))
    kinds = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return (
        met.repartition(parts, "chunk")
        .sortWithinPartitions("chunk", "kind", "number")
        .mapInArrow(_join_back(vocabulary, full), kinds + (", ids array<long>, decoded string" if full else ""))
    )
