"""Alignment of two tokenizers' tokens by diagonal run skipping, with corpus-wide link counts.

A byte-level BPE (A) and a piece model (B) encode the same bytes; the byte
offsets where tokens end are two ascending arrays.  From a common offset the
arrays are compared along the diagonal, at the present shift between their
indexes, in stretches of 1, 2, 4, ... tokens: while they agree, every token
is one group with its counterpart.  A stretch that differs is halved down to
the first difference, the irregular group there is resolved locally (the
token that ends first is passed until both end at one offset), and the shift
follows from where it ended.  Tokens of a group whose bytes overlap are
linked.

Links are counted corpus-wide in three steps, so that no row is shuffled per
document and pair: a task numbers the distinct pairs of a bounded chunk of
documents in a dictionary and counts its documents; the dictionaries are
summed per pair; totals go back to the chunk, where the documents hold only
pair numbers.  The vocabulary files are read once by the driver and sent to
the tasks (a few MB, whatever the data).

Edge cases: texts that are NULL, empty, or not reproduced byte for byte by
both tokenizers have no tokens: zeros and no groups; special tokens inside a
text are plain text; repeated rows each count as a document; a document of
any length is encoded whole (alone in its chunk when it is long); an empty
table gives an empty result; extra columns pass through, clashing ones are
replaced.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import accumulate, chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored, table

TOKENIZERS = "/opt/tokenizers"
BYTE_BPE = "byte_bpe_50k.json"
PIECE_BPE = "piece_bpe_32k.model"
CHUNK_BYTES = 4 << 20  # text of a chunk, unless one document is longer
SHIFT = 32  # a pair is a << SHIFT | b

# The byte-level BPE's rule for words.  Texts of the characters below, whose classes all Unicode versions agree on,
# are encoded by merge ranks (the same tokens, in a fraction of the time), all others by the tokenizer itself.
WORDS = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_PLAIN = re.compile(r"[\t-\r -~¡-ɏ]*")
WORD_CHARS = 8 << 20  # characters of the words whose pieces a worker keeps


# ---- tokenizers

def byte_level() -> dict[str, int]:
    """Character of byte-level BPE -> byte: printable bytes stand for themselves, the others follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(0x100 + n): b for n, b in enumerate(rest)}}


class Encoders:
    """Both tokenizers, with the bytes of every token."""

    def __init__(self, byte_bpe: bytes, piece_bpe: bytes):
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_buffer(byte_bpe)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_bpe)
        to_byte = byte_level()
        self.a_bytes = []
        for i in range(self.a.get_vocab_size()):
            token = self.a.id_to_token(i) or ""
            known = all(c in to_byte for c in token)
            self.a_bytes.append(bytes(to_byte[c] for c in token) if known else token.encode())
        self.b_bytes = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.fast = self._ranks(byte_bpe)
        self.by_word = self._by_word(piece_bpe)
        self.words, self.word_chars = {}, 0
        self.first = {i for i in range(len(self.b_bytes)) if self.b_bytes[i].startswith(b" ")}  # pieces that begin a word
        self.a_size = [len(t) for t in self.a_bytes]
        self.b_size = [len(t) for t in self.b_bytes]

    def ends(self, a: list, b: list) -> tuple[list, list]:
        """Byte offsets where the tokens end."""
        return list(accumulate(map(self.a_size.__getitem__, a))), list(accumulate(map(self.b_size.__getitem__, b)))

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def _ranks(self, byte_bpe: bytes):
        """A by merge ranks, where its ids follow the order of its merges; else None."""
        import tiktoken

        model = json.loads(byte_bpe)["model"]
        vocab = model["vocab"]
        first = len(vocab) - len(model["merges"])
        for k, pair in enumerate(model["merges"]):
            left, right = pair.split(" ") if isinstance(pair, str) else pair
            if vocab.get(left + right) != first + k:
                return None
        ranks = {self.a_bytes[i]: i for i in vocab.values()}
        return tiktoken.Encoding("byte-level", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})

    def encode_a(self, text: str) -> list | None:
        """Token ids of A, None unless they give the text's bytes."""
        if self.fast and _PLAIN.fullmatch(text):
            return self.fast.encode_ordinary(text)
        ids = self.a.encode(text, add_special_tokens=False).ids
        return ids if b"".join([self.a_bytes[i] for i in ids]) == text.encode() else None

    def _by_word(self, piece_bpe: bytes) -> bool:
        """Whether B can encode word by word: merges of a BPE model none of whose
        pieces has a space behind another character never cross from a word to the next."""
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto.FromString(piece_bpe)
        plain = not any(p.type == p.USER_DEFINED or "▁" in p.piece.lstrip("▁") for p in model.pieces)
        return plain and model.trainer_spec.model_type == model.trainer_spec.BPE and not model.trainer_spec.treat_whitespace_as_suffix

    def _learn(self, words: list) -> bool:
        """Keep the pieces of words, encoded as one text; False where that does not give their bytes."""
        ids = tuple(self.b.encode(" ".join(words)))
        at = [k for k, i in enumerate(ids) if i in self.first]
        if len(at) != len(words) or b"".join(map(self.b_bytes.__getitem__, ids)) != (" " + " ".join(words)).encode():
            return False
        self.words.update(zip(words, map(ids.__getitem__, map(slice, at, [*at[1:], len(ids)]))))
        self.word_chars += sum(map(len, words)) + 16 * len(words)
        return True

    def encode_b(self, text: str) -> list | None:
        """Token ids of B, None unless they give the bytes of space + text."""
        if self.by_word and _PLAIN.fullmatch(text):
            words = text.split(" ")
            if self.word_chars > WORD_CHARS:
                self.words, self.word_chars = {}, 0
            new = set(words).difference(self.words)
            if "" not in new and (not new or self._learn(list(new))):
                return list(chain.from_iterable(map(self.words.__getitem__, words)))
        ids = self.b.encode(text)
        return ids if b"".join([self.b_bytes[i] for i in ids]) == b" " + text.encode() else None

    def encode(self, texts: list) -> Iterator[tuple[list, list]]:
        """Token ids of both tokenizers, empty where they do not give the bytes of space + text."""
        for t in texts:
            y = self.encode_b(t) if t else None
            x = self.encode_a(" " + t) if y else None
            yield (x, y) if x else ([], [])


def encoders(files) -> Encoders:
    """Both tokenizers from their broadcast files, kept beside the broadcast for a worker's later tasks."""
    if getattr(files, "encoders", None) is None:
        files.encoders = Encoders(*files.value)
    return files.encoders


# ---- alignment

def runs(a: list, b: list) -> Iterator[tuple[int, int, int, int]]:
    """(first, end) of A and of B for one-to-one stretches and irregular groups, in order.

    ``a`` and ``b`` are the end offsets of the tokens; both end at the same one.
    A stretch has as many tokens on either side, each its own group; an
    irregular group has two or more tokens on one side at least.
    """
    i = j = 0
    n = len(a)
    while i < n:
        x, y = a[i], b[j]
        if x == y:
            first, start, step = i, j, 1
            while a[i:i + step] == b[j:j + step]:  # along the diagonal
                i, j = i + step, j + step
                if i >= n:
                    yield first, n, start, len(b)
                    return
                step *= 2
            while step > 1:  # the first difference lies within the last probe
                step //= 2
                if a[i:i + step] == b[j:j + step]:
                    i, j = i + step, j + step
            yield first, i, start, j
            x, y = a[i], b[j]
        first, start = i, j
        while x != y:
            if x < y:
                i += 1
                x = a[i]
            else:
                j += 1
                y = b[j]
        i, j = i + 1, j + 1
        yield first, i, start, j


NUMERALS = [str(i) for i in range(1 << 16)]
LEFT, RIGHT = [n + "|" for n in NUMERALS], [n + ";" for n in NUMERALS]


def links(a: list, b: list, ends_a: list, ends_b: list) -> tuple[list, list, str]:
    """Linked A and B ids in order of their bytes, and the groups as text."""
    left, right, text = [], [], []
    digits, of_a, of_b = NUMERALS.__getitem__, LEFT.__getitem__, RIGHT.__getitem__
    for i, end_i, j, end_j in runs(ends_a, ends_b):
        some_a, some_b = a[i:end_i], b[j:end_j]
        if ends_a[i] == ends_b[j]:
            left += some_a
            right += some_b
            text += chain.from_iterable(zip(map(of_a, some_a), map(of_b, some_b)))
            continue
        text.append(",".join(map(digits, some_a)) + "|" + ",".join(map(digits, some_b)) + ";")
        x, y = ends_a[i], ends_b[j]
        last = ends_a[end_i - 1]
        while True:  # the token that ends first gives way to its successor
            left.append(a[i])
            right.append(b[j])
            if x < y:
                i += 1
                x = ends_a[i]
            elif y < last:
                j += 1
                y = ends_b[j]
            else:
                break
    return left, right, "".join(text)[:-1]


# ---- tasks

NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned_schema(row: T.StructType) -> T.StructType:
    ints = T.ArrayType(T.IntegerType())
    row = T.StructType([T.StructField(f.name, f.dataType) for f in row])  # a dictionary's row is NULL
    return T.StructType(
        [T.StructField("chunk", T.LongType()), T.StructField("row", row)] + [T.StructField(c, T.LongType()) for c in NUMBERS]
        + [T.StructField("groups", T.StringType()), T.StructField("pair", ints), T.StructField("times", ints),
           T.StructField("dict_a", ints), T.StructField("dict_b", ints), T.StructField("dict_docs", ints)])


def aligner(files, digest: bool, chunk_bytes: int):
    """The task: aligned documents, and after those of a chunk one row with its dictionary."""

    def chunk_rows(number: int, docs: list, out_row: pa.DataType) -> pa.RecordBatch:
        codes = [d[1] for d in docs]
        keys, at = np.unique(np.concatenate(codes), return_inverse=True)
        seen = np.bincount(at, minlength=len(keys)).astype(np.int32)
        cuts = np.concatenate(([0], np.cumsum([len(c) for c in codes])))
        at = at.astype(np.int32)
        n = len(docs)
        rows = pa.concat_arrays([d[0] for d in docs] + [pa.nulls(1, out_row)])
        none = [None] * n

        def ints(values):
            return pa.array(values, pa.list_(pa.int32()))

        columns = [pa.array([number] * (n + 1), pa.int64()), rows]
        columns += [pa.array([d[3][k] for d in docs] + [None], pa.int64()) for k in range(len(NUMBERS))]
        columns += [pa.array([d[4] for d in docs] + [None], pa.string()),
                    ints([at[cuts[k]:cuts[k + 1]] for k in range(n)] + [None]), ints([d[2] for d in docs] + [None]),
                    ints(none + [(keys >> SHIFT).astype(np.int32)]), ints(none + [(keys & 0xFFFFFFFF).astype(np.int32)]),
                    ints(none + [seen])]
        names = ["chunk", "row", *NUMBERS, "groups", "pair", "times", "dict_a", "dict_b", "dict_docs"]
        return pa.RecordBatch.from_arrays(columns, names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        from pyspark import TaskContext

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        both = encoders(files)
        number = TaskContext.get().partitionId() << 32
        docs, size, kind = [], 0, None
        for batch in batches:
            rows, texts = batch.column("row"), batch.column("text")
            kind = rows.type
            for at in range(0, batch.num_rows, 64):
                some = texts.slice(at, 64).to_pylist()
                for k, (a, b) in enumerate(both.encode(some)):
                    x, y, groups = links(a, b, *both.ends(a, b))
                    code, times = np.unique((np.array(x, np.int64) << SHIFT) | np.array(y, np.int64), return_counts=True)
                    numbers = len(a), len(b), groups.count(";") + 1 if a else 0, len(x)
                    if digest and a:
                        groups = hashlib.sha256(groups.encode()).hexdigest()
                    docs.append((rows.slice(at + k, 1), code, times.astype(np.int32), numbers, groups))
                    size += len(some[k] or "") + 64
                    if size >= chunk_bytes:
                        yield chunk_rows(number, docs, kind)
                        number, docs, size = number + 1, [], 0
        if docs:
            yield chunk_rows(number, docs, kind)

    return run


def counted(key, left: pa.Table, right: pa.Table) -> pa.Table:
    """The task: the documents of a chunk with the totals of their pairs."""
    docs = left.num_rows
    size = int(max(right["at"].to_numpy(), default=-1)) + 1
    total, best = np.zeros(size, np.int64), np.zeros(size, np.int64)
    total[right["at"].to_numpy()] = right["docs"].to_numpy()
    best[right["at"].to_numpy()] = right["best"].to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.zeros((2, docs), np.int64)
    for i, (pair, times) in enumerate(zip(left["pair"], left["times"])):
        at, n = pair.values.to_numpy(), times.values.to_numpy()
        sums[0, i], sums[1, i] = n @ best[at], n @ total[at]
    keep = left.select(["row", *NUMBERS, "groups"])
    return keep.append_column("n_best", pa.array(sums[0])).append_column("count_sum", pa.array(sums[1]))


# ---- Spark side

def align(docs: DataFrame, tokenizers: str = TOKENIZERS, byte_bpe: str = BYTE_BPE, piece_bpe: str = PIECE_BPE,
          digest: bool = False, keep: list[str] | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``docs`` (or its columns ``keep``) with n_a, n_b, n_groups, n_links, n_best, count_sum and groups.

    ``groups`` lists the groups in order as ``a1,a2|b1;a3|b2,b3`` ('' without
    tokens); with ``digest`` it is the SHA-256 of that text, made in the task.
    """
    spark = docs.sparkSession
    files = []
    for name in (byte_bpe, piece_bpe):
        with open(f"{tokenizers.rstrip('/')}/{name}", "rb") as f:
            files.append(f.read())
    shared = spark.sparkContext.broadcast(tuple(files))
    row = F.struct(*(keep or docs.columns)).alias("row")
    source = docs.select(row, F.col("text"))
    schema = aligned_schema(source.schema["row"].dataType)
    chunks = stored(source.mapInArrow(aligner(shared, digest, chunk_bytes), schema), "aligned")

    entries = chunks.where("dict_a IS NOT NULL").select(
        "chunk", F.posexplode(F.arrays_zip("dict_a", "dict_b", "dict_docs")).alias("at", "e")).select(
        F.col("chunk").alias("part"), "at", F.col("e.dict_a").alias("a"), F.col("e.dict_b").alias("b"), F.col("e.dict_docs").alias("docs"))
    totals = entries.groupBy("a", "b").agg(F.sum("docs").alias("docs"))
    highest = totals.groupBy("a").agg(F.max("docs").alias("highest"))
    totals = totals.join(highest, "a").select("a", "b", "docs", (F.col("docs") == F.col("highest")).alias("best"))
    numbers = entries.drop("docs").join(totals, ["a", "b"]).select("part", "at", "docs", "best")

    rows = chunks.where("dict_a IS NULL").select("chunk", "row", *NUMBERS, "groups", "pair", "times")
    out = T.StructType([f for f in schema if f.name in ("row", *NUMBERS, "groups")]
                       + [T.StructField(c, T.LongType()) for c in ("n_best", "count_sum")])
    done = rows.groupBy("chunk").cogroup(numbers.groupBy("part")).applyInArrow(counted, out)
    new = [*NUMBERS, "n_best", "count_sum", "groups"]
    old = [F.col("row").getField(c).alias(c) for c in (keep or docs.columns) if c not in new]
    return done.select(*old, *new)


def op11_diagonal_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = align(table(spark, sf_dir, "documents"), digest=True, keep=["doc_id"])
    return out.withColumnRenamed("groups", "groups_sha256")
