"""Alignment of two tokenizations of the same text by pointer jumping, with corpus-wide counts.

Both tokenizers cut a text's bytes into tokens. Tokens of the two that share a byte are
linked; what hangs together is a group, and its ids say the same thing in both vocabularies.

1. Texts are encoded and aligned in chunks of bounded size, one after another on one line
   of bytes. Every token points to its farthest-right overlapping token: one of the other
   side whose range has the token's last byte. Pointers are replaced by the pointers of what
   they point to (successor doubling) until nothing changes; after a number of rounds that
   is the logarithm of the longest chain, every token points to the token that ends its
   group.
2. A chunk gives its distinct (A id, B id) pairs with the number of its documents that hold
   each, and one row per document with the pairs it holds, by their places in the chunk's
   sorted list. A pair that every document holds is one row per chunk.
3. Document counts are summed over the corpus, compared with the highest count of the pair's
   A id, and return to the chunks that have the pair, where the documents' sums are taken.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import shared_folder
from creditmart.llm.tokenizing import encoder

PIECES = "piece_bpe_32k.model"
#: Bytes of text that are aligned together at least; a longer text is a chunk by itself.
CHUNK_BYTES = 1 << 20

DIGEST = "groups_sha256"
_CHUNK_SCHEMA = (
    f"chunk long, pair long, docs long, doc_id long, n_a long, n_b long, n_groups long, n_links long, {DIGEST} string, held binary"
)
_RESULT_SCHEMA = (
    f"doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, {DIGEST} string"
)


@dataclass(frozen=True)
class Vocabulary:
    """Ids of texts, the bytes that each id stands for, and the bytes that ids stand for together."""

    encode: Callable[[list[str]], list[list[int]]]
    tokens: list[bytes]
    decode: Callable[[list[int]], bytes]

    def lengths(self) -> np.ndarray:
        return np.array([len(token) for token in self.tokens], dtype=np.int64)


def byte_level(ranks_path: str | None = None) -> Vocabulary:
    """The byte-level vocabulary over space + text; strings of special tokens are plain text."""
    coder = encoder(ranks_path)

    def encode(texts: list[str]) -> list[list[int]]:
        return [coder.encode_ordinary(" " + text) for text in texts]

    tokens = [coder.decode_single_token_bytes(i) for i in range(coder.n_vocab)]
    return Vocabulary(encode, tokens, coder.decode_bytes)


def pieces(model_path: str | None = None) -> Vocabulary:
    """The piece vocabulary over the text, to which it adds a space itself."""
    coder = sentencepiece.SentencePieceProcessor(model_file=model_path or public_tokenizers.path(PIECES))

    def written(i: int) -> bytes:
        piece = coder.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if coder.is_byte(i) else piece.replace("▁", " ").encode()

    tokens = [written(i) for i in range(coder.get_piece_size())]
    return Vocabulary(
        lambda texts: coder.encode(texts, num_threads=1), tokens, lambda ids: b"".join(map(tokens.__getitem__, ids))
    )


def tokens_before(ends: np.ndarray, size: int) -> np.ndarray:
    """How many tokens end at or before each of the bytes 0 to ``size``."""
    marks = np.zeros(size + 1, dtype=np.int32)
    marks[ends] = 1
    return np.cumsum(marks, dtype=np.int32, out=marks)


def group_ends(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token of A and of B, the number of the B token that ends its group.

    ``ends_a`` and ``ends_b`` are the increasing byte offsets where tokens end; both cover
    the same bytes. Tokens of a group are connected by overlaps.
    """
    n_a, n_b = len(ends_a), len(ends_b)
    size = int(ends_a[-1]) if n_a else 0
    # the other side's token that has a token's last byte reaches farthest of all that overlap it
    over_a = tokens_before(ends_b, size)[ends_a - 1]
    over_b = tokens_before(ends_a, size)[ends_b - 1]
    terminal = ends_a[over_b] == ends_b if n_b else np.zeros(0, dtype=bool)
    points = np.concatenate([n_a + over_a, np.where(terminal, n_a + np.arange(n_b), over_b)])
    while not np.array_equal(further := points[points], points):
        points = further
    return points[:n_a] - n_a, points[n_a:] - n_a


def _order(values: np.ndarray) -> np.ndarray:
    """Places of whole numbers from 0 up in order, equal ones as they come: sixteen bits at a time."""
    order, shift, most = np.argsort(values.astype(np.uint16), kind="stable"), 16, int(values.max(initial=0))
    while most >> shift:
        order = order[np.argsort((values >> shift).astype(np.uint16)[order], kind="stable")]
        shift += 16
    return order


def _planes(values: np.ndarray) -> bytes:
    """Unsigned 32-bit numbers with their bytes in planes, which compress far better."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _from_planes(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


class _Aligner:
    """Alignment of the documents of one chunk."""

    def __init__(self, a: Vocabulary, b: Vocabulary):
        self.a, self.b = a, b
        self.lengths = (a.lengths(), b.lengths())
        self.width = max(len(str(len(v.tokens) - 1)) for v in (a, b))
        numbers = np.array([str(i).encode() for i in range(max(len(a.tokens), len(b.tokens)))], dtype=f"S{self.width}")
        self.digits = numbers.view(np.uint8).reshape(len(numbers), self.width)

    def encoded(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of both sides for each text; none where a side does not give back the text's bytes."""
        plain = [text or "" for text in texts]
        found = []
        for text, *sides in zip(plain, self.a.encode(plain), self.b.encode(plain), strict=True):
            raw = b" " + text.encode()
            same = all(v.decode(ids) == raw for v, ids in zip((self.a, self.b), sides, strict=True))
            found.append(tuple(sides) if text and same else ([], []))
        return found

    def rows(self, chunk: int, doc_ids: list, texts: list[str | None]) -> Iterator[pa.RecordBatch]:
        """The chunk's pairs and documents."""
        docs, encoded = len(doc_ids), self.encoded(texts)
        sides = [np.fromiter(chain.from_iterable(ids[side] for ids in encoded), dtype=np.int64) for side in (0, 1)]
        sizes = [np.array([len(ids[side]) for ids in encoded]) for side in (0, 1)]
        ends = [np.cumsum(lengths[ids]) for lengths, ids in zip(self.lengths, sides, strict=True)]
        owners = [np.repeat(np.arange(docs), n) for n in sizes]
        last_a, last_b = group_ends(*ends)
        is_terminal = np.zeros(len(last_b), dtype=bool)
        is_terminal[last_b] = True
        group = np.cumsum(is_terminal) - is_terminal
        group_a, group_b = group[last_a], group[last_b]
        n_groups = np.bincount(owners[1][is_terminal], minlength=docs)

        # all overlapping pairs: of each A token, the B tokens from its first byte's to its last byte's
        before = tokens_before(ends[1], int(ends[0][-1]) if len(ends[0]) else 0)
        first = before[ends[0] - self.lengths[0][sides[0]]]
        number = before[ends[0] - 1] - first + 1
        at_b = np.repeat(first - (np.cumsum(number) - number), number) + np.arange(number.sum())
        keys = np.repeat(sides[0], number) * len(self.b.tokens) + sides[1][at_b]
        owner = np.repeat(owners[0], number)
        # links sorted by pair, then document: each pair's documents, and how often a document links it
        order = _order(keys)
        keys, linked_by = keys[order], owner[order]
        new_pair = np.diff(keys, prepend=-1) != 0
        held = np.flatnonzero(new_pair | (np.diff(linked_by, prepend=-1) != 0))
        times = np.diff(held, append=len(keys))
        pairs, held_place, held_by = keys[new_pair], np.cumsum(new_pair)[held] - 1, linked_by[held]
        in_docs = np.bincount(held_place, minlength=len(pairs))
        order = _order(held_by)
        held_place, held_by, times = held_place[order], held_by[order], times[order]
        yield self._batch(len(pairs), chunk, pair=pa.array(pairs), docs=pa.array(in_docs))

        cuts = np.searchsorted(held_by, np.arange(docs + 1))
        packed = []
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            steps = np.diff(held_place[start:end], prepend=0)
            packed.append(_planes(np.concatenate([steps, times[start:end]])))
        yield self._batch(
            docs,
            chunk,
            doc_id=pa.array(doc_ids, pa.int64()),
            n_a=pa.array(sizes[0]),
            n_b=pa.array(sizes[1]),
            n_groups=pa.array(n_groups),
            n_links=pa.array(np.bincount(owner, minlength=docs)),
            **{DIGEST: pa.array(self._digests(sides, sizes, group_a, group_b), pa.string())},
            held=pa.array(packed, pa.binary()),
        )

    def _digests(self, sides: list, sizes: list, group_a: np.ndarray, group_b: np.ndarray) -> list[str]:
        """Digest of each document's groups written out as ``a1,a2|b1;a3|b2,b3``."""
        n_a, n_b = len(sides[0]), len(sides[1])
        # place of a token where a group's A ids come before its B ids
        groups = int(group_b[-1]) + 1 if n_b else 0
        ends_of = [np.cumsum(np.bincount(group, minlength=groups)) for group in (group_a, group_b)]
        place_a = np.arange(n_a) + np.concatenate([[0], ends_of[1]])[group_a]
        place_b = np.arange(n_b) + ends_of[0][group_b]
        written = np.zeros((n_a + n_b, self.width + 1), dtype=np.uint8)
        written[place_a, :-1], written[place_b, :-1] = self.digits[sides[0]], self.digits[sides[1]]
        group, side = np.empty(n_a + n_b, dtype=np.int64), np.zeros(n_a + n_b, dtype=bool)
        group[place_a], group[place_b] = group_a, group_b
        side[place_b] = True
        after = np.where(side[1:] != side[:-1], ord("|"), ord(","))
        written[:-1, -1] = np.where(group[1:] != group[:-1], ord(";"), after)
        edges = np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])])
        written[edges[1:][edges[1:] > 0] - 1, -1] = 0
        digests = []
        for start, end in zip(edges[:-1], edges[1:], strict=True):
            text = written[start:end].tobytes().translate(None, b"\0")
            digests.append(hashlib.sha256(text).hexdigest() if end > start else "")
        return digests

    def _batch(self, rows: int, chunk: int, **columns: pa.Array) -> pa.RecordBatch:
        fields = [field.split() for field in _CHUNK_SCHEMA.split(", ")]
        kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}
        columns["chunk"] = pa.array(np.full(rows, chunk, dtype=np.int64))
        arrays = [columns.get(name, pa.nulls(rows, kinds[kind])).cast(kinds[kind]) for name, kind in fields]
        return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def _aligned_chunks(docs: DataFrame, a: Callable[[], Vocabulary], b: Callable[[], Vocabulary], chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner(a(), b())
        # unique in the written table, of which each task's rows are kept once
        chunk = TaskContext.get().partitionId() << 32
        doc_ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1), strict=True):
                doc_ids.append(doc_id.as_py())
                texts.append(text.as_py())
                size += len(texts[-1] or "") + 64
                if size >= chunk_bytes:
                    yield from aligner.rows(chunk, doc_ids, texts)
                    doc_ids, texts, size, chunk = [], [], 0, chunk + 1
        if doc_ids:
            yield from aligner.rows(chunk, doc_ids, texts)

    chosen = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    written = f"{shared_folder(docs.sparkSession)}/aligned-{uuid.uuid4().hex}"
    chosen.mapInArrow(run, _CHUNK_SCHEMA).write.parquet(written)
    return docs.sparkSession.read.parquet(written)


def pair_counts(chunks: DataFrame, size_b: int) -> DataFrame:
    """(pair, n, best): documents that hold a linked pair of ids, and whether no pair of the
    same A id is held by more. A pair is its A id times ``size_b`` plus its B id."""
    counts = chunks.where("pair IS NOT NULL").groupBy("pair").agg(F.sum("docs").alias("n"))
    a_id = F.expr(f"pair div {size_b}")
    # one row per id of the vocabulary at most
    highest = F.broadcast(counts.groupBy(a_id.alias("a")).agg(F.max("n").alias("top")))
    return counts.join(highest, a_id == F.col("a")).select("pair", "n", (F.col("n") == F.col("top")).alias("best"))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by chunk, pairs in order before documents, to the documents' sums."""
    chunk, counts, best, known = None, [], [], None
    for batch in batches:
        of_chunk = batch.column(0).to_numpy()
        is_pair = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
        edges = np.flatnonzero((np.diff(of_chunk) != 0) | np.diff(is_pair)) + 1
        cuts = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(cuts[:-1], cuts[1:], strict=True):
            if start == end:
                continue
            part = batch.slice(start, end - start)
            if of_chunk[start] != chunk:
                chunk, counts, best, known = of_chunk[start], [], [], None
            if is_pair[start]:
                counts.append(part.column(2).to_numpy())
                best.append(part.column(3).cast(pa.int64()).to_numpy())
                continue
            if known is None:
                none = np.zeros(0, dtype=np.int64)
                known = np.concatenate([none, *counts]), np.concatenate([none, *best])
            n_best, count_sum = [], []
            for raw in part.column(10):
                steps, times = np.split(_from_planes(raw.as_py()).astype(np.int64), 2)
                places = np.cumsum(steps)
                n_best.append(int((times * known[1][places]).sum()))
                count_sum.append(int((times * known[0][places]).sum()))
            kept = [part.column(i) for i in range(4, 9)]
            sums = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
            names = [field.split()[0] for field in _RESULT_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([*kept, *sums, part.column(9)], names=names)


def aligned(
    docs: DataFrame,
    a: Callable[[], Vocabulary] = byte_level,
    b: Callable[[], Vocabulary] = pieces,
    chunk_bytes: int = CHUNK_BYTES,
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row of ``docs``.

    Numbers of tokens, groups and links of a document; the links whose pair of ids is held by
    the most documents among the pairs of its A id, ties included; the sum of those document
    counts over the links; and the digest of the groups' ids. Null and empty texts, and texts
    that one of the vocabularies does not give back byte by byte, have no tokens: zeros and an
    empty digest. Repeated rows count as documents of their own. A null doc_id stays null.
    Other columns are left out; an empty table gives an empty result.
    """
    size_b = len(b().tokens)
    chunks = _aligned_chunks(docs, a, b, chunk_bytes)
    asked = chunks.where("pair IS NOT NULL").select("chunk", "pair")
    answered = asked.join(pair_counts(chunks, size_b), "pair").select("chunk", "pair", "n", "best")
    found = chunks.where("pair IS NULL").drop("pair", "docs")
    rows = answered.unionByName(found, allowMissingColumns=True)
    ordered = rows.repartition("chunk").sortWithinPartitions("chunk", F.col("pair").asc_nulls_last())
    columns = ["chunk", "pair", "n", "best", "doc_id", "n_a", "n_b", "n_groups", "n_links", DIGEST, "held"]
    return ordered.select(*columns).mapInArrow(_sums, _RESULT_SCHEMA)
