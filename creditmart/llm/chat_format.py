"""Conversations as token sequences with reserved ids and a loss mask.

Every turn is a few segments: the mark that opens a turn, its role, the mark that opens
the text, the text, the mark that ends the turn. Marks are ids beyond the vocabulary,
put between the ids of segments that are encoded apart, so no text can be encoded into
a mark. Control strings inside texts are escaped as well, so that the written form of a
conversation reads back to its turns.

Encoding is work per row, before any shuffle. A conversation's rows are then brought
together in order and pass one by one: positions are sums of the lengths before, and
nothing of a conversation is held but its running state, so its length does not matter.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from creditmart.llm.common import texts
from creditmart.llm.tokenizing import encoder

#: Written marks and their ids, the first beyond the vocabulary's 50,257.
MARKS = {"<s>": 50_257, "<|turn|>": 50_258, "<|text|>": 50_259, "<|end|>": 50_260}
START, TURN, TEXT, END = MARKS
#: Strings that control some chat template; inside texts they are escaped.
CONTROL = (
    *MARKS, "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|endoftext|>", "<|im_start|>", "<|im_end|>",
    "<|system|>", "<|user|>", "<|assistant|>", "<unk>", "<pad>",
)
LEARNED_ROLE = "assistant"
_ESCAPE = "\\"
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)
_CONTROL = re.compile("|".join(re.escape(c) for c in sorted((*CONTROL, _ESCAPE), key=len, reverse=True)))


def escaped(text: str) -> str:
    """The text with the escape sign doubled, and put behind the first character of control strings.

    The rest of a control string is looked at again, so no control string is left.
    """
    parts, at = [], 0
    while match := _CONTROL.search(text, at):
        parts += [text[at : match.start() + 1], _ESCAPE]
        at = match.start() + 1
    return "".join([*parts, text[at:]])


def unescaped(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def formatted(turns: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """One row per turn: conv_id, turn, place, token_start, ids, loss_start, loss_end, written.

    ``ids`` are the turn's tokens, ``token_start`` their position in the conversation,
    ``loss_start`` and ``loss_end`` the positions in the conversation between which the
    model learns: the text of an assistant's turn, an empty span for others. ``place``
    counts turns from 0; the first turn of a conversation starts with its start mark.

    Turns come by number, null first; turns with one number by role and text, and equal
    rows one after the other. Null roles and texts are empty. Rows without a conv_id
    are one conversation. Other columns are left out; an empty table gives an empty result.
    """
    encoded_schema = "conv_id long, turn long, role string, text string, written string, before array<int>, body array<int>"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path)
        names = ["conv_id", "turn", "role", "text", "written", "before", "body"]
        for batch in batches:
            written, before, body = [], [], []
            for role, text in zip(texts(batch.column(2)), texts(batch.column(3)), strict=True):
                role, text = escaped(role), escaped(text)
                written.append(f"{TURN}{role}{TEXT}{text}{END}")
                before.append([MARKS[TURN], *coder.encode_ordinary(role), MARKS[TEXT]])
                body.append(coder.encode_ordinary(text))
            lists = [pa.array(column, pa.list_(pa.int32())) for column in (before, body)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(written, pa.string()), *lists], names=names)

    chosen = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    schema = (
        "conv_id long, turn long, place long, token_start long, ids array<int>,"
        " loss_start long, loss_end long, written string"
    )

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, place, tokens = None, 0, 0
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                conversation = (row["conv_id"],)
                if conversation != here:
                    here, place, tokens = conversation, 0, 0
                first = [MARKS[START]] if place == 0 else []
                ids = [*first, *row["before"], *row["body"], MARKS[END]]
                start = tokens + len(first) + len(row["before"])
                end = start + len(row["body"]) if row["role"] == LEARNED_ROLE else start
                written = (START if place == 0 else "") + row["written"]
                rows.append((row["conv_id"], row["turn"], place, tokens, ids, start, end, written))
                place, tokens = place + 1, tokens + len(ids)
            if rows:
                kinds = (*[pa.int64()] * 4, pa.list_(pa.int32()), pa.int64(), pa.int64(), pa.string())
                arrays = [pa.array(column, kind) for column, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                names = [field.split()[0] for field in schema.split(", ")]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    ordered = (
        chosen.mapInArrow(encode, encoded_schema)
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
    )
    return ordered.mapInArrow(assemble, schema)


def read_back(rows: DataFrame, ranks_path: str | None = None) -> DataFrame:
    """What formatted turns say, per conversation: read from ids and loss spans alone.

    conv_id, n_turns, turns_sha256 (role, newline, text, newline of every turn),
    loss_chars and loss_sha256 (all text under the loss mask, unescaped), formatted_chars.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(ranks_path)
        marks = {number: mark for mark, number in MARKS.items()}
        here, state = None, None

        def text_of(ids: list[int]) -> str:
            return coder.decode_bytes(ids).decode()

        def closed() -> tuple:
            n, turns, chars, loss, written = state
            return (here[0], n, turns.hexdigest(), chars, loss.hexdigest(), written)

        def batch_of(done: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            columns = zip(*done, strict=True)
            arrays = [pa.array(column, kind) for column, kind in zip(columns, kinds, strict=True)]
            names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if (row["conv_id"],) != here:
                    if here is not None:
                        done.append(closed())
                    here, state = (row["conv_id"],), [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                ids = row["ids"]
                turn, text, end = (ids.index(MARKS[mark]) for mark in (TURN, TEXT, END))
                role, said = (unescaped(text_of(part)) for part in (ids[turn + 1 : text], ids[text + 1 : end]))
                learned = ids[row["loss_start"] - row["token_start"] : row["loss_end"] - row["token_start"]]
                under = unescaped(text_of(learned))
                state[0] += 1
                state[1].update(f"{role}\n{said}\n".encode())
                state[2] += len(under)
                state[3].update(under.encode())
                plain, written = [], 0
                for number in [*ids, -1]:
                    if number in marks or number == -1:
                        written += len(text_of(plain)) + len(marks.get(number, ""))
                        plain = []
                    else:
                        plain.append(number)
                state[4] += written
            if done:
                yield batch_of(done)
        if here is not None:
            yield batch_of([closed()])

    schema = (
        "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"
    )
    ordered = rows.repartition("conv_id").sortWithinPartitions("conv_id", "place")
    return ordered.mapInArrow(run, schema)
