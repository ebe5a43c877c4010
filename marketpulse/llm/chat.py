"""Chat formatting at token level, with reversible escapes and loss masks.

A turn becomes

    <s>[INST]role[/INST]text</s>

The four marks are reserved ids beyond the vocabulary, spliced between the ids
of the separately encoded role and text, so no content can produce a mark. In
the rendered text a content's control strings are escaped too: a backslash
is doubled, and a control string gets one after its first character. Loss masks
are prefix sums of +1 at the first and -1 after the last token under the loss;
positions in the conversation are prefix sums of the turns' token counts.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketpulse.llm.common import written
from marketpulse.llm.tokens import encoder

MARKS = ("<s>", "[INST]", "[/INST]", "</s>")
CONTROL = (*MARKS, "<<SYS>>", "<</SYS>>")
LOSS_ROLE = "assistant"
CHUNK = 1024
_FIND = re.compile("|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """Break up control strings; :func:`unescape` restores the text exactly."""
    text = text.replace("\\", "\\\\")
    while True:  # a replacement can uncover an overlapping control string
        broken = _FIND.sub(lambda m: f"{m[0][0]}\\{m[0][1:]}", text)
        if broken == text:
            return text
        text = broken


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _encode(path: str, loss_role: str):
    def run(frames):
        import pandas as pd

        enc = encoder(path, "byte", "<|endoftext|>")
        marks = np.arange(enc.vocabulary, enc.vocabulary + len(MARKS), dtype=np.uint32)
        for frame in frames:
            roles, texts = frame["role"].tolist(), frame["text"].tolist()
            coded = enc.encode([escape(x) for x in roles] + [escape(x) for x in texts])
            ids, masks = [], []
            for role, head, body in zip(roles, coded[:len(roles)], coded[len(roles):]):
                segments = [marks[:1], marks[1:2], head, marks[2:3], body, marks[3:]]
                ends = np.cumsum([len(s) for s in segments])
                steps = np.zeros(ends[-1] + 1, np.int8)
                if role == loss_role:
                    steps[ends[3]] += 1
                    steps[ends[4]] -= 1
                ids.append(np.concatenate(segments).astype("<u4").tobytes())
                masks.append(np.cumsum(steps[:-1]).astype(np.uint8).tobytes())
            yield pd.DataFrame({"conv_id": frame["conv_id"], "turn": frame["turn"], "ids": ids, "loss_mask": masks})

    return run


def format_turns(turns: DataFrame, tokenizer: str, loss_role: str = LOSS_ROLE) -> DataFrame:
    """One row per turn: ``conv_id, turn, start, ids, loss_mask``.

    ``ids`` are little-endian unsigned 32-bit, ``loss_mask`` one byte a token,
    ``start`` the turn's first token position in its conversation. Null
    role or text counts as empty. Turns are ordered by ``turn`` (null first), ties by
    role and text; repeated rows all stay. A null ``conv_id`` is one
    conversation. Extra columns are ignored; an empty table gives no rows.
    """
    rows = (turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"),
                         F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
            .mapInPandas(_encode(tokenizer, loss_role), "conv_id long, turn long, ids binary, loss_mask binary"))
    rows = written(rows, "chat-turns")  # read for the chunks and for their sums: encoded once
    # two-level prefix sums, so that no window holds a long conversation: within
    # chunks of turn numbers, then over the chunks of a conversation
    rows = rows.withColumn("n", F.octet_length("ids") / 4).withColumn("chunk", F.floor(F.col("turn") / CHUNK))
    inner = Window.partitionBy("conv_id", "chunk").orderBy("turn", "ids").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("upto", F.sum("n").over(inner))
    chunks = rows.groupBy("conv_id", "chunk").agg(F.sum("n").alias("total"))
    outer = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("base", F.coalesce(F.sum("total").over(outer), F.lit(0))).alias("c")
    r = rows.alias("r")
    return (r.join(chunks, F.col("r.conv_id").eqNullSafe(F.col("c.conv_id")) & F.col("r.chunk").eqNullSafe(F.col("c.chunk")))
            .select("r.conv_id", "r.turn", (F.col("base") + F.col("upto") - F.col("n")).cast("long").alias("start"),
                    "r.ids", "r.loss_mask"))


def _decode(path: str):
    def run(frames):
        import pandas as pd

        enc = encoder(path, "byte", "<|endoftext|>")
        first = enc.vocabulary
        for frame in frames:
            heads, bodies, losses = [], [], []
            for ids, mask in zip(frame["ids"], frame["loss_mask"]):
                ids = np.frombuffer(ids, "<u4")
                at = np.flatnonzero(ids >= first)
                if (ids[at] - first).tolist() != [0, 1, 2, 3]:
                    raise ValueError("not a formatted turn")
                heads.append(ids[at[1] + 1:at[2]].tolist())
                bodies.append(ids[at[2] + 1:at[3]].tolist())
                losses.append(ids[np.frombuffer(mask, np.uint8) > 0].tolist())
            heads, bodies, losses = (enc.plain.decode_batch(x, skip_special_tokens=False) for x in (heads, bodies, losses))
            yield pd.DataFrame({"conv_id": frame["conv_id"], "turn": frame["turn"], "start": frame["start"],
                                "role": [unescape(x) for x in heads], "text": [unescape(x) for x in bodies],
                                "loss_text": [unescape(x) for x in losses],
                                "n_chars": [len(a) + len(b) + sum(map(len, MARKS)) for a, b in zip(heads, bodies)]})

    return run


def read_turns(formatted: DataFrame, tokenizer: str) -> DataFrame:
    """``conv_id, turn, start, role, text, loss_text, n_chars`` decoded from formatted turns."""
    return formatted.mapInPandas(_decode(tokenizer), "conv_id long, turn long, start long, role string, text string, "
                                                     "loss_text string, n_chars long")


def conversation_digests(turns: DataFrame) -> DataFrame:
    """Per conversation ``n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars`` of read turns.

    A digest of a conversation is a chain over its turns, so they come to
    one task in order; it keeps two running hashes and no turns.
    """

    def run(frames):
        import pandas as pd

        now, state = None, None
        columns = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]

        def row():
            return (now[0], state[0], state[1].hexdigest(), state[2], state[3].hexdigest(), state[4])

        for frame in frames:
            out = []
            for conv, none, role, text, loss, n in zip(frame["conv_id"], frame["no_id"], frame["role"], frame["text"],
                                                       frame["loss_text"], frame["n_chars"]):
                key = (None if none else int(conv),)
                if key != now:
                    if now is not None:
                        out.append(row())
                    now, state = key, [0, hashlib.sha256(), 0, hashlib.sha256(), 0]
                state[0] += 1
                state[1].update(f"{role}\n{text}\n".encode())
                state[2] += len(loss)
                state[3].update(loss.encode())
                state[4] += int(n)
            if out:
                yield pd.DataFrame(out, columns=columns).astype({"conv_id": "Int64"})
        if now is not None:
            yield pd.DataFrame([row()], columns=columns).astype({"conv_id": "Int64"})

    rows = turns.select(F.coalesce("conv_id", F.lit(0)).alias("conv_id"), F.col("conv_id").isNull().alias("no_id"),
                        "start", "role", "text", "loss_text", "n_chars")
    return (rows.repartition("no_id", "conv_id").sortWithinPartitions("no_id", "conv_id", "start")
            .mapInPandas(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
                              "formatted_chars long"))
