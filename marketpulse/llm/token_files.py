"""Flat token files with 64-bit document offsets, memory-mapped on reading.

Documents are range-partitioned and sorted on their id. Each task writes, in the
shared folder, its tokens as one flat file of unsigned integers (16 bits if
the vocabulary allows, else 32), its documents' offsets into that file as
unsigned 64-bit integers (one more than documents) and their ids. Only one row per file
(name, documents, tokens) reaches the driver; the files' bases are the prefix
sums of those counts, written with the names as the manifest. Files carry the
task attempt in their name and the manifest names those of the successful
attempts, so a repeated task leaves at most an unnamed file behind.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketpulse.llm.common import text_or_empty
from marketpulse.llm.tokens import encoder, slices

END_ID = 1
TIE_CHARS = 256
NO_ID = -(1 << 63)  # stands for a null id in the id files


# schemes that Spark's connectors use for stores which pyarrow knows by another name, or as a mounted folder
SCHEMES = {"s3a": "s3://", "s3n": "s3://", "abfss": "abfs://", "wasbs": "abfs://", "dbfs": "/dbfs/"}


def store_uri(folder: str) -> str:
    """The folder as pyarrow names it."""
    scheme, colon, rest = folder.partition(":")
    if not colon or scheme not in SCHEMES:
        return folder
    return SCHEMES[scheme] + rest.lstrip("/")


def _store(folder: str):
    """``(filesystem, path)`` of a folder URI (or an absolute local path)."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(store_uri(folder))


def _write_task(folder: str, path: str, separator: str, end_id: int):
    def run(frames):
        import pandas as pd

        enc = encoder(path, "word", separator)
        kind = "<u2" if max(enc.vocabulary, end_id + 1) <= 1 << 16 else "<u4"
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}"
        files, root = _store(folder)
        offsets, ids, total = [np.zeros(1, "<u8")], [], 0
        out = None
        for frame in frames:
            keys = frame["doc_id"].to_numpy()
            for at, texts in slices(frame["text"].tolist()):
                coded = [np.append(x, np.uint32(end_id)) for x in enc.encode(texts)]
                if out is None:
                    out = files.open_output_stream(f"{root}/{name}.tokens")
                out.write(np.concatenate(coded).astype(kind).tobytes())
                ends = total + np.cumsum([len(x) for x in coded])
                total = int(ends[-1])
                offsets.append(ends.astype("<u8"))
                ids.append(keys[at:at + len(texts)].astype("<i8"))
        if out is None:
            return
        out.close()
        for suffix, parts in (("offsets", offsets), ("ids", ids)):
            with files.open_output_stream(f"{root}/{name}.{suffix}") as f:
                f.write(np.concatenate(parts).tobytes())
        yield pd.DataFrame({"part": [task.partitionId()], "name": [name], "kind": [kind],
                            "n_docs": [sum(map(len, ids))], "n_tokens": [total]})

    return run


def write_token_files(docs: DataFrame, folder: str, tokenizer: str, separator: str = "<|startoftext|>",
                      id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> list[dict]:
    """Write ``docs`` in ascending id order under ``folder``; returns (and stores) the manifest.

    Null or empty text is the end id alone. Null ids come first. Rows of one
    id are separate documents, next to each other in the order of their texts' first
    ``TIE_CHARS`` characters, then of a hash, so many of them are several files. An empty table writes an empty manifest. Extra columns are ignored.
    """
    files, root = _store(folder)
    files.create_dir(root, recursive=True)
    rows = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"),
                       text_or_empty(text_col).alias("text"))
    order = ["doc_id", F.substring("text", 1, TIE_CHARS), F.xxhash64("text")]
    counts = (rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
              .mapInPandas(_write_task(folder, tokenizer, separator, end_id),
                           "part int, name string, kind string, n_docs long, n_tokens long")
              .collect())  # one row per file
    manifest, doc_base, token_base = [], 0, 0
    for r in sorted(counts, key=lambda r: r.part):
        manifest.append({"name": r.name, "kind": r.kind, "n_docs": r.n_docs, "n_tokens": r.n_tokens,
                         "doc_base": doc_base, "token_base": token_base})
        doc_base, token_base = doc_base + r.n_docs, token_base + r.n_tokens
    with files.open_output_stream(f"{root}/manifest.json") as f:
        f.write(json.dumps(manifest).encode())
    return manifest


def read_manifest(folder: str) -> list[dict]:
    files, root = _store(folder)
    with files.open_input_stream(f"{root}/manifest.json") as f:
        return json.loads(f.read())


def open_part(folder: str, entry: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(tokens, offsets, ids)`` of one part, memory-mapped where the store is a mounted folder."""
    from pyarrow import fs

    files, root = _store(folder)
    local = isinstance(files, fs.LocalFileSystem)

    def one(suffix, kind):
        file = f"{root}/{entry['name']}.{suffix}"
        if local:
            return np.memmap(file, kind, "r")
        with files.open_input_file(file) as f:
            return np.frombuffer(f.read(), kind)

    return one("tokens", entry["kind"]), one("offsets", "<u8"), one("ids", "<i8")


def _read_task(folder: str):
    def run(frames):
        import pandas as pd

        for frame in frames:
            for entry in map(json.loads, frame["entry"]):
                tokens, offsets, ids = open_part(folder, entry)
                for at in range(0, len(ids), 5000):
                    ends = offsets[at:at + 5001].astype("int64")
                    crc = [zlib.crc32(tokens[a:b].astype("<u4").tobytes())
                           for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
                    keys = pd.Series(ids[at:at + 5000].astype("int64"), dtype="Int64")
                    yield pd.DataFrame({"doc_id": keys.mask(keys == NO_ID), "start": entry["token_base"] + ends[:-1],
                                        "n_tokens": np.diff(ends), "ids_crc32": np.array(crc, "int64")})

    return run


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, read back from the files, one task per file."""
    entries = [(json.dumps(e),) for e in read_manifest(folder)]
    parts = spark.createDataFrame(entries, "entry string")
    if len(entries) > 1:
        parts = parts.repartition(len(entries))
    return parts.mapInPandas(_read_task(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")
