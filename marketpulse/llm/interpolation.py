"""Language-model scores by deleted interpolation of bigram, unigram and uniform estimates.

    P(w | h) = l2(b) c(h, w) / c(h) + l1(b) c(w) / N + l0(b) / (V + 1)

with one set of weights per bucket b = log2 of the context's count. The weights
are learned by expectation-maximisation on a deleted part of the training documents
(``DELETED_REMAINDER``): their tokens are predicted from the counts of the
other part. EM sees them as counts per (bucket, estimates rounded to an eighth
of a power of two), a table whose size does not depend on the corpus. The score
then uses the counts of all training documents.

Counting and looking up go by request and reply. Documents are dealt into
blocks of about ``BLOCK_CHARS`` characters. A block sends, for each range of the
64-bit key space, its distinct unigram or bigram keys (sorted, differences packed
in as few bytes as needed) with their counts: the map-side aggregate, so a word
however frequent is one key per block. A range's task sums all blocks' counts
and replies to each block in the order of its request; a block's text then meets its
replies. No model is broadcast or collected; what moves grows with the
corpus. Words are identified by a 64-bit hash, bigrams by 56 bits of one.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketpulse.llm.common import exchange_size, released_shuffles, text_or_empty
from marketpulse.llm.packed import pack_counts, pack_keys, range_edges, unpack_counts, unpack_keys
from marketpulse.session import scratch_path

MOD, HELD_OUT, DELETED_REMAINDER = 7, 2, 5
BLOCK_CHARS = 8 << 20
RANGE_CHARS = 16 << 20
BUCKETS = 64  # log2 of any count there can be
STEPS = 8  # rounding of estimates for EM: steps per power of two
END = np.uint64(0x9E3779B97F4A7C15)  # key of the end token; any constant no word hashes to
_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))
_CACHED = 250_000
REQUEST = "kind int, part int, block int, keys binary, train binary, deleted binary"
REPLY = "kind int, part int, block int, train binary, deleted binary, stats array<long>"


class _Words(dict):
    """Word (bytes) -> index of its 64-bit hash."""

    def __init__(self):
        super().__init__()
        self.hashes: list[int] = []

    def __missing__(self, word):
        from xxhash import xxh64_intdigest

        self[word] = i = len(self)
        self.hashes.append(xxh64_intdigest(word))
        return i


_WORDS = _Words()


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, sizes)``: the keys of all tokens, an end after each text, and tokens per text."""
    if len(_WORDS) > _CACHED:
        _WORDS.clear()
        _WORDS.hashes.clear()
    parts, sizes = [], np.empty(len(texts), np.int64)
    for i, text in enumerate(texts):
        words = text.encode().translate(_LOWER).split()
        parts.append(np.fromiter(map(_WORDS.__getitem__, words), np.int64, len(words)))
        sizes[i] = len(words) + 1
    keys = np.full(int(sizes.sum()), END, np.uint64)
    inner = np.ones(len(keys), bool)
    inner[np.cumsum(sizes) - 1] = False
    if parts:
        keys[inner] = np.array(_WORDS.hashes, np.uint64)[np.concatenate(parts)]
    return keys, sizes


def bigrams(keys: np.ndarray) -> np.ndarray:
    """56-bit keys of each token with the one before it; a text starts after an end token."""
    before = np.concatenate([[END], keys[:-1]]).astype(np.uint64)
    x = before * np.uint64(0xBF58476D1CE4E5B9) + (keys ^ keys >> np.uint64(31)) * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x9E3779B97F4A7C15)
    return (x ^ x >> np.uint64(32)) >> np.uint64(8)


def _distinct(frame):
    """Per kind (1 unigram, 2 bigram): sorted distinct keys and each token's place among them."""
    keys, sizes = tokens(frame["text"].tolist())
    return sizes, [np.unique(k, return_inverse=True) for k in (keys, bigrams(keys))]


def _request(parts: int):
    def run(frame):
        import pandas as pd

        sizes, kinds = _distinct(frame)
        remainder = np.repeat(frame["remainder"].to_numpy(), sizes)
        block = int(frame["block"].iloc[0])
        out = []
        for kind, (keys, place) in enumerate(kinds, 1):
            train = np.bincount(place[remainder != HELD_OUT], minlength=len(keys))
            deleted = np.bincount(place[remainder == DELETED_REMAINDER], minlength=len(keys))
            for part, a, b in range_edges(keys, parts, 64 if kind == 1 else 56):
                out.append((kind, part, block, pack_keys(keys[a:b]), pack_counts(train[a:b]), pack_counts(deleted[a:b])))
        return pd.DataFrame(out, columns=["kind", "part", "block", "keys", "train", "deleted"])

    return run


def _reply(frame):
    import pandas as pd

    asked = [unpack_keys(k) for k in frame["keys"]]
    keys, place = np.unique(np.concatenate(asked), return_inverse=True)
    train, deleted = (np.bincount(place, np.concatenate([unpack_counts(c) for c in frame[n]]), len(keys)).astype(np.int64)
                      for n in ("train", "deleted"))
    kind, part = int(frame["kind"].iloc[0]), int(frame["part"].iloc[0])
    out, at = [], 0
    for block, own in zip(frame["block"], asked):
        mine = place[at:at + len(own)]
        at += len(own)
        out.append((kind, part, block, pack_counts(train[mine]), pack_counts(deleted[mine]), None))
    if kind == 1:
        kept = train - deleted
        out.append((0, part, -1, b"", b"", [int(train.sum()), int((train > 0).sum()), int(kept.sum()), int((kept > 0).sum())]))
    return pd.DataFrame(out, columns=["kind", "part", "block", "train", "deleted", "stats"])


def _counts(frame, replies):
    """``(sizes, c(w), c(h), c(h, w))`` of a block's tokens, each with its deleted part's counts."""
    sizes, kinds = _distinct(frame)
    found = []
    for kind, (keys, place) in enumerate(kinds, 1):
        mine = replies[replies["kind"] == kind].sort_values("part")
        found.append([np.concatenate([unpack_counts(c) for c in mine[n]])[place] for n in ("train", "deleted")])
    words, pairs = found
    ends = np.cumsum(sizes) - 1
    # the count of the end token as a context is the number of texts, as of a token
    contexts = [np.concatenate([c[ends[:1]], c[:-1]]) for c in words]
    return sizes, words, contexts, pairs


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(context + 1).astype(np.int64), BUCKETS - 1)


def _histogram(n: int, v: int):
    """EM's view of the deleted texts: tokens per (bucket, rounded bigram and unigram estimate)."""

    def run(_, frame, replies):
        import pandas as pd

        columns = ["bucket", "two", "one", "n"]
        if not len(frame):
            return pd.DataFrame([], columns=columns).astype("int64")
        sizes, words, contexts, pairs = _counts(frame, replies)
        word, context, pair = (x[0] - x[1] for x in (words, contexts, pairs))
        with np.errstate(divide="ignore"):
            two = np.where(pair > 0, np.round(STEPS * np.log2(np.maximum(pair, 1) / np.maximum(context, 1) * (v + 1))), -10_000)
            one = np.where(word > 0, np.round(STEPS * np.log2(np.maximum(word, 1) / max(n, 1) * (v + 1))), -10_000)
        cells, count = np.unique(np.stack([_bucket(context), two, one], axis=1).astype(np.int64), axis=0, return_counts=True)
        return pd.DataFrame(np.column_stack([cells, count]), columns=columns)

    return run


def learn_weights(cells: np.ndarray, rounds: int = 100) -> np.ndarray:
    """EM: weights ``(BUCKETS, 3)`` of bigram, unigram and uniform estimates.

    ``cells`` has rows (bucket, rounded log estimates of bigram and unigram relative to the
    uniform one, tokens). A bucket without tokens takes the weights of the next
    lower one; the uniform weight stays positive, so no text has probability zero.
    """
    weights = np.empty((BUCKETS, 3))
    before = np.array([0.0, 0.5, 0.5])
    for b in range(BUCKETS):
        mine = cells[cells[:, 0] == b]
        now = np.array([0.0, 0.5, 0.5]) if b == 0 else np.array([1, 1, 1]) / 3
        if not len(mine):
            now = before
        else:
            p = np.stack([np.exp2(mine[:, 1] / STEPS), np.exp2(mine[:, 2] / STEPS), np.ones(len(mine))], axis=1)
            n = mine[:, 3:]
            for _ in range(rounds):
                share = now * p
                now = (share / share.sum(1, keepdims=True) * n).sum(0) / n.sum()
            now = np.maximum(now, [0.0, 1e-6, 1e-6])
            now = now / now.sum()
        weights[b] = before = now
    return weights


def _score(n: int, v: int, weights: np.ndarray):
    def run(_, frame, replies):
        import pandas as pd

        columns = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
        if not len(frame):
            return pd.DataFrame([], columns=columns)
        sizes, (word, _), (context, _), (pair, _) = _counts(frame, replies)
        mix = weights[_bucket(context)]
        p = mix[:, 0] * (pair / np.maximum(context, 1)) + mix[:, 1] * (word / max(n, 1)) + mix[:, 2] / (v + 1)
        starts = np.cumsum(sizes) - sizes
        return pd.DataFrame({
            "doc_id": frame["doc_id"].to_numpy(), "held_out": frame["remainder"].to_numpy() == HELD_OUT,
            "n_tokens": sizes, "n_known": np.add.reduceat(word > 0, starts, dtype=np.int64), "train_tokens": n,
            "base_score": np.add.reduceat(np.log10((word + 1) / (n + v + 1)), starts),
            "score": np.add.reduceat(np.log10(p), starts)})[columns]

    return run


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          block_chars: int | None = None, range_chars: int | None = None) -> DataFrame:
    """One row per input row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    Scores are log10 probabilities of the whole text and its end. Null and empty texts
    are an end alone. Without training documents every count is 0 and all
    estimates are uniform. A null id counts as the empty string for the split.
    Repeated rows are separate documents; extra columns are ignored; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).alias("text"))
    size = rows.agg(F.sum(F.length("text") + 64)).first()[0] or 0
    blocks = max(1, -(-size // (block_chars or exchange_size(size, BLOCK_CHARS, 640))))
    parts = max(1, -(-size // (range_chars or exchange_size(size, RANGE_CHARS, 640))))
    # the deleted part has blocks of its own after the others, so EM reads no other text
    place = F.xxhash64("doc_id", "text")
    block = F.when(F.col("remainder") == DELETED_REMAINDER, blocks + F.pmod(place, F.lit(-(-blocks // MOD))))
    rows = (rows.withColumn("remainder", (F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % MOD).cast("int"))
            .withColumn("block", block.otherwise(F.pmod(place, F.lit(blocks))).cast("int")))
    folder = scratch_path(spark, "lm-replies")
    with released_shuffles(spark):
        (rows.groupBy("block").applyInPandas(_request(parts), REQUEST)
         .groupBy("kind", "part").applyInPandas(_reply, REPLY).write.parquet(folder))
    replies = spark.read.schema(REPLY).parquet(folder)
    stats = replies.where("kind = 0").select(*[F.sum(F.col("stats")[i]) for i in range(4)]).first()
    n, v, n_kept, v_kept = (x or 0 for x in stats)

    deleted = rows.where(F.col("remainder") == DELETED_REMAINDER)
    asked = replies.where((F.col("kind") > 0) & (F.col("block") >= blocks))
    with released_shuffles(spark):
        cells = (deleted.groupBy("block").cogroup(asked.groupBy("block"))
                 .applyInPandas(_histogram(n_kept, v_kept), "bucket long, two long, one long, n long")
                 .groupBy("bucket", "two", "one").agg(F.sum("n").alias("n")).collect())  # bounded by the rounding
    weights = learn_weights(np.array([tuple(r) for r in cells], np.float64).reshape(-1, 4))
    return rows.groupBy("block").cogroup(replies.where("kind > 0").groupBy("block")).applyInPandas(
        _score(n, v, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
                               "base_score double, score double")
