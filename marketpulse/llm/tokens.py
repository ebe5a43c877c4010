"""Token ids of whole texts through the tokenizers library, word by word with a cache.

A text is cut where its tokenizer can never merge across: between words. Only
words not seen before are encoded; many of them are encoded in one call,
joined by the vocabulary's own separator token, and the ids are cut apart at
that token again. The result equals encoding the whole text in one call.

``byte`` vocabularies (byte-level BPE) keep white space: a chunk starts at a
blank, or after a line feed. The pre-tokenizer takes a blank with the word that
follows it and never crosses a change from non-space to space, so such cuts are
safe where the blank or line feed stands alone; a text with other white space
next to each other is encoded whole. ``word`` vocabularies drop white space, so
any white space is a cut. Both pre-tokenizers end a run of letters or digits
before a full stop or comma, so that is a cut too (in texts where these two follow
nothing else), and ``word`` vocabularies fold case, so their texts are
lower-cased before the cut where that is the same thing.
"""

from __future__ import annotations

import re
from unicodedata import is_normalized

import numpy as np

# white space other than single blanks and line feeds
_PAIRS = ("  ", " \n", "\n ", "\n\n")
_ODD = ("\t\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000"
        + "".join(map(chr, range(0x2000, 0x200b))))
# a full stop or comma after anything but a letter or digit
_MARK = re.compile(r"(?<![^\W_])[.,]")
# characters that str.split() takes for white space and the vocabularies do not
_SEPARATORS = "\x1c\x1d\x1e\x1f"
_CACHED_CHUNKS = 300_000  # about 400 bytes each
_ENCODERS: dict[tuple, Encoder] = {}


class _Codes(dict):
    """Chunk -> code; an unknown chunk gets the next code and is noted as new."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, chunk):
        self[chunk] = code = len(self)
        self.new.append(chunk)
        return code


class Encoder:
    """Encodes texts to ids; use :func:`encoder`, which keeps one per process."""

    def __init__(self, path: str, kind: str, separator: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        if kind not in ("byte", "word"):
            raise ValueError("kind must be byte or word")
        self.kind, self.separator = kind, separator
        self._tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.plain.get_added_tokens_decoder().values() if t.content != separator]
        self.separator_id = self.split.token_to_id(separator)
        self.vocabulary = self.plain.get_vocab_size(with_added_tokens=True)
        self._forget()

    @property
    def split(self):
        """The tokenizer, finding the separator."""
        self._tokenizer.encode_special_tokens = False
        return self._tokenizer

    @property
    def plain(self):
        """The same tokenizer, taking the separator as ordinary text."""
        self._tokenizer.encode_special_tokens = True
        return self._tokenizer

    def _forget(self, keep: np.ndarray | None = None) -> None:
        """Keep only the chunks of the given codes (none at the start)."""
        old = self.codes if keep is not None else {}
        self.codes = _Codes()
        if keep is None or not len(keep):
            self.starts, self.sizes, self.uses = (np.zeros(0, np.int64) for _ in range(3))
            self.ids = np.zeros(0, np.uint32)
            return
        chunks = list(old)
        self.codes.update(zip([chunks[i] for i in keep.tolist()], range(len(keep))))
        self.ids = self._spread(keep)
        self.sizes = self.sizes[keep]
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.uses = np.zeros(len(keep), np.int64)

    def _spread(self, codes: np.ndarray) -> np.ndarray:
        """The ids of a sequence of codes."""
        n = self.sizes[codes]
        ends = np.cumsum(n)
        return self.ids[np.repeat(self.starts[codes] - ends + n, n) + np.arange(int(ends[-1]) if len(ends) else 0)]

    def _learn(self) -> None:
        new, self.codes.new = self.codes.new, []
        parts, sizes = [self.ids], []
        for i in range(0, len(new), 20_000):
            chunks = new[i:i + 20_000]
            joined = self.separator.join(chunks)
            if joined.count(self.separator) == len(chunks) - 1 and not any(t in joined for t in self.special):
                ids = np.array(self.split.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.uint32)
                at = np.flatnonzero(ids == self.separator_id)
                sizes.append(np.diff(np.concatenate([[-1], at, [len(ids)]])) - 1)
                parts.append(ids[ids != self.separator_id])
            else:  # some chunk holds a special token's text
                one = [self.plain.encode(c, add_special_tokens=False).ids for c in chunks]
                sizes.append(np.array([len(x) for x in one], np.int64))
                parts.append(np.array([y for x in one for y in x], np.uint32))
        if new:
            self.ids = np.concatenate(parts)
            self.sizes = np.concatenate([self.sizes, *sizes])
            self.starts = np.cumsum(self.sizes) - self.sizes
            self.uses = np.append(self.uses, np.zeros(len(new), np.int64))

    def _chunks(self, text: str) -> list[str]:
        if self.kind == "word":
            if any(c in text for c in _SEPARATORS):
                return [text]
            if text.isascii() or ("\u03a3" not in text and is_normalized("NFC", text)
                                  and is_normalized("NFC", text.lower())):
                text = text.lower()
            else:  # a capital sigma's or a mark's place may matter
                return text.split()
            if _MARK.search(text):
                return text.split()
            return text.replace(",", " ,").replace(".", " .").split()
        if any(p in text for p in _PAIRS) or any(c in text for c in _ODD):
            return [text]
        text = text.replace("\n", "\n\x1f").replace(" ", "\x1f ")
        if not _MARK.search(text):
            text = text.replace(",", "\x1f,").replace(".", "\x1f.")
        return text.split("\x1f")

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids (uint32) of each text."""
        if len(self.codes) > _CACHED_CHUNKS:  # keep what came up again since the last time
            again = np.flatnonzero(self.uses > 1)
            self._forget(again[np.argsort(-self.uses[again], kind="stable")[:_CACHED_CHUNKS // 2]])
        coded, whole = [], {}
        for i, text in enumerate(texts):
            chunks = self._chunks(text)
            if len(chunks) == 1 and len(text) > 200:  # not worth a place in the cache
                whole[i] = np.array(self.plain.encode(text, add_special_tokens=False).ids, np.uint32)
                chunks = []
            coded.append(np.fromiter(map(self.codes.__getitem__, chunks), np.int64, len(chunks)))
        self._learn()
        everything = np.concatenate(coded) if coded else np.zeros(0, np.int64)
        self.uses += np.bincount(everything, minlength=len(self.uses))
        ids = self._spread(everything)
        ends = np.concatenate([[0], np.cumsum(self.sizes[everything])])[np.cumsum([0] + [len(c) for c in coded])].tolist()
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(zip(ends[:-1], ends[1:]))]


def encoder(path: str, kind: str, separator: str) -> Encoder:
    """The process's encoder for a vocabulary file (kept between tasks of a worker)."""
    key = (path, kind, separator)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(*key)
    return _ENCODERS[key]


def slices(texts: list[str], size: int = 4 << 20):
    """Consecutive ``(first, texts)`` groups of about ``size`` characters."""
    first, n = 0, 0
    for i, t in enumerate(texts):
        n += len(t)
        if n >= size:
            yield first, texts[first:i + 1]
            first, n = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def arrow_slices(batch, column: str = "text", size: int = 1 << 20):
    """Consecutive parts of an Arrow batch of about ``size`` bytes of ``column`` (a row at least).

    Parts share the batch's buffers, so Python objects exist of one part at a time.
    """
    import pyarrow.compute as pc

    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    first, given = 0, 0
    while first < len(ends):
        end = max(first + 1, int(np.searchsorted(ends, given + size, side="right")))
        yield batch.slice(first, end - first)
        first, given = end, int(ends[end - 1])
