"""Encoding inside tasks: a worker-wide memo of space-separated chunks in front of the ``tokenizers`` library.

Both tokenizers used here split a text at white space before merging, so the ids of a text are the ids of its chunks
in order.  Chunks repeat far more than texts do; each worker keeps the ids of at most ``MEMO_CHUNKS`` of them and the
library encodes the others.  Texts whose white space makes a chunk border unsafe go to the library whole.
"""

from __future__ import annotations

import os
import re
from array import array
from functools import cache

MEMO_CHUNKS = 400_000
MEMO_CHARS = 48
#: a space beside other white space, or at an end of the text: byte-level BPE may join it with its neighbour
UNSAFE = re.compile(r"\s | \s|\A | \Z")
#: lower-case letters, then other ASCII marks: pre-tokenised without the library; apostrophes and "<|" are left to it
PLAIN = re.compile(r"([a-z]*)([!-&(-/:;=-@\[-`{-~]*)")


@cache
def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path)


class ByteLevelCounter:
    """Token counts of a byte-level BPE whose only pre-tokenizer is the byte-level one."""

    def __init__(self, path: str):
        self.tok, self.memo = load(path), {}

    def encode_counts(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def counts(self, texts: list[str]) -> list[int]:
        split = {i: t for i, t in enumerate(texts) if not UNSAFE.search(t)}
        whole = [i for i in range(len(texts)) if i not in split]
        out = dict(zip(whole, self.encode_counts([texts[i] for i in whole])))
        # every chunk but a text's first carries the space before it
        chunks = {i: t.replace(" ", "\0 ").split("\0") if "\0" not in t else re.split(r"(?= )", t) for i, t in split.items()}
        new = list(set().union(*chunks.values()) - self.memo.keys())
        fresh = dict(zip(new, self.encode_counts(new)))
        for c, n in fresh.items():
            if len(self.memo) >= MEMO_CHUNKS:
                break
            if len(c) <= MEMO_CHARS:
                self.memo[c] = n
        memo, get = self.memo, self.memo.get
        for i, own in chunks.items():
            got = list(map(get, own))
            out[i] = sum(got) if None not in got else sum(fresh[c] if c in fresh else memo[c] for c in own)
        return [out[i] for i in range(len(texts))]


class WordIds:
    """Ids, as little-endian 32-bit bytes, of a lower-casing BPE with word ends that drops white space."""

    def __init__(self, path: str):
        self.tok, self.memo = load(path), {}

    def _pieces(self, chunk: str) -> bytes | None:
        """Chunks of plain ASCII letters and marks: the model alone; None where the library's own splitting is needed."""
        m = PLAIN.fullmatch(chunk.lower()) if chunk.isascii() else None
        if m is None:
            return None
        model = self.tok.model
        return array("I", [t.id for part in m.groups() if part for t in model.tokenize(part)]).tobytes()

    def texts_ids(self, texts: list[str]) -> list[bytes]:
        chunks = [t.replace("\n", " ").split(" ") for t in texts]
        new = set().union(*chunks) - self.memo.keys()
        fresh = {c: self._pieces(c) for c in new}
        rest = [c for c, x in fresh.items() if x is None]
        fresh |= {c: array("I", e.ids).tobytes() for c, e in zip(rest, self.tok.encode_batch_fast(rest, add_special_tokens=False))}
        for c, x in fresh.items():
            if len(self.memo) >= MEMO_CHUNKS:
                break
            if len(c) <= MEMO_CHARS:
                self.memo[c] = x
        out, get = [], self.memo.get
        for own in chunks:
            got = list(map(get, own))
            out.append(b"".join(got if None not in got else [fresh[c] if x is None else x for c, x in zip(own, got)]))
        return out


@cache
def counter(path: str) -> ByteLevelCounter:
    return ByteLevelCounter(path)


@cache
def word_ids(path: str) -> WordIds:
    return WordIds(path)
