"""Token ids by the ``tokenizers`` library, as a fast exact helper for tasks.

``Encoder(path)`` gives the ids that ``Tokenizer.from_file(path).encode(text,
add_special_tokens=False)`` gives. Where the file's normalizer and
pre-tokenizer never look across white space, a text's ids are the ids of its
white-space separated chunks, so chunks are encoded once and remembered in a
bounded table. A text with any character outside the plain range below goes
to the library as it is.
"""

from __future__ import annotations

import json
import re
from array import array
from functools import lru_cache

import numpy as np

#: Characters for which lower(), split() and NFC agree with the library's
#: normalizer: ASCII, Latin letters without combining marks, common punctuation.
_PLAIN = re.compile("[\t\n\r -~¡-įĲ-ɀ‐-―‘-‟†-•…€]*")
#: The file's own splitting pattern, written for the plain range.
_PIECES = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_\u00b2\u00b3\u00b9\u00bc-\u00be]+|"
                     r"[\d\u00b2\u00b3\u00b9\u00bc-\u00be]|(?:[^\s\w]|_)+")
_MARK = "<|"  # start of the special tokens' strings
#: Remembered chunks per Python worker (two generations of this many).
_CHUNKS = 700_000
#: Texts whose chunks are looked up together.
PART = 2048
_LONG = 64  # chunks longer than this are not remembered


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def _byte_letters() -> list[str]:
    """The public byte-level alphabet: printable Latin-1 bytes stand for
    themselves, the others for the code points from 256 on, in order."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer
        self.lib = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.by_chunk = self._splits_on_space(spec)
        self.dtype = np.dtype("<u2") if self.lib.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.pieces: dict[str, bytes] = {}
        self.letters = _byte_letters()
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    @staticmethod
    def _splits_on_space(spec: dict) -> bool:
        norm = [n.get("type") for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        first = pre[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        return (norm == ["NFC", "Replace", "Lowercase"] and first.get("type") == "Split"
                and first.get("invert") is True and first.get("behavior") == "Removed"
                and pattern.endswith(r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"))

    def _library(self, texts: list[str]) -> list[bytes]:
        out = []
        for i in range(0, len(texts), 64):
            out += [np.array(e.ids, self.dtype).tobytes()
                    for e in self.lib.encode_batch(texts[i:i + 64], add_special_tokens=False)]
        return out

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Encode unknown chunks by the library's model, piece by piece."""
        tokenize, known, code = self.lib.model.tokenize, self.pieces, self.dtype.char
        made = {}
        for c in chunks:
            out = b""
            for p in _PIECES.findall(c):
                got = known.get(p)
                if got is None:
                    raw = p if p.isascii() else "".join(map(self.letters.__getitem__, p.encode()))
                    got = array(code, [t.id for t in tokenize(raw)]).tobytes()
                    if len(p) <= _LONG:
                        known[p] = got
                out += got
            made[c] = out
            if len(c) <= _LONG:
                self.new[c] = out
        if len(known) > _CHUNKS:
            known.clear()
        return made

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Ids of every text (None counts as empty), as unsigned integers."""
        out: list[bytes | None] = [None] * len(texts)
        plain, odd = [], []
        for i, t in enumerate(texts):
            t = t or ""
            if self.by_chunk and _MARK not in t and _PLAIN.fullmatch(t):
                plain.append((i, t.lower().split()))
            else:
                odd.append((i, t))
        for a in range(0, len(plain), PART):
            part = plain[a:a + PART]
            # a small table of this part's chunks: the large one is asked once for each kind
            near, unknown = {}, []
            new, old = self.new.get, self.old.get
            for c in set().union(*(w for _, w in part)):
                got = new(c)
                if got is None:
                    got = old(c)
                    if got is None:
                        unknown.append(c)
                        continue
                    self.new[c] = got
                near[c] = got
            near.update(self._learn(unknown))
            get = near.__getitem__
            for i, words in part:
                out[i] = b"".join(map(get, words))
            if len(self.new) > _CHUNKS:
                self.old, self.new = self.new, {}
        for (i, _), b in zip(odd, self._library([t for _, t in odd])):
            out[i] = b
        return [np.frombuffer(b, self.dtype) for b in out]


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Encoder(path)
