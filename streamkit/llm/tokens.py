"""Byte-level BPE ids with a bounded per-worker cache.

In byte-level BPE with the usual pre-tokenizer pattern, a run of white space
that follows other text always starts a new pre-token, what stands before it
does not depend on what follows, and no rule looks back.  So a text can be cut
before each such run, and each cut piece (white space, then text) has the ids
it has in context.  Pieces repeat, so their ids are kept in a table of bounded
size; new pieces go through the library in batches.  Texts that hold a special
token's string, or characters on whose class regex engines disagree, go
through the library whole."""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import public_tokenizers

# The characters with the Unicode property White_Space
WHITE = "\t\n\x0b\x0c\r \xa0                　"
ODD = re.compile("[\x1c-\x1f\x85᠎​﻿]")
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
KEEP, PASSING = 700_000, 300_000  # pieces kept for good (the first seen: the frequent ones), and others that come and go


def byte_letters() -> dict[str, int]:
    """Byte-level BPE's letter of each byte: printable Latin-1 stands for itself, the others for 256 and up."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pieces:
    """ids(texts): the little-endian unsigned 32-bit ids of each text, as bytes."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.special = [t.content for t in self.library.get_added_tokens_decoder().values()]
        kept: dict[str, bytes] = {}
        self.kept, self.recent = kept, {}

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, dtype="<u4").tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, pieces: list[str]) -> dict[str, bytes]:
        new = dict(zip(pieces, self.whole(pieces)))
        room = KEEP - len(self.kept)
        if room > 0:
            self.kept.update(list(new.items())[:room])
        else:
            if len(self.recent) + len(new) > PASSING:
                self.recent = {}
            self.recent.update(new)
        return new

    def plain(self, text: str) -> bool:
        return not (ODD.search(text) or any(s in text for s in self.special))

    def ids(self, texts: list[str]) -> list[bytes]:
        out: list[bytes] = []
        for text in texts:
            if not self.plain(text):
                out += self.whole([text])
                continue
            pieces = PIECE.findall(text)
            found = list(map(self.kept.get, pieces))
            if None in found:
                rest = [i for i, v in enumerate(found) if v is None]
                again = [self.recent.get(pieces[i]) for i in rest]
                if None in again:
                    new = self._learn(list({pieces[i] for i, v in zip(rest, again) if v is None}))
                    again = [new[pieces[i]] if v is None else v for i, v in zip(rest, again)]
                for i, v in zip(rest, again):
                    found[i] = v
            out.append(b"".join(found))
        return out


@functools.lru_cache(maxsize=4)
def byte_level(name: str) -> Pieces:
    """The cache of this worker for a vocabulary file (a path, or a public name)."""
    return Pieces(name if os.path.sep in name else public_tokenizers.path(name))
