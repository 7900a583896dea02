"""Token ids of whole texts by a public tokenizer, with the ids of frequent pieces kept."""

from __future__ import annotations

import os
import re

import numpy as np

from orderloom.llm.common import worker_memory

#: White space as Unicode defines it. Python's \s holds four more control characters, which the
#: tokenizers treat as symbols.
WHITE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
#: Letters that are letters to every library.
PLAIN = "A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff"
#: A text falls into a run of other characters with at most one white space before it, and what
#: further white space stands before or at the end; plain words are parted from a sign after them.
#: Neither tokenizer's own split pattern, lower casing or merges reach over such a border, so the
#: ids of a text are those of its pieces in order.
PIECE = re.compile(f"[{WHITE}]?[{PLAIN}]+(?=[.,;:!?{WHITE}]|$)|[{WHITE}]?[^{WHITE}]+"
                   f"|[{WHITE}]+(?=[{WHITE}][^{WHITE}])|[{WHITE}]+")
#: Pieces kept in a worker; at this number the memory is emptied (time only, never results).
KEPT_PIECES = 1_000_000
LONG_PIECE = 64


class Encoder:
    """ids(texts): the ids of each text as little-endian unsigned 32-bit integers.

    A control string in a text (an added token of the tokenizer) is its own id, as in the library by
    default; the text is cut there. With `literal` it is ordinary text.
    """

    def __init__(self, path: str, literal: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use the cores
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = literal
        added = {} if literal else {
            t.content: i for i, t in self.tokenizer.get_added_tokens_decoder().items()}
        self.control = {c: np.array([i], "<u4").tobytes() for c, i in added.items()}
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")")
        self.kept: dict[str, bytes] = {}

    def ids(self, texts: list[str]) -> list[bytes]:
        if not any(c in text for c in self.control for text in texts):
            return self._plain(texts)
        parts = [self.cut.split(text) for text in texts]  # every second one is a control string
        plain = iter(self._plain([p for own in parts for p in own[::2]]))
        return [b"".join(self.control[p] if i % 2 else next(plain) for i, p in enumerate(own))
                for own in parts]

    def _plain(self, texts: list[str]) -> list[bytes]:
        kept = self.kept
        if len(kept) > KEPT_PIECES:
            kept.clear()
        pieces = [PIECE.findall(text) for text in texts]
        found = [list(map(kept.get, own)) for own in pieces]
        new = {p for own, made in zip(pieces, found, strict=True) if None in made
               for p, ids in zip(own, made, strict=True) if ids is None}
        if not new:
            return [b"".join(made) for made in found]
        fresh = self._encoded(sorted(new))
        kept.update((p, ids) for p, ids in fresh.items() if len(p) <= LONG_PIECE)
        return [b"".join([fresh[p] if ids is None else ids
                          for p, ids in zip(own, made, strict=True)])
                for own, made in zip(pieces, found, strict=True)]

    def _encoded(self, pieces: list[str]) -> dict[str, bytes]:
        """Many pieces a call: the tokenizer takes them as words of one split text."""
        made: dict[str, bytes] = {}
        for first in range(0, len(pieces), 1024):
            part = pieces[first:first + 1024]
            found = self.tokenizer.encode(part, is_pretokenized=True, add_special_tokens=False)
            edges = np.searchsorted(np.array(found.word_ids, "i8"), np.arange(len(part) + 1)) * 4
            ids, edges = np.array(found.ids, "<u4").tobytes(), edges.tolist()
            made.update(zip(part, [ids[a:b] for a, b in zip(edges, edges[1:], strict=False)],
                            strict=True))
        return made


def encoder(path: str) -> Encoder:
    """One per Python worker and tokenizer file."""
    loaded = worker_memory("tokens")
    if path not in loaded:
        loaded[path] = Encoder(path)
    return loaded[path]
