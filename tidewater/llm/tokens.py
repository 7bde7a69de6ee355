"""Token ids of whole texts with a public tokenizer, inside tasks.

The tokenizer cuts at white space before anything else, so a text's ids are
those of its blank-separated pieces one after the other. Pieces repeat, so
each worker keeps the ids of those it has met; only new ones reach the
tokenizer, many at a time.
"""

from __future__ import annotations

import os
from array import array
from unicodedata import is_normalized

from tidewater.llm.common import worker_store

END_ID = 1
CACHED_PIECES = 800_000
LONG_PIECE = 64
TAIL = ".,;:!?"
#: Byte-level BPE shows a byte that is no printable sign as one from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
SHOWN = {b: 0x100 + k for k, b in enumerate(sorted(set(range(0x100)) - set(PRINTABLE)))}


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Texts to little-endian unsigned 16-bit ids (the vocabulary is below
    65,536 ids)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        if self.tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary don't fit 16 bits")
        self.pieces: dict[str, bytes] = {"": b""}

    @staticmethod
    def of(path: str) -> Encoder:
        store = worker_store("encoder", path)
        if "encoder" not in store:
            store["encoder"] = Encoder(path)
        return store["encoder"]

    def plain(self, texts: list[str]) -> list[bytes]:
        return [array("H", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, new: set[str]) -> None:
        """Ids of new pieces. A word with signs at its end is the word and the
        signs. Of a word of letters in normal form, small letters as bytes are
        what the BPE model itself gets; the steps before it change nothing
        else. (A capital sigma has two small forms, and some small forms hold
        signs; those words go the long way.)"""
        if len(self.pieces) > CACHED_PIECES:
            self.pieces = {"": b""}
        known, tokenize = self.pieces, self.tokenizer.model.tokenize
        composed, rest = [], []
        for piece in new:
            word = piece.rstrip(TAIL)
            key = word.lower()
            if key.isalpha() and word.isalpha() and (
                    word.isascii() or "Σ" not in word and is_normalized("NFC", word)):
                if key not in known:
                    shown = key if key.isascii() else key.encode().decode("latin-1").translate(SHOWN)
                    known[key] = array("H", [t.id for t in tokenize(shown)]).tobytes()
                tail = piece[len(word):]
                if not tail:
                    known[piece] = known[key]
                elif tail in known:
                    known[piece] = known[key] + known[tail]
                else:
                    rest.append(tail)
                    composed.append((piece, key, tail))
            else:
                rest.append(piece)
        rest = sorted(set(rest))
        known.update(zip(rest, self.plain(rest)))
        for piece, key, tail in composed:
            known[piece] = known[key] + known[tail]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each whole text."""
        cut = [t.replace("\n", " ").split(" ") for t in texts]
        known = self.pieces
        new = {p for pieces in cut for p in pieces if p not in known}
        long = sorted(p for p in new if len(p) > LONG_PIECE)
        extra = dict(zip(long, self.plain(long)))
        self.learn(new.difference(long))
        known = self.pieces
        try:
            return [b"".join(map(known.__getitem__, pieces)) for pieces in cut]
        except KeyError:  # long pieces, or pieces forgotten when the store was emptied
            rest = {p for pieces in cut for p in pieces if p not in known and p not in extra}
            extra |= dict(zip(rest, self.plain(list(rest))))
            return [b"".join(known[p] if p in known else extra[p] for p in pieces)
                    for pieces in cut]
