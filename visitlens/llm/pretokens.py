"""Exact cuts of a text into pre-tokens that a public tokenizer encodes one by one.

Both kinds guarantee: the ids of a text are the ids of its keys, one after the other. So a
key's ids (or only their number) may be looked up, whatever text it stands in.
"""

from __future__ import annotations

import os
import re

#: Letters and numbers (\p{L}, \p{N}) among the characters of PLAIN.
_L, _N = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"
#: Fixed value: the splitting pattern of byte-level BPE files of the GPT-2 family, for texts of PLAIN characters.
BYTE_LEVEL = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_L}]+| ?[{_N}]+| ?[^\s{_L}{_N}]+|\s+(?!\S)|\s+")
#: A character outside PLAIN; texts with one go to the library whole.
ODD = re.compile("[^\t\n\r -~¡-ɏ‐-‧‰-⁞]")
#: White space that doesn't stand alone between other characters, or is neither blank nor line feed.
RUNS = ("  ", " \n", "\n ", "\n\n", "\t", "\r")


class SentencePieceKeys:
    """Keys of a SentencePiece model with identity normaliser, dummy prefix and no piece across words.

    A key is the text of a word (encoded with the dummy prefix standing for its blank), a run
    of blanks less one followed by a word, or a line feed with what follows it. Neither a
    blank after another character nor a line feed is inside any piece (checked when loaded),
    so merges never cross these cuts. U+2581 is the model's blank and counts as one.
    """

    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        for i in range(self.sp.get_piece_size()):
            piece = self.sp.id_to_piece(i)
            if "\n" in piece or "▁" in piece.lstrip("▁"):
                raise ValueError(f"piece {i} crosses words; this model can't be cut into pre-tokens")
        probe = self.sp.encode("a  b ")
        if self.sp.decode(probe) != "a  b " or self.sp.encode("ﬁ　", out_type=str)[-1] != "　":
            raise ValueError("the model normalises texts; it can't be cut into pre-tokens")
        self.blank = self.sp.encode("a ")[-1]

    def split(self, text: str) -> list[str]:
        return sentencepiece_keys(text)

    def pretokens(self, key: str) -> list[str]:
        return [key]

    def encode_pretoken(self, key: str) -> list[int]:
        return self.encode(key)

    def encode(self, key: str) -> list[int]:
        if key == "":
            return [self.blank]
        ids = self.sp.encode(key)
        return ids[1:] if key[0] == "\n" else ids

    def encode_whole(self, text: str) -> list[int]:
        return self.sp.encode(text)


_KEY = re.compile(r"\n[^ \n]*| ( *[^ \n]*)")


def sentencepiece_keys(text: str) -> list[str]:
    """The keys of ``text`` (see SentencePieceKeys), in order; none for an empty text."""
    if not text:
        return []
    if "▁" in text:
        text = text.replace("▁", " ")
    flat = text.replace("\n", " \n")
    if flat[0] != " " and "  " not in flat:
        keys = flat.split(" ")
        return keys
    return [m[0] if m[0][0] == "\n" else m[1] for m in _KEY.finditer(" " + text)]


class ByteLevelKeys:
    """Keys of a byte-level BPE file of the tokenizers library (no normaliser, no prefix space)."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        state = json.loads(self.tokenizer.to_str())
        pre = state["pre_tokenizer"] or {}
        if state["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex"):
            raise ValueError("only byte-level files without normaliser and prefix space are cut here")
        self.special = [t["content"] for t in state["added_tokens"]]
        self.model = self.tokenizer.model
        self.model._resize_cache(0)  # the callers' caches are larger
        shown = [b for b in range(256) if chr(b).isprintable() and b not in (0x20, 0xA0, 0xAD)]
        hidden = [b for b in range(256) if b not in shown]
        self.letters = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}

    def plain(self, text: str) -> bool:
        """Whether a pre-token begins at every blank and line feed, and all of them are cut here as in the library.

        So it is where no two blanks or line feeds meet, none stands at an end, and there are
        neither special strings nor characters outside PLAIN.
        """
        return not (ODD.search(text) or text[0] in " \n" or text[-1] in " \n" or any(s in text for s in self.special)
                    or any(r in text for r in RUNS))

    def split(self, text: str) -> list[str] | None:
        """The pre-tokens; None: the text must be encoded whole."""
        if ODD.search(text) or any(s in text for s in self.special):
            return None
        return BYTE_LEVEL.findall(text)

    def pretokens(self, key: str) -> list[str]:
        return BYTE_LEVEL.findall(key)

    def encode(self, key: str) -> list[int]:
        return self.encode_pretoken(key)

    def encode_pretoken(self, key: str) -> list[int]:
        """Ids of one pre-token, from the library's model without its splitting of texts."""
        return [t.id for t in self.model.tokenize(key.encode().decode("latin-1").translate(self.letters))]

    def encode_whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids


def keys_of(path: str) -> SentencePieceKeys | ByteLevelKeys:
    return SentencePieceKeys(path) if path.endswith(".model") else ByteLevelKeys(path)
