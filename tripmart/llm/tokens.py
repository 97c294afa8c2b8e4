"""Token ids of whole texts in Arrow batches, exactly as the tokenizers library gives them.

A text is cut at spaces where the tokenizer's own pre-tokens end, and the ids of each distinct piece
come from the library and are kept in the worker. That is several times faster than encoding whole
texts and gives the same ids, as BPE never merges across pre-tokens. A piece of letters and closing
marks is two pre-tokens, which the library's model takes as they are; other pieces pass through the
whole tokenizer. Pieces are kept in two generations of REMEMBERED / 2; one met in the older is kept on.

Cutting is used for texts whose characters all lie below U+0250, where normalisation and case are
simple; other texts, texts with unusual runs of white space and texts that may hold a special token are
encoded whole by the library.
"""

from __future__ import annotations

import json
import re

from tripmart.llm.common import worker_state

#: Pieces kept in a worker, of at most LONGEST characters.
REMEMBERED = 800_000
LONGEST = 48
#: Characters of texts that are cut before their new pieces are encoded.
AT_ONCE = 1_000_000
# Letters below U+0250 and marks of ASCII; no letter follows the marks, so they hold no contraction
_SIMPLE = re.compile(r"(\n?)([A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+)([!-/:-@\[-`{-~]*)").fullmatch
_RARE_SPACES = "\t\x0b\x0c\r\x85\xa0"
# The pre-token pattern of the lower-casing kind of tokenizer
_WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


class Encoder:
    """Little-endian unsigned 32-bit ids by a tokenizer file, without added special tokens."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            parts = json.load(f)
        self.specials = [t["content"] for t in parts.get("added_tokens") or []]
        self.beyond = re.compile("[^\x00-ɏ]").search
        self.first: dict[str, bytes] = {}
        self.later: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        byte_level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: byte_level.pre_tokenize_str(chr(c))[0][0] for c in range(0x250) if not 0x80 <= c < 0xC0}
        before, model = parts.get("pre_tokenizer") or {}, parts.get("model") or {}
        kinds = [x["type"] for x in before.get("pretokenizers", [before])]
        normal = [x["type"] for x in (parts.get("normalizer") or {}).get("normalizers", [])]
        self.kind = "whole"
        if model.get("type") == "BPE" and not parts.get("post_processor"):
            if kinds == ["ByteLevel"] and before.get("use_regex") and not before.get("add_prefix_space") and not parts.get("normalizer"):
                self.kind = "byte"
            elif kinds == ["Split", "ByteLevel"] and normal == ["NFC", "Replace", "Lowercase"]:
                if before["pretokenizers"][0]["pattern"].get("Regex") == _WORD_PATTERN:
                    self.kind = "word"

    def whole(self, texts: list[str]) -> list[bytes]:
        import numpy as np

        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _pre_token(self, text: str) -> bytes:
        """Ids of one pre-token by the library's model."""
        from array import array

        return array("I", [t.id for t in self.tokenizer.model.tokenize(text.translate(self.bytes))]).tobytes()

    def _learn(self, kept: dict[str, bytes], pieces, before: str) -> None:
        """Adds the ids of new pieces, each of which follows `before`."""
        pre_token, rest, marks = self._pre_token, [], {"": b"", "\n": b""}
        if self.kind == "byte":
            marks["\n"] = pre_token("\n")
        for piece in pieces:
            simple = _SIMPLE(piece)
            if not simple:
                rest.append(piece)
                continue
            line, word, end = simple.groups()
            ids = None if line else kept.get(word)
            if ids is None:
                ids = pre_token(word if line else before + word)
            if end not in marks:
                marks[end] = pre_token(end)
            kept[piece] = marks[line] + ids + marks[end]
        if rest:
            self._learn_whole(kept, rest, before)

    def _learn_whole(self, kept: dict[str, bytes], pieces: list[str], before: str) -> None:
        """Adds the ids of any pieces. They are encoded as one text, cut again at a lone token."""
        import numpy as np

        mark = "~" if self.kind == "word" else "\n"
        plain = [p for p in pieces if p and mark not in p and not p.isspace()]
        ids = np.frombuffer(self.whole([f" {mark} ".join(plain) if mark == "~" else mark.join(before + p for p in plain)])[0], "<u4")
        ends = np.flatnonzero(ids == np.frombuffer(self.whole([mark])[0], "<u4")[0])
        if plain and len(ends) == len(plain) - 1:
            starts = [0, *(ends + 1).tolist()]
            raw = ids.tobytes()
            kept.update((p, raw[4 * a : 4 * b]) for p, a, b in zip(plain, starts, [*ends.tolist(), len(ids)]))
            pieces = [p for p in pieces if p not in kept]
        kept.update(zip(pieces, self.whole([p if p[:1] == "\n" else before + p for p in pieces])))

    def _cut(self, text: str):
        """(first piece, later pieces), or None if the text must be encoded whole."""
        if self.kind == "whole" or any(t in text for t in self.specials):
            return None
        if not text.isascii() and (self.beyond(text) or "İ" in text):
            return None
        if self.kind == "word":
            return None if any(c in text for c in "\x1c\x1d\x1e\x1f") else ("", text.lower().split())
        if any(pair in text for pair in ("  ", " \n", "\n ", "\n\n")):
            return None
        for space in _RARE_SPACES:
            if space in text and any(x in text for c in " \n" for x in (c + space, space + c)):
                return None
        first, *later = text.replace("\n", " \n").split(" ")
        return first, later

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text."""
        out: list[bytes] = []
        start = 0
        while start < len(texts):
            end, size = start, 0
            while end < len(texts) and size < AT_ONCE:
                size += len(texts[end])
                end += 1
            out += self._encode(texts[start:end])
            start = end
        return out

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.first) > REMEMBERED // 2:
            self.first.clear()
        if len(self.later) > REMEMBERED // 2:
            self.older, self.later = self.later, {}
        cuts = [self._cut(t) for t in texts]
        self._learn(self.first, {c[0] for c in cuts if c}.difference(self.first), "")
        new = set().union(*[c[1] for c in cuts if c]).difference(self.later)
        again = {p: self.older[p] for p in new if p in self.older}
        self.later.update(again)
        self._learn(self.later, new.difference(again), "" if self.kind == "word" else " ")
        ids = self.later.__getitem__
        wholes = iter(self.whole([t for t, c in zip(texts, cuts) if not c]))
        out = [self.first[c[0]] + b"".join(map(ids, c[1])) if c else next(wholes) for c in cuts]
        for piece in [p for p in new if len(p) > LONGEST]:
            del self.later[piece]
        for piece in {c[0] for c in cuts if c and len(c[0]) > LONGEST}:
            del self.first[piece]
        return out


def encoded(column, encode, at_once: int = 256):
    """Ids of every text of an Arrow column; few of them are held at a time."""
    for at in range(0, len(column), at_once):
        yield from encode([t or "" for t in column.slice(at, at_once).to_pylist()])


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    held = worker_state().setdefault("encoders", {})
    if path not in held:
        held[path] = Encoder(path)
    return held[path]


def tokenizer_path(name: str) -> str:
    """Where the public tokenizer file `name` is installed; the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)
