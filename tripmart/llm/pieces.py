"""SentencePiece ids of whole texts, with the bytes of the original text behind every id, and back.

A text is normalised by the model's compiled character map: at every place the longest rule that fits
is applied, else one character is copied, and each normalised byte keeps the place in the original text
where its rule or character began. The normalised text is cut before runs of space marks that follow
another character; where no piece of a BPE vocabulary reaches over such a place, the ids of a chunk do
not depend on what surrounds it. So each distinct chunk is encoded once by the library (told to
normalise nothing) and remembered by the worker. Other models encode the whole normalised text. The
pieces' lengths add up to places in the normalised text, and these project to original bytes.

Spans follow the library: the last of the ids that spell one character by its bytes holds the whole
character, the ones before it are empty.

Defined results: null text is the empty text, which has no ids. Null and repeated doc_ids give a row
each, as read. Texts of any length are encoded whole. Empty tables give no rows. Columns other than
doc_id and text are not looked at.
"""

from __future__ import annotations

import re
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import worker_state
from tripmart.llm.memory import Memory
from tripmart.llm.tokens import tokenizer_path
from tripmart.llm.words import slices

MODEL = "piece_bpe_32k.model"
#: Bytes of chunks and their ids a worker remembers.
REMEMBERED = 192 << 20
#: Characters encoded before the results are handed on; a longer text goes alone.
AT_ONCE = 1 << 19

ENCODED = "doc_id bigint, ids array<int>, starts array<bigint>, ends array<bigint>"
_SPACE_MARK = "▁"
# Fixed values of the model file: kinds of model and of pieces
_BPE, _USER_DEFINED, _BYTE = 2, 4, 6


def read_character_map(compiled: bytes) -> dict[str, str]:
    """The rules of a compiled map: a double-array trie over UTF-8 keys, then the replacements.

    The first four bytes hold the trie's size. A unit's low byte is its label, bit 8 says that a key
    ends there, and the bits from 10 on (times 256 if bit 9 is set) lead to its children. All nodes of a
    depth are opened together.
    """
    import numpy as np

    if not compiled:
        return {}
    size = int.from_bytes(compiled[:4], "little")
    units = np.frombuffer(compiled[4 : 4 + size], "<u4").astype(np.int64)
    texts = compiled[4 + size :]

    def children(places, opened):
        return places ^ ((opened >> 10) << ((opened & 512) >> 6))

    rules = {}
    places, keys = children(np.zeros(1, np.int64), units[:1]), [b""]
    labels = np.arange(1, 256)
    while len(places):
        inside = places[:, None] ^ labels
        fits = inside < len(units)
        met = units[np.where(fits, inside, 0)]
        parents, which = np.nonzero(fits & ((met & ((1 << 31) | 255)) == labels))
        met = met[parents, which]
        places = children(inside[parents, which], met)
        keys = [keys[p] + bytes([c + 1]) for p, c in zip(parents.tolist(), which.tolist())]
        for key, place, ends in zip(keys, places.tolist(), ((met >> 8) & 1).tolist()):
            if ends:
                start = int(units[place]) & ((1 << 31) - 1)
                rules[key.decode()] = texts[start : texts.index(b"\0", start)].decode()
    return rules


class Normalizer:
    """Normalised text with, for each of its bytes and its end, the original byte it comes from."""

    def __init__(self, spec, whole_symbols=(), space_after: bool = False):
        self.rules = read_character_map(spec.precompiled_charsmap)
        self.rules.update((s, s) for s in whole_symbols)  # these are never normalised
        self.prefix, self.squeeze = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        self.mark = _SPACE_MARK if spec.escape_whitespaces else " "
        self.space_after = space_after
        longest: dict[str, int] = {}
        for key in self.rules:
            longest[key[0]] = max(longest.get(key[0], 0), len(key))
        self.longest = longest
        firsts = "".join(re.escape(c) for c in longest)
        self.candidate = re.compile(f"[{firsts}]").search if longest else None

    def _replaced(self, text: str):
        """Bytes after the rules, and the place each byte's rule or character starts."""
        import numpy as np

        def copied(part: str, at: int):
            raw = np.frombuffer(part.encode(), np.uint8)
            starts = np.where((raw & 0xC0) != 0x80, np.arange(len(raw)), 0)
            return raw, np.maximum.accumulate(starts) + at if len(raw) else starts

        if self.candidate is None or not self.candidate(text):
            return copied(text, 0)
        raws, froms, at, done, place = [], [], 0, 0, 0
        while True:
            met = self.candidate(text, at)
            if not met:
                break
            at = met.start()
            for size in range(self.longest[text[at]], 0, -1):
                key = text[at : at + size]
                if len(key) == size and key in self.rules:
                    raw, source = copied(text[done:at], place)
                    new = self.rules[key].encode()
                    place += len(raw)
                    raws += [raw, np.frombuffer(new, np.uint8)]
                    froms += [source, np.full(len(new), place, np.int64)]
                    place += len(key.encode())
                    at = done = at + size
                    break
            else:
                at += 1
        raw, source = copied(text[done:], place)
        return np.concatenate([*raws, raw]), np.concatenate([*froms, source])

    def normalize(self, text: str):
        """(normalised text, places): places has one entry per byte of the UTF-8 text and one for its end."""
        import numpy as np

        end = len(text.encode())
        raw, source = self._replaced(text)
        if not end:
            return "", np.zeros(1, np.int64)
        space = raw == 32
        first = 0  # where the prefix mark belongs
        if self.squeeze:
            n = len(raw)
            opens = np.ones(n + 1, bool)
            opens[1:n] = source[1:] != source[:-1]
            lone = space & opens[:-1] & opens[1:]
            others = np.flatnonzero(~lone)
            if not len(others):
                return "", np.zeros(1, np.int64)
            first = int(source[others[0]])
            # A space goes if it starts its rule's text and follows a space or nothing
            run = np.arange(n) - np.maximum.accumulate(np.where(opens[:-1], np.arange(n), 0))
            solid = np.concatenate([[0], np.cumsum(~space)])
            leading = space & (solid[:n] == solid[np.arange(n) - run])
            after = np.ones(n, bool)
            after[1:] = space[:-1]
            keep = ~(leading & after)
            raw, source, space = raw[keep], source[keep], space[keep]
        mark = self.mark.encode()
        places = np.repeat(source, np.where(space, len(mark), 1))
        out = raw.tobytes().decode()
        if self.mark != " ":
            out = out.replace(" ", self.mark)
        if self.prefix and not self.space_after:
            out, places = self.mark + out, np.concatenate([np.full(len(mark), first), places])
        elif self.prefix:
            out, places = out + self.mark, np.concatenate([places, np.full(len(mark), end)])
        places = np.append(places, end)
        if self.squeeze and not self.space_after:
            out = out.rstrip(self.mark)
            places = places[: len(out.encode()) + 1]
        return out, places


class PieceEncoder:
    """Ids and original byte spans by a model file; `decode` is the library's."""

    def __init__(self, path: str):
        import numpy as np
        from sentencepiece import SentencePieceProcessor, sentencepiece_model_pb2

        with open(path, "rb") as f:
            proto = sentencepiece_model_pb2.ModelProto.FromString(f.read())
        self.library = SentencePieceProcessor(model_proto=proto.SerializeToString())
        kinds = [p.type for p in proto.pieces]
        users = [p.piece for p in proto.pieces if p.type == _USER_DEFINED]
        self.normalizer = Normalizer(proto.normalizer_spec, users, proto.trainer_spec.treat_whitespace_as_suffix)
        self.bytes_of = np.array([-1 if k == _BYTE else len(p.piece.encode()) for p, k in zip(proto.pieces, kinds)], np.int64)
        self.fallback = proto.trainer_spec.byte_fallback
        self.cut = None
        if proto.trainer_spec.model_type == _BPE and self.fallback and not users and self.normalizer.mark == _SPACE_MARK:
            if not any(_SPACE_MARK in p.piece.lstrip(_SPACE_MARK) for p in proto.pieces):
                self.cut = re.compile(f"{_SPACE_MARK}*[^{_SPACE_MARK}]+|{_SPACE_MARK}+").findall
        spec = proto.normalizer_spec
        spec.name, spec.precompiled_charsmap = "identity", b""
        spec.add_dummy_prefix = spec.remove_extra_whitespaces = spec.escape_whitespaces = False
        self.plain = SentencePieceProcessor(model_proto=proto.SerializeToString())
        self.known = Memory(REMEMBERED)

    def _learn(self, chunks: list[str]) -> dict[str, bytes]:
        """Encodes new chunks. Those that stay apart when written one after another are encoded as one text."""
        import numpy as np

        apart = [c for c in chunks if c[0] == _SPACE_MARK and c[-1] != _SPACE_MARK]
        ids = np.array(self.plain.encode("".join(apart)), "<u4")
        ends = np.cumsum(np.abs(self.bytes_of[ids]))
        cuts = np.searchsorted(ends, np.cumsum([len(c.encode()) for c in apart], dtype=np.int64), side="right") * 4
        raw = ids.tobytes()
        new = {c: raw[a:b] for c, a, b in zip(apart, [0, *cuts.tolist()], cuts.tolist())}
        for c in chunks:
            if c not in new:
                new[c] = np.array(self.plain.encode(c), "<u4").tobytes()
        self.known.add(new)
        return new

    def _ids(self, texts: list[str]) -> list:
        """Ids of normalised texts."""
        import numpy as np

        if self.cut is None:
            return [np.array(self.plain.encode(t), np.int32) for t in texts]
        cuts = [self.cut(t) for t in texts]
        found = [self.known.find(c) for c in cuts]
        lacking = [i for i, f in enumerate(found) if None in f]
        new = self._learn(list({c for i in lacking for c, f in zip(cuts[i], found[i]) if f is None}))
        for i in lacking:
            found[i] = [new[c] if f is None else f for c, f in zip(cuts[i], found[i])]
        self.known.age()
        return [np.frombuffer(b"".join(f), "<i4") for f in found]

    def _ranges(self, text: str, ids):
        """Where each id starts and ends in the UTF-8 bytes of a normalised text."""
        import numpy as np

        if not self.fallback:  # an unknown run is one id whatever its length
            sizes = np.array([len(p.surface.encode()) for p in self.plain.encode(text, return_type="proto").pieces], np.int64)
            to = np.cumsum(sizes)
            return to - sizes, to
        sizes = self.bytes_of[ids]
        single = np.flatnonzero(sizes < 0)
        sizes[single] = 1
        to = np.cumsum(sizes)
        start = to - sizes
        if len(single):
            raw = np.frombuffer(text.encode(), np.uint8)
            opens = np.ones(len(raw) + 1, bool)
            opens[:-1] = (raw & 0xC0) != 0x80
            first = np.maximum.accumulate(np.where(opens, np.arange(len(raw) + 1), 0))[to[single] - 1]
            # The last byte of a character stands for all of it, the others for nothing
            to[single] = np.where(opens[to[single]], to[single], first)
            start[single] = first
        return start, to

    def encode(self, texts: list[str]) -> list[tuple]:
        """(ids, starts, ends) of each text: its bytes starts[i] to ends[i] lie behind ids[i]."""
        normal = [self.normalizer.normalize(t) for t in texts]
        out = []
        for (text, places), ids in zip(normal, self._ids([n for n, _ in normal])):
            start, to = self._ranges(text, ids)
            out.append((ids, places[start], places[to]))
        return out

    def decode(self, ids: list[list[int]]) -> list[str]:
        return self.library.decode(ids) if ids else []


def piece_encoder(path: str) -> PieceEncoder:
    """One encoder per worker and file."""
    held = worker_state().setdefault("piece_encoders", {})
    if path not in held:
        held[path] = PieceEncoder(path)
    return held[path]


def _lists(arrays, kind):
    import numpy as np
    import pyarrow as pa

    offsets = np.concatenate([[0], np.cumsum([len(a) for a in arrays], dtype=np.int64)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(arrays), kind))


def _encoded(batches, path: str, decode: bool):
    import pyarrow as pa

    encoder = piece_encoder(path)
    for batch in batches:
        for a, b in slices(batch.column(1), AT_ONCE):
            part = batch.slice(a, b - a)
            rows = encoder.encode([t or "" for t in part.column(1).to_pylist()])
            ids, starts, ends = zip(*rows)
            columns = [part.column(0), _lists(ids, pa.int32()), _lists(starts, pa.int64()), _lists(ends, pa.int64())]
            names = ["doc_id", "ids", "starts", "ends"]
            if decode:
                columns.append(pa.array(encoder.decode([i.tolist() for i in ids]), pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)


def encode_pieces(docs: DataFrame, model: str | None = None, decode: bool = False) -> DataFrame:
    """Rows of ENCODED per document (doc_id, text); with `decode` also `decoded`, the text of the ids."""
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = f"{ENCODED}, decoded string" if decode else ENCODED
    return texts.mapInArrow(partial(_encoded, path=model or tokenizer_path(MODEL), decode=decode), schema)


def _decoded(batches, path: str):
    import pyarrow as pa

    encoder = piece_encoder(path)
    for batch in batches:
        texts = [encoder.library.decode(i) if i else "" for i in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"])


def decode_pieces(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """Rows (doc_id, text) of rows (doc_id, ids); null ids give the empty text."""
    ids = encoded.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids"))
    return ids.mapInArrow(partial(_decoded, path=model or tokenizer_path(MODEL)), "doc_id bigint, text string")


def piece_report(docs: DataFrame) -> DataFrame:
    """Digests of the ids, of the decoded texts and of the spans, per document."""
    return encode_pieces(docs, decode=True).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.xxhash64("starts", "ends").alias("spans_xxhash64"),
    )
