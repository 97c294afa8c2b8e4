"""Spelling variants, SentencePiece ids and clusters against plain code, and for odd rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tripmart.llm import centroids, pieces, spelling
from tripmart.llm.memory import Memory
from tripmart.llm.tokens import tokenizer_path

DOCS = "doc_id bigint, text string, word string, n int, ids string, cell int"
LETTERS = "abcdeé÷ÿñ"


def frame(spark, texts, ids=None):
    ids = range(len(texts)) if ids is None else ids
    return spark.createDataFrame([(i, t, "x", None, "y", 3) for i, t in zip(ids, texts)], DOCS)


@pytest.fixture(scope="module")
def odd(spark):
    texts = [None, "", " \n\t", "Hello Hello hello", "½ ² 中文 😀 a\x00b ▁ <s>", "word " * 4000, "x" * 9000, None, "word hello"]
    return frame(spark, texts, [0, 1, 2, 3, 4, 5, 6, None, 3])


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Spelling variants


def edited(a: str, b: str) -> bool:
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def plain_words(docs):
    counts = Counter()
    for row in docs.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", row.text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if row.doc_id is None else row.doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_variants(words):
    rows, forms = {}, {}
    for w, n in words.items():
        near = sorted((-m, v) for v, m in words.items() if edited(w, v))
        form = near[0][1] if near and -near[0][0] >= 2 * n else None
        rows[w], forms[w] = (form, n, len(near), words[form] if form else None), form
    out = set()
    for w, (form, n, n_near, form_n) in rows.items():
        root = w
        while forms[root]:
            root = forms[root]
        out.add((w, form, root, n, n_near, form_n))
    return out


@pytest.fixture(scope="module")
def variants(spark):
    """Words of few letters, so that many are near, counts differ and letters clash."""
    draw = random.Random(5)
    base = ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(4, 9))) for _ in range(60)]
    words = []
    for w in base:
        words += [w] * draw.randrange(1, 40)
        for _ in range(6):
            i = draw.randrange(len(w))
            other = draw.choice([w[:i] + w[i + 1 :], w[:i] + draw.choice(LETTERS) + w[i:], w[:i] + draw.choice(LETTERS) + w[i + 1 :]])
            words += [other.upper() if draw.random() < 0.3 else other] * draw.randrange(1, 12)
    draw.shuffle(words)
    return frame(spark, [" 1,".join(words[i : i + 40]) for i in range(0, len(words), 40)])


@pytest.mark.parametrize("cell", [7, 40, spelling.CELL])
def test_variants_against_all_pairs(variants, cell):
    got = [tuple(r) for r in spelling.spelling_variants(variants, cell).collect()]
    wanted = plain_variants(plain_words(variants))
    assert len(got) == len(wanted) > 150 and set(got) == wanted
    assert any(r[1] and r[2] != r[1] for r in wanted)  # paths of several forms


def test_words_that_counts_cannot_cut_apart(spark):
    """Anagrams share one vector: their cell is dealt to parts, and every part is asked."""
    draw = random.Random(2)
    names = set()
    while len(names) < 300:
        names.add("".join(draw.sample("abcdefg", 7)))
    more = {w[:3] + "z" + w[4:] for w in list(names)[:100]} | {w + "a" for w in list(names)[:100]}
    words = spark.createDataFrame([(w, 3) for w in names | more], "word string, n bigint")
    tree = spelling.build_tree(words, cell=20)
    assert max(tree.parts.values()) >= 15
    got = [(r.word, r.near, r.near_n) for r in spelling.near_words(words, cell=20).collect()]
    known = sorted(names | more)
    assert sorted(got) == sorted((a, b, 3) for a in known for b in known if edited(a, b))


def test_words_of_other_scripts(spark):
    names = ["привет", "превет", "приветы", "ἀγαπάω", "ἀγαπάων", "😀😀😀😀😀", "😀😀😀😀", "ααααα", "αααααα"]
    words = spark.createDataFrame([(w, 1) for w in names], "word string, n bigint")
    got = {(r.word, r.near) for r in spelling.near_words(words, cell=2).collect()}
    assert got == {(a, b) for a in names for b in names if edited(a, b)}


def test_variants_odd_rows(odd, empty):
    got = {tuple(r) for r in spelling.spelling_variants(odd).collect()}
    assert got == plain_variants(plain_words(odd)) and any(r[0] == "hello" for r in got)
    assert spelling.spelling_variants(empty).collect() == []


# SentencePiece


def library():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=tokenizer_path(pieces.MODEL))


def strange_texts(n: int):
    draw = random.Random(3)
    alphabet = list("ab c  \t\n▁é中😀ﬁＡ½x\xa0　\x00́e'.,<s>​①가각ᄀ")
    return ["".join(draw.choice(alphabet) for _ in range(draw.randrange(14))) for _ in range(n)]


def test_pieces_are_the_library_s(spark):
    texts = strange_texts(3000) + ["a b " * 3000, "中" * 5000]
    sp = library()
    rows = {r.doc_id: r for r in pieces.encode_pieces(frame(spark, texts), decode=True).collect()}
    for i, text in enumerate(texts):
        found = sp.encode(text, return_type="proto").pieces
        assert rows[i].ids == [p.id for p in found]
        assert rows[i].starts == [p.begin for p in found] and rows[i].ends == [p.end for p in found]
        assert rows[i].decoded == sp.decode(rows[i].ids)


def test_pieces_round_trip(spark):
    texts = [t for t in strange_texts(500) if "▁" not in t]
    docs = frame(spark, texts)
    back = pieces.decode_pieces(pieces.encode_pieces(docs)).collect()
    assert {r.doc_id: r.text for r in back} == dict(enumerate(texts))


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nmt_nfkc_cf", "identity"])
def test_normal_text_and_places_are_the_library_s(rule):
    from sentencepiece import SentencePieceNormalizer, sentencepiece_model_pb2

    for spaces in (False, True):
        lib = SentencePieceNormalizer(rule_name=rule, add_dummy_prefix=spaces, remove_extra_whitespaces=spaces, escape_whitespaces=spaces)
        own = pieces.Normalizer(sentencepiece_model_pb2.ModelProto.FromString(lib.serialized_model_proto()).normalizer_spec)
        for text in strange_texts(1500):
            normal, places = own.normalize(text)
            wanted, offsets = lib.normalize(text, with_offsets=True)
            assert normal == wanted
            ends = np.cumsum([0] + [len(c.encode()) for c in normal])  # the library gives places of characters
            begins = {b: i for i, b in enumerate(np.cumsum([0] + [len(c.encode()) for c in text]).tolist())}
            assert [begins[int(places[e])] for e in ends] == offsets


def test_pieces_odd_rows(odd, empty):
    sp = library()
    rows = pieces.piece_report(odd).collect()
    wanted = []
    for row in odd.collect():
        ids = sp.encode(row.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((row.doc_id, len(ids), digest, hashlib.sha256(sp.decode(ids).encode()).hexdigest()))
    assert sorted(map(str, (tuple(r)[:4] for r in rows))) == sorted(map(str, wanted))
    assert pieces.piece_report(empty).collect() == []


def test_memory_keeps_what_is_met():
    memory = Memory(40_000)
    memory.add({"often": b"1"})
    for i in range(5000):
        memory.add({f"rare{i}": b"0"})
        memory.age()
        assert memory.find(["often", "never"]) == [b"1", None]
    assert len(memory.young) + len(memory.old) < 300 and memory.find(["rare1"]) == [None]


# Clusters

VECTORS = "vec_id bigint, embedding array<float>, cluster string, n int, block string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, e, "c", None, "b") for i, e in rows], VECTORS)


def plain_lloyd(rows, k, rounds, components, seed=2):
    kept = []
    for i, e in rows:
        if e is not None and len(e) == components and all(x is not None and math.isfinite(x) for x in e):
            kept.append((i, [math.floor(256 * float(np.float32(x))) for x in e]))
    kept.sort(key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    places = [v for _, v in kept[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), i) for i, c in enumerate(places))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(nearest(v)[1], []).append(v)
        places = [[sum(x) // len(x) for x in zip(*groups[i])] if i in groups else c for i, c in enumerate(places)]
    found = [(i, *nearest(v)[::-1]) for i, v in kept]
    inertia = Counter()
    for _, c, d in found:
        inertia[c] += d
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in places]
    return sorted(map(str, ((i, c, d, inertia[c], sum(inertia.values()), digest[c]) for i, c, d in found)))


def report(df, **how):
    rows = centroids.cluster_report(df, **how).select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256").collect()
    return sorted(str(tuple(r)) for r in rows)


@pytest.mark.parametrize("shards, block, size", [(1, 7, 1.0), (3, 50, 1.0), (4, 2048, 60_000.0)])
def test_clusters_against_plain_code(spark, shards, block, size):
    """Few distinct values, so distances tie; large ones leave exact double precision."""
    draw = random.Random(4)
    rows = [(i, [draw.randrange(-3, 4) / 4 * size for _ in range(10)]) for i in range(300)]
    got = report(vectors(spark, rows), k=9, rounds=3, components=10, shards=shards, block=block)
    assert got == plain_lloyd(rows, 9, 3, 10)


def test_clusters_odd_rows(spark):
    good = [0.5] * 10
    rows = [(0, None), (1, []), (2, [None] * 10), (3, [float("nan")] * 10), (4, [float("inf")] + good[1:]), (5, good[:9]), (6, good), (6, good), (6, [-0.1] * 10)]
    rows += [(None, [0.25] * 10), (None, [0.125] * 10), (9, [0.0] * 10)]
    for k in (2, 40):
        assert report(vectors(spark, rows), k=k, rounds=2, components=10) == plain_lloyd(rows, k, 2, 10)
    assert report(vectors(spark, rows[:3]), components=10) == []
    assert report(vectors(spark, [])) == []


def test_too_large_components_fail(spark):
    with pytest.raises(Exception, match="exceeds"):
        report(vectors(spark, [(1, [1e30] * 10)]), components=10)
