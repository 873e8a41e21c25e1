import hashlib
import random
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from chronokey.llm import bpe_chunks as B
from chronokey.llm import rans as R
from chronokey.llm import token_store as S
from chronokey.llm.bpe import encoder, stretches
from chronokey.llm.common import documents
from chronokey.llm.queries import byte_vocabulary

from .cases import edge_documents, empty_documents

ALPHABET = " \n\t\r'’ab stmdrevl19é \u0085 ßЖ!?.,<|endoftext|>\x1c\x00²½"


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(byte_vocabulary())
    t.no_truncation()
    t.no_padding()
    return t


def noisy_texts(n, seed=1):
    rng = random.Random(seed)
    out = ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 60))) for _ in range(n)]
    out += ["".join(rng.choice([" ", "  ", "'s", "'re", "'", "ll", "\n", "a", "9", " '", "word "]) for _ in range(rng.randint(0, 25))) for _ in range(n)]
    return [*out, "", "<|endoftext|>", "a<|endoftext|>b", "𝔘𝔫☃漢字 x", "it's we're I'll they've 'sx ''s"]


def test_encoder_equals_the_library(library):
    texts = noisy_texts(3000)
    enc = encoder(byte_vocabulary())
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in enc.encode(texts)] == want
    assert [enc.decode(np.array(x, np.int32)) for x in want] == library.decode_batch(want, skip_special_tokens=False)


def test_every_classified_character(library):
    enc = encoder(byte_vocabulary())
    texts = [f"a{chr(c)}b {chr(c)} 1{chr(c)}{chr(c)}x" for c in range(1, len(enc.kind)) if enc.kind[c] != 5]
    assert [x.tolist() for x in enc.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_full_table_starts_anew(library):
    from chronokey.llm import bpe

    enc = bpe.Encoder(byte_vocabulary())
    enc.start, enc.count = enc.start[:3000], enc.count[:3000]
    rng = random.Random(3)
    for _ in range(3):
        texts = [" ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(20)) for _ in range(100)]
        assert [x.tolist() for x in enc.encode(texts)] == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_stretches_of_long_texts():
    text = "some words here " * 5000
    parts = stretches(text, 1000)
    assert len(parts) > 50 and "".join(parts) == text
    assert stretches("x" * 5000, 1000) == ["x" * 5000]


def test_chunk_joins_are_repaired(library):
    """Any subset of chunks taken from a store, cut anywhere, gives the ids of the whole text."""
    enc, rng = encoder(byte_vocabulary()), random.Random(7)
    texts = noisy_texts(300, 8) + [" ".join(rng.choice(["the", "it's", "don't", "42", "...", "naïve", "\n"]) for _ in range(400)) for _ in range(40)]
    refs = []
    for t in texts:
        cuts = sorted(rng.sample(range(len(t) + 1), min(len(t), rng.randint(0, 12))))
        own = [(a, b) for a, b in zip(cuts, cuts[1:]) if rng.random() < 0.6]
        refs.append([{"off": a, "len": b - a, "ids": enc.encode([t[a:b]])[0].astype(enc.narrow).tobytes()} for a, b in own])
    want = [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x, _, _ in B.encode_with_chunks(texts, refs, enc)] == want
    # Wrong ids in the store are found by the final agreement.
    for r in refs:
        for c in r:
            c["ids"] = np.array([5], enc.narrow).tobytes()
    assert [x.tolist() for x, _, _ in B.encode_with_chunks(texts, refs, enc)] == want


def test_repairs_alone_are_exact(library):
    """Without the fallback: assembled ids are those of the whole text wherever they are returned."""
    enc, rng = encoder(byte_vocabulary()), random.Random(9)
    done = 0
    for _ in range(200):
        t = " ".join("".join(rng.choices("abcé'", k=rng.randint(1, 8))) for _ in range(120))
        start, end, _ = B.chunks_of(t, 8, 32, 8)
        refs = [{"off": int(a), "len": int(b - a), "ids": enc.encode([t[a:b]])[0].astype(enc.narrow).tobytes()} for a, b in zip(start, end)]
        p = B.Pieces(t, refs, enc.token_size, enc.narrow)
        todo = p.spans
        while todo:
            for (x, y), ids in zip(todo, enc.encode([t[x:y] for x, y in todo])):
                p.made[x, y] = ids
            todo = p.widen()
        assert p.assemble()[0].tolist() == library.encode(t, add_special_tokens=False).ids
        done += len(start) > 3
    assert done > 100


def chunk_refs(enc, text):
    start, end, _ = B.chunks_of(text)
    return [{"off": int(a), "len": int(b - a), "ids": enc.encode([text[a:b]])[0].astype(enc.narrow).tobytes()} for a, b in zip(start, end)]


@pytest.mark.parametrize("letters", ["abcdefgh", "абвгдежз", "αβγδεζηθ", "0123456789"])
def test_few_characters_are_encoded_anew(library, letters):
    """In any script a join costs a few words, and all chunks are reused."""
    enc, rng = encoder(byte_vocabulary()), random.Random(12)
    text = " ".join("".join(rng.choices(letters, k=6)) for _ in range(3000))
    refs = chunk_refs(enc, text)
    [(ids, reused, redone)] = B.encode_with_chunks([text], [refs], enc)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(refs) > 30 and reused == len(refs) and redone < len(text) / 10


def test_text_without_spaces(library):
    """Ideographs are cut before punctuation; without a safe place a text is one window and reuses nothing."""
    enc, rng = encoder(byte_vocabulary()), random.Random(13)
    text = "".join("".join(rng.choices("中文的一是在不了有和人", k=rng.randint(4, 12))) + rng.choice("。，") for _ in range(600))
    refs = chunk_refs(enc, text)
    [(ids, reused, redone)] = B.encode_with_chunks([text], [refs], enc)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and reused > len(refs) / 2 and redone < len(text) / 4
    text = "".join(rng.choices("abc-_=", k=5000))
    refs = chunk_refs(enc, text)
    [(ids, reused, redone)] = B.encode_with_chunks([text], [refs], enc)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids and (reused, redone) == (0, len(text))


def test_windows_grow_past_wrong_ids(library):
    """Wrong ids beside a join make its window grow, over the wrong chunk only."""
    enc, rng = encoder(byte_vocabulary()), random.Random(14)
    text = " ".join("".join(rng.choices("abcdefgh", k=6)) for _ in range(3000))
    refs = chunk_refs(enc, text)
    refs[9]["ids"] = enc.encode(["x"])[0].astype(enc.narrow).tobytes()
    [(ids, reused, redone)] = B.encode_with_chunks([text], [refs], enc)
    assert ids.tolist() == library.encode(text, add_special_tokens=False).ids
    assert len(refs) - 6 <= reused < len(refs) and redone < len(text) / 4


def test_safe_places_are_cut_by_the_library(library):
    """Ids of the parts between safe places are the ids of the text."""
    rng = random.Random(15)
    pool = ["a", "é", "ж", "中", "か", "한", "7", "²", "'s", "'", " ", "  ", "\n", "\u3000", "。", "，", "_", "!", "\u0301", "\x1c", "\u00a0"]
    for _ in range(3000):
        t = "".join(rng.choices(pool, k=rng.randint(1, 30)))
        cuts = [0, *(m.start() for m in B.SAFE.finditer(t)), len(t)]
        parts = [library.encode(t[a:b], add_special_tokens=False).ids for a, b in zip(cuts, cuts[1:])]
        assert [i for x in parts for i in x] == library.encode(t, add_special_tokens=False).ids


def test_chunks_follow_content():
    rng = random.Random(4)
    text = " ".join("".join(rng.choices("abcdefghij", k=6)) for _ in range(3000))
    whole = set(B.chunks_of(text)[2].tolist())
    moved = set(B.chunks_of("something in front " + text)[2].tolist())
    assert len(whole & moved) >= len(whole) - 2
    assert B.chunks_of("")[0].tolist() == [0]


@pytest.mark.parametrize("table", ["edge", "sf0.001"])
def test_operators_equal_the_library(spark, library, table, tmp_path):
    docs = edge_documents(spark) if table == "edge" else documents(spark, "/root/testdata/sf0.001")
    rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    ids = [np.array(x.ids, "<u4") for x in library.encode_batch([r[1] or "" for r in rows], add_special_tokens=False)]
    out = B.bpe_encode(docs, byte_vocabulary())
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"]), r["text"], r["n_tokens"]) for r in out.collect())
    assert got == sorted((r[0] is None, r[0] or 0, x.tobytes(), r[1] or "", len(x)) for r, x in zip(rows, ids))
    decoded = B.bpe_decode(out.select("doc_id", "ids"), byte_vocabulary())
    assert sorted(map(str, (r["text"] for r in decoded.collect()))) == sorted(r[1] or "" for r in rows)
    S.write_tokens(docs, f"{tmp_path}/store", byte_vocabulary(), partitions=3, segment_ids=5000)
    got, at, want = S.read_tokens(spark, f"{tmp_path}/store").collect(), 0, []
    for r, x in zip(rows, ids):
        raw = np.append(x, np.uint32(2)).astype("<u4").tobytes()
        want.append((r[0], at, hashlib.sha256(raw).hexdigest()))
        at += len(raw) // 4
    assert sorted(((r["doc_id"], r["start"], hashlib.sha256(r["ids"]).hexdigest()) for r in got), key=lambda r: r[1]) == want


def test_empty_tables(spark, tmp_path):
    assert B.bpe_encode(empty_documents(spark), byte_vocabulary()).count() == 0
    S.write_tokens(empty_documents(spark), f"{tmp_path}/empty", byte_vocabulary())
    assert S.read_tokens(spark, f"{tmp_path}/empty").count() == 0


@pytest.mark.parametrize("n", [0, 1, 127, 128, 129, R.BLOCK - 1, R.BLOCK, R.BLOCK + 1, 3 * R.BLOCK + 77])
def test_segments_round_trip(n):
    rng = np.random.default_rng(n)
    for ids in (rng.zipf(1.3, n) % 50257, np.zeros(n), np.arange(n)):
        ids = ids.astype(np.int32)
        sizes = np.array([n // 2, n - n // 2])
        data = R.encode_segment(ids, sizes)
        back, counts = R.decode_segment(data)
        assert (back == ids).all() and counts.tolist() == sizes.tolist()


def test_damage_is_found():
    ids = np.arange(5000, dtype=np.int32) % 700
    data = bytearray(R.encode_segment(ids, np.array([5000])))
    data[-1000] ^= 1
    with pytest.raises(ValueError):
        R.decode_segment(bytes(data))
    with pytest.raises(ValueError):
        R.decode_segment(b"x" + bytes(data[1:]))
    assert zlib.crc32(b"") == 0
