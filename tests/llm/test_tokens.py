"""BPE, packing and audio columns: exact round trips."""

import hashlib
import struct
import time
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from folioloom.llm import bpe, mpeg_audio, packing

from .helpers import PROSE, ROWS, as_set, clashing, documents, tokenizer


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(tokenizer())
    t.no_truncation()
    t.no_padding()
    return t


@pytest.fixture(scope="module")
def own():
    with open(tokenizer(), encoding="utf-8") as f:
        return bpe.Bpe(f.read())


def ids_of(own, text):
    return np.frombuffer(own.encode(text), "<u4").tolist()


def test_tokens_are_their_own_encoding(own):
    assert all(own.alone(r) for r in range(len(own.halves)))


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_same_ids_as_the_library(library, own, text):
    ids = library.encode(text, add_special_tokens=False).ids
    assert ids_of(own, text) == ids
    assert own.decode(memoryview(own.encode(text)).cast("I")) == library.decode(ids, skip_special_tokens=False)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abeht \n'.", max_size=80))
def test_same_ids_on_spaces_and_merges(library, own, text):
    assert ids_of(own, text) == library.encode(text, add_special_tokens=False).ids


def test_pairs_against_merging(own, library):
    rng = np.random.default_rng(0)
    for a, b in rng.integers(256, 20000, (2000, 2)).tolist():
        text = own.text[own.ids[a]] + own.text[own.ids[b]]
        try:
            word = text.decode()
        except UnicodeDecodeError:
            continue
        if own.words(word) == [word]:
            together = library.encode(word, add_special_tokens=False).ids
            assert own.compatible(a, b) == (together == [own.ids[a], own.ids[b]])


def test_encode_query(spark, library):
    docs = documents(spark)
    got = bpe.encode(docs, tokenizer(), digests=True)
    assert got.count() == len(ROWS)
    for r in got.collect():
        text = {x[0]: x[1] for x in ROWS}[r.doc_id] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert as_set(bpe.encode(clashing(docs), tokenizer(), digests=True)) == as_set(got)
    assert bpe.encode(docs.limit(0), tokenizer()).count() == 0
    full = {r.doc_id: r for r in bpe.encode(docs, tokenizer()).collect()}
    assert full[0].decoded == PROSE[0] and len(full[0].ids) == 4 * full[0].n_tokens


def test_first_fit_against_plain_search():
    rng = np.random.default_rng(2)
    for _ in range(50):
        lengths = sorted(rng.integers(1, 101, rng.integers(0, 60)).tolist(), reverse=True)
        bins, want = [], []
        for n in lengths:
            k = next((k for k, room in enumerate(bins) if room >= n), len(bins))
            bins += [100] * (k == len(bins))
            bins[k] -= n
            want.append(k)
        assert packing.first_fit(lengths, 100) == want


def check_packed(rows, ids_by_row, size=1024):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r.sequence_id].append(r)
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= size
    found = sorted((r.doc_id is None, r.doc_id or 0, r.start, r.length, r.ids_crc32, r.doc_tokens) for r in rows)
    want = []
    for i, ids in ids_by_row:
        starts = sorted({r.start for r in rows if r.doc_id == i and r.doc_tokens == len(ids)})
        for a, b in zip(starts, [*starts[1:], len(ids)], strict=True):
            want.append((i is None, i or 0, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()), len(ids)))
    assert found == sorted(want)


def test_packing(spark, library):
    docs = documents(spark)
    ids = [(r[0], [*library.encode(r[1] or "", add_special_tokens=False).ids, 0]) for r in ROWS]
    check_packed(packing.pack(docs, tokenizer()).collect(), ids)
    check_packed(packing.pack(clashing(docs), tokenizer(), group_rows=3).collect(), ids)
    assert packing.pack(docs.limit(0), tokenizer()).count() == 0


def test_packing_wastes_little(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packing.pack(docs, tokenizer()).toPandas()
    assert rows.length.sum() / (1024 * rows.sequence_id.nunique()) > 0.99


def test_audio(spark):
    docs = documents(spark)
    got = mpeg_audio.from_media(mpeg_audio.to_media(docs))
    assert got.count() == len(ROWS)
    for r in got.collect():
        raw = ({x[0]: x[1] for x in ROWS}[r.doc_id] or "").encode()
        payload = raw.ljust(max(192, -(-len(raw) // 192) * 192), b" ")
        assert (r.n_bytes, r.payload_bytes, r.payload_sha256) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert r.tail_crc32 == zlib.crc32(payload[-16:]) and r.samples == 1152 * len(payload) // 192
        assert len(r.frame_offsets) == len(payload) // 192 == r.crc_ok and "table right" in r.feature and r.crc_failed == r.skipped_bytes == 0
    assert as_set(mpeg_audio.from_media(mpeg_audio.to_media(clashing(docs)))) == as_set(got)
    assert mpeg_audio.to_media(docs.limit(0)).count() == 0


def test_audio_resynchronises_and_verifies():
    data = mpeg_audio.write(bytes(range(192)) * 3, 500)
    clean = mpeg_audio.read(data)
    assert clean["payload"] == bytes(range(192)) * 3 and clean["table"][0] == 3
    at = clean["offsets"][1]
    junk = data[:at] + b"\xff\xfbnoise" + data[at:]
    found = mpeg_audio.read(junk)
    assert len(found["offsets"]) in (2, 3) and found["skipped"] > 0 and found["payload"].endswith(bytes(range(192)))
    broken = bytearray(data)
    broken[at + 8] ^= 1  # side information
    assert (mpeg_audio.read(bytes(broken))["crc_ok"], mpeg_audio.read(bytes(broken))["crc_failed"]) == (2, 1)
    assert mpeg_audio.read(b"")["offsets"] == [] and mpeg_audio.read(b"\xff" * 50)["offsets"] == []
    assert mpeg_audio.read(data + b"TAG" + bytes(125))["payload"] == clean["payload"]


@pytest.mark.parametrize("units", [1, 3])
def test_audio_keeps_texts_that_look_like_tags(units):
    for at in range(190):
        payload = bytearray(b"x" * 192 * units)
        payload[192 * (units - 1) + at : 192 * (units - 1) + at + 3] = b"TAG"
        data = mpeg_audio.write(bytes(payload), len(payload))
        for found in (mpeg_audio.read(data), mpeg_audio.read(data + b"TAG" + b"\xff" * 125)):
            assert found["payload"] == payload and len(found["offsets"]) == units and found["skipped"] == 0


def test_audio_headers():
    assert mpeg_audio.header(bytes([0xFF, 0xFB, 0x90, 0x00]))[:3] == (417, 1152, 44100)
    assert mpeg_audio.header(bytes([0xFF, 0xFB, 0x92, 0x00]))[0] == 418
    assert mpeg_audio.header(bytes([0xFF, 0xF3, 0x80, 0xC0]))[:3] == (208, 576, 22050)
    assert mpeg_audio.header(bytes([0xFF, 0xFB, 0xF0, 0x00])) is None


def frames(lead: bytes, count: int) -> bytes:
    size = mpeg_audio.header(lead)[0]
    return lead.ljust(size, b"\0") * count


def test_audio_tags():
    body = frames(mpeg_audio.HEADER[:1] + b"\xfb" + mpeg_audio.HEADER[2:], 3)
    long = "x" * 300  # a size over 127: synchsafe in 2.4, plain in 2.3
    size = mpeg_audio.synchsafe
    v4 = b"TIT2" + size(301) + b"\0\0\x03" + long.encode()
    v3 = b"TIT2" + (301).to_bytes(4, "big") + b"\0\0\0" + long.encode()
    v2 = b"TT2" + (301).to_bytes(3, "big") + b"\0" + long.encode()
    files = {
        "TIT2": [b"ID3\4\0\0" + size(len(v4)) + v4, b"ID3\3\0\0" + size(len(v3)) + v3, b"ID3\4\0\x10" + size(len(v4)) + v4 + b"3DI" + bytes(7)]
        + [b"ID3\4\0\x40" + size(len(v4) + 6) + size(6) + b"\1\0" + v4, b"ID3\3\0\x40" + size(len(v3) + 10) + (6).to_bytes(4, "big") + bytes(6) + v3],
        "TT2": [b"ID3\2\0\0" + size(len(v2)) + v2],
    }
    for name, tags in files.items():
        for tag in tags:
            found = mpeg_audio.read(tag + body)
            assert found["tags"] == {name: long} and found["first"] == len(tag) and len(found["offsets"]) == 3 and found["skipped"] == 0
    swung = b"TXXX" + (8).to_bytes(4, "big") + b"\0\0\0a\0b\xffcd\xe0"
    safe = swung.replace(b"\xff", b"\xff\0")
    assert mpeg_audio.read(b"ID3\3\0\x80" + size(len(safe)) + safe + body)["tags"] == {"a": "b\xffcd\xe0"}
    ape = b"APETAGEX" + (2000).to_bytes(4, "little") + (32 + 40).to_bytes(4, "little") + bytes(16)
    closed = body + bytes(40) + ape
    for file in (closed, closed + b"TAG" + bytes(125)):
        found = mpeg_audio.read(file)
        assert len(found["offsets"]) == 3 and found["skipped"] == 0


def test_audio_tables_and_layers():
    plain = bytes([0xFF, 0xFB, 0x90, 0x00])  # 128 kbit/s, 44.1 kHz, stereo
    body = frames(plain, 5)
    lame = b"Info" + (15).to_bytes(4, "big") + (5).to_bytes(4, "big") + (417 * 6).to_bytes(4, "big") + bytes(100) + bytes(4) + b"LAME3.100" + bytes(12) + (576 << 12 | 1000).to_bytes(3, "big")
    found = mpeg_audio.read((plain + bytes(32) + lame).ljust(417, b"\0") + body)
    assert found["samples"] == 5 * 1152 - 1576 and found["table"][0] == 5 and len(found["offsets"]) == 5
    vbri = b"VBRI" + bytes(6) + (417 * 6).to_bytes(4, "big") + (5).to_bytes(4, "big") + (2).to_bytes(2, "big") + (1).to_bytes(2, "big") + (2).to_bytes(2, "big") + (3).to_bytes(2, "big") + b"abcd"
    found = mpeg_audio.read((plain + bytes(32) + vbri).ljust(417, b"\0") + body)
    assert found["table"][:3] == (5, 417 * 6, b"abcd") and found["samples"] == 5 * 1152
    other = frames(bytes([0xFF, 0xF3, 0x80, 0xC0]), 1)  # another version: no frame of this file
    found = mpeg_audio.read(body + other[:50] + body)
    assert found["hertz"] == 44100 and len(found["offsets"]) >= 9 and found["skipped"] > 0
    one = bytes([0xFF, 0xFE, 0x50, 0xC0])  # Layer I with CRC, mono
    sum_ = mpeg_audio.crc16(one[2:] + bytes(16)).to_bytes(2, "big")
    size = mpeg_audio.header(one)[0]
    found = mpeg_audio.read((one + sum_).ljust(size, b"\0") + (one + b"xx").ljust(size, b"\0"))
    assert (found["crc_ok"], found["crc_failed"], found["samples"]) == (1, 1, 768)


@pytest.mark.parametrize("space", [" ", "\n", "\t"])
def test_endless_white_space(library, own, space):
    with open(tokenizer(), encoding="utf-8") as f:
        encode = packing.encoder(f.read())
    for text in (space * 2_000_000 + "x", "a " + space * 60_000, space * 1_500_000):
        assert encode(text) == ids_of(own, text)
    assert encode(space * 50_001 + "x") == library.encode(space * 50_001 + "x", add_special_tokens=False).ids


def test_unsupported_vocabularies_raise():
    import json

    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        source = f.read()
    with pytest.raises(ValueError, match="end_of_word_suffix, normalizer, pre_tokenizer"):
        bpe.Bpe(source)
    with open(tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    with pytest.raises(ValueError, match="lstrip|added token"):
        bpe.check(spec | {"added_tokens": [spec["added_tokens"][0] | {"lstrip": True}]})


def test_many_runs_of_white_space_are_read_once():
    from folioloom.llm.packing import ENDLESS

    text = ("\t" * 49_999 + "x") * 30
    began = time.time()
    assert not ENDLESS(text) and ENDLESS(text + "\t" * 50_000)
    assert time.time() - began < 5


def test_audio_keeps_a_last_frame_that_looks_like_a_tag():
    """An APE footer that points at the last frame's begin, before what looks like an ID3v1 tag inside it."""
    unit = bytearray(b"x" * 192)
    foot = b"APETAGEX" + bytes(4) + b"p" + bytes(3) + bytes(16)
    unit[57 : 57 + len(foot)] = foot
    unit[89:92] = b"TAG"
    for lead in range(20, 90):
        for size in (b"p", b"q", bytes([lead + 32]), bytes([192])):
            u = bytearray(unit)
            u[lead : lead + 8], u[lead + 8 : lead + 16], u[lead + 16 : lead + 32] = b"APETAGEX", bytes(4) + size[:1] + bytes(3), bytes(16)
            u[min(lead + 32, 160) : min(lead + 32, 160) + 3] = b"TAG"
            for payload in (b"y" * 384 + bytes(u), bytes(u)):
                assert mpeg_audio.read(mpeg_audio.write(payload, len(payload)))["payload"] == payload
    payload = b"y" * 384 + bytes(unit)
    assert mpeg_audio.read(mpeg_audio.write(payload, len(payload)))["payload"] == payload
    real = mpeg_audio.write(payload, len(payload)) + b"APETAGEX" + struct.pack("<IIII", 2000, 32, 0, 0) + bytes(8) + b"TAG" + bytes(125)
    assert mpeg_audio.read(real)["payload"] == payload  # true tags end the frames
