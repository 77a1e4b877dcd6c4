import gzip
import struct

import numpy as np
import pytest
import zstandard

from lamellar.operators import codecs as c


def words(*w):
    return struct.pack(f"<{len(w)}I", *w)


def labels(*v):
    return struct.pack(f"<{len(v)}Q", *v)


GOLDEN = [
    ([[[4, 0], [4, 0]]], (1, 2, 2), words(1, 3 | 1 << 24, 2, 0b0101) + labels(0, 4)),
    (np.full((2, 2, 2), 42), (2, 2, 2), words(1, 2, 2) + labels(42)),
    ([[[4, 3], [5, 4]]], (1, 2, 2), words(1, 3 | 2 << 24, 2, 0b01100001) + labels(3, 4, 5)),
]


@pytest.mark.parametrize("volume,block,want", GOLDEN)
def test_golden_segmentation(volume, block, want):
    assert c.encode_segmentation(np.array(volume, np.uint64), block) == want


def test_tables_are_shared():
    data = c.encode_segmentation(np.full((2, 4, 4), 3, np.uint64), (2, 2, 2))
    head = np.frombuffer(data, "<u4")[1:9].reshape(4, 2)
    assert len({h & 0xFFFFFF for h in head[:, 0].tolist()}) == 1 and len(data) == 4 + 32 + 8


@pytest.mark.parametrize("n,bits", [(1, 0), (2, 1), (3, 2), (4, 2), (5, 4), (16, 4), (17, 8), (256, 8), (257, 16), (512, 16)])
def test_round_trips(n, bits):
    rng = np.random.default_rng(42)
    for shape in ((8, 8, 8), (9, 7, 10)):
        pool = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        volume = pool[rng.integers(0, n, shape)]
        assert (c.decode_segmentation(c.encode_segmentation(volume), shape) == volume).all()
        assert len(c.encode_segmentation(volume)) <= c.encoded_bound(shape)
    assert c.encoding_bits(n) == bits
    big = pool[np.arange(64**3).reshape(64, 64, 64) % n]
    assert (c.decode_block(c.encode_block(big)) == big).all()


def test_large_labels_and_limits():
    v = np.full((8, 8, 8), (1 << 64) - 1, np.uint64)
    assert (c.decode_segmentation(c.encode_segmentation(v), v.shape) == v).all()
    with pytest.raises(c.CodecError):
        c.encoding_bits(65_537)


def test_blocks():
    solid = words(8, 8, 8, 1) + labels(42)
    assert (c.decode_block(solid) == 42).all()
    split = words(8, 8, 8, 2) + labels(7, 9) + struct.pack("<512H", *[1] * 512) + words(*[0 if k < 256 else 1 for k in range(512)])
    out = c.decode_block(split)
    assert (out[:32] == 7).all() and (out[32:] == 9).all()
    none = words(8, 8, 8, 2) + labels(7, 9) + struct.pack("<512H", *[0] * 512)
    assert not c.decode_block(none).any()
    for bad in (b"", words(4, 4, 4, 1) + labels(1), words(8, 8, 8, 0), words(8, 8, 8, 3), split[:-4], split[:2000]):
        with pytest.raises(c.CodecError):
            c.decode_block(bad)
    with pytest.raises(c.CodecError):
        c.decode_block(words(8, 8, 8, 2) + labels(7, 9) + struct.pack("<512H", *[1] * 512) + words(*[5] * 512))


@pytest.mark.parametrize("seed", range(4))
def test_mixed_bit_widths(seed):
    rng = np.random.default_rng(seed)
    v = rng.integers(0, 600, (64, 64, 64), dtype=np.uint64)
    v[:16] %= np.uint64(3)
    v[16:32] %= np.uint64(20)
    v[32:40] = 5
    assert (c.decode_block(c.encode_block(v)) == v).all()


def test_packed_values():
    assert c.packed_value(b"\xd3\xb5", 0, 3) == 0b110 and c.packed_value(b"\xd3\xb5", 2, 4) == 0b0100
    assert [c.bits_for(n) for n in (0, 1, 2, 4, 8, 16)] == [0, 0, 1, 2, 3, 4]


def test_mapping_last_wins():
    palette = np.array([0, 5, 9], np.uint64)
    got = c.mapping(palette, np.array([10, 20, 30, 40], np.uint64), np.array([5, 5, 7], np.uint64))
    assert got.tolist() == [0, 20, 9]
    assert c.mapping(palette, np.array([], np.uint64), np.array([], np.uint64)).tolist() == [0, 5, 9]


def test_transcode():
    v = np.arange(8**3, dtype=np.uint64).reshape(8, 8, 8) % 7
    plain = c.encode_block(v)
    stored = zstandard.ZstdCompressor().compress(plain)
    assert gzip.decompress(c.transcode(stored, shape=v.shape)) == c.encode_segmentation(v)
    assert c.transcode(plain, compressed=False, gzipped=False, shape=v.shape) == c.encode_segmentation(v)
    with pytest.raises(c.CodecError):
        c.transcode(stored, np.zeros(1, np.uint64), np.zeros(2, np.uint64), shape=v.shape)


def test_info():
    stored = zstandard.ZstdCompressor().compress(words(8, 8, 8, 1) + labels(1))
    assert c.block_info(stored)["type"] == "solid" and c.block_info(b"")["type"] == "empty" and c.block_info(b"junk")["type"] == "zstd_error"
    assert c.block_info(zstandard.ZstdCompressor().compress(b"abc"))["type"] == "invalid"


def test_every_width_of_indices():
    rng = np.random.default_rng(5)
    for n in (2, 3, 4, 5, 8, 9, 16, 17, 32, 33, 64, 65, 128, 129, 256, 257, 512):
        v = rng.permutation(np.arange(512) % n).astype(np.uint64).reshape(8, 8, 8) * 7 + (1 << 63)
        assert (c.decode_block(c.encode_block(v), shape=(8, 8, 8)) == v).all(), n
        assert (c.decode_segmentation(c.encode_segmentation(v), v.shape) == v).all(), n
