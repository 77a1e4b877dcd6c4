import gzip

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lamellar.operators import chunked, codecs, palette


def volume(rng, shape, labels):
    """Smooth regions with some noise, so that blocks of one, two and many labels occur."""
    big = 1 << 63
    names = np.array([0, 5, 7, big, big + 1, *range(100, 100 + labels)], np.uint64)
    coarse = rng.integers(0, len(names), [-(-n // 8) for n in shape])
    v = coarse.repeat(8, 0).repeat(8, 1).repeat(8, 2)[: shape[0], : shape[1], : shape[2]]
    noise = rng.random(v.shape) < rng.choice([0, 0.05, 0.6])
    two = rng.random(v.shape) < 0.3
    v = np.where(two & (coarse.repeat(8, 0).repeat(8, 1).repeat(8, 2)[: shape[0], : shape[1], : shape[2]] % 2 == 0), 1, v)
    return names[np.where(noise, rng.integers(0, len(names), v.shape), v)]


def by_voxels(v, factors):
    cube = np.zeros([-(-n // f) * f for n, f in zip(v.shape, factors, strict=True)], np.uint64)
    cube[: v.shape[0], : v.shape[1], : v.shape[2]] = v
    return chunked.vote(cube, v.shape, factors)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 1 << 30), st.tuples(*[st.integers(1, 26)] * 3), st.tuples(*[st.sampled_from([1, 2, 4])] * 3), st.sampled_from([1, 40, 400]))
def test_votes_give_the_bytes_of_encoded_voxels(seed, shape, factors, labels):
    v = volume(np.random.default_rng(seed), shape, labels)
    want = by_voxels(v, factors)
    got = palette.voted(codecs.encode_segmentation(v), shape, factors)
    assert got == (codecs.encode_segmentation(want) if want.any() else None)


def test_tables_in_any_order_and_with_repeats():
    # two blocks along x: tables (9, 4) and (6, 6), one bit a voxel; ties go to the smaller label
    index = np.tile([0, 1], 256)
    words = np.packbits(index, bitorder="little").tobytes()
    data = codecs.laid_out([(np.array([9, 4], "<u8").tobytes(), 1, words), (np.array([6, 6], "<u8").tobytes(), 1, words)])
    v = codecs.decode_segmentation(data, (8, 8, 16))
    assert set(np.unique(v)) == {4, 6, 9}
    got = codecs.decode_segmentation(palette.voted(data, (8, 8, 16), (2, 2, 2)), (4, 4, 8))
    assert (got == by_voxels(v, (2, 2, 2))).all() and set(np.unique(got)) == {4, 6}


def test_broken_chunks_are_told():
    data = codecs.encode_segmentation(volume(np.random.default_rng(1), (16, 16, 16), 30))
    for cut in (8, 70, len(data) // 2, len(data) - 8):
        with pytest.raises(codecs.CodecError):
            palette.voted(data[: cut // 4 * 4], (16, 16, 16), (2, 2, 2))


def test_whole_blocks_are_joined_as_they_are():
    rng = np.random.default_rng(2)
    shape = (16, 13, 24)
    v = volume(rng, shape, 50)
    v[:8, :8, :8] = 0
    boxes = [((z, y, x), (8, min(8, 13 - y), 8 if x < 16 else 8)) for z in (0, 8) for y in (0, 8) for x in (0, 8, 16)][1:]
    assert palette.aligned(boxes, shape)
    cut = lambda o, n: v[o[0] : o[0] + n[0], o[1] : o[1] + n[1], o[2] : o[2] + n[2]]
    assert palette.joined([(o, n, codecs.encode_segmentation(cut(o, n))) for o, n in boxes], shape) == codecs.encode_segmentation(v)
    assert not palette.aligned([((0, 4, 0), (8, 4, 8))], shape) and not palette.aligned([((0, 0, 0), (8, 4, 8))], shape)
    assert not palette.aligned([((8, 8, 16), (8, 8, 8))], shape) and not palette.aligned([boxes[0], boxes[0]], shape)


def test_factors_that_cross_blocks_go_by_voxels():
    v = volume(np.random.default_rng(3), (9, 9, 9), 20)
    data, size = chunked._voted(gzip.compress(codecs.encode_segmentation(v)), v.shape, (3, 3, 3))
    assert size == [3, 3, 3] and (chunked.unpacked(data, (3, 3, 3)) == by_voxels(v, (3, 3, 3))).all()


def test_chunks_from_voxels_and_up(spark):
    from lamellar.functions.geometry import Scale
    from lamellar.operators import volume as v

    a, b = Scale("a", (40, 21, 16), (16, 16, 8)), Scale("b", (20, 11, 8), (16, 16, 8))
    cube = volume(np.random.default_rng(4), (16, 21, 40), 9)
    cube[:8, :16, :16] = 0
    rows = [(int(x), int(y), int(z), int(cube[z, y, x].astype(np.int64))) for z, y, x in np.argwhere(cube)]
    df = spark.createDataFrame([*rows, (40, 0, 0, 3), (-1, 0, 0, 3), (0, 0, 0, None)], "x long, y long, z long, label long")
    stored = chunked.from_voxels(df, a)
    assert stored.where("chunk_x = 0 and chunk_y = 0 and chunk_z = 0").count() == 0
    back = v.explode_voxels(chunked.decoded(stored, a), a)
    assert sorted(map(tuple, back.select("x", "y", "z", "label").collect())) == sorted(rows)
    want = by_voxels(cube, (2, 2, 2))
    half = v.explode_voxels(chunked.decoded(chunked.put_together(chunked.halved(stored, a, b), b), b), b)
    got = np.zeros(want.shape, np.int64)
    for r in half.collect():
        got[r.z, r.y, r.x] = r.label
    assert (got.view(np.uint64) == want).all()
