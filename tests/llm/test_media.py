import base64
import zlib
from hashlib import sha256

import numpy as np
import pytest
from conftest import DATA
from odd import TEXTS, none, odd

from tracelake.llm import media, registry, webp, webp_encode

#: A public probe picture: one transparent pixel.
PROBE = base64.b64decode("UklGRhoAAABXRUJQVlA4TA0AAAAvAAAAEAcQERGIiP4HAA==")


def pictures():
    r = np.random.default_rng(1)
    for h, w in ((1, 1), (5, 7), (20, 33), (1, 40), (40, 1)):
        yield (np.cumsum(r.integers(-3, 4, (h, w, 4)), axis=1) % 256).astype(np.uint8)
        yield r.integers(0, 256, (h, w, 4)).astype(np.uint8)
        yield (r.integers(0, 2, (h, w, 1)) * np.array([3, 77, 200, 255])).astype(np.uint8)


def test_a_known_file():
    assert webp.decode(PROBE).tolist() == [[[0, 0, 0, 0]]]


@pytest.mark.parametrize("transforms", [(), ("subtract_green",), ("predictor",), ("cross_color",), ("predictor", "cross_color", "subtract_green"), ("palette",), ("palette", "predictor")])
@pytest.mark.parametrize("cache", [0, 1, 7])
def test_transforms_and_cache(transforms, cache):
    for pixels in pictures():
        if "palette" in transforms and len(np.unique(pixels.reshape(-1, 4), axis=0)) > 256:
            continue
        for mode in range(16) if "predictor" in transforms else (0,):
            stored = webp_encode.encode(pixels, transforms, cache, True, mode, (17, -40, 99), 2)
            assert (webp.decode(stored) == pixels).all()


def test_predictors_by_hand():
    left, top, right, corner = (np.array([x] * 4, np.int16) for x in (10, 20, 40, 14))
    want = {1: 10, 2: 20, 3: 40, 4: 14, 5: (25 + 20) // 2, 6: 12, 7: 15, 8: 17, 9: 30, 10: (12 + 30) // 2, 11: 20, 12: 16, 13: 15 + 0}
    assert {m: int(f(left, top, right, corner)[0]) for m, f in webp.PREDICT.items()} == want


def test_broken_files():
    good = webp_encode.gray_tiles([bytes(range(192)) * 2], 192)[0]
    for bad in (b"", b"RIFF", PROBE[:20] + b"\x00" + PROBE[21:], good[:60]):
        with pytest.raises((ValueError, IndexError)):
            webp.decode_many([bad])


def test_lanes_equal_the_plain_decoder():
    r = np.random.default_rng(2)
    line = bytes(r.integers(97, 123, 50).astype(np.uint8)) + b"\n"
    tiles = [(line * 8)[: 192 * 2], b" " * 192, bytes(192), r.integers(0, 256, 192 * 9).astype(np.uint8).tobytes(), (b"ab" * 6000)[: 192 * 60]]
    files = webp_encode.gray_tiles(tiles, 192)
    for image, file, tile in zip(webp.decode_many(files), files, tiles, strict=True):
        assert image[..., 0].tobytes() == tile and (image == webp.decode(file)).all()


def check(rows, texts):
    want = {}
    for doc_id, text in texts:
        own = (text or "").encode()
        full = own + b" " * (-len(own) % 192 if own else 192)
        want.setdefault(doc_id, []).append((len(own), len(full), sha256(full).hexdigest(), zlib.crc32(full[-16:])))
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.payload_sha256, (r.media_sha256, r.media_bytes, r.feature)) == (r.media_sha256, r.media_bytes, r.feature)


def test_odd_rows(spark):
    check(media.media_column(odd(spark)).collect(), [r[:2] for r in TEXTS])
    assert media.media_column(none(spark)).count() == 0


def test_query(spark):
    check(registry.op3_media(spark, DATA).collect(), [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()])


def test_stored_pixels(spark, tmp_path):
    media.write(odd(spark), f"file://{tmp_path}/m")
    for r in media.read(spark, f"file://{tmp_path}/m").collect():
        assert bytes(r.pixels)[r.n_bytes :].strip() == b"" and media.decode([bytes(r.media)])[0].shape[1] == 192
