"""A word's shape is that of the whole word."""

import xxhash

from marquee.llm import classifier


def test_shapes_see_long_words_to_their_end():
    shape_hash = lambda w: classifier.Features().word(w.encode())[8:]
    url = "https://example.org/" + "path/" * 20
    assert shape_hash(url + "?q=1&r=2") != shape_hash(url + "#top")
    text = "委員会は火曜日に開かれた" * 8
    assert shape_hash(text + "。次") == xxhash.xxh3_64_digest("a。a".encode(), seed=1)
