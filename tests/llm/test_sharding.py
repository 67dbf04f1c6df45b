"""Shards against a plain walk, one number at a time in Python integers."""

import zlib

WORD = (1 << 64) - 1


def walk(number, rows, key=0):
    """The place of one row: rounds on two halves, repeated while the value lies outside the rows."""
    half = 1
    while 4**half < rows:
        half += 1
    value = number
    while True:
        left, right = divmod(value, 2**half)
        for i in range(1, 7):
            x = (right + key * 0x9E3779B97F4A7C15 + i * 0xD1B54A32D192ED03) & WORD
            x = x * 0xBF58476D1CE4E5B9 & WORD
            x = (x ^ x >> 29) * 0x94D049BB133111EB & WORD
            left, right = right, left ^ (x ^ x >> 32) % 2**half
        value = left * 2**half + right
        if value < rows:
            return value


def test_permutation_equals_a_plain_walk():
    import numpy as np

    from milepost.llm.sharding import feistel

    for rows in (1, 2, 4, 5, 16, 17, 64, 65, 1000):
        for key in (0, 3):
            assert feistel(np.arange(rows), rows, key).tolist() == [walk(i, rows, key) for i in range(rows)]


def test_shards_with_null_ids_and_repeated_rows(llm):
    from milepost.llm.sharding import shards

    rows = [(i, f"text {i}") for i in range(40)] + [(None, "no id"), (None, None), (None, "no id"), (3, "text 3")]
    key = lambda r: (r[0] is not None, r[0] or 0, zlib.crc32((r[1] or "").encode()))
    # Null ids first; equal ids by the checksums of their texts; equal rows may change places.
    expected = []
    for number, (i, t) in enumerate(sorted(rows, key=key)):
        place = walk(number, len(rows))
        raw = (t or "").encode()
        expected.append((str(i), len(raw) + 1, zlib.crc32(raw), place % 16, place // 16))
    got = shards(llm.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got) == sorted(expected)
