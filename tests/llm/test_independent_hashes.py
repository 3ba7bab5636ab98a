"""Lines and vectors whose first 64-bit hash collides stay apart."""

import struct

import xxhash

from pvspark.llm import embeddings, fuzzy_lines

P1, P2, P3, P4, P5 = (
    0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5
)
M = 2**64 - 1
SEED = 42  # of Spark's xxhash64


def rotl(x, r):
    return ((x << r) | (x >> (64 - r))) & M


def mixed(k):
    return rotl(k * P2 & M, 31) * P1 & M


def unmixed(x):
    x = x * pow(P1, -1, 2**64) & M
    return rotl(x, 33) * pow(P2, -1, 2**64) & M


def step(h, k):
    return (rotl(h ^ mixed(k), 27) * P1 + P4) & M


def finished(h):
    h = (h ^ h >> 33) * P2 & M
    h = (h ^ h >> 29) * P3 & M
    return h ^ h >> 32


def long_hash(k, seed):
    return finished(step((seed + P5 + 8) & M, k))


def colliding_lines():
    """Two ASCII lines of 16 characters with one hash: the second half is solved for each first half."""
    one = b"abcdefghijklmnop"
    start = (SEED + P5 + 16) & M
    first, second = struct.unpack("<QQ", one)
    target = step(start, first) ^ mixed(second)
    for k in range(10**6):
        half = b"%08d" % k
        other = half + struct.pack("<Q", unmixed(step(start, struct.unpack("<Q", half)[0]) ^ target))
        if all(32 < c < 127 for c in other):
            return one.decode(), other.decode()
    raise AssertionError("no collision")


def test_colliding_lines_stay(spark):
    a, b = colliding_lines()
    assert a != b and xxhash.xxh64_intdigest(a, SEED) == xxhash.xxh64_intdigest(b, SEED)
    docs = spark.createDataFrame([(1, a), (2, b)], "doc_id LONG, text STRING")
    assert docs.selectExpr("count(distinct xxhash64(text)) n").first().n == 1
    assert [r.n_removed for r in fuzzy_lines.line_report(docs).collect()] == [0, 0]


def bits(x):
    return struct.unpack("<Q", struct.pack("<d", x))[0]


def colliding_vectors():
    """Two vectors with one hash, the second with an angle of more than 45 degrees to the first."""
    one = [1.0, 0.5]
    start = lambda x: (long_hash(bits(x), SEED) + P5 + 8) & M
    target = start(one[0]) ^ mixed(bits(one[1]))
    for k in range(1, 10**5):
        x = -float(k)
        y = struct.unpack("<d", struct.pack("<Q", unmixed(start(x) ^ target)))[0]
        if 1e-3 < abs(y) < 1e3:
            return one, [x, y]
    raise AssertionError("no collision")


def test_colliding_vectors_stay(spark):
    a, b = colliding_vectors()
    assert a[0] * b[0] + a[1] * b[1] < 0.7 * (a[0] ** 2 + a[1] ** 2) ** 0.5 * (b[0] ** 2 + b[1] ** 2) ** 0.5
    table = spark.createDataFrame([(1, a), (2, b)], "vec_id LONG, embedding ARRAY<DOUBLE>")
    assert table.selectExpr("count(distinct xxhash64(embedding)) n").first().n == 1
    rows = embeddings.near_duplicates(table).orderBy("vec_id").collect()
    assert [(r.vec_id, r.n_links, r.component_id, r.kept) for r in rows] == [(1, 0, 1, True), (2, 0, 2, True)]
