"""Filter audit, plane clusters and piecewise hashes against brute-force versions, on small tables with awkward rows."""

import collections
import hashlib
import itertools
import random
import re

import numpy as np
import pytest

from jobtide.llm import filter_audit, piecewise_hash, plane_clusters
from jobtide.llm.common import small_batches, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _texts(seed=5, n=40):
    rng = random.Random(seed)
    words = ["the", "of", "The", "END", "é中", "a b", "10%", "x#y", "\x00", "I"] + [f"w{k}" for k in range(300)]
    out = [None, "", " ", "A", "#", "same text", "word " * 4000, " ".join(f"u{k}" for k in range(30_000)), "Z" * 70_000]
    return out + [" ".join(rng.choices(words, k=rng.choice([3, 60, 199, 200, 201, 400]))) for _ in range(n)]


@pytest.fixture(scope="module")
def docs(spark):
    small_batches(spark)
    texts = _texts()
    rows = [(i, t, ("en", "de", None, "")[i % 4], 1, b"x", "clash") for i, t in enumerate(texts)]
    rows += [(100 + i, texts[i], "en", 1, None, None) for i in (1, 5, 6, 12, 12, 20)]
    rows += [rows[12], (5, "same text", "de", 1, None, ""), (None, "same text", "en", 1, None, ""), (None, "only here", None, 1, None, "")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, n long, digest binary, failed string").repartition(4).cache()


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, i % 2, int(i % 5 == 0), 3) for i in range(0, 48, 2)] + [(0, 1, 1, 3), (12, None, None, 3), (12, 1, 0, 3), (None, 1, 1, 3), (7000, 1, 1, 3)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int, part int")


def _audit(rows, labels):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(first.get(text or "", i), i)
    out = []
    for i, text, lang in rows:
        x = text or ""
        words = WORD.findall(x)
        fails = {"A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words), "C": 100 * len(re.findall("[A-Z]", x)) > 3 * len(x),
                 "D": bool(re.search(r"[#$%&*|]", x)), "E": i is not None and first[x] < i}
        out.append((lang or "", fails, any(j == i and q == 1 for j, q, _ in labels if j is not None), any(j == i and t == 1 for j, _, t in labels if j is not None)))
    result, removals = {}, collections.Counter()
    for order in map("".join, itertools.permutations("ABCDE")):
        for part in {p for p, *_ in out}:
            mine = [x[1:] for x in out if x[0] == part]
            for k, letter in enumerate(order):
                gone = [x for x in mine if any(x[0][f] for f in order[:k])]
                here = [x for x in mine if x not in gone and x[0][letter]]
                removals[part, letter] += len(here)
                result[part, order, k + 1] = (len(mine) - len(gone) - len(here), len(here), sum(x[0][letter] for x in gone),
                                              sum([f for f in "ABCDE" if x[0][f]] == [letter] for x in mine), sum(x[1] for x in here), sum(x[2] for x in here))
    return {(*key, *v, removals[key[0], key[1][key[2] - 1]]) for key, v in result.items()}


def test_filter_audit_equals_a_plain_walk(docs, labels):
    rows = [(r["doc_id"], r["text"], r["lang"]) for r in docs.collect()]
    marks = [(r["doc_id"], r["quality"], r["toxic"]) for r in labels.collect()]
    want = _audit(rows, marks)
    for entries in (1 << 20, 300):
        got = filter_audit.audit(docs, labels, entries).collect()
        assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert filter_audit.audit(docs.limit(0), labels).count() == 0
    bare = filter_audit.audit(docs, labels.limit(0)).collect()
    assert sum(r["good_lost"] + r["toxic_lost"] for r in bare) == 0


@pytest.mark.parametrize("bucket", [1 << 16, 500])
def test_matrix_holds_every_count_under_one_dictionary(docs, bucket, request):
    cut = stored(filter_audit.blocks(docs, entries=500))
    rows = collections.Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    size, filter_audit.DICTIONARY_BUCKET = filter_audit.DICTIONARY_BUCKET, bucket
    request.addfinalizer(lambda: setattr(filter_audit, "DICTIONARY_BUCKET", size))
    whole = {r["term_id"]: r["word"].decode() for r in filter_audit.dictionary(cut).collect()}
    assert len(whole) == len(set(whole.values())) == len({w for _, t in rows for w in WORD.findall(t)})
    got = collections.Counter()
    for s in filter_audit.matrix(cut).collect():
        for k, i in enumerate(s["doc_ids"]):
            at = slice(s["indptr"][k], s["indptr"][k + 1])
            got[i, frozenset(zip((whole[c] for c in s["columns"][at]), s["counts"][at], strict=True))] += 1
    want = collections.Counter()
    for (i, t), n in rows.items():
        want[i, frozenset(collections.Counter(WORD.findall(t)).items())] += n
    assert got == want


def _ints(rng, n, top):
    return np.array([[rng.randint(-top, top) for _ in range(64)] for _ in range(n)], dtype=np.int64)


def test_planes_give_exact_products():
    rng = random.Random(2)
    for top in (0, 1, 900, 1 << 20, 1 << 40, 1 << 62):
        a, b = _ints(rng, 5, top), _ints(rng, 3, 17)
        p, q = plane_clusters.to_planes(a), plane_clusters.to_planes(b)
        want = [[sum((int(x) - int(y)) ** 2 for x, y in zip(u, v, strict=True)) for v in b] for u in a]
        assert plane_clusters.distances(p, q).tolist() == want
        assert plane_clusters.distances(plane_clusters.widen(p, p.shape[1] + 3), q).tolist() == want
        assert plane_clusters.column_sums(p) == [sum(map(int, c)) for c in a.T]


def _cluster(rows, clusters=8, rounds=10):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == 64 and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(1024 * np.float64(np.float32(x)))) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest(), plane_order(r[1])))
    cents = [v for _, v in order[:clusters]]

    def near(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c, strict=True)), k) for k, c in enumerate(cents))

    for _ in range(rounds):
        best = [near(v)[1] for _, v in kept]
        for k in range(len(cents)):
            mine = [v for (_, v), b in zip(kept, best, strict=True) if b == k]
            if mine:
                cents[k] = [sum(c) // len(mine) for c in zip(*mine, strict=True)]
    final = [(i, *near(v)) for i, v in kept]
    per = collections.Counter()
    for _, d, k in final:
        per[k] += d
    return sorted(((i, k, d, per[k], sum(per.values()), hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest()) for i, d, k in final), key=repr)


def plane_order(v):
    return plane_clusters.to_planes(np.array([v], np.int64)).view(np.int64)[0].tolist()


@pytest.mark.parametrize("top", [1.0, 50_000.0])
def test_clusters_equal_plain_rounds(spark, top):
    rng = random.Random(4)
    rows = [(i, [rng.gauss(i % 5, 0.3) * top for _ in range(64)], 9, "x") for i in range(120)]
    hot = [top] * 64
    rows += [(200 + i, hot, 9, "x") for i in range(60)]  # a third of all rows are copies
    rows += [rows[3], (None, [0.5] * 64, 9, "x"), (300, None, 9, "x"), (301, [], 9, "x"), (302, [1.0] * 63, 9, "x"), (303, [1.0] * 65, 9, "x"),
             (304, [1.0] * 63 + [None], 9, "x"), (305, [1.0] * 63 + [float("nan")], 9, "x"), (306, [float("inf")] + [1.0] * 63, 9, "x")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, cluster int, planes string").repartition(5)
    got = sorted(map(tuple, plane_clusters.cluster(df).collect()), key=repr)
    assert got == _cluster([r[:2] for r in rows])


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(1, [0.25] * 64), (2, [0.75] * 64)], "vec_id long, embedding array<double>")
    assert {(r["vec_id"], r["distance"]) for r in plane_clusters.cluster(df).collect()} == {(1, 0), (2, 0)}
    assert plane_clusters.cluster(df.limit(0)).count() == 0
    wide = spark.createDataFrame([(1, [1e300] * 64), (2, [-1e300] * 64)], "vec_id long, embedding array<double>")
    assert {r["distance"] for r in plane_clusters.cluster(wide, clusters=1, rounds=0).collect()} == {0, (1 << 63) - 1}


def _plain_fingerprint(text):
    """Byte by byte, with Python integers."""
    ends = []
    for i in range(len(text)):
        h = 0
        for j in range(i - 6, i + 1):
            h = (h * 0x9E3779B1 + (text[j] + 1 if j >= 0 else 0)) & 0xFFFFFFFF
        h ^= h >> 15
        h = h * 0x85EBCA6B & 0xFFFFFFFF
        h ^= h >> 13
        ones = 0
        while ones < 32 and h >> ones & 1:
            ones += 1
        ends.append((i + 1, ones))
    bits = 2
    while bits < 31 and sum(ones >= bits for _, ones in ends) > 64:
        bits += 1

    def sign(least):
        out, piece = "", b""
        for (_, ones), byte in zip(ends, text, strict=True):
            piece += bytes([byte])
            if ones >= least:
                out, piece = out + code(piece), b""
        return out + (code(piece) if piece else "")

    def code(piece):
        import zlib
        c = zlib.crc32(piece)
        c ^= (c >> 12) ^ (c >> 24)
        table = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
        return table[c >> 6 & 63] + table[c & 63]

    return f"{bits}:{sign(bits)}:{sign(bits + 1)}"


def _plain_likeness(a, b):
    if a == b:
        return 1.0
    x, y = a.split(":"), b.split(":")
    best = 0.0
    for n in range(40):
        if int(x[0]) <= n <= int(x[0]) + 1 and int(y[0]) <= n <= int(y[0]) + 1:
            p, q = x[1 + n - int(x[0])], y[1 + n - int(y[0])]
            p, q = [p[k:k + 2] for k in range(0, len(p), 2)], [q[k:k + 2] for k in range(0, len(q), 2)]
            row = list(range(len(q) + 1))
            for i, u in enumerate(p):
                new = [i + 1]
                for j, v in enumerate(q):
                    new.append(row[j] if u == v else 1 + min(row[j + 1], new[j]))
                row = new
            if p and q:
                best = max(best, (len(p) + len(q) - row[-1]) / (len(p) + len(q)))
    return best


def test_fingerprints_equal_a_plain_walk(docs):
    for text in _texts(8, 10)[1:]:
        data = text[:3000].encode()
        assert piecewise_hash.fingerprint(data) == _plain_fingerprint(data)
    # boundaries do not depend on how many bytes are hashed at once
    data = random.Random(1).randbytes(5000)
    whole = piecewise_hash.fingerprint(data)
    stride = piecewise_hash._STRIDE
    try:
        piecewise_hash._STRIDE = 64
        assert piecewise_hash.fingerprint(data) == whole
    finally:
        piecewise_hash._STRIDE = stride
    got = collections.Counter(tuple(r) for r in piecewise_hash.fingerprint_documents(docs).collect())
    assert got == collections.Counter((r["doc_id"], len(r["text"] or ""), piecewise_hash.fingerprint((r["text"] or "").encode())) for r in docs.collect())


def test_likeness_is_the_edit_distance():
    rng = random.Random(6)
    texts = ["".join(rng.choices("abcde ", k=rng.randint(0, 2000))).encode() for _ in range(30)]
    texts += [t[:len(t) // 2] + b"new words" + t[len(t) // 2:] for t in texts] + [t * 2 for t in texts[:5]]
    prints = [piecewise_hash.fingerprint(t) for t in texts]
    for a, b in itertools.product(prints, prints):
        assert piecewise_hash.likeness(a, b) == pytest.approx(_plain_likeness(a, b))
    for k in range(30):
        if len(texts[k]) > 300:
            assert piecewise_hash.likeness(prints[k], prints[k + 30]) > 0.8


@pytest.mark.parametrize("parts", ["1", "7"])
def test_neighbours_equal_a_plain_walk(spark, docs, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        got = [tuple(r) for r in piecewise_hash.compare_neighbours(docs).collect()]
        assert piecewise_hash.compare_neighbours(docs.limit(0)).count() == 0
        alone = piecewise_hash.compare_neighbours(docs.where("doc_id = 3")).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    from pyspark.sql import functions as F
    rows = [(r["doc_id"], r["text"] or "", r["h"]) for r in docs.withColumn("h", F.xxhash64(F.coalesce("text", F.lit("")))).collect()]
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), r[2]))
    want = []
    for (i, t, _), (_, u, _) in zip(rows, rows[1:] + rows[:1], strict=True):
        n = len(t) // 3
        new = (t[:len(t) - n] + u[:n]).encode()
        a, b, c = (piecewise_hash.fingerprint(x) for x in (t.encode(), new, u.encode()))
        want.append((i, len(t), hashlib.sha256(new).hexdigest(), a, b, piecewise_hash.likeness(a, b), piecewise_hash.likeness(a, c)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert len(alone) == 1 and alone[0]["near_next"] == 1.0
