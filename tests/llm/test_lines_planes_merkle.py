"""Line dedup, bit-plane clustering and Merkle manifest against brute force and SQL."""

import hashlib
import random
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from compare import differences, duck
from skyloom.llm import line_dedup, merkle_manifest, plane_clustering
from skyloom.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, source string, lang string, n_chars long, text string, t1 string, line int, tree string, pos int"


@pytest.mark.parametrize("name", list(ORACLES))
def test_against_sql(spark, name):
    assert differences(QUERIES[name](spark, SF), duck(SF), ORACLES[name]) == []


def _fold(text):
    return text.translate(str.maketrans(string.ascii_uppercase, string.ascii_lowercase))


def _frame(spark, rows):
    full = [(d, s, la, n, t, "x", 1, "y", 2) for d, s, la, n, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(5)


def _rows():
    draw = random.Random(11)
    shared = ["".join(draw.choice("abc dé") for _ in range(n)) + "end" for n in (37, 37, 60, 200, 36)]
    shared = ["x" + s[1:] for s in shared]
    rows = []
    for k in range(70):
        lines = [f"line {draw.random()} that only one document holds, {k}" for _ in range(draw.randrange(4))]
        for s in shared[: 1 + k % 5]:
            lines.insert(draw.randrange(len(lines) + 1), draw.choice(["\t ", "", "\x0b"]) + draw.choice([s, s.upper()]))
        if k % 7 == 0:
            lines += ["", shared[0], shared[0], ""]
        rows.append((k, draw.choice(["a", "b", None, "", "é"]), "en", len(lines), "\n".join(lines)))
    copy = rows[20]
    long = "\n".join([shared[2]] * 200 + ["short"] * 70 + [shared[3]] * 3)
    return [
        *rows, copy, (20, "a", None, None, "other text\n" + shared[0]), (None, "a", "en", 3, None), (None, None, "en", 3, long),
        (None, None, "en", 3, long), (100, "b", "en", 0, ""), (101, "b", "en", 0, "\n"), (2, "big", "de", 1, long),
        (-5, "big", "de", -1, "ÀB " + shared[1] + " "), (102, "big", "x", 5, shared[2] * 3000),
    ]


def _strip(line):
    return line.strip(" \t\n\x0b\x0c\r")


def _line_digests(rows):
    holders = defaultdict(set)
    for d, *_, text in rows:
        for line in (text or "").split("\n"):
            if len(key := _fold(_strip(line))) >= 40:
                holders[key].add(float("-inf") if d is None else d)
    gone = {k: max(v) for k, v in holders.items() if len(v) >= 5}
    for d, *_, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if gone.get(_fold(_strip(x)), d) == d]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        yield d, len(lines), len(lines) - len(kept), digest


def test_line_dedup(spark):
    rows = _rows()
    found = line_dedup.line_digests(_frame(spark, rows))
    expected = list(_line_digests(rows))
    assert Counter(map(tuple, found.collect())) == Counter(expected)
    assert sum(r[2] for r in expected) > 200
    one = line_dedup.keep_bitmaps(_frame(spark, rows), salts=1).collect()
    assert sorted(map(str, one)) == sorted(map(str, line_dedup.keep_bitmaps(_frame(spark, rows)).collect()))


def test_line_bitmaps_hold_changed_words_only(spark):
    lines = [f"the line with number {k} and some more of its own" for k in range(300)]
    docs = [(k, "s", "l", 1, "\n".join([*lines[:130], f"{k}" * 50, *lines[130:]] if k else lines)) for k in range(5)]
    keep = {r.doc_id: r.keep for r in line_dedup.keep_bitmaps(_frame(spark, docs)).collect()}
    assert set(keep) == {0, 1, 2, 3}
    assert [e.word for e in keep[1]] == [0, 1, 2, 3, 4] and keep[1][0].bits == 0 and keep[1][2].bits == 1 << 2
    few = [(k, "s", "l", 1, "\n".join(["own"] * 100 + lines[:1])) for k in range(5)]
    keep = line_dedup.keep_bitmaps(_frame(spark, few)).first().keep
    assert [tuple(e) for e in keep] == [(1, ~(1 << 36))]


def test_line_dedup_is_native(spark):
    plan = line_dedup.line_digests(_frame(spark, _rows()[:3]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_line_dedup_of_nothing(spark):
    assert line_dedup.line_digests(_frame(spark, [])).count() == 0


def _cluster(rows, k=8, rounds=10):
    most = (1 << 63) - 1

    def floor(x):
        return max(-(1 << 62), min(1 << 62, int(np.floor(float(x) * 1024)) if abs(x) < 1e300 else int(np.sign(x)) << 62))

    kept = [(v, e) for v, e in rows if e is not None and len(e) == 64 and all(x is not None and np.isfinite(x) for x in e)]
    named = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"3:{r[0]}".encode()).hexdigest() * (r[0] is not None), r[1]))
    kept = [(v, [floor(x) for x in e]) for v, e in kept]
    centroids = [[floor(x) for x in e] for _, e in named[:k]]

    def near(x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        groups = defaultdict(list)
        for _, x in kept:
            groups[near(x)[1]].append(x)
        centroids = [[sum(c) // len(c) for c in zip(*groups[n], strict=True)] if n in groups else old for n, old in enumerate(centroids)]
    placed = [(v, *near(x)) for v, x in kept]
    inertia = Counter()
    for _, d, c in placed:
        inertia[c] += min(d, most)
    for v, d, c in placed:
        digest = hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()
        yield v, c, min(d, most), min(inertia[c], most), min(sum(inertia.values()), most), digest


VECTORS = "vec_id long, embedding array<double>, label int, planes string, cluster string"


def _vectors(spark, rows):
    return spark.createDataFrame([(v, e, 1, "p", "c") for v, e in rows], VECTORS).repartition(4)


def _draw(n, spread=1.0, seed=1):
    draw = np.random.default_rng(seed)
    return [(k, (draw.normal(size=64) * spread).tolist()) for k in range(n)]


ODD = [
    (500, None), (501, []), (502, [0.5] * 63), (503, [0.5] * 65), (504, [None] + [0.5] * 63), (505, [float("nan")] * 64),
    (506, [0.1] * 63 + [float("inf")]), (507, [0.0] * 64), (507, [0.0] * 64), (507, [-0.0001] * 64), (None, [1.0] * 64),
]


@pytest.mark.parametrize(
    "rows",
    [
        _draw(300) + ODD,
        _draw(60, 1e5) + [(70, [3e5] * 64)],
        _draw(40, 1e12) + _draw(40, 0.01, 2) + [(900, [1e300] * 64), (901, [-1e300, 1e16] * 32)],
        [(k, [0.25] * 64) for k in range(20)],
        [(7, [float(k % 5)] * 64) for k in range(30)],
        _draw(3),
        [(None, [0.5] * 64), (None, [0.25] * 64)],
    ],
    ids=["odd rows", "wide", "beyond a long", "equal", "one id", "few", "no ids"],
)
def test_clusters(spark, rows):
    found = plane_clustering.cluster_vectors(_vectors(spark, rows)).collect()
    assert Counter(map(tuple, found)) == Counter(_cluster(rows))


def test_clusters_of_floats(spark):
    rows = [(k, np.float32(e).astype(float).tolist()) for k, e in _draw(50)]
    frame = _vectors(spark, rows).selectExpr("vec_id", "CAST(embedding AS ARRAY<FLOAT>) AS embedding")
    assert Counter(map(tuple, plane_clustering.cluster_vectors(frame).collect())) == Counter(_cluster(rows))


def test_clusters_of_nothing(spark):
    assert plane_clustering.cluster_vectors(_vectors(spark, ODD[:3])).count() == 0
    assert plane_clustering.cluster_vectors(_vectors(spark, [])).count() == 0


def test_planes():
    draw = np.random.default_rng(4)
    for width, most in ((12, 1 << 11), (27, 1 << 26), (40, 1 << 39), (64, 1 << 62)):
        a, b = (draw.integers(-most, most, (5, 64)) for _ in range(2))
        exact = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in b] for r in a]
        assert plane_clustering.dots(plane_clustering.pack(a, width), plane_clustering.pack(b, width)).tolist() == exact
        assert plane_clustering.sums(plane_clustering.pack(a, width)) == [sum(map(int, c)) for c in a.T]
    assert plane_clustering.widths(np.array([[0] * 64, [7] * 64, [8] * 64, [-8] * 64, [1 << 62] * 64])).tolist() == [4, 4, 8, 4, 64]


def _sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _tree(leaves):
    """The levels of a tree, lowest first."""
    levels = [leaves]
    while len(levels[-1]) > 1:
        low = levels[-1]
        levels.append([_sha("".join(low[k : k + 16])) for k in range(0, len(low), 16)])
    return levels


def _path(levels, at):
    for level in levels[:-1]:
        run = level[at // 16 * 16 : at // 16 * 16 + 16]
        yield "".join(run[: at % 16]), "".join(run[at % 16 + 1 :])
        at //= 16


def _leaf(row):
    values = (row[0], row[1], row[2], row[3], row[4])
    return _sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def _proofs(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source, members in groups.items():
        members.sort(key=lambda r: (r[0] is not None, r[0] or 0, _leaf(r)))
        trees[source] = _tree([_leaf(r) for r in members])
    top = _tree([trees[s][-1][0] for s in order])
    for n, source in enumerate(order):
        for at, row in enumerate(groups[source]):
            path = [*_path(trees[source], at), *_path(top, n)]
            due = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            folded = _leaf((*row[:4], _fold(row[4]))) if due and row[4] is not None else _leaf(row)
            for left, right in path:
                folded = _sha(left + folded + right)
            root = top[-1][0]
            proof = _sha("".join(a + b for a, b in path))
            yield row[0], _leaf(row), trees[source][-1][0], root, proof, folded, folded == root


@pytest.mark.parametrize("height", [1, 2, 3])
@pytest.mark.parametrize("sources", [1, 2, 40])
def test_proofs(spark, height, sources):
    draw = random.Random(sources)
    rows = [(k, f"s{draw.randrange(sources)}", "en", k, draw.choice("ABCdef") * 3) for k in range(600)]
    rows += _rows() if sources > 1 else []
    found = merkle_manifest.merkle_proofs(_frame(spark, rows), height).collect()
    expected = list(_proofs(rows))
    assert Counter(map(tuple, found)) == Counter(expected)
    assert 0 < sum(not r[-1] for r in expected) < len(rows)


@pytest.mark.parametrize("rows", [[], [(1, None, None, None, None)], [(3, "a", "b", 1, "C")] * 40])
def test_small_manifests(spark, rows):
    found = merkle_manifest.merkle_proofs(_frame(spark, rows)).collect()
    assert Counter(map(tuple, found)) == Counter(_proofs(rows))


@pytest.mark.parametrize("levels", [1, 2, 3, 4, 5])
def test_van_emde_boas_addresses(levels):
    places = [
        merkle_manifest.addresses(levels, d, np.arange(16**d, dtype=np.int64)) for d in range(levels)
    ]
    flat = np.concatenate(places)
    assert sorted(flat.tolist()) == list(range(merkle_manifest.subtree_size(levels)))
    assert places[0][0] == 0
    # the upper half of the levels fills the first places
    upper = np.concatenate(places[: max(levels // 2, 1)])
    assert upper.max() == upper.size - 1


def test_a_block_keeps_what_it_built():
    digests = [hashlib.sha256(bytes([k % 256, k // 256])).digest() for k in range(300)]
    built = merkle_manifest.Block.build(digests, 3)
    again = merkle_manifest.Block.stored(300, 3, built.nodes.tobytes())
    assert again.counts == [300, 19, 2, 1]
    for k in (0, 15, 16, 299):
        assert merkle_manifest.fold(digests[k], again.siblings(k)) == built.root()
        assert merkle_manifest.fold(digests[k - 1], again.siblings(k)) != built.root()
