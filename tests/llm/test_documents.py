"""Operators on documents against brute force, with nulls, empty texts, copies and odd columns."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from tokenizers import Tokenizer

from skyloom.llm import bpe, decontaminate, length_histogram, simhash, suffix_dedup, token_orc
from skyloom.llm.encoding import VOCABULARY, LibraryEncoder

SCHEMA = "doc_id long, text string, lang string, anchor long, id long, fp long, shard string, part int"


def _texts():
    draw = random.Random(3)
    words = [f"w{draw.randrange(400)}" for _ in range(4000)]
    shared = " ".join(words[:60])
    long = " ".join(draw.choice(words) for _ in range(30_000))
    texts = [None, "", " \n\t ", "one", "Two words", "a" * 900, "ab" * 300, "<|endoftext|> x  y\n z ", long]
    for k in range(60):
        body = " ".join(draw.choice(words) for _ in range(draw.randrange(5, 120)))
        texts.append(body)
        if k % 4 == 0:
            texts.append(body)  # a copy
        if k % 5 == 0:
            texts.append(body[:150] + " " + shared + " é漢 " + body[150:])
    return texts + ["é" * 150 + shared, "ß" * 150 + shared[:199], shared[:200]]


@pytest.fixture(scope="module")
def rows():
    texts = _texts()
    rows = [(k, t) for k, t in enumerate(texts)]
    return [*rows, (None, "no id"), (None, None), (3, "one"), (3, "another text under a known id")]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame([(d, t, "en", 1, 2, 3, "s", 4) for d, t in rows], SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def _same(found, expected):
    assert Counter(map(tuple, found)) == Counter(expected)


def _removed(texts, length):
    raw = [(t or "").encode() for t in texts]
    starts = Counter(t[k : k + length] for t in raw for k in range(len(t) - length + 1))
    for t in raw:
        gone = np.zeros(len(t) + 2, int)
        for k in range(len(t) - length + 1):
            if starts[t[k : k + length]] > 1:
                gone[k + 1 : k + 1 + length] = 1
        kept = bytes(b for b, g in zip(t, gone[1:-1], strict=True) if not g)
        yield len(t), int(gone.sum()), int((np.diff(gone) == 1).sum()), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("largest", [2_000, 3])
def test_repeats_against_brute_force(docs, rows, largest):
    expected = [(d, *r) for (d, _), r in zip(rows, _removed([t for _, t in rows], 200), strict=True)]
    _same(suffix_dedup.remove_repeats(docs, largest=largest).collect(), expected)


def test_repeats_with_text_keep_columns(docs, rows):
    found = suffix_dedup.remove_repeats(docs, with_text=True, keep=["doc_id", "anchor", "id", "lang"])
    assert found.columns[:4] == ["doc_id", "anchor", "id", "lang"] and found.count() == len(rows)


def test_large_collection_of_one_anchor(spark):
    draw = random.Random(5)
    passage = "".join(draw.choice("abcdefgh ") for _ in range(260))
    texts = ["".join(draw.choice("xyzuvw") for _ in range(80)) + passage + str(k) * 50 for k in range(150)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    expected = [(k, *r) for k, r in enumerate(_removed(texts, 200))]
    _same(suffix_dedup.remove_repeats(docs, largest=10).collect(), expected)


def _words(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", folded)


@pytest.mark.parametrize("block_words", [2_000_000, 40])
def test_contamination_against_brute_force(spark, docs, rows, block_words):
    texts = [t for _, t in rows if t]
    items = [(k, " ".join(_words(texts[k])[3:40]).upper()) for k in range(9, 40, 6)]
    items += [(100, "Two, words"), (101, None), (102, "..."), (9, "one"), (103, "never met")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = defaultdict(set)
    for item, text in items:
        found = _words(text)
        size = min(10, len(found))
        for k in range(len(found) - size + 1 if size else 0):
            windows[tuple(found[k : k + size])].add(str(item))
    expected = []
    for doc_id, text in rows:
        found, hit, names = _words(text), set(), set()
        for window, owners in windows.items():
            for k in range(len(found) - len(window) + 1):
                if tuple(found[k : k + len(window)]) == window:
                    hit.update(range(k, k + len(window)))
                    names |= owners
        digest = hashlib.sha256(",".join(sorted(names)).encode()).hexdigest()
        expected.append((doc_id, len(found), len(hit), len(names), digest, bool(hit)))
    found = decontaminate.find_contamination(docs, benchmark, block_words=block_words)
    _same(decontaminate.contamination_digest(found).collect(), expected)


def test_blocks_share_one_numbering(spark, tmp_path, monkeypatch):
    rows = [(k, f"a{k} b{k} c{k} " * (k + 1)) for k in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(8).write.parquet(f"{tmp_path}/docs")
    benchmark = spark.createDataFrame([(k, f"a{k} b{k} c{k}") for k in range(30)], "item_id long, text string")
    blocks = decontaminate.benchmark_blocks
    name = "spark.sql.files.minPartitionNum"

    def resplit(*given):
        # the files are packed into other partitions for each block
        for k, block in enumerate(blocks(*given)):
            spark.conf.set(name, "1" if k % 2 else "64")
            yield block

    monkeypatch.setattr(decontaminate, "benchmark_blocks", resplit)
    try:
        found = decontaminate.find_contamination(spark.read.parquet(f"{tmp_path}/docs"), benchmark, block_words=30)
        found = found.where("contaminated").collect()
    finally:
        spark.conf.unset(name)
    assert sorted((r.doc_id, r.items) for r in found) == [(k, [str(k)]) for k in range(30)]


def test_proximity(spark):
    docs = spark.createDataFrame(
        [(1, "alpha x x beta"), (2, "beta alpha"), (3, "alpha " + "x " * 9 + "beta"), (4, "alpha")],
        "doc_id long, text string",
    )
    benchmark = spark.createDataFrame([(7, "alpha beta")], "item_id long, text string")
    found = decontaminate.find_contamination(docs, benchmark, reach=4)
    assert {r.doc_id for r in found.where("contaminated").collect()} == {1, 2}
    none = decontaminate.find_contamination(docs, benchmark.where("false"))
    assert none.count() == 4 and none.where("contaminated").isEmpty()


@pytest.fixture(scope="module")
def reference():
    return Tokenizer.from_file(VOCABULARY)


def test_encoders_against_the_library(reference):
    draw = random.Random(9)
    bits = [
        "a", "b", "the", " ", "  ", "\n", " \n", "\t", "é", "ß", "1", "23", "'s", "'ll", "!", "$$$", "<|endoftext|>",
        "\x1c", "\x85", "\0", "漢字", "😀", "²", "ª", "\u3000", "z" * 200, "Ünd",
    ]
    texts = ["".join(draw.choice(bits) for _ in range(draw.randrange(25))) for _ in range(3000)]
    texts += ["a" * 20_000, "ab" * 5_000 + "é" * 3_000, " " * 3_000]
    own = bpe.RankArrayEncoder(kept_bytes=50_000)
    lists = [reference.encode(t, add_special_tokens=False).ids for t in texts]
    for encoder in (own, LibraryEncoder(kept_bytes=20_000)):
        found = [x for k in range(0, len(texts), 100) for x in encoder.encode(texts[k : k + 100])]
        assert [np.frombuffer(x, "<u4").tolist() for x in found] == lists
    for ids in [*lists[:200], *[[draw.randrange(50_257) for _ in range(9)] for _ in range(200)]]:
        assert own.decode(ids) == reference.decode(ids, skip_special_tokens=False)


def test_digests(docs, rows, reference):
    expected = []
    for doc_id, text in rows:
        ids = reference.encode(text or "", add_special_tokens=False).ids
        shown = reference.decode(ids, skip_special_tokens=False)
        sums = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), shown)]
        expected.append((doc_id, len(ids), *sums))
    _same(bpe.encoding_digests(docs).collect(), expected)
    pairs = bpe.encode_documents(docs).collect()
    assert Counter((r.doc_id, r.decoded) for r in pairs) == Counter((d, t or "") for d, t in rows)


class _Tasks:
    """Stands for a frame and hands out the function of its tasks."""

    def select(self, *columns):
        return self

    def mapInArrow(self, run, schema):
        return run


def test_encoding_takes_little_memory(spark, reference):
    """Many different words in one batch: what is held at once depends neither on the batch nor on the words."""
    draw = random.Random(11)
    texts = [" ".join("%07x" % draw.randrange(1 << 28) for _ in range(1_000)) for _ in range(600)]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(600), pa.int64()), "text": pa.array(texts, pa.string())})
    task = bpe.encoding_digests(_Tasks(), with_ids=True)
    list(task(iter([batch.slice(0, 1)])))  # the encoder
    tracemalloc.start()
    sizes, seen = [], {}
    for out in task(iter([batch])):
        sizes.append(out.num_rows)
        for k in range(0, out.num_rows, 50):
            seen[out.column(0)[k].as_py()] = out.column(4)[k].as_py()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(sizes) == len(texts)
    assert seen == {k: reference.encode(texts[k], add_special_tokens=False).ids for k in seen}
    assert peak < 80_000_000


def test_token_files(spark, docs, rows, reference, tmp_path):
    target = str(tmp_path / "tokens")
    token_orc.write_tokens(docs, target)
    found = token_orc.token_index(spark, target).collect()
    sums = defaultdict(list)
    for doc_id, text in rows:
        ids = [*reference.encode(text or "", add_special_tokens=False).ids, token_orc.END_ID]
        sums[doc_id].append((len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in found) == Counter(
        (d, *x) for d, v in sums.items() for x in v
    )
    at = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == at
        at += row.n_tokens
    ids = [r.doc_id for r in sorted(found, key=lambda r: r.start)]
    assert ids == sorted(ids, key=lambda d: (d is not None, d))
    some = token_orc.read_tokens(spark, target, 10, 12)
    assert sorted(r.doc_id for r in some.collect()) == [10, 11, 12]
    plan = token_orc.read_documents(spark, target, [11])._jdf.queryExecution().toString()
    assert "PushedFilters: [In(doc_id" in plan or "PushedFilters: [IsNotNull(doc_id), EqualTo(doc_id" in plan
    import pyarrow.orc as orc

    for file in sorted((tmp_path / "tokens").glob("*.orc")):
        assert orc.ORCFile(file).nstripes >= 1


def test_length_histogram(docs, rows, reference):
    lengths = Counter(len(reference.encode(t or "", add_special_tokens=False).ids) for _, t in rows)
    total = sum(lengths.values())
    expected = [
        (
            k, n, k * n, sum(m for x, m in lengths.items() if x >= k), sum(x * m for x, m in lengths.items() if x >= k),
            sum(min(x, k) * m for x, m in lengths.items()), sum(m for x, m in lengths.items() if x <= k) / total,
        )
        for k, n in lengths.items()
    ]
    histogram = length_histogram.length_histogram(docs).cache()
    _same(histogram.collect(), expected)
    cut = {r.limit: (r.n_whole, r.n_tokens) for r in length_histogram.truncated_totals(histogram, [0, 50]).collect()}
    assert cut[50] == (sum(n for x, n in lengths.items() if x <= 50), sum(min(x, 50) * n for x, n in lengths.items()))
    middle = sorted(lengths.elements())[(total - 1) // 2]
    assert length_histogram.quantile(histogram, 0.5).first().length == middle


def _fingerprint(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", folded)
    runs = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(r.encode(), seed=42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _groups(values, near):
    group = list(range(len(values)))

    def top(k):
        while group[k] != k:
            k = group[k]
        return k

    for a in range(len(values)):
        for b in range(a):
            if near(values[a], values[b]):
                x, y = top(a), top(b)
                group[max(x, y)] = min(x, y)
    return [top(k) for k in range(len(values))]


def test_near_duplicates_against_brute_force(docs, rows):
    prints = [_fingerprint(t) for _, t in rows]
    group = _groups(prints, lambda a, b: (a ^ b).bit_count() <= 2)
    least = defaultdict(list)
    for (doc_id, _), g in zip(rows, group, strict=True):
        least[g] += [doc_id] if doc_id is not None else []
    expected = [
        (d, f"{p:016x}", min(least[g], default=None)) for (d, _), p, g in zip(rows, prints, group, strict=True)
    ]
    found = simhash.near_duplicates(docs)
    _same(found.select("doc_id", "fingerprint", "component_id").collect(), expected)
    kept = simhash.keep_one_of_each(docs, found).collect()
    assert len(kept) == len(set(group)) and len(kept[0]) == len(SCHEMA.split(","))


@pytest.mark.parametrize("size", [1, 7, 40, 1 << 18])
def test_long_texts_in_slices(spark, monkeypatch, size):
    """Slices of any size, cut inside words and white space, give the fingerprint of the whole text."""
    monkeypatch.setattr(simhash, "SLICE", size)
    draw = random.Random(size)
    texts = ["", " \t ", "one", "One  two", "a b c", " a\u00a0b\nC\x0bd " * 9, "x" * 200, "\u00e9" * 90 + " y z"]
    texts += [" ".join(draw.choice(["Ab", "c", "\u00fc", "dd"]) for _ in range(n)) for n in (2, 3, 4, 50, 400)]

    def digest(data):
        return xxhash.xxh64_intdigest(data, 42)

    for text in texts:
        assert simhash._long_fingerprint(text.encode().lower(), 3, digest) == _fingerprint(text)


def test_a_very_long_text_takes_little_memory(spark):
    text = " ".join(f"w{k % 7919}" for k in range(2_000_000))
    data = text.encode()
    assert len(data) > 10_000_000
    tracemalloc.start()
    value = simhash._long_fingerprint(data, 3, lambda b: xxhash.xxh64_intdigest(b, 42))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 60_000_000
    frame = spark.createDataFrame([(1, text), (2, "a b c"), (3, None)], "doc_id long, text string")
    found = {r.doc_id: r.fp & (1 << 64) - 1 for r in simhash.fingerprints(frame).collect()}
    assert found == {1: value, 2: _fingerprint("a b c"), 3: 0}


@pytest.mark.parametrize("largest", [256, 4])
def test_links_of_dense_fingerprints(spark, largest):
    draw = random.Random(11)
    values = set()
    for _ in range(12):
        base = draw.getrandbits(64)
        for _ in range(25):
            values.add(base ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) ^ (draw.getrandbits(4) << 30))
    values = [v - (1 << 64) if v >> 63 else v for v in sorted(values)]
    mask = (1 << 64) - 1
    group = _groups(values, lambda a, b: ((a ^ b) & mask).bit_count() <= 2)
    links = simhash.fingerprint_links(spark.createDataFrame([(v,) for v in values], "fp long"), largest=largest)
    place = {v: k for k, v in enumerate(values)}
    rows = links.collect()
    found = _groups(list(range(len(values))), lambda a, b: False)
    for _ in range(len(values)):
        before = list(found)
        for r in rows:
            low = min(found[place[r.a]], found[place[r.b]])
            found[place[r.a]] = found[place[r.b]] = low
        if found == before:
            break
    assert Counter(Counter(found).values()) == Counter(Counter(group).values())


def test_bk_tree():
    tree, values = simhash.BKTree(), [0, 1, 3, 7, 255, 0, 1 << 63]
    for v in values:
        tree.add(v)
    for query in (0, 2, 254):
        expected = [k for k, v in enumerate(values) if (v ^ query).bit_count() <= 2]
        assert sorted(tree.within(query, 2)) == expected


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "item_id long, text string")
    for result in (
        suffix_dedup.remove_repeats(empty),
        decontaminate.find_contamination(empty, none),
        token_orc.encode_to_files(empty),
        length_histogram.length_histogram(empty),
        simhash.near_duplicates(empty),
        bpe.encoding_digests(empty),
    ):
        assert result.count() == 0
