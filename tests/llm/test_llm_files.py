"""Whitening, the Merkle manifest and token files against brute force, with NULLs, empty tables, ties, repeats and extra columns."""

import hashlib
import heapq
import zlib
from itertools import product

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tracklens.llm import feast, huffman, merkle, tokenfiles, whitening
from tracklens.session import ship_package


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship_package(spark)


# whitening


@pytest.mark.parametrize("size, wanted", [(1, 4), (3, 4), (40, 4), (40, 40)])
def test_contour_integration(size, wanted):
    a = np.random.default_rng(1).standard_normal((size, 2 * size))
    matrix = a @ a.T
    values, vectors = feast.largest(matrix, wanted)
    expected = np.linalg.eigvalsh(matrix)[::-1][:wanted]
    assert np.allclose(values, expected, rtol=1e-12)
    assert np.allclose(vectors.T @ matrix @ vectors, np.diag(expected), atol=1e-10 * expected[0])


def test_equal_zero_and_far_apart_eigenvalues():
    assert len(feast.largest(np.zeros((5, 5)), 3)[0]) == 0
    assert np.allclose(feast.largest(np.diag([2.0, 2, 2, 2, 0]), 3)[0], [2, 2, 2])
    assert np.allclose(feast.largest(np.diag([1.0, 0, 0, 0]), 3)[0], [1])
    assert np.allclose(feast.largest(np.diag([1e12, 1e6, 1, 0.5]).astype(np.longdouble), 4)[0], [1e12, 1e6, 1, 0.5])


def test_inertia():
    assert feast.positives(np.array([[0.0, 1], [1, 0]])) == 1
    a = np.random.default_rng(2).standard_normal((30, 30))
    assert feast.positives(a + a.T) == (np.linalg.eigvalsh(a + a.T) > 0).sum()


@pytest.mark.parametrize("reach", [300, 2**40])
def test_products_are_exact(reach):
    y = np.random.default_rng(3).integers(-reach, reach, (5000, 4))
    assert (whitening._products(y) == y.astype(object).T @ y.astype(object)).all()


def vectors(spark, rows):
    made = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return made.withColumns({"v": F.lit(1), "component": F.lit("x")}).repartition(3)


@pytest.mark.parametrize("offset", [0.0, 1e6])
def test_whitening(spark, offset):
    rng = np.random.default_rng(4)
    spread = rng.standard_normal((9, 9)) * np.arange(1, 10)
    rows = [(i, [float(c) for c in v + offset]) for i, v in enumerate(rng.standard_normal((400, 9)) @ spread)]
    odd = [(900, None), (901, []), (902, [None] * 9), (903, [float("nan")] * 9), (904, [float("inf")] * 9), (905, [1.0])]
    odd += [(None, rows[0][1]), (0, rows[0][1]), (906, rows[0][1])]
    got = whitening.whiten(vectors(spark, rows + odd)).collect()
    used = rows + odd[-3:]
    x = np.array([[int(np.floor(256 * c)) for c in v] for _, v in used], dtype=object)
    distinct = np.array([list(r) for r in {tuple(r) for r in x.tolist()}], dtype=object)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = n * distinct - sums
    values, axes = np.linalg.eigh((centred.T @ centred / n**3).astype(float))
    values, axes = values[::-1][:4], axes[:, ::-1][:, :4]
    expected = ((n * x - sums) / n).astype(float) @ axes / np.sqrt(values)
    key = lambda r: (str(r[0]), r[1], r[2])
    want = sorted(
        [
            (i, c + 1, int(((n * row - sums) ** 2).sum()), abs(w[c]))
            for (i, _), row, w in zip(used, x, expected, strict=True)
            for c in range(4)
        ],
        key=key,
    )
    have = sorted([(r.vec_id, r.component, int(r.deviation), abs(r.whitened)) for r in got], key=key)
    assert [w[:3] for w in want] == [h[:3] for h in have]
    assert np.allclose([w[3] for w in want], [h[3] for h in have], atol=1e-7)
    share = dict(zip(range(1, 5), values / (centred.T @ centred / n**3).astype(float).trace(), strict=True))
    assert all(r.n == n and r.identity_error < 1e-9 and abs(r.explained / share[r.component] - 1) < 1e-9 for r in got)


def test_whitening_of_nothing(spark):
    assert whitening.whiten(vectors(spark, []).limit(0)).count() == 0
    assert whitening.whiten(vectors(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    line = [(i, [float(i), 2.0 * i]) for i in range(5)]
    assert whitening.whiten(vectors(spark, line)).count() == 5  # one dimension, one component


# the Merkle manifest

ROWS = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(leaves, fanout):
    paths, at, level = [[] for _ in leaves], list(range(len(leaves))), leaves
    while len(level) > 1:
        for i, path in enumerate(paths):
            base = at[i] // fanout * fanout
            path.append(("".join(level[base : at[i]]), "".join(level[at[i] + 1 : base + fanout])))
            at[i] //= fanout
        level = [digest(*level[k : k + fanout]) for k in range(0, len(level), fanout)]
    return level[0], paths


def brute_manifest(rows, fanout=2):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0], digest(*map(framed, r)), r))
    keys = sorted(groups, key=lambda k: (k is not None, (k or "").encode()))
    for k in keys:
        groups[k].sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1]))
    trees = {k: tree([t[1] for t in groups[k]], fanout) for k in keys}
    out = []
    if not keys:
        return out
    root, top = tree([trees[k][0] for k in keys], fanout)
    for k, above in zip(keys, top, strict=True):
        for (i, own, r), path in zip(groups[k], trees[k][1], strict=True):
            start = own
            if i is not None and zlib.crc32(str(i).encode()) % 7 == 0 and r[3] is not None:
                start = digest(*map(framed, (*r[:3], r[3] + 1, r[4])))
            for left, right in path + above:
                start = digest(left, start, right)
            near = digest(*[a + b for a, b in path + above])
            out.append((i, own, trees[k][0], root, near, start, start == root))
    return sorted(out, key=str)


def manifest_rows():
    rows = [
        (i, "s", ["en", "de", None, "fr", "é"][i * i % 5 if i < 40 else 0], i if i % 5 else None, f"t{i}" if i % 9 else None)
        for i in range(290)
    ]
    return rows + [(None, None, None, None, None)] * 2 + [(7, "s", "en", 1, "q")] * 3 + [(7, "s", "en", 1, "")]


@pytest.mark.parametrize("rows", [[], [(1, "a", "en", 3, "x" * 100_000)], manifest_rows()])
def test_manifest(spark, rows):
    df = spark.createDataFrame(rows, ROWS).withColumns({"key": F.lit(1), "at": F.lit(2), "leaf": F.lit("z")})
    got = merkle.document_manifest(df.repartition(4)).collect()
    assert sorted(map(tuple, got), key=str) == brute_manifest(rows)


def test_manifest_with_wider_runs(spark):
    rows = manifest_rows()
    leaf = merkle.leaf(*[F.col(c) for c in merkle.FIELDS])
    made = merkle.manifest(spark.createDataFrame(rows, ROWS), {"leaf": leaf}, fanout=3, levels=2)
    got = made.select("doc_id", "leaf", "subroot", "root", merkle.fold(F.col("leaf"), F.col("proof")).alias("folded"))
    assert all(r.folded == r.root for r in got.collect())
    expected = {(r[1], r[2], r[3]) for r in brute_manifest(rows, 3)}
    assert {(r.leaf, r.subroot, r.root) for r in got.collect()} == expected


# token files


def huffman_cost(counts):
    heap, cost = [int(c) for c in counts if c], 0
    heapq.heapify(heap)
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        cost += both
        heapq.heappush(heap, both)
    return cost


@pytest.mark.parametrize("n, limit", [(1, 18), (2, 18), (3, 2), (5000, 25), (300, 9)])
def test_codes_round_trip(n, limit):
    rng = np.random.default_rng(n)
    counts = rng.integers(30, 1000, n) ** 2  # so even that no code is over 25 bits unless limited
    lengths = huffman.code_lengths(counts, limit)
    assert lengths.max() <= limit and (n == 1 or sum(2.0 ** -lengths.astype(float)) == 1)
    cost = int((counts * lengths).sum())
    assert cost >= huffman_cost(counts) and (limit < 18 or n == 1 or cost == huffman_cost(counts))
    coder = huffman.Coder(lengths)
    blocks = [rng.choice(n, size=s, p=counts / counts.sum()) for s in (1, 255, 256, 257, 9000)]
    made = coder.decode([(*coder.encode(b), len(b)) for b in blocks])
    assert all(np.array_equal(a, b) for a, b in zip(blocks, made, strict=True))


def test_limited_codes_are_the_best():
    rng = np.random.default_rng(9)
    for n in (3, 5, 6):
        counts = rng.integers(1, 200, n)
        fits = [k for k in product(range(1, 4), repeat=n) if sum(2.0**-x for x in k) <= 1]
        assert (counts * huffman.code_lengths(counts, 3)).sum() == min((counts * k).sum() for k in map(np.array, fits))


def test_codes_are_canonical_and_limited():
    lengths = huffman.code_lengths(np.array([1, 0, 1, 2, 4, 8, 16, 32]), 4)
    assert lengths[1] == 0 and lengths.max() == 4
    ids, codes = huffman.canonical(lengths)
    texts = [f"{c:0{lengths[i]}b}" for i, c in zip(ids, codes, strict=True)]
    assert texts == sorted(texts) and not any(b.startswith(a) for a in texts for b in texts if a != b)
    with pytest.raises(ValueError):
        huffman.code_lengths(np.ones(5, dtype=int), 2)


def test_joined_crc():
    parts = [b"abc" * 5, b"", b"x" * 999]
    assert tokenfiles.joined_crc([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


def texts():
    odd = [None, "", " a", "a  b   c \n d\t\n e \n\n f  ", "<|endoftext|> x<|endoftext|>", "é x \x1c y   z\r\n", " \n ", "\n"]
    odd += ["日本語 テキスト 😀 ", "don't  it's 'll\n'x", "x" * 30_000, "word " * 9000]
    return [(i - 3, t) for i, t in enumerate(odd)] + [(None, "no id"), (2, "twice"), (2, "again")] + [(5, "same")] * 6


@pytest.mark.parametrize("block", [tokenfiles.BLOCK_IDS, 100])
def test_token_files(spark, tmp_path, block):
    rows = texts()
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, did int, ids string")
    folder = str(tmp_path / "files")
    tokenfiles.write_ids(df.repartition(3), folder, block_ids=block)
    stretches = tokenfiles.read_ids(spark, folder)
    got = tokenfiles.digest(stretches).orderBy("start").collect()
    plain = Tokenizer.from_file(tokenfiles.tokenizer_path())
    ids = [(i, [*plain.encode(t or "", add_special_tokens=False).ids, 0]) for i, t in rows]
    want = [(i, len(k), zlib.crc32(np.array(k, "<u4").tobytes())) for i, k in ids]
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=str) == sorted(want, key=str)
    order = [-(2**63) if r.doc_id is None else r.doc_id for r in got]
    assert order == sorted(order)
    assert [r.start for r in got] == [0, *np.cumsum([r.n_tokens for r in got])[:-1].tolist()]
    read = {}
    for r in sorted(stretches.collect(), key=lambda r: (r.start, r.at)):
        read[r.start] = read.get(r.start, b"") + r.ids
    assert sorted(read.values()) == sorted(np.array(k, "<u4").tobytes() for _, k in ids)


def test_token_files_of_nothing(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert tokenfiles.round_trip(df).count() == 0
