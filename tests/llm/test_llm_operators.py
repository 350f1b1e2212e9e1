"""Each operator against brute force on small fixtures with NULLs, empty and long texts, ties, repeats and extra columns."""

import hashlib
import json
import random
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tracklens.llm import (
    chat,
    decontaminate,
    graph,
    licences,
    linededup,
    neighbours,
    packing,
    simhash,
    suffixes,
    toxicity,
    wrappers,
)

DOCS = "doc_id long, text string, did string, key int"
WORDS = "ba ca da fe go hu ji ko lu mi no pa qui ro sa tu".split()


def prose(rng, n):
    return " ".join("".join(rng.choices(WORDS, k=rng.randint(1, 4))) for _ in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1) for i, t in rows], DOCS).repartition(3)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(4)
    shared, line = prose(rng, 60), "The same line, in many documents."
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "one two"), (None, "a line without an id " + line)]
    for i in range(5, 45):
        text = prose(rng, rng.randint(5, 120))
        if i % 4 == 0:
            text = f"{text}\n {line.upper()}\t\n{shared}"
        if i % 5 == 0:
            text += " " + prose(rng, 8) + "\n" + line
        rows.append((i, text))
    rows += [(50, rows[20][1]), (51, rows[20][1].replace("ba", "ca", 1)), (52, "é" * 200), (53, "é" * 200)]
    rows += [(54, prose(rng, 6000)), (20, dict(rows)[20])]
    return rows


# line dedup


def brute_lines(rows):
    blank = " \t\n\x0b\x0c\r"
    upper = {c: c + 32 for c in range(65, 91)}
    held = {}
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(blank).translate(upper)
            if len(key) >= 20:
                held.setdefault(key, set()).add(-(2**63) if i is None else i)
    out = []
    for i, t in rows:
        own, lines = -(2**63) if i is None else i, (t or "").split("\n")
        kept = []
        for line in lines:
            ids = held.get(line.strip(blank).translate(upper), ())
            if not (len(ids) >= 3 and own != max(ids)):
                kept.append(line)
        out.append((i, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(out, key=str)


@pytest.mark.parametrize("batches", [1, 5])
def test_line_dedup(spark, corpus, batches):
    made = linededup.drop_repeated_lines(documents(spark, corpus), batches=batches)
    assert made.columns == ["doc_id", "text", "did", "key", "n_lines", "n_dropped"]
    got = [(r.doc_id, r.text, r.n_lines, r.n_dropped) for r in made.collect()]
    assert sorted(got, key=str) == brute_lines(corpus)


def test_line_dedup_of_nothing(spark):
    assert linededup.drop_repeated_lines(documents(spark, []).limit(0)).count() == 0


# SimHash


def plain_fingerprint(text):
    words = [w for w in (text or "").encode().lower().split()]
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(nodes, linked):
    label = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a in nodes:
            for b in nodes:
                if linked(a, b) and label[b] < label[a]:
                    label[a], changed = label[b], True
    return label


def test_simhash(spark, corpus):
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents(spark, corpus)).collect()}
    prints = {i: plain_fingerprint(t) for i, t in corpus}
    assert {i: f"{p:016x}" for i, p in prints.items()} == {i: f for i, (f, _) in got.items()}
    order = {i: -1 if i is None else i for i in prints}
    label = brute_components(
        sorted(order.values()),
        lambda a, b, p={order[i]: v for i, v in prints.items()}: (p[a] ^ p[b]).bit_count() <= 4,
    )
    assert {order[i]: -1 if c is None else c for i, (_, c) in got.items()} == label


def test_simhash_links_are_complete(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(30)]
    values = set(base)
    for b in base:
        for _ in range(20):
            flipped = b
            for bit in rng.sample(range(64), rng.randint(1, 6)):
                flipped ^= 1 << bit
            values.add(flipped)
    values = sorted(values)
    frame = spark.createDataFrame([(int(np.uint64(v).astype(np.int64)),) for v in values], "fp long")
    for run_rows in (4096, 16):  # 16: runs are dealt out in pieces
        made = simhash.links(frame, run_rows=run_rows).collect()
        pairs = {(r.a % 2**64, r.b % 2**64) for r in made}
        assert all((a ^ b).bit_count() <= 4 for a, b in pairs)
        want = brute_components(values, lambda a, b: (a ^ b).bit_count() <= 4)
        assert brute_components(values, lambda a, b: (a, b) in pairs or (b, a) in pairs or a == b) == want


def test_keep_one(spark, corpus):
    made = simhash.keep_one(documents(spark, corpus))
    assert made.columns == ["doc_id", "text", "did", "key"]
    groups = {r.component_id for r in simhash.near_duplicates(documents(spark, corpus)).collect()}
    assert sorted(r.doc_id or -1 for r in made.collect()) == sorted(g or -1 for g in groups)


def test_filters_decide_by_row(spark):
    rng = random.Random(12)
    texts = [". ".join(prose(rng, 12) for _ in range(4)) + "." for _ in range(10)]
    rows = [(None, t) for t in texts[:5]] + [(7, t) for t in texts[5:]]
    made = simhash.keep_one(documents(spark, [*rows, *rows[:2], (7, texts[0]), (7, texts[6])]))
    assert sorted((r.doc_id or -1, r.text) for r in made.collect()) == sorted((i or -1, t) for i, t in rows)
    item = prose(rng, 30)
    docs = documents(spark, [*rows, (None, f"x {item} y"), (7, f"z {item}")])
    left = decontaminate.clean(docs, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(r.text for r in left.collect()) == sorted(texts)
    known = [(100 + i, prose(rng, 9) + ". you vile thing" * (i % 2)) for i in range(400)]
    docs = documents(spark, [*rows, *known, (None, "you vile thing"), (7, "you vile thing")])
    marks = spark.createDataFrame([(i, i % 2) for i, _ in known], "doc_id long, toxic int")
    left = [r.text for r in toxicity.reject(docs, marks).collect() if r.doc_id in (None, 7)]
    assert sorted(left) == sorted(texts)


def test_components_of_a_long_chain(spark):
    chain = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r.component for r in graph.components(chain).collect()} == {0}
    assert graph.components(chain.limit(0)).count() == 0


# suffix dedup


def test_suffix_dedup(spark, corpus):
    got = {
        r.doc_id: (r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
        for r in suffixes.remove_repeats(documents(spark, corpus)).collect()
    }
    rows = [(-(2**63) if i is None else i, (t or "").encode()) for i, t in corpus]
    want = suffixes.brute_force(rows)
    assert got == {None if i == -(2**63) else i: v for i, v in want.items()}
    assert sum(v[0] for v in got.values()) > 1000


def test_texts_of_one_id_are_cut_apart(spark):
    """(2, A with a tail) repeats document 1, (2, B) and the rows without an id repeat nothing."""
    rng = random.Random(6)
    a, b, c, d = (prose(rng, 30) for _ in range(4))
    rows = [(1, a), (2, a + " tail one"), (2, b), (None, c), (None, d), (3, b), (3, c + d), (3, prose(rng, 25))]
    made = suffixes.remove_repeats(documents(spark, rows)).collect()
    got = sorted((r.doc_id is not None, r.doc_id or 0, r.n_bytes, r.n_removed) for r in made)
    size = {t: len(t) for _, t in rows}
    full = {(2, a + " tail one"): size[a], (3, b): size[b], (3, c + d): size[c + d]}
    want = sorted((i is not None, i or 0, size[t], full.get((i, t), 0)) for i, t in rows)
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) <= 1 for g, w in zip(got, want, strict=True)), (got, want)


def test_suffix_pieces(monkeypatch):
    rng = random.Random(2)
    data = prose(rng, 900).encode()
    whole = suffixes.stretches([(1, 0, data)])
    monkeypatch.setattr(suffixes, "PIECE", 700)
    parts = list(suffixes._pieces(1, data))
    assert len(parts) > 3
    cut = suffixes.stretches(parts)
    assert whole["count"].sum() == cut["count"].sum() == len(data) - 49


# decontamination


def test_decontamination(spark):
    rng = random.Random(3)
    items = [(i, prose(rng, n)) for i, n in enumerate((3, 5, 9, 30, 60, 61))]
    items += [(6, None), (7, ""), (8, "!!!"), (9, items[3][1])]
    near = items[4][1].split()
    near[3] = "changed"
    rows = [(0, None), (1, ""), (2, prose(rng, 3000) + " " + items[3][1].upper() + ", " + prose(rng, 3000))]
    rows += [(3, items[0][1]), (4, "x " + items[1][1] + " y"), (5, " ".join(near)), (6, prose(rng, 40))]
    rows += [(7, " ".join(items[4][1].split()[:30])), (None, items[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")

    def shingles(text):
        words = decontaminate._word.findall((text or "").lower())
        n = min(5, len(words))
        return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set(), n, words

    want = set()
    for item, text in items:
        own, n, _ = shingles(text)
        for doc, body in rows:
            words = shingles(body)[2]
            has = {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if n else set()
            if own and len(own & has) >= 0.8 * len(own) - 1e-9:
                want.add((doc, item, len(own & has), len(own)))
    for block in (500_000, 20):
        made = decontaminate.contained_items(documents(spark, rows), benchmark, block_shingles=block)
        got = {(r.doc_id, r.item_id, r.n_shared, r.n_item) for r in made.collect()}
        assert got == want
    kept = decontaminate.clean(documents(spark, rows), benchmark)
    assert {r.doc_id for r in kept.collect()} == {d for d, _ in rows} - {w[0] for w in want}
    assert decontaminate.clean(documents(spark, rows), benchmark.limit(0)).count() == len(rows)


# packing


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    whole = Tokenizer.from_file(packing.tokenizer_path())
    rows = [*corpus, (60, "a<|endoftext|>b don't it's I'LL _x_ 12 34,5 ΑΣ İ ﬁ naïve " + "  z y")]
    ids = {}
    for i, t in rows:
        found = np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        ids.setdefault(i, found)
    made = packing.digest(packing.pack(documents(spark, rows), shard_tokens=6000)).collect()
    by_doc, by_sequence = {}, {}
    for r in made:
        expected = zlib.crc32(ids[r.doc_id][r.start : r.start + r.length].tobytes())
        assert r.ids_crc32 == expected and r.doc_tokens == len(ids[r.doc_id])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(n for v in by_doc.values() for _, n in v) == sum(len(ids[i]) for i, _ in rows)
    for i, pieces in by_doc.items():
        if i != 20:  # twice in the corpus
            pieces.sort()
            assert [s for s, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
    for pieces in by_sequence.values():
        pieces.sort()
        assert [s for s, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
        total = sum(n for _, n in pieces)
        assert total <= 2048 and total & (total - 1) == 0
    assert packing.pack(documents(spark, rows).limit(0)).count() == 0


def test_neighbours_fill_the_window():
    rarity = np.ones(packing.VOCABULARY, dtype=np.float32)
    docs = [np.full(100, t, "<u2") for t in (5, 9, 5, 9, 5)]
    pieces = packing.pack_shard(docs, rarity)
    assert [p[0] for p in pieces if p[4] == 0][0] == 0
    order = list(dict.fromkeys(p[0] for p in pieces))
    assert order[:3] == [0, 2, 4]  # documents of the seed's token first


# chat


def test_chat(spark):
    rows = [
        (1, 0, "system", "be [nice] ~1 <s>"),
        (1, 2, "assistant", "é1"),
        (1, 1, "user", None),
        (1, 3, "assistant", "[+]</s>~~0"),
        (1, 3, "assistant", "[+]</s>~~0"),
        (2, None, None, ""),
        (2, 0, "we]ird", "x"),
        (None, 0, "assistant", "no id"),
    ]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    turns = turns.withColumn("turns", F.lit(1)).withColumn("formatted", F.lit("clash"))
    got = {r.conv_id: r for r in chat.digests(chat.format_chats(chat.with_probe(turns))).collect()}
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    for conv in (1, 2, None, -7):
        own = sorted((-1 if t is None else t, r or "", x or "") for c, t, r, x in rows if c == conv)
        every = "".join(f"{r}\n{x}\n" for _, r, x in own)
        loss = "".join(x for _, r, x in own if r == "assistant")
        assert got[conv].n_turns == len(own) and got[conv].loss_chars == len(loss)
        assert got[conv].turns_sha256 == hashlib.sha256(every.encode()).hexdigest()
        assert got[conv].loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    text = {r.conv_id: r.formatted for r in chat.format_chats(turns).collect()}[1]
    assert text.count("<s>[assistant]") == 1 and text.count("[+]") == 2
    assert chat.format_chats(turns.limit(0)).count() == 0


# nearest neighbours


def test_neighbours(spark):
    rng = np.random.default_rng(5)
    vectors = rng.standard_normal((1500, 16)).astype(np.float32)
    vectors[100:140] = vectors[7]
    rows = [(i, v.tolist(), 1) for i, v in enumerate(vectors)]
    rows += [(2000, None, 1), (2001, [0.0] * 16, 1), (2002, [float("nan")] * 16, 1), (2003, [None] * 16, 1)]
    rows += [(2004, [float("inf")] + [1.0] * 15, 1), (7, vectors[7].tolist(), 1), (2005, [1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score int")
    got = {}
    for r in neighbours.nearest(frame, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.vec_id, r.score)
    unit = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    hit = 0
    for q in range(0, 1500, 50):
        cosine = unit @ unit[q]
        want = sorted((-round(c, 9), i) for i, c in enumerate(cosine) if i != q)[:5]
        assert list(got[q]) and all(abs(s - cosine[i]) < 1e-12 for i, s in got[q].values())
        hit += len({i for _, i in want} & {i for i, _ in got[q].values()})
    assert hit >= 0.9 * 150
    assert [got[100][r][0] for r in range(1, 6)] == [7, 101, 102, 103, 104]
    assert neighbours.nearest(frame.limit(0), F.lit(True)).count() == 0
    few = neighbours.nearest(frame.where("vec_id < 3"), F.lit(True)).collect()
    assert sorted((r.query_id, r.rank) for r in few) == [(q, k) for q in range(3) for k in (1, 2)]


def test_neighbours_of_repeated_rows(spark):
    rng = np.random.default_rng(6)
    vectors = rng.standard_normal((200, 8))
    vectors[10:50] = vectors[0]
    rows = [(i, v.tolist()) for i, v in enumerate(vectors) for _ in range(20 if i == 10 else 3)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = neighbours.nearest(frame, F.col("vec_id").isin(0, 49)).collect()
    assert [r.vec_id for r in sorted(got, key=lambda r: (r.query_id, r.rank))] == [10, 11, 12, 13, 14, 0, 10, 11, 12, 13]


# toxicity


def test_toxicity(spark):
    rng = random.Random(6)
    rows, labels = [], []
    for i in range(1200):
        text = ". ".join(prose(rng, 8) for _ in range(rng.randint(1, 15))) + "."
        if toxic := i % 5 == 0:
            words = text.split(" ")
            words.insert(rng.randrange(len(words)), rng.choice(("vile", "rotten", "Vile!")))
            text = " ".join(words)
        rows.append((i, text))
        labels.append((i, int(toxic)))
    rows += [(1700, None), (1701, ""), (1702, "123 ?"), (None, "you vile thing")]
    labels += [(1700, 1), (None, 1), (0, None)]
    docs = documents(spark, rows)
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    held = [i for i, _ in labels[:1200] if zlib.crc32(str(i).encode()) % 4 == 2]
    right = sum((got[i].score >= toxicity.THRESHOLD) == (i % 5 == 0) for i in held)
    assert len(held) > 100 and right >= 0.97 * len(held)
    assert got[1700].score == got[1701].score == got[1702].score == 0
    assert "vile" in got[None].worst
    kept = {r.doc_id for r in toxicity.reject(docs, marks).collect()}
    assert None not in kept and {1700, 1701, 1702} <= kept
    assert toxicity.train(docs.limit(0), marks.limit(0)).score("anything.")[0] < toxicity.THRESHOLD


def test_toxicity_without_both_labels(spark):
    rng = random.Random(8)
    rows = [(i, ". ".join(prose(rng, 4) for _ in range(n)) + ".") for i, n in enumerate((1, 20, 300, 3000))]
    docs = documents(spark, rows)
    for labels in ([], [(i, 0) for i in range(4)], [(i, 1) for i in range(4)], [(70, 0), (71, 1)]):
        marks = spark.createDataFrame(labels, "doc_id long, toxic int")
        assert {r.doc_id for r in toxicity.reject(docs, marks).collect()} == {0, 1, 2, 3}


def test_toxicity_learns_from_long_documents(spark):
    rng = random.Random(9)
    rows = [(i, ". ".join(prose(rng, 10) for _ in range(250)) + ". vile." * (i % 2)) for i in range(60)]
    docs = documents(spark, rows)
    marks = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    model = toxicity.train(docs, marks)
    assert model.score("vile.")[0] > 10 * model.score("ba.")[0]


def test_noisy_or_is_whole():
    weights = np.zeros(1 << toxicity.BITS)
    model = toxicity.Model(weights, -1.0)
    p = 1 / (1 + np.exp(1.0))
    assert abs(model.score("a b. c d. e")[0] - (1 - (1 - p) ** 3)) < 1e-12


# HTML


def page(title, body, menu="Home About"):
    return (
        f"<html><head><title>{title}</title><style>p{{}}</style><script>var t='</p>';</script></head><body>"
        f"<nav><ul><li><a href='/'>{menu}</a></ul></nav><div class='ad'>Buy!</div><article><h1>{title}</h1>{body}"
        f"<div class='comments'><p>first!</p></div></article><footer>&copy; us</footer></body></html>"
    )


def test_html(spark):
    body = "<p>One &amp; two\n <b>three<p>four<br>five</p><p class='note'>Read on</p>"
    rows = [(i, f"http://h.example/{i}", page(f"T{i}", f"<p>text {i}</p>" + body)) for i in range(6)]
    rows += [(10, "http://one.example/", page("Solo", body)), (11, None, None), (12, "x", ""), (13, "http://h.example/", "<p>bare")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r.text for r in wrappers.extract(frame).collect()}
    assert got[0].startswith("T0\n\ntext 0") and "Buy" not in got[0] and "first!" not in got[0]
    assert got[10] == "Solo\n\nOne & two three\n\nfour five\n\nRead on"
    assert got[11] == got[12] == "" and got[13] == "bare"
    assert wrappers.extract(frame.limit(0)).count() == 0


def test_html_noise_is_a_whole_token():
    for opening in ("<body class='no-sidebar'>", "<body class='sidebar' role='dialog'>", "<body class='has-sidebar nav'>"):
        assert wrappers.main_text(f"<html class='menu'>{opening}<p>text</p><div class='x sidebar'>no</div></body>") == "text"
    inside = "<main class='widget'><article class='post comments-open related'><div class='content-widget'><p>text</p></div>"
    assert wrappers.main_text(f"{inside}<div class='comments'>no</div></article></main>") == "text"


def test_html_keeps_figures():
    figure = "<figure><img src='x'><table><tr><td>cell</td></tr></table><figcaption>caption</figcaption></figure>"
    assert wrappers.main_text(f"<article><p>text</p>{figure}</article>") == "text\n\ncell\n\ncaption"


def test_html_keeps_repeated_passages(spark):
    shared = "<h2>Summary</h2><p>A passage in all articles.</p>"
    bare = "<div class='top'>Our site</div><div class='post'><h1>T{0}</h1>%s<p>text {0}</p></div>" % shared
    rows = [(i, "http://a.example/", f"<article><h1>T{i}</h1>{shared}<p>text {i}</p></article>") for i in range(4)]
    rows += [(10 + i, "http://b.example/", bare.format(i)) for i in range(4)]
    rows += [(20 + i, "http://c.example/", bare.format(1)) for i in range(9)]  # copies are one page: no template
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in wrappers.extract(frame).collect()}
    for i in range(4):
        want = f"T{i}\n\nSummary\n\nA passage in all articles.\n\ntext {i}"
        assert got[i] == got[10 + i] == want
    assert got[20] == got[28] == f"Our site\n\n{got[11]}"


def test_html_without_article_keeps_title_and_lead():
    post = "<div class=post><h1>Title</h1><div class=lead><p>lead</p></div><div class=text><p>a</p><p>b</p></div></div>"
    links = "<div class=links><a href='/'>Home</a> <a href='/x'>More</a></div>"
    assert wrappers.main_text(f"<body>{links}{post}</body>") == "Title\n\nlead\n\na\n\nb"


def test_wrapper_expression():
    found = wrappers.infer([page("a", "<p>x</p>"), page("b", "<p>y</p><p>z</p><ul><li>q</li></ul>")])
    assert "(<p>#</p>)+" in found["expression"] and "(<ul>" in found["expression"]
    assert found["main"][-1] == "article" and json.loads(json.dumps(found)) == found


def test_deep_html():
    assert wrappers.main_text("<div>" * 3000 + "deep") == "deep"


# licences


def test_licences(spark, corpus):
    said = {
        "apache-2.0": "Licensed under the Apache License, Version 2.0.",
        "mit": "Released under the MIT License.",
        "gpl-3.0": "This work is licensed under the GNU General Public License, version 3.",
        "cc-by-nc": "Licensed under CC BY-NC 4.0.",
    }
    rows = [*corpus, *[(100 + i, f"some text of mine\n{line}\nmore") for i, line in enumerate(said.values())]]
    rows += [(110, "\n".join(said.values())), (111, "A license is required to sell food on the market.")]
    got = {r.doc_id: r for r in licences.scan(documents(spark, rows)).collect()}
    assert [got[100 + i].families for i in range(4)] == list(said)
    assert got[110].families == ",".join(sorted(said)) and got[110].n_licences == 4
    assert all(got[i].families == "" for i, _ in [*corpus, (111, "")])
    assert got[0].n_paragraphs == 1 and licences.scan(documents(spark, rows).limit(0)).count() == 0


def test_licences_within_lines(spark, corpus):
    mit = next(t for t in licences.TEMPLATES["mit"] if t.endswith("conditions:"))
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public "
    gpl += "License as published by the Free Software Foundation; either version %s of the License, or (at your option) any "
    said = [
        ("mit", f"{mit} The above copyright notice and this permission notice shall be included in all copies."),
        ("mit", "All photographs were taken by the members of the club in the spring; the text is released under the MIT License."),
        ("mit", "MIT License"),
        ("apache-2.0,mit", "Licensed under the Apache License, Version 2.0. The rest is released under the MIT License."),
        ("gpl-2.0", gpl % 2 + "later version."),
        ("gpl-3.0", gpl % 3 + "later version."),
        ("", "A license is required to sell food on the market, and permission of the owner to park a car."),
    ]
    rows = [*corpus, *[(200 + i, line) for i, (_, line) in enumerate(said)]]
    got = {r.doc_id: r.families for r in licences.scan(documents(spark, rows)).collect()}
    assert [got[200 + i] for i in range(len(said))] == [families for families, _ in said]
    assert all(got[i] == "" for i, _ in corpus)


def test_licence_model_learns_from_every_line(spark):
    """More lines than any sample would hold: all are counted, and the threshold is that of all of them."""
    texts = [(i, "\n".join(f"line {i} {k} of the work" for k in range(500))) for i in range(20)]
    lines = licences.paragraphs(documents(spark, texts))
    features = licences.Features(licences._grams(licences._template_rows(spark)))
    assert licences.unknown_lines(lines, features).agg(F.sum("n")).first()[0] == 10_000
    like = [(30, "Released under the MIT License.")]
    assert licences.unknown_lines(licences.paragraphs(documents(spark, like)), features).count() == 0


def test_licence_threshold_counts_rare_lines(spark):
    """Of 10,000 lines 21 reach 0.7: one more than may; of 20 none decides."""
    for few, want in ((21, 0.7001), (20, 0.5)):
        rows = [(0.1, 10_000 - few), (0.70005, few)]
        assert licences._threshold(spark.createDataFrame(rows, "probability double, n long")) == want


def test_suffix_rows_follow_the_text_not_the_tasks(spark, corpus):
    """A batch sends one row of a kind to a bucket, and buckets are counted by the text alone."""
    rows = [(i, f"{text} {text}") for i, text in corpus]
    texts = documents(spark, rows).selectExpr("coalesce(doc_id, -1) AS did", "xxhash64(text) AS text_key", "text")
    buckets = suffixes.bucket_count(texts)
    size = sum(len(t.encode()) for _, t in rows)
    assert buckets == -(-size // suffixes.BUCKET_BYTES) == suffixes.bucket_count(texts.repartition(40))
    positions = suffixes.chosen_positions(texts.repartition(40), buckets)
    assert 0 < positions.count() <= 40 * 2 * buckets
    assert suffixes.shared_stretches(positions, buckets).count() <= (40 + 2 * buckets) * buckets
    assert suffixes.bucket_count(texts.limit(0)) == 1
