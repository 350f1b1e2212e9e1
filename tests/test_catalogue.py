import os
from urllib.parse import unquote, urlparse

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_telemetry import same

from tracklens import dims
from tracklens.operators import catalogue as C
from tracklens.operators import textindex
from tracklens.plans import shelf_report
from tracklens.session import shared_folder
from tracklens.sources.catalogue import load_books, rejected_books, save_books

TYPED = "id STRING, title STRING, author STRING, format STRING, retailer STRING, price DECIMAL(10,2), rating DOUBLE, status STRING, note STRING, added BIGINT"


def ids(df):
    return [r.id for r in df.collect()]


@pytest.fixture(scope="module")
def seed(spark):
    return C.clean(dims.seed_books(spark))[0]


def book(**over):
    base = dict(id="x", title="T", author="A", format="kindle", retailer="Kobo", price=None, rating=None, status="want", note=None, added=1)
    return tuple((base | over).values())


def books(spark, *rows):
    import decimal

    fixed = [tuple(decimal.Decimal(str(v)) if i == 5 and v is not None else v for i, v in enumerate(r)) for r in rows]
    return spark.createDataFrame(fixed, TYPED)


def test_seed_order_tally_search_and_kind(seed):
    assert ids(C.shelf(seed)) == ["b5", "b4", "b3", "b2", "b1"]
    (t,) = C.tally(seed).collect()
    assert (t.titles, t.physical, float(t.want_total)) == (5, 4, 69.0)
    assert sorted(ids(C.search(seed, "dostoevsky"))) == ["b1", "b2"]
    assert ids(C.by_format(seed, "digital")) == ["b4"]


def test_orderings_on_the_seed(seed):
    assert ids(C.shelf(seed, sort="title")) == ["b5", "b2", "b3", "b1", "b4"]
    assert ids(C.shelf(seed, sort="author")) == ["b4", "b1", "b2", "b3", "b5"]
    assert ids(C.shelf(seed, sort="price")) == ["b4", "b2", "b3", "b5", "b1"]
    assert ids(C.shelf(seed, sort="rating")) == ["b1", "b2", "b3", "b4", "b5"]
    with pytest.raises(ValueError):
        C.shelf(seed, sort="colour")


def test_text_order_is_case_and_accent_aware(spark):
    rows = books(spark, *[book(id=t, title=t, added=i) for i, t in enumerate(["Z", "É", "b", "A", "e", "a"])])
    assert ids(C.order_shelf(rows, "title")) == ["a", "A", "b", "e", "É", "Z"]


def test_missing_values_and_sentinels(spark):
    rows = books(
        spark,
        book(id="none"),
        book(id="zero", price=0, rating=0.0),
        book(id="sixty", price=60, rating=3.0),
        book(id="more", price=75, rating=5.0),
    )
    assert sorted(ids(C.max_price(rows, 60))) == ["more", "none", "sixty", "zero"]
    assert sorted(ids(C.max_price(rows, 59))) == ["none", "zero"]
    assert sorted(ids(C.max_price(rows, 0))) == ["none", "zero"]
    assert sorted(ids(C.min_rating(rows, 0))) == ["more", "none", "sixty", "zero"]
    assert sorted(ids(C.min_rating(rows, 3))) == ["more", "sixty"]
    shown = {r.id: (r.price_text, r.rating_text) for r in C.display(rows).collect()}
    assert shown["none"] == ("—", "—") and shown["zero"] == ("$0.00", "—")
    assert shown["more"] == ("$75.00", "5.0 / 5")


def test_unknown_format_is_physical_but_not_the_default_id(spark):
    rows = books(spark, book(id="odd", format="scroll"), book(id="null", format=None), book(id="pb", format="paperback"))
    assert sorted(ids(C.by_format(rows, "physical"))) == ["null", "odd", "pb"]
    assert ids(C.by_format(rows, "paperback")) == ["pb"]
    labels = {r.id: (r.format_label, r.kind) for r in C.with_format(rows, dims.format_dim(spark)).collect()}
    assert labels["odd"] == ("Paperback", "physical")


def test_search_is_literal_trimmed_and_spans_fields(spark):
    rows = books(spark, book(id="a", title="100% Wool", author="Ann"), book(id="b", title="100 Wool", author="Ann"))
    assert ids(C.search(rows, " 100% WOOL ann ")) == ["a"]
    assert sorted(ids(C.search(rows, "   "))) == ["a", "b"]


def test_status_cycle(spark):
    rows = books(spark, *[book(id=s, status=s) for s in ("want", "reading", "read", "lost")], book(id="other", status="read"))
    picked = spark.createDataFrame([("want",), ("reading",), ("read",), ("lost",), ("want",)], "id STRING")
    after = {r.id: r.status for r in C.cycle_status(rows, picked).collect()}
    assert after == {"want": "reading", "reading": "read", "read": "want", "lost": "want", "other": "read"}


def test_links_keep_the_unreserved_marks(spark):
    rows = books(spark, book(title="What's (new)? a+b*!~", author="Ö"))
    (r,) = C.links(rows).collect()
    assert r.amazon == "https://www.amazon.com/s?k=What's%20(new)%3F%20a%2Bb*!~%20%C3%96"


def test_clean_rejects_blank_titles_only(spark):
    raw = spark.createDataFrame(
        [
            ("1", "  Dune ", " Frank ", "kindle", "Kobo", "", "", "want", "", 1),
            ("2", "   ", "x", "kindle", "Kobo", "3", "4", "want", "", 2),
            ("3", "Emma", "Jane", "kindle", "Kobo", "-5", "9.5", "want", "", 3),
            ("4", None, "Jane", "kindle", "Kobo", "1", "1", "want", "", 4),
        ],
        dims.RAW_BOOK_SCHEMA,
    )
    good, rejected = C.clean(raw)
    found = {r.id: (r.title, r.author, r.price, r.rating) for r in good.collect()}
    assert found["1"] == ("Dune", "Frank", None, None)
    assert float(found["3"][2]) == -5.0 and found["3"][3] == 9.5
    assert sorted(ids(rejected)) == ["2", "4"]


def test_upsert_twice_is_once_and_remove_undoes(spark, seed):
    change = books(spark, book(id="b2", title="New"), book(id="b9", title="Nine")).withColumn("seq", F.lit(1))
    once = C.upsert(seed, change)
    assert sorted(map(tuple, C.upsert(once, change).collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    assert sorted(ids(once)) == ["b1", "b2", "b3", "b4", "b5", "b9"]
    assert {r.id: r.title for r in once.collect()}["b2"] == "New"
    assert "b9" not in ids(C.remove(once, change))


def test_changes_apply_the_last_per_id(spark, seed):
    feed = spark.createDataFrame(
        [
            (1, "remove", *book(id="b1")),
            (2, "upsert", *book(id="b1", title="Back")),
            (1, "upsert", *book(id="b2", title="Gone")),
            (2, "remove", *book(id="b2")),
            (1, "remove", *book(id="missing")),
        ],
        "seq INT, op STRING, " + TYPED,
    )
    after = {r.id: r.title for r in C.apply_changes(seed, feed).collect()}
    assert after["b1"] == "Back" and "b2" not in after and "missing" not in after and len(after) == 4


def test_load_falls_back_to_the_seed(spark, seed, tmp_path):
    stored = shared_folder(spark, "books")
    save_books(seed.withColumns({c: F.col(c).cast("string") for c in ("price", "rating")}), stored)
    assert sorted(ids(load_books(spark, stored))) == ["b1", "b2", "b3", "b4", "b5"]
    assert len(ids(load_books(spark, str(tmp_path / "missing")))) == 5
    assert ids(load_books(spark, str(tmp_path / "missing"), fallback=False)) == []
    for name, text in {"bad": "{oops", "object": '{"id": "z"}', "empty": "[]"}.items():
        (tmp_path / name).write_text(text)
        assert len(ids(load_books(spark, str(tmp_path / name), array_document=True))) == 5, name
    (tmp_path / "array").write_text('[{"id": "q", "title": "Q", "price": 3}, {"id": "r"}]')
    rows = load_books(spark, str(tmp_path / "array"), array_document=True).collect()
    assert [(r.id, r.price) for r in rows] == [("q", "3"), ("r", None)]


def test_the_stored_form_is_found_and_unreadable_rows_are_returned(spark, tmp_path):
    (tmp_path / "array").write_text('\n[{"id": "q"},\n {"id": "r"}]')
    assert ids(load_books(spark, str(tmp_path / "array"))) == ["q", "r"]
    assert rejected_books(spark, str(tmp_path / "array")).count() == 0
    (tmp_path / "lines").write_text('{"id": "q"}\n\n{oops\n')
    assert ids(load_books(spark, str(tmp_path / "lines"))) == ["q"]
    assert [tuple(r) for r in rejected_books(spark, str(tmp_path / "lines")).collect()] == [("{oops", "not an object")]
    (tmp_path / "cut").write_text('[{"id": "q"')
    assert [r.reason for r in rejected_books(spark, str(tmp_path / "cut")).collect()] == ["not an array"]
    assert rejected_books(spark, str(tmp_path / "missing")).count() == 0


def test_save_never_overwrites(spark, seed):
    path = save_books(seed, shared_folder(spark, "books"))
    with pytest.raises(Exception, match="(?i)exist"):
        save_books(seed, path)


def test_report_cards_and_totals(seed):
    cards = shelf_report.cards(seed, sort="price", format="physical", max_price=20).collect()
    assert [c.id for c in cards] == ["b2", "b3", "b5"]
    assert cards[0].price_text == "$12.00" and cards[0].status_label == "Want"
    (t,) = shelf_report.totals(seed, format="physical", max_price=20).collect()
    assert (t.shown, t.titles, t.nothing_shown, t.physical) == (3, 5, False, 4)


def test_ranks_cover_every_row_without_one_window(spark, tables):
    found = C.ranked_shelf(tables.books, "price")
    assert sorted(r["rank"] for r in found.collect()) == list(range(1, tables.books.count() + 1))


def test_blank_titles_of_any_white_space_are_rejected(spark):
    from tracklens import dims

    rows = dims.seed_books(spark).limit(1)
    kept, rejected = C.clean(rows.withColumn("title", F.lit("\t ")))
    assert kept.count() == 0 and rejected.count() == 1


def test_numbers_as_differences():
    rng = np.random.default_rng(1)
    for numbers in ([0], [5, 6, 1000, 8191], [0, 127, 128, 16_511, 2**40], np.unique(rng.integers(0, 8192, 500))):
        assert textindex.numbers_of(textindex.varints(np.array(numbers))).tolist() == list(numbers)
    assert textindex.numbers_of(b"").tolist() == []


def test_index_equals_the_scan(spark, tables, tmp_path):
    """Every kind of query, and fewer bytes than the whole index for one of three characters or more."""
    docs = tables.documents.select("doc_id", F.col("text").alias("title"), F.lit(None).cast("string").alias("author"), F.lit("").alias("note"))
    odd = spark.createDataFrame([(-1, None, "É'% _", None), (-2, "", "", ""), (-3, "ab", "c", "d")], "doc_id long, title string, author string, note string")
    docs = docs.unionByName(odd).repartition(3)
    root = str(tmp_path / "index")
    textindex.build(docs, root)
    word = docs.select(F.get(F.split("title", " "), 3).alias("w")).filter("w IS NOT NULL").first().w
    for query in ("", "a", "qu", "the", f" {word.upper()} ", "the th", "é'% _", "b c d", "zzqqzz", "b  c"):
        same(textindex.search(spark, root, query).select("doc_id"), C.search(docs, query).select("doc_id"))

    def size(df):
        files = df.select(F.input_file_name().alias("f")).distinct().collect()
        return sum(os.path.getsize(unquote(urlparse(r.f).path)) for r in files)

    whole = size(spark.read.parquet(f"{root}/postings"))
    read = size(textindex._postings(spark, root, ["the", "he "]))
    assert 0 < read < whole / 10
