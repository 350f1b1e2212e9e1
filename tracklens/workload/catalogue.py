"""Catalogue queries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions import text
from tracklens.operators import catalogue as C
from tracklens.operators import textindex
from tracklens.plans import shelf_report
from tracklens.session import shared_folder
from tracklens.sources.catalogue import load_books, rejected_books, save_books
from tracklens.workload.registry import query

BOOKS = ("books",)
COLS = "id, title, author, format, retailer, CAST(price AS DOUBLE) AS price, rating, status, note, added"
NEWEST = {"query": "bolt", "status": "want", "format": "physical", "max_price": 40, "min_rating": 1}
NEWEST_SQL = """contains(lower(title || ' ' || author || ' ' || coalesce(note, '')), 'bolt') AND status = 'want'
  AND kind = 'physical' AND coalesce(price, 0) <= 40 AND coalesce(rating, 0) >= 1"""


def plain(df):
    return df.withColumn("price", F.col("price").cast("double"))


@query("shelf", f"SELECT {COLS} FROM book_kinds WHERE {NEWEST_SQL}", ("book_kinds",))
def _(t):
    return plain(C.shelf(t.books, sort="rating", **NEWEST))


@query("book_search", f"SELECT {COLS} FROM books WHERE contains(lower(title || ' ' || author || ' ' || coalesce(note, '')), 'ring brand#1')", BOOKS)
def _(t):
    return plain(C.search(t.books, "  Ring Brand#1 "))


@query("document_search", "SELECT doc_id, lang, source FROM documents WHERE contains(lower(text), 'the th')")
def _(t):
    docs = t.documents.select("doc_id", "lang", "source", F.col("text").alias("title"), F.lit("").alias("author"), F.lit("").alias("note"))
    return C.search(docs, "THE th").select("doc_id", "lang", "source")


@query(
    "document_search_indexed",
    " UNION ALL ".join(
        f"SELECT {k} AS query, doc_id, lang, source FROM documents WHERE contains(lower(text), '{q}')"
        for k, q in enumerate(["the th", "qu", "ization of", "zzqqzz"])
    ),
)
def _(t):
    """Through a trigram index; the second query has two characters and scans."""
    docs = t.documents.select("doc_id", "lang", "source", F.col("text").alias("title"), F.lit("").alias("author"), F.lit("").alias("note"))
    root = shared_folder(t.spark, "text-index")
    textindex.build(docs, root)
    found = [
        textindex.search(t.spark, root, q).select(F.lit(k).alias("query"), "doc_id", "lang", "source")
        for k, q in enumerate(["THE th", "qu", " ization OF", "zzqqzz"])
    ]
    return reduce(DataFrame.unionByName, found)


@query("book_status", f"SELECT {COLS} FROM books WHERE status = 'reading'", BOOKS)
def _(t):
    return plain(C.by_status(t.books, "reading"))


@query("book_kind", f"SELECT {COLS} FROM book_kinds WHERE kind = 'physical'", ("book_kinds",))
def _(t):
    return plain(C.by_format(t.books, "physical"))


@query("book_format", f"SELECT {COLS} FROM books WHERE format = 'paperback'", BOOKS)
def _(t):
    return plain(C.by_format(t.books, "paperback"))


@query("book_retailer", f"SELECT {COLS} FROM books WHERE retailer = 'Library'", BOOKS)
def _(t):
    return plain(C.by_retailer(t.books, "Library"))


@query("book_max_price", f"SELECT {COLS} FROM books WHERE coalesce(price, 0) <= 59", BOOKS)
def _(t):
    return plain(C.max_price(t.books, 59))


@query("book_min_rating", f"SELECT {COLS} FROM books WHERE coalesce(rating, 0) >= 2.5", BOOKS)
def _(t):
    return plain(C.min_rating(t.books, 2.5))


_ORDER_SQL = {
    "added": "added DESC",
    "title": "title COLLATE en",
    "author": "author COLLATE en",
    "price": "coalesce(price, 0)",
    "rating": "coalesce(rating, 0) DESC",
}


def _ordering(key):
    order = f"{_ORDER_SQL[key]}, added, id"

    @query(
        f"shelf_by_{key}",
        f"SELECT {COLS}, row_number() OVER (ORDER BY {order}) AS rank FROM books",
        BOOKS,
    )
    def _(t):
        return plain(C.ranked_shelf(t.books, key))


for _key in _ORDER_SQL:
    _ordering(_key)


@query(
    "book_display",
    """SELECT id, CASE WHEN price IS NULL THEN '—' ELSE '$' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) END
      AS price_text, CASE WHEN coalesce(rating, 0) = 0 THEN '—' ELSE CAST(CAST(rating AS DECIMAL(18,1)) AS VARCHAR)
      || ' / 5' END AS rating_text FROM books""",
    BOOKS,
)
def _(t):
    return C.display(t.books).select("id", "price_text", "rating_text")


_ENCODED = "url_encode(title || ' ' || author)"
for _coded, _plain in [("%21", "!"), ("%27", "''"), ("%28", "("), ("%29", ")"), ("%2A", "*")]:
    _ENCODED = f"replace({_ENCODED}, '{_coded}', '{_plain}')"
_LINKS = ", ".join(f"'{prefix}' || {_ENCODED} AS {site}" for site, prefix in dims.LINK_TEMPLATES.items())


@query("book_links", f"SELECT id, {_LINKS} FROM books", BOOKS)
def _(t):
    return C.links(t.books).select("id", *dims.LINK_TEMPLATES)


_TIDY_TITLE = "CASE WHEN status = 'lost' THEN '' ELSE title END"


@query(
    "book_clean",
    """SELECT id, title, author, format, retailer, CASE WHEN format <> 'unknown' THEN CAST(price AS DOUBLE) END AS price,
    rating, status, note, added FROM books WHERE status <> 'lost'""",
    BOOKS,
)
def _(t):
    return plain(C.clean(t.books_raw)[0])


@query("book_rejects", "SELECT id, '   ' AS title, ' ' || author AS author, status FROM books WHERE status = 'lost'", BOOKS)
def _(t):
    return C.clean(t.books_raw)[1].select("id", "title", "author", "status")


@query(
    "book_defaults",
    """SELECT 'b' || (event_id * 1000 + epoch_us(ts) // 1000) AS id, CAST(user_id AS VARCHAR) AS title, '' AS author,
    CASE WHEN event_type = 'click' THEN 'kobo' ELSE 'paperback' END AS format, 'Amazon' AS retailer,
    CASE WHEN event_type = 'view' THEN 'read' ELSE 'want' END AS status, '' AS note,
    CAST(NULL AS DOUBLE) AS price, CAST(NULL AS DOUBLE) AS rating,
    event_id * 1000 + epoch_us(ts) // 1000 AS added FROM events""",
)
def _(t):
    kind = F.col("event_type")
    empty = F.lit(None).cast("string")
    drafts = t.events.select(
        empty.alias("id"),
        F.col("user_id").cast("string").alias("title"),
        empty.alias("author"),
        F.when(kind == "click", "kobo").alias("format"),
        empty.alias("retailer"),
        F.lit(None).cast("double").alias("price"),
        F.lit(None).cast("double").alias("rating"),
        F.when(kind == "view", "read").alias("status"),
        empty.alias("note"),
        F.lit(None).cast("long").alias("added"),
        (F.col("event_id") * 1000 + F.unix_millis(F.col("ts").cast("timestamp"))).alias("created_ms"),
    )
    return C.with_defaults(drafts)


@query(
    "book_cycle",
    """SELECT id, CASE WHEN id NOT IN (SELECT CAST(l_partkey AS VARCHAR) FROM lineitem WHERE l_returnflag = 'A'
      AND l_quantity >= 40) THEN status WHEN status = 'want' THEN 'reading' WHEN status = 'reading' THEN 'read'
      ELSE 'want' END AS status FROM books""",
    BOOKS,
)
def _(t):
    picked = t.lineitem.filter((F.col("l_returnflag") == "A") & (F.col("l_quantity") >= 40))
    ids = picked.select(F.col("l_partkey").cast("string").alias("id"))
    return C.cycle_status(t.books.select("id", "status"), ids)


@query("book_format_dim", "SELECT id, format, format_label, kind FROM book_kinds", ("book_kinds",))
def _(t):
    return C.with_format(t.books.select("id", "format"), F.broadcast(dims.format_dim(t.spark)))


@query(
    "book_status_label",
    """SELECT id, status, CASE status WHEN 'want' THEN 'Want' WHEN 'reading' THEN 'Reading' WHEN 'read' THEN 'Read' END
    AS status_label FROM books""",
    BOOKS,
)
def _(t):
    return C.with_status(t.books.select("id", "status"), F.broadcast(dims.status_dim(t.spark)))


@query(
    "book_upsert",
    f"""WITH latest AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
      FROM changes WHERE op = 'upsert') WHERE rn = 1)
    SELECT {COLS} FROM latest UNION ALL SELECT {COLS} FROM books WHERE id NOT IN (SELECT id FROM latest)""",
    ("books", "changes"),
)
def _(t):
    return plain(C.upsert(t.books, t.changes.filter(F.col("op") == "upsert")))


@query(
    "book_changes",
    f"""SELECT {COLS} FROM last_changes WHERE op = 'upsert' UNION ALL
    SELECT {COLS} FROM books WHERE id NOT IN (SELECT id FROM last_changes)""",
    ("books", "last_changes"),
)
def _(t):
    return plain(C.apply_changes(t.books, t.changes))


@query(
    "book_remove",
    f"SELECT {COLS} FROM books WHERE id NOT IN (SELECT id FROM changes WHERE op = 'remove')",
    ("books", "changes"),
)
def _(t):
    return plain(C.remove(t.books, t.changes.filter(F.col("op") == "remove")))


@query(
    "book_tally",
    """SELECT count(*) AS titles, CAST(coalesce(sum(CASE WHEN status = 'want' THEN price END), 0) AS DOUBLE) AS want_total,
    count(*) FILTER (kind = 'physical') AS physical FROM book_kinds""",
    ("book_kinds",),
)
def _(t):
    return C.tally(t.books).withColumn("want_total", F.col("want_total").cast("double"))


@query(
    "shown_of",
    f"""SELECT count(*) FILTER ({NEWEST_SQL}) AS shown, count(*) AS total,
    count(*) FILTER ({NEWEST_SQL}) = 0 AS nothing_shown FROM book_kinds""",
    ("book_kinds",),
)
def _(t):
    return C.shown_of(t.books, C.filters(**NEWEST))


@query("catalogue_load", "SELECT id, title, author, format, retailer, CAST(price AS DOUBLE) AS price, rating, status, note, added FROM books", BOOKS)
def _(t):
    raw = t.books.withColumns({"price": F.col("price").cast("string"), "rating": F.col("rating").cast("string")})
    path = save_books(raw, shared_folder(t.spark, "catalogue"))
    stored = load_books(t.spark, path)
    return stored.withColumns({"price": F.col("price").cast("double"), "rating": F.col("rating").cast("double")})


@query(
    "catalogue_rejects",
    """SELECT '{"id": "' || id || '", "status": ' AS value, 'not an object' AS reason FROM books WHERE status = 'read'""",
    BOOKS,
)
def _(t):
    whole = F.to_json(F.struct("id", "status"))
    cut = F.concat(F.lit('{"id": "'), "id", F.lit('", "status": '))
    path = shared_folder(t.spark, "catalogue")
    t.books.select(F.when(F.col("status") == "read", cut).otherwise(whole).alias("value")).write.text(path)
    return rejected_books(t.spark, path)


@query("catalogue_save", f"SELECT {COLS} FROM books", BOOKS)
def _(t):
    path = save_books(t.books, shared_folder(t.spark, "catalogue"), fmt="parquet")
    return plain(t.spark.read.parquet(path))


@query(
    "shelf_report",
    f"""SELECT id, title, author, format_label, kind, status_label, price_text, rating_text,
      {", ".join(dims.LINK_TEMPLATES)} FROM (
      SELECT *, CASE status WHEN 'want' THEN 'Want' WHEN 'reading' THEN 'Reading' WHEN 'read' THEN 'Read' END AS status_label,
      CASE WHEN price IS NULL THEN '—' ELSE '$' || CAST(CAST(price AS DECIMAL(18,2)) AS VARCHAR) END AS price_text,
      CASE WHEN coalesce(rating, 0) = 0 THEN '—' ELSE CAST(CAST(rating AS DECIMAL(18,1)) AS VARCHAR) || ' / 5' END
      AS rating_text, {_LINKS} FROM book_kinds WHERE {NEWEST_SQL})""",
    ("book_kinds",),
)
def _(t):
    return shelf_report.cards(t.books, sort="price", **NEWEST)


@query(
    "shelf_report_totals",
    f"""SELECT count(*) AS titles, CAST(coalesce(sum(CASE WHEN status = 'want' THEN price END), 0) AS DOUBLE) AS want_total,
    count(*) FILTER (kind = 'physical') AS physical, count(*) FILTER ({NEWEST_SQL}) AS shown,
    count(*) FILTER ({NEWEST_SQL}) = 0 AS nothing_shown FROM book_kinds""",
    ("book_kinds",),
)
def _(t):
    return shelf_report.totals(t.books, **NEWEST).withColumn("want_total", F.col("want_total").cast("double"))
