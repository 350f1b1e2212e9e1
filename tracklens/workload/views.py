"""The test tables reshaped into the library's inputs: once for Spark, once as SQL text.

Every view is a projection (or one aggregate) over whole tables; nothing is subset.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tracklens import dims
from tracklens.session import ship_package

TZ = "America/Los_Angeles"


#: What one micro-batch reads at most, in whole files and at least one.
BATCH_BYTES = 1 << 30


class Tables:
    """Lazily opened test tables and the views over them."""

    def __init__(self, spark: SparkSession, folder: str, streaming: bool = False):
        self.spark = spark
        self.folder = folder.rstrip("/")
        self.streaming = streaming
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        ship_package(spark)

    @cached_property
    def live(self) -> Tables:
        """The same tables read as streams."""
        return Tables(self.spark, self.folder, streaming=True)

    def table(self, name: str) -> DataFrame:
        path = f"{self.folder}/{name}.parquet"
        if not self.streaming:
            return self.spark.read.parquet(path)
        schema = self.spark.read.parquet(path).schema
        files = self.spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet")
        return files.option("maxBytesPerTrigger", BATCH_BYTES).parquet(self.folder)

    @cached_property
    def part(self) -> DataFrame:
        return self.table("part")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")

    @cached_property
    def pages(self) -> DataFrame:
        return self.table("pages")

    @cached_property
    def documents(self) -> DataFrame:
        return self.table("documents")

    # ---- catalogue ----

    @cached_property
    def books(self) -> DataFrame:
        key = F.col("p_partkey")
        kind = F.col("p_type")
        fmt = (
            F.when(kind == "ECONOMY", "paperback")
            .when(kind == "SMALL", "kindle")
            .when(kind == "MEDIUM", "kobo")
            .when(kind == "LARGE", "hardcover")
            .when(kind == "STANDARD", "audiobook")
            .otherwise("unknown")
        )
        shop = F.element_at(F.array(*[F.lit(r) for r in dims.RETAILERS]), (key % 7 + 1).cast("int"))
        status = (
            F.when(key % 17 == 0, "lost").when(key % 3 == 0, "want").when(key % 3 == 1, "reading").otherwise("read")
        )
        return self.part.select(
            key.cast("string").alias("id"),
            F.col("p_name").alias("title"),
            F.col("p_brand").alias("author"),
            fmt.alias("format"),
            shop.alias("retailer"),
            F.when(key % 11 != 0, key % 75).cast("decimal(10,2)").alias("price"),
            F.when(key % 13 != 0, F.col("p_size") / 10.0).alias("rating"),
            status.alias("status"),
            F.when(key % 2 != 0, kind).alias("note"),
            key.alias("added"),
        )

    @cached_property
    def books_raw(self) -> DataFrame:
        """Unclean records: padded and blank titles, blank and unreadable numbers."""
        return self.books.select(
            "id",
            F.when(F.col("status") == "lost", "   ").otherwise(F.concat(F.lit("  "), "title", F.lit(" "))).alias("title"),
            F.concat(F.lit(" "), "author").alias("author"),
            "format",
            "retailer",
            F.when(F.col("format") == "unknown", "n/a")
            .otherwise(F.coalesce(F.col("price").cast("string"), F.lit("")))
            .alias("price"),
            F.coalesce(F.col("rating").cast("string"), F.lit("")).alias("rating"),
            "status",
            "note",
            "added",
        )

    @cached_property
    def changes(self) -> DataFrame:
        """Every line item as one change to a book: open lines point at new ids, returned ones remove."""
        key = F.col("l_partkey") + F.when(F.col("l_linestatus") == "O", F.lit(1_000_000)).otherwise(F.lit(0))
        return self.lineitem.select(
            F.struct("l_shipdate", "l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity", "l_suppkey").alias(
                "seq"
            ),
            F.when(F.col("l_returnflag") == "R", "remove").otherwise("upsert").alias("op"),
            key.cast("string").alias("id"),
            F.concat(F.lit("order "), F.col("l_orderkey").cast("string")).alias("title"),
            F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("author"),
            F.when(F.col("l_returnflag") == "A", "kobo").otherwise("hardcover").alias("format"),
            F.lit(dims.RETAILERS[0]).alias("retailer"),
            F.col("l_quantity").cast("decimal(10,2)").alias("price"),
            (F.col("l_linenumber") / 2.0).alias("rating"),
            F.lit("reading").alias("status"),
            F.lit("").alias("note"),
            F.col("l_orderkey").alias("added"),
        )

    # ---- plan ----

    @cached_property
    def entries(self) -> DataFrame:
        """One listed entry per line item: the order is its track."""
        role = (
            F.when(F.col("l_returnflag") == "N", "w").when(F.col("l_returnflag") == "A", "f").otherwise("r")
        )
        return self.lineitem.select(
            F.col("l_orderkey").alias("track"),
            role.alias("role"),
            F.concat_ws(" ", F.lit("part"), F.col("l_partkey").cast("string"), "l_linestatus").alias("title"),
        )

    @cached_property
    def nested(self) -> DataFrame:
        """Line items as nested records: an order line with its part and its supplier as entries."""
        supplier_role = F.when(F.col("l_linestatus") == "O", "f").otherwise("r")
        part_role = (
            F.when(F.col("l_returnflag") == "N", "w").when(F.col("l_returnflag") == "A", "f").otherwise("r")
        )
        return self.lineitem.select(
            F.col("l_orderkey").alias("track"),
            F.array(
                F.struct(
                    part_role.alias("role"),
                    F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("title"),
                ),
                F.struct(
                    supplier_role.alias("role"),
                    F.concat(F.lit("supplier "), F.col("l_suppkey").cast("string")).alias("title"),
                ),
            ).alias("entries"),
        )

    @cached_property
    def declared(self) -> DataFrame:
        """Declared entries per track, from the leading digit of the order priority."""
        return self.orders.select(
            F.col("o_orderkey").alias("track"), F.substring("o_orderpriority", 1, 1).cast("int").alias("declared")
        )

    # ---- calendar ----

    @cached_property
    def rules(self) -> DataFrame:
        """Every order as one weekly rule, four weeks long; the priority picks the lane."""
        lane = F.substring("o_orderpriority", 1, 1)

        def pick(*values):
            out = F.when(lane == "1", values[0])
            for digit, v in zip("234", values[1:4], strict=True):
                out = out.when(lane == digit, v)
            return out.otherwise(values[4])

        days = lambda *d: F.array(*[F.lit(x) for x in d])
        hours = pick(*[F.expr(f"INTERVAL '{t}' HOUR TO MINUTE") for t in ("19:30", "19:30", "10:30", "21:30", "17:00")])
        minutes = pick(*[F.lit(m) for m in (60, 60, 150, 30, 30)])
        start = F.col("o_orderdate") + hours
        return self.orders.select(
            F.col("o_orderkey").alias("uid"),
            F.col("o_custkey").alias("owner"),
            pick(*[F.lit(x) for x in ("Deep", "Algorithms", "Build", "Light", "Review")]).alias("lane"),
            F.lit(TZ).alias("tz"),
            start.alias("start_local"),
            (start + F.make_dt_interval(mins=minutes)).alias("end_local"),
            pick(
                days("MO", "TU", "WE"),
                days("TH"),
                days("SA"),
                days("SU", "MO", "TU", "WE", "TH", "FR"),
                days("SU"),
            ).alias("byday"),
            (F.col("o_orderdate") + F.expr("INTERVAL '28 07:59:59' DAY TO SECOND")).alias("until_utc"),
        )

    @cached_property
    def blocks(self) -> DataFrame:
        """84-day blocks with a 7-day recess between, from 1995-01-01 to the last order date."""
        first = F.lit("1995-01-01").cast("date")
        last = self.orders.agg(F.max(F.col("o_orderdate").cast("date")).alias("last"))
        number = F.explode(F.sequence(F.lit(0), F.floor(F.datediff("last", first) / 91).cast("int")))
        start = F.date_add(first, F.col("block") * 91)
        return last.select(number.alias("block")).select(
            "block", start.alias("block_start"), F.date_add(start, 83).alias("block_end")
        )

    @cached_property
    def ticks(self) -> DataFrame:
        """Every event as a clock tick: day and minutes after the session base."""
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        return self.events.select(
            "event_id",
            F.col("ts").cast("date").alias("day"),
            (micros % 86_400_000_000 / 60_000_000.0 - dims.SESSION_BASE_MINUTES).alias("m"),
            "event_type",
        )

    @cached_property
    def sessions(self) -> DataFrame:
        """Sessions: first to last purchase within each four-hour stretch of a day."""
        buys = self.ticks.withColumn("stretch", F.floor((F.col("m") + dims.SESSION_BASE_MINUTES) / 240).cast("long"))
        return (
            buys.filter(F.col("event_type") == "purchase")
            .groupBy("day", "stretch")
            .agg(F.min("m").alias("start_min"), F.max("m").alias("end_min"))
        )

    # ---- interactions, registers, telemetry ----

    @property
    def _k(self):
        return F.get_json_object("props", "$.k").cast("int")

    @cached_property
    def answers(self) -> DataFrame:
        return self.events.select(
            F.col("user_id").alias("learner"),
            (self._k % 10).alias("item"),
            (F.col("event_id") % 4).cast("int").alias("pick"),
            "ts",
            "event_id",
        )

    @cached_property
    def answer_key(self) -> DataFrame:
        """The right pick per item, for every item that occurs."""
        return self.answers.select("item").distinct().withColumn("ans", F.col("item") % 4)

    @cached_property
    def checklist_events(self) -> DataFrame:
        return self.events.select(
            F.col("user_id").alias("learner"),
            (self._k % 3).alias("list"),
            (self._k % 10).alias("box"),
            F.when(F.col("event_type") == "error", "reset").otherwise("set").alias("kind"),
            (F.col("event_type") != "view").alias("checked"),
            "ts",
            "event_id",
        )

    @cached_property
    def slide_visits(self) -> DataFrame:
        return self.events.select(
            F.col("user_id").alias("learner"), (self._k % 20).alias("slide"), "ts", "event_id"
        )

    @cached_property
    def points(self) -> DataFrame:
        kind = (
            F.when(F.col("event_id") % 3 == 0, "16").when(F.col("event_id") % 3 == 1, "32").otherwise("bits")
        )
        return self.events.select(
            F.col("user_id").alias("device"),
            F.col("event_id").alias("ord"),
            kind.alias("kind"),
            (16256 + F.col("event_id") % 256).cast("int").alias("hi"),
            (self._k * 655).alias("lo"),
            F.when(F.col("event_type") == "click", "lsb").otherwise("msb").alias("word_order"),
        )

    @cached_property
    def telemetry(self) -> DataFrame:
        kind = F.col("event_type")
        return self.events.select(
            (F.col("user_id") % 10).alias("plant"),
            F.col("user_id").alias("device"),
            "ts",
            "event_id",
            F.col("value").alias("out"),
            F.when(F.col("user_id") % 23 == 0, 0.0).otherwise(100.0).alias("rating"),
            (~kind.isin("error", "click")).alias("responsive"),
            (self._k % 10 == 0).alias("fault"),
            (self._k % 17 == 3).alias("offline"),
            (kind != "view").alias("included"),
            (kind != "error").alias("quality"),
            kind.alias("source"),
            (50 + self._k / 2.0).alias("sp"),
        )


_LANE = "substr(o_orderpriority, 1, 1)"


def _pick(*values: str) -> str:
    arms = " ".join(f"WHEN '{d}' THEN {v}" for d, v in zip("1234", values[:4], strict=True))
    return f"CASE {_LANE} {arms} ELSE {values[4]} END"


_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
_SHOPS = "[" + ", ".join(f"'{r}'" for r in dims.RETAILERS) + "]"

SQL_VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {
    "books": (
        f"""SELECT CAST(p_partkey AS VARCHAR) AS id, p_name AS title, p_brand AS author,
        CASE p_type WHEN 'ECONOMY' THEN 'paperback' WHEN 'SMALL' THEN 'kindle' WHEN 'MEDIUM' THEN 'kobo'
          WHEN 'LARGE' THEN 'hardcover' WHEN 'STANDARD' THEN 'audiobook' ELSE 'unknown' END AS format,
        {_SHOPS}[CAST(p_partkey % 7 + 1 AS INTEGER)] AS retailer,
        CASE WHEN p_partkey % 11 <> 0 THEN CAST(p_partkey % 75 AS DECIMAL(10,2)) END AS price,
        CASE WHEN p_partkey % 13 <> 0 THEN p_size / 10.0::DOUBLE END AS rating,
        CASE WHEN p_partkey % 17 = 0 THEN 'lost' WHEN p_partkey % 3 = 0 THEN 'want'
          WHEN p_partkey % 3 = 1 THEN 'reading' ELSE 'read' END AS status,
        CASE WHEN p_partkey % 2 <> 0 THEN p_type END AS note,
        p_partkey AS added FROM part""",
        (),
    ),
    "book_kinds": (
        """SELECT *, CASE WHEN format IN ('kindle','kobo','audiobook') THEN 'digital' ELSE 'physical' END AS kind,
        CASE format WHEN 'hardcover' THEN 'Hardcover' WHEN 'kindle' THEN 'Kindle' WHEN 'kobo' THEN 'Kobo'
          WHEN 'audiobook' THEN 'Audiobook' ELSE 'Paperback' END AS format_label FROM books""",
        ("books",),
    ),
    "changes": (
        """SELECT row(l_shipdate, l_orderkey, l_linenumber, l_extendedprice, l_quantity, l_suppkey) AS seq,
        CASE WHEN l_returnflag = 'R' THEN 'remove' ELSE 'upsert' END AS op,
        CAST(l_partkey + CASE WHEN l_linestatus = 'O' THEN 1000000 ELSE 0 END AS VARCHAR) AS id,
        'order ' || l_orderkey AS title, 'supplier ' || l_suppkey AS author,
        CASE WHEN l_returnflag = 'A' THEN 'kobo' ELSE 'hardcover' END AS format, 'Amazon' AS retailer,
        CAST(l_quantity AS DECIMAL(10,2)) AS price, l_linenumber / 2.0::DOUBLE AS rating, 'reading' AS status,
        '' AS note, l_orderkey AS added FROM lineitem""",
        (),
    ),
    "last_changes": (
        """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY seq DESC) AS rn
        FROM changes) WHERE rn = 1""",
        ("changes",),
    ),
    "entries": (
        """SELECT l_orderkey AS track, CASE l_returnflag WHEN 'N' THEN 'w' WHEN 'A' THEN 'f' ELSE 'r' END AS role,
        'part ' || l_partkey || ' ' || l_linestatus AS title FROM lineitem""",
        (),
    ),
    "declared": (
        "SELECT o_orderkey AS track, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS declared FROM orders",
        (),
    ),
    "rules": (
        f"""SELECT *, start_local + to_minutes(minutes) AS end_local FROM (
        SELECT o_orderkey AS uid, o_custkey AS owner,
        {_pick("'Deep'", "'Algorithms'", "'Build'", "'Light'", "'Review'")} AS lane,
        '{TZ}' AS tz,
        o_orderdate + {_pick(*[f"to_minutes({m})" for m in (1170, 1170, 630, 1290, 1020)])} AS start_local,
        {_pick("60", "60", "150", "30", "30")} AS minutes,
        {_pick("['MO','TU','WE']", "['TH']", "['SA']", "['SU','MO','TU','WE','TH','FR']", "['SU']")} AS byday,
        o_orderdate + INTERVAL '28 days 7 hours 59 minutes 59 seconds' AS until_utc FROM orders)""",
        (),
    ),
    "blocks": (
        """SELECT block, DATE '1995-01-01' + CAST(block * 91 AS INTEGER) AS block_start,
        DATE '1995-01-01' + CAST(block * 91 + 83 AS INTEGER) AS block_end
        FROM (SELECT unnest(range(0, CAST(floor((max(CAST(o_orderdate AS DATE)) - DATE '1995-01-01') / 91.0) AS BIGINT)
        + 1)) AS block FROM orders)""",
        (),
    ),
    "ticks": (
        """SELECT event_id, CAST(ts AS DATE) AS day,
        (epoch_us(ts) % 86400000000) / 60000000.0::DOUBLE - 410 AS m, event_type FROM events""",
        (),
    ),
    "sessions": (
        """SELECT day, CAST(floor((m + 410) / 240) AS BIGINT) AS stretch, min(m) AS start_min, max(m) AS end_min
        FROM ticks WHERE event_type = 'purchase' GROUP BY ALL""",
        ("ticks",),
    ),
    "answers": (
        f"""SELECT user_id AS learner, {_K} % 10 AS item, CAST(event_id % 4 AS INTEGER) AS pick, ts, event_id
        FROM events""",
        (),
    ),
    "first_answers": (
        """SELECT *, CASE WHEN pick = item % 4 THEN 1 ELSE 0 END AS ok FROM (SELECT *, row_number() OVER
        (PARTITION BY learner, item ORDER BY ts, event_id) AS rn FROM answers) WHERE rn = 1""",
        ("answers",),
    ),
    "checklist_events": (
        f"""SELECT user_id AS learner, {_K} % 3 AS list, {_K} % 10 AS box,
        CASE WHEN event_type = 'error' THEN 'reset' ELSE 'set' END AS kind, event_type <> 'view' AS checked,
        ts, event_id FROM events""",
        (),
    ),
    "slide_visits": (f"SELECT user_id AS learner, {_K} % 20 AS slide, ts, event_id FROM events", ()),
    "points": (
        f"""SELECT user_id AS device, event_id AS ord,
        CASE event_id % 3 WHEN 0 THEN '16' WHEN 1 THEN '32' ELSE 'bits' END AS kind,
        CAST(16256 + event_id % 256 AS INTEGER) AS hi, {_K} * 655 AS lo,
        CASE WHEN event_type = 'click' THEN 'lsb' ELSE 'msb' END AS word_order FROM events""",
        (),
    ),
    "telemetry": (
        f"""SELECT user_id % 10 AS plant, user_id AS device, ts, event_id, value AS out,
        CASE WHEN user_id % 23 = 0 THEN 0.0::DOUBLE ELSE 100.0::DOUBLE END AS rating,
        event_type NOT IN ('error', 'click') AS responsive, {_K} % 10 = 0 AS fault, {_K} % 17 = 3 AS offline,
        event_type <> 'view' AS included, event_type <> 'error' AS quality, event_type AS source,
        50 + {_K} / 2.0::DOUBLE AS sp FROM events""",
        (),
    ),
}


def with_views(sql: str, uses: tuple[str, ...]) -> str:
    """Prefix a query with the views it uses, in dependency order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for needed in SQL_VIEWS[name][1]:
            visit(needed)
        if name not in ordered:
            ordered.append(name)

    for name in uses:
        visit(name)
    if not ordered:
        return sql
    body = ",\n".join(f"{name} AS ({SQL_VIEWS[name][0]})" for name in ordered)
    if sql.lstrip().upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {body},\n{sql.lstrip()[len('WITH RECURSIVE '):]}"
    if sql.lstrip().upper().startswith("WITH "):
        return f"WITH {body},\n{sql.lstrip()[len('WITH '):]}"
    return f"WITH {body}\n{sql}"
