"""Plan and page queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens.functions import text
from tracklens.operators import plan as P
from tracklens.operators import publish as G
from tracklens.operators import digests
from tracklens.plans import plan_audit
from tracklens.session import shared_folder
from tracklens.sources.markdown import read_track_tables
from tracklens.workload.registry import query

_ROLE_SQL = "CASE l_returnflag WHEN 'N' THEN 'w' WHEN 'A' THEN 'f' ELSE 'r' END"


@query(
    "flatten_tracks",
    f"""SELECT l_orderkey AS track, 0 AS pos, {_ROLE_SQL} AS role, 'part ' || l_partkey AS title FROM lineitem
    UNION ALL SELECT l_orderkey, 1, CASE l_linestatus WHEN 'O' THEN 'f' ELSE 'r' END, 'supplier ' || l_suppkey
    FROM lineitem""",
)
def _(t):
    return P.flatten_tracks(t.nested)


@query(
    "track_scan",
    f"SELECT 'track ' || l_orderkey AS track, {_ROLE_SQL} AS role, 'part ' || l_partkey AS title FROM lineitem",
)
def _(t):
    """Line items written as Markdown sections by Spark, then read back."""
    word = F.when(F.col("l_returnflag") == "N", "Work through").when(F.col("l_returnflag") == "A", "Read")
    sections = t.lineitem.select(
        F.concat(
            F.lit("## track "),
            F.col("l_orderkey").cast("string"),
            F.lit("\n\n| Role | Book |\n|---|---|\n| "),
            word.otherwise("Reference"),
            F.lit(" | part "),
            F.col("l_partkey").cast("string"),
            F.lit(" |\n"),
        ).alias("value")
    )
    path = shared_folder(t.spark, "tracks")
    sections.write.text(path)
    return read_track_tables(t.spark, path).select("track", "role", "title")


@query(
    "track_labels",
    """SELECT track, role, CASE role WHEN 'w' THEN 'WORK' WHEN 'f' THEN 'READ' WHEN 'r' THEN 'REF' END AS role_label,
    title FROM entries""",
    ("entries",),
)
def _(t):
    return P.label_role(t.entries)


@query(
    "track_rollup",
    """SELECT track, role, count(*) AS entries, CAST(grouping_id(track, role) AS INTEGER) AS level
    FROM entries GROUP BY ROLLUP (track, role)""",
    ("entries",),
)
def _(t):
    return P.track_summary(t.entries)


@query(
    "track_pivot",
    """SELECT track, count(*) FILTER (role = 'w') AS w, count(*) FILTER (role = 'f') AS f,
    count(*) FILTER (role = 'r') AS r FROM entries GROUP BY track""",
    ("entries",),
)
def _(t):
    return P.track_pivot(t.entries)


@query(
    "count_reconcile",
    """SELECT track, declared, actual, coalesce(actual, 0) - coalesce(declared, 0) AS diff,
    declared IS NOT DISTINCT FROM actual AS agrees FROM declared
    FULL JOIN (SELECT track, count(*) AS actual FROM entries GROUP BY track) USING (track)""",
    ("declared", "entries"),
)
def _(t):
    return P.reconcile(t.declared, t.entries.groupBy("track").agg(F.count("*").alias("actual")), ["track"])


@query(
    "dataset_diff",
    """WITH a AS (SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O'),
    b AS (SELECT l_partkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F')
    SELECT side, l_partkey, l_returnflag, count(*) AS copies FROM (
      SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
      UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY ALL""",
)
def _(t):
    side = lambda s: t.lineitem.filter(F.col("l_linestatus") == s).select("l_partkey", "l_returnflag")
    return P.dataset_diff(side("O"), side("F"))


@query(
    "tree_diff",
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity FROM lineitem),
    b AS (SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_orderkey % 1000 = 7 THEN l_quantity + 1 ELSE l_quantity END
      AS l_quantity FROM lineitem WHERE l_orderkey % 1000 <> 8)
    SELECT side, l_orderkey, l_linenumber, l_partkey, l_quantity, count(*) AS copies FROM (
      SELECT 'left' AS side, * FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
      UNION ALL SELECT 'right', * FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)) GROUP BY ALL""",
)
def _(t):
    a = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    more = F.when(F.col("l_orderkey") % 1000 == 7, F.col("l_quantity") + 1).otherwise(F.col("l_quantity"))
    b = a.filter(F.col("l_orderkey") % 1000 != 8).withColumn("l_quantity", more)
    return digests.tree_diff(a, b, ["l_orderkey", "l_linenumber"])


@query("unit_rows", "SELECT track, declared, CAST(unnest(range(1, declared + 1)) AS INTEGER) AS unit FROM declared", ("declared",))
def _(t):
    return P.unit_rows(t.declared)


_LANES = ["deep", "light", "build"]


def _roadmap(t):
    return t.orders.select(
        F.col("o_orderkey").alias("block"),
        F.col("o_orderpriority").alias("deep"),
        F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("customer "), F.col("o_custkey").cast("string"))).alias("light"),
        F.col("o_orderstatus").alias("build"),
    )


@query(
    "roadmap_unpivot",
    """SELECT o_orderkey AS block, 'deep' AS lane, o_orderpriority AS text FROM orders
    UNION ALL SELECT o_orderkey, 'light', 'customer ' || o_custkey FROM orders WHERE o_orderstatus <> 'P'
    UNION ALL SELECT o_orderkey, 'build', o_orderstatus FROM orders""",
)
def _(t):
    return P.roadmap_long(_roadmap(t), _LANES, ["block"])


@query(
    "roadmap_pivot",
    """SELECT o_orderkey AS block, o_orderpriority AS deep,
    CASE WHEN o_orderstatus <> 'P' THEN 'customer ' || o_custkey END AS light, o_orderstatus AS build FROM orders""",
)
def _(t):
    return P.roadmap_wide(P.roadmap_long(_roadmap(t), _LANES, ["block"]), _LANES, ["block"])


@query(
    "latest_edition",
    """SELECT * EXCLUDE (rn) FROM (SELECT p_name AS work, p_size AS edition, p_partkey AS id,
      p_name || ' ' || p_size || 'e' AS title, count(*) OVER (PARTITION BY p_name) AS copies,
      row_number() OVER (PARTITION BY p_name ORDER BY p_size DESC, p_partkey DESC) AS rn FROM part) WHERE rn = 1""",
)
def _(t):
    title = F.concat(F.initcap("p_name"), F.lit(" "), F.col("p_size").cast("string"), F.lit("e"))
    found = P.latest_edition(t.part.select(F.col("p_partkey").alias("id"), title.alias("title")))
    return found.withColumn("title", F.lower("title"))


@query(
    "plan_audit",
    """WITH t AS (SELECT 'track' AS "check", CAST(track AS VARCHAR) AS key, declared, actual FROM declared
      FULL JOIN (SELECT track, count(*) AS actual FROM entries GROUP BY track) USING (track)),
    r AS (SELECT 'role' AS "check", role AS key, count(*) FILTER (title LIKE '% O') AS declared, count(*) AS actual
      FROM entries GROUP BY role),
    m AS (SELECT 'minutes' AS "check", CAST(owner AS VARCHAR) AS key, count(*) * 180 AS declared,
      CAST(sum(len(byday) * minutes) AS BIGINT) AS actual FROM rules GROUP BY owner),
    w AS (SELECT 'weekday' AS "check", CAST(uid AS VARCHAR) AS key,
      upper(byday[1][1]) || lower(byday[1][2]) AS declared, substr(strftime(start_local, '%a'), 1, 2) AS actual FROM rules),
    p AS (SELECT 'track role' AS "check", track || ' / ' || role AS key, count(*) FILTER (title NOT LIKE 'part 1%') AS declared,
      count(*) AS actual FROM entries GROUP BY track, role),
    d AS (SELECT track, sum(n) AS n FROM (SELECT track, role, title, 1 AS n FROM entries
      UNION ALL SELECT track, CASE WHEN track % 97 = 0 THEN 'w' ELSE role END, title, -1 FROM entries
        WHERE track % 89 <> 0 OR role <> 'r') GROUP BY track, role, title HAVING sum(n) <> 0),
    s AS (SELECT 'source' AS "check", CAST(track AS VARCHAR) AS key, coalesce(sum(-n) FILTER (n < 0), 0) AS declared,
      coalesce(sum(n) FILTER (n > 0), 0) AS actual FROM d GROUP BY track)
    SELECT "check", key, CAST(declared AS VARCHAR) AS declared, CAST(actual AS VARCHAR) AS actual,
      declared IS NOT DISTINCT FROM actual AS agrees FROM (SELECT * FROM t UNION ALL SELECT * FROM r UNION ALL SELECT * FROM m
      UNION ALL SELECT * FROM p)
    UNION ALL SELECT "check", key, declared, actual, declared = actual FROM w
    UNION ALL SELECT "check", key, CAST(declared AS VARCHAR), CAST(actual AS VARCHAR), false FROM s""",
    ("declared", "entries", "rules"),
)
def _(t):
    roles = t.entries.groupBy("role").agg(F.count_if(F.endswith("title", F.lit(" O"))).alias("declared"))
    minutes = t.rules.groupBy("owner").agg((F.count("*") * 180).alias("declared"))
    pairs = t.entries.groupBy("track", "role").agg(F.count_if(~F.startswith("title", F.lit("part 1"))).alias("declared"))
    track = F.col("track")
    source = t.entries.filter((track % 89 != 0) | (F.col("role") != "r"))
    source = source.withColumn("role", F.when(track % 97 == 0, "w").otherwise(F.col("role")))
    return plan_audit.audit(t.entries, t.declared, roles, t.rules, minutes, source, pairs)


# ---- pages ----


@query(
    "page_sections",
    """SELECT page_id, n_p, n_li, printf('%02d', n_p) AS n_p_text, printf('%02d', n_li) AS n_li_text FROM (
    SELECT page_id, CAST((length(html) - length(replace(html, '<p', ''))) // 2 AS BIGINT) AS n_p,
    CAST((length(html) - length(replace(html, '<li', ''))) // 3 AS BIGINT) AS n_li FROM pages)""",
)
def _(t):
    return G.sections(t.pages, {"n_p": "<p", "n_li": "<li"}).drop("url", "html")


@query("page_escape", """SELECT page_id, replace(html, '"', '&quot;') AS html FROM pages""")
def _(t):
    return t.pages.select("page_id", text.escape_attr(F.col("html")).alias("html"))


@query(
    "page_labels",
    """SELECT page_id, trim(coalesce(nullif(regexp_extract(url, '#(.*)$', 1), ''),
    nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), ''), 'Slide ' || (page_id + 1))) AS label FROM pages""",
)
def _(t):
    short = F.regexp_extract("url", "#(.*)$", 1)
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t.pages.select("page_id", G.card_label(short, title, F.col("page_id") + 1).alias("label"))


@query(
    "page_link_json",
    """SELECT page_id, '{' || array_to_string(list_transform(urls, lambda u, i: '"' || i || '":"' || u || '"'), ',')
    || '}' AS links FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS urls FROM pages)""",
)
def _(t):
    return t.pages.select("page_id", G.links_json(G.hrefs(F.col("html"))).alias("links"))


@query(
    "link_resolve",
    """WITH pairs AS (SELECT page_id, urls[1] AS own, unnest(urls) AS target FROM
      (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS urls FROM pages))
    SELECT page_id, own, target, variant, CASE WHEN own = target THEN NULL WHEN variant = 'standalone'
      THEN substr(target, 2) || '.html' ELSE 'https://example.com' || target END AS href,
      own <> target AND variant = 'fragment' AS new_tab
    FROM pairs, (VALUES ('standalone'), ('fragment')) v(variant)""",
)
def _(t):
    urls = G.hrefs(F.col("html"))
    pairs = t.pages.select("page_id", urls.alias("_urls")).select(
        "page_id", F.get("_urls", F.lit(0)).alias("own"), F.explode("_urls").alias("target")
    )
    known = pairs.select("target").distinct().select(
        "target",
        F.concat(F.expr("substring(target, 2)"), F.lit(".html")).alias("file"),
        F.concat(F.lit("https://example.com"), "target").alias("absolute"),
    )
    return G.resolve_links(pairs, known)


@query(
    "variant_write",
    """SELECT page_id, url, length(html) AS n_chars, variant FROM pages, (VALUES ('standalone'), ('fragment')) v(variant)""",
)
def _(t):
    path = G.write_variants(t.pages, shared_folder(t.spark, "variants"))
    written = t.spark.read.parquet(path)
    return written.select("page_id", "url", F.length("html").cast("long").alias("n_chars"), F.col("variant").cast("string"))
