"""Register and conversion queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tracklens import dims
from tracklens.functions.numeric import decode_f32
from tracklens.operators import registers as R
from tracklens.plans.register_map import register_map
from tracklens.workload.registry import query

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def k():
    return F.get_json_object("props", "$.k").cast("int")


_LAYOUT = """layout AS (SELECT *, CAST(coalesce(sum(CASE WHEN kind = '32' THEN 2 ELSE 1 END) OVER (PARTITION BY device
  ORDER BY ord ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS address FROM points)"""
_NAMED = """named AS (SELECT *, CASE kind WHEN '16' THEN ['Status','Mode','Fault_Code','Ramp_Rate'][used % 4 + 1]
    WHEN '32' THEN ['P_kW','Q_kVAr','V_ll','Freq_Hz'][used % 4 + 1] ELSE ['Alarms','Trips','Flags'][used % 3 + 1] END
    || CASE WHEN used >= CASE kind WHEN 'bits' THEN 3 ELSE 4 END THEN '_' || used ELSE '' END AS name
  FROM (SELECT *, row_number() OVER (PARTITION BY device, kind ORDER BY ord) - 1 AS used FROM points))"""
_WORDS = """words AS (SELECT device, ord, kind, address, unnest(CASE kind
    WHEN '32' THEN [{'register': address, 'part': 'high word'}, {'register': address + 1, 'part': 'low word'}]
    WHEN 'bits' THEN [{'register': address, 'part': 'bits 0–15'}]
    ELSE [{'register': address, 'part': 'int16'}] END) AS w FROM layout)"""
_DECODED = """decoded AS (SELECT device, ord, CASE WHEN ex = 255 THEN NULL
    WHEN ex = 0 THEN sgn * frac * pow(2.0::DOUBLE, -149) + 0.0::DOUBLE
    ELSE sgn * (1.0::DOUBLE + frac / 8388608.0::DOUBLE) * pow(2.0::DOUBLE, ex - 127) END AS value
  FROM (SELECT device, ord, CASE WHEN bits >> 31 = 1 THEN -1.0::DOUBLE ELSE 1.0::DOUBLE END AS sgn,
    (bits >> 23) & 255 AS ex, (bits & 8388607)::DOUBLE AS frac FROM (SELECT device, ord,
      CASE WHEN word_order = 'lsb' THEN ((lo::BIGINT & 65535) << 16) | (hi::BIGINT & 65535)
      ELSE ((hi::BIGINT & 65535) << 16) | (lo::BIGINT & 65535) END AS bits FROM points)))"""


@query("register_layout", f"WITH {_LAYOUT} SELECT device, ord, kind, address FROM layout", ("points",))
def _(t):
    return R.register_layout(t.points.select("device", "ord", "kind"))


@query(
    "register_totals",
    """SELECT device, count(*) AS points, CAST(sum(CASE WHEN kind = '32' THEN 2 ELSE 1 END) AS BIGINT) AS registers
    FROM points GROUP BY device""",
    ("points",),
)
def _(t):
    return R.register_totals(t.points)


@query(
    "register_words",
    f"WITH {_LAYOUT}, {_WORDS} SELECT device, ord, kind, address, w.register AS register, w.part AS part FROM words",
    ("points",),
)
def _(t):
    return R.register_words(R.register_layout(t.points.select("device", "ord", "kind")))


@query("point_names", f"WITH {_NAMED} SELECT device, ord, kind, name FROM named", ("points",))
def _(t):
    return R.name_points(t.points.select("device", "ord", "kind"))


@query("register_decode", f"WITH {_DECODED} SELECT device, ord, value FROM decoded", ("points",))
def _(t):
    value = decode_f32(F.col("hi"), F.col("lo"), F.col("word_order"))
    return t.points.select("device", "ord", value.alias("value"))


@query(
    "register_map",
    f"""WITH {_LAYOUT}, {_NAMED}, {_WORDS}, {_DECODED}
    SELECT w.device, w.ord, w.kind, n.name, w.w.register AS register, w.w.part AS part,
      CASE WHEN w.kind = '32' THEN d.value END AS value
    FROM words w JOIN named n ON w.device = n.device AND w.ord = n.ord
    JOIN decoded d ON w.device = d.device AND w.ord = d.ord""",
    ("points",),
)
def _(t):
    return register_map(t.points).select("device", "ord", "kind", "name", "register", "part", "value")


@query(
    "index_bounds",
    """SELECT l_orderkey, l_linenumber AS idx, CAST(floor(l_quantity / 5) AS BIGINT) AS len,
    l_linenumber BETWEEN 1 AND floor(l_quantity / 5) AS ok FROM lineitem""",
)
def _(t):
    return R.in_bounds(
        t.lineitem.select("l_orderkey", F.col("l_linenumber").alias("idx"), F.floor(F.col("l_quantity") / 5).alias("len"))
    )


@query(
    "cycle_check",
    f"""SELECT event_id, sps, cycle_ms, round(1000.0::DOUBLE / sps, 9) AS frame_ms,
    CAST(floor(1000.0::DOUBLE / sps) AS BIGINT) AS need_ms, cycle_ms <= 1000.0::DOUBLE / sps AS keeps_up
    FROM (SELECT event_id, {_K} + 1 AS sps, value AS cycle_ms FROM events)""",
)
def _(t):
    checked = R.cycle_check(t.events.select("event_id", (k() + 1).alias("sps"), F.col("value").alias("cycle_ms")))
    return checked.withColumn("frame_ms", F.round("frame_ms", 9))


@query(
    "eval_rate",
    f"""SELECT event_id, round(1000.0::DOUBLE / nullif(value, 0), 6) AS per_second, ({_K} * 2) <= value AS meter_ok FROM events""",
)
def _(t):
    rated = R.eval_rate(t.events.select("event_id", F.col("value").alias("period_ms"), (k() * 2).alias("meter_ms")))
    return rated.select("event_id", F.round("per_second", 6).alias("per_second"), "meter_ok")


def _case(column: str, pairs) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in pairs) + " END"


_POINT_KIND = "CASE event_type WHEN 'click' THEN 'float' WHEN 'view' THEN 'int' WHEN 'purchase' THEN 'bin' WHEN 'signup' THEN 'cnt' ELSE 'dbl' END"


@query(
    "variation_lookup",
    f"""SELECT event_id, kind, has_time, {_case("kind", [(v[0], v[1]) for v in dims.VARIATIONS])} AS object_group,
    {_case("kind", [(v[0], v[2]) for v in dims.VARIATIONS])} AS name,
    CASE WHEN has_time THEN {_case("kind", [(v[0], v[3]) for v in dims.VARIATIONS])}
    ELSE {_case("kind", [(v[0], v[4]) for v in dims.VARIATIONS])} END AS variation
    FROM (SELECT event_id, {_POINT_KIND} AS kind, value > 50 AS has_time FROM events)""",
)
def _(t):
    kind = F.col("event_type")
    asked = t.events.select(
        "event_id",
        F.when(kind == "click", "float").when(kind == "view", "int").when(kind == "purchase", "bin")
        .when(kind == "signup", "cnt").otherwise("dbl").alias("kind"),
        (F.col("value") > 50).alias("has_time"),
    )
    return R.variation(asked, F.broadcast(dims.variation_dim(t.spark)))


@query(
    "send_mode",
    """SELECT event_id, event_type = 'error' AS needs_force, CASE WHEN event_type = 'error'
    THEN 'Send the full project' ELSE 'Send IEC 61131-3 logic only' END AS send_mode FROM events""",
)
def _(t):
    asked = t.events.select("event_id", (F.col("event_type") == "error").alias("needs_force"))
    return R.send_mode(asked, F.broadcast(dims.send_mode_dim(t.spark)))


@query(
    "diagnose",
    f"""SELECT event_id, first, second, CASE first || '/' || second WHEN 'none/closed' THEN 'Firewall.'
    WHEN 'none/open' THEN 'Server IP or port mismatch.' WHEN 'flowing/several' THEN 'Client IP port collision.'
    WHEN 'flowing/single' THEN 'Reversed or mismatched DNP addresses.' END AS cause FROM (
    SELECT event_id, CASE event_type WHEN 'error' THEN 'none' WHEN 'click' THEN 'unknown' ELSE 'flowing' END AS first,
    ['closed', 'open', 'several', 'single'][{_K} % 4 + 1] AS second FROM events)""",
)
def _(t):
    kind = F.col("event_type")
    answers = F.array(*[F.lit(x) for x in ("closed", "open", "several", "single")])
    seen = t.events.select(
        "event_id",
        F.when(kind == "error", "none").when(kind == "click", "unknown").otherwise("flowing").alias("first"),
        F.element_at(answers, k() % 4 + 1).alias("second"),
    )
    return R.diagnose(seen, F.broadcast(dims.diagnosis_dim(t.spark)))


@query(
    "broken_refs",
    """SELECT l_orderkey, l_linenumber, 'Part ' || l_partkey AS ref FROM lineitem WHERE l_partkey NOT IN
    (SELECT p_partkey FROM part WHERE p_type <> 'PROMO')""",
)
def _(t):
    uses = t.lineitem.select(
        "l_orderkey", "l_linenumber", F.concat(F.lit("Part "), F.col("l_partkey").cast("string")).alias("ref")
    )
    kept = t.part.filter(F.col("p_type") != "PROMO")
    defs = kept.select(F.concat(F.lit(" PART "), F.col("p_partkey").cast("string"), F.lit(" ")).alias("ref"))
    return R.broken_refs(uses, defs)


@query("fault_any", f"SELECT event_id, {_K} & 12 AS bits, ({_K} & 12) <> 0 AS fault FROM events")
def _(t):
    return R.normalise_fault(t.events.select("event_id", k().bitwiseAND(12).alias("bits")))


@query(
    "fault_any_device",
    f"""SELECT user_id AS device, bool_or(({_K} & 96) = 96) AS fault, count(*) FILTER (({_K} & 96) = 96) AS rows
    FROM events GROUP BY user_id""",
)
def _(t):
    both = k().bitwiseAND(96)
    bits = t.events.select(F.col("user_id").alias("device"), F.when(both == 96, both).otherwise(0).alias("bits"))
    return R.any_fault(bits, ["device"])


@query(
    "burn_down",
    """WITH passes AS (SELECT user_id % 10 AS plant, CAST(ts AS DATE) AS pass, count(*) FILTER (event_type = 'error') AS errors
      FROM events GROUP BY ALL)
    SELECT plant, pass, errors, lag(errors) OVER w - errors AS fixed,
      round(errors / nullif(first(errors) OVER w, 0) * 100, 6) AS left_pct FROM passes
    WINDOW w AS (PARTITION BY plant ORDER BY pass)""",
)
def _(t):
    passes = t.events.groupBy((F.col("user_id") % 10).alias("plant"), F.col("ts").cast("date").alias("pass")).agg(
        F.count_if(F.col("event_type") == "error").alias("errors")
    )
    return R.burn_down(passes, ["plant"]).withColumn("left_pct", F.round("left_pct", 6))


_FEATURES = """SELECT p_partkey AS ord, p_name AS name, p_brand AS brand, CAST(p_type IN ('SMALL','PROMO') AS INTEGER) AS inv,
  CAST(p_size > 25 AS INTEGER) AS hyb, CAST(p_retailprice > 950 AS INTEGER) AS met,
  CAST(p_brand < 'Brand#2' AS INTEGER) AS sub FROM part"""


def _candidates(t):
    flag = lambda c: c.cast("int")
    return t.part.select(
        F.col("p_partkey").alias("ord"),
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("brand"),
        flag(F.col("p_type").isin("SMALL", "PROMO")).alias("inv"),
        flag(F.col("p_size") > 25).alias("hyb"),
        flag(F.col("p_retailprice") > 950).alias("met"),
        flag(F.col("p_brand") < "Brand#2").alias("sub"),
    )


_WANTS = {"inv": True, "hyb": True, "met": False, "sub": True}


@query(
    "template_match",
    f"""SELECT ord, name, inv + hyb + sub AS score, CAST(floor((inv + hyb + sub) / 3 * 100 + 0.5) AS BIGINT) AS pct
    FROM ({_FEATURES})""",
)
def _(t):
    return R.template_match(_candidates(t), _WANTS).select("ord", "name", "score", "pct")


@query(
    "template_best",
    f"""SELECT brand, CASE WHEN score > 0 THEN name ELSE 'no usable base' END AS best,
    CAST(floor(score / 3 * 100 + 0.5) AS BIGINT) AS pct FROM (SELECT *, inv + hyb + sub AS score,
    row_number() OVER (PARTITION BY brand ORDER BY inv + hyb + sub DESC, ord) AS rn FROM ({_FEATURES})) WHERE rn = 1""",
)
def _(t):
    return R.best_template(_candidates(t), _WANTS, ["brand"])


@query(
    "template_ranking",
    f"""WITH wants AS (SELECT n_nationkey AS request, feature FROM nation,
      (VALUES ('inv', 1), ('hyb', 2), ('met', 4), ('sub', 8)) f(feature, bit) WHERE (n_nationkey & bit) <> 0),
    totals AS (SELECT request, count(*) AS total FROM wants GROUP BY request),
    scored AS (SELECT request, ord, name, count(*) FILTER (CASE feature WHEN 'inv' THEN inv WHEN 'hyb' THEN hyb
      WHEN 'met' THEN met ELSE sub END = 1) AS score FROM wants, ({_FEATURES}) GROUP BY ALL)
    SELECT request, ord, name, CAST(score AS INTEGER) AS score,
      CAST(floor(score / total * 100 + 0.5) AS BIGINT) AS pct,
      rank() OVER (PARTITION BY request ORDER BY score DESC) AS place
    FROM scored JOIN totals USING (request) WHERE score > 0""",
)
def _(t):
    return R.rank_templates(*_requests(t))


def _requests(t):
    bits = {"inv": 1, "hyb": 2, "met": 4, "sub": 8}
    wanted = [F.when(F.col("n_nationkey").bitwiseAND(b) != 0, name) for name, b in bits.items()]
    wants = t.table("nation").select(
        F.col("n_nationkey").alias("request"), F.explode(F.array_compact(F.array(*wanted))).alias("feature")
    )
    return R.held_features(_candidates(t), list(bits)), wants


@query(
    "template_top",
    f"""WITH wants AS (SELECT n_nationkey AS request, feature FROM nation,
      (VALUES ('inv', 1), ('hyb', 2), ('met', 4), ('sub', 8)) f(feature, bit) WHERE (n_nationkey & bit) <> 0),
    totals AS (SELECT request, count(*) AS total FROM wants GROUP BY request),
    scored AS (SELECT request, ord, name, count(*) FILTER (CASE feature WHEN 'inv' THEN inv WHEN 'hyb' THEN hyb
      WHEN 'met' THEN met ELSE sub END = 1) AS score FROM wants, ({_FEATURES}) GROUP BY ALL)
    SELECT request, ord, name, CAST(score AS INTEGER) AS score, CAST(floor(score / total * 100 + 0.5) AS BIGINT) AS pct,
      CAST(place AS INTEGER) AS place FROM (SELECT *, row_number() OVER (PARTITION BY request ORDER BY score DESC, ord, name) AS place
        FROM scored WHERE score > 0) JOIN totals USING (request) WHERE place <= 3""",
)
def _(t):
    return R.top_templates(*_requests(t), k=3)
