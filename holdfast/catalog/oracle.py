"""The same results in plain SQL, for another engine to compute from the same tables.

Written from the rules, not from the DataFrame code: windows where that is clearer, and no
care for large data.
"""

from __future__ import annotations

from holdfast.catalog.queries import GRID, MONTHS, REPAIRS, RESULT_TABLES, SHARES, TOTALS
from holdfast.catalog.sales import AS_OF, REGIONS, TYPES
from holdfast.sources.feedback import NOTE_COLUMNS
from holdfast.spec import RiskLabels

L = RiskLabels()
KEYS = "client_id, product, branch"


def dsum(x: str) -> str:
    return f"COALESCE(SUM({x}), 0.0)"


def even(x: str) -> str:
    """Round half to even, for a double."""
    return (
        f"(CASE WHEN ({x}) - floor({x}) = 0.5 THEN 2 * round(({x}) / 2) ELSE round({x}) END)"
    )


def rnd_once(x: str, digits: int) -> str:
    scale = f"{10**digits}.0::DOUBLE"
    return f"({even(f'({x}) * {scale}')} / {scale})"


def rnd(x: str, digits: int) -> str:
    """To 8 decimals, then to ``digits``, as the queries do."""
    return rnd_once(rnd_once(x, 8), digits)


def months(later: str, earlier: str) -> str:
    return f"date_diff('month', {earlier}, {later})"


def digest(keys: str, seed: int) -> str:
    return f"md5(concat_ws('|', {keys}, '{seed}'))"


def number(digest_sql: str, digits: int = 6) -> str:
    return f"CAST('0x' || substr({digest_sql}, 1, {digits}) AS BIGINT)"


def newest(column: str, date: str = "sale_date") -> str:
    return (
        f"(arg_max({column}, ({date}, {column})) FILTER (WHERE {column} IS NOT NULL)) AS {column}"
    )


CTE: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, needs: tuple[str, ...], body: str) -> None:
    CTE[name] = (needs, body)


def sql(final: str, *needs: str) -> str:
    """The final select with the tables it needs in front."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        for other in CTE[name][0]:
            visit(other)
        if name not in ordered:
            ordered.append(name)

    for name in needs:
        visit(name)
    if not ordered:
        return final
    return "WITH " + ",\n".join(f"{n} AS ({CTE[n][1]})" for n in ordered) + "\n" + final


cte(
    "lines",
    (),
    """
SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS line_no, l_suppkey AS client_id,
  NULLIF(p_type, 'PROMO') AS product, l_partkey AS product_code,
  CAST(p_size AS BIGINT) AS size_code, r_name AS branch, CAST(o_orderdate AS DATE) AS sale_date,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
  l_extendedprice * (1 - l_discount) AS amount, l_extendedprice AS amount_usd,
  l_quantity AS volume, s_name AS client_name, o_orderpriority AS seller,
  c_mktsegment AS segment, l_returnflag AS doc_type, l_linestatus AS data_kind,
  CASE WHEN s_acctbal > 5000 THEN 'S' WHEN s_acctbal > 2000 THEN 'N' END AS flag_a,
  CASE WHEN l_returnflag = 'R' THEN 'S' ELSE l_returnflag END AS flag_b,
  'T' || n_name AS phone,
  CASE WHEN l_linestatus = 'O' THEN 'm' || CAST(o_custkey AS VARCHAR) END AS email
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey JOIN supplier ON l_suppkey = s_suppkey""",
)
cte(
    "raw",
    ("lines",),
    f"SELECT * FROM lines WHERE sale_date >= date_trunc('month', DATE '{AS_OF}') - INTERVAL 27 MONTH",
)
cte("sales", ("raw",), "SELECT * FROM raw WHERE product IS NOT NULL")
cte(
    "ends",
    ("sales",),
    """SELECT max(period) AS prod_end,
  CAST(max(period) - INTERVAL 3 MONTH AS DATE) AS train_end FROM sales""",
)
cte(
    "act",
    ("sales",),
    f"""
SELECT {KEYS}, period, {dsum('amount')} AS monetary_value,
  CAST(COUNT(sale_date) >= 1 AS BIGINT) AS frequency, {dsum('volume')} AS volume
FROM sales WHERE client_id IS NOT NULL AND branch IS NOT NULL AND period IS NOT NULL
GROUP BY {KEYS}, period""",
)
cte(
    "gaps",
    ("act",),
    f"""
SELECT *, COALESCE({months('period', 'lag(period) OVER w')}, 0) AS max_gap
FROM act WINDOW w AS (PARTITION BY client_id, product ORDER BY period, branch)""",
)


def reference_cte(name: str, end: str) -> None:
    cte(
        name,
        ("act", "ends"),
        f"""
SELECT {KEYS}, COALESCE(o, r) AS ref_period,
  CASE WHEN o IS NULL THEN 'recent' ELSE 'older' END AS ref_kind
FROM (SELECT {KEYS},
  max(period) FILTER (WHERE period BETWEEN {end} - INTERVAL 24 MONTH
                      AND {end} - INTERVAL 12 MONTH) AS o,
  min(period) FILTER (WHERE period BETWEEN {end} - INTERVAL 11 MONTH AND {end}) AS r
  FROM act, ends GROUP BY {KEYS})""",
    )


def features_cte(name: str, end: str, reference: str) -> None:
    reference_cte(reference, end)
    cte(
        name,
        ("gaps", "ends", reference),
        f"""
SELECT a.client_id, a.product, a.branch, a.monetary_value, a.frequency, a.volume,
  a.last_purchase, a.max_gap,
  CAST({even("abs(date_diff('day', first_period, last_purchase)) / 30.4375::DOUBLE")} AS BIGINT) + 1
    AS recency,
  p.ref_period, p.ref_kind,
  ({months('last_purchase', 'p.ref_period')} + 1)::DOUBLE
    / (a.frequency + CASE WHEN p.ref_kind = 'older' THEN 1 ELSE 0 END) AS mean_gap,
  analysis_period
FROM (
  SELECT {KEYS}, {dsum('monetary_value')} / COUNT(*) AS monetary_value,
    CAST(SUM(frequency) AS BIGINT) AS frequency, {dsum('volume')} / COUNT(*) AS volume,
    max(period) AS last_purchase, CAST(max(max_gap) AS BIGINT) AS max_gap,
    any_value({end}) AS analysis_period, any_value(first_period) AS first_period
  FROM (SELECT *, min(period) OVER () AS first_period FROM gaps, ends
        WHERE period > {end} - INTERVAL 12 MONTH AND period <= {end})
  GROUP BY {KEYS}) a
JOIN {reference} p USING ({KEYS})""",
    )


features_cte("feat", "prod_end", "ref_prod")
features_cte("tfeat", "train_end", "ref_train")
cte(
    "labels_w",
    ("act", "ends"),
    f"""
SELECT client_id, product, {dsum('monetary_value')} AS future_spend_total,
  {dsum('monetary_value')} / COUNT(*) AS future_spend_avg, CAST(0 AS BIGINT) AS target
FROM act, ends WHERE period > prod_end - INTERVAL 3 MONTH AND period <= prod_end
GROUP BY client_id, product""",
)
cte(
    "train",
    ("tfeat", "labels_w"),
    """SELECT tfeat.*, COALESCE(target, 1) AS target
FROM tfeat LEFT JOIN labels_w USING (client_id, product)""",
)
PROBABILITY = f"({number(digest(KEYS, 5))} % 1000) / 1000.0::DOUBLE"
cte(
    "marg",
    ("sales",),
    """
SELECT product, branch, 1.0::DOUBLE - """ + f"{dsum('amount')} / {dsum('amount_usd')} AS margin" + """
FROM sales GROUP BY product, branch
HAVING NOT (product = 'ECONOMY' AND branch = 'ASIA')""",
)
cte("names", ("raw",), "SELECT client_id, min(client_name) AS client_name FROM raw GROUP BY client_id")
cte(
    "risk",
    ("feat", "marg", "names"),
    f"""
SELECT f.*, names.client_name, margin, monetary_value * frequency AS total_value,
  CASE WHEN base <> '{L.opportunity}' THEN prob END AS churn_probability,
  CASE WHEN last_purchase = analysis_period THEN '{L.recent}' ELSE base END AS risk_level
FROM (SELECT *, CASE WHEN frequency <= 3 THEN '{L.opportunity}' WHEN prob >= 0.8 THEN '{L.lost}'
    WHEN prob >= 0.7 THEN '{L.high}' WHEN prob >= 0.5 THEN '{L.at_risk}'
    WHEN prob >= 0 THEN '{L.stable}' ELSE '{L.unknown}' END AS base
  FROM (SELECT *, {PROBABILITY} AS prob FROM feat)) f
LEFT JOIN marg USING (product, branch) LEFT JOIN names USING (client_id)""",
)
cte(
    "churn",
    ("risk",),
    f"""
SELECT client_id,
  {dsum('churn_probability * total_value')} / NULLIF({dsum('total_value')}, 0)
    AS client_churn_probability,
  {dsum('margin * total_value')} / NULLIF({dsum('total_value')}, 0) AS client_margin_est
FROM risk WHERE risk_level <> '{L.opportunity}' GROUP BY client_id""",
)
cte(
    "opp",
    ("risk",),
    f"""
SELECT client_id, {dsum('total_value * margin')} AS potential_win
FROM risk WHERE risk_level = '{L.opportunity}' GROUP BY client_id""",
)
cte(
    "total12",
    ("raw",),
    f"""
SELECT client_id, branch, {dsum('amount')} AS sales_12m FROM raw
WHERE sale_date >= (SELECT max(period) FROM raw) - INTERVAL 11 MONTH GROUP BY client_id, branch""",
)
cte(
    "list",
    ("risk", "churn", "opp", "total12"),
    f"""
SELECT r.client_id, a.branch, r.client_name, a.segment, sl.seller, c.phone, c.email,
  CAST({even(rnd_once('t.sales_12m', 6))} AS BIGINT) AS sales_12m,
  COALESCE(churn.client_churn_probability, 0) AS client_churn_probability,
  churn.client_margin_est,
  COALESCE(t.sales_12m * churn.client_churn_probability * churn.client_margin_est, 0)
    AS expected_loss,
  opp.potential_win
FROM (SELECT DISTINCT client_id, client_name FROM risk) r
LEFT JOIN (SELECT client_id, branch, {newest('segment')} FROM raw GROUP BY client_id, branch) a
  USING (client_id)
LEFT JOIN (SELECT client_id, {newest('seller')} FROM raw GROUP BY client_id) sl USING (client_id)
LEFT JOIN (SELECT client_id, branch, {newest('phone')}, {newest('email')} FROM sales
           GROUP BY client_id, branch) c USING (client_id, branch)
LEFT JOIN total12 t USING (client_id, branch)
LEFT JOIN churn USING (client_id) LEFT JOIN opp USING (client_id)""",
)
cte(
    "atrisk",
    ("risk",),
    f"""SELECT DISTINCT client_id FROM risk
WHERE churn_probability >= 0.5 AND risk_level NOT IN ('{L.opportunity}', '{L.recent}')""",
)
cte(
    "topopp",
    ("risk", "ends"),
    f"""
SELECT client_id, client_name, total_value, margin FROM (
  SELECT DISTINCT client_name, client_id, total_value, margin FROM risk, ends
  WHERE risk_level = '{L.opportunity}' AND last_purchase < prod_end - INTERVAL 1 MONTH
    AND last_purchase >= prod_end - INTERVAL 4 MONTH)
ORDER BY total_value * margin DESC NULLS LAST, client_id, total_value DESC,
  margin DESC NULLS LAST, client_name LIMIT 500""",
)
cte(
    "callable",
    ("risk",),
    f"""SELECT DISTINCT client_id FROM risk
WHERE (churn_probability >= 0.5 AND risk_level <> '{L.recent}') OR risk_level = '{L.opportunity}'""",
)
cte(
    "targets",
    ("list", "atrisk", "topopp", "callable"),
    """
SELECT * FROM list WHERE client_id IN (SELECT client_id FROM atrisk UNION SELECT client_id FROM topopp)
  AND seller IS DISTINCT FROM '5-LOW' AND client_id IN (SELECT client_id FROM callable)""",
)
cte(
    "oldlist",
    ("raw",),
    f"""
SELECT client_id, branch,
  client_id * 100 + length(branch) + ascii(branch) AS row_no,
  CASE WHEN h % 4 <> 0 THEN 'E' || CAST(h % 5 AS VARCHAR) END AS "Estado",
  mark AS "Fecha_planificada",
  CASE WHEN h % 2 = 0 THEN mark END AS telefono_alternativo,
  mark AS nombre_persona_contactada,
  CASE WHEN h % 3 = 0 THEN '{L.not_at_risk_reason}' WHEN h % 3 = 1 THEN 'OTRO' END
    AS motivo_contacto_fallido,
  CASE WHEN h % 7 < 3 THEN '' END AS estado_propuesta,
  CAST(h % 1000 AS VARCHAR) AS valor_propuesta,
  CASE WHEN h % 5 = 0 THEN mark END AS motivo_venta_nocerrada,
  mark AS observaciones,
  CASE WHEN h % 6 <> 0 THEN '2001-07-15' END AS fecha_ultima_accion
FROM (SELECT client_id, branch, {number(digest('client_id, branch', 7))} AS h,
        concat_ws('-', 'n', client_id, branch) AS mark
      FROM (SELECT DISTINCT client_id, branch FROM raw))""",
)
cte(
    "predicted",
    ("train",),
    f"""SELECT target, CAST({PROBABILITY} > 0.5 AS BIGINT) AS prediction
FROM train WHERE frequency > 3""",
)
cte(
    "confusion",
    ("predicted",),
    """
SELECT COUNT(*) FILTER (WHERE target = 1 AND prediction = 1)::DOUBLE AS tp,
  COUNT(*) FILTER (WHERE target = 0 AND prediction = 1)::DOUBLE AS fp,
  COUNT(*) FILTER (WHERE target = 1 AND prediction = 0)::DOUBLE AS fn,
  COUNT(*) FILTER (WHERE target = 0 AND prediction = 0)::DOUBLE AS tn FROM predicted""",
)
cte(
    "listed",
    ("list",),
    f"""
SELECT client_id, branch, seller, sales_12m,
  CASE WHEN client_id IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 6000)
    THEN '{L.centre}' ELSE seller END AS assignee FROM list""",
)

cte(
    "balanced",
    ("train",),
    f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY target ORDER BY {digest(KEYS, 11)}, {KEYS})
    AS pos, COUNT(*) FILTER (WHERE target = 1) OVER () AS churners FROM train WHERE frequency > 3)
WHERE (target = 1 OR pos <= churners)
  AND NOT {number(digest(KEYS, 42))} / 16777216.0::DOUBLE < 0.2""",
)
_CUTS = " ".join(
    f"WHEN draw < greatest({GRID.thin ** (k + 1 - GRID.rungs)}, {GRID.least_rows} / n::DOUBLE) THEN {k}"
    for k in range(GRID.rungs - 1)
)
cte(
    "sampled",
    ("balanced",),
    f"""
SELECT {KEYS}, target, CAST({number(digest(KEYS, GRID.seed))} % {GRID.folds} AS INTEGER) AS fold,
  CAST(CASE {_CUTS} ELSE {GRID.rungs - 1} END AS INTEGER) AS rung
FROM (SELECT *, {number(digest(KEYS, GRID.seed + 1))} / 16777216.0::DOUBLE AS draw,
  COUNT(*) OVER () AS n FROM balanced)""",
)
cte(
    "codes",
    ("raw",),
    """
SELECT "column", value, n, code FROM (
  SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY n DESC, value) - 1 AS code FROM (
    SELECT "column", value, COUNT(*) AS n FROM (
      SELECT 'product' AS "column", product AS value FROM raw UNION ALL
      SELECT 'segment', segment FROM raw UNION ALL SELECT 'client_name', client_name FROM raw)
    WHERE value IS NOT NULL GROUP BY "column", value HAVING COUNT(*) >= 20))
WHERE code < 60""",
)
cte(
    "ranked",
    ("train",),
    f"""
SELECT {KEYS}, target, prob, rank() OVER (ORDER BY prob)
  + (COUNT(*) OVER (PARTITION BY prob) - 1) / 2.0::DOUBLE AS mid_rank
FROM (SELECT *, {PROBABILITY} AS prob FROM train)""",
)

for _i, _as_of in enumerate(MONTHS):
    cte(
        f"raw_{_i}",
        ("lines",),
        f"""SELECT * FROM lines WHERE sale_date < DATE '{_as_of}'
  AND sale_date >= DATE '{_as_of}' - INTERVAL 27 MONTH""",
    )
    cte(
        f"act_{_i}",
        (f"raw_{_i}",),
        f"""
SELECT {KEYS}, period, {dsum('amount')} AS monetary_value,
  CAST(COUNT(sale_date) >= 1 AS BIGINT) AS frequency, {dsum('volume')} AS volume
FROM raw_{_i} WHERE product IS NOT NULL GROUP BY {KEYS}, period""",
    )
OLD_STATE = """CASE WHEN branch IN ('AMERICA', 'EUROPE') THEN 'old' ELSE "Estado" END AS "Estado\""""

SALES = "order_no, line_no, client_id, product, branch, sale_date, amount, volume"
RESULTS = """SELECT client_id, product, monetary_value, branch AS country,
  strftime(period, '%Y%m') AS period FROM act"""
FEATURES = f"""SELECT {KEYS}, monetary_value, frequency, volume, last_purchase, max_gap, recency,
  ref_period, ref_kind, {rnd('mean_gap', 6)} AS mean_gap, analysis_period FROM """
LIST = f"""SELECT client_id, branch, client_name, segment, seller, phone, email, sales_12m,
  {rnd('client_churn_probability', 6)} AS client_churn_probability,
  {rnd('client_margin_est', 6)} AS client_margin_est,
  {rnd('expected_loss', 2)} AS expected_loss, potential_win FROM """
BANDS = f"""CASE max(CASE WHEN risk_level IN ('{L.lost}', '{L.high}', '{L.at_risk}') THEN 2
  WHEN risk_level = '{L.opportunity}' THEN 1 ELSE 0 END)
  WHEN 2 THEN 'Risk' WHEN 1 THEN 'Opportunity' ELSE 'Out' END AS band"""
BANDED = f"""(SELECT list.*, COALESCE(band, 'Out') AS band FROM list LEFT JOIN
  (SELECT client_id, branch, {BANDS} FROM risk GROUP BY client_id, branch)
  USING (client_id, branch))"""
NOTES = ", ".join(f'"{c}"' for c in NOTE_COLUMNS)


def repaired() -> str:
    cases = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in REPAIRS.items())
    return f"CASE product {cases} ELSE product END"


def marks(column: str, values) -> str:
    return ", ".join(
        f"CAST(COALESCE({column} = '{v}', false) AS BIGINT) AS "
        f"{column}_{v.lower().replace(' ', '_')}"
        for v in values
    )


def capped(c: str) -> str:
    top = f"least({c}, (SELECT quantile_cont({c}, 0.999) FROM feat))"
    return rnd(f"greatest({top}, (SELECT quantile_cont({top}, 0.001) FROM feat))", 4) + f" AS {c}"


def allocated() -> str:
    """Cumulative counts per agent; the draws are taken from what is left over."""
    steps, taken, left = [], "0", 1.0
    for agent, share in SHARES.items():
        part = share / left
        rest = f"(n - {taken})"
        drawn = rest if abs(part - 1) < 0.01 else even(f"{rest} * {part!r}::DOUBLE")
        taken = f"({taken} + {drawn})"
        steps.append(f"WHEN pos <= {taken} THEN '{agent}'")
        left -= share
    return "CASE " + " ".join(steps) + f" ELSE '{L.centre}' END"


def report() -> str:
    def safe(a: str, b: str) -> str:
        return f"COALESCE(({a}) / NULLIF({b}, 0), 0)"

    def measures(hit: str, false: str, missed: str) -> list[str]:
        return [
            safe(hit, f"{hit} + {false}"),
            safe(hit, f"{hit} + {missed}"),
            safe(f"2 * {hit}", f"2 * {hit} + {false} + {missed}"),
        ]

    zero, one = measures("tn", "fn", "fp"), measures("tp", "fp", "fn")
    n0, n1 = "(tn + fp)", "(tp + fn)"
    accuracy = safe("tp + tn", f"{n0} + {n1}")
    rows = [
        ("0", zero, n0),
        ("1", one, n1),
        ("accuracy", [accuracy] * 3, accuracy),
        ("macro avg", [f"({a} + {b}) / 2" for a, b in zip(zero, one)], f"{n0} + {n1}"),
        (
            "weighted avg",
            [f"({a} * {n0} + {b} * {n1}) / ({n0} + {n1})" for a, b in zip(zero, one)],
            f"{n0} + {n1}",
        ),
    ]
    names = ("precision", "recall", "f1_score", "support")
    return " UNION ALL ".join(
        f"SELECT '{name}' AS class, "
        + ", ".join(f"{rnd(v, 6)} AS {n}" for v, n in zip([*values, support], names))
        + " FROM confusion"
        for name, values, support in rows
    )


def window_rows(test: str) -> str:
    return f"CAST({test} AS BIGINT)"


IN_OLDER = "period BETWEEN train_end - INTERVAL 24 MONTH AND train_end - INTERVAL 12 MONTH"
IN_RECENT = "period BETWEEN train_end - INTERVAL 11 MONTH AND train_end"
IN_FEATURES = "(period > train_end - INTERVAL 12 MONTH AND period <= train_end)"

ORACLE: dict[str, str] = {
    "src_sales": sql(f"SELECT {SALES} FROM lines", "lines"),
    "src_window_27m": sql(f"SELECT {SALES} FROM raw", "raw"),
    "src_contacts_distinct": """SELECT DISTINCT o_custkey AS client_id, c_name AS company,
  CAST(c_nationkey AS VARCHAR) AS branch_code
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "src_period_slice": sql(RESULTS + " WHERE period = DATE '2001-07-01'", "act"),
    "proj_period": sql(
        """SELECT order_no, line_no, period, strftime(sale_date, '%Y%m') AS period_text
  FROM lines""",
        "lines",
    ),
    "proj_period_formats": """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day_of_text,
  CAST(o_orderdate AS DATE) AS day_of_key,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS period_of_text,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS period_of_key,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS period_of_month FROM orders""",
    "proj_code_override": sql(
        """SELECT order_no, line_no,
  CASE WHEN size_code IN (3, 20) THEN 'CLASS C' WHEN size_code = 10 THEN 'CLASS B'
    WHEN size_code IN (1, 2) THEN 'CLASS A' ELSE product END AS product,
  CASE WHEN size_code IN (10, 20) THEN 'PACKAGED' ELSE segment END AS segment FROM lines""",
        "lines",
    ),
    "proj_trim_key": sql(
        """SELECT order_no, line_no, branch, CAST(r_regionkey AS BIGINT) AS region_key
  FROM lines JOIN region ON branch = r_name""",
        "lines",
    ),
    "proj_label_repair": sql(f"SELECT order_no, line_no, {repaired()} AS product FROM lines", "lines"),
    "proj_map_override": sql(
        """SELECT order_no, line_no, product_code,
  CASE WHEN p_size > 25 THEN 'NEW ' || p_type ELSE product END AS product
  FROM lines JOIN part ON product_code = p_partkey""",
        "lines",
    ),
    "proj_prefix_class": """SELECT c_custkey,
  CASE WHEN c_nationkey < 10 THEN 'DNI' ELSE '20' END || CAST(c_custkey AS VARCHAR) AS document,
  CASE WHEN c_nationkey < 10 THEN 'DNI' ELSE 'RUC' END AS document_kind FROM customer""",
    "proj_flag": sql(
        """SELECT order_no, line_no, CASE WHEN flag_a = 'S' THEN 1 ELSE 0 END::BIGINT AS flag_a,
  CASE WHEN flag_b = 'S' THEN 1 ELSE 0 END::BIGINT AS flag_b FROM lines""",
        "lines",
    ),
    "proj_fill": f"""SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS line_no,
  COALESCE(NULLIF(l_discount, 0.05), 0.0) AS discount,
  COALESCE(NULLIF(l_returnflag, 'R'), '{L.no_seller}') AS kind,
  NULLIF(l_linestatus, 'O') AS status FROM lineitem""",
    "proj_round_even": f"""SELECT l_orderkey AS order_no, CAST(l_linenumber AS BIGINT) AS line_no,
  CAST({even('l_quantity / 2')} AS BIGINT) AS half_quantity,
  {rnd_once('l_extendedprice * (1 - l_discount)', 2)} AS price FROM lineitem""",
    "buy_probability": sql(
        f"""SELECT {KEYS}, risk_level, churn_probability,
  CAST({even(f"COALESCE(CASE WHEN risk_level <> '{L.opportunity}' THEN 1 - churn_probability END, 0) * 100")}
    AS BIGINT) AS buy_probability FROM risk""",
        "risk",
    ),
    "filter_not_in_keep_null": sql(
        """SELECT order_no, line_no, product, segment FROM lines
  WHERE (product IS NULL OR product NOT IN ('SMALL', 'LARGE')) AND segment <> 'MACHINERY'""",
        "lines",
    ),
    "filter_in_or_null": sql(
        """SELECT order_no, line_no, product FROM lines
  WHERE product IN ('SMALL', 'LARGE') OR product IS NULL""",
        "lines",
    ),
    "filter_period_windows": sql(
        f"""SELECT {KEYS}, period, {window_rows(IN_OLDER)} AS in_older,
  {window_rows(IN_RECENT)} AS in_recent, {window_rows(IN_FEATURES)} AS in_features
  FROM act, ends WHERE {IN_OLDER} OR {IN_RECENT} OR {IN_FEATURES}""",
        "act",
        "ends",
    ),
    "history_view": sql(
        f"""SELECT {SALES} FROM lines
  WHERE year(sale_date) = 2001 AND month(sale_date) = 7""",
        "lines",
    ),
    "distinct_rows": sql(f"SELECT DISTINCT {KEYS}, segment FROM lines", "lines"),
    "join_left_dim": sql(
        """SELECT order_no, line_no, branch, 'M' || CAST(r_regionkey AS VARCHAR) AS manager
  FROM lines LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON branch = r_name""",
        "lines",
    ),
    "join_multi_dim": sql(
        """SELECT order_no, line_no,
  CASE WHEN branch <> 'ASIA' THEN 'M' || CAST(r.r_regionkey AS VARCHAR) END AS seller,
  n AS unit, p_brand AS brand
FROM lines JOIN region r ON branch = r.r_name JOIN part ON product_code = p_partkey
LEFT JOIN (SELECT r_name, c_mktsegment, COUNT(*) AS n FROM customer
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY r_name, c_mktsegment) u ON branch = u.r_name AND segment = u.c_mktsegment""",
        "lines",
    ),
    "join_cast_keys": sql(
        """SELECT order_no, line_no, client_id, s_name AS name
  FROM lines LEFT JOIN supplier ON client_id = s_suppkey""",
        "lines",
    ),
    "join_inner_attrs": sql(
        f"""SELECT {KEYS}, frequency, segment, CAST(COALESCE(flag_a, '') = 'S' AS BIGINT) AS flag_a,
  CAST(COALESCE(flag_b, '') = 'S' AS BIGINT) AS flag_b
FROM feat JOIN (SELECT client_id, product, {newest('segment')}, {newest('flag_a')},
  {newest('flag_b')} FROM raw GROUP BY client_id, product) USING (client_id, product)""",
        "feat",
        "raw",
    ),
    "label_training": sql(f"SELECT {KEYS}, frequency, target FROM train", "train"),
    "past_reference": sql("SELECT * FROM ref_prod", "ref_prod"),
    "join_semi": sql(
        """SELECT order_no, line_no, client_id FROM lines
  WHERE client_id IN (SELECT client_id FROM atrisk)""",
        "lines",
        "atrisk",
    ),
    "join_anti": sql(
        """SELECT order_no, line_no, client_id FROM lines
  WHERE client_id NOT IN (SELECT client_id FROM atrisk)""",
        "lines",
        "atrisk",
    ),
    "share_of_client": sql(
        f"""SELECT {KEYS}, total_value, client_value, {rnd('total_value / client_value', 6)} AS share
FROM (SELECT *, SUM(total_value) OVER (PARTITION BY client_id) AS client_value FROM risk WHERE risk_level <> '{L.opportunity}')""",
        "risk",
    ),
    "join_margin": sql(
        f"""SELECT {KEYS}, monetary_value, {rnd('margin', 6)} AS margin
  FROM feat LEFT JOIN marg USING (product, branch)""",
        "feat",
        "marg",
    ),
    "risk_view": sql(
        f"""SELECT {KEYS}, client_name, risk_level, churn_probability, analysis_period,
  last_purchase, {rnd('monetary_value', 2)} AS monetary_value, frequency, segment, seller,
  sales_12m, CAST(COALESCE(flag_a, '') = 'S' AS BIGINT) AS flag_a,
  CAST(COALESCE(flag_b, '') = 'S' AS BIGINT) AS flag_b
FROM risk LEFT JOIN (SELECT {KEYS}, {newest('segment')}, {newest('seller')} FROM sales
  GROUP BY {KEYS}) USING ({KEYS})
LEFT JOIN total12 USING (client_id, branch)
LEFT JOIN (SELECT client_id, product, {newest('flag_a')}, {newest('flag_b')} FROM raw
  GROUP BY client_id, product) USING (client_id, product)""",
        "risk",
        "total12",
    ),
    "features": sql(FEATURES + "feat", "feat"),
    "features_training": sql(FEATURES + "tfeat", "tfeat"),
    "activity": sql("SELECT * FROM act", "act"),
    "activity_multi_measure": sql(
        f"""SELECT {KEYS}, period, {dsum('amount_usd')} AS monetary_value_usd,
  {dsum('amount')} AS monetary_value, CAST(COUNT(sale_date) >= 1 AS BIGINT) AS frequency,
  {dsum('volume')} AS volume FROM sales GROUP BY {KEYS}, period""",
        "sales",
    ),
    "activity_small_addends": sql(
        """SELECT client_id, branch, SUM(volume / 1e6 * -3.0) * 1e6 AS monetary_value,
  SUM(volume / 1e6) * 1e6 AS volume
FROM sales WHERE client_id IS NOT NULL AND branch IS NOT NULL AND period IS NOT NULL
GROUP BY client_id, branch""",
        "sales",
    ),
    "agg_sales_12m": sql("SELECT * FROM total12", "total12"),
    "agg_sales_12m_filtered": sql(
        f"""SELECT client_id, branch, {dsum('amount')} AS sales_12m
FROM (SELECT *, max(period) OVER () AS newest FROM raw
  WHERE data_kind <> 'O' AND doc_type NOT IN ('R', 'A'))
WHERE sale_date >= newest - INTERVAL 11 MONTH GROUP BY client_id, branch""",
        "raw",
    ),
    "agg_last_transaction": sql(
        f"""SELECT {KEYS}, max(period) AS ref_period FROM act, ends
  WHERE period BETWEEN prod_end - INTERVAL 24 MONTH AND prod_end - INTERVAL 12 MONTH
  GROUP BY {KEYS}""",
        "act",
        "ends",
    ),
    "label_window": sql("SELECT * FROM labels_w", "labels_w"),
    "distinct_pairs": sql(
        """SELECT DISTINCT product, segment, branch FROM lines
  WHERE product IS NOT NULL AND segment IS NOT NULL AND branch IS NOT NULL""",
        "lines",
    ),
    "agg_client_name": sql(
        "SELECT client_id, min(client_name) AS client_name FROM lines GROUP BY client_id", "lines"
    ),
    "client_churn": sql(
        f"""SELECT client_id, {rnd('client_churn_probability', 6)} AS client_churn_probability,
  {rnd('client_margin_est', 6)} AS client_margin_est FROM churn""",
        "churn",
    ),
    "client_opportunity": sql("SELECT * FROM opp", "opp"),
    "agg_risk_counts": sql(
        """SELECT COUNT(*) AS clients,
  COUNT(*) FILTER (WHERE client_churn_probability >= 0.5) AS at_risk,
  COUNT(*) FILTER (WHERE client_churn_probability >= 0.5 AND potential_win IS NOT NULL)
    AS at_risk_with_opportunity,
  COUNT(*) FILTER (WHERE potential_win IS NOT NULL) AS with_opportunity FROM list""",
        "list",
    ),
    "agg_seller_load": sql(
        "SELECT seller, COUNT(*) AS clients FROM list GROUP BY seller ORDER BY 2 DESC, 1", "list"
    ),
    "band_client": sql(
        f"""SELECT client_id, branch, COALESCE(band, 'Out') AS band FROM list
  LEFT JOIN (SELECT client_id, {BANDS} FROM risk GROUP BY client_id) USING (client_id)""",
        "list",
        "risk",
    ),
    "band_client_branch": sql(
        f"SELECT CAST(client_id AS VARCHAR) AS client_id, branch, band FROM {BANDED}", "list", "risk"
    ),
    "win_gap_months": sql(f"SELECT {KEYS}, period, max_gap FROM gaps", "gaps"),
    "latest_per_key": sql(
        f"""SELECT client_id, branch, {newest('seller')}, {newest('segment')}, {newest('email')}
  FROM raw GROUP BY client_id, branch""",
        "raw",
    ),
    "assign_quota": sql(
        f"""SELECT client_id, branch, seller, sales_12m,
  CASE WHEN seller = '3-MEDIUM' OR n < 10 THEN '{L.centre}' WHEN n <= 40 THEN seller
    WHEN pos <= least(greatest(reached, 10), 40) THEN seller ELSE '{L.centre}' END AS assignee
FROM (SELECT *, COUNT(*) FILTER (WHERE sales_12m >= q) OVER (PARTITION BY seller) AS reached
  FROM (SELECT *, COUNT(*) OVER (PARTITION BY seller) AS n,
      quantile_cont(sales_12m::DOUBLE, 0.8) OVER (PARTITION BY seller) AS q,
      row_number() OVER (PARTITION BY seller
        ORDER BY sales_12m DESC NULLS LAST, client_id, branch) AS pos
    FROM list))""",
        "list",
    ),
    "rank_clients": sql(
        f"""SELECT row_number() OVER (ORDER BY expected_loss DESC NULLS LAST,
    client_churn_probability DESC NULLS LAST, potential_win DESC NULLS LAST, client_id, branch)
    AS call_rank, client_id, branch, expected_loss FROM ({LIST} targets)""",
        "targets",
    ),
    "row_number": sql(
        """SELECT order_no, line_no, amount,
  row_number() OVER (ORDER BY amount DESC, order_no, line_no) AS row_number FROM raw""",
        "raw",
    ),
    "topk_opportunities": sql(
        f"""SELECT client_id, client_name, total_value, {rnd('margin', 6)} AS margin
  FROM topopp""",
        "topopp",
    ),
    "union_tagged": sql(
        f"""SELECT 'Production' AS data_type, {KEYS}, monetary_value, frequency, recency, max_gap
  FROM feat UNION ALL
SELECT 'Training', {KEYS}, monetary_value, frequency, recency, max_gap FROM tfeat""",
        "feat",
        "tfeat",
    ),
    "unpivot_margin": sql(
        f"SELECT product, branch, {rnd('margin', 6)} AS margin FROM marg", "marg"
    ),
    "one_hot": sql(
        f"""SELECT order_no, line_no, {marks('product', TYPES)}, {marks('branch', REGIONS)}
  FROM lines""",
        "lines",
    ),
    "classification_report": sql(report(), "confusion"),
    "cap_floor": sql(
        f"SELECT {KEYS}, {capped('monetary_value')}, {capped('volume')} FROM feat", "feat"
    ),
    "risk_level": sql(
        f"SELECT {KEYS}, frequency, last_purchase, churn_probability, risk_level FROM risk", "risk"
    ),
    "balance_classes": sql(
        f"""SELECT {KEYS}, frequency, target FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY {digest(KEYS, 11)}, {KEYS}) AS pos,
    COUNT(*) FILTER (WHERE target = 1) OVER () AS churners FROM train WHERE frequency > 3)
WHERE target = 1 OR pos <= churners""",
        "train",
    ),
    "train_test_split": sql(
        f"""SELECT {KEYS}, CASE WHEN {number(digest(KEYS, 42))} / 16777216.0::DOUBLE < 0.2
  THEN 'test' ELSE 'train' END AS part FROM train""",
        "train",
    ),
    "allocate_shares": sql(
        f"""SELECT client_id, branch,
  CASE WHEN assignee = '{L.centre}' THEN agent ELSE assignee END AS assignee
FROM listed LEFT JOIN (SELECT client_id, {allocated()} AS agent
  FROM (SELECT client_id, COUNT(*) OVER () AS n,
      row_number() OVER (ORDER BY {digest('client_id', 10)}, client_id) AS pos
    FROM (SELECT DISTINCT client_id FROM listed WHERE assignee = '{L.centre}')))
USING (client_id)""",
        "listed",
    ),
    "assign_threshold": sql(
        f"""SELECT client_id, branch, own AS seller, sales_12m,
  CASE WHEN sales_12m > 150000 THEN own ELSE '{L.centre}' END AS assignee
FROM (SELECT list.*, CASE WHEN s_acctbal > 1000 THEN 'V' || CAST(s_nationkey AS VARCHAR)
    ELSE '{L.no_seller}' END AS own FROM list JOIN supplier ON client_id = s_suppkey)""",
        "list",
    ),
    "assign_list": sql("SELECT client_id, branch, seller, assignee FROM listed", "listed"),
    "auc_hard_label": sql(
        f"SELECT {rnd('(tp / (tp + fn) + tn / (tn + fp)) / 2', 6)} AS auc FROM confusion",
        "confusion",
    ),
    "src_window_text": f"""
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN ' ' || d || ' ' ELSE d END AS day_text,
  strftime(o_orderdate, '%m/%Y') AS month_text, kind
FROM (SELECT *, strftime(o_orderdate, '%d/%m/%Y') AS d,
    date_trunc('month', DATE '{AS_OF}') - INTERVAL 27 MONTH AS start FROM orders),
  (VALUES ('day'), ('month')) AS k(kind)
WHERE CASE kind WHEN 'day' THEN CAST(o_orderdate AS DATE) > start
  ELSE date_trunc('month', o_orderdate) >= start END""",
    "activity_increments": sql(
        " UNION ALL ".join(f"SELECT *, '{d}' AS as_of FROM act_{i}" for i, d in enumerate(MONTHS)),
        *[f"act_{i}" for i in range(len(MONTHS))],
    ),
    "sales_12m_increments": sql(
        " UNION ALL ".join(
            f"""SELECT client_id, branch, {dsum('amount')} AS sales_12m, '{d}' AS as_of FROM raw_{i}
WHERE sale_date >= (SELECT max(period) FROM raw_{i}) - INTERVAL 11 MONTH GROUP BY client_id, branch"""
            for i, d in enumerate(MONTHS)
        ),
        *[f"raw_{i}" for i in range(len(MONTHS))],
    ),
    "last_transaction_increments": sql(
        " UNION ALL ".join(
            f"""SELECT {KEYS}, max(period) AS ref_period, '{d}' AS as_of FROM act_{i}
WHERE period >= (SELECT max(period) FROM act_{i}) - INTERVAL 12 MONTH GROUP BY {KEYS}"""
            for i, d in enumerate(MONTHS)
        ),
        *[f"act_{i}" for i in range(len(MONTHS))],
    ),
    "sink_commit": sql(
        f"""SELECT state, "table", country, period, COUNT(*) AS rows,
  {dsum('monetary_value')} AS monetary_value
FROM ({RESULTS}) r
JOIN (VALUES ('first', '200106'), ('failed', '200106'), ('second', '200106'), ('second', '200107'))
  AS s(state, month) ON r.period = s.month,
  (VALUES {", ".join(f"('{t}')" for t in RESULT_TABLES)}) AS t("table")
WHERE NOT ("table" = 'metrics' AND state = 'second' AND month = '200106')
GROUP BY state, "table", country, period""",
        "act",
    ),
    "feedback_quarantine": sql(
        f"""SELECT client_id, row_no, {NOTES.replace('"Estado"', OLD_STATE)}, branch AS country,
  CASE WHEN branch IN ('AMERICA', 'EUROPE') THEN 'lacks {", ".join(NOTE_COLUMNS[-2:])}' END
    AS reason FROM oldlist""",
        "oldlist",
    ),
    "quantile_sketch": sql(
        " UNION ALL ".join(
            f"""SELECT branch, {p}::DOUBLE AS prob, COUNT(*) AS n,
  {rnd(f"quantile_cont(monetary_value, {p})", 4)} AS exact, true AS within FROM act GROUP BY branch"""
            for p in (0.001, 0.25, 0.5, 0.75, 0.999)
        ),
        "act",
    ),
    "model_samples": sql(f"SELECT {KEYS}, target, fold, rung FROM sampled", "sampled"),
    "model_rungs": sql(
        " UNION ALL ".join(
            f"""SELECT {rung}::INTEGER AS rung, {draws}::INTEGER AS draws,
  COUNT(*) FILTER (WHERE rung <= {rung}) AS rows,
  CAST(COALESCE(SUM(target) FILTER (WHERE rung <= {rung}), 0) AS BIGINT) AS churners FROM sampled"""
            for rung, draws in enumerate(GRID.survivors())
        ),
        "sampled",
    ),
    "model_learns": sql(
        f"""SELECT {KEYS}, frequency, target, target AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY target ORDER BY {digest(KEYS, 11)}, {KEYS}) AS pos,
    COUNT(*) FILTER (WHERE target = 1) OVER () AS churners
  FROM (SELECT *, CAST(frequency >= 5 AS BIGINT) AS target FROM tfeat WHERE frequency > 3))
WHERE (target = 1 OR pos <= churners)
  AND {number(digest(KEYS, 42))} / 16777216.0::DOUBLE < 0.2""",
        "tfeat",
    ),
    "model_reload": sql(
        f"""SELECT {KEYS}, frequency, CAST(frequency >= 5 AS BIGINT) AS prediction, true AS same
FROM tfeat WHERE frequency > 3""",
        "tfeat",
    ),
    "category_dictionary": sql(
        """SELECT "column", value, n, CAST(code AS INTEGER) AS code FROM codes
WHERE "column" <> 'segment'""",
        "codes",
    ),
    "category_codes": sql(
        "SELECT product, segment, client_name, COUNT(*) AS lines, "
        + ", ".join(
            f"""any_value(CASE WHEN {c} IS NULL
  THEN (SELECT COUNT(*) FROM codes WHERE "column" = '{c}') + 1
  ELSE COALESCE((SELECT code FROM codes WHERE "column" = '{c}' AND value = {c}),
    (SELECT COUNT(*) FROM codes WHERE "column" = '{c}')) END) AS {c}_code"""
            for c in ("product", "segment", "client_name")
        )
        + " FROM raw GROUP BY product, segment, client_name",
        "raw",
        "codes",
    ),
    "mid_ranks": sql(
        f"SELECT {KEYS}, prob AS churn_probability, mid_rank FROM ranked", "ranked"
    ),
    "score_auc": sql(
        f"""SELECT n1 AS positives, n0 AS negatives,
  {rnd_once("((total - n1 * (n1 + 1) / 2.0::DOUBLE) / NULLIF(n1 * n0, 0))", 9)} AS auc
FROM (SELECT COUNT(*) FILTER (WHERE target = 1) AS n1, COUNT(*) FILTER (WHERE target = 0) AS n0,
  SUM(mid_rank) FILTER (WHERE target = 1) AS total FROM ranked)""",
        "ranked",
    ),
    "churn_rate": sql(
        f"""SELECT COUNT(*) AS rows, COUNT(*) FILTER (WHERE target = 1) AS churners,
  {rnd('COUNT(*) FILTER (WHERE target = 1) / COUNT(*)::DOUBLE', 6)} AS churn_rate,
  {rnd('COUNT(*) FILTER (WHERE target = 0) / COUNT(*)::DOUBLE', 6)} AS loyal_rate
  FROM train WHERE frequency > 3""",
        "train",
    ),
    "client_list": sql(LIST + "list", "list"),
    "client_targets": sql(LIST + "targets", "targets"),
    "target_detail": sql(
        f"""SELECT {KEYS}, risk_level, churn_probability, total_value FROM risk
  WHERE client_id IN (SELECT client_id FROM targets)""",
        "risk",
        "targets",
    ),
    "carry_over": sql(
        f"""SELECT client_id, branch, {", ".join(
            f'CASE WHEN o.client_id IS NULL THEN {chr(39) * 2} ELSE o."{c}" END AS "{c}"'
            for c in NOTE_COLUMNS)}
FROM targets LEFT JOIN (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY client_id
    ORDER BY row_no DESC) AS pos FROM oldlist
  WHERE "Estado" IS NOT NULL
    AND motivo_contacto_fallido IS DISTINCT FROM '{L.not_at_risk_reason}') WHERE pos = 1) o
  USING (client_id)""".replace("SELECT client_id, branch,", "SELECT client_id, targets.branch,"),
        "targets",
        "oldlist",
    ),
    "sink_roundtrip": sql(RESULTS, "act"),
    "feedback_load": sql(
        f"SELECT client_id, row_no, {NOTES}, branch AS country, 1 AS rejected FROM oldlist", "oldlist"
    ),
    "export_bands": sql(
        f"SELECT client_id, client_name, seller, band, branch AS country FROM {BANDED}",
        "list",
        "risk",
    ),
}

for _name, _columns in TOTALS.items():
    if _columns:
        _new = ", ".join(f"{rnd(c, 4)} AS {c}" for c in _columns)
        ORACLE[_name] = f"SELECT * REPLACE ({_new}) FROM ({ORACLE[_name]})"
