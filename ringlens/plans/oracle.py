"""Independent DuckDB SQL for every registered query (the correctness oracle).

Each query is written from the definitions, not generated from the Spark plans. The tables are the driver's
views (``lineitem``, ``orders``, ``supplier`` ...). Doubles are rounded exactly like the Spark side
(see ``plans.catalog.BIG``).
"""

from __future__ import annotations

from ringlens.config import ClusterConfig, HeatConfig, RingSpec


def _round_select(cols: list[tuple[str, int | None]], src: str) -> str:
    parts = [f"round({c}, {p}) AS {c}" if p is not None else c for c, p in cols]
    return f"SELECT {', '.join(parts)} FROM {src}"


REPAIR = "CASE WHEN {w} IS NULL OR isnan({w}) OR isinf({w}) OR {w} <= 0 THEN 1.0 ELSE {w} END"

RF_LABEL = (
    "CASE WHEN l_returnflag = 'R' THEN 'fraud' WHEN l_returnflag = 'A' THEN 'normal' ELSE 'unknown' END"
)


def _class(bal: str) -> str:
    return f"CASE WHEN {bal} < 1000.0 THEN '1' WHEN {bal} >= 2000.0 THEN '2' ELSE '3' END"


def _edge_label(s: str, d: str) -> str:
    return (
        f"CASE WHEN {s} = '1' OR {d} = '1' THEN 'fraud' "
        f"WHEN {s} = '2' AND {d} = '2' THEN 'normal' ELSE 'unknown' END"
    )


TRADES = f"""trades AS (
  SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS src_key, 'S' || CAST(l.l_suppkey AS VARCHAR) AS dst_key,
         l.l_extendedprice AS amount, o.o_orderdate AS order_date, {RF_LABEL} AS true_label
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def _prep_from_keys(src_table: str, weight_expr: str, prefix: str = "p") -> str:
    """CTEs ``{prefix}_sel, {prefix}_pairs, {prefix}_keys, {prefix}_ids, {prefix}_edges`` for string-keyed edges."""
    w = REPAIR.format(w=weight_expr)
    return f"""{prefix}_sel AS (
  SELECT trim(src_key) AS src_key, trim(dst_key) AS dst_key, {w} AS weight, true_label FROM {src_table}
  WHERE src_key IS NOT NULL AND dst_key IS NOT NULL AND length(trim(src_key)) > 0 AND length(trim(dst_key)) > 0),
{prefix}_pairs AS (
  SELECT least(src_key, dst_key) AS src, greatest(src_key, dst_key) AS dst, true_label, max(weight) AS weight
  FROM {prefix}_sel WHERE src_key <> dst_key GROUP BY 1, 2, 3),
{prefix}_keys AS (
  SELECT node_key, CAST(row_number() OVER (ORDER BY node_key) - 1 AS BIGINT) AS node_id
  FROM (SELECT src AS node_key FROM {prefix}_pairs UNION SELECT dst FROM {prefix}_pairs)),
{prefix}_ids AS (
  SELECT ks.node_id AS src, kd.node_id AS dst, p.weight, p.true_label
  FROM {prefix}_pairs p JOIN {prefix}_keys ks ON p.src = ks.node_key JOIN {prefix}_keys kd ON p.dst = kd.node_key),
{prefix}_edges AS (
  SELECT src, dst, weight, true_label,
         round(weight / (SELECT CASE WHEN max(weight) > 0 THEN max(weight) ELSE 1.0 END FROM {prefix}_ids), 6)
           AS weight_norm
  FROM {prefix}_ids)"""


def _star(member: str, prefix: str) -> str:
    return f"""{prefix}_li AS (SELECT l_orderkey, {member} AS member, l_extendedprice, l_returnflag FROM lineitem),
{prefix}_anchor AS (SELECT l_orderkey, min(member) AS anchor FROM {prefix}_li GROUP BY 1),
{prefix}_star AS (SELECT a.anchor, li.* FROM {prefix}_li li JOIN {prefix}_anchor a USING (l_orderkey))"""


CO_SUPPLY_RAW = (
    _star("l_suppkey", "cs")
    + f""",
scls AS (SELECT s_suppkey AS tx_id, {_class('s_acctbal')} AS class FROM supplier),
cs_raw AS (
  SELECT s.anchor AS src, s.member AS dst, s.l_extendedprice AS weight, {_edge_label('sc.class', 'dc.class')} AS true_label
  FROM cs_star s LEFT JOIN scls sc ON sc.tx_id = s.anchor LEFT JOIN scls dc ON dc.tx_id = s.member)"""
)

CO_PURCHASE_RAW = (
    _star("l_partkey", "cp")
    + f""",
cp_raw AS (SELECT anchor AS src, member AS dst, l_extendedprice AS weight, {RF_LABEL} AS true_label FROM cp_star)"""
)


def _typed_prep(raw: str, prefix: str) -> str:
    w = REPAIR.format(w="weight")
    return f"""{prefix}_pairs AS (
  SELECT least(src, dst) AS src, greatest(src, dst) AS dst, true_label, max({w}) AS weight
  FROM {raw} WHERE src IS NOT NULL AND dst IS NOT NULL AND src <> dst GROUP BY 1, 2, 3),
{prefix}_edges AS (
  SELECT src, dst, weight, true_label,
         round(weight / (SELECT CASE WHEN max(weight) > 0 THEN max(weight) ELSE 1.0 END FROM {prefix}_pairs), 6)
           AS weight_norm
  FROM {prefix}_pairs)"""


CS_EDGES = CO_SUPPLY_RAW + ",\n" + _typed_prep("cs_raw", "cs")
CP_EDGES = CO_PURCHASE_RAW + ",\n" + _typed_prep("cp_raw", "cp")

ASSIGN = """assign AS (
  SELECT s_suppkey AS id, CAST(s_nationkey AS INTEGER) AS cluster FROM supplier
  WHERE s_suppkey IN (SELECT src FROM cs_edges UNION SELECT dst FROM cs_edges))"""


def _clusters(cfg: ClusterConfig) -> str:
    return f"""enr AS (
  SELECT e.*, a1.cluster AS src_cluster, a2.cluster AS dst_cluster, a1.cluster = a2.cluster AS same_cluster
  FROM cs_edges e LEFT JOIN assign a1 ON e.src = a1.id LEFT JOIN assign a2 ON e.dst = a2.id),
intra AS (SELECT * FROM enr WHERE same_cluster),
sizes AS (SELECT cluster, count(*) AS n_nodes FROM assign GROUP BY 1),
estats AS (
  SELECT src_cluster AS cluster, count(*) AS n_edges, sum(weight) AS total_volume, avg(weight) AS avg_weight,
         stddev_samp(weight) AS std_weight, min(weight) AS min_weight, max(weight) AS max_weight
  FROM intra GROUP BY 1),
m0 AS (
  SELECT s.cluster, s.n_nodes, CAST(coalesce(e.n_edges, 0) AS BIGINT) AS n_edges,
         coalesce(e.total_volume, 0.0) AS total_volume, coalesce(e.avg_weight, 0.0) AS avg_weight,
         coalesce(e.std_weight, 0.0) AS std_weight, coalesce(e.min_weight, 0.0) AS min_weight,
         coalesce(e.max_weight, 0.0) AS max_weight, CAST(s.n_nodes * (s.n_nodes - 1) / 2 AS DOUBLE) AS max_possible_edges
  FROM sizes s LEFT JOIN estats e ON s.cluster = e.cluster),
m1 AS (
  SELECT *, CASE WHEN max_possible_edges > 0 THEN n_edges / max_possible_edges ELSE 0.0 END AS internal_density,
         CASE WHEN avg_weight > 0 THEN std_weight / avg_weight ELSE 999.0 END AS coeff_variation,
         CASE WHEN n_nodes > 0 THEN total_volume / n_nodes ELSE 0.0 END AS volume_per_node
  FROM m0),
metrics AS (
  SELECT *, CASE WHEN (SELECT max(volume_per_node) FROM m1) > 0
                 THEN volume_per_node / (SELECT max(volume_per_node) FROM m1) ELSE 0.0 END AS volume_per_node_norm
  FROM m1),
scored0 AS (
  SELECT *, 1.0 / (1.0 + coeff_variation) AS uniformity_score,
         round({cfg.density_weight} * internal_density + {cfg.uniformity_weight} * (1.0 / (1.0 + coeff_variation))
               + {cfg.volume_weight} * volume_per_node_norm, 6) AS fraud_score
  FROM metrics),
scored AS (
  SELECT *, fraud_score >= {cfg.fraud_score_threshold} AND n_nodes <= {cfg.micro_cluster_max_size}
            AND internal_density >= {cfg.min_internal_density} AS is_fraud_ring
  FROM scored0),
nres0 AS (
  SELECT a.id AS node_id, a.cluster, s.fraud_score, coalesce(s.is_fraud_ring, false) AS is_fraud_ring
  FROM assign a LEFT JOIN scored s ON a.cluster = s.cluster),
nlab AS (
  SELECT node_id, min(true_label) AS true_label FROM (
    SELECT src AS node_id, true_label FROM cs_edges UNION ALL SELECT dst, true_label FROM cs_edges)
  WHERE true_label IS NOT NULL AND true_label NOT IN ('normal', 'unknown') GROUP BY 1),
nres AS (
  SELECT r.*, l.true_label, (l.true_label IS NOT NULL AND l.true_label <> 'normal') AS true_fraud
  FROM nres0 r LEFT JOIN nlab l ON r.node_id = l.node_id),
conf AS (
  SELECT count_if(is_fraud_ring AND true_fraud) AS tp, count_if(is_fraud_ring AND NOT true_fraud) AS fp,
         count_if(NOT is_fraud_ring AND true_fraud) AS fn, count_if(NOT is_fraud_ring AND NOT true_fraud) AS tn
  FROM nres),
prf AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall
  FROM conf),
prf1 AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2.0 * precision * recall / (precision + recall) ELSE 0.0 END AS f1
  FROM prf)"""


METRIC_COLS = [
    ("cluster", None), ("n_nodes", None), ("n_edges", None), ("total_volume", 4), ("avg_weight", 4),
    ("std_weight", 4), ("min_weight", 6), ("max_weight", 6), ("max_possible_edges", 6),
    ("internal_density", 6), ("coeff_variation", 6), ("volume_per_node", 4), ("volume_per_node_norm", 6),
]


# The default cooling schedule, 1.2 to 0.2 in six steps.
TAUS = (1.2, 1.0, 0.8, 0.6, 0.4, 0.2)


def _heat(cfg: HeatConfig) -> str:
    """The annealing step by step: multiply, take the step's maximum, divide by it unless it is tiny."""
    scale = max(cfg.distance_scale, 1e-6)
    steps = ["h0 AS MATERIALIZED (SELECT *, weight_norm AS w0 FROM hedges)"]
    for i, tau in enumerate(TAUS, start=1):
        steps.append(
            f"g{i} AS MATERIALIZED (SELECT *, w{i - 1} * exp(-pow((src_risk - dst_risk) / {scale!r}, 2.0) / {tau!r}) "
            f"* (1.0 + {cfg.faulty_edge_boost!r} * greatest(src_faulty, dst_faulty)) AS r{i} FROM h{i - 1})"
        )
        steps.append(f"s{i} AS MATERIALIZED (SELECT CASE WHEN max(r{i}) > 1e-9 THEN max(r{i}) ELSE 1.0 END AS top FROM g{i})")
        steps.append(f"h{i} AS MATERIALIZED (SELECT *, r{i} / (SELECT top FROM s{i}) AS w{i} FROM g{i})")
    chain = ",\n".join(steps)
    q = cfg.faulty_quantile
    return f"""obs AS (SELECT src AS node_id, weight FROM cs_edges UNION ALL SELECT dst, weight FROM cs_edges),
ns AS (SELECT node_id, count(*) AS degree, avg(weight) AS avg_weight FROM obs GROUP BY 1),
mom AS (
  SELECT coalesce(avg(degree), 0.0) AS dm,
         CASE WHEN stddev_samp(degree) IS NULL OR stddev_samp(degree) <= 1e-9 THEN 1.0 ELSE stddev_samp(degree) END AS ds,
         coalesce(avg(avg_weight), 0.0) AS wm,
         CASE WHEN stddev_samp(avg_weight) IS NULL OR stddev_samp(avg_weight) <= 1e-9 THEN 1.0
              ELSE stddev_samp(avg_weight) END AS ws
  FROM ns),
rz AS (
  SELECT ns.*, (degree - (SELECT dm FROM mom)) / (SELECT ds FROM mom) AS degree_z,
         (avg_weight - (SELECT wm FROM mom)) / (SELECT ws FROM mom) AS weight_z
  FROM ns),
risk AS (
  SELECT *, 0.5 * degree_z + 0.5 * weight_z AS risk_raw, 1.0 / (1.0 + exp(-(0.5 * degree_z + 0.5 * weight_z))) AS node_risk
  FROM rz),
frisk AS (
  SELECT *, CAST(node_risk >= (SELECT quantile_disc(node_risk, {q!r}) FROM risk) AS INTEGER) AS is_faulty_node FROM risk),
hedges AS (
  SELECT e.*, coalesce(a.node_risk, 0.0) AS src_risk, coalesce(b.node_risk, 0.0) AS dst_risk,
         coalesce(a.is_faulty_node, 0) AS src_faulty, coalesce(b.is_faulty_node, 0) AS dst_faulty
  FROM cs_edges e LEFT JOIN frisk a ON e.src = a.node_id LEFT JOIN frisk b ON e.dst = b.node_id),
{chain},
hw AS (SELECT * FROM h{len(TAUS)})"""


def _heat_history(cfg: HeatConfig) -> str:
    hot = cfg.hot_threshold
    parts = []
    for i, tau in enumerate(TAUS, start=1):
        parts.append(
            f"SELECT {i} AS iteration, CAST({round(float(tau), 6)!r} AS DOUBLE) AS tau, round(coalesce(sum(w{i}), 0.0), 6) AS heat_mass, "
            f"round(coalesce(avg(w{i}), 0.0), 6) AS heat_mean, CAST(count_if(w{i} >= {hot!r}) AS BIGINT) AS hot_edges, "
            f"CASE WHEN count(*) > 0 THEN round(count_if(w{i} >= {hot!r}) / count(*), 6) ELSE 0.0 END AS hot_edge_ratio, "
            f"round(coalesce(sum(CASE WHEN w{i} >= {hot!r} THEN w{i} ELSE 0.0 END), 0.0), 6) AS hot_area_mass FROM hw"
        )
    return "\nUNION ALL\n".join(parts)


def _heat_frames(cfg: HeatConfig) -> str:
    parts = []
    for i, tau in enumerate(TAUS, start=1):
        parts.append(
            f"(SELECT {i} AS iteration, CAST({round(float(tau), 6)!r} AS DOUBLE) AS tau, src, dst, round(w{i}, 6) AS weight, "
            f"round(src_risk, 6) AS src_risk, round(dst_risk, 6) AS dst_risk, src_faulty, dst_faulty FROM hw "
            f"WHERE w{i} >= {cfg.frame_min_weight!r} ORDER BY w{i} DESC, src, dst LIMIT {cfg.frame_max_edges})"
        )
    return "\nUNION ALL\n".join(parts)


def _power_iteration(steps: int) -> str:
    ctes = [
        """pa_both AS (SELECT src AS i, dst AS j, weight_norm AS w FROM cs_edges UNION ALL
             SELECT dst AS i, src AS j, weight_norm AS w FROM cs_edges)""",
        "pa_deg AS (SELECT i, sum(w) AS d FROM pa_both GROUP BY 1)",
        "pa AS (SELECT b.i, b.j, CASE WHEN d.d > 0 THEN b.w / d.d ELSE 0.0 END AS a FROM pa_both b JOIN pa_deg d ON b.i = d.i)",
        "v0 AS (SELECT DISTINCT i AS id, CAST(((i % 104729) * 7919 % 104729 + 1) AS DOUBLE) / 104729 AS v FROM pa)",
    ]
    for s in range(1, steps + 1):
        ctes.append(
            f"v{s} AS (SELECT pa.i AS id, sum(pa.a * v{s - 1}.v) AS v FROM pa JOIN v{s - 1} ON pa.j = v{s - 1}.id GROUP BY 1)"
        )
    return ",\n".join(ctes) + f"""
SELECT id, round(v / (SELECT sum(abs(v)) FROM v{steps}), 9) AS v FROM v{steps}"""


def _power_iteration_stop(max_steps: int, epsilon: float, history: bool) -> str:
    """Steps one by one with every vector scaled, their changes, and the first step whose acceleration is under the threshold."""
    chain = _power_iteration(0).split("\nSELECT")[0]
    ctes = ["x0 AS MATERIALIZED (SELECT id, v / (SELECT sum(v) FROM v0) AS v FROM v0)"]
    for t in range(1, max_steps + 1):
        ctes.append(f"y{t} AS MATERIALIZED (SELECT pa.i AS id, sum(pa.a * x.v) AS v FROM pa JOIN x{t - 1} x ON pa.j = x.id GROUP BY 1)")
        ctes.append(f"x{t} AS MATERIALIZED (SELECT id, v / (SELECT sum(v) FROM y{t}) AS v FROM y{t})")
    changes = " UNION ALL ".join(f"SELECT {t} AS step, sum(abs(a.v - b.v)) AS change FROM x{t} a JOIN x{t - 1} b USING (id)" for t in range(1, max_steps + 1))
    ctes.append(f"ch AS ({changes})")
    ctes.append("acc AS (SELECT step, change, abs(change - lag(change) OVER (ORDER BY step)) AS acceleration FROM ch)")
    ctes.append(f"hit AS (SELECT min(step) AS step FROM acc WHERE acceleration <= {epsilon!r} / (SELECT count(*) FROM x0))")
    ctes.append(f"fin AS (SELECT coalesce(step, {max_steps}) AS step, step IS NOT NULL AS converged FROM hit)")
    if history:
        last = "SELECT step, round(change, 12) AS change, round(acceleration, 12) AS acceleration FROM acc WHERE step <= (SELECT step FROM fin)"
    else:
        last = " UNION ALL ".join(
            f"SELECT id, round(v, 9) AS v, {t} AS steps, (SELECT converged FROM fin) AS converged FROM x{t} WHERE (SELECT step FROM fin) = {t}"
            for t in range(1, max_steps + 1)
        )
    return chain + ",\n" + ",\n".join(ctes) + "\n" + last


def _best_runs(src: str, top: int) -> str:
    """The best k-means clusters of the values of ``src`` (g, id, v) in each group g: for every k the runs of sorted values, found by trying every last
    cluster after every best shorter division; values that are equal are not divided."""
    ctes = [
        f"kz AS MATERIALIZED (SELECT g, id, v, row_number() OVER (PARTITION BY g ORDER BY v, id) AS i, (v - min(v) OVER (PARTITION BY g)) / "
        f"(max(v) OVER (PARTITION BY g) - min(v) OVER (PARTITION BY g)) AS z FROM {src})",
        "kp AS MATERIALIZED (SELECT g, i, sum(z) OVER w AS s, sum(z * z) OVER w AS q, coalesce(lead(v) OVER w > v, true) AS free FROM kz "
        "WINDOW w AS (PARTITION BY g ORDER BY i) UNION ALL SELECT DISTINCT g, 0, 0.0, 0.0, true FROM kz)",
        "kc AS MATERIALIZED (SELECT a.g, a.i AS i, b.i AS j, greatest(b.q - a.q - pow(b.s - a.s, 2) / (b.i - a.i), 0.0) AS cost FROM kp a JOIN kp b "
        "ON a.g = b.g AND a.i < b.i WHERE a.free)",
        "kd1 AS MATERIALIZED (SELECT g, j, cost, [i] AS path FROM kc WHERE i = 0)",
    ]
    for k in range(2, top + 1):
        ctes.append(
            f"kd{k} AS MATERIALIZED (SELECT c.g, c.j, min(d.cost + c.cost) AS cost, arg_min(list_append(d.path, c.i), d.cost + c.cost) AS path "
            f"FROM kd{k - 1} d JOIN kc c ON c.g = d.g AND c.i = d.j GROUP BY 1, 2)"
        )
    return ",\n".join(ctes)


def _runs_of(k: int) -> str:
    return (
        f"SELECT z.g, z.id, z.v, {k} AS k, len(list_filter(d.path, lambda s: s < z.i)) - 1 AS cluster FROM kz z JOIN kd{k} d "
        f"ON d.g = z.g AND d.j = (SELECT max(j) FROM kd1 m WHERE m.g = z.g)"
    )


def _choose_k(steps: int, ks: tuple[int, ...]) -> str:
    chain, last = _power_iteration(steps).rsplit("\nSELECT", 1)
    runs = " UNION ALL ".join(_runs_of(k) for k in ks)
    return f"""{chain},
emb AS MATERIALIZED (SELECT 0 AS g, id, v / (SELECT sum(abs(v)) FROM v{steps}) AS v FROM v{steps}),
{_best_runs('emb', max(ks))},
runs AS MATERIALIZED ({runs}),
means AS (SELECT k, cluster, avg(v) AS mean FROM runs GROUP BY 1, 2),
away AS (
  SELECT r.k, r.id, min(abs(r.v - m.mean)) FILTER (m.cluster = r.cluster) AS a, min(abs(r.v - m.mean)) FILTER (m.cluster <> r.cluster) AS b
  FROM runs r JOIN means m ON m.k = r.k GROUP BY 1, 2),
rated AS (SELECT k, avg(CASE WHEN greatest(a, b) > 0 THEN (b - a) / greatest(a, b) ELSE 0.0 END) AS score FROM away GROUP BY 1)
SELECT k, round(score, 6) AS score, k = first_value(k) OVER (ORDER BY round(score, 12) DESC, k) AS chosen FROM rated"""


def _main_nations(name: str, where: str) -> str:
    return f"""{name} AS (
  SELECT id, min(nation) AS cluster FROM (
    SELECT l_suppkey AS id, c_nationkey AS nation, count(*) AS n, max(count(*)) OVER (PARTITION BY l_suppkey) AS top
    FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey WHERE {where} GROUP BY 1, 2)
  WHERE n = top GROUP BY 1)"""


MONTHLY_DENSITY = """ms AS (
  SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS slice, anchor AS src, l_suppkey AS dst
  FROM lineitem JOIN (SELECT l_orderkey AS k, min(l_suppkey) AS anchor FROM lineitem GROUP BY 1) ON k = l_orderkey JOIN orders ON o_orderkey = l_orderkey
  WHERE anchor <> l_suppkey),
md AS (
  SELECT slice, cluster, count(DISTINCT id) AS n_nodes, any_value(n) AS n_edges,
    CASE WHEN count(DISTINCT id) > 1 THEN any_value(n) / (count(DISTINCT id) * (count(DISTINCT id) - 1) / 2.0) ELSE 0.0 END AS internal_density
  FROM (
    SELECT slice, id, CAST(s_nationkey AS INTEGER) AS cluster, (
      SELECT count(*) FROM ms i JOIN supplier a ON a.s_suppkey = i.src JOIN supplier b ON b.s_suppkey = i.dst
      WHERE i.slice = e.slice AND a.s_nationkey = b.s_nationkey AND a.s_nationkey = s.s_nationkey) AS n
    FROM (SELECT slice, src AS id FROM ms UNION SELECT slice, dst FROM ms) e JOIN supplier s ON s_suppkey = id)
  GROUP BY 1, 2)"""

RECENT_ACTIVITY = """SELECT payer, "at", n_now, n_recent, round(CAST(amount_recent AS DOUBLE), 4) AS amount_recent,
  CASE WHEN n_now > 1 THEN 0 WHEN "at" - prev <= 90 * 86400 THEN "at" - prev END AS gap
FROM (
  SELECT payer, "at", n_now, lag("at") OVER (PARTITION BY payer ORDER BY "at") AS prev,
    sum(n_now) OVER w AS n_recent, sum(a) OVER w AS amount_recent
  FROM (SELECT o_custkey AS payer, CAST(epoch(o_orderdate) AS BIGINT) AS "at", count(*) AS n_now, sum(CAST(o_totalprice AS DECIMAL(28, 4))) AS a FROM orders GROUP BY 1, 2)
  WINDOW w AS (PARTITION BY payer ORDER BY "at" RANGE BETWEEN 7776000 PRECEDING AND CURRENT ROW))"""

COMPOSITE_WEIGHTS = """WITH t AS (
  SELECT l_orderkey AS transfer, l_linenumber AS line, o_custkey AS payer, l_extendedprice AS amount, o_orderdate AS booked,
    CASE WHEN cn.n_nationkey = sn.n_nationkey THEN 1.0 WHEN cn.n_regionkey = sn.n_regionkey THEN 0.5 ELSE 0.0 END AS place_closeness
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey
  JOIN nation cn ON cn.n_nationkey = c_nationkey JOIN nation sn ON sn.n_nationkey = s_nationkey),
w AS (
  SELECT *, count(*) OVER r AS n_recent, CAST(sum(CAST(amount AS DECIMAL(28, 4))) OVER r AS DOUBLE) AS amount_recent,
    count(*) OVER (PARTITION BY payer, booked) AS n_now,
    max(booked) OVER (PARTITION BY payer ORDER BY booked RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 SECOND PRECEDING) AS prev
  FROM t WINDOW r AS (PARTITION BY payer ORDER BY booked RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)),
f AS (
  SELECT *, amount / (SELECT max(amount) FROM t) AS amount_norm,
    CASE WHEN n_now > 1 THEN 1.0 WHEN prev IS NULL THEN 0.0 ELSE 1.0 - epoch(booked - prev) / 2592000.0 END AS time_proximity,
    CASE WHEN n_recent >= 8 OR amount_recent >= 400000.0 THEN 1.0 ELSE 0.0 END AS velocity_flag
  FROM w)
SELECT transfer, line, payer, n_recent, round(amount_recent, 4) AS amount_recent, round(amount_norm, 6) AS amount_norm, round(CAST(time_proximity AS DOUBLE), 6) AS time_proximity,
  CAST(place_closeness AS DOUBLE) AS place_closeness, CAST(velocity_flag AS DOUBLE) AS velocity_flag,
  round(CAST(0.4 AS DOUBLE) * amount_norm + CAST(0.2 AS DOUBLE) * time_proximity + CAST(0.2 AS DOUBLE) * place_closeness + CAST(0.2 AS DOUBLE) * velocity_flag, 6) AS weight
FROM f"""

# exact counts; that the sketches keep their errors is computed on the Spark side against exact counts and ranks
STEP_SKETCHES = """SELECT label, count(*) AS n_edges, count(l_extendedprice) AS n_weights, count(DISTINCT o_custkey) AS payers, count(DISTINCT s_nationkey) AS nations,
  true AS payers_kept, true AS nations_kept, true AS quantile0_kept, true AS quantile1_kept, true AS quantile2_kept
FROM (
  SELECT *, unnest([strftime(o_orderdate, '%Y-%m'), strftime(o_orderdate, '%Y'), 'all']) AS label
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey JOIN supplier ON s_suppkey = l_suppkey)
GROUP BY 1"""

# the cumulative sums one slice after the other, as they are defined
DENSITY_DRIFT = f"""WITH RECURSIVE {MONTHLY_DENSITY},
d AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY slice) AS nth, internal_density - lag(internal_density) OVER (PARTITION BY cluster ORDER BY slice) AS change FROM md),
x AS (SELECT cluster, avg(internal_density) AS expected FROM d WHERE nth <= 12 GROUP BY 1),
c AS (
  SELECT d.cluster, nth, expected, greatest(0.0, expected - internal_density - 0.02) AS down, greatest(0.0, internal_density - expected - 0.02) AS up FROM d JOIN x USING (cluster) WHERE nth = 1
  UNION ALL
  SELECT c.cluster, d.nth, expected, greatest(0.0, down + expected - internal_density - 0.02), greatest(0.0, up + internal_density - expected - 0.02)
  FROM c JOIN d ON d.cluster = c.cluster AND d.nth = c.nth + 1)
SELECT slice, d.cluster, n_nodes, n_edges, round(internal_density, 6) AS internal_density, round(change, 6) AS change, round(expected, 6) AS expected,
  round(down, 6) AS cusum_down, round(up, 6) AS cusum_up, round(down, 9) > 0.5 OR round(up, 9) > 0.5 AS alarm
FROM d JOIN c ON c.cluster = d.cluster AND c.nth = d.nth"""


def _alert_table(days: tuple[str, ...], density: float) -> str:
    values = ", ".join(f"(DATE '{day}')" for day in days)
    return f"""WITH {MONTHLY_DENSITY},
seen AS (SELECT day, cluster, n_nodes, internal_density FROM md JOIN (VALUES {values}) v(day) ON slice = day - INTERVAL 1 MONTH WHERE internal_density >= {density!r})
SELECT cluster, min(day) AS first_seen, max(day) AS last_seen, count(*) AS n_days, max(day) = (SELECT max(day) FROM (VALUES {values}) v(day)) AS open,
  arg_max(n_nodes, day) AS n_nodes, round(arg_max(internal_density, day), 6) AS internal_density
FROM seen GROUP BY 1"""


def _cluster_matching(split: str, min_jaccard: float) -> str:
    return f"""WITH {_main_nations('old', f"o_orderdate < TIMESTAMP '{split}'")},
{_main_nations('new', f"o_orderdate >= TIMESTAMP '{split}'")},
os AS (SELECT cluster, count(*) AS n FROM old GROUP BY 1), ns AS (SELECT cluster, count(*) AS n FROM new GROUP BY 1),
ov AS (
  SELECT a.cluster AS o, b.cluster AS w, count(*) AS common, any_value(os.n) AS old_n, any_value(ns.n) AS new_n,
    count(*) / (any_value(os.n) + any_value(ns.n) - count(*)) AS j
  FROM old a JOIN new b USING (id) JOIN os ON os.cluster = a.cluster JOIN ns ON ns.cluster = b.cluster GROUP BY 1, 2),
kept AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o ORDER BY j DESC, w) AS ro, row_number() OVER (PARTITION BY w ORDER BY j DESC, o) AS rw FROM ov)
  WHERE ro = 1 AND rw = 1 AND j >= {min_jaccard!r})
SELECT 'kept' AS status, o AS old_cluster, w AS new_cluster, common, old_n AS old_nodes, new_n AS new_nodes, round(j, 6) AS jaccard FROM kept
UNION ALL SELECT 'died', cluster, NULL, 0, n, 0, 0.0 FROM os WHERE cluster NOT IN (SELECT o FROM kept)
UNION ALL SELECT 'born', NULL, cluster, 0, 0, n, 0.0 FROM ns WHERE cluster NOT IN (SELECT w FROM kept)"""


def _deliveries(ends: tuple[str, ...], lateness_days: int) -> str:
    """The feed, the watermark before each delivery, the transfers that count, and the edges of every window."""
    delivery = " + ".join(f"CAST(arrived >= TIMESTAMP '{end}' AS INTEGER)" for end in ends)
    return f"""feed AS (
  SELECT 'C' || o_custkey AS payer, 'D' || (o_orderkey % 97) AS depot, o_totalprice AS amount, o_orderdate AS booked, o_orderstatus AS status,
    {delivery} AS delivery
  FROM (SELECT *, o_orderdate + to_days(CAST(o_orderkey * 7 % 11 + CASE WHEN o_orderkey % 50 = 3 THEN 500 ELSE 0 END + again AS INTEGER)) AS arrived
        FROM orders, (VALUES (0), (2)) x(again) WHERE again = 0 OR o_orderkey % 13 = 0)),
marks AS (SELECT delivery, max(max(booked)) OVER (ORDER BY delivery) - to_days({lateness_days}) AS closes FROM feed GROUP BY 1),
counted AS (
  SELECT payer, depot, amount, status, booked, min(feed.delivery) AS delivery FROM feed LEFT JOIN marks m ON m.delivery = feed.delivery - 1
  WHERE m.closes IS NULL OR booked > m.closes GROUP BY ALL),
win AS (
  SELECT date_trunc('day', booked) - to_days(CAST(back AS INTEGER)) AS window_start, date_trunc('day', booked) - to_days(CAST(back AS INTEGER)) + to_days(7) AS window_end,
    least(payer, depot) AS src, greatest(payer, depot) AS dst, status AS true_label, amount
  FROM counted, range(0, 7) r(back)),
wedges AS MATERIALIZED (
  SELECT window_start, window_end, src, dst, true_label, max(amount) AS weight, count(*) AS n_transfers, sum(amount) AS volume
  FROM win WHERE window_end <= (SELECT max(closes) FROM marks) GROUP BY ALL)"""


def _reclustered(ends: tuple[str, ...], lateness_days: int, steps: int, k: int) -> str:
    """The newest closed window after each delivery: its embedding step by step and its best k clusters."""
    chain = [
        "chosen AS (SELECT max(window_end) AS g FROM wedges JOIN marks ON window_end <= closes GROUP BY delivery)",
        "ce AS MATERIALIZED (SELECT DISTINCT window_end AS g, src, dst, true_label, weight, round(weight / max(weight) OVER (PARTITION BY window_end), 6) AS w "
        "FROM wedges WHERE window_end IN (SELECT g FROM chosen))",
        "nk AS (SELECT g, k, row_number() OVER (PARTITION BY g ORDER BY k) - 1 AS id FROM (SELECT g, src AS k FROM ce UNION SELECT g, dst FROM ce))",
        "cb AS (SELECT g, src AS i, dst AS j, w FROM ce UNION ALL SELECT g, dst, src, w FROM ce)",
        "ca AS MATERIALIZED (SELECT g, i, j, w / sum(w) OVER (PARTITION BY g, i) AS a FROM cb)",
        "e0 AS (SELECT g, k, CAST((id % 104729) * 7919 % 104729 + 1 AS DOUBLE) / 104729 AS v FROM nk)",
    ]
    for t in range(1, steps + 1):
        chain.append(f"e{t} AS MATERIALIZED (SELECT ca.g, ca.i AS k, sum(ca.a * e.v) AS v FROM ca JOIN e{t - 1} e ON e.g = ca.g AND e.k = ca.j GROUP BY 1, 2)")
    chain.append(f"emb AS MATERIALIZED (SELECT g, k AS id, v / sum(abs(v)) OVER (PARTITION BY g) AS v FROM e{steps})")
    return f"""WITH {_deliveries(ends, lateness_days)},
{', '.join(chain)},
{_best_runs('emb', k)}
SELECT g AS window_end, id AS node_key, round(v, 9) AS v, CAST(cluster AS INTEGER) AS cluster FROM ({_runs_of(k)})"""


def _etl_sources() -> str:
    return f"""etl_e AS (
  SELECT 'C' || CAST(o.o_custkey AS VARCHAR) AS src_id, 'S' || CAST(l.l_suppkey AS VARCHAR) AS dst_id
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
etl_c AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS tx_id, {_class('c_acctbal')} AS class FROM customer
  UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), {_class('s_acctbal')} FROM supplier),
etl_f AS (
  SELECT 'C' || CAST(c_custkey AS VARCHAR) AS tx_id, CAST(c_nationkey AS INTEGER) AS ts FROM customer
  UNION ALL SELECT 'S' || CAST(s_suppkey AS VARCHAR), CAST(s_nationkey AS INTEGER) FROM supplier),
etl_n AS (
  SELECT coalesce(t.tx_id, c.tx_id) AS tx_id, t.ts, c.class
  FROM (SELECT tx_id, max(ts) AS ts FROM etl_f GROUP BY 1) t
  FULL OUTER JOIN (
    SELECT tx_id, CASE WHEN bool_or(class = '1') THEN '1' WHEN bool_or(class = '2') THEN '2' ELSE min(class) END AS class
    FROM etl_c GROUP BY 1) c ON t.tx_id = c.tx_id),
etl_j AS (
  SELECT e.src_id, e.dst_id, a.ts AS src_ts, b.ts AS dst_ts, a.class AS src_class, b.class AS dst_class
  FROM etl_e e LEFT JOIN etl_n a ON e.src_id = a.tx_id LEFT JOIN etl_n b ON e.dst_id = b.tx_id),
etl_out AS (
  SELECT src_id, dst_id, CAST(1.0 AS DOUBLE) AS amount, CAST(greatest(src_ts, dst_ts) AS INTEGER) AS timestamp,
         {_edge_label('src_class', 'dst_class')} AS true_label
  FROM etl_j)"""


def _planted(rings: tuple[RingSpec, ...]) -> str:
    parts = []
    for r, spec in enumerate(rings):
        label = "fraud_ring_" + chr(65 + r)
        parts.append(
            f"SELECT (SELECT top FROM cs_top) + 1 + {spec.id_offset} + a.x AS src, (SELECT top FROM cs_top) + 1 + {spec.id_offset} + b.x AS dst, "
            f"'{label}' AS true_label FROM range(0, {spec.n_nodes}) a(x) JOIN range(0, {spec.n_nodes}) b(x) ON a.x < b.x"
        )
    return "\nUNION ALL\n".join(parts)


def oracle_sql(cluster_cfg: ClusterConfig | None = None, heat_cfg: HeatConfig | None = None,
               rings: tuple[RingSpec, ...] | None = None, pi_steps: int = 6) -> dict[str, str]:
    from ringlens.config import GeneratorConfig

    ccfg = cluster_cfg or ClusterConfig()
    hcfg = heat_cfg or HeatConfig()
    rings = rings if rings is not None else GeneratorConfig().rings
    cl = CS_EDGES + ",\n" + ASSIGN + ",\n" + _clusters(ccfg)
    heat = CS_EDGES + ",\n" + _heat(hcfg)
    q: dict[str, str] = {}
    q["edge_prep"] = f"WITH {TRADES},\n{_prep_from_keys('trades', 'amount')}\n" + _round_select(
        [("src", None), ("dst", None), ("weight", 6), ("true_label", None), ("weight_norm", 6)], "p_edges"
    )
    q["node_index"] = f"WITH {TRADES},\n{_prep_from_keys('trades', 'amount')}\nSELECT node_key, node_id FROM p_keys"
    q["time_slice"] = (
        f"WITH {TRADES},\nsliced AS (SELECT * FROM trades WHERE order_date >= TIMESTAMP '1996-01-01 00:00:00' "
        f"AND order_date <= TIMESTAMP '1997-12-31 00:00:00'),\n{_prep_from_keys('sliced', 'amount')}\n"
        + _round_select([("src", None), ("dst", None), ("weight", 6), ("true_label", None), ("weight_norm", 6)], "p_edges")
    )
    q["weight_repair"] = (
        "WITH w AS (SELECT 'P' || CAST(l_partkey AS VARCHAR) AS src_key, 'S' || CAST(l_suppkey AS VARCHAR) AS dst_key, "
        "l_quantity - 25.0 AS raw_weight, " + RF_LABEL + " AS true_label FROM lineitem)\n"
        "SELECT src_key, dst_key, round(" + REPAIR.format(w="raw_weight") + ", 6) AS weight, true_label FROM w"
    )
    q["edge_dedupe"] = f"WITH {CO_PURCHASE_RAW},\n{_typed_prep('cp_raw', 'cp')}\n" + _round_select(
        [("src", None), ("dst", None), ("weight", 6), ("true_label", None)], "cp_pairs"
    )
    q["weight_norm"] = f"WITH {CS_EDGES}\n" + _round_select(
        [("src", None), ("dst", None), ("weight", 6), ("true_label", None), ("weight_norm", 6)], "cs_edges"
    )
    q["cluster_sizes"] = f"WITH {CS_EDGES},\n{ASSIGN}\nSELECT cluster, count(*) AS node_count FROM assign GROUP BY 1"
    q["cluster_edge_stats"] = f"WITH {cl}\n" + _round_select(
        [("cluster", None), ("n_edges", None), ("total_volume", 4), ("avg_weight", 4), ("std_weight", 4),
         ("min_weight", 6), ("max_weight", 6)], "estats"
    )
    q["cluster_metrics"] = f"WITH {cl}\n" + _round_select(METRIC_COLS, "metrics")
    q["cluster_scores"] = f"WITH {cl}\n" + _round_select(
        METRIC_COLS + [("uniformity_score", 6), ("fraud_score", 6), ("is_fraud_ring", None)], "scored"
    )
    q["intra_cross"] = f"""WITH {cl}
SELECT count(*) AS total_edges, count_if(coalesce(same_cluster, false)) AS intra_edges,
       count(*) - count_if(coalesce(same_cluster, false)) AS cross_edges,
       round(CASE WHEN count(*) > 0 THEN count_if(coalesce(same_cluster, false)) / count(*) ELSE 0.0 END, 6) AS intra_share
FROM enr"""
    q["flagged_volume"] = f"""WITH {cl}
SELECT round(coalesce(sum(weight), 0.0), 4) AS flagged_volume FROM intra
WHERE src_cluster IN (SELECT cluster FROM scored WHERE is_fraud_ring)"""
    q["node_results"] = f"WITH {cl}\n" + _round_select(
        [("node_id", None), ("cluster", None), ("fraud_score", 6), ("is_fraud_ring", None), ("true_label", None),
         ("true_fraud", None)], "nres"
    )
    q["confusion"] = f"WITH {cl}\nSELECT tp, fp, fn, tn FROM conf"
    q["prf1"] = f"WITH {cl}\n" + _round_select(
        [("tp", None), ("fp", None), ("fn", None), ("tn", None), ("precision", 6), ("recall", 6), ("f1", 6)], "prf1"
    )
    q["run_summary"] = f"""WITH {cl}
SELECT (SELECT count(DISTINCT id) FROM assign) AS n_nodes,
       (SELECT count(*) FROM cs_edges) AS total_edges,
       round(CASE WHEN (SELECT count(DISTINCT id) FROM assign) > 1
             THEN 2.0 * (SELECT count(*) FROM cs_edges) / (CAST((SELECT count(DISTINCT id) FROM assign) AS DOUBLE)
                  * ((SELECT count(DISTINCT id) FROM assign) - 1)) ELSE 0.0 END, 6) AS graph_density,
       (SELECT count(DISTINCT cluster) FROM assign) AS n_clusters,
       (SELECT count(*) FROM scored WHERE is_fraud_ring) AS n_fraud_clusters,
       coalesce((SELECT array_to_string(list_sort(list(cluster)), ',') FROM scored WHERE is_fraud_ring), '')
         AS fraud_cluster_ids,
       (SELECT count_if(is_fraud_ring) FROM nres) AS total_nodes_flagged,
       round(coalesce((SELECT sum(weight) FROM intra WHERE src_cluster IN (SELECT cluster FROM scored WHERE is_fraud_ring)), 0.0), 4)
         AS total_volume_flagged,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, tp, fp, fn, tn
FROM prf1"""
    q["score_extract"] = f"""WITH {cl}
SELECT cluster, n_nodes, n_edges, round(internal_density, 6) AS internal_density, round(coeff_variation, 6) AS coeff_variation,
       round(fraud_score, 6) AS fraud_score, is_fraud_ring, round(total_volume, 4) AS total_volume,
       row_number() OVER (ORDER BY fraud_score DESC, cluster) - 1 AS position
FROM scored"""
    q["density_report"] = f"""WITH {cl},
shown AS (
  SELECT cluster, n_nodes, n_edges, max_possible_edges, round(internal_density, 4) AS density, round(coeff_variation, 4) AS cv,
         round(total_volume, 2) AS total_vol, round(volume_per_node, 2) AS vol_per_node
  FROM metrics)
SELECT *, row_number() OVER (ORDER BY density DESC, n_nodes, cluster) - 1 AS position FROM shown"""
    q["ordered_assignments"] = f"""WITH {CS_EDGES},\n{ASSIGN}
SELECT id, cluster, row_number() OVER (ORDER BY cluster, id) - 1 AS position FROM assign"""
    order_edges = """oe AS (
  SELECT 'C' || CAST(o_custkey AS VARCHAR) AS src_key, '00' || CAST(o_orderkey % 97 AS VARCHAR) AS dst_key, o_totalprice AS amount,
         o_orderdate AS booked, o_orderstatus AS true_label FROM orders)"""
    q["time_slice_text"] = (
        f"WITH {order_edges},\nsliced AS (SELECT * FROM oe WHERE booked >= TIMESTAMP '1996-01-01 00:00:00' "
        f"AND booked <= TIMESTAMP '1997-12-31 00:00:00'),\n{_prep_from_keys('sliced', 'amount')}\n"
        + _round_select([("src", None), ("dst", None), ("weight", 6), ("true_label", None), ("weight_norm", 6)], "p_edges")
    )
    q["file_formats"] = (
        f"WITH {order_edges},\n{_prep_from_keys('oe', 'amount')}\n"
        "SELECT f.format, src, dst, round(weight, 6) AS weight, true_label FROM p_pairs, (VALUES ('csv'), ('json'), ('parquet')) f(format)"
    )
    q["dirty_edges"] = """
SELECT 'P' || CAST(l_partkey AS VARCHAR) AS src_key, 'S' || CAST(l_suppkey AS VARCHAR) AS dst_key,
       CASE WHEN l_linenumber % 7 = 6 THEN round(CAST(l_quantity AS DOUBLE), 6) ELSE 1.0 END AS weight, 'unknown' AS true_label
FROM lineitem WHERE l_orderkey % 7 > 1 AND l_suppkey % 11 <> 0"""
    ringed = f"""WITH {CS_EDGES},
cs_top AS (SELECT greatest(max(src), max(dst)) AS top FROM cs_edges),
ringed AS (
SELECT src, dst, 'background' AS part FROM cs_edges
UNION ALL
{_planted(rings)}),
ends AS (SELECT src AS id, part FROM ringed UNION SELECT dst, part FROM ringed)"""
    facts = """
SELECT part, (SELECT count(*) FROM ends e WHERE e.part = r.part) AS n_nodes, CAST(0 AS BIGINT) AS n_without, count(*) AS n_edges,
       CASE WHEN part <> 'background' THEN CAST(1 AS BIGINT) END AS ring_clusters, CASE WHEN part <> 'background' THEN CAST(0 AS BIGINT) END AS ring_cut,
       true AS clusters_within_k, (SELECT count(*) FROM ends) AS n_assigned"""
    q["pic_clusters"] = f"{ringed}{facts} FROM ringed r GROUP BY part"
    q["pic_dataframe"] = f"{ringed}{facts}, CAST(0 AS BIGINT) AS n_reaching FROM ringed r GROUP BY part"
    q["pic_scores"] = f"""{ringed}
SELECT (SELECT count(*) FROM ends) AS n_nodes, true AS clusters_within_k, count(*) AS n_edges, CAST(0 AS BIGINT) AS wrong_flags,
       CAST(0 AS BIGINT) AS scores_out_of_range, CAST(1.0 AS DOUBLE) AS largest_volume_norm FROM ringed"""
    q["label_breakdown"] = f"""WITH {CP_EDGES}
SELECT true_label, count(*) AS edge_count, round(avg(weight), 2) AS avg_weight, round(stddev_samp(weight), 2) AS std_weight,
       round(sum(weight), 2) AS total_volume
FROM cp_edges GROUP BY 1"""
    q["degree_top10"] = f"""WITH {CP_EDGES}
SELECT node, count(*) AS degree FROM (SELECT src AS node FROM cp_edges UNION ALL SELECT dst FROM cp_edges)
GROUP BY 1 ORDER BY degree DESC, node LIMIT 10"""
    q["graph_density"] = f"""WITH {CP_EDGES},
nn AS (SELECT count(*) AS n FROM (SELECT src FROM cp_edges UNION SELECT dst FROM cp_edges))
SELECT (SELECT n FROM nn) AS n_nodes, count(*) AS total_edges,
       round(CASE WHEN (SELECT n FROM nn) > 1 THEN 2.0 * count(*) / (CAST((SELECT n FROM nn) AS DOUBLE) * ((SELECT n FROM nn) - 1))
             ELSE 0.0 END, 9) AS graph_density
FROM cp_edges"""
    q["node_risk"] = f"WITH {heat}\n" + _round_select(
        [("node_id", None), ("degree", None), ("avg_weight", 4), ("degree_z", 6), ("weight_z", 6), ("risk_raw", 6),
         ("node_risk", 6)], "risk"
    )
    q["suspicious_nodes"] = f"WITH {heat}\n" + _round_select(
        [("node_id", None), ("node_risk", 6), ("is_faulty_node", None)], "frisk"
    )
    q["heat_weights"] = f"WITH {heat}\n" + _round_select(
        [("src", None), ("dst", None), ("weight", 6), ("true_label", None)], "hw"
    ).replace("FROM hw", f", round(w{len(TAUS)}, 6) AS weight_norm FROM hw")
    q["heat_history"] = f"WITH {heat}\n" + _heat_history(hcfg)
    q["heat_frames"] = f"WITH {heat}\n" + _heat_frames(hcfg)
    q["power_iteration3"] = f"WITH {CS_EDGES},\n" + _power_iteration(pi_steps)
    from ringlens.operators.one_dim import K_CANDIDATES
    from ringlens.plans.catalog import ALERT_DAYS, ALERT_DENSITY
    from ringlens.sources.testgraphs import DELIVERY_ENDS

    q["power_iteration_stop"] = f"WITH {CS_EDGES},\n" + _power_iteration_stop(15, 1e-5, False)
    q["power_iteration_changes"] = f"WITH {CS_EDGES},\n" + _power_iteration_stop(15, 1e-5, True)
    q["choose_k"] = f"WITH {CS_EDGES},\n" + _choose_k(pi_steps, K_CANDIDATES)
    q["cluster_matching"] = _cluster_matching("1998-04-01 00:00:00", 0.1)
    q["sliding_graph"] = f"""WITH {_deliveries(DELIVERY_ENDS, 5)}
SELECT window_start, window_end, src, dst, true_label, round(weight, 6) AS weight, n_transfers, round(volume, 4) AS volume FROM wedges"""
    q["reclustered_windows"] = _reclustered(DELIVERY_ENDS, 5, pi_steps, 3)
    q["recent_activity"] = RECENT_ACTIVITY
    q["composite_weights"] = COMPOSITE_WEIGHTS
    q["step_sketches"] = STEP_SKETCHES
    q["density_drift"] = DENSITY_DRIFT
    q["alert_table"] = _alert_table(ALERT_DAYS, ALERT_DENSITY)
    etl = _etl_sources()
    q["etl_edges"] = f"WITH {etl}\nSELECT * FROM etl_out"
    q["edge_time_modes"] = f"""WITH {etl}
SELECT src_id, dst_id, src_ts AS t_src, dst_ts AS t_dst, least(src_ts, dst_ts) AS t_min, greatest(src_ts, dst_ts) AS t_max
FROM etl_j"""
    q["edge_label_rule"] = f"WITH {etl}\nSELECT true_label, count(*) AS n_edges FROM etl_out GROUP BY 1"
    q["etl_stats"] = f"""WITH {etl}
SELECT count(*) AS edge_count, count(DISTINCT src_id) AS distinct_src, count(DISTINCT dst_id) AS distinct_dst,
       min(timestamp) AS min_timestamp, max(timestamp) AS max_timestamp
FROM etl_out"""
    q["planted_graph"] = f"""WITH {CS_EDGES},
cs_top AS (SELECT greatest(max(src), max(dst)) AS top FROM cs_edges)
SELECT src, dst, true_label FROM cs_edges
UNION ALL
{_planted(rings)}"""
    return q
