"""Runs, trials, versions and rollouts, with orders and lineitem standing in for run logs."""

from pyspark.sql import functions as F

from tidemark.catalog import query
from tidemark.operators import halving as hv
from tidemark.operators import importance as im
from tidemark.operators import runs as rn
from tidemark.plans.scratch import written
from tidemark.queries.base import events, inference_log, rounded
from tidemark.queries.splits import SHARE
from tidemark.session import table


def _runs(spark, sf):
    """An order is a child run of its customer."""
    params = F.create_map(F.lit("priority"), "o_orderpriority", F.lit("status"), "o_orderstatus")
    metrics = F.create_map(F.lit("price"), F.col("o_totalprice"))
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.col("o_custkey").alias("parent_id"),
        params.alias("params"), metrics.alias("metrics"),
    )


def _trials(spark, sf):
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("number"), F.col("o_totalprice").alias("value"), "o_orderpriority", "o_orderstatus"
    )


@query(
    "run_pivot",
    """
    SELECT o_orderkey AS run_id, o_custkey AS parent_id, o_orderpriority AS priority, o_orderstatus AS status,
           o_totalprice AS price FROM orders
    """,
)
def run_pivot(spark, sf):
    return rn.run_columns(_runs(spark, sf), ["priority", "status"], ["price"])


@query(
    "run_entries",
    """
    SELECT o_orderkey AS run_id, 'params' AS kind, 'priority' AS name, o_orderpriority AS value FROM orders
    UNION ALL SELECT o_orderkey, 'params', 'status', o_orderstatus FROM orders
    """,
)
def run_entries(spark, sf):
    return rn.run_entries(_runs(spark, sf), ["params"])


@query(
    "run_children",
    """
    SELECT c_custkey AS run_id, c_mktsegment AS segment, count(o_orderkey) AS n_children,
           max(o_totalprice) AS best_price, arg_max(o_orderkey, (o_totalprice, -o_orderkey)) AS best_run_id
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY ALL
    """,
)
def run_children(spark, sf):
    parents = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("run_id"), F.col("c_mktsegment").alias("segment")
    )
    return rn.with_children(parents, _runs(spark, sf), "price")


@query(
    "top_trials",
    """
    SELECT o_orderkey AS number, o_totalprice AS value, o_orderpriority, o_orderstatus FROM orders
    ORDER BY o_totalprice DESC, o_orderkey LIMIT 5
    """,
)
def top_trials(spark, sf):
    return rn.top_trials(_trials(spark, sf))


@query(
    "best_so_far",
    """
    SELECT o_orderkey AS number, o_totalprice AS value, max(o_totalprice) OVER (ORDER BY o_orderkey) AS best_value
    FROM orders
    """,
)
def best_so_far(spark, sf):
    return rn.best_so_far(_trials(spark, sf).select("number", "value"))


@query(
    "param_importance",
    """
    WITH l AS (SELECT 'priority' AS param, o_orderpriority AS bin, o_totalprice AS v FROM orders
               UNION ALL SELECT 'status', o_orderstatus, o_totalprice FROM orders),
         g AS (SELECT param, bin, count(*) AS n, avg(v) AS m, var_pop(v) AS s FROM l GROUP BY ALL),
         t AS (SELECT param, avg(v) AS grand, var_pop(v) * count(*) AS total FROM l GROUP BY param),
         e AS (SELECT g.param, sum(n * (m - grand) ** 2) / any_value(total) AS explained
               FROM g JOIN t ON g.param = t.param GROUP BY g.param)
    SELECT param, round(explained, 8) AS explained, round(explained / (SELECT sum(explained) FROM e), 4) AS importance
    FROM e
    """,
)
def param_importance(spark, sf):
    params = {"priority": F.col("o_orderpriority"), "status": F.col("o_orderstatus")}
    return rounded(rn.param_importance(_trials(spark, sf), params), 8, importance=4)


@query(
    "param_variance",
    """
    WITH r AS (SELECT min(l_quantity) AS a, max(l_quantity) AS b, min(l_discount) AS c, max(l_discount) AS d,
                      (max(l_quantity) FILTER (WHERE l_quantity <= 25) + min(l_quantity) FILTER (WHERE l_quantity > 25)) / 2 AS q,
                      (max(l_discount) FILTER (WHERE l_discount <= 0.05) + min(l_discount) FILTER (WHERE l_discount > 0.05)) / 2 AS x
               FROM lineitem),
         s AS (SELECT (b - q) / (b - a) AS p, (d - x) / (d - c) AS u FROM r),
         z AS (SELECT i, j, CASE i WHEN 1 THEN p ELSE 1 - p END AS wi, CASE j WHEN 1 THEN u ELSE 1 - u END AS wj,
                      2.0::DOUBLE * i + j + 3 * i * j AS y
               FROM s, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j)),
         m AS (SELECT sum(wi * wj * y) AS m, sum(wi * wj * y * y) - sum(wi * wj * y) ** 2 AS total FROM z),
         qi AS (SELECT i, any_value(wi) AS w, sum(wj * y) AS a FROM z GROUP BY i),
         xj AS (SELECT j, any_value(wj) AS w, sum(wi * y) AS a FROM z GROUP BY j),
         v AS (SELECT 'quantity' AS params, sum(w * (a - m) ** 2) AS variance FROM qi, m
               UNION ALL SELECT 'discount', sum(w * (a - m) ** 2) FROM xj, m
               UNION ALL SELECT 'quantity,discount', sum(wi * wj * (y - qi.a - xj.a + m) ** 2)
               FROM z JOIN qi USING (i) JOIN xj USING (j), m)
    SELECT params, round(variance, 6) AS variance, round(variance / total, 6) AS share FROM v, m
    """,
)
def param_variance(spark, sf):
    """Two parameters of which one matters more where the other is large."""
    high, dear = F.col("l_quantity") > 25, F.col("l_discount") > 0.05
    value = 2.0 * high.cast("int") + dear.cast("int") + 3.0 * (high & dear).cast("int")
    trials = table(spark, sf, "lineitem").select(
        F.col("l_quantity").alias("quantity"), F.col("l_discount").alias("discount"), value.alias("value"))
    return rounded(im.param_variance(trials, ["quantity", "discount"], depth=4))


@query(
    "param_response",
    """
    WITH b AS (SELECT CAST(least(9, floor(log10(l_quantity) / log10(50) * 10)) AS INTEGER) AS bin,
                      count(*) AS n, avg(l_extendedprice) AS m, max(l_extendedprice) AS best
               FROM lineitem WHERE l_quantity BETWEEN 1 AND 50 GROUP BY 1)
    SELECT bin, n, round(m, 4) AS mean_value, best AS best_value,
           (SELECT arg_max(bin, (best, bin)) FROM b) IN (0, 9) AS optimum_on_edge FROM b
    """,
)
def param_response(spark, sf):
    made = rn.param_response(table(spark, sf, "lineitem"), "l_quantity", 1, 50, 10, log=True, value="l_extendedprice")
    return rounded(made, 4)


@query(
    "median_prune",
    """
    WITH s AS (SELECT l_orderkey AS trial, l_linenumber AS step, max(l_extendedprice) AS value FROM lineitem GROUP BY ALL),
         m AS (SELECT step, median(value) AS med FROM s GROUP BY step)
    SELECT trial, count(*) AS n_steps, min(CASE WHEN value < med AND s.step >= 3 THEN s.step END) AS pruned_at
    FROM s JOIN m ON s.step = m.step GROUP BY trial
    """,
)
def median_prune(spark, sf):
    lines = table(spark, sf, "lineitem")
    steps = lines.groupBy(F.col("l_orderkey").alias("trial"), F.col("l_linenumber").alias("step"))
    return rn.median_prune(written(steps.agg(F.max("l_extendedprice").alias("value")), "steps"), warmup=3)


STEPS = """
  WITH s AS (SELECT l_orderkey AS trial, l_linenumber AS step, max(l_extendedprice) AS value, min(l_shipdate) AS "at"
             FROM lineitem GROUP BY ALL)
"""


def _steps(spark, sf):
    """An order is a trial, its lines are the steps it reports, the shipping date is when."""
    lines = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("trial"), F.col("l_linenumber").alias("step"))
    return written(lines.agg(F.max("l_extendedprice").alias("value"), F.min("l_shipdate").alias("at")), "steps")


def _halved_sql(rungs, source, group=""):
    """Survivors of each rung: the best half, at least one, of what the rungs before have left."""
    parts, gone = [], []
    for step, start in rungs:
        anti = "".join(f" AND trial NOT IN (SELECT trial FROM stop{g})" for g in gone)
        over = f"PARTITION BY {group}" if group else ""
        parts.append(f"""
          at{step} AS (SELECT *, row_number() OVER ({over} ORDER BY value DESC, trial) AS nth, count(*) OVER ({over}) AS n
                       FROM {source} WHERE step = {step} AND {start}{anti}),
          stop{step} AS (SELECT trial, step AS stopped_at FROM at{step} WHERE nth > greatest(1, n // 2))""")
        gone.append(step)
    union = " UNION ALL ".join(f"SELECT * FROM stop{g}" for g in gone)
    columns = f"{group}, trial" if group else "trial"
    return ",".join(parts) + f""", gone AS ({union})
      SELECT {columns}, count(*) AS n_steps, any_value(stopped_at) AS stopped_at,
             count(*) FILTER (WHERE stopped_at IS NULL OR step <= stopped_at) AS n_run
      FROM {source} LEFT JOIN gone USING (trial) GROUP BY {columns}"""


@query("successive_halving", STEPS + "," + _halved_sql([(1, "true"), (2, "true")], "s"))
def successive_halving(spark, sf):
    """After the first and the second line of an order, only the better half goes on."""
    return hv.successive_halving(_steps(spark, sf), last=4, eta=2)


@query(
    "hyperband",
    STEPS
    + f"""
    , b AS (SELECT *, CASE WHEN {SHARE.format(key="trial")} < 0.3 THEN 0 WHEN {SHARE.format(key="trial")} < 0.6 THEN 1
                      ELSE 2 END AS bracket FROM s),"""
    + _halved_sql([(1, "bracket = 2"), (2, "bracket >= 1")], "b", "bracket"),
)
def hyperband(spark, sf):
    """Three brackets: two rungs, one, and none."""
    return hv.hyperband(_steps(spark, sf), last=4, eta=2)


def _asha_sql(rungs):
    """A report is compared with those that arrived before it at the same rung."""
    parts, gone = [], []
    for step in rungs:
        anti = "".join(f" AND trial NOT IN (SELECT trial FROM stop{g})" for g in gone)
        parts.append(f"""
          at{step} AS (SELECT trial, value, row_number() OVER (ORDER BY "at", trial) AS seen FROM s WHERE step = {step}{anti}),
          stop{step} AS (SELECT a.trial, {step} AS stopped_at FROM at{step} a JOIN at{step} b ON b.seen <= a.seen
                         GROUP BY a.trial, a.seen HAVING count(*) FILTER (WHERE b.value > a.value) >= greatest(1, a.seen // 2))""")
        gone.append(step)
    union = " UNION ALL ".join(f"SELECT * FROM stop{g}" for g in gone)
    return ",".join(parts) + f""", gone AS ({union})
      SELECT trial, count(*) AS n_steps, any_value(stopped_at)::INTEGER AS stopped_at,
             count(*) FILTER (WHERE stopped_at IS NULL OR step <= stopped_at) AS n_run
      FROM s LEFT JOIN gone USING (trial) GROUP BY trial"""


@query("asha_prune", STEPS + "," + _asha_sql([1, 2]))
def asha_prune(spark, sf):
    """The same decided report by report, in the order of the shipping dates."""
    return hv.asha(_steps(spark, sf), "at", last=4, eta=2)


@query(
    "pareto_front",
    """
    WITH c AS (SELECT l_extendedprice AS g, min(l_quantity) AS q FROM lineitem GROUP BY g),
         r AS (SELECT *, min(q) OVER (ORDER BY g DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM c),
         f AS (SELECT g, q FROM r WHERE before IS NULL OR q < before)
    SELECT l_orderkey, l_linenumber, l_extendedprice, l_quantity
    FROM lineitem JOIN f ON l_extendedprice = g AND l_quantity = q
    """,
)
def pareto_front(spark, sf):
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    return rn.pareto_front(lines, "l_extendedprice", "l_quantity")


VERSIONS = """
  WITH v AS (SELECT source || '/' || lang AS name, CAST(doc_id AS VARCHAR) AS version,
                    CASE WHEN lang = 'en' AND doc_id % 50 = 7 THEN 'champion' END AS alias,
                    CASE WHEN lang = 'fr' AND n_chars % 3 = 0 THEN 'Production' END AS stage,
                    doc_id FROM documents)
"""


@query(
    "resolve_version",
    VERSIONS
    + """
    , r AS (SELECT *, CASE WHEN alias = 'champion' THEN 2 WHEN stage = 'Production' THEN 1 ELSE 0 END AS level FROM v),
    p AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY name ORDER BY level DESC, doc_id DESC) = 1)
    SELECT name, version, CASE level WHEN 2 THEN 'alias' WHEN 1 THEN 'stage' ELSE 'latest' END AS resolved_by,
           'models:/' || name || CASE level WHEN 2 THEN '@champion' WHEN 1 THEN '/Production' ELSE '/' || version END
             AS uri
    FROM p
    """,
)
def resolve_version(spark, sf):
    docs = table(spark, sf, "documents")
    versions = docs.select(
        F.concat_ws("/", "source", "lang").alias("name"),
        F.col("doc_id").cast("string").alias("version"),
        F.when((F.col("lang") == "en") & (F.col("doc_id") % 50 == 7), "champion").alias("alias"),
        F.when((F.col("lang") == "fr") & (F.col("n_chars") % 3 == 0), "Production").alias("stage"),
    )
    return rn.resolve_version(versions, stage="Production")


@query(
    "eligible_models",
    """
    SELECT o_orderkey AS run_id, o_orderpriority AS model, 'factory-' || o_orderpriority AS name FROM orders
    WHERE o_totalprice >= 400000
    """,
)
def eligible_models(spark, sf):
    orders = table(spark, sf, "orders")
    runs = orders.select(F.col("o_orderkey").alias("run_id"), F.col("o_orderpriority").alias("model"))
    gates = orders.select(F.col("o_orderkey").alias("run_id"), (F.col("o_totalprice") >= 400000).alias("passed"))
    return rn.eligible_models(runs, gates, "factory")


@query(
    "canary_decision",
    """
    WITH p AS (SELECT 'm' || (user_id % 40) AS target, event_type <> 'error' AS ok FROM events),
         t AS (SELECT DISTINCT 'm' || (c_custkey % 50) AS target FROM customer),
         r AS (SELECT target, count(*) AS n, avg(ok::INTEGER) AS rate FROM p GROUP BY target)
    SELECT t.target, coalesce(n, 0) AS n_probes, round(coalesce(rate, 0), 6) AS success_rate,
           CASE WHEN coalesce(rate, 0) >= 0.81 THEN 'promote' ELSE 'rollback' END AS decision
    FROM t LEFT JOIN r ON t.target = r.target
    """,
)
def canary_decision(spark, sf):
    """The last ten targets never answered a probe."""
    name = lambda key, n: F.concat(F.lit("m"), (F.col(key) % n).cast("string")).alias("target")
    log = events(spark, sf)
    status = F.when(F.col("event_type") == "error", "degraded").otherwise("ok").alias("status")
    probes = log.select(name("user_id", 40), status)
    targets = table(spark, sf, "customer").select(name("c_custkey", 50))
    return rounded(rn.canary_decision(probes, targets, threshold=0.81))


ARM = f"CASE WHEN {SHARE.format(key='user_id')} < 0.05 THEN 'new' ELSE 'current' END"


@query("ab_assign", f"SELECT event_id, user_id, {ARM} AS arm FROM events")
def ab_assign(spark, sf):
    return rn.ab_assign(events(spark, sf).select("event_id", "user_id"), ["user_id"], 0.05)


@query(
    "ab_compare",
    f"""
    WITH a AS (SELECT 'm' || (user_id % 3) AS model, event_type = 'error' AS hit,
                      {SHARE.format(key='event_id')} < 0.3 AS new FROM events),
         c AS (SELECT model, count(*) FILTER (WHERE new) AS n1, count(*) FILTER (WHERE NOT new) AS n2,
                      count(*) FILTER (WHERE new AND hit) AS x1, count(*) FILTER (WHERE NOT new AND hit) AS x2
               FROM a GROUP BY model)
    SELECT model, n1 AS n_new, n2 AS n_current, x1 AS hits_new, x2 AS hits_current,
           round(x1 / n1, 6) AS rate_new, round(x2 / n2, 6) AS rate_current,
           round((x1 / n1 - x2 / n2) / sqrt(((x1 + x2) / (n1 + n2)) * (1 - (x1 + x2) / (n1 + n2))
                 * (1 / n1 + 1 / n2)), 6) AS z
    FROM c
    """,
)
def ab_compare(spark, sf):
    arms = rn.ab_assign(inference_log(spark, sf), ["event_id"], 0.3)
    return rounded(rn.ab_compare(arms, F.col("status") == "error", ["model"]))
