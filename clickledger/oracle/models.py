"""The study's models once more: cuts, logistic fits and trees from their definitions."""

CHECKS = {}

# fixed values: predictors of the two sets, numbers that are clamped
POST = ["vorlauf", "close2book", "bin_rematched", "nmv", "margin", "vertical_combo_c_rate", "partner_c_rate",
        "agent_c_rate", "is_image_uploaded", "epd"]
PRE = ["vorlauf", "nmv", "vertical_combo_c_rate", "agent_c_rate", "is_image_uploaded", "epd"]
FLAGS = ["bin_rematched", "is_image_uploaded"]
CLAMPED = {"post": ["vorlauf", "close2book", "nmv", "margin"], "pre": ["vorlauf", "nmv"]}


def _rate(subject: str) -> str:
    return f"count(*) FILTER (bin_cancelled) OVER (PARTITION BY {subject}) / count(*) OVER (PARTITION BY {subject})"


for _booking, _columns, _label, _which in (
    ("post", POST, "bin_cancelled", "bin_prepared"), ("pre", PRE, "NOT bin_prepared", "true"),
):
    CHECKS[f"raw_{_booking}"] = f"""
SELECT opportunity_id, ({_label})::INT AS label, {", ".join(_columns)} FROM (
  SELECT opportunity_id, bin_cancelled, bin_prepared, bin_rematched, is_image_uploaded, vorlauf, close2book,
    round(nmv, 4) AS nmv, round(margin, 6) AS margin, round(sales_epd, 4) AS epd,
    {_rate("verticals")} AS vertical_combo_c_rate, {_rate("partner_id")} AS partner_c_rate,
    {_rate("first_sales_agent")} AS agent_c_rate
  FROM {{features}}
) WHERE {_which}
"""
    _fences = ", ".join(
        f"quantile_cont({c}, [0.25, 0.75]) AS {c}_q" for c in CLAMPED[_booking]
    )
    _clamp = ", ".join(
        f"least(greatest({c}, {c}_q[1] - 1.5 * ({c}_q[2] - {c}_q[1])), {c}_q[2] + 1.5 * ({c}_q[2] - {c}_q[1]))::DOUBLE AS {c}"
        for c in CLAMPED[_booking]
    )
    _flags = ", ".join(f"{c}::INT::DOUBLE AS {c}" for c in _columns if c in FLAGS)
    CHECKS[f"plain_{_booking}"] = f"""
SELECT * EXCLUDE ({", ".join(f"{c}_q" for c in CLAMPED[_booking])}) REPLACE ({_clamp}, {_flags})
FROM {{raw_{_booking}}}, (SELECT {_fences} FROM {{raw_{_booking}}})
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _columns)}
"""
    _scaled = ", ".join(
        f"coalesce(({c} - avg({c}) OVER ()) / nullif(stddev_samp({c}) OVER (), 0), 0) AS {c}"
        for c in _columns if c not in FLAGS
    )
    CHECKS[f"scaled_{_booking}"] = f"SELECT * REPLACE ({_scaled}) FROM {{plain_{_booking}}}"

# --- supervised cuts: the cut of least entropy of an interval, kept where it pays for its description ---
_H = "(CASE WHEN {p} > 0 AND {p} < {n} THEN -({p} / {n}) * log2({p} / {n}) - (1 - {p} / {n}) * log2(1 - {p} / {n}) ELSE 0 END)"


def _entropy(p: str, n: str) -> str:
    return _H.replace("{p}", f"({p})").replace("{n}", f"({n})::DOUBLE")


def _kinds(p: str, n: str) -> str:
    return f"(1 + (({p}) > 0 AND ({p}) < ({n}))::INT)"


CHECKS["long_post"] = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c}::DOUBLE AS value, label FROM {{complete_post}}" for c in POST
)
CHECKS["complete_post"] = f"SELECT * FROM {{raw_post}} WHERE {' AND '.join(f'{c} IS NOT NULL' for c in POST)}"
CHECKS["cut_points"] = f"""
WITH RECURSIVE counted AS (
  SELECT feature, value, count(*) AS n, sum(label) AS p FROM {{long_post}} GROUP BY ALL
), intervals AS (
  SELECT DISTINCT feature, '-inf'::DOUBLE AS low, 'inf'::DOUBLE AS high FROM counted
  UNION ALL
  SELECT feature, unnest([low, cut]), unnest([cut, high]) FROM (
    SELECT feature, low, high, unnest(arg_min(struct_pack(cut := value, a, pa, n, p), (round(mean, 10), value))) FROM (
      SELECT *, (a * {_entropy("pa", "a")} + (n - a) * {_entropy("p - pa", "n - a")}) / n AS mean FROM (
        SELECT i.feature, i.low, i.high, value, sum(c.n) OVER upto AS a, sum(c.p) OVER upto AS pa,
          sum(c.n) OVER whole AS n, sum(c.p) OVER whole AS p
        FROM intervals i JOIN counted c ON c.feature = i.feature AND c.value > i.low AND c.value <= i.high
        WINDOW upto AS (PARTITION BY i.feature, i.low, i.high ORDER BY value ROWS UNBOUNDED PRECEDING),
          whole AS (PARTITION BY i.feature, i.low, i.high)
      ) WHERE a < n
    ) GROUP BY feature, low, high
  ) WHERE {_entropy("p", "n")} - (a * {_entropy("pa", "a")} + (n - a) * {_entropy("p - pa", "n - a")}) / n
    > (log2(n - 1) + log2(3 ** {_kinds("p", "n")} - 2) - ({_kinds("p", "n")} * {_entropy("p", "n")}
      - {_kinds("pa", "a")} * {_entropy("pa", "a")} - {_kinds("p - pa", "n - a")} * {_entropy("p - pa", "n - a")})) / n
)
SELECT DISTINCT feature, high AS cut FROM intervals WHERE high < 'inf'::DOUBLE
"""
CHECKS["gains_exact"] = f"""
WITH pieces AS (
  SELECT feature, label, CASE WHEN feature IN ('{"', '".join(FLAGS)}') THEN value::BIGINT ELSE
    (SELECT count(*) FROM {{cut_points}} c WHERE c.feature = l.feature AND c.cut < l.value) END AS piece
  FROM {{long_post}} l
), cells AS (SELECT feature, piece, label, count(*)::DOUBLE AS n FROM pieces GROUP BY ALL),
sums AS (
  SELECT *, sum(n) OVER (PARTITION BY feature) AS total, sum(n) OVER (PARTITION BY feature, piece) AS a,
    sum(n) OVER (PARTITION BY feature, label) AS b FROM cells
)
SELECT feature, sum(n / total * ln(n * total / (a * b))) AS information_gain,
  sqrt(greatest(sum(n * n * total / (a * b)) - max(total), 0)
    / nullif(max(total) * (least(count(DISTINCT piece), count(DISTINCT label)) - 1), 0)) AS chi_squared
FROM sums GROUP BY feature
"""
CHECKS["gains"] = """
SELECT feature, round(information_gain, 8) AS information_gain, round(chi_squared, 8) AS chi_squared FROM {gains_exact}
"""
CHECKS["informative"] = """
SELECT (SELECT count(*) FROM {raw_post}) AS rows, 'n_' || feature AS feature, known
FROM {gains_exact} JOIN (UNPIVOT (SELECT count(COLUMNS(* EXCLUDE (opportunity_id, label))) FROM {raw_post})
  ON COLUMNS(*) INTO NAME feature VALUE known) USING (feature)
WHERE information_gain >= 0.002
"""


# --- judging scores -------------------------------------------------------------------------------
def _judge(scored: str, group: str) -> str:
    """The chance that a positive row outranks another, ties half, from mean ranks."""
    return f"""
SELECT {group}, rows, positives, round((ranks - positives * (positives + 1) / 2) / nullif(positives * (rows - positives), 0), 6)
    AS auc, round(hits / rows, 6) AS acc
FROM (
  SELECT {group}, sum(n)::BIGINT AS rows, sum(p)::BIGINT AS positives, sum(p * (upto - n + (n + 1) / 2)) AS ranks,
    sum(CASE WHEN score > 0.5 THEN p ELSE n - p END) AS hits
  FROM (SELECT *, sum(n) OVER (PARTITION BY {group} ORDER BY score ROWS UNBOUNDED PRECEDING) AS upto
    FROM (SELECT {group}, score, sum(n) AS n, sum(p) AS p FROM {scored} GROUP BY ALL))
  GROUP BY {group}
)"""


# a constant column has nothing to divide by and gets 0
_ELIMINATED = """CASE WHEN abs(a.m[s.k][s.k]) < 1e-12 THEN (CASE WHEN i = s.k THEN [0.0 FOR v IN line] ELSE line END)
        WHEN i = s.k THEN [v / line[s.k] FOR v IN line]
        ELSE [v - line[s.k] / a.m[s.k][s.k] * a.m[s.k][j] FOR v, j IN line] END"""


# --- logistic regression by Newton's method; the equations are solved by elimination ---------------
def _fits(source: str, columns: list[str], folds: int | None) -> str:
    size = len(columns) + 1
    x = ["1.0", *columns]
    gram = ", ".join(
        "[" + ", ".join([*[f"sum(p * (1 - p) * {a} * {b})" for b in x], f"sum((label - p) * {a})"]) + "]" for a in x
    )
    score = " + ".join(f"beta[{i + 1}] * {c}" for i, c in enumerate(x))
    steps = ", ".join(["{'m': gram, 'k': 0}"] + [f"{{'m': NULL, 'k': {k}}}" for k in range(1, size + 1)])
    models = "[-1]" if folds is None else f"range({folds})"
    learned = "true" if folds is None else "fold <> model"
    return f"""
fitted AS (
  SELECT unnest({models}) AS model, 0 AS round, list_resize([0.0::DOUBLE], {size}, 0.0) AS beta, NULL::DOUBLE[][] AS solved
  UNION ALL
  SELECT model, round, [b + solved[i][{size + 1}] FOR b, i IN beta], solved FROM (
    SELECT model, round, beta, list_reduce([{steps}], lambda a, s: {{
      'm': list_transform(a.m, lambda line, i: {_ELIMINATED}), 'k': s.k}}).m AS solved
    FROM (
      SELECT model, round + 1 AS round, beta, [{gram}] AS gram FROM (
        SELECT *, 1 / (1 + exp(-({score}))) AS p FROM fitted, {source} WHERE {learned} AND round < 12
      ) GROUP BY ALL
    )
  )
)"""


for _booking, _columns in (("post", POST), ("pre", PRE)):
    CHECKS[f"dealt_{_booking}"] = f"""
SELECT *, ((row_number() OVER (PARTITION BY label ORDER BY md5(opportunity_id), opportunity_id)) - 1) % 5 AS fold
FROM {{scaled_{_booking}}}
"""
    _score = " + ".join(f"beta[{i + 1}] * {c}" for i, c in enumerate(["1.0", *_columns]))
    CHECKS[f"logistic_{_booking}"] = f"""
WITH RECURSIVE {_fits(f"{{dealt_{_booking}}}", _columns, 5)}, scored AS (
  SELECT fold::INT AS fold, 1 / (1 + exp(-({_score}))) AS score, 1 AS n, label AS p
  FROM {{dealt_{_booking}}} JOIN fitted ON model = fold WHERE round = 12
)
{_judge("scored", "fold")}
"""
_errors = ", ".join(f"sqrt(inverse[{i + 1}])" for i in range(len(POST) + 1))
CHECKS["logistic_terms"] = f"""
WITH RECURSIVE {_fits("{scaled_post}", POST, None)}, curved AS (
  SELECT beta, [{", ".join("[" + ", ".join([f"sum(p * (1 - p) * {a} * {b})" for b in ["1.0", *POST]] + ["0.0"]) + "]" for a in ["1.0", *POST])}] AS gram
  FROM (SELECT *, 1 / (1 + exp(-({" + ".join(f"beta[{i + 1}] * {c}" for i, c in enumerate(["1.0", *POST]))}))) AS p
    FROM fitted, {{scaled_post}} WHERE round = 12)
  GROUP BY beta
), solved AS (
  -- column by column of the inverse
  SELECT beta, c, list_reduce([{{'m': [list_concat(line[:{len(POST) + 1}], [(i = c)::INT::DOUBLE]) FOR line, i IN gram], 'k': 0}},
      {", ".join(f"{{'m': NULL, 'k': {k}}}" for k in range(1, len(POST) + 2))}], lambda a, s: {{
      'm': list_transform(a.m, lambda line, i: {_ELIMINATED}), 'k': s.k}}).m[c][{len(POST) + 2}] AS variance
  FROM curved, (SELECT unnest(range(1, {len(POST) + 2})) AS c)
)
SELECT (['(intercept)', '{"', '".join(POST)}'])[c] AS term, round(beta[c], 6) AS coefficient,
  round(sqrt(variance), 6) AS std_error, round(beta[c] / nullif(sqrt(variance), 0), 4) AS z
FROM solved
"""

# --- trees ------------------------------------------------------------------------------------------
# one tree for each smallest node, smallest side and held-out fold; -1 holds out none
LEVELS = 24
CHECKS["tree_shapes"] = """
SELECT row_number() OVER (ORDER BY ms, mb, held) AS tree, * FROM
  (SELECT unnest([40, 80, 120]) AS ms), (SELECT unnest([5, 22, 40]) AS mb), (SELECT unnest([-1, 0, 1, 2]) AS held)
"""
CHECKS["tree_at_0"] = f"""
SELECT tree, ms, mb, 1::BIGINT AS node, fold <> held AS learns, label, [{", ".join(f"{c}::DOUBLE" for c in POST)}] AS x FROM (
  SELECT *, (row_number() OVER (PARTITION BY label ORDER BY md5(opportunity_id), opportunity_id) - 1) % 3 AS fold
  FROM {{plain_post}}
), {{tree_shapes}}
"""
_PURE = "(({p}) * ({p}) + (({n}) - ({p})) * (({n}) - ({p})))::DOUBLE / ({n})"


def _pure(p: str, n: str) -> str:
    return _PURE.replace("{p}", p).replace("{n}", n)


for _k in range(LEVELS):
    CHECKS[f"tree_split_{_k}"] = f"""
SELECT tree, node, unnest(arg_min(struct_pack(feature, cut, gain), (-gain, feature, value))) FROM (
  SELECT *, (value + next) / 2 AS cut,
    round({_pure("pa", "a")} + {_pure("p - pa", "n - a")} - {_pure("p", "n")}, 9) AS gain
  FROM (
    SELECT *, sum(c) OVER upto AS a, sum(pc) OVER upto AS pa, sum(c) OVER whole AS n, sum(pc) OVER whole AS p,
      lead(value) OVER (PARTITION BY tree, node, feature ORDER BY value) AS next
    FROM (
      SELECT tree, ms, mb, node, feature, value, count(*) AS c, sum(label) AS pc FROM (
        SELECT tree, ms, mb, node, label, unnest(x) AS value, generate_subscripts(x, 1) AS feature
        FROM {{tree_at_{_k}}} WHERE learns) GROUP BY ALL
    ) WINDOW upto AS (PARTITION BY tree, node, feature ORDER BY value ROWS UNBOUNDED PRECEDING),
      whole AS (PARTITION BY tree, node, feature)
  ) WHERE a < n AND n >= ms AND a >= mb AND n - a >= mb AND p > 0 AND p < n
) WHERE gain > 0 GROUP BY tree, node
"""
    CHECKS[f"tree_at_{_k + 1}"] = f"""
SELECT tree, ms, mb, 2 * node + (x[feature] > cut)::INT AS node, learns, label, x
FROM {{tree_at_{_k}}} JOIN {{tree_split_{_k}}} USING (tree, node)
"""
CHECKS["tree_nodes"] = " UNION ALL ".join(
    f"""SELECT tree, node, {_k} AS level, count(*) FILTER (learns) AS n, coalesce(sum(label) FILTER (learns), 0) AS p,
  count(*) FILTER (NOT learns) AS out, coalesce(sum(label) FILTER (NOT learns), 0) AS p_out,
  any_value(feature) AS feature, any_value(gain) AS gain
FROM {{tree_at_{_k}}} LEFT JOIN {{tree_split_{_k}}} USING (tree, node) GROUP BY tree, node"""
    for _k in range(LEVELS)
)
CHECKS["tree_grid"] = """
SELECT row_number() OVER (ORDER BY ms, mb, cp) - 1 AS setting, * FROM (SELECT DISTINCT ms, mb FROM {tree_shapes}),
  (SELECT unnest([0.0001::DOUBLE, 0.0001::DOUBLE + (0.1::DOUBLE - 0.0001::DOUBLE) / 2, 0.1::DOUBLE]) AS cp)
"""
# the cheapest way to go on below a node: end there, or the sum of its children
for _k in reversed(range(LEVELS)):
    _below = (
        f"(SELECT setting, tree, node // 2 AS node, sum(cost) AS below FROM {{tree_cost_{_k + 1}}} GROUP BY ALL)"
        if _k + 1 < LEVELS
        else "(SELECT 0 AS setting, 0 AS tree, 0 AS node, 0 AS below WHERE false)"
    )
    CHECKS[f"tree_cost_{_k}"] = f"""
SELECT setting, tree, node, level, least(alone, coalesce(below, alone)) AS cost, below IS NULL OR alone <= below + 1e-9 AS ends,
  p / n AS score, feature, gain
FROM (
  SELECT setting, tree, t.node, level, feature, gain, p, n, least(p, n - p) + cp * (SELECT least(r.p, r.n - r.p) FROM {{tree_nodes}} r
      WHERE r.tree = t.tree AND r.node = 1) AS alone
  FROM {{tree_nodes}} t JOIN {{tree_shapes}} USING (tree) JOIN {{tree_grid}} USING (ms, mb) WHERE level = {_k}
) LEFT JOIN {_below} USING (setting, tree, node)
"""
CHECKS["tree_costs"] = " UNION ALL ".join(f"SELECT * FROM {{tree_cost_{_k}}}" for _k in range(LEVELS))
CHECKS["tree_judged"] = f"""
WITH leaves AS (
  SELECT tree, node, out, p_out, unnest([node >> j FOR j IN range(level + 1)]) AS above FROM {{tree_nodes}} WHERE feature IS NULL
), ended AS (
  SELECT c.setting, l.tree, l.node, out, p_out, arg_min(score, above) AS score
  FROM leaves l JOIN {{tree_costs}} c ON c.tree = l.tree AND c.node = above WHERE ends GROUP BY ALL
), scored AS (
  SELECT setting, held AS fold, score, out AS n, p_out AS p FROM ended JOIN {{tree_shapes}} USING (tree) WHERE held >= 0 AND out > 0
)
{_judge("scored", "setting, fold").replace(", 6)", ", 12)")}
"""
CHECKS["tree_settings"] = """
WITH means AS (SELECT setting, avg(auc) AS auc, avg(acc) AS acc FROM {tree_judged} GROUP BY setting)
SELECT setting::INT AS setting, ms AS min_split, mb AS min_bucket, round(cp, 6) AS complexity, round(auc, 6) AS auc,
  round(acc, 6) AS acc, row_number() OVER (ORDER BY round(auc, 9) DESC, setting) = 1 AS best
FROM means JOIN {tree_grid} USING (setting)
"""
CHECKS["tree_folds"] = """
SELECT setting::INT AS setting, fold, rows, positives, round(auc, 6) AS auc, round(acc, 6) AS acc FROM {tree_judged}
WHERE setting = (SELECT setting FROM {tree_settings} WHERE best)
"""
CHECKS["tree_gains"] = f"""
WITH RECURSIVE kept AS (
  SELECT node, feature, gain FROM {{tree_costs}} JOIN {{tree_shapes}} USING (tree)
  WHERE held = -1 AND setting = 0 AND node = 1 AND NOT ends
  UNION ALL
  SELECT c.node, c.feature, c.gain FROM kept k JOIN {{tree_costs}} c ON c.node // 2 = k.node JOIN {{tree_shapes}} USING (tree)
  WHERE held = -1 AND setting = 0 AND NOT ends
)
SELECT name AS feature, count(kept.feature) AS splits, round(coalesce(sum(gain), 0), 4) AS importance
FROM (SELECT unnest(['{"', '".join(POST)}']) AS name, unnest(range(1, {len(POST) + 1})) AS number)
LEFT JOIN kept ON kept.feature = number GROUP BY name
"""
