"""SQL twins of the queries, for an engine that knows nothing of this package.

They start from the parquet tables and recompute every answer in plain SQL: linear systems by
elimination and gradient descent by recursive queries over lists.
"""

from __future__ import annotations

from collections.abc import Sequence

from linefit.plans import fixed_values as K

SONGS = """songs AS (
  SELECT year(l_shipdate)::INT AS year, l_quantity / 50 AS f1,
         l_discount + 0.0::DOUBLE AS f2, l_tax + 0.0::DOUBLE AS f3
  FROM lineitem)"""

BANK = """bank AS (
  SELECT p_size AS age, p_type AS job, p_brand AS marital, p_name AS education,
         trunc(p_retailprice)::INT AS balance
  FROM part)"""

# Label y and features x as lists.
PRICE = """data AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice / 100000 AS y,
         [l_quantity / 50, l_discount, l_tax] AS x
  FROM lineitem)"""
CHARGE = """data AS (
  SELECT l_orderkey, l_linenumber,
         l_extendedprice / 100000 * (1 - l_discount) * (1 + l_tax) AS y,
         [l_extendedprice / 100000, l_discount, l_tax] AS x
  FROM lineitem)"""
PERFECT = """data AS (
  SELECT l_orderkey, l_linenumber, l_extendedprice / 60000 / 2 AS y, [l_extendedprice / 60000] AS x
  FROM lineitem)"""
SHIFTED_YEAR = f"""data AS (
  SELECT l_orderkey, l_linenumber, (year(l_shipdate) - {K.FIRST_YEAR})::DOUBLE AS y,
         [l_quantity / 50, l_discount, l_tax] AS x
  FROM lineitem)"""
EMBEDDING = """data AS (
  SELECT vec_id, label / 10.0::DOUBLE AS y, embedding::DOUBLE[] AS x FROM embeddings)"""

WIDE = """wide AS (
  SELECT o_orderpriority AS artist,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 0.0
              WHEN o_orderstatus = 'P' THEN NULL
              WHEN o_orderstatus = 'F' THEN year(o_orderdate) + 0.5
              ELSE year(o_orderdate) END::DOUBLE AS y,
         [o_totalprice / 500000, (o_orderkey % 12)::DOUBLE, (o_custkey % 100) / 100.0::DOUBLE,
          month(o_orderdate)::DOUBLE, (day(o_orderdate) % 7)::DOUBLE,
          (o_orderkey % 97) / 97.0::DOUBLE] AS x
  FROM orders)"""


# The same as text, the way the file has it.
WIDE_TEXT = """wide AS (
  SELECT o_orderpriority AS artist, o_orderkey AS number, o_orderstatus AS id,
         CASE WHEN o_orderpriority = '2-HIGH' THEN '0'
              WHEN o_orderstatus = 'P' THEN ''
              WHEN o_orderstatus = 'F' THEN year(o_orderdate) || '.5'
              ELSE year(o_orderdate)::VARCHAR END AS y,
         [(o_totalprice / 500000)::VARCHAR, (o_orderkey % 12)::VARCHAR,
          ((o_custkey % 100) / 100.0::DOUBLE)::VARCHAR, month(o_orderdate)::VARCHAR,
          (day(o_orderdate) % 7)::VARCHAR, ((o_orderkey % 97) / 97.0::DOUBLE)::VARCHAR] AS t
  FROM orders)"""


def rounded(expression: str, name: str, places: int = 6) -> str:
    return f"round({expression}, {places}) + 0.0::DOUBLE AS {name}"


def hashed(
    seed: int, keys: Sequence[str] = ("l_orderkey", "l_linenumber"), start: int = 1
) -> str:
    text = " || '|' || ".join(f"{k}::VARCHAR" for k in keys)
    return f"('0x' || substr(md5('{seed}:' || {text}), {start}, 8))::BIGINT"


def fold(seed: int) -> str:
    h = hashed(seed, start=9)
    cuts = [bound(k / K.FOLDS) for k in range(1, K.FOLDS)]
    whens = " ".join(f"WHEN {h} < {c} THEN {k}" for k, c in enumerate(cuts))
    return f"CASE {whens} ELSE {len(cuts)} END::INT"


def bound(share: float) -> int:
    return round(2**32 * share)


def by_index(source: str, vector: str) -> str:
    return f"""SELECT idx, count(value) AS count, {rounded('sum(value)', 'total')},
  {rounded('max(value)', 'largest')}
FROM (SELECT unnest(range(len({vector})))::INT AS idx, unnest({vector}) AS value FROM {source})
GROUP BY idx"""


def dot(a: str, b: str) -> str:
    return f"list_inner_product({a}, {b})"


# --- linear algebra -----------------------------------------------------------------------


def gram(source: str, width: int) -> str:
    """``gram``: n, c = Σy², b = Σxy (list) and g = Σxxᵀ (list of lists), one row."""
    return f"""
pairs AS (
  SELECT i, j, sum(x[i] * x[j]) AS v
  FROM {source}, range(1, {width + 1}) AS a(i), range(1, {width + 1}) AS c(j) GROUP BY i, j),
lines_of AS (SELECT i, list(v ORDER BY j) AS line FROM pairs GROUP BY i),
sides AS (
  SELECT i, sum(x[i] * y) AS v FROM {source}, range(1, {width + 1}) AS a(i) GROUP BY i),
gram AS MATERIALIZED (
  SELECT (SELECT count(*) FROM {source})::DOUBLE AS n, (SELECT sum(y * y) FROM {source}) AS c,
         (SELECT list(v ORDER BY i) FROM sides) AS b,
         (SELECT list(line ORDER BY i) FROM lines_of) AS g)"""


def descent(source: str, width: int) -> str:
    """``descent``: the weights w before update ``iter``, one row per update."""
    return f"""{gram(source, width)},
descent AS (
  SELECT 0 AS iter, list_resize([]::DOUBLE[], {width}, 0.0::DOUBLE) AS w
  UNION ALL
  SELECT iter + 1, list_transform(w, lambda v, j:
           v - ({dot('g[j]', 'w')} - b[j]) / (n * sqrt(iter + 1)))
  FROM descent, gram WHERE iter < {K.GRADIENT_ITERATIONS})"""


HISTORY_RMSE = (
    f"sqrt(greatest(c - 2 * {dot('w', 'b')} + "
    f"{dot('w', 'list_transform(g, lambda line: ' + dot('line', 'w') + ')')}, 0) / n)"
)


def moments(source: str, width: int, group: str) -> str:
    """``moments``: count, sums and product sums per group, as scalar columns."""
    z = [f"x[{i + 1}]" for i in range(width)] + ["y"]
    columns = [f"sum({c}) AS s{i}" for i, c in enumerate(z)]
    columns += [
        f"sum({z[i]} * {z[j]}) AS q{i}_{j}" for i in range(width + 1) for j in range(i, width + 1)
    ]
    return f"""moments AS (
  SELECT {group} AS fold, count(*)::DOUBLE AS n, {', '.join(columns)}
  FROM {source} GROUP BY {group})"""


def training(width: int, condition: str) -> str:
    """``training``: moments added up over the groups that serve a fold for training."""
    names = ["n"] + [f"s{i}" for i in range(width + 1)]
    names += [f"q{i}_{j}" for i in range(width + 1) for j in range(i, width + 1)]
    sums = ", ".join(f"sum(o.{n}) AS {n}" for n in names)
    return f"""training AS (
  SELECT f.fold, {sums} FROM (SELECT DISTINCT fold FROM moments) f
  JOIN moments o ON {condition} GROUP BY f.fold)"""


def ridge(width: int) -> str:
    """``ridge``: weights w and intercept per fold and strength, from ``training``.

    The standardised normal equations are solved by Gauss-Jordan elimination, one pivot per
    step of the recursion.
    """

    def q(i, j):
        return f"q{min(i, j)}_{max(i, j)}"

    def covariance(i, j):
        return f"({q(i, j)} / n - s{i} / n * s{j} / n)"

    sd = ", ".join(f"sqrt({covariance(i, i)}) AS d{i}" for i in range(width + 1))
    lines = []
    for i in range(width):
        cells = [
            f"{covariance(i, j)} / (d{i} * d{j})" + (f" + reg / d{width}" if i == j else "")
            for j in range(width + 1)
        ]
        lines.append(f"[{', '.join(cells)}]")
    scales = ", ".join(f"d{width} / d{i}" for i in range(width))
    means = ", ".join(f"s{i} / n" for i in range(width))
    regs = ", ".join(f"({r}::DOUBLE)" for r in K.REG_PARAMS)
    return f"""
deviations AS (SELECT *, {sd} FROM training),
elimination AS (
  SELECT fold, reg, 0 AS step, [{', '.join(lines)}] AS m
  FROM deviations, (VALUES {regs}) AS r(reg)
  UNION ALL
  SELECT fold, reg, step + 1, list_transform(m, lambda line, i:
           CASE WHEN i = step + 1
                THEN list_transform(line, lambda v: v / line[step + 1])
                ELSE list_transform(line, lambda v, j:
                       v - line[step + 1] / m[step + 1][step + 1] * m[step + 1][j]) END)
  FROM elimination WHERE step < {width}),
scaled AS (
  SELECT e.fold, reg, s{width} / n AS mean_y, [{means}] AS mean_x,
         list_transform([{scales}], lambda v, i: v * m[i][{width + 1}]) AS w
  FROM elimination e JOIN deviations d ON e.fold = d.fold WHERE step = {width}),
ridge AS (SELECT fold, reg, w, mean_y - {dot('w', 'mean_x')} AS intercept FROM scaled)"""


def elastic_net(width: int) -> str:
    """``elastic``: weights w and intercept, from ``training``.

    Coordinate descent on the standardised problem, one coordinate per step of the recursion.
    """

    def covariance(i, j):
        i, j = min(i, j), max(i, j)
        return f"(q{i}_{j} / n - s{i} / n * s{j} / n)"

    sd = ", ".join(f"sqrt({covariance(i, i)}) AS d{i}" for i in range(width + 1))
    lines = ", ".join(
        "[" + ", ".join(f"{covariance(i, j)} / (d{i} * d{j})" for j in range(width)) + "]"
        for i in range(width)
    )
    sides = ", ".join(f"{covariance(i, width)} / (d{i} * d{width})" for i in range(width))
    scales = ", ".join(f"d{width} / d{i}" for i in range(width))
    means = ", ".join(f"s{i} / n" for i in range(width))
    strength, share = K.ELASTIC_NET["regParam"], K.ELASTIC_NET["elasticNetParam"]
    pull = f"(b[i] - {dot('g[i]', 'w')} + g[i][i] * v)"
    return f"""
deviations AS (SELECT *, {sd} FROM training),
problem AS MATERIALIZED (
  SELECT [{lines}] AS g, [{sides}] AS b, [{scales}] AS scales, s{width} / n AS mean_y,
         [{means}] AS mean_x, {strength * share}::DOUBLE / d{width} AS absolute,
         {strength * (1 - share)}::DOUBLE / d{width} AS square
  FROM deviations),
sweeps AS (
  SELECT 0 AS step, list_resize([]::DOUBLE[], {width}, 0.0::DOUBLE) AS w
  UNION ALL
  SELECT step + 1, list_transform(w, lambda v, i:
           CASE WHEN i = step % {width} + 1
                THEN sign({pull}) * greatest(abs({pull}) - absolute, 0) / (g[i][i] + square)
                ELSE v END)
  FROM sweeps, problem WHERE step < {100 * width}),
unscaled AS (
  SELECT mean_y, mean_x, list_transform(scales, lambda v, i: v * w[i]) AS w
  FROM sweeps, problem WHERE step = {100 * width}),
elastic AS (SELECT w, mean_y - {dot('w', 'mean_x')} AS intercept FROM unscaled)"""


def wide_ridge_weights(width: int, strength: float) -> str:
    """Ridge weights over the embeddings: conjugate gradients, one step per recursion."""
    product = f"list_transform(c, lambda line, i: {dot('line', 'p')} + lambda_ * p[i])"
    return f"""WITH RECURSIVE {EMBEDDING},
means AS (SELECT list(v ORDER BY i) AS m, list(d ORDER BY i) AS d FROM (
  SELECT i, avg(x[i]) AS v, stddev_pop(x[i]) AS d FROM data, range(1, {width + 1}) AS r(i) GROUP BY i)),
label AS (SELECT avg(y) AS my, stddev_pop(y) AS dy FROM data),
z AS MATERIALIZED (
  SELECT (y - my) / dy AS t, list_transform(x, lambda v, i: (v - m[i]) / d[i]) AS z
  FROM data, means, label),
cells AS (
  SELECT i, j, avg(z[i] * z[j]) AS v
  FROM z, range(1, {width + 1}) AS a(i), range(1, {width + 1}) AS b(j) GROUP BY i, j),
system AS MATERIALIZED (
  SELECT (SELECT list(line ORDER BY i) FROM (SELECT i, list(v ORDER BY j) AS line FROM cells GROUP BY i)) AS c,
         (SELECT list(v ORDER BY i) FROM (SELECT i, avg(t * z[i]) AS v FROM z, range(1, {width + 1}) AS a(i)
          GROUP BY i)) AS b, (SELECT {strength} / dy FROM label) AS lambda_),
steps AS (
  SELECT 0 AS step, list_resize([]::DOUBLE[], {width}, 0.0::DOUBLE) AS w, b AS r, b AS p FROM system
  UNION ALL
  SELECT step + 1, w2, r2, list_transform(r2, lambda v, i: v + {dot('r2', 'r2')} / {dot('r', 'r')} * p[i])
  FROM (SELECT *, list_transform(r, lambda v, i: v - a * q[i]) AS r2,
               list_transform(w, lambda v, i: v + a * p[i]) AS w2
        FROM (SELECT *, {dot('r', 'r')} / {dot('p', 'q')} AS a
              FROM (SELECT step, w, r, p, {product} AS q FROM steps, system WHERE step < 60)))
  WHERE {dot('r', 'r')} > 1e-26)
SELECT i::INT AS idx, {rounded('w[i + 1] * dy / d[i + 1]', 'value')}
FROM (SELECT * FROM steps ORDER BY step DESC LIMIT 1), means, label, range({width}) AS r(i)"""


def dual_ridge_weights(strength: float) -> str:
    """Ridge weights over all products of two numbers of an embedding, by way of the rows' inner
    products: conjugate gradients for one number per row, then the sum of the rows times theirs."""
    product = f"list_transform(k, lambda line, i: {dot('line', 'p')} + lambda_ * p[i])"
    return f"""WITH RECURSIVE {EMBEDDING}, products AS (
  SELECT vec_id, y, flatten(list_transform(range(1, 65), lambda j:
           [x[j]] || list_transform(range(1, j + 1), lambda i: x[i] * x[j]))) AS x FROM data),
cells AS (SELECT vec_id, unnest(range(len(x))) AS i, unnest(x) AS v FROM products),
means AS (SELECT list(m ORDER BY i) AS m, list(d ORDER BY i) AS d FROM (
  SELECT i, avg(v) AS m, stddev_pop(v) AS d FROM cells GROUP BY i)),
label AS (SELECT avg(y) AS my, stddev_pop(y) AS dy, count(*)::DOUBLE AS n FROM data),
z AS MATERIALIZED (
  SELECT vec_id, (y - my) / dy AS t, list_transform(x, lambda v, i: (v - m[i]) / d[i]) AS z
  FROM products, means, label),
inner_products AS (
  SELECT a.vec_id AS i, list({dot('a.z', 'b.z')} / n ORDER BY b.vec_id) AS line
  FROM z a, z b, label GROUP BY a.vec_id),
system AS MATERIALIZED (
  SELECT (SELECT list(line ORDER BY i) FROM inner_products) AS k,
         (SELECT list(t ORDER BY vec_id) FROM z) AS b, (SELECT {strength} / dy FROM label) AS lambda_),
steps AS (
  SELECT 0 AS step, list_transform(b, lambda v: 0.0::DOUBLE) AS u, b AS r, b AS p FROM system
  UNION ALL
  SELECT step + 1, u2, r2, list_transform(r2, lambda v, i: v + {dot('r2', 'r2')} / {dot('r', 'r')} * p[i])
  FROM (SELECT *, list_transform(r, lambda v, i: v - a * q[i]) AS r2,
               list_transform(u, lambda v, i: v + a * p[i]) AS u2
        FROM (SELECT *, {dot('r', 'r')} / {dot('p', 'q')} AS a
              FROM (SELECT step, u, r, p, {product} AS q FROM steps, system WHERE step < 400)))
  WHERE {dot('r', 'r')} > 1e-24),
solved AS (SELECT unnest((SELECT list(vec_id ORDER BY vec_id) FROM z)) AS vec_id, unnest(u) AS u
  FROM (SELECT u FROM steps ORDER BY step DESC LIMIT 1))
SELECT c.i::INT AS idx, {rounded('sum((v - m[c.i + 1]) / d[c.i + 1] * u) / any_value(n) * any_value(dy) / any_value(d[c.i + 1])', 'value')}
FROM cells c JOIN solved USING (vec_id), means, label GROUP BY c.i"""


RESIDUAL_RMSE = f"sqrt(avg((y - intercept - {dot('w', 'x')}) ** 2))"
GRID = "(VALUES " + ", ".join(f"({i}, {v})" for i, v in enumerate(K.MAX_ITERS)) + ")"
STRENGTH_ORDER = "list_position([" + ", ".join(map(str, K.REG_PARAMS)) + "]::DOUBLE[], reg)"


def products_of(source: str = "data") -> str:
    """``products``: the rows of ``source`` with all terms of degree one and two."""
    terms = []
    for j in range(1, 4):
        terms += [f"x[{j}]"] + [f"x[{i}] * x[{j}]" for i in range(1, j + 1)]
    return f"""products AS (
  SELECT l_orderkey, l_linenumber, y, [{', '.join(terms)}] AS x FROM {source})"""


def cross_validation(source: str, width: int, seed: int = 0) -> str:
    """``fold_errors`` per fold and strength, and ``winner`` with the best strength."""
    return f"""
folded AS (SELECT *, {fold(seed)} AS fold FROM {source}),
{moments('folded', width, 'fold')},
{training(width, 'o.fold <> f.fold')},
{ridge(width)},
fold_errors AS (
  SELECT fold, reg, {RESIDUAL_RMSE} AS rmse
  FROM folded JOIN ridge USING (fold) GROUP BY fold, reg),
mean_errors AS (SELECT reg, avg(rmse) AS rmse FROM fold_errors GROUP BY reg),
winner AS (SELECT reg FROM mean_errors ORDER BY rmse, {STRENGTH_ORDER} LIMIT 1)"""


def refit(source: str, width: int) -> str:
    """Name spaced subquery: ridge weights per strength over all rows of ``source``."""
    return f"""(WITH RECURSIVE {moments(source, width, '1')},
{training(width, 'true')},
{ridge(width)}
SELECT reg, w, intercept FROM ridge)"""


def sides(
    source: str, share: float, seed: int, keys: Sequence[str] = ("l_orderkey", "l_linenumber")
) -> str:
    h = hashed(seed, keys)
    return (
        f"sided AS (SELECT *, CASE WHEN {h} < {bound(share)} THEN 'train' ELSE 'test' END "
        f"AS side FROM {source})"
    )


def tuned_errors(source: str, prefix: str, width: int) -> str:
    return f"""WITH RECURSIVE {prefix}, {sides(source, 0.9, K.TUNING_SEED)},
train AS (SELECT * FROM sided WHERE side = 'train'),
{cross_validation('train', width, K.TUNING_SEED)},
best AS (SELECT w, intercept FROM {refit('train', width)} JOIN winner USING (reg))
SELECT side, 'rmse' AS metric, {rounded(RESIDUAL_RMSE, 'value')}
FROM sided, best GROUP BY side"""


def best(source: str, prefix: str, width: int) -> str:
    return f"""WITH RECURSIVE {prefix}, {cross_validation(source, width)},
best AS (SELECT reg, w, intercept FROM {refit(source, width)} JOIN winner USING (reg))
SELECT reg AS "regParam", {K.MAX_ITERS[0]}::INT AS "maxIter",
  {rounded(RESIDUAL_RMSE, 'train_rmse')}
FROM {source}, best GROUP BY reg"""


# --- the twins ----------------------------------------------------------------------------


def _questions() -> dict[str, str]:
    (a, b), (c, d) = K.YEARS_COUNTED, K.YEARS_LISTED
    answers = {
        "song_count": "SELECT count(*) AS count FROM songs",
        "song_count_1998_2000": (
            f"SELECT count(*) AS count FROM songs WHERE year >= {a} AND year <= {b}"
        ),
        "year_min_max_avg": (
            f"SELECT min(year) AS min, max(year) AS max, {rounded('avg(year)', 'avg')} FROM songs"
        ),
        "songs_per_year": (
            "SELECT year, count(*) AS count FROM songs "
            f"WHERE year >= {c} AND year <= {d} GROUP BY year"
        ),
    }
    answers = {n: f"WITH {SONGS} {q}" for n, q in answers.items()}
    return answers | {f"{n}_sql": q for n, q in answers.items()}


def _texts() -> dict[str, str]:
    song_rows = (
        f"WITH {SONGS} SELECT year, {rounded('f1', 'f1')}, {rounded('f2', 'f2')}, "
        f"{rounded('f3', 'f3')} FROM songs"
    )
    bank_rows = f"WITH {BANK} SELECT age, {{}} AS job, marital, education, balance FROM bank"
    per_age = (
        f"WITH {BANK} SELECT age, count(*) AS count FROM bank WHERE age < 40 "
        "GROUP BY age ORDER BY age"
    )
    return {
        "keys_below_bound_ordered": per_age,
        "keys_below_bound_ordered_sql": per_age,
        "preview_top_n": (
            "SELECT o_orderkey, o_totalprice FROM orders "
            "ORDER BY o_totalprice DESC, o_orderkey LIMIT 10"
        ),
        "csv_headerless_songs": song_rows,
        "text_lines_songs": song_rows,
        "lines_accepted_per_year": (
            "SELECT year(l_shipdate)::INT AS year, count(*) AS count FROM lineitem "
            "WHERE l_linenumber < 4 GROUP BY 1"
        ),
        "lines_rejected_per_reason": """
SELECT CASE WHEN l_linenumber = 5 THEN 'empty' WHEN l_linenumber = 4 THEN 'bad_number'
            ELSE 'width' END AS reason, count(*) AS count
FROM lineitem WHERE l_linenumber >= 4 GROUP BY 1""",
        "line_counts": """
SELECT CASE WHEN l_linenumber = 5 THEN 'empty' WHEN l_linenumber = 4 THEN 'bad_number'
            WHEN l_linenumber > 5 THEN 'width' END AS reason,
       CASE WHEN l_linenumber < 4 THEN year(l_shipdate) END::INT AS year, count(*) AS count
FROM lineitem GROUP BY 1, 2""",
        "rejects_non_finite": """
SELECT CASE WHEN l_linenumber <= 3 THEN 'non_finite' ELSE 'none' END AS reason, count(*) AS count
FROM lineitem GROUP BY 1""",
        "bank_rejected_per_reason": """
SELECT CASE WHEN p_size <= 10 THEN 'width' ELSE 'bad_number' END AS reason, count(*) AS count
FROM part WHERE p_size <= 20 GROUP BY 1""",
        "bank_lines_rejected": """
SELECT CASE WHEN p_size <= 10 THEN 'width' WHEN p_size <= 20 THEN 'bad_number' ELSE 'none' END
  AS reason, count(*) AS count FROM part GROUP BY 1""",
        "wide_csv_rejected": f"""WITH {WIDE}, numbered AS (
  SELECT o_orderpriority AS artist, o_custkey % 10 AS tempo,
         CASE WHEN o_orderpriority = '2-HIGH' THEN 0.0 WHEN o_orderstatus = 'P' THEN NULL
              ELSE 1.0 END AS y FROM orders)
SELECT CASE WHEN artist IN ('1-URGENT', '5-LOW') THEN 'width' WHEN tempo = 0 THEN 'bad_number'
            ELSE 'non_finite' END AS reason, count(*) AS count
FROM numbered WHERE artist IN ('1-URGENT', '5-LOW') OR y > 0 AND tempo <= 1 GROUP BY 1""",
        "csv_drop_malformed": (
            'SELECT o_orderpriority AS "ArtistName", count(*) AS count FROM orders '
            "WHERE o_orderpriority NOT IN ('1-URGENT', '5-LOW') GROUP BY 1"
        ),
        "csv_rejected_records": (
            "SELECT CASE o_orderpriority WHEN '1-URGENT' THEN 17 ELSE 19 END AS fields, "
            "count(*) AS count FROM orders "
            "WHERE o_orderpriority IN ('1-URGENT', '5-LOW') GROUP BY 1"
        ),
        "delimited_quoted_bank": bank_rows.format("job || ';' || marital"),
        "quoted_multiline_records": bank_rows.format("job || chr(10) || '\";' || chr(10) || chr(10) || marital"),
        "bank_lines_by_position": bank_rows.format("job"),
        "wide_select_drop_pack": (
            f"WITH {WIDE}, known AS (SELECT [y] || x AS v FROM wide WHERE y > 0) "
            + by_index("known", "v")
        ),
    }


def _features() -> dict[str, str]:
    lines = """numbers AS (
  SELECT [year(l_shipdate)::DOUBLE, l_quantity / 50, l_discount + 0.0::DOUBLE,
          l_tax + 0.0::DOUBLE, l_orderkey::DOUBLE, l_partkey::DOUBLE, l_suppkey::DOUBLE,
          l_linenumber::DOUBLE, l_quantity, l_extendedprice, l_discount, l_tax, 0::DOUBLE] AS v
  FROM lineitem)"""
    from_first = f"""WITH {SONGS}
SELECT (year - (SELECT min(year) FROM songs))::DOUBLE AS label, count(*) AS count
FROM songs GROUP BY 1"""
    return {
        "tokenize_lines": """
WITH split_up AS (
  SELECT doc_id, list_filter(string_split(lower(text), ','), lambda t: length(t) >= 1) AS t
  FROM documents)
SELECT doc_id, len(t)::INT AS tokens, length(array_to_string(t, ''))::INT AS characters
FROM split_up""",
        "tokens_to_numbers": f"WITH {lines} " + by_index("numbers", "v"),
        "slice_label_features": f"""WITH {SONGS}
SELECT year, count(*) AS count, {rounded('sum(f1)', 'f1')}, {rounded('sum(f2)', 'f2')},
  {rounded('sum(f3)', 'f3')} FROM songs GROUP BY year""",
        "label_shift_min": from_first,
        "label_shift_min_lazy": from_first,
        "label_shift_const": f"""WITH {SONGS}
SELECT (year - {K.FIRST_YEAR})::DOUBLE AS label, floor((year - {K.FIRST_YEAR}) / 10)::BIGINT
  AS decade, count(*) AS count FROM songs GROUP BY 1, 2""",
        "poly2_column_sums": f"WITH {PRICE}, {products_of()} " + by_index("products", "x"),
        "poly2_wide_sums": f"""WITH {EMBEDDING}, products AS (
  SELECT flatten(list_transform(range(1, 65), lambda j:
           [x[j]] || list_transform(range(1, j + 1), lambda i: x[i] * x[j]))) AS v FROM data)
""" + by_index("products", "v"),
        "finite_rows_kept": (
            "SELECT vec_id, count(*) AS count FROM embeddings WHERE vec_id % 3 <> 0 GROUP BY 1"
        ),
        "vector_scale_add_fill": (
            f"WITH {EMBEDDING}, moved AS "
            "(SELECT list_transform(x, lambda e: 2 * e + 1) AS v FROM data) "
            + by_index("moved", "v")
        ),
        "embedding_dot_score": f"""WITH {EMBEDDING},
weights AS (SELECT list_transform(range(64), lambda j: (j % 5 - 2) / 10.0::DOUBLE) AS w)
SELECT vec_id, {rounded(dot('x', 'w'), 'score')},
  {rounded(dot('x', 'list_reverse(x)'), 'mirrored')} FROM data, weights""",
        "embedding_sum_by_label": f"""
SELECT label, idx, {rounded('sum(v)', 'value')}
FROM (SELECT label, unnest(range(len(embedding)))::INT AS idx,
             unnest(embedding::DOUBLE[]) AS v FROM embeddings) GROUP BY label, idx""",
    }


def _errors() -> dict[str, str]:
    h, at = hashed(K.TUNING_SEED), hashed(K.TUNING_SEED, ("file", "place"))
    residual = f"({dot('x', '[0.5, 0.25, 0.125]::DOUBLE[]')} - y)"
    return {
        "hash_split_counts": f"""
SELECT CASE WHEN {h} < {bound(0.7)} THEN 0 WHEN {h} < {bound(0.7 + 0.2)} THEN 1 ELSE 2 END::INT
  AS part, count(*) AS count, sum(l_partkey)::BIGINT AS part_keys FROM lineitem GROUP BY 1""",
        "row_split_counts": f"""
WITH placed AS (SELECT l_partkey, 'lineitem.parquet' AS file, row_number() OVER () - 1 AS place FROM lineitem)
SELECT CASE WHEN {at} < {bound(0.7)} THEN 0 WHEN {at} < {bound(0.7 + 0.2)} THEN 1 ELSE 2 END::INT
  AS part, count(*) AS count, sum(l_partkey)::BIGINT AS part_keys FROM placed GROUP BY 1""",
        "squared_error_total": (
            f"WITH {PRICE} SELECT {rounded(f'sum({residual} ** 2)', 'squared_error_sum', 4)} "
            "FROM data"
        ),
        "rmse_of_scored_rows": (
            f"WITH {PRICE} SELECT 'rmse' AS metric, "
            f"{rounded(f'sqrt(avg({residual} ** 2))', 'value')} FROM data"
        ),
        "gd_gradient_at_zero": f"""WITH {PRICE}
SELECT i::INT AS idx, {rounded('sum(-y * x[i + 1])', 'value', 4)}
FROM data, range(3) AS r(i) GROUP BY i""",
        "gd_gradient_terms": f"""WITH {PRICE}
SELECT l_linenumber, i::INT AS idx, {rounded(f'sum({residual} * x[i + 1])', 'value', 4)}
FROM data, range(3) AS r(i) GROUP BY l_linenumber, i""",
    }


def _descents() -> dict[str, str]:
    last = K.GRADIENT_ITERATIONS

    def weights(prefix, width):
        return f"""WITH RECURSIVE {prefix}, {descent('data', width)}
SELECT i::INT AS idx, {rounded('w[i + 1]', 'value')}
FROM descent, range({width}) AS r(i) WHERE iter = {last}"""

    def history(prefix, width):
        return f"""WITH RECURSIVE {prefix}, {descent('data', width)}
SELECT iter::INT AS iter, {rounded(HISTORY_RMSE, 'rmse')}
FROM descent, gram WHERE iter < {last}"""

    def trained(prefix, width=3):
        return f"""WITH RECURSIVE {prefix}, {sides('data', 0.9, 0)},
train AS (SELECT * FROM sided WHERE side = 'train'), {descent('train', width)},
final AS (SELECT w FROM descent WHERE iter = {last})"""

    row_rmse = f"sqrt(avg(({dot('w', 'x')} - y) ** 2))"
    return {
        "gd_weights": weights(PRICE, 3),
        "gd_history": history(PRICE, 3),
        "gd_rows_history": history(PRICE, 3),
        "gd_rows_errors": f"""WITH RECURSIVE {PRICE}, {descent('data', 3)}
SELECT iter::INT AS iter, {rounded(f"sqrt(avg(({dot('w', 'x')} - y) ** 2))", 'rmse')}
FROM descent, data WHERE iter < 3 GROUP BY iter""",
        "gd_perfect_history": f"""{trained(PERFECT, 1)}
SELECT iter::INT AS iter, {rounded(f"1e6 * {row_rmse}", 'rmse', 4)}
FROM descent, train WHERE iter < {last} GROUP BY iter""",
        "pipeline_copy_score": f"""WITH RECURSIVE {PRICE}, {descent('data', 3)}
SELECT i::INT AS idx, {rounded('w[i + 1]', 'value')}
FROM descent, range(3) AS r(i) WHERE iter = 5""",
        "gd_wide_weights": weights(EMBEDDING, 64),
        "gd_wide_history": history(EMBEDDING, 64),
        "gd_test_predictions": f"""{trained(PRICE)}
SELECT l_orderkey, l_linenumber, {rounded('y', 'label', 8)}, {rounded(dot('w', 'x'), 'prediction')}
FROM sided, final WHERE side = 'test'""",
        "gd_test_rmse": f"""{trained(PRICE)}
SELECT side, 'rmse' AS metric, {rounded(row_rmse, 'value')}
FROM sided, final GROUP BY side""",
        "gd_from_lines": f"""{trained(SHIFTED_YEAR)}
SELECT 'history' AS series, iter::INT AS iter, {rounded(HISTORY_RMSE, 'value')}
FROM descent, gram WHERE iter < {last}
UNION ALL
SELECT side, {last}::INT, {rounded(row_rmse, 'value')} FROM sided, final GROUP BY side""",
    }


def _ridges() -> dict[str, str]:
    products = f"{CHARGE}, {products_of()}"
    # the normal equations by conjugate gradients, in units of the features' deviations
    wide_ridge = wide_ridge_weights(64, 0.1)
    line = f"WITH {CHARGE}, fit AS (SELECT regr_slope(y, x[1]) AS a, " \
           "regr_intercept(y, x[1]) AS b FROM data)"
    return {
        "ols_1d": f"""{line}
SELECT 'slope' AS name, {rounded('a', 'value')} FROM fit
UNION ALL SELECT 'intercept', {rounded('b', 'value')} FROM fit""",
        "ols_train_rmse": f"""{line}
SELECT 'rmse' AS metric, {rounded('sqrt(avg((y - a * x[1] - b) ** 2))', 'value')}
FROM data, fit""",
        "grid_train_rmse": f"""WITH RECURSIVE {CHARGE}
SELECT reg AS "regParam", it::INT AS "maxIter", {rounded(RESIDUAL_RMSE, 'rmse')}
FROM data, {refit('data', 3)} fitted, {GRID} g(k, it) GROUP BY reg, it""",
        "ridge_cv_table": f"""WITH RECURSIVE {CHARGE}, {cross_validation('data', 3)}
SELECT reg AS "regParam", it::INT AS "maxIter", fold, {rounded('rmse', 'rmse')}
FROM fold_errors, {GRID} g(k, it)""",
        "ridge_rows_cv_table": f"""WITH RECURSIVE {CHARGE}, {cross_validation('data', 3)}
SELECT reg AS "regParam", it::INT AS "maxIter", fold, {rounded('rmse', 'rmse')}
FROM fold_errors, {GRID} g(k, it)""",
        "ridge_shifted_cv_table": f"""WITH RECURSIVE {products}, {cross_validation('products', 9)}
SELECT reg AS "regParam", it::INT AS "maxIter", {rounded('rmse', 'rmse')}
FROM mean_errors, {GRID} g(k, it)""",
        "ridge_sketched_weights": dual_ridge_weights(0.1),
        "ridge_wide_moments_weights": wide_ridge,
        "ridge_wide_rows_weights": wide_ridge,
        "ridge_near_perfect_rmse": """
SELECT round(1e9 * sqrt(avg((e - (SELECT avg(e) FROM t) - (SELECT regr_slope(e, p) FROM t)
  * (p - (SELECT avg(p) FROM t))) ** 2)), 3) + 0.0::DOUBLE AS value
FROM (SELECT * FROM t)""".replace("SELECT round", """WITH t AS (
  SELECT l_extendedprice / 100000 AS p,
         CASE WHEN l_orderkey % 2 = 0 THEN 1e-9 ELSE -1e-9 END::DOUBLE AS e FROM lineitem)
SELECT round"""),
        "raw_year_moments": f"""WITH {SONGS}
SELECT count(*) AS count, {rounded('avg(year)', 'mean')}, {rounded('stddev_pop(year)', 'deviation')}
FROM songs""",
        "ridge_cv_best": best("data", CHARGE, 3),
        "ridge_cv_weights": f"""WITH RECURSIVE {CHARGE}, {cross_validation('data', 3)}
SELECT i::INT AS idx, {rounded('w[i + 1]', 'value')}
FROM {refit('data', 3)} fitted JOIN winner USING (reg), range(3) AS r(i)""",
        "ridge_cv_errors": tuned_errors("data", CHARGE, 3),
        "poly_ridge_cv_table": f"""WITH RECURSIVE {products}, {cross_validation('products', 9)}
SELECT reg AS "regParam", it::INT AS "maxIter", {rounded('rmse', 'rmse')}
FROM mean_errors, {GRID} g(k, it)""",
        "poly_ridge_cv_best": best("products", products, 9),
        "poly_ridge_cv_errors": tuned_errors("products", products, 9),
    }


def _elastic_nets() -> dict[str, str]:
    def fitted(prefix, width, seed, keys=("l_orderkey", "l_linenumber")):
        return f"""WITH RECURSIVE {prefix}, {sides('data', 0.7, seed, keys)},
train AS (SELECT * FROM sided WHERE side = 'train'),
{moments('train', width, '1')}, {training(width, 'true')}, {elastic_net(width)}"""

    charge = fitted(CHARGE, 3, 0)

    def errors(places):
        return f"""{charge}
SELECT side, 'rmse' AS metric, {rounded(RESIDUAL_RMSE, 'value', places)}
FROM sided, elastic GROUP BY side"""

    # Rows of the CSV file are told apart by their text, as it is written there.
    csv = f"""{WIDE_TEXT},
data AS (
  SELECT y::DOUBLE - {K.FIRST_YEAR} AS y, list_transform(t, lambda e: e::DOUBLE) AS x,
         number, id, y || ',' || array_to_string(t, ',') AS text
  FROM wide WHERE try_cast(y AS DOUBLE) > 0 AND artist NOT IN ('1-URGENT', '5-LOW'))"""
    return {
        "elastic_net_errors": errors(6),
        "elastic_net_errors_mllib": errors(4),
        "elastic_net_rows_weights": f"""{charge}
SELECT i::INT AS idx, {rounded('w[i + 1]', 'value')} FROM elastic, range(3) AS r(i)""",
        "elastic_net_consensus_weights": f"""{charge}
SELECT i::INT AS idx, {rounded('w[i + 1]', 'value')} FROM elastic, range(3) AS r(i)""",
        "elastic_net_weights": f"""{charge}
SELECT i::INT AS idx, {rounded('w[i + 1]', 'value')} FROM elastic, range(3) AS r(i)""",
        "elastic_net_predictions": f"""{charge}
SELECT l_orderkey, l_linenumber, {rounded('y', 'label', 12)},
  {rounded(dot('w', 'x') + ' + intercept', 'prediction')}
FROM sided, elastic WHERE side = 'test'""",
        "wide_csv_regression_mllib": f"""{fitted(csv, 6, K.CSV_SEED, ('number', 'id', 'text'))}
SELECT side, 'rmse' AS metric, {rounded(RESIDUAL_RMSE, 'value', 3)}
FROM sided, elastic GROUP BY side""",
        "wide_csv_regression": f"""{fitted(csv, 6, K.CSV_SEED, ('number', 'id', 'text'))}
SELECT side || ' rmse' AS name, {rounded(RESIDUAL_RMSE, 'value')}
FROM sided, elastic GROUP BY side
UNION ALL
SELECT 'weight ' || i, {rounded('w[i + 1]', 'value')} FROM elastic, range(6) AS r(i)""",
    }


def twins() -> dict[str, str]:
    return {
        **_questions(), **_texts(), **_features(), **_errors(), **_descents(), **_ridges(),
        **_elastic_nets(),
    }
