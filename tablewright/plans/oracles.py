"""The registered results as plain SQL over the same tables, written without the library."""

from __future__ import annotations

import math
from statistics import NormalDist

BASE = """base AS MATERIALIZED (
SELECT o.o_orderkey AS id, o_totalprice, o_orderpriority, o_orderstatus, c_mktsegment, n_name, c_acctbal,
       year(o_orderdate) AS o_year, month(o_orderdate) AS o_month,
       l.n_lines, l.sum_qty, l.sum_price, l.avg_disc, l.top_flag, coalesce(l.has_return, 0) AS has_return
FROM orders o
JOIN customer c ON o_custkey = c_custkey
JOIN nation n ON c_nationkey = n_nationkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, sum(l_quantity) AS sum_qty, sum(l_extendedprice) AS sum_price,
                  avg(l_discount) AS avg_disc, min(l_returnflag) AS top_flag,
                  max(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS has_return
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey),
train AS (SELECT * FROM base WHERE o_year < 2000),
test AS (SELECT * FROM base WHERE o_year >= 2000)"""

NUMERIC = ["n_lines", "sum_qty", "avg_disc", "o_totalprice", "c_acctbal"]
COLUMNS = ["sum_price", *NUMERIC]
X3 = ["n_lines", "sum_qty", "c_acctbal"]
ALL = [
    "id", "o_totalprice", "o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name", "c_acctbal", "o_year", "o_month",
    "n_lines", "sum_qty", "sum_price", "avg_disc", "top_flag", "has_return",
]

#: Terms looked for in the documents, and what a gap in their labels means.
TERMS = ["the", "License", "und", "http", "zzzz"]
MEANINGS = {"quality": "not rated", "toxic": "not checked", "lang": "unknown", "not_there": "no such column"}
MEANING_TERMS = {"quality": "License", "toxic": "http", "lang": "und"}

UNION = "\nUNION ALL\n"


def sql(body: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([BASE, *ctes]) + "\n" + body


def hashed(key: str = "id") -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR)), 1, 8) AS BIGINT)"


# ---------------------------------------------------------------- missing values and catalogue


def gaps(table: str, columns, extra: str = "") -> str:
    return UNION.join(
        f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_count, count(*) AS n_rows {extra} FROM {table}" for c in columns
    )


def missing_summary() -> str:
    return sql(
        f"SELECT \"column\", missing_count, 100.0 * missing_count / n_rows AS missing_percent FROM ({gaps('base', ALL)}) g "
        "WHERE missing_count > 0"
    )


RATED = "rated AS (SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels USING (doc_id))"


def missing_summary_documents() -> str:
    columns = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
    return (
        f"WITH {RATED} SELECT \"column\", missing_count, 100.0 * missing_count / n_rows AS missing_percent "
        f"FROM ({gaps('rated', columns)}) g WHERE missing_count > 0"
    )


ROLES = [
    ("o_totalprice", "numeric continuous", "standard scale", "double"),
    ("c_acctbal", "numeric continuous", "standard scale", "double"),
    ("sum_qty", "numeric continuous", "standard scale", "double"),
    ("avg_disc", "numeric continuous", "standard scale", "double"),
    ("n_lines", "numeric count", "standard scale", "bigint"),
    ("o_orderpriority", "ordinal", "ordinal codes", "string"),
    ("n_name", "nominal", "one column per level", "string"),
    ("c_mktsegment", "nominal", "one column per level", "string"),
    ("o_orderstatus", "nominal", "one column per level", "string"),
    ("top_flag", "nominal", "one column per level", "string"),
    ("has_return", "binary", "map to 0 and 1", "int"),
    ("o_month", "special", "text, then one column per level", "int"),
    ("o_year", "special", "text, then one column per level", "int"),
    ("sum_price", "target", "log1p", "double"),
    ("id", "id", "dropped", "bigint"),
]


def catalog_check() -> str:
    return sql(
        UNION.join(
            f"SELECT '{c}' AS feature, '{r}' AS role, '{t}' AS treatment, 1 AS in_table, '{d}' AS data_type, "
            f"100.0 * (count(*) - count({c})) / count(*) AS null_percent, count(DISTINCT {c}) AS n_distinct FROM base"
            for c, r, t, d in ROLES
        )
    )


def term_coverage() -> str:
    return UNION.join(
        f"SELECT '{t}' AS term, count(*) FILTER (WHERE contains(text, '{t}')) AS n_texts FROM documents" for t in TERMS
    )


def term_coverage_many(k: int = 1000) -> str:
    """The words in the most texts, and the texts that hold them anywhere."""
    return f"""WITH words AS (SELECT DISTINCT doc_id, unnest(string_split(text, ' ')) AS word FROM documents),
    terms AS (SELECT word AS term FROM words WHERE length(word) >= 3 GROUP BY word ORDER BY count(*) DESC, word LIMIT {k})
    SELECT term, count(*) FILTER (WHERE contains(text, term)) AS n_texts FROM terms CROSS JOIN documents GROUP BY term"""


def na_semantics() -> str:
    parts = []
    for c, meaning in MEANINGS.items():
        term, there = MEANING_TERMS.get(c, c), c != "not_there"
        found = f"(SELECT count(*) FROM documents WHERE contains(text, '{term}'))"
        gap = f"(SELECT count(*) - count({c}) FROM rated)" if there else "NULL"
        parts.append(
            f"SELECT '{c}' AS \"column\", '{meaning}' AS na_meaning, '{term}' AS term, {int(there)} AS in_table, "
            f"{found} AS n_texts, {gap} AS missing_count, CASE WHEN {found} > 0 THEN 1 ELSE 0 END AS mentioned"
        )
    return f"WITH {RATED} " + UNION.join(parts)


def missing_before_after() -> str:
    columns = [c for c in ALL if c != "sum_price"]
    return sql(
        UNION.join(
            f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS missing_before, 0 AS missing_after FROM train"
            for c in columns
        )
    )


PARTS = "parts AS (SELECT 'train' AS part, * FROM train UNION ALL SELECT 'test' AS part, * FROM test)"


def impute_constant() -> str:
    return sql(
        "SELECT part, id, coalesce(top_flag, 'None') AS top_flag, coalesce(n_lines, 0) AS n_lines, "
        "coalesce(sum_qty, 0) AS sum_qty, coalesce(avg_disc, 0) AS avg_disc FROM parts",
        PARTS,
    )


def _typical(table: str, name: str) -> str:
    return (
        f"{name} AS (SELECT (SELECT top_flag FROM {table} WHERE top_flag IS NOT NULL GROUP BY top_flag "
        f"ORDER BY count(*) DESC, top_flag LIMIT 1) AS top_flag, quantile_cont(n_lines, 0.5) AS n_lines, "
        f"quantile_cont(sum_qty, 0.5) AS sum_qty, quantile_cont(avg_disc, 0.5) AS avg_disc FROM {table})"
    )


def _filled(source: str, fill: str, label: str) -> str:
    return (
        f"SELECT {label}, t.id, coalesce(t.top_flag, f.top_flag) AS top_flag, "
        + ", ".join(f"coalesce(CAST(t.{c} AS DOUBLE), f.{c}) AS {c}" for c in ("n_lines", "sum_qty", "avg_disc"))
        + f" FROM {source} t CROSS JOIN {fill} f"
    )


def impute_median_mode() -> str:
    return sql(_filled("parts", "f", "t.part AS part"), PARTS, _typical("train", "f"))


def impute_test_scope() -> str:
    return sql(
        _filled("test", "f", "'train' AS scope") + UNION + _filled("test", "g", "'test' AS scope"),
        "complete AS (SELECT * FROM train WHERE n_lines IS NOT NULL)",
        _typical("complete", "f"),
        _typical("test", "g"),
    )


def strategy_log() -> str:
    return sql(
        UNION.join(
            [
                "SELECT 0 AS step, 'top_flag' AS \"column\", 'fillna(''None'')' AS strategy, 'No feature' AS reason",
                "SELECT 1, 'n_lines', 'fillna(0)', 'No numeric feature'",
                "SELECT 2, 'avg_disc', printf('fillna(median=%.4f)', avg_disc), 'True missing numeric' FROM f",
                "SELECT 3, 'sum_qty', printf('fallback fillna(median=%.4f)', sum_qty), 'Remaining numeric missing' FROM f",
            ]
        ),
        _typical("train", "f"),
    )


# ---------------------------------------------------------------- derived columns and filters

WHOLE = "(sum_qty + 10 * n_lines)"


def derived_features() -> str:
    return sql(
        f"""SELECT id, {WHOLE} AS whole, o_totalprice - sum_price AS price_gap,
        CASE WHEN avg_disc > 0 THEN 1 ELSE 0 END AS has_discount, CASE WHEN c_acctbal > 0 THEN 1 ELSE 0 END AS has_balance,
        coalesce(sum_qty, 0) + coalesce(n_lines, 0) + coalesce(c_acctbal, 0) AS row_total,
        (sum_qty + n_lines) / 2.0 AS row_mean FROM base"""
    )


def row_sum_mean() -> str:
    return sql(
        """SELECT id, coalesce(sum_qty, 0) + coalesce(n_lines, 0) + coalesce(avg_disc, 0) AS row_total,
        list_avg(list_filter([sum_qty, CAST(n_lines AS DOUBLE), avg_disc], lambda v: v IS NOT NULL)) AS row_mean FROM base"""
    )


def presence_flags() -> str:
    return sql(
        UNION.join(
            f"SELECT '{k}' AS flag, count(*) FILTER (WHERE {c} > 0) AS n_set, count(*) AS n_rows FROM base"
            for k, c in (("has_lines", "n_lines"), ("has_discount", "avg_disc"), ("has_balance", "c_acctbal"))
        )
    )


FLAG = "CASE WHEN n_lines > 8 AND sum_price < 300000 THEN 1 ELSE 0 END"


def outlier_flag() -> str:
    return sql(f"SELECT id, n_lines, sum_price, {FLAG} AS is_outlier FROM base")


def outlier_candidates() -> str:
    return sql(f"SELECT id, n_lines, sum_price, n_name FROM base WHERE {FLAG} = 1")


def outlier_removed() -> str:
    return sql(f"SELECT id, n_lines, sum_price FROM base WHERE {FLAG} = 0")


def log1p_roundtrip() -> str:
    return sql("SELECT id, ln(1 + sum_price) AS logged, sum_price AS back FROM base")


def value_mapped() -> str:
    return sql(
        """SELECT id, CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3
        WHEN '1-URGENT' THEN 4 END AS priority,
        CASE c_mktsegment WHEN 'BUILDING' THEN 1 WHEN 'MACHINERY' THEN 2 ELSE 0 END AS segment,
        CASE coalesce(top_flag, 'None') WHEN 'None' THEN 0 WHEN 'A' THEN 1 WHEN 'N' THEN 2 WHEN 'R' THEN 3 END AS flag
        FROM base"""
    )


# ---------------------------------------------------------------- segments, bins and shapes


def _segment(by: str, x: str, table: str) -> str:
    return f"""SELECT {by}, count(*) AS count, quantile_cont({x}, 0.5) AS median, quantile_cont({x}, 0.25) AS q1,
        quantile_cont({x}, 0.75) AS q3, avg({x}) AS mean, stddev_samp({x}) AS std,
        quantile_cont({x}, 0.75) - quantile_cont({x}, 0.25) AS iqr FROM {table} GROUP BY {by}"""


def segment_stats() -> str:
    return sql(_segment("n_name", "sum_price", "base"))


def segment_by_median() -> str:
    return sql(_segment("c_mktsegment", "sum_price", "base"))


def segment_order() -> str:
    return sql("SELECT o_orderpriority, quantile_cont(sum_price, 0.5) AS median FROM base GROUP BY 1")


def segment_stats_lines() -> str:
    return _segment("l_returnflag", "l_extendedprice", "lineitem")


def group_mean_error() -> str:
    return sql("SELECT n_name, avg(abs(sum_price - o_totalprice)) AS mean_error FROM base GROUP BY 1")


def _labelled_bins(shares, labels, x: str = "sum_price", table: str = "base") -> str:
    edges = f"(SELECT quantile_cont({x}, {shares}) AS e FROM {table})"
    whens = " ".join(f"WHEN {x} <= e[{i + 2}] THEN '{label}'" for i, label in enumerate(labels))
    return f"(SELECT b.*, CASE {whens} END AS segment FROM {table} b CROSS JOIN {edges} q WHERE {x} IS NOT NULL)"


def _segments(shares, labels) -> str:
    return sql(
        "SELECT segment, count(*) AS n, avg(sum_price) AS mean, min(sum_price) AS lowest, max(sum_price) AS highest "
        f"FROM {_labelled_bins(shares, labels)} s GROUP BY 1"
    )


PRICE = [0.0, 0.5, 0.9, 1.0], ["Mainstream_50pct", "UpperMid_40pct", "Luxury_10pct"]


def qcut3_segments() -> str:
    return _segments([0.0, 1 / 3, 2 / 3, 1.0], ["Low", "Mid", "High"])


def price_segments() -> str:
    return _segments(*PRICE)


def _bin_of(x: str, edges: str) -> str:
    """Right-closed bin by the number of distinct edges below the value."""
    return f"greatest(len(list_filter(list_distinct({edges}), lambda e: e < {x})) - 1, 0)"


def _even(n: int) -> str:
    return "[" + ", ".join(repr(i / n) for i in range(n + 1)) + "]"


def _variance_ratios() -> str:
    parts = UNION.join(
        f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, sum_price AS y FROM base WHERE {c} IS NOT NULL AND sum_price IS NOT NULL"
        for c in NUMERIC
    )
    return f"""(SELECT feature, count(v) AS n_bins, CASE WHEN count(v) > 1 AND min(v) > 0 THEN max(v) / min(v) END AS variance_ratio
    FROM (SELECT feature, {_bin_of('x', 'e')} AS bin, var_samp(y) AS v
          FROM ({parts}) p JOIN (SELECT feature, quantile_cont(x, {_even(5)}) AS e FROM ({parts}) q GROUP BY 1) USING (feature)
          GROUP BY 1, 2) w GROUP BY 1)"""


def variance_ratio_q5() -> str:
    return sql(f"SELECT * FROM {_variance_ratios()} r")


def _histogram(x: str, table: str, bins: int, extra: str = "") -> str:
    return f"""SELECT {extra} b AS bin, lo + (b - 1) * (hi - lo) / {bins} AS lower, lo + b * (hi - lo) / {bins} AS upper,
        (SELECT count(*) FROM {table} WHERE {x} IS NOT NULL AND least(floor({bins} * ({x} - lo) / (hi - lo)) + 1, {bins}) = b) AS n
        FROM range(1, {bins + 1}) t(b) CROSS JOIN (SELECT min({x}) AS lo, max({x}) AS hi FROM {table}) m"""


def histogram50() -> str:
    return sql(
        _histogram("sum_price", "base", 50, "'raw' AS version,")
        + UNION
        + _histogram("logged", "logs", 50, "'log1p' AS version,"),
        "logs AS (SELECT ln(1 + sum_price) AS logged FROM base)",
    )


def histogram50_lines() -> str:
    return _histogram("l_extendedprice", "lineitem", 50)


def density_curve() -> str:
    """Every row at every point."""
    parts = [
        f"""SELECT '{name}' AS version, point, x, sum(exp(-0.5 * pow((x - v) / h, 2))) / (any_value(n) * any_value(h) * sqrt(2 * pi())) AS density
        FROM (SELECT p AS point, lo + p * (hi - lo) / 199 AS x, h, n FROM range(0, 200) t(p) CROSS JOIN
              (SELECT min({x}) AS lo, max({x}) AS hi, count({x}) AS n, stddev_samp({x}) * pow(count({x}), -0.2) AS h FROM base) m) g
        CROSS JOIN (SELECT {x} AS v FROM base WHERE sum_price IS NOT NULL) r GROUP BY point, x"""
        for name, x in (("raw", "sum_price"), ("log1p", "ln(1 + sum_price)"))
    ]
    return sql(UNION.join(parts))


FENCED = """fenced AS (SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM
    (SELECT n_name, count(sum_price) AS n, quantile_cont(sum_price, 0.25) AS q1, quantile_cont(sum_price, 0.5) AS median,
     quantile_cont(sum_price, 0.75) AS q3 FROM base GROUP BY 1) f)"""


def boxplot_stats() -> str:
    inside = "sum_price BETWEEN lower_fence AND upper_fence"
    return sql(
        f"""SELECT n_name, n, q1, median, q3, lower_fence, upper_fence, min(sum_price) FILTER (WHERE {inside}) AS whisker_low,
        max(sum_price) FILTER (WHERE {inside}) AS whisker_high, count(*) FILTER (WHERE NOT ({inside})) AS n_outliers
        FROM base JOIN fenced USING (n_name) GROUP BY ALL""",
        FENCED,
    )


def boxplot_outliers() -> str:
    return sql(
        "SELECT id, n_name, sum_price FROM base JOIN fenced USING (n_name) "
        "WHERE sum_price < lower_fence OR sum_price > upper_fence",
        FENCED,
    )


#: The rational approximations of the normal quantile (algorithm AS 241), numerators and denominators from the lowest power.
NORMAL_MIDDLE = (
    ["3.3871328727963666080", "133.14166789178437745", "1971.5909503065514427", "13731.693765509461125", "45921.953931549871457", "67265.770927008700853", "33430.575583588128105", "2509.0809287301226727"],
    ["1.0", "42.313330701600911252", "687.18700749205790830", "5394.1960214247511077", "21213.794301586595867", "39307.895800092710610", "28729.085735721942674", "5226.4952788528545610"],
)
NORMAL_TAIL = (
    ["1.42343711074968357734", "4.63033784615654529590", "5.76949722146069140550", "3.64784832476320460504", "1.27045825245236838258", "0.241780725177450611770", "0.0227238449892691845833", "0.000774545014278341407640"],
    ["1.0", "2.05319162663775882187", "1.67638483018380384940", "0.689767334985100004550", "0.148103976427480074590", "0.0151986665636164571966", "0.000547593808499534494600", "1.05075007164441684324e-9"],
)


def normal_quantile(p: str) -> str:
    """For probabilities not nearer than 10^-11 to 0 or 1."""

    def ratio(tables, x):
        above, below = (" + ".join(f"{c}::DOUBLE * pow({x}, {k})" for k, c in enumerate(t)) for t in tables)
        return f"(({above}) / ({below}))"

    q = f"({p} - 0.5)"
    far = f"(sqrt(-ln(least({p}, 1 - {p}))) - 1.6)"
    return f"CASE WHEN abs({q}) <= 0.425 THEN {q} * {ratio(NORMAL_MIDDLE, f'(0.180625 - {q} * {q})')} ELSE sign({q}) * {ratio(NORMAL_TAIL, far)} END"


def qq_points() -> str:
    """Points at even probabilities; the line is that of all rows, each at the median of its order statistic."""
    probs = [(i + 0.5) / 99 for i in range(99)]
    z = "z(point, probability, theoretical) AS (VALUES " + ", ".join(
        f"({i}, {p!r}::DOUBLE, {NormalDist().inv_cdf(p)!r}::DOUBLE)" for i, p in enumerate(probs)
    ) + ")"
    versions = {"raw": "sum_price", "log1p": "ln(1 + sum_price)"}
    obs = UNION.join(f"SELECT '{n}' AS version, unnest(range(0, 99)) AS point, unnest(quantile_cont({x}, {probs!r})) AS observed FROM base" for n, x in versions.items())
    ranked = UNION.join(
        f"SELECT '{n}' AS version, {x} AS y, row_number() OVER (ORDER BY {x}) AS i, count(*) OVER () AS n FROM base WHERE sum_price IS NOT NULL" for n, x in versions.items()
    )
    share = "CASE WHEN i = 1 THEN 1 - pow(0.5, 1.0 / n) WHEN i = n THEN pow(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END"
    return sql(
        "SELECT version, point, probability, theoretical, observed, slope, intercept, r FROM obs JOIN z USING (point) JOIN lines USING (version)",
        z,
        f"obs AS ({obs})",
        f"scored AS MATERIALIZED (SELECT version, y, {normal_quantile('p')} AS x FROM (SELECT version, y, ({share})::DOUBLE AS p FROM ({ranked}) k) s)",
        "lines AS (SELECT version, regr_slope(y, x) AS slope, regr_intercept(y, x) AS intercept, corr(y, x) AS r FROM scored GROUP BY version)",
    )


def scatter_extract() -> str:
    return sql(f"SELECT id, n_lines, sum_price, {FLAG} AS is_outlier, n_name FROM base")


def argmax_row_profile() -> str:
    columns = ["o_year", "o_month", "has_return", *NUMERIC]
    out = []
    for which, order in (("high", "DESC"), ("low", "ASC")):
        values = UNION.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {which}_row" for c in columns)
        out.append(f"(SELECT '{which}' AS which, feature, value FROM ({values}) v WHERE value IS NOT NULL ORDER BY value DESC, feature LIMIT 5)")
    return sql(
        UNION.join(out),
        *[
            f"{w}_row AS (SELECT * FROM base WHERE sum_price IS NOT NULL ORDER BY sum_price {o}, id LIMIT 1)"
            for w, o in (("high", "DESC"), ("low", "ASC"))
        ],
    )


def trend_line() -> str:
    return sql(
        UNION.join(
            f"SELECT '{c}' AS feature, regr_count(sum_price, {c}) AS n, regr_slope(sum_price, {c}) AS slope, "
            f"regr_intercept(sum_price, {c}) AS intercept, regr_r2(sum_price, {c}) AS r2 FROM base"
            for c in NUMERIC
        )
    )


def trend_quadratic() -> str:
    """Two regressors, x centred and its square, by Cramer's rule; then back to powers of x."""
    parts = []
    for c in NUMERIC:
        rows = f"(SELECT {c} - m AS u, pow({c} - m, 2) AS v, sum_price AS y, m FROM base CROSS JOIN (SELECT avg({c}) AS m FROM base WHERE sum_price IS NOT NULL) a WHERE {c} IS NOT NULL AND sum_price IS NOT NULL)"
        sums = f"(SELECT any_value(m) AS m, var_pop(u) AS uu, var_pop(v) AS vv, covar_pop(u, v) AS uv, covar_pop(u, y) AS uy, covar_pop(v, y) AS vy, avg(u) AS mu, avg(v) AS mv, avg(y) AS my FROM {rows} r)"
        weights = f"(SELECT *, (uy * vv - vy * uv) / (uu * vv - uv * uv) AS b, (vy * uu - uy * uv) / (uu * vv - uv * uv) AS c FROM {sums} s)"
        parts.append(f"SELECT '{c}' AS feature, my - b * mu - c * mv - b * m + c * m * m AS c0, b - 2 * c * m AS c1, c AS c2 FROM {weights} w")
    return sql(UNION.join(parts))


# ---------------------------------------------------------------- distribution and correlation


def _shape(version: str, x: str, table: str) -> str:
    """Jarque-Bera from central moments, the adjusted forms from the built-in functions."""
    return f"""SELECT '{version}' AS version, n, g1 AS skewness, g2 AS excess_kurtosis, jb AS jb_stat, exp(-jb / 2) AS jb_p FROM
    (SELECT n, g1, g2, n / 6.0 * (pow(m3 / pow(m2, 1.5), 2) + pow(m4 / (m2 * m2) - 3, 2) / 4) AS jb FROM
     (SELECT count(x) AS n, skewness(x) AS g1, kurtosis(x) AS g2, avg(pow(x - m, 2)) AS m2, avg(pow(x - m, 3)) AS m3, avg(pow(x - m, 4)) AS m4
      FROM (SELECT {x} AS x FROM {table}) a CROSS JOIN (SELECT avg({x}) AS m FROM {table}) b) c) d"""


def distribution_diagnostics() -> str:
    return sql(_shape("sum_price", "sum_price", "base") + UNION + _shape("log1p(sum_price)", "ln(1 + sum_price)", "base"))


def distribution_events() -> str:
    return _shape("value", "value", "events") + UNION + _shape("log1p(value)", "ln(1 + value)", "events")


def distribution_before_after() -> str:
    kept = f"(SELECT sum_price FROM base WHERE {FLAG} = 0)"
    return sql(
        _shape("before_sum_price", "sum_price", "base")
        + UNION
        + _shape("after_outlier_sum_price", "sum_price", kept)
        + UNION
        + _shape("after_log1p_sum_price", "ln(1 + sum_price)", kept)
    )


def _matrix(columns, table: str = "base") -> str:
    return "(" + UNION.join(f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM {table}" for a in columns for b in columns) + ")"


MATRIX = f"matrix AS MATERIALIZED {_matrix(COLUMNS)}"

WIDE = [*COLUMNS, "o_year", "o_month", "has_return", "whole", "half", "other", "apart"]
#: The base table with more columns; ``apart`` is very large just where ``other`` is missing.
WIDE_BASE = """wide AS MATERIALIZED (SELECT *, sum_qty + 10 * n_lines AS whole, CASE WHEN id % 2 = 0 THEN sum_qty END AS half,
       CASE WHEN id % 3 > 0 THEN sum_price END AS other,
       CASE WHEN id % 3 = 0 THEN 1e12 + id ELSE c_acctbal END AS apart FROM base)"""


def pearson_matrix_wide() -> str:
    return sql(_matrix(WIDE, "wide")[1:-1], WIDE_BASE)


def collinear_pairs_wide() -> str:
    place = "CASE {} " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(WIDE)) + " END"
    return sql(
        "SELECT a AS feature_a, b AS feature_b, abs(r) AS abs_r FROM matrix "
        f"WHERE abs(r) >= 0.8 AND ({place.format('a')}) < ({place.format('b')})",
        WIDE_BASE,
        f"matrix AS MATERIALIZED {_matrix(WIDE, 'wide')}",
    )


def pearson_matrix() -> str:
    return sql("SELECT * FROM matrix", MATRIX)


def pearson_ranking() -> str:
    return sql("SELECT a AS feature, r AS pearson FROM matrix WHERE b = 'sum_price'", MATRIX)


def _p_value(r: str, n: str) -> str:
    """Simpson's rule on the density of r under no correlation, from abs(r) as far as it matters."""
    top, k = f"least(1.0, abs({r}) + 14.0 / sqrt({n}))", 4000
    step = f"(({top} - abs({r})) / {k})"
    weight = f"CASE WHEN i = 0 OR i = {k} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    log_density = f"(({n}) - 4) / 2.0 * ln(greatest(1 - pow(abs({r}) + i * {step}, 2), 1e-300)) + lgamma(({n} - 1) / 2.0) - lgamma(({n} - 2) / 2.0) - 0.5 * ln(pi())"
    return f"(SELECT 2 * sum({weight} * exp({log_density})) * {step} / 3 FROM range(0, {k + 1}) t(i))"


def _linear_p() -> str:
    found = UNION.join(f"SELECT '{c}' AS feature, regr_count(sum_price, {c}) AS n, corr(sum_price, {c}) AS pearson FROM base" for c in NUMERIC)
    return f"(SELECT feature, n, pearson, {_p_value('pearson', 'n')} AS p_value FROM ({found}) f)"


def pearson_p_values() -> str:
    return sql(f"SELECT * FROM {_linear_p()} p")


def collinear_pairs() -> str:
    place = "CASE {} " + " ".join(f"WHEN '{c}' THEN {i}" for i, c in enumerate(COLUMNS)) + " END"
    return sql(
        "SELECT a AS feature_a, b AS feature_b, abs(r) AS abs_r FROM matrix "
        f"WHERE abs(r) >= 0.8 AND ({place.format('a')}) < ({place.format('b')})",
        MATRIX,
    )


def correlation_importance() -> str:
    return sql("SELECT a AS feature, r AS pearson FROM matrix WHERE b = 'sum_price' AND a <> 'sum_price' ORDER BY r DESC LIMIT 3", MATRIX)


def top_submatrix(k: int = 3) -> str:
    return sql(
        f"SELECT m.a, m.b, m.r FROM matrix m JOIN ranked x ON m.a = x.a JOIN ranked y ON m.b = y.a WHERE x.place <= {k} AND y.place <= {k}",
        MATRIX,
        "ranked AS MATERIALIZED (SELECT a, row_number() OVER (ORDER BY r DESC, a) AS place FROM matrix WHERE b = 'sum_price')",
    )


def top_submatrix_wide(k: int = 10) -> str:
    return sql(
        f"SELECT m.a, m.b, m.r FROM matrix m JOIN ranked x ON m.a = x.a JOIN ranked y ON m.b = y.a WHERE x.place <= {k} AND y.place <= {k}",
        WIDE_BASE,
        f"matrix AS MATERIALIZED {_matrix(WIDE, 'wide')}",
        "ranked AS MATERIALIZED (SELECT a, row_number() OVER (ORDER BY r DESC, a) AS place FROM matrix WHERE b = 'sum_price' AND r IS NOT NULL)",
    )


def correlation_importance_encoded(k: int = 15) -> str:
    return f"SELECT * FROM ({encoded_correlation()}) e WHERE feature <> 'sum_price' ORDER BY pearson DESC, feature LIMIT {k}"


def row_profile_wide(k: int = 10) -> str:
    columns, out = [c for c in WIDE if c != "sum_price"], []
    for which, order in (("high", "DESC"), ("low", "ASC")):
        values = UNION.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS value FROM {which}_row" for c in columns)
        out.append(f"(SELECT '{which}' AS which, feature, value FROM ({values}) v WHERE value IS NOT NULL ORDER BY value DESC, feature LIMIT {k})")
    rows = [f"{w}_row AS (SELECT * FROM wide WHERE sum_price IS NOT NULL ORDER BY sum_price {o}, id LIMIT 1)" for w, o in (("high", "DESC"), ("low", "ASC"))]
    return sql(UNION.join(out), WIDE_BASE, *rows)


def _spearman(x: str, y: str, table: str) -> str:
    return f"""SELECT '{x}' AS feature, count(*) AS n, corr(rx, ry) AS spearman FROM
    (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
            rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry
     FROM (SELECT {x} AS x, {y} AS y FROM {table} WHERE {x} IS NOT NULL AND {y} IS NOT NULL) v) r"""


def _spearman_all() -> str:
    return "(" + UNION.join(_spearman(c, "sum_price", "base") for c in NUMERIC) + ")"


def spearman_ranking() -> str:
    return sql(f"SELECT * FROM {_spearman_all()} s")


def spearman_lines() -> str:
    return _spearman("l_quantity", "l_extendedprice", "lineitem") + UNION + _spearman("l_discount", "l_extendedprice", "lineitem")


def relationship_diagnostics() -> str:
    return sql(
        f"""SELECT feature, p.n, pearson, p_value AS pearson_p, spearman, {_p_value('s.spearman', 's.n')} AS spearman_p,
        abs(spearman) - abs(pearson) AS monotonic_minus_linear, variance_ratio
        FROM {_linear_p()} p JOIN {_spearman_all()} s USING (feature) JOIN {_variance_ratios()} v USING (feature)"""
    )


def mutual_information() -> str:
    values = UNION.join(f"SELECT '{c}' AS feature, CAST({c} AS DOUBLE) AS x, sum_price AS y FROM base" for c in NUMERIC)
    return sql(
        """SELECT feature, sum(n / nt * ln(n * nt / (nx * ny))) AS mi FROM
        (SELECT feature, CAST(n AS DOUBLE) AS n, sum(n) OVER (PARTITION BY feature, xb)::DOUBLE AS nx,
                sum(n) OVER (PARTITION BY feature, yb)::DOUBLE AS ny, sum(n) OVER (PARTITION BY feature)::DOUBLE AS nt FROM cells) c GROUP BY 1""",
        f"vals AS ({values})",
        f"ye AS (SELECT quantile_cont(sum_price, {_even(10)}) AS e2 FROM base)",
        f"xe AS (SELECT feature, quantile_cont(x, {_even(10)}) AS e1 FROM vals GROUP BY 1)",
        f"""cells AS (SELECT feature, {_bin_of('x', 'e1')} AS xb, {_bin_of('y', 'e2')} AS yb, count(*) AS n
        FROM vals JOIN xe USING (feature) CROSS JOIN ye WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY 1, 2, 3)""",
    )


def feature_gain() -> str:
    return sql(
        UNION.join(
            f"SELECT '{name}' AS feature, corr({x}, sum_price) AS pearson FROM base"
            for name, x in (("sum_qty", "sum_qty"), ("n_lines", "n_lines"), ("whole", WHOLE))
        )
    )


# ---------------------------------------------------------------- encoding


def standard_scaled() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in NUMERIC)
    return sql(
        "SELECT part, id, " + ", ".join(f"({c} - m_{c}) / s_{c} AS {c}" for c in NUMERIC) + " FROM parts CROSS JOIN st",
        PARTS,
        f"st AS (SELECT {stats} FROM train)",
    )


PRIORITY = """CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2
    WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 ELSE -1 END"""


def ordinal_encoded() -> str:
    return sql(f"SELECT id, {PRIORITY} AS o_orderpriority, CASE top_flag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE -1 END AS flag FROM base")


def one_hot() -> str:
    years = ", ".join(f"CASE WHEN o_year = {y} THEN 1 ELSE 0 END AS o_year_{y}" for y in range(1995, 2000))
    flags = ", ".join(f"CASE WHEN top_flag = '{f}' THEN 1 ELSE 0 END AS top_flag_{f}" for f in "ANR")
    return sql(
        f"""SELECT id, {years}, {flags}, CASE WHEN o_year < 2000 THEN 1 ELSE 0 END + CASE WHEN top_flag IS NULL THEN 0 ELSE 1 END AS n_set
        FROM base"""
    )


def label_encoded() -> str:
    def code(c):
        return f"dense_rank() OVER (ORDER BY {c}) - 1 AS {c}"

    median = ", ".join(
        f"coalesce(CAST({c} AS DOUBLE), (SELECT quantile_cont({c}, 0.5) FROM base)) AS {c}" for c in ("n_lines", "sum_qty", "avg_disc")
    )
    return sql(
        f"""SELECT id, {code('n_name')}, {code('c_mktsegment')}, {code('top_flag')}, n_lines, sum_qty, avg_disc
        FROM (SELECT id, n_name, c_mktsegment, coalesce(top_flag, 'Missing') AS top_flag, {median} FROM base) f"""
    )


def label_encoded_large() -> str:
    return "SELECT c_custkey, dense_rank() OVER (ORDER BY c_name) - 1 AS code FROM customer"


def binary_mapped() -> str:
    return sql("SELECT id, has_return AS returned, CASE WHEN c_mktsegment = 'BUILDING' THEN 1 ELSE 0 END AS building FROM base")


def special_coded() -> str:
    return sql(
        """SELECT id, CAST(o_month AS VARCHAR) AS o_month, CAST(o_year AS VARCHAR) AS o_year,
        coalesce(CAST(n_lines AS VARCHAR), 'None') AS n_lines FROM base"""
    )


#: Levels of the nominal columns on the train side.
LEVELS = {
    "n_name": [f"NATION_{i}" for i in range(25)],
    "c_mktsegment": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "o_orderstatus": ["F", "O", "P"],
    "top_flag": ["A", "N", "R"],
    "o_month": [str(m) for m in range(1, 13)],
    "o_year": [str(y) for y in range(1995, 2000)],
}
SCALED = ["o_totalprice", "c_acctbal", "sum_qty", "avg_disc", "n_lines", "whole"]


def encoded_columns() -> str:
    hot = [f"{c}_{v}:l" for c, levels in LEVELS.items() for v in levels]
    return " ".join(["part:s", "id:l", *[f"{c}:f8" for c in SCALED], "o_orderpriority:l", *hot, "has_return:l", "has_discount:l"])


#: Filled and derived rows of both tables, the train side with a target only.
CLEAN = """clean AS (SELECT *, sum_qty + 10 * n_lines AS whole, CASE WHEN avg_disc > 0 THEN 1 ELSE 0 END AS has_discount FROM
    (SELECT CASE WHEN o_year < 2000 THEN 'train' ELSE 'test' END AS part, id, o_totalprice, o_orderpriority, o_orderstatus, c_mktsegment,
     n_name, c_acctbal, o_year, o_month, has_return, sum_price, coalesce(n_lines, 0) AS n_lines, coalesce(sum_qty, 0) AS sum_qty,
     coalesce(avg_disc, 0) AS avg_disc, coalesce(top_flag, 'None') AS top_flag FROM base WHERE o_year >= 2000 OR sum_price IS NOT NULL) f)"""


def _encoded() -> str:
    stats = ", ".join(f"avg({c}) AS m_{c}, coalesce(nullif(stddev_pop({c}), 0), 1) AS s_{c}" for c in SCALED)
    out = [f"({c} - m_{c}) / s_{c} AS {c}" for c in SCALED] + [f"{PRIORITY} AS o_orderpriority"]
    out += [f"CASE WHEN CAST({c} AS VARCHAR) = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in LEVELS.items() for v in vs]
    out += ["has_return", "has_discount"]
    return f"encoded AS (SELECT part, id, sum_price, {', '.join(out)} FROM clean CROSS JOIN (SELECT {stats} FROM clean WHERE part = 'train') st)"


def encoded_matrix() -> str:
    return sql("SELECT * EXCLUDE (sum_price) FROM encoded", CLEAN, _encoded())


def _profile(stage: str, feature: str, kind: str, x: str, table: str, number: bool) -> str:
    nonzero = f"count(*) FILTER (WHERE {x} <> 0)" if number else f"count({x})"
    return (
        f"SELECT '{stage}' AS stage, '{feature}' AS feature, '{kind}' AS feature_type, count(*) AS n_rows, count(*) - count({x}) AS n_null, "
        f"{nonzero} * 1.0 / count(*) AS nonzero_rate, count(DISTINCT {x}) AS n_distinct FROM {table}"
    )


TEXT = ["o_orderpriority", "o_orderstatus", "c_mktsegment", "n_name", "top_flag"]


def encoded_profile() -> str:
    raw = [_profile("raw", c, "Raw", c, "rawt", c not in TEXT) for c in ALL if c not in ("id", "sum_price")]
    made = [
        _profile("engineered", "whole", "Engineered Numeric", "whole", "cleant", True),
        _profile("engineered", "has_discount", "Binary", "has_discount", "cleant", True),
    ]
    kinds = {"o_orderpriority": "Ordinal Encoded", "has_return": "Binary", "has_discount": "Binary"}
    encoded = [
        _profile("encoded", c, kinds.get(c, "OneHot Encoded"), f'"{c}"', "encodedt", True)
        for c in ("o_orderpriority", "top_flag_A", "has_return", "has_discount", "o_year_1995")
    ]
    return sql(
        UNION.join(raw + made + encoded),
        CLEAN,
        _encoded(),
        "rawt AS (SELECT * FROM train WHERE sum_price IS NOT NULL)",
        "cleant AS (SELECT * FROM clean WHERE part = 'train')",
        "encodedt AS (SELECT * FROM encoded WHERE part = 'train')",
    )


def encoded_profile_all() -> str:
    """All columns of all three stages."""
    raw = [_profile("raw", c, "Raw", c, "rawt", c not in TEXT) for c in ALL if c not in ("id", "sum_price")]
    kinds = {**{c: "Numeric" for c in SCALED}, "whole": "Engineered Numeric", "has_return": "Binary", "has_discount": "Binary"}
    derived = [c for c in ALL if c not in ("id", "sum_price")] + ["whole", "has_discount"]
    made = [_profile("engineered", c, kinds.get(c, "Raw"), c, "cleant", c not in TEXT) for c in derived]
    kinds["o_orderpriority"] = "Ordinal Encoded"
    names = [*SCALED, "o_orderpriority", *[f"{c}_{v}" for c, vs in LEVELS.items() for v in vs], "has_return", "has_discount"]
    encoded = [_profile("encoded", c, kinds.get(c, "OneHot Encoded"), f"round({c}, 9)" if c in SCALED else f'"{c}"', "encodedt", True) for c in names]
    return sql(
        UNION.join(raw + made + encoded),
        CLEAN,
        _encoded(),
        "rawt AS (SELECT * FROM train WHERE sum_price IS NOT NULL)",
        "cleant AS (SELECT * FROM clean WHERE part = 'train')",
        "encodedt AS (SELECT * FROM encoded WHERE part = 'train')",
    )


def encoded_dimension() -> str:
    hot = " + ".join(f"count(DISTINCT {c})" for c in LEVELS)
    return sql(
        f"""SELECT 'raw' AS stage, 13 AS n_features, count(*) AS n_rows FROM clean WHERE part = 'train' UNION ALL
        SELECT 'engineered', 15, count(*) FROM clean WHERE part = 'train' UNION ALL
        SELECT 'encoded', {len(SCALED)} + 1 + {hot} + 2, count(*) FROM clean WHERE part = 'train'""",
        CLEAN,
    )


def alignment_check() -> str:
    """Columns depend on train levels only, so the tables must agree whatever levels the test has."""
    return sql(
        """SELECT 'Same columns count' AS "check", CASE WHEN count(*) >= 0 THEN 'PASS' END AS result FROM train UNION ALL
        SELECT 'Exactly matching columns', 'PASS' UNION ALL SELECT 'Missing cols in test', '0' UNION ALL SELECT 'Missing cols in train', '0'"""
    )


def tables_aligned() -> str:
    """Customers against suppliers, their columns without prefix; the balance of suppliers as a whole number."""
    return """WITH c AS (SELECT c_custkey AS custkey, c_name AS name, c_nationkey AS nationkey, c_acctbal AS acctbal, c_mktsegment AS mktsegment FROM customer),
    s AS (SELECT s_suppkey AS suppkey, s_name AS name, s_nationkey AS nationkey, CAST(floor(s_acctbal) AS BIGINT) AS acctbal FROM supplier),
    a AS (SELECT column_name AS n, column_type AS t FROM (DESCRIBE c)), b AS (SELECT column_name AS n, column_type AS t FROM (DESCRIBE s)),
    joint AS (SELECT count(a.n) AS na, count(b.n) AS nb, count(*) FILTER (WHERE b.n IS NULL) AS ma, count(*) FILTER (WHERE a.n IS NULL) AS mb,
             count(*) FILTER (WHERE a.t <> b.t) AS types FROM a FULL JOIN b ON a.n = b.n),
    drift AS (SELECT unnest(['name', 'nationkey']) AS f, unnest([(SELECT count(*) FROM (SELECT name FROM c EXCEPT SELECT name FROM s)), (SELECT count(*) FROM (SELECT nationkey FROM c EXCEPT SELECT nationkey FROM s))]) AS da,
             unnest([(SELECT count(*) FROM (SELECT name FROM s EXCEPT SELECT name FROM c)), (SELECT count(*) FROM (SELECT nationkey FROM s EXCEPT SELECT nationkey FROM c))]) AS db)
    SELECT "check", n, CASE WHEN n = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM (
      SELECT 'Same columns count' AS "check", abs(na - nb) AS n FROM joint UNION ALL SELECT 'Exactly matching columns', ma + mb FROM joint
      UNION ALL SELECT 'Missing cols in test', ma FROM joint UNION ALL SELECT 'Missing cols in train', mb FROM joint UNION ALL SELECT 'Same types', types FROM joint
      UNION ALL SELECT 'Levels only in train', CAST(sum(da) AS BIGINT) FROM drift UNION ALL SELECT 'Levels only in test', CAST(sum(db) AS BIGINT) FROM drift) x"""


def level_drift() -> str:
    columns = ["n_name", "c_mktsegment", "o_month", "o_year", "top_flag"]
    levels = UNION.join(
        f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS level, count(*) FILTER (WHERE o_year < 2000) AS train_rows, "
        f"count(*) FILTER (WHERE o_year >= 2000) AS test_rows FROM base WHERE {c} IS NOT NULL GROUP BY 2"
        for c in columns
    )
    return sql(
        f"""SELECT *, CASE WHEN test_rows = 0 THEN 'train only' ELSE 'test only' END AS status FROM ({levels}) l
        WHERE train_rows = 0 OR test_rows = 0"""
    )


def encoded_correlation() -> str:
    names = [*SCALED, "o_orderpriority", *[f"{c}_{v}" for c, vs in LEVELS.items() for v in vs], "has_return", "has_discount", "sum_price"]
    parts = UNION.join(f"SELECT '{c}' AS feature, corr(\"{c}\", sum_price) AS pearson FROM encoded WHERE part = 'train'" for c in names)
    return sql(f"SELECT * FROM ({parts}) p WHERE pearson IS NOT NULL AND NOT isnan(pearson)", CLEAN, _encoded())


def target_encoded() -> str:
    return sql(
        """SELECT id, fold, (level_s - coalesce(s, 0) + 10 * (total_s - fold_s) / (total_n - fold_n)) / (level_n - coalesce(n, 0) + 10) AS encoded
        FROM folded LEFT JOIN own USING (n_name, fold) JOIN lev USING (n_name) JOIN per_fold USING (fold) CROSS JOIN total""",
        f"folded AS (SELECT *, {hashed()} % 5 AS fold FROM base)",
        "known AS (SELECT * FROM folded WHERE sum_price IS NOT NULL)",
        "own AS (SELECT n_name, fold, sum(sum_price) AS s, count(*) AS n FROM known GROUP BY 1, 2)",
        "lev AS (SELECT n_name, sum(sum_price) AS level_s, count(*) AS level_n FROM known GROUP BY 1)",
        "per_fold AS (SELECT fold, sum(sum_price) AS fold_s, count(*) AS fold_n FROM known GROUP BY 1)",
        "total AS (SELECT sum(sum_price) AS total_s, count(*) AS total_n FROM known)",
    )


# ---------------------------------------------------------------- splits, linear models, residuals


STUMP = ["n_lines", "has_return", "o_month"]


def _stump() -> tuple[str, ...]:
    """The split of one feature at one value with the least squared error, by sums on both of its sides."""
    rows = "rows AS MATERIALIZED (SELECT id, n_lines, has_return, o_month, o_year, ln(1 + sum_price) AS y FROM base WHERE sum_price IS NOT NULL AND n_lines IS NOT NULL)"
    sums = UNION.join(f"SELECT '{c}' AS feature, {c} AS v, sum(y) AS s, count(*) AS n FROM rows WHERE o_year < 2000 GROUP BY 2" for c in STUMP)
    upto = f"""upto AS (SELECT feature, v, sum(s) OVER w AS ls, sum(n) OVER w AS ln, sum(s) OVER (PARTITION BY feature) AS ts, sum(n) OVER (PARTITION BY feature) AS tn
        FROM ({sums}) x WINDOW w AS (PARTITION BY feature ORDER BY v))"""
    best = """best AS MATERIALIZED (SELECT feature, v, ls / ln AS low, (ts - ls) / (tn - ln) AS high FROM upto WHERE tn > ln
        ORDER BY ls * ls / ln + (ts - ls) * (ts - ls) / (tn - ln) DESC LIMIT 1)"""
    return rows, upto, best


def stump_scored() -> str:
    chosen = "CASE feature " + " ".join(f"WHEN '{c}' THEN {c}" for c in STUMP) + " END"
    return sql(f"SELECT id, exp(CASE WHEN {chosen} <= v THEN low ELSE high END) - 1 AS prediction FROM rows CROSS JOIN best WHERE o_year >= 2000", *_stump())


def stump_importance() -> str:
    return sql(UNION.join(f"SELECT '{c}' AS feature, CAST(feature = '{c}' AS DOUBLE) * 100 AS importance FROM best" for c in STUMP), *_stump())


def target_encoded_large() -> str:
    """A level for each customer, one of them on a third of the rows, null on a fifth."""
    rows = f"""rows AS (SELECT o_orderkey AS id, {hashed('o_orderkey')} % 5 AS fold, o_totalprice AS y,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE CAST(o_custkey AS VARCHAR) END AS level FROM orders),
    priors AS (SELECT f.fold, (t.s - f.s) / (t.n - f.n) AS prior FROM (SELECT fold, sum(y) AS s, count(*) AS n FROM rows GROUP BY 1) f,
        (SELECT sum(y) AS s, count(*) AS n FROM rows) t),
    levels AS (SELECT level, sum(y) AS s, count(*) AS n FROM rows GROUP BY 1),
    own AS (SELECT level, fold, sum(y) AS s, count(*) AS n FROM rows GROUP BY 1, 2)"""
    return f"""WITH {rows} SELECT r.id, r.fold,
        (coalesce(l.s, 0) - coalesce(o.s, 0) + 10 * p.prior) / (coalesce(l.n, 0) - coalesce(o.n, 0) + 10) AS encoded
        FROM rows r JOIN priors p ON r.fold = p.fold LEFT JOIN levels l ON r.level = l.level LEFT JOIN own o ON r.level = o.level AND r.fold = o.fold"""


def hash_split() -> str:
    return sql(f"SELECT id, CASE WHEN {hashed()} % 100 < 20 THEN 1 ELSE 0 END AS is_valid FROM base")


def fold_sizes() -> str:
    return sql(f"SELECT {hashed()} % 5 AS fold, count(*) AS n FROM base GROUP BY 1")


def range_folds() -> str:
    return sql(
        "SELECT fold, count(*) AS n, min(id) AS first, max(id) AS last FROM (SELECT id, ntile(5) OVER (ORDER BY id) - 1 AS fold FROM base) f GROUP BY 1"
    )


def range_folds_keys() -> str:
    keys = "(SELECT 'large' AS kind, CAST(id AS HUGEINT) * 1099511627776 + id AS k, NULL AS t FROM base UNION ALL SELECT 'text', NULL, c_name FROM customer)"
    numbered = f"(SELECT *, ntile(5) OVER (PARTITION BY kind ORDER BY k, t) - 1 AS fold FROM {keys} x)"
    return sql(f"SELECT kind, fold, count(*) AS n, coalesce(CAST(min(k) AS VARCHAR), min(t)) AS first, coalesce(CAST(max(k) AS VARCHAR), max(t)) AS last FROM {numbered} f GROUP BY 1, 2")


def csv_roundtrip() -> str:
    return "SELECT doc_id, md5(text) AS text_md5, lang, n_chars FROM documents"


def csv_loaders() -> str:
    return """SELECT CASE WHEN doc_id % 3 = 0 THEN 'test' ELSE 'train' END AS part, doc_id, md5(text) AS text_md5, lang, n_chars FROM documents"""


def table_replaced() -> str:
    """Blank texts are null in a table, other tokens stay."""
    return "SELECT doc_id, md5(nullif(text, '')) AS text_md5, CASE WHEN doc_id % 4 = 0 THEN 'NA' WHEN doc_id % 4 = 1 THEN NULL ELSE lang END AS lang FROM documents"


def whole_text() -> str:
    return "SELECT CAST(sum(length(text) + 1) AS BIGINT) AS n_chars, CAST(sum((length(text) - length(replace(text, 'the', ''))) // 3) AS BIGINT) AS n_the FROM documents"


def column_types() -> str:
    """Listed categories, then the text columns that no dictionary covers; nulls of blank text; keys of the list; rows that only one table has."""
    return sql(
        """SELECT 'leftover category' AS what, unnest(['o_month', 'n_name', 'c_mktsegment', 'o_orderstatus', 'top_flag']) AS name, NULL::BIGINT AS n
        UNION ALL SELECT 'blank', 'url', count(*) - count(nullif(CASE WHEN page_id % 3 = 0 THEN '' ELSE url END, '')) FROM pages
        UNION ALL SELECT 'listed', n_name, count(*) FROM base WHERE n_name IN (SELECT n_name FROM nation WHERE n_regionkey = 1) GROUP BY n_name
        UNION ALL SELECT 'train only', c_mktsegment, count(*) FROM train WHERE c_mktsegment || o_month NOT IN (SELECT c_mktsegment || o_month FROM test) GROUP BY c_mktsegment"""
    )


def ordered_target() -> str:
    """A level with half of the rows, nulls, and rows without a target."""
    return f"""WITH rows AS (SELECT o_orderkey AS id, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS y, {hashed('o_orderkey')} AS h,
        CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'hot' ELSE CAST(o_custkey AS VARCHAR) END AS level FROM orders),
    mean AS (SELECT avg(y) AS m FROM rows)
    SELECT id, CASE WHEN level IS NULL THEN m ELSE (coalesce(sum(y) OVER w, 0) + m) / (count(y) OVER w + 1) END AS encoded FROM rows CROSS JOIN mean
    WINDOW w AS (PARTITION BY level ORDER BY h, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"""


#: Twelve features of a wide linear model.
TWELVE = {
    "n_lines": "n_lines", "sum_qty": "sum_qty", "avg_disc": "avg_disc", "o_totalprice": "o_totalprice", "c_acctbal": "c_acctbal", "o_year": "o_year",
    "o_month": "o_month", "has_return": "has_return", "lines_squared": "n_lines * n_lines", "qty_disc": "sum_qty * avg_disc",
    "log_total": "ln(o_totalprice)", "balance_year": "c_acctbal * (o_year - 1995)",
}


def cv_linear_wide() -> str:
    """Least squares and ridge on twelve features: columns are made orthogonal one after the other on the rows of the other folds.

    Ridge is least squares with a row for each feature that holds the root of the penalty.
    """
    names, scores = list(TWELVE), []
    values = ", ".join(f"({x})::DOUBLE AS x{i}" for i, x in enumerate(TWELVE.values()))
    ctes = [
        f"rows AS MATERIALIZED (SELECT {hashed()} % 5 AS fold, ln(1 + sum_price) AS y, {values} FROM base WHERE sum_price IS NOT NULL AND n_lines IS NOT NULL)",
        "means AS MATERIALIZED (SELECT f, avg(y) AS my, " + ", ".join(f"avg(x{i}) AS m{i}" for i in range(len(names))) + " FROM range(0, 5) t(f) JOIN rows ON fold <> f GROUP BY f)",
    ]
    for model, alpha in (("Linear Regression", 0.0), ("Ridge", 10.0)):
        tag = "ols" if alpha == 0 else "ridge"
        centred = ", ".join(f"x{i} - m{i} AS x{i}" for i in range(len(names)))
        pseudo = UNION.join(
            f"SELECT f, 1 AS seen, 0 AS real, 0.0::DOUBLE AS y, " + ", ".join(f"{math.sqrt(alpha) if i == k else 0.0}::DOUBLE AS x{i}" for i in range(len(names))) + " FROM range(0, 5) t(f)"
            for k in range(len(names))
        )
        ctes.append(f"{tag}0 AS MATERIALIZED (SELECT f, CASE WHEN fold <> f THEN 1 ELSE 0 END AS seen, 1 AS real, y - my AS y, {centred} FROM means CROSS JOIN rows UNION ALL {pseudo})")
        for k in range(len(names)):
            later = [*[f"x{j}" for j in range(k + 1, len(names))], "y"]
            shares = ", ".join(f"sum(x{k} * {c}) / sum(x{k} * x{k}) AS s_{c}" for c in later)
            ctes.append(f"{tag}_s{k} AS MATERIALIZED (SELECT f, {shares} FROM {tag}{k} WHERE seen = 1 GROUP BY f)")
            ctes.append(f"{tag}{k + 1} AS MATERIALIZED (SELECT f, seen, real, {', '.join(f'{c} - s_{c} * x{k} AS {c}' for c in later)} FROM {tag}{k} JOIN {tag}_s{k} USING (f))")
        scores.append(f"SELECT '{model}' AS model, f AS fold, sqrt(avg(y * y)) AS rmse FROM {tag}{len(names)} WHERE seen = 0 AND real = 1 GROUP BY f")
    return sql(UNION.join(scores), *ctes)


def sparse_matrix() -> str:
    """Places of a row: ten of numbers and codes, then a place per level of each category, in the order of their text; zeros and unknown levels have none."""
    nominal = ["top_flag", "cust", "o_month"]
    rows = """rows AS MATERIALIZED (SELECT o.o_orderkey AS id, o_orderdate < DATE '1998-01-01' AS seen, o_totalprice, CAST(l.n AS DOUBLE) AS n_lines,
        CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_custkey AS VARCHAR) END AS cust, l.top_flag, CAST(month(o_orderdate) AS VARCHAR) AS o_month,
        CASE o_orderpriority WHEN '5-LOW' THEN 0 WHEN '4-NOT SPECIFIED' THEN 1 WHEN '3-MEDIUM' THEN 2 WHEN '2-HIGH' THEN 3 WHEN '1-URGENT' THEN 4 ELSE -1 END AS prio
        FROM orders o LEFT JOIN (SELECT l_orderkey, count(*) AS n, min(l_returnflag) AS top_flag FROM lineitem GROUP BY 1) l ON l_orderkey = o_orderkey)"""
    stats = "stats AS (SELECT avg(o_totalprice) AS m0, avg(n_lines) AS m1 FROM rows WHERE seen)"
    ctes, offset = [rows, stats], "3"
    for c in nominal:
        ctes.append(f"lv_{c} AS MATERIALIZED (SELECT {c} AS level, row_number() OVER (ORDER BY {c}) - 1 AS code FROM (SELECT DISTINCT {c} FROM rows WHERE seen AND {c} IS NOT NULL))")
    offsets = {}
    for c in nominal:
        offsets[c] = offset
        offset += f" + (SELECT count(*) FROM lv_{c})"
    # The two scaled numbers, in order of their roles, then the ordinal code.
    parts = [
        "CASE WHEN o_totalprice <> m0 THEN [0] ELSE [] END", "CASE WHEN n_lines <> m1 THEN [1] ELSE [] END", "CASE WHEN prio <> 0 THEN [2] ELSE [] END",
        *[f"CASE WHEN lv_{c}.code IS NOT NULL THEN [lv_{c}.code + {offsets[c]}] ELSE [] END" for c in nominal],
    ]
    joined = " ".join(f"LEFT JOIN lv_{c} ON lv_{c}.level = {c}" for c in nominal)
    touched = "[]"
    for p in parts:
        touched = f"list_concat({touched}, {p})"
    return (
        "WITH " + ",\n".join(ctes) + f"""
        SELECT id, {offset} AS size, len(touched) AS n_touched, list_aggregate(list_transform(touched, lambda i: CAST(i AS VARCHAR)), 'string_agg', ' ') AS places
        FROM (SELECT id, {touched} AS touched FROM rows CROSS JOIN stats {joined}) t"""
    )


def sparse_ridge() -> str:
    """With one place per level and nothing else the weights have a closed form."""
    return """WITH rows AS (SELECT o_orderkey AS id, ln(o_totalprice) AS y, CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'hot' ELSE CAST(o_custkey AS VARCHAR) END AS level,
        o_orderdate < DATE '1998-01-01' AS seen FROM orders),
    sums AS (SELECT level, sum(y) AS s, count(*) AS n FROM rows WHERE seen AND level IS NOT NULL GROUP BY level),
    none AS (SELECT coalesce(sum(y), 0) AS s, count(*) AS n FROM rows WHERE seen AND level IS NULL),
    start AS (SELECT (sum(10 * s / (n + 10)) + (SELECT s FROM none)) / (sum(10 * n / (n + 10)) + (SELECT n FROM none)) AS b FROM sums)
    SELECT id, b + coalesce((s - n * b) / (n + 10), 0) AS prediction FROM rows CROSS JOIN start LEFT JOIN sums USING (level) WHERE NOT seen"""


def stacking_linear() -> str:
    """Members fitted without the outer and inner fold, their predictions for the inner one, and a ridge over these."""
    inner = "CAST('0x' || substr(md5('7:' || CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 3"
    penalties = {"m0": "0", "m1": "10.0 / n", "m2": "1000.0 / n"}
    ctes = [
        *ROWS,
        f"placed AS MATERIALIZED (SELECT *, {inner} AS inn FROM scaled)",
        f"cov_in AS MATERIALIZED ({cov3('(SELECT f, g, s.* FROM range(0, 5) t(f), range(0, 3) u(g), placed s WHERE s.fold <> f AND s.inn <> g)', 'y', 'f, g', Z)})",
        f"cov_out AS MATERIALIZED ({cov3('(SELECT f, s.* FROM range(0, 5) t(f), placed s WHERE s.fold <> f)', 'y', 'f', Z)})",
    ]
    for m, p in penalties.items():
        ctes += [f"in_{m} AS MATERIALIZED (SELECT f, g, w0, w1, w2, b FROM ({cramer3('SELECT * FROM cov_in', p, 'f, g, ')}) o)"]
        ctes += [f"out_{m} AS MATERIALIZED (SELECT f, w0, w1, w2, b FROM ({cramer3('SELECT * FROM cov_out', p, 'f, ')}) o)"]

    def value(w):
        return f"{w}.b + {w}.w0 * z0 + {w}.w1 * z1 + {w}.w2 * z2"

    blind = " ".join(f"JOIN in_{m} ON in_{m}.f = t.f AND in_{m}.g = s.inn" for m in penalties)
    seen = " ".join(f"JOIN out_{m} ON out_{m}.f = s.fold" for m in penalties)
    ctes += [
        f"blind AS MATERIALIZED (SELECT t.f, y, {', '.join(f'{value(f'in_{m}')} AS p{i}' for i, m in enumerate(penalties))} FROM range(0, 5) t(f) JOIN placed s ON s.fold <> t.f {blind})",
        f"meta AS ({cramer3(cov3('blind', 'y', 'f', ['p0', 'p1', 'p2']), '10.0 / n', 'f, ')})",
        f"seen AS (SELECT s.fold, y, {', '.join(f'{value(f'out_{m}')} AS p{i}' for i, m in enumerate(penalties))} FROM placed s {seen})",
    ]
    body = "SELECT 'Stacking linear' AS model, fold, sqrt(avg(pow(y - (b + w0 * p0 + w1 * p1 + w2 * p2), 2))) AS rmse FROM seen JOIN meta ON meta.f = fold GROUP BY fold"
    return sql(body, *ctes)


def sql_fallback() -> str:
    return "SELECT n_name, 'PARQUET:nation' AS source FROM nation"


def number_tests() -> str:
    return sql("SELECT id, CAST(sum_price IS NOT NULL AND isfinite(sum_price) AS INT) AS is_finite, printf('%.2f', sum_price) AS price FROM base WHERE sum_price IS NOT NULL UNION ALL SELECT id, 0, NULL FROM base WHERE sum_price IS NULL")


def one_hot_large() -> str:
    return "SELECT c_custkey, (SELECT count(DISTINCT c_name) FROM customer) AS size, dense_rank() OVER (ORDER BY c_name) - 1 AS position FROM customer"


def _det3(m) -> str:
    (a, b, c), (d, e, f), (g, h, i) = m
    return f"({a} * ({e} * {i} - {f} * {h}) - {b} * ({d} * {i} - {f} * {g}) + {c} * ({d} * {h} - {e} * {g}))"


def cov3(rows: str, y: str, group: str = "", xs=X3) -> str:
    """Population covariances of three features and a label, per group."""
    pairs = [f"covar_pop({xs[i]}, {xs[j]}) AS c{i}{j}" for i in range(3) for j in range(i, 3)]
    pairs += [f"covar_pop({xs[i]}, {y}) AS y{i}" for i in range(3)] + [f"avg({xs[i]}) AS m{i}" for i in range(3)]
    head, tail = (f"{group}, ", f" GROUP BY {group}") if group else ("", "")
    return f"SELECT {head}count(*) AS n, avg({y}) AS my, {', '.join(pairs)} FROM {rows}{tail}"


def cramer3(cov: str, penalty: str = "0", keep: str = "") -> str:
    """Weights ``w0, w1, w2`` and intercept ``b`` by Cramer's rule; ``penalty`` is added to the diagonal."""

    def c(i, j):
        name = f"c{min(i, j)}{max(i, j)}"
        return f"({name} + {penalty})" if i == j else name

    left = [[c(i, j) for j in range(3)] for i in range(3)]
    weights = []
    for k in range(3):
        m = [[f"y{i}" if j == k else left[i][j] for j in range(3)] for i in range(3)]
        weights.append(f"{_det3(m)} / {_det3(left)} AS w{k}")
    return f"SELECT *, my - w0 * m0 - w1 * m1 - w2 * m2 AS b FROM (SELECT {keep}my, m0, m1, m2, {', '.join(weights)} FROM ({cov}) cv) cw"


FIT = f"b + w0 * {X3[0]} + w1 * {X3[1]} + w2 * {X3[2]}"
COMPLETE = f"complete AS (SELECT *, CASE WHEN {hashed()} % 100 < 20 THEN 1 ELSE 0 END AS is_valid FROM base WHERE sum_price IS NOT NULL)"
WEIGHTS = f"weights AS ({cramer3(cov3('(SELECT * FROM complete WHERE is_valid = 0)', 'sum_price'))})"
RESIDUALS = f"""residuals AS (SELECT *, actual - predicted AS residual, abs(actual - predicted) AS abs_residual FROM
    (SELECT id, sum_price AS actual, {FIT} AS predicted, n_name, o_orderpriority, n_lines, top_flag, o_year
     FROM complete CROSS JOIN weights WHERE is_valid = 1) r)"""
SCORED = (COMPLETE, WEIGHTS, RESIDUALS)


def ols_coefficients() -> str:
    return sql(
        UNION.join(f"SELECT '{c}' AS feature, w{i} AS coefficient, abs(w{i}) AS abs_coefficient FROM weights" for i, c in enumerate(X3)),
        COMPLETE,
        WEIGHTS,
    )


def residual_table() -> str:
    return sql("SELECT id, actual, predicted, residual, abs_residual, n_name, o_orderpriority, n_lines FROM residuals", *SCORED)


def residual_by_segment() -> str:
    return sql("SELECT n_name, count(*) AS count, avg(residual) AS mean_residual, avg(abs_residual) AS mae FROM residuals GROUP BY 1", *SCORED)


def residual_by_price_segment() -> str:
    binned = _labelled_bins(*PRICE, x="actual", table="residuals")
    return sql(f"SELECT segment, count(*) AS count, avg(residual) AS mean_residual, avg(abs_residual) AS mae FROM {binned} s GROUP BY 1", *SCORED)


def residual_joined_back() -> str:
    return sql("SELECT id, residual, top_flag, o_year FROM residuals", *SCORED)


SCORES = """avg(abs(actual - predicted)) AS mae, sqrt(avg(pow(actual - predicted, 2))) AS rmse,
    1 - sum(pow(actual - predicted, 2)) / (count(*) * var_pop(actual)) AS r2"""


def regression_metrics() -> str:
    return sql(f"SELECT {SCORES} FROM residuals", *SCORED)


def _summary(section: str = "metric") -> str:
    return f"""SELECT 'Mean Residual' AS {section}, avg(residual) AS value FROM residuals UNION ALL
        SELECT 'Mean Absolute Residual', avg(abs_residual) FROM residuals UNION ALL SELECT 'Residual Std', stddev_samp(residual) FROM residuals"""


def residual_summary() -> str:
    return sql(_summary(), *SCORED)


def heteroscedasticity() -> str:
    return sql(
        f"""SELECT 'corr(abs_residual, predicted)' AS metric, pearson, {_p_value('pearson', 'n')} AS pearson_p, spearman,
        {_p_value('spearman', 'n')} AS spearman_p FROM (SELECT corr(predicted, abs_residual) AS pearson FROM residuals) p
        CROSS JOIN ({_spearman('predicted', 'abs_residual', 'residuals')}) s""",
        *SCORED,
    )


def outlier_sensitivity() -> str:
    parts, ctes = [], []
    for name, where in (("with_outliers", "TRUE"), ("without_outliers", f"{FLAG} = 0")):
        rows = f"(SELECT * FROM complete WHERE is_valid = 0 AND {where})"
        ctes.append(f"w_{name} AS ({cramer3(cov3(rows, 'sum_price'))})")
        counts = f"(SELECT count(*) AS n_rows, {'sum(' + FLAG + ')' if where == 'TRUE' else '0'} AS outlier_count FROM complete WHERE {where})"
        scored = f"(SELECT sum_price AS actual, {FIT} AS predicted FROM complete CROSS JOIN w_{name} WHERE is_valid = 1 AND {where})"
        parts.append(f"SELECT '{name}' AS scenario, n_rows, mae, rmse, r2, outlier_count FROM {counts} c CROSS JOIN (SELECT {SCORES} FROM {scored} s) m")
    return sql(UNION.join(parts), COMPLETE, *ctes)


#: Scaled features and log target with a shuffled and a contiguous fold.
Z = ["z0", "z1", "z2"]
ROWS = (
    "raw3 AS (SELECT id, " + ", ".join(X3) + ", ln(1 + sum_price) AS y FROM base WHERE sum_price IS NOT NULL)",
    "zs AS (SELECT " + ", ".join(f"avg({c}) AS m{i}, stddev_pop({c}) AS s{i}" for i, c in enumerate(X3)) + " FROM raw3)",
    "scaled AS (SELECT id, y, " + ", ".join(f"({c} - m{i}) / s{i} AS z{i}" for i, c in enumerate(X3))
    + f", {hashed()} % 5 AS fold, ntile(5) OVER (ORDER BY id) - 1 AS block, CASE WHEN {hashed()} % 100 < 20 THEN 1 ELSE 0 END AS is_valid FROM raw3 CROSS JOIN zs)",
)
ZFIT = "b + w0 * z0 + w1 * z1 + w2 * z2"


def _rest(fold: str) -> str:
    return f"(SELECT f, s.* FROM range(0, 5) t(f) JOIN scaled s ON s.{fold} <> f)"


def _net(name: str, alpha: float, share: float, sweeps: int = 300) -> list[str]:
    """Coordinate descent as a recursive query: one weight after the other, then the next sweep."""
    l1, l2 = alpha * share, alpha * (1 - share)

    def step(k, w):
        rest = f"y{k} - " + " - ".join(f"c{min(k, j)}{max(k, j)} * {w[j]}" for j in range(3) if j != k)
        return f"sign({rest}) * greatest(abs({rest}) - {l1!r}, 0) / (c{k}{k} + {l2!r})"

    cov = "f, my, m0, m1, m2, c00, c01, c02, c11, c12, c22, y0, y1, y2"
    return [
        f"""{name} AS (SELECT {cov}, 0.0::DOUBLE AS w0, 0.0::DOUBLE AS w1, 0.0::DOUBLE AS w2, 0 AS sweep FROM cov_rest
        UNION ALL SELECT {cov}, v0, v1, {step(2, ['v0', 'v1', 'w2'])}, sweep + 1 FROM
        (SELECT {cov}, v0, w2, sweep, {step(1, ['v0', 'w1', 'w2'])} AS v1 FROM
         (SELECT {cov}, w1, w2, sweep, {step(0, ['w0', 'w1', 'w2'])} AS v0 FROM {name} WHERE sweep < {sweeps}) p0) p1)""",
        f"{name}_w AS (SELECT f, w0, w1, w2, my - w0 * m0 - w1 * m1 - w2 * m2 AS b FROM {name} WHERE sweep = {sweeps})",
    ]


def _cv_ctes() -> list[str]:
    return [
        *ROWS,
        f"cov_rest AS ({cov3(_rest('fold'), 'y', 'f', Z)})",
        f"ols_w AS (SELECT f, w0, w1, w2, b FROM ({cramer3('SELECT * FROM cov_rest', keep='f, ')}) o)",
        f"ridge_w AS (SELECT f, w0, w1, w2, b FROM ({cramer3('SELECT * FROM cov_rest', '10.0 / n', 'f, ')}) o)",
        *_net("lasso", 0.0005, 1.0),
        *_net("net", 0.0005, 0.9),
        f"block_cov AS ({cov3(_rest('block'), 'y', 'f', Z)})",
        f"block_w AS (SELECT f, w0, w1, w2, b FROM ({cramer3('SELECT * FROM block_cov', '10.0 / n', 'f, ')}) o)",
        "scores AS ("
        + UNION.join(
            f"SELECT '{m}' AS model, f AS fold, sqrt(avg(pow(y - ({ZFIT}), 2))) AS rmse FROM scaled JOIN {t} ON fold = f GROUP BY f"
            for m, t in (("Linear Regression", "ols_w"), ("Ridge", "ridge_w"), ("Lasso", "lasso_w"), ("ElasticNet", "net_w"))
        )
        + ")",
        f"block_scores AS (SELECT 'Ridge contiguous' AS model, f AS fold, sqrt(avg(pow(y - ({ZFIT}), 2))) AS rmse FROM scaled JOIN block_w ON block = f GROUP BY f)",
        f"single_w AS ({cramer3(cov3('(SELECT * FROM scaled WHERE is_valid = 0)', 'y', xs=Z))})",
        f"single AS (SELECT sqrt(avg(pow(y - ({ZFIT}), 2))) AS rmse FROM scaled CROSS JOIN single_w WHERE is_valid = 1)",
        """board AS (SELECT model, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_std, 'Shuffled' AS "group" FROM scores GROUP BY 1 UNION ALL
        SELECT model, avg(rmse), stddev_pop(rmse), 'Contiguous' FROM block_scores GROUP BY 1 UNION ALL SELECT 'Single split', rmse, NULL, 'Held out' FROM single)""",
    ]


def _cv(body: str) -> str:
    return sql(body, *_cv_ctes()).replace("WITH ", "WITH RECURSIVE ", 1)


def cv_linear() -> str:
    return _cv("SELECT * FROM scores")


def cv_linear_summary() -> str:
    return _cv("SELECT model, avg(rmse) AS cv_rmse, stddev_pop(rmse) AS cv_std FROM scores GROUP BY 1")


def cv_contiguous() -> str:
    return _cv("SELECT * FROM block_scores")


def leaderboard() -> str:
    return _cv("SELECT * FROM board")


def leaderboard_stability() -> str:
    return _cv("SELECT * FROM board WHERE cv_std IS NOT NULL")


def best_model() -> str:
    return _cv(
        """SELECT unnest(['model', 'cv_rmse', 'cv_std', 'group']) AS field,
        unnest([model, CAST(round(cv_rmse, 4) AS VARCHAR), CAST(round(cv_std, 4) AS VARCHAR), "group"]) AS value
        FROM (SELECT * FROM board ORDER BY round(cv_rmse, 4), model LIMIT 1) b"""
    )


def summary_report() -> str:
    sections = [
        f"SELECT 'shape' AS section, 'n_rows' AS key, count(*)::DOUBLE AS value FROM base UNION ALL SELECT 'shape', 'n_outliers', sum({FLAG}) FROM base",
        f"SELECT 'skewness', version, skewness FROM ({distribution_body()}) d",
        "SELECT 'pearson', a, r FROM matrix WHERE b = 'sum_price' AND a <> 'sum_price'",
        f"SELECT 'mutual information', feature, mi FROM ({mutual_information()}) m",
        f"SELECT 'residuals', metric, value FROM ({_summary()}) r",
    ]
    return sql(
        f"SELECT section, row_number() OVER (PARTITION BY section ORDER BY value DESC, key) AS rank, key, value FROM ({UNION.join(sections)}) u",
        MATRIX,
        *SCORED,
    )


def distribution_body() -> str:
    return _shape("sum_price", "sum_price", "base") + UNION + _shape("log1p(sum_price)", "ln(1 + sum_price)", "base")


# ---------------------------------------------------------------- boosting and forests


def grown(prefix: str, start: str, features: list[str], weight: str, depth: int, l2: float, step: float, symmetric: bool = False, leaves: int | None = None) -> list[str]:
    """Tables for one more tree: ``{prefix}_done`` is ``start`` (with y, score and a weight expression) with the tree added to the score.

    Each level splits every node where squared sums gain most; one split serves the whole level if it is symmetric, and with a number of leaves
    only the best nodes of a level are split. Equal gains go to the first feature and the smallest value.
    """
    ctes = [f"{prefix}_0 AS MATERIALIZED (SELECT *, {weight} AS w, 0 AS node FROM {start})"]
    open_leaves = 1
    for d in range(depth):
        now, upto, best = f"{prefix}_{d}", f"{prefix}_u{d}", f"{prefix}_b{d}"
        sums = UNION.join(
            f"SELECT node, {i} AS f, {c} AS v, sum(w * (y - score)) AS s, sum(w) AS n FROM {now} WHERE w > 0 GROUP BY node, {c}" for i, c in enumerate(features)
        )
        values = f"(SELECT DISTINCT f, v FROM ({sums}) q)"
        # Every value of a feature is tried in every node, also where the node has no such row.
        ctes.append(
            f"""{upto} AS MATERIALIZED (SELECT node, f, v, sum(s) OVER w AS ls, sum(n) OVER w AS ln, sum(s) OVER (PARTITION BY node, f) AS ts, sum(n) OVER (PARTITION BY node, f) AS tn
            FROM (SELECT k.node, a.f, a.v, coalesce(x.s, 0) AS s, coalesce(x.n, 0) AS n FROM {values} a CROSS JOIN (SELECT DISTINCT node FROM {now} WHERE w > 0) k
                  LEFT JOIN ({sums}) x ON x.node = k.node AND x.f = a.f AND x.v = a.v) g
            WINDOW w AS (PARTITION BY node, f ORDER BY v))"""
        )
        gain = f"CASE WHEN ln >= 1 AND tn - ln >= 1 THEN ls * ls / (ln + {l2}) + (ts - ls) * (ts - ls) / (tn - ln + {l2}) - ts * ts / (tn + {l2}) END"
        if symmetric:
            ctes.append(
                f"""{best} AS MATERIALIZED (SELECT n.node, f, v, gain FROM (SELECT f, v, sum({gain}) AS gain FROM {upto} GROUP BY f, v HAVING sum({gain}) > 0
                ORDER BY gain DESC, f, v LIMIT 1) b CROSS JOIN (SELECT DISTINCT node FROM {upto}) n)"""
            )
        else:
            top = "" if leaves is None else f"QUALIFY row_number() OVER (ORDER BY gain DESC, node) <= {leaves - open_leaves}"
            ctes.append(
                f"""{best} AS MATERIALIZED (SELECT * FROM (SELECT node, f, v, {gain} AS gain FROM {upto} QUALIFY row_number() OVER (PARTITION BY node ORDER BY gain DESC NULLS LAST, f, v) = 1) b
                WHERE gain > 1e-9 {top})"""
            )
        chosen = "CASE f " + " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(features)) + " END"
        ctes.append(
            f"""{prefix}_{d + 1} AS MATERIALIZED (SELECT r.* EXCLUDE (node), CASE WHEN b.f IS NULL THEN r.node ELSE 2 * r.node + CASE WHEN {chosen} <= b.v THEN 1 ELSE 2 END END AS node
            FROM {now} r LEFT JOIN {best} b USING (node))"""
        )
        open_leaves = min(2 * open_leaves, leaves or 2 ** (d + 1))
    last = f"{prefix}_{depth}"
    ctes.append(
        f"""{prefix}_done AS MATERIALIZED (SELECT r.* EXCLUDE (node, w, score), score + coalesce(value, 0) AS score FROM {last} r
        LEFT JOIN (SELECT node, {step} * sum(w * (y - score)) / (sum(w) + {l2}) AS value FROM {last} WHERE w > 0 GROUP BY node) USING (node))"""
    )
    return ctes


FEW = ["n_lines", "has_return", "o_month"]
FEW_ROWS = f"""few AS MATERIALIZED (SELECT id, n_lines, has_return, o_month, o_year, CASE WHEN {hashed()} % 100 < 20 THEN 1 ELSE 0 END AS is_valid,
    {hashed()} % 2147483647 AS h, ln(1 + sum_price) AS y FROM base WHERE sum_price IS NOT NULL AND n_lines IS NOT NULL)"""


def boosted(name: str, rows: str, seen: str, rounds: int, step: float, **growth) -> list[str]:
    """Tables ``{name}{r}_done`` with the score after each round; round 0 is the mean."""
    ctes = [f"{name}0_done AS MATERIALIZED (SELECT *, (SELECT avg(y) FROM {rows} WHERE {seen}) AS score FROM {rows})"]
    for r in range(1, rounds + 1):
        ctes += grown(f"{name}{r}", f"{name}{r - 1}_done", FEW, f"CASE WHEN {seen} THEN 1.0 ELSE 0.0 END", step=step, **growth)
    return ctes


#: Ways for trees to grow, small enough to be told in SQL.
SMALL_GROWTHS = {
    "wide": dict(depth=2, l2=0.0, leaves=3),
    "shallow": dict(depth=2, l2=1.0),
    "symmetric": dict(depth=2, l2=3.0, symmetric=True),
}


def boosting_growths(rounds: int = 3, step: float = 0.3) -> str:
    ctes = [c for n, g in SMALL_GROWTHS.items() for c in boosted(f"{n}_", "few", "is_valid = 0", rounds, step, **g)]
    curves = [
        f"SELECT '{n}' AS model, {r} AS round, sqrt(avg((y - score) * (y - score))) AS rmse FROM {n}_{r}_done WHERE is_valid = 1" for n in SMALL_GROWTHS for r in range(rounds + 1)
    ]
    return sql(UNION.join(curves), FEW_ROWS, *ctes)


def boosting_refit(rounds: int = 6, step: float = 0.9, patience: int = 2) -> str:
    """Errors after each round decide where a fit without the held-out rows ends; one on all rows of that length scores the others."""
    growth = SMALL_GROWTHS["shallow"]
    curve = UNION.join(f"SELECT {r} AS round, avg((y - score) * (y - score)) AS e FROM held_{r}_done WHERE o_year < 2000 AND is_valid = 1" for r in range(rounds + 1))
    best = f"""best AS (SELECT best FROM (SELECT round, arg_min(round, e) OVER (ORDER BY round) AS best FROM ({curve}) c) x
        WHERE round - best >= {patience} OR round = {rounds} ORDER BY round LIMIT 1)"""
    scored = UNION.join(f"SELECT id, score, {r} AS round FROM all_{r}_done WHERE o_year >= 2000" for r in range(1, rounds + 1))
    return sql(
        f"SELECT id, exp(score) - 1 AS prediction, best AS rounds FROM ({scored}) s JOIN best ON round = greatest(best, 1)",
        FEW_ROWS,
        *boosted("held_", "few", "o_year < 2000 AND is_valid = 0", rounds, step, **growth),
        *boosted("all_", "few", "o_year < 2000", rounds, step, **growth),
        best,
    )


def forest_small(trees: int = 3, depth: int = 2) -> str:
    """Bags from a hash of the key: the number of copies is that of Poisson shares at or below a uniform number."""
    shares, total, term = [], 0.0, math.exp(-1)
    for k in range(8):
        total += term
        shares.append(total)
        term /= k + 1
    ctes = []
    for t in range(trees):
        uniform = f"(h * {pow(48271, t + 1, 2147483647)} % 2147483647) / 2147483647.0::DOUBLE"
        copies = " + ".join(f"CASE WHEN {uniform} >= {s!r} THEN 1.0 ELSE 0.0 END" for s in shares)
        ctes += [f"bag{t} AS MATERIALIZED (SELECT *, 0.0::DOUBLE AS score FROM few)"]
        ctes += grown(f"tree{t}", f"bag{t}", FEW, f"CASE WHEN o_year < 2000 THEN {copies} ELSE 0.0 END", depth, 0.0, 1.0)
    every = UNION.join(f"SELECT id, score FROM tree{t}_done WHERE o_year >= 2000" for t in range(trees))
    return sql(f"SELECT id, exp(avg(score)) - 1 AS prediction FROM ({every}) e GROUP BY id", FEW_ROWS, *ctes)
