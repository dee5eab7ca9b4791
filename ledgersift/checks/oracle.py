"""For each query, SQL over the same tables that must give the same rows."""

from __future__ import annotations

from ledgersift import schema as S
from ledgersift.checks.queries import LAMBDAS, PROFILE_GRID, RAW_AND_BOXCOX
from ledgersift.functions.calendar import PUBLIC_HOLIDAYS
from ledgersift.operators.numbering import BUCKET_ROWS

TXN = """
txn AS (
  SELECT concat('A', CAST(l_partkey AS varchar(20)))               AS address,
         CAST(year(l_shipdate) AS int)                             AS year,
         CAST(dayofyear(l_shipdate) AS int)                        AS day,
         CAST(l_quantity AS int)                                   AS length,
         l_discount + l_tax                                        AS weight,
         l_linenumber                                              AS count,
         CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS looped,
         CAST(l_suppkey % 7 AS int)                                AS neighbors,
         CAST(round(l_extendedprice * 100) AS bigint)              AS income,
         CASE WHEN l_partkey % 50 <> 0 THEN 'white'
              WHEN l_partkey % 100 = 0 THEN 'family_a'
              ELSE 'family_b' END                                  AS label
  FROM lineitem)"""

DIRTY = TXN + """,
nulled AS (
  SELECT address, year, day, length,
         CASE WHEN income % 97 <> 0 THEN weight END AS weight,
         count, looped, neighbors, income,
         CASE WHEN income % 89 <> 0 THEN label END  AS label
  FROM txn),
dirty AS (SELECT * FROM nulled UNION ALL SELECT * FROM nulled WHERE income % 83 = 0)"""

FLAGGED = TXN + ", flagged AS (SELECT *, label <> 'white' AS fraud FROM txn)"
FRAUD = FLAGGED + ", bad AS (SELECT * FROM flagged WHERE fraud)"

CLEAN = """,
clean AS (
  SELECT * FROM dirty
  WHERE address IS NOT NULL AND year IS NOT NULL AND day IS NOT NULL AND length IS NOT NULL
    AND weight IS NOT NULL AND count IS NOT NULL AND looped IS NOT NULL
    AND neighbors IS NOT NULL AND income IS NOT NULL AND label IS NOT NULL)"""

DATE = """CASE WHEN year(make_date(year, 1, 1) + (day - 1)) = year AND day >= 1
           THEN CAST(make_date(year, 1, 1) + (day - 1) AS date) END"""
WEEKDAY = f"CAST(dayofweek({DATE}) + 1 AS int)"
HOLIDAYS = ", ".join(str(d) for d in sorted(PUBLIC_HOLIDAYS))
HOLIDAY = f"CASE WHEN day IN ({HOLIDAYS}) THEN 1 ELSE 0 END"

DATED = FRAUD + f""",
dated AS (SELECT *, {WEEKDAY} AS day_of_week, CAST(month({DATE}) AS int) AS month,
                 {HOLIDAY} AS is_public_holiday FROM bad)"""

SCORES = TXN + """,
scores AS (
  SELECT CASE WHEN label = 'white' THEN 1 ELSE 0 END AS label,
         CAST(('0x' || substr(md5(concat(address, CAST(income AS varchar(20)))), 1, 8))::BIGINT
              % 100 AS double) AS score
  FROM txn),
pred AS (SELECT *, CASE WHEN score >= 50 THEN 1 ELSE 0 END AS prediction FROM scores),
size AS (SELECT CAST(sum(label) AS bigint) AS pos, CAST(sum(1 - label) AS bigint) AS neg
         FROM pred),
steps AS (
  SELECT score, pos_at, neg_at,
         CAST(sum(pos_at) OVER (ORDER BY score DESC) AS double) AS tp,
         CAST(sum(neg_at) OVER (ORDER BY score DESC) AS double) AS fp
  FROM (SELECT score, sum(label) AS pos_at, sum(1 - label) AS neg_at FROM pred GROUP BY score))"""

COLUMNS = ", ".join(S.TXN.fieldNames())


def _hash(key: str, digits: int) -> str:
    return f"('0x' || substr(md5({key}), 1, {digits}))::BIGINT"


def _row_key(seed: str, columns: list[str] = S.KEY_COLUMNS) -> str:
    return "concat_ws('|', '{}', {})".format(
        seed, ", ".join(f"CAST({c} AS varchar)" for c in columns))


def _draw(columns: list[str] = S.KEY_COLUMNS, seed: str = "1024") -> str:
    return f"({_hash(_row_key(seed, columns), 8)} / 4294967296.0)"


def _kept(source: str) -> str:
    return f""",
kept AS (
  SELECT {COLUMNS.replace('label', "CASE WHEN label = 'white' THEN 'white' ELSE 'black' END AS label")}
  FROM {source} WHERE label <> 'white' OR (label = 'white' AND {_draw()} < 0.015))"""


def _boxcox(column: str, lam: float) -> str:
    y = f"CAST({column} AS double) + 1"
    return f"ln({y})" if lam == 0 else f"(pow({y}, {lam}) - 1) / {lam}"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


def _histogram(source: str) -> str:
    parts = [f"""
  SELECT '{c}' AS "column", b.bin, lo + b.bin * width AS bin_low, lo + (b.bin + 1) * width AS bin_high,
         coalesce(n, 0) AS n
  FROM (SELECT CAST(min({c}) AS double) AS lo,
               (CAST(max({c}) AS double) - CAST(min({c}) AS double)) / 30 AS width FROM {source})
  CROSS JOIN (SELECT unnest(range(30)) AS bin) b
  LEFT JOIN (
    SELECT least(CAST(floor((CAST({c} AS double) - lo) / width) AS bigint), 29) AS bin, count(*) AS n
    FROM {source}, (SELECT CAST(min({c}) AS double) AS lo,
         (CAST(max({c}) AS double) - CAST(min({c}) AS double)) / 30 AS width FROM {source})
    GROUP BY 1) h ON h.bin = b.bin""" for c in S.HISTOGRAM_COLUMNS]
    return f"""SELECT "column", CAST(bin AS bigint) AS bin, round(bin_low, 6) AS bin_low,
      round(bin_high, 6) AS bin_high, CAST(n AS bigint) AS n FROM ({_union(parts)})"""


SHAPED = TXN + ", shaped AS (SELECT *, " + ", ".join(
    f"{_boxcox(c, 0)} AS {c}_boxcox" for c in S.BOXCOX_COLUMNS) + " FROM txn)"

SEPARABLE = TXN + f""",
parted AS (SELECT * REPLACE (CAST(looped > 0 AS int) AS label) FROM txn),
test AS (SELECT {', '.join(['address', 'year', 'day', 'income', 'label'])}, label AS prediction FROM parted
         WHERE {_draw(['label', *S.KEY_COLUMNS])} >= 0.8),
scored AS (SELECT address, year, day, income, label, label AS prediction FROM parted)"""


def _histogram_auto() -> str:
    parts = [f"""
  SELECT '{c}' AS "column", bin, lo + bin * width AS bin_low, lo + (bin + 1) * width AS bin_high,
         count(*) AS n
  FROM (
    SELECT lo, width, least(CAST(floor((x - lo) / width) AS bigint), bins - 1) AS bin
    FROM (SELECT CAST({c} AS double) AS x FROM shaped), (
      SELECT lo, bins, (hi - lo) / bins AS width FROM (
        SELECT lo, hi, CAST(ceil((hi - lo) / least(
                 2 * (q3 - q1) * pow(n, -1.0 / 3.0), (hi - lo) / (log2(n) + 1))) AS bigint) AS bins
        FROM (SELECT CAST(count(*) AS double) AS n, CAST(min({c}) AS double) AS lo,
                     CAST(max({c}) AS double) AS hi,
                     quantile_cont(CAST({c} AS double), 0.25) AS q1,
                     quantile_cont(CAST({c} AS double), 0.75) AS q3 FROM shaped))))
  GROUP BY bin, lo, width""" for c in RAW_AND_BOXCOX]
    return f"""WITH {SHAPED}
SELECT "column", bin, round(bin_low, 6) AS bin_low, round(bin_high, 6) AS bin_high, n
FROM ({_union(parts)})"""


def _kde(column: str, source: str, cut: float, by: str | None) -> str:
    key = by or "1"
    return f"""
  SELECT {'g AS ' + by + ',' if by else ''} CAST(point AS int) AS point, x,
         sum(c * exp(-0.5 * pow((x - v) / bw, 2))) / (n * bw * sqrt(2 * pi())) AS density
  FROM (SELECT g, n, bw, point, lo - {cut} * bw + point * ((hi - lo + 2 * {cut} * bw) / 199) AS x
        FROM (SELECT {key} AS g, count(*) AS n, min({column}) AS lo, max({column}) AS hi,
                     stddev_samp({column}) * pow(count(*), -0.2) AS bw
              FROM {source} GROUP BY 1) CROSS JOIN (SELECT unnest(range(200)) AS point))
  JOIN (SELECT {key} AS h, CAST({column} AS double) AS v, count(*) AS c FROM {source} GROUP BY 1, 2)
    ON g = h
  GROUP BY g, point, x, n, bw"""


def _boxplot(scope: str, source: str) -> str:
    return _union([f"""
  SELECT '{scope}' AS scope, '{c}' AS "column", CAST(count(*) AS bigint) AS n, q1, median, q3,
         least(min(CASE WHEN {c} >= q1 - 1.5 * (q3 - q1) THEN {c} END), q1) AS whisker_low,
         greatest(max(CASE WHEN {c} <= q3 + 1.5 * (q3 - q1) THEN {c} END), q3) AS whisker_high,
         CAST(count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1)
                                  OR {c} > q3 + 1.5 * (q3 - q1)) AS bigint) AS outliers
  FROM {source}, (SELECT quantile_cont(CAST({c} AS double), 0.25) AS q1,
                         quantile_cont(CAST({c} AS double), 0.5) AS median,
                         quantile_cont(CAST({c} AS double), 0.75) AS q3 FROM {source})
  GROUP BY q1, median, q3""" for c in ["length", "weight", "income"]])


def _describe() -> str:
    def one(c: str) -> str:
        if c in ("address", "label"):
            return f"""SELECT '{c}' AS "column", count({c}) AS n, CAST(NULL AS double) AS mean,
  CAST(NULL AS double) AS std, CAST(NULL AS double) AS min, CAST(NULL AS double) AS max,
  min({c}) AS min_text, max({c}) AS max_text, CAST(NULL AS double) AS q1,
  CAST(NULL AS double) AS median, CAST(NULL AS double) AS q3 FROM dirty"""
        return f"""SELECT '{c}' AS "column", count({c}) AS n, round(avg({c}), 4) AS mean,
  round(stddev_samp({c}), 4) AS std, round(CAST(min({c}) AS double), 4) AS min,
  round(CAST(max({c}) AS double), 4) AS max,
  CAST(NULL AS varchar) AS min_text, CAST(NULL AS varchar) AS max_text,
  round(quantile_cont(CAST({c} AS double), 0.25), 4) AS q1,
  round(quantile_cont(CAST({c} AS double), 0.5), 4) AS median,
  round(quantile_cont(CAST({c} AS double), 0.75), 4) AS q3 FROM dirty"""
    return f"WITH {DIRTY}\n" + _union([one(c) for c in S.TXN.fieldNames()])


def _correlation() -> str:
    columns = [*S.NUMERIC, "fraud"]

    def number(c: str) -> str:
        return f"CAST({c} AS double)" if c != "fraud" else "CAST(CAST(fraud AS int) AS double)"

    return f"WITH {FLAGGED}\n" + _union([
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({number(a)}, {number(b)}), 6) AS r "
        "FROM flagged" for a in columns for b in columns])


def _profile() -> str:
    def one(c: str, lam: float) -> str:
        t = "ln(y)" if lam == 0 else f"(pow(y, {lam}) - 1) / {lam}"
        return f"""SELECT '{c}' AS "column", CAST({lam} AS double) AS lambda,
  round(({lam} - 1) * sum(ln(y)) - count(*) / 2.0 * ln(var_pop({t})), 3) AS llf
  FROM (SELECT CAST({c} AS double) + 1 AS y FROM txn)"""
    return f"WITH {TXN}\n" + _union([one(c, v) for c in S.BOXCOX_COLUMNS for v in PROFILE_GRID])


def _fit() -> str:
    """Six rounds of 41 points, each a tenth of the width before, starting from [-20, 20]."""
    parts = [TXN.strip()]
    for c in S.BOXCOX_COLUMNS:
        parts.append(f"""v_{c} AS (SELECT w, count(*) AS n FROM (
    SELECT ln(CAST({c} AS double) + 1) - (SELECT avg(ln(CAST({c} AS double) + 1)) FROM txn) AS w
    FROM txn) GROUP BY w)""")
        centre = "0.0"
        for r, step in enumerate([1.0, 0.1, 0.01, 0.001, 0.0001, 0.00001]):
            half = 20
            parts.append(f"""r{r}_{c} AS (
    SELECT arg_max(lam, llf) AS lam FROM (
      SELECT lam, -ln(sum(n * t * t) / sum(n) - pow(sum(n * t) / sum(n), 2)) AS llf
      FROM (SELECT n, lam, CASE WHEN lam = 0 THEN w ELSE (exp(lam * w) - 1) / lam END AS t
            FROM v_{c} CROSS JOIN (
              SELECT round({centre} + i * {step}, 7) AS lam
              FROM (SELECT unnest(range(-{half}, {half + 1})) AS i))) GROUP BY lam))""")
            centre = f"(SELECT lam FROM r{r}_{c})"
        last = f"r5_{c}"
        parts.append(f"""f_{c} AS (SELECT '{c}' AS "column", CAST(round(lam, 3) AS double) AS lambda FROM {last})""")
    return "WITH " + ",\n".join(parts) + "\n" + _union(
        [f"SELECT * FROM f_{c}" for c in S.BOXCOX_COLUMNS])


def _frequency(key: str, first: int, last: int, extra: str = "") -> str:
    return f"""WITH {DATED}
SELECT CAST(k AS int) AS {key}, CAST(coalesce(n, 0) AS bigint) AS n{extra}
FROM (SELECT unnest(range({first}, {last + 1})) AS k)
LEFT JOIN (SELECT {key} AS v, count(*) AS n FROM dated GROUP BY 1) ON k = v"""


def _eda() -> str:
    return ", ".join(c for c in S.TXN.fieldNames() if c not in ("address", "label"))


def _random_oversample() -> str:
    order = ", ".join(S.NUMERIC)
    whole = ", ".join(f"CAST({c} AS varchar)" for c in S.NUMERIC if c != "weight")
    return f"""WITH {FLAGGED},
n AS (SELECT count(*) FILTER (WHERE fraud) AS bad, count(*) FILTER (WHERE NOT fraud) AS good
      FROM flagged),
shares AS (
  SELECT *, least({BUCKET_ROWS}, copies - share * {BUCKET_ROWS}) AS size
  FROM (SELECT *, unnest(range((copies - 1) // {BUCKET_ROWS} + 1)) AS share
        FROM (SELECT {_eda()}, fraud, count(*) AS copies FROM flagged WHERE fraud GROUP BY ALL))),
dealt AS (
  SELECT shares.*, {_hash(f"concat_ws('|', 'deal', {whole}, fraud, share)", 12)}
                   % greatest(1, (bad + {BUCKET_ROWS - 1}) // {BUCKET_ROWS}) AS bucket FROM shares, n),
placed AS (
  SELECT *, sum(size) OVER (ORDER BY bucket, {order}, share ROWS UNBOUNDED PRECEDING) AS stop FROM dealt),
numbered AS (SELECT {_eda()}, fraud, unnest(range(CAST(stop - size AS bigint), CAST(stop AS bigint))) AS row_no
             FROM placed),
draws AS (SELECT {_hash("concat_ws('|', '42-true', CAST(id AS varchar))", 12)} % bad AS row_no
          FROM n, (SELECT unnest(range((SELECT good - bad FROM n))) AS id))
SELECT {_eda()}, fraud FROM flagged
UNION ALL
SELECT {_eda()}, fraud FROM draws JOIN numbered USING (row_no)"""


def _smote() -> str:
    # features by falling spread of the suspicious rows, as the distances are summed
    wide = ["income", "day", "length", "count", "neighbors", "year", "looped", "weight"]
    return f"""WITH {FLAGGED},
n AS (SELECT count(*) FILTER (WHERE fraud) AS bad, count(*) FILTER (WHERE NOT fraud) AS good
      FROM flagged),
p AS (SELECT {', '.join(f'CAST({c} AS double) AS {c}' for c in S.NUMERIC)},
             row_number() OVER (ORDER BY {{order}}) - 1 AS row_no
      FROM flagged WHERE fraud),
pairs AS (
  SELECT a.row_no, b.row_no AS near_no,
         row_number() OVER (PARTITION BY a.row_no ORDER BY sqrt({{distance}}), b.row_no) - 1 AS pick
  FROM p a JOIN p b ON a.row_no <> b.row_no),
draws AS (
  SELECT {_hash("concat_ws('|', '42-true-row', CAST(id AS varchar))", 12)} % bad AS row_no,
         {_hash("concat_ws('|', '42-true-near', CAST(id AS varchar))", 12)} % 5 AS pick,
         {_hash("concat_ws('|', '42-true-step', CAST(id AS varchar))", 8)} / 4294967296.0 AS u
  FROM n, (SELECT unnest(range((SELECT good - bad FROM n))) AS id)),
made AS (
  SELECT {', '.join(f'a.{c} + u * (b.{c} - a.{c}) AS {c}' for c in S.NUMERIC)}
  FROM draws JOIN pairs USING (row_no, pick)
  JOIN p a ON a.row_no = draws.row_no JOIN p b ON b.row_no = near_no)
SELECT {', '.join(c if c != 'weight' else 'round(weight, 6) AS weight' for c in S.NUMERIC)}, fraud
FROM flagged
UNION ALL
SELECT {', '.join('round(weight, 6)' if c == 'weight' else
                  f"CAST(trunc({c}) AS {'bigint' if c == 'income' else 'int'})"
                  for c in S.NUMERIC)}, true FROM made""".format(
        order=", ".join(wide),
        distance=" + ".join(f"(a.{c} - b.{c}) * (a.{c} - b.{c})" for c in wide))


def _zscore(std: str) -> str:
    def one(measure: str) -> str:
        return f"""SELECT {COLUMNS}, '{measure}' AS measure, round((x - m) / sd, 6) AS z
FROM (SELECT *, {measure.replace('income_count_interaction', 'income * count')} AS x FROM txn),
     (SELECT avg({measure.replace('income_count_interaction', 'income * count')}) AS m,
             {std}({measure.replace('income_count_interaction', 'income * count')}) AS sd FROM txn)
WHERE abs((x - m) / sd) > 3"""
    return f"WITH {TXN}\n" + _union([one("income"), one("income_count_interaction")])


BINARY = """,
kept AS (SELECT * REPLACE (CASE WHEN label <> 'white' THEN 'black' ELSE 'white' END AS label) FROM txn)"""

FEATURES = TXN + BINARY + f""",
features AS (
  SELECT *, count(address) OVER (PARTITION BY address) AS num_addresses,
         {WEEKDAY} AS day_of_week, CASE WHEN {WEEKDAY} IN (1, 7) THEN 1 ELSE 0 END AS is_holiday,
         length * weight AS length_weight_interaction,
         income * count AS income_count_interaction,
         {', '.join(f'{_boxcox(c, v)} AS {c}_boxcox' for c, v in LAMBDAS.items())}
  FROM kept)"""


def _rounded(columns: list[str]) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_BOXCOX_NAMES = [f"{c}_boxcox" for c in LAMBDAS]
_STATS = [(c, n, f) for c in S.STATS_COLUMNS for n, f in (
    ("mean", "avg({})"), ("std", "stddev_samp({})"),
    ("median", "quantile_cont(CAST({} AS double), 0.5)"))]

ORACLE: dict[str, str] = {
    "scan_parquet": f"WITH {TXN} SELECT * FROM txn",
    "scan_csv": f"WITH {TXN} SELECT * FROM txn",
    "sink_parquet": f"WITH {DIRTY}{CLEAN} SELECT * FROM clean",
    "sink_csv": f"WITH {TXN} SELECT year, label, count(*) AS n FROM txn GROUP BY 1, 2",
    "schema_report": f"WITH {DIRTY}\n" + _union([
        f"SELECT '{f.name}' AS \"column\", '{f.dataType.simpleString()}' AS type, "
        f"count({f.name}) AS non_null FROM dirty" for f in S.TXN.fields]),
    "project_columns": f"WITH {TXN} SELECT length, weight, income FROM txn",
    "drop_columns": f"""WITH {DIRTY}
SELECT {_eda()}, coalesce(label <> 'white', true) AS fraud FROM dirty""",
    "drop_nulls": f"WITH {DIRTY}{CLEAN} SELECT * FROM clean",
    "drop_duplicates": f"WITH {DIRTY} SELECT DISTINCT * FROM dirty",
    "filter_label": f"""WITH {DIRTY}
SELECT *, CASE WHEN label = 'white' THEN 'majority' ELSE 'minority' END AS side
FROM dirty WHERE label IS NOT NULL""",
    "filter_fraud_trimmed": f"""WITH {DIRTY}
SELECT length, weight, income FROM dirty
WHERE coalesce(label <> 'white', true) AND weight < 100""",
    "flag_fraud": f"WITH {DIRTY} SELECT *, coalesce(label <> 'white', true) AS fraud FROM dirty",
    "relabel_binary": f"""WITH {DIRTY}
SELECT {COLUMNS.replace(', label', '')},
       CASE WHEN label <> 'white' THEN 'black' ELSE 'white' END AS label,
       'whole table' AS spelling FROM dirty
UNION ALL
SELECT {COLUMNS.replace(', label', '')}, 'black', 'minority' FROM dirty WHERE label <> 'white'""",
    "encode_label": f"""WITH {DIRTY}
SELECT {COLUMNS.replace(', label', '')}, CAST(label = 'white' AS int) AS label FROM dirty""",
    "txn_date": f"WITH {TXN} SELECT address, year, day, {DATE} AS txn_date FROM txn",
    "day_of_week": f"WITH {TXN} SELECT *, {WEEKDAY} AS day_of_week FROM txn",
    "month_of_year": f"WITH {TXN} SELECT *, CAST(month({DATE}) AS int) AS month FROM txn",
    "weekend_flag": f"""WITH {TXN} SELECT *, {WEEKDAY} AS day_of_week,
  CASE WHEN {WEEKDAY} IN (1, 7) THEN 1 ELSE 0 END AS is_holiday FROM txn""",
    "public_holiday_flag": f"WITH {TXN} SELECT *, {HOLIDAY} AS is_public_holiday FROM txn",
    "interaction_features": f"""WITH {TXN} SELECT address, year, day, income,
  round(length * weight, 6) AS length_weight_interaction,
  income * count AS income_count_interaction FROM txn""",
    "boxcox_apply": f"""WITH {TXN} SELECT address, year, day, income,
  {', '.join(f'round({_boxcox(c, v)}, 6) AS {c}_boxcox' for c, v in LAMBDAS.items())} FROM txn""",
    "row_counts": f"""WITH {DIRTY}{CLEAN}
SELECT 'before' AS step, count(*) AS n FROM dirty
UNION ALL SELECT 'after', count(*) FROM clean""",
    "null_counts": f"WITH {DIRTY} SELECT " + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in S.TXN.fieldNames()) + " FROM dirty",
    "describe_table": _describe(),
    "group_count_year": f"WITH {TXN} SELECT year, count(*) AS n FROM txn GROUP BY 1 ORDER BY 1",
    "group_count_year_fraud": f"WITH {FRAUD} SELECT year, count(*) AS n FROM bad GROUP BY 1",
    "group_count_day": f"""WITH {TXN}
SELECT day, count(*) AS n FROM txn GROUP BY 1 ORDER BY 1 LIMIT 10""",
    "class_counts": f"""WITH {DIRTY}
SELECT coalesce(label <> 'white', true) AS fraud, count(*) AS n FROM dirty GROUP BY 1""",
    "group_means": f"""WITH {FLAGGED} SELECT fraud, round(avg(income), 4) AS mean_income,
  round(avg(count), 4) AS mean_count FROM flagged GROUP BY 1""",
    "fraud_stats": f"WITH {FLAGGED} SELECT fraud, " + ", ".join(
        f"round({f.format(c)}, 4) AS {n}_{c}" for c, n, f in _STATS) + " FROM flagged GROUP BY 1",
    "median_exact": f"WITH {FLAGGED}\n" + _union([
        f"SELECT fraud, '{c}' AS \"column\", round(quantile_cont(CAST({c} AS double), 0.5), 6) "
        "AS value FROM flagged GROUP BY 1" for c in S.STATS_COLUMNS]),
    "global_moments": f"""WITH {TXN}
SELECT round(avg(income), 4) AS mean, round(stddev_samp(income), 4) AS std FROM txn""",
    "correlation_matrix": _correlation(),
    "correlation_pairwise": f"WITH {DIRTY}\n" + _union([
        f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr(CAST({a} AS double), CAST({b} AS double)), 6) "
        "AS r FROM dirty" for a in S.NUMERIC for b in S.NUMERIC]),
    "median_approx": f"""WITH {FLAGGED} SELECT DISTINCT fraud, c AS "column", true AS occurs,
true AS in_bounds FROM flagged, (VALUES ('income'), ('weight'), ('length')) AS t(c)""",
    **{key: f"WITH {SEPARABLE} SELECT * FROM test" for key in (
        "fit_logistic", "fit_decision_tree", "fit_random_forest", "fit_naive_bayes", "fit_gbt",
        "fit_linear_svc", "test_predictions")},
    **{key: f"WITH {SEPARABLE} SELECT * FROM scored" for key in (
        "model_roundtrip", "batch_scoring", "stream_scoring")},
    "vector_element": f"WITH {TXN} SELECT address, " + ", ".join(
        f"CAST({c} AS double) AS v_{c}" for c in S.NUMERIC) + " FROM txn",
    "model_leaderboard": f"""WITH {SEPARABLE}
SELECT algorithm, auc, auc AS precision, auc AS recall, auc AS f1, auc AS accuracy
FROM (SELECT CAST(avg(CAST(label = prediction AS int)) AS double) AS auc FROM test),
  (VALUES ('LogisticRegression'), ('DecisionTreeClassifier'), ('RandomForestClassifier'), ('NaiveBayes'),
          ('GBTClassifier'), ('LinearSVC')) AS t(algorithm)""",
    "feature_importance": f"""WITH {TXN}
SELECT feature, abs(r) > 0.5 AS informative FROM (
  SELECT 'signal_a' AS feature, corr(CAST(looped > 0 AS int), CAST(looped > 0 AS int) * 100 + count) AS r
  FROM txn UNION ALL
  SELECT 'signal_b', corr(CAST(looped > 0 AS int), CAST(looped <= 0 AS int) * 100 + count) FROM txn
  UNION ALL SELECT 'count', corr(CAST(looped > 0 AS int), count) FROM txn)""",
    "rank_importance": f"WITH {TXN}, means AS (" + _union([
        f"SELECT '{c}' AS feature, round(avg({c}), 6) AS importance FROM txn" for c in S.NUMERIC])
        + """)
SELECT CAST(row_number() OVER (ORDER BY importance DESC, feature) AS int) AS place, feature, importance
FROM means""",
    "run_stages": f"""WITH {SEPARABLE}
SELECT algorithm, CASE WHEN tree THEN auc END AS tree_auc
FROM (SELECT CAST(avg(CAST(label = prediction AS int)) AS double) AS auc FROM test),
  (VALUES ('LogisticRegression', false), ('DecisionTreeClassifier', true), ('RandomForestClassifier', false),
          ('NaiveBayes', false), ('GBTClassifier', true), ('LinearSVC', false)) AS t(algorithm, tree)""",
    "histogram_fixed": f"WITH {TXN} {_histogram('txn')}",
    "histogram_fraud": f"WITH {FRAUD} {_histogram('bad')}",
    "histogram_auto": _histogram_auto(),
    "kde_curve": f"""WITH {SHAPED}
SELECT "column", point, round(x, 4) AS x,
       round(density, CASE WHEN "column" = 'income' THEN 14 ELSE 9 END) AS density FROM (""" + _union([
        f"SELECT *, '{c}' AS \"column\" FROM ({_kde(c, 'shaped', 0.0, None)})"
        for c in RAW_AND_BOXCOX]) + ")",
    "kde_by_class": f"""WITH {FLAGGED}
SELECT fraud, point, round(x, 4) AS x,
       round(density, CASE WHEN "column" = 'income' THEN 14 ELSE 10 END) AS density, "column" FROM (""" + _union([
        f"SELECT *, '{c}' AS \"column\" FROM ({_kde(c, 'flagged', 3.0, 'fraud')})"
        for c in ["length", "weight", "income"]]) + ")",
    "boxplot_stats": f"""WITH {FLAGGED}, trimmed AS (SELECT * FROM flagged WHERE fraud AND weight < 100)
SELECT scope, "column", n, outliers, {_rounded(["q1", "median", "q3", "whisker_low", "whisker_high"])}
FROM ({_boxplot('all', 'flagged')} UNION ALL {_boxplot('suspicious', 'trimmed')})""",
    "fraud_by_month": _frequency("month", 1, 12),
    "fraud_by_holiday": _frequency("is_public_holiday", 0, 1),
    "fraud_by_day": _frequency(
        "day", 1, 365, f", {HOLIDAY.replace('day', 'k')} AS is_public_holiday"),
    "fraud_by_weekday": _frequency("day_of_week", 1, 7),
    "scatter_sample": f"WITH {TXN}{_kept('txn')}\n" + _union([
        f"SELECT '{a}' AS x_name, '{b}' AS y_name, CAST({a} AS double) AS x, "
        f"CAST({b} AS double) AS y, label FROM kept"
        for a in ["length", "income", "weight"] for b in ["count", "neighbors"]]),
    "pair_density": f"WITH {TXN}{BINARY}, r AS (SELECT " + ", ".join(
        f"CAST(min({c}) AS double) AS lo_{c}, "
        f"(CAST(max({c}) AS double) - CAST(min({c}) AS double)) / 30 AS w_{c}" for c in S.NUMERIC)
        + " FROM kept), b AS (SELECT label, " + ", ".join(
        f"CAST(least(floor((CAST({c} AS double) - lo_{c}) / w_{c}), 29) AS int) AS {c}"
        for c in S.NUMERIC) + " FROM kept, r)\n" + _union([
        f"SELECT '{a}' AS x_name, '{b}' AS y_name, {a} AS bin_x, {b} AS bin_y, label, "
        "count(*) AS n FROM b GROUP BY ALL"
        for i, a in enumerate(S.NUMERIC) for b in S.NUMERIC[i:]]),
    "model_choice": f"""WITH {TXN},
seen AS (SELECT CAST((count % 2 = 0) <> (day > 183) AS int) AS said, income % 10 = 0 AS turned FROM txn),
rule AS (SELECT round((1 + avg(said) FILTER (WHERE (said = 1) <> turned)
                         - avg(said) FILTER (WHERE (said = 1) = turned)) / 2, 1) AS auc FROM seen)
SELECT algorithm, CASE WHEN tree THEN auc END AS auc, tree AS chosen
FROM rule, (VALUES ('LogisticRegression', false), ('DecisionTreeClassifier', true), ('LinearSVC', false))
  AS t(algorithm, tree)""",
    "stream_rejects": f"""WITH {TXN}
SELECT CASE WHEN income % 71 = 0 THEN 'does not parse'
            WHEN income % 73 = 0 THEN 'without signal_b' ELSE 'scored' END AS reason, count(*) AS n
FROM txn GROUP BY 1""",
    "boxcox_fit": _fit(),
    "boxcox_profile": _profile(),
    "describe_categorical": f"""WITH {FLAGGED},
n AS (SELECT greatest(count(*) FILTER (WHERE fraud), count(*) FILTER (WHERE NOT fraud)) AS m
      FROM flagged)
SELECT 2 * m AS n, CAST(2 AS bigint) AS "distinct", 'false' AS top, m AS freq FROM n""",
    "address_activity": f"""WITH {TXN}
SELECT *, count(address) OVER (PARTITION BY address) AS num_addresses FROM txn""",
    "order_by": f"""WITH {TXN} SELECT year, label, count(*) AS n FROM txn GROUP BY 1, 2
ORDER BY year, n DESC, label""",
    "limit_rows": f"WITH {TXN} SELECT * FROM txn ORDER BY {COLUMNS} LIMIT 10",
    "union_all": f"WITH {TXN} SELECT * FROM txn",
    "distinct_values": f"WITH {FRAUD} SELECT DISTINCT year FROM bad",
    "bernoulli_sample": f"WITH {TXN} SELECT * FROM txn WHERE {_draw()} < 0.8",
    "downsample_majority": f"WITH {DIRTY}{_kept('dirty')} SELECT * FROM kept",
    "stratified_split": f"""WITH {DIRTY},
coded AS (SELECT {COLUMNS.replace(', label', '')}, CAST(label = 'white' AS int) AS label FROM dirty)
SELECT *, CASE WHEN {_draw(['label', *S.KEY_COLUMNS])} < 0.8 THEN 'train' ELSE 'test' END AS split
FROM coded WHERE label IS NOT NULL""",
    "random_oversample": _random_oversample(),
    "smote_oversample": _smote(),
    "zscore_outliers": _zscore("stddev_samp"),
    "zscore_outliers_pop": _zscore("stddev_pop"),
    "outlier_scatter": f"""WITH {TXN},
s AS (SELECT avg(income) AS m, stddev_samp(income) AS sd FROM txn)
SELECT income, abs((income - m) / sd) > 3 AS is_outlier FROM txn, s""",
    "assemble_features": f"WITH {FEATURES} SELECT " + ", ".join(
        f"round(CAST({c} AS double), 6) AS v{i}" for i, c in enumerate(S.NOTEBOOK_FEATURES))
        + " FROM features",
    "auc_roc": f"""WITH {SCORES}
SELECT round(sum(neg_at * (tp - pos_at + pos_at / 2.0)) / (any_value(pos) * any_value(neg)), 9) AS auc
FROM steps, size""",
    "weighted_metrics": f"""WITH {SCORES},
c AS (SELECT label AS k, count(*) AS actual,
             CAST(count(*) FILTER (WHERE prediction = label) AS double) AS hit,
             (SELECT count(*) FROM pred q WHERE q.prediction = p.label) AS said
      FROM pred p GROUP BY label),
m AS (SELECT actual, hit, hit / said AS prec, hit / actual AS rec FROM c)
SELECT round(sum(actual * prec) / sum(actual), 9) AS precision,
       round(sum(actual * rec) / sum(actual), 9) AS recall,
       round(sum(actual * 2 * prec * rec / (prec + rec)) / sum(actual), 9) AS f1,
       round(sum(hit) / sum(actual), 9) AS accuracy FROM m""",
    "roc_curve": f"""WITH {SCORES}
SELECT score AS threshold, round(fp / neg, 9) AS fpr, round(tp / pos, 9) AS tpr FROM steps, size
UNION ALL SELECT CAST('Infinity' AS double), 0.0, 0.0""",
    "pr_curve": f"""WITH {SCORES}
SELECT score AS threshold, round(tp / (tp + fp), 9) AS precision, round(tp / pos, 9) AS recall
FROM steps, size
UNION ALL SELECT NULL, 1.0, 0.0""",
    "confusion_matrix": f"""WITH {SCORES}
SELECT a.v AS label, b.v AS prediction, CAST(coalesce(n, 0) AS bigint) AS n
FROM (SELECT CAST(unnest(range(2)) AS int) AS v) a CROSS JOIN (SELECT CAST(unnest(range(2)) AS int) AS v) b
LEFT JOIN (SELECT label, prediction, count(*) AS n FROM pred GROUP BY 1, 2) c
  ON a.v = c.label AND b.v = c.prediction""",
    "feature_table": f"""WITH {FEATURES}
SELECT {COLUMNS}, num_addresses, day_of_week, is_holiday,
       round(length_weight_interaction, 6) AS length_weight_interaction, income_count_interaction,
       {_rounded(_BOXCOX_NAMES)} FROM features""",
}
